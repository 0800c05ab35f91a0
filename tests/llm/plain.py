"""Plain Python versions of the operators' contracts, for small tables."""

import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def fold(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5


def base_counts(text):
    w = words(text)
    seen = defaultdict(list)
    for i in range(len(w) - 2):
        seen[tuple(w[i : i + 3])].append(i)
    hit = {j for at in seen.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
    }


def host_verdicts(rows, limit=0.5):
    """kept of each (text, host)."""
    counts = [base_counts(t) for t, _ in rows]
    base = [c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"] for c in counts]
    rule = [
        b or 100 * c["n_symbols"] > 20 * c["word_chars"] or 100 * c["n_dup_lines"] > 50 * c["n_lines"]
        for b, c in zip(base, counts, strict=True)
    ]
    hosts = defaultdict(list)
    for (_, host), failed in zip(rows, rule, strict=True):
        hosts[host].append(failed)
    rates = [sum(f) / len(f) for f in hosts.values()]
    m = sum(rates) / len(rates) if rates else 0
    v = sum((r - m) ** 2 for r in rates) / len(rates) if rates else 0
    s = max(m * (1 - m) / v - 1, 0) if v > 1e-12 else 1
    shrunk = {h: (sum(f) + m * s) / (len(f) + s) for h, f in hosts.items()}
    return [not b and shrunk[h] <= limit for (_, h), b in zip(rows, base, strict=True)]


def shingles(text):
    w = words(lower(text))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def overlap_join(rows):
    """{row number: (n_shingles, component_id, n_links)} of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in (least.get(find(i)), doc_id) if x is not None]
        least[find(i)] = min(known) if known else None
    return [(len(s), least[find(i)], links[i]) for i, s in enumerate(sets)]


def mix_targets(sizes):
    """Target of each source: weights 5, 2, 1 by code point with null last, none above twice its size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, targets = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        rate = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * rate > 2 * sizes[s]}
        if not over:
            return targets | {s: weight[s] * rate for s in free}
        for s in over:
            targets[s] = 2.0 * sizes[s]
            left -= targets[s]
        free -= over
    return targets
