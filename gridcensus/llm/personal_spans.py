"""Personal data in texts: spans by rule, and more spans by gradient-boosted trees over candidates.

Generators propose overlapping candidates in looser forms than the rules know (``name [at] host [dot]
org``, cards with dots between the digits, phones without a plus, addresses with ``[.]``). Boosted trees
see the format of a candidate, read as the plain form it stands for, and its context. They learn from
the spans that the rules accept, from those spans written in looser forms, from spans with broken digits
and from candidates that no rule accepts. A threshold per kind comes from held-out documents.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.llm.common import materialize, pieces

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Least share of true spans among held-out examples at or above a threshold.
PRECISION = 0.99
TREES, DEPTH, SEED = 12, 4, 7
STEP_BYTES = 1 << 20

# --- rules -----------------------------------------------------------------------------------

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# the run of digits is taken whole: a shorter one or a later start could not go on either
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the leftmost matches of each kind that pass their test, by kind and start."""
    spans, upto, at = [], 0, text.find("@")
    while at >= 0:
        first = at
        while first > upto and text[first - 1] in _LOCAL:
            first -= 1
        host = _HOST.match(text, at + 1) if first < at else None
        if host:
            spans.append((EMAIL, first, host.end()))
        upto = host.end() if host else at + 1
        at = text.find("@", upto)
    spans += [(IP, *m.span()) for m in _IP.finditer(text) if all(map(_octet, m.groups()))]
    for m in _CARD.finditer(text):
        digits = digits_of(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((CARD, *m.span()))
    spans += [(PHONE, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return spans


# --- candidates ------------------------------------------------------------------------------

_AT = re.compile(r"\s?[\[({<]\s?at\s?[\])}>]\s?|\sat\s|\s?@\s?", re.IGNORECASE)
_DOT = r"(?:\.|\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\sdot\s)"
_DOTS = re.compile(_DOT, re.IGNORECASE)
#: A local part has at most 64 characters; written-out dots take more room.
LOCAL_ROOM = 128
_BEFORE = re.compile(rf"[A-Za-z0-9_%+-]+(?:{_DOT}[A-Za-z0-9_%+-]+){{0,8}}$", re.IGNORECASE)
_AFTER = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,8}}", re.IGNORECASE)
_FOUR = re.compile(rf"(?<![0-9A-Za-z])[0-9]{{1,4}}(?:{_DOT}[0-9]{{1,4}}){{3}}(?![0-9A-Za-z])", re.IGNORECASE)
# a candidate does not begin or end inside a longer row of digits
_OUTSIDE, _NOT_ON = r"(?<![0-9])(?<![0-9][./_-])", r"(?![./_-]?[0-9])"
_LONG = re.compile(rf"{_OUTSIDE}[0-9](?:[ ./_-]{{0,2}}[0-9]){{11,19}}{_NOT_ON}")
_SHORT = re.compile(rf"{_OUTSIDE}(?:\+|\(|\+\()?[0-9](?:[ ()./-]{{0,3}}[0-9]){{6,14}}{_NOT_ON}")


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of everything that might be personal data; spans of several kinds may overlap."""
    found = []
    for m in _AT.finditer(text):
        after = _AFTER.match(text, m.end())
        if after:
            before = _BEFORE.search(text, max(0, m.start() - LOCAL_ROOM), m.start())
            if before:
                found.append((EMAIL, before.start(), after.end()))
    for kind, pattern in ((IP, _FOUR), (CARD, _LONG), (PHONE, _SHORT)):
        found += [(kind, *m.span()) for m in pattern.finditer(text)]
    return found


#: Words that speak for a kind, and words that speak against any.
CUES = (
    ("mail", "email", "e-mail", "contact", "write", "correo", "courriel"),
    ("ip", "host", "server", "address", "login", "from"),
    ("card", "visa", "mastercard", "amex", "credit", "karte", "tarjeta", "carte"),
    ("phone", "tel", "call", "mobile", "fax", "telefon", "telefono", "cell"),
)
AGAINST = ("version", "v", "isbn", "id", "no", "nr", "order", "page", "section", "token", "key", "=", "$", "€")
_WORDS = re.compile(r"[A-Za-z][A-Za-z-]*|[=$€]")

FEATURES = (
    "kind valid digits letters groups longest shortest labels top_label local plus parentheses first_digit"
    " before after cue against"
).split()


def _class_of(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


def _valid(kind: int, plain: str, digits: str, labels: list[str]) -> bool:
    """Whether the plain form passes the test that data of its kind must pass."""
    if kind == EMAIL:
        return len(labels) > 1 and labels[-1].isalpha() and labels[-1].islower()
    if kind == IP:
        return all(map(_octet, plain.split(".")))
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == CARD else 8 <= len(digits) <= 15


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of a candidate in its plain form, and its context."""
    span = text[start:end]
    if kind == EMAIL:
        span = _DOTS.sub(".", _AT.sub("@", span, count=1))
    elif kind == IP:
        span = _DOTS.sub(".", span)
    local, _, host = span.partition("@")
    labels = host.split(".") if kind == EMAIL else []
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    before, after = text[max(0, start - 24) : start], text[end : end + 1]
    words = [w.lower() for w in _WORDS.findall(before)[-3:]]
    return [
        float(x)
        for x in (
            kind,
            _valid(kind, span, digits, labels),
            len(digits),
            sum(c.isalpha() for c in span),
            len(groups),
            max(map(len, groups), default=0),
            min(map(len, groups), default=0),
            len(labels),
            len(labels[-1]) if labels and labels[-1].isalpha() else 0,
            len(local) if kind == EMAIL else 0,
            kind == PHONE and (span.startswith("+") or span.startswith("00")),
            kind == PHONE and "(" in span,
            int(digits[0]) if digits and kind == CARD else 0,
            _class_of(before[-1:]),
            _class_of(after),
            any(w in CUES[kind] for w in words),
            any(w in AGAINST for w in words),
        )
    ]


# --- examples --------------------------------------------------------------------------------


def _looser(kind: int, span: str, rng: random.Random) -> str:
    """A true span as people write it to hide it from rules."""
    if kind == EMAIL:
        at, dot = rng.choice(((" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", "."), (" @ ", ".")))
        local, _, host = span.partition("@")
        return local.strip(".").replace("..", ".") + at + host.replace(".", dot)
    if kind == IP:
        return span.replace(".", rng.choice(("[.]", " dot ", "(.)", "[dot]")))
    digits = digits_of(span)
    if kind == CARD:
        gap = rng.choice((".", "/", "_", "  ", "- "))
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    gap = rng.choice((".", "-", " ", "/"))
    country, rest = digits[: max(0, len(digits) - 10)], digits[-10:]
    start = rng.choice(("", "00" + country + gap, country + gap if country else ""))
    return start + gap.join((rest[:3], rest[3:6], rest[6:]))


def _broken(kind: int, span: str, rng: random.Random) -> str:
    """A span of the same look that is no such data."""
    digits = [i for i, c in enumerate(span) if "0" <= c <= "9"]
    if kind == CARD:
        i = rng.choice(digits)
        return span[:i] + str((int(span[i]) + rng.randrange(1, 10)) % 10) + span[i + 1 :]
    if kind == IP:
        parts = span.split(".")
        parts[rng.randrange(4)] = str(rng.randrange(256, 9999))
        return ".".join(parts)
    if kind == PHONE:
        return digits_of(span)[: rng.randrange(4, 8)] if rng.random() < 0.5 else digits_of(span)[:9] + "0" * rng.randrange(6)
    local, _, host = span.partition("@")
    return f"{local.rpartition('.')[2]} at {host.split('.')[0]}.{rng.choice(('The', 'And', 'It', 'La', 'Der'))}"


def _proposed(text: str, kind: int, start: int, end: int, written: str, label: int) -> Iterator[dict]:
    """What the generators propose where a span is written otherwise in its own context.

    A candidate of the span's kind that covers it has its label; those of other kinds are false.
    """
    before = text[max(0, start - 160) : start]
    changed = before + written + text[end : end + 40]
    first, last = len(before), len(before) + len(written)
    for k, a, b in candidates(changed):
        if k == kind and abs(a - first) <= 1 and b >= last:
            yield {"kind": k, "label": label, "f": features(changed, k, a, b)}
        elif k != kind and a < last and b > first:
            yield {"kind": k, "label": 0, "f": features(changed, k, a, b)}


def examples(text: str, rules: list[tuple[int, int, int]], rng: random.Random) -> list[dict]:
    """True spans as they are and in a looser form, and broken ones in both."""
    made = []
    for kind, start, end in rules:
        span = text[start:end]
        broken = _broken(kind, span, rng)
        forms = [(1, span), (1, _looser(kind, span, rng)), (0, broken)]
        if kind in (IP, CARD):
            forms.append((0, _looser(kind, broken, rng)))
        for label, written in forms:
            made += _proposed(text, kind, start, end, written, label)
    return made


def _scan(text: str, seed: int) -> tuple[list, list, list]:
    """Rule spans, candidates apart from them and examples of one text."""
    rules = rule_spans(text)
    proposed = candidates(text)
    covered = sorted((s, e) for _, s, e in rules)
    # greatest end of the rule spans up to each start, as spans of two kinds may overlap
    reach, most = [], 0
    for _, e in covered:
        most = max(most, e)
        reach.append(most)
    free = []
    for kind, start, end in proposed:
        i = bisect_left(covered, (end, 0))
        if not i or reach[i - 1] <= start:
            free.append({"kind": kind, "start": start, "end": end, "f": features(text, kind, start, end)})
    return rules, free, examples(text, rules, random.Random(seed)) if rules else []


_FEATURES = pa.list_(pa.float64())
_SPAN = [("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]
SCANNED = (
    "rules array<struct<kind int, start long, end long>>,"
    " free array<struct<kind int, start long, end long, f array<double>>>,"
    " examples array<struct<kind int, label int, f array<double>>>"
)


def _scan_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, STEP_BYTES):
            scanned = [_scan(t or "", zlib.crc32((t or "").encode())) for t in part["text"].to_pylist()]
            rules, free, made = zip(*scanned, strict=True)
            spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in r] for r in rules]
            yield pa.RecordBatch.from_arrays(
                [
                    *[part[i] for i in range(part.num_columns)],
                    pa.array(spans, pa.list_(pa.struct(_SPAN))),
                    pa.array(free, pa.list_(pa.struct([*_SPAN, ("f", _FEATURES)]))),
                    pa.array(made, pa.list_(pa.struct([("kind", pa.int32()), ("label", pa.int32()), ("f", _FEATURES)]))),
                ],
                [*part.schema.names, "rules", "free", "examples"],
            )


# --- model -----------------------------------------------------------------------------------


def _all_examples(scanned: DataFrame) -> DataFrame:
    """(kind, label, f, held_out, weight): every example of every row, equal ones as one with their number.

    A candidate that no rule accepts is a false one, unless it is of a kind with a strict test and passes
    that in its plain form: such a candidate may well be true and teaches nothing.
    """
    made = scanned.select("row", F.explode("examples").alias("e")).select("row", "e.kind", "e.label", "e.f")
    none = scanned.select("row", F.explode("free").alias("e")).select("row", "e.kind", F.lit(0).alias("label"), "e.f")
    none = none.where((F.col("kind") == PHONE) | (F.get("f", F.lit(FEATURES.index("valid"))) == 0))
    held_out = F.pmod(F.xxhash64(F.lit(SEED), "row"), F.lit(5)) == 0
    found = made.unionByName(none).select("kind", "label", "f", held_out.alias("held_out"))
    return found.groupBy(*found.columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def fit_trees(scanned: DataFrame, precision: float = PRECISION):
    """Boosted trees on all examples and the least score to accept for each kind; None where there is too little to learn from.

    From some score on ``precision`` of a kind's held-out examples are true spans. The threshold lies
    halfway between the least such score and the next lower one that an example has, at 0.5 at least. A
    kind that never gets there, or of which none is held out, accepts nothing.
    """
    chosen = materialize(_all_examples(scanned), "pii-examples")
    vectors = chosen.select("kind", F.col("label").cast("double").alias("label"), array_to_vector("f").alias("features"), "held_out", "weight")
    fit = vectors.where("not held_out")
    if fit.select("label").distinct().count() < 2:
        return None, {}
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight").fit(fit)
    scored = model.transform(vectors.where("held_out")).select("kind", "label", "weight", _score().alias("score"))
    # 1000 steps of the score by kind, so what comes to the driver does not grow
    steps = scored.groupBy("kind", F.floor(F.col("score") * 1000).alias("step"))
    counts = steps.agg(F.sum(F.col("label") * F.col("weight")).alias("true"), F.sum("weight").alias("n")).collect()
    thresholds = {}
    for kind in range(len(KINDS)):
        true = n = 0.0
        rows = sorted((c for c in counts if c["kind"] == kind), key=lambda c: -c["step"])
        for row, below in zip(rows, [*(r["step"] for r in rows[1:]), 0], strict=False):
            true, n = true + row["true"], n + row["n"]
            if true >= precision * n:
                thresholds[kind] = max(0.5, (row["step"] + below) / 2000)
    return model, thresholds


def _score() -> Column:
    return vector_to_array("probability")[1]


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Accepted candidates that do not overlap, the best score first, next to the rule spans."""
    for batch in batches:
        resolved = []
        for rules, accepted in zip(batch["rules"].to_pylist(), batch["accepted"].to_pylist(), strict=True):
            starts: list[int] = []
            ends: list[int] = []
            kept = [{**s, "by_rule": True, "score": 1.0} for s in rules]
            for s in sorted(accepted or [], key=lambda s: (-s["score"], s["start"], -s["end"], s["kind"])):
                i = bisect_left(starts, s["end"])
                if not i or ends[i - 1] <= s["start"]:
                    starts.insert(i, s["start"])
                    ends.insert(i, s["end"])
                    kept.append({**s, "by_rule": False})
            kept.sort(key=lambda s: (s["kind"], s["start"]))
            resolved.append([{**s, "kind": KINDS[s["kind"]]} for s in kept])
        carried = [n for n in batch.schema.names if n not in ("rules", "accepted")]
        types = [("kind", pa.string()), *_SPAN[1:], ("by_rule", pa.bool_()), ("score", pa.float64())]
        spans = pa.array(resolved, pa.list_(pa.struct(types)))
        yield pa.RecordBatch.from_arrays([*[batch[n] for n in carried], spans], [*carried, "spans"])


SPANS = "array<struct<kind string, start long, end long, by_rule boolean, score double>>"


def personal_spans(
    docs: DataFrame,
    precision: float = PRECISION,
    keep_text: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, spans) of every row; with ``keep_text`` also the text and ``redacted``, the text without them.

    Spans are in code points, the end exclusive, by kind and start. Rule spans always stay; accepted
    candidates never overlap them or each other. Texts are read once, whole; what goes on are spans and
    features, and only candidates are shuffled, by row. The trees are fitted on all examples of
    all rows, equal ones as one of their weight. A null text counts as empty; an id may be
    null or repeated, as rows have numbers of their own; repeated rows give repeated results; other
    columns are ignored; where nothing can be learned only the rules speak.
    """
    kind = dict(docs.dtypes)[doc_id]
    texts = docs.selectExpr(f"`{doc_id}` as doc_id", f"cast(`{text}` as string) as text")
    read = texts.mapInArrow(_scan_all, f"doc_id {kind}, text string, {SCANNED}")
    carried = ["doc_id", "text"] if keep_text else ["doc_id"]
    scanned = materialize(
        read.select(F.monotonically_increasing_id().alias("row"), *carried, "rules", "free", "examples"), "pii"
    )
    model, thresholds = fit_trees(scanned, precision)
    rows = scanned.select("row", *carried, "rules")
    accepted_type = "array<struct<kind int, start long, end long, score double>>"
    if model is None or not thresholds:
        found = rows.withColumn("accepted", F.lit(None).cast(accepted_type))
    else:
        free = scanned.select("row", F.inline("free")).withColumn("features", array_to_vector("f"))
        least = F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair])
        scored = model.transform(free).select("row", "kind", "start", "end", _score().alias("score"))
        # a kind without a threshold compares with null, which accepts nothing
        accepted = scored.where(F.col("score") >= F.try_element_at(least, F.col("kind")))
        by_row = accepted.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end", "score")).alias("accepted"))
        found = rows.join(by_row, "row", "left")
    schema = f"doc_id {kind}, {'text string, ' if keep_text else ''}spans {SPANS}"
    spans = found.select(*carried, "rules", "accepted").mapInArrow(_resolve, schema)
    return spans.withColumn("redacted", redacted(F.col("text"), F.col("spans"))) if keep_text else spans


def redacted(text: Column, spans: Column) -> Column:
    """The text with the name of its kind in place of every span; of overlapping ones the first to start."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("upto"))

    def add(so_far: Column, s: Column) -> Column:
        length = F.greatest(s["start"] - so_far["upto"], F.lit(0))
        between = F.substring(text, (so_far["upto"] + 1).cast("int"), length.cast("int"))
        name = F.when(s["start"] >= so_far["upto"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")
        return F.struct(
            F.concat(so_far["done"], between, name).alias("done"), F.greatest(so_far["upto"], s["end"]).alias("upto")
        )

    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    rest = lambda done: F.concat(done["done"], F.substring(text, (done["upto"] + 1).cast("int"), F.length(text)))
    return F.aggregate(by_start, start, add, rest)


def listed(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def span_digests(found: DataFrame) -> DataFrame:
    """Counts and a digest of the rule spans, and all spans as text."""
    rules = F.filter("spans", lambda s: s["by_rule"])

    def count(kind: str) -> Column:
        return F.size(F.filter(rules, lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{k}") for k in KINDS]
    digest = F.sha2(listed(rules), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, listed(F.col("spans")).alias("spans"))
