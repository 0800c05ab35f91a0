"""BPE encoding and decoding through a trie of words.

A text is cut into words; distinct words go into a trie, and a depth-first walk hands on, from each
prefix to the next longer one, the last token of the prefix's encoding. That token decides the rest:
an encoding is the one chain of tokens in which all neighbours stay apart when they are encoded
together, so the last token of a longer prefix is the one suffix that stays apart from the last token
of what precedes it. A prefix that many words share is encoded once.

Spark deals out the documents; each task keeps a trie of bounded size of its own, so nothing is
shuffled and a lost task starts again with an empty trie.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from gridcensus.llm.common import KEPT, pieces

#: Words and trie nodes that a task keeps before it starts afresh.
MAX_WORDS = 200_000
MAX_NODES = 500_000
MAX_PAIRS = 500_000
STEP_BYTES = 1 << 20

END = "</w>"
#: Texts of these characters alone are cut by a plain pattern; all others by the library's own rules.
_OTHER = re.compile("[^\t\n\r -~À-ÿ]")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t\n\ra-z0-9ß-öø-ÿ]+")


def byte_letters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the rest from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(256 + hidden.index(b)) if b in set(hidden) else chr(b) for b in range(256)]


class _Node:
    __slots__ = ("back", "children", "token")

    def __init__(self, token: int, back: int) -> None:
        self.token, self.back = token, back
        self.children: dict[str, _Node] | None = None


def _suffixes(names: dict[str, int]) -> dict[str, int]:
    """The id of each name; -1 for a string that only ends one. Shorter strings of a found one are found."""
    found = {name[i:]: -1 for name in names for i in range(len(name))}
    return found | names


class WordTrie:
    """Encodes words given in byte letters, sharing the work on common prefixes."""

    def __init__(self, vocab: dict[str, int], merges: list) -> None:
        self.vocab = vocab
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.names = {i: t for t, i in vocab.items()}
        self.inner = _suffixes({t: i for t, i in vocab.items() if not t.endswith(END)})
        self.final = _suffixes({t.removesuffix(END): i for t, i in vocab.items() if t.endswith(END)})
        self.apart: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        self.root, self.nodes = _Node(-1, 0), 1
        if len(self.apart) > MAX_PAIRS:
            self.apart.clear()

    def _merged(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            rank, i = min((self.ranks.get(p, 1 << 30), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if rank == 1 << 30:
                break
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def _symbols(self, token: int) -> list[str]:
        name = self.names[token]
        letters = list(name.removesuffix(END))
        if name.endswith(END):
            letters[-1] += END
        return letters

    def stays_apart(self, a: int, b: int) -> bool:
        """Whether token b follows token a (or the word's start, -1) where both are encoded together."""
        known = self.apart.get((a, b))
        if known is None:
            if a < 0:
                known = self._merged(self._symbols(b)) == [self.names[b]]
            else:
                together = self._merged(self._symbols(a) + self._symbols(b))
                known = together == [self.names[a], self.names[b]]
            self.apart[a, b] = known
        return known

    def _step(self, path: list[_Node], word: str, n: int, names: dict[str, int]) -> _Node:
        """The state after the first n letters, from the states of shorter prefixes."""
        known = self.apart
        for start in range(n - 1, -1, -1):
            token = names.get(word[start:n])
            if token is None:
                break
            if token >= 0:
                before = path[start].token
                apart = known.get((before, token))
                if apart or (apart is None and self.stays_apart(before, token)):
                    return _Node(token, n - start)
        raise ValueError("the vocabulary does not cover every byte")

    def encode_all(self, words: list[str]) -> dict[str, list[int]]:
        """Encodings of words; the sorted order is the depth-first order of the trie."""
        found: dict[str, list[int]] = {}
        path, at, inner, final = [self.root], "", self.inner, self.final
        for word in sorted(words):
            n = len(word)
            keep, most = 0, min(len(at), n - 1)
            while keep < most and at[keep] == word[keep]:
                keep += 1
            del path[keep + 1 :]
            for depth in range(keep, n - 1):
                node = path[depth]
                if node.children is None:
                    node.children = {}
                child = node.children.get(word[depth])
                if child is None:
                    child = node.children[word[depth]] = self._step(path, word, depth + 1, inner)
                    self.nodes += 1
                path.append(child)
            at = word[:-1]
            node, depth, ids = self._step(path, word, n, final), n, []
            while depth:
                ids.append(node.token)
                depth -= node.back
                node = path[depth]
            found[word] = ids[::-1]
        return found


class TrieTokenizer:
    """Ids and decoded text of whole texts, by the rules of one tokenizer file."""

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        rules = json.loads(definition)
        if rules["model"]["end_of_word_suffix"] != END or rules["decoder"] is not None:
            raise ValueError("a BPE file with word ends and without a decoder is needed")
        library = Tokenizer.from_str(definition)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.added = {t["content"]: t["id"] for t in rules["added_tokens"]}
        self.splitter = re.compile("(" + "|".join(re.escape(t) for t in self.added) + ")") if self.added else None
        self.trie = WordTrie(rules["model"]["vocab"], rules["model"]["merges"])
        self.letters = byte_letters()
        self.bytes_of: dict[str, bytes] = {}
        self.text_of: dict[str, str] = {}
        self.clear()

    def clear(self) -> None:
        self.bytes_of.clear()
        self.text_of.clear()
        self.trie.clear()
        for content, i in self.added.items():
            self.bytes_of["\x00" + content], self.text_of["\x00" + content] = i.to_bytes(4, "little"), content

    def _words(self, text: str) -> list[str]:
        if _OTHER.search(text) is None:
            return _PIECE.findall(text.lower())
        normal = self.normalizer.normalize_str(text)
        return ["\x01" + piece for piece, _ in self.pre_tokenizer.pre_tokenize_str(normal)]

    def words(self, text: str) -> list[str]:
        """Keys of a text's words: plain, with \\x01 if already in byte letters, with \\x00 if an added token."""
        if self.splitter is None or "<|" not in text:
            return self._words(text)
        found: list[str] = []
        for part in self.splitter.split(text):
            found += ["\x00" + part] if part in self.added else self._words(part)
        return found

    def encode_decode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text, of each text."""
        if len(self.bytes_of) > MAX_WORDS or self.trie.nodes > MAX_NODES:
            self.clear()
        per_text = [self.words(t) for t in texts]
        new = set().union(*per_text).difference(self.bytes_of)
        spelled = {
            w: w[1:] if w[0] == "\x01" else w if w.isascii() else "".join(self.letters[b] for b in w.encode()) for w in new
        }
        ids = self.trie.encode_all(list(set(spelled.values())))
        names = self.trie.names
        for w, letters in spelled.items():
            self.bytes_of[w] = b"".join(i.to_bytes(4, "little") for i in ids[letters])
            self.text_of[w] = " ".join(names[i] for i in ids[letters])
        as_bytes, as_text = self.bytes_of.__getitem__, self.text_of.__getitem__
        return [(b"".join(map(as_bytes, ws)), " ".join(map(as_text, ws))) for ws in per_text]


_kept: dict[str, TrieTokenizer] = {}
KEPT.append(_kept)


def tokenizer_of(definition: str) -> TrieTokenizer:
    """One tokenizer per worker and definition; its trie is of bounded size."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _kept:
        _kept.clear()
        _kept[key] = TrieTokenizer(definition)
    return _kept[key]


def prefix_bpe(
    docs: DataFrame,
    tokenizer_path: str,
    outputs: Callable[[bytes, str], dict],
    schema: str,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode and decode the whole text of every row; a null text counts as empty.

    ``outputs`` makes the columns of ``schema`` (besides the id, which comes first) from the ids in
    bytes and the decoded text. The tokenizer file is read by the driver and broadcast; it does not
    grow with the data. Empty texts have no ids; repeated rows give repeated results; other columns
    are ignored. A step of a task holds a megabyte of text, or one document.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(definition.value)
        for batch in batches:
            for part in pieces(batch, STEP_BYTES):
                made = [outputs(*x) for x in tokenizer.encode_decode([t or "" for t in part["text"].to_pylist()])]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *[pa.array([m[k] for m in made]) for k in made[0]]], ["doc_id", *made[0]]
                )

    rows = docs.selectExpr(f"`{doc_id}` as doc_id", f"cast(`{text}` as string) as text")
    return rows.mapInArrow(run, f"doc_id {kind}, {schema}")


def digests(ids: bytes, decoded: str) -> dict:
    return {
        "n_tokens": len(ids) // 4,
        "ids_sha256": hashlib.sha256(ids).hexdigest(),
        "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest(),
    }


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"
