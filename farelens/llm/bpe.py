"""Byte-pair encoding and decoding with a segment tree over adjacent pair ranks.

Leaf i of the tree holds the rank of the pair that starts at symbol i, together with
i, so that the root is the leftmost lowest-rank merge. A merge changes three leaves;
each change climbs to the root in logarithmic time. Encoding ends when the root holds
no mergeable pair. Decoding looks up the bytes of every id and joins them.

Texts are first cut at special strings and then by the vocabulary's split pattern,
as the public tokenizer file says; no merge crosses a cut.

Defined cases: null text counts as empty and has no ids; repeated rows are encoded
each; columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from farelens.llm.common import BoundedCache, pieces_of

# Fixed value: how byte-level vocabularies split a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabulary files: printable
    Latin-1 characters for themselves, the rest in order from code point 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(printable))
    return [chr(b) if b in printable else chr(256 + i) for b, i in sorted(
        [(b, 0) for b in printable] + [(b, i) for i, b in enumerate(others)])]


def merge_all(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The ids left when no adjacent pair can merge. ``pairs``: (left, right) -> (rank, id).

    ``tree[n:]`` are the leaves, one for each pair; ``tree[1]`` is the root, the least of
    rank * size + place.
    """
    size = len(symbols)
    n = size - 1
    if n < 1:
        return symbols
    get, none = pairs.get, 1 << 62
    tree = [none] * (2 * n)
    left, leaf = symbols[0], n
    for right in symbols[1:]:
        pair = get((left, right))
        if pair is not None:
            tree[leaf] = pair[0] * size + leaf - n
        left = right
        leaf += 1
    for node in range(n - 1, 0, -1):
        one, two = tree[2 * node], tree[2 * node + 1]
        tree[node] = one if one < two else two
    if tree[1] == none:
        return symbols
    after, before = list(range(1, size + 1)), list(range(-1, n))
    symbols = list(symbols)
    while (root := tree[1]) != none:
        i = root % size
        j = after[i]
        whole = symbols[i] = get((symbols[i], symbols[j]))[1]
        symbols[j] = -1
        k = after[i] = after[j]
        changed = [n + i]
        if j < n:
            tree[n + j] = none
            changed.append(n + j)
        pair = None
        if k < size:
            before[k] = i
            pair = get((whole, symbols[k]))
        tree[n + i] = none if pair is None else pair[0] * size + i
        h = before[i]
        if h >= 0:
            pair = get((symbols[h], whole))
            tree[n + h] = none if pair is None else pair[0] * size + h
            changed.append(n + h)
        for node in changed:
            while node > 1:
                node >>= 1
                one, two = tree[2 * node], tree[2 * node + 1]
                if two < one:
                    one = two
                if tree[node] == one:
                    break
                tree[node] = one
    return [s for s in symbols if s >= 0]


class ByteVocabulary:
    """Bytes, pair ranks and special strings of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids = content["model"]["vocab"]
        letters = byte_letters()
        value = {letter: byte for byte, letter in enumerate(letters)}
        self.first = [ids[letter] for letter in letters]
        self.pairs = {}
        for rank, pair in enumerate(content["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs[ids[left], ids[right]] = rank, ids[left + right]
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.bytes_of = {i: bytes(value[c] for c in token) for token, i in ids.items()
                         if all(c in value for c in token)}
        self.bytes_of |= {i: token.encode() for token, i in special.items()}
        self.special = special
        self.at_special = re.compile(
            "(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")"
        ) if special else None
        self.split = regex.compile(SPLIT)

    def encode_part(self, part: str) -> list[int]:
        first = self.first
        return merge_all([first[b] for b in part.encode()], self.pairs)


#: White space but the blank.
OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]


def uneven(text: str) -> bool:
    """Whether a blank stands next to white space, or at the end: cuts at blanks would then
    differ from the pattern's. Searches for what the text does not have cost next to nothing."""
    return text.endswith(" ") or "  " in text or any(
        c in text and (" " + c in text or c + " " in text) for c in OTHER_SPACE)


class Encoder:
    """Whole texts in terms of cached parts; ``form`` says what is kept of a part's ids."""

    def __init__(self, vocabulary: ByteVocabulary, form, encode_part=None,
                 limits: tuple[int, int, int] = (500_000, 200_000, 50_000)):
        self.vocabulary = vocabulary
        encode = encode_part or vocabulary.encode_part
        self.parts = BoundedCache(lambda part: form(encode(part)), limit=limits[0])
        self.form = form
        self.joined = BoundedCache(self.word, limit=limits[1])
        self.first = BoundedCache(self.split_join, limit=limits[2])

    def word(self, word: str):
        """A word after a blank; letters alone are one part."""
        return self.parts[" " + word] if word.isalpha() else self.split_join(" " + word)

    def split_join(self, text: str):
        return self.join([self.parts[part] for part in self.vocabulary.split.findall(text)])

    def join(self, forms: list):
        raise NotImplementedError

    def plain(self, text: str) -> list:
        """Forms of a text without special strings. Where every blank stands between
        other characters, a part begins at every blank, so blank-separated words can
        be looked up whole; the pattern decides inside them."""
        if uneven(text):
            return [self.parts[part] for part in self.vocabulary.split.findall(text)]
        words = text.split(" ")
        forms = [self.first[words[0]]] if words[0] else []
        forms.extend(map(self.joined.__getitem__, words[1:]))
        return forms

    def forms(self, text: str) -> list:
        if self.vocabulary.at_special is None:
            return self.plain(text)
        out: list = []
        for part in self.vocabulary.at_special.split(text):
            if part in self.vocabulary.special:
                out.append(self.form([self.vocabulary.special[part]]))
            elif part:
                out.extend(self.plain(part))
        return out


class RoundTrip(Encoder):
    """Ids of parts as packed numbers, and both ways of spelling an id."""

    def __init__(self, vocabulary: ByteVocabulary):
        last = max(vocabulary.bytes_of)
        self.kind = "H" if last < 1 << 16 else "I"
        self.digits = [str(i) for i in range(last + 1)]
        self.text = [vocabulary.bytes_of.get(i) for i in range(last + 1)]
        super().__init__(vocabulary, lambda ids: array(self.kind, ids).tobytes())

    def join(self, forms):
        return forms[0] if len(forms) == 1 else b"".join(forms)

    def both_ways(self, text: str) -> tuple[str, int, bytes]:
        """Decimal ids joined by commas, their number, the decoded text in UTF-8."""
        ids = array(self.kind)
        ids.frombytes(b"".join(self.forms(text)))
        decoded = b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace").encode()
        return ",".join(map(self.digits.__getitem__, ids)), len(ids), decoded


@lru_cache(maxsize=2)
def round_trip(path: str) -> RoundTrip:
    return RoundTrip(ByteVocabulary(path))


def encode(text: str | None, vocabulary: ByteVocabulary) -> list[int]:
    """Ids of one text."""
    out: list[int] = []
    for part in vocabulary.at_special.split(text or "") if vocabulary.at_special else [text or ""]:
        if part in vocabulary.special:
            out.append(vocabulary.special[part])
        else:
            for piece in vocabulary.split.findall(part):
                out.extend(vocabulary.encode_part(piece))
    return out


def decode(ids: list[int], vocabulary: ByteVocabulary) -> str:
    """The text of ids; bytes that form no character become U+FFFD."""
    return b"".join(vocabulary.bytes_of[i] for i in ids).decode("utf-8", "replace")


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) and the decoded text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = round_trip(path)
        for batch in pieces_of(batches):
            rows = [coder.both_ways(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([[int(i) for i in ids.split(",")] if ids else [] for ids, _, _ in rows],
                         pa.list_(pa.int32())),
                pa.array([text.decode() for _, _, text in rows], pa.string())],
                ["doc_id", "ids", "decoded"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>, decoded string")


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the decimal ids and of the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = round_trip(path)
        for batch in pieces_of(batches):
            rows = [coder.both_ways(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([n for _, n, _ in rows], pa.int64()),
                pa.array([hashlib.sha256(ids.encode()).hexdigest() for ids, _, _ in rows]),
                pa.array([hashlib.sha256(text).hexdigest() for _, _, text in rows])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
