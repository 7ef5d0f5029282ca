"""Token counts by heap-and-linked-list byte-pair merging.

A text becomes a linked list of symbols. Every adjacent pair whose concatenation is
in the vocabulary waits in a heap under its rank; the lowest rank is popped (leftmost
on ties) and merged until the heap is empty. The count is the number of initial
symbols minus the number of merges. No identifiers are produced. A character outside
the vocabulary counts once for each of its UTF-8 bytes, as byte fallback spells it.

Defined cases: null text counts as empty and has 0 tokens; repeated rows are counted
each; columns other than the id and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from farelens.llm.common import BoundedCache, pieces_of

BLANK = "▁"


def merged_length(symbols: list[str], ranks: dict[str, float]) -> tuple[int, list[str]]:
    """Symbols minus merges, and the symbols left."""
    size = len(symbols)
    heap = []
    for i in range(size - 1):
        rank = ranks.get(symbols[i] + symbols[i + 1])
        if rank is not None:
            heap.append((rank, i, symbols[i] + symbols[i + 1]))
    if not heap:
        return size, symbols
    heapify(heap)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    text: list[str | None] = list(symbols)
    merges = 0
    while heap:
        _, i, whole = heappop(heap)
        left = text[i]
        if left is None:
            continue
        j = after[i]
        if j >= size or len(left) + len(text[j]) != len(whole) or left + text[j] != whole:
            continue
        merges += 1
        text[i], text[j] = whole, None
        k = after[i] = after[j]
        if k < size:
            before[k] = i
            pair = whole + text[k]
            rank = ranks.get(pair)
            if rank is not None:
                heappush(heap, (rank, i, pair))
        h = before[i]
        if h >= 0:
            pair = text[h] + whole
            rank = ranks.get(pair)
            if rank is not None:
                heappush(heap, (rank, h, pair))
    return size - merges, [s for s in text if s is not None]


class PieceCounter:
    """Counts tokens of whole texts under a piece vocabulary with byte fallback.

    The text is cut before every run of blanks. That changes nothing where no piece
    holds a blank after another character, which is checked when the vocabulary is
    read; otherwise the whole text is one chunk.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        self.ranks = {model.id_to_piece(i): -model.get_score(i) for i in ids if i not in special}
        self.cuts = all(BLANK not in piece.lstrip(BLANK) for piece in self.ranks)
        self.inside = {piece[i:i + 2] for piece in self.ranks for i in range(len(piece) - 1)}
        self.words = BoundedCache(lambda word: self.chunk(BLANK + word), limit=400_000)
        self.parts = BoundedCache(self.part, limit=600_000)

    def part(self, text: str) -> int:
        count, symbols = merged_length(list(text), self.ranks)
        return count + sum(
            len(s.encode()) - 1 for s in symbols if len(s) == 1 and s not in self.ranks)

    def chunk(self, text: str) -> int:
        """Cut between characters that are neighbours in no piece: no merge joins them."""
        inside, start, total = self.inside, 0, 0
        for i in range(1, len(text)):
            if text[i - 1:i + 1] not in inside:
                total += self.parts[text[start:i]]
                start = i
        return total + self.parts[text[start:]]

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.cuts:
            return self.chunk(BLANK + text.replace(" ", BLANK))
        if BLANK in text:
            text = text.replace(BLANK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return sum(self.chunk(part) for part in blank_runs(BLANK + text.replace(" ", BLANK)))
        return sum(map(self.words.__getitem__, text.split(" ")))


def blank_runs(text: str) -> Iterator[str]:
    """Parts that begin with a run of blanks and hold none after it."""
    start = 0
    for i in range(1, len(text)):
        if text[i] == BLANK and text[i - 1] != BLANK:
            yield text[start:i]
            start = i
    yield text[start:]


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(docs: DataFrame, model: str, limit: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counter(model)
        for batch in pieces_of(batches):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            tokens = [pieces.count(text) for text in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([len(text.encode()) for text in texts], pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
