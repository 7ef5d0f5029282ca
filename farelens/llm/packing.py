"""Sum-of-squares packing of token sequences.

A sequence holds ``capacity`` tokens. Each document goes where, over all gaps, the
sum of the squared counts of open sequences with that residual gap becomes smallest
(ties to the smallest gap left). Documents above the capacity are cut into full
pieces after a shorter first one; full pieces need no company.

The work is split in groups of documents by a hash of their id, each packed in one
task, longest first, with one counter per gap. Sequences stay as they are but for a
group's emptiest twentieth: that is unpacked, counted over all groups, dealt anew to as
many groups as that count needs, and packed again. It ends with one group, or as soon
as a level passes on more than half of what it got (groups of few sequences): then
every group of the next level closes its own. Closing refills the emptiest twentieth by
best fit, where that needs fewer sequences. So a group is of ``docs_per_group`` documents
at every level, as evenly as a hash deals them, and all levels together see each
document about three times at most.

Defined cases: null text counts as empty and still takes its end token; repeated
rows, also of one doc_id, are packed each; columns other than the id and the text
are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.bpe import ByteVocabulary, Encoder, byte_letters
from farelens.llm.common import pieces_of, stored

DOCS_PER_GROUP = 60_000
#: What part of a group's sequences is unpacked, the emptiest first, and how many at least.
LOOSE_SHARE, LOOSE_LEAST = 0.05, 100
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, copy long"
PLACED = f"{PIECES}, level int, grp long, bin long, offset long, done boolean"


class LibraryIds(Encoder):
    """Ids as the public tokenizer library gives them, as little-endian unsigned 32-bit."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenize = Tokenizer.from_file(path).model.tokenize
        letters = dict(enumerate(byte_letters()))
        blank = letters[ord(" ")]

        def ids(spelled: str) -> bytes:
            return array("I", [t.id for t in tokenize(spelled)]).tobytes()

        def spelled(part: str) -> str:
            return part.encode().decode("latin-1").translate(letters)

        self.letters_alone = lambda word: ids(blank + word if word.isascii() else spelled(" " + word))
        # a worker that waits for its next task holds these: words of letters are kept once,
        # under the word without its blank, parts are the rest
        super().__init__(ByteVocabulary(path), lambda known: array("I", known).tobytes(),
                         limits=(50_000, 400_000, 10_000))
        self.parts.compute = lambda part: ids(spelled(part))

    def word(self, word: str) -> bytes:
        return self.letters_alone(word) if word.isalpha() else self.split_join(" " + word)

    def split_join(self, text: str) -> bytes:
        return b"".join([
            self.joined[part[1:]] if part[0] == " " and part[1:].isalpha() else self.parts[part]
            for part in self.vocabulary.split.findall(text)])

    def join(self, forms):
        return b"".join(forms)

    def ids(self, text: str) -> bytes:
        return b"".join(self.forms(text))


@lru_cache(maxsize=2)
def library_ids(path: str) -> LibraryIds:
    return LibraryIds(path)


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32 and copy, a number
    that tells repeated rows of one doc_id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, last = library_ids(path), array("I", [end_id]).tobytes()
        for batch in pieces_of(batches):
            rows: list[tuple] = []
            for doc_id, text, copy in zip(*(c.to_pylist() for c in batch.columns)):
                ids = coder.ids(text or "") + last
                size = len(ids) // 4
                start, end, piece = 0, size % capacity or capacity, 0
                while start < size:
                    rows.append((doc_id, piece, start, end - start,
                                 zlib.crc32(ids[4 * start:4 * end]), copy))
                    start, end, piece = end, end + capacity, piece + 1
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "copy"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"),
                       F.monotonically_increasing_id().alias("copy"))
    return rows.mapInArrow(run, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each item, in the given order, and the fill of each bin.

    Moving an open bin from gap g to g - s changes the sum of squares by
    2 (N[g - s] - N[g]) + 2; a new bin adds 2 N[capacity - s] + 1. A bin that
    becomes full leaves the sum.
    """
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    bins = np.empty(len(lengths), np.int64)
    fills: list[int] = []
    never = np.int64(1) << 60
    for item, size in enumerate(lengths.tolist()):
        change = 2 * (count[:capacity + 1 - size] - count[size:]) + 2
        change[0] -= 2 * count[0] + 1
        change[count[size:] == 0] = never
        best = int(change.argmin())
        if change[best] > 2 * count[capacity - size] + 1:
            target, gap = len(fills), capacity
            fills.append(0)
        else:
            gap = best + size
            target = open_bins[gap].pop()
            count[gap] -= 1
        bins[item] = target
        fills[target] += size
        if gap > size:
            open_bins[gap - size].append(target)
            count[gap - size] += 1
    return bins, np.array(fills, np.int64)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: largest first, each into the smallest gap that takes it."""
    bins = np.empty(len(lengths), np.int64)
    gaps: list[tuple[int, int]] = []
    used = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        at = bisect_left(gaps, (size, -1))
        if at < len(gaps):
            gap, target = gaps.pop(at)
        else:
            gap, target, used = capacity, used, used + 1
        bins[item] = target
        if gap > size:
            insort(gaps, (gap - size, target))
    return bins


def pack_items(lengths: np.ndarray, capacity: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each item, and which items stay in it.

    Sum-of-squares takes the items longest first. Those of the emptiest bins go on to the
    next level; a group of the last level refills these bins with best fit.
    """
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    bins[order], fills = sum_of_squares(lengths[order], capacity)
    emptiest = np.argsort(fills, kind="stable")[:max(LOOSE_LEAST, math.ceil(len(fills) * LOOSE_SHARE))]
    loose = np.zeros(len(fills), bool)
    loose[emptiest] = fills[emptiest] < capacity
    done = ~loose[bins]
    if last:
        rest = np.flatnonzero(~done)
        again = best_fit(lengths[rest], capacity)
        if len(rest) and again.max() + 1 < np.count_nonzero(loose):
            bins[rest] = len(fills) + again
        done[:] = True
    return bins, done


def pack_group(capacity: int, level: int, last: bool):
    """Packs one group's items in one order, whatever order they arrive in."""

    def run(key, group):
        group = group.select(["doc_id", "piece", "start", "length", "ids_crc32", "copy"])
        group = group.take(pa.array(np.lexsort((
            group["copy"].to_numpy(), group["piece"].to_numpy(),
            group["doc_id"].fill_null(-1).to_numpy()))))
        lengths = group["length"].to_numpy()
        bins, done = pack_items(lengths, capacity, last)
        by_bin = np.argsort(bins, kind="stable")
        before = np.cumsum(lengths[by_bin]) - lengths[by_bin]
        first = np.searchsorted(bins[by_bin], bins[by_bin])
        offsets = np.empty(len(lengths), np.int64)
        offsets[by_bin] = before - before[first]
        columns = {
            "level": pa.array(np.full(len(lengths), level, np.int32)),
            "grp": pa.array(np.full(len(lengths), key[0].as_py(), np.int64)),
            "bin": pa.array(bins), "offset": pa.array(offsets), "done": pa.array(done)}
        for name, column in columns.items():
            group = group.append_column(name, column)
        return group

    return run


def pack(pieces: DataFrame, capacity: int = 2048,
         docs_per_group: int = DOCS_PER_GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    pieces = stored(pieces, "pieces")
    short = pieces.filter(F.col("length") < capacity)
    full = pieces.filter(F.col("length") >= capacity).select(
        "*", F.lit(-1).alias("level"), F.xxhash64("doc_id", "copy", "piece").alias("grp"),
        F.monotonically_increasing_id().alias("bin"), F.lit(0).cast("long").alias("offset"),
        F.lit(True).alias("done"))
    finished, level, count, rest, closing = [full], 0, short.count(), short, False
    while True:
        groups = max(1, math.ceil(count / docs_per_group))
        last = closing or groups == 1
        dealt = rest.withColumn("grp", F.pmod(
            F.xxhash64("doc_id", "copy", F.lit(level)), F.lit(groups)))
        placed = dealt.groupBy("grp").applyInArrow(pack_group(capacity, level, last), PLACED)
        placed = placed if last else stored(placed, "packed")
        finished.append(placed.filter("done"))
        if last:
            break
        rest = placed.filter("NOT done").select(*[c.split(" ")[0] for c in PIECES.split(", ")])
        left = rest.count()
        closing, count, level = 2 * left > count, left, level + 1
    out = finished[0]
    for part in finished[1:]:
        out = out.unionByName(part)
    number = (F.when(F.col("level") < 0, -1 - F.col("bin"))
              .otherwise(F.shiftleft(F.col("level").cast("long"), 58)
                         + F.shiftleft(F.col("grp"), 26) + F.col("bin")))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32",
                      number.alias("sequence_id"), "offset")


def packed_documents(docs: DataFrame, path: str, capacity: int = 2048, **columns) -> DataFrame:
    """Tokenise, cut and pack whole documents."""
    return pack(token_pieces(docs, path, capacity, **columns), capacity)
