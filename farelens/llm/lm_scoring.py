"""Language-model scoring by cross-entropy difference.

A target model and a background model of the same form, word pairs interpolated with
single words, share one vocabulary. A document's score is its loss per token under
the target model minus that under the background model: the lower, the more it reads
like the target.

Every word and every pair that occurs twice or more, at any corpus size, has its
counts summed over all documents; a target document's words and pairs always do, as they
are counted for both models. Words that occur once share one entry. Pairs that occur once
are left out before a left word's total and kinds are taken, so each model sums to
one; they fall back to single words with the mass that Witten and Bell give them.

No model is held whole anywhere. Documents are dealt to chunks of some million words, where
they lie. A chunk's texts are cut into words once and stored as its list of words and the
places in that list, compressed. A chunk sends each of its words and pairs once, with its own
counts, so a word or pair is sent at most once by each chunk, however common it is. Words
and pairs are dealt by hash to shares of some million, a chunk's of a share as one block.
A share's blocks meet in one place, get the sums over them there, and each chunk gets the
sums back in the order in which it sent the block, so that neither words nor pairs return.

A left word's pairs lie in one share, which knows the word's own sums then. Only frequent
words, at most ``FREQUENT`` of them, have their pairs in all shares; their sums and those
of BEGIN and OTHER are gathered and sent to all tasks.

Defined cases: a null or wordless text has no tokens and null losses and score; a
document whose label is missing or not the target's is background only; the
background is all documents; repeated rows count and are scored each; an empty table
gives no rows; without target documents the target model is uniform over the
vocabulary.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import pieces_of, stored

#: A word or pair that occurs less often over background and target is not stored.
LEAST = 2
#: Words in a chunk, one more for each document; only its last document goes beyond.
CHUNK_WORDS = 3_000_000
#: Words and pairs of all chunks in a share, about.
SHARE_WORDS, SHARE_PAIRS = 1_000_000, 2_000_000
#: Words are in order of 2**16 cells of their hash; a share is a range of cells.
CELLS = 1 << 16
#: A word that is at least one in so many of all is frequent.
FREQUENT = 4096
#: Numbers of what begins a text and of all words that are not stored.
BEGIN, OTHER = 0, 1


def tokens(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers in a compressed block. Bytes of one weight lie together,
    since most high ones are zero."""
    planes = [np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8).T) for c in columns]
    return len(columns[0]).to_bytes(8, "little") + pa.compress(
        b"".join(p.tobytes() for p in planes), codec="zstd", asbytes=True)


def unpacked(data: bytes, width: int) -> np.ndarray:
    """The columns of a block, one in each row of the array."""
    size = int.from_bytes(data[:8], "little")
    if not size:
        return np.zeros((width, 0), np.int64)
    planes = np.frombuffer(pa.decompress(
        data[8:], decompressed_size=8 * size * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, 8, size).transpose(0, 2, 1)).view("<i8")[:, :, 0].copy()


def block(*columns: np.ndarray) -> bytes:
    """``packed``, for a first column that does not fall: its steps are kept."""
    return packed(np.diff(columns[0], prepend=0), *columns[1:])


def unblock(data: bytes, width: int) -> np.ndarray:
    columns = unpacked(data, width)
    columns[0] = np.cumsum(columns[0])
    return columns


def joined(blocks: list[np.ndarray], width: int) -> np.ndarray:
    return np.concatenate([np.zeros((width, 0), np.int64), *blocks], axis=1)


def packed_words(words: list[str]) -> bytes:
    """Words hold no white space, so a line each."""
    data = "\n".join(words).encode()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpacked_words(data: bytes) -> list[str]:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True).decode().split(
        "\n") if size else []


CHUNK = ("chunk long, n_words long, n_kinds long, doc_ids array<bigint>, sizes array<int>, "
         "codes binary, cells binary, words binary")


def coded(rows: DataFrame, chunk_words: int) -> DataFrame:
    """A row for each chunk: its documents' ids and numbers of words, the places of all their
    words in its list of words, that list in order of cell, and how many are in each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("chunk", pa.int64()), ("n_words", pa.int64()), ("n_kinds", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
            ("codes", pa.binary()), ("cells", pa.binary()), ("words", pa.binary())])
        chunk = TaskContext.get().partitionId() << 32
        ids, sizes, codes, places = [], [], array("I"), defaultdict()

        def flushed() -> pa.RecordBatch:
            words = list(places)
            cells = np.fromiter((zlib.crc32(word.encode()) for word in words), np.int64, len(words)) >> 16
            order = np.argsort(cells, kind="stable")
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            return pa.RecordBatch.from_pylist([{
                "chunk": chunk, "n_words": len(codes), "n_kinds": len(words), "doc_ids": ids, "sizes": sizes,
                "codes": packed(place[np.frombuffer(codes, np.uint32)] if words else np.zeros(0, np.int64)),
                "cells": packed(np.bincount(cells, minlength=CELLS)),
                "words": packed_words([words[i] for i in order])}], schema)

        for batch in pieces_of(batches):
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if len(codes) + len(ids) >= chunk_words:
                    yield flushed()
                    chunk += 1
                    ids, sizes, codes, places = [], [], array("I"), defaultdict()
                if not ids:
                    places.default_factory = places.__len__
                words = tokens(text)
                ids.append(doc_id)
                sizes.append(len(words))
                codes.extend(map(places.__getitem__, words))
        if ids:
            yield flushed()

    return rows.mapInArrow(run, CHUNK)


def marked(chunks: DataFrame, target_ids: DataFrame) -> DataFrame:
    """chunk and the places of its target documents."""
    # the ids grow with the corpus, so they are joined alike at every size
    return chunks.select("chunk", F.posexplode("doc_ids").alias("place", "doc_id")).join(
        target_ids.distinct().hint("merge"), "doc_id", "left_semi").groupBy("chunk").agg(
        F.collect_list("place").alias("marks"))


def in_target(sizes: np.ndarray, marks: pa.ChunkedArray) -> np.ndarray:
    """Of every word of a chunk, whether its document is of the target."""
    chosen = np.zeros(len(sizes), bool)
    for places in marks.drop_null().to_pylist():
        chosen[places] = True
    return np.repeat(chosen, sizes)


def word_counts(chunks: DataFrame, marks: DataFrame, shares: int) -> DataFrame:
    """share, chunk, the chunk's words of that share, and a block of b and t: how often each
    occurs in all its documents and in those of the target."""

    def run(key, texts: pa.Table, told: pa.Table) -> pa.Table:
        words = unpacked_words(texts["words"][0].as_py())
        codes, = unpacked(texts["codes"][0].as_py(), 1)
        cells, = unpacked(texts["cells"][0].as_py(), 1)
        chosen = in_target(texts["sizes"][0].values.to_numpy(), told["marks"])
        b, t = (np.bincount(c, minlength=len(words)) for c in (codes, codes[chosen]))
        # where a share's cells end, and so its words
        ends = np.r_[0, np.cumsum(cells)][(np.arange(shares + 1) * CELLS + shares - 1) // shares]
        parts = [(i, slice(ends[i], ends[i + 1])) for i in range(shares) if ends[i] < ends[i + 1]]
        return pa.table({
            "share": pa.array([i for i, _ in parts], pa.int64()),
            "chunk": pa.array([key[0].as_py()] * len(parts), pa.int64()),
            "words": pa.array([packed_words(words[at]) for _, at in parts], pa.binary()),
            "counts": pa.array([packed(b[at], t[at]) for _, at in parts], pa.binary())})

    return chunks.select("chunk", "sizes", "codes", "cells", "words").groupBy("chunk").cogroup(
        marks.groupBy("chunk")).applyInArrow(run, "share long, chunk long, words binary, counts binary")


WORD_SUMS = "share long, chunk long, sums binary, number long, n long, b long, t long, whole_t long"


def word_sums(own: DataFrame, total: int) -> DataFrame:
    """Three kinds of rows, the other's columns null: share, chunk and a block of number, b and
    t of its words in the order sent, with the counts over all chunks, OTHER and zeros where not
    stored; the numbers of frequent words; and for every share the number n of stored words,
    their sums b and t, and the sum of t with the others."""

    def run(blocks: pa.Table) -> pa.Table:
        share, chunks = blocks["share"][0].as_py(), blocks["chunk"].to_pylist()
        lists = [unpacked_words(data) for data in blocks["words"].to_pylist()]
        ends = np.cumsum([0] + [len(words) for words in lists])
        alike = pa.array([word for words in lists for word in words], pa.string()).dictionary_encode()
        del lists
        place, kinds = alike.indices.to_numpy(), len(alike.dictionary)
        b, t = (np.bincount(place, c, kinds).astype(np.int64) for c in
                joined([unpacked(data, 2) for data in blocks["counts"].to_pylist()], 2))
        kept = b + t >= LEAST
        whole_t, b, t = int(t.sum()), b * kept, t * kept
        number = np.where(kept, (share << 32) + 1 + np.cumsum(kept), OTHER)
        sums = [packed(number[at], b[at], t[at]) for at in (place[one:two] for one, two in zip(ends, ends[1:]))]
        often = number[kept & (b * FREQUENT >= total)].tolist()
        rest = [None] * len(sums)
        columns = {
            "share": [share] * len(sums) + [None] * (len(often) + 1),
            "chunk": chunks + [None] * (len(often) + 1),
            "number": rest + often + [None]}
        for name, value in (("n", kept.sum()), ("b", b.sum()), ("t", t.sum()), ("whole_t", whole_t)):
            columns[name] = rest + [None] * len(often) + [int(value)]
        return pa.table({
            **{name: pa.array(values, pa.int64()) for name, values in columns.items()},
            "sums": pa.array(sums + [None] * (len(often) + 1), pa.binary())}).select(
            [c.split(" ")[0] for c in WORD_SUMS.split(", ")])

    return own.groupBy("share").applyInArrow(run, WORD_SUMS)


def shares_of(left: np.ndarray, right: np.ndarray, shares: int) -> np.ndarray:
    """The share of every pair: the same in all chunks."""
    mixed = (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
             ^ right.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((mixed >> np.uint64(32)) % np.uint64(shares)).astype(np.int64)


class Pairs:
    """A chunk's word pairs, each once, in the order in which they are sent and come back: by
    share, then by the numbers of the left and of the right word.

    ``numbers``, ``b`` and ``t`` follow the places of its stored words, behind those of BEGIN and
    OTHER. ``left`` and ``right`` are the places of the pairs, ``of`` the pair of every word, and
    share i has the pairs from ``ends[i]`` up to ``ends[i + 1]``."""

    def __init__(self, texts: pa.Table, told: pa.Table, often: np.ndarray, shares: int):
        self.sizes = texts["sizes"][0].values.to_numpy()
        told = told.filter(told["sums"].is_valid()).sort_by("share")
        number, b, t = joined([unpacked(data, 3) for data in told["sums"].to_pylist()], 3)
        stored_words = np.flatnonzero(number != OTHER)
        stored_words = stored_words[np.argsort(number[stored_words])]
        place = np.full(len(number), OTHER)
        place[stored_words] = np.arange(len(stored_words)) + 2
        self.numbers, self.b, self.t = (
            np.r_[head, c[stored_words]] for head, c in (([BEGIN, OTHER], number), ([0, 0], b), ([0, 0], t)))
        right = place[unpacked(texts["codes"][0].as_py(), 1)[0]]
        left = np.roll(right, 1)
        left[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = BEGIN
        pairs, of = np.unique(left * len(self.numbers) + right, return_inverse=True)
        left, right = pairs // len(self.numbers), pairs % len(self.numbers)
        self.often = np.isin(self.numbers, often)
        share = shares_of(self.numbers[left], np.where(self.often[left], self.numbers[right], 0), shares)
        order = np.argsort(share, kind="stable")
        self.left, self.right = left[order], right[order]
        self.ends = np.searchsorted(share[order], np.arange(shares + 1))
        sent = np.empty(len(order), np.int64)
        sent[order] = np.arange(len(order))
        self.of = sent[of]


def steps_of(*columns: np.ndarray) -> np.ndarray:
    """Where a value of the columns, in order, differs from the one before."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)])


def pair_counts(chunks: DataFrame, told: DataFrame, often: np.ndarray, shares: int) -> DataFrame:
    """share, chunk and a block of l, r (numbers of the left and the right word), b and t of
    the chunk's pairs of that share. ``told`` has the chunk's marks and the sums of its words."""

    def run(key, texts: pa.Table, told: pa.Table) -> pa.Table:
        pairs = Pairs(texts, told, often, shares)
        chosen = in_target(pairs.sizes, told["marks"])
        b, t = (np.bincount(of, minlength=len(pairs.left)) for of in (pairs.of, pairs.of[chosen]))
        left, right = pairs.numbers[pairs.left], pairs.numbers[pairs.right]
        parts = [(i, slice(pairs.ends[i], pairs.ends[i + 1])) for i in range(shares)
                 if pairs.ends[i] < pairs.ends[i + 1]]
        return pa.table({
            "share": pa.array([i for i, _ in parts], pa.int64()),
            "chunk": pa.array([key[0].as_py()] * len(parts), pa.int64()),
            "pairs": pa.array([block(left[at], right[at], b[at], t[at]) for _, at in parts], pa.binary())})

    return chunks.select("chunk", "sizes", "codes").groupBy("chunk").cogroup(
        told.groupBy("chunk")).applyInArrow(run, "share long, chunk long, pairs binary")


PAIR_SUMS = "share long, chunk long, pairs binary, lefts binary, l long, ab long, at long, kb long, kt long"


def pair_sums(own: DataFrame, often: np.ndarray) -> DataFrame:
    """Two kinds of rows, the other's columns null. Share, chunk, a block of b and t of its pairs
    in the order sent, with the counts over all chunks, zeros where not stored, and one of ab, at,
    kb and kt of the left words of these pairs, frequent ones left out: the sums and numbers of
    the stored pairs that a word begins anywhere. And the same for a frequent left word l,
    as far as its pairs are in the share."""

    def run(blocks: pa.Table) -> pa.Table:
        columns = [unblock(data, 4) for data in blocks["pairs"].to_pylist()]
        ends = np.cumsum([0] + [c.shape[1] for c in columns])
        l, r, b, t = joined(columns, 4)
        del columns
        order = np.lexsort((r, l))
        l, r = l[order], r[order]
        starts = steps_of(l, r)
        place = np.empty(len(l), np.int64)
        place[order] = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(l)]))
        l, b, t = l[starts], np.add.reduceat(b[order], starts), np.add.reduceat(t[order], starts)
        kept = b + t >= LEAST
        b, t = b * kept, t * kept
        firsts = steps_of(l)
        whose = np.repeat(np.arange(len(firsts)), np.diff(np.r_[firsts, len(l)]))
        sums = np.array([np.add.reduceat(c.astype(np.int64), firsts) for c in (b, t, b > 0, t > 0)])
        spread = np.isin(l[firsts], often)
        pairs, lefts = [], []
        for one, two in zip(ends, ends[1:]):
            at = place[one:two]
            pairs.append(packed(b[at], t[at]))
            words = whose[at]
            words = words[steps_of(words)]
            lefts.append(packed(*sums[:, words[~spread[words]]]))
        none, rest = [None] * int(spread.sum()), [None] * len(pairs)
        return pa.table({
            "share": pa.array(blocks["share"].to_pylist() + none, pa.int64()),
            "chunk": pa.array(blocks["chunk"].to_pylist() + none, pa.int64()),
            "pairs": pa.array(pairs + none, pa.binary()), "lefts": pa.array(lefts + none, pa.binary()),
            **{name: pa.array(rest + c[spread].tolist(), pa.int64())
               for name, c in zip(("l", "ab", "at", "kb", "kt"), [l[firsts], *sums])}})

    return own.groupBy("share").applyInArrow(run, PAIR_SUMS)


def losses(words: np.ndarray, total: int, size: int, after: np.ndarray, kinds: np.ndarray,
           counts: np.ndarray, pairs: Pairs) -> np.ndarray:
    """Loss of the right word of every pair under one set of counts.

    ``words``, ``after`` and ``kinds`` follow the chunk's places: a word's count, and the
    sum and number of the stored pairs it begins anywhere; ``counts`` follows its pairs.
    ``total`` and ``size`` are those of all words and of the whole vocabulary."""
    single = ((words + 1) / (total + size))[pairs.right]
    kinds, after = kinds[pairs.left], after[pairs.left]
    return -np.log(np.where(after > 0, (counts + kinds * single) / np.maximum(after + kinds, 1), single))


SCORES = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def scorer(total: dict[str, int], others: dict[str, int], size: int, often: np.ndarray,
           often_sums: np.ndarray, shares: int):
    """Scores a chunk's texts. ``others`` has the counts of OTHER, ``often_sums`` ab, at, kb
    and kt of the numbers ``often``, which are in order."""

    def run(key, texts: pa.Table, told: pa.Table) -> pa.Table:
        pairs = Pairs(texts, told, often, shares)
        words = {"b": pairs.b, "t": pairs.t}
        for m in "bt":
            words[m][OTHER] = others[m]
        facts = told.filter(told["pairs"].is_valid()).sort_by("share")
        counts = dict(zip("bt", joined([unpacked(data, 2) for data in facts["pairs"].to_pylist()], 2)))
        # left words in order of share and number, as their sums come
        lefts = pairs.left[~pairs.often[pairs.left]]
        sums = np.zeros((4, len(pairs.numbers)), np.int64)
        sums[:, lefts[steps_of(lefts)]] = joined([unpacked(data, 4) for data in facts["lefts"].to_pylist()], 4)
        sums[:, pairs.often] = often_sums[:, np.searchsorted(often, pairs.numbers[pairs.often])]
        after, kinds = dict(zip("bt", sums[:2])), dict(zip("bt", sums[2:]))
        some = pairs.sizes > 0
        starts = (np.cumsum(pairs.sizes) - pairs.sizes)[some]
        means = {}
        for m in "bt":
            loss = losses(words[m], total[m], size, after[m], kinds[m], counts[m], pairs)[pairs.of]
            means[m] = np.full(len(some), np.nan)
            means[m][some] = np.add.reduceat(loss, starts) / pairs.sizes[some] if len(starts) else []
        return pa.table({
            "doc_id": texts["doc_ids"][0].values, "n_tokens": pa.array(pairs.sizes.astype(np.int64)),
            **{name: pa.array(values, pa.float64(), mask=~some) for name, values in (
                ("target_loss", means["t"]), ("background_loss", means["b"]),
                ("score", means["t"] - means["b"]))}})

    return run


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id",
                             text_col: str = "text",
                             chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss and score of every row.
    ``target_ids`` names the target documents in a column of the same name as ``id_col``."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    chosen = target_ids.select(target_ids[id_col].cast("long").alias("doc_id"))
    chunks = stored(coded(rows, chunk_words), "lm-chunks")
    marks = stored(marked(chunks, chosen), "lm-marks")
    whole = chunks.agg(F.sum("n_words").alias("b"), F.sum("n_kinds").alias("kinds")).first()

    shares = min(CELLS, max(1, math.ceil((whole["kinds"] or 0) / SHARE_WORDS)))
    words = stored(word_sums(word_counts(chunks, marks, shares), whole["b"] or 0), "lm-words")
    kept = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "b", "t", "whole_t")]).first()
    total = {"b": whole["b"] or 0, "t": kept["whole_t"]}
    often = np.array(sorted([BEGIN, OTHER, *(
        row["number"] for row in words.filter("number IS NOT NULL").select("number").collect())]), np.int64)

    told = words.filter("chunk IS NOT NULL").select("share", "chunk", "sums")
    shares = max(1, math.ceil(total["b"] / SHARE_PAIRS))
    pairs = stored(pair_sums(pair_counts(
        chunks, told.unionByName(marks, allowMissingColumns=True), often, shares), often), "lm-pairs")
    often_sums = np.zeros((4, len(often)), np.int64)
    for row in pairs.filter("l IS NOT NULL").groupBy("l").agg(
            *[F.sum(c).alias(c) for c in ("ab", "at", "kb", "kt")]).collect():
        often_sums[:, np.searchsorted(often, row["l"])] = row[1:]

    facts = told.unionByName(
        pairs.filter("chunk IS NOT NULL").select("share", "chunk", "pairs", "lefts"), allowMissingColumns=True)
    others = {m: total[m] - kept[m] for m in "bt"}
    return chunks.select("chunk", "doc_ids", "sizes", "codes").groupBy("chunk").cogroup(
        facts.groupBy("chunk")).applyInArrow(
        scorer(total, others, kept["n"] + 2, often, often_sums, shares), SCORES)
