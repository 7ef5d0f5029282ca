"""Vector code compression: a codebook for each part of the vectors, by active-entry Lloyd.

Components become integers, so all distances and sums are exact and no result depends
on the order of rows. A vector is cut into ``parts`` equal parts; each part position has
a codebook that starts as that part of the vectors with the smallest ids. A round
assigns every part to its nearest entry (lower index in ties) and moves each entry to
the floored mean of its parts.

Rows keep their assigned entries and exact distances from round to round, in a table
that each round writes anew. A part whose entry stayed where it was compares only the
entries that moved with the stored distance: all others were not nearer before and are
not now. A part whose entry moved looks at all entries again.

Sums of a round are taken inside the tasks and come as one row for each task, part and
entry. What is sent to the tasks and comes back is the codebooks, ``entries`` vectors
in all. Before the next round the table of the one before last goes, so two are kept.

Defined cases: a null or empty vector and one with null or non-finite components is left
out; integers beyond 2**27 either way are held there; a length that ``parts`` does not
divide is filled up with zeros; a vector of another length than that of the smallest
id keeps its row with null code and error and moves nothing; of rows with one id the
smallest vector can start a codebook; null ids start one only where there is no other;
fewer ids give fewer entries; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import discard, pieces_of, stored, written

LIMIT = 1 << 27
ROWS = 4_096
KEPT = "kind int, vec_id long, label string, ints binary, codes binary, far binary, error long"
SUMS = "part int, entry int, n long, sums array<bigint>"


def integers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int
             ) -> DataFrame:
    """vec_id, label and ints (int32, little-endian) of the rows that take part."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < float("inf")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, ROWS):
            lists = batch.column(2)
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            flat = np.clip(flat, -LIMIT, LIMIT).astype("<i4")
            ends = np.cumsum([0, *(len(v) for v in lists)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([flat[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())],
                ["vec_id", "label", "ints"])

    return (vectors.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite)
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.col(label_col).cast("string").alias("label"), vector_col)
            .mapInArrow(run, "vec_id long, label string, ints binary"))


def first_entries(rows: DataFrame, parts: int, entries: int) -> tuple[np.ndarray, int]:
    """(parts, entries, width): the parts of the vectors with the smallest ids; and the
    length of a vector."""
    ids = [r[0] for r in rows.select("vec_id").distinct()
           .orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()]
    named = [i for i in ids if i is not None] or ids
    chosen = F.col("vec_id").isin(named) if named != [None] else F.col("vec_id").isNull()
    found = {r[0]: r[1] for r in rows.filter(chosen).select("vec_id", "ints").groupBy("vec_id").agg(
        F.min("ints")).collect()} if ids else {}
    flat = [np.frombuffer(found[i], "<i4").astype(np.int64) for i in named if i in found]
    flat = [v for v in flat if len(v) == len(flat[0])]
    if not flat:
        return np.zeros((parts, 0, 0), np.int64), 0
    whole = np.stack(flat)
    dims = whole.shape[1]
    whole = np.pad(whole, ((0, 0), (0, -whole.shape[1] % parts)))
    return whole.reshape(len(whole), parts, -1).transpose(1, 0, 2).copy(), dims


def squares(part: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, (rows, entries)."""
    apart = part[:, None, :] - entries[None, :, :]
    return (apart * apart).sum(axis=2)


def nearest(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and distance of every row after a look at all entries."""
    far = squares(part, entries)
    code = far.argmin(axis=1)
    return code, far[np.arange(len(part)), code]


def nearest_again(part: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray,
                  far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from the last round's answer and which entries have moved since."""
    if not moved.any() or not len(part):
        return code, far
    code, far = code.copy(), far.copy()
    lost = moved[code]
    if lost.any():
        code[lost], far[lost] = nearest(part[lost], entries)
    kept = np.flatnonzero(~lost)
    active = np.flatnonzero(moved)
    place, least = nearest(part[kept], entries[active])
    place = active[place]
    better = (least < far[kept]) | (least == far[kept]) & (place < code[kept])
    code[kept[better]], far[kept[better]] = place[better], least[better]
    return code, far


def assigned(rows: DataFrame, books: np.ndarray, moved: np.ndarray | None, dims: int) -> DataFrame:
    """Rows of kind 0: the vectors with their codes and distances under ``books``; of kind 1:
    n and sums of the parts of each entry, one row for each task. ``moved`` (parts,
    entries) marks what moved since the rows' codes; None: there are none yet."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        for batch in pieces_of(batches, ROWS):
            ints = batch.column("ints").to_pylist()
            fits = np.array([len(v) == 4 * dims for v in ints], bool)
            n = int(fits.sum())
            whole = np.zeros((n, parts * width), np.int64)
            if n:
                whole[:, :dims] = np.frombuffer(
                    b"".join(v for v, ok in zip(ints, fits) if ok), "<i4").reshape(n, dims)
            whole = whole.reshape(n, parts, width)
            codes, far = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
            if moved is not None and n:
                held = [c for c in batch.column("codes").to_pylist() if c is not None]
                codes = np.frombuffer(b"".join(held), np.uint8).reshape(n, parts).astype(np.int64)
                held = [c for c in batch.column("far").to_pylist() if c is not None]
                far = np.frombuffer(b"".join(held), "<i8").reshape(n, parts).copy()
            for p in range(parts) if n else ():
                if moved is None:
                    codes[:, p], far[:, p] = nearest(whole[:, p], books[p])
                else:
                    codes[:, p], far[:, p] = nearest_again(
                        whole[:, p], books[p], moved[p], codes[:, p], far[:, p])
                counts[p] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(sums[p], codes[:, p], whole[:, p])
            place = iter(zip(codes.astype(np.uint8), far.astype("<i8"), far.sum(axis=1).tolist()))
            out = [next(place) if ok else None for ok in fits]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(ints), np.int32)), batch.column("vec_id"),
                 batch.column("label"), batch.column("ints"),
                 pa.array([o and o[0].tobytes() for o in out], pa.binary()),
                 pa.array([o and o[1].tobytes() for o in out], pa.binary()),
                 pa.array([o and o[2] for o in out], pa.int64()), pa.nulls(len(ints), pa.int32()), pa.nulls(len(ints), pa.int32()),
                 pa.nulls(len(ints), pa.int64()), pa.nulls(len(ints), pa.list_(pa.int64()))], names)
        used = np.argwhere(counts > 0)
        count = len(used)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(count, np.int32)), pa.nulls(count, pa.int64()),
             pa.nulls(count, pa.string()), *(pa.nulls(count, pa.binary()) for _ in range(3)),
             pa.nulls(count, pa.int64()),
             pa.array(used[:, 0].astype(np.int32)), pa.array(used[:, 1].astype(np.int32)),
             pa.array([int(counts[p, e]) for p, e in used], pa.int64()),
             pa.array([sums[p, e].tolist() for p, e in used], pa.list_(pa.int64()))], names)

    names = ["kind", "vec_id", "label", "ints", "codes", "far", "error", "part", "entry", "n", "sums"]
    return rows.mapInArrow(run, f"{KEPT}, {SUMS}")


def moved_books(table: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry at the floored mean of its parts; entries without parts stay."""
    found = (table.filter("kind = 1").select("part", "entry", "n", F.posexplode("sums"))
             .groupBy("part", "entry", "pos")
             .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"),
                  F.sum(F.col("col").cast("decimal(38,0)")).alias("total")).collect())
    out = books.copy()
    for row in found:
        out[row["part"], row["entry"], row["pos"]] = int(row["total"]) // int(row["n"])
    return out


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6,
             scale: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """vec_id, label (as text), codes (one byte a part) and error of every row that takes
    part, and the codebooks (parts, entries, width) as integers. ``entries`` is at
    most 256."""
    spark = vectors.sparkSession
    table, path = written(integers(vectors, id_col, vector_col, label_col, scale), "vector-rows")
    books, dims = first_entries(table, parts, entries)
    if not dims:
        return table.select("vec_id", "label", F.lit(None).cast("binary").alias("codes"),
                            F.lit(None).cast("long").alias("error")), books
    moved = None
    for turn in range(rounds + 1):
        rows = table if moved is None else table.filter("kind = 0")
        table, last = written(assigned(rows, books, moved, dims), "vector-codes")
        discard(spark, path)
        path = last
        if turn < rounds:
            after = moved_books(table, books)
            moved, books = (after != books).any(axis=2), after

    return table.filter("kind = 0").select("vec_id", "label", "codes", "error"), books


def decoded(codes: DataFrame, books: np.ndarray, dims: int, scale: int = 4096) -> DataFrame:
    """vec_id and the vector that the codes stand for. ``books`` is small: ``entries``
    vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, ROWS):
            out = []
            for code in batch.column(1).to_pylist():
                out.append(None if code is None else np.concatenate(
                    [books[p, e] for p, e in enumerate(code)])[:dims] / scale)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.list_(pa.float64()))], ["vec_id", "embedding"])

    return codes.select("vec_id", "codes").mapInArrow(run, "vec_id long, embedding array<double>")


def code_report(vectors: DataFrame, **settings) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every row that takes part."""
    codes, books = compress(vectors, **settings)
    digest = sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    by_label = stored(codes.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")), "label-errors")
    by_label = by_label.withColumnRenamed("label", "same")
    return (codes.join(by_label, codes["label"].eqNullSafe(by_label["same"]), "left")
            .select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
                    F.lit(digest).alias("codebooks_sha256")))
