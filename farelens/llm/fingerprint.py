"""Document fingerprints: a quartile bucket digest.

Every byte triplet of a text is hashed into one of 256 buckets. Each bucket is then
written as the quartile its count falls in, behind one byte for the text's length on
a logarithmic scale: 130 hexadecimal digits. Two digests differ by the sum over the
buckets of the quartile steps, an opposite quartile counting double, plus the length
steps; the difference is bounded, and the likeness is 1 minus its share of the bound.

Defined cases: null text counts as empty; a text under three bytes is filled up with
zero bytes; equal texts have equal fingerprints; repeated rows and rows that share a
doc_id follow each other in order of their text; an empty table gives no rows; the
only row of a table is its own next row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import pieces_of, shuffle_width

BUCKETS = 256
STEPS = np.array([0, 1, 2, 6])
LENGTH_STEPS = 64
BOUND = 6 * BUCKETS + LENGTH_STEPS


def codes(text: str) -> np.ndarray:
    """The length step, then the quartile 0 to 3 of every bucket."""
    data = text.encode()
    size = len(data)
    data = np.frombuffer(data.ljust(3, b"\0"), np.uint8).astype(np.uint32)
    hashed = data[:-2] * np.uint32(2654435761) + data[1:-1] * np.uint32(2246822519)
    hashed += data[2:] * np.uint32(3266489917)
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(668265263)
    counts = np.bincount(hashed >> np.uint32(24), minlength=BUCKETS)
    if not size:
        counts[:] = 0
    cuts = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    out = np.empty(BUCKETS + 1, np.uint8)
    out[0] = min(255, round(12 * math.log2(size + 1)))
    out[1:] = (counts[:, None] > cuts).sum(1)
    return out


def digest(code: np.ndarray) -> str:
    four = code[1:].reshape(-1, 4)
    packed = four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]
    return f"{code[0]:02x}" + packed.astype(np.uint8).tobytes().hex()


def difference(one: np.ndarray, other: np.ndarray) -> int:
    """Bounded by ``BOUND``."""
    steps = np.abs(one[1:].astype(np.int16) - other[1:].astype(np.int16))
    return int(STEPS[steps].sum()) + min(LENGTH_STEPS, abs(int(one[0]) - int(other[0])))


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    return 1 - difference(one, other) / BOUND


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_next_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, part and ghost, sorted inside tasks by part, ghost, doc_id, text.

    Documents are dealt by ranges of doc_id. The first document of every part is
    also sent, as a ghost, to the part before it (the first of all to the last), so
    that each part knows the document after its last one. The ranges come from
    quantiles of the ids; only those and each part's smallest id visit the driver.
    """
    width = shuffle_width(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"))
    ids = rows.select("doc_id")
    cuts = np.unique(ids.approxQuantile(
        "doc_id", [i / width for i in range(1, width)], 1 / (8 * width))).astype(np.int64)

    @F.pandas_udf("int")
    def part(values: pd.Series) -> pd.Series:
        """Range number; null ids stand before all others."""
        numbers = np.searchsorted(cuts, values.fillna(-2 ** 63).astype("int64"), side="right")
        return pd.Series(numbers.astype("int32"))

    firsts = sorted((r["part"], r["first"]) for r in ids.groupBy(part("doc_id").alias("part"))
                    .agg(F.min(F.coalesce("doc_id", F.lit(-2 ** 63))).alias("first")).collect())
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}

    @F.pandas_udf("array<int>")
    def parts(values: pd.Series) -> pd.Series:
        values = values.fillna(-2 ** 63).astype("int64")
        own = np.searchsorted(cuts, values, side="right")
        ghost = values.map(before)
        return pd.Series([[p] if g != g else [p, int(g)] for p, g in zip(own, ghost)])

    return (rows.select("*", F.posexplode(parts("doc_id")).alias("ghost", "part"))
            .repartition(width, "part").sortWithinPartitions("part", "ghost", "doc_id", "text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in pieces_of(batches):
            out: list[tuple] = []
            for doc_id, text, ghost, part in zip(*(c.to_pylist() for c in batch.columns)):
                code = codes(text)
                if last is not None and last[2] == part:
                    out.append(row(*last[:2], last[3], text, code))
                last = None if ghost else (doc_id, text, part, code)
            if out:
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
                         pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                     "near_edited", "near_next"])

    def row(doc_id, text, code, following, next_code) -> tuple:
        changed = edited(text, following)
        changed_code = codes(changed)
        return (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), digest(code),
                digest(changed_code), likeness(code, changed_code), likeness(code, next_code))

    return with_next_rows(docs, id_col, text_col).select("doc_id", "text", "ghost", "part").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")
