"""Shared helpers of the corpus operators: whole tables, Arrow mapping, bounded caches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from farelens.session import scratch_dir, stored

__all__ = ["BoundedCache", "discard", "pieces_of", "read", "shuffle_width", "stored", "written"]


#: Bytes of an Arrow batch on its way to Python; a single larger row goes alone.
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The whole table. From here on the session's Arrow batches are bounded in bytes as well
    as in rows: ten thousand texts are tens of megabytes, held several times in a task."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(limit).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(limit, str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class BoundedCache(dict):
    """Results of ``compute`` by key: the last ``limit`` new keys and those used since, and
    the ``limit`` before them.

    Forgetting only costs time. Keys of over 64 characters are not kept, so that
    junk without blanks cannot fill the memory.
    """

    def __init__(self, compute: Callable, limit: int = 300_000):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.older = {}


def pieces_of(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, which bounds memory with long texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def written(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """The rows as a written table in the scratch folder, and its path, for ``discard``."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Removes a written table of which all that is needed has been written elsewhere."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
