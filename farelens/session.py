"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
SCAN_BYTES = 32 * 1024 * 1024
SHUFFLE_INPUT_BYTES = 8 * 1024 * 1024
CACHE_ROWS = 1_000
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
INITIAL_WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(app: str = "farelens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on, which splits skewed join partitions."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TARGET_PARTITION_BYTES))
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Let shuffles begin with one partition for each 128 MB of input, at least 8; AQE
    merges what turns out smaller. Returns that number."""
    width = max(math.ceil(input_bytes / TARGET_PARTITION_BYTES), 8)
    spark.conf.set(INITIAL_WIDTH, str(width))
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    return width


def widen_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Let shuffles begin with one partition for each 8 MB of input at least, for rows that are
    several times as large in a shuffle as in the files; AQE merges what turns out smaller.
    Never fewer than the session has. Returns the number."""
    now = int(spark.conf.get(INITIAL_WIDTH, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    width = max(now, math.ceil(input_bytes / SHUFFLE_INPUT_BYTES))
    if width > now:
        spark.conf.set(INITIAL_WIDTH, str(width))
    return width


def narrow_scans(spark: SparkSession) -> None:
    """Let a scan's task take 32 MB of files at most, for tables whose rows grow when read."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(SCAN_BYTES))


def narrow_merges(spark: SparkSession) -> None:
    """Let AQE merge shuffle partitions up to 8 MB at most, for rows that a task holds sorted and
    that are twenty times as large there as in the shuffle."""
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(ADVISORY))
    if now > SHUFFLE_INPUT_BYTES:
        spark.conf.set(ADVISORY, str(SHUFFLE_INPUT_BYTES))


def narrow_caches(spark: SparkSession) -> None:
    """Let a cached table hold 1,000 rows a batch at most. Java's serializer keeps the last hundred
    batches that it wrote or read, and a batch of 10,000 encoded rows is 2 MB."""
    spark.conf.set("spark.sql.inMemoryColumnarStorage.batchSize", str(CACHE_ROWS))


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path for written intermediates, on storage every executor sees.

    The cluster names that storage in ``spark.checkpoint.dir``; without it, it is a
    folder beside the tables in ``spark.sql.warehouse.dir``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/farelens-scratch"
    return f"{root.rstrip('/')}/farelens/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Remove what this application has written there. Results that are not yet read need
    it, so it is for the end of a job."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark, "x")).getParent()
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a written table in the scratch folder: computed once, and read
    back from there after a lost executor."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative trainers cut their lineage in the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(spark, "checkpoints"))
