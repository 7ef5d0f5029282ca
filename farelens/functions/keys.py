"""Key hashing for samples, splits and folds that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_RANGE = 1 << 31
HASH_RANGE = 1 << 32
SPLIT_MULTIPLIER = 2654435761
FOLD_MULTIPLIER = 2246822519


def whole_hash(key: Column | str, multiplier: int = SPLIT_MULTIPLIER) -> Column:
    """A whole number below ``HASH_RANGE`` from an integer key, by multiplicative hashing."""
    value = F.col(key) if isinstance(key, str) else key
    reduced = F.pmod(value, F.lit(KEY_RANGE))
    return F.pmod(reduced * F.lit(multiplier), F.lit(HASH_RANGE))


def unit_hash(key: Column | str, multiplier: int = SPLIT_MULTIPLIER) -> Column:
    """A number in [0, 1) from an integer key."""
    return whole_hash(key, multiplier) / float(HASH_RANGE)


def fold_of(key: Column | str, folds: int) -> Column:
    return F.floor(unit_hash(key, FOLD_MULTIPLIER) * folds).cast("int")


def row_key(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A key for rows without an id: equal rows share it."""
    return F.xxhash64(*(columns or df.columns))
