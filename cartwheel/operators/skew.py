"""Skew handling: salted two-phase aggregation and hot-key detection.

The reference turns on a two-phase group-by for skewed keys. Spark's partial
aggregation already combines counts and sums per task, but a distinct count
or a collect on a hot key still lands in one reducer. Salting spreads the
first phase of such a key over ``buckets`` reducers; the second phase then
merges at most ``buckets`` partial rows per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "__salt"


def salt_of(col: Column | str, buckets: int) -> Column:
    """A deterministic salt (recomputed identically after an executor loss)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.xxhash64(c), F.lit(buckets))


def salted_counts(df: DataFrame, key: str, value: str, buckets: int = 32) -> DataFrame:
    """Per ``key``: row count and distinct count of ``value``.

    Phase 1 groups by (key, salt(value), value): the distinct values of a hot
    key are split over ``buckets`` reducers by the value's hash. Phase 2 merges
    the per-salt counts; a value lives in exactly one salt, so summing the
    per-salt distinct counts is exact."""
    s = salt_of(value, buckets)
    per_value = df.groupBy(key, s.alias(SALT), value).agg(F.count(F.lit(1)).alias("n"))
    per_salt = per_value.groupBy(key, SALT).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d"))
    return per_salt.groupBy(key).agg(F.sum("n").alias("rows"), F.sum("d").alias("distinct_values"))


def hot_keys(df: DataFrame, key: str, min_share: float) -> DataFrame:
    """Keys holding at least ``min_share`` of all rows.

    Size bound: at most ``1 / min_share`` keys can each hold that share, so
    the result is safe to broadcast whatever the input size."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows"))
    total = df.agg(F.count(F.lit(1))).scalar()  # scalar subquery, one value
    return counts.filter(F.col("key_rows") >= total * F.lit(min_share)).select(key, "key_rows")
