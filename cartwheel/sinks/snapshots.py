"""K7: daily snapshots of a keyed table, stored as one base and the changes after it.

``add_day`` compares the day's table with the day before and writes only rows inserted,
updated or deleted; ``rebuild`` gives any kept day back; ``keep`` newest days stay, as
the base moves up to the oldest of them.

Days are added in ascending order; the newest may be added again (it is replaced).
A base that moved up is finished before the older folders go, and ``rebuild`` starts from
the newest base at or before its day, so an interrupted call loses nothing.

Scale: two shuffles by key a day (rebuild, comparison), both sides of the size of the table;
what is written is the day's changes. The key must be unique in each day's table and not
null: else ``add_day`` raises. Columns and their types stay as on the first day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import folders

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def days(spark: SparkSession, root: str) -> list[str]:
    """The days that can be rebuilt, ascending."""
    base = folders.finished(spark, f"{root}/base", "day=")
    return sorted({*base, *[d for d in folders.finished(spark, f"{root}/changes", "day=") if base and d > base[0]]})


def _packed(df: DataFrame, key: list[str], name: str) -> DataFrame:
    return df.select(*key, F.struct(*[c for c in df.columns if c not in key]).alias(name))


def row_changes(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """(key..., op, row): what turns ``before`` into ``after``; row is null for a delete."""
    after = after.select(before.columns)
    both = _packed(before, key, "old").withColumn("had", F.lit(True)).join(
        _packed(after, key, "row").withColumn("has", F.lit(True)), key, "full_outer")
    op = F.when(F.col("had").isNull(), INSERT).when(F.col("has").isNull(), DELETE).when(~F.col("old").eqNullSafe(F.col("row")), UPDATE)
    return both.select(*key, op.alias("op"), "row").filter("op is not null")


def rebuild(spark: SparkSession, root: str, day: str, key: list[str]) -> DataFrame:
    """The table as it was on ``day``."""
    if day not in days(spark, root):
        raise ValueError(f"day {day} is not kept")
    start = max(d for d in folders.finished(spark, f"{root}/base", "day=") if d <= day)
    base = spark.read.parquet(f"{root}/base/day={start}")
    rows = _packed(base, key, "row").withColumns({"at": F.lit(start), "op": F.lit(INSERT)})
    for d in [d for d in folders.finished(spark, f"{root}/changes", "day=") if start < d <= day]:
        rows = rows.unionByName(spark.read.parquet(f"{root}/changes/day={d}").withColumn("at", F.lit(d)))
    last = rows.groupBy(*key).agg(F.max_by(F.struct("op", "row"), "at").alias("last")).filter(F.col("last.op") != DELETE)
    return last.select(*key, "last.row.*").select(base.columns)


def _checked(table: DataFrame, key: list[str]) -> DataFrame:
    bad = table.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(
        (F.col("n") > 1) | F.greatest(*[F.col(k).isNull() for k in key], F.lit(False)))
    if not bad.isEmpty():
        raise ValueError(f"key {key} is null or repeated")
    return table


def add_day(table: DataFrame, root: str, day: str, key: list[str], keep: int = 7) -> None:
    """Store ``table`` as the snapshot of ``day`` and drop days beyond the ``keep`` newest."""
    spark = table.sparkSession
    _checked(table, key)
    known = days(spark, root)
    if known and day < known[-1]:
        raise ValueError(f"day {day} is before {known[-1]}")
    earlier = [d for d in known if d < day]
    if not earlier:
        table.write.mode("overwrite").parquet(f"{root}/base/day={day}")
        return
    changes = row_changes(rebuild(spark, root, earlier[-1], key), table, key)
    changes.write.mode("overwrite").parquet(f"{root}/changes/day={day}")
    _move_base(spark, root, key, keep)


def _move_base(spark: SparkSession, root: str, key: list[str], keep: int) -> None:
    known = days(spark, root)
    first = known[max(0, len(known) - keep)]
    old_bases = [d for d in folders.finished(spark, f"{root}/base", "day=") if d < first]
    if old_bases:
        rebuild(spark, root, first, key).write.mode("overwrite").parquet(f"{root}/base/day={first}")
    for d in old_bases:
        folders.remove(spark, f"{root}/base/day={d}")
    for d in folders.finished(spark, f"{root}/changes", "day="):
        if d <= first:
            folders.remove(spark, f"{root}/changes/day={d}")
