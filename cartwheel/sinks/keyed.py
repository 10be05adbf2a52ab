"""K9: a wide-column table with keyed writes. A cell is (row_key, family, qualifier).

``put`` adds a batch of cell versions, ``read`` merges the batches (the highest version
of a cell wins, on equal versions the later batch; a null value deletes the cell), and
``compact`` writes the merged state as one batch.

Layout: ``cells/part=<batch>/region=<r>/`` with files sorted by row key. Regions are ranges of
row keys between split keys drawn from the first batch, so a read of a key range lists
and opens only its regions, and within them Parquet's statistics skip row groups. Every
batch is staged and then moved, so a reader sees all of it or nothing; a batch that is
already there is left alone (replay). A compaction up to batch n replaces the
batches up to n for readers as soon as it is moved; the old folders go afterwards.

Scale: a put shuffles its own rows once, by region (adaptive execution splits a large
one); reads combine partially before their shuffle. Null row keys and null versions have
no place in such a table: they raise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import folders

CELL = ["row_key", "family", "qualifier"]
_SCHEMA = "row_key string, family string, qualifier string, value string, version long, batch long, part string, region int"


def cell_rows(df: DataFrame, row_key: str, cells: list[tuple[str, str, str]], version: str) -> DataFrame:
    """(row_key, family, qualifier, value, version) of each listed (family, qualifier, column)."""
    each = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(q).alias("qualifier"), F.col(c).cast("string").alias("value"))
                     for f, q, c in cells])
    return df.select(F.col(row_key).cast("string").alias("row_key"), F.col(version).cast("long").alias("version"),
                     F.inline(each)).select(*CELL, "value", "version")


def create(spark: SparkSession, root: str, keys: DataFrame, regions: int) -> None:
    """Write the split keys: the first key of each of ``regions`` ranges of (row_key)."""
    ranges = keys.select("row_key").distinct().repartitionByRange(regions, "row_key")
    splits = ranges.groupBy(F.spark_partition_id().alias("r")).agg(F.min("row_key").alias("split"))
    splits.coalesce(1).write.mode("overwrite").parquet(f"{root}/splits")


def _splits(spark: SparkSession, root: str) -> list[str]:
    """One key a region, the first region's left out: the table is open below."""
    return sorted(r["split"] for r in spark.read.parquet(f"{root}/splits").collect())[1:]


def _region(key: Column, splits: list[str]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, splits)).cast("array<string>"), lambda s: s <= key))


def _write(df: DataFrame, root: str, name: str) -> None:
    spark = df.sparkSession
    df = df.withColumn("region", _region(F.col("row_key"), _splits(spark, root)))
    staged = f"{root}/staged/{name}"
    df.hint("rebalance", "region").sortWithinPartitions("region", *CELL).write.mode("overwrite").partitionBy("region").parquet(staged)
    folders.publish(spark, staged, f"{root}/cells/part={name}")


def put(cells: DataFrame, root: str, batch: int) -> bool:
    """Add the batch; False if it is there already, by itself or in a compaction."""
    spark = cells.sparkSession
    upto, later = _parts(spark, root)
    if batch in later or (upto is not None and batch <= upto):
        return False
    need = F.when(F.col("row_key").isNull() | F.col("version").isNull(), F.raise_error(F.lit("a cell needs a row key and a version")))
    rows = cells.select(F.coalesce(need.cast("string"), "row_key").alias("row_key"), "family", "qualifier", "value",
                        F.col("version").cast("long").alias("version"), F.lit(batch).cast("long").alias("batch"))
    _write(_merged(rows), root, f"batch-{batch:012d}")
    return True


def _parts(spark: SparkSession, root: str) -> tuple[int | None, list[int]]:
    """The newest compaction, and the batches after it."""
    upto = [int(n) for n in folders.finished(spark, f"{root}/cells", "part=upto-")]
    last = max(upto, default=None)
    return last, [b for b in map(int, folders.finished(spark, f"{root}/cells", "part=batch-")) if last is None or b > last]


def _merged(rows: DataFrame) -> DataFrame:
    """The last version of each cell; the value in the order decides between equal ones of a batch."""
    last = F.max(F.struct("version", "batch", F.col("value").isNull().alias("gone"), "value"))
    return rows.groupBy(*CELL).agg(last.alias("m")).select(*CELL, "m.value", "m.version", "m.batch")


def stored(spark: SparkSession, root: str, low: str | None = None, high: str | None = None) -> DataFrame:
    """All stored versions with row keys in [low, high); only their regions are read."""
    upto, batches = _parts(spark, root)
    names = ([] if upto is None else [f"upto-{upto:012d}"]) + [f"batch-{b:012d}" for b in batches]
    if not names:
        return spark.createDataFrame([], _SCHEMA)
    rows = spark.read.schema(_SCHEMA).option("basePath", f"{root}/cells").parquet(*[f"{root}/cells/part={n}" for n in names]).drop("part")
    splits = _splits(spark, root)
    if low is not None:
        rows = rows.filter((F.col("region") >= sum(s <= low for s in splits)) & (F.col("row_key") >= low))
    if high is not None:
        rows = rows.filter((F.col("region") <= sum(s <= high for s in splits)) & (F.col("row_key") < high))
    return rows


def read(spark: SparkSession, root: str, low: str | None = None, high: str | None = None) -> DataFrame:
    """(row_key, family, qualifier, value, version): the present cells of the key range."""
    return _merged(stored(spark, root, low, high)).filter("value is not null").select(*CELL, "value", "version")


def compact(spark: SparkSession, root: str) -> None:
    """Merge all batches into one; deleted cells and older versions go."""
    upto, batches = _parts(spark, root)
    if not batches:
        return
    _write(_merged(stored(spark, root)).filter("value is not null"), root, f"upto-{batches[-1]:012d}")
    for b in batches:
        folders.remove(spark, f"{root}/cells/part=batch-{b:012d}")
    if upto is not None:
        folders.remove(spark, f"{root}/cells/part=upto-{upto:012d}")
