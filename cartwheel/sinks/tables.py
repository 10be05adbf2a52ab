"""Table writes and table maintenance.

Every writer takes an explicit location (under ``session.shared_dir`` in the
catalog queries): nothing is written to a machine-local folder, and the
written table doubles as a lineage cut that survives executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the warehouse text format's NULL marker.
HIVE_NULL = "\\N"
# Fixed value: the folder name of the null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
FILES_A_TASK = 1_000
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """K1: replace whatever is at ``path``."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save_as_table(df: DataFrame, name: str, path: str, mode: str = "overwrite") -> DataFrame:
    """K1 with a catalog entry: ``saveAsTable`` over an explicit location."""
    df.write.mode(mode).format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def ctas(spark: SparkSession, name: str, path: str, select_sql: str) -> DataFrame:
    """K2: CREATE TABLE ... AS SELECT."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}' AS {select_sql}")
    return spark.table(name)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """K3: static-partition overwrite - only the partitions present in ``df``
    are replaced; all others stay (dynamic partition-overwrite mode)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def insert_partitioned(df: DataFrame, path: str, partition_by: list[str], mode: str = "append") -> None:
    """K4 / K5: partitioned insert, partition columns last. Rows are first
    rebalanced by the partition values: each task writes few files, and
    adaptive execution splits a large partition value over several tasks."""
    df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_partitioned(spark: SparkSession, path: str, string_partitions: list[str] | None = None) -> DataFrame:
    """Read a partitioned layout; the named partition columns keep their
    string type (inference would turn '0' into an int)."""
    df = spark.read.option("basePath", path).parquet(path)
    for c in string_partitions or []:
        df = df.withColumn(c, F.col(c).cast("string"))
    return df


def list_partitions(df: DataFrame, column: str) -> DataFrame:
    """K6: partition values with their row counts."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def _newest_first(values: list[str]) -> list[str]:
    """Partition values from the newest: as numbers where all are whole
    numbers ('9' before '10'), else as text (ISO dates)."""
    whole = all(v.lstrip("-").isdigit() for v in values)
    return sorted(values, key=int if whole else str, reverse=True)


def drop_old_partitions(spark: SparkSession, path: str, column: str, keep: int = 7) -> list[str]:
    """K7: delete the partition folders of ``column`` beyond the ``keep``
    newest. The null partition is no snapshot: it is neither counted nor
    deleted. Only partition folder names are listed on the driver - bounded by
    the partition count, not the data - through Hadoop's FileSystem, so it
    works on any storage the cluster mounts. Returns the dropped values."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    prefix = f"{column}="
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    values = [n[len(prefix):] for n in names if n.startswith(prefix) and n != prefix + NULL_PARTITION]
    dropped = _newest_first(values)[keep:]
    for v in dropped:
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, prefix + v), True)
    return dropped


def bucketed_save(df: DataFrame, name: str, path: str, buckets: int, column: str) -> DataFrame:
    """K8: ``clustered by (column) into n buckets``, sorted within buckets.
    Rows are first dealt by the bucket's own hash, so each bucket is one
    sorted file, written by one task: choose ``buckets`` by the table's size.
    Later joins / aggregations on ``column`` between tables with the same
    bucketing read without a shuffle."""
    (df.repartition(buckets, column).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, column).sortBy(column).saveAsTable(name))
    return df.sparkSession.table(name)


def to_cells(df: DataFrame, row_key: str, cells: list[tuple[str, str, str]], version: str) -> DataFrame:
    """K9: unpivot to wide-column cells (row_key, family, qualifier, value)
    and keep, per cell, the value of the highest ``version`` (last write
    wins, deterministic). ``cells`` lists (family, qualifier, source column)."""
    arr = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(q).alias("qualifier"),
                             F.col(c).cast("string").alias("value")) for f, q, c in cells])
    long = df.select(F.col(row_key).cast("string").alias("row_key"), F.col(version).alias("version"),
                     F.inline(arr))
    return (long.groupBy("row_key", "family", "qualifier")
            .agg(F.max_by("value", "version").alias("value")))


def save_text(df: DataFrame, path: str, line) -> None:
    """One text line per row."""
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def save_files(df: DataFrame, path: str, folders: list[str], key: str) -> None:
    """One text file per row, below a folder for each of ``folders``; rows of one ``key`` share a task.

    Creating a file costs far more than its bytes, so tasks are dealt by rows, ``FILES_A_TASK`` each and at
    least one a core, and adaptive execution may not merge them by size. On a ``file:`` folder each file would
    also get a checksum file, and permissions for both by a process of its own: ``PLAIN_FILES`` leaves the
    checksum files out. Other storage is written as ever."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, df.count() // FILES_A_TASK)
    df.repartition(tasks, key).write.mode("overwrite").options(**PLAIN_FILES).partitionBy(*folders).text(path)


def save_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """Warehouse text table: delimited, no header, NULL as \\N. Empty strings
    are written quoted (``""``) - the reader turns an unquoted empty field
    into NULL, a quoted one back into ''."""
    df.write.mode("overwrite").option("sep", sep).option("nullValue", HIVE_NULL).csv(path)


def save_sampled(df: DataFrame, path: str, column: str, buckets: int) -> None:
    """Lay a table out by the sample's own bucket function, the key mod ``buckets``
    (a null key is in the first bucket), one folder a bucket."""
    insert_partitioned(df.withColumn("bucket_no", F.coalesce(F.pmod(F.col(column), F.lit(buckets)), F.lit(0))),
                       path, ["bucket_no"], mode="overwrite")


def read_sample(spark: SparkSession, path: str, column: str, buckets: int, bucket: int, out_of: int) -> DataFrame:
    """``tablesample(bucket x out of y on column)`` of a ``save_sampled`` table. Where one of
    y and the table's buckets divides the other, only folders that hold the sample are read."""
    if not 1 <= bucket <= out_of:
        raise ValueError(f"bucket {bucket} out of {out_of}")
    t, want = spark.read.parquet(path), bucket - 1
    if buckets % out_of == 0:
        t = t.filter(F.pmod(F.col("bucket_no"), F.lit(out_of)) == want)
    else:
        if out_of % buckets == 0:
            t = t.filter(F.col("bucket_no") == want % buckets)
        t = t.filter(F.coalesce(F.pmod(F.col(column), F.lit(out_of)), F.lit(0)) == want)
    return t.drop("bucket_no")
