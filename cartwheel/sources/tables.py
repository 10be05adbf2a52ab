"""Table scans over the parquet test layout and over delimited / text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    """Location of one test table below a scale-factor folder."""
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan. Column pruning and filters reach the reader because
    callers only ever ``select``/``filter`` on the returned frame."""
    return spark.read.parquet(table_path(sf_dir, name))


def string_schema(names: list[str] | str) -> T.StructType:
    """All-nullable string schema from a list or a space separated name list."""
    if isinstance(names, str):
        names = names.split()
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def delimited_load(spark: SparkSession, path: str, columns: list[str] | str,
                   sep: str = ",") -> DataFrame:
    """Delimited text without header, every column a string (the warehouse
    text-table contract: an empty field is '', NULL is written \\N). The schema is given, never inferred, so the scan is
    one pass and splits across files freely."""
    return (spark.read.schema(string_schema(columns))
            .option("sep", sep).option("header", "false").option("nullValue", "\\N")
            .option("mode", "PERMISSIVE").csv(path))


def text_lines(spark: SparkSession, path: str, column: str = "sentence") -> DataFrame:
    """One line per row (``fields terminated by '\\n'``)."""
    return spark.read.text(path).withColumnRenamed("value", column)


def external_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Register a table over an existing location. Dropping it removes only
    the catalog entry; the files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'")
    return spark.table(name)
