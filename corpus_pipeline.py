"""The corpus pipeline: ``documents`` through five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet in the shared folder and read again as the next stage's ``docs``. All stages but
the last return the columns of ``docs``. A verdict holds for the one row it was given to,
so repeated rows, rows that share a doc_id and rows without one stay or go each for itself.
Null texts count as empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import decontaminate as D2
from cartwheel.llm import exact_dedup as D7
from cartwheel.llm import near_dedup as D1
from cartwheel.llm import packing as D4
from cartwheel.llm import toxicity as D5
from cartwheel.llm.catalog import tokenizer_file
from cartwheel.llm.common import cut_lineage, documents


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that names each row for good, and the column's name: the file and
    place where the row is written. Other than a written table is written first."""
    plan = docs._jdf.queryExecution().analyzed()
    if not (plan.children().isEmpty() and plan.toString().strip().endswith("] parquet")):
        docs = cut_lineage(docs, "stage_input")
    name = "written_row"
    while name in map(str.lower, docs.columns):
        name += "_"
    return docs.withColumn(name, F.concat_ws("#", "_metadata.file_path", "_metadata.row_index")), name


def keep_rows(rows: DataFrame, row: str, verdicts: DataFrame, kept: str, key: str = "doc_id") -> DataFrame:
    """The rows whose verdict, found by ``key``, says ``kept``; without the column ``row``."""
    ids = verdicts.filter(kept).select(F.col(key).alias("kept_row"))
    return rows.join(ids, rows[row] == ids["kept_row"], "left_semi").drop(row)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-or of their sentences predicts toxic go."""
    rows, row = numbered(docs)
    model = D5.fit(docs, documents(spark, sf_dir, "labels"))
    return keep_rows(rows, row, D5.score(rows.withColumn("doc_id", F.col(row)), model), "predicted = 0")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays."""
    rows, row = numbered(docs)
    return keep_rows(rows, row, D7.exact_dedup(rows, row=row), "kept", row)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component (shingles of five words) stays, one of the smallest doc_id."""
    rows, row = numbered(docs)
    return keep_rows(rows, row, D1.near_dedup(rows, row=row, width=5), "kept", row)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    rows, row = numbered(docs)
    verdicts = D2.decontaminate(rows.withColumn("doc_id", F.col(row)), documents(spark, sf_dir, "benchmark"))
    return keep_rows(rows, row, verdicts, "not contaminated")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return D4.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("near dedup", near_dedup),
          ("decontamination", decontaminate), ("packing", packing)]

# SQL can't state the trained, tokenising and packing stages; a brute-force version in the tests does.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
