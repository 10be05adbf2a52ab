"""Whole-file corpus ingest (S5): one row per file found recursively."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Label rules, tried in this order; the first substring found
# in the file's path wins.
LABEL_RULES = ["business", "yule", "it", "sports", "auto"]
UNKNOWN_LABEL = "unknown"
FILES_A_PASS = 100_000      # files that the driver lists, or hears of from the tasks that wrote them, at a time


def label_from_path(path: Column) -> Column:
    """Ordered ``contains`` rules with a default (the reference has none and
    fails on an unmatched path)."""
    out = F.lit(UNKNOWN_LABEL)
    for rule in reversed(LABEL_RULES):
        out = F.when(path.contains(rule), F.lit(rule)).otherwise(out)
    return out


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    """(path, sentence, label, segs) for every file below ``root``:
    ``sentence`` is the content without line breaks and spaces, ``segs`` the
    content without line breaks. Labels are matched on the path relative to
    ``root`` so the storage prefix cannot match a rule. Files are read by
    many tasks in parallel; no listing happens on the driver beyond Spark's
    own file index, which keeps some hundred bytes a file there (``FILES_A_PASS``)."""
    # wholetext must be the text() argument: its default False overrides an option.
    raw = (spark.read.option("recursiveFileLookup", True).text(root, wholetext=True)
           .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")))
    root_uri = root.rstrip("/")
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _regex_quote(root_uri.split("://")[-1]) + "/?", "")
    segs = F.regexp_replace("content", r"[\r\n]", "")
    return raw.select(rel.alias("path"), F.regexp_replace(segs, " ", "").alias("sentence"),
                      label_from_path(rel).alias("label"), segs.alias("segs"))


def _regex_quote(s: str) -> str:
    import re
    return re.escape(s)
