"""Small tables with the awkward rows that every operator has to take."""

import pytest
from pyspark.sql import functions as F

# Names that operators use inside, here as extra columns of the input.
CLASHING = ["digit", "rest", "gid", "members", "row_id", "node", "bucket", "n", "text_key", "set_a", "registers", "score",
            "tokens", "kept_id", "block", "row", "tail", "h", "part", "shard", "y", "token", "tokens_", "list_rule", "v", "layout"]

LONG = " ".join(f"w{i % 977}x{i % 89}" for i in range(30_000))

ROWS = [
    (None, None, None), (None, "a b c d", "en"), (1, "", "en"), (2, "a", None), (3, "a b c d", "en"), (4, "a b c d", "en"),
    (4, "a b c d", "en"), (5, LONG, "de"), (6, LONG + " end", "de"), (7, "\t \n\r", "fr"), (8, "A  B\tc d", "en"),
    (9, "İ <|endoftext|> </s> ▁x \x00 梦 ½", "xx"), (10, None, "en"), (11, "abcd", "en"), (12, "a b c d e", "en"),
    (12, "other text under the same id", "en"),
]


@pytest.fixture(scope="session")
def edge_rows():
    return ROWS


@pytest.fixture(scope="session")
def edge_docs(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").withColumns(
        {"source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return docs.withColumns({c: F.lit(1) for c in CLASHING})


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def small_rows(small_docs):
    return [(r["doc_id"], r["text"]) for r in small_docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def edge_labels(spark):
    return spark.createDataFrame([(3, 1, 0), (5, 0, 1), (5, 1, 0), (None, 1, 1), (99, 0, 0), (8, None, None)],
                                 "doc_id long, quality int, toxic int")
