"""Round 6: files of the corpus (F15), on rows of the tests' own."""

import os

from cartwheel.session import scratch_path
from cartwheel.sinks import tables as SK
from cartwheel.sources.corpus import read_corpus

ROWS = [(i, f"h{i % 3}", f"text {i}\nnext") for i in range(40)] + [(None, "h1", "no id"), (50, None, "no host"), (51, "it.x", None), (52, "h1", "")]


def test_a_file_a_row_without_checksum_files(spark):
    """each file's creation counts, so no second file for it, and as many tasks as cores."""
    df = spark.createDataFrame(ROWS, "page_id long, host string, html string").coalesce(1)
    root = scratch_path(spark, "files")
    SK.save_files(df, root, ["host", "page_id"], "page_id")
    names = [n for _, _, files in os.walk(root.split("file:")[-1]) for n in files]
    made = [n for n in names if n.startswith("part-")]
    assert len(made) == len(ROWS) and not [n for n in names if n.endswith(".crc")]
    assert len({n.split("-")[1] for n in made}) > min(4, spark.sparkContext.defaultParallelism // 2)
    got = {r["path"].split("/part-")[0]: (r["segs"], r["label"]) for r in read_corpus(spark, root).collect()}
    assert len(got) == len(ROWS)
    assert got["host=h1/page_id=4"] == ("text 4next", "unknown") and got["host=it.x/page_id=51"] == ("", "it")


def test_files_are_dealt_by_rows(spark, monkeypatch):
    monkeypatch.setattr(SK, "FILES_A_TASK", 1)
    root = scratch_path(spark, "files")
    SK.save_files(spark.createDataFrame(ROWS, "page_id long, host string, html string"), root, ["host", "page_id"], "page_id")
    assert len({n.split("-")[1] for _, _, files in os.walk(root.split("file:")[-1]) for n in files if n.startswith("part-")}) > 16
