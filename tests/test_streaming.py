"""Streaming equals batch, including a stop and restart from the checkpoint."""

import os
import shutil
import tempfile

from pyspark.sql import functions as F

from cartwheel.session import scratch_path
from cartwheel.sources.tables import load_table
from cartwheel.streaming import counts as SC
from cartwheel.streaming import sources as SS

SF = "/root/testdata/sf0.001"


def _batch_counts(spark):
    e = load_table(spark, SF, "events")
    w = e.select(F.explode(F.split(F.concat_ws(" ", "event_type", F.col("user_id").cast("string")), " ")).alias("word"))
    return {r.word: r.cnt for r in w.groupBy("word").agg(F.count("*").alias("cnt")).collect()}


def test_running_count_survives_restart(spark):
    staged = SS.stage_lines(spark, SF, scratch_path(spark, "lines"))
    days = sorted(d for d in os.listdir(staged) if d.startswith("day="))
    live = tempfile.mkdtemp(prefix="live-", dir=os.path.dirname(staged))
    out, chk = scratch_path(spark, "out"), scratch_path(spark, "chk")
    half = len(days) // 2
    for d in days[:half]:
        shutil.copytree(os.path.join(staged, d), os.path.join(live, d))
    SC.running_word_counts(SS.text_stream(spark, live), out, chk)          # first run, then stop
    first = {r.word: r.cnt for r in SC.latest_counts(spark, out, ["word"]).collect()}
    for d in days[half:]:
        shutil.copytree(os.path.join(staged, d), os.path.join(live, d))
    SC.running_word_counts(SS.text_stream(spark, live), out, chk)          # resumes from checkpoint
    final = {r.word: r.cnt for r in SC.latest_counts(spark, out, ["word"]).collect()}
    assert sum(first.values()) < sum(final.values())
    assert final == _batch_counts(spark)


def test_per_batch_counts_have_no_state(spark):
    staged = SS.stage_lines(spark, SF, scratch_path(spark, "lines"))
    out, chk = scratch_path(spark, "out"), scratch_path(spark, "chk")
    SC.per_batch_word_counts(SS.text_stream(spark, staged, max_files_per_trigger=1), out, chk)
    t = spark.read.parquet(out)
    n_files = sum(f.endswith(".txt") for _, _, names in os.walk(staged) for f in names)
    # one micro-batch per file, each batch counted alone
    assert t.select("batch_id").distinct().count() == n_files
    assert t.groupBy("batch_id").agg(F.countDistinct("day").alias("d")).filter("d > 1").count() == 0
    total = {r.word: r.c for r in t.groupBy("word").agg(F.sum("cnt").alias("c")).collect()}
    assert total == _batch_counts(spark)


def test_custom_state_equals_running(spark):
    staged = SS.stage_lines(spark, SF, scratch_path(spark, "lines"))
    out, chk = scratch_path(spark, "out"), scratch_path(spark, "chk")
    SC.custom_state_counts(SS.text_stream(spark, staged, max_files_per_trigger=5), out, chk)
    got = {r.word: r.c for r in spark.read.parquet(out).groupBy("word").agg(F.max("cnt").alias("c")).collect()}
    assert got == _batch_counts(spark)


def test_replayed_batch_is_not_duplicated(spark):
    from cartwheel.streaming.ingest import json_batch_writer
    msgs = spark.createDataFrame([('{"order_id":"1","user_id":"7"}',), ('{"order_id":"2","user_id":"8"}',),
                                  ("not json",)], "value string")
    out, bad = scratch_path(spark, "ingest"), scratch_path(spark, "bad")
    write = json_batch_writer("20181212", out, bad)
    write(msgs, 3)
    write(msgs, 3)            # the same batch again, as after a failure before commit
    write(msgs.limit(1), 4)
    got = spark.read.option("basePath", out).parquet(out)
    assert got.count() == 3
    assert sorted(r.order_id for r in got.collect()) == ["1", "1", "2"]
    assert spark.read.parquet(bad).count() == 1


def test_processing_time_trigger(spark):
    """the production trigger (a fixed batch interval) instead of availableNow."""
    staged = SS.stage_lines(spark, SF, scratch_path(spark, "lines"))
    out, chk = scratch_path(spark, "out"), scratch_path(spark, "chk")
    q = SC.running_word_counts(SS.text_stream(spark, staged, max_files_per_trigger=10), out, chk,
                               trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r.word: r.cnt for r in SC.latest_counts(spark, out, ["word"]).collect()}
    assert got == _batch_counts(spark)


def test_sliding_windows_survive_restart(spark):
    """Update-mode windows with a watermark, stopped half way and resumed from
    the checkpoint: the change log read back equals the batch aggregate."""
    staged = SS.stage_events(spark, SF, scratch_path(spark, "ev"))
    days = sorted(d for d in os.listdir(staged) if d.startswith("day="))
    live = tempfile.mkdtemp(prefix="live-", dir=os.path.dirname(staged))
    out, chk = scratch_path(spark, "out"), scratch_path(spark, "chk")
    half = len(days) // 2
    for d in days[:half]:
        shutil.copytree(os.path.join(staged, d), os.path.join(live, d))
    SC.sliding_window_counts(SS.event_stream(spark, live), out, chk)
    for d in days[half:]:
        shutil.copytree(os.path.join(staged, d), os.path.join(live, d))
    SC.sliding_window_counts(SS.event_stream(spark, live), out, chk)
    got = SC.latest_counts(spark, out, ["window_start", "window_end", "word"])
    ev = load_table(spark, SF, "events").select(F.col("event_type").alias("word"), F.col("ts").cast("timestamp"))
    want = (ev.groupBy(F.window("ts", "20 seconds", "4 seconds"), "word").agg(F.count("*").alias("cnt"))
            .select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                    F.date_format("window.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"), "word", "cnt"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
