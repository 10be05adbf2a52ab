"""The log source's own offsets (S10, S11) and state that expires."""

from datetime import datetime

from pyspark.sql import functions as F

from cartwheel.session import scratch_path
from cartwheel.streaming import counts as SC
from cartwheel.streaming import log_source as SL
from cartwheel.streaming import state as ST


def _append(spark, path, spans):
    rows = [(p, o, f"{p}:{o}") for p, low, high in spans for o in range(low, high)]
    df = spark.createDataFrame(rows, "partition int, offset long, value string")
    df.repartition(3).write.mode("append").partitionBy("partition").parquet(path)


def _read(spark, path, out, chk, **options):
    s = SL.direct_stream(spark, path, "t", **options)
    return SL.drain(s.writeStream.foreachBatch(SC._batch_dir_writer(out, lambda b: b)), chk)


def _offsets(spark, out):
    return sorted((r["partition"], r["offset"]) for r in spark.read.parquet(out).collect())


def test_direct_stream_restarts_without_loss_or_repeats(spark):
    path, out, chk, com = (scratch_path(spark, n) for n in ("log", "out", "chk", "com"))
    _append(spark, path, [(0, 5, 105), (1, 0, 30)])
    assert _read(spark, path, out, chk, rows_per_partition=20, rows_per_task=7, commits=com) == 4
    sizes = spark.read.parquet(out).groupBy("batch_id", "partition").count().collect()
    assert max(r["count"] for r in sizes) == 20
    _append(spark, path, [(0, 105, 140), (1, 30, 31), (2, 900, 950)])       # partition 2 is new
    _read(spark, path, out, chk, rows_per_partition=20, rows_per_task=7, commits=com)
    want = [(0, o) for o in range(5, 140)] + [(1, o) for o in range(31)] + [(2, o) for o in range(900, 950)]
    assert _offsets(spark, out) == want
    # the checkpoint is lost: a new query goes on from the committed offsets
    _append(spark, path, [(1, 31, 40)])
    out2 = scratch_path(spark, "out")
    _read(spark, path, out2, scratch_path(spark, "chk"), commits=com)
    assert _offsets(spark, out2) == [(1, o) for o in range(31, 40)]


def test_starting_offsets_are_clamped(spark):
    path = scratch_path(spark, "log")
    _append(spark, path, [(0, 5, 25), (1, 0, 10), (2, 3, 6)])
    out = scratch_path(spark, "out")
    _read(spark, path, out, scratch_path(spark, "chk"), starting_offsets='{"0": 20, "1": 99}')
    assert _offsets(spark, out) == [(0, o) for o in range(20, 25)] + [(2, o) for o in range(3, 6)]
    assert SL.LogReader({"path": path, "startingoffsets": "latest"}).initialOffset() == {"0": 25, "1": 10, "2": 6}
    assert [(r.partition, r.start, r.end) for r in SL.ranges({"0": 3}, {"0": 8, "4": 9, "from:4": 7}, 4)] == [(0, 3, 7), (0, 7, 8), (4, 7, 9)]


def test_idle_words_leave_the_state(spark):
    src, out, chk = (scratch_path(spark, n) for n in ("ev", "out", "chk"))
    schema = "word string, ts timestamp"

    def feed(rows):
        spark.createDataFrame([(w, datetime(2024, 1, d)) for w, d in rows], schema).coalesce(1).write.mode("append").parquet(src)
        ST.expiring_counts(spark.readStream.schema(schema).parquet(src), out, chk, idle="3 days", initial=first)

    first = spark.createDataFrame([("old", datetime(2024, 1, 1)), ("kept", datetime(2024, 1, 2))], schema)
    feed([("kept", 3), ("kept", 3), ("new", 2)])
    state = {r["key"]["word"]: r["value"]["cnt"] for r in ST.state_rows(spark, chk, stateVarName="total").collect()}
    assert state == {"old": 1, "kept": 3, "new": 1}
    feed([("kept", 5)])
    feed([("kept", 6), ("new", 6)])     # 'old' and 'new' were idle for three days
    got = {(r["word"], r["cnt"], r["days"]) for r in spark.read.parquet(out).filter("expired").collect()}
    assert ("old", 1, 1) in got
    state = {r["key"]["word"]: r["value"]["cnt"] for r in ST.state_rows(spark, chk, stateVarName="total").collect()}
    assert state["kept"] == 5 and "old" not in state
    last = {r["word"]: (r["cnt"], r["expired"]) for r in ST.latest_rows(spark, out).collect()}
    assert last["old"] == (1, True) and last["kept"] == (5, False)
    assert spark.conf.get(ST.PROVIDER) != ST.ROCKSDB
