"""Rules that hold at any size: complete windows, split partition values, a
shared folder, typed retention, few exchanges."""

import os
import re

import pytest
from pyspark.sql import functions as F

from cartwheel import session as S
from cartwheel.functions.typed import blank_to_zero, to_whole
from cartwheel.operators import features as FE
from cartwheel.operators import recommend as R
from cartwheel.sinks import tables as SK
from cartwheel.sources import fixtures as FXS
from cartwheel.sources.tables import load_table
from cartwheel.streaming import counts as SC
from cartwheel.streaming import ingest as SI
from cartwheel.streaming import sources as SS

SF = "/root/testdata/sf0.001"


def _windows(spark):
    ev = load_table(spark, SF, "events").select(F.col("event_type").alias("word"), F.col("ts").cast("timestamp"))
    return (ev.groupBy(F.window("ts", "20 seconds", "4 seconds"), "word").agg(F.count("*").alias("cnt"))
            .select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                    F.date_format("window.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"), "word", "cnt"))


def _run_windows(spark, staged, **kw):
    out = S.scratch_path(spark, "w")
    q = SC.sliding_window_counts(SS.event_stream(spark, staged, max_files_per_trigger=5), out, S.scratch_path(spark, "c"), **kw)
    return SC.latest_counts(spark, out, ["window_start", "window_end", "word"]), q


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_windows_are_complete_when_days_come_out_of_order(spark):
    staged = SS.stage_events(spark, SF, S.scratch_path(spark, "ev"))
    days = sorted(d for d in os.listdir(staged) if d.startswith("day="))
    # the file source takes the oldest files first: make the last day the oldest
    for age, day in enumerate(reversed(days)):
        for f in os.listdir(f"{staged}/{day}"):
            os.utime(f"{staged}/{day}/{f}", (1_600_000_000 + age * 60,) * 2)
    got, _ = _run_windows(spark, staged)
    assert _same(got, _windows(spark))
    # with a watermark such rows are dropped, and counted
    got, q = _run_windows(spark, staged, watermark="1 hour")
    assert SC.late_rows(q) > 0 and got.count() < _windows(spark).count()


def test_windows_are_complete_without_coalescing(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        staged = SS.stage_events(spark, SF, S.scratch_path(spark, "ev"))
        assert _same(_run_windows(spark, staged)[0], _windows(spark))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_hot_word_is_counted_before_its_python_group(spark):
    staged = S.scratch_path(spark, "hot")
    spark.range(5000).select(F.lit("a a b").alias("value"), F.lit("d").alias("day")).write.partitionBy("day").text(staged)
    out = S.scratch_path(spark, "o")
    SC.custom_state_counts(SS.text_stream(spark, staged), out, S.scratch_path(spark, "c"))
    assert {r.word: r.cnt for r in SC.latest_counts(spark, out, ["word"]).collect()} == {"a": 10000, "b": 5000}


def test_json_batch_is_parsed_once_and_keeps_null_fields(spark):
    msgs = spark.createDataFrame([('{"order_id":"1","user_id":"7"}',), ('{"user_id":"8"}',), ("no",), (None,)], "value string")
    out, bad = S.scratch_path(spark, "in"), S.scratch_path(spark, "bad")
    write = SI.json_batch_writer("20181212", out, bad)
    write(msgs, 0)
    write(msgs.filter("value is not null"), 0)          # a replay replaces the batch
    rows = spark.read.option("basePath", out).parquet(out).select("order_id", "user_id").collect()
    assert sorted(map(tuple, rows), key=str) == [("1", "7"), (None, "8")]
    assert [r["value"] for r in spark.read.parquet(bad).collect()] == ["no"]


def test_log_numbers_equal_a_plain_row_number(spark, monkeypatch):
    monkeypatch.setattr(FXS, "OFFSET_RUN", 64)
    got = FXS.fx_offsets(spark, SF).groupBy("partition").agg(
        F.min("offset").alias("a"), F.max("offset").alias("b"), F.countDistinct("offset").alias("n")).collect()
    assert all(r["a"] == FXS.OFFSET_BASE + 1 and r["b"] - r["a"] + 1 == r["n"] for r in got) and len(got) == 4


ORDERS = "order_id string, user_id string, eval_set string, order_number string, order_dow string, " \
         "order_hour_of_day string, days_since_prior_order string"
LINES = "order_id string, product_id string, add_to_cart_order string, reordered string"


@pytest.fixture(scope="module")
def gap_tables(spark):
    orders = spark.createDataFrame([("1", "u", "prior", "1", "0", "9", ""), ("2", "u", "prior", "2", "0", "9", "15.0"),
                                    ("3", "u", "train", "3", "0", "9", "21.0")], ORDERS)
    prior = spark.createDataFrame([("1", "p", "1", "0"), ("2", "p", "1", "1")], LINES)
    return orders, prior, spark.createDataFrame([("3", "p", "1", "1")], LINES)


def test_fractional_gaps_count_at_their_value(spark, gap_tables):
    orders, prior, trains = gap_tables
    df = spark.createDataFrame([("",), ("7.0",), ("7.9",), ("x",), (None,), ("1e3",)], "x string")
    assert [r[0] for r in df.select(blank_to_zero("x", "int")).collect()] == [0, 7, 7, 0, 0, 1000]
    assert [r[0] for r in df.select(to_whole("x")).collect()] == [None, 7, 7, None, None, 1000]
    assert FE.user_gap(orders).first()["u_avg_day_gap"] == 12.0
    assert FE.user_gap(orders, blank_as_zero=False).first()["u_avg_day_gap"] == 18.0
    assert FE.user_features(orders, prior).first()["u_avg_day_gap"] == FE.user_features_alt(orders, prior).first()["ds_avg"] == 12.0
    assert {r["order_id"]: r["days_since_ratio"] for r in FE.days_ratio(orders, prior).collect()} == {"1": 0.0, "2": 1.25, "3": 1.75}
    full = {r["order_id"]: r for r in FE.train_matrix_full(orders, prior, trains).collect()}
    assert full["2"]["days_since_ratio"] == 1.25 and full["2"]["u_avg_day_gap"] == 12.0 and full["2"]["label"] == 1


def test_train_matrix_full_moves_the_lines_once(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o, p, t = (FXS.load(spark, SF, n) for n in ("fx_orders", "fx_prior", "fx_trains"))
        plan = FE.train_matrix_full(o, p, t)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(re.findall("Exchange hashpartitioning", plan)) <= 9
    assert "CartesianProduct" not in plan


def test_hot_partition_value_is_written_by_several_tasks(spark):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        path = S.scratch_path(spark, "hot")
        df = spark.range(60_000, numPartitions=8).select(F.md5(F.col("id").cast("string")).alias("x"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("dt"))
        SK.insert_partitioned(df, path, ["dt"], mode="overwrite")
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert len([f for f in os.listdir(f"{path}/dt=a") if f.endswith(".parquet")]) > 1
    assert SK.read_partitioned(spark, path).count() == 60_000


def test_retention_sorts_typed_values_and_ignores_the_null_partition(spark):
    path = S.scratch_path(spark, "snap")
    df = spark.createDataFrame([(i, str(i % 12)) for i in range(24)] + [(99, None)], "id int, day string")
    SK.insert_partitioned(df, path, ["day"], mode="overwrite")
    assert sorted(map(int, SK.drop_old_partitions(spark, path, "day", keep=7))) == [0, 1, 2, 3, 4]
    left = spark.read.option("basePath", path).parquet(path)
    assert left.filter("day is null").count() == 1 and left.select("day").distinct().count() == 8


def test_buckets_are_one_sorted_file_each(spark):
    path = S.scratch_path(spark, "bk")
    SK.bucketed_save(FXS.fx_ratings(spark, SF), f"bk_{os.getpid()}", path, 4, "user_id")
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 4


class _Context:
    master, applicationId = "spark://host:7077", "app"

    def getCheckpointDir(self):
        return None


class _Session:
    sparkContext = _Context()

    class conf:
        get = staticmethod(lambda key, default=None: default)


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.shared_dir(_Session())


def test_scratch_is_released(spark, monkeypatch):
    root = S.scratch_path(spark, "probe-root")
    monkeypatch.setattr(S, "_scratch_root", lambda s: root)
    S.cut_lineage(spark.range(3), "probe")
    assert os.listdir(root)
    S.release_scratch(spark)
    assert not os.path.exists(root)


def test_pairs_are_made_once_and_mirrored_without_a_second_pass(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = R.cosine(FXS.load(spark, SF, "fx_ratings"), block=8)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan
    # one union of small and cut items, and one (u, v) aggregate: partial and final
    assert plan.count("Union") == 1 and plan.count("functions=[sum((ra") == 1 and plan.count("functions=[partial_sum((ra") == 1


def test_global_sort_is_range_partitioned(spark, registry):
    df = registry["cf_recommend_sorted"].fn(spark, SF)
    assert "rangepartitioning" in df._jdf.queryExecution().executedPlan().toString()
    rows = [(-r["sum_score"], r["user_id"], r["item_id"]) for r in df.collect()]
    assert rows == sorted(rows) and len(rows) > 100


def test_kafka_options():
    direct = SS.kafka_options("h:1,h:2", ["a", "b"], starting_offsets='{"a":{"0":3}}')
    assert direct == {"kafka.bootstrap.servers": "h:1,h:2", "subscribe": "a,b", "startingOffsets": '{"a":{"0":3}}'}
    receiver = SS.kafka_options("h:1", "t.*", subscribe_pattern=True, group_id="g")
    assert receiver == {"kafka.bootstrap.servers": "h:1", "subscribePattern": "t.*", "kafka.group.id": "g"}


def test_socket_reader_options(spark):
    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def option(self, key, value):
            self.seen[key] = value
            return self

        def load(self):
            return self.seen

    class Session:
        readStream = Reader()

    assert SS.socket_stream(Session(), "host", 9, with_time=True) == {
        "format": "socket", "host": "host", "port": 9, "includeTimestamp": "true"}
