"""Hand-sized cases: typed helpers under ANSI mode, the reference's worked
examples (pivot row, per-day average), and label / cell / resume rules."""

import json

from pyspark.sql import functions as F

from cartwheel.functions.typed import blank_to_zero, hour_gap, plus_columns, safe_ratio, to_int
from cartwheel.operators import analytics as A
from cartwheel.operators import recommend as R
from cartwheel.sinks.tables import to_cells
from cartwheel.sources.corpus import label_from_path
from cartwheel.streaming.ingest import resume_from, start_positions, starting_offsets

ORDER_COLS = "order_id string, user_id string, eval_set string, order_number string, order_dow string, " \
             "order_hour_of_day string, days_since_prior_order string"


def test_blank_and_garbage_do_not_raise(spark):
    df = spark.createDataFrame([("",), ("7",), ("7.0",), ("abc",), (None,)], "x string")
    out = [r[0] for r in df.select(blank_to_zero("x")).collect()]
    assert out == [0.0, 7.0, 7.0, 0.0, 0.0]
    assert [r[0] for r in df.select(to_int("x")).collect()] == [None, 7, None, None, None]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_safe_ratio_and_plus(spark):
    df = spark.createDataFrame([(1.0, 0.0, "2", "3"), (3.0, 2.0, "x", "1")], "a double, b double, c string, d string")
    r = df.select(safe_ratio("a", "b").alias("r"), plus_columns("c", "d").alias("p")).collect()
    assert r[0]["r"] is None and r[1]["r"] == 1.5
    assert r[0]["p"] == 5 and r[1]["p"] is None


def test_hour_gap(spark):
    df = spark.createDataFrame([(10, 8), (1, 23), (23, 1), (5, None)], "h int, l int")
    rows = df.select(hour_gap("h", "l").alias("g"), hour_gap("h", "l", circular=True).alias("c")).collect()
    assert [r["g"] for r in rows] == [2, -22, 2, None]
    assert [r["c"] for r in rows] == [2, 2, 2, None]


def test_pivot_example(spark):
    # user 1: one order on dow 2, two on dow 3, five on dow 4
    rows = [(str(i), "1", "prior", str(i), d, "10", "") for i, d in enumerate(["2"] + ["3"] * 2 + ["4"] * 5)]
    o = spark.createDataFrame(rows, ORDER_COLS)
    r = A.dow_pivot(o).first()
    assert [r[f"dow_{d}"] for d in range(7)] == [0, 0, 1, 2, 5, 0, 0]


def test_per_day_average_example(spark):
    # day 1: two orders with 10 and 15 products; day 2: one order with 12 -> (25 + 12) / 2
    o = spark.createDataFrame([("1", "u", "prior", "1", "0", "9", "1"), ("2", "u", "prior", "2", "0", "9", "1"),
                               ("3", "u", "prior", "3", "0", "9", "2")], ORDER_COLS)
    lines = [(oid, str(p), "1", "0") for oid, n in (("1", 10), ("2", 15), ("3", 12)) for p in range(n)]
    p = spark.createDataFrame(lines, "order_id string, product_id string, add_to_cart_order string, reordered string")
    assert A.per_day_ratio(o, p).first()["day_cnt"] == 18.5
    assert A.per_day_nested(o, p).first()["avg_day_prod_cnt"] == 18.5


def test_seen_item_removed(spark):
    r = spark.createDataFrame([(1, 10, 5), (1, 11, 3), (2, 10, 4), (2, 12, 5), (2, 11, 1)],
                              "user_id long, item_id long, rating int")
    sim = R.cosine(r).withColumnRenamed("cosine_sim", "sim")
    s = R.item_scores(sim, r).filter("user_id = 1").collect()
    assert [(x.item_id) for x in s] == [12]
    assert abs(s[0].score - 5 * (23 / ((34 ** 0.5) * (42 ** 0.5)))) < 1e-12


def test_cells_last_write_wins(spark):
    df = spark.createDataFrame([("u1", "o1", "3", 1), ("u1", "o2", "5", 2)], "user_id string, order_id string, dow string, v int")
    cells = {(r.family, r.qualifier): r.value
             for r in to_cells(df, "user_id", [("id", "order", "order_id"), ("num", "dow", "dow")], "v").collect()}
    assert cells == {("id", "order"): "o2", ("num", "dow"): "5"}


def test_label_rules_first_match(spark):
    df = spark.createDataFrame([("a/sports/business.txt",), ("x/auto",), ("x/edit",), ("zzz",)], "p string")
    assert [r[0] for r in df.select(label_from_path(F.col("p"))).collect()] == ["business", "auto", "it", "unknown"]


def test_resume_clamps_and_defaults(spark):
    log = spark.createDataFrame([("t", p, o, "v") for p in range(4) for o in range(100, 110)],
                                "topic string, partition int, offset long, value string")
    committed = spark.createDataFrame([("t", 0, 5), ("t", 1, 999), ("t", 2, 105)],
                                      "topic string, partition int, committed long")
    def kept(**rule):
        return {p: n for p, n in resume_from(log, committed, **rule).groupBy("partition").count().collect()}

    # partition 1's commit lies past the end; partition 3 has none
    assert kept(default="earliest", whole_topic=False) == {0: 10, 2: 5, 3: 10}
    assert kept(default="latest", whole_topic=False) == {0: 10, 2: 5}
    # the whole-topic rule: one missing commit sends every partition to the default
    assert kept() == {}
    assert kept(default="earliest") == {0: 10, 1: 10, 2: 10, 3: 10}
    full = committed.union(spark.createDataFrame([("t", 3, 108)], committed.schema))
    assert {p: n for p, n in resume_from(log, full).groupBy("partition").count().collect()} == {0: 10, 2: 5, 3: 2}
    starts = start_positions(log, committed, whole_topic=False)
    assert json.loads(starting_offsets(starts)) == {"t": {"0": 100, "1": 110, "2": 105, "3": 110}}


def test_shared_folder_follows_session_setting(spark):
    from cartwheel.session import cut_lineage, scratch_path, shared_dir
    base = shared_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured and base == configured.rstrip("/")
    assert scratch_path(spark, "x").startswith(f"{base}/cartwheel-{spark.sparkContext.applicationId}/x-")
    df = cut_lineage(spark.range(10), "probe")
    assert df.count() == 10
    assert any(base in f for f in df.inputFiles())


def test_drop_old_partitions(spark):
    import os

    from cartwheel.session import scratch_path
    from cartwheel.sinks.tables import drop_old_partitions, insert_partitioned, read_partitioned
    path = scratch_path(spark, "snap")
    df = spark.createDataFrame([(i, f"2018082{i % 9}") for i in range(90)], "id int, dt string")
    insert_partitioned(df, path, ["dt"], mode="overwrite")
    dropped = drop_old_partitions(spark, path, "dt", keep=7)
    assert sorted(dropped) == ["20180820", "20180821"]
    assert sorted(d for d in os.listdir(path) if d.startswith("dt=")) == [f"dt=2018082{i}" for i in range(2, 9)]
    assert read_partitioned(spark, path, ["dt"]).count() == 70


def test_scored_rows_query_counts_for_the_split_only():
    from cartwheel.plans.registry import load_all

    assert load_all()["lr_scored_rows"].ops == ("C5",)
