"""Physical-plan properties that matter at scale."""

from pyspark.sql import functions as F

from cartwheel.operators import analytics as A
from cartwheel.session import scratch_path
from cartwheel.sinks import tables as SK
from cartwheel.sources import fixtures as FXS
from cartwheel.sources.tables import load_table

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark):
    li = load_table(spark, SF, "lineitem").filter(F.col("l_quantity") > 10).select("l_orderkey")
    p = _plan(li)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p


def test_partition_pruning(spark):
    path = scratch_path(spark, "ev")
    e = load_table(spark, SF, "events").select("event_id", F.date_format("ts", "yyyyMMdd").alias("dt"))
    SK.insert_partitioned(e, path, ["dt"], mode="overwrite")
    df = SK.read_partitioned(spark, path, ["dt"]).filter(F.col("dt").between("20240105", "20240111"))
    assert "PartitionFilters: [isnotnull(dt" in _plan(df)


def test_top_n_uses_window_group_limit(spark):
    o, p = FXS.fx_orders(spark, SF), FXS.fx_prior(spark, SF)
    df = A.user_top_products(o, p, 3)
    assert "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString()


def test_bucketed_tables_join_without_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = FXS.fx_ratings(spark, SF)
        a = SK.bucketed_save(r, "bk_a", scratch_path(spark, "bk_a"), 4, "user_id")
        b = SK.bucketed_save(r.select("user_id", F.col("rating").alias("r2")), "bk_b",
                             scratch_path(spark, "bk_b"), 4, "user_id")
        j = a.join(b, "user_id")
        j._jdf.queryExecution().executedPlan()  # plan it
        phys = j._jdf.queryExecution().sparkPlan().toString()
        assert "Exchange" not in phys
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_cartesian_products_in_catalog(spark, registry):
    heavy = ["cf_recommend_topk", "nb_predict", "auc", "train_matrix_full", "feat_user", "resume_from_offsets"]
    for name in heavy:
        p = _plan(registry[name].fn(spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
