"""Keyed cell table (K9), snapshots as differences (K7), sample by bucket."""

import os

import pytest
from pyspark.sql import functions as F

from cartwheel.session import scratch_path
from cartwheel.sinks import keyed as KV
from cartwheel.sinks import snapshots as SN
from cartwheel.sinks import tables as SK

CELLS = "row_key string, family string, qualifier string, value string, version long"


def test_puts_merge_delete_and_compact(spark):
    root = scratch_path(spark, "cells")
    first = [(f"k{i:03d}", "f", "q", f"v{i}", 1) for i in range(100)]
    KV.create(spark, root, spark.createDataFrame(first, CELLS), regions=4)
    assert KV.read(spark, root).count() == 0
    batches = [first, [("k001", "f", "q", "new", 2), ("k002", "f", "q", None, 2), ("k003", "f", "q", "late", 0), ("a", "f", "q", "low", 1)],
               [("k001", "f", "q", "tie", 2), ("k004", "f", "q", None, 9), ("k004", "g", "q", "", 1)]]
    want = {}
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, CELLS)
        assert KV.put(df, root, n) and not KV.put(df, root, n)
        for k, f, q, v, ver in rows:
            if (k, f, q) not in want or ver >= want[k, f, q][1]:
                want[k, f, q] = (v, ver)
    want = {k: v for k, v in want.items() if v[0] is not None}
    for _ in range(2):
        got = {tuple(r)[:3]: tuple(r)[3:] for r in KV.read(spark, root).collect()}
        assert got == want
        assert {r["row_key"] for r in KV.read(spark, root, "k010", "k020").collect()} == {f"k0{i}" for i in range(10, 20)}
        KV.compact(spark, root)
    assert os.listdir(f"{root}/cells") == ["part=upto-000000000002"] and not KV.put(spark.createDataFrame(first, CELLS), root, 1)
    with pytest.raises(Exception, match="row key"):
        KV.put(spark.createDataFrame([(None, "f", "q", "v", 1)], CELLS), root, 7)


def test_range_reads_open_their_regions_only(spark):
    root = scratch_path(spark, "cells")
    cells = spark.range(4000).select(F.format_string("%05d", "id").alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
                                     F.lit("v").alias("value"), F.lit(1).alias("version"))
    KV.create(spark, root, cells, regions=8)
    KV.put(cells, root, 0)
    rows = KV.stored(spark, root, "00100", "00200")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan and "GreaterThanOrEqual(row_key,00100)" in plan
    assert rows.select("region").distinct().count() == 1 and rows.count() == 100
    assert KV.stored(spark, root).select("region").distinct().count() == 8


def test_snapshots_rebuild_every_kept_day(spark):
    root = scratch_path(spark, "days")
    tables = {}
    for d in range(10):
        rows = [(k, f"v{(k * d) // 7}" if (k + d) % 5 else None) for k in range(300) if (k + d) % 11]
        tables[f"{d:02d}"] = sorted(rows, key=repr)
        SN.add_day(spark.createDataFrame(rows, "k long, v string"), root, f"{d:02d}", ["k"], keep=4)
        SN.add_day(spark.createDataFrame(rows, "k long, v string"), root, f"{d:02d}", ["k"], keep=4)      # again
    assert SN.days(spark, root) == ["06", "07", "08", "09"] and os.listdir(f"{root}/base") == ["day=06"]
    for d in SN.days(spark, root):
        assert sorted(map(tuple, SN.rebuild(spark, root, d, ["k"]).collect()), key=repr) == tables[d]
    with pytest.raises(ValueError):
        SN.rebuild(spark, root, "05", ["k"])
    with pytest.raises(ValueError):
        SN.add_day(spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string"), root, "10", ["k"])
    same = spark.createDataFrame(tables["09"], "k long, v string")
    SN.add_day(same, root, "10", ["k"], keep=4)
    assert spark.read.parquet(f"{root}/changes/day=10").count() == 0


@pytest.mark.parametrize("out_of", [1, 2, 3, 4, 8])
def test_sample_reads_its_bucket_only(spark, out_of):
    path = scratch_path(spark, "sampled")
    rows = spark.range(-50, 50).select(F.col("id").alias("k"), F.lit("x").alias("v")).unionByName(spark.sql("select cast(null as bigint) k, 'n' v"))
    SK.save_sampled(rows, path, "k", 4)
    seen = []
    for bucket in range(1, out_of + 1):
        got = SK.read_sample(spark, path, "k", 4, bucket, out_of)
        ids = [r["k"] for r in got.collect()]
        assert all((k or 0) % out_of == bucket - 1 for k in ids)
        seen += ids
        if out_of in (4, 8):
            folders = {r["f"].split("bucket_no=")[1].split("/")[0] for r in got.select(F.input_file_name().alias("f")).collect()}
            assert folders == {str((bucket - 1) % 4)} and "PartitionFilters: [isnotnull(bucket_no" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, seen)) == sorted(str(r["k"]) for r in rows.collect())
