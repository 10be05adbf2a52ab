"""Catalog: file sources, table sinks and table maintenance.

Each query writes its table below the session's shared folder, reads it back
and returns what was read, so the oracle checks the round trip."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.typed import to_int
from ..session import scratch_path
from ..sinks import keyed as KV
from ..sinks import snapshots as SN
from ..sinks import tables as SK
from ..sources import fixtures as FXS
from ..sources import corpus as CP
from ..sources.corpus import LABEL_RULES, UNKNOWN_LABEL
from ..sources.tables import delimited_load, external_table, load_table, text_lines
from .registry import query

ORDER_COLS = FXS.ORDER_COLUMNS


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _events_by_day(spark, sf):
    """Events written as a daily-partitioned table (dt = yyyyMMdd)."""
    path = scratch_path(spark, "events_dt")
    e = load_table(spark, sf, "events").select(
        "event_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("dt"))
    SK.insert_partitioned(e, path, ["dt"], mode="overwrite")
    return SK.read_partitioned(spark, path, ["dt"])


@query("delimited_load", ops=("S2",), fx=("fx_orders",), sql="SELECT * FROM fx_orders")
def q_delimited_load(spark, sf):
    path = scratch_path(spark, "orders_csv")
    SK.save_delimited(FXS.load(spark, sf, "fx_orders"), path, ",")
    return delimited_load(spark, path, ORDER_COLS, ",")


@query("delimited_load_tab", ops=("S2",), fx=("fx_ratings",), sql="""
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id,
       CAST(rating AS VARCHAR) AS rating FROM fx_ratings""")
def q_delimited_load_tab(spark, sf):
    """The ratings table as tab-separated text, every column read back as a
    string (the warehouse DDL of the ratings table)."""
    path = scratch_path(spark, "udata_tsv")
    SK.save_delimited(FXS.load(spark, sf, "fx_ratings"), path, "\t")
    return delimited_load(spark, path, "user_id item_id rating", "\t")


@query("text_lines", ops=("S3",), sql="""
SELECT unnest(string_split(text, chr(10))) AS sentence FROM documents""")
def q_text_lines(spark, sf):
    path = scratch_path(spark, "article")
    SK.save_text(load_table(spark, sf, "documents"), path, F.col("text"))
    return text_lines(spark, path, "sentence")


@query("external_table", ops=("S4",), fx=("fx_ratings",), sql="""
SELECT user_id, item_id, rating FROM fx_ratings""")
def q_external_table(spark, sf):
    path = scratch_path(spark, "ext")
    SK.overwrite(FXS.load(spark, sf, "fx_ratings"), path)
    return external_table(spark, _name("ext"), path)


_LABEL_SQL = "CASE " + " ".join(f"WHEN host LIKE '%{r}%' THEN '{r}'" for r in LABEL_RULES) + f" ELSE '{UNKNOWN_LABEL}' END"


@query("corpus_ingest", ops=("S5", "X13", "X14"), sql=f"""
SELECT page_id, replace(replace(html, chr(10), ''), ' ', '') AS sentence, {_LABEL_SQL} AS label,
       replace(html, chr(10), '') AS segs
FROM (SELECT page_id, html, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host FROM pages) p""")
def q_corpus_ingest(spark, sf):
    """Pages stored one file per page under host=/page_id= folders, then
    ingested recursively as whole files."""
    root = scratch_path(spark, "corpus")
    p = load_table(spark, sf, "pages").select(
        "page_id", "html", F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1).alias("host"))
    passes = p.count() // CP.FILES_A_PASS + 1
    if passes == 1:
        return _ingested(spark, p, f"{root}/pages")
    # Beyond that many files, pages are written and ingested in passes, dealt by id, so that the
    # driver never holds the names of all files.
    for i in range(passes):
        part = p.filter(F.pmod(F.xxhash64("page_id"), F.lit(passes)) == i)
        _ingested(spark, part, f"{root}/pages{i}").write.mode("append").parquet(f"{root}/ingested")
    return spark.read.parquet(f"{root}/ingested")


def _ingested(spark, pages, root):
    SK.save_files(pages, root, ["host", "page_id"], "page_id")
    c = CP.read_corpus(spark, root)
    return c.select(F.regexp_extract("path", r"page_id=(\d+)", 1).cast("bigint").alias("page_id"),
                    "sentence", "label", "segs")


@query("partition_range_scan", ops=("S6",), sql="""
SELECT event_id, event_type, strftime(ts, '%Y%m%d') AS dt FROM events
WHERE strftime(ts, '%Y%m%d') BETWEEN '20240105' AND '20240111'""")
def q_partition_range_scan(spark, sf):
    return _events_by_day(spark, sf).filter(F.col("dt").between("20240105", "20240111"))


@query("snapshot_retention", ops=("K7",), sql="""
SELECT event_id, event_type, strftime(ts, '%Y%m%d') AS dt FROM events
WHERE strftime(ts, '%Y%m%d') IN (SELECT DISTINCT strftime(ts, '%Y%m%d') AS d FROM events ORDER BY d DESC LIMIT 7)""")
def q_snapshot_retention(spark, sf):
    """Daily snapshot partitions, keep the newest 7: older partition folders
    are dropped, then the table is read back."""
    path = scratch_path(spark, "events_dt")
    e = load_table(spark, sf, "events").select(
        "event_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("dt"))
    SK.insert_partitioned(e, path, ["dt"], mode="overwrite")
    SK.drop_old_partitions(spark, path, "dt", keep=7)
    return SK.read_partitioned(spark, path, ["dt"])


@query("overwrite_readback", ops=("K1",), fx=("fx_orders",), sql="SELECT * FROM fx_orders")
def q_overwrite_readback(spark, sf):
    o = FXS.load(spark, sf, "fx_orders")
    name, path = _name("orders_tbl"), scratch_path(spark, "orders_tbl")
    SK.save_as_table(o.withColumn("order_number", F.lit("0")), name, path)
    t = SK.save_as_table(o, name, path)   # overwrite
    return t.select(*ORDER_COLS)


@query("ctas_readback", ops=("K2",), fx=("fx_ratings",), sql="""
SELECT user_id, item_id, rating FROM fx_ratings WHERE ((user_id % 4) + 4) % 4 = 0""")
def q_ctas_readback(spark, sf):
    view = _name("udata")
    FXS.load(spark, sf, "fx_ratings").createOrReplaceTempView(view)
    return SK.ctas(spark, _name("tmp1"), scratch_path(spark, "tmp1"),
                   f"SELECT user_id, item_id, rating FROM {view} WHERE pmod(user_id, 4) = 0")


@query("static_partition_overwrite", ops=("K3",), sql="""
SELECT doc_id, lang, '20180821' AS dt FROM documents
UNION ALL SELECT doc_id, lang, '20180822' AS dt FROM documents WHERE lang = 'en'""")
def q_static_partition_overwrite(spark, sf):
    path = scratch_path(spark, "art_dt")
    d = load_table(spark, sf, "documents").select("doc_id", "lang")
    both = d.withColumn("dt", F.lit("20180821")).unionByName(d.withColumn("dt", F.lit("20180822")))
    SK.insert_partitioned(both, path, ["dt"], mode="overwrite")
    SK.overwrite_partitions(d.filter(F.col("lang") == "en").withColumn("dt", F.lit("20180822")), path, ["dt"])
    return SK.read_partitioned(spark, path, ["dt"]).select("doc_id", "lang", "dt")


def _order_part(spark, sf):
    path = scratch_path(spark, "order_part")
    SK.insert_partitioned(FXS.load(spark, sf, "fx_orders"), path, ["order_dow"], mode="overwrite")
    return SK.read_partitioned(spark, path, ["order_dow"])


@query("dynamic_partition_insert", ops=("K4",), fx=("fx_orders",), sql="SELECT * FROM fx_orders")
def q_dynamic_partition_insert(spark, sf):
    return _order_part(spark, sf).select(*ORDER_COLS)


@query("list_partitions", ops=("K6",), fx=("fx_orders",), sql="""
SELECT order_dow, count(*) AS rows FROM fx_orders GROUP BY order_dow""")
def q_list_partitions(spark, sf):
    return SK.list_partitions(_order_part(spark, sf), "order_dow")


@query("bucketed_write", ops=("K8",), fx=("fx_ratings",), sql="SELECT user_id, item_id, rating FROM fx_ratings")
def q_bucketed_write(spark, sf):
    return SK.bucketed_save(FXS.load(spark, sf, "fx_ratings"), _name("bucket_users"),
                            scratch_path(spark, "bucket_users"), 4, "user_id")


@query("wide_column_cells", ops=("K9", "O3"), fx=("fx_orders",), sql="""
SELECT user_id AS row_key, 'id' AS family, 'order' AS qualifier,
       arg_max(order_id, CAST(order_number AS INTEGER)) AS value FROM fx_orders GROUP BY user_id
UNION ALL
SELECT user_id, 'num', 'dow', arg_max(order_dow, CAST(order_number AS INTEGER)) FROM fx_orders GROUP BY user_id""")
def q_wide_column_cells(spark, sf):
    o = FXS.load(spark, sf, "fx_orders").withColumn("version", to_int("order_number"))
    cells = SK.to_cells(o, "user_id", [("id", "order", "order_id"), ("num", "dow", "order_dow")], "version")
    path = scratch_path(spark, "hcells")
    SK.overwrite(cells, path)
    return spark.read.parquet(path)


@query("script_transform", ops=("V8",), sql="""
SELECT CAST(event_id AS VARCHAR) AS event_id, upper(event_type) AS kind FROM events""")
def q_script_transform(spark, sf):
    """V8: rows through an external command, Spark's own TRANSFORM ... USING;
    each task pipes its rows through one process."""
    view = _name("events")
    load_table(spark, sf, "events").select("event_id", "event_type").createOrReplaceTempView(view)
    return spark.sql(f"SELECT TRANSFORM(event_id, event_type) USING 'tr a-z A-Z' AS (event_id STRING, kind STRING) FROM {view}")


@query("text_save", ops=("K10",), fx=("fx_orders",), sql="""
SELECT '(' || user_id || ',(' || order_number || ',' || order_hour_of_day || '))' AS value FROM fx_orders""")
def q_text_save(spark, sf):
    o = FXS.load(spark, sf, "fx_orders")
    line = F.concat(F.lit("("), F.col("user_id"), F.lit(",("), F.col("order_number"), F.lit(","),
                    F.col("order_hour_of_day"), F.lit("))"))
    path = scratch_path(spark, "pairs_txt")
    SK.save_text(o, path, line)
    return spark.read.text(path)


_CELLS = [("id", "order", "order_id"), ("num", "dow", "order_dow")]


def put_in_batches(spark, orders, root):
    """Three overlapping batches of puts, newer versions before older ones; the second is
    replayed, and a compaction lies between."""
    cells = KV.cell_rows(orders.withColumn("v", to_int("order_number")), "user_id", _CELLS, "v").withColumn("part", F.col("version") % 3)
    KV.create(spark, root, cells, regions=8)
    for batch, part in enumerate((2, 0, 1)):
        KV.put(cells.filter(F.col("part") == part).drop("part"), root, batch)
        if batch == 1:
            KV.put(cells.filter(F.col("part") == part).drop("part"), root, batch)
            KV.compact(spark, root)


@query("wide_column_upserts", ops=("K9",), fx=("fx_orders",), sql="""
SELECT user_id AS row_key, 'id' AS family, 'order' AS qualifier, max(CAST(order_number AS BIGINT)) AS version,
       arg_max(order_id, CAST(order_number AS INTEGER)) AS value FROM fx_orders GROUP BY user_id
UNION ALL
SELECT user_id, 'num', 'dow', max(CAST(order_number AS BIGINT)), arg_max(order_dow, CAST(order_number AS INTEGER)) FROM fx_orders GROUP BY user_id""")
def q_wide_column_upserts(spark, sf):
    root = scratch_path(spark, "cells")
    put_in_batches(spark, FXS.load(spark, sf, "fx_orders"), root)
    return KV.read(spark, root)


@query("wide_column_range", ops=("K9",), fx=("fx_orders",), sql="""
SELECT user_id AS row_key, arg_max(order_id, CAST(order_number AS INTEGER)) AS value FROM fx_orders
WHERE user_id >= '2' AND user_id < '4' GROUP BY user_id""")
def q_wide_column_range(spark, sf):
    """A range of row keys, read from its regions only."""
    root = scratch_path(spark, "cells")
    put_in_batches(spark, FXS.load(spark, sf, "fx_orders"), root)
    return KV.read(spark, root, "2", "4").filter("family = 'id'").select("row_key", "value")


@query("snapshot_rebuild", ops=("K7",), sql="""
WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events ORDER BY day DESC LIMIT 7)
SELECT strftime(d.day, '%Y%m%d') AS dt, user_id, count(*) AS n, max(event_id) AS last_event
FROM events e JOIN days d ON CAST(e.ts AS DATE) BETWEEN d.day - 2 AND d.day GROUP BY d.day, user_id""")
def q_snapshot_rebuild(spark, sf):
    """Nine daily snapshots of the users active in the last three days, stored as changes;
    each of the seven that are kept, rebuilt."""
    root = scratch_path(spark, "snapshots")
    e = load_table(spark, sf, "events").select("event_id", "user_id", F.to_date("ts").alias("day"))
    newest = sorted(r["day"] for r in e.select("day").distinct().orderBy(F.desc("day")).limit(9).collect())
    for day in newest:
        now = e.filter(F.col("day").between(F.date_sub(F.lit(day), 2), F.lit(day)))
        SN.add_day(now.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event")), root, f"{day:%Y%m%d}", ["user_id"])
    kept = [SN.rebuild(spark, root, d, ["user_id"]).withColumn("dt", F.lit(d)) for d in SN.days(spark, root)]
    return reduce(DataFrame.unionByName, kept)
