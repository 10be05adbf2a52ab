"""Catalog: Structured Streaming jobs (F1-F9, S12-S13, K5, K11) and JSON parsing.

Each streaming query stages its input from the test tables as files, runs a
real streaming query to completion (``availableNow``), and returns the
sink's table read back. The oracle is the SQL of the same batch aggregate."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources import fixtures as FXS
from ..sources.tables import load_table
from ..streaming import counts as SC
from ..streaming import ingest as SI
from ..streaming import log_source as SL
from ..streaming import sources as SS
from ..streaming import state as ST
from .registry import query

WORDS_SQL = """(SELECT ts, unnest(string_split(event_type || ' ' || CAST(user_id AS VARCHAR), ' ')) AS word FROM events)"""

# Commit positions used by the resume query (partition -> committed offset):
# one below the earliest offset, one past the latest, one inside, and
# partition 3 without a commit.
COMMITTED = [(FXS.OFFSET_TOPIC, 0, 5), (FXS.OFFSET_TOPIC, 1, 999999), (FXS.OFFSET_TOPIC, 2, 150)]
INGEST_DT = "20181212"


def _lines(spark, sf):
    src = SS.stage_lines(spark, sf, scratch_path(spark, "lines"))
    return SS.text_stream(spark, src)


def _read_batches(spark, out):
    return spark.read.parquet(out).drop("batch_id")


@query("stream_batch_wordcount", ops=("F1", "S13", "K11"), sql=f"""
SELECT strftime(ts, '%Y-%m-%d') AS day, word, count(*) AS cnt FROM {WORDS_SQL} w GROUP BY 1, 2""")
def q_stream_batch_wordcount(spark, sf):
    out = scratch_path(spark, "wc_batches")
    SC.per_batch_word_counts(_lines(spark, sf), out, scratch_path(spark, "chk"))
    # a day may be read in several batches, each with its own counts
    return _read_batches(spark, out).groupBy("day", "word").agg(F.sum("cnt").alias("cnt"))


@query("stream_line_count", ops=("F2",), sql="""
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type || ' ' || CAST(user_id AS VARCHAR) AS line, count(*) AS cnt
FROM events GROUP BY 1, 2""")
def q_stream_line_count(spark, sf):
    out = scratch_path(spark, "lc_batches")
    SC.per_batch_line_counts(_lines(spark, sf), out, scratch_path(spark, "chk"))
    return _read_batches(spark, out).groupBy("day", "line").agg(F.sum("cnt").alias("cnt"))


@query("stream_running_count", ops=("F3",), sql=f"""
SELECT word, count(*) AS cnt FROM {WORDS_SQL} w GROUP BY word""")
def q_stream_running_count(spark, sf):
    out = scratch_path(spark, "wc_running")
    SC.running_word_counts(_lines(spark, sf), out, scratch_path(spark, "chk"))
    return SC.latest_counts(spark, out, ["word"])


@query("stream_custom_state", ops=("F4", "V10"), sql=f"""
SELECT word, count(*) AS cnt FROM {WORDS_SQL} w GROUP BY word""")
def q_stream_custom_state(spark, sf):
    out = scratch_path(spark, "wc_state")
    SC.custom_state_counts(_lines(spark, sf), out, scratch_path(spark, "chk"))
    return SC.latest_counts(spark, out, ["word"])


@query("stream_sliding_count", ops=("F5",), sql="""
SELECT strftime(make_timestamp(s), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(make_timestamp(s + 20000000), '%Y-%m-%d %H:%M:%S') AS window_end, word, count(*) AS cnt
FROM (SELECT event_type AS word, (epoch_us(ts) - epoch_us(ts) % 4000000) - 4000000 * i AS s
      FROM events CROSS JOIN range(5) r(i)) w
GROUP BY s, word""")
def q_stream_sliding_count(spark, sf):
    src = SS.stage_events(spark, sf, scratch_path(spark, "events_stream"))
    out = scratch_path(spark, "sliding")
    SC.sliding_window_counts(SS.event_stream(spark, src), out, scratch_path(spark, "chk"))
    return SC.latest_counts(spark, out, ["window_start", "window_end", "word"])


@query("stream_json_append", ops=("F7", "K5"), fx=("fx_offsets",), sql=f"""
SELECT json_extract_string(value, '$.order_id') AS order_id, json_extract_string(value, '$.user_id') AS user_id,
       '{INGEST_DT}' AS dt FROM fx_offsets""")
def q_stream_json_append(spark, sf):
    src = SS.stage_messages(spark, sf, scratch_path(spark, "messages"))
    msgs = spark.readStream.schema("value string").text(src)
    out, bad = scratch_path(spark, "order_partition"), scratch_path(spark, "quarantine")
    SI.ingest_json(msgs, INGEST_DT, out, bad, scratch_path(spark, "chk"))
    t = spark.read.option("basePath", out).parquet(out)
    return t.select("order_id", "user_id", F.col("dt").cast("string").alias("dt"))


@query("json_extract", ops=("X16",), sql="""
SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def q_json_extract(spark, sf):
    e = load_table(spark, sf, "events").select("event_id", "props")
    p = SI.parse_json(e, T.StructType([T.StructField("k", T.IntegerType())]), "props")
    return p.select("event_id", "k")


@query("offset_ranges", ops=("F8",), fx=("fx_offsets",), sql="""
SELECT topic, "partition", min("offset") AS from_offset, max("offset") + 1 AS until_offset
FROM fx_offsets GROUP BY topic, "partition\"""")
def q_offset_ranges(spark, sf):
    return SI.offset_ranges(FXS.load(spark, sf, "fx_offsets"))


_COMMITTED_SQL = " UNION ALL ".join(f"SELECT '{t}' AS topic, {p} AS \"partition\", CAST({o} AS BIGINT) AS committed"
                                    for t, p, o in COMMITTED)


def _resume_sql(missing: str, default: str) -> str:
    return f"""
WITH c AS ({_COMMITTED_SQL}),
b AS (SELECT topic, "partition", min("offset") AS low, max("offset") + 1 AS high FROM fx_offsets GROUP BY 1, 2),
s AS (SELECT b.topic, b."partition",
             CASE WHEN {missing} THEN b.{default} ELSE GREATEST(b.low, LEAST(c.committed, b.high)) END AS start
      FROM b LEFT JOIN c ON b.topic = c.topic AND b."partition" = c."partition")
SELECT l.topic, l."partition", l."offset", l.value FROM fx_offsets l
JOIN s ON l.topic = s.topic AND l."partition" = s."partition" WHERE l."offset" >= s.start"""


def _resume(spark, sf, **rule):
    committed = spark.createDataFrame(COMMITTED, "topic string, partition int, committed long")
    return SI.resume_from(FXS.load(spark, sf, "fx_offsets"), committed, **rule).select("topic", "partition", "offset", "value")


@query("resume_from_offsets", ops=("F9",), fx=("fx_offsets",), sql=_resume_sql("c.committed IS NULL", "low"))
def q_resume_from_offsets(spark, sf):
    """A partition without a commit starts at its earliest offset by itself."""
    return _resume(spark, sf, default="earliest", whole_topic=False)


@query("resume_whole_topic", ops=("F9",), fx=("fx_offsets",),
       sql=_resume_sql("bool_or(c.committed IS NULL) OVER (PARTITION BY b.topic)", "low"))
def q_resume_whole_topic(spark, sf):
    """A partition without a commit sends its whole topic to the default start, here the earliest offset."""
    return _resume(spark, sf, default="earliest")


@query("resume_at_end", ops=("F9",), fx=("fx_offsets",), sql="""
SELECT topic, "partition", max("offset") + 1 AS start FROM fx_offsets GROUP BY topic, "partition\"""")
def q_resume_at_end(spark, sf):
    """The default rule: without all commits, every partition starts at the end of the log."""
    committed = spark.createDataFrame(COMMITTED, "topic string, partition int, committed long")
    return SI.start_positions(FXS.load(spark, sf, "fx_offsets"), committed)


@query("stream_dir_wordcount", ops=("S13",), sql=f"""
SELECT word, count(*) AS cnt FROM {WORDS_SQL} w GROUP BY word""")
def q_stream_dir_wordcount(spark, sf):
    """New files of a directory as a text stream, several files per
    micro-batch; the per-batch counts summed over all batch outputs."""
    src = SS.stage_lines(spark, sf, scratch_path(spark, "lines"))
    out = scratch_path(spark, "dir_wc")
    SC.per_batch_word_counts(SS.text_stream(spark, src, max_files_per_trigger=7), out, scratch_path(spark, "chk"))
    return spark.read.parquet(out).groupBy("word").agg(F.sum("cnt").alias("cnt"))


@query("stream_batch_files", ops=("K11",), sql=f"""
SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT word) AS groups FROM {WORDS_SQL} w GROUP BY 1""")
def q_stream_batch_files(spark, sf):
    """One output folder per micro-batch, one input file a batch; per day,
    the number of word groups that its folders hold."""
    out = scratch_path(spark, "batch_files")
    src = SS.stage_lines(spark, sf, scratch_path(spark, "lines"))
    SC.per_batch_word_counts(SS.text_stream(spark, src, max_files_per_trigger=1), out, scratch_path(spark, "chk"))
    return spark.read.parquet(out).groupBy("day").agg(F.countDistinct("word").alias("groups"))


@query("stream_sliding_count_2s", ops=("F5",), sql="""
SELECT strftime(make_timestamp(s), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(make_timestamp(s + 20000000), '%Y-%m-%d %H:%M:%S') AS window_end, word, count(*) AS cnt
FROM (SELECT event_type AS word, (epoch_us(ts) - epoch_us(ts) % 2000000) - 2000000 * i AS s
      FROM events CROSS JOIN range(10) r(i)) w
GROUP BY s, word""")
def q_stream_sliding_count_2s(spark, sf):
    """F5 second variant: 20 s windows sliding every 2 s."""
    src = SS.stage_events(spark, sf, scratch_path(spark, "events_stream"))
    out = scratch_path(spark, "sliding2")
    SC.sliding_window_counts(SS.event_stream(spark, src), out, scratch_path(spark, "chk"), slide="2 seconds")
    return SC.latest_counts(spark, out, ["window_start", "window_end", "word"])


@query("stream_offset_audit", ops=("F8",), fx=("fx_offsets",), sql="""
SELECT topic, "partition", min("offset") AS from_offset, max("offset") + 1 AS until_offset
FROM fx_offsets GROUP BY topic, "partition\"""")
def q_stream_offset_audit(spark, sf):
    """F8 per micro-batch: one file of the log a batch; each batch writes the
    ranges it consumed, and the ranges of all batches cover the log."""
    src = SS.stage_log(spark, sf, scratch_path(spark, "log"))
    out = scratch_path(spark, "offset_audit")
    SI.audit_offsets(SS.log_stream(spark, src, max_files_per_trigger=1), out, scratch_path(spark, "chk"))
    return spark.read.parquet(out).groupBy("topic", "partition").agg(
        F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset"))


HALF = "2024-01-16"     # the day at which streams that stop and go on are cut


@query("stream_direct_log", ops=("S10", "S11", "F10"), fx=("fx_offsets",), sql="""
SELECT topic, "partition", "offset", value FROM fx_offsets""")
def q_stream_direct_log(spark, sf):
    """The log by ranges of offsets, at a fixed interval; the query is stopped, more of the log
    arrives, and a second start goes on from the checkpoint."""
    out, chk, commits = (scratch_path(spark, n) for n in ("direct", "chk", "commits"))
    path = scratch_path(spark, "log")
    cut = FXS.load(spark, sf, "fx_offsets").agg(F.max("offset")).first()[0] // 2
    for where, mode in ((f"offset < {cut}", "overwrite"), (f"offset >= {cut}", "append")):
        SS.stage_log(spark, sf, path, where, mode)
        log = SL.direct_stream(spark, path, FXS.OFFSET_TOPIC, rows_per_partition=50_000, commits=commits)
        SL.drain(log.writeStream.foreachBatch(SC._batch_dir_writer(out, lambda b: b)), chk, "1 second")
    return spark.read.parquet(out).select("topic", "partition", "offset", "value")


@query("stream_recovered_state", ops=("F6",), sql=f"""
SELECT word, count(*) AS cnt FROM {WORDS_SQL} w GROUP BY word""")
def q_stream_recovered_state(spark, sf):
    """A running count that stops after half of the input and is started again; the result
    is read from the state store of its checkpoint."""
    src, out, chk = (scratch_path(spark, n) for n in ("lines", "wc_running", "chk"))
    for where, mode in ((f"day < '{HALF}'", "overwrite"), (f"day >= '{HALF}'", "append")):
        SS.stage_lines(spark, sf, src, where, mode)
        SC.running_word_counts(SS.text_stream(spark, src), out, chk)
    return ST.state_rows(spark, chk).select("key.word", F.col("value.count").alias("cnt"))


@query("stream_state_from_table", ops=("F3", "F4", "V10"), sql="""
SELECT event_type AS word, count(*) AS cnt, count(DISTINCT CAST(ts AS DATE)) AS days, max(epoch_us(ts) // 1000) AS last_ms
FROM events GROUP BY event_type""")
def q_stream_state_from_table(spark, sf):
    """State with timers that starts from the table of the first days and goes on with the rest."""
    old = load_table(spark, sf, "events").select(F.col("event_type").alias("word"), F.col("ts").cast("timestamp").alias("ts"))
    src, out = SS.stage_events(spark, sf, scratch_path(spark, "events_stream")), scratch_path(spark, "state_out")
    new = SS.event_stream(spark, src).filter(F.col("ts") >= F.lit(HALF).cast("timestamp"))
    ST.expiring_counts(new, out, scratch_path(spark, "chk"), idle="3650 days", initial=old.filter(F.col("ts") < F.lit(HALF).cast("timestamp")))
    return ST.latest_rows(spark, out).select("word", "cnt", "days", "last_ms")
