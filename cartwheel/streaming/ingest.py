"""JSON message ingest into a partitioned table (F7, K5) and offset
bookkeeping of a partitioned message log (F8, F9)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .counts import run

ORDER_MESSAGE = T.StructType([T.StructField("order_id", T.StringType()),
                              T.StructField("user_id", T.StringType())])


def parse_json(df: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON text -> typed columns plus ``_bad`` (no JSON object, or a
    field of the wrong type) for quarantine. A valid message may lack fields."""
    corrupt = "_corrupt"
    p = F.from_json(F.col(column), T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]),
                    {"columnNameOfCorruptRecord": corrupt})
    return df.select("*", p.alias("_m")).select(
        *df.columns, *[F.col(f"_m.{f.name}").alias(f.name) for f in schema.fields],
        (F.col("_m").isNull() | F.col(f"_m.{corrupt}").isNotNull()).alias("_bad"))


def json_batch_writer(dt: str, out: str, quarantine: str):
    """The per-batch sink of ``ingest_json``: the batch is read and parsed once
    and written once, to ``<staged>/bad=...``; good rows are then taken as
    ``out/dt=<dt>/batch_id=<id>`` and unparsable ones as
    ``quarantine/batch_id=<id>`` by moving the folders. A replayed batch
    replaces what it wrote."""
    cols = [f.name for f in ORDER_MESSAGE.fields]

    def write(batch: DataFrame, batch_id: int) -> None:
        jvm, jsc = batch.sparkSession.sparkContext._jvm, batch.sparkSession.sparkContext._jsc
        path = jvm.org.apache.hadoop.fs.Path
        staged = f"{quarantine}-staged/batch_id={batch_id}"
        parsed = parse_json(batch, ORDER_MESSAGE).withColumn("value", F.when(F.col("_bad"), F.col("value")))
        parsed.select(*cols, "value", F.col("_bad").alias("bad")).write.mode("overwrite").partitionBy("bad").parquet(staged)
        fs = path(staged).getFileSystem(jsc.hadoopConfiguration())
        for flag, target in (("false", f"{out}/dt={dt}/batch_id={batch_id}"), ("true", f"{quarantine}/batch_id={batch_id}")):
            fs.delete(path(target), True)
            if fs.exists(path(f"{staged}/bad={flag}")):
                fs.mkdirs(path(target).getParent())
                fs.rename(path(f"{staged}/bad={flag}"), path(target))

    return write


def ingest_json(messages: DataFrame, dt: str, out: str, quarantine: str, checkpoint: str,
                trigger: dict | None = None):
    """Parse each message, stamp the load date ``dt`` and append the
    batch to partition dt=...; rows that do not parse go to ``quarantine``.
    Each batch lands in its own folder, overwritten on replay, so a retried
    batch never duplicates rows."""
    return run(messages.writeStream.foreachBatch(json_batch_writer(dt, out, quarantine)), checkpoint, trigger)


def offset_ranges(log: DataFrame) -> DataFrame:
    """F8: per (topic, partition) the [from, until) offset range of a batch."""
    return log.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"))


def audit_offsets(log: DataFrame, out: str, checkpoint: str, trigger: dict | None = None):
    """F8 on a stream: every micro-batch writes the offset ranges it consumed
    per (topic, partition) to its own folder (idempotent on replay)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (offset_ranges(batch).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}"))
    return run(log.writeStream.foreachBatch(write), checkpoint, trigger)


def start_positions(log: DataFrame, committed: DataFrame, default: str = "latest", whole_topic: bool = True) -> DataFrame:
    """(topic, partition, start). start = committed offset clamped to the
    partition's [earliest, end]. ``whole_topic`` (default): if any partition of a
    topic has no commit, the lookup failed and the whole topic starts at
    ``default`` ('latest': the end of the log, or 'earliest'); otherwise only
    that partition does. One row per topic-partition."""
    bounds = offset_ranges(log).withColumnRenamed("from_offset", "low").withColumnRenamed("until_offset", "high")
    c = bounds.join(committed.select("topic", "partition", "committed"), ["topic", "partition"], "left")
    missing = F.col("committed").isNull()
    if whole_topic:
        missing = F.max(missing).over(Window.partitionBy("topic"))
    # least/greatest skip NULLs: a missing commit has its own branch
    return c.select("topic", "partition", F.when(missing, F.col("low" if default == "earliest" else "high")).otherwise(
        F.greatest(F.col("low"), F.least(F.col("committed"), F.col("high")))).alias("start"))


def starting_offsets(starts: DataFrame) -> str:
    """The start table as the JSON a Kafka source takes, so the broker skips what
    is before it. One entry per topic-partition."""
    out: dict[str, dict[str, int]] = {}
    for r in starts.collect():
        out.setdefault(r["topic"], {})[str(r["partition"])] = r["start"]
    return json.dumps(out, sort_keys=True)


def resume_from(log: DataFrame, committed: DataFrame, default: str = "latest", whole_topic: bool = True) -> DataFrame:
    """F9 on a stored log: the records at or after each partition's start. The
    start table has one row per topic-partition - bounded by the topic's
    partition count, which is what makes the broadcast safe."""
    starts = start_positions(log, committed, default, whole_topic)
    return (log.join(F.broadcast(starts), ["topic", "partition"])
            .filter(F.col("offset") >= F.col("start")).drop("start"))
