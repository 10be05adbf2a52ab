"""Stream sources (S10-S13) and staging of test streams from the given tables.

Production streams come from Kafka (or any Structured Streaming source);
the connector jar is not on this image's classpath, so ``kafka_stream`` only
builds the reader and tests drive the same operators from file streams that
Spark itself derives from the test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import fixtures as FXS
from ..sources.tables import load_table

LINE_SCHEMA = T.StructType([T.StructField("value", T.StringType()), T.StructField("day", T.StringType())])
EVENT_SCHEMA = T.StructType([T.StructField("word", T.StringType()), T.StructField("ts", T.TimestampType())])


def kafka_options(bootstrap: str, topics: str | list[str], starting_offsets: str | None = None,
                  subscribe_pattern: bool = False, group_id: str | None = None) -> dict[str, str]:
    """The source's options. ``starting_offsets`` ('latest', 'earliest' or a
    JSON table, see ``ingest.starting_offsets``) holds for a query's first start
    only; without it the source begins at the end of the topic."""
    topics = ",".join(topics) if isinstance(topics, list) else topics
    out = {"kafka.bootstrap.servers": bootstrap, "subscribePattern" if subscribe_pattern else "subscribe": topics}
    if starting_offsets:
        out["startingOffsets"] = starting_offsets
    if group_id:
        out["kafka.group.id"] = group_id
    return out


def kafka_stream(spark: SparkSession, bootstrap: str, topics: str | list[str], **options) -> DataFrame:
    """Messages of one or more topics as (topic, partition, offset,
    value string). Offsets are tracked by the query's checkpoint, which
    replaces the external offset store of the receiver / direct styles;
    ``group_id`` sets the consumer group (receiver style)."""
    r = spark.readStream.format("kafka").options(**kafka_options(bootstrap, topics, **options))
    return r.load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def socket_stream(spark: SparkSession, host: str, port: int, with_time: bool = False) -> DataFrame:
    """Lines of text from a socket (``value``, and ``timestamp`` on
    arrival if ``with_time``). Spark's socket source reads on the driver and
    can't replay: use it to try a job out."""
    return (spark.readStream.format("socket").option("host", host).option("port", port)
            .option("includeTimestamp", str(with_time).lower()).load())


def _files(spark: SparkSession, schema: T.StructType, max_files_per_trigger: int | None):
    """A file source; by default a batch takes as many files as there are new."""
    r = spark.readStream.schema(schema)
    return r.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else r


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New text files in a directory, one line per row. Folders named
    day=... add a ``day`` column."""
    return _files(spark, LINE_SCHEMA, max_files_per_trigger).text(path)


def event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Event-time stream (word, ts) from parquet files."""
    return _files(spark, EVENT_SCHEMA, max_files_per_trigger).parquet(path)


def stage_lines(spark: SparkSession, sf_dir: str, path: str, where: str = "true", mode: str = "overwrite") -> str:
    """Write the word stream as text: one line 'event_type user_id' per event
    under day=yyyy-MM-dd; a large day is several files, written by several tasks.
    ``where`` picks days, for input that arrives in parts (mode 'append')."""
    e = load_table(spark, sf_dir, "events").select(
        F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("value"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"))
    e.filter(where).hint("rebalance", "day").write.mode(mode).partitionBy("day").text(path)
    return path


def stage_events(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Write (word = event_type, ts as TIMESTAMP) as parquet under day=..., as
    ``stage_lines`` does."""
    e = load_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("word"), F.col("ts").cast("timestamp").alias("ts"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"))
    e.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(path)
    return path


LOG_SCHEMA = T.StructType([T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
                           T.StructField("offset", T.LongType()), T.StructField("value", T.StringType())])


def stage_log(spark: SparkSession, sf_dir: str, path: str, where: str = "true", mode: str = "overwrite") -> str:
    """Write the message log with its coordinates (topic, partition, offset,
    value) as parquet under partition=..., several files for a large one."""
    log = FXS.load(spark, sf_dir, "fx_offsets").filter(where)
    log.hint("rebalance", "partition").write.mode(mode).partitionBy("partition").parquet(path)
    return path


def log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The staged log as a stream with the same columns a Kafka source has."""
    return _files(spark, LOG_SCHEMA, max_files_per_trigger).parquet(path)


def stage_messages(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Write the message log's JSON values as text lines under partition=..."""
    log = FXS.load(spark, sf_dir, "fx_offsets")
    log.select("value", "partition").hint("rebalance", "partition").write.mode("overwrite") \
        .partitionBy("partition").text(path)
    return path
