"""state per word that starts from a table, expires, and can be read back.

``expiring_counts`` keeps a count per word (value state), its occurrences by day (map state)
and one timer: a word not seen for ``idle`` of event time leaves the state, with its last count
as a result row. ``state_rows`` reads the state of a stopped or running query from its
checkpoint with Spark's state reader.

Needs the RocksDB state store, set for these queries only. The task that reads rows counts
them by (word, day) per Arrow batch, so a hot word reaches its state as a few rows a task.
Rows later than the watermark are counted too: a word that comes again after it has left starts anew.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .counts import _batch_dir_writer, run

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "word string, cnt long, days long, last_ms long, expired boolean"


class ExpiringCounts(StatefulProcessor):
    """State of a word: total and time last seen, occurrences by day, a timer at last + idle."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "cnt long, last_ms long")
        self.by_day = handle.getMapState("by_day", "day string", "n long")

    def _remind(self, last_ms: int) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at[0] if isinstance(at, tuple) else at)
        self.handle.registerTimer(last_ms + self.idle_ms)

    def _add(self, rows: Iterator[pd.DataFrame]) -> tuple[int, int]:
        cnt, last = self.total.get() if self.total.exists() else (0, -1)
        for pdf in rows:
            for day, n in pdf.groupby("day")["n"].sum().items():
                old = self.by_day.getValue((day,))[0] if self.by_day.containsKey((day,)) else 0
                self.by_day.updateValue((day,), (old + int(n),))
            cnt, last = cnt + int(pdf["n"].sum()), max(last, int(pdf["ms"].max()))
        self.total.update((cnt, last))
        self._remind(last)
        return cnt, last

    def _row(self, key, cnt: int, last: int, expired: bool) -> pd.DataFrame:
        days = sum(1 for _ in self.by_day.keys())
        return pd.DataFrame({"word": [key[0]], "cnt": [cnt], "days": [days], "last_ms": [last], "expired": [expired]})

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._add([initialState])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        cnt, last = self._add(rows)
        yield self._row(key, cnt, last, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        cnt, last = self.total.get()
        yield self._row(key, cnt, last, True)
        self.total.clear()
        self.by_day.clear()

    def close(self) -> None:
        """Nothing is held open."""


@contextmanager
def rocksdb(spark: SparkSession):
    """The RocksDB state store for queries started inside."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def _by_day(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = pa.Table.from_batches([batch]).group_by(["word", "day"]).aggregate([("ms", "max"), ("ms", "count")])
        yield from sums.select(["word", "day", "ms_max", "ms_count"]).rename_columns(["word", "day", "ms", "n"]).combine_chunks().to_batches()


def day_counts(events: DataFrame) -> DataFrame:
    """(word, ts) rows as partial (word, day, ms = last time, n) of a task."""
    days = events.select("word", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.unix_millis("ts").alias("ms")).filter("ms is not null")
    return days.mapInArrow(_by_day, "word string, day string, ms long, n long")


def expiring_counts(events: DataFrame, out: str, checkpoint: str, idle: str = "7 days", delay: str = "0 seconds",
                    initial: DataFrame | None = None, trigger: dict | None = None):
    """Counts per word over (word, ts) rows; rows without a time are left out. ``initial``: (word,
    ts) rows of a batch table that the state starts from, read at the first start only. Every
    batch writes the words it changed and those that expired."""
    first = None
    if initial is not None:
        first = day_counts(initial).groupBy("word", "day").agg(F.max("ms").alias("ms"), F.sum("n").alias("n")).groupBy("word")
    rows = day_counts(events.withWatermark("ts", delay))
    counted = rows.groupBy("word").transformWithStateInPandas(
        ExpiringCounts(int(pd.Timedelta(idle) / pd.Timedelta("1ms"))), OUT, "Update", "EventTime", initialState=first)
    with rocksdb(events.sparkSession):
        return run(counted.writeStream.outputMode("update").foreachBatch(_batch_dir_writer(out, lambda b: b)), checkpoint, trigger)


def latest_rows(spark: SparkSession, out: str) -> DataFrame:
    """Each word's last result row over all batches."""
    last = F.max_by(F.struct("cnt", "days", "last_ms", "expired"), F.struct("batch_id", "expired"))
    return spark.read.parquet(out).groupBy("word").agg(last.alias("r")).select("word", "r.*")


def state_rows(spark: SparkSession, checkpoint: str, **options) -> DataFrame:
    """the state kept in a checkpoint as (key, value, partition_id) rows. ``options`` of the
    state reader: batchId, operatorId, stateVarName and others."""
    return spark.read.format("statestore").options(**options).load(checkpoint)
