"""Streaming counts (F1-F6, F10, K11) on Structured Streaming.

Every sink is ``foreachBatch`` writing a distributed table: each micro-batch
writes its own ``batch_id=`` folder, overwritten if the batch is replayed
after a failure (idempotent). Stateful queries run in update mode, so a batch
writes only the keys it changed (an append-only change log read back with
``latest_counts``); with a watermark, event-time windows leave the state store
once it passes them. Offsets and state live in the checkpoint, so a stopped
or crashed query resumes where it left off.
"""

from __future__ import annotations

import sys

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Functions of this module run inside Python workers. They are pickled by
# value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# Trigger used when none is given: process what is there, then stop.
AVAILABLE_NOW = {"availableNow": True}


def words_of(lines: DataFrame, keep: tuple[str, ...] = ("day",)) -> DataFrame:
    """One row per space-separated word of ``value``, keeping ``keep`` columns."""
    return lines.select(*keep, F.explode(F.split("value", " ")).alias("word"))


def run(query_writer, checkpoint: str, trigger: dict | None = None, timeout_s: int | None = None):
    """Start a stream writer with a checkpoint and a trigger (F10: e.g.
    {'processingTime': '2 seconds'}); with the default trigger wait for it,
    for as long as its input takes unless ``timeout_s`` is given."""
    q = query_writer.option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW)).start()
    if (trigger or AVAILABLE_NOW) == AVAILABLE_NOW:
        q.awaitTermination(*([] if timeout_s is None else [timeout_s]))
        if q.isActive:
            q.stop()
            raise TimeoutError("stream did not finish")
        if q.exception():
            raise q.exception()
    return q


def _batch_dir_writer(out: str, build):
    def write(batch: DataFrame, batch_id: int) -> None:
        build(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return write


def per_batch_word_counts(lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None):
    """F1 + K11: word counts of each micro-batch alone (no state), one output
    folder per batch."""
    build = lambda b: words_of(b).groupBy("day", "word").agg(F.count(F.lit(1)).alias("cnt"))
    return run(lines.writeStream.foreachBatch(_batch_dir_writer(out, build)), checkpoint, trigger)


def per_batch_line_counts(lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None):
    """F2: whole-line counts of each micro-batch."""
    build = lambda b: b.groupBy("day", F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("cnt"))
    return run(lines.writeStream.foreachBatch(_batch_dir_writer(out, build)), checkpoint, trigger)


def _overwrite_writer(out: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)
    return write


def latest_counts(spark, out: str, keys: list[str], value: str = "cnt") -> DataFrame:
    """Read an update-mode output folder: every batch folder holds the keys it
    changed with their new totals; totals only grow, so the current value of
    a key is its maximum over the batch folders."""
    return spark.read.parquet(out).groupBy(*keys).agg(F.max(value).alias(value))


def running_word_counts(lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                        output_mode: str = "update"):
    """counts over everything seen so far (state never expires). In
    update mode (default) each batch writes only the words whose count
    changed - the cost of a batch follows the batch, not the vocabulary; read
    with ``latest_counts``. ``output_mode='complete'`` rewrites the whole
    table each batch instead (small vocabularies)."""
    counts = words_of(lines, ()).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    if output_mode == "complete":
        return run(counts.writeStream.outputMode("complete").foreachBatch(_overwrite_writer(out)),
                   checkpoint, trigger)
    return run(counts.writeStream.outputMode("update").foreachBatch(_batch_dir_writer(out, lambda b: b)),
               checkpoint, trigger)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of one task, emitted batch by batch."""
    for batch in batches:
        counts = batch.column(0).value_counts()
        yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], names=["word", "n"])


def _add_counts(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """F4 state function: new total = sum of this batch's values + old total."""
    new = sum(int(p["n"].sum()) for p in pdfs)
    old = state.get[0] if state.exists else 0
    state.update((old + new,))
    yield pd.DataFrame({"word": [key[0]], "cnt": [old + new]})


def custom_state_counts(lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None):
    """the same running count through a user state function
    (``applyInPandasWithState``); the state per word is one long. Updated
    words are appended per batch and the latest total per word is read back
    with ``max`` (totals only grow)."""
    # A word's occurrences are counted in the task that reads them: its Python
    # group gets one row an Arrow batch, also for a hot word.
    w = words_of(lines, ()).mapInArrow(_count_words, "word string, n long")
    upd = w.groupBy("word").applyInPandasWithState(
        _add_counts, "word string, cnt long", "cnt long", "update", GroupStateTimeout.NoTimeout)
    return run(upd.writeStream.outputMode("update").foreachBatch(_batch_dir_writer(out, lambda b: b)),
               checkpoint, trigger)


def late_rows(query) -> int:
    """Rows a finished or running query has dropped as later than its
    watermark, summed over the progress reports Spark still holds."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def sliding_window_counts(events: DataFrame, out: str, checkpoint: str, length: str = "20 seconds",
                          slide: str = "4 seconds", watermark: str | None = None, trigger: dict | None = None):
    """counts per (sliding window, word) in event time, update mode: each
    batch writes the windows it changed; read with
    ``latest_counts(.., ["window_start", "window_end", "word"])``.

    Without a ``watermark`` every window stays open, so the counts are complete
    in whatever order the input arrives; this is the mode for replaying stored
    input, whose windows are as many as the result has. A stream without end
    needs a ``watermark``: windows older than it leave the state store, rows
    that come later than it are dropped, and ``late_rows`` tells how many."""
    if watermark:
        events = events.withWatermark("ts", watermark)
    agg = (events.groupBy(F.window("ts", length, slide), "word").agg(F.count(F.lit(1)).alias("cnt"))
           .select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                   F.date_format("window.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"), "word", "cnt"))
    return run(agg.writeStream.outputMode("update").foreachBatch(_batch_dir_writer(out, lambda b: b)),
               checkpoint, trigger)
