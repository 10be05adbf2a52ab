"""A partitioned message log as a stream that keeps its own offsets.

A Spark Python data source over the stored log: Parquet files of (offset, value) below
``partition=<n>`` folders, as ``sources.stage_log`` writes them. A micro-batch is a range
of offsets per partition, at most ``rowsPerPartition`` rows of each, and every range is one
task, cut further at ``rowsPerTask``. Offsets are consecutive within a partition; a range
with gaps is only shorter.

Options: ``path``; ``topic``; ``startingOffsets`` ('earliest', 'latest' or a JSON object
partition -> offset; a partition it lacks starts at its earliest; clamped to what is stored);
``commits``, a folder in the shared storage, holds the offsets read so far
(one small JSON file, replaced at every batch). A new query with the same ``commits`` and a
lost checkpoint goes on from there. With a checkpoint, the checkpoint rules: each batch
is the range it was planned as, also after a restart.

Bounds: the driver looks at Parquet footers only, one pair of offsets a file. A task
streams record batches of its files whose statistics meet its range. New files may appear
at any time; a new partition joins at its earliest offset.

For a broker, ``sources.kafka_stream`` builds Spark's own reader.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Readers run inside Python workers; pickled by value, executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "topic string, partition int, offset long, value string"
FORMAT = "stored_log"
_COLUMNS = ["topic", "partition", "offset", "value"]


class OffsetRange(InputPartition):
    """Offsets [start, end) of a partition."""

    def __init__(self, partition: int, start: int, end: int):
        super().__init__((partition, start, end))
        self.partition, self.start, self.end = partition, start, end


def ranges(start: dict, end: dict, rows_per_task: int) -> list[OffsetRange]:
    """The tasks of a batch: each partition's range, cut at ``rows_per_task``. A partition
    that the start lacks has come up since; ``end`` says where it begins as 'from:<n>'."""
    out = []
    for p, until in sorted((int(k), v) for k, v in end.items() if not k.startswith("from:")):
        at = start.get(str(p), end.get(f"from:{p}", until))
        for low in range(at, until, rows_per_task):
            out.append(OffsetRange(p, low, min(low + rows_per_task, until)))
    return out


class LogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.topic = options["path"], options.get("topic", "log")
        self.starting = options.get("startingoffsets", options.get("startingOffsets", "earliest"))
        self.rows = int(options.get("rowsperpartition", options.get("rowsPerPartition", 0))) or None
        self.task_rows = int(options.get("rowspertask", options.get("rowsPerTask", 1_000_000)))
        self.commits = options.get("commits")
        self.position: dict | None = None

    def _stored(self) -> dict[str, tuple[int, int]]:
        """partition -> (earliest, end), from the files' footers."""
        bounds: dict[str, tuple[int, int]] = {}
        data = ds.dataset(self.path, format="parquet", partitioning=ds.partitioning(pa.schema([("partition", pa.int32())]), flavor="hive"))
        for piece in data.get_fragments():
            p = str(ds.get_partition_keys(piece.partition_expression)["partition"])
            for group in piece.row_groups:
                seen = group.statistics["offset"]
                low, high = bounds.get(p, (seen["min"], seen["max"] + 1))
                bounds[p] = (min(low, seen["min"]), max(high, seen["max"] + 1))
        return bounds

    def _first(self, stored: dict) -> dict:
        if self.starting == "latest":
            return {p: high for p, (_, high) in stored.items()}
        named = {} if self.starting == "earliest" else json.loads(self.starting)
        return {p: max(low, min(named.get(p, low), high)) for p, (low, high) in stored.items()}

    def _committed(self) -> dict | None:
        if not self.commits:
            return None
        files, path = pafs.FileSystem.from_uri(f"{self.commits}/offsets.json")
        if files.get_file_info(path).type == pafs.FileType.NotFound:
            return None
        with files.open_input_stream(path) as f:
            return json.loads(f.read())

    def _commit(self, end: dict) -> None:
        if not self.commits:
            return
        files, folder = pafs.FileSystem.from_uri(self.commits)
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(f"{folder}/offsets.json.new") as f:
            f.write(json.dumps(end).encode())
        files.move(f"{folder}/offsets.json.new", f"{folder}/offsets.json")

    def initialOffset(self) -> dict:
        self.position = self._committed() or self._first(self._stored())
        return dict(self.position)

    def latestOffset(self) -> dict:
        stored = self._stored()
        if self.position is None:       # restarted: the last batch planned, else all that is stored
            self.position = self._committed() or {}
        end = {}
        for p, (low, high) in stored.items():
            at = self.position.get(p, self.position.get(f"from:{p}"))
            if at is None:
                end[f"from:{p}"] = at = low
            elif f"from:{p}" in self.position:
                end[f"from:{p}"] = self.position[f"from:{p}"]
            end[p] = max(at, high if self.rows is None else min(high, at + self.rows))
        return {**self.position, **end}

    def partitions(self, start: dict, end: dict) -> list[OffsetRange]:
        # written before the batch runs, so a restart never offers an earlier end
        self.position = dict(end)
        self._commit(self.position)
        return ranges(start, end, self.task_rows)

    def read(self, part: OffsetRange) -> Iterator[pa.RecordBatch]:
        data = ds.dataset(f"{self.path}/partition={part.partition}", format="parquet")
        for batch in data.to_batches(columns=["offset", "value"], filter=(ds.field("offset") >= part.start) & (ds.field("offset") < part.end)):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([self.topic] * batch.num_rows, pa.string()), pa.array([part.partition] * batch.num_rows, pa.int32()),
                     batch.column("offset").cast(pa.int64()), batch.column("value").cast(pa.string())], names=_COLUMNS)

    def commit(self, end: dict) -> None:
        """Nothing to free: the log is not this reader's to delete."""

    def stop(self) -> None:
        """No connection is held."""


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogReader:
        return LogReader(dict(self.options))


def direct_stream(spark: SparkSession, path: str, topic: str, starting_offsets: str = "earliest", rows_per_partition: int | None = None,
                  rows_per_task: int = 1_000_000, commits: str | None = None) -> DataFrame:
    """The log below ``path`` as (topic, partition, offset, value). Without
    ``rows_per_partition`` a batch takes all there is. Run it with a processingTime trigger
    (``drain`` stops when all is read); availableNow takes a single batch."""
    spark.dataSource.register(LogSource)
    r = spark.readStream.format(FORMAT).option("path", path).option("topic", topic).option("startingOffsets", starting_offsets)
    r = r.option("rowsPerTask", rows_per_task)
    if rows_per_partition:
        r = r.option("rowsPerPartition", rows_per_partition)
    return (r.option("commits", commits) if commits else r).load()


def drain(writer, checkpoint: str, interval: str = "0 seconds") -> int:
    """run at a fixed batch interval until all input is read, then stop; the number of
    the last batch."""
    q = writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()
    try:
        q.processAllAvailable()
        return max([p["batchId"] for p in q.recentProgress if p["numInputRows"]], default=-1)
    finally:
        q.stop()
