"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import cut_lineage, scratch_path, shared_dir  # noqa: F401  (re-exported)


def ship(module_name: str) -> None:
    """Pickle a module's functions by value, so executors need no installed copy."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so a task works on at most ``rows`` rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_arrow(df: DataFrame, schema: str, fn: Callable, rows: int = 2000) -> DataFrame:
    """``fn(list of column lists) -> dict of output columns`` over row slices."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out_schema = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        work = fn()
        for part in slices(batches, rows):
            out = work(*[c.to_pylist() for c in part.columns])
            if out is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in out_schema], schema=out_schema)

    return df.mapInArrow(run, schema)


class Memo(dict):
    """``memo[key]`` computes and keeps ``fn(key)``; the table is emptied at ``limit``
    entries, so its memory is bounded (values never change, only speed does)."""

    def __init__(self, fn: Callable, limit: int = 200_000):
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.fn(key)
        return value
