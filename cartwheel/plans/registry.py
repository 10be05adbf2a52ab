"""Registry of named queries: a Spark callable plus, where SQL can say the same
thing, the oracle SQL the driver runs on DuckDB for comparison."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .fixtures_sql import with_fx


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...]        # SURVEY section 2 rows this query covers
    bench: bool = False         # part of bench.py's headline set


REGISTRY: dict[str, Query] = {}


def query(name: str, *, sql: str | None = None, fx: tuple[str, ...] = (),
          ops: tuple[str, ...] = (), bench: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` runs against the raw test tables; ``fx`` names the fixture CTEs
    it needs (prepended automatically)."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, with_fx(sql, *fx) if sql else None, ops, bench)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the catalog modules fills the registry.
    from . import warehouse, features, recommend, text_models, segment_q, sinks_q, streams_q, ml_q, linear_q, clusters_q  # noqa: F401
    return REGISTRY
