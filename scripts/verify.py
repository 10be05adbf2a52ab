"""Run a catalog query in Spark and its oracle SQL in DuckDB and compare them
order-insensitively (row count, column names and kinds, values)."""

from __future__ import annotations

import math
import os
import time

from cartwheel.sources.tables import TABLES, table_path


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


# Exact float comparison when set (the engines must agree to the last bit).
STRICT = os.environ.get("ORACLE_STRICT", "0") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if STRICT else round(v, 5)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)) or (hasattr(v, "tolist") and not isinstance(v, (str, bytes))):
        return tuple(_norm(x) for x in (v.tolist() if hasattr(v, "tolist") else v))
    if isinstance(v, bool):
        return int(v)
    return v


# Spark type -> the DuckDB type of the same width and kind.
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    try:   # the executed (final adaptive) plan, for plan-shape assertions
        res["plan"] = sdf._jdf.queryExecution().executedPlan().toString()
    except Exception:  # noqa: BLE001 - a plan string is optional
        res["plan"] = ""
    if not sql:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} oracle={sorted(d_cols)}")
    else:
        kinds = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
        if kinds:
            problems.append(f"types {kinds}")
        if len(s_rows) != len(d_rows):
            problems.append("row count")
        else:
            a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                problems.append(f"values differ e.g. {diff}")
    res["status"] = "ok" if not problems else "FAIL: " + "; ".join(problems)
    return res
