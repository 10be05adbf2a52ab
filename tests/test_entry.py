"""The driver contract in __spark_entry__.py."""

import re

import __spark_entry__ as E

TABLES = {"region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"}


def test_contract_shapes():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 120 and len(sql) >= 110
    assert all(callable(f) for f in q.values())


def test_oracle_reads_only_given_tables():
    ctes = re.compile(r"(?:WITH(?:\s+RECURSIVE)?|,)\s*([a-z_0-9]+)(?:\([a-z_0-9, ]+\))?\s+AS\s*(?:MATERIALIZED\s*)?\(", re.I)
    for name, text in E.oracle_sql().items():
        defined = set(ctes.findall(text))
        used = set(re.findall(r"\b(?:FROM|JOIN)\s+([a-z_][a-z_0-9]*)\b(?!\s*\()", text, re.I))
        unknown = {u for u in used if u.lower() not in TABLES and u not in defined}
        assert not unknown, (name, unknown)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "top_3_prods"]
    assert df.count() > 0

