"""The FIXTURES.md derivations written in plain SQL (DuckDB dialect) for the oracle.

Independent of the Spark code in ``sources/fixtures.py``: both follow the
written rule, and a mismatch between them shows up in every oracle check.
"""

from __future__ import annotations

# name -> (body, dependencies)
FX: dict[str, tuple[str, tuple[str, ...]]] = {
    "fx_orders_t": ("""
SELECT o_orderkey AS order_id, o_custkey AS user_id,
       CASE WHEN rn < cnt THEN 'prior' WHEN o_custkey % 3 = 0 THEN 'test' ELSE 'train' END AS eval_set,
       rn AS order_number, CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
       CAST(o_orderkey % 24 AS INTEGER) AS order_hour_of_day,
       date_diff('day', prev_day, CAST(o_orderdate AS DATE)) AS days_since_prior_order
FROM (SELECT o_orderkey, o_custkey, o_orderdate,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn,
             count(*) OVER (PARTITION BY o_custkey) AS cnt,
             lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_day
      FROM orders) z""", ()),
    "fx_orders": ("""
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id, eval_set,
       CAST(order_number AS VARCHAR) AS order_number, CAST(order_dow AS VARCHAR) AS order_dow,
       CAST(order_hour_of_day AS VARCHAR) AS order_hour_of_day,
       COALESCE(CAST(days_since_prior_order AS VARCHAR), '') AS days_since_prior_order
FROM fx_orders_t""", ("fx_orders_t",)),
    "fx_lines_t": ("""
SELECT b.l_orderkey AS order_id, b.product_id,
       row_number() OVER (PARTITION BY b.l_orderkey ORDER BY b.first_line, b.product_id) AS add_to_cart_order,
       CASE WHEN row_number() OVER (PARTITION BY o.user_id, b.product_id ORDER BY o.order_number) > 1
            THEN 1 ELSE 0 END AS reordered,
       o.user_id, o.eval_set
FROM (SELECT l_orderkey, l_partkey % products AS product_id, min(l_linenumber) AS first_line
      FROM lineitem, (SELECT greatest(count(*) // 10, 200) AS products FROM part) n GROUP BY 1, 2) b
JOIN fx_orders_t o ON b.l_orderkey = o.order_id""", ("fx_orders_t",)),
    "fx_lines": ("""
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS product_id,
       CAST(add_to_cart_order AS VARCHAR) AS add_to_cart_order, CAST(reordered AS VARCHAR) AS reordered
FROM fx_lines_t""", ("fx_lines_t",)),
    "fx_prior": ("""
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS product_id,
       CAST(add_to_cart_order AS VARCHAR) AS add_to_cart_order, CAST(reordered AS VARCHAR) AS reordered
FROM fx_lines_t WHERE eval_set = 'prior'""", ("fx_lines_t",)),
    "fx_trains": ("""
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS product_id,
       CAST(add_to_cart_order AS VARCHAR) AS add_to_cart_order, CAST(reordered AS VARCHAR) AS reordered
FROM fx_lines_t WHERE eval_set = 'train'""", ("fx_lines_t",)),
    "fx_ratings": ("""
SELECT o_custkey AS user_id, l_partkey AS item_id,
       CAST(1 + floor((max(l_quantity) - 1) / 10) AS INTEGER) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_custkey, l_partkey""", ()),
    "fx_docs": ("""
SELECT d.doc_id, d.text AS sentence, COALESCE(CAST(l.quality AS VARCHAR), d.lang) AS label,
       array_to_string(regexp_extract_all(lower(d.text), '\\p{L}+'), ' ') AS segs
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""", ()),
    "fx_offsets": ("""
SELECT 'orders' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition",
       CAST(row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) + 99 AS BIGINT) AS "offset",
       '{"order_id":"' || CAST(event_id AS VARCHAR) || '","user_id":"' || CAST(user_id AS VARCHAR) || '"}' AS value
FROM events""", ()),
}


def with_fx(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs for ``names`` (and their dependencies)."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in FX[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({FX[n][0]}\n)" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
