"""Catalog: reorder-prediction features (B*), labels and training matrices."""

from __future__ import annotations

from ..operators import features as FE
from ..sources import fixtures as FXS
from ..sources.tables import load_table
from .common import round_doubles
from .registry import query

OP = ("fx_orders", "fx_prior")
OPT = ("fx_orders", "fx_prior", "fx_trains")


def _op(spark, sf):
    return FXS.load(spark, sf, "fx_orders"), FXS.load(spark, sf, "fx_prior")


def _opt(spark, sf):
    return FXS.load(spark, sf, "fx_orders"), FXS.load(spark, sf, "fx_prior"), FXS.load(spark, sf, "fx_trains")


# SQL building blocks (DuckDB dialect)
GAP0_INT = "COALESCE(TRY_CAST(NULLIF(days_since_prior_order, '') AS INTEGER), 0)"
PAIRS_PRIOR = "(SELECT DISTINCT o.user_id, p.product_id FROM fx_orders o JOIN fx_prior p ON o.order_id = p.order_id)"
PAIRS_TRAIN = "(SELECT DISTINCT o.user_id, p.product_id FROM fx_orders o JOIN fx_trains p ON o.order_id = p.order_id)"
PROD_FEAT = """(SELECT product_id, CAST(sum(CAST(reordered AS INTEGER)) AS BIGINT) AS prod_sum_rod,
  avg(CAST(reordered AS INTEGER)) AS prod_rod_rate, count(product_id) AS prod_cnt FROM fx_prior GROUP BY product_id)"""
USER_FEAT = f"""(SELECT pu.user_id, pu.g AS u_avg_day_gap, pu.c AS user_ord_cnt, rec.dc AS u_prod_dist_cnt,
        rec.recs AS u_prod_records, sz.a AS u_avg_ord_prods
 FROM (SELECT user_id, avg({GAP0_INT}) AS g, count(*) AS c FROM fx_orders GROUP BY user_id) pu
 JOIN (SELECT user_id, count(*) AS dc, string_agg(product_id, ',' ORDER BY CAST(product_id AS BIGINT)) AS recs
       FROM {PAIRS_PRIOR} pp GROUP BY user_id) rec ON pu.user_id = rec.user_id
 JOIN (SELECT o.user_id, avg(s.prod_cnt) AS a FROM fx_orders o
       JOIN (SELECT order_id, count(product_id) AS prod_cnt FROM fx_prior GROUP BY order_id) s ON o.order_id = s.order_id
       GROUP BY o.user_id) sz ON pu.user_id = sz.user_id)"""
LABELS = f"""(SELECT COALESCE(r.user_id, t.user_id) AS user_id, COALESCE(r.product_id, t.product_id) AS product_id,
        CASE WHEN t.user_id IS NULL THEN 0 ELSE 1 END AS label
 FROM {PAIRS_PRIOR} r FULL OUTER JOIN {PAIRS_TRAIN} t ON r.user_id = t.user_id AND r.product_id = t.product_id)"""
CROSS = """(SELECT o.user_id, p.product_id, count(*) AS orders_cnt, avg(CAST(p.add_to_cart_order AS INTEGER)) AS avg_pos_in_cart,
        max(CAST(o.order_number AS INTEGER)) AS max_ord_num,
        arg_max(o.order_id, CAST(o.order_number AS INTEGER)) AS last_order_id,
        arg_max(o.order_hour_of_day, CAST(o.order_number AS INTEGER)) AS last_order_hour
 FROM fx_orders o JOIN fx_prior p ON o.order_id = p.order_id GROUP BY o.user_id, p.product_id)"""


@query("feat_product", ops=("B1",), fx=("fx_prior",), sql=f"""
SELECT product_id, prod_sum_rod, round(prod_rod_rate, 6) AS prod_rod_rate, prod_cnt FROM {PROD_FEAT} t""")
def q_feat_product(spark, sf):
    return round_doubles(FE.product_features(FXS.load(spark, sf, "fx_prior")))


@query("feat_product_with_count", ops=("B2",), fx=("fx_prior",), sql="""
SELECT product_id, count(*) AS "count", CAST(sum(CAST(reordered AS INTEGER)) AS BIGINT) AS prod_sum_rod,
       round(avg(CAST(reordered AS INTEGER)), 6) AS prod_rod_rate, count(product_id) AS prod_cnt
FROM fx_prior GROUP BY product_id""")
def q_feat_product_with_count(spark, sf):
    return round_doubles(FE.product_features_with_count(FXS.load(spark, sf, "fx_prior")))


@query("feat_user_gap", ops=("B3",), fx=("fx_orders",), sql=f"""
SELECT user_id, round(avg({GAP0_INT}), 6) AS u_avg_day_gap FROM fx_orders GROUP BY user_id""")
def q_feat_user_gap(spark, sf):
    return round_doubles(FE.user_gap(FXS.load(spark, sf, "fx_orders")))


@query("feat_user", ops=("B4", "B5", "B6"), fx=OP, sql=f"""
SELECT user_id, round(u_avg_day_gap, 6) AS u_avg_day_gap, user_ord_cnt, u_prod_dist_cnt, u_prod_records,
       round(u_avg_ord_prods, 6) AS u_avg_ord_prods FROM {USER_FEAT} t""", bench=True)
def q_feat_user(spark, sf):
    return round_doubles(FE.user_features(*_op(spark, sf)))


@query("feat_user_alt", ops=("B14",), fx=OP, sql="""
SELECT d.user_id, round(d.ds_avg, 6) AS ds_avg, round(s.a, 6) AS u_pro_avg
FROM (SELECT user_id, avg(COALESCE(TRY_CAST(NULLIF(days_since_prior_order, '') AS DOUBLE), 0)) AS ds_avg
      FROM fx_orders GROUP BY user_id) d
JOIN (SELECT o.user_id, avg(s.prod_cnt) AS a FROM fx_orders o
      JOIN (SELECT order_id, count(product_id) AS prod_cnt FROM fx_prior GROUP BY order_id) s ON o.order_id = s.order_id
      GROUP BY o.user_id) s ON d.user_id = s.user_id""")
def q_feat_user_alt(spark, sf):
    return round_doubles(FE.user_features_alt(*_op(spark, sf)))


@query("feat_last_basket", ops=("B12",), fx=OP, sql="""
SELECT l.user_id, string_agg(p.product_id, ',' ORDER BY CAST(p.product_id AS BIGINT)) AS u_last_p
FROM (SELECT user_id, max(CAST(order_id AS BIGINT)) AS last_id FROM fx_orders GROUP BY user_id) l
JOIN fx_prior p ON CAST(p.order_id AS BIGINT) = l.last_id GROUP BY l.user_id""")
def q_feat_last_basket(spark, sf):
    return FE.last_basket(*_op(spark, sf))


@query("feat_cross", ops=("B7",), fx=OP, sql=f"""
SELECT user_id, product_id, orders_cnt, round(avg_pos_in_cart, 6) AS avg_pos_in_cart FROM {CROSS} t""")
def q_feat_cross(spark, sf):
    return round_doubles(FE.cross_features(*_op(spark, sf)).select(
        "user_id", "product_id", "orders_cnt", "avg_pos_in_cart"))


@query("feat_last_order", ops=("B8", "A24"), fx=OP, sql=f"""
SELECT user_id, product_id, max_ord_num, last_order_id, last_order_hour FROM {CROSS} t""")
def q_feat_last_order(spark, sf):
    return FE.cross_features(*_op(spark, sf)).select(
        "user_id", "product_id", "max_ord_num", "last_order_id", "last_order_hour")


@query("feat_cross_full", ops=("B9",), fx=OP, sql=f"""
SELECT user_id, product_id, orders_cnt, round(avg_pos_in_cart, 6) AS avg_pos_in_cart, max_ord_num,
       last_order_id, last_order_hour FROM {CROSS} t""")
def q_feat_cross_full(spark, sf):
    return round_doubles(FE.cross_features(*_op(spark, sf)))


@query("feat_user_product_orders", ops=("B10",), fx=OP, sql="""
SELECT o.user_id, d.product_id, count(*) AS "count"
FROM fx_orders o JOIN (SELECT DISTINCT order_id, product_id FROM fx_prior) d ON o.order_id = d.order_id
GROUP BY o.user_id, d.product_id""")
def q_feat_user_product_orders(spark, sf):
    return FE.user_product_orders(*_op(spark, sf))


@query("feat_product_position", ops=("B11",), fx=("fx_prior",), sql="""
SELECT product_id, round(avg(CAST(add_to_cart_order AS INTEGER)), 6) AS p_position FROM fx_prior GROUP BY product_id""")
def q_feat_product_position(spark, sf):
    return round_doubles(FE.product_position(FXS.load(spark, sf, "fx_prior")))


@query("feat_user_product_rate", ops=("B13", "W5"), fx=OP, sql="""
SELECT user_id, product_id, round(num / sum(num) OVER (PARTITION BY user_id), 6) AS u_p_rate, num,
       CAST(sum(num) OVER (PARTITION BY user_id) AS BIGINT) AS total
FROM (SELECT o.user_id, p.product_id, count(*) AS num FROM fx_orders o JOIN fx_prior p ON o.order_id = p.order_id
      GROUP BY o.user_id, p.product_id) t""")
def q_feat_user_product_rate(spark, sf):
    return round_doubles(FE.user_product_rate(*_op(spark, sf)))


@query("feat_days_ratio", ops=("B15",), fx=("fx_orders",), sql=f"""
SELECT o.order_id, o.user_id,
       round(COALESCE(TRY_CAST(o.days_since_prior_order AS DOUBLE), 0) / NULLIF(g.u_avg_day_gap, 0), 6) AS days_since_ratio
FROM fx_orders o JOIN (SELECT user_id, avg({GAP0_INT}) AS u_avg_day_gap FROM fx_orders GROUP BY user_id) g
ON o.user_id = g.user_id""")
def q_feat_days_ratio(spark, sf):
    return round_doubles(FE.days_ratio(*_op(spark, sf)))


@query("train_labels", ops=("C1", "J4", "P5", "P7"), fx=OPT, sql=f"SELECT user_id, product_id, label FROM {LABELS} t")
def q_train_labels(spark, sf):
    return FE.train_labels(*_opt(spark, sf))


@query("train_matrix", ops=("C2",), fx=OPT, sql=f"""
SELECT l.user_id, l.product_id, l.label, round(u.u_avg_day_gap, 6) AS u_avg_day_gap, u.user_ord_cnt,
       u.u_prod_dist_cnt, round(u.u_avg_ord_prods, 6) AS u_avg_ord_prods, p.prod_sum_rod,
       round(p.prod_rod_rate, 6) AS prod_rod_rate, p.prod_cnt
FROM {LABELS} l JOIN {USER_FEAT} u ON l.user_id = u.user_id JOIN {PROD_FEAT} p ON l.product_id = p.product_id""",
       bench=True)
def q_train_matrix(spark, sf):
    return round_doubles(FE.train_matrix(*_opt(spark, sf)))


@query("train_matrix_full", ops=("C3", "J5", "B16", "B17", "P6"), fx=OPT, sql=f"""
WITH m AS (
  SELECT ln.user_id, ln.product_id, ln.order_id, COALESCE(l.label, 0) AS label,
         u.u_avg_day_gap, u.user_ord_cnt, u.u_prod_dist_cnt, u.u_avg_ord_prods,
         p.prod_sum_rod, p.prod_rod_rate, p.prod_cnt,
         COALESCE(TRY_CAST(oc.order_hour_of_day AS INTEGER), 0) AS order_hour_of_day,
         COALESCE(TRY_CAST(oc.days_since_prior_order AS DOUBLE), 0) AS days_since_prior_order,
         x.orders_cnt, x.avg_pos_in_cart, x.max_ord_num, x.last_order_hour
  FROM (SELECT o.order_id, o.user_id, p.product_id FROM fx_orders o JOIN fx_prior p ON o.order_id = p.order_id) ln
  LEFT JOIN {LABELS} l ON ln.user_id = l.user_id AND ln.product_id = l.product_id
  JOIN {USER_FEAT} u ON ln.user_id = u.user_id
  JOIN {PROD_FEAT} p ON ln.product_id = p.product_id
  JOIN fx_orders oc ON ln.order_id = oc.order_id
  LEFT JOIN {CROSS} x ON ln.user_id = x.user_id AND ln.product_id = x.product_id)
SELECT user_id, product_id, order_id, label, round(u_avg_day_gap, 6) AS u_avg_day_gap, user_ord_cnt, u_prod_dist_cnt,
       round(u_avg_ord_prods, 6) AS u_avg_ord_prods, prod_sum_rod, round(prod_rod_rate, 6) AS prod_rod_rate, prod_cnt,
       order_hour_of_day, round(days_since_prior_order, 6) AS days_since_prior_order,
       round(COALESCE(days_since_prior_order / NULLIF(u_avg_day_gap, 0), -1), 6) AS days_since_ratio,
       COALESCE(orders_cnt, -1) AS orders_cnt, round(COALESCE(avg_pos_in_cart, -1), 6) AS avg_pos_in_cart,
       COALESCE(max_ord_num, -1) AS max_ord_num,
       user_ord_cnt - COALESCE(max_ord_num, -1) AS up_orders_since_last,
       CASE WHEN CAST(last_order_hour AS INTEGER) IS NULL THEN NULL
            ELSE LEAST(order_hour_of_day - CAST(last_order_hour AS INTEGER),
                       24 - (order_hour_of_day - CAST(last_order_hour AS INTEGER))) END AS up_hour_vs_last
FROM m""")
def q_train_matrix_full(spark, sf):
    return round_doubles(FE.train_matrix_full(*_opt(spark, sf)))


@query("hash_split", ops=("C5",), sql="""
SELECT event_id, CAST(CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 AS INTEGER) AS bucket,
       CASE WHEN CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80
            THEN 'train' ELSE 'test' END AS split
FROM events""")
def q_hash_split(spark, sf):
    e = load_table(spark, sf, "events").select("event_id")
    return FE.hash_split(e, "event_id", 80)
