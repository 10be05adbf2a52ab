"""Warehouse analytics over the shopping-cart tables (HiveQL family A).

Inputs follow the reference contract: ``orders`` (order_id, user_id, eval_set,
order_number, order_dow, order_hour_of_day, days_since_prior_order) and
``prior`` (order_id, product_id, add_to_cart_order, reordered), all strings.

Plan notes (checked with ``explain``):
* every count / sum / avg below is a HashAggregate with a partial (map-side)
  stage, so a hot key (one user or product holding a third of the rows) is
  pre-aggregated in every task before the shuffle;
* joins of ``orders`` with per-order aggregates are equi joins on order_id;
  AQE turns them into broadcast joins when one side is small at run time and
  splits skewed partitions otherwise;
* top-N per group uses ``row_number`` + filter, which Catalyst rewrites into a
  WindowGroupLimit, so only N rows per group and task cross the shuffle;
* every per-user window runs after the (user, product) aggregate, so one
  window partition holds at most one row per product for that user - bounded
  by the product catalogue however many rows a hot user has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import split_words
from ..functions.typed import blank_to_zero, to_int, to_long
from ..session import cut_lineage


def _one():
    return F.lit(1)


# Weekday codes of order_dow, Sunday first.
DOW_VALUES = ["0", "1", "2", "3", "4", "5", "6"]


# ---------------------------------------------------------------- text

def words(lines: DataFrame, column: str = "sentence") -> DataFrame:
    """One row per word: ``explode(split(sentence, ' '))``."""
    return lines.select(F.explode(split_words(column)).alias("word"))


def word_count(lines: DataFrame, column: str = "sentence") -> DataFrame:
    """A1: (word, cnt) over space-separated text."""
    return words(lines, column).groupBy("word").agg(F.count(_one()).alias("cnt"))


def top_words(lines: DataFrame, n: int = 100, column: str = "sentence") -> DataFrame:
    """Top-N words by count (ties by word). ``orderBy.limit`` plans as
    TakeOrderedAndProject: each task keeps N rows, the driver merges N x tasks."""
    return word_count(lines, column).orderBy(F.desc("cnt"), F.asc("word")).limit(n)


# ---------------------------------------------------------------- orders

def products_per_order(prior: DataFrame) -> DataFrame:
    """A2: (order_id, prod_cnt)."""
    return prior.groupBy("order_id").agg(F.count("product_id").alias("prod_cnt"))


def order_size_by_user(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Each order's product count carried to its user."""
    return (orders.select("order_id", "user_id")
            .join(products_per_order(prior), "order_id")
            .select("order_id", "user_id", "prod_cnt"))


def user_total_products(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Sum over a user's orders of the per-order product count."""
    return (order_size_by_user(orders, prior).groupBy("user_id")
            .agg(F.sum("prod_cnt").alias("sum_prod_cnt")))


def orders_per_user(orders: DataFrame) -> DataFrame:
    """A4: (user_id, order_cnt)."""
    return orders.groupBy("user_id").agg(F.count("order_id").alias("order_cnt"))


def user_avg_order_size(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """A5: (user_id, avg_prod_cnt) - mean products per order."""
    return (order_size_by_user(orders, prior).groupBy("user_id")
            .agg(F.avg("prod_cnt").alias("avg_prod_cnt")))


def per_day_ratio(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Products per active day = sum(prod_cnt) / count(distinct day)."""
    j = orders.select("order_id", "user_id", "days_since_prior_order").join(
        products_per_order(prior), "order_id")
    return j.groupBy("user_id").agg(
        F.try_divide(F.sum("prod_cnt").cast("double"),
                     F.countDistinct("days_since_prior_order").cast("double")).alias("day_cnt"))


def per_day_nested(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Avg over a user's days of the day's product sum (equals A6)."""
    j = orders.select("order_id", "user_id", "days_since_prior_order").join(
        products_per_order(prior), "order_id")
    per_day = j.groupBy("user_id", "days_since_prior_order").agg(F.sum("prod_cnt").alias("prod_cnt"))
    return per_day.groupBy("user_id").agg(F.avg("prod_cnt").alias("avg_day_prod_cnt"))


def user_day_count(orders: DataFrame) -> DataFrame:
    """(user_id, day_cnt) - distinct day-gap values."""
    return orders.groupBy("user_id").agg(F.countDistinct("days_since_prior_order").alias("day_cnt"))


def dow_pivot(orders: DataFrame) -> DataFrame:
    """Orders per weekday as seven columns. The pivot values are given,
    so Spark plans one aggregate (no extra job to discover them)."""
    p = orders.groupBy("user_id").pivot("order_dow", DOW_VALUES).agg(F.count(_one())).na.fill(0)
    return p.select("user_id", *[F.col(v).alias(f"dow_{v}") for v in DOW_VALUES])


def blank_gap_to_zero(orders: DataFrame) -> DataFrame:
    """``if(days_since_prior_order='', 0, ...)`` as a number."""
    return orders.select("order_id", "user_id",
                         blank_to_zero("days_since_prior_order").alias("days_since_prior_order"))


# ---------------------------------------------------------------- products

def product_pv(prior: DataFrame) -> DataFrame:
    """A10: (product_id, pv) - purchase lines per product."""
    return prior.groupBy("product_id").agg(F.count(_one()).alias("pv"))


def product_uv(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """(product_id, uv) - distinct buyers per product."""
    j = orders.select("order_id", "user_id").join(prior.select("order_id", "product_id"), "order_id")
    return j.groupBy("product_id").agg(F.countDistinct("user_id").alias("uv"))


def product_reorders(prior: DataFrame) -> DataFrame:
    """(product_id, reordered_cnt)."""
    return prior.groupBy("product_id").agg(F.sum(to_int("reordered")).alias("reordered_cnt"))


def product_pv_reorders(prior: DataFrame) -> DataFrame:
    """Two aggregates in one pass over one scan."""
    return prior.groupBy("product_id").agg(F.count(_one()).alias("pv"),
                                           F.sum(to_int("reordered")).alias("reordered_cnt"))


def product_pv_uv_onepass(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Pv, uv, reorders after the join in one aggregate. Spark expands the
    distinct into a (product, user) pre-aggregation, so the hot product is
    reduced per task before its final merge."""
    j = orders.select("order_id", "user_id").join(prior, "order_id")
    return j.groupBy("product_id").agg(F.count(_one()).alias("pv"),
                                       F.countDistinct("user_id").alias("uv"),
                                       F.sum(to_int("reordered")).alias("reordered_cnt"))


def product_pv_uv_join(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Join of the pv/reorder aggregate with the uv aggregate on product."""
    return (product_pv_reorders(prior).join(product_uv(orders, prior), "product_id")
            .select("product_id", "pv", "reordered_cnt", "uv"))


# ---------------------------------------------------------------- lists and sets

def _sorted_csv(values: Column, numeric: bool = True) -> Column:
    """Join an array of id strings with ',' in a total order (numeric ids)."""
    if numeric:
        s = F.array_sort(F.transform(values, lambda x: F.struct(x.try_cast("bigint").alias("k"), x.alias("v"))))
        return F.array_join(F.transform(s, lambda t: t["v"]), ",")
    return F.array_join(F.array_sort(values), ",")


def user_order_list(orders: DataFrame) -> DataFrame:
    """``collect_list(order_id)`` per user, in order-id order."""
    return orders.groupBy("user_id").agg(_sorted_csv(F.collect_list("order_id")).alias("order_ids"))


def user_product_set(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """``concat_ws(',', collect_set(product_id))`` per user.
    Deduplicated by (user, product) first: that aggregate is map-side combined,
    so the set a task builds is bounded by the user's distinct products."""
    pairs = distinct_pairs(orders, prior)
    return pairs.groupBy("user_id").agg(_sorted_csv(F.collect_list("product_id")).alias("product_set"))


def user_product_record(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Distinct product count and the product set in one record. Lines go
    to their user once, and are made distinct and gathered there."""
    pairs = (orders.select("order_id", "user_id").join(prior.select("order_id", "product_id"), "order_id")
             .select("user_id", "product_id").repartition("user_id").distinct())
    return pairs.groupBy("user_id").agg(
        F.count(_one()).alias("u_prod_dist_cnt"),
        _sorted_csv(F.collect_list("product_id")).alias("u_prod_records"))


def user_product_totals(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Purchases with repeats plus the distinct set. Counted per
    (user, product) first so repeats never travel as rows."""
    j = orders.select("order_id", "user_id").join(prior.select("order_id", "product_id"), "order_id")
    per = j.groupBy("user_id", "product_id").agg(F.count(_one()).alias("n"))
    return per.groupBy("user_id").agg(
        F.sum("n").alias("pro_tal"),
        _sorted_csv(F.collect_list("product_id")).alias("pro_record"))


def user_hour_sequence(orders: DataFrame) -> DataFrame:
    """Per user (order_number, hour) pairs sorted by hour compared as a
    string (as the reference does), ties by numeric order number."""
    s = F.array_sort(F.collect_list(F.struct(
        F.col("order_hour_of_day").alias("h"),
        to_long("order_number").alias("n"))))
    return orders.groupBy("user_id").agg(
        F.array_join(F.transform(s, lambda t: F.concat_ws("_", t["n"].cast("string"), t["h"])), ",")
        .alias("ons"))


def user_top_decile_size(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """ceil(10% of the user's distinct products)."""
    j = orders.select("order_id", "user_id").join(prior.select("order_id", "product_id"), "order_id")
    return j.groupBy("user_id").agg(
        F.ceil(F.countDistinct("product_id").cast("double") * 0.1).alias("total_prod_cnt"))


def distinct_pairs(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Distinct (user, product)."""
    return (orders.select("order_id", "user_id").join(prior.select("order_id", "product_id"), "order_id")
            .select("user_id", "product_id").distinct())


# ---------------------------------------------------------------- windows

def user_product_counts(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """(user_id, product_id, prod_buy_cnt) - purchases per user and product."""
    j = orders.select("order_id", "user_id").join(prior.select("order_id", "product_id"), "order_id")
    return j.groupBy("user_id", "product_id").agg(F.count(_one()).alias("prod_buy_cnt"))


def _pack_ranked(df: DataFrame, parts: list[str], out: str) -> DataFrame:
    """Per user, ``collect_list(concat_ws('_', ...))`` ordered by row_num."""
    s = F.array_sort(F.collect_list(F.struct(
        F.col("row_num").alias("r"), F.concat_ws("_", *[F.col(p).cast("string") for p in parts]).alias("v"))))
    return df.groupBy("user_id").agg(F.array_join(F.transform(s, lambda t: t["v"]), ",").alias(out))


def user_top_products(orders: DataFrame, prior: DataFrame, n: int = 3) -> DataFrame:
    """Each user's n most bought products as 'product_rank,...'.
    Ties on the count go to the smaller product id."""
    cnt = user_product_counts(orders, prior)
    w = Window.partitionBy("user_id").orderBy(F.desc("prod_buy_cnt"), to_long("product_id"))
    top = cnt.withColumn("row_num", F.row_number().over(w)).filter(F.col("row_num") <= n)
    return _pack_ranked(top, ["product_id", "row_num"], f"top_{n}_prods")


def user_top_decile(orders: DataFrame, prior: DataFrame, fraction: float = 0.1) -> DataFrame:
    """Products ranked per user, kept while rank <= ceil(fraction x the
    user's distinct products); packed as 'product_rank_total'."""
    cnt = user_product_counts(orders, prior).withColumnRenamed("prod_buy_cnt", "usr_prod_cnt")
    by_user = Window.partitionBy("user_id")
    ranked = cnt.select(
        "user_id", "product_id",
        F.row_number().over(by_user.orderBy(F.desc("usr_prod_cnt"), to_long("product_id"))).alias("row_num"),
        F.ceil(F.count(_one()).over(by_user).cast("double") * fraction).alias("total_prod_cnt"))
    kept = ranked.filter(F.col("row_num") <= F.col("total_prod_cnt"))
    return _pack_ranked(kept, ["product_id", "row_num", "total_prod_cnt"], "top_10_perc_prod")


# ---------------------------------------------------------------- joins and sets

def join_diff_keys(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Equi join where the key columns carry different names."""
    p = prior.withColumnRenamed("order_id", "oid")
    return (orders.join(p, orders["order_id"] == p["oid"])
            .select("order_id", "user_id", "product_id", "add_to_cart_order"))


def three_way_join(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Three inputs joined on the same key; all sides hash-partitioned by
    order_id once and the second join reuses that partitioning."""
    sizes = products_per_order(prior)
    return (orders.select("order_id", "user_id")
            .join(prior.select("order_id", "product_id"), "order_id")
            .join(sizes, "order_id")
            .select("order_id", "user_id", "product_id", "prod_cnt"))


def users_in(orders: DataFrame, eval_set: str) -> DataFrame:
    """Distinct users with an order in ``eval_set``."""
    return orders.filter(F.col("eval_set") == eval_set).select("user_id").distinct()


def eval_set_overlap(orders: DataFrame) -> DataFrame:
    """Sizes of user-set intersections train/test, prior/train, prior/test.
    The orders table is scanned once: its distinct (eval_set, user) pairs -
    at most three rows per user - are written to the shared folder and the
    six user sets and three intersections are taken from that."""
    sets = cut_lineage(orders.select("eval_set", "user_id").distinct(), "eval_set_users")
    pairs = [("train", "test"), ("prior", "train"), ("prior", "test")]
    parts = [users_in(sets, a).intersect(users_in(sets, b)).select(F.lit(f"{a}&{b}").alias("sets"), "user_id")
             for a, b in pairs]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    counts = u.groupBy("sets").agg(F.count(_one()).alias("users"))
    names = orders.sparkSession.createDataFrame([(f"{a}&{b}",) for a, b in pairs], "sets string")
    return names.join(counts, "sets", "left").na.fill(0, ["users"])
