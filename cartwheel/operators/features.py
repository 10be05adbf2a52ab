"""Reorder-prediction feature tables (family B) and training sets.

Plan notes:
* per-user features are three aggregates (over orders, over order sizes, over
  distinct user-product pairs); each comes out hash-partitioned by user_id, so
  joining them costs no further shuffle;
* the reference's RDD ``groupByKey`` steps become ``groupBy().agg`` with
  partial aggregation, and its arg-max over a per-key list becomes ``max_by``
  (a streaming aggregate: nothing per key is buffered but the current best);
* the user-product share uses a window sum instead of group-collect-flatten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.typed import blank_to_zero, hour_gap, safe_ratio, to_double, to_int, to_long, to_whole
from ..session import cut_lineage
from . import analytics as A
from .text import sent_if_small

SENT_PRODUCTS = 2_000_000     # rows of product features that may be sent to every task


def _one() -> Column:
    return F.lit(1)


# ------------------------------------------------------------- product features

def product_features(prior: DataFrame) -> DataFrame:
    """B1: product_id, prod_sum_rod, prod_rod_rate, prod_cnt."""
    r = to_int("reordered")
    return prior.groupBy("product_id").agg(
        F.sum(r).alias("prod_sum_rod"), F.avg(r).alias("prod_rod_rate"),
        F.count("product_id").alias("prod_cnt"))


def product_features_with_count(prior: DataFrame) -> DataFrame:
    """B2: B1 plus the plain row count ``count`` (equal to prod_cnt). The
    reference joins a second aggregate for it; one aggregate gives both."""
    r = to_int("reordered")
    return prior.groupBy("product_id").agg(
        F.count(_one()).alias("count"), F.sum(r).alias("prod_sum_rod"),
        F.avg(r).alias("prod_rod_rate"), F.count("product_id").alias("prod_cnt"))


def product_position(prior: DataFrame) -> DataFrame:
    """Mean cart position per product."""
    return prior.groupBy("product_id").agg(F.avg(to_int("add_to_cart_order")).alias("p_position"))


# ------------------------------------------------------------- user features

def user_gap(orders: DataFrame, blank_as_zero: bool = True) -> DataFrame:
    """Mean day gap; the first order's blank gap counts as 0 unless
    ``blank_as_zero=False`` (then it is left out of the mean)."""
    g = blank_to_zero("days_since_prior_order", "int") if blank_as_zero else to_whole("days_since_prior_order")
    return orders.groupBy("user_id").agg(F.avg(g).alias("u_avg_day_gap"))


def order_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """orders JOIN lines on order_id with every column the features use. A
    job that derives several aggregates from it writes it once
    (``cut_lineage``) instead of joining the fact table again per aggregate."""
    return (orders.select("order_id", "user_id", "order_number", "order_hour_of_day")
            .join(lines.select("order_id", "product_id", "add_to_cart_order", "reordered"), "order_id"))


def user_features(orders: DataFrame, prior: DataFrame, op: DataFrame | None = None) -> DataFrame:
    """user_id, u_avg_day_gap, user_ord_cnt, u_prod_dist_cnt,
    u_prod_records, u_avg_ord_prods. Inner joins: users without prior lines
    drop out, as in the reference. ``op`` = order_lines(orders, prior) if
    the caller already has it."""
    op = order_lines(orders, prior) if op is None else op
    per_user = orders.groupBy("user_id").agg(
        F.avg(blank_to_zero("days_since_prior_order", "int")).alias("u_avg_day_gap"),
        F.count(_one()).alias("user_ord_cnt"))
    pairs = op.select("user_id", "product_id").distinct()
    records = pairs.groupBy("user_id").agg(
        F.count(_one()).alias("u_prod_dist_cnt"),
        A._sorted_csv(F.collect_list("product_id")).alias("u_prod_records"))
    sizes = (op.groupBy("user_id", "order_id").agg(F.count("product_id").alias("n"))
             .groupBy("user_id").agg(F.avg("n").alias("u_avg_ord_prods")))
    return (per_user.join(records, "user_id").join(sizes, "user_id")
            .select("user_id", "u_avg_day_gap", "user_ord_cnt", "u_prod_dist_cnt",
                    "u_prod_records", "u_avg_ord_prods"))


def user_features_alt(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """The second job's variants: ds_avg (blank gap as 0) and u_pro_avg."""
    ds = orders.groupBy("user_id").agg(F.avg(blank_to_zero("days_since_prior_order")).alias("ds_avg"))
    sizes = A.user_avg_order_size(orders, prior).withColumnRenamed("avg_prod_cnt", "u_pro_avg")
    return ds.join(sizes, "user_id")


def last_basket(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Products of each user's highest numeric order_id, as CSV. The
    highest order may be a train/test order with no prior lines; such users
    have no row (inner join as in the reference)."""
    last = orders.groupBy("user_id").agg(F.max(to_long("order_id")).alias("last_id"))
    p = prior.select(to_long("order_id").alias("last_id"), "product_id")
    return (last.join(p, "last_id").groupBy("user_id")
            .agg(A._sorted_csv(F.collect_list("product_id")).alias("u_last_p")))


# ------------------------------------------------------------- user x product

def cross_features(orders: DataFrame, prior: DataFrame, op: DataFrame | None = None) -> DataFrame:
    """B7-B9 in one aggregate: orders_cnt, avg_pos_in_cart and the last order
    (max order_number) with its id and hour via ``max_by``."""
    op = order_lines(orders, prior) if op is None else op
    last = F.max_by(F.struct(F.col("order_id").alias("id"), F.col("order_hour_of_day").alias("hour")),
                    to_int("order_number"))
    return (op.groupBy("user_id", "product_id")
            .agg(F.count(_one()).alias("orders_cnt"),
                 F.avg(to_int("add_to_cart_order")).alias("avg_pos_in_cart"),
                 F.max(to_int("order_number")).alias("max_ord_num"),
                 last.alias("last"))
            .select("user_id", "product_id", "orders_cnt", "avg_pos_in_cart", "max_ord_num",
                    F.col("last.id").alias("last_order_id"), F.col("last.hour").alias("last_order_hour")))


def user_product_orders(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Distinct orders per (user, product)."""
    d = prior.select("order_id", "product_id").distinct()
    return (orders.select("order_id", "user_id").join(d, "order_id")
            .groupBy("user_id", "product_id").agg(F.count(_one()).alias("count")))


def user_product_rate(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Share of each product in the user's purchases."""
    per = A.user_product_counts(orders, prior).withColumnRenamed("prod_buy_cnt", "num")
    total = F.sum("num").over(Window.partitionBy("user_id"))
    return per.select("user_id", "product_id", (F.col("num") / total).alias("u_p_rate"),
                      "num", total.alias("total"))


def order_context(orders: DataFrame) -> DataFrame:
    """Order features: hour (int) and day gap (double), NULLs filled with 0."""
    return orders.select("order_id", to_int("order_hour_of_day").alias("order_hour_of_day"),
                         F.col("days_since_prior_order").try_cast("double").alias("days_since_prior_order")
                         ).na.fill(0)


def days_ratio(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """The order's day gap over the user's mean gap (NULL when the mean is 0)."""
    o = order_context(orders).join(orders.select("order_id", "user_id"), "order_id")
    return (o.join(user_gap(orders), "user_id")
            .select("order_id", "user_id",
                    safe_ratio("days_since_prior_order", "u_avg_day_gap").alias("days_since_ratio")))


# ------------------------------------------------------------- labels and matrices

def train_labels(orders: DataFrame, prior: DataFrame, trains: DataFrame,
                 op: DataFrame | None = None) -> DataFrame:
    """Distinct prior (user, product) FULL OUTER JOIN distinct train pairs
    tagged 1; missing labels become 0."""
    recall = (A.distinct_pairs(orders, prior) if op is None
              else op.select("user_id", "product_id").distinct())
    real = A.distinct_pairs(orders, trains).withColumn("label", F.lit(1))
    return recall.join(real, ["user_id", "product_id"], "outer").na.fill(0, ["label"])


MODEL_USER = ["u_avg_day_gap", "user_ord_cnt", "u_prod_dist_cnt", "u_avg_ord_prods"]
MODEL_PRODUCT = ["prod_sum_rod", "prod_rod_rate", "prod_cnt"]


def train_matrix(orders: DataFrame, prior: DataFrame, trains: DataFrame) -> DataFrame:
    """Labels joined with user and product features (inner). The per-user
    product list is not carried: it would be copied onto every pair."""
    both = prior.select("order_id", "product_id", F.lit(0).alias("train")).unionByName(
        trains.select("order_id", "product_id", F.lit(1).alias("train")))
    users = orders.select("order_id", "user_id")
    # Lines meet their order, then go to the user once; pairs, labels and user features are made there.
    pairs = users.join(both, "order_id").select("user_id", "product_id", "train").repartition("user_id").groupBy(
        "user_id", "product_id").agg(F.max("train").alias("label"), F.min("train").alias("bought"))
    kinds = F.count_if(F.col("bought") == 0).over(Window.partitionBy("user_id"))
    per_user = orders.groupBy("user_id").agg(
        F.avg(blank_to_zero("days_since_prior_order", "int")).alias("u_avg_day_gap"), F.count(_one()).alias("user_ord_cnt"))
    sizes = users.join(prior.groupBy("order_id").agg(F.count("product_id").alias("n")), "order_id").groupBy(
        "user_id", "order_id").agg(F.sum("n").alias("n")).groupBy("user_id").agg(F.avg("n").alias("u_avg_ord_prods"))
    products = cut_lineage(product_features(prior), "product_features")
    return (pairs.withColumn("u_prod_dist_cnt", kinds).join(per_user, "user_id").join(sizes, "user_id")
            .join(sent_if_small(products, SENT_PRODUCTS), "product_id")
            .select("user_id", "product_id", "label", *MODEL_USER, *MODEL_PRODUCT))


def train_matrix_full(orders: DataFrame, prior: DataFrame, trains: DataFrame,
                      circular: bool = False) -> DataFrame:
    """C3 with B15-B17: one row per prior line with its order context, the
    (user, product) label of C1, user/product/cross features; numeric NULLs
    become -1 after the cross-feature left join.

    Plan: orders meet the prior and train lines in one join, which is written.
    One aggregate on (user, product) then gives label and cross features, one on
    the user gives all user features; they and the product features are joined to
    the pairs, which are fewer than the lines, and the lines are moved once."""
    both = prior.withColumn("train", F.lit(0)).unionByName(trains.withColumn("train", F.lit(1)))
    context = orders.select("order_id", "user_id", "order_number", "order_hour_of_day", "days_since_prior_order")
    op = cut_lineage(context.join(both.select("order_id", "product_id", "add_to_cart_order", "reordered", "train"), "order_id"),
                     "all_lines")
    bought = F.col("train") == 0
    last = F.max_by(F.when(bought, to_int("order_hour_of_day")), F.when(bought, to_int("order_number")))
    pairs = op.groupBy("user_id", "product_id").agg(
        F.max("train").alias("label"), F.count_if(bought).alias("orders_cnt"),
        F.avg(F.when(bought, to_int("add_to_cart_order"))).alias("avg_pos_in_cart"),
        F.max(F.when(bought, to_int("order_number"))).alias("max_ord_num"), last.alias("last_hour")).filter("orders_cnt > 0")

    # per user: one aggregate over order rows, basket sizes and distinct pairs
    none = F.lit(None)
    gaps = orders.select("user_id", blank_to_zero("days_since_prior_order", "int").cast("double").alias("gap"),
                         none.cast("double").alias("size"), F.lit(0).alias("pair"))
    sizes = op.filter(bought).groupBy("user_id", "order_id").agg(F.count("product_id").cast("double").alias("size")).select(
        "user_id", none.cast("double").alias("gap"), "size", F.lit(0).alias("pair"))
    kinds = pairs.select("user_id", none.cast("double").alias("gap"), none.cast("double").alias("size"), F.lit(1).alias("pair"))
    users = gaps.unionByName(sizes).unionByName(kinds).groupBy("user_id").agg(
        F.avg("gap").alias("u_avg_day_gap"), F.count("gap").alias("user_ord_cnt"),
        F.sum("pair").alias("u_prod_dist_cnt"), F.avg("size").alias("u_avg_ord_prods"))

    per_pair = (pairs.join(users, "user_id").join(product_features(op.filter(bought)), "product_id"))
    hour, gap = to_int("order_hour_of_day"), to_double("days_since_prior_order")
    lines = op.filter(bought).select("user_id", "product_id", "order_id", F.coalesce(hour, F.lit(0)).alias("order_hour_of_day"),
                                     F.coalesce(gap, F.lit(0.0)).alias("days_since_prior_order"))
    m = (lines.join(per_pair, ["user_id", "product_id"])
         .withColumn("days_since_ratio", safe_ratio("days_since_prior_order", "u_avg_day_gap")).na.fill(-1))
    return m.select("user_id", "product_id", "order_id", "label", *MODEL_USER, *MODEL_PRODUCT,
                    "order_hour_of_day", "days_since_prior_order", "days_since_ratio",
                    "orders_cnt", "avg_pos_in_cart", "max_ord_num",
                    (F.col("user_ord_cnt") - F.col("max_ord_num")).alias("up_orders_since_last"),
                    hour_gap("order_hour_of_day", "last_hour", circular).alias("up_hour_vs_last"))


# ------------------------------------------------------------- reproducible split

def hash_bucket(key, buckets: int = 100) -> Column:
    """Stable bucket of a key: first 8 hex digits of md5(key) mod ``buckets``.
    Unlike ``randomSplit`` it does not depend on partitioning or retries."""
    k = F.col(key) if isinstance(key, str) else key
    return (F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def hash_split(df: DataFrame, key: str, train_pct: int = 80) -> DataFrame:
    """Adds ``bucket`` and ``split`` ('train' below ``train_pct``, else 'test')."""
    b = hash_bucket(key)
    return df.withColumn("bucket", b).withColumn(
        "split", F.when(F.col("bucket") < train_pct, F.lit("train")).otherwise(F.lit("test")))
