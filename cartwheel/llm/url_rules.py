"""Operator 10, URL filters: list rules first, mined association rules for the rest.

A list rule (host, path, verdict) fits its host and subdomains where the url's path
begins with the rule's; the longest wins. For other urls, Spark's FP-growth mines
combinations of url tokens (host labels, path words, parameter names) together with a
label from labelled urls. Rules "tokens -> label" of any length are kept by support and
confidence, and dropped where a rule on fewer of the same tokens is at least as sure. A
rule is filed in an inverted index under its rarest token; a url meets the rules of its
own tokens and checks the rest of their tokens. The surest matching rule gives the verdict
(on a tie, block); a url that none fits is allowed.

FP-growth is given only tokens that can be part of an unbeaten longer rule, so that hot
long urls don't make every subset of their tokens an itemset. Tokens of the same labelled
urls are one item (``token_table`` keeps the names, and a url is matched by these items,
so nothing is lost). A token whose urls all have one label, or that every url has, is
left out: with it a longer rule is no surer than without the rest, or without it. Their
rules of one token come straight from the counts.

Scale: urls and tokens only, html is never read. The index is joined, not broadcast by
hand, and a hot token is a skewed join side that adaptive execution splits. What stays
of frequent itemsets is the method's own: k frequent tokens, each missing from some
urls of its kind and each with both labels, still have 2^k combinations.

Defined cases: a null url, or one without ``://``, has empty host and path, no tokens, no
rule and is allowed; a very long url is a url of many tokens; repeated rows each keep their row; extra columns are ignored;
without labelled urls no rule is mined.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

# Fixed value: the list rules of the task, (host, path, verdict).
LIST_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
              ("net", "/es/", "block"), ("net", "/fr/", "block")]
MIN_SUPPORT = 0.002
MIN_ROWS = 20           # a rule rests on at least so many labelled urls
MIN_CONFIDENCE = 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LABEL = "label="


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """host, path and what follows them; empty where there is no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, r"^[^?#]*(.*)$", 1)


def list_rule(host: Column, path: Column, rules=LIST_RULES) -> Column:
    """The longest fitting rule as struct(size, rule, verdict), or null."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for h, p, v in rules]
    return F.array_max(F.array(*fits))


def url_tokens(host: Column, path: Column, tail: Column) -> Column:
    """Distinct tokens; numbers in a path are one token, values of parameters none."""
    def tagged(tag: str, words: Column) -> Column:
        return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(tag), w))

    words = F.transform(F.split(path, "[/._-]"), lambda w: F.regexp_replace(w, "^[0-9]+$", "#"))
    return F.array_distinct(F.concat(
        tagged("host:", F.split(host, r"\.")), tagged("path:", words),
        tagged("name:", F.regexp_extract_all(tail, F.lit(r"[?&]([^=&#]+)"), F.lit(1))),
        tagged("part:", F.regexp_extract_all(tail, F.lit(r"#([^#]*)"), F.lit(1)))))


def prepared_pages(pages: DataFrame, rules=LIST_RULES) -> DataFrame:
    """Written once: row, page_id, host, path, tokens, list_rule."""
    host, path, tail = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), tail.alias("tail")).select(
        F.monotonically_increasing_id().alias("row"), "page_id", "host", "path",
        url_tokens(F.col("host"), F.col("path"), F.col("tail")).alias("tokens"),
        list_rule(F.col("host"), F.col("path"), rules).alias("list_rule"))
    return cut_lineage(rows, "url_rows")


_RULES = "tokens array<string>, verdict string, confidence double, support double"


def token_table(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """Written once: the frequent tokens of (tokens, label) rows as (token, item, n,
    verdicts). Tokens of exactly the same rows have the same ``item``, the least of them."""
    rows = cut_lineage(labelled.select(F.monotonically_increasing_id().alias("id"), F.array_distinct("tokens").alias("tokens"), "label")
                       .filter(F.size("tokens") > 0), "url_labelled")
    n = rows.count()
    marks = [F.sum(F.xxhash64("id", F.lit(seed)).cast("decimal(38,0)")).alias(f"mark{seed}") for seed in (1, 2)]
    by_label = rows.select("id", "label", F.explode("tokens").alias("token")).groupBy("token", "label").agg(
        F.count(F.lit(1)).alias("k"), *marks)
    sums = by_label.groupBy("token").agg(
        F.sum("k").alias("n"), F.sum("mark1").alias("mark1"), F.sum("mark2").alias("mark2"),
        F.array_sort(F.collect_list(F.struct("label", F.col("k").alias("n")))).alias("verdicts")
    ).filter(F.col("n") >= F.lit(_least(n, min_support)))
    first = sums.groupBy("n", "mark1", "mark2").agg(F.min("token").alias("item"))
    sums = cut_lineage(sums.join(first, ["n", "mark1", "mark2"]).select("token", "item", "n", "verdicts"), "url_marks")
    # the marks propose equal rows, a count of the rows that hold both tokens confirms them
    both = rows.select("tokens", F.explode("tokens").alias("token")).join(
        sums.filter("item <> token").select("token", "item"), "token").filter(
        F.array_contains("tokens", F.col("item"))).groupBy("token").agg(F.count(F.lit(1)).alias("both"))
    return cut_lineage(sums.join(both, "token", "left").select(
        "token", F.when(F.col("both") == F.col("n"), F.col("item")).otherwise(F.col("token")).alias("item"), "n", "verdicts"), "url_tokens")


def _least(n: int, min_support: float) -> int:
    """Labelled urls that a rule must rest on."""
    return max(math.ceil(min_support * n), MIN_ROWS)


def as_items(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """(key, tokens): each row's tokens as the items of the table, others left out."""
    return rows.select(key, F.explode("tokens").alias("token")).join(table.select("token", "item"), "token").groupBy(key).agg(
        F.array_sort(F.collect_set("item")).alias("tokens"))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               table: DataFrame | None = None) -> DataFrame:
    """Pruned rules (tokens, verdict, confidence, support) from (tokens, label); their
    tokens are items of ``table`` (the ``token_table`` of the same rows)."""
    spark = labelled.sparkSession
    labelled = cut_lineage(labelled.filter(F.size("tokens") > 0).select(F.monotonically_increasing_id().alias("id"), "tokens", "label"), "url_labels")
    n = labelled.count()
    if n < MIN_ROWS:
        return spark.createDataFrame([], _RULES)
    table = token_table(labelled, min_support) if table is None else table
    items = table.filter("token = item")
    single = items.select(F.array("item").alias("tokens"), "n", F.inline("verdicts").alias("verdict", "k")).filter(
        (F.col("k") >= _least(n, min_support)) & (F.col("k") / F.col("n") >= min_confidence)).select(
        "tokens", "verdict", (F.col("k") / F.col("n")).alias("confidence"), (F.col("k") / F.lit(n)).alias("support"))
    mixed = table.filter((F.size("verdicts") > 1) & (F.col("n") < n))
    baskets = labelled.select("id", "label").join(as_items(labelled, "id", mixed), "id", "left").select(
        F.concat(F.array(F.concat(F.lit(_LABEL), "label")), F.coalesce("tokens", F.array().cast("array<string>"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=max(min_support, MIN_ROWS / n), minConfidence=min_confidence).fit(
        cut_lineage(baskets, "url_baskets"))
    longer = model.associationRules.filter(F.col("consequent")[0].startswith(_LABEL) & (F.size("antecedent") > 1)).select(
        F.array_sort("antecedent").alias("tokens"), F.expr(f"substring(consequent[0], {len(_LABEL) + 1})").alias("verdict"), "confidence", "support")
    rules = cut_lineage(single.unionByName(longer), "url_rules")
    # a rule that beats another is met under its rarest token among the other's tokens
    held = rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("token"))
    uses = held.groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    least = held.join(uses, "token").groupBy("tokens", "verdict", "confidence").agg(F.min(F.struct("uses", "token"))["token"].alias("token"))
    shorter = least.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("least"), "token")
    beaten = held.join(shorter, ["token", "verdict"]).filter(
        (F.size("part") < F.size("tokens")) & (F.col("least") >= F.col("confidence")) & (F.size(F.array_except("part", "tokens")) == 0)
    ).select("tokens", "verdict").distinct()
    return cut_lineage(rules.join(beaten, ["tokens", "verdict"], "left_anti"), "url_rules_pruned")


def match_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """(row, verdict, confidence): the surest rule that each row's tokens contain."""
    terms = rules.select(F.explode("tokens").alias("token")).distinct()
    counts = rows.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    seen = terms.join(counts, "token")
    # a rule with a token that no url has can't fit, so the inner join may drop it
    index = rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("token")).join(seen, "token").groupBy(
        "tokens", "verdict", "confidence").agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    index = index.withColumnRenamed("tokens", "needed")
    hits = rows.select("row", "tokens", F.explode("tokens").alias("token")).join(index, "token").filter(
        F.size(F.array_except("needed", "tokens")) == 0)
    best = F.max(F.struct("confidence", (F.col("verdict") == "block").alias("strict"), "verdict"))
    return hits.groupBy("row").agg(best.alias("b")).select("row", "b.verdict", "b.confidence")


def judge(pages: DataFrame, labels: DataFrame, rules=LIST_RULES, **limits) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict. ``labels``: (page_id, label) of some pages;
    pages that a list rule settles are labelled by it."""
    rows = prepared_pages(pages, rules)
    known = labels.groupBy(F.col("page_id").alias("id")).agg(F.max(F.col("label") == "block").alias("bad"))
    from_list = rows.filter("list_rule is not null").select("tokens", F.col("list_rule.verdict").alias("label"))
    given = rows.filter("list_rule is null").join(known, F.col("page_id") == F.col("id")).select(
        "tokens", F.when(F.col("bad"), "block").otherwise("allow").alias("label"))
    labelled = from_list.unionByName(given)
    table = token_table(labelled, limits.get("min_support", MIN_SUPPORT))
    mined = mine_rules(labelled, table=table, **limits)
    items = cut_lineage(as_items(rows.filter("list_rule is null"), "row", table), "url_items")
    found = match_rules(items, mined).select("row", F.col("verdict").alias("mined"))
    return rows.join(found, "row", "left").select(
        "page_id", "host", "path", F.col("list_rule.rule").alias("rule"),
        F.coalesce("list_rule.verdict", "mined", F.lit("allow")).alias("verdict"))
