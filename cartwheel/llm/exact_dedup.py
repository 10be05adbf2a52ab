"""Operator 7, exact dedup: MSD radix partitioning of whole texts.

Texts are split by their most significant digit first: the byte length, then
runs of successive bytes. A group that holds one text is finished, and so is a
group whose texts have ended; only the others go on to the next digit. Two
texts share a class only if all their bytes matched, so no digest decides
equality. A digit is a run of bytes whose width grows by ``GROWTH`` per round
up to ``MAX_DIGIT``: the number of rounds is logarithmic for usual texts, and
a shuffle key never exceeds ``MAX_DIGIT`` bytes.

Scale: each round counts keys with a partial aggregate (copies meet inside the
map task first) and joins the counts back; the join is an ordinary sort-merge
join, whose hot keys adaptive execution splits. Nothing is collected. A round's
survivors are written to the shared folder, so a lost executor costs one round.

Defined cases: null text counts as empty; empty texts form one class; null
doc_id sorts after all others when the row that stays is chosen; repeated rows
each have an output row, and one of them at most is kept; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, text_or_empty

# Fixed value: the characters deleted before comparison, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
FIRST_DIGIT = 32
GROWTH = 32
MAX_DIGIT = 1 << 20


def normalised(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def _split(rows: DataFrame, key: list[str], width: int) -> DataFrame:
    """One radix round: add ``members`` and the group's new id; cut the digit off."""
    rows = rows.withColumn("digit", F.substring("rest", 1, width))
    groups = (rows.groupBy(*key, "digit").agg(F.count(F.lit(1)).alias("members"))
              .filter("members > 1"))
    # A group's new id is any value no other group has; its only use is equality.
    groups = groups.withColumn("next_gid", F.monotonically_increasing_id())
    groups = cut_lineage(groups, "radix_groups")
    same = [rows[c].eqNullSafe(groups[c]) for c in [*key, "digit"]]
    # a merge join at every size: text never moves more at one size than at another
    out = rows.join(groups.hint("merge"), same, "left").select(
        *[rows[c] for c in rows.columns if c not in ("digit", "rest", "gid", "members", "row_id")],
        F.col("next_gid").alias("gid"), F.coalesce(groups["members"], F.lit(1)).alias("members"),
        F.when(F.col("next_gid").isNotNull(),
               F.expr(f"substring(rest, {width + 1})")).alias("rest"),
        F.monotonically_increasing_id().alias("row_id"))
    return cut_lineage(out, "radix_round")


def exact_classes(docs: DataFrame, first_digit: int = FIRST_DIGIT, growth: int = GROWTH,
                  max_digit: int = MAX_DIGIT, row: str | None = None) -> DataFrame:
    """Every row of ``docs`` with its class: ``class_id`` (null for a text without
    copies), ``n_points`` (code points of the original), ``text_sha256`` and the column ``row``."""
    text = text_or_empty()
    own = ["doc_id", row] if row else ["doc_id"]
    rows = docs.select(*own, F.length(text).alias("n_points"), normalised(text).alias("norm")).select(
        *own, "n_points", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.octet_length("norm").alias("n_bytes"), F.col("norm").cast("binary").alias("rest"))
    done, width, at = [], first_digit, first_digit
    live = _split(rows, ["n_bytes"], width)
    while True:
        # ended: every byte of these texts has been compared
        over = (F.col("members") == 1) | (F.col("n_bytes") <= at)
        done.append(live.filter(over).drop("rest").withColumn("round", F.lit(len(done))))
        live = live.filter(~over)
        if live.isEmpty():
            break
        width = min(width * growth, max_digit)
        at += width
        live = _split(live, ["gid"], width)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    # (round, gid) names a class that ended in that round
    return out.withColumn("class_id", F.when(F.col("members") > 1, F.struct("round", "gid"))).drop("gid", "round")


def exact_dedup(docs: DataFrame, row: str | None = None, **digits) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256 and, if given, the column
    ``row``. Of equal texts the row with the most code points stays, then the smallest doc_id."""
    rows = exact_classes(docs, row=row, **digits)
    own = [row] if row else []
    copies = rows.filter("class_id is not null")
    best = F.min(F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("z"), F.col("doc_id"),
                          F.col("row_id")))
    keep = copies.groupBy("class_id").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    in_class = copies.join(keep.hint("merge"), "class_id").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("best.row_id")).alias("kept"), "text_sha256", *own)
    alone = rows.filter("class_id is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256", *own)
    return in_class.unionByName(alone)


SQL = r"""
with t as (
  select doc_id, length(coalesce(text, '')) as n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size,
       row_number() over w = 1 as kept, sha256(norm) as text_sha256
from t window w as (partition by norm order by n desc, doc_id nulls last)
"""
