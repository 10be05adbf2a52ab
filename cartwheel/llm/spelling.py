r"""Operator 12, spelling variants by a dictionary of trie-node pairs.

The words form a trie, and read backwards a second one; each node of either has an integer. A
word w with a place i then gives pairs of integers: (node of w[:i], backward node of w[i:]) is the
word itself; (node of w[:i], backward node of w[i+1:]) is the word with the letter at i skipped.
Two words that differ by one replaced letter have a skipping pair in common, at one place only; a
word with one letter more skips it into a pair of the other word (of a run of equal letters only
the first counts, so each such couple is found once). So one grouping by pairs gives exact
neighbours. A group's words differ at one place, so it has at most one word for each letter of
the alphabet, and one whole word.

Numbering: words are sorted by range, and each range runs through its words once, keeping the
nodes of the word before; a node is new behind the common prefix. The first nodes of a range may
have been met before it; ``_numbered`` reads each range's first and last word (as many rows as
ranges) and gives these nodes their earlier numbers. A word of any length costs its length.

A word's form is its near word of largest count, the smallest such word, if it counts at least
``RATIO`` times the word. Forms are followed by joining the pointers with themselves until none leads
on; counts grow ``RATIO``-fold with each step, so chains are short.

Scale: texts are counted with partial sums before the one shuffle of words; all else is the size
of the vocabulary: two sorts, one grouping of 2 x (length + 1) rows a word, one a word, and joins on
word numbers. Only the ends of ranges reach the driver.

Defined cases: null text has no words; a null doc_id is written as nothing; null words and
counts are left out; an empty table gives an empty result; extra columns are ignored; repeated
rows count again. The table of counts must have one row a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from .common import cut_lineage, ship, slices, text_or_empty

ship(__name__)

LETTERS = "[a-zÀ-ÿ]"      # after A-Z are lower-cased
SHORTEST, FEWEST, RATIO, ONE_IN = 6, 5, 5, 199
_PART = 1 << 40     # numbers of a range start at its place times this


def planted_words(docs: DataFrame, shortest: int = SHORTEST, one_in: int = ONE_IN) -> DataFrame:
    """Every occurrence of a word of at least ``shortest`` letters: (word). In about one of
    ``one_in`` a letter is deleted, by the crc32 of the doc_id and the word."""
    lower = F.translate(text_or_empty(), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lower, F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))).alias("run"))
    code = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = (F.col("code") % F.length("run")).cast("int")
    kept = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.withColumn("code", code).select(
        F.when(F.col("code") % one_in == 0, kept).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= shortest)


def count_words(words: DataFrame, fewest: int = FEWEST) -> DataFrame:
    """(word, n) of the words that occur at least ``fewest`` times."""
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= fewest)


def common_prefix(a: str, b: str) -> int:
    if b.startswith(a):
        return len(a)
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _nodes(at: int):
    """Adds each word's nodes, the range's place and the word's number in order; words come sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, path, made, rows = "", [part * _PART], part * _PART + 1, part * _PART
        for batch in slices(batches, 2000):
            lists, fresh = [], []
            for word in batch.column(at).to_pylist():
                same = common_prefix(last, word)
                path = [*path[:same + 1], *range(made, made + len(word) - same)]
                made += len(word) - same
                last = word
                lists.append(path)
                fresh.append([x != y for x, y in zip(word, "\0" + word)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lists, pa.list_(pa.int64())), pa.array(fresh, pa.list_(pa.bool_())),
                 pa.array([part] * len(lists), pa.int64()), pa.array(range(rows, rows + len(lists)), pa.int64())],
                names=[*batch.schema.names, "nodes", "fresh", "part", "number"])
            rows += len(lists)
    return run


def _numbered(words: DataFrame, key: str) -> DataFrame:
    """``words`` with the trie nodes of each prefix of ``key`` (``nodes``), which of its letters
    differ from the one before (``fresh``), and the word's number in the order of ``key``."""
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType(words.schema.fields + StructType.fromDDL("nodes array<long>, fresh array<boolean>, part long, number long").fields)
    table = cut_lineage(words.repartitionByRange(n, key).sortWithinPartitions(key).mapInArrow(_nodes(words.columns.index(key)), schema), "nodes")
    end = F.struct(key, "nodes")
    ends = table.groupBy("part").agg(F.min_by(end, "number").alias("first"), F.max_by(end, "number").alias("last")).collect()
    before, known = "", []
    earlier = []        # part, the numbers that the first nodes of the range have from before it
    for row in sorted(ends, key=lambda r: r["part"]):
        shared = known[:common_prefix(before, row["first"][0]) + 1]
        earlier.append((row["part"], shared))
        before = row["last"][0]
        known = [shared[d] if d < len(shared) and x == row["part"] * _PART + d else x for d, x in enumerate(row["last"][1])]
    ranges = words.sparkSession.createDataFrame(earlier, StructType().add("part", LongType()).add("earlier", ArrayType(LongType())))
    nodes = F.transform("nodes", lambda x, d: F.coalesce(F.when(x == F.col("part") * _PART + d, F.get("earlier", d)), x))
    # bounded: a row a range
    return table.join(F.broadcast(ranges), "part").withColumn("nodes", nodes).drop("part", "earlier")


def near_words(words: DataFrame) -> DataFrame:
    """``number``, ``n_near`` and the best near word (``best``: n, -number) of each word with one; from ``_tries``."""
    a, b, fresh = F.col("nodes"), F.col("back"), F.col("fresh")
    size = F.size("fresh")
    skips = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        a[i].alias("a"), b[size - i - 1].alias("b"), F.when(fresh[i], 1).otherwise(0).alias("kind")))
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(a[i].alias("a"), b[size - i].alias("b"), F.lit(2).alias("kind")))
    pairs = words.filter(size > 0).select("number", "n", F.explode(F.concat(skips, whole)).alias("p")).select("number", "n", "p.*")
    # at most a word a letter, and one whole word
    groups = pairs.groupBy("a", "b").agg(F.collect_list(F.struct("n", (-F.col("number")).alias("minus"), "kind")).alias("g")).filter(F.size("g") > 1)

    def near(m):
        return lambda x: (x["minus"] != m["minus"]) & (
            ((m["kind"] < 2) & (x["kind"] < 2)) | ((m["kind"] == 2) & (x["kind"] == 1)) | ((m["kind"] == 1) & (x["kind"] == 2)))

    each = groups.select(F.explode(F.transform("g", lambda m: F.struct((-m["minus"]).alias("number"), F.filter("g", near(m)).alias("near")))).alias("m"))
    each = each.select("m.number", F.size("m.near").alias("k"), F.array_max("m.near").alias("best")).filter("k > 0")
    return each.groupBy("number").agg(F.sum("k").alias("n_near"), F.max(F.struct("best.n", "best.minus")).alias("best"))


def _tries(counts: DataFrame) -> DataFrame:
    """word, n, number (in code-point order), nodes, back (nodes of the word read backwards), fresh."""
    words = counts.select("word", F.col("n").cast("long").alias("n")).filter("word is not null and n is not null")
    back = _numbered(words.withColumn("reversed", F.reverse("word")), "reversed")
    return _numbered(back.select("word", "n", F.col("nodes").alias("back")), "word")


def _roots(forms: DataFrame) -> DataFrame:
    """(number, root) from (number, form): where following forms ends."""
    roots = cut_lineage(forms.select("number", F.col("form").alias("root")), "roots")
    while True:
        step = roots.select(F.col("number").alias("root"), F.col("root").alias("further"))
        roots = cut_lineage(roots.join(step, "root", "left").select(
            "number", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if roots.filter("moved").isEmpty():
            return roots.drop("moved")
        roots = roots.drop("moved")


def group_variants(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Per word of (word, n): word, form, root, n, n_near, form_n."""
    words = cut_lineage(_tries(counts), "tries")
    near = near_words(words)
    judged = cut_lineage(words.select("number", "word", "n").join(near, "number", "left").select(
        "number", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best.n") >= ratio * F.col("n"), F.struct((-F.col("best.minus")).alias("form"), F.col("best.n").alias("form_n"))).alias("f")), "near_words")
    forms = judged.filter("f is not null").select("number", "f.form")
    names = words.select("number", "word")
    ends = forms.join(_roots(forms), "number")
    ends = ends.join(names.toDF("form", "form_word"), "form").join(names.toDF("root", "root_word"), "root").select("number", "form_word", "root_word")
    return judged.join(ends, "number", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", F.col("f.form_n").alias("form_n"))


SQL = r"""
with recursive runs as (
  select coalesce(cast(doc_id as varchar), '') as d, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run from documents),
counted as (select d, run, count(*) as k from runs where length(run) >= 6 group by d, run),
bytes as (
  select *, flatten(list_transform(string_split(d || ':' || run, ''), lambda c: case when unicode(c) < 128 then [unicode(c)::bigint]
      else [(192 | (unicode(c) >> 6))::bigint, (128 | (unicode(c) & 63))::bigint] end)) as b from counted),
bits as (
  select d, run, k, flatten(list_transform(b, lambda x: [x & 1, (x >> 1) & 1, (x >> 2) & 1, (x >> 3) & 1,
      (x >> 4) & 1, (x >> 5) & 1, (x >> 6) & 1, (x >> 7) & 1])) as bit from bytes),
coded as (
  select run, k, xor(list_reduce([4294967295::bigint] || bit,
      lambda c, x: case when xor(c & 1, x) = 1 then xor(c >> 1, 3988292384) else c >> 1 end), 4294967295) as h from bits),
shown as (
  select k, case when h % 199 = 0 then substr(run, 1, cast(h % length(run) as int)) || substr(run, cast(h % length(run) as int) + 2) else run end as word
  from coded),
v as (select word, cast(sum(k) as bigint) as n from shown where length(word) >= 6 group by word having sum(k) >= 5),
skip as (select word, n, substr(word, 1, i) as pre, substr(word, i + 2) as post from (select word, n, unnest(range(length(word))) as i from v)),
near as (
  select a.word, b.word as other, b.n from skip a join skip b on a.pre = b.pre and a.post = b.post and a.word <> b.word
  union select s.word, v.word, v.n from skip s join v on s.pre || s.post = v.word
  union select v.word, s.word, s.n from skip s join v on s.pre || s.post = v.word),
best as (
  select word, other, n as form_n, count(*) over (partition by word) as n_near,
         row_number() over (partition by word order by n desc, other) as place from near),
formed as (
  select v.word, v.n, coalesce(n_near, 0) as n_near, case when form_n >= 5 * v.n then other end as form,
         case when form_n >= 5 * v.n then form_n end as form_n
  from v left join best on v.word = best.word and place = 1),
chain(word, tip) as (
  select word, word from formed
  union all select chain.word, formed.form from chain join formed on chain.tip = formed.word where formed.form is not null)
select f.word, f.form, c.tip as root, f.n, f.n_near, f.form_n
from formed f join chain c on f.word = c.word join formed e on c.tip = e.word and e.form is null
"""
