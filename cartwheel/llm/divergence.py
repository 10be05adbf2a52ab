r"""Operator 13, divergence of sources by a transducer vocabulary.

Per language the terms in enough documents are kept, sorted and cut into shards. Each shard is
built in one pass over its sorted terms into a minimal acyclic transducer: equal ends are shared,
and a transition carries the number of terms before it, so that a term's outputs add up to
its place. With the places of the shards before, that is the term's ordinal in its language, in
code-point (and so UTF-8) order. Text is then streamed through the transducers and counted again by
ordinal; from there on, terms are integers, and ordinals break ties. Only terms that a report shows
are read back, by walking a shard down to the ordinal.

A transducer is four arrays (transitions sorted by state and letter, their targets and outputs,
final states), some 30 bytes a term. A task counts the terms of its texts, by bytes, and whenever it
holds ``FLUSH`` of them all distinct ones walk at once.

Pair sums: L1 distances of sources over blocks of ``WIDTH`` ordinals, between two sets of about
``SIDE`` sources each, so a task's matrix is bounded whatever the vocabulary and the number of
sources. A cell without occurrences has its group's least value, which fills the matrix. No row is
made for a pair and a term.

Scale: (language, term) counts are partial sums before their shuffle. The transducers are broadcast in
blocks of at most ``BLOCK`` bytes (and a shard), of which the driver holds one at a time; each block
reads the texts of its languages once and writes its counts, so some two million kept terms need
one reading. Counts are added up within a task before they are shuffled as (group, ordinal).
A report of pairs has, by definition, the square of a language's sources.

Defined cases: null text, lang and source are empty strings; each row is a document; a language
without kept terms gives pairs of value 0 and no terms; a language of one source gives no pairs; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, map_arrow, ship, slices, text_or_empty

ship(__name__)

FEWEST, SMOOTH, UNIT, TOP = 30, 5, 1_000_000_000, 50
SHARD = 1 << 15         # terms of a transducer
BLOCK = 64 << 20        # bytes of transducers that a task holds
WIDTH, SIDE = 1024, 128     # ordinals, and sources of each side, of a matrix
FLUSH = 300_000         # terms, and counts by ordinal, that a task holds before it goes on with them
#: of a text's UTF-8 bytes: A-Z in lower case, and white space for what is in no term
_LETTERS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_BITS = 21              # of a code point
_SHARDS = "lang string, n_terms int, first string, last string, keys binary, targets binary, outs binary, finals binary"


def _rows(held: dict, names: list[str], kinds: list[pa.DataType]):
    """A batch for each key of ``held``: its parts, the counted things and their counts."""
    for key, counts in held.items():
        k = len(counts)
        parts = [pa.array([x] * k, pa.string()) for x in (key if isinstance(key, tuple) else (key,))]
        yield pa.RecordBatch.from_arrays([*parts, *(pa.array(list(x), kind) for x, kind in zip((counts.keys(), counts.values()), kinds))], names=names)
    held.clear()


def _document_counts(batches):
    held: dict[str, Counter] = defaultdict(Counter)
    for batch in slices(batches, 500):
        for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            held[lang].update(set(text.translate(_LETTERS).split()))
        if sum(map(len, held.values())) > FLUSH:
            yield from _rows(held, ["lang", "term", "n"], [pa.binary(), pa.int64()])
    yield from _rows(held, ["lang", "term", "n"], [pa.binary(), pa.int64()])


def kept_terms(docs: DataFrame, fewest: int = FEWEST) -> DataFrame:
    """(lang, term) of the terms in at least ``fewest`` documents of a language."""
    texts = docs.select(text_or_empty("lang").alias("lang"), text_or_empty().cast("binary").alias("text"))
    terms = texts.mapInArrow(_document_counts, "lang string, term binary, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    return terms.filter(F.col("n") >= fewest).select("lang", F.col("term").cast("string").alias("term"))


class Transducer:
    """Arrays of a minimal acyclic transducer; the root is the last state."""

    def __init__(self, keys, targets, outs, finals):
        self.keys, self.targets, self.outs, self.finals = keys, targets, outs, finals

    @classmethod
    def build(cls, terms: Iterable[str]) -> Transducer:
        """From distinct terms in code-point order."""
        known: dict[tuple, int] = {}
        states: list[tuple] = []
        path: list[list] = [[False, []]]        # open states of the last term: final, transitions
        last = ""

        def close(depth: int) -> None:
            while len(path) - 1 > depth:
                final, edges = path.pop()
                state = (final, tuple(edges))
                if state not in known:
                    known[state] = len(states)
                    states.append(state)
                path[-1][1].append((last[len(path) - 1], known[state]))

        for term in terms:
            same = next((i for i, (a, b) in enumerate(zip(last, term)) if a != b), min(len(last), len(term)))
            close(same)
            path.extend([False, []] for _ in range(len(term) - same))
            path[-1][0] = True
            last = term
        close(0)
        states.append((path[0][0], tuple(path[0][1])))
        held: list[int] = []                    # terms from a state on; targets come first
        keys, targets, outs = [], [], []
        for number, (final, edges) in enumerate(states):
            n = int(final)
            for letter, target in edges:
                keys.append(number << _BITS | ord(letter))
                targets.append(target)
                outs.append(n)
                n += held[target]
            held.append(n)
        return cls(np.array(keys, "int64"), np.array(targets, "int64"), np.array(outs, "int64"), np.array([s[0] for s in states], "bool"))

    def term(self, ordinal: int) -> str:
        state, letters = len(self.finals) - 1, []
        while ordinal or not self.finals[state]:
            lo, hi = np.searchsorted(self.keys, [state << _BITS, (state + 1) << _BITS])
            edge = lo + np.searchsorted(self.outs[lo:hi], ordinal, "right") - 1
            letters.append(chr(int(self.keys[edge]) & (1 << _BITS) - 1))
            ordinal -= int(self.outs[edge])
            state = int(self.targets[edge])
        return "".join(letters)


def _shards(part):
    """(lang, Transducer, terms) runs of a partition sorted by (lang, term)."""
    lang, terms = None, []
    for batch in part:
        for one, term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if terms and (one != lang or len(terms) == SHARD):
                yield lang, terms
                terms = []
            lang = one
            terms.append(term)
    if terms:
        yield lang, terms


def build_vocabulary(kept: DataFrame) -> DataFrame:
    """The written table of transducers: shard (lang, n_terms, first, last, arrays), ``base`` (ordinals of
    the language before it) and its place ``shard`` in the language."""
    def build(batches):
        for lang, terms in _shards(batches):
            t = Transducer.build(terms)
            arrays = [t.keys.tobytes(), t.targets.astype("int32").tobytes(), t.outs.astype("int32").tobytes(), t.finals.tobytes()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([len(terms)], pa.int32()), pa.array(terms[:1]), pa.array(terms[-1:]), *(pa.array([a], pa.binary()) for a in arrays)],
                names=["lang", "n_terms", "first", "last", "keys", "targets", "outs", "finals"])

    n = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    built = cut_lineage(kept.repartitionByRange(n, "lang", "term").sortWithinPartitions("lang", "term").mapInArrow(build, _SHARDS), "shards")
    before = Window.partitionBy("lang").orderBy("first")        # a row for some thousands of terms
    places = built.select("lang", "first", F.coalesce(F.sum("n_terms").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
                          (F.row_number().over(before) - 1).alias("shard"))
    return cut_lineage(built.join(places, ["lang", "first"]), "vocabulary")


def _transducer(row) -> Transducer:
    return Transducer(np.frombuffer(row["keys"], "int64"), np.frombuffer(row["targets"], "int32"),
                      np.frombuffer(row["outs"], "int32"), np.frombuffer(row["finals"], "bool"))


class Block:
    """Shards joined into one table of transitions."""

    def __init__(self, rows):
        self.firsts, self.places, self.longest = defaultdict(list), defaultdict(list), 0
        keys, targets, outs, finals, at = [], [], [], [], 0
        for row in sorted(rows, key=lambda r: (r["lang"], r["first"])):
            t = _transducer(row)
            self.firsts[row["lang"]].append(row["first"])
            self.places[row["lang"]].append((at + len(t.finals) - 1, row["base"]))
            keys.append(t.keys + (at << _BITS))
            targets.append(t.targets.astype("int64") + at)
            outs.append(t.outs)
            finals.append(t.finals)
            at += len(t.finals)
        self.keys, self.targets, self.outs, self.finals = map(np.concatenate, (keys, targets, outs, finals))

    def ordinals(self, lang: str, terms: list[str]) -> np.ndarray:
        """The ordinals of terms, -1 for those that no shard here has."""
        out = np.full(len(terms), -1, "int64")
        firsts, places = self.firsts[lang], self.places[lang]
        order = sorted(range(len(terms)), key=lambda i: len(terms[i]))
        at = 0
        while at < len(order):      # lengths rise; a matrix of letters has at most four million, or one term
            stop = at + 1
            while stop < len(order) and (stop + 1 - at) * len(terms[order[stop]]) <= 1 << 22:
                stop += 1
            some, at = order[at:stop], stop
            letters = np.array([terms[i] for i in some])
            letters = letters.view(np.uint32).reshape(len(some), -1)
            ends = np.array([len(terms[i]) for i in some])
            shard = np.array([bisect_right(firsts, terms[i]) - 1 for i in some])
            state = np.array([places[s][0] for s in shard], "int64")
            total = np.array([places[s][1] for s in shard], "int64")
            alive = shard >= 0
            for k in range(letters.shape[1]):
                go = np.flatnonzero(alive & (ends > k))
                if not len(go):
                    break
                key = state[go] << _BITS | letters[go, k]
                edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                found = self.keys[edge] == key
                alive[go[~found]] = False
                go, edge = go[found], edge[found]
                total[go] += self.outs[edge]
                state[go] = self.targets[edge]
            alive &= self.finals[state]
            out[np.array(some)[alive]] = total[alive]
        return out


def _count(shared):
    def run(batches):
        block: Block = shared.value
        held: dict[tuple[str, str], Counter] = defaultdict(Counter)         # of ordinals
        terms: dict[tuple[str, str], Counter] = defaultdict(Counter)        # not yet walked

        def walk():
            by_lang = defaultdict(set)
            for (lang, _), counts in terms.items():
                by_lang[lang].update(counts)
            known = {}
            for lang, some in by_lang.items():
                some = list(some)
                known[lang] = dict(zip(some, block.ordinals(lang, [t.decode() for t in some]).tolist()))
            for (lang, source), counts in terms.items():
                ordinal, here = known[lang], held[lang, source]
                for term, n in counts.items():
                    if (o := ordinal[term]) >= 0:
                        here[o] += n
            terms.clear()

        for batch in slices(batches, 500):
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                terms[lang, source].update(text.translate(_LETTERS).split())
            if sum(map(len, terms.values())) > FLUSH:
                walk()
                if sum(map(len, held.values())) > FLUSH:
                    yield from _rows(held, ["lang", "source", "ordinal", "n"], [pa.int64(), pa.int64()])
        walk()
        yield from _rows(held, ["lang", "source", "ordinal", "n"], [pa.int64(), pa.int64()])
    return run


def blocks(vocabulary: DataFrame, limit: int = BLOCK) -> Iterable[list]:
    """The shards' (lang, shard), in runs of at most ``limit`` bytes or one shard."""
    size = F.length("keys") + F.length("targets") + F.length("outs") + F.length("finals")
    run, used = [], 0
    # one small row for some thousands of terms
    for row in sorted(vocabulary.select("lang", "shard", size.alias("size")).collect(), key=lambda r: (r["lang"], r["shard"])):
        if run and used + row["size"] > limit:
            yield run
            run, used = [], 0
        run.append((row["lang"], row["shard"]))
        used += row["size"]
    if run:
        yield run


def recount(docs: DataFrame, vocabulary: DataFrame, limit: int = BLOCK) -> DataFrame:
    """The written table (lang, source, ordinal, n) of the kept terms that occur."""
    spark = docs.sparkSession
    texts = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"), text_or_empty().cast("binary").alias("text"))
    parts = []
    for run in blocks(vocabulary, limit):
        langs = sorted({lang for lang, _ in run})
        wanted = spark.createDataFrame(run, "lang string, shard int")
        shared = spark.sparkContext.broadcast(Block(vocabulary.join(F.broadcast(wanted), ["lang", "shard"]).collect()))
        counts = texts.filter(F.col("lang").isin(langs)).mapInArrow(_count(shared), "lang string, source string, ordinal long, n long")
        parts.append(cut_lineage(counts.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "counts"))
        shared.destroy()
    if not parts:
        return spark.createDataFrame([], "lang string, source string, ordinal long, n long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _share(n: str, total: str, v: str) -> Column:
    """1 + floor(UNIT * (n + SMOOTH) / (total + SMOOTH * v)), exactly."""
    return (1 + F.expr(f"(cast({UNIT} as decimal(10,0)) * cast({n} + {SMOOTH} as decimal(20,0))) div cast({total} + {SMOOTH} * {v} as decimal(20,0))")).cast("long")


def pair_part(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, item, value): L1 distances of the sources of a language. ``groups``: lang,
    source, total, v, side (its set of sources), sides (how many); ``counts``: these and ordinal, n."""
    tiles = F.explode(F.transform(F.sequence(F.lit(0), F.col("sides") - 1), lambda j: F.struct(
        F.least("side", j).alias("i"), F.greatest("side", j).alias("j")))).alias("tile")
    cols = ["lang", "source", "side", tiles, "block", "v", "p", "at"]
    blank = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.expr(f"cast(greatest(v - 1, 0) div {WIDTH} as int)"))))
    least = blank.withColumn("p", F.when(F.col("v") > 0, _share("0L", "total", "v")).otherwise(0).cast("long")).withColumn("at", F.lit(-1)).select(cols)
    cells = counts.withColumn("block", F.expr(f"cast(ordinal div {WIDTH} as int)")).withColumn("p", _share("n", "total", "v")).withColumn(
        "at", F.expr(f"cast(ordinal % {WIDTH} as int)")).select(cols)
    rows = least.unionByName(cells).select("lang", "source", "side", "tile.i", "tile.j", "block", "v", "p", "at")

    def distances(pdf: pd.DataFrame) -> pd.DataFrame:
        lang, i, j, width = pdf["lang"].iat[0], pdf["i"].iat[0], pdf["j"].iat[0], int(min(WIDTH, pdf["v"].iat[0] - WIDTH * pdf["block"].iat[0]))
        blank = pdf["at"] < 0
        sources, sides, least = (pdf.loc[blank, c].to_numpy() for c in ("source", "side", "p"))
        place = {s: k for k, s in enumerate(sources)}
        matrix = np.repeat(least[:, None], max(width, 0), axis=1)
        cells = pdf[~blank]
        matrix[[place[s] for s in cells["source"]], cells["at"].to_numpy()] = cells["p"].to_numpy()
        out = []
        for a in np.flatnonzero(sides == i):
            others = np.flatnonzero(sides == j) if i != j else np.arange(a + 1, len(sources))
            for b, value in zip(others, np.abs(matrix[others] - matrix[a]).sum(axis=1)):
                out += [(lang, sources[a], sources[b], int(value)), (lang, sources[b], sources[a], int(value))]
        return pd.DataFrame(out, columns=["lang", "source", "item", "value"])

    each = rows.groupBy("lang", "i", "j", "block").applyInPandas(distances, "lang string, source string, item string, value long")
    return each.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))


def _read_back(wanted: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(lang, ordinal, item) of (lang, ordinal)."""
    places = F.broadcast(vocabulary.select("lang", "shard", "base", "n_terms"))     # a row for some thousands of terms
    found = wanted.distinct().join(places, "lang").filter("ordinal >= base and ordinal < base + n_terms")
    lists = found.groupBy("lang", "shard").agg(F.collect_list("ordinal").alias("ordinals"))      # at most a shard's terms

    def start():
        def work(langs, bases, ordinals, *arrays):
            out = {"lang": [], "ordinal": [], "item": []}
            for lang, base, some, *parts in zip(langs, bases, ordinals, *arrays):
                t = _transducer(dict(zip(("keys", "targets", "outs", "finals"), parts)))
                out["lang"] += [lang] * len(some)
                out["ordinal"] += some
                out["item"] += [t.term(o - base) for o in some]
            return out
        return work

    rows = lists.join(vocabulary, ["lang", "shard"]).select("lang", "base", "ordinals", "keys", "targets", "outs", "finals")
    return map_arrow(rows, "lang string, ordinal long, item string", start, rows=16)


def term_part(groups: DataFrame, counts: DataFrame, vocabulary: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a source has most above its language."""
    langs = groups.groupBy("lang").agg(F.sum("total").alias("all_total"))
    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("all_n")).join(langs, "lang")
    rows = counts.join(whole, ["lang", "ordinal"]).withColumn("value", _share("n", "total", "v") - _share("all_n", "all_total", "v")).filter("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    shown = cut_lineage(rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", "source", "ordinal", "value", "rank"), "shown_terms")
    return shown.join(_read_back(shown.select("lang", "ordinal"), vocabulary), ["lang", "ordinal"]).select("lang", "source", "item", "value", "rank")


def audit(docs: DataFrame, fewest: int = FEWEST, top: int = TOP, limit: int = BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank."""
    docs = docs.select("text", "lang", "source")
    vocabulary = build_vocabulary(kept_terms(docs, fewest))
    counts = recount(docs, vocabulary, limit)
    sizes = vocabulary.groupBy("lang").agg(F.sum("n_terms").alias("v"))
    groups = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source")).distinct()
    of_lang = groups.groupBy("lang").agg(F.ceil(F.count("*") / SIDE).cast("int").alias("sides"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = cut_lineage(groups.join(of_lang, "lang").join(sizes, "lang", "left").join(totals, ["lang", "source"], "left").select(
        "lang", "source", "sides", F.expr("cast(pmod(xxhash64(source), sides) as int)").alias("side"),
        F.coalesce("v", F.lit(0)).cast("long").alias("v"), F.coalesce("total", F.lit(0)).alias("total")), "groups")
    counts = counts.join(groups, ["lang", "source"])
    pairs = pair_part(groups, counts)
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    terms = term_part(groups, counts, vocabulary, top)
    return pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


SQL = r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
o as (select r, lang, source, unnest(w) as term from d),
kept as (select lang, term from o group by lang, term having count(distinct r) >= 30),
size as (select lang, count(*) as v from kept group by lang),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from o join kept using (lang, term) group by lang, source, term),
cell as (
  select g.lang, g.source, kept.term, coalesce(c.n, 0) as n
  from g join kept using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = kept.term),
p as (
  select lang, source, term, n, 1 + (1000000000::hugeint * (n + 5)) // (sum(n) over (partition by lang, source) + 5 * v)::hugeint as p
  from cell join size using (lang)),
q as (
  select lang, term, 1 + (1000000000::hugeint * (n + 5)) // (sum(n) over (partition by lang) + 5 * v)::hugeint as q
  from (select lang, term, sum(n)::hugeint as n from cell group by lang, term) join size using (lang)),
pairs as (
  select a.lang, a.source, b.source as item, coalesce(f, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join (select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as f
             from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by x.lang, x.source, y.source) s
    on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (select p.lang, p.source, p.term as item, p.p - q.q as value from p join q using (lang, term) where n > 0 and p.p > q.q),
every as (select *, 'pair' as part from pairs union all select *, 'term' as part from terms)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from every)
where part = 'pair' or rank <= 50
"""
