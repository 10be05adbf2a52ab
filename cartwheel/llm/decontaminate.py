"""Operator 2, benchmark decontamination: a distributed positional inverted index.

The index is partitioned by document: a task turns its slice of documents into
postings, (term, position) pairs sorted by term and then position, for the
terms of the test set (no other term can take part in a match). A test window
is answered from its rarest term: that term's positions, moved back by the
term's offset, are the candidate starts; each further term, in order of
rarity, keeps the candidates whose offset-adjusted position is in its own list.
What is left after the last term are all exact phrase matches. A proximity
match lets each term lie up to ``slop`` words from its place.

Scale: documents are not shuffled. The test set is a stated query set; its different
(item, text) rows are written once, cut into blocks of about ``BLOCK_BYTES`` bytes of text (checked
per block), and each block is read by the driver, sent to the tasks and let go of
before the next one, and run against all rows.

Defined cases: null or wordless texts have no words and match nothing; a
wordless item has no window; a null item_id is named "null"; items that share
an id count once; repeated rows each keep their row; extra columns are ignored.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, map_arrow, ship

ship(__name__)

WIDTH = 10
BLOCK_BYTES = 4 << 20
_PIECE = 2_000_000      # candidates held at once


def _word_table() -> bytes:
    """Byte map: A-Z lower-cased, other ASCII outside 0-9 a-z to a blank, the rest kept."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for c in b"0123456789abcdefghijklmnopqrstuvwxyz":
        table[c] = c
        if c >= 97:
            table[c - 32] = c
    return bytes(table)


WORDS = _word_table()


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORDS).split() if text else []


def query_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """The test set in blocks, each read when it is asked for; every block's size is measured
    before. Without a text there is one empty block."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                             F.col("text").cast("binary").alias("text")).filter("text is not null")
    # copies count once, and would always share a block
    items = cut_lineage(items.distinct(), "benchmark_items")
    size = items.agg(F.sum(F.octet_length("text")), F.max(F.octet_length("text"))).first()
    if not size[0]:
        yield []
        return
    limit = max(block_bytes, size[1])          # one item is never cut
    n = math.ceil(size[0] / limit)
    while True:
        block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
        largest = items.groupBy(block.alias("b")).agg(F.sum(F.octet_length("text")).alias("s")).agg(F.max("s")).first()[0]
        if largest <= 2 * limit:
            break
        n *= 2
    for b in range(n):
        yield [(r["item"], r["text"]) for r in items.filter(block == b).collect()]


def build_windows(items: list[tuple[str, bytes]], width: int):
    """Term ids of a block and, by window length, (matrix of term ids, items of each row)."""
    vocab: dict[bytes, int] = {}
    owners: dict[tuple, set[str]] = {}
    for item, text in items:
        ids = [vocab.setdefault(w, len(vocab)) for w in words_of(text)]
        n = min(width, len(ids))
        for at in range(len(ids) - n + 1 if n else 0):
            owners.setdefault(tuple(ids[at:at + n]), set()).add(item)
    by_length: dict[int, tuple[list, list]] = {}
    for window, names in owners.items():
        rows, who = by_length.setdefault(len(window), ([], []))
        rows.append(window)
        who.append(sorted(names))
    return vocab, {n: (np.array(rows, dtype=np.int64), who) for n, (rows, who) in by_length.items()}


class Postings:
    """A slice's positional index: sorted keys term * span + position."""

    def __init__(self, ids: np.ndarray, n_terms: int):
        self.span = max(1, len(ids))
        at = np.flatnonzero(ids >= 0)
        terms = ids[at].astype(np.int64)
        order = np.argsort(terms, kind="stable")
        self.pos = at[order]
        self.keys = terms[order] * self.span + self.pos
        self.count = np.bincount(terms, minlength=n_terms)
        self.first = np.concatenate(([0], np.cumsum(self.count)))

    def near(self, terms: np.ndarray, at: np.ndarray, slop: int) -> np.ndarray:
        """Does the term's list have a position within ``slop`` of ``at``?"""
        low, high = np.maximum(at - slop, 0), np.minimum(at + slop, self.span - 1)
        i = np.searchsorted(self.keys, terms * self.span + low)
        ok = (i < len(self.keys)) & (at + slop >= 0) & (at - slop < self.span)
        return ok & (self.keys[np.minimum(i, len(self.keys) - 1)] <= terms * self.span + high)

    def matches(self, windows: np.ndarray, slop: int = 0):
        """(row of ``windows``, start) of every match."""
        live = np.flatnonzero((self.count[windows] > 0).all(axis=1))
        if not len(live):
            return
        terms = windows[live]
        order = np.argsort(self.count[terms], axis=1, kind="stable")
        rarest = np.take_along_axis(terms, order, axis=1)
        sizes = self.count[rarest[:, 0]]
        ends = np.cumsum(sizes)
        begin = 0
        while begin < len(live):
            # a run of windows whose candidates fit in memory together
            done = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, done + _PIECE, side="right")))
            w = np.repeat(np.arange(begin, stop), sizes[begin:stop])
            within = np.arange(len(w)) - np.repeat(ends[begin:stop] - sizes[begin:stop] - done, sizes[begin:stop])
            start = self.pos[self.first[rarest[w, 0]] + within] - order[w, 0]
            for k in range(1, terms.shape[1]):
                ok = self.near(rarest[w, k], start + order[w, k], slop)
                w, start = w[ok], start[ok]
            yield live[w], start
            begin = stop


def _encode(texts: list[bytes | None], vocab: dict[bytes, int], gap: int):
    """Term ids of a slice with ``gap`` blanks between documents, and where each begins."""
    parts, begins, lengths, at = [], [], [], 0
    blank = np.full(gap, -1, dtype=np.int32)
    for text in texts:
        ids = np.fromiter(map(vocab.get, words := words_of(text), repeat(-1)), np.int32, len(words))
        parts += [ids, blank]
        begins.append(at)
        lengths.append(len(ids))
        at += len(ids) + gap
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return ids, np.array(begins, dtype=np.int64), np.array(lengths, dtype=np.int64)


def _ranges(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [{"start": int(a), "stop": int(b)} for a, b in zip(edge[::2], edge[1::2])]


def _merge(old: list[dict], new: list[dict]) -> list[dict]:
    out: list[dict] = []
    for r in sorted([*old, *new], key=lambda r: (r["start"], r["stop"])):
        if out and r["start"] <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], r["stop"])
        else:
            out.append(dict(r))
    return out


HIT_SCHEMA = ("doc_id {}, text binary, n_words long, items array<string>, "
              "spans array<struct<start: long, stop: long>>")


def _scan_block(block, width: int):
    def start():
        vocab, windows = build_windows(block.value, width)

        def work(doc_ids, texts, n_words, items, spans):
            ids, begins, lengths = _encode(texts, vocab, 1)
            index = Postings(ids, len(vocab))
            edges = np.zeros(len(ids) + 1, np.int64)
            found: dict[int, set[str]] = {}
            for n, (matrix, who) in windows.items():
                for rows, at in index.matches(matrix):
                    np.add.at(edges, at, 1)
                    np.add.at(edges, at + n, -1)
                    doc = np.searchsorted(begins, at, side="right") - 1
                    for d, r in np.unique(np.column_stack((doc, rows)), axis=0).tolist():
                        found.setdefault(d, set()).update(who[r])
            hit = np.cumsum(edges[:-1]) > 0
            items = [sorted({*(old or ()), *found.get(i, ())}) for i, old in enumerate(items)]
            spans = [_merge(old or [], _ranges(hit[b:b + n])) if i in found else old or []
                     for i, (old, b, n) in enumerate(zip(spans, begins.tolist(), lengths.tolist()))]
            return {"doc_id": doc_ids, "text": texts, "n_words": lengths, "items": items, "spans": spans}
        return work
    return start


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, items (ids of items with an occurring window),
    spans (hit word ranges [start, stop), merged)."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.lit(0).cast("long").alias("n_words"),
                       F.lit(None).cast("array<string>").alias("items"),
                       F.lit(None).cast("array<struct<start:bigint,stop:bigint>>").alias("spans"))
    schema = HIT_SCHEMA.format(docs.schema["doc_id"].dataType.simpleString())
    # A block of no item still counts the words.
    for block in query_blocks(benchmark, block_bytes):
        rows = map_arrow(rows, schema, _scan_block(sc.broadcast(block), width))
    return rows.drop("text")


def _match_block(block, width: int, slop: int):
    def start():
        vocab, windows = build_windows(block.value, width)

        def work(doc_ids, texts):
            ids, begins, _ = _encode(texts, vocab, slop + width)
            index = Postings(ids, len(vocab))
            out = {"doc_id": [], "item": [], "position": [], "n_words": [], "exact": []}
            for n, (matrix, who) in windows.items():
                for rows, at in index.matches(matrix, slop):
                    exact = np.ones(len(at), bool)
                    for k in range(n):
                        exact &= index.near(matrix[rows, k], at + k, 0)
                    doc = np.searchsorted(begins, at + slop, side="right") - 1
                    for d, r, p, e in zip(doc.tolist(), rows.tolist(), (at - begins[doc]).tolist(), exact.tolist()):
                        for item in who[r]:
                            for c, v in zip(out, (doc_ids[d], item, p, n, e)):
                                out[c].append(v)
            return out
        return work
    return start


def find_matches(docs: DataFrame, benchmark: DataFrame, slop: int = 0, width: int = WIDTH,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per match of a test window: doc_id, item, position (of the window's
    first word in the document), n_words of the window, exact. With ``slop`` > 0 each
    word may lie up to that many words from its place (proximity); position is where
    the window would begin by its rarest word, so it may lie just outside the text."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    schema = "doc_id long, item string, position long, n_words long, exact boolean"
    out = [map_arrow(rows, schema, _match_block(sc.broadcast(block), width, slop))
           for block in query_blocks(benchmark, block_bytes)]
    for part in out[1:]:
        out[0] = out[0].unionByName(part)
    return out[0]


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return contaminated_spans(docs, benchmark, width).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (
  select coalesce(cast(item_id as varchar), 'null') as item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (
  select distinct item, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as win
  from (select item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from b where len(w) > 0)),
sizes as (select distinct n from bw),
dw as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
m as (select doc_id, i, bw.n as n, item from dw join bw on dw.n = bw.n and dw.win = bw.win),
h as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from m) group by doc_id),
it as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
       from (select distinct doc_id, item from m) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (doc_id) left join it using (doc_id)
"""
