"""Operator 1, near-dedup by SetSketch registers.

A document's set is its distinct shingles of ``width`` words (``WIDTH`` unless the caller says
otherwise). Every shingle sends points at
exponentially spaced times to random registers; a register keeps the earliest time,
written as a truncated logarithm. So registers of a union are the larger ones of its
parts, and two sets agree in a register about as often as their Jaccard similarity
says. Documents whose registers agree in a whole band are candidates; their registers
estimate the similarity by maximum likelihood with the known set sizes, and those that
may reach the threshold are confirmed on their full shingle sets.

Texts with the same set are one node. Components are found without listing the pairs of
a group. In each band's bucket all nodes are confirmed against one pivot, and components
are joined. A bucket whose other nodes then lie in several components is resolved in
blocks: its nodes outside its largest component against all its nodes, a block of at most
about ``BLOCK`` by ``BLOCK`` nodes at a time, as one exact product of their shingle
matrices, of which only the links leave the task. So every pair that shares a bucket is
confirmed, refuted, or inside one component already.

Scale: counting, pivots and components are aggregations with partial sums and joins whose
hot keys adaptive execution splits; nothing is collected. A hot bucket is cut into blocks by
a hash of its nodes. Texts move once to the nodes that have candidates, and then with the
pivot pairs and blocks. Each step's tables are written in the shared folder.

Defined cases: a null text, or one without words, has the empty set: it is linked with
nothing, and is its own component; a text of fewer words than a shingle has one shingle; a null doc_id sorts
after all others; rows that share a doc_id share a component if their texts do; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, cut_lineage, map_arrow, ship, slices

ship(__name__)

WIDTH = 5
REGISTERS = 256
BASE = 1.02
RATE = 20.0
BAND_ROWS = 6
BANDS = REGISTERS // BAND_ROWS
THRESHOLD = 80          # per cent
BLOCK = 384
SURE_BELOW = 0.15       # an estimate so far under the threshold (over 5 standard errors) refutes a pair
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix (the published splitmix64 finaliser; its constants are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _lower_table() -> bytes:
    table = bytearray(range(256))
    table[65:91] = bytes(range(97, 123))
    return bytes(table)


LOWER = _lower_table()


def words_of(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased; words are runs of other bytes than [\\x20\\x09-\\x0D]."""
    return text.translate(LOWER).split() if text else []


def shingle_set(text: bytes | None, width: int = WIDTH) -> set:
    words = words_of(text)
    return set(zip(*[words[i:] for i in range(min(width, len(words)))]))


def shingle_hashes(words: list[bytes], memo: dict, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = max(0, len(h) - width) + 1
    out = h[:n]
    for i in range(1, min(width, len(h))):
        out = mixed(out * _GOLD + h[i:i + n])
    return np.unique(out)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (rows: sets) as earliest times, before truncation. A set's points come one
    after another for all its elements; an element is done once its next point is later
    than every register of its set."""
    m = REGISTERS
    items = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    first = np.full(len(sets) * m, np.inf)
    time = np.zeros(len(items))
    j = 0
    while len(items):
        for _ in range(int(np.clip(50_000 // len(items), 1, 32))):
            j += 1
            u = mixed(items + np.uint64(j * int(_GOLD) % (1 << 64)))
            time = time - np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / m
            np.minimum.at(first, owner * m + (u & np.uint64(m - 1)).astype(np.int64), time)
        latest = first.reshape(-1, m).max(axis=1)
        on = time < latest[owner]
        items, owner, time = items[on], owner[on], time[on]
    return first.reshape(-1, m)


def truncated(first: np.ndarray) -> np.ndarray:
    """Registers floor(1 - log_b(time / RATE)) within 16 bits."""
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(first / RATE) / np.log(BASE))
    return np.clip(k, 0, 65535).astype(np.uint16)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """(rows, BANDS) 64-bit keys."""
    r = registers[:, :BANDS * BAND_ROWS].reshape(len(registers), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD, r.shape[:2])
    for i in range(BAND_ROWS):
        key = mixed(key ^ (r[:, :, i] + np.uint64(i + 1) * _GOLD))
    return key.view(np.int64)


def _p(x: np.ndarray) -> np.ndarray:
    """Chance that a register of one set exceeds the other's by its own share x."""
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, steps: int = 101) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of row pairs of registers, over a grid."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u = na / (na + nb)
    v = 1 - u
    j = np.linspace(0, 1, steps)[None, :] * np.minimum(u / v, v / u)[:, None]
    up, down = _p(u[:, None] - v[:, None] * j), _p(v[:, None] - u[:, None] * j)
    tiny = 1e-12
    like = (more[:, None] * np.log(np.maximum(up, tiny)) + less[:, None] * np.log(np.maximum(down, tiny))
            + same[:, None] * np.log(np.maximum(1 - up - down, tiny)))
    return np.take_along_axis(j, like.argmax(axis=1)[:, None], axis=1)[:, 0]


_SKETCH = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("set_a", pa.int64()),
                     ("set_b", pa.int64()), ("registers", pa.binary()), ("row", pa.string())])


def sketches(docs: DataFrame, row: str | None = None, width: int = WIDTH) -> DataFrame:
    """Written per row: doc_id, text_key, n (set size), set_a, set_b (a 128-bit digest of the whole
    set), registers (null for the empty set), row (the column of that name, if given)."""
    def run(batches):
        import xxhash

        memo = Memo(xxhash.xxh64_intdigest)
        for part in slices(batches, 1000):
            ids, keys, texts, own = part.columns
            sets = [shingle_hashes(words_of(t), memo, width) for t in texts.to_pylist()]
            digest = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets]).reshape(-1, 2)
            registers = truncated(sketch([s for s in sets if len(s)]))
            rows = iter(registers)
            yield pa.RecordBatch.from_arrays(
                [ids, keys, pa.array([len(s) for s in sets], pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1]),
                 pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()), own], schema=_SKETCH)

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"),
                       (F.col(row) if row else F.lit(None)).cast("string").alias("row"))
    return cut_lineage(rows.mapInArrow(
        run, "doc_id long, text_key long, n long, set_a long, set_b long, registers binary, row string"), "sketches")


def nodes_of(table: DataFrame) -> DataFrame:
    """Written, one row for each different set: node, set_a, set_b, n, doc (its smallest row), registers."""
    doc = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_key", "row"))
    rows = table.filter("n > 0").groupBy("set_a", "set_b").agg(
        doc.alias("doc"), F.first("n").alias("n"), F.first("registers").alias("registers"))
    return cut_lineage(rows.withColumn("node", F.monotonically_increasing_id()), "set_nodes")


_BUCKET = pa.schema([("bucket", pa.int64()), ("node", pa.int64()), ("n", pa.int64())])


def buckets_of(nodes: DataFrame) -> DataFrame:
    """(bucket, node, n): one row for each band of a node."""
    def run(batches):
        for part in slices(batches, 2000):
            node, n, registers = (part.column(i) for i in range(3))
            keys = band_keys(np.frombuffer(b"".join(registers.to_pylist()), np.uint16).reshape(-1, REGISTERS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(node.to_numpy(), BANDS)), pa.array(np.repeat(n.to_numpy(), BANDS))],
                schema=_BUCKET)

    return nodes.select("node", "n", "registers").mapInArrow(run, "bucket long, node long, n long")


def _near_size(a: str, b: str):
    """Set sizes that allow the threshold at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * THRESHOLD


def confirm(pairs: DataFrame, texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """The pairs (a, b) that are linked, by registers first and then by their full sets."""
    def start():
        last: list = [None, None]

        def work(a, b, text_a, text_b, reg_a, reg_b, n_a, n_b):
            regs = [np.frombuffer(b"".join(r), np.uint16).reshape(-1, REGISTERS) for r in (reg_a, reg_b)]
            hopeful = estimate(*regs, np.array(n_a, float), np.array(n_b, float)) >= THRESHOLD / 100 - SURE_BELOW
            out = {"a": [], "b": []}
            for i in np.flatnonzero(hopeful).tolist():
                if last[0] != b[i]:
                    last[:] = b[i], shingle_set(text_b[i], width)
                sa, sb = shingle_set(text_a[i], width), last[1]
                common = len(sa & sb)
                if 100 * common >= THRESHOLD * (len(sa) + len(sb) - common):
                    out["a"].append(a[i])
                    out["b"].append(b[i])
            return out
        return work

    side = lambda s: texts.select(F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("text", "registers", "n")])
    rows = pairs.select("a", "b").join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
    return map_arrow(rows.select("a", "b", "text_a", "text_b", "registers_a", "registers_b", "n_a", "n_b"),
                     "a long, b long", start, rows=500)


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for the nodes of ``edges`` (a, b). Alternating
    stars: neighbours are pointed at the smallest of them until every star is flat."""
    def stars(e: DataFrame, both: bool) -> DataFrame:
        # large stars look at all neighbours, small stars at the smaller ones
        way = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if both:
            way = way.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = way.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        moved = way.join(low.hint("merge"), "u")
        if both:
            out = moved.filter("v > u").select(F.col("v").alias("a"), F.col("low").alias("b"))
        else:
            out = moved.select(F.col("v").alias("a"), F.col("low").alias("b")).unionByName(
                low.select(F.col("u").alias("a"), F.col("low").alias("b")))
        return cut_lineage(out.filter("a <> b").distinct(), "stars")

    e = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003))
    seen = None
    while True:
        e = stars(stars(e, True), False)
        now = e.agg(mark).first()[0]
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def _block_links(block_rows, width: int = WIDTH):
    """Linked pairs of different components between the two sides of a block."""
    sides = []
    memo: dict = {}
    for side in block_rows:
        sets = [[hash_ for hash_ in _indexed(r["text"], memo, width)] for r in side]
        sides.append((np.array([r["node"] for r in side]), np.array([r["comp"] for r in side]), sets,
                      np.array([len(s) for s in sets])))
    (node_a, comp_a, sets_a, n_a), (node_b, comp_b, sets_b, n_b) = sides
    shared = np.intersect1d(np.concatenate(sets_a), np.concatenate(sets_b))
    common = np.zeros((len(sets_a), len(sets_b)), np.float32)
    step = 4096
    for at in range(0, len(shared), step):
        part = shared[at:at + step]
        common += _matrix(sets_a, part) @ _matrix(sets_b, part).T
    union = n_a[:, None] + n_b[None, :] - common
    linked = (100 * common >= THRESHOLD * union) & (comp_a[:, None] != comp_b[None, :])
    i, j = np.nonzero(linked)
    # one link joins two components
    _, keep = np.unique(np.stack((comp_a[i], comp_b[j])), axis=1, return_index=True) if len(i) else (None, [])
    return node_a[i[keep]].tolist(), node_b[j[keep]].tolist()


def _indexed(text: bytes, memo: dict, width: int) -> list[int]:
    """A text's shingles as numbers that are exact within the block."""
    return [memo.setdefault(s, len(memo)) for s in shingle_set(text, width)]


def _matrix(sets: list[list[int]], columns: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(columns)), np.float32)
    for row, ids in zip(out, sets):
        ids = np.asarray(ids)
        at = np.searchsorted(columns, ids)
        at = np.minimum(at, len(columns) - 1)
        row[at[columns[at] == ids]] = 1
    return out


def resolve_blocks(members: DataFrame, comps: DataFrame, texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """Links (a, b) between components that share a bucket, beyond those of the pivots.
    ``members``: (bucket, node, pivot) of the buckets with several nodes."""
    rows = members.filter("node <> pivot").join(comps.hint("merge"), "node", "left").select(
        "bucket", "node", F.coalesce("comp", "node").alias("comp"))
    rows = cut_lineage(rows, "bucket_comps")
    per = rows.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("k"))
    mixed_up = per.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("comps"), F.sum("k").alias("size"), F.max(F.struct("k", "comp")).alias("main")).filter("comps > 1")
    mixed_up = mixed_up.select(
        "bucket", F.col("main.comp").alias("main"), F.ceil(F.col("size") / BLOCK).cast("int").alias("right_blocks"),
        F.ceil((F.col("size") - F.col("main.k")) / BLOCK).cast("int").alias("left_blocks"))
    mixed_up = cut_lineage(mixed_up, "open_buckets")
    rows = cut_lineage(rows.join(mixed_up.hint("merge"), "bucket"), "open_rows")
    rows = rows.join(texts.select("node", "text").hint("merge"), "node")
    h = F.xxhash64("node")
    item = F.collect_list(F.struct("node", "comp", "text"))
    # the fewer nodes outside the main component meet every block of the bucket
    left = rows.filter("comp <> main").select(
        "bucket", F.pmod(h, F.col("left_blocks")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("right_blocks") - 1)).alias("j"),
        "node", "comp", "text").groupBy("bucket", "i", "j").agg(item.alias("left"))
    right = rows.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("left_blocks") - 1)).alias("i"), F.pmod(h, F.col("right_blocks")).alias("j"),
        "node", "comp", "text").groupBy("bucket", "i", "j").agg(item.alias("right"))
    blocks = left.join(right.hint("merge"), ["bucket", "i", "j"]).select("left", "right")

    def start():
        def work(lefts, rights):
            out = {"a": [], "b": []}
            for pair in zip(lefts, rights):
                a, b = _block_links(pair, width)
                out["a"] += a
                out["b"] += b
            return out
        return work

    return map_arrow(blocks, "a long, b long", start, rows=8)


def near_dedup(docs: DataFrame, row: str | None = None, width: int = WIDTH) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable), kept. With ``row``, a column
    that differs in all rows, that column too, and kept is true of one row of each component."""
    table = sketches(docs, row, width)
    nodes = nodes_of(table)
    buckets = cut_lineage(buckets_of(nodes), "buckets")
    pivots = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("node", "n")).alias("p")).filter("size > 1")
    members = cut_lineage(buckets.join(pivots.hint("merge"), "bucket").select(
        "bucket", "node", "n", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n")), "members")
    pairs = cut_lineage(members.filter((F.col("node") != F.col("pivot")) & _near_size("n", "pivot_n")).select(
        F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(), "pivot_pairs")

    active = members.select("node").distinct()
    wanted = nodes.join(active.hint("merge"), "node").select(
        "node", "n", "registers", F.coalesce("doc.doc_id", F.lit(0)).alias("id"), F.col("doc.z").alias("z"), F.col("doc.text_key").alias("text_key"))
    rows = docs.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("z"),
                       F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
    texts = rows.join(wanted.hint("merge"), ["id", "z", "text_key"]).select("node", "n", "registers", "text")
    texts = cut_lineage(texts.dropDuplicates(["node"]), "node_texts")

    links = cut_lineage(confirm(pairs, texts, width), "links")
    more = cut_lineage(resolve_blocks(members.select("bucket", "node", "pivot"), components(links), texts, width), "block_links")
    comps = components(links.unionByName(more))
    # components by node, then by the smallest doc_id in them
    owner = nodes.select("node", "set_a", "set_b", F.struct("doc.z", "doc.doc_id", "doc.row").alias("doc")).join(
        comps.hint("merge"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    owner = cut_lineage(owner, "node_components")
    least = owner.groupBy("comp").agg(F.min("doc").alias("least")).select(
        "comp", F.col("least.doc_id").alias("component_id"), F.col("least.row").alias("first_row"))
    label = owner.join(least.hint("merge"), "comp").select("set_a", "set_b", "component_id", "first_row")
    linked = table.filter("n > 0").select("doc_id", "n", "set_a", "set_b", "row").join(label.hint("merge"), ["set_a", "set_b"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "row", "first_row")
    alone = table.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                         "row", F.col("row").alias("first_row"))
    same = ("row", "first_row") if row else ("doc_id", "component_id")
    return linked.unionByName(alone).select("doc_id", "n_shingles", "component_id", F.col(same[0]).eqNullSafe(F.col(same[1])).alias("kept"),
                                            *([F.col("row").alias(row)] if row else []))
