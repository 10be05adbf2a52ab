"""Operator 4, packing: non-negative least squares over length combinations.

A document's ids are cut into full windows of ``WINDOW`` and one tail. The tails'
length histogram (fewer than ``WINDOW`` numbers, the only thing the driver sees)
is packed in three steps: combinations of at most ``DEPTH`` lengths (or repeats of one and a
partner) that fill a window exactly are enumerated by column generation: every round looks at
all of them and takes in those that the residual prices best; repeat counts x >= 0 minimising
|A x - histogram|^2 are solved by accelerated projected gradient and rounded; what
remains is filled greedily, first by whole further combinations, then end to end, cut where a
window is full. The last, partly filled window is cut into powers of two, which
need no padding, so no sequence is padded at all.

Which tail goes where follows from its length and its rank among the tails of that
length, by arithmetic on the plan. Ranks come from two parts: the rank within the
task that tokenised it, kept with the ids, and the sum over earlier tasks. No key
is ever gathered in one task, however many tails share a length.

Scale: ids are written once, in the shared folder; after that only lengths move.
The plan sent to tasks has a row for each length of a combination in use: the solution's
columns, a few for each length, and those of the greedy step, each of which uses a length
up. It depends on the window, not on how many documents there are.

Defined cases: null and empty texts have the end id alone; repeated rows are
packed each; extra columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import token_ids
from .common import cut_lineage, map_arrow, ship

ship(__name__)

WINDOW = 2048
DEPTH = 3
STEPS = 250
TOLERANCE = 1e-3


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenised(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """The written table of ids: doc_id, ids (binary), n_tokens, crcs (of each full window, then
    the tail), tail, and by writing task (block): tail_rank among equal tails, windows_before."""
    described = token_ids.describe(tokenizer_path)
    shared = docs.sparkSession.sparkContext.broadcast(described)

    def start():
        from pyspark import TaskContext

        block = TaskContext.get().partitionId()
        encoder = token_ids.encoder(shared)
        seen = np.zeros(window, np.int64)
        count = [0, 0]

        def work(doc_ids, texts):
            out = {c: [] for c in ("doc_id", "ids", "n_tokens", "crcs", "tail", "block", "row", "tail_rank", "windows_before")}
            for doc, raw in zip(doc_ids, encoder.encode(texts)):
                ids = np.frombuffer(raw, encoder.dtype)
                wide = ids.astype("<u4")
                n, tail = len(ids), len(ids) % window
                values = (doc, raw, n, [zlib.crc32(wide[a:a + window]) for a in range(0, n, window)], tail, block,
                          count[1], int(seen[tail]), count[0])
                for c, v in zip(out, values):
                    out[c].append(v)
                seen[tail] += 1
                count[0] += n // window
                count[1] += 1
            return out
        return work

    schema = ("doc_id long, ids binary, n_tokens long, crcs array<long>, tail int, block int, row long, "
              "tail_rank long, windows_before long")
    table = map_arrow(docs.select("doc_id", "text"), schema, start, rows=1000)
    return cut_lineage(table, "token_ids")


def fill(value: np.ndarray, window: int) -> tuple[np.ndarray, list[tuple[int, ...]]]:
    """Every length's best combination among those that fill the window: at most ``DEPTH``
    lengths, or repeats of one length with a partner or none. ``value[n]`` is a length's price
    (-inf: not at hand); returns the best total by length, and its combination."""
    price = np.full(window + 1, -np.inf)
    price[:len(value)] = value
    price[0] = -np.inf
    best, combo = np.full(window + 1, -np.inf), [()] * (window + 1)
    parts = np.zeros((window + 1, 3), np.int64)
    have = np.flatnonzero(price > -np.inf)
    pair = price[have] + price[window - have]
    best[have], parts[have, 0], parts[have, 1] = pair, have, window - have
    for a in have[have <= window // 3].tolist():            # a <= b <= c
        b = have[np.searchsorted(have, a):np.searchsorted(have, (window - a) // 2, side="right")]
        c = window - a - b
        total = price[a] + price[b] + price[c]
        for n in (b, c):
            better = total > best[n]
            best[n[better]] = total[better]
            parts[n[better]] = np.stack([np.full(len(b), a), b, c], axis=1)[better]
        if len(b) and total.max() > best[a]:
            i = int(total.argmax())
            best[a], parts[a] = total[i], (a, b[i], c[i])
    for n in have.tolist():
        combo[n] = tuple(sorted(int(x) for x in parts[n] if x)) if best[n] > -np.inf else ()
    for k in range(DEPTH, window // int(have[0]) + 1 if len(have) else 0):
        a = have[have * k <= window]
        rest = window - k * a
        total = k * price[a] + np.where(rest == 0, 0.0, price[rest])
        for i in np.flatnonzero(total > -np.inf).tolist():
            whole = tuple(sorted([int(a[i])] * k + ([int(rest[i])] if rest[i] else [])))
            for n in {int(a[i]), int(rest[i])} - {0}:
                if total[i] > best[n]:
                    best[n], combo[n] = total[i], whole
    return best, combo


def least_squares(combos: list[tuple[int, ...]], hist: np.ndarray, x: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """x >= 0 with least |A x - hist|^2 over the given columns, from ``x`` on, by accelerated
    projected gradient that starts anew where it climbs; and hist - A x."""
    col = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    row = np.concatenate([np.array(c) for c in combos])
    mul = lambda x: np.bincount(row, x[col], minlength=len(hist))  # noqa: E731  A x
    back = lambda r: np.bincount(col, r[row], minlength=len(combos))  # noqa: E731  A' r
    v = np.ones(len(combos))
    for _ in range(20):                                 # largest eigenvalue of A'A
        w = back(mul(v))
        v = w / np.linalg.norm(w)
    step = 1 / (1.05 * np.linalg.norm(back(mul(v))))
    y, t = x, 1.0
    for _ in range(steps):
        new = np.maximum(0, y - step * back(mul(y) - hist))
        if ((y - new) @ (new - x)) > 0:
            t = 1.0
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / after * (new - x), new, after
    return x, hist - mul(x)


def solve(hist: np.ndarray, window: int, steps: int = STEPS) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
    """Non-negative least squares over all combinations by column generation: each round prices
    them by the residual (the sum of what their lengths still lack), takes in every length's
    best one that would lower the error, solves, and keeps the columns in use. No combination
    lowers the error further once none has a price above zero; the rounds end when the best
    price is below ``TOLERANCE`` of the mean count, or when two rounds lowered the error by less
    than a millionth of the histogram's own square. Returns columns, counts, hist - A x."""
    want = hist.astype(float)
    want[0] = 0
    here = want > 0
    combos: list[tuple[int, ...]] = []
    x, left = np.zeros(0), want
    floor = TOLERANCE * want[here].mean() if here.any() else 0.0
    errors = []
    while here.any():
        best, fits = fill(np.where(here, left, -np.inf), window)
        known = set(combos)
        new = sorted({c for c, v in zip(fits, best) if v > floor} - known)
        errors.append(float(left @ left))
        if best.max() <= floor or len(errors) > 2 and errors[-3] - errors[-1] <= TOLERANCE ** 2 * float(want @ want):
            break
        combos += new
        x, left = least_squares(combos, want, np.concatenate([x, np.zeros(len(new))]), steps)
        used = x > 0
        combos, x = [c for c, u in zip(combos, used) if u], x[used]
    return combos, x, left


def whole_counts(combos: list[tuple[int, ...]], x: np.ndarray, hist: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Whole repeat counts within the supply: the solution rounded down, its largest parts
    first, then further combinations of what is left, from the longest length down: each takes
    the combination with most supply as often as that lasts, so a length is used up each time."""
    left = hist.astype(np.int64).copy()
    left[0] = 0
    out: list[tuple[tuple[int, ...], int]] = []

    def take(combo, n):
        need = {a: combo.count(a) for a in set(combo)}
        n = min([n, *(int(left[a]) // k for a, k in need.items())])
        if n > 0:
            out.append((combo, n))
            for a, k in need.items():
                left[a] -= n * k
        return n

    order = np.argsort(-x, kind="stable")
    for i in order:
        take(combos[i], int(x[i]))
    for i in order:                                     # rounded up where the supply allows
        if x[i] > int(x[i]):
            take(combos[i], 1)
    for a in range(window - 1, 0, -1):
        while left[a]:
            take_one = left[:window - a + 1].copy()     # supply of a second and a third length
            if window - a >= a:
                take_one[a] = (left[a] // 2)
            b = np.arange(1, (window - a) // 2 + 1)
            b = b[take_one[b] > 0]
            c = window - a - b
            supply = np.minimum(take_one[b], take_one[c])
            supply = np.where(b == c, np.where(b == a, left[a] // 3, take_one[b] // 2), supply)
            choices = [((a, window - a), int(left[window - a]) if window - a != a else int(left[a]) // 2)]
            if len(b) and supply.max() > 0:
                i = int(supply.argmax())
                choices.append(((a, int(b[i]), int(c[i])), int(supply[i])))
            combo, n = max(choices, key=lambda ch: (ch[1], -len(ch[0])))
            if n == 0 or not take(tuple(sorted(combo)), int(left[a])):
                break
    return out


def plan(hist: np.ndarray, window: int = WINDOW) -> dict:
    """Where the tail of each (length, rank) lies; sequences count from 0 here."""
    combos, x, _ = solve(hist, window)
    used = np.zeros(len(hist), np.int64)
    keys, base, first, offset = [], [], [], []
    sequence = 0
    for combo, n in whole_counts(combos, x, hist, window):
        at = 0
        for length in combo:
            keys.append((length, int(used[length])))
            base.append(sequence)
            first.append(int(used[length]))
            offset.append(at)
            used[length] += n
            at += length
        sequence += n
    order = sorted(range(len(keys)), key=keys.__getitem__)
    left = hist - used
    lengths = np.arange(len(hist))
    # the rest end to end, longest first
    stream = np.zeros(len(hist), np.int64)
    stream[::-1] = np.concatenate(([0], np.cumsum((left * lengths)[::-1])[:-1]))
    total = int((left * lengths).sum())
    return {"length": np.array([keys[i][0] for i in order], np.int64), "rank": np.array([keys[i][1] for i in order], np.int64),
            "base": np.array([base[i] for i in order], np.int64), "first": np.array([first[i] for i in order], np.int64),
            "offset": np.array([offset[i] for i in order], np.int64),
            "used": used, "stream": stream, "sequences": sequence, "total": total, "window": window}


def last_cuts(total: int, window: int) -> np.ndarray:
    """Ends of the sequences in the partly filled last window: its binary digits."""
    at, ends = total - total % window, []
    for bit in reversed(range(window.bit_length())):
        if total % window >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return np.array(ends, np.int64)


def place(p: dict, length: int, rank: int) -> list[tuple[int, int, int, int]]:
    """Pieces (start in the tail, length, sequence, offset) of one tail."""
    if rank < p["used"][length]:
        lo, hi = np.searchsorted(p["length"], [length, length + 1])
        i = lo + int(np.searchsorted(p["rank"][lo:hi], rank, side="right")) - 1
        return [(0, length, int(p["base"][i]) + rank - int(p["first"][i]), int(p["offset"][i]))]
    window, cuts = p["window"], last_cuts(p["total"], p["window"])
    at = int(p["stream"][length]) + (rank - int(p["used"][length])) * length
    whole, out, start = p["total"] // window, [], 0
    while start < length:
        pos = at + start
        k = pos // window
        if k < whole:
            begin, end = k * window, (k + 1) * window
        else:
            i = int(np.searchsorted(cuts, pos, side="right"))
            begin, end, k = int(cuts[i - 1]) if i else whole * window, int(cuts[i]), whole + i
        n = min(length - start, end - pos)
        out.append((start, n, p["sequences"] + k, pos - begin))
        start += n
    return out


def _before(rows: DataFrame, part: list[str], value: str) -> DataFrame:
    """``value`` summed over earlier blocks: one row a block and key."""
    w = Window.partitionBy(*part).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("before", F.coalesce(F.sum(value).over(w), F.lit(0)))


def pack(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces of a ``tokenised`` table: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and block, row (which name the document's row in the table)."""
    sc = tokens.sparkSession.sparkContext
    blocks = tokens.groupBy("block").agg(F.sum(F.floor(F.col("n_tokens") / window)).alias("windows"))
    # one row a writing task; a prefix sum over them
    blocks = cut_lineage(_before(blocks, [], "windows"), "window_starts")
    n_windows = blocks.agg(F.coalesce(F.max(F.col("before") + F.col("windows")), F.lit(0)).alias("n")).first()["n"]

    ranks = tokens.filter("tail > 0").groupBy("tail", "block").agg(F.count(F.lit(1)).alias("n"))
    ranks = cut_lineage(_before(ranks, ["tail"], "n"), "tail_ranks")
    hist = np.zeros(window, np.int64)
    for r in ranks.groupBy("tail").agg(F.sum("n").alias("n")).collect():       # fewer than ``window`` rows
        hist[r["tail"]] = r["n"]
    shared = sc.broadcast(plan(hist, window))

    full = tokens.filter(F.col("n_tokens") >= window).join(blocks.select("block", "before"), "block").select(
        "doc_id", "block", "row", "n_tokens", (F.col("before") + F.col("windows_before")).alias("at"),
        F.posexplode(F.slice("crcs", F.lit(1), F.floor(F.col("n_tokens") / window).cast("int"))).alias("k", "ids_crc32"))
    full = full.select(
        "doc_id", (F.col("k") * F.lit(window).cast("long")).alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32",
        F.col("n_tokens").alias("doc_tokens"), (F.col("at") + F.col("k")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), "block", "row")

    def start():
        p = shared.value

        def work(doc_ids, tails, ranks, sums, n_tokens, blocks, rows):
            out = {c: [] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "block", "row")}
            for doc, tail, rank, value, n, block, row in zip(doc_ids, tails, ranks, sums, n_tokens, blocks, rows):
                pieces = place(p, tail, rank)
                for begin, length, sequence, offset in pieces:
                    values = (doc, n - tail + begin, length, value if len(pieces) == 1 else None, n,
                              n_windows + sequence, offset, block, row)
                    for c, v in zip(out, values):
                        out[c].append(v)
            return out
        return work

    tails = tokens.filter("tail > 0").join(ranks.select("tail", "block", "before").hint("merge"), ["tail", "block"]).select(
        "doc_id", "tail", (F.col("tail_rank") + F.col("before")).alias("rank"),
        F.element_at("crcs", -1).alias("crc"), "n_tokens", "block", "row")
    placed = cut_lineage(map_arrow(
        tails, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long, block int, row long", start, rows=10_000), "tail_pieces")
    # only the ids of a cut tail are read again
    pieces_of = placed.filter("ids_crc32 is null").withColumnRenamed("doc_id", "piece_doc")
    cut = with_ids(pieces_of, tokens).select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "block", "row")

    def sums():
        dtype = np.dtype("<u2") if narrow else np.dtype("<u4")
        return lambda doc, start, length, ids, n, sequence, offset, block, row: {
            "doc_id": doc, "start": start, "length": length, "ids_crc32": [crc(np.frombuffer(i, dtype)) for i in ids],
            "doc_tokens": n, "sequence_id": sequence, "offset": offset, "block": block, "row": row}

    narrow = is_narrow(tokens)
    cut = map_arrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                    "offset long, block int, row long", sums)
    return full.unionByName(placed.filter("ids_crc32 is not null")).unionByName(cut)


def is_narrow(tokens: DataFrame) -> bool:
    """Are the table's ids written in two bytes each?"""
    r = tokens.select(F.octet_length("ids").alias("b"), "n_tokens").first()
    return r is None or r["b"] == 2 * r["n_tokens"]


def with_ids(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """Pieces with their own ids as binary, read back from the written table."""
    width = F.lit(2 if is_narrow(tokens) else 4)
    return pieces.join(tokens.select("doc_id", "block", "row", F.col("ids").alias("all_ids")), ["block", "row"]).withColumn(
        "ids", F.substring("all_ids", (F.col("start") * width + 1).cast("int"), (F.col("length") * width).cast("int"))).drop("all_ids")


def sequences(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (binary). A sequence has at most
    ``WINDOW`` ids, so a group is bounded."""
    rows = with_ids(pieces.drop("doc_id"), tokens)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return rows.groupBy("sequence_id").agg(joined.alias("ids"))


PIECE_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    return pack(tokenised(docs, tokenizer_path, window), window).select(*PIECE_COLUMNS)
