"""Operator 6, token counts: a merge tokenizer compiled to a finite-state transducer.

The vocabulary's pieces are merged best score first. A split of a text into
pieces is the tokenizer's own split exactly when every adjacent pair is: merging
the pair's joined text gives the two pieces back. So, read left to right, each
prefix of a text has one valid last piece, and what later characters need to know
is finite: the prefixes of pieces that may still grow, the piece each follows, and
how far its count is from the count here. That is a state. A transition is
compiled when it is first taken and carries the number of tokens it emits (the
change of the count). A blank after another character always starts afresh, as no
piece has a blank behind another character; ``compile_pieces`` checks it.

Long texts are cut into chunks. A chunk's map takes an entry state to (exit state,
count); it is computed for the state that the ``LEAD`` characters before the chunk lead to
from a fresh start, as states converge after some pieces. The maps of a document compose
where each entry is the exit before it; a chunk entered by another state gets its map for
that one in a further round, until all compose (each round settles at least the first
open chunk of every document). A map is one small row, whatever the text.

Scale: short texts (at most ``CHUNK`` characters) need no shuffle. Longer ones are written
once in chunks, which are run through in parallel, also without any blank; only the
chunks' maps are shuffled.

Defined cases: null counts as empty (no tokens); repeated rows each keep their
row; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Memo, cut_lineage, map_arrow, ship, text_or_empty

ship(__name__)

CHUNK = 1 << 15
LEAD = 256
LIMIT = 4096
SPACE = "▁"
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")
_STARTS_AFRESH = re.compile(f"(?<=[^{SPACE}]){SPACE}")


def compile_pieces(model_path: str) -> dict[str, float]:
    """piece -> score of a sentencepiece merge model, without control, unknown and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model_path)
    n = sp.get_piece_size()
    pieces = {sp.id_to_piece(i): sp.get_score(i) for i in range(n)
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    crossing = [p for p in pieces if re.search(f"[^{SPACE}]{SPACE}", p)]
    if crossing or not any(sp.is_byte(i) for i in range(n)):
        raise ValueError(f"not a byte-fallback model whose pieces end at blanks: {crossing[:3]}")
    return pieces


def merge(text: str, scores: dict[str, float]) -> list[str]:
    """The tokenizer's split of ``text``: join the adjacent pair of best score, leftmost first."""
    parts: list[str | None] = list(text)
    after = list(range(1, len(parts) + 1))
    before = list(range(-1, len(parts) - 1))
    queue: list[tuple[float, int, str]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(parts) and (s := scores.get(parts[i] + parts[j])) is not None:
            heapq.heappush(queue, (-s, i, parts[i] + parts[j]))

    for i in range(len(parts) - 1):
        offer(i)
    while queue:
        _, i, joined = heapq.heappop(queue)
        j = after[i]
        if parts[i] is None or j >= len(parts) or parts[i] + parts[j] != joined:
            continue
        parts[i], parts[j], after[i] = joined, None, after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [p for p in parts if p is not None]


class Transducer:
    """A state is (fresh, live); live: (grown prefix, piece before it, count minus the count
    here). States are numbered; ``rows[i]`` has state i's compiled transitions."""

    START = (True, (("", None, 0),))
    MOST_STATES = 250_000

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.prefixes = {p[:i] for p in scores for i in range(1, len(p))}
        self.follows = Memo(self._follows, 400_000)
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.rows: list[dict[str, tuple[int, int]]] = []

    def number(self, state: tuple) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.rows.append({})
        return self.numbers[state]

    def _follows(self, pair: tuple) -> bool:
        left, right = pair
        return merge((left or "") + right, self.scores) == ([left, right] if left else [right])

    def _step(self, state: tuple, ch: str) -> tuple[tuple, int]:
        fresh, live = state
        if ch == SPACE and not fresh:
            return self._step(self.START, ch)
        if ch not in self.scores:      # written as its bytes; nothing joins with them
            return (False, self.START[1]), len(ch.encode())
        grown, here = [], None
        for prefix, last, count in live:
            piece = prefix + ch
            if here is None and piece in self.scores and self.follows[last, piece]:
                here = (piece, count + 1)      # exactly one piece can end here
            if piece in self.prefixes:
                grown.append((piece, last, count))
        piece, count = here
        return (ch == SPACE, (("", piece, 0), *((p, last, c - count) for p, last, c in grown))), count

    def run(self, text: str, state: tuple = START) -> tuple[tuple, int]:
        """Exit state and tokens emitted."""
        if len(self.states) > self.MOST_STATES:
            self.forget()
        rows, at, total = self.rows, self.number(state), 0
        for ch in text:
            try:
                at, n = rows[at][ch]
            except KeyError:
                after, n = self._step(self.states[at], ch)
                to = self.number(after)
                rows[at][ch] = (to, n)
                at = to
            total += n
        return self.states[at], total


def prepared(text: str) -> str:
    """As the model's normaliser leaves it: a blank in front, blanks shown as U+2581."""
    return SPACE + text.replace(" ", SPACE) if text else ""


class Counter:
    """Counts by units (blanks and what follows them); a unit's own map is kept."""

    def __init__(self, scores: dict[str, float]):
        self.machine = Transducer(scores)
        self.unit = Memo(lambda u: self.machine.run(u)[1])
        self.word = Memo(lambda w: self.machine.run(SPACE + w)[1] if len(w) < 64 else self.unit[SPACE + w])

    def fresh(self, text: str) -> int:
        """Tokens of a text that begins with a blank."""
        words = text.split(SPACE)
        if "" in words[1:]:
            return sum(map(self.unit.__getitem__, _UNIT.findall(text)))
        return sum(map(self.word.__getitem__, words[1:]))

    def run(self, chunk: str, state: tuple) -> tuple[tuple, int]:
        """Exit state and tokens of a chunk; whole units behind its first fresh start."""
        found = _STARTS_AFRESH.search(chunk)
        if found is None:
            return self.machine.run(chunk, state)
        at = found.start()
        tail = max(at, chunk.rfind(SPACE))
        while tail > at and chunk[tail - 1] == SPACE:
            tail -= 1
        _, n = self.machine.run(chunk[:at], state)
        after, m = self.machine.run(chunk[tail:])
        return after, n + m + (self.fresh(chunk[at:tail]) if tail > at else 0)


def _counter(shared) -> Counter:
    """The worker's counter, kept with the broadcast, so later tasks find it compiled."""
    kept = shared.value
    if "counter" not in kept:
        kept["counter"] = Counter(kept["scores"])
    return kept["counter"]


def _count_short(shared):
    def start():
        counter = _counter(shared)
        return lambda ids, texts, n_bytes: {
            "doc_id": ids, "n_bytes": n_bytes,
            "n_tokens": [counter.fresh(prepared(t)) if t else 0 for t in texts]}
    return start


def _map_chunks(shared):
    def start():
        counter = _counter(shared)

        def work(rows, ids, n_bytes, at, leads, chunks, entries):
            out = {"row": rows, "doc_id": ids, "n_bytes": n_bytes, "at": at, "entry": [], "exit": [], "count": []}
            for k, lead, chunk, entry in zip(at, leads, chunks, entries):
                state = _state(entry) if entry else counter.run(lead.replace(" ", SPACE), Transducer.START)[0]
                after, n = counter.run(prepared(chunk) if k == 0 else chunk.replace(" ", SPACE), state)
                out["entry"].append(json.dumps(state))
                out["exit"].append(json.dumps(after))
                out["count"].append(n)
            return out
        return work
    return start


def _state(text: str) -> tuple:
    fresh, live = json.loads(text)
    return fresh, tuple(map(tuple, live))


_MAPS = "row long, doc_id long, n_bytes long, at int, entry string, exit string, count long"


def chunk_maps(chunks: DataFrame, shared) -> DataFrame:
    """One map per chunk (row, at) of the written ``chunks``, entered by the state it is due."""
    maps = cut_lineage(map_arrow(chunks, _MAPS, _map_chunks(shared), rows=64), "token_maps")
    order = Window.partitionBy("row").orderBy("at")
    while True:
        due = F.coalesce(F.lag("exit").over(order), F.lit(json.dumps(Transducer.START)))
        still = maps.select("row", "at", "entry", due.alias("due")).filter("entry <> due").select("row", "at", F.col("due").alias("entry"))
        still = cut_lineage(still, "token_open")
        if still.isEmpty():
            return maps
        again = map_arrow(chunks.drop("entry").join(still, ["row", "at"]).select(chunks.columns), _MAPS, _map_chunks(shared), rows=64)
        maps = cut_lineage(maps.join(still.select("row", "at"), ["row", "at"], "left_anti").select(maps.columns).unionByName(again), "token_maps")


def count_tokens(docs: DataFrame, model_path: str, chunk: int = CHUNK, limit: int = LIMIT, lead: int = LEAD) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit."""
    shared = docs.sparkSession.sparkContext.broadcast({"scores": compile_pieces(model_path)})    # bounded: a vocabulary
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn(
        "n_bytes", F.octet_length("text").cast("long"))
    # at most ``chunk`` bytes is at most ``chunk`` characters
    short = map_arrow(rows.filter(F.col("n_bytes") <= chunk), "doc_id long, n_bytes long, n_tokens long", _count_short(shared))
    size, lead = F.lit(chunk), max(lead, 1)
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor((F.length("text") - 1) / size).cast("int")),
        lambda k: F.struct(F.when(k * size > lead, F.substring("text", k * size + 1 - lead, F.lit(lead)))
                           .when(k > 0, F.concat(F.lit(" "), F.substring("text", F.lit(1), k * size))).otherwise("").alias("lead"),
                           F.substring("text", k * size + 1, size).alias("chunk")))
    long = rows.filter(F.col("n_bytes") > chunk).withColumn("row", F.monotonically_increasing_id()).select(
        "row", "doc_id", "n_bytes", F.posexplode(pieces).alias("at", "p")).select(
        "row", "doc_id", "n_bytes", "at", "p.lead", "p.chunk", F.lit(None).cast("string").alias("entry"))
    whole = chunk_maps(cut_lineage(long, "token_chunks"), shared).groupBy("row").agg(
        F.min("doc_id").alias("doc_id"), F.min("n_bytes").alias("n_bytes"), F.sum("count").alias("n_tokens")).drop("row")
    return short.unionByName(whole).withColumn("over_limit", F.col("n_tokens") > limit)
