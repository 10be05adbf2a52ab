"""Token counts (6), packing (4) and token files (9) against the libraries."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cartwheel.llm import packing as D4
from cartwheel.llm import token_count as D6
from cartwheel.llm import token_files as D9
from cartwheel.llm import token_ids as T
from cartwheel.llm.catalog import tokenizer_file
from cartwheel.session import scratch_path

PIECES, BYTES, WORDS = (tokenizer_file(f) for f in ("piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = st.lists(st.sampled_from(["a", "B", " ", "  ", "the", "ing", "\n", "é", "e\u0301", "▁", "梦", "Ａ", "'s", "'", "0", "\x00", "\x1c", "\x85",
                                  "\u2003", "İ", "ß", "½", "--", "<s>", "<|endoftext|>", "ǅ", " " * 17, "Σ"]) | st.text(max_size=3), max_size=12).map("".join)


@pytest.fixture(scope="module")
def counter():
    return D6.Counter(D6.compile_pieces(PIECES))


@pytest.fixture(scope="module")
def pieces():
    return SentencePieceProcessor(model_file=PIECES)


@settings(max_examples=300, deadline=None)
@given(text=PARTS.filter(lambda t: "\ud800" not in t), size=st.integers(1, 9))
def test_transducer_counts_as_the_library(counter, pieces, text, size):
    want = len(pieces.encode(text))
    assert (counter.fresh(D6.prepared(text)) if text else 0) == want
    state, total = D6.Transducer.START, 0
    for k, c in enumerate(text[i:i + size] for i in range(0, len(text), size)):
        state, n = counter.run(D6.prepared(c) if k == 0 else c.replace(" ", D6.SPACE), state)
        total += n
    assert total == want


def test_long_texts_without_blanks_are_run_through_in_chunks(spark, pieces):
    """Every map is one small row; chunks entered by another state than foreseen are run again."""
    draw = random.Random(3)
    texts = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=200_000)), "梦的" * 30_000, "ab" * 40_000 + " end", " " * 50_000, "A" * 70_001]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [len(pieces.encode(t)) for t in texts]
    for chunk, lead in ((4096, 256), (20_000, 1)):
        got = {r["doc_id"]: r["n_tokens"] for r in D6.count_tokens(docs, PIECES, chunk=chunk, lead=lead).collect()}
        assert [got[i] for i in range(len(texts))] == want
    shared = spark.sparkContext.broadcast({"scores": D6.compile_pieces(PIECES)})
    chunks = spark.createDataFrame([(0, 0, 1, k, texts[0][max(0, k * 5000 - 3):k * 5000], texts[0][k * 5000:k * 5000 + 5000], None) for k in range(40)],
                                   "row long, doc_id long, n_bytes long, at int, lead string, chunk string, entry string")
    maps = D6.chunk_maps(chunks, shared).orderBy("at").collect()
    assert len(maps) == 40 and sum(m["count"] for m in maps) == want[0] and max(len(m["exit"]) for m in maps) < 1000
    assert all(a["exit"] == b["entry"] for a, b in zip(maps, maps[1:]))


def test_token_counts_in_chunks(edge_docs, edge_rows, pieces):
    got = sorted((tuple(r) for r in D6.count_tokens(edge_docs, PIECES, chunk=100, limit=50).collect()), key=repr)
    want = [(d, len((t or "").encode()), n := len(pieces.encode(t or "")), n > 50) for d, t, _ in edge_rows]
    assert got == sorted(want, key=repr)
    assert D6.count_tokens(edge_docs.limit(0), PIECES).count() == 0


@pytest.mark.parametrize("path", [BYTES, WORDS])
@settings(max_examples=200, deadline=None)
@given(texts=st.lists(PARTS, max_size=4))
def test_units_give_the_library_ids(path, texts):
    encoder = T.UnitEncoder(T.describe(path))
    for text, raw in zip(texts, encoder.encode(texts)):
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids + [T.END_ID]
        assert np.frombuffer(raw, encoder.dtype).tolist() == want


def check_pieces(rows, texts, window):
    """Every id in one piece, sequences gapless, sums right."""
    tok = Tokenizer.from_file(BYTES)
    want = defaultdict(list)
    for doc, text in texts:
        want[doc].append(tok.encode(text or "", add_special_tokens=False).ids + [1])
    by_seq = defaultdict(list)
    seen = defaultdict(int)
    for r in rows:
        by_seq[r["sequence_id"]].append(r)
        seen[r["doc_id"]] += r["length"]
        assert any(len(ids) == r["doc_tokens"] and r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
                   for ids in want[r["doc_id"]])
    assert seen == {d: sum(map(len, v)) for d, v in want.items()}
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at == window or at < window and at & (at - 1) == 0     # no padding at all
    assert sorted(by_seq) == list(range(len(by_seq)))


@pytest.mark.parametrize("window", [2048, 64])
def test_packing(small_docs, small_rows, window):
    rows = D4.pack_documents(small_docs, BYTES, window).collect()
    check_pieces(rows, small_rows, window)


def test_packing_edge_rows(edge_docs, edge_rows):
    check_pieces(D4.pack_documents(edge_docs, BYTES, 32).collect(), [r[:2] for r in edge_rows], 32)
    assert D4.pack_documents(edge_docs.limit(0), BYTES).count() == 0


def test_sequences_hold_their_ids(small_docs):
    tokens = D4.tokenised(small_docs, BYTES, 256)
    pieces = D4.pack(tokens, 256).cache()
    for r in D4.sequences(pieces, tokens).limit(20).collect():
        ids = np.frombuffer(r["ids"], "<u2")
        for p in pieces.filter(pieces["sequence_id"] == r["sequence_id"]).collect():
            assert p["ids_crc32"] == D4.crc(ids[p["offset"]:p["offset"] + p["length"]])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 31), max_size=80))
def test_plan_places_every_tail_once(lengths):
    hist = np.bincount(np.array(lengths, int), minlength=32)
    p = D4.plan(hist, 32)
    fill = defaultdict(list)
    for n in range(32):
        for rank in range(hist[n]):
            parts = D4.place(p, n, rank)
            assert sum(x[1] for x in parts) == n
            for _, size, seq, off in parts:
                fill[seq].append((off, size))
    for parts in fill.values():
        at = 0
        for off, size in sorted(parts):
            assert off == at
            at += size
        assert at & (at - 1) == 0 and at <= 32


def test_counts_solve_the_histogram():
    hist = np.zeros(2048, int)
    hist[[1000, 1048, 500, 548]] = [700, 300, 400, 400]
    combos, x, _ = D4.solve(hist, 2048)
    used = np.zeros(2048, int)
    for c, n in D4.whole_counts(combos, x, hist, 2048):
        assert sum(c) == 2048
        for a in c:
            used[a] += n
    assert (used <= hist).all() and used.sum() >= 1790


def all_combinations(window):
    """Every pair and triple of lengths that fills the window, and every repeat with a partner or none."""
    found = {(a, window - a) for a in range(1, window // 2 + 1)}
    found |= {(a, b, window - a - b) for a in range(1, window) for b in range(a, (window - a) // 2 + 1)}
    for a in range(1, window):
        for k in range(1, window // a + 1):
            found.add(tuple(sorted([a] * k + [window - k * a] * (window > k * a))))
    return sorted(c for c in found if max(c) < window)


@pytest.mark.parametrize("counts", [[36, 28, 16, 8, 0, 18, 14, 17, 27, 7, 23, 18, 6, 0, 0],
                                    *np.random.default_rng(1).integers(0, 41, (12, 15)).tolist()])
def test_generated_columns_reach_the_least_error_of_all(counts):
    hist = np.array([0, *counts])
    combos, _, left = D4.solve(hist, 16)
    every = [c for c in all_combinations(16) if all(hist[n] for n in c)]
    assert set(combos) <= set(every)
    if every:
        _, least = D4.least_squares(every, hist.astype(float), np.zeros(len(every)), 3000)
        square = float((hist * hist).sum())
        assert float(left @ left) <= 1.01 * float(least @ least) + 1e-4 * square
        for c in every:                                 # no combination would lower the error by much
            assert sum(left[n] for n in c) <= 0.05 * square ** 0.5


def test_most_tails_are_placed_by_combinations():
    rng = np.random.default_rng(4)
    hist = np.bincount(rng.integers(1, 2048, 20_000), minlength=2048)
    combos, x, _ = D4.solve(hist, 2048)
    out = D4.whole_counts(combos, x, hist, 2048)
    used = np.zeros(2048, int)
    for c, n in out:
        for a in c:
            used[a] += n
    assert (used <= hist).all() and used.sum() >= 0.9 * hist.sum()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1 << 20), min_size=1, max_size=1500))
def test_codes_round_trip(ids):
    raw = D9.write_shard([None, 5], np.array([0, 1, len(ids)]), np.array(ids, np.uint32))
    docs, starts, codes = D9.read_shard(raw)
    assert docs == [None, 5] and codes.decode().tolist() == ids
    assert all(codes[i] == ids[i] for i in range(0, len(ids), 7))


def test_token_files(spark, edge_docs, edge_rows):
    path = scratch_path(spark, "ids")
    D9.write_ids(edge_docs, WORDS, path, shard_ids=500)
    rows = sorted((r for r in D9.read_documents(spark, path).collect()), key=lambda r: r["start"])
    tok = Tokenizer.from_file(WORDS)
    assert [r["doc_id"] for r in rows] == sorted((r[0] for r in edge_rows), key=lambda d: (d is not None, d))
    ids, at = [], 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
        match = [w for d, t, _ in edge_rows if d == r["doc_id"]
                 if zlib.crc32(np.array(w := tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) == r["ids_crc32"]]
        assert match and len(match[0]) == r["n_tokens"]
        ids += match[0]
    asked = spark.range(0, len(ids), 1777).withColumnRenamed("id", "position")
    got = {r["position"]: r["id"] for r in D9.tokens_at(spark, path, asked).collect()}
    assert got == {p: ids[p] for p in range(0, len(ids), 1777)}
    D9.write_ids(edge_docs.limit(0), WORDS, path)
    assert D9.read_documents(spark, path).count() == 0
