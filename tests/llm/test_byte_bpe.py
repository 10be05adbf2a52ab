"""Byte-level BPE (11) against the library that the ranks are for."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwheel.llm import byte_bpe as D11
from cartwheel.llm.catalog import op11_byte_bpe, tokenizer_file

TOKENS = D11.read_ranks(tokenizer_file("byte_bpe_multi_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})
PARTS = st.lists(st.sampled_from(["a", "e", "th", "in", "ing", "tion", "s", "é", "梦", "想", "я", "ا", "́", " ", "  ", "\n", " \n", "\x1c", "\x85",
                                  "　", "'s", "'", "1", "½", ".", "--", "<|endoftext|>", "\U0003d027", "\x00"]) | st.text(max_size=4), max_size=30).map("".join)


@pytest.fixture(scope="module")
def codec():
    return D11.Codec(TOKENS, D11.library_pattern(PATTERN))


@settings(max_examples=500, deadline=None)
@given(text=PARTS)
def test_ids_are_the_library_s(codec, text):
    ids = codec.encode(text).tolist()
    assert ids == LIBRARY.encode_ordinary(text) and D11.join(TOKENS, ids) == text.encode()


def test_pieces_of_every_kind_of_character(codec):
    chars = map(chr, [*range(0x3400), *range(0xA000, 0xAC00), *range(0x10000, 0x12000), *range(0x3D000, 0x3D100)])
    text = " ".join(f"a{c}a 1{c}1 .{c}. {c}{c}" for c in chars)
    assert codec.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_long_pieces_and_blocks(codec, monkeypatch):
    rng = random.Random(5)
    texts = ["a" * 100_000, "ab" * 50_000, "".join(rng.choices("abcdefghij", k=100_000)), " " * 50_000 + "x", "=" * 9_000 + "-" * 9_001]
    assert [codec.encode(t).tolist() for t in texts] == [LIBRARY.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(D11, "BLOCK", 50)
    for _ in range(200):
        text = "".join(rng.choices(["word", " ", "  ", "\n", "'s", "12", "é", "."], k=400))
        assert codec.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_pairs_fit_as_merging_says(codec):
    rng = random.Random(6)
    pairs = [(rng.randrange(len(TOKENS)), rng.randrange(2_000)) for _ in range(20_000)]
    for a, b in pairs:
        if codec.halves[a] is not None and codec.halves[b] is not None:
            assert codec.fits[a * len(TOKENS) + b] == (codec.merge(TOKENS[a] + TOKENS[b]) == [TOKENS[a], TOKENS[b]])


def test_kept_strings_are_bounded(codec, monkeypatch):
    monkeypatch.setattr(D11, "MEMO", 10)
    small = D11.Codec(TOKENS, D11.library_pattern(PATTERN))
    text = " ".join(f"word{i} {i}" for i in range(300))
    assert small.encode(text).tolist() == LIBRARY.encode_ordinary(text)
    assert max(map(len, (small.known, small.known.older, small.after_space, small.after_space.older))) <= 10


def test_a_worker_does_not_merge_the_vocabulary_again(spark, codec, monkeypatch):
    shared = D11.share(spark, TOKENS, PATTERN).value
    assert shared["halves"] == codec.halves
    monkeypatch.setattr(D11.Codec, "merge", None)
    assert D11.Codec(TOKENS, shared["pattern"], shared["halves"]).encode("a worded text").tolist() == LIBRARY.encode_ordinary("a worded text")


def test_strings_made_of_kept_ones_are_not_kept(codec):
    small = D11.Codec(TOKENS, D11.library_pattern(PATTERN), codec.halves)
    text = "First second, third.\nFourth second. don't it's"
    assert small.encode(text).tolist() == LIBRARY.encode_ordinary(text)
    assert set(small.after_space) == {"second", "don't", "it's"}


def _digest(doc, text):
    ids = LIBRARY.encode_ordinary(text or "")
    return doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_whole_table(spark, small_rows):
    got = sorted(tuple(r) for r in op11_byte_bpe(spark, "/root/testdata/sf0.001").collect())
    assert got == sorted(_digest(*r) for r in small_rows)


def test_awkward_rows(edge_docs, edge_rows):
    out = D11.digests(edge_docs, TOKENS, PATTERN)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted((_digest(d, t) for d, t, _ in edge_rows), key=repr)
    assert D11.digests(edge_docs.limit(0), TOKENS, PATTERN).count() == 0


def test_columns_pass_through(spark):
    docs = spark.createDataFrame([(1, "ab cd", "x", [1]), (2, None, "y", None)], "n long, Text string, decoded string, ids array<int>")
    shared = D11.share(spark, TOKENS, PATTERN)
    out = D11.decode(D11.encode(docs, shared, text="Text"), shared).select("n", "Text", "ids", F.col("decoded").cast("string").alias("d")).orderBy("n")
    assert [tuple(r) for r in out.collect()] == [(1, "ab cd", LIBRARY.encode_ordinary("ab cd"), "ab cd"), (2, None, [], "")]


def test_ranks_are_checked(tmp_path):
    bad = tmp_path / "ranks"
    bad.write_text("YQ== 0\nYg== 1\n")
    with pytest.raises(ValueError, match="every byte"):
        D11.read_ranks(str(bad))
    with pytest.raises(ValueError, match="no such id"):
        D11.join(TOKENS, [-1])


def test_pieces_split_together_are_those_split_alone(codec, monkeypatch):
    """op11_byte_bpe: unknown pieces are split as arrays; one by one only where they are few or long."""
    rng = random.Random(7)
    some = ["".join(rng.choices("abcdeinorst", k=rng.randrange(1, 40))) for _ in range(3_000)]
    some += ["".join(rng.choices("aéñя梦½ \n'.,-\x00\x85", k=rng.randrange(1, 16))) for _ in range(3_000)]
    pieces = list(dict.fromkeys(some))
    want = {piece: codec.split(piece.encode()).tobytes() for piece in pieces}
    for slots in (1 << 19, 4):
        monkeypatch.setattr(D11, "SLOTS", slots)
        small = D11.Codec(TOKENS, D11.library_pattern(PATTERN), codec.halves)
        assert small.split_all(pieces) == want
    alone = []
    small.split = lambda piece: alone.append(piece) or codec.split(piece)
    assert small.split_all(pieces) == want and 10 * len(alone) < len(pieces)


def test_texts_are_coded_together(codec, monkeypatch):
    rng = random.Random(8)
    parts = ["first", "second,", "tiers.", "a1,", "don't", "mañana", "mañana!", "x.\ny", "", "梦想", "1½", "?,", " ", "\t", "z" * 70, "q" * 2_000]
    texts = ["", *[" ".join(rng.choices(parts, k=rng.randrange(80))) for _ in range(300)]]
    want = [LIBRARY.encode_ordinary(text) for text in texts]
    for together, block, memo in ((1 << 19, 1 << 20, 55_000), (300, 1_000, 10), (1, 50, 3)):
        for name, value in (("TOGETHER", together), ("BLOCK", block), ("MEMO", memo)):
            monkeypatch.setattr(D11, name, value)
        assert [ids.tolist() for ids in D11.Codec(TOKENS, D11.library_pattern(PATTERN), codec.halves).encode_all(texts)] == want


def test_decoded_rows_are_the_ids_bytes(spark):
    rows = [(1, [5, 300, 40_000]), (2, None), (3, []), (4, [7])]
    shared = D11.share(spark, TOKENS, PATTERN)
    ids = spark.createDataFrame(rows, "n long, ids array<int>").coalesce(1)
    assert {r["n"]: bytes(r["decoded"]) for r in D11.decode(ids, shared).collect()} == {n: D11.join(TOKENS, i or []) for n, i in rows}
    for wrong in (-1, len(TOKENS)):
        with pytest.raises(Exception, match="no such id|out of bounds"):
            D11.decode(spark.createDataFrame([(1, [wrong])], "n long, ids array<int>"), shared).collect()
