"""Decontamination (2), toxicity (5), quality (3)."""

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import decontaminate as D2
from cartwheel.llm import quality as D3
from cartwheel.llm import toxicity as D5

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(docs, items, width=10):
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, phrase in items:
            p = words(phrase)
            n = min(width, len(p))
            wins = {tuple(p[i:i + n]) for i in range(len(p) - n + 1)} if n else set()
            for at in range(len(w) - n + 1) if n else ():
                if tuple(w[at:at + n]) in wins:
                    hit |= set(range(at, at + n))
                    found.add("null" if item is None else str(item))
        ids = ",".join(sorted(found))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


ITEMS = [(1, "b c"), (2, "w1x1 w2x2 w3x3 w4x4 w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 w11x11"), (2, "a"), (3, None), (4, " ,. "),
         (None, "same id"), (10, "B C"), (11, "absent")]


@pytest.mark.parametrize("block_bytes", [D2.BLOCK_BYTES, 64])
def test_decontaminate_equals_brute_force(spark, edge_docs, edge_rows, block_bytes, monkeypatch):
    bench = spark.createDataFrame(ITEMS, "item_id int, text string").withColumn("n", F.lit(0))
    rows = D2.contaminated_spans(edge_docs, bench, block_bytes=block_bytes)
    monkeypatch.setattr(D2, "contaminated_spans", lambda *a: rows)
    got = sorted((tuple(r) for r in D2.decontaminate(edge_docs, bench).collect()), key=repr)
    assert got == brute_hits([r[:2] for r in edge_rows], ITEMS)


def test_decontaminate_on_sample(spark, small_docs, small_rows):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    got = sorted((tuple(r) for r in D2.decontaminate(small_docs, bench).collect()), key=repr)
    assert got == brute_hits(small_rows, items)
    assert any(r[-1] for r in got)


def test_decontaminate_empty(spark, edge_docs):
    bench = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert D2.decontaminate(edge_docs.limit(0), bench).count() == 0
    assert D2.decontaminate(edge_docs, bench.limit(0)).filter("contaminated").count() == 0


def test_decontaminate_copies_of_an_item_count_once(spark, monkeypatch):
    item = "one two three four five six"
    bench = spark.createDataFrame([(1, item)] * 50 + [(2, "seven eight")], "item_id int, text string")
    tries = []
    pmod = F.pmod
    monkeypatch.setattr(D2.F, "pmod", lambda *a: tries.append(a) or (pmod(*a) if len(tries) < 9 else 1 / 0))    # else it never ends
    assert sorted(r for b in D2.query_blocks(bench, 32) for r in b) == [("1", item.encode()), ("2", b"seven eight")]


def test_decontaminate_reads_a_block_at_a_time(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    log = []

    def blocks(*_):
        for w in (b"b", b"c"):
            log.append("read")
            yield [("1", w)]

    monkeypatch.setattr(D2, "query_blocks", blocks)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast",
                        lambda self, v, send=type(spark.sparkContext).broadcast: log.append("sent") or send(self, v))
    D2.find_matches(docs, None)
    D2.contaminated_spans(docs, None)
    assert log == ["read", "sent"] * 4


def test_exact_and_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "x a b c d y"), (2, "a z b c d"), (3, "a b"), (4, "d c b a"), (5, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "a b c d")], "item_id int, text string")
    exact = [tuple(r) for r in D2.find_matches(docs, bench).collect()]
    assert exact == [(1, "7", 1, 4, True)]
    near = {(r["doc_id"], r["exact"]) for r in D2.find_matches(docs, bench, slop=1).collect()}
    assert near == {(1, True), (2, False)}


@pytest.fixture(scope="module")
def toxic_table(spark):
    calm, bad = "the sun is up. we walk to the sea.", "you are a {} person."
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        text = f"{calm} {calm}" + (f"\n{bad.format(['fool', 'idiot'][i // 5 % 2])} bye {['fool', 'idiot'][i // 10 % 2]}." if toxic else "\nyou are a kind person.")
        rows.append((i, text))
        labels.append((i, 1, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity_learns_held_out_rows_and_locates(toxic_table):
    docs, labels = toxic_table
    model = D5.fit(docs, labels, steps=40)
    rows = D5.score(docs, model).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert held and all(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in held)
    found = D5.locate(docs, model).collect()
    assert {r["doc_id"] for r in found} == {i for i in range(400) if i % 5 == 0}
    assert all("fool" in r["text"] or "idiot" in r["text"] for r in found)


def test_toxicity_never_reads_held_out_labels(toxic_table):
    docs, labels = toxic_table
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2,
                                                1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert D5.fit(docs, labels, steps=5) == D5.fit(docs, flipped, steps=5)


def test_toxicity_edge_rows(spark, edge_docs, edge_labels, edge_rows):
    rows = D5.detect(edge_docs, edge_labels).collect()
    assert len(rows) == len(edge_rows) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 0 for r in rows if r["doc_id"] in (1, 7, 10))
    assert D5.detect(edge_docs.limit(0), edge_labels).count() == 0
    assert D5.detect(edge_docs, edge_labels.limit(0)).count() == len(edge_rows)


def test_toxicity_does_not_grow_with_length(spark, toxic_table):
    docs, labels = toxic_table
    model = D5.fit(docs, labels, steps=40)
    calm = "the sun is up. we walk to the sea. "
    long = spark.createDataFrame([(1, calm * 5_000), (2, calm * 5_000 + "you are a fool person. bye fool."), (3, "zzz qqq. " * 100_000)],
                                 "doc_id long, text string")
    got = {r["doc_id"]: r for r in D5.score(long, model).collect()}
    assert [got[i]["predicted"] for i in (1, 2, 3)] == [0, 1, 0] and got[3]["score"] == 0


def test_toxicity_without_features_scores_the_share(spark):
    docs = spark.createDataFrame([(i, "same words. " * (1 + 5_000 * (i % 2))) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(40)], "doc_id long, toxic int")
    model = D5.fit(docs, labels)
    assert not model["features"]
    scores = {r["score"] for r in D5.score(docs, model).collect()}
    assert scores == {model["share"]} and 0 < model["share"] < 0.3
    assert D5.locate(docs, model, 0.0001).isEmpty()


def test_quality_separates_junk(spark):
    rows = [(i, ("Quiet words on a page about rivers. " if i % 4 else "BUY!! NOW!! %%% $$$ | ") * (3 + i % 7), "en", f"s{i % 3}", 50) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 400, 3)], "doc_id long, quality int, toxic int")
    got = D3.classify(docs, labels, rounds=1).collect()
    assert len(got) == 400 and all(r["good"] == (r["doc_id"] % 4 > 0) for r in got)


def test_quality_rounds_see_all_other_documents(spark, monkeypatch):
    rows = [(i, "Quiet words on a page about rivers. " if i % 4 else "BUY!! NOW!! %%% $$$ | ", "en", "s", 50) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    pools = []
    cut = D3.cut_lineage
    monkeypatch.setattr(D3, "cut_lineage", lambda df, name: pools.append((name, out := cut(df, name))) or out)
    D3.fit(docs, labels, max_labelled=100, rounds=1)
    sizes = {name: {r["doc_id"] for r in t.collect()} for name, t in pools}
    assert sizes["quality_pool"] == set(range(400)) - sizes["quality_labelled"] and len(sizes["quality_pool"]) > 200


def test_quality_edge_rows(edge_docs, edge_labels, edge_rows):
    assert D3.classify(edge_docs, edge_labels, rounds=1).count() == len(edge_rows)
    one_kind = D3.classify(edge_docs, edge_labels.filter("quality = 1")).collect()
    assert len(one_kind) == len(edge_rows) and all(r["score"] == 1 for r in one_kind)
    assert D3.classify(edge_docs.limit(0), edge_labels.limit(0)).count() == 0
