"""Exact dedup (7) and near-dedup (1) against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from cartwheel.llm import exact_dedup as D7
from cartwheel.llm import near_dedup as D1
from cartwheel.llm.catalog import QUERIES


def brute_exact(rows):
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc is None, doc or 0, i, doc))
    out = []
    for norm, members in groups.items():
        best = min(m[:3] for m in members)
        sha = hashlib.sha256(norm.encode()).hexdigest()
        keep = min(members)[4]
        same = sorted(m for m in members if m[:3] == best)
        out += [(m[4], keep, len(members), m is same[0] or m == same[0], sha) for m in members]
    return out


def key(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("digits", [{}, {"first_digit": 1, "growth": 2, "max_digit": 64}])
def test_exact_dedup_equals_brute_force(edge_docs, edge_rows, digits):
    got = [tuple(r) for r in D7.exact_dedup(edge_docs, **digits).collect()]
    assert key(got) == key(brute_exact([r[:2] for r in edge_rows]))


def test_exact_dedup_on_sample(small_docs, small_rows):
    assert key(tuple(r) for r in D7.exact_dedup(small_docs).collect()) == key(brute_exact(small_rows))


def test_exact_dedup_empty(edge_docs):
    assert D7.exact_dedup(edge_docs.limit(0)).count() == 0


def brute_near(rows):
    sets = [D1.shingle_set(t.encode() if t is not None else None) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        members[find(i)].append((doc is None, doc))
    out = []
    for i, (doc, _) in enumerate(rows):
        comp = min(members[find(i)], key=lambda m: (m[0], m[1] or 0))[1]
        out.append((doc, len(sets[i]), comp, doc == comp))
    return out


def test_near_dedup_equals_brute_force(edge_docs, edge_rows):
    got = [tuple(r) for r in D1.near_dedup(edge_docs).collect()]
    assert key(got) == key(brute_near([r[:2] for r in edge_rows]))


def test_near_dedup_on_sample(small_docs, small_rows):
    assert key(tuple(r) for r in D1.near_dedup(small_docs).collect()) == key(brute_near(small_rows))


def test_near_dedup_dense_group(spark, monkeypatch):
    """Many near copies, linked and not quite linked, in blocks smaller than the group."""
    monkeypatch.setattr(D1, "BLOCK", 16)
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(150):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 7), replace=False):
            words[at] = f"x{rng.integers(10_000)}"
        rows.append((d, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert key(tuple(r) for r in D1.near_dedup(docs).collect()) == key(brute_near(rows))


def word_runs(text, width):
    """Shingles by another way than the operator's."""
    words = (text or "").lower().split()
    return {" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def test_shingle_width_by_caller(spark):
    for text in ("a b c d e f a b c d e", "a b", "a", None):
        for width in (2, 5):
            given = text.encode() if text else None
            assert {b" ".join(s).decode() for s in D1.shingle_set(given, width)} == word_runs(text, width)
            assert len(D1.shingle_hashes(D1.words_of(given), D1.Memo(xxhash.xxh64_intdigest), width)) == len(word_runs(text, width))
    words = [f"w{i}" for i in range(100)]
    docs = spark.createDataFrame(
        [(1, " ".join(words)), (2, " ".join("x" if i in (15, 30, 45, 60) else w for i, w in enumerate(words)))], "doc_id long, text string")
    both = {w: len({r["component_id"] for r in D1.near_dedup(docs, width=w).collect()}) for w in (2, 5)}
    assert both == {2: 1, 5: 2}


def test_op1_query_links_on_two_words(spark, small_rows, monkeypatch):
    wide = D1.shingle_set
    monkeypatch.setattr(D1, "shingle_set", lambda text, width=2: wide(text, width))
    want = key(brute_near(small_rows))
    monkeypatch.undo()
    assert key(tuple(r) for r in QUERIES["op1_near_dedup"](spark, "/root/testdata/sf0.001").collect()) == want


def test_near_dedup_empty(edge_docs):
    assert D1.near_dedup(edge_docs.limit(0)).count() == 0


def test_registers_estimate_and_merge():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[400:2400])
    first = D1.sketch([a, b, np.unique(pool[:2400])])
    k = D1.truncated(first)
    assert (np.maximum(k[0], k[1]) == k[2]).all()                      # mergeable
    j = D1.estimate(k[:1], k[1:2], np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(j - 1600 / 2400) < 0.12
    alone = D1.sketch([a])
    assert (alone[0] == first[0]).all()                                # independent of the batch


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["comp"] for r in D1.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
