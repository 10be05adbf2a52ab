"""Spelling variants (12) against brute force."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from cartwheel.llm import spelling as D12


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=5):
    form, out = {}, {}
    for w, n in counts.items():
        near = [(-m, v) for v, m in counts.items() if one_apart(w, v)]
        best = min(near, default=None)
        if best and -best[0] >= ratio * n:
            form[w] = best[1]
        out[w] = (n, len(near))
    rows = []
    for w, (n, k) in out.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, k, counts[form[w]] if w in form else None))
    return sorted(rows)


def table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def got(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def test_random_words(spark):
    rng = random.Random(3)
    counts = {"".join(rng.choices("abé", k=rng.randint(1, 6))): rng.choice([1, 2, 5, 9, 10, 50, 51, 250]) for _ in range(400)}
    assert got(D12.group_variants(table(spark, counts))) == brute(counts)


def test_chains_ties_runs_and_long_words(spark):
    long = "xy" * 20_000
    counts = {"aaaaaa": 1, "aaaaaaa": 5, "aaaaaaaa": 25, "aaaaaaaaa": 125, "aaaaaaaaaa": 625, "baaaaa": 5, "caaaaa": 5, long: 5, long + "y": 25,
              long[:-1] + "z": 1, "solitary": 9, "àaaaaa": 2, "ÿaaaaa": 2}
    assert got(D12.group_variants(table(spark, counts))) == brute(counts)


def test_full_group_of_one_place(spark):
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    counts = {f"word{c}s": 5 + i for i, c in enumerate(letters)} | {"words": 1000, "wordss": 7}
    assert got(D12.group_variants(table(spark, counts))) == brute(counts)


def test_nodes_are_numbered_once(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(1, 9))) for _ in range(300)})
    rows = D12._numbered(table(spark, dict.fromkeys(words, 1)), "word").collect()
    node = {}
    for r in rows:
        assert len(r["nodes"]) == len(r["word"]) + 1
        for k, x in enumerate(r["nodes"]):
            assert node.setdefault(r["word"][:k], x) == x
    assert len(set(node.values())) == len(node)
    assert [r["word"] for r in sorted(rows, key=lambda r: r["number"])] == words


def test_planted_words_and_awkward_rows(spark, edge_docs, edge_rows):
    extra = [(20, "Foobar FOOBAR foobar foobár-foobar foobars Ärzte123xÀÈÌÒÙÉabcdef fooBars çççççç", "en"), (None, "foobar foobars", "en")] * 4
    rows = edge_rows + extra
    docs = edge_docs.select("doc_id", "text").unionByName(spark.createDataFrame([r[:2] for r in extra], "doc_id long, text string")).withColumn("word", F.lit("clash"))
    want = Counter()
    for d, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 3 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                want[run] += 1
    words = D12.planted_words(docs, one_in=3)
    assert Counter(r["word"] for r in words.collect()) == want
    counts = {w: n for w, n in want.items() if n >= 2}
    assert counts and got(D12.group_variants(D12.count_words(words, fewest=2), ratio=2)) == brute(counts, 2)
    assert D12.group_variants(D12.count_words(D12.planted_words(docs.limit(0)))).count() == 0


def test_null_words_are_left_out(spark):
    counts = spark.createDataFrame([(None, 5, 1), ("abcdef", None, 1), ("abcdeg", 5, 1), ("", 3, 1)], "word string, n int, number int")
    assert got(D12.group_variants(counts)) == [("", None, "", 3, 0, None), ("abcdeg", None, "abcdeg", 5, 0, None)]
