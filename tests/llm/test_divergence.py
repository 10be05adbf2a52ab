"""Source divergence (13) against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from cartwheel.llm import divergence as D13

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(rows, fewest, top=50):
    """rows: (text, lang, source)."""
    docs = [(terms_of(t), lang or "", source or "") for t, lang, source in rows]
    df, counts = defaultdict(Counter), defaultdict(Counter)
    for terms, lang, source in docs:
        df[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang in {d[1] for d in docs}:
        kept = sorted(t for t, n in df[lang].items() if n >= fewest)
        sources = sorted({d[2] for d in docs if d[1] == lang})

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s)
            own = sorted((q[t] - p[s][t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t])[:top]
            for part, ranked in (("pair", pairs), ("term", own)):
                out += [(lang, s, part, item, -value, k) for k, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def got(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


def corpus(seed, n, sources):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdé梦", k=rng.randint(1, 5))) for _ in range(150)]
    return [(" ".join(rng.choices(words, weights=range(150, 0, -1), k=rng.randint(0, 40))), rng.choice(["en", "de", None, ""]), f"s{rng.randrange(sources)}")
            for _ in range(n)]


@pytest.mark.parametrize("case", ["plain", "many_blocks"])
def test_against_brute_force(spark, case, monkeypatch):
    rows = corpus(1, 200, 7)
    limit = D13.BLOCK
    if case == "many_blocks":
        for name, value in (("SHARD", 7), ("WIDTH", 5), ("SIDE", 2), ("FLUSH", 20)):
            monkeypatch.setattr(D13, name, value)
        limit = 900
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert got(D13.audit(docs, fewest=6, top=9, limit=limit)) == brute(rows, 6, 9)


def test_awkward_rows(spark, edge_docs, edge_rows):
    rows = [(t, lang, "s") for _, t, lang in edge_rows]
    more = [("same words here", "en", None), ("Same WORDS", "en", "t"), (None, "zz", None), ("", "zz", "a"), ("x" * 50_000, "en", "t"), ("x" * 50_000 + " é", "en", "t")]
    docs = edge_docs.select("text", "lang", "source").unionByName(spark.createDataFrame(more, "text string, lang string, source string"))
    clash = docs.selectExpr("*", "1 as term", "2 as n", "3 as ordinal", "4 as total", "5 as part")
    assert got(D13.audit(clash, fewest=2)) == brute(rows + more, 2)
    assert got(D13.audit(docs, fewest=10_000)) == brute(rows + more, 10_000)
    assert D13.audit(docs.limit(0)).count() == 0


def test_transducer_is_minimal_and_ordered():
    rng = random.Random(2)
    terms = sorted({"".join(rng.choices("abc梦", k=rng.randint(1, 6))) for _ in range(500)})
    t = D13.Transducer.build(terms)
    assert [t.term(i) for i in range(len(terms))] == terms
    ends = {frozenset(x[k:] for x in terms if x.startswith(p)) for x in terms for k in range(len(x) + 1) for p in [x[:k]]}
    assert len(t.finals) == len(ends)       # one state for each set of ends
    row = {"lang": "l", "first": terms[0], "base": 10, "keys": t.keys.tobytes(), "targets": t.targets.astype("int32").tobytes(),
           "outs": t.outs.astype("int32").tobytes(), "finals": t.finals.tobytes()}
    others = ["", "zz", "a" * 9, "d", terms[3] + "x", "\u0001"]
    assert D13.Block([row]).ordinals("l", terms + others).tolist() == [*range(10, 10 + len(terms)), *[-1] * len(others)]
