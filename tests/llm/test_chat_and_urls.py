"""Chat formatting (8) and URL rules (10)."""

import hashlib
import itertools
import json
import math
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwheel.llm import chat_format as D8
from cartwheel.llm import url_rules as D10

RECORDS = [
    (1, 0, {"role": "user", "text": "hi & <|end|> [INST]"}), (1, 1, {"text": "ok\n", "role": "assistant"}), (1, 2, {"role": None, "text": None}),
    (2, None, {"messages": [{"role": "user", "content": "q"}, {"content": "a</s>", "role": "assistant"}]}),
    (3, 0, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "&lt;"}], "id": "7"}),
    (4, 0, {"prompt": "p", "completion": "c"}), (5, 0, {"prompt": "p", "response": "r", "system": "s"}),
    (6, 0, {"instruction": "i", "output": "o"}), (7, 0, {"instruction": "i", "input": "x", "output": "o"}),
    (8, 0, {"what": "is this"}), (None, 0, {"role": "a\nb<", "text": ""}),
]
TURNS = {
    1: [("user", "hi & <|end|> [INST]"), ("assistant", "ok\n"), ("", "")], 2: [("user", "q"), ("assistant", "a</s>")],
    3: [("user", "q"), ("assistant", "&lt;")], 4: [("user", "p"), ("assistant", "c")],
    5: [("system", "s"), ("user", "p"), ("assistant", "r")], 6: [("user", "i"), ("assistant", "o")],
    7: [("user", "i\nx"), ("assistant", "o")], None: [("a\nb<", "")],
}


def records(spark):
    rows = [(c, t, json.dumps(r)) for c, t, r in RECORDS] + [(9, 0, "no json"), (9, 1, None)]
    return spark.createDataFrame(rows, "conv_id long, turn long, record string").withColumns({c: F.lit(1) for c in ("v", "layout", "part", "role")})


def test_layouts_become_canonical_turns_and_read_back(spark):
    formatted = D8.format_turns(D8.canonical_turns(records(spark)))
    got = {}
    for r in sorted(D8.read_turns(formatted).collect(), key=lambda r: (r["turn"] or 0, r["part"])):
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
        assert r["loss"] == (r["text"] if r["role"] == "assistant" else "")
        assert r["formatted"].count(D8.START) == 1 and r["formatted"].count("<") == 2 and "[" not in r["formatted"]
    assert got == TURNS
    assert sorted(r["conv_id"] for r in D8.unknown_records(records(spark)).collect()) == [8, 9, 9]
    assert D8.conversation_digests(formatted.limit(0)).count() == 0


def test_struct_rows_are_read_like_records(spark):
    said = "array<struct<role:string,content:string>>"
    for conv, schema in ((1, "role string, text string"), (2, f"messages {said}"), (3, "id int, conversations array<struct<value:string,`from`:string>>"),
                         (4, "prompt string, completion string"), (5, "prompt string, response string, system string"),
                         (6, "instruction string, output string"), (7, "instruction string, input string, output string")):
        rows = [(c, t, json.dumps(r)) for c, t, r in RECORDS if c == conv] + [(conv, 9, None)]
        structs = spark.createDataFrame(rows, "conv_id long, turn long, j string").select("conv_id", "turn", F.from_json("j", schema).alias("record"))
        got = sorted(map(tuple, D8.canonical_rows(structs.withColumn("part", F.lit(1))).collect()), key=lambda r: (r[1] or 0, r[2]))
        assert [r[3:] for r in got] == TURNS[conv]
    with pytest.raises(ValueError, match="no layout"):
        D8.canonical_rows(spark.range(1).selectExpr("id as conv_id", "id as turn", "struct(id as what) as record"))


def test_very_long_text_keeps_its_turn(spark):
    """Beyond the 20,000,000 characters that a JSON string may have."""
    text = F.expr("repeat(if(id = 0, '<', 'x'), if(id = 0, 3, 21000000))")
    rows = spark.range(2).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.struct(F.lit("assistant").alias("role"), text.alias("text")).alias("record"))
    got = D8.conversation_digests(D8.format_turns(D8.canonical_rows(rows))).orderBy("conv_id").collect()
    assert [(r["n_turns"], r["loss_chars"]) for r in got] == [(1, 3), (1, 21_000_000)]
    assert [r["turns_sha256"] for r in got] == [hashlib.sha256(f"assistant\n{t}\n".encode()).hexdigest() for t in ("<<<", "x" * 21_000_000)]


def test_repeated_rows_and_equal_turn_numbers(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", "n")]
    structs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select("conv_id", "turn", F.struct("role", "text").alias("record"))
    [r] = D8.conversation_digests(D8.format_turns(D8.canonical_rows(structs))).collect()
    assert r["n_turns"] == 4 and r["turns_sha256"] == hashlib.sha256(b"assistant\nn\nuser\na\nuser\na\nuser\nb\n").hexdigest()


def test_formatting_is_native(spark):
    plan = D8.conversation_digests(D8.format_turns(D8.canonical_turns(records(spark))))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_escapes_round_trip(spark):
    texts = ["", "&", "&amp;", "&lt;|", "<|start|>user\n", "[INST]&lbrack;", "&&lt;;<"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert all(r["t"] == r["b"] for r in df.select("t", D8.unescape(D8.escape(F.col("t"))).alias("b")).collect())


URLS = [None, "", "nothing", "http://A.Example.COM/en/1", "https://www.example.com/en/x?y=1", "http://x.net/es/", "http://net/fr/z#t", "http://com",
        "ftp://example.com?q=/en/", "http://b.com/x", "a://b://c/d", "http://notexample.com/en/", "http://x.net/es"]


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match("[^/?#]*", rest)[0])
    path = re.match("[^?#]*", rest[len(host):])[0]
    fits = [(len(h + p), h + p, v) for h, p, v in D10.LIST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else None


def test_list_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(0, None)], "page_id long, url string").withColumns(
        {c: F.lit(1) for c in ("row", "host", "token", "tokens")})
    labels = spark.createDataFrame([], "page_id long, label string")
    rows = D10.judge(pages, labels).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        host, path, rule = brute_rule(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
        assert r["verdict"] == (rule[1] if rule else "allow")
    assert D10.judge(pages.limit(0), labels).count() == 0


def brute_match(tokens, rules):
    fits = [(c, v == "block", v) for need, v, c in rules if set(need) <= set(tokens)]
    return max(fits)[2] if fits else None


def test_rules_are_mined_pruned_and_matched(spark):
    good = [["host:a", "path:x"], ["host:a", "path:y"], ["host:b", "path:x"]] * 20
    bad = [["host:b", "path:y"], ["host:b", "path:y", "name:q"]] * 20
    labelled = spark.createDataFrame([(t, "allow") for t in good] + [(t, "block") for t in bad], "tokens array<string>, label string")
    rules = [(r["tokens"], r["verdict"], r["confidence"]) for r in D10.mine_rules(labelled).collect()]
    assert (["host:b", "path:y"], "block", 1.0) in rules
    assert not any(v == "block" and {"host:b", "path:y"} < set(t) for t, v, _ in rules)          # beaten by the shorter rule
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad + [["host:z"], []])], "row long, tokens array<string>")
    got = {r["row"]: r["verdict"] for r in D10.match_rules(rows, D10.mine_rules(labelled)).collect()}
    for i, t in enumerate(good + bad + [["host:z"], []]):
        assert got.get(i) == brute_match(t, rules)


def brute_mine(rows, confidence=D10.MIN_CONFIDENCE):
    """Every set of tokens that enough rows hold, by counting each row's subsets."""
    held = {}
    for tokens, label in rows:
        for k in range(1, len(tokens) + 1):
            for part in itertools.combinations(sorted(tokens), k):
                held.setdefault(part, []).append(label)
    least = max(math.ceil(D10.MIN_SUPPORT * len(rows)), D10.MIN_ROWS)
    rules = {(p, v): ls.count(v) / len(ls) for p, ls in held.items() for v in set(ls) if ls.count(v) >= least and ls.count(v) / len(ls) >= confidence}
    return {(p, v, c) for (p, v), c in rules.items()
            if not any(v == w and set(q) < set(p) and d >= c for (q, w), d in rules.items())}


def test_mined_rules_equal_a_brute_force_miner(spark):
    """Tokens of every kind: in all rows, of one label, of the same rows, and mixed."""
    draw = random.Random(7)
    rows = []
    for _ in range(400):
        tokens = ["all"] + [t for t in "abcd" if draw.random() < 0.55]
        tokens += ["twin1", "twin2"] if draw.random() < 0.4 else []
        label = "block" if ("a" in tokens and "b" in tokens and draw.random() < 0.9) or draw.random() < 0.2 else "allow"
        rows.append((tokens + (["pure"] if label == "block" and draw.random() < 0.5 else []), label))
    labelled = spark.createDataFrame(rows, "tokens array<string>, label string")
    table = D10.token_table(labelled)
    names = {}
    for r in table.collect():
        names.setdefault(r["item"], []).append(r["token"])
    assert sorted(names["twin1"]) == ["twin1", "twin2"] and len(names) == 7
    got = {(tuple(sorted(p)), r["verdict"], r["confidence"]) for r in D10.mine_rules(labelled, table=table).collect()
           for p in itertools.product(*(names[t] for t in r["tokens"]))}
    want = brute_mine(rows)
    assert got == want and any(len(p) > 1 for p, _, _ in want)


def test_hot_long_urls_make_no_explosion(spark):
    """300 equal urls of 40 tokens, with both labels, and a very long url beside them."""
    words = "/".join(f"w{i}" for i in range(37))
    urls = [f"http://h.org/{words}"] * 300 + [f"http://x.org/{words}/" + "/".join(f"v{i}" for i in range(5000))] * 2
    pages = spark.createDataFrame(list(enumerate(urls)) + [(900, f"http://other.io/{words}"), (901, "http://other.io/w3")], "page_id long, url string")
    labels = spark.createDataFrame([(i, "block" if i % 10 else "allow") for i in range(300)] * 2, "page_id long, label string")
    rows = {r["page_id"]: r["verdict"] for r in D10.judge(pages, labels).collect()}
    assert len(rows) == 304 and rows[0] == rows[300] == rows[900] == rows[901] == "block"


@settings(max_examples=50, deadline=None)
@given(st.text(max_size=30))
def test_brute_rule_never_fails(url):
    brute_rule(url)
