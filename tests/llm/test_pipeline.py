"""The pipeline against the operators' brute-force meanings, stage by stage, and the entry module's guard."""

import subprocess
import sys
import textwrap

import corpus_pipeline
from cartwheel.llm import toxicity as D5
from cartwheel.llm.catalog import QUERIES, SQL

from .test_dedup import brute_exact, brute_near
from .test_text_ops import brute_hits
from .test_tokens import check_pieces

SF = "/root/testdata/sf0.001"


def test_stages_keep_what_brute_force_keeps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        rows = list(before.items())
        out = corpus_pipeline.cut_lineage(stage(spark, docs, SF))
        if name == "packing":
            check_pieces(out.collect(), rows, 2048)
            break
        assert out.columns == columns
        kept = {r["doc_id"] for r in out.collect()}
        if name == "toxicity":
            model = D5.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            lexicon = D5.Lexicon(model)
            want = {d for d, t in rows if D5.noisy_or(lexicon.sentences(D5.words_of(t))[1]) < 0.3}
        elif name == "exact dedup":
            want = {r[0] for r in brute_exact(rows) if r[3]}
        elif name == "near dedup":
            want = {r[0] for r in brute_near(rows) if r[3]}
        else:
            want = {r[0] for r in brute_hits(rows, bench) if not r[-1]}
        assert kept == want, name
        docs = out


def test_stages_take_awkward_rows(spark, edge_docs, tmp_path):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    for docs in (edge_docs, edge_docs.limit(0)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.cut_lineage(stage(spark, docs, str(tmp_path)))
            assert name == "packing" or docs.columns == columns


def test_verdicts_take_effect_by_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = "doc_id long, text string, lang string"
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    scores = D5.score(docs, D5.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))).filter("doc_id is not null").collect()
    toxic, clean = (texts[pick(scores, key=lambda r: r["score"])["doc_id"]] for pick in (max, min))
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 100").first()["text"]
    near = " ".join(f"w{i}" for i in range(100))

    def left(stage, rows, base=None):
        given = spark.createDataFrame([(*r, "en") for r in rows], columns)
        out = dict(corpus_pipeline.STAGES)[stage](spark, given if base is None else base.unionByName(given), SF)
        return sorted(((r["doc_id"], r["text"]) for r in out.collect() if r["doc_id"] in (None, -1)), key=repr)

    mixed = [(-1, toxic), (-1, clean), (None, toxic), (None, clean)]
    assert left("toxicity", mixed, docs.select("doc_id", "text", "lang")) == sorted([(-1, clean), (None, clean)], key=repr)
    assert left("decontamination", [(-1, leak), (-1, "fine"), (None, leak), (None, "fine")]) == sorted([(-1, "fine"), (None, "fine")], key=repr)
    assert left("exact dedup", [(-1, "a b"), (-1, "a b"), (-1, "c"), (None, "x"), (None, "x "), (None, "y")]) == sorted(
        [(-1, "a b"), (-1, "c"), (None, "x "), (None, "y")], key=repr)
    kept = left("near dedup", [(-1, near), (-1, near + " end"), (-1, "c"), (None, "x y"), (None, "x  y"), (None, ""), (None, "z")])
    assert sorted(str(d) + t[:1] for d, t in kept) == ["-1c", "-1w", "None", "Nonex", "Nonez"]


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(SQL) <= set(QUERIES)


def test_entry_works_without_the_subpackage():
    code = textwrap.dedent("""
        import sys
        class Gone:
            def find_spec(self, name, path=None, target=None):
                if name in ("cartwheel.llm", "corpus_pipeline"):
                    raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as e
        names = e.queries()
        assert len(names) > 100 and not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in names)
    """)
    root = corpus_pipeline.__file__.rsplit("/", 1)[0]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
