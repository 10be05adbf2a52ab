"""Operator 5, toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's chance of being toxic is logistic in
its words' weights; the document's is the noisy-or of its sentences',
1 - prod(1 - p_s). The chance that the bias alone gives any sentence is a background of
the fit and says nothing of a sentence; scores leave it out, 1 - p_s = (1 - p_z) / (1 - p_bias),
at most 1, so plain sentences add nothing however many there are. Only documents have labels, so the likelihood of the document
labels trains the sentence model, and its sentence scores then say which sentences
offend. A word's weight is the sum over its hashed features: the word and its first
four and five letters. Features are chosen by chi-square of their presence in
documents against the label; weights are fitted by Adam, each step one Spark job whose
tasks return one summed gradient each.

Scale: fitting takes a bounded sample of labelled documents (``MAX_TRAIN`` rows in
expectation, by a hash of doc_id); counts and gradients are summed in the tasks.
Scoring is one pass over whole texts with a model of at most ``MAX_FEATURES`` weights,
and no shuffle.

Defined cases: null, empty and wordless texts have no sentence and score 0; a null
doc_id is never labelled nor held out; several labels of one doc_id count as toxic if
one is; repeated rows each keep their row; extra columns are ignored; without labels of
both kinds, or a feature to choose, every document with a sentence scores the share of
toxic labels whatever its length, and no sentence offends.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, cut_lineage, map_arrow, ship

ship(__name__)

MAX_TRAIN = 20_000
HASH_BITS = 18
MAX_FEATURES = 4096
MIN_CHI2 = 12.0
STEPS, RATE, RIDGE = 100, 0.4, 0.15      # RIDGE: of the summed loss
THRESHOLD = 0.3
_TASKS = 8
_ENDS = ".!?"


def held_out():
    """Rows never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def features_of(word: str) -> list[int]:
    """Hashed features of a raw word: lower-cased letters and digits, and its beginnings."""
    w = "".join(c for c in word.lower() if c.isalnum())
    mask = (1 << HASH_BITS) - 1
    return sorted({zlib.crc32(x.encode()) & mask for x in ([w] if w else []) + [f"{w[:n]}*" for n in (4, 5) if len(w) > n]})


def words_of(text: str | None) -> list[str]:
    """Raw words; a line end also ends a sentence."""
    return text.replace("\n", " . ").split() if text else []


class Lexicon:
    """Per raw word: its weight, whether it ends a sentence, whether it is a word at all."""

    def __init__(self, model: dict):
        self.weights = dict(zip(model["features"], model["weights"]))
        self.bias = model["bias"]
        self.share = model.get("share")         # without weights: the score of any document
        self.table = np.zeros((3, 1 << 12))
        self.memo = Memo(self._add)

    def _add(self, word: str) -> int:
        i = len(self.memo)
        if i >= self.table.shape[1]:
            self.table = np.concatenate((self.table, np.zeros_like(self.table)), axis=1)
        ids = features_of(word)
        self.table[:, i] = (sum(self.weights.get(f, 0.0) for f in ids), word[-1] in _ENDS, bool(ids))
        return i

    def sentences(self, words: list[str]):
        """(first word, -log(1 - p)) of each sentence, p its chance beyond that of the bias."""
        if len(self.memo) + len(words) > self.memo.limit:
            self.memo.clear()
            self.memo.limit = max(self.memo.limit, len(words) + 1)
        ids = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        weight, ends, real = self.table[:, ids]
        first = np.concatenate(([0], np.flatnonzero(ends[:-1]) + 1)) if len(ids) else np.zeros(0, np.int64)
        if not len(first):
            return first, first.astype(float)
        keep = np.add.reduceat(real, first) > 0
        z = self.bias + np.add.reduceat(weight, first)[keep]
        return first[keep], np.maximum(np.logaddexp(0, z) - np.logaddexp(0, self.bias), 0.0)

    def score(self, text: str | None) -> float:
        first, risks = self.sentences(words_of(text))
        return noisy_or(risks) if self.share is None else self.share if len(first) else 0.0


def noisy_or(risks: np.ndarray) -> float:
    """1 - prod(1 - p) from each sentence's -log(1 - p)."""
    return float(-np.expm1(-risks.sum()))


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> DataFrame:
    """(text, y) of at most about ``limit`` labelled documents that are not held out."""
    known = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("y")).filter(~held_out())
    n = known.count()
    share = min(1.0, limit / max(1, n))
    part = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # bounded by ``limit``, whatever the input
    return docs.select("doc_id", "text").join(F.broadcast(part), "doc_id").select("text", "y")


def choose_features(sample: DataFrame) -> tuple[np.ndarray, float]:
    """Features whose presence goes with the label, and the share of toxic documents."""
    size = 1 << HASH_BITS

    def run(batches):
        import pyarrow as pa

        counts, docs = np.zeros((2, size), np.int32), [0, 0]
        memo = Memo(features_of)
        for batch in batches:
            for text, y in zip(*[c.to_pylist() for c in batch.columns]):
                y = int(y > 0)
                docs[y] += 1
                ids = list({f for w in set(words_of(text)) for f in memo[w]})
                counts[y, ids] += 1
        yield pa.RecordBatch.from_pydict({"n0": [docs[0]], "n1": [docs[1]], "counts": [counts.tobytes()]})

    total, n = np.zeros((2, size)), np.zeros(2)
    for row in sample.mapInArrow(run, "n0 long, n1 long, counts binary").collect():     # one row a task
        total += np.frombuffer(row["counts"], np.int32).reshape(2, size)
        n += (row["n0"], row["n1"])
    if not n.all():
        return np.zeros(0, np.int64), float(n[1] / max(1, n.sum()))
    a, b = total[1], total[0]
    c, d = n[1] - a, n[0] - b
    with np.errstate(divide="ignore", invalid="ignore"):
        chi2 = np.nan_to_num(n.sum() * (a * d - b * c) ** 2 / ((a + b) * (c + d) * n[0] * n[1]))
    chi2[a + b < 2] = 0
    best = np.argsort(-chi2, kind="stable")[:MAX_FEATURES]
    return np.sort(best[chi2[best] >= MIN_CHI2]), float(n[1] / n.sum())


def _bags(sample: DataFrame, chosen: np.ndarray) -> DataFrame:
    """Written training bags: y, plain (sentences without chosen features), sizes and features of the others."""
    place = {int(f): i for i, f in enumerate(chosen)}

    def start():
        memo = Memo(lambda w: ([place[f] for f in features_of(w) if f in place], w[-1] in _ENDS, bool(features_of(w))))

        def work(texts, ys):
            out = {"y": [int(y > 0) for y in ys], "plain": [], "sizes": [], "features": []}
            for text in texts:
                plain, sizes, feats, now, real = 0, [], [], [], False
                for w in [*words_of(text), "."]:
                    ids, end, word = memo[w]
                    now += ids
                    real |= word
                    if end:
                        if now:
                            sizes.append(len(now))
                            feats += now
                        elif real:
                            plain += 1
                        now, real = [], False
                out["plain"].append(plain)
                out["sizes"].append(sizes)
                out["features"].append(feats)
            return out
        return work

    return cut_lineage(map_arrow(sample, "y int, plain int, sizes array<int>, features array<int>", start), "toxic_bags")


def _gradient(weights: np.ndarray, bias: float):
    """Per task: loss and its gradient in the weights and the bias."""
    def run(batches):
        import pyarrow as pa

        grad, loss = np.zeros(len(weights) + 1), 0.0
        for batch in batches:
            y, plain, sizes, feats = batch.columns
            y, plain = y.to_numpy(), plain.to_numpy()
            n_sent = np.diff(sizes.offsets.to_numpy())
            size, ids = sizes.flatten().to_numpy(), feats.flatten().to_numpy()
            sent = np.repeat(np.arange(len(size)), size)
            doc = np.repeat(np.arange(len(y)), n_sent)
            z = bias + np.bincount(sent, weights[ids], len(size))
            none = np.bincount(doc, np.logaddexp(0, z), len(y)) + plain * np.logaddexp(0, bias)   # -log prod(1 - p)
            p = np.maximum(-np.expm1(-none), 1e-12)
            pull = np.where(y > 0, -np.exp(-none) / p, 1.0)
            ps = 1 / (1 + np.exp(-z)) * pull[doc]
            grad[:-1] += np.bincount(ids, ps[sent], len(weights))
            grad[-1] += ps.sum() + (plain * pull).sum() / (1 + math.exp(-bias))
            loss += np.where(y > 0, -np.log(p), none).sum()
        yield pa.RecordBatch.from_pydict({"loss": [float(loss)], "grad": [grad.tobytes()]})
    return run


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN, steps: int = STEPS) -> dict:
    """The model: features (hash values), weights, bias; share of toxic documents if there is no feature."""
    sample = cut_lineage(labelled_sample(docs, labels, limit).repartition(_TASKS), "toxic_sample")
    chosen, share = choose_features(sample)
    bias = math.log((share + 1e-3) / (1 - share + 1e-3))
    if not len(chosen):
        return {"features": [], "weights": [], "bias": bias, "share": share}
    bags = _bags(sample, chosen)
    n = bags.count()
    x = np.zeros(len(chosen) + 1)
    x[-1] = bias - 3
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, steps + 1):
        grad = np.zeros_like(x)
        for row in bags.mapInArrow(_gradient(x[:-1], float(x[-1])), "loss double, grad binary").collect():  # one row a task
            grad += np.frombuffer(row["grad"])
        grad = (grad + RIDGE * np.append(x[:-1], 0.0)) / n
        m, v = 0.9 * m + 0.1 * grad, 0.98 * v + 0.02 * grad * grad
        x = x - RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.98 ** t)) + 1e-9) / math.sqrt(1 + t / 10)
    return {"features": chosen.tolist(), "weights": x[:-1].tolist(), "bias": float(x[-1])}


def score(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)        # at most MAX_FEATURES weights

    def start():
        lexicon = Lexicon(shared.value)
        return lambda ids, held, texts: {
            "doc_id": ids, "held_out": held, "score": [*map(lexicon.score, texts)]}

    scored = map_arrow(docs.select("doc_id", held_out().alias("held_out"), "text"),
                       f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double", start)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def locate(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The offending sentences: doc_id, sentence (its place), first_word, text, score >= ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        lexicon = Lexicon(shared.value)

        def work(ids, texts):
            out = {c: [] for c in ("doc_id", "sentence", "first_word", "text", "score")}
            for doc, text in zip(ids, texts):
                words = words_of(text)
                first, risks = lexicon.sentences(words)
                p = -np.expm1(-risks)
                for k in np.flatnonzero(p >= threshold).tolist():
                    stop = int(first[k + 1]) if k + 1 < len(first) else len(words)
                    for c, x in zip(out, (doc, k, int(first[k]), " ".join(words[first[k]:stop]), float(p[k]))):
                        out[c].append(x)
            return out
        return work

    return map_arrow(docs.select("doc_id", "text"), "doc_id long, sentence long, first_word long, text string, score double", start)


def detect(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None) -> DataFrame:
    """Fit on ``train_docs`` (else ``docs``) and score every row of ``docs``."""
    return score(docs, fit(docs if train_docs is None else train_docs, labels))
