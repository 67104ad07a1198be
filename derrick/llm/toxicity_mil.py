"""Toxicity by multiple-instance learning: which sentence makes a document toxic.

A document is a bag of sentences; a sentence has the probability p = sigmoid(bias +
weights of its distinct words), and the document is toxic unless all its sentences are
harmless: 1 - prod(1 - p) (noisy-or). Only documents are labelled, so the weights are
trained through the noisy-or, and the sentences that carry a verdict can be named
afterwards. Around the noisy-or stands a logistic curve fitted on documents that the
weights have not seen, which turns it into a probability (labels are noisy: even the
worst document is not toxic for certain, nor the best one harmless).

Words are hashed into ``2^BITS`` weights, so the model has one size at any vocabulary.

Scale: the model is fitted on a bounded sample (``TRAIN_DOCS`` labelled documents of
each label with their whole texts, chosen by a hash of the id; tasks turn them into arrays
of word slots, and no text reaches the driver) and travels to the tasks as an array of
2^BITS floats; scoring is one pass without a shuffle, whole texts, one document at a time.

Learning uses only labels of rows whose crc32(doc_id as text) mod 4 is not 2; scores
see the text alone. Edge cases: null and empty texts have no sentence and get the
score of a noisy-or of 0; several labels of one id count as toxic if one says so; ids
that are null have no label and are scored (crc32 of no text: not held out); without
labelled rows of both kinds all scores are the share of toxic labels, 0 if there are
none; empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, fields
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.llm.common import documents
from derrick.sources.scratch import materialize

BITS = 18
TRAIN_DOCS = 6_000
EPOCHS = 60
THRESHOLD = 0.3
_SENTENCE = re.compile(r"[.!?\n\r]+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")


class _Slots(dict):
    """Word -> weight slot, remembered for a while."""

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = slot = crc32(word.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)
        return slot


def sentences(text: str | None) -> list[str]:
    return [s for s in _SENTENCE.split(text or "") if s and not s.isspace()]


def slots(sentence: str, known: dict) -> set[int]:
    return {known[w] for w in _WORD.findall(sentence.lower())}


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def sentence_logits(self, text: str | None, known: dict) -> np.ndarray:
        sums = [sum(self.weights[list(slots(s, known))].tolist()) for s in sentences(text)]
        return np.array(sums, dtype=float) + self.bias

    def score(self, z: np.ndarray) -> float:
        """The document's calibrated probability from its sentences' logits."""
        return float(_sigmoid(self.slope * _bag_logit(z) + self.offset))


def _sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _bag_logit(z: np.ndarray) -> float:
    """Logit of the noisy-or, from log(1 - p) summed over the sentences."""
    none = -float(np.logaddexp(0, z).sum()) if len(z) else 0.0
    return float(np.clip(np.log(-np.expm1(min(none, -1e-9))) - none, -20, 20))


def fit(texts: list[str | None], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """The model of texts at hand."""
    known = _Slots()
    return fit_bags([packed(t, known) for t in texts], labels, epochs)


def packed(text: str | None, known: dict) -> bytes:
    """A document as 32-bit numbers: the sorted word slots of its sentences, each sentence
    closed by -1."""
    out = array("i")
    for s in sentences(text):
        out.extend(sorted(slots(s, known)))
        out.append(-1)
    return out.tobytes()


def fit_bags(bags: list[bytes], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Telling words, and their weights by Adam through the noisy-or, on four fifths of
    the documents, the curve around it on the others."""
    rate = float(np.mean(labels)) if len(labels) else 0.0
    flat = Model(np.zeros(1 << BITS, dtype=np.float32), -12.0, 0.0, float(np.log((rate + 1e-6) / (1 - rate + 1e-6))))
    if len(set(labels.tolist())) < 2:
        return flat
    row = np.frombuffer(b"".join(bags), dtype=np.int32)
    close = row == -1
    bag = np.repeat(np.arange(len(bags), dtype=np.int32), [len(b) // 4 for b in bags])[close]
    sent = np.cumsum(close, dtype=np.int32)[~close]
    word = row[~close]
    if not len(word):
        return flat
    used, word = np.unique(word, return_inverse=True)
    y = labels.astype(float)
    n_docs, held = len(bags), np.arange(len(bags)) % 5 == 4
    weight = np.where(held, 0.0, 1.0)
    telling = _telling(word, bag[sent], y, held, len(used))
    if not telling.any():
        return flat
    keep = telling[word]
    used, word, sent = used[telling], (np.cumsum(telling) - 1)[word[keep]], sent[keep]
    sizes = np.maximum(np.bincount(bag, minlength=n_docs), 1)
    w = np.zeros(len(used))
    b = float(-np.log(np.mean(sizes) * 4))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, epochs + 1):
        z = np.bincount(sent, weights=w[word], minlength=len(bag)) + b
        none = -np.bincount(bag, weights=np.logaddexp(0, z), minlength=n_docs)
        some = -np.expm1(np.minimum(none, -1e-9))
        # d loss / d z_s = p_s (1 - y / P(bag)), averaged over the documents.
        g = _sigmoid(z) * ((1 - y / np.maximum(some, 0.02)) * weight / weight.sum())[bag]
        gw = np.bincount(word, weights=g[sent], minlength=len(w)) + 2e-6 * w
        gb = float(g.sum())
        m, mb = 0.9 * m + 0.1 * gw, 0.9 * mb + 0.1 * gb
        v, vb = 0.99 * v + 0.01 * gw * gw, 0.99 * vb + 0.01 * gb * gb
        fix, fix2 = 1 - 0.9**step, 1 - 0.99**step
        w -= 0.15 * (m / fix) / (np.sqrt(v / fix2) + 1e-6)
        b -= 0.05 * (mb / fix) / (np.sqrt(vb / fix2) + 1e-6)
    z = np.bincount(sent, weights=w[word], minlength=len(bag)) + b
    logit = np.array([_bag_logit(z[a:e]) for a, e in _ranges(bag, n_docs)])
    slope, offset = _curve(logit[held], y[held])
    full = np.zeros(1 << BITS, dtype=np.float32)
    full[used] = w
    return Model(full, b, slope, offset)


def _telling(word: np.ndarray, doc: np.ndarray, y: np.ndarray, held: np.ndarray, n: int) -> np.ndarray:
    """Words whose documents are toxic more often than chance allows: by the Chernoff
    bound, at a level at which one word in all would pass by accident."""
    n_docs = len(y)
    pairs = np.unique(word.astype(np.int64) * n_docs + doc)
    pairs = pairs[~held[pairs % n_docs]]
    seen = np.bincount(pairs // n_docs, minlength=n).astype(float)
    toxic = np.bincount(pairs // n_docs, weights=y[pairs % n_docs], minlength=n)
    rate = y[~held].mean()
    if not 0 < rate < 1:
        return np.zeros(n, dtype=bool)
    p = toxic / np.maximum(seen, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(p > 0, p * np.log(p / rate), 0) + np.where(p < 1, (1 - p) * np.log((1 - p) / (1 - rate)), 0)
    return (p > rate) & (seen * gain > np.log(max((seen >= 2).sum(), 2)))


def _ranges(bag: np.ndarray, n: int) -> list[tuple[int, int]]:
    edges = np.searchsorted(bag, np.arange(n + 1)).tolist()
    return list(zip(edges[:-1], edges[1:]))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not below zero) and offset of a logistic regression, by Newton steps."""
    a, c = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * x + c)
        s = p * (1 - p) + 1e-6
        g = np.array([((p - y) * x).sum() + 1e-3 * a, (p - y).sum()])
        h = np.array([[(s * x * x).sum() + 1e-3, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, c = max(a - step[0], 0.0), c - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(c)


def held_out(doc_id: Column, mod: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == 2, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """(text, toxic, h, doc_id) of at most ``per_label`` documents of each label, by a hash of
    the id; the ids are chosen before any text is read."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id"), 4))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    known = materialize(known.withColumn("h", F.xxhash64("doc_id")), "labelled")
    ids = [known.filter(cond).orderBy("h", "doc_id").limit(per_label) for cond in ("toxic = 1", "toxic <> 1")]
    chosen = materialize(ids[0].unionByName(ids[1]), "chosen")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "toxic", "h").agg(F.min("text").alias("text"))


def training_bags(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCS) -> tuple[list[bytes], np.ndarray]:
    """The sample's documents as word slots, made in the tasks, and their labels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Slots()
        for rows in batches:
            rows["bag"] = [packed(t, known) for t in rows.pop("text")]
            yield rows

    bags = _sample(docs, labels, per_label).select("doc_id", "toxic", "h", "text")
    bags = materialize(bags.mapInPandas(run, "doc_id long, toxic int, h long, bag binary"), "bags")
    rows = bags.orderBy("h", "doc_id").select("bag", "toxic").toArrow()
    return rows["bag"].to_pylist(), np.array([int(t == 1) for t in rows["toxic"].to_pylist()])


def training_sample(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCS) -> tuple[list, np.ndarray]:
    """Texts and labels of the sample."""
    rows = _sample(docs, labels, per_label).orderBy("h", "doc_id").toArrow()
    return rows["text"].to_pylist(), np.array([int(t == 1) for t in rows["toxic"].to_pylist()])


def shares(labels: DataFrame) -> tuple[int, int]:
    """Toxic and other labels among all rows that may be learned from."""
    known = labels.filter("toxic IS NOT NULL").filter(~held_out(F.col("doc_id"), 4))
    r = known.agg(F.count(F.when(F.col("toxic") == 1, 1)).alias("t"), F.count(F.lit(1)).alias("n")).first()
    return r["t"], r["n"] - r["t"]


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``score`` and the worst sentence: its number, its probability."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(getattr(model, f.name) for f in fields(model)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, m = _Slots(), Model(*shared.value)
        for rows in batches:
            z = [m.sentence_logits(t, known) for t in rows.pop("text")]
            rows["score"] = [m.score(x) for x in z]
            rows["worst"] = [int(x.argmax()) if len(x) else None for x in z]
            rows["worst"] = rows["worst"].astype("Int32")
            rows["worst_score"] = [float(_sigmoid(x.max())) if len(x) else 0.0 for x in z]
            yield rows

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, score double, worst int, worst_score double")


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    """The model, its curve moved from the sample's shares of labels to those of all."""
    bags, y = training_bags(docs, labels)
    model = fit_bags(bags, y)
    toxic, other = shares(labels)
    if 0 < y.sum() < len(y) and toxic and other:
        moved = np.log(toxic / other) - np.log(y.sum() / (len(y) - y.sum()))
        model = Model(model.weights, model.bias, model.slope, model.offset + float(moved))
    return model


def op9_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = score(docs, trained(docs, documents(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", held_out(F.col("doc_id"), 4).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("worst").alias("worst_sentence"), "worst_score",
    )
