"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams (operator 10).

Features are the distinct hashed single words, word pairs and pairs with one word between them. FTRL-proximal keeps two
numbers per coordinate, so that every coordinate has its own rate, and its L1 term leaves most weights at zero: what is
broadcast are the others. Shards of a bounded sample are learned in parallel and their weights averaged.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline.llm.common import add_columns, held_out, keep_rows

BITS = 20
#: Bounds, documented in the README: labelled documents to learn from, and those of one shard.
TRAIN_DOCS, SHARD_DOCS = 20_000, 5_000
#: Toxic documents are few, so each counts for TOXIC_WEIGHT others.
EPOCHS, ALPHA, BETA, L1, L2, TOXIC_WEIGHT = 8, 0.3, 1.0, 30.0, 0.5, 8.0
WORD = re.compile(r"\w+")
_PAIR = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_SKIP = np.array([0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
REMEMBERED = 400_000


class Hasher:
    """Distinct feature numbers of a text, below 2**BITS."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def all_features(self, text: str | None) -> np.ndarray:
        words = WORD.findall(text.lower()) if text else []
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        mixed = [h * _PAIR[0]]
        mixed.append(h[:-1] * _PAIR[0] + h[1:] * _PAIR[1])
        mixed.append(h[:-2] * _SKIP[0] + h[2:] * _SKIP[1])
        return (np.concatenate(mixed) >> np.uint64(64 - BITS)).astype(np.int32)

    def features(self, text: str | None) -> np.ndarray:
        return np.unique(self.all_features(text))


def ftrl(rows: list[np.ndarray], labels: list[int], epochs: int = EPOCHS, l1: float = L1, weight: float = TOXIC_WEIGHT) -> tuple[np.ndarray, float]:
    """Dense weights and bias after ``epochs`` passes in the given order. Every feature has the value 1."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at):
        over = np.abs(z[at]) - l1
        return np.where(over > 0, -np.sign(z[at]) * over / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    for _ in range(epochs):
        for at, y in zip(rows, labels):
            at = np.append(at, size)
            w = weights(at)
            g = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, w.sum())))) - y
            g *= weight if y else 1.0
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(size + 1))
    return w[:size], float(w[size])


class Model:
    """Non-zero weights by feature number, and the bias."""

    def __init__(self, at: np.ndarray, weights: np.ndarray, bias: float):
        self.at, self.weights, self.bias = at, weights, bias


class Scorer:
    def __init__(self, model: Model):
        self.hasher, self.bias = Hasher(), model.bias
        self.weights = np.zeros(1 << BITS, np.float32)
        self.weights[model.at] = model.weights

    def __call__(self, text: str | None) -> float:
        at = self.hasher.all_features(text)
        w = self.weights[at]
        on = np.unique(at[w != 0])
        return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, self.bias + float(self.weights[on].sum())))))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", most: int = TRAIN_DOCS) -> Model:
    """Learn from the texts of labelled ids: ``most`` ids at most, those of the smallest digests.

    Null ids and null labels teach nothing; of several labels of an id the largest counts; an id that several rows carry
    teaches with one of them, that of the smallest digest of its text, so that no more than ``most`` rows are learned and
    no id outweighs the others. Without a label, or without a positive one, every score is the share of positives seen.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg((F.max(label) > 0).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    hashed = add_columns(rows, "text", [T.StructField("at", T.ArrayType(T.IntegerType()))], lambda: _feature_lists, keep_text=False)
    shards = max(1, math.ceil(chosen.count() / SHARD_DOCS))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(order=[xxhash.xxh64_intdigest(str(i)) for i in pdf["doc_id"]]).sort_values(["order", "doc_id", "y"], kind="stable")
        w, bias = ftrl([np.asarray(x, np.int64) for x in pdf["at"]], pdf["y"].tolist())
        on = np.flatnonzero(w)
        return pd.DataFrame({"at": np.append(on, -1), "w": np.append(w[on], bias), "n": len(pdf), "ones": int(pdf["y"].sum())})

    shard = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("shard")), F.lit(shards))
    learned = hashed.groupBy(shard.alias("shard")).applyInPandas(learn, "at long, w double, n long, ones long").toPandas()
    if learned.empty:
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0 - 35.0)
    heads = learned[learned["at"] < 0]
    total, ones = int(heads["n"].sum()), int(heads["ones"].sum())
    if ones in (0, total):
        return Model(np.zeros(0, np.int64), np.zeros(0), 35.0 if ones else -35.0)
    mean = (learned["w"] * learned["n"]).groupby(learned["at"]).sum() / total
    return Model(mean.index[mean.index >= 0].to_numpy(), mean[mean.index >= 0].to_numpy(), float(mean[-1]))


def _feature_lists(texts):
    hasher = Hasher()
    return [[hasher.features(t) for t in texts]]


FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """All columns, ``score`` and ``predicted`` (1 from 0.5 on) of each whole text; null texts score as empty ones."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(held.value)

        def work(texts):
            scores = list(map(scorer, texts))
            return scores, [int(s >= 0.5) for s in scores]

        return work

    return add_columns(docs, text, FIELDS, make, keep_text)


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.5, text: str = "text") -> DataFrame:
    """The documents, unchanged, that score below ``limit``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(held.value)
        return lambda texts: [scorer(t) < limit for t in texts]

    return keep_rows(docs, text, make)


def training_labels(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return labels.where(~held_out(doc_id, 5, 0))
