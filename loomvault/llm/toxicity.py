"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

A text gives the set of its hashed features: words, the first letters of words (a backed-off word, so
that an unseen inflection still counts), neighbouring pairs and pairs with one word between. Training
is online: each coordinate has its own rate and an L1 threshold that keeps most weights at zero, so
that the model is a short list of (index, weight), broadcast for scoring.

Fitted on a bounded sample of labelled rows (``most`` rows per label, those whose hashed id is
smallest). Features are made where the texts are read, so the training task gets one array of at most
2^BITS numbers for each sampled id and no text; every text is scored, as a whole.

Defined cases: null and empty texts get the score of the bias alone; without any labelled row, or
with one label only, the score of every text is the share of label 1 (0 if there are no labels);
repeated rows and extra columns pass through, new columns replace columns of the same name; of a
labelled id with several texts one is learned from, that of the least feature array; an empty table
gives an empty table.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, named

BITS = 20
STEMS = (4, 5, 6, 7)
THRESHOLD = 0.7
WORD = re.compile(r"\w+")
WORDS_KEPT = 400_000
_WORDS: dict[str, tuple[int, list[int]]] = {}
_MASK = np.uint64((1 << BITS) - 1)
# Odd multipliers that tell the kinds of pairs apart.
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def _word(word: str) -> tuple[int, list[int]]:
    code = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    stems = [zlib.crc32(f"^{word[:k]}".encode("utf-8", "surrogatepass")) % (1 << BITS) for k in STEMS if len(word) > k]
    return code, [(code * 2654435761 >> 7) % (1 << BITS), *stems]


def features(text: str | None) -> np.ndarray:
    """Distinct feature indexes of a text; index 0 is the bias."""
    words = WORD.findall(text.lower()) if text else []
    if len(_WORDS) > WORDS_KEPT:
        _WORDS.clear()
    codes = np.empty(len(words), np.uint64)
    single: set[int] = {0}
    for k, word in enumerate(words):
        if (known := _WORDS.get(word)) is None:
            known = _WORDS[word] = _word(word)
        codes[k] = known[0]
        single.update(known[1])
    found = [np.fromiter(single, np.uint64, len(single))]
    for gap, a, b in ((1, _MIX[0], _MIX[1]), (2, _MIX[2], _MIX[3])):
        if len(words) > gap:
            mixed = codes[:-gap] * a ^ codes[gap:] * b
            found.append((mixed ^ (mixed >> np.uint64(29))) * _MIX[0] >> np.uint64(64 - BITS))
    return np.unique(np.concatenate(found)).astype(np.int64)


class Ftrl:
    """Follow the regularised leader: per-coordinate rates, L1 and L2."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 12.0, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, label: int, weight: float = 1.0) -> None:
        w = self.weights(at)
        g = (sigmoid(w.sum()) - label) * weight
        root = np.sqrt(self.n[at])
        self.n[at] += g * g
        self.z[at] += g - (np.sqrt(self.n[at]) - root) / self.alpha * w


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def train(rows: list[tuple[np.ndarray, int]], epochs: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and weights other than zero, from (features, label) rows taken in order.

    A row of label 1 weighs the root of how many times rarer its label is, and the other way round.
    """
    model = Ftrl()
    toxic = sum(label for _, label in rows)
    if not 0 < toxic < len(rows):
        return np.array([0]), np.array([35.0 if toxic else -35.0])
    rarer = float(np.sqrt((len(rows) - toxic) / toxic))
    weight = (max(1.0, 1 / rarer), max(1.0, rarer))
    for _ in range(epochs):
        for at, label in rows:
            model.learn(at, label, weight[label])
    every = model.weights(slice(None))
    at = np.flatnonzero(every)
    return at, every[at]


def toxicity_fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                 train_on: Column | None = None, most: int = 6000) -> tuple[np.ndarray, np.ndarray]:
    """Weights from labelled rows of ``docs``: at most ``most`` of label 0 and ``most`` of label 1.

    ``train_on`` is a condition on the labels table that says which rows may be learned from. A
    document labelled twice counts once, by its highest label.
    """
    given = labels.select(named(key).alias("id"), named(label).cast("int").alias("label"))
    if train_on is not None:
        given = labels.filter(train_on).select(named(key).alias("id"), named(label).cast("int").alias("label"))
    given = given.filter("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    given = given.withColumn("place", F.xxhash64("id"))
    sample = None
    for value in (0, 1):
        part = given.filter(F.col("label") == value).orderBy("place", "id").limit(most)
        sample = part if sample is None else sample.unionAll(part)
    # 2 x most ids and labels at the most: a fixed bound, whatever the table
    rows = docs.select(named(key).alias("id"), named(text).cast("string").alias("text")).join(F.broadcast(sample), "id")
    rows = rows.select(F.col("id").cast("string").alias("id"), "place", "label", "text")

    def featured(frames):
        for f in frames:
            at = [features(t).astype(np.int32) for t in f["text"].fillna("")]
            yield f[["id", "place", "label"]].assign(features=at)

    # texts stay where they are read; of the rows of a repeated id the one of the least features is learned from
    rows = rows.mapInPandas(featured, "id string, place long, label int, features array<int>")
    rows = rows.groupBy("id", "place", "label").agg(F.min("features").alias("features"))

    def fit(frames):
        got = sorted(((int(p), i, at, int(y)) for f in frames for p, i, at, y in zip(f["place"], f["id"], f["features"], f["label"])), key=lambda r: r[:2])
        at, w = train([(np.asarray(at, np.int64), y) for _, _, at, y in got])
        yield pd.DataFrame({"at": at.astype(np.int64), "w": w.astype(np.float64)})

    model = rows.repartition(1).mapInPandas(fit, "at long, w double").toPandas()  # 2^BITS rows at the most
    if model.empty:
        return np.array([0]), np.array([-35.0])
    return model["at"].to_numpy(), model["w"].to_numpy()


FIELDS = T.StructType([T.StructField("toxicity", T.DoubleType()), T.StructField("is_toxic", T.BooleanType())])


def toxicity_score(df: DataFrame, model: tuple[np.ndarray, np.ndarray], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``toxicity`` (0 to 1) and ``is_toxic`` (``toxicity >= threshold``)."""
    at, w = model
    shared = df.sparkSession.sparkContext.broadcast((at.astype(np.int32), w.astype(np.float64)))

    def score(texts):
        dense = np.zeros(1 << BITS)
        dense[shared.value[0]] = shared.value[1]
        scores = np.fromiter((sigmoid(dense[features(t)].sum()) for t in texts), np.float64, len(texts))
        return [pa.array(scores), pa.array(scores >= threshold)]

    return add_columns(df, text, FIELDS, score)
