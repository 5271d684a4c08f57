"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1, a function of its code point. A trigram is bound from the
permuted vectors of its letters, a text is the bundle (sum) of its trigrams, a language the bundle of
its training texts. A text gets the language whose prototype has the largest cosine with it.

Prototypes are gathered in partial sums per partition, added up by Spark; their size is languages x
dimensions, whatever the corpus.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is every text when
nothing can be learned from; rows without a language teach nothing; ties go to the smaller name;
repeated rows and extra columns pass through, new columns replace columns of the same name; a text of
any length is read whole, and is the only one handled at its time; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, chunks, named

DIMENSIONS = 1024
UNKNOWN = "und"
SEED = 20_111
LEAST = 1024  # a text counts as this many characters at least: 512 short ones are handled at once, in 16 MB of counts
_TABLES: dict[str, np.ndarray] = {}
_LETTERS: dict[int, np.ndarray] = {}


def _letter_mask() -> np.ndarray:
    """Which code points are letters."""
    if "mask" not in _TABLES:
        _TABLES["mask"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _TABLES["mask"]


def letter_vector(code: int) -> np.ndarray:
    if code not in _LETTERS:
        _LETTERS[code] = np.random.default_rng((SEED, code)).integers(0, 2, DIMENSIONS, dtype=np.int8) * np.int8(2) - np.int8(1)
    return _LETTERS[code]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes of all texts and the index of the text of each; words are set off by one blank."""
    parts, sizes = [], []
    for t in texts:
        codes = np.frombuffer((f" {t.lower()} " if t else "  ").encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(_letter_mask()[codes], codes, 32)
        codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])].astype(np.uint64)
        grams = codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:] if len(codes) > 2 else np.empty(0, np.uint64)
        parts.append(grams)
        sizes.append(len(grams))
    return np.concatenate(parts) if parts else np.empty(0, np.uint64), np.repeat(np.arange(len(texts)), sizes)


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """One bound vector per trigram: letters permuted by their place and multiplied."""
    low = np.uint64((1 << 21) - 1)
    out = np.ones((len(grams), DIMENSIONS), np.int8)
    for place in (0, 1, 2):
        codes, inverse = np.unique(grams >> np.uint64(21 * place) & low, return_inverse=True)
        rows = np.stack([np.roll(letter_vector(int(c)), place) for c in codes]) if len(codes) else np.empty((0, DIMENSIONS), np.int8)
        out *= rows[inverse]
    return out


def bundles(grams: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """The sum of the trigram vectors of each owner."""
    codes, inverse = np.unique(grams, return_inverse=True)
    total = np.zeros((owners, DIMENSIONS), np.float32)
    step = 4096  # trigram vectors held at once
    for lo in range(0, len(codes), step):
        vectors = gram_vectors(codes[lo : lo + step]).astype(np.float32)
        at = (inverse >= lo) & (inverse < lo + step) if len(codes) > step else slice(None)
        width = len(vectors)
        counts = np.bincount(owner[at] * width + (inverse[at] - lo), minlength=owners * width).reshape(owners, width)
        total += counts.astype(np.float32) @ vectors
    return total


def language_fit(df: DataFrame, text: str = "text", lang: str = "lang", train_on: Column | None = None) -> tuple[list[str], np.ndarray]:
    """Language names in order and their prototypes, from the rows that ``train_on`` allows."""
    rows = df if train_on is None else df.filter(train_on)
    rows = rows.select(named(text).alias("text"), named(lang).alias("lang")).filter("text is not null and lang is not null")

    def partial(frames):
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            texts, langs = frame["text"].tolist(), frame["lang"].tolist()
            for lo, hi in chunks([max(len(t), LEAST) for t in texts], 1 << 19):
                names = sorted(set(langs[lo:hi]))
                grams, owner = trigrams(texts[lo:hi])
                index = np.array([names.index(x) for x in langs[lo:hi]])
                for name, vector in zip(names, bundles(grams, index[owner], len(names)).astype(np.float64)):
                    sums[name] = sums[name] + vector if name in sums else vector
        for name, vector in sums.items():
            yield pd.DataFrame({"lang": [name], "vector": [vector.astype(np.int64)]})

    added = (rows.mapInPandas(partial, "lang string, vector array<long>")
             .selectExpr("lang", "posexplode(vector) as (d, v)").groupBy("lang", "d").agg(F.sum("v").alias("v")))
    got = added.toPandas()  # languages x dimensions
    names = sorted(got["lang"].unique())
    prototypes = np.zeros((len(names), DIMENSIONS))
    if names:
        prototypes[got["lang"].map({n: i for i, n in enumerate(names)}), got["d"]] = got["v"]
    return names, prototypes


FIELDS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())])


def language_predict(df: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``lang_score``, the cosine (0 to 1) with the chosen prototype."""
    names, prototypes = model
    keep = np.linalg.norm(prototypes, axis=1) > 0 if len(names) else np.empty(0, bool)
    names = [n for n, k in zip(names, keep) if k]
    unit = prototypes[keep] / np.linalg.norm(prototypes[keep], axis=1, keepdims=True) if names else prototypes
    shared = df.sparkSession.sparkContext.broadcast((names, unit.astype(np.float32)))

    def predict(texts):
        names, unit = shared.value
        label, score = [], []
        for lo, hi in chunks([max(len(t or ""), LEAST) for t in texts], 1 << 19):
            grams, owner = trigrams(texts[lo:hi])
            total = bundles(grams, owner, hi - lo)
            size = np.linalg.norm(total, axis=1)
            if not names:
                label += [UNKNOWN] * (hi - lo)
                score += [0.0] * (hi - lo)
                continue
            cosine = total @ unit.T / np.maximum(size, 1e-9)[:, None]
            best = cosine.argmax(axis=1)
            known = np.bincount(owner, minlength=hi - lo) > 0
            label += [names[b] if k else UNKNOWN for b, k in zip(best, known)]
            score += [min(1.0, max(0.0, float(c[b]))) if k else 0.0 for c, b, k in zip(cosine, best, known)]
        return [pa.array(label, pa.string()), pa.array(score, pa.float64())]

    return add_columns(df, text, FIELDS, predict)
