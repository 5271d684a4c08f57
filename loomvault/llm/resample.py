"""Importance resampling towards a target: array-scored weights, then a distributed quickselect of the best.

Features are runs of ``least`` to ``most`` consecutive words, hashed into ``buckets`` (CRC-32 of their bytes). A bucket's gain is the
floored thousandfold log ratio of its smoothed share in the target to that in the source; a document's weight is the floored mean gain of
its features. Gumbel noise, a function of ``seed`` and the key alone, turns "the highest scores" into a draw without replacement.

1. Counts of the buckets: one array a task, summed by bucket. ``buckets`` rows come to the driver, however large the corpus.
2. Weights: the gains are one array of ``buckets`` numbers; every document adds up the entries of its features, in Arrow batches.
3. The place of the last document drawn, without a sort: pivots are a few random keys of the rows still in question. Rows are
   counted below, at and above each pivot, exactly and partition by partition, and only the stretch between two pivots that holds the
   k-th key goes on. With 31 pivots a round leaves about a thirtieth.
4. The documents drawn, and they alone, are sorted by ranges and ranked by the totals of the ranges before.

The composite key (score falling, key rising, number of the row) tells all rows apart, so that any number of ties, also of one
repeated row, is cut exactly and spread over ranges.

Defined cases: null and empty texts have no words, weight 0 and are not drawn where ``min_words`` is above 0; a null key counts as the
empty text in the noise and comes first among ties; repeated rows are rows of their own with equal scores; texts of any length are whole
and read in slices; an empty table, an empty target or one of no words work by the same formulas; columns with the name of a new one
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_place, map_in_arrow, named, stored, without
from .ranges import AT, PART, in_order, totals

# Bytes that stay in words, capitals lowered; all others are blanks.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
SLICE = 1 << 20  # bytes of a text handled at once, and words remembered by a task: bound memory only
PIVOTS = 31
ADDED = ("n_words", "n_features", "weight", "score", "rank")


def runs(text: bytes, least: int, most: int) -> Iterator[tuple[int, list[bytes]]]:
    """(number of words, features) of a text, slice by slice; a feature belongs to the slice it ends in."""
    plain, start, carried = text.translate(PLAIN), 0, []
    while start < len(plain):
        end = plain.find(b" ", start + SLICE)
        end = len(plain) if end < 0 else end
        new = plain[start:end].split()
        words = carried + new
        out = new if least == most == 1 else [
            b" ".join(words[i:i + n]) for n in range(least, most + 1) for i in range(max(len(carried) - n + 1, 0), len(words) - n + 1)]
        yield len(new), out
        carried, start = words[len(words) - most + 1:] if most > 1 else [], end


class _Remembered(dict):
    """A number for each feature, computed once; forgets all when full."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= SLICE:
            self.clear()
        number = self[feature] = self.of(feature)
        return number


def _bytes_of(texts: pa.Array) -> Iterator[bytes]:
    for text in texts.cast(pa.large_binary()):
        yield text.as_py() or b""


def bucket_counts(df: DataFrame, text: str, least: int, most: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32
        number = _Remembered(lambda f: crc32(f) % buckets).__getitem__
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            held: list[int] = []
            for body in _bytes_of(batch.column(0)):
                for _, features in runs(body, least, most):
                    held.extend(map(number, features))
                    if len(held) > SLICE:
                        counts += np.bincount(held, minlength=buckets)
                        held = []
            if held:
                counts += np.bincount(held, minlength=buckets)
        seen = np.flatnonzero(counts)
        yield by_place([pa.array(seen), pa.array(counts[seen])], pa.schema([("c0", pa.int64()), ("c1", pa.int64())]))

    schema = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("n", T.LongType())])
    found = map_in_arrow(df.select(named(text).cast("string")), count, schema).groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)  # at most a row a bucket
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    s, t, b = source.astype(float), target.astype(float), float(len(source))
    return np.floor(1000.0 * np.log((t + 1.0) * (s.sum() + b) / ((s + 1.0) * (t.sum() + b)))).astype(np.int64)


def weigh(df: DataFrame, gains: np.ndarray, text: str = "text", least: int = 1, most: int = 1, keep_text: bool = True) -> DataFrame:
    """``df`` with ``n_words``, ``n_features`` and ``weight``."""
    buckets = len(gains)
    source = df.select(*without(df, *ADDED, *([] if keep_text else [text])), named(text).cast("string").alias("__text"))
    fields = [T.StructField(n, T.LongType()) for n in ADDED[:3]]
    out = T.StructType([*source.schema.fields[:-1], *fields])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32
        gain = _Remembered(lambda f: int(gains[crc32(f) % buckets])).__getitem__
        for batch in batches:
            n_words, n_features, weights = [], [], []
            for body in _bytes_of(batch.column(batch.num_columns - 1)):
                words = features = total = 0
                for n, part in runs(body, least, most):
                    words, features, total = words + n, features + len(part), total + sum(map(gain, part))
                n_words.append(words)
                n_features.append(features)
                weights.append(total // features if features else 0)
            new = [pa.array(c, pa.int64()) for c in (n_words, n_features, weights)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], [f"c{k}" for k in range(len(out.fields))])

    return map_in_arrow(source, score, out)


def noise(key: Column, seed: str) -> Column:
    """Thousandfold standard Gumbel noise, floored, from the first 32 bits of a hash of seed and key."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    uniform = (F.conv(head, 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))


def kth_key(rows: DataFrame, parts: list[str], k: int, pivots: int = PIVOTS, seed: int = 0):
    """The k-th smallest (from 1) of the keys ``struct(parts)``, which must all differ, as a column to compare with.

    Null parts come first. Every round reads the rows between two known keys once for its pivots and once for the counts.
    """
    key = F.struct(*parts)
    types = [rows.schema[p].dataType for p in parts]

    def literal(row) -> Column:
        return F.struct(*(F.lit(v).cast(t).alias(p) for v, t, p in zip(row, types, parts)))

    above = below = None
    wanted, round_ = k, seed
    while True:
        active = rows
        if above is not None:
            active = active.filter(key > literal(above))
        if below is not None:
            active = active.filter(key < literal(below))
        some = active.orderBy(F.xxhash64(F.lit(round_), *parts), *parts).select(*parts).limit(pivots).collect()
        if not some:
            raise ValueError("fewer rows than k")
        # ascending, as the engine orders them
        some = [r["p"] for r in rows.sparkSession.range(1).select(F.explode(F.array_sort(F.array(*map(literal, some)))).alias("p")).collect()]
        places = F.array(*map(literal, some))
        slot = F.size(F.filter(places, lambda p: p < key)) * 2 + F.exists(places, lambda p: p == key).cast("int")
        counts = dict(active.groupBy(slot.alias("slot")).agg(F.count("*").alias("n")).collect())  # two a pivot, and one
        for slot_ in range(2 * len(some) + 1):
            n = counts.get(slot_, 0)
            if wanted <= n:
                break
            wanted -= n
        else:
            raise ValueError("fewer rows than k")
        if slot_ % 2:
            return literal(some[slot_ // 2])
        if slot_ > 0:
            above = some[slot_ // 2 - 1]
        if slot_ < 2 * len(some):
            below = some[slot_ // 2]
        round_ += 1


def resample(df: DataFrame, target: DataFrame, percent: int, key: str = "doc_id", text: str = "text", least: int = 1, most: int = 1,
             buckets: int = 10_000, min_words: int = 1, seed: str = "2024", keep_text: bool = True) -> DataFrame:
    """``df`` with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``: 1, 2, 3 ... for the documents drawn, null for others.

    Drawn are ``percent`` of the documents of ``min_words`` words or more (floored), those of the highest scores.
    """
    gains = gains_of(bucket_counts(df, text, least, most, buckets), bucket_counts(target, text, least, most, buckets))
    weighed = weigh(df, gains, text, least, most, keep_text)
    scored = stored(weighed.withColumns({"score": (F.col("weight") + noise(named(key), seed)).cast("long"), "__row": F.monotonically_increasing_id()}), "resample")
    names = [c for c in scored.columns if c != "__row"]
    ranked = scored.select("*", (-F.col("score")).alias("__fall"), named(key).alias("__key"), (F.col("n_words") >= min_words).alias("__fit"))
    drawn = percent * ranked.filter("__fit").count() // 100
    if not drawn:
        return scored.select(*map(named, names), F.lit(None).cast("long").alias("rank"))
    order = ["__fall", "__key", "__row"]
    last = kth_key(ranked.filter("__fit").select(*order), order, drawn)
    won = F.col("__fit") & (F.struct(*order) <= last)
    winners = in_order(ranked.filter(won), [F.col(c).asc_nulls_first() for c in order], "resample-won")
    ahead, before = 0, []
    for part in totals(winners):
        before.append((part[PART], ahead))
        ahead += part["n"]
    shift = F.broadcast(df.sparkSession.createDataFrame(before, f"{PART} int, __ahead long"))  # a row a range
    places = winners.join(shift, PART).select(*map(named, names), (F.col("__ahead") + F.col(AT) + 1).alias("rank"))
    return places.unionByName(ranked.filter(~won).select(*map(named, names), F.lit(None).cast("long").alias("rank")))
