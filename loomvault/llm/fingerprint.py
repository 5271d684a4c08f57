"""Document fingerprints by locally consistent parsing.

A text is a row of symbols. At each level a run of one symbol becomes one symbol; deterministic coin
tossing shrinks the names to six labels, of which the local maxima begin phrases; each phrase becomes
one symbol of the next level, named by a hash of its symbols. Where a phrase begins depends on a few
symbols around it only, so equal substrings get equal phrases inside, wherever they stand. The
fingerprint holds the ``SIZE`` smallest distinct names of the phrases of levels ``FROM_LEVEL`` and up
and of the whole text; the likeness of two fingerprints estimates the share of names they have in
common. All texts of a chunk are parsed at once.

Defined cases: null counts as empty; an empty text has the empty fingerprint, like itself (1) and
unlike any other (0); equal texts have equal fingerprints; texts of any length are parsed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import add_columns, chunks, named, without

SIZE = 48
FROM_LEVEL = 2
U = np.uint64
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, as in SplitMix."""
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


def join_names(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The name of each group of consecutive names that begins at ``starts``, in order of its members."""
    place = np.arange(len(names), dtype=np.int64)
    sizes = np.diff(np.append(starts, len(names)))
    place -= np.repeat(starts, sizes)
    return mix(np.add.reduceat(mix(names + place.astype(U) * U(0x9E3779B97F4A7C15)), starts) + sizes.astype(U))


def coin_labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below six, different from the left neighbour's: place and value of the first differing bit."""
    labels = names
    for _ in range(4):  # 2^64 names, then 128, 14, 8 and 6 labels
        before = np.empty_like(labels)
        before[1:] = labels[:-1]
        before[:1] = 0
        differ = labels ^ before
        differ[first] = 1
        low = differ & (~differ + differ.dtype.type(1))
        place = np.bitwise_count(low - low.dtype.type(1)).astype(np.uint8)
        bit = ((labels & low) != 0).astype(np.uint8)
        labels = place * np.uint8(2) + bit
    return labels


def next_level(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of one level as the symbols of the next, with the text of each."""
    first = np.empty(len(names), bool)
    first[0] = True
    new = (owner[1:] != owner[:-1]) | (names[1:] != names[:-1])
    first[1:] = new
    if not new.all():  # runs of one symbol become one symbol
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(names)))
        names, owner = names[starts], owner[starts]
        names = np.where(sizes > 1, mix(names + mix(sizes.astype(U))), names)
    first = np.empty(len(names), bool)
    first[0] = True
    first[1:] = owner[1:] != owner[:-1]
    labels = coin_labels(names, first).astype(np.int8)
    left, right = np.empty_like(labels), np.empty_like(labels)
    left[1:], left[0] = labels[:-1], 127
    right[:-1], right[-1] = labels[1:], 127
    last = np.append(first[1:], True)
    peak = (labels > left) & (labels >= right) & ~last
    peak[1:] &= ~first[:-1]  # no phrase of one symbol at the start of a text
    starts = np.flatnonzero(first | peak)
    return join_names(names, starts), owner[starts]


def phrase_names(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of all texts that count for a fingerprint, and the text of each."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    names = codes.astype(U) + U(1)
    kept, owners, level = [], [], 0
    while len(names):
        alone = np.ones(len(names), bool)
        alone[1:] &= owner[1:] != owner[:-1]
        alone[:-1] &= owner[:-1] != owner[1:]
        keep = alone if level < FROM_LEVEL else np.ones(len(names), bool)
        kept.append(names[keep])
        owners.append(owner[keep])
        names, owner = names[~alone], owner[~alone]
        if not len(names):
            break
        names, owner = next_level(names, owner)
        level += 1
    return (np.concatenate(kept), np.concatenate(owners)) if kept else (np.empty(0, U), np.empty(0, np.int64))


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The smallest distinct names of each text, in ascending order."""
    names, owner = phrase_names(texts)
    order = np.lexsort((names, owner))
    names, owner = names[order], owner[order]
    if len(names):
        keep = np.append(True, (names[1:] != names[:-1]) | (owner[1:] != owner[:-1]))
        names, owner = names[keep], owner[keep]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [names[a : min(b, a + SIZE)] for a, b in zip(bounds[:-1], bounds[1:])]


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common names: of the smallest of both, those that both have."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    # a sketch that is not full is the whole set of names
    both = np.union1d(a, b)
    if len(a) == SIZE or len(b) == SIZE:
        both = both[:SIZE]
    return float(np.isin(both, a).astype(int) @ np.isin(both, b).astype(int) / len(both))


FINGERPRINT = T.StructType([T.StructField("fingerprint", T.StringType())])


def fingerprint(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the fingerprint of a text column, as hexadecimal digits."""
    return add_columns(df, text, FINGERPRINT, lambda texts: [
        pa.array([as_text(s) for lo, hi in chunks([len(t or "") for t in texts], 1 << 18)
                  for s in sketches([t or "" for t in texts[lo:hi]])], pa.string())])


def likeness_of(left: Column, right: Column) -> Column:
    """The likeness of two fingerprint columns."""
    @F.pandas_udf("double")
    def of(a, b):
        return a.combine(b, lambda x, y: likeness(np.frombuffer(bytes.fromhex(x or ""), ">u8").astype(U),
                                                  np.frombuffer(bytes.fromhex(y or ""), ">u8").astype(U)))
    return of(left, right)


NEIGHBOURS = T.StructType([
    T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the beginning of the following text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def compare_with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the likeness of its fingerprint to that of its edited text and of the next document's.

    Documents go in ascending order of (key, text), nulls first; the last is followed by the first.
    Texts move once, into key ranges that are read in order; the first document of each range is
    also sent, marked, to the end of the range before. Returns the key and ``NEIGHBOURS``.
    """
    spark = df.sparkSession
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = df.select(named(key).alias("key"), F.coalesce(named(text).cast("string"), F.lit("")).alias("text"))
    bounds = _bounds(rows, ranges)
    place = F.lit(0) if not bounds else F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("key")))
    rows = rows.withColumn("range", F.when(F.col("key").isNull(), F.lit(0)).otherwise(place))
    # the smallest row of each range in use: one key and hash per range
    order = F.struct(F.col("key").isNotNull().alias("known"), "key", F.sha2("text", 256).alias("mark"))
    heads = sorted((r["range"], tuple(r["head"])) for r in rows.groupBy("range").agg(F.min(order).alias("head")).collect())
    if not heads:
        return df.select(named(key)).limit(0).select(named(key), *(F.lit(None).cast(f.dataType).alias(f.name) for f in NEIGHBOURS))
    before = {heads[i][0]: heads[i - 1][0] for i in range(len(heads))}
    head_of = F.create_map(*(F.lit(x) for r, h in heads for x in (r, f"{h[1]}|{h[2]}")))
    send_to = F.create_map(*(F.lit(x) for x in sum(before.items(), ())))
    is_head = F.concat(F.coalesce(F.col("key").cast("string"), F.lit("None")), F.lit("|"), F.sha2("text", 256)) == head_of[F.col("range")]
    whole = rows.withColumn("ghost", F.lit(False))
    ghosts = rows.filter(is_head).withColumn("range", send_to[F.col("range")]).withColumn("ghost", F.lit(True)).dropDuplicates(["range"])
    dealt = (whole.unionByName(ghosts).repartitionById(ranges, "range")
             .sortWithinPartitions("range", "ghost", F.col("key").asc_nulls_first(), F.sha2("text", 256)))
    out = T.StructType([T.StructField("key", rows.schema["key"].dataType), *NEIGHBOURS])
    schema = to_arrow_schema(out)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the last row of the chunk before: (key, text, sketch, range)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            keys, where, ghost = (batch.column(c).to_pylist() for c in ("key", "range", "ghost"))
            for lo, hi in chunks([len(t) for t in texts], 1 << 18):
                own = list(zip(keys[lo:hi], texts[lo:hi], sketches(texts[lo:hi]), where[lo:hi], ghost[lo:hi]))
                line = ([waiting] if waiting else []) + own
                pairs = [(a, b) for a, b in zip(line, line[1:]) if not a[4] and a[3] == b[3]]
                waiting = line[-1]
                changed = [edited(a[1], b[1]) for a, b in pairs]
                marks = sketches(changed)
                yield pa.RecordBatch.from_pydict({
                    "key": [a[0] for a, _ in pairs], "n_chars": [len(a[1]) for a, _ in pairs],
                    "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
                    "fingerprint": [as_text(a[2]) for a, _ in pairs], "edited_fingerprint": [as_text(m) for m in marks],
                    "near_edited": [likeness(a[2], m) for (a, _), m in zip(pairs, marks)],
                    "near_next": [likeness(a[2], b[2]) for a, b in pairs]}, schema=schema)

    return dealt.mapInArrow(compare, out).withColumnRenamed("key", key)


def _bounds(rows: DataFrame, ranges: int) -> list:
    """Keys that cut the rows in ranges of about equal size; never more than ``ranges`` of them."""
    kind = rows.schema["key"].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError("the key must be an integer")
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.select(F.col("key").cast("double")).na.drop().approxQuantile("key", shares, 0.2 / ranges) if shares else []
    return sorted({int(x) for x in found})
