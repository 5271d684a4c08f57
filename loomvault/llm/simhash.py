"""Near-duplicates by SimHash fingerprints and Golay-code fuzzy hashing.

A 64-bit fingerprint is cut in segments of 23, 23 and 18 bits. The perfect Golay code of 23 bits has
one codeword within 3 bits of any word; the codewords within 4 bits, one or six of them, are the
word's indexes. Two words that differ in two bits or fewer share an index: the word between them is
within 3 bits of some codeword, so both are within 4 bits of it. If two fingerprints differ in four
bits or fewer, then one segment is equal and another differs in at most two bits, or no segment is
equal and each differs in at most two. So the keys are: one segment as it stands with an index of
another (35 bits), and one index of each segment (36 bits). Equal keys make candidates; the number of
differing bits is then counted.

Only distinct fingerprints are keyed. Keys are dealt by hash and sorted, and a key's fingerprints are
compared in blocks as they stream by. What is emitted for a key is not its pairs but the links of a
spanning forest of them, fewer than it has fingerprints. A key with more than ``BLOCK`` fingerprints
is cut in blocks first, and each pair of blocks is compared by a task of its own.

Defined cases: null texts count as empty; texts without a word have fingerprint zero and are linked
like any other; repeated rows are copies; texts of any length are read whole; an empty table gives an
empty table; a null key is the largest.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .common import add_columns, named, without
from .components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
# Bits of the segments, from the lowest.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
# Fingerprints of one key compared at once.
BLOCK = 2048
# One fingerprint in so many is used to estimate which keys are long.
SHARE = 16
# x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, the generator of the code (fixed value).
GENERATOR = 0b101011100011
# White space between words, A-Z to small letters (bytes of UTF-8).
_LOWER = bytes(32 if b == 32 or 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BITS = np.arange(64, dtype=np.uint64)


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text: the majority of each bit over its shingles' hashes."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split(b" ") if text else []
    words = [w for w in words if w]
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())], np.uint64)
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo : lo + (1 << 16)]
        counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(((2 * counts > len(hashes)).astype(np.uint64) << _BITS).sum())


FINGERPRINT = T.StructType([T.StructField("simhash", T.LongType())])


def add_simhash(df: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``df`` with ``simhash``, the fingerprint as a signed 64-bit number."""
    return add_columns(df, text, FINGERPRINT, lambda texts: [
        pa.array(np.array([simhash(t, shingle) for t in texts], np.uint64).view(np.int64))])


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator: which coset of the code it is in."""
    rest = words.astype(np.uint32).copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> np.uint32(bit) & np.uint32(1), np.uint32(GENERATOR << (bit - 11)), np.uint32(0))
    return rest


def coset_patterns() -> tuple[np.ndarray, np.ndarray]:
    """Per coset the error patterns of 4 bits or fewer that lead to a codeword, and their number."""
    patterns = np.array([sum(1 << b for b in bits) for k in range(5) for bits in combinations(range(23), k)], np.uint32)
    table, count = np.zeros((1 << 11, 6), np.uint32), np.zeros(1 << 11, np.int64)
    for pattern, coset in zip(patterns.tolist(), syndromes(patterns).tolist()):
        table[coset, count[coset]] = pattern
        count[coset] += 1
    return table, count


_TABLES: list[np.ndarray] = []


def indexes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codeword indexes (12 bits) of each word in six columns, and which of the columns count."""
    if not _TABLES:
        _TABLES.extend(coset_patterns())
    coset = syndromes(words)
    table, count = _TABLES
    near = (words.astype(np.uint32)[:, None] ^ table[coset]) >> np.uint32(11)
    return near.astype(np.int64), np.arange(6) < count[coset][:, None]


def golay_keys(prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, row) arrays that together hold every key of every fingerprint."""
    prints = prints.view(np.uint64)
    parts = [((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    fuzzy = [indexes(p) for p in parts]
    rows = np.arange(len(prints))
    for kind, (exact, loose) in enumerate(permutations(range(3), 2)):
        near, ok = fuzzy[loose]
        key = (np.int64(kind) << 40) | (parts[exact][:, None] << 12) | near
        yield key[ok], np.repeat(rows, ok.sum(axis=1))
    (a, oka), (b, okb), (c, okc) = fuzzy
    key = (a[:, :, None, None] << 24) | (b[:, None, :, None] << 12) | c[:, None, None, :] | (np.int64(6) << 40)
    ok = oka[:, :, None, None] & okb[:, None, :, None] & okc[:, None, None, :]
    yield key[ok], np.repeat(rows, ok.reshape(len(rows), -1).sum(axis=1))


KEYED = T.StructType([T.StructField("key", T.LongType()), T.StructField("print", T.LongType())])
LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def forest(nodes: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the distinct fingerprints that are near each other."""
    out, rest = [], nodes
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            node = reached.pop()
            near = np.bitwise_count(rest ^ node) <= distance
            if near.any():
                found, rest = rest[near], rest[~near]
                reached.extend(found)
                out += [(int(node.view(np.int64)), int(x)) for x in found.view(np.int64)]
    return out


def _runs(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal (key, left, right) of sorted rows: a key, or two blocks of one."""
    held: list[tuple[np.ndarray, ...]] = []

    def links(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        key, left, right, prints = columns
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])) + 1
        starts, ends = np.append(0, cuts), np.append(cuts, len(key))
        prints = prints.view(np.uint64)
        a, b = [], []
        pair = ends - starts == 2
        x, y = prints[starts[pair]], prints[starts[pair] + 1]
        near = (np.bitwise_count(x ^ y) <= distance) & (x != y)
        a.append(x[near].view(np.int64))
        b.append(y[near].view(np.int64))
        for s, e in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
            found = forest(prints[s:e], distance)
            if found:
                a.append(np.array([f[0] for f in found], np.int64))
                b.append(np.array([f[1] for f in found], np.int64))
        got = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1) if a else np.empty((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(got[0]), pa.array(got[1])], ["a", "b"])

    for batch in batches:
        columns = tuple(np.concatenate([*(h[k] for h in held), batch.column(k).to_numpy(zero_copy_only=False)]) for k in range(4))
        if not len(columns[0]):
            continue
        same = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1]) & (columns[2] == columns[2][-1])
        cut = int(np.argmax(same))  # the last run may go on in the next batch
        if cut:
            yield links(tuple(c[:cut] for c in columns))
        held = [tuple(c[cut:] for c in columns)]
    if held and len(held[0][0]):
        yield links(held[0])


def near_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) that connect all fingerprints at ``distance`` bits or fewer, from a table of distinct ``print``."""
    if distance > DISTANCE:
        raise ValueError(f"the keys find differences of at most {DISTANCE} bits")
    spark = prints.sparkSession
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def keyed(batches):
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, len(every), 4096):
                part = every[lo : lo + 4096]
                for key, row in golay_keys(part):
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], ["key", "print"])

    # each fingerprint gives many keys: dealt anew, as the few bytes of the fingerprints would else come in a handful of tasks
    # (by another hash than the one they may lie by already, which the planner would take for done)
    prints = prints.select("print").repartition(width, F.xxhash64("print"))
    keys = prints.mapInArrow(keyed, KEYED)
    # Keys of many fingerprints, estimated from those of one in SHARE: this decides only how the work
    # is dealt; each key is compared in full either way.
    some = prints.filter(F.pmod(F.xxhash64("print"), F.lit(SHARE)) == 0).select("print").mapInArrow(keyed, KEYED)
    many = cut_lineage(some.groupBy("key").count().select("key", F.ceil(F.col("count") * SHARE / BLOCK).cast("int").alias("blocks"))
                       .filter("blocks > 1"))
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("print", F.lit(1)), blocks).cast("int")
    # a fingerprint in block x of n meets the blocks 0 to n - 1, once each
    marked = keys.join(many, "key", "left") if not many.isEmpty() else keys.withColumn("blocks", F.lit(1))
    marked = marked.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = marked.select("key", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "print")
    return (dealt.repartition(width, "key", "left", "right").sortWithinPartitions("key", "left", "right")
            .mapInArrow(lambda batches: _runs(batches, distance), LINKS).distinct())


def _grouped(df: DataFrame, key: str, text: str, distance: int, shingle: int) -> DataFrame:
    """``key``, the ``mark`` of the text, ``simhash`` and ``component`` of each row."""
    given = df.select(named(key).alias("key"), F.xxhash64(named(text).cast("string")).alias("mark"), named(text).alias("text"))
    docs = cut_lineage(add_simhash(given, "text", shingle).select("key", "mark", "simhash"))
    least = docs.groupBy("simhash").agg(F.min("key").alias("least"))
    groups = components(near_links(least.select(F.col("simhash").alias("print")), distance))
    rooted = least.join(groups, least["simhash"] == groups["node"], "left").select(
        "simhash", "least", F.coalesce("root", "simhash").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    classes = rooted.join(smallest, "root").select("simhash", "component")
    return docs.join(classes, "simhash").select("key", "mark", "simhash", "component")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """``key``, ``simhash`` and ``component``: the smallest key that near links lead to, itself included."""
    return _grouped(df, key, text, distance, shingle).select(F.col("key").alias(key), "simhash", "component")


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` but for those with a near-duplicate of a smaller key; of rows of equal key and text one stays.

    Rows without a key stay as they are.
    """
    known = df.filter(named(key).isNotNull()).withColumn("__mark", F.xxhash64(named(text).cast("string")))
    kept = _grouped(known, key, text, DISTANCE, SHINGLE).filter("key = component").select(F.col("key").alias("__k"), F.col("mark").alias("__m")).distinct()
    return (known.join(kept, (named(key) == F.col("__k")) & (F.col("__mark") == F.col("__m")), "left_semi").dropDuplicates([key, "__mark"])
            .select(*map(named, df.columns)).unionByName(df.filter(named(key).isNull())))
