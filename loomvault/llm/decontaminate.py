"""Benchmark decontamination with suffix arrays of the training texts.

Words of the texts get the numbers they have in the benchmark's vocabulary (0: none). Each shard of
training texts, a chunk of an Arrow batch, gets a suffix array over its words, of the suffixes that
can match at all: those whose first words, as many as the shortest window has, are benchmark words.
Every distinct window of the test texts is searched in it by binary search, over all shards; what
lies between the two ends of a search are the places of a verbatim match. Occurrences that overlap in
a text join to spans of hit words; the longest verbatim match is taken within one item, word by word.

A window is ``WINDOW`` consecutive words of an item, or the whole item if that is shorter. A document
word inside an occurrence of a window is hit.

The benchmark is the side that is sent out: in blocks of at most ``BLOCK_WORDS`` words, each a
broadcast of bounded size, read one after the other by every task. Texts do not move.

Defined cases: null and empty texts have no words and are not contaminated; items of null or
wordless text match nothing; an item without id hits as any other and is a null among the items; items that share a window all count; repeated item rows count once; texts of any
length are handled whole; an empty benchmark leaves every document clean; columns that have the name
of a new column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_columns, chunks, named

WINDOW = 13
BLOCK_WORDS = 2_000_000
SHARD_CHARS = 2 << 20
# Bytes of words after lower-casing A-Z: digits, small letters and all bytes of other characters.
_TO_WORDS = bytes(
    b if b in b"0123456789abcdefghijklmnopqrstuvwxyz" or b >= 128 else b + 32 if b in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split() if text else []


def pack(ids: np.ndarray, at: np.ndarray, k: int, words: int, bits: int) -> np.ndarray:
    """``words`` words of each suffix from its k-th on as one number, ``bits`` bits for each."""
    top = len(ids) - 1  # the last entry is a 0 that ends every suffix
    out = np.zeros(len(at), np.int64)
    for j in range(k, k + words):
        out = out << bits | ids[np.minimum(at + j, top)]
    return out


def suffix_array(ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The positions ``at`` in order of the first ``length`` words that follow (0 sorts first)."""
    bits = max(1, int(ids.max()).bit_length())  # of the largest id here, so that ids of any size fit
    words = min(length, 63 // bits)
    keys = [pack(ids, at, k, words, bits) for k in range(0, length, words)]
    return at[np.lexsort(keys[::-1])]


def search(ids: np.ndarray, order: np.ndarray, pattern: np.ndarray, sizes: np.ndarray, upper: bool) -> np.ndarray:
    """For each pattern the place of its first suffix, or the place after its last (``upper``)."""
    lo, hi = np.zeros(len(pattern), np.int64), np.full(len(pattern), len(order), np.int64)
    top = len(ids) - 1
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        at = order[np.minimum(mid, len(order) - 1)]
        sign = np.zeros(len(pattern), np.int64)
        for j in range(pattern.shape[1]):
            same = (sign == 0) & (j < sizes)
            if not same.any():
                break
            sign[same] = np.sign(ids[np.minimum(at[same] + j, top)] - pattern[same, j])
        go = open_ & ((sign < 0) | (sign == 0) & upper)
        lo = np.where(go, mid + 1, lo)
        hi = np.where(open_ & ~go, mid, hi)
    return lo


class Block:
    """Distinct windows of a block of test texts, with the items that have each."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        vocabulary = sorted({w for _, words in items for w in words})
        self.ids = {w: i + 1 for i, w in enumerate(vocabulary)}
        owners: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for row, (_, words) in enumerate(items):
            numbers = [self.ids[w] for w in words]
            for k in range(max(1, len(numbers) - window + 1)):
                owners.setdefault(tuple(numbers[k : k + window]), []).append((row, k))
        windows = sorted(owners)
        self.sizes = np.array([len(w) for w in windows], np.int64)
        self.least = int(self.sizes.min())
        self.pattern = np.array([w + (0,) * (window - len(w)) for w in windows], np.int64)
        self.places = [owners[w] for w in windows]  # (item row, place in it)
        self.items = [{items[row][0] for row, _ in owners[w]} for w in windows]

    def matches(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``numbers`` where a window occurs, and which window; 0 ends a text."""
        usable = numbers > 0
        run = usable.copy()
        for j in range(1, self.least):
            run[:-j] &= usable[j:]
            run[len(run) - j :] = False
        at = np.flatnonzero(run)
        if not len(at):
            return at, at
        order = suffix_array(numbers, at, self.pattern.shape[1])
        lo = search(numbers, order, self.pattern, self.sizes, False)
        hi = search(numbers, order, self.pattern, self.sizes, True)
        counts = hi - lo
        which = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lo, counts)
        return order[place], which


FIELDS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("hit_items", T.ArrayType(T.StringType())), T.StructField("longest_match", T.LongType()),
    T.StructField("contaminated", T.BooleanType())])


def shard_matches(texts: list[str | None], blocks: list) -> list[tuple]:
    """(n_words, n_hit, spans, items, longest, contaminated) of each text of one shard."""
    words = [words_of(t) for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])  # one 0 after each text
    delta = np.zeros(int(starts[-1]) + 2, np.int64)
    found: list[set[str | None]] = [set() for _ in texts]
    longest = [0] * len(texts)
    for shared in blocks:
        block: Block = shared.value
        numbers = np.zeros(int(starts[-1]) + 1, np.int64)
        get = block.ids.get
        for k, row in enumerate(words):
            numbers[starts[k] : starts[k] + sizes[k]] = [get(w, 0) for w in row]
        place, which = block.matches(numbers)
        np.add.at(delta, place, 1)
        np.add.at(delta, place + block.sizes[which], -1)
        owner = np.searchsorted(starts, place, "right") - 1
        for k, w in set(zip(owner.tolist(), which.tolist())):
            found[k].update(block.items[w])
        open_: dict[tuple[int, int, int], tuple[int, int]] = {}  # a match runs on at the same distance from its item
        for at, k, w in sorted(zip(place.tolist(), owner.tolist(), which.tolist())):
            end = at + int(block.sizes[w])
            for row, offset in block.places[w]:
                start, last = open_.get(run := (k, row, at - offset), (at, at))
                open_[run] = (start if at <= last else at, end)
                longest[k] = max(longest[k], end - open_[run][0])
    hit = np.cumsum(delta) > 0
    out = []
    for k in range(len(texts)):
        own = hit[starts[k] : starts[k] + sizes[k]]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
        spans = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]
        n = int(own.sum())
        out.append((len(own), n, spans, sorted(found[k], key=lambda x: (x is None, x or "")), longest[k], n > 0 and 20 * n >= len(own)))
    return out


def find_benchmark_text(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                        window: int = WINDOW) -> DataFrame:
    """``df`` with the columns ``FIELDS``: words, hit words and their spans, the items that occur, the
    longest verbatim match with one item in words, and whether a twentieth of the words or more is hit."""
    blocks, held, total = [], [], 0
    given = benchmark.select(named(item).cast("string").alias("item"), named(item_text).alias("text")).filter("text is not null").distinct()
    context = df.sparkSession.sparkContext
    for row in given.sort("item", "text").toLocalIterator():  # one partition at a time, blocks of bounded size
        words = words_of(row["text"])
        if not words:
            continue
        if held and total + len(words) > BLOCK_WORDS:
            blocks.append(context.broadcast(Block(held, window)))
            held, total = [], 0
        held.append((row["item"], words))
        total += len(words)
    if held:
        blocks.append(context.broadcast(Block(held, window)))

    def scan(texts):
        rows = []
        for lo, hi in chunks([len(t or "") for t in texts], SHARD_CHARS):
            rows += shard_matches(texts[lo:hi], blocks)
        columns = list(zip(*rows))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.string()), pa.int64(), pa.bool_()]
        return [pa.array(list(c), k) for c, k in zip(columns, kinds)]

    return add_columns(df, text, FIELDS, scan)


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``df`` that are not contaminated, with the columns they had."""
    fresh = {f.name.lower() for f in FIELDS}
    clash = [c for c in df.columns if c.lower() in fresh]
    if clash:  # keep the table's own columns of these names aside
        aside = df.withColumnsRenamed({c: f"__own_{c}" for c in clash})
        marked = find_benchmark_text(aside, benchmark, text, window=window)
        return marked.filter("not contaminated").select(*(named(f"__own_{c}" if c in clash else c).alias(c) for c in df.columns))
    marked = find_benchmark_text(df, benchmark, text, window=window)
    return marked.filter("not contaminated").select(*map(named, df.columns))
