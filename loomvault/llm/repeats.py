"""Removal of repeated byte strings with suffix arrays and longest previous factors.

A string of ``length`` bytes or more that starts at two places makes its copies removable: all of
them (``keep="none"``) or all but the first (``keep="first"``, by key, then text hash, then place).

Every window of ``length`` bytes has an anchor, the smallest hash of the ``GRAM``-byte strings in it:
equal windows have equal anchors, whatever surrounds them. Neighbouring windows with one anchor form a
context, so a text gives one short row for some hundred bytes. Anchors that occur once are done with.
Where all contexts of an anchor are one string, all its windows are repeated. For the others one copy
of each context is fetched, and the contexts are sorted in shards: a suffix array, by doubling of
ranks, orders the windows by their bytes and places in order of first occurrence. There the previous
smaller position of a window that has an earlier match is the entry before it, so that the entry tells
whether its longest previous factor reaches ``length``. An anchor with very many contexts is cut in
slices; the slices' distinct windows are then matched by hash, counted in partial sums.

Texts move once, by key, and are read twice from there: for the contexts and for the cut.

Defined cases: null counts as empty; texts shorter than ``length`` stay as they are; a repeated row
is a text of its own, of which nothing is kept with ``keep="none"`` and everything with ``"first"``
in each of the equal rows; texts of any length are handled whole, one at a time; an empty table gives
an empty table; columns with the name of a new column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import cut_lineage
from .common import by_place, map_in_arrow, named, without

LENGTH = 200
GRAM = 32
# Windows of one context, contexts of one slice, bytes of one suffix array.
CONTEXT = 1024
SLICE = 4096
SHARD = 1 << 20
# Places of a text whose anchors are found at once.
PIECE = 1 << 20
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
U = np.uint64


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; the first byte weighs most."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    out = np.empty(len(data), U)
    for k in range(8):
        part = out[k::8]
        part[:] = padded[k : k + 8 * len(part)].view(">u8")
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbouring values."""
    rows = -(-len(values) // width)
    block = np.full(rows * width, ~U(0), U)
    block[: len(values)] = values
    block = block.reshape(rows, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(values) - width + 1
    return np.minimum(back[:windows], ahead[width - 1 : width - 1 + windows])


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per window the hash of its anchor, and the first and last place where the anchor is least in it."""
    eight = _eights(data)
    n = len(data) - GRAM + 1
    h = np.zeros(n, U)
    for k in range(0, GRAM, 8):
        h = (h ^ eight[k : k + n]) * U(0x9E3779B97F4A7C15)
        h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    width, low, place = length - GRAM + 1, U(PIECE - 1), np.arange(n).astype(U)
    high = h & ~low
    left = (_least(high | place, width) & low).astype(np.int64)
    right = (low - (_least(high | (low - place), width) & low)).astype(np.int64)
    return h[left], left, right


def contexts(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int], np.ndarray]:
    """Start, number of windows, anchor and hash of the contexts of one text, and whether the anchor
    stands in a context more than once, so that it may hold equal windows itself."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), [], np.empty(0, bool)
    parts, step = [], PIECE - length
    for lo in range(0, len(data) - length + 1, step):
        anchor, left, right = anchors(np.frombuffer(data, np.uint8)[lo : lo + step + length - 1], length)
        parts.append((anchor, left + lo, right + lo))
    anchor, left, right = (np.concatenate(p) for p in zip(*parts))
    starts = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    sizes = np.diff(np.append(starts, len(anchor)))
    if sizes.max() > CONTEXT:
        pieces = -(-sizes // CONTEXT)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        ends = np.repeat(starts + sizes, pieces)
        starts = np.repeat(starts, pieces) + nth * CONTEXT
        sizes = np.minimum(ends - starts, CONTEXT)
    twice = left[starts] != right[starts + sizes - 1]
    digest = xxhash.xxh3_64_intdigest
    hashes = [digest(data[a:b]) for a, b in zip(starts.tolist(), (starts + sizes + length - 1).tolist())]
    return starts, sizes, anchor[starts].view(np.int64), hashes, twice


def window_ranks(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the windows at ``at`` among the suffixes of ``data``, by their first ``length`` bytes."""
    rank = np.unique(_eights(data), return_inverse=True)[1].astype(np.int64)
    have = 8
    while have < length:
        ahead = min(have, length - have)
        places = np.arange(len(data)) if have + ahead < length else at
        second = np.zeros(len(places), np.int64)
        inside = places + ahead < len(data)
        second[inside] = rank[places[inside] + ahead]
        pair = rank[places] << 32 | second
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        have += ahead
    return rank if length > 8 else rank[at]


def previous_factors(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every window of the texts: text, offset, whether it occurs before, whether it occurs elsewhere.

    Windows of equal rank stand together in suffix order, by ascending position: the previous smaller
    position is the entry before, if its rank is the same.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    owner = np.repeat(np.arange(len(texts)), windows)
    offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    rank = window_ranks(data, begin[owner] + offset, length)
    order = np.argsort(rank, kind="stable")
    same = rank[order][1:] == rank[order][:-1]
    before, elsewhere = np.zeros(len(order), bool), np.zeros(len(order), bool)
    before[order[1:]] = same
    elsewhere[order[1:]] = same
    elsewhere[order[:-1]] |= same
    return owner, offset, before, elsewhere


def _spans(flags: np.ndarray, length: int) -> list[dict]:
    """Runs of flagged windows as byte spans."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b) + length - 1} for a, b in zip(edge[::2], edge[1::2])]


def find_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, keep: str = "none") -> DataFrame:
    """``df`` with ``n_bytes``, ``removed_spans`` (bytes, in order, apart) and ``kept`` (the bytes that stay)."""
    if keep not in ("none", "first") or length < GRAM + 1:
        raise ValueError(f"keep is 'none' or 'first', length above {GRAM}")
    spark = df.sparkSession
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    first = keep == "first"
    new = ("n_bytes", "removed_spans", "kept")
    body = F.coalesce(named(text).cast("string"), F.lit(""))
    docs = df.select(*without(df, *new, "__key", "__mark"), named(key).alias("__key"), F.xxhash64(body).alias("__mark"))
    texts = docs.select("__key", "__mark", named(text).cast("string").alias("__text"))
    own = texts.schema["__key"]

    # 1. one row per context
    row = T.StructType([own, texts.schema["__mark"], *(T.StructField(n, T.LongType()) for n in ("start", "n", "anchor", "context")), T.StructField("twice", T.BooleanType())])
    row_schema = to_arrow_schema(row)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, columns, held = [], [[], [], [], [], []], 0
            for k, data in enumerate(batch.column(2).to_pylist()):
                if data is None:
                    continue
                starts, sizes, anchor, hashes, twice = contexts(data.encode("utf-8", "surrogatepass"), length)
                owner.append(np.full(len(starts), k))
                for column, values in zip(columns, (starts, sizes, anchor, np.array(hashes, U).view(np.int64), twice)):
                    column.append(values)
                held += len(starts)
                if held > 200_000:
                    yield _rows(batch, owner, columns, row_schema)
                    owner, columns, held = [], [[], [], [], [], []], 0
            if owner:
                yield _rows(batch, owner, columns, row_schema)

    found = texts.mapInArrow(cut, row)
    head = F.struct("__key", "__mark", "start")

    # 2. anchors that occur more than once, and whether their contexts differ
    wanted = [F.count("*").alias("m"), (F.min("context") != F.max("context")).alias("differ"), F.max("twice").alias("twice")]
    dup = (found.groupBy("anchor").agg(*wanted, *([F.min(head).alias("head")] if first else []))
           .withColumn("mixed", F.expr("differ or twice")).filter("m > 1 or mixed").drop("m", "differ", "twice"))
    hits = cut_lineage(found.drop("twice").join(dup, "anchor"))
    whole = hits.filter("not mixed").filter(head != F.col("head")) if first else hits.filter("not mixed")
    spans = whole.select("__key", "__mark", F.col("start").alias("lo"), (F.col("start") + F.col("n") + length - 1).alias("hi"))

    # 3. one copy of each context of the other anchors, with its bytes
    mixed = hits.filter("mixed").select("__key", "__mark", "start", "n", "anchor", "context")
    kinds = mixed.groupBy("anchor", "context").agg(F.count("*").alias("m"), F.min(F.struct("__key", "__mark", "start", "n")).alias("head"))
    slices = kinds.groupBy("anchor").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices"))
    wanted = (kinds.join(slices, "anchor").groupBy("head.__key", "head.__mark").agg(F.collect_list(F.struct(
        "anchor", "context", "m", "slices", F.col("head.start").alias("start"), F.col("head.n").alias("n"))).alias("wanted")))
    fetched = _by_doc(texts, wanted, "inner")
    piece = T.StructType([own, row["__mark"], *(T.StructField(n, T.LongType()) for n in ("start", "anchor", "context", "m", "slices", "slice")),
                          T.StructField("bytes", T.BinaryType())])
    piece_schema = to_arrow_schema(piece)

    def fetch(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                data = batch.column(2)[k].as_py().encode("utf-8", "surrogatepass")
                asked = batch.column(3)[k].as_py()
                for lo in range(0, len(asked), 10_000):
                    part = asked[lo : lo + 10_000]
                    n = len(part)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([batch.column(0)[k].as_py()] * n, piece_schema.field(0).type), pa.array([batch.column(1)[k].as_py()] * n, pa.int64()),
                        *(pa.array([x[c] for x in part], pa.int64()) for c in ("start", "anchor", "context", "m", "slices")),
                        pa.array([x["context"] % x["slices"] for x in part], pa.int64()),
                        pa.array([data[x["start"] : x["start"] + x["n"] + length - 1] for x in part], pa.binary())], schema=piece_schema)

    pieces = fetched.select("__key", "__mark", "__text", "wanted").mapInArrow(fetch, piece)

    # 4. suffix arrays over the contexts of whole slices
    result = T.StructType([*(T.StructField(n, T.LongType()) for n in ("anchor", "context")), T.StructField("spans", SPAN), T.StructField("head_spans", SPAN),
                           T.StructField("__key", own.dataType), T.StructField("__mark", T.LongType()), row["start"], T.StructField("offset", T.LongType()), T.StructField("window", T.LongType())])
    result_schema = to_arrow_schema(result)

    def sort(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for x in zip(*(batch.column(k).to_pylist() for k in (3, 4, 5, 6, 7, 8, 0, 1, 2))):
                if held and (x[0] != held[-1][0] and size > SHARD or x[0] == held[-1][0] and x[4] != held[-1][4]):
                    yield solve(held)
                    held, size = [], 0
                held.append(x)
                size += len(x[5])
        if held:
            yield solve(held)

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        owner, offset, before, elsewhere = previous_factors([r[5] for r in rows], length)
        bounds = np.searchsorted(owner, np.arange(len(rows) + 1))
        out: list[tuple] = []
        digest = xxhash.xxh3_64_intdigest
        for k, (anchor, context, m, slices, _, data, own_key, mark, start) in enumerate(rows):
            a, b = bounds[k], bounds[k + 1]
            every = np.ones(b - a, bool) if m > 1 else elsewhere[a:b]
            out.append((anchor, context, _spans(every, length), _spans(before[a:b], length), None, None, None, None, None))
            if slices > 1:  # the first of its kind in this slice; other slices may have it too
                for o in np.flatnonzero(~before[a:b]).tolist():
                    h = digest(data[o : o + length])
                    out.append((anchor, context, None, None, own_key, mark, start, o, h - (1 << 64) if h >> 63 else h))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), result_schema)], schema=result_schema)

    solved = cut_lineage(pieces.repartition(width, "anchor", "slice").sortWithinPartitions("anchor", "slice", "__key", "__mark", "start")
                         .mapInArrow(sort, result))
    side = "head_spans" if first else "spans"
    local = solved.filter("window is null").select("anchor", "context", F.explode(side).alias("s")).select("anchor", "context", "s.start", "s.end")
    # windows that several slices have
    apart = solved.filter("window is not null")
    place = F.struct("__key", "__mark", (F.col("start") + F.col("offset")).alias("place"))
    shared = apart.groupBy("anchor", "window").agg(F.count("*").alias("slices"), F.min(place).alias("least")).filter("slices > 1")
    across = apart.join(shared, ["anchor", "window"])
    if first:
        across = across.filter(place != F.col("least"))
    found_in = local.withColumnsRenamed({"start": "from", "end": "to"}).unionByName(
        across.select("anchor", "context", F.col("offset").alias("from"), (F.col("offset") + length).alias("to")))
    placed = mixed.join(found_in, ["anchor", "context"])
    if first:
        # later copies of a context lose all of it; its first copy what occurs before
        heads = kinds.select("anchor", "context", F.struct("head.__key", "head.__mark", "head.start").alias("head"))
        placed = placed.join(heads, ["anchor", "context"]).filter(head == F.col("head"))
        later = mixed.join(heads, ["anchor", "context"]).filter(head != F.col("head"))
        spans = spans.unionByName(later.select("__key", "__mark", F.col("start").alias("lo"), (F.col("start") + F.col("n") + length - 1).alias("hi")))
    spans = spans.unionByName(placed.select("__key", "__mark", (F.col("start") + F.col("from")).alias("lo"), (F.col("start") + F.col("to")).alias("hi")))

    # 5. the cut
    removed = spans.groupBy("__key", "__mark").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("cut"))
    outcome = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("removed_spans", SPAN), T.StructField("kept", T.BinaryType())])
    kept_columns = [c for c in docs.columns if c not in ("__key", "__mark")]
    joined = _by_doc(docs.withColumn("__text", named(text).cast("string")) if set(kept_columns) - {key, text} else texts, removed, "left")
    if not set(kept_columns) - {key, text}:  # the shuffled texts serve both reads
        joined = joined.select(F.col("__key").alias(key), *([F.col("__text").alias(text)] if text != key else []), "__text", "cut")
    else:
        joined = joined.select(*map(named, kept_columns), "__text", "cut")
    out = T.StructType([*joined.schema.fields[:-2], *outcome.fields])
    out_schema = to_arrow_schema(out)

    def apply(batches):
        for batch in batches:
            n_bytes, runs, kept = [], [], []
            for text_, cut_ in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                data = (text_ or "").encode("utf-8", "surrogatepass")
                merged: list[list[int]] = []
                for s in cut_ or ():
                    if merged and s["lo"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["hi"])
                    else:
                        merged.append([s["lo"], s["hi"]])
                edges = [0, *(x for m in merged for x in m), len(data)]
                n_bytes.append(len(data))
                runs.append([{"start": a, "end": b} for a, b in merged])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield by_place([*batch.columns[:-2], *(pa.array(c, f.type) for c, f in zip((n_bytes, runs, kept), list(out_schema)[-3:]))], out_schema)

    return map_in_arrow(joined, apply, out)


def _rows(batch: pa.RecordBatch, owner: list, columns: list, schema: pa.Schema) -> pa.RecordBatch:
    at = pa.array(np.concatenate(owner))
    return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *(pa.array(np.concatenate(c)) for c in columns)], schema=schema)


def _by_doc(docs: DataFrame, per_doc: DataFrame, how: str) -> DataFrame:
    """Documents with what belongs to them, by key and text hash; null keys are keys too."""
    right = per_doc.withColumnsRenamed({"__key": "__k", "__mark": "__m"}).hint("shuffle_hash")
    return docs.join(right, (F.col("__mark") == F.col("__m")) & F.col("__key").eqNullSafe(F.col("__k")), how).drop("__k", "__m")
