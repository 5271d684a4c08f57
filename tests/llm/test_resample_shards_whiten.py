"""Importance resampling, sharding and whitening against plain versions, and on the odd cases."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomvault.llm import ranges, resample, shards, whiten
from loomvault.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_features(text, least, most):
    words = WORD.findall(lower(text))
    return words, [" ".join(words[i:i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]


def plain_resample(docs, target, percent, least, most, buckets, min_words):
    def of(texts):
        counts = [0] * buckets
        for text in texts:
            for f in plain_features(text, least, most)[1]:
                counts[zlib.crc32(f.encode()) % buckets] += 1
        return counts
    s, t = of(x for _, x in docs), of(target)
    gain = [math.floor(1000 * math.log((t[k] + 1) * (sum(s) + buckets) / ((s[k] + 1) * (sum(t) + buckets)))) for k in range(buckets)]
    out = []
    for key, text in docs:
        words, features = plain_features(text, least, most)
        total = sum(gain[zlib.crc32(f.encode()) % buckets] for f in features)
        weight = total // len(features) if features else 0
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append((key, len(words), len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    drawn = fit[:percent * len(fit) // 100]
    return out, drawn


def texts(n, seed=5):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "g4mma", "délta", "日本", "x"] + [f"w{k}" for k in range(40)]
    return [(k, " ".join(rng.choices(vocabulary, k=rng.randint(0, 30))) + rng.choice(["", ".", "\n--- !!"])) for k in range(n)]


@pytest.mark.parametrize("least,most", [(1, 1), (1, 3), (2, 2)])
def test_resampling_equals_a_plain_version(spark, least, most):
    docs = texts(300) + [(None, None), (301, ""), (302, "-- !"), (7, "alpha beta"), (7, "alpha beta")]
    target = ["alpha beta g4mma", None, "日本 x w1 w2"]
    df = spark.createDataFrame([(k, t, "kept", "old") for k, t in docs], "doc_id long, text string, `a.b` string, Rank string")
    got = resample.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), 30, least=least, most=most, buckets=64, min_words=2)
    assert got.columns == ["doc_id", "text", "a.b", "n_words", "n_features", "weight", "score", "rank"]
    rows = got.collect()
    plain, drawn = plain_resample(docs, target, 30, least, most, 64, 2)
    assert sorted(map(str, plain)) == sorted(str((r.doc_id, r.n_words, r.n_features, r.weight, r.score)) for r in rows)
    won = sorted((r for r in rows if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in won] == list(range(1, len(drawn) + 1))
    assert [(r.score, r.doc_id) for r in won] == [(d[4], d[0]) for d in drawn]


def test_resampling_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "alpha beta")], "doc_id long, text string")
    assert resample.resample(empty, some, 50).collect() == []
    row = resample.resample(some, empty, 100).first()
    assert (row.n_features, row["rank"]) == (2, 1)
    assert resample.resample(some, empty, 100, min_words=3).first()["rank"] is None


def test_features_of_a_long_text_are_those_of_its_slices(monkeypatch):
    monkeypatch.setattr(resample, "SLICE", 50)
    text = " ".join(t for _, t in texts(60))
    for least, most in ((1, 1), (1, 3), (2, 4)):
        parts = list(resample.runs(text.encode(), least, most))
        assert len(parts) > 10
        words, features = plain_features(text, least, most)
        assert sum(n for n, _ in parts) == len(words)
        assert sorted(f.decode() for _, p in parts for f in p) == sorted(features)


@pytest.mark.parametrize("pivots", [1, 2, 31])
def test_quickselect_finds_every_place(spark, pivots):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 2, 2, 3]), rng.choice([None, "a", "b", "b"]), k) for k in range(120)]
    df = spark.createDataFrame(rows, "a long, b string, c long").repartition(7).persist()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "", r[2]))
    for k in (1, 2, 59, 120):
        found = df.filter(F.struct("a", "b", "c") == resample.kth_key(df, ["a", "b", "c"], k, pivots)).collect()
        assert [tuple(r) for r in found] == [ordered[k - 1]]
    with pytest.raises(ValueError):
        resample.kth_key(df, ["a", "b", "c"], 121, pivots)


def plain_shards(docs, n):
    rows = sorted((hashlib.sha256((t or "").encode()).hexdigest(), -1 if k is None else k, len((t or "").encode()) + 16) for k, t in docs)
    total, before, out, starts, slots = sum(r[2] for r in rows), 0, [], {}, {}
    whole = {}
    for same, _, size in rows:
        whole[same] = whole.get(same, 0) + size
    for same, key, size in rows:
        start = before if whole[same] * n * shards.WHOLE > total else starts.setdefault(same, before)
        shard = (2 * start + size) * n // (2 * total)
        slot = slots[shard] = slots.get(shard, -1) + 1
        out.append((key, size, shard, slot))
        before += size
    return sorted(out)


@pytest.mark.parametrize("n", [1, 4, 7])
def test_shards_equal_a_plain_version(spark, n):
    rng = random.Random(n)
    pool = [t for _, t in texts(400, seed=n)]
    docs = [(k, rng.choice(pool)) for k in range(900)] + [(k, "the same text") for k in range(900, 1400)] + [(1400, None), (1401, ""), (None, "x")]
    df = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id long, text string, Slot int").repartition(9)
    got = shards.assign_shards(df, n).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r["size"], r.shard, r["slot"]) for r in got) == plain_shards(docs, n)
    assert all(r.text_crc32 == zlib.crc32((dict(docs)[r.doc_id] or "").encode()) for r in got)
    sizes = [sum(r["size"] for r in got if r.shard == k) for k in range(n)]
    share = sum(sizes) / n
    assert max(sizes) - min(sizes) <= share / shards.WHOLE * 2 + 2 * max(r["size"] for r in got)


def test_runs_go_on_over_ranges(spark):
    rows = [(k, "same" if 5 <= k < 95 else f"t{k:03d}") for k in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in ("1", "9", "40"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = shards.assign_shards(df, 3).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert sorted((r.doc_id, r["size"], r.shard, r["slot"]) for r in got) == plain_shards(rows, 3), parts


def test_sharding_odd_cases_and_files(spark, folder):
    assert shards.assign_shards(spark.createDataFrame([], "doc_id long, text string"), 3).collect() == []
    again = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b" * 100_000)], "doc_id long, text string")
    got = shards.assign_shards(again, 40).collect()
    assert len(got) == 3 and all(0 <= r.shard < 40 for r in got)
    assert len({(r.shard, r["slot"]) for r in got}) == 3
    shards.write_shards(again, 2, f"{folder}/out")
    back = spark.read.parquet(f"{folder}/out")
    assert sorted(r.text[:1] for r in back.collect()) == ["a", "a", "b"]
    with pytest.raises(ValueError):
        shards.assign_shards(again, 0)


def test_rows_in_order_know_what_stands_before(spark):
    rows = [(k % 13, k, k + 1) for k in range(200)]
    df = spark.createDataFrame(rows, "a long, b long, w long").repartition(6)
    out = ranges.in_order(df, [F.col("a"), F.col("b")], "test", weight="w", run="a")
    ahead = {r[ranges.PART]: r for r in ranges.totals(out, "w", "a")}
    assert sum(r["n"] for r in ahead.values()) == 200 and sum(r["total"] for r in ahead.values()) == sum(r[2] for r in rows)
    for part in ahead:
        inside = sorted(((r.a, r.b, r.w, r[ranges.AT], r[ranges.BEFORE]) for r in out.filter(F.col(ranges.PART) == part).collect()))
        assert [r[3] for r in inside] == list(range(len(inside)))
        assert [r[4] for r in inside] == [sum(x[2] for x in inside[:k]) for k in range(len(inside))]


def vectors(rng, n, d, spread):
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    return (rng.standard_normal((n, d)) * spread) @ turn


@pytest.mark.parametrize("name,n,d,components,spread", [
    ("flat", 400, 40, 10, np.ones(40)), ("steep", 300, 24, 8, 10.0 ** -np.arange(24) * 1000), ("small", 200, 6, 32, np.arange(1, 7)),
    ("few rows", 12, 40, 16, np.ones(40)), ("one large", 300, 30, 10, np.array([1e5] + [1.0] * 29))])
def test_whitening_equals_dense_eigenvectors(spark, name, n, d, components, spread):
    rng = np.random.default_rng(7)
    given = vectors(rng, n, d, spread)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(given)], "vec_id long, embedding array<double>").repartition(5)
    rows = whiten.whole_vectors(df)
    got = whiten.fit(rows, components)
    x = np.floor(64 * given) + 1_000_000
    centred = x - x.mean(axis=0)
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1], turn[:, ::-1]
    k = len(got.values)
    assert k == min(components, d, int((values > 1e-12 * values[0]).sum()))
    assert np.abs(got.values - values[:k]).max() <= 1e-11 * values[0]
    assert got.trace == pytest.approx(values.sum(), rel=1e-12)
    for j in range(k):  # the space of values that are not told apart
        near = np.abs(values - values[j]) < 1e-3 * values[0]
        assert np.linalg.norm(turn[:, near].T @ got.vectors[:, j]) == pytest.approx(1, abs=1e-6)
    assert whiten.identity_error(rows, got) < 1e-4


def test_whitening_rows_and_odd_cases(spark):
    rng = np.random.default_rng(2)
    good = [(k, v.tolist(), "kept", 5) for k, v in enumerate(rng.standard_normal((60, 5)))]
    nan, inf = float("nan"), float("inf")
    odd = [(100, None, "x", 1), (101, [], "x", 1), (102, [1.0, None, 2.0, 3.0, 4.0], "x", 1), (103, [nan, 1.0, 1.0, 1.0, 1.0], "x", 1),
           (104, [1.0, inf, 1.0, 1.0, 1.0], "x", 1), (105, [1.0, 2.0], "x", 1)]
    repeated = [good[0], (None, [0.5] * 5, "y", 2)]
    df = spark.createDataFrame(good + odd + repeated, "vec_id long, embedding array<double>, `a.b` string, Whitened int")
    got = whiten.whiten(df, 3).collect()
    assert len(got) == 62 * 3 and {r.n for r in got} == {62}
    x = np.floor(64 * np.array([r[1] for r in good + repeated])).astype(int) + 1_000_000
    exact = sorted(((62 * x - x.sum(axis=0)) ** 2).sum(axis=1).tolist())
    assert sorted(r.deviation for r in got if r.component == 1) == exact
    assert {r["a.b"] for r in got} == {"kept", "y"}
    white = np.array([[r.whitened for r in got if r.component == c] for c in (1, 2, 3)])
    assert np.abs(np.cov(white, bias=True) - np.eye(3)).max() < 1e-9 and got[0].identity_error < 1e-9
    same = [(k, [1.0, 2.0]) for k in range(4)]
    for rows in ([], same[:1], same):
        assert whiten.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 3).collect() == []
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whiten.whiten(huge, 1).collect()} == {None}


def test_registered_queries_run_whole(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    bench = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = QUERIES["op11_importance_resampling"](spark, SMALL).collect()
    plain, drawn = plain_resample([tuple(r) for r in docs], bench, 10, 1, 1, 10_000, 20)
    assert sorted((r.doc_id, r.n_features, r.weight, r.score) for r in rows) == sorted((p[0], *p[2:]) for p in plain)
    assert [r.doc_id for r in sorted((r for r in rows if r["rank"]), key=lambda r: r["rank"])] == [d[0] for d in drawn]
    rows = QUERIES["op12_sharding"](spark, SMALL).collect()
    assert sorted((r.doc_id, r["size"], r.shard, r["slot"]) for r in rows) == plain_shards([tuple(r) for r in docs], 40)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    rows = QUERIES["op13_embedding_whitening"](spark, SMALL).collect()
    n = spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
    assert len(rows) == n * 32 and rows[0].identity_error < 1e-9
