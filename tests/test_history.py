"""Segments change the plan, not the rows: every operator is run with few cuts and with many."""
import random

import pytest
from conftest import same
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomvault.functions.dates import at
from loomvault.operators import history, segments
from loomvault.plans import vault



def cut(df, key="k", instant="t"):
    """Many cuts, also of keys with few rows."""
    return segments.cut_points(df, key, instant, one_in=2, points=4)


@pytest.fixture(scope="module")
def versions(spark):
    """A third of the rows belong to one key; instants repeat and marks repeat."""
    rng = random.Random(7)
    data = []
    for i in range(1500):
        key = "hot" if i % 3 == 0 else f"k{rng.randint(0, 60)}"
        data.append((key, rng.randint(0, 400), rng.choice("abc"), i, "s"))
    df = spark.createDataFrame(data, "k string, m int, mark string, n int, RECORD_SOURCE string")
    return df.select("k", (at("2024-01-01 00:00:00") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("m"))).alias("t"), "mark", "n", "RECORD_SOURCE").persist()


def test_segments_are_ordered_and_whole(versions):
    rows, only_cut = segments.segmented(versions, "k", "t", cut(versions))
    same(rows.where(F.col(segments.SEGMENT) > 0), only_cut)
    stats = {(r["k"], r[segments.SEGMENT]): r for r in rows.groupBy("k", segments.SEGMENT).agg(
        F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).collect()}
    hot = sorted((s, r) for (k, s), r in stats.items() if k == "hot")
    assert len(hot) > 20 and max(r["n"] for _, r in hot) < 60
    assert [s for s, _ in hot] == list(range(1, len(hot) + 1))
    assert all(a[1]["hi"] < b[1]["lo"] for a, b in zip(hot, hot[1:]))
    assert sum(r["n"] for r in stats.values()) == versions.count()
    only_hot = segments.cut_points(versions, "k", "t", one_in=2, points=30).collect()
    assert [r[0] for r in only_hot] == ["hot"]
    assert {r[segments.SEGMENT] for r in segments.segmented(versions, "k", "t", segments.cut_points(versions, "k", "t"))[0].select(segments.SEGMENT).distinct().collect()} == {0}


def test_segments_beyond_a_block_of_cuts(spark):
    df = spark.range(3000).select(F.lit("a").alias("k"), F.col("id").alias("t"))
    cuts = segments.cut_points(df, "k", "t", one_in=1, points=5)
    got = segments.segmented(df, "k", "t", cuts)[0].collect()
    assert all(r[segments.SEGMENT] == 1 + sum(1 for c in range(4, 3000, 5) if c < r["t"]) for r in got[::97])


def test_nothing_runs_while_a_frame_is_built_and_no_cut_leaves_no_join(spark, versions):
    tracker = spark.sparkContext.statusTracker()
    versions.count()
    spark.sparkContext.setJobGroup("build", "build")
    try:
        out = history.drop_repeats(history.previous_of(versions, "k", ["t", "n"], {"p": "mark"}), "k", "t", "mark")
        assert list(tracker.getJobIdsForGroup("build")) == []
        out.collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Join" not in final  # joins with cuts and edges met an empty side


def test_previous_and_next(versions):
    order, new = ["t", "n"], {"pm": "mark", "pt": "t"}
    for fn in (history.previous_of, history.next_of):
        same(fn(versions, "k", order, new), fn(versions, "k", order, new, cuts=cut(versions)))
    w = Window.partitionBy("k").orderBy("t", "n")
    same(history.previous_of(versions, "k", order, {"pm": "mark"}, cuts=cut(versions)), versions.withColumn("pm", F.lag("mark").over(w)))
    same(history.next_of(versions, "k", order, {"pm": "mark"}, cuts=cut(versions)), versions.withColumn("pm", F.lead("mark").over(w)))


def test_previous_keeps_null_values(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, None)], "k string, i int, v string").select(
        "k", F.col("v"), (at("2024-01-01 00:00:00") + F.make_dt_interval(F.col("i"))).alias("t"))
    got = [r["p"] for r in history.previous_of(df, "k", ["t"], {"p": "v"}, cuts=segments.cut_points(df, "k", "t", one_in=1, points=1)).orderBy("t").collect()]
    assert got == [None, None, "x"]


def test_carry_forward(versions):
    sparse = versions.withColumn("v", F.when(F.col("n") % 7 == 0, F.col("n")))
    # one value per instant, so that the carried value is defined
    sparse = sparse.groupBy("k", "t").agg(F.max("v").alias("v"), F.max("n").alias("n"))
    same(history.carry_forward(sparse, "k", "t", ["v"]), history.carry_forward(sparse, "k", "t", ["v"], cuts=cut(sparse)))


def test_drop_repeats(versions):
    plain = history.drop_repeats(versions, "k", "t", "mark", ties=["RECORD_SOURCE"])
    sliced = history.drop_repeats(versions, "k", "t", "mark", ties=["RECORD_SOURCE"], cuts=cut(versions))
    same(plain.select("k", "t", "mark"), sliced.select("k", "t", "mark"))


def test_asof_join_equals_lateral_form(versions):
    left = versions.select("n", "k", "t")
    right = versions.where("n % 5 = 0").groupBy("k", F.col("t").alias("rt")).agg(F.max("mark").alias("m"))
    pairs = left.join(right, "k").where("rt <= t").groupBy("n").agg(F.max_by(F.struct("rt", "m"), "rt").alias("b"))
    want = left.join(pairs, "n", "left").select("n", "k", "t", F.col("b.rt").alias("rt"), F.col("b.m").alias("m"))
    same(history.asof_join(left, right, "k", "t", "rt", ["m"]), want)
    same(history.asof_join(left, right, "k", "t", "rt", ["m"], cuts=cut(left)), want)


def test_scd2_intervals(versions):
    once = versions.dropDuplicates(["k", "t"])
    plain, sliced = history.scd2_intervals(once, "k", "t"), history.scd2_intervals(once, "k", "t", cuts=cut(once))
    same(plain.drop("mark", "n"), sliced.drop("mark", "n"))
    assert plain.where("IS_CURRENT").count() == once.select("k").distinct().count()


def test_satellite_and_pit_with_hot_key(versions):
    staged = versions.select(F.col("k").alias("HK"), F.col("mark").alias("HD"), F.col("t").alias("LOAD_DATETIME"), "RECORD_SOURCE")
    plain = vault.load_satellite(staged, "HK", "HD", [])
    sliced = vault.load_satellite(staged, "HK", "HD", [], cuts=cut(staged, "HK", "LOAD_DATETIME"))
    same(plain, sliced)
    hub = staged.groupBy("HK").agg(F.min("LOAD_DATETIME").alias("LOAD_DATETIME"))
    other = plain.where("HASH_DIFF <> 'a'")
    same(vault.load_pit(hub, "HK", {"A": plain, "B": other}), vault.load_pit(hub, "HK", {"A": plain, "B": other}, cuts=cut(staged, "HK", "LOAD_DATETIME")))


def test_latest_and_earliest(versions):
    w = Window.partitionBy("k").orderBy(F.desc("t"), F.desc("n"))
    same(history.latest_per_key(versions, "k", ["t", "n"]), versions.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r"))
    w = Window.partitionBy("k").orderBy("t", "n")
    same(history.earliest_per_key(versions, "k", ["t", "n"]), versions.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r"))


def test_null_keys_match_nothing_as_of(spark):
    from loomvault.operators.history import asof_join
    left = spark.createDataFrame([(1, None, 5), (2, "a", 5), (3, "b", 5)], "id int, k string, t int")
    right = spark.createDataFrame([(None, 1, "x"), ("a", 1, "y")], "k string, s int, v string")
    got = {r.id: r.v for r in asof_join(left, right, "k", "t", "s", ["v"]).collect()}
    assert got == {1: None, 2: "y", 3: None}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nulls_give_the_same_rows_with_and_without_cuts(spark, seed):
    """A third of the rows have no key, some have no instant or no value; instants repeat."""
    rng = random.Random(seed)
    data = [(None if i % 3 == 0 else f"k{rng.randint(0, 5)}", None if rng.random() < 0.1 else rng.randint(0, 200),
             rng.choice(["a", "b", None]), i) for i in range(900)]
    df = spark.createDataFrame(data, "k string, m int, mark string, n int").select(
        "k", (at("2024-01-01 00:00:00") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("m"))).alias("t"), "mark", "n").persist()
    assert None in [r[0] for r in cut(df).collect()]
    order = ["t", "n"]
    for fn, reach in ((history.previous_of, F.lag), (history.next_of, F.lead)):
        want = df.withColumn("p", reach("mark").over(Window.partitionBy("k").orderBy(*order)))
        same(fn(df, "k", order, {"p": "mark"}), want)
        same(fn(df, "k", order, {"p": "mark"}, cuts=cut(df)), want)
    once = df.groupBy("k", "t").agg(F.max("mark").alias("mark"))
    so_far = Window.partitionBy("k").orderBy("t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    want = once.withColumn("mark", F.last("mark", ignorenulls=True).over(so_far))
    same(history.carry_forward(once, "k", "t", ["mark"]), want)
    same(history.carry_forward(once, "k", "t", ["mark"], cuts=cut(once)), want)
    same(history.scd2_intervals(once, "k", "t"), history.scd2_intervals(once, "k", "t", cuts=cut(once)))
    same(history.drop_repeats(df, "k", "t", "mark").select("k", "t", "mark"), history.drop_repeats(df, "k", "t", "mark", cuts=cut(df)).select("k", "t", "mark"))


def test_a_hot_key_without_instants_is_left_whole(spark):
    df = spark.range(200).select(F.lit("a").alias("k"), F.lit(None).cast("timestamp_ntz").alias("t"), F.col("id").alias("n"))
    got = history.previous_of(df, "k", ["t", "n"], {"p": "n"}, cuts=cut(df))
    assert got.where("p = n - 1 or (n = 0 and p is null)").count() == 200


def test_a_key_of_half_the_rows_meets_no_large_task(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                    (F.col("id") * 7919 % 40_000).alias("t"), (F.col("id") % 3).alias("mark")).persist()
    cuts = segments.cut_points(df, "k", "t", one_in=8, points=16)
    rows, _ = segments.segmented(df, "k", "t", cuts)
    assert rows.groupBy("k", segments.SEGMENT).count().agg(F.max("count")).first()[0] < 600  # of 20,000
    want = df.withColumn("p", F.lag("mark").over(Window.partitionBy("k").orderBy("t")))
    same(history.previous_of(df, "k", ["t"], {"p": "mark"}, cuts=cuts), want)
    same(history.drop_repeats(df, "k", "t", "mark", cuts=cuts), want.where("p is null or p <> mark").drop("p"))


def test_newest_kept_is_the_newest_row_without_repeats(spark, versions):
    """Two marks at once, few cuts and many; rows without an instant are the first of a key."""
    undated = spark.createDataFrame([("k1", "a"), ("k2", "b"), ("only", "a"), ("flat", "c")], "k string, mark string").select(
        "k", F.lit(None).cast("timestamp_ntz").alias("t"), "mark", F.lit(-1).alias("n"), F.lit("s").alias("RECORD_SOURCE"))
    flat = versions.where("k = 'hot'").withColumns({"k": F.lit("flat"), "mark": F.lit("c")})
    df = versions.unionByName(undated).unionByName(flat).withColumn("coarse", F.when(F.col("mark") == "c", "c").otherwise("ab"))
    marks = {"fine": (lambda rows: F.col("mark"), ["mark"]), "rough": (lambda rows: F.col("coarse"), ["coarse"])}
    for cuts in (None, cut(df)):
        got = history.newest_kept(df.drop("n", "RECORD_SOURCE").withColumn("at", F.col("t")), "k", "t", {
            name: (mark, [*columns, "at"]) for name, (mark, columns) in marks.items()}, cuts)
        for name, column in (("fine", "mark"), ("rough", "coarse")):
            kept = history.drop_repeats(df.select("k", "t", column), "k", "t", column)
            want = kept.groupBy("k").agg(F.max_by(F.struct(column, F.col("t").alias("at")), "t").alias(name))
            same(got.select("k", name), want)


def test_partitions_grow_with_the_scan(spark, tmp_path):
    from loomvault.operators.sizes import dealt, parts_for, scanned_bytes
    path = str(tmp_path / "t")
    spark.range(20000).write.parquet(path)
    df = spark.read.parquet(path)
    size, cores = scanned_bytes(df), spark.sparkContext.defaultParallelism
    assert parts_for(df, size // 50) in (50, 51) and parts_for(df, 2 * size) == cores
    assert dealt(df, size // 50, "id").rdd.getNumPartitions() in (50, 51)
