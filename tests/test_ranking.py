import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomvault.operators.ranking import global_ranks, ntile_of, percent_rank_of


@pytest.mark.parametrize("n,distinct", [(1, 1), (3, 1), (4, 4), (97, 3), (500, 40), (1000, 1000)])
def test_equal_to_builtin_ranks(spark, n, distinct):
    rng = random.Random(n)
    df = spark.createDataFrame([(f"k{i:05d}", rng.randint(1, distinct), rng.random()) for i in range(n)], "k string, v int, d double").persist()
    ranks, rows = global_ranks(df, "k", {"V": F.col("v"), "DOWN": -F.col("v")})
    assert rows == n
    up, down = Window.orderBy("v", "k"), Window.orderBy(F.desc("v"), "k")
    want = df.select(
        "k", F.row_number().over(up).alias("p"), F.rank().over(Window.orderBy("v")).alias("r"), F.ntile(5).over(up).alias("q"),
        F.percent_rank().over(Window.orderBy("v")).alias("pr"), F.ntile(5).over(down).alias("dq"))
    got = ranks.select("k", F.col("V_POSITION").alias("p"), F.col("V_RANK").alias("r"), ntile_of(F.col("V_POSITION"), rows, 5).alias("q"),
                       percent_rank_of(F.col("V_RANK"), rows).alias("pr"), ntile_of(F.col("DOWN_POSITION"), rows, 5).alias("dq"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("rows,buckets", [(1, 5), (4, 5), (5, 5), (6, 5), (23, 4), (100, 7)])
def test_ntile_formula(spark, rows, buckets):
    df = spark.range(1, rows + 1)
    want = [r[0] for r in df.select(F.ntile(buckets).over(Window.orderBy("id"))).collect()]
    got = [r[0] for r in df.orderBy("id").select(ntile_of(F.col("id"), rows, buckets)).collect()]
    assert got == want


def test_value_shared_by_most_rows_is_split(spark):
    df = spark.range(4000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("k"), F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).alias("v"))
    ranks, rows = global_ranks(df, "k", {"V": F.col("v")})
    zeros = ranks.join(df, "k").where("v = 0")
    assert zeros.select("V_RANK").distinct().collect()[0][0] == 1
    assert zeros.agg(F.max("V_POSITION")).first()[0] == df.where("v = 0").count()


def test_nulls_rank_first_and_count(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from loomvault.operators.ranking import global_ranks
    df = spark.createDataFrame([(i, None if i < 3 else float(i // 4)) for i in range(40)], "k int, v double").repartition(4)
    got, total = global_ranks(df, "k", {"V": F.col("v")})
    want = df.select("k", F.rank().over(Window.orderBy("v")).alias("r"))
    assert total == 40
    assert {r.k: r.V_RANK for r in got.collect()} == {r.k: r.r for r in want.collect()}


def test_measures_keep_their_types(spark):
    """Tiny, huge, fractional, text and missing values side by side, each by its own order."""
    rows = [(f"k{i:03d}", x, -i if i % 5 else None, f"t{i % 7}") for i, x in enumerate(
        [1e-7, 2e-7, 3e-7, 1e40, -1e40, float("nan"), float("nan"), 0.0, None, None] * 6)]
    df = spark.createDataFrame(rows, "k string, d double, n long, s string").persist()
    measures = ("d", "n", "s")
    got, total = global_ranks(df, "k", {m: F.col(m) for m in measures})
    want = df.select("k", *[c for m in measures for c in (
        F.row_number().over(Window.orderBy(m, "k")).alias(f"{m}_POSITION"), F.rank().over(Window.orderBy(m)).alias(f"{m}_RANK"))])
    assert total == 60
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
