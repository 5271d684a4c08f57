"""Ranks kept up to date from changes, against a sort of all rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from loomvault.plans import ranks
from loomvault.sources.tables import TableFolder


def place(v):
    """The order of values: NULL first, NaN last."""
    return (0, 0) if v is None else (2, 0) if math.isnan(v) else (1, v)


def plain(rows):
    order = sorted(rows.items(), key=lambda kv: (place(kv[1]), kv[0]))
    first = {}
    for number, (_, v) in enumerate(order, 1):
        first.setdefault(place(v), number)
    return [(k, number, first[place(v)]) for number, (k, v) in enumerate(order, 1)]


def read(tables):
    got, total = ranks.read_ranks(tables, "r", "id", "x")
    return sorted([(r.id, r.x_POSITION, r.x_RANK) for r in got.collect()], key=lambda r: r[1]), total


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_after_each_batch_equal_a_sort_of_all_rows(spark, folder, seed):
    rng = random.Random(seed)

    def value():  # a third of the rows share one value
        return rng.choice([5.0, 5.0, 5.0, None, math.nan, float(rng.randint(-9, 20)), rng.random() * 20, 0.0, 7.5])

    tables = TableFolder(spark, folder)
    now = {k: value() for k in range(400)}
    schema = "id long, x double"
    ranks.build_ranks(tables, "r", spark.createDataFrame(list(now.items()), schema), "id", F.col("x"), bins=8)
    assert read(tables) == (plain(now), len(now))
    for batch in range(1, 4):
        signed = []
        for k in rng.sample(range(500), 40):
            if k in now:
                signed.append((k, now.pop(k), -1))
            if rng.random() < 0.7:
                now[k] = value()
                signed.append((k, now[k], 1))
        feed = spark.createDataFrame(signed, schema + ", SIGN int")
        for _ in range(1 + (batch == 2)):  # a batch may run again
            ranks.change_ranks(tables, "r", feed, "id", F.col("x"), batch, bins=8)
        assert read(tables) == (plain(now), len(now))


def test_a_change_writes_its_bins_only(spark, folder):
    tables = TableFolder(spark, folder)
    ranks.build_ranks(tables, "r", spark.range(4000).selectExpr("id", "cast(id as double) x"), "id", F.col("x"), bins=16)
    before = set(tables.folders("r"))
    ranks.change_ranks(tables, "r", spark.createDataFrame([(10, 10.0, -1), (10, 10.5, 1)], "id long, x double, SIGN int"), "id", F.col("x"), 1, bins=16)
    assert len(before) == 16 and len(before & set(tables.folders("r"))) == 15
    text = ranks.read_ranks(tables, "r", "id", "x")[0]._jdf.queryExecution().toString()
    assert "Sort" not in text and "hashpartitioning" not in text


def test_bins_that_empty_grow_or_begin_from_nothing(spark, folder):
    tables = TableFolder(spark, folder)
    schema = "id long, x double"
    ranks.build_ranks(tables, "r", spark.createDataFrame([], schema), "id", F.col("x"), bins=4)
    assert read(tables) == ([], 0)
    now = {k: float(k % 50) for k in range(200)}
    feed = spark.createDataFrame([(k, v, 1) for k, v in now.items()], schema + ", SIGN int")
    ranks.change_ranks(tables, "r", feed, "id", F.col("x"), 1, bins=4)
    assert read(tables) == (plain(now), 200) and len(tables.folders("r")) == 4  # one bin had grown: all are cut anew
    ranks.change_ranks(tables, "r", feed.withColumn("SIGN", F.lit(-1)).where("x < 30"), "id", F.col("x"), 2, bins=4)
    now = {k: v for k, v in now.items() if v >= 30}
    assert read(tables) == (plain(now), len(now)) and len(tables.folders("r")) < 4
    ranks.change_ranks(tables, "r", feed.where("x = 3"), "id", F.col("x"), 3, bins=4)
    now.update({k: 3.0 for k in range(200) if k % 50 == 3})
    assert read(tables) == (plain(now), len(now))
