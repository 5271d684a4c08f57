"""Several tables kept up to date from one stream of changes, against the batch form."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomvault.sources.tables import TableFolder
from loomvault.streaming import apply, cdc

from conftest import rows, same

ROW = T.StructType([T.StructField("K", T.LongType()), T.StructField("V", T.StringType()), T.StructField("N", T.DoubleType())])
TARGETS = {"a": apply.Target("table_a", ROW, ["K"]), "b": apply.Target("table_b", ROW, ["K"])}


def envelope(table, operation, day, lsn, key, value):
    row = {"K": key, "V": value, "N": None if value is None else len(value) / 2}
    return json.dumps({"operation": operation, "before": row if operation == "DELETE" else None, "after": None if operation == "DELETE" else row,
                       "timestamp": f"2024-01-{day:02d}T00:00:00", "lsn": f"{lsn:06d}", "source": {"db": "d", "schema": "s", "table": table}})


def changes(seed, n=300):
    """Changes of two tables in any order; keys repeat, one is missing and one has a third of all rows."""
    rng = random.Random(seed)
    keys = [None, *range(12)] + [99] * 6
    out = [envelope(rng.choice("ab"), rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]), rng.randint(1, 5), k, rng.choice(keys), rng.choice(["x", "yy", None]))
           for k in range(n)]
    rng.shuffle(out)
    return out


def start(spark):
    return spark.createDataFrame([(k, "old", 1.5) for k in (1, 2, 50, 99)] + [(None, "old", None)], ROW)


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_equal_the_whole_log(spark, folder, seed):
    tables = TableFolder(spark, folder)
    apply.seed(tables, TARGETS["a"], start(spark), buckets=4)
    every = changes(seed)
    parts = [every[:120], every[100:200], [], every[200:] + every[:30]]
    for number, part in enumerate(parts):
        for _ in range(1 + (number == 1)):  # one batch runs twice
            apply.apply_batch(frame(spark, part), TARGETS, tables, number, buckets=4)
    log = cdc.open_envelopes(frame(spark, every), "text")
    for source, before in (("a", start(spark)), ("b", spark.createDataFrame([], ROW))):
        same(apply.current(tables, TARGETS[source]), cdc.apply_log(before, log.where(F.col("SOURCE_TABLE") == source), ["K"]))
    counts = {(r.BATCH_ID, r.SOURCE_TABLE): r.EVENTS for r in tables.read("changes_commits").collect()}
    assert [sum(n for (b, _), n in counts.items() if b == k) for k in range(4)] == [len(p) for p in parts]
    assert tables.read("changes_dead_letters").count() == 0


def test_a_batch_that_failed_between_its_tables_runs_again(spark, folder, monkeypatch):
    tables = TableFolder(spark, folder)
    apply.apply_batch(frame(spark, [envelope("a", "INSERT", 1, 1, 1, "x"), envelope("b", "INSERT", 1, 1, 1, "x")]), TARGETS, tables, 0, buckets=2)
    second = frame(spark, [envelope("a", "DELETE", 2, 2, 1, "x"), envelope("a", "INSERT", 2, 3, 2, "new"), envelope("b", "UPDATE", 2, 2, 1, "yy")])
    whole = apply.apply_to

    def fail_at_b(log, target, *more):
        if target.name == "table_b":
            raise OSError("lost")
        whole(log, target, *more)

    monkeypatch.setattr(apply, "apply_to", fail_at_b)
    with pytest.raises(OSError):
        apply.apply_batch(second, TARGETS, tables, 1, buckets=2)
    assert rows(apply.current(tables, TARGETS["b"])) == [(1, "x", 0.5)]
    monkeypatch.undo()
    apply.apply_batch(second, TARGETS, tables, 1, buckets=2)
    assert rows(apply.current(tables, TARGETS["a"])) == [(2, "new", 1.5)] and rows(apply.current(tables, TARGETS["b"])) == [(1, "yy", 1.0)]


def test_events_that_cannot_be_applied_are_told_apart(spark, folder):
    tables = TableFolder(spark, folder)
    good = json.loads(envelope("a", "INSERT", 1, 1, 1, "x"))
    odd = {"NO_JSON": ["{", "", None], "UNKNOWN_TABLE": [{**good, "source": {"table": "z"}}, {**good, "source": None}, [1]],
           "UNKNOWN_OPERATION": [{**good, "operation": "TRUNCATE"}, {**good, "operation": None}],
           "NO_POSITION": [{**good, "timestamp": "soon"}, {**good, "lsn": None}], "NO_IMAGE": [{**good, "after": None}, {**good, "operation": "UPDATE", "after": None, "before": {"K": 1}}]}
    texts = [(reason, t if t is None or isinstance(t, str) else json.dumps(t)) for reason, many in odd.items() for t in many]
    apply.apply_batch(frame(spark, [json.dumps(good), *[t for _, t in texts]]), TARGETS, tables, 0, buckets=2)
    assert rows(tables.read("changes_dead_letters"), "REASON", "text") == sorted(texts, key=str)
    assert rows(apply.current(tables, TARGETS["a"])) == [(1, "x", 0.5)] and apply.current(tables, TARGETS["b"]).count() == 0


def test_a_batch_writes_the_buckets_of_its_keys_only(spark, folder):
    tables = TableFolder(spark, folder)
    apply.seed(tables, TARGETS["a"], spark.range(1000).select(F.col("id").alias("K"), F.lit("v").alias("V"), F.lit(0.0).alias("N")), buckets=16)
    before = set(tables.folders("table_a"))
    apply.apply_batch(frame(spark, [envelope("a", "UPDATE", 1, 1, 5, "new")]), TARGETS, tables, 0, buckets=16)
    assert len(before) == 16 and len(before & set(tables.folders("table_a"))) == 15
    assert apply.current(tables, TARGETS["a"]).where("V = 'new'").count() == 1 and apply.current(tables, TARGETS["a"]).count() == 1000
