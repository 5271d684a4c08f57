import random

from conftest import rows, same
from pyspark.sql import functions as F

from loomvault.operators import changes
from loomvault.streaming import cdc


def version(spark, seed):
    rng = random.Random(seed)
    keys = rng.sample(range(60), 40)
    return spark.createDataFrame([(k, rng.choice(["x", "y", None]), rng.randint(0, 2)) for k in keys], "k int, v string, n int")


def test_feed_reproduces_the_next_version(spark):
    for seed in range(3):
        a, b = version(spark, seed), version(spark, seed + 100)
        feed = changes.change_feed(a, b, ["k"])
        same(changes.feed_apply(a, feed, ["k"]), b)
        assert changes.change_feed(a, a, ["k"]).count() == 0
        assert changes.has_changes(feed) and not changes.has_changes(changes.change_feed(a, a, ["k"]))


def test_feed_shape(spark):
    a = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (4, "x")], "k int, v string")
    feed = changes.change_feed(a, b, ["k"])
    assert rows(feed, "k", "v", changes.ACTION, changes.IS_UPDATE) == [
        (2, "x", "DELETE", True), (2, "y", "INSERT", True), (3, "x", "DELETE", False), (4, "x", "INSERT", False)]
    assert feed.where("k = 2").select(changes.ROW_ID).distinct().count() == 1
    assert rows(changes.change_feed(a, b, ["k"], append_only=True), "k") == [(4,)]
    assert changes.initial_rows(a, ["k"]).where("_ACTION = 'INSERT' and not _IS_UPDATE").count() == 3


def test_merge_ignores_unflagged_matches_and_deletes(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (3, "old")], "k int, v string")
    feed = spark.createDataFrame([(1, "new", "INSERT", True), (2, "new", "INSERT", False), (3, "old", "DELETE", False), (4, "new", "INSERT", False)],
                                 "k int, v string, _ACTION string, _IS_UPDATE boolean").withColumn("_ROW_ID", F.lit("r"))
    assert rows(changes.cdc_merge(target, feed, ["k"])) == [(1, "new"), (2, "old"), (3, "old"), (4, "new")]
    assert rows(changes.feed_apply(target, feed.where("k = 3"), ["k"])) == [(1, "old"), (2, "old")]


def test_log_with_images(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    log = spark.createDataFrame([
        ("UPDATE", "2024-01-01 00:00:00", "1", '{"k":1,"v":"a"}', '{"k":1,"v":"c"}'), ("UPDATE", "2024-01-01 00:00:00", "2", '{"k":1,"v":"c"}', '{"k":1,"v":"d"}'),
        ("DELETE", "2024-01-02 00:00:00", "3", '{"k":2,"v":"b"}', None), ("INSERT", "2024-01-02 00:00:00", "4", None, '{"k":3,"v":null}'),
    ], "CDC_OPERATION string, CDC_TIMESTAMP string, LSN string, RECORD_BEFORE string, RECORD_AFTER string").withColumn("CDC_TIMESTAMP", F.col("CDC_TIMESTAMP").cast("timestamp_ntz"))
    assert rows(cdc.apply_log(target, log, ["k"])) == [(1, "d"), (3, None)]


def test_dead_letters_and_envelopes(spark):
    text = '{"operation":"INSERT","after":{"id":7},"timestamp":"2024-01-01T00:00:00","transaction_id":"t","lsn":"9","source":{"db":"d","schema":"s","table":"orders"}}'
    df = spark.createDataFrame([(text,), ("{broken",), ("",)], "value string")
    good, bad = cdc.split_dead_letters(df, "value")
    assert (good.count(), bad.count()) == (1, 2)
    row = cdc.open_envelopes(good, "value").first()
    assert (row["SOURCE_TABLE"], row["CDC_OPERATION"], row["LSN"], row["RECORD_AFTER"], row["RECORD_BEFORE"]) == ("orders", "INSERT", "9", '{"id":7}', None)


def test_an_update_of_microseconds_is_a_change(spark):
    from loomvault.operators.changes import change_feed
    one = spark.sql("select 1 id, timestamp_ntz'2020-01-01 00:00:00.000001' t")
    two = spark.sql("select 1 id, timestamp_ntz'2020-01-01 00:00:00.000002' t")
    assert sorted(r._ACTION for r in change_feed(one, two, ["id"]).collect()) == ["DELETE", "INSERT"]
    assert change_feed(one, one, ["id"]).collect() == []


def test_null_keys_are_compared_as_values(spark):
    a = spark.createDataFrame([(1, None, "x"), (None, "k", "x"), (None, None, "x")], "k int, l string, v string")
    b = spark.createDataFrame([(1, None, "y"), (None, "k", "x"), (2, None, "x")], "k int, l string, v string")
    keys = ["k", "l"]
    assert changes.change_feed(a, a, keys).count() == 0 and changes.feed_apply(a, changes.change_feed(a, a, keys), keys).count() == 3
    feed = changes.change_feed(a, b, keys)
    assert rows(feed, "k", "l", "v", changes.ACTION, changes.IS_UPDATE) == sorted([
        (1, None, "x", "DELETE", True), (1, None, "y", "INSERT", True), (None, None, "x", "DELETE", False), (2, None, "x", "INSERT", False)], key=str)
    same(changes.feed_apply(a, feed, keys), b)
    assert rows(changes.change_feed(a, b, keys, append_only=True), "k", "l") == [(2, None)]
    assert rows(changes.cdc_merge(a, feed, keys)) == sorted([(1, None, "y"), (None, "k", "x"), (None, None, "x"), (2, None, "x")], key=str)
    assert changes.merge_upsert(a, b, keys).count() == 4
