"""What jobs of several steps leave on disk: no step's shuffle files, no copy of all staged columns, digests as bytes in what is exchanged."""

import re
import time

from conftest import rows, same
from pyspark.sql import functions as F

from loomvault.functions.dates import at
from loomvault.functions.keys import packed, unpacked
from loomvault.operators.changes import change_feed
from loomvault.plans import deltas, staging
from loomvault.plans import warehouse as loaders
from loomvault.registry import change_queries as cq
from loomvault.session import REMOVE_SHUFFLED, stored
from loomvault.sources.tables import TableFolder
from loomvault.streaming import known, vault_stream

def late():
    return F.col("LOAD_DATETIME") >= at("1998-01-01 00:00:00")


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def left_by(spark, action):
    before = shuffle_files(spark)
    action()
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)  # they are removed beside the action
    return left


def counted(spark):
    return spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()


def test_a_stored_table_leaves_no_shuffle_files(spark, folder, monkeypatch):
    tables, frame = TableFolder(spark, folder), counted(spark)
    set_before = spark.conf.get(REMOVE_SHUFFLED)
    assert not left_by(spark, lambda: tables.replace("t", frame))
    assert not left_by(spark, lambda: tables.replace("parts", frame, "k"))
    assert not left_by(spark, lambda: stored(frame, "t"))
    assert spark.conf.get(REMOVE_SHUFFLED) == set_before
    assert rows(tables.read("t")) == rows(frame) == rows(tables.read("parts").select("k", "count").withColumn("k", F.col("k").cast("bigint")))
    assert all(".zstd." in f for f in tables.read("t").inputFiles() + tables.read("parts").inputFiles())


def test_digests_as_bytes_keep_their_order(spark):
    df = spark.range(300).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    assert [r.h for r in df.orderBy(packed(F.col("h"))).collect()] == [r.h for r in df.orderBy("h").collect()]
    same(df.select(unpacked(packed(F.col("h"))).alias("h")), df)


def test_batches_keep_no_copy_and_exchange_bytes(spark, warehouse, folder, monkeypatch):
    tables, held, widths = TableFolder(spark, folder), [], []
    monkeypatch.setattr(known, "fits_broadcast", lambda df: False)  # as with a batch of many keys

    def watched(load):
        def loading(staged, target=None):
            held.append(spark._jsc.sc().getPersistentRDDs().size())
            out = load(staged, target)
            if target is not None:
                widths.append(out._jdf.queryExecution().optimizedPlan().toString())
            return out
        return loading

    names = {**cq.VAULT_LOADERS, "eff_sat_customer_order": loaders.load_eff_sat_customer_order}
    kept = spark._jsc.sc().getPersistentRDDs().size()
    for batch, part in enumerate((warehouse.stg_orders.where(~late()), warehouse.stg_orders.where(late()))):
        vault_stream.load_batch(part, {n: watched(f) for n, f in names.items()}, tables, batch, {**cq.VAULT_KEYS, "eff_sat_customer_order": ("HK_LINK_CUSTOMER_ORDER", "IS_ACTIVE")}, buckets=4)
    assert set(held) == {kept} and len(widths) == len(names)
    for text in widths:
        assert "unhex" in text.split("Join")[-1]  # below the join with what is known
    for name in names:
        same(tables.read(name), getattr(warehouse, name))


def test_few_keys_are_found_without_an_exchange_of_all(spark, folder, monkeypatch):
    tables = TableFolder(spark, folder)
    many = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("K"), F.lit("2024-01-01").cast("timestamp_ntz").alias("LOAD_DATETIME"))
    known.learn(tables, "t", many, "K", None, 4)
    keys = many.select("K").union(many.select("K"))
    assert known.known_rows(tables, "t", keys.where("K in ('k1', 'k2', 'x')"), "K", 4).count() == 2
    assert known.known_rows(tables, "t", keys, "K", 4).count() == 5000
    monkeypatch.setattr(known, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(known, "FEW", 1)
    found = known.known_rows(tables, "t", keys.where("K < 'k3'"), "K", 4)
    assert {r.K for r in found.collect()} >= {r.K for r in many.where("K < 'k3'").collect()}


def test_revenue_keeps_no_copy_of_its_changes(spark, warehouse, folder):
    tables = TableFolder(spark, folder)
    feed = change_feed(warehouse.fct_orders.limit(0), warehouse.fct_orders, ["ORDER_SK"])
    kept = spark._jsc.sc().getPersistentRDDs().size()
    got = []
    left = left_by(spark, lambda: got.append(deltas.refresh_revenue(tables, feed, warehouse.dim_date, warehouse.as_of, 1, buckets=3)))
    assert tables.folders(deltas.CHANGES) is None and spark._jsc.sc().getPersistentRDDs().size() == kept
    assert not left
    same(got[0], warehouse.agg_monthly_revenue)


def test_bridge_of_batches_equals_the_whole(spark, warehouse, folder):
    """With digests as bytes and as text; a key of a batch that no link has changes nothing."""
    for digests in ((), loaders.LINK_DIGESTS):
        tables = TableFolder(spark, f"{folder}/{len(digests)}")
        for batch, part in enumerate((warehouse.stg_orders.where(~late()), warehouse.stg_orders.where(late()), warehouse.stg_orders.where(late()).limit(3))):
            links = warehouse.link_customer_order.join(warehouse.stg_orders.where(~late()).select("HK_ORDER"), "HK_ORDER", "left_semi") if not batch else warehouse.link_customer_order
            states = warehouse.eff_sat_customer_order.where(~late()) if not batch else warehouse.eff_sat_customer_order
            unknown = part.limit(1).withColumn("HK_LINK_CUSTOMER_ORDER", F.lit("0" * 64))
            out = deltas.refresh_bridge(tables, part.unionByName(unknown), "HK_LINK_CUSTOMER_ORDER", ["HK_CUSTOMER", "HK_ORDER"], links, states, "bridge", batch,
                                        ["ORDER_STATUS"], 4, digests)
        same(out.drop(known.BUCKET).withColumnRenamed("ORDER_STATUS", "EFF_ORDER_STATUS"), warehouse.bridge_customer_order)


def test_items_move_after_the_joins_of_their_orders(spark, warehouse):
    built = type(warehouse)(spark, warehouse.landing, warehouse.as_of, warehouse.calendar)
    assert not left_by(spark, lambda: built.fct_order_items)
    text = built.fct_order_items._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bJoin\b", text)) == 1  # none of the vault's
    want = warehouse.conformed_orders.select("ORDER_ID", "ORDER_DATE", "CURRENCY_CODE")
    same(built.item_orders, want)


def test_a_stateful_stream_exchanges_bytes(spark, warehouse):
    staged = staging.stage_orders(warehouse.landing.orders, warehouse.as_of)
    rows_ = staged.select("HK_ORDER", F.col("HD_ORDER_DETAILS").alias("HASH_DIFF"), "LOAD_DATETIME", "RECORD_SOURCE")
    out = vault_stream.stream_satellite_stateful(rows_, "HK_ORDER", digests=["HK_ORDER", "HASH_DIFF"])
    assert out.schema.simpleString() == rows_.schema.simpleString()
    assert out._jdf.queryExecution().analyzed().toString().count("unhex(") == 2
