import os

import pytest
from conftest import same
from pyspark.sql import functions as F

from loomvault.functions.dates import at
from loomvault.plans import staging
from loomvault.registry import change_queries as cq
from loomvault.sources.tables import TableFolder
from loomvault.streaming import ingest, vault_stream


def run(spark, tables, schema, as_of):
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", cq.FILES).parquet(tables.path("landed/*"))
    vault_stream.stream_load_vault(raw, lambda b: staging.stage_orders(b, as_of), cq.VAULT_LOADERS, tables, tables.path("_checkpoint")).awaitTermination()


def test_stream_equals_batch_and_restart_adds_nothing(spark, warehouse, folder):
    tables = TableFolder(spark, folder)
    schema = cq.raw_orders_in_two_folders(warehouse, tables)
    run(spark, tables, schema, warehouse.as_of)
    for name in cq.VAULT_LOADERS:
        same(tables.read(name), getattr(warehouse, name))
    counts = {n: tables.read(n).count() for n in cq.VAULT_LOADERS}
    run(spark, tables, schema, warehouse.as_of)
    assert counts == {n: tables.read(n).count() for n in cq.VAULT_LOADERS}


def test_a_batch_run_again_changes_nothing(spark, warehouse, folder):
    tables = TableFolder(spark, folder)
    late = F.col("LOAD_DATETIME") >= at("1998-01-01 00:00:00")
    staged = warehouse.stg_orders
    vault_stream.load_batch(staged.where(~late), cq.VAULT_LOADERS, tables, 0)
    for _ in range(2):
        vault_stream.load_batch(staged.where(late), cq.VAULT_LOADERS, tables, 1)
    for name in cq.VAULT_LOADERS:
        same(tables.read(name), getattr(warehouse, name))


@pytest.fixture
def no_codegen(spark):
    """Many small jobs over few rows: compiling them takes longer than running them."""
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_stored_run_in_two_batches_equals_the_lazy_frames(spark, warehouse, folder, no_codegen):
    from loomvault.plans.run import run_batch
    from loomvault.plans.warehouse import Landing
    tables = TableFolder(spark, folder)
    cut = at("1998-06-01 00:00:00")
    raw = warehouse.landing

    def part(keep):
        # all items arrive with the first batch, when many of their orders are not known yet
        return Landing(raw.customers.where(keep(F.col("_LOADED_AT"))), raw.orders.where(keep(F.col("_LOADED_AT"))),
                       raw.products.where(keep(F.col("_LOADED_AT"))), raw.order_items.where(keep(at("1996-01-01 00:00:00"))))

    first, second = part(lambda t: t < cut), part(lambda t: t >= cut)
    run_batch(spark, first, tables, warehouse.as_of, 1, warehouse.calendar, buckets=4, late_orders=True)
    waiting = tables.read("pending_order_items").count()
    assert 0 < waiting < raw.order_items.count()
    for _ in range(2 if os.environ.get("LOOMVAULT_ALL") else 1):  # the second batch may run again after it finished
        built = run_batch(spark, second, tables, warehouse.as_of, 2, warehouse.calendar, buckets=4, late_orders=True)
    for name in ("sat_customer_details", "pit_customer", "pit_order", "bridge_customer_order", "fct_orders", "fct_order_items",
                 "agg_monthly_revenue", "agg_customer_ltv"):
        same(getattr(built, name), getattr(warehouse, name))
    assert tables.read("pending_order_items").count() == warehouse.fct_order_items.where("ORDER_DATE is null").count()


def test_a_small_batch_reads_the_buckets_of_its_keys_only(spark, warehouse, folder):
    from loomvault.streaming import known
    tables = TableFolder(spark, folder)
    staged = warehouse.stg_orders
    vault_stream.load_batch(staged, cq.VAULT_LOADERS, tables, 0, cq.VAULT_KEYS, buckets=16)
    one = staged.limit(1).persist()
    keys = one.select("HK_ORDER").distinct()
    rows = known.known_rows(tables, "sat_order_details", keys, "HK_ORDER", 16)
    buckets = {f.split("KEY_BUCKET=")[1].split("/")[0] for f in rows.inputFiles()}
    assert len(buckets) == 1 and len(tables.folders("current_sat_order_details")) == 16
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "PushedFilters: [IsNotNull(HK_ORDER), EqualTo(HK_ORDER" in text
    assert rows.count() == warehouse.sat_order_details.join(keys, "HK_ORDER", "left_semi").count()
    many = staged.select("HK_ORDER").distinct()
    assert known.known_rows(tables, "hub_order", many, "HK_ORDER", 16).count() == warehouse.hub_order.count()


def test_known_rows_are_reduced_and_a_batch_may_run_again(spark, warehouse, folder, monkeypatch):
    from loomvault.streaming import known
    monkeypatch.setattr(known, "COMPACT", 1)
    tables = TableFolder(spark, folder)
    staged = warehouse.stg_orders
    late = F.col("LOAD_DATETIME") >= at("1998-01-01 00:00:00")
    for batch, part in ((0, staged.where(~late)), (1, staged.where(late)), (1, staged.where(late))):
        vault_stream.load_batch(part, cq.VAULT_LOADERS, tables, batch, cq.VAULT_KEYS, buckets=4)
    for name in cq.VAULT_LOADERS:
        same(tables.read(name), getattr(warehouse, name))
    assert tables.read("current_sat_order_details").count() == warehouse.hub_order.count()


def test_error_trend_stream(spark, folder):
    errors = spark.createDataFrame([("2024-01-01 00:10:00", "p", "E", "x"), ("2024-01-01 00:50:00", "p", "E", "y"), ("2024-01-01 09:00:00", "p", "E", "x")],
                                   "t string, PROCEDURE_NAME string, SEVERITY string, ERROR_CODE string").withColumn("ERROR_TIMESTAMP", F.col("t").cast("timestamp_ntz")).drop("t")
    errors.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(errors.schema).parquet(f"{folder}/in")
    q = ingest.error_trend_stream(stream).writeStream.format("memory").queryName("trend").outputMode("append").option(
        "checkpointLocation", f"{folder}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    got = [(str(r["ERROR_HOUR"]), r["ERROR_COUNT"], r["ERROR_CODES"]) for r in spark.table("trend").collect()]
    assert got == [("2024-01-01 00:00:00", 2, "x,y")]  # the last hour is not final yet


EVENT = "_OFFSET_TOKEN string, _PARTITION_ID long, _TOPIC_NAME string, RECORD_TEXT string"


def landed(tables):
    good = [(r._OFFSET_TOKEN, r._PARTITION_ID, r._TOPIC_NAME) for r in tables.read("e").collect()]
    bad = [(r._OFFSET_TOKEN, r.RECORD_TEXT) for r in tables.read("e_dead_letters").collect()]
    return sorted(good, key=str), sorted(bad, key=str)


def test_events_land_once_whatever_their_order_and_a_batch_may_run_again(spark, folder):
    tables = TableFolder(spark, folder)
    first = [(str(k), 0, "t", "{}") for k in (1, 2, 3, 3, 9)] + [("2", 1, "t", "{}"), ("2", 0, "u", "{}"), (None, 0, "t", "{}"), (None, 0, "t", "{}"),
             ("7", None, "t", "{}"), ("7", None, "t", "{}"), ("x-1", 0, "t", "{}"), ("x-1", 0, "t", "{}"), ("5", 0, "t", "no json"), ("5", 0, "t", "no json"), ("007", 0, "t", "{}")]
    second = [("2", 0, "t", "{}"), ("4", 0, "t", "{}"), ("5", 0, "t", "no json"), ("10", 0, "t", "{}"), ("x-1", 0, "t", "{}"), ("x-2", 0, "t", "{}"), (None, 0, "t", "{}"), ("007", 0, "t", "{}")]
    ingest.load_events(spark.createDataFrame(first, EVENT), tables, "e", 0)
    for _ in range(2):
        ingest.load_events(spark.createDataFrame(second, EVENT), tables, "e", 1)
    good, bad = landed(tables)
    want = [(str(k), 0, "t") for k in (1, 2, 3, 4, 9, 10)] + [("2", 1, "t"), ("2", 0, "u")] + [(None, 0, "t")] * 3 + [("7", None, "t")] * 2 + [
        ("x-1", 0, "t"), ("x-2", 0, "t"), ("007", 0, "t")]
    assert good == sorted(want, key=str) and bad == [("5", "no json")]
    spans = sorted((r.lane, r.low, r.high) for r in tables.snapshot("e_offsets", 9).collect())
    assert spans == [("0/t", 1, 5), ("0/t", 9, 10), ("0/u", 2, 2), ("1/t", 2, 2)]


def test_intervals_of_offsets_equal_a_plain_scan(spark):
    import random

    from loomvault.streaming import offsets
    for seed in range(3):
        rng = random.Random(seed)
        taken = {(lane, rng.randint(0, 60)) for lane in ("a", "b") for _ in range(40)}
        parts = [set(), set()]
        for t in taken:
            parts[rng.random() < 0.5].add(t)
        frames = [spark.createDataFrame(sorted(p), "lane string, offset long") for p in parts]
        both = offsets.joined(offsets.islands(frames[0]).unionByName(offsets.islands(frames[1])))
        spans = {(r.lane, k) for r in both.collect() for k in range(r.low, r.high + 1)}
        assert spans == taken
        assert both.count() == sum((lane, k - 1) not in taken for lane, k in taken)


def test_events_are_told_apart_once_and_not_looked_up_before_any_has_landed(spark, folder):
    from conftest import rows

    from loomvault.streaming import offsets
    data = [(str(k % 7), k % 2, "t", "{}") for k in range(40)] + [(None, 0, "t", "{}"), ("x", 0, "t", "{}")]
    events = offsets.with_offset(spark.createDataFrame(data, EVENT))
    none = spark.createDataFrame([], offsets.SCHEMA)
    numbered = offsets.each_once(events).persist()
    try:
        first = offsets.not_landed(events, None, numbered)
        assert rows(first) == rows(offsets.not_landed(events, none)) and first.count() == 16
        assert "Window" not in first._jdf.queryExecution().executedPlan().toString()
        later = offsets.not_landed(events, none, numbered)
        assert later._jdf.queryExecution().withCachedData().toString().count("Deduplicate") == 0  # it reads the stored ones
    finally:
        numbered.unpersist()


def test_no_event_leaves_no_interval(spark, folder):
    tables = TableFolder(spark, folder)
    ingest.load_events(spark.createDataFrame([], EVENT), tables, "e", 0)
    assert landed(tables) == ([], []) and tables.snapshot("e_offsets", 1).count() == 0


def test_stateful_satellite_by_buckets_equals_one_load(spark, folder):
    import random

    from conftest import rows

    from loomvault.plans import vault
    rng = random.Random(5)
    schema = "HK string, HASH_DIFF string, P string, LOAD_DATETIME timestamp_ntz, RECORD_SOURCE string"
    for part, days in ((1, (1, 12)), (2, (12, 28))):
        data = [(f"h{rng.randint(0, 30)}", rng.choice("ABC"), "p", f"2024-01-{rng.randrange(*days):02d} 00:00:00", rng.choice("st")) for _ in range(200)]
        data.append((None, "A", "p", f"2024-01-{days[0]:02d} 00:00:00", "s"))
        text = spark.createDataFrame(data, schema.replace("timestamp_ntz", "string"))
        text.withColumn("LOAD_DATETIME", F.col("LOAD_DATETIME").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{folder}/landed/{part}")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    tables, batches = TableFolder(spark, f"{folder}/tables"), []
    try:
        raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/landed/*")
        out = vault_stream.stream_satellite_stateful(raw, "HK", buckets=3)
        out.writeStream.foreachBatch(lambda df, n: (tables.append("sat", df, n), batches.append(n))).option("checkpointLocation", f"{folder}/c").trigger(
            availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(provider, before)
    whole = spark.read.schema(schema).parquet(f"{folder}/landed/*").withColumnRenamed("HASH_DIFF", "HD")
    want = vault.load_satellite(whole, "HK", "HD", ["P"])
    assert len(batches) == 2
    assert rows(tables.read("sat").select(*want.columns)) == rows(want)
