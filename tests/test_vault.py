from conftest import rows, same
from pyspark.sql import functions as F

from loomvault import config, schemas
from loomvault.functions.dates import at
from loomvault.operators.segments import cut_points
from loomvault.plans import staging, vault
from loomvault.plans.warehouse import Landing, Warehouse, load_hub_customer, load_link_customer_order, load_sat_customer_demographics, load_sat_customer_details

DAY = "2024-01-{:02d} 00:00:00"


def staged(spark, data):
    df = spark.createDataFrame([(*r[:-1], r[-1]) for r in data], "HK string, HD string, SRC string, D int")
    day = F.concat(F.lit("2024-01-"), F.lpad(F.col("D").cast("string"), 2, "0")).cast("timestamp_ntz")
    return df.select("HK", "HD", day.alias("LOAD_DATETIME"), F.col("SRC").alias("RECORD_SOURCE"), F.concat("HK", "HD").alias("P"))


def versions_of(df):
    return [r[1] for r in sorted((r["LOAD_DATETIME"], r["HASH_DIFF"]) for r in df.collect())]


def load(df, target=None, **options):
    return vault.load_satellite(df, "HK", "HD", ["P"], target, **options)


def test_satellite_versions_in_one_batch(spark):
    batch = staged(spark, [("h", "A", "s", 1), ("h", "A", "s", 2), ("h", "B", "s", 3), ("h", "A", "s", 4)])
    sat = load(batch)
    assert versions_of(sat) == ["A", "B", "A"]
    assert load(batch, sat).count() == 0  # replay


def test_one_batch_equals_many(spark):
    import random
    rng = random.Random(3)
    data = [(f"h{rng.randint(0, 9)}", rng.choice("AB"), "s", d) for d in range(1, 29) for _ in range(6)]
    whole = load(staged(spark, data))
    for cut in (False, True):
        table = None
        for lo, hi in ((1, 5), (5, 6), (6, 20), (20, 29)):
            part = staged(spark, [r for r in data if lo <= r[3] < hi])
            new = load(part, table, cuts=cut_points(part, "HK", "LOAD_DATETIME", one_in=1, points=2) if cut else None)
            table = new if table is None else table.unionByName(new)
        same(whole, table)


def test_rows_older_than_the_stored_version_are_dropped(spark):
    stored = load(staged(spark, [("h", "A", "s", 10)]))
    late = load(staged(spark, [("h", "B", "s", 5), ("h", "A", "s", 11), ("h", "B", "s", 12), ("x", "Z", "s", 1)]), stored)
    assert sorted((r["HK"], r["HASH_DIFF"]) for r in late.collect()) == [("h", "B"), ("x", "Z")]


def test_hub_earliest_and_ties(spark):
    df = spark.createDataFrame([("h", "b1", "z"), ("h", "b1", "a")], "HK string, BK string, RECORD_SOURCE string").withColumn("LOAD_DATETIME", at(DAY.format(1)))
    hub = vault.load_hub(df, "HK", "BK")
    assert rows(hub, "HK", "RECORD_SOURCE") == [("h", "a")]
    assert vault.load_hub(df, "HK", "BK", hub).count() == 0


def test_high_water_mark_skips_late_keys(spark):
    def part(k, d):
        return spark.createDataFrame([(k, k, "s")], "HK string, BK string, RECORD_SOURCE string").withColumn("LOAD_DATETIME", at(DAY.format(d)))
    hub = vault.load_hub(part("a", 10), "HK", "BK")
    assert vault.load_hub(part("late", 5), "HK", "BK", hub).count() == 1
    assert vault.load_hub(part("late", 5), "HK", "BK", hub, use_high_water_mark=True).count() == 0


def test_blank_business_keys_are_not_loaded(spark):
    df = spark.createDataFrame([("h1", "a"), ("h2", ""), ("h3", None), ("h4", "  ")], "HK string, BK string").withColumns(
        {"LOAD_DATETIME": at(DAY.format(1)), "RECORD_SOURCE": F.lit("s")})
    assert rows(vault.load_hub(df, "HK", "BK"), "BK") == [("a",)]


def test_effectivity_flips(spark):
    def eff(states):
        df = spark.createDataFrame([("l", "c", "o", s, i + 1) for i, s in enumerate(states)], "L string, C string, O string, ORDER_STATUS string, D int")
        when = F.concat(F.lit("2024-01-"), F.lpad(F.col("D").cast("string"), 2, "0")).cast("timestamp_ntz")
        return vault.load_eff_satellite(df.withColumns({"LOAD_DATETIME": when, "RECORD_SOURCE": F.lit("s"), "ORDER_DATE": at(DAY.format(1))}),
                                        "L", ["C", "O"], "ORDER_STATUS", "ORDER_DATE")
    assert eff(["CONFIRMED", "CANCELLED", "CONFIRMED"]).count() == 3
    assert eff(["CONFIRMED", "SHIPPED"]).count() == 1
    ended = eff(["CONFIRMED", "REFUNDED"]).where("not IS_ACTIVE").select(F.col("EFFECTIVE_TO").cast("string")).first()[0]
    assert ended == DAY.format(2)


def test_pit_ghost_before_the_first_version(spark):
    hub = spark.createDataFrame([("h",)], "HK string").withColumn("LOAD_DATETIME", at(DAY.format(1)))
    sat = spark.createDataFrame([("h", "x")], "HK string, HASH_DIFF string").withColumn("LOAD_DATETIME", at(DAY.format(2)))
    pit = vault.load_pit(hub, "HK", {"S": sat}).select(F.col("S_LDTS").cast("string"), "S_HD").collect()
    assert sorted(map(tuple, pit)) == [(config.GHOST_TIME, config.GHOST_KEY), (DAY.format(2), "x")]


def test_snapshot_closes_changed_and_deleted_keys(spark):
    def source(data):
        df = spark.createDataFrame(data, "K string, V string, D int")
        return df.select("K", "V", F.concat(F.lit("2024-01-"), F.lpad(F.col("D").cast("string"), 2, "0")).cast("timestamp_ntz").alias("U"))
    first = vault.snapshot_scd2(None, source([("a", "1", 1), ("b", "1", 1), ("c", "1", 1)]), "K", "U", DAY.format(1))
    second = vault.snapshot_scd2(first, source([("a", "2", 5), ("b", "1", 1), ("d", "1", 5)]), "K", "U", DAY.format(6))
    got = {(r["K"], r["V"]): r["VALID_TO"] and str(r["VALID_TO"]) for r in second.collect()}
    assert got == {("a", "1"): DAY.format(5), ("a", "2"): None, ("b", "1"): None, ("c", "1"): DAY.format(6), ("d", "1"): None}
    third = vault.snapshot_scd2(second, source([("a", "2", 5), ("b", "1", 1), ("d", "1", 5)]), "K", "U", DAY.format(7))
    same(second, third)


def test_empty_batches_keep_the_schema(spark):
    wh = Warehouse(spark, Landing(*[spark.createDataFrame([], schemas.LANDING[n]) for n in ("RAW_CUSTOMERS", "RAW_ORDERS", "RAW_PRODUCTS", "RAW_ORDER_ITEMS")]), DAY.format(1))
    for name in ("hub_customer", "link_order_product", "sat_order_details", "eff_sat_customer_order", "pit_customer", "bridge_customer_order",
                 "conformed_orders", "conformed_customers", "fct_order_items", "agg_monthly_revenue", "agg_customer_ltv", "dp_product_performance"):
        frame = getattr(wh, name)
        assert frame.count() == 0 and frame.columns, name


# ---- worked example: two customers, two days ---------------------------------------------------
def _customers(spark, data):
    df = spark.createDataFrame(data, "CUSTOMER_ID string, FIRST_NAME string, EMAIL string, LOYALTY_TIER string, at string")
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schemas.RAW_CUSTOMERS if f.name not in df.columns}
    return df.withColumns(missing).withColumn("_LOADED_AT", F.col("at").cast("timestamp_ntz")).select(*schemas.RAW_CUSTOMERS.names)


def _orders(spark, data):
    df = spark.createDataFrame(data, "ORDER_ID string, CUSTOMER_ID string, TOTAL_AMOUNT double, at string")
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schemas.RAW_ORDERS if f.name not in df.columns}
    return df.withColumns(missing).withColumns({
        "_LOADED_AT": F.col("at").cast("timestamp_ntz"), "ORDER_DATE": F.col("at").cast("timestamp_ntz"), "TOTAL_AMOUNT": F.col("TOTAL_AMOUNT").cast("decimal(18,4)"),
    }).select(*schemas.RAW_ORDERS.names)


def test_worked_example(spark):
    one, two = "2026-04-23 10:00:00", "2026-04-24 09:00:00"
    day1 = _customers(spark, [("C100", "alice", "ali@m.com", "gold", one), ("C200", "bob", "bob@m.com", "silver", "2026-04-23 10:05:00")])
    day2 = _customers(spark, [("C100", "alice", "alice_new@m.com", "platinum", two)])
    orders1 = _orders(spark, [("O999", "C100", 25.0, one), ("O555", "C200", 90.0, "2026-04-23 10:05:00")])
    orders2 = _orders(spark, [(None, "C100", None, two)])
    s1, s2 = staging.stage_customers(day1, two), staging.stage_customers(day2, two)
    hub = load_hub_customer(s1)
    assert hub.count() == 2 and load_hub_customer(s2, hub).count() == 0
    o1, o2 = staging.stage_orders(orders1, two), staging.stage_orders(orders2, two)
    link = load_link_customer_order(o1)
    assert link.count() == 2 and load_link_customer_order(o2, link).count() == 0
    for load_sat in (load_sat_customer_details, load_sat_customer_demographics):
        sat = load_sat(s1)
        assert sat.unionByName(load_sat(s2, sat)).count() == 3
    empty = [spark.createDataFrame([], schemas.LANDING[n]) for n in ("RAW_PRODUCTS", "RAW_ORDER_ITEMS")]
    wh = Warehouse(spark, Landing(day1.unionByName(day2), orders1.unionByName(orders2), *empty), two)
    pit = wh.pit_customer_current.select("CUSTOMER_ID", F.col("SAT_DETAILS_LOAD_DT").cast("string"), F.col("SAT_DEMOGRAPHICS_LOAD_DT").cast("string"))
    assert rows(pit) == [("C100", two, two), ("C200", "2026-04-23 10:05:00", "2026-04-23 10:05:00")]
    assert [(a, float(b)) for a, b in rows(wh.dp_customer_360, "CUSTOMER_ID", "LIFETIME_REVENUE")] == [("C100", 25.0), ("C200", 90.0)]


def test_order_cancelled_later_is_not_counted(spark):
    orders = _orders(spark, [("o1", "c1", 10.0, "2024-01-01 00:00:00"), ("o2", "c1", 5.0, "2024-01-01 00:00:00")])
    first = orders.withColumn("ORDER_STATUS", F.lit("confirmed"))
    later = orders.where("ORDER_ID = 'o1'").withColumns({"ORDER_STATUS": F.lit("cancelled"), "_LOADED_AT": at("2024-01-05 00:00:00")})
    customers = _customers(spark, [("c1", "a", "a@b.com", "gold", "2024-01-01 00:00:00")])
    empty = [spark.createDataFrame([], schemas.LANDING[n]) for n in ("RAW_PRODUCTS", "RAW_ORDER_ITEMS")]
    wh = Warehouse(spark, Landing(customers, first.unionByName(later), *empty), "2024-02-01 00:00:00")
    row = wh.bv_customer_classification.first()
    assert row["TOTAL_ORDERS"] == 1 and float(row["TOTAL_REVENUE"]) == 5.0


def test_full_name_needs_both_parts(spark):
    customers = _customers(spark, [("c1", "ann", "a@b.com", "gold", "2024-01-01 00:00:00")])
    empty = [spark.createDataFrame([], schemas.LANDING[n]) for n in ("RAW_ORDERS", "RAW_PRODUCTS", "RAW_ORDER_ITEMS")]
    wh = Warehouse(spark, Landing(customers, *empty), "2024-02-01 00:00:00")
    row = wh.dim_customer.first()
    assert row["FULL_NAME"] is None and row["CHURN_RISK"] == "HIGH" and row["LTV_TIER"] == "NEW" and row["IS_ACTIVE"] is False


def raw_orders(spark):
    """Several versions of some orders, out of order and repeated, equal instants with differing rows, keys that are missing or blank."""
    data = [(f"o{k % 7}", f" c{k % 3}", ("new", "paid", None)[k * k % 3], k % 5 + 1, k % 4) for k in range(60)]
    data += [(None, "c1", "new", 1, 1), ("  ", "c1", "new", 2, 1), ("o9", None, "paid", 1, 2), ("O1 ", "c1", "PAID", 2, 0)]
    df = spark.createDataFrame(data, "ORDER_ID string, CUSTOMER_ID string, ORDER_STATUS string, D int, A int")
    nothing = {c: F.lit(None).cast("string") for c in ("SHIPPING_METHOD", "SHIPPING_ADDRESS", "BILLING_ADDRESS", "CURRENCY_CODE", "PAYMENT_METHOD", "_FILE_NAME")}
    day = F.concat(F.lit("2024-01-0"), F.col("D").cast("string")).cast("timestamp_ntz")
    return df.select("ORDER_ID", "CUSTOMER_ID", "ORDER_STATUS", day.alias("ORDER_DATE"), F.lit(None).cast("timestamp_ntz").alias("FULFILLMENT_DATE"),
                     F.col("A").cast("decimal(18,4)").alias("TOTAL_AMOUNT"), F.lit(None).cast("decimal(18,4)").alias("DISCOUNT_AMOUNT"),
                     F.lit(1).cast("decimal(18,4)").alias("TAX_AMOUNT"), *[c.alias(n) for n, c in nothing.items()],
                     day.alias("_LOADED_AT"), F.lit(1).cast("bigint").alias("_FILE_ROW_NUMBER"))


def test_late_digests_give_the_same_rows(spark):
    from loomvault.plans import warehouse as loaders
    orders = staging.stage_orders(raw_orders(spark), "2024-02-01 00:00:00")
    undated = orders.withColumn("LOAD_DATETIME", F.when(F.col("CUSTOMER_ID") == "C1", F.lit(None).cast("timestamp_ntz")).otherwise(F.col("LOAD_DATETIME")))
    for staged_rows in (orders, undated):
        same(loaders.load_hub_order(staged_rows), loaders.load_hub_order(staged_rows, late=staging.ORDERS))
        same(load_link_customer_order(staged_rows), load_link_customer_order(staged_rows, late=staging.ORDERS))
    for load_sat, hashed in ((loaders.load_sat_order_details, staging.ORDER_DETAILS_HASHED), (loaders.load_sat_order_financials, staging.ORDER_FINANCIALS)):
        plain = load_sat(orders)
        same(plain.drop("ORDER_DATE"), load_sat(orders, hashed=hashed).drop("ORDER_DATE"))
        cuts = cut_points(orders, "ORDER_ID", "LOAD_DATETIME", one_in=1, points=2)
        same(plain.drop("ORDER_DATE"), load_sat(orders, hashed=hashed, cuts=cuts).drop("ORDER_DATE"))


def test_no_digest_is_made_before_a_first_load_is_exchanged(spark):
    from loomvault.plans import gold
    from loomvault.plans import warehouse as loaders
    orders = staging.stage_orders(raw_orders(spark), "2024-02-01 00:00:00")
    items = spark.createDataFrame([("i1", "o1", "p1", 1)], "ORDER_ITEM_ID string, ORDER_ID string, PRODUCT_ID string, Q int").select(
        "ORDER_ITEM_ID", "ORDER_ID", "PRODUCT_ID", F.col("Q").cast("decimal(10,0)").alias("QUANTITY"), F.col("Q").cast("decimal(18,4)").alias("UNIT_PRICE"),
        F.col("Q").cast("decimal(5,2)").alias("DISCOUNT_PERCENT"), F.col("Q").cast("decimal(18,4)").alias("LINE_TOTAL"), at(DAY.format(1)).alias("_LOADED_AT"),
        F.lit("f").alias("_FILE_NAME"), F.lit(1).cast("bigint").alias("_FILE_ROW_NUMBER"))
    w = Warehouse(spark, Landing(None, raw_orders(spark), None, items), "2024-02-01 00:00:00")
    facts = gold.fct_order_items(w.stg_order_items, orders.select("HK_ORDER", "ORDER_ID", "ORDER_DATE", "CURRENCY_CODE").hint("merge"))
    for df in (w.hub_order, w.link_customer_order, w.link_order_product, facts):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" in plan and "sha2(" not in plan[plan.index("Exchange hashpartitioning"):]
    lines = loaders.load_sat_order_details(orders, hashed=staging.ORDER_DETAILS_HASHED)._jdf.queryExecution().executedPlan().toString().split("\n")
    dealt = [i for i, line in enumerate(lines) if "REPARTITION_BY_COL" in line]  # the digest is made right above this exchange
    assert dealt and all("sha2(" in lines[i - 1] and "sha2(" not in lines[i + 1] for i in dealt)
    assert rows(facts, "ORDER_ID", "CURRENCY_CODE")[0][0] == "O1"


def test_a_link_of_children_is_dealt_before_it_is_aggregated(spark):
    """Its keys hardly repeat: a map-side aggregate would hold all of them, and spill."""
    from loomvault.plans import warehouse as loaders
    items = spark.range(400).select(
        F.concat(F.lit("I"), (F.col("id") % 150).cast("string")).alias("ORDER_ITEM_ID"), F.when(F.col("id") % 150 != 3, F.concat(F.lit("O"), (F.col("id") % 50).cast("string"))).alias("ORDER_ID"),
        F.concat(F.lit("P"), (F.col("id") % 10).cast("string")).alias("PRODUCT_ID"), F.when(F.col("id") % 150 != 7, at(DAY.format(1)) + F.make_dt_interval(F.col("id").cast("int"))).alias("LOAD_DATETIME"),
        F.lit(staging.ORDER_ITEMS).alias("RECORD_SOURCE"))
    from loomvault.functions.keys import hash_key
    keyed = items.withColumns({"HK_ORDER": hash_key(items, "ORDER_ID"), "HK_PRODUCT": hash_key(items, "PRODUCT_ID"),
                               "HK_LINK_ORDER_PRODUCT": hash_key(items, "ORDER_ID", "PRODUCT_ID", "ORDER_ITEM_ID")})
    link = loaders.load_link_order_product(keyed, late=staging.ORDER_ITEMS)
    same(link, loaders.load_link_order_product(keyed))
    assert link.count() == 149
    lines = link._jdf.queryExecution().executedPlan().toString().split("\n")
    moved = [i for i, line in enumerate(lines) if "Exchange" in line]
    assert len(moved) == 1 and not any("Aggregate" in line for line in lines[moved[0]:])
