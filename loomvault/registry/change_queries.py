"""Change data capture and streaming queries."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import at
from ..operators import changes, history
from ..operators.observe import error_trend_hourly
from ..plans import warehouse as loaders
from ..operators.ranking import ntile_of, percent_rank_of
from ..plans import deltas, ranks, staging
from ..plans.run import KEYED
from ..session import scratch_path, shuffles_removed
from ..sources import testbed
from ..sources.tables import TableFolder
from ..sources.testbed import AS_OF_EVENTS, table
from ..streaming import apply, cdc, ingest, vault_stream
from .base import CTES, doubles, query
from .ctes import AS_OF_EVENTS as NOW_SQL

# ---- two versions of a keyed table: customers before and after a re-rating, one unchanged row without a key ------------------
CTES["customers_before"] = """SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 10 <> 0
UNION ALL SELECT NULL, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey = 1"""
CTES["customers_after"] = """SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer WHERE c_custkey % 7 <> 0
UNION ALL SELECT NULL, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey = 1"""
KEY = ["c_custkey"]


def versions(spark, folder):
    base = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    key = F.col("c_custkey")
    after = base.where(key % 7 != 0).withColumn("c_acctbal", F.when(key % 3 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    nameless = base.where(key == 1).withColumn("c_custkey", F.lit(None).cast(base.schema["c_custkey"].dataType))
    return base.where(key % 10 != 0).unionByName(nameless), after.unionByName(nameless)


FEED_SQL = """SELECT a.*, 'INSERT' AS _ACTION, b.c_custkey IS NOT NULL AS _IS_UPDATE, sha256(CAST(a.c_custkey AS VARCHAR)) AS _ROW_ID
FROM customers_after a LEFT JOIN customers_before b ON a.c_custkey = b.c_custkey WHERE a.c_custkey IS NOT NULL AND (b.c_custkey IS NULL OR a.c_acctbal IS DISTINCT FROM b.c_acctbal)
UNION ALL SELECT b.*, 'DELETE', a.c_custkey IS NOT NULL, sha256(CAST(b.c_custkey AS VARCHAR))
FROM customers_before b LEFT JOIN customers_after a ON a.c_custkey = b.c_custkey WHERE b.c_custkey IS NOT NULL AND (a.c_custkey IS NULL OR a.c_acctbal IS DISTINCT FROM b.c_acctbal)"""


@query("change_feed", FEED_SQL)
def change_feed(w, spark, folder):
    return changes.change_feed(*versions(spark, folder), KEY)


@query("change_feed_append_only", """SELECT a.*, 'INSERT' AS _ACTION, false AS _IS_UPDATE, sha256(CAST(a.c_custkey AS VARCHAR)) AS _ROW_ID
FROM customers_after a WHERE NOT EXISTS (SELECT 1 FROM customers_before b WHERE b.c_custkey IS NOT DISTINCT FROM a.c_custkey)""")
def change_feed_append_only(w, spark, folder):
    return changes.change_feed(*versions(spark, folder), KEY, append_only=True)


@query("ranks_after_change", """SELECT c_custkey, c_acctbal, row_number() OVER by_balance AS POSITION, rank() OVER (ORDER BY c_acctbal NULLS FIRST) AS RANK,
  CAST(ntile(5) OVER by_balance AS INTEGER) AS QUINTILE, percent_rank() OVER (ORDER BY c_acctbal NULLS FIRST) AS PERCENT_RANK
FROM customers_after WINDOW by_balance AS (ORDER BY c_acctbal NULLS FIRST, c_custkey NULLS FIRST)""")
def ranks_after_change(w, spark, folder):
    """Ranks of balances stored for the first version of customers, then changed by what the second one changes."""
    tables = TableFolder(spark, scratch_path(spark, "ranks"))
    before, after = versions(spark, folder)
    balance = F.col("c_acctbal")
    ranks.build_ranks(tables, "balance", before, "c_custkey", balance, bins=16)
    signed = changes.change_feed(before, after, KEY).withColumn(ranks.SIGN, F.when(F.col("_ACTION") == "INSERT", 1).otherwise(-1))
    ranks.change_ranks(tables, "balance", signed, "c_custkey", balance, batch=1, bins=16)
    now, total = ranks.read_ranks(tables, "balance", "c_custkey", "c_acctbal")
    position, rank = F.col("c_acctbal_POSITION"), F.col("c_acctbal_RANK")
    return now.select("c_custkey", "c_acctbal", position.alias("POSITION"), rank.alias("RANK"), ntile_of(position, total, 5).alias("QUINTILE"),
                      percent_rank_of(rank, total).alias("PERCENT_RANK"))


@query("feed_apply", "SELECT * FROM customers_after")
def feed_apply(w, spark, folder):
    before, after = versions(spark, folder)
    return changes.feed_apply(before, changes.change_feed(before, after, KEY), KEY)


@query("merge_upsert", """SELECT * FROM customers_after UNION ALL SELECT * FROM customers_before b WHERE NOT EXISTS (SELECT 1 FROM customers_after a WHERE a.c_custkey IS NOT DISTINCT FROM b.c_custkey)""")
def merge_upsert(w, spark, folder):
    before, after = versions(spark, folder)
    return changes.merge_upsert(before, after, KEY)


@query("cdc_merge", """SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, coalesce(a.c_nationkey, b.c_nationkey) AS c_nationkey, coalesce(a.c_acctbal, b.c_acctbal) AS c_acctbal,
  coalesce(a.c_mktsegment, b.c_mktsegment) AS c_mktsegment FROM customers_before b FULL JOIN customers_after a ON a.c_custkey IS NOT DISTINCT FROM b.c_custkey""")
def cdc_merge(w, spark, folder):
    before, after = versions(spark, folder)
    return changes.cdc_merge(before, changes.change_feed(before, after, KEY), KEY)


@query("stream_has_data", """SELECT (SELECT count(*) FROM customers_after a LEFT JOIN customers_before b USING (c_custkey) WHERE a.c_custkey IS NOT NULL AND (b.c_custkey IS NULL OR a.c_acctbal <> b.c_acctbal)) > 0 AS HAS_DATA""")
def stream_has_data(w, spark, folder):
    feed = changes.change_feed(*versions(spark, folder), KEY)
    return feed.limit(1).agg((F.count("*") > 0).alias("HAS_DATA"))


# ---- change log with before and after images -------------------------------------------------
IMAGE = ("CUSTOMER_ID", "EMAIL", "DATE_OF_BIRTH", "LOYALTY_TIER", "_LOADED_AT")
CTES["change_rows"] = """SELECT *, row_number() OVER (PARTITION BY CUSTOMER_ID ORDER BY _LOADED_AT, EMAIL, LOYALTY_TIER) AS n FROM raw_customers"""


def change_log(w):
    """Consecutive versions of a customer as INSERT and UPDATE, and a DELETE of every tenth customer."""
    rows = w.landing.customers.select(*IMAGE)
    image = F.to_json(F.struct(*IMAGE), cdc.JSON_OPTIONS)
    # the log position continues the order of versions that share an instant
    position = F.concat_ws("|", "EMAIL", F.coalesce("LOYALTY_TIER", F.lit("~")))
    imaged = rows.withColumns({"RECORD_AFTER": image, "LSN": position})
    seen = history.previous_of(imaged, "CUSTOMER_ID", ["_LOADED_AT", "LSN"], {"RECORD_BEFORE": "RECORD_AFTER"})
    changed = seen.select(
        F.when(F.col("RECORD_BEFORE").isNull(), "INSERT").otherwise("UPDATE").alias("CDC_OPERATION"),
        F.col("_LOADED_AT").alias("CDC_TIMESTAMP"), "LSN", "RECORD_BEFORE", "RECORD_AFTER",
    )
    number = F.regexp_extract("CUSTOMER_ID", r"(\d+)", 1).cast("bigint")
    first = history.earliest_per_key(imaged.where(number % 10 == 0), "CUSTOMER_ID", ["_LOADED_AT", "LSN"])
    removed = first.select(
        F.lit("DELETE").alias("CDC_OPERATION"), at("2024-02-01 00:00:00").alias("CDC_TIMESTAMP"), F.lit("z").alias("LSN"),
        F.col("RECORD_AFTER").alias("RECORD_BEFORE"), F.lit(None).cast("string").alias("RECORD_AFTER"),
    )
    return changed.unionByName(removed)


@query("cdc_apply", """SELECT CUSTOMER_ID, EMAIL, DATE_OF_BIRTH, LOYALTY_TIER, _LOADED_AT FROM raw_customers
WHERE CAST(regexp_extract(CUSTOMER_ID, '(\\d+)', 1) AS BIGINT) % 10 <> 0
QUALIFY row_number() OVER (PARTITION BY CUSTOMER_ID ORDER BY _LOADED_AT DESC, concat_ws('|', EMAIL, coalesce(LOYALTY_TIER, '~')) DESC) = 1""")
def cdc_apply(w, spark, folder):
    target = w.landing.customers.select(*IMAGE).where(F.col("_LOADED_AT") < at("1996-01-01 00:00:00"))
    return cdc.apply_log(target, change_log(w), ["CUSTOMER_ID"])


def envelopes(spark, folder):
    """Orders and customers as change envelopes; every 50th text is cut off and no longer JSON."""
    stamp = F.lit("2024-01-05T00:00:00")

    def wrap(df, key, name):
        return df.select(F.to_json(F.struct(
            F.when(F.col(key) % 9 == 0, "UPDATE").otherwise("INSERT").alias("operation"), F.struct(*df.columns).alias("after"),
            stamp.alias("timestamp"), F.col(key).cast("string").alias("transaction_id"), F.lpad(F.col(key).cast("string"), 10, "0").alias("lsn"),
            F.struct(F.lit("shop").alias("db"), F.lit("public").alias("schema"), F.lit(name).alias("table")).alias("source"),
        )).alias("text"), F.col(key).alias("id"))

    both = wrap(table(spark, folder, "customer").select("c_custkey", "c_mktsegment"), "c_custkey", "customers").unionByName(
        wrap(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "orders"))
    return both.withColumn("text", F.when(F.col("id") % 50 == 49, F.left("text", F.lit(20))).otherwise(F.col("text")))


ENVELOPES_SQL = """SELECT id, tbl, CASE WHEN id % 9 = 0 THEN 'UPDATE' ELSE 'INSERT' END AS op, tbl || id AS uid FROM (
  SELECT c_custkey AS id, 'customers' AS tbl FROM customer UNION ALL SELECT o_orderkey, 'orders' FROM orders)"""
CTES["envelope_rows"] = ENVELOPES_SQL


@query("cdc_route", """SELECT 'shop' AS SOURCE_DATABASE, 'public' AS SOURCE_SCHEMA, tbl AS SOURCE_TABLE, op AS CDC_OPERATION, TIMESTAMP '2024-01-05 00:00:00' AS CDC_TIMESTAMP,
  CAST(id AS VARCHAR) AS TRANSACTION_ID, lpad(CAST(id AS VARCHAR), 10, '0') AS LSN, tbl AS ROUTE FROM envelope_rows WHERE id % 50 <> 49""")
def cdc_route(w, spark, folder):
    good, _ = cdc.split_dead_letters(envelopes(spark, folder), "text")
    routed = cdc.route(cdc.open_envelopes(good, "text"), ["customers", "orders"])
    parts = [df.drop("RECORD_BEFORE", "RECORD_AFTER").withColumn("ROUTE", F.lit(t)) for t, df in routed.items()]
    return parts[0].unionByName(parts[1])


@query("dead_letter_split", """SELECT id % 50 <> 49 AS PARSED, count(*) AS N, min(id) AS FIRST_ID, max(id) AS LAST_ID FROM envelope_rows GROUP BY 1""")
def dead_letter_split(w, spark, folder):
    good, bad = cdc.split_dead_letters(envelopes(spark, folder), "text")
    both = good.withColumn("PARSED", F.lit(True)).unionByName(bad.withColumn("PARSED", F.lit(False)))
    return both.groupBy("PARSED").agg(F.count("*").alias("N"), F.min("id").alias("FIRST_ID"), F.max("id").alias("LAST_ID"))


CTES["error_event_log"] = """SELECT CAST(event_id AS VARCHAR) AS ERROR_ID, ts AS ERROR_TIMESTAMP, 'JOB_' || (user_id % 5) AS PROCEDURE_NAME, 'E' || (event_id % 7) AS ERROR_CODE,
  CASE WHEN value >= 50 THEN 'CRITICAL' ELSE 'ERROR' END AS SEVERITY FROM events WHERE event_type = 'error'"""
TREND = """SELECT date_trunc('hour', ERROR_TIMESTAMP) AS ERROR_HOUR, PROCEDURE_NAME, SEVERITY, count(*) AS ERROR_COUNT,
  array_to_string(list_sort(list(DISTINCT ERROR_CODE)), ',') AS ERROR_CODES FROM error_event_log {where} GROUP BY ALL"""


@query("error_trend_hourly", TREND.format(where=f"WHERE ERROR_TIMESTAMP >= {NOW_SQL} - INTERVAL 7 DAY"))
def error_trend(w, spark, folder):
    return error_trend_hourly(testbed.error_event_log(spark, folder), AS_OF_EVENTS)


# ---- streams over the given files -------------------------------------------------------------
def stream_of(spark, folder, name):
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


FILES = 8  # of each of the two folders, and of each trigger


@query("stream_ingest_events", """SELECT CASE WHEN event_id % 1000 <> 5 THEN CAST(event_id AS VARCHAR) END AS _OFFSET_TOKEN, user_id % 4 AS _PARTITION_ID, 'events' AS _TOPIC_NAME,
  ts AS _LOADED_AT, CASE WHEN event_id % 50 <> 49 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS K, event_id % 50 = 49 AS DEAD FROM events""")
def stream_ingest_events(w, spark, folder):
    """Every tenth event comes late; every seventh comes twice in the first batch and again in the second; some have no offset, some no JSON."""
    tables = TableFolder(spark, scratch_path(spark, "events"))
    events = testbed.event_texts(table(spark, folder, "events"))
    late = F.col("event_id") % 10 == 3
    again = (F.col("event_id") % 7 == 0) & F.col("_OFFSET_TOKEN").isNotNull()
    copies = F.explode(F.when(again, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    for number, part in ((1, events.where(~late).withColumn("_copy", copies).drop("_copy")), (2, events.where(late | again))):
        # a variant is delivered as text too
        part.withColumn("RECORD_METADATA", F.to_json("RECORD_METADATA")).drop("event_id").repartition(FILES).write.parquet(tables.path(f"delivered/{number}"))
    schema = spark.read.parquet(tables.path("delivered/1")).schema
    delivered = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES).parquet(tables.path("delivered/*"))
    ingest.stream_events(delivered.withColumn("RECORD_METADATA", F.parse_json("RECORD_METADATA")), tables, "raw_stream_events", tables.path("_checkpoint")).awaitTermination()
    good = tables.read("raw_stream_events").select(F.variant_get("RECORD_CONTENT", "$.k", "int").alias("K"), F.lit(False).alias("DEAD"), "*")
    bad = tables.read("raw_stream_events_dead_letters").select(F.lit(None).cast("int").alias("K"), F.lit(True).alias("DEAD"), "*")
    wanted = ["_OFFSET_TOKEN", "_PARTITION_ID", "_TOPIC_NAME", "_LOADED_AT", "K", "DEAD"]
    return good.select(*wanted).unionByName(bad.select(*wanted))


CTES["change_rows"] = """SELECT 'customers' AS tbl, c_custkey AS id, c_mktsegment AS v FROM customer UNION ALL SELECT 'orders', o_orderkey, o_orderstatus FROM orders"""
CHANGED = {name: apply.Target(name, T.StructType([T.StructField("ID", T.LongType()), T.StructField("VALUE", T.StringType())]), ["ID"])
           for name in ("customers", "orders")}


def change_texts(spark, folder):
    """Change envelopes of customers and orders in two deliveries.

    Every row is inserted, every 9th then updated, every 11th at last deleted. The updates and every tenth insert come in the second delivery, after
    the deletions; every 7th insert comes in both. Every 50th insert is cut off, and some customers' changes name a table that is not kept.
    """
    rows = table(spark, folder, "customer").select(F.lit("customers").alias("t"), F.col("c_custkey").alias("ID"), F.col("c_mktsegment").alias("VALUE")).unionByName(
        table(spark, folder, "orders").select(F.lit("orders").alias("t"), F.col("o_orderkey").alias("ID"), F.col("o_orderstatus").alias("VALUE")))

    def change(operation, day, value, name=F.col("t")):
        row = F.struct("ID", value.alias("VALUE"))
        images = [row.alias("before")] if operation == "DELETE" else [row.alias("after")]
        return F.to_json(F.struct(
            F.lit(operation).alias("operation"), *images, F.lit(f"2024-01-{day}T00:00:00").alias("timestamp"),
            F.lpad(F.col("ID").cast("string"), 12, "0").alias("lsn"), F.struct(F.lit("shop").alias("db"), name.alias("table")).alias("source")))

    inserts = change("INSERT", "05", F.col("VALUE"))
    cut = F.col("ID") % 50 == 49
    late = F.col("ID") % 10 == 3
    first = [rows.where(~late).select(F.when(cut, F.left(inserts, F.lit(20))).otherwise(inserts).alias("text")),
             rows.where("ID % 11 = 0").select(change("DELETE", "07", F.col("VALUE")).alias("text")),
             rows.where("t = 'customers' AND ID % 100 = 1").select(change("INSERT", "05", F.col("VALUE"), F.lit("ghosts")).alias("text"))]
    second = [rows.where("ID % 9 = 0").select(change("UPDATE", "06", F.concat("VALUE", F.lit("*"))).alias("text")),
              rows.where(late | ((F.col("ID") % 7 == 0) & ~cut)).select(inserts.alias("text"))]
    return first[0].unionByName(first[1]).unionByName(first[2]), second[0].unionByName(second[1])


@query("stream_cdc_apply", """SELECT tbl AS SOURCE_TABLE, id AS ID, CASE WHEN id % 9 = 0 THEN v || '*' ELSE v END AS VALUE, NULL AS REASON
  FROM change_rows WHERE id % 11 <> 0 AND (id % 50 <> 49 OR id % 9 = 0)
UNION ALL SELECT NULL, NULL, NULL, 'NO_JSON' FROM change_rows WHERE id % 50 = 49
UNION ALL SELECT NULL, NULL, NULL, 'UNKNOWN_TABLE' FROM customer WHERE c_custkey % 100 = 1""")
def stream_cdc_apply(w, spark, folder):
    """One stream of changes kept in two tables, with repeats, late inserts of deleted rows, broken texts and an unknown table."""
    tables = TableFolder(spark, scratch_path(spark, "changes"))
    for number, part in enumerate(change_texts(spark, folder)):
        part.repartition(FILES).write.parquet(tables.path(f"delivered/{number}"))
    delivered = spark.readStream.schema("text string").option("maxFilesPerTrigger", FILES).parquet(tables.path("delivered/*"))
    apply.stream_apply(delivered, CHANGED, tables, tables.path("_checkpoint"), buckets=8).awaitTermination()
    none = F.lit(None).cast("string")
    kept = [apply.current(tables, t).select(F.lit(name).alias("SOURCE_TABLE"), "ID", "VALUE", none.alias("REASON")) for name, t in CHANGED.items()]
    dead = tables.read("changes_dead_letters").select(none.alias("SOURCE_TABLE"), F.lit(None).cast("bigint").alias("ID"), none.alias("VALUE"), "REASON")
    return kept[0].unionByName(kept[1]).unionByName(dead)


@query("stream_ingest_files", """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders WHERE o_orderstatus <> 'P'""")
def stream_ingest_files(w, spark, folder):
    """Orders written as delimited files; a broken row in the files of state P skips those files whole, those of state F have their columns the other way round."""
    from ..sources.formats import Stage
    tables = TableFolder(spark, scratch_path(spark, "files"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"))
    broken = orders.withColumn("o_custkey", F.when(F.col("o_orderstatus") == "P", "not a number").otherwise(F.col("o_custkey").cast("string")))
    for part in ("F", "O", "P"):
        columns = broken.columns[::-1] if part == "F" else broken.columns
        broken.where(F.col("o_orderstatus") == part).select(*columns).write.option("header", "true").option("sep", "|").csv(tables.path(f"landed/part={part}"))
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()),
                           T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_orderdate", T.DateType())])
    stage = Stage(tables.path("landed") + "/*", "csv_pipe", schema)
    ingest.stream_files(spark, stage, tables, "raw_orders", "SHOP", AS_OF_EVENTS, tables.path("_checkpoint")).awaitTermination()
    return tables.read("raw_orders").drop("_FILE_NAME", "_LOADED_AT")


VAULT_LOADERS = {
    "hub_order": partial(loaders.load_hub_order, late=staging.ORDERS),
    "link_customer_order": partial(loaders.load_link_customer_order, late=staging.ORDERS),
    "sat_order_details": partial(loaders.load_sat_order_details, hashed=staging.ORDER_DETAILS_HASHED),
    "sat_order_financials": partial(loaders.load_sat_order_financials, hashed=staging.ORDER_FINANCIALS),
}

VAULT_KEYS = {name: KEYED[name] for name in VAULT_LOADERS}


def raw_orders_in_two_folders(w, tables):
    """Landing rows in two folders of several files, older rows in the first."""
    raw = w.landing.orders
    late = F.col("_LOADED_AT") >= at("1998-01-01 00:00:00")
    for folder, part in ((1, raw.where(~late)), (2, raw.where(late))):
        with shuffles_removed(part.sparkSession):
            part.repartition(FILES).write.parquet(tables.path(f"landed/{folder}"), compression="zstd")
    return raw.schema


def stream_orders_vault(w, spark):
    tables = TableFolder(spark, scratch_path(spark, "vault"))
    schema = raw_orders_in_two_folders(w, tables)
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES).parquet(tables.path("landed/*"))
    vault_stream.stream_load_vault(
        raw, lambda batch: staging.stage_orders(batch, w.as_of), VAULT_LOADERS, tables, tables.path("_checkpoint"), keyed=VAULT_KEYS, buckets=8).awaitTermination()
    return tables


@query("stream_load_vault", doubles("sat_order_details"))
def stream_load_vault(w, spark, folder):
    return stream_orders_vault(w, spark).read("sat_order_details").select(*w.sat_order_details.columns)


CTES["pit_product_refreshed"] = """SELECT p.HK_PRODUCT, p.t AS PIT_LOAD_DATETIME, d.LOAD_DATETIME AS DETAILS_LDTS, d.HASH_DIFF AS DETAILS_HD,
  r.LOAD_DATETIME AS PRICING_LDTS, r.HASH_DIFF AS PRICING_HD
FROM (SELECT HK_PRODUCT, LOAD_DATETIME AS t FROM hub_product UNION SELECT HK_PRODUCT, LOAD_DATETIME FROM sat_product_details
      UNION SELECT HK_PRODUCT, LOAD_DATETIME FROM sat_product_pricing) p
ASOF LEFT JOIN sat_product_details d ON p.HK_PRODUCT = d.HK_PRODUCT AND p.t >= d.LOAD_DATETIME
ASOF LEFT JOIN sat_product_pricing r ON p.HK_PRODUCT = r.HK_PRODUCT AND p.t >= r.LOAD_DATETIME"""


@query("refresh_to_lag", doubles("pit_product_refreshed"))
def refresh_to_lag(w, spark, folder):
    """PIT built from early products, then only the keys of the late batch rebuilt."""
    tables = TableFolder(spark, scratch_path(spark, "refresh"))
    late = F.col("LOAD_DATETIME") >= at("1998-01-01 00:00:00")
    chosen = {"hub_product": loaders.load_hub_product, "sat_product_details": loaders.load_sat_product_details,
              "sat_product_pricing": loaders.load_sat_product_pricing}
    satellites = {"DETAILS": "sat_product_details", "PRICING": "sat_product_pricing"}
    for batch, part in enumerate((w.stg_products.where(~late), w.stg_products.where(late))):
        vault_stream.load_batch(part, chosen, tables, batch)
        vault_stream.refresh_pit(tables, part, "HK_PRODUCT", "hub_product", satellites, "pit_product", buckets=8)
    return tables.read("pit_product").drop(vault_stream.BUCKET)


def earlier_orders(after):
    """Orders as they were before: some are new since, some were of another amount, customer or state, some are gone."""
    number = F.regexp_extract("ORDER_ID", r"(\d+)", 1).cast("bigint")
    before = after.where(number % 5 != 0).withColumns({
        "TOTAL_AMOUNT": F.when(number % 7 == 0, F.col("TOTAL_AMOUNT") + 1).otherwise(F.col("TOTAL_AMOUNT")).cast(after.schema["TOTAL_AMOUNT"].dataType),
        "HK_CUSTOMER": F.when(number % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("HK_CUSTOMER")),
        "ORDER_STATUS": F.when(number % 13 == 0, "CANCELLED").otherwise(F.col("ORDER_STATUS")),
    })
    gone = before.where(number % 3 == 0).withColumn("ORDER_SK", F.concat(F.lit("gone-"), "ORDER_SK"))
    return before.unionByName(gone)


@query("refresh_revenue_to_lag", doubles("agg_monthly_revenue"))
def refresh_revenue_to_lag(w, spark, folder):
    """Monthly revenue of an earlier state of all orders, brought up to date by the changes alone; the second batch runs twice."""
    tables = TableFolder(spark, scratch_path(spark, "revenue"))
    columns = ["ORDER_SK", *deltas.REVENUE_COLUMNS]  # a change of others changes no revenue
    after = tables.replace("after", w.fct_orders.select("ORDER_ID", *columns))  # the orders are made once; the earlier state is made of the stored rows
    before, after = earlier_orders(after).select(*columns), after.select(*columns)
    first = changes.change_feed(before.limit(0), before, ["ORDER_SK"])
    deltas.refresh_revenue(tables, first, w.dim_date, w.as_of, 1, buckets=8)
    for _ in range(2):
        out = deltas.refresh_revenue(tables, changes.change_feed(before, after, ["ORDER_SK"]), w.dim_date, w.as_of, 2, buckets=8)
    return out


@query("refresh_bridge_to_lag", doubles("bridge_customer_order", texts=("EFFECTIVE_TO",)))
def refresh_bridge_to_lag(w, spark, folder):
    """The bridge of early orders, then only the links of the late batch rebuilt."""
    tables = TableFolder(spark, scratch_path(spark, "bridge"))
    late = F.col("LOAD_DATETIME") >= at("1998-01-01 00:00:00")
    chosen = {"link_customer_order": VAULT_LOADERS["link_customer_order"], "eff_sat_customer_order": loaders.load_eff_sat_customer_order}
    for batch, part in enumerate((w.stg_orders.where(~late), w.stg_orders.where(late))):
        vault_stream.load_batch(part, chosen, tables, batch, KEYED, buckets=8)
        out = deltas.refresh_bridge(tables, part, "HK_LINK_CUSTOMER_ORDER", ["HK_CUSTOMER", "HK_ORDER"], tables.read("link_customer_order"),
                                    tables.read("eff_sat_customer_order"), "bridge", batch, ["ORDER_STATUS"], buckets=8, digests=loaders.LINK_DIGESTS)
    return out.drop(vault_stream.BUCKET).withColumnRenamed("ORDER_STATUS", "EFF_ORDER_STATUS").select(*w.bridge_customer_order.columns)


@query("stream_satellite_stateful", """SELECT HK_ORDER, HASH_DIFF, ORDER_STATUS, LOAD_DATETIME, RECORD_SOURCE FROM sat_order_details""")
def stream_satellite_stateful(w, spark, folder):
    tables = TableFolder(spark, scratch_path(spark, "stateful"))
    schema = raw_orders_in_two_folders(w, tables)
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES).parquet(tables.path("landed/*"))
    rows = staging.stage_orders(raw, w.as_of).select("HK_ORDER", F.col("HD_ORDER_DETAILS").alias("HASH_DIFF"), "ORDER_STATUS", "LOAD_DATETIME", "RECORD_SOURCE")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        out = vault_stream.stream_satellite_stateful(rows, "HK_ORDER", digests=["HK_ORDER", "HASH_DIFF"])
        with shuffles_removed(spark):  # the stream takes the settings it starts with: a batch's rows go when the batch ends
            (out.writeStream.foreachBatch(lambda batch, n: tables.append("sat", batch, n)).outputMode("append")
             .option("checkpointLocation", tables.path("_checkpoint")).trigger(availableNow=True).start().awaitTermination())
    finally:
        spark.conf.set(provider, before)
    return tables.read("sat")
