"""Governance, data quality, observability and file handling queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import at
from ..operators import governance as gov
from ..operators import observe, quality
from ..schemas import LANDING, SchemaDrift, assert_schema, sync_columns
from ..session import scratch_path
from ..sources import copy, drift, formats, testbed
from ..sources.tables import TableFolder, write_archive
from ..sources.testbed import AS_OF_EVENTS, table
from .base import CTES, doubles, query
from .ctes import AS_OF, AS_OF_EVENTS as NOW_SQL
from .ctes import SAT_COLUMNS

MASKED_EMAIL = "CASE WHEN regexp_matches({c}, '^.{{2}}.*@.*$') THEN regexp_replace({c}, '^(.{{2}})(.*)(@.*)$', '\\1***\\3') WHEN {c} IS NOT NULL THEN '***' END"


# ---- masks ------------------------------------------------------------------------------------
def _mask_query(name, column, masked_sql, mask):
    """Clear for a trusted role, masked for an analyst, side by side."""
    @query(name, f"SELECT CUSTOMER_ID, _LOADED_AT, {column} AS CLEAR, {masked_sql} AS MASKED FROM stg_customers")
    def run(w, spark, folder):
        trusted, analyst = mask(F.col(column), "PLATFORM_ADMIN"), mask(F.col(column), "ANALYST")
        return w.stg_customers.select("CUSTOMER_ID", "_LOADED_AT", trusted.alias("CLEAR"), analyst.alias("MASKED"))


_mask_query("mask_email", "EMAIL", MASKED_EMAIL.format(c="EMAIL"), gov.mask_email)
_mask_query("mask_phone", "PHONE", "'***-***-' || right(PHONE, 4)", gov.mask_phone)
_mask_query("mask_name", "LAST_NAME", "left(LAST_NAME, 1) || '****'", gov.mask_name)
_mask_query("mask_ssn", "POSTAL_CODE", "'***-**-****'", gov.mask_ssn)
_mask_query("mask_dob", "DATE_OF_BIRTH", "make_date(year(DATE_OF_BIRTH), 1, 1)", gov.mask_dob)
_mask_query("mask_address", "CITY", "'*** REDACTED ***'", gov.mask_address)


@query("mask_inline", f"""SELECT CUSTOMER_ID, _LOADED_AT, {MASKED_EMAIL.format(c='EMAIL')} AS EMAIL, '***-***-' || right(PHONE, 4) AS PHONE, left(LAST_NAME, 1) || '****' AS LAST_NAME,
  CITY AS CITY FROM stg_customers""")
def mask_inline(w, spark, folder):
    role = "DATA_STEWARD"  # clear under the table policies, masked inline
    return w.stg_customers.select(
        "CUSTOMER_ID", "_LOADED_AT", gov.mask_inline(F.col("EMAIL"), "EMAIL", role).alias("EMAIL"), gov.mask_inline(F.col("PHONE"), "PHONE", role).alias("PHONE"),
        gov.mask_inline(F.col("LAST_NAME"), "NAME", role).alias("LAST_NAME"), gov.mask_inline(F.col("CITY"), "NONE", role).alias("CITY"))


@query("apply_tag_policies", f"""SELECT CUSTOMER_ID, _LOADED_AT, left(FIRST_NAME, 1) || '****' AS FIRST_NAME, left(LAST_NAME, 1) || '****' AS LAST_NAME,
  {MASKED_EMAIL.format(c='EMAIL')} AS EMAIL, '***-***-' || right(PHONE, 4) AS PHONE, make_date(year(DATE_OF_BIRTH), 1, 1) AS DATE_OF_BIRTH, CITY FROM stg_customers""")
def apply_tag_policies(w, spark, folder):
    tagged = gov.tag_columns(w.stg_customers, gov.PII_TAGS)
    return gov.apply_tag_policies(tagged, "ANALYST").select(
        "CUSTOMER_ID", "_LOADED_AT", "FIRST_NAME", "LAST_NAME", "EMAIL", "PHONE", "DATE_OF_BIRTH", "CITY")


# ---- row policies -------------------------------------------------------------------------------
@query("row_access_country", "SELECT HK_CUSTOMER, COUNTRY_CODE, LOAD_DATETIME FROM sat_customer_details WHERE COUNTRY_CODE IN ('US', 'DE')")
def row_access_country(w, spark, folder):
    return gov.row_access_country(w.sat_customer_details, "ANALYST", ["US", "DE"]).select("HK_CUSTOMER", "COUNTRY_CODE", "LOAD_DATETIME")


@query("row_access_sensitivity", """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'PUBLIC' WHEN 1 THEN 'INTERNAL' ELSE 'CONFIDENTIAL' END AS SENSITIVITY_LEVEL FROM orders WHERE o_orderkey % 3 < 2""")
def row_access_sensitivity(w, spark, folder):
    level = F.when(F.col("o_orderkey") % 3 == 0, "PUBLIC").when(F.col("o_orderkey") % 3 == 1, "INTERNAL").otherwise("CONFIDENTIAL")
    return gov.row_access_sensitivity(table(spark, folder, "orders").select("o_orderkey", level.alias("SENSITIVITY_LEVEL")), "ANALYST")


@query("row_access_roles", "SELECT 'AUDITOR' AS ROLE, count(*) AS N FROM supplier UNION ALL SELECT 'GUEST', 0")
def row_access_roles(w, spark, folder):
    parts = [
        gov.row_access_roles(table(spark, folder, "supplier"), role, ["AUDITOR", "DATA_STEWARD"]).agg(F.count("*").alias("N")).withColumn("ROLE", F.lit(role))
        for role in ("AUDITOR", "GUEST")
    ]
    return parts[0].unionByName(parts[1]).select("ROLE", "N")


PATTERN_SQL = {
    "EMAIL": "^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$", "PHONE": "^\\+?[1-9]\\d{1,14}$", "SSN": "^\\d{3}-\\d{2}-\\d{4}$",
}
CLASSIFIED = {"RAW_CUSTOMERS": "customers", "RAW_ORDERS": "orders", "RAW_PRODUCTS": "products", "RAW_ORDER_ITEMS": "order_items"}


def _text_columns(name):
    return [f.name for f in LANDING[name] if f.dataType.simpleString() == "string" and not f.name.startswith("_")]


# one pass per table in SQL too: the shares of all columns and patterns side by side, then as rows
CTES["match_shares"] = " UNION ALL ".join(
    f"SELECT '{n}' AS OBJECT_NAME, COLUMN_NAME, TAG_VALUE, MATCH_SHARE FROM (SELECT unnest([{', '.join(cells)}], recursive := true) FROM {n.lower()})" for n, cells in (
        (n, [f"{{'COLUMN_NAME': '{c}', 'TAG_VALUE': '{t}', 'MATCH_SHARE': avg(CASE WHEN regexp_matches({c}, '{p}') THEN 1.0 ELSE 0.0 END) FILTER (WHERE {c} IS NOT NULL)}}"
             for c in _text_columns(n) for t, p in PATTERN_SQL.items()]) for n in CLASSIFIED))


def _classified(w):
    """Every text column of every landing table."""
    found = [gov.classify_columns(getattr(w.landing, source), 0.8, _text_columns(name)).withColumn("OBJECT_NAME", F.lit(name)) for name, source in CLASSIFIED.items()]
    return reduce(DataFrame.unionByName, found)


@query("classify_columns", "SELECT OBJECT_NAME, COLUMN_NAME, TAG_VALUE, round(MATCH_SHARE, 6) AS MATCH_SHARE FROM match_shares WHERE MATCH_SHARE >= 0.8")
def classify_columns(w, spark, folder):
    return _classified(w).withColumn("MATCH_SHARE", F.round("MATCH_SHARE", 6))


@query("classification_report", "SELECT 'PII' AS TAG_NAME, OBJECT_NAME, COLUMN_NAME, TAG_VALUE, 'AUTO_CLASSIFIED' AS CLASSIFICATION_METHOD FROM match_shares WHERE MATCH_SHARE >= 0.8")
def classification_report(w, spark, folder):
    found = _classified(w).select("OBJECT_NAME", "COLUMN_NAME", "TAG_VALUE", F.lit(None).cast("timestamp_ntz").alias("DELETED"))
    return gov.classification_report(found.withColumn("TAG_NAME", F.explode(F.array(F.lit("PII"), F.lit("COMMENT")))))


# ---- data quality ----------------------------------------------------------------------------------
@query("dq_not_null", "SELECT ORDER_ID, _LOADED_AT FROM raw_orders WHERE TAX_AMOUNT IS NULL")
def dq_not_null(w, spark, folder):
    return quality.not_null(w.landing.orders, "TAX_AMOUNT").select("ORDER_ID", "_LOADED_AT")


@query("dq_unique", "SELECT ORDER_ID, count(*) AS CNT FROM raw_orders WHERE ORDER_ID IS NOT NULL GROUP BY ORDER_ID HAVING count(*) > 1")
def dq_unique(w, spark, folder):
    return quality.unique(w.landing.orders, "ORDER_ID")


@query("dq_accepted_values", "SELECT COUNTRY_CODE, count(*) AS CNT FROM stg_customers WHERE COUNTRY_CODE NOT IN ('US', 'GB', 'DE') GROUP BY COUNTRY_CODE")
def dq_accepted_values(w, spark, folder):
    return quality.accepted_values(w.stg_customers, "COUNTRY_CODE", ["US", "GB", "DE"])


@query("dq_relationships", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def dq_relationships(w, spark, folder):
    return quality.relationships(table(spark, folder, "documents").select("doc_id", "source"), "doc_id", table(spark, folder, "labels"), "doc_id")


@query("dq_between", "SELECT ORDER_ITEM_ID, CAST(QUANTITY AS DOUBLE) AS QUANTITY FROM stg_order_items WHERE QUANTITY < 2 OR QUANTITY > 45")
def dq_between(w, spark, folder):
    return quality.between(w.stg_order_items, "QUANTITY", 2, 45).select("ORDER_ITEM_ID", "QUANTITY")


@query("dq_inline", """SELECT count(*) FILTER (WHERE TAX_AMOUNT IS NULL) <= 0 AS tax_known, count(*) - count(DISTINCT ORDER_ID) <= 0 AS order_once, count(*) > 100 AS enough FROM raw_orders""")
def dq_inline(w, spark, folder):
    return quality.inline_checks(w.landing.orders, [
        ("tax_known", "null_check", "TAX_AMOUNT", 0), ("order_once", "unique_check", "ORDER_ID", 0), ("enough", "row_count", "ORDER_ID", 100)])


EARLY = "2000-01-01 00:00:00"
CTES["early_hub_order"] = f"SELECT * FROM hub_order WHERE LOAD_DATETIME < TIMESTAMP '{EARLY}'"
CTES["early_hub_customer"] = "SELECT * FROM hub_customer WHERE right(CUSTOMER_ID, 1) <> '7'"


def _early(w):
    """Hubs with gaps, so that integrity checks have something to find."""
    return w.hub_order.where(F.col("LOAD_DATETIME") < at(EARLY)), w.hub_customer.where(F.right("CUSTOMER_ID", F.lit(1)) != "7")


@query("dq_hub_integrity", "SELECT HK_ORDER FROM sat_order_financials WHERE HK_ORDER NOT IN (SELECT HK_ORDER FROM early_hub_order) AND HK_ORDER <> repeat('0', 64)")
def dq_hub_integrity(w, spark, folder):
    return quality.hub_integrity(w.sat_order_financials, "HK_ORDER", _early(w)[0])


LINK_SQL = """SELECT 'HK_CUSTOMER' AS FK_COLUMN, HK_CUSTOMER AS FK_VALUE FROM link_customer_order WHERE HK_CUSTOMER NOT IN (SELECT HK_CUSTOMER FROM early_hub_customer)
UNION ALL SELECT 'HK_ORDER', HK_ORDER FROM link_customer_order WHERE HK_ORDER NOT IN (SELECT HK_ORDER FROM early_hub_order)"""


@query("dq_link_integrity", LINK_SQL)
def dq_link_integrity(w, spark, folder):
    orders, customers = _early(w)
    return quality.link_integrity(w.link_customer_order, {"HK_CUSTOMER": customers, "HK_ORDER": orders})


@query("dq_vault_ri", """SELECT 'LINK_CUSTOMER_ORDER.HK_CUSTOMER' AS CHECK_NAME, HK_CUSTOMER AS ORPHAN_KEY FROM link_customer_order WHERE HK_CUSTOMER NOT IN (SELECT HK_CUSTOMER FROM early_hub_customer)
UNION ALL SELECT 'LINK_CUSTOMER_ORDER.HK_ORDER', HK_ORDER FROM link_customer_order WHERE HK_ORDER NOT IN (SELECT HK_ORDER FROM early_hub_order)
UNION ALL SELECT 'LINK_ORDER_PRODUCT.HK_ORDER', HK_ORDER FROM link_order_product WHERE HK_ORDER NOT IN (SELECT HK_ORDER FROM early_hub_order)
UNION ALL SELECT 'LINK_ORDER_PRODUCT.HK_PRODUCT', HK_PRODUCT FROM link_order_product WHERE HK_PRODUCT NOT IN (SELECT HK_PRODUCT FROM hub_product)""")
def dq_vault_ri(w, spark, folder):
    orders, customers = _early(w)
    return quality.vault_integrity([
        ("LINK_CUSTOMER_ORDER.HK_CUSTOMER", w.link_customer_order, "HK_CUSTOMER", customers),
        ("LINK_CUSTOMER_ORDER.HK_ORDER", w.link_customer_order, "HK_ORDER", orders),
        ("LINK_ORDER_PRODUCT.HK_ORDER", w.link_order_product, "HK_ORDER", orders),
        ("LINK_ORDER_PRODUCT.HK_PRODUCT", w.link_order_product, "HK_PRODUCT", w.hub_product),
    ])


@query("dq_satellite_scd2", """SELECT HK_ORDER, HASH_DIFF, LOAD_DATETIME, PREV_HASH_DIFF FROM (
  SELECT HK_ORDER, HD_ORDER_FINANCIALS AS HASH_DIFF, LOAD_DATETIME, lag(HD_ORDER_FINANCIALS) OVER (PARTITION BY HK_ORDER ORDER BY LOAD_DATETIME) AS PREV_HASH_DIFF FROM stg_orders)
WHERE HASH_DIFF = PREV_HASH_DIFF""")
def dq_satellite_scd2(w, spark, folder):
    uncollapsed = w.stg_orders.withColumnRenamed("HD_ORDER_FINANCIALS", "HASH_DIFF")
    return quality.satellite_repeats(uncollapsed, "HK_ORDER").select("HK_ORDER", "HASH_DIFF", "LOAD_DATETIME", "PREV_HASH_DIFF")


@query("dq_dim_uniqueness", """SELECT 'CUSTOMER_SK' AS KEY_COLUMN, c_mktsegment AS KEY_VALUE, count(*) AS CNT FROM customer GROUP BY c_mktsegment HAVING count(*) > 1
UNION ALL SELECT 'PRODUCT_SK', PRODUCT_SK, count(*) FROM dim_product GROUP BY PRODUCT_SK HAVING count(*) > 1""")
def dq_dim_uniqueness(w, spark, folder):
    coarse = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("CUSTOMER_SK"))
    return quality.duplicate_keys({"CUSTOMER_SK": coarse, "PRODUCT_SK": w.dim_product})


@query("dq_fact_measures", "SELECT ORDER_SK, CAST(NET_AMOUNT AS DOUBLE) AS NET_AMOUNT FROM fct_orders WHERE TOTAL_AMOUNT < 0 OR NET_AMOUNT < 150 OR DISCOUNT_AMOUNT < 0 OR TAX_AMOUNT < 0")
def dq_fact_measures(w, spark, folder):
    return quality.fact_measures(w.fct_orders, lowest_net=150).select("ORDER_SK", "NET_AMOUNT")


@query("dq_pit_completeness", f"SELECT HK_ORDER, ORDER_ID FROM hub_order WHERE HK_ORDER NOT IN (SELECT HK_ORDER FROM pit_order WHERE PIT_LOAD_DATETIME < TIMESTAMP '{EARLY}')")
def dq_pit_completeness(w, spark, folder):
    early = w.pit_order.where(F.col("PIT_LOAD_DATETIME") < at(EARLY))
    return quality.pit_completeness(w.hub_order, early, "HK_ORDER").select("HK_ORDER", "ORDER_ID")


MINIMUM = {"hub_customer": 100, "hub_order": 100, "hub_product": 10, "sat_customer_details": 100, "sat_order_details": 100, "fct_orders": 100, "dim_customer": 10**9}
CTES["volume_rows"] = " UNION ALL ".join(f"SELECT '{n}' AS MODEL_NAME, count(*) AS ROWS_SCANNED, {m} AS least FROM {n}" for n, m in MINIMUM.items())
CTES["dq_results"] = """SELECT 'volume_check_' || MODEL_NAME AS TEST_NAME, 'CUSTOM' AS TEST_TYPE, MODEL_NAME, CASE WHEN ROWS_SCANNED >= least THEN 'PASS' ELSE 'FAIL' END AS STATUS,
  CAST(CASE WHEN ROWS_SCANNED >= least THEN 0 ELSE 1 END AS BIGINT) AS FAILURES_COUNT, ROWS_SCANNED, 'ERROR' AS SEVERITY FROM volume_rows"""


def _volume(w):
    return quality.volume({n: getattr(w, n) for n in MINIMUM}, MINIMUM)


@query("dq_volume", doubles("dq_results"))
def dq_volume(w, spark, folder):
    return _volume(w)


@query("dq_source_freshness", f"""SELECT SOURCE, LATEST, CAST(date_diff('hour', LATEST, now_at) AS INTEGER) AS AGE_HOURS,
  CASE WHEN date_diff('hour', LATEST, now_at) > 24 THEN 'error' WHEN date_diff('hour', LATEST, now_at) > 12 THEN 'warn' ELSE 'pass' END AS STATUS FROM (
  SELECT 'RAW_CUSTOMERS' AS SOURCE, max(_LOADED_AT) AS LATEST, {NOW_SQL} AS now_at FROM raw_customers UNION ALL SELECT 'RAW_ORDERS', max(_LOADED_AT), {NOW_SQL} FROM raw_orders
  UNION ALL SELECT 'RAW_PRODUCTS', max(_LOADED_AT), {NOW_SQL} FROM raw_products UNION ALL SELECT 'RAW_ORDER_ITEMS', max(_LOADED_AT), {NOW_SQL} FROM raw_order_items)""")
def dq_source_freshness(w, spark, folder):
    return quality.source_freshness({"RAW_CUSTOMERS": w.landing.customers, "RAW_ORDERS": w.landing.orders, "RAW_PRODUCTS": w.landing.products,
                                     "RAW_ORDER_ITEMS": w.landing.order_items}, AS_OF_EVENTS)


@query("dq_results_log", """SELECT 'not_null' AS TEST_NAME, 'raw_orders' AS MODEL_NAME, 'TAX_AMOUNT' AS COLUMN_NAME, 'WARN' AS STATUS,
  (SELECT count(*) FROM raw_orders WHERE TAX_AMOUNT IS NULL) AS FAILURES_COUNT, (SELECT count(*) FROM raw_orders) AS ROWS_SCANNED
UNION ALL SELECT 'unique', 'hub_order', 'HK_ORDER', 'PASS', 0, (SELECT count(*) FROM hub_order)""")
def dq_results_log(w, spark, folder):
    tables = TableFolder(spark, scratch_path(spark, "dq"))
    raw = w.landing.orders
    rows = [
        quality.result_row("not_null", quality.not_null(raw, "TAX_AMOUNT"), raw, "raw_orders", "TAX_AMOUNT", AS_OF_EVENTS),
        quality.result_row("unique", quality.unique(w.hub_order, "HK_ORDER"), w.hub_order, "hub_order", "HK_ORDER", AS_OF_EVENTS, severity="ERROR"),
    ]
    for batch, row in enumerate(rows):
        tables.append("dq_test_results", row, batch)
    return tables.read("dq_test_results").select("TEST_NAME", "MODEL_NAME", "COLUMN_NAME", "STATUS", "FAILURES_COUNT", "ROWS_SCANNED")


@query("dq_report", "SELECT STATUS, count(*) AS TEST_COUNT, CAST(sum(FAILURES_COUNT) AS BIGINT) AS TOTAL_FAILURES FROM dq_results GROUP BY STATUS")
def dq_report(w, spark, folder):
    return quality.quality_report(_volume(w).withColumn("EXECUTED_AT", at(AS_OF_EVENTS)), AS_OF_EVENTS)


# ---- observability -----------------------------------------------------------------------------------
VAULT = ("hub_customer", "hub_order", "hub_product", "link_customer_order", "link_order_product", *SAT_COLUMNS)


@query("vault_health_check", " UNION ALL ".join(f"SELECT '{n.upper()}' AS ENTITY, count(*) AS ROW_COUNT FROM {n}" for n in VAULT))
def vault_health_check(w, spark, folder):
    return observe.vault_health_check({n: getattr(w, n) for n in VAULT})


@query("layer_sla_monitor", f"""SELECT *, CASE WHEN HOURS_AGO <= 6 THEN 'GREEN' WHEN HOURS_AGO <= 12 THEN 'YELLOW' WHEN HOURS_AGO <= 24 THEN 'ORANGE' ELSE 'RED' END AS SLA_STATUS FROM (
  SELECT LAYER, MODEL, t AS LATEST_RECORD, CAST(date_diff('hour', t, {NOW_SQL}) AS INTEGER) AS HOURS_AGO FROM (
  SELECT 'BRONZE' AS LAYER, 'SAT_CUSTOMER_DETAILS' AS MODEL, max(LOAD_DATETIME) AS t FROM sat_customer_details UNION ALL SELECT 'BRONZE', 'SAT_ORDER_DETAILS', max(LOAD_DATETIME) FROM sat_order_details
  UNION ALL SELECT 'SILVER', 'BV_ORDER_LIFECYCLE', max(COMPUTED_AT) FROM bv_order_lifecycle UNION ALL SELECT 'GOLD', 'FCT_ORDERS', max(UPDATED_AT) FROM fct_orders))""")
def layer_sla_monitor(w, spark, folder):
    return observe.layer_sla_monitor([
        ("BRONZE", "SAT_CUSTOMER_DETAILS", w.sat_customer_details, "LOAD_DATETIME"), ("BRONZE", "SAT_ORDER_DETAILS", w.sat_order_details, "LOAD_DATETIME"),
        ("SILVER", "BV_ORDER_LIFECYCLE", w.bv_order_lifecycle, "COMPUTED_AT"), ("GOLD", "FCT_ORDERS", w.fct_orders, "UPDATED_AT")], AS_OF_EVENTS)


@query("pipeline_sla_monitor", f"""SELECT *, CASE WHEN HOURS_AGO <= 6 THEN 'GREEN' WHEN HOURS_AGO <= 12 THEN 'YELLOW' WHEN HOURS_AGO <= 24 THEN 'ORANGE' ELSE 'RED' END AS SLA_STATUS FROM (
  SELECT LAYER, MODEL, t AS LATEST_RECORD, CAST(date_diff('hour', t, {NOW_SQL}) AS INTEGER) AS HOURS_AGO FROM (
  SELECT 'BRONZE' AS LAYER, 'SAT_CUSTOMER_DETAILS' AS MODEL, max(LOAD_DATETIME) AS t FROM sat_customer_details UNION ALL SELECT 'BRONZE', 'SAT_ORDER_DETAILS', max(LOAD_DATETIME) FROM sat_order_details
  UNION ALL SELECT 'SILVER', 'BV_CUSTOMER_CLASSIFICATION', max(CLASSIFIED_AT) FROM bv_customer_classification UNION ALL SELECT 'GOLD', 'FCT_ORDERS', max(UPDATED_AT) FROM fct_orders))""")
def pipeline_sla_monitor(w, spark, folder):
    return observe.layer_sla_monitor([
        ("BRONZE", "SAT_CUSTOMER_DETAILS", w.sat_customer_details, "LOAD_DATETIME"), ("BRONZE", "SAT_ORDER_DETAILS", w.sat_order_details, "LOAD_DATETIME"),
        ("SILVER", "BV_CUSTOMER_CLASSIFICATION", w.bv_customer_classification, "CLASSIFIED_AT"), ("GOLD", "FCT_ORDERS", w.fct_orders, "UPDATED_AT")], AS_OF_EVENTS)


@query("sla_monitor", f"""SELECT CASE WHEN date_diff('hour', t, {NOW_SQL}) <= 24 THEN 'WITHIN_SLA' ELSE 'SLA_BREACH' END AS SLA_STATUS, t AS LATEST_RECORD,
  CAST(date_diff('hour', t, {NOW_SQL}) AS INTEGER) AS HOURS_SINCE_UPDATE, 24 AS SLA_THRESHOLD_HOURS FROM (SELECT max(LOAD_DATETIME) AS t FROM sat_customer_details)""")
def sla_monitor(w, spark, folder):
    return observe.sla_monitor(w.sat_customer_details, AS_OF_EVENTS)


CTES["file_ingestion_log"] = """SELECT CAST(event_id AS VARCHAR) AS INGESTION_ID, 'file-' || event_id || '.json' AS FILE_NAME, upper(event_type) AS SOURCE_SYSTEM, 'PIPE_' || upper(event_type) AS PIPE_NAME,
  CASE WHEN event_id % 10 = 0 THEN 'FAILED' ELSE 'LOADED' END AS STATUS, event_id % 1000 AS ROWS_LOADED, ts AS LOAD_START_TS, ts + to_seconds(floor(value)) AS LOAD_END_TS FROM events"""


@query("ingestion_freshness", f"""SELECT SOURCE_SYSTEM, count(*) AS FILES_LOADED_24H, CAST(sum(ROWS_LOADED) AS BIGINT) AS ROWS_LOADED_24H, max(LOAD_END_TS) AS LATEST_LOAD,
  date_diff('minute', max(LOAD_END_TS), {NOW_SQL}) AS MINUTES_SINCE_LAST_LOAD, CASE WHEN date_diff('hour', max(LOAD_END_TS), {NOW_SQL}) <= 12 THEN 'WITHIN_SLA'
  WHEN date_diff('hour', max(LOAD_END_TS), {NOW_SQL}) <= 24 THEN 'WARNING' ELSE 'SLA_BREACH' END AS SLA_STATUS
FROM file_ingestion_log WHERE LOAD_START_TS >= {NOW_SQL} - INTERVAL 1 DAY GROUP BY SOURCE_SYSTEM""")
def ingestion_freshness(w, spark, folder):
    return observe.ingestion_freshness(testbed.file_ingestion_log(spark, folder), AS_OF_EVENTS)


@query("ingestion_check", f"""SELECT CASE WHEN date_diff('hour', t, {NOW_SQL}) <= 24 THEN 'HEALTHY' ELSE 'SLA_BREACH' END AS STATUS,
  'Last ingestion: ' || coalesce(strftime(t, '%Y-%m-%d %H:%M:%S'), 'NEVER') AS DETAIL, {NOW_SQL} AS CHECKED_AT FROM (SELECT max(LOAD_START_TS) AS t FROM file_ingestion_log WHERE SOURCE_SYSTEM = 'ERROR')""")
def ingestion_check(w, spark, folder):
    return observe.ingestion_check(testbed.file_ingestion_log(spark, folder), "ERROR", 24, AS_OF_EVENTS)


@query("file_ingestion_log", f"""SELECT upper(event_type) AS SOURCE_SYSTEM, 'PIPE_' || upper(event_type) AS PIPE_NAME, CASE WHEN event_type = 'error' THEN 'SKIPPED' ELSE 'LOADED' END AS STATUS,
  count(*) AS ROW_COUNT, CASE WHEN event_type = 'error' THEN 0 ELSE count(*) END AS ROWS_LOADED, CAST(CASE WHEN event_type = 'error' THEN count(*) ELSE 0 END AS BIGINT) AS ERRORS_SEEN, true AS SIZED,
  CAST({NOW_SQL} AS TIMESTAMP) AS LAST_LOAD_TIME FROM events GROUP BY event_type UNION ALL SELECT 'EMPTY', 'PIPE_EMPTY', 'LOADED', 0, 0, 0, true, CAST({NOW_SQL} AS TIMESTAMP) FROM (SELECT count(*) FROM events)""")
def file_ingestion_log(w, spark, folder):
    """The log that loads of event files write: a source per event type, Parquet files of differing types, one set of text where numbers are declared, one without rows."""
    tables = TableFolder(spark, scratch_path(spark, "log"))
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    schema = _types("event_id bigint, event_type string, value double")
    sources = [r["event_type"] for r in events.select("event_type").distinct().collect()]  # a handful of systems
    for batch, source in enumerate([*sources, "empty"]):
        mine = events.where(F.col("event_type") == source)
        path = tables.path(f"landed/{source}")
        shaped = mine.withColumn("value", F.concat(F.lit("v"), "value") if source == "error" else F.col("value")).withColumn(
            "event_id", F.col("event_id").cast("string") if batch % 2 else F.col("event_id"))
        if source == "empty":
            shaped.write.parquet(path)
        else:  # a plain write leaves a file without rows where the first split has none of the source; a partitioned one does not
            shaped.withColumn("part", F.lit(batch)).write.partitionBy("part").parquet(path)
        result = copy.copy_into(spark, formats.Stage(path, "parquet", schema), source.upper(), AS_OF_EVENTS, f"PIPE_{source.upper()}")
        tables.append("events", result.rows, batch)
        tables.append(copy.LOG, result.log, batch)
    return tables.read(copy.LOG).groupBy("SOURCE_SYSTEM", "PIPE_NAME", "STATUS").agg(
        F.sum("ROW_COUNT").alias("ROW_COUNT"), F.sum("ROWS_LOADED").alias("ROWS_LOADED"), F.sum("ERRORS_SEEN").alias("ERRORS_SEEN"),
        (F.min("FILE_SIZE_BYTES") > 0).alias("SIZED"), F.max("LOAD_END_TS").alias("LAST_LOAD_TIME"))


@query("ingestion_source_status", f"""SELECT PIPE_NAME, count(*) AS FILES_LOADED, CAST(sum(ROWS_LOADED) AS BIGINT) AS TOTAL_ROWS, max(LOAD_END_TS) AS LATEST_LOAD FROM file_ingestion_log
WHERE LOAD_START_TS >= {NOW_SQL} - INTERVAL 36 HOUR GROUP BY PIPE_NAME""")
def ingestion_source_status(w, spark, folder):
    return observe.ingestion_source_status(testbed.file_ingestion_log(spark, folder), AS_OF_EVENTS, hours=36)


@query("task_execution_log", """SELECT 'load_hub_order' AS TASK_NAME, 'LOAD' AS TASK_TYPE, 'SUCCESS' AS STATUS, (SELECT count(*) FROM hub_order) AS ROWS_AFFECTED, CAST(90 AS DOUBLE) AS EXECUTION_TIME_SEC
UNION ALL SELECT 'load_hub_product', 'LOAD', 'SUCCESS', (SELECT count(*) FROM hub_product), 90""")
def task_execution_log(w, spark, folder):
    tables = TableFolder(spark, scratch_path(spark, "tasks"))
    for batch, name in enumerate(("hub_order", "hub_product")):
        rows = getattr(w, name).count()
        entry = observe.task_row(spark, f"load_{name}", "LOAD", "SUCCESS", "2024-01-31 00:00:00", "2024-01-31 00:01:30", rows=rows, model=name, run_id="run-1")
        tables.append("task_execution_log", entry, batch)
    return tables.read("task_execution_log").select("TASK_NAME", "TASK_TYPE", "STATUS", "ROWS_AFFECTED", "EXECUTION_TIME_SEC")


@query("error_log", """SELECT 'SAFE_INGESTION_CHECK' AS PROCEDURE_NAME, upper(event_type) AS SOURCE_SYSTEM, 'OPEN' AS RESOLUTION_STATUS, 'ERROR' AS SEVERITY, true AS LOGGED FROM events GROUP BY event_type""")
def error_log(w, spark, folder):
    """A check per source system that cannot read its log: the answer is an ERROR row and the error table gains an entry each."""
    tables = TableFolder(spark, scratch_path(spark, "errors"))
    log = testbed.file_ingestion_log(spark, folder)
    broken = log.withColumn("LOAD_START_TS", F.raise_error(F.lit("log unreadable")).cast("timestamp_ntz"))
    sources = [r["SOURCE_SYSTEM"] for r in log.select("SOURCE_SYSTEM").distinct().collect()]  # a handful of systems
    for batch, source in enumerate(sources):
        observe.safe_ingestion_check(spark, lambda: broken, source, 24, AS_OF_EVENTS, lambda row, b=batch: tables.append("error_event_log", row, b))
    return tables.read("error_event_log").select(
        "PROCEDURE_NAME", F.get_json_object("INPUT_PARAMETERS", "$.source_system").alias("SOURCE_SYSTEM"), "RESOLUTION_STATUS", "SEVERITY",
        F.contains("ERROR_MESSAGE", F.lit("log unreadable")).alias("LOGGED"))


CTES["cost_rows"] = """SELECT list_extract(['LOADER_WH', 'TRANSFORMER_WH', 'CI_WH', 'DEV_WH', 'ANALYTICS_WH'], CAST(user_id % 5 + 1 AS INTEGER)) AS WAREHOUSE_NAME, event_type AS QUERY_TAG, 'CC' || (user_id % 3) AS COST_CENTER,
  CAST(floor(value * 100) / 10000.0::DOUBLE AS DECIMAL(12,4)) AS CREDITS_USED, 1 AS QUERIES_EXECUTED, event_id * 1024 AS BYTES_SCANNED, ts AS PERIOD_START FROM events"""
PERIOD = "PERIOD_START >= TIMESTAMP '2024-01-05' AND PERIOD_START < TIMESTAMP '2024-01-25'"


@query("cost_attribution", f"""SELECT WAREHOUSE_NAME, QUERY_TAG, COST_CENTER, CAST(sum(CREDITS_USED) AS DOUBLE) AS CREDITS_USED, CAST(sum(QUERIES_EXECUTED) AS BIGINT) AS QUERIES_EXECUTED,
  CAST(sum(BYTES_SCANNED) AS BIGINT) AS BYTES_SCANNED FROM cost_rows WHERE {PERIOD} GROUP BY ALL""")
def cost_attribution(w, spark, folder):
    return observe.cost_attribution(testbed.cost_attribution(spark, folder), "2024-01-05 00:00:00", "2024-01-25 00:00:00")


@query("budget_status", f"""SELECT WAREHOUSE_NAME, CAST(c AS DOUBLE) AS CREDITS_USED, CAST(b AS INTEGER) AS BUDGET, round(CAST(c AS DOUBLE) / b * 100, 4) AS PERCENT_USED,
  CASE WHEN c * 100 >= b * 100 THEN 'SUSPEND_IMMEDIATE' WHEN c * 100 >= b * s THEN 'SUSPEND' WHEN c * 100 >= b * n THEN 'NOTIFY' ELSE 'OK' END AS ACTION FROM (
  SELECT WAREHOUSE_NAME, sum(CREDITS_USED) AS c FROM cost_rows WHERE {PERIOD} GROUP BY ALL)
JOIN (VALUES ('LOADER_WH', 200, 90, 70), ('TRANSFORMER_WH', 1500, 95, 60), ('CI_WH', 100, 100, 80), ('DEV_WH', 200, 95, 75), ('ANALYTICS_WH', 2000, 90, 50)) q(WAREHOUSE_NAME, b, s, n) USING (WAREHOUSE_NAME)""")
def budget_status(w, spark, folder):
    return observe.budget_status(testbed.cost_attribution(spark, folder), "2024-01-05 00:00:00", "2024-01-25 00:00:00")


CTES["refresh_rows"] = """SELECT 'GROUP_' || (user_id % 10) AS GROUP_NAME, ts AS REFRESH_START, ts + to_seconds(floor(value * 60)) AS REFRESH_END, event_id AS BYTES_TRANSFERRED, event_id % 50 AS OBJECT_COUNT,
  CASE WHEN event_type = 'click' THEN 'RUNNING' ELSE 'IDLE' END AS SCHEDULING_STATE FROM events"""


@query("lag_status", """SELECT GROUP_NAME, REFRESH_START, REFRESH_END, date_diff('second', REFRESH_START, REFRESH_END) AS LAG_SECONDS, BYTES_TRANSFERRED, OBJECT_COUNT,
  CASE WHEN date_diff('second', REFRESH_START, REFRESH_END) <= 300 THEN 'HEALTHY' WHEN date_diff('second', REFRESH_START, REFRESH_END) <= 3600 THEN 'WARNING' ELSE 'CRITICAL' END AS SLA_STATUS FROM refresh_rows""")
def lag_status(w, spark, folder):
    return observe.lag_status(testbed.refresh_history(spark, folder))


@query("lag_alert", """SELECT GROUP_NAME, REFRESH_START, REFRESH_END, date_diff('second', REFRESH_START, REFRESH_END) AS LAG_SECONDS, BYTES_TRANSFERRED, OBJECT_COUNT,
  CASE WHEN date_diff('second', REFRESH_START, REFRESH_END) >= 7200 THEN 'CRITICAL' WHEN date_diff('second', REFRESH_START, REFRESH_END) >= 3600 THEN 'WARNING' ELSE 'HEALTHY' END AS SLA_STATUS
FROM refresh_rows QUALIFY row_number() OVER (PARTITION BY GROUP_NAME ORDER BY REFRESH_END DESC, REFRESH_START DESC) = 1""")
def lag_alert(w, spark, folder):
    from ..operators.history import latest_per_key
    newest = latest_per_key(testbed.refresh_history(spark, folder), "GROUP_NAME", ["REFRESH_END", "REFRESH_START"])
    return observe.lag_status(newest, alert=True)


@query("refresh_health", f"""SELECT NAME, SCHEDULING_STATE, LAST_REFRESH, date_diff('minute', LAST_REFRESH, {NOW_SQL}) AS MINUTES_SINCE_REFRESH,
  CASE WHEN SCHEDULING_STATE = 'RUNNING' THEN 'HEALTHY' WHEN date_diff('minute', LAST_REFRESH, {NOW_SQL}) > 60 THEN 'STALE' ELSE 'OK' END AS HEALTH_STATUS FROM (
  SELECT GROUP_NAME || '/' || SCHEDULING_STATE AS NAME, SCHEDULING_STATE, max(REFRESH_END) AS LAST_REFRESH FROM refresh_rows GROUP BY ALL)""")
def refresh_health(w, spark, folder):
    state = testbed.refresh_history(spark, folder).groupBy("GROUP_NAME", "SCHEDULING_STATE").agg(F.max("REFRESH_END").alias("LAST_REFRESH"))
    return observe.refresh_health(state.withColumn("NAME", F.concat("GROUP_NAME", F.lit("/"), "SCHEDULING_STATE")), AS_OF_EVENTS)


# ---- data products --------------------------------------------------------------------------------------
PRODUCT_MODELS = (("hub_customer", "Customer 360"), ("dim_customer", "Customer 360"), ("sat_customer_details", "Customer Feature Store"),
                  ("hub_product", "Product Performance"), ("fct_orders", "Revenue by Segment"), ("hub_order", "Revenue by Segment"))
CTES["product_models"] = "SELECT * FROM (VALUES " + ", ".join(f"('{m}', '{p}')" for m, p in PRODUCT_MODELS) + ") AS t(MODEL_NAME, PRODUCT_NAME)"
QUALITY = "SELECT PRODUCT_NAME, round(count(*) FILTER (WHERE STATUS = 'PASS') * 100.0 / count(*), 2)::DOUBLE AS QUALITY_SCORE FROM dq_results JOIN product_models USING (MODEL_NAME) GROUP BY PRODUCT_NAME"


def _product_scores(w, spark):
    models = spark.createDataFrame(list(PRODUCT_MODELS), "MODEL_NAME string, PRODUCT_NAME string")
    return observe.product_quality(_volume(w), models)


@query("data_product_quality", QUALITY)
def data_product_quality(w, spark, folder):
    return _product_scores(w, spark)


CTES["product_quality"] = QUALITY
REGISTERED = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in p) + ")" for p in observe.PRODUCTS)
CTES["product_registry"] = f"""SELECT * FROM (VALUES {REGISTERED}) AS t(PRODUCT_NAME, PRODUCT_DOMAIN, PRODUCT_OWNER, PRODUCT_TIER, PRODUCT_TYPE, DATABASE_NAME, SCHEMA_NAME, OBJECT_NAME, DESCRIPTION, HOURS)"""


@query("data_product_catalog", f"""SELECT r.PRODUCT_NAME, PRODUCT_DOMAIN, PRODUCT_TIER, PRODUCT_TYPE, DATABASE_NAME || '.' || SCHEMA_NAME || '.' || OBJECT_NAME AS FULLY_QUALIFIED_NAME, DESCRIPTION, PRODUCT_OWNER,
  'SLA: ' || HOURS || 'h freshness, 99.50% uptime' AS SLA_SUMMARY, q.QUALITY_SCORE, '1.0.0' AS PRODUCT_VERSION, true AS IS_ACTIVE, {NOW_SQL} AS PUBLISHED_AT,
  (SELECT max(LOAD_DATETIME) FROM stg_orders) AS LAST_REFRESHED_AT FROM product_registry r LEFT JOIN product_quality q ON r.PRODUCT_NAME = q.PRODUCT_NAME""")
def data_product_catalog(w, spark, folder):
    registry = observe.register_products(spark, None, AS_OF_EVENTS)
    registry = observe.register_products(spark, registry, AS_OF_EVENTS)  # a second registration adds nothing
    newest = w.stg_orders.agg(F.max("LOAD_DATETIME")).scalar()
    scored = registry.drop("QUALITY_SCORE").join(_product_scores(w, spark), "PRODUCT_NAME", "left").withColumn("LAST_REFRESHED_AT", newest)
    return observe.product_catalog(scored)


@query("data_product_registry", """SELECT r.PRODUCT_NAME, PRODUCT_DOMAIN, sha256(r.PRODUCT_NAME) AS PRODUCT_ID, q.QUALITY_SCORE FROM product_registry r LEFT JOIN product_quality q ON r.PRODUCT_NAME = q.PRODUCT_NAME""")
def data_product_registry(w, spark, folder):
    registry = observe.register_products(spark, observe.register_products(spark, None, AS_OF_EVENTS), AS_OF_EVENTS)
    return registry.drop("QUALITY_SCORE").join(_product_scores(w, spark), "PRODUCT_NAME", "left").select("PRODUCT_NAME", "PRODUCT_DOMAIN", "PRODUCT_ID", "QUALITY_SCORE")


@query("audit_retention", """SELECT ERROR_ID, ERROR_TIMESTAMP FROM error_event_log WHERE ERROR_TIMESTAMP IS NULL OR ERROR_TIMESTAMP >= TIMESTAMP '2024-01-16 00:00:00'""")
def audit_retention(w, spark, folder):
    return observe.audit_retention(testbed.error_event_log(spark, folder), "ERROR_TIMESTAMP", "2024-04-15 10:00:00").select("ERROR_ID", "ERROR_TIMESTAMP")


# ---- storage -----------------------------------------------------------------------------------------------
@query("table_backup", doubles("hub_product"))
def table_backup(w, spark, folder):
    tables = TableFolder(spark, scratch_path(spark, "backup"))
    tables.replace("hub_product", w.hub_product)
    copied = tables.backup("hub_product", AS_OF_EVENTS)
    tables.replace("hub_product", w.hub_product.limit(0))  # the backup does not follow the table
    return tables.read_backup(copied)


@query("table_restore", doubles("hub_product"))
def table_restore(w, spark, folder):
    """Backup, lose most rows, restore: the table is whole again and the short state is kept aside."""
    tables = TableFolder(spark, scratch_path(spark, "restore"))
    tables.replace("hub_product", w.hub_product)
    tables.backup("hub_product", "2024-01-30 00:00:00")
    tables.replace("hub_product", w.hub_product.where("PRODUCT_ID like '%9'"))
    tables.restore("hub_product", "2024-01-30 12:00:00", AS_OF_EVENTS)
    return tables.read("hub_product")


@query("backup_cleanup", "SELECT 'hub_product_BACKUP_20231001_000000' AS REMOVED, (SELECT count(*) FROM part) AS ROWS_KEPT")
def backup_cleanup(w, spark, folder):
    tables = TableFolder(spark, scratch_path(spark, "cleanup"))
    tables.replace("hub_product", w.hub_product)
    for instant in ("2023-10-01 00:00:00", "2024-01-30 00:00:00"):
        tables.backup("hub_product", instant)
    removed = tables.cleanup_backups(AS_OF_EVENTS)
    left = [c for c, _, _ in tables.backups()]
    kept = tables.read_backup(left[0])
    return kept.agg(F.count("*").alias("ROWS_KEPT")).withColumn("REMOVED", F.lit(",".join(removed)))


@query("write_table", """SELECT how, count(*) AS N, CAST(sum(c_acctbal) AS BIGINT) AS TOTAL FROM (
  SELECT 'table' AS how, floor(c_acctbal) AS c_acctbal FROM customer UNION ALL SELECT 'view', floor(c_acctbal) FROM customer
  UNION ALL SELECT 'append', floor(c_acctbal) FROM customer UNION ALL SELECT 'merge', CASE WHEN c_custkey % 4 = 0 THEN 7 ELSE floor(c_acctbal) END FROM customer) GROUP BY how""")
def write_table(w, spark, folder):
    tables = TableFolder(spark, scratch_path(spark, "write"))
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", F.floor("c_acctbal").alias("c_acctbal"))
    even = F.col("c_custkey") % 2 == 0
    stored = {"table": tables.write("as_table", customer, "table", sort_by=["c_custkey"]), "view": tables.write("as_view", customer, "view")}
    tables.write("as_append", customer.where(even), "append", batch=1)
    tables.write("as_append", customer.where(even), "append", batch=1)  # the same batch again replaces itself
    stored["append"] = tables.write("as_append", customer.where(~even), "append", batch=2)
    tables.write("as_merge", customer, "merge", keys=["c_custkey"], partition_by="c_nationkey")
    changed = customer.where(F.col("c_custkey") % 4 == 0).withColumn("c_acctbal", F.lit(7).cast("bigint"))
    stored["merge"] = tables.write("as_merge", changed, "merge", keys=["c_custkey"], partition_by="c_nationkey")
    parts = [df.agg(F.count("*").alias("N"), F.sum("c_acctbal").alias("TOTAL")).withColumn("how", F.lit(how)) for how, df in stored.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("schema_change_policy", """SELECT 'sync' AS policy, count(*) AS N, count(c_name) AS OLD_COLUMN, count(extra) AS NEW_COLUMN FROM (
  SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, CAST(NULL AS INTEGER) AS extra FROM customer UNION ALL SELECT c_custkey, NULL, 1 FROM customer)
UNION ALL SELECT 'fail', count(*), count(c_name), 0 FROM customer""")
def schema_change_policy(w, spark, folder):
    stored = table(spark, folder, "customer").select("c_custkey", "c_name")
    incoming = table(spark, folder, "customer").select("c_custkey", F.lit(1).alias("extra"))
    synced = sync_columns(stored, incoming)
    try:
        assert_schema(incoming, stored.schema)
        accepted = stored.unionByName(incoming, allowMissingColumns=True)
    except SchemaDrift:  # the table stays as it was
        accepted = stored.withColumn("extra", F.lit(None).cast("int"))
    sync = synced.agg(F.lit("sync").alias("policy"), F.count("*").alias("N"), F.lit(0).cast("bigint").alias("OLD_COLUMN"), F.count("extra").alias("NEW_COLUMN"))
    fail = accepted.agg(F.lit("fail").alias("policy"), F.count("*").alias("N"), F.count("c_name").alias("OLD_COLUMN"), F.count("extra").alias("NEW_COLUMN"))
    return sync.unionByName(fail)


# ---- files ------------------------------------------------------------------------------------------------------
@query("read_parquet", "SELECT l_orderkey, l_shipdate FROM lineitem WHERE l_quantity > 45")
def read_parquet(w, spark, folder):
    return formats.read_parquet(spark, f"{folder}/lineitem.parquet").where("l_quantity > 45").select("l_orderkey", "l_shipdate")


CUSTOMER_TYPES = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _types(text):
    from pyspark.sql.types import StructType
    return StructType.fromDDL(text)


@query("read_delimited", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer")
def read_delimited(w, spark, folder):
    path = scratch_path(spark, "csv")
    dirty = F.when(F.col("c_custkey") % 5 == 0, "N/A").otherwise(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")))
    table(spark, folder, "customer").withColumn("c_mktsegment", dirty).write.option("header", "true").option("sep", "|").option(
        "ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return formats.read_delimited(spark, path, _types(CUSTOMER_TYPES), "|").drop("_FILE_NAME")


@query("read_json", "SELECT event_id, user_id, event_type, value FROM events")
def read_json(w, spark, folder):
    """Arrays of events, one array per line, and a broken line per array: the arrays come back as rows, the broken lines do not."""
    path = scratch_path(spark, "json")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    # an array per thousand event ids: its size does not grow with the table
    arrays = events.groupBy(F.floor(F.col("event_id") / 1000)).agg(F.to_json(F.collect_list(F.struct(*events.columns))).alias("value"))
    arrays.select(F.explode(F.array("value", F.concat(F.lit("[{"), F.substring("value", 1, 40)))).alias("value")).write.text(path)
    return formats.read_json(spark, path, _types("event_id bigint, user_id bigint, event_type string, value double")).drop("_FILE_NAME")


@query("read_stage", """SELECT c_custkey, c_name, TIMESTAMP '2024-01-31 00:00:00' AS _LOADED_AT, count(*) OVER () AS ROWS_IN_STAGE FROM customer""")
def read_stage(w, spark, folder):
    path = scratch_path(spark, "stage")
    table(spark, folder, "customer").repartition(3).write.option("header", "true").csv(path)
    rows = formats.read_stage(spark, formats.Stage(path, "csv_comma", _types(CUSTOMER_TYPES)), AS_OF_EVENTS)
    numbered = rows.groupBy("_FILE_NAME").agg(F.max("_FILE_ROW_NUMBER").alias("last"))
    total = numbered.agg(F.sum("last")).scalar()  # the last number of each file is its row count
    return rows.select("c_custkey", "c_name", "_LOADED_AT", total.alias("ROWS_IN_STAGE"))


@query("copy_into", """SELECT 'LOADED' AS STATUS, count(*) AS FILES_ROWS, count(*) AS ROWS_LOADED FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT 'SKIPPED', count(*), 0 FROM customer WHERE c_custkey % 3 = 0""")
def copy_into(w, spark, folder):
    """Three sets of files; the one with unreadable balances is skipped whole and logged, one has its columns the other way round."""
    path = scratch_path(spark, "copy")
    customer = table(spark, folder, "customer").withColumn("part", F.col("c_custkey") % 3)
    bad = F.when(F.col("part") == 0, "broken").otherwise(F.col("c_acctbal").cast("string"))
    dirty, names = customer.withColumn("c_acctbal", bad), [f.name for f in _types(CUSTOMER_TYPES)]
    for part, order in ((0, names), (1, names[::-1]), (2, [n.upper() for n in names])):
        dirty.where(F.col("part") == part).select(*[F.col(n).alias(n) for n in order]).write.option("header", "true").csv(f"{path}/part={part}")
    tables = TableFolder(spark, scratch_path(spark, "landing"))
    stage = formats.Stage(f"{path}/*", "csv_comma", _types(CUSTOMER_TYPES))
    for batch in (1, 2):  # the second run finds its files logged and loads nothing twice
        copy.copy_to_table(spark, stage, tables, "raw_customers", "SHOP", AS_OF_EVENTS, batch)
    log = tables.read(copy.LOG).dropDuplicates(["FILE_PATH", "STATUS"]).groupBy("STATUS").agg(F.sum("ROW_COUNT").alias("FILES_ROWS"))
    loaded = tables.read("raw_customers").agg(F.count("*")).scalar()
    return log.select("STATUS", "FILES_ROWS", F.when(F.col("STATUS") == "LOADED", loaded).otherwise(0).alias("ROWS_LOADED"))


@query("infer_schema_drift", """SELECT * FROM (VALUES ('c_nationkey', 'TYPE_CHANGE', 'string', 'int', 2), ('c_name', 'REMOVE', NULL, 'string', 2), ('c_region', 'ADD', 'int', NULL, 2))
  AS t(COLUMN_NAME, CHANGE_TYPE, NEW_TYPE, OLD_TYPE, SCHEMA_VERSION) WHERE (SELECT count(*) FROM customer) > 0""")
def infer_schema_drift(w, spark, folder):
    first, second = scratch_path(spark, "drift"), scratch_path(spark, "drift")
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    customer.write.option("header", "true").csv(first)
    customer.select("c_custkey", F.concat(F.lit("N"), F.col("c_nationkey")).alias("c_nationkey"), (F.col("c_nationkey") % 5).alias("c_region")).write.option("header", "true").csv(second)
    before = drift.detect_drift(drift.infer_from_files(spark, first), None, "SHOP", "CUSTOMER", AS_OF_EVENTS)
    after = drift.detect_drift(drift.infer_from_files(spark, second), before.registry, "SHOP", "CUSTOMER", AS_OF_EVENTS)
    return after.changes.withColumn("SCHEMA_VERSION", F.lit(after.version))


@query("landing_schemas", """SELECT 'RAW_CUSTOMERS' AS TABLE_NAME, count(*) AS N FROM raw_customers UNION ALL SELECT 'RAW_ORDERS', count(*) FROM raw_orders
UNION ALL SELECT 'RAW_PRODUCTS', count(*) FROM raw_products UNION ALL SELECT 'RAW_ORDER_ITEMS', count(*) FROM raw_order_items UNION ALL SELECT 'RAW_STREAM_EVENTS', count(*) FROM events
UNION ALL SELECT 'RAW_CDC_EVENTS', count(*) FROM events""")
def landing_schemas(w, spark, folder):
    """Every landing table has the declared columns and types; counted to show the rows were read."""
    frames = {"RAW_CUSTOMERS": w.landing.customers, "RAW_ORDERS": w.landing.orders, "RAW_PRODUCTS": w.landing.products,
              "RAW_ORDER_ITEMS": w.landing.order_items, "RAW_STREAM_EVENTS": testbed.stream_events(spark, folder),
              "RAW_CDC_EVENTS": testbed.cdc_events(spark, folder)}
    out = None
    for name, df in frames.items():
        assert_schema(df, LANDING[name])
        counted = df.agg(F.count("*").alias("N")).select(F.lit(name).alias("TABLE_NAME"), "N")
        out = counted if out is None else out.unionByName(counted)
    return out


@query("write_archive", f"""SELECT CAST(year(LOAD_DATETIME) AS INTEGER) AS LOAD_YEAR, count(*) AS N FROM hub_order WHERE LOAD_DATETIME < CAST({AS_OF} AS DATE) - INTERVAL 2 YEAR GROUP BY 1""")
def archive_written(w, spark, folder):
    from ..sources.tables import archive_older_than
    path = scratch_path(spark, "archive")
    write_archive(archive_older_than(w.hub_order, w.as_of), path)
    return spark.read.parquet(path).groupBy("LOAD_YEAR").agg(F.count("*").alias("N"))
