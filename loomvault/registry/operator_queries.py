"""Projections, joins, aggregates, windows, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import config
from ..functions import dates, scoring, text
from ..functions.dates import at
from ..functions.keys import hash_diff, hash_key, row_id, surrogate_key
from ..operators import history, ranking
from ..plans.vault import newer_than
from ..sources import seeds
from ..sources.testbed import AS_OF_EVENTS, table
from .base import CTES, query
from .ctes import AS_OF, AS_OF_EVENTS as SQL_EVENTS_NOW
from .ctes import hd, hk, newest


def values(seed_name: str, *columns: str) -> str:
    """A reference list as an inline SQL table."""
    import csv
    import io
    header, *rows = csv.reader(io.StringIO(seeds.SEEDS[seed_name][0]))
    quoted = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in r) + ")" for r in rows)
    return f"(VALUES {quoted}) AS {seed_name}({', '.join(header)})"


# ---- keys, casts, incremental predicates ----------------------------------------------------
@query("hash_key", f"SELECT l_orderkey, l_linenumber, {hk('l_orderkey', 'l_linenumber', 'l_returnflag')} AS HK FROM lineitem")
def q_hash_key(w, spark, folder):
    li = table(spark, folder, "lineitem")
    return li.select("l_orderkey", "l_linenumber", hash_key(li, "l_orderkey", "l_linenumber", "l_returnflag").alias("HK"))


@query("hash_diff", f"SELECT CUSTOMER_ID, _LOADED_AT, {hd('GENDER', 'PHONE', 'LOYALTY_TIER', 'DATE_OF_BIRTH')} AS HD FROM raw_customers")
def q_hash_diff(w, spark, folder):
    raw = w.landing.customers
    return raw.select("CUSTOMER_ID", "_LOADED_AT", hash_diff(raw, "GENDER", "PHONE", "LOYALTY_TIER", "DATE_OF_BIRTH").alias("HD"))


@query("surrogate_key", f"SELECT o_orderkey, {hk('o_orderkey', 'o_orderpriority')} AS ORDER_SK FROM orders")
def q_surrogate_key(w, spark, folder):
    o = table(spark, folder, "orders")
    return o.select("o_orderkey", surrogate_key(o, "o_orderkey", "o_orderpriority").alias("ORDER_SK"))


@query("safe_cast", """SELECT event_id, coalesce(try_cast(replace(replace(props, '{"k": ', ''), '}', '') AS INTEGER), -1) AS k,
  coalesce(try_cast(event_type AS INTEGER), 0) AS type_as_int, try_cast(event_type AS DATE) AS type_as_date FROM events""")
def q_safe_cast(w, spark, folder):
    number = F.replace(F.replace("props", F.lit('{"k": '), F.lit("")), F.lit("}"), F.lit(""))
    return table(spark, folder, "events").select(
        "event_id", text.safe_cast(number, "int", -1).alias("k"), text.safe_cast(F.col("event_type"), "int", 0).alias("type_as_int"),
        text.safe_cast(F.col("event_type"), "date").alias("type_as_date"),
    )


@query("incremental_lookback", "SELECT event_id, ts, value FROM events WHERE ts >= DATE '2024-01-28'")
def q_lookback(w, spark, folder):
    return table(spark, folder, "events").where(F.col("ts") >= dates.lookback_start(AS_OF_EVENTS)).select("event_id", "ts", "value")


@query("incremental_filter", """SELECT ORDER_ID, ORDER_STATUS, LOAD_DATETIME FROM stg_orders
WHERE LOAD_DATETIME > (SELECT coalesce(max(LOAD_DATETIME), TIMESTAMP '1900-01-01') FROM stg_orders WHERE LOAD_DATETIME < TIMESTAMP '2000-01-01')""")
def q_incremental_filter(w, spark, folder):
    stored = w.stg_orders.where(F.col("LOAD_DATETIME") < at("2000-01-01 00:00:00"))
    return newer_than(w.stg_orders, stored).select("ORDER_ID", "ORDER_STATUS", "LOAD_DATETIME")


@query("audit_columns", f"""SELECT o_orderkey, {AS_OF} AS _DW_LOADED_AT, 'BRONZE' AS _DW_SCHEMA, 'ORDERS' AS _DW_MODEL_NAME, 'run-1' AS _DW_INVOCATION_ID FROM orders""")
def q_audit_columns(w, spark, folder):
    from ..operators.observe import audit_columns
    return audit_columns(table(spark, folder, "orders").select("o_orderkey"), "BRONZE", "ORDERS", "run-1", w.as_of)


@query("status_filter", """SELECT ORDER_ID, ORDER_STATUS, TOTAL_AMOUNT::DOUBLE AS TOTAL_AMOUNT FROM stg_orders
WHERE ORDER_STATUS NOT IN ('CANCELLED', 'REFUNDED') AND SHIPPING_METHOD IN ('EXPRESS', 'OVERNIGHT') AND PAYMENT_METHOD LIKE '%CARD'
  AND FULFILLMENT_DATE IS NULL AND TOTAL_AMOUNT BETWEEN 100 AND 400""")
def q_status_filter(w, spark, folder):
    c = F.col
    kept = w.stg_orders.where(
        ~c("ORDER_STATUS").isin(*config.UNCOUNTED_STATUSES) & c("SHIPPING_METHOD").isin("EXPRESS", "OVERNIGHT")
        & c("PAYMENT_METHOD").like("%CARD") & c("FULFILLMENT_DATE").isNull() & c("TOTAL_AMOUNT").between(100, 400)
    )
    return kept.select("ORDER_ID", "ORDER_STATUS", "TOTAL_AMOUNT")


@query("case_bucket", """SELECT o_orderkey, CASE WHEN o_totalprice >= 400000 THEN 'PLATINUM' WHEN o_totalprice >= 200000 THEN 'GOLD' ELSE 'BASE' END AS tier,
  CASE WHEN o_custkey > 365 THEN 'HIGH' WHEN o_custkey > 180 THEN 'MEDIUM' WHEN o_custkey > 90 THEN 'LOW' ELSE 'ACTIVE' END AS churn,
  CASE WHEN o_orderkey % 30 <= 6 THEN 'GREEN' WHEN o_orderkey % 30 <= 12 THEN 'YELLOW' WHEN o_orderkey % 30 <= 24 THEN 'ORANGE' ELSE 'RED' END AS colour FROM orders""")
def q_case_bucket(w, spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        scoring.bucket_at_least(F.col("o_totalprice"), ((400000, "PLATINUM"), (200000, "GOLD")), "BASE").alias("tier"),
        scoring.churn_risk(F.col("o_custkey")).alias("churn"),
        scoring.bucket_at_most(F.col("o_orderkey") % 30, config.LAYER_SLA_HOURS, "RED").alias("colour"),
    )


# ---- joins ----------------------------------------------------------------------------------
@query("join_inner_equi", """SELECT l.HK_LINK_CUSTOMER_ORDER, c.CUSTOMER_ID, o.ORDER_ID FROM link_customer_order l
JOIN hub_customer c ON l.HK_CUSTOMER = c.HK_CUSTOMER JOIN hub_order o ON l.HK_ORDER = o.HK_ORDER""")
def q_inner(w, spark, folder):
    return (
        w.link_customer_order.join(w.hub_customer.select("HK_CUSTOMER", "CUSTOMER_ID"), "HK_CUSTOMER")
        .join(w.hub_order.select("HK_ORDER", "ORDER_ID"), "HK_ORDER").select("HK_LINK_CUSTOMER_ORDER", "CUSTOMER_ID", "ORDER_ID")
    )


@query("join_left_equi", f"""SELECT h.CUSTOMER_ID, d.EMAIL, m.LOYALTY_TIER FROM hub_customer h LEFT JOIN {newest('sat_customer_details', 'HK_CUSTOMER')} d ON h.HK_CUSTOMER = d.HK_CUSTOMER
LEFT JOIN {newest('sat_customer_demographics', 'HK_CUSTOMER')} m ON h.HK_CUSTOMER = m.HK_CUSTOMER""")
def q_left(w, spark, folder):
    details = history.latest_per_key(w.sat_customer_details.select("HK_CUSTOMER", "EMAIL", "LOAD_DATETIME"), "HK_CUSTOMER", ["LOAD_DATETIME"])
    demo = history.latest_per_key(w.sat_customer_demographics.select("HK_CUSTOMER", "LOYALTY_TIER", "LOAD_DATETIME"), "HK_CUSTOMER", ["LOAD_DATETIME"])
    return w.hub_customer.join(details, "HK_CUSTOMER", "left").join(demo, "HK_CUSTOMER", "left").select("CUSTOMER_ID", "EMAIL", "LOYALTY_TIER")


@query("join_inner_filtered", """SELECT l.HK_CUSTOMER, d.HK_ORDER, d.ORDER_STATUS, d.LOAD_DATETIME FROM link_customer_order l
JOIN sat_order_details d ON l.HK_ORDER = d.HK_ORDER AND d.ORDER_STATUS NOT IN ('CANCELLED', 'REFUNDED')""")
def q_inner_filtered(w, spark, folder):
    details = w.sat_order_details.select("HK_ORDER", "ORDER_STATUS", "LOAD_DATETIME")
    link = w.link_customer_order.select("HK_CUSTOMER", F.col("HK_ORDER").alias("LINK_ORDER"))
    on = (F.col("LINK_ORDER") == F.col("HK_ORDER")) & ~F.col("ORDER_STATUS").isin(*config.UNCOUNTED_STATUSES)
    return link.join(details, on).drop("LINK_ORDER")


@query("anti_join_new_keys", """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_custkey IS NOT NULL)""")
def q_anti_new(w, spark, folder):
    seen = table(spark, folder, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, folder, "customer").select("c_custkey", "c_name").join(seen, "c_custkey", "left_anti")


@query("anti_join_null", """SELECT d.doc_id, d.source FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL""")
def q_anti_null(w, spark, folder):
    return table(spark, folder, "documents").select("doc_id", "source").join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_anti")


@query("semi_join_in", """SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')
  AND c_mktsegment IN (SELECT unnest(['BUILDING', 'MACHINERY']))""")
def q_semi(w, spark, folder):
    buyers = table(spark, folder, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("c_custkey"))
    listed = F.array_contains(F.from_json(F.lit('["BUILDING", "MACHINERY"]'), "array<string>"), F.col("c_mktsegment"))
    return table(spark, folder, "customer").where(listed).join(buyers, "c_custkey", "left_semi").select("c_custkey", "c_mktsegment")


@query("asof_join", """SELECT e.event_id, e.user_id, e.ts, p.ts AS last_purchase_ts, p.value AS last_purchase_value FROM events e
ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts) p ON e.user_id = p.user_id AND e.ts >= p.ts""")
def q_asof(w, spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type", "value")
    buys = events.where("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("last_purchase_ts")).agg(F.max("value").alias("last_purchase_value"))
    return history.asof_join(events.select("event_id", "user_id", "ts"), buys, "user_id", "ts", "last_purchase_ts", ["last_purchase_value"])


@query("latest_join", f"""SELECT l.HK_LINK_CUSTOMER_ORDER, e.IS_ACTIVE, e.ORDER_STATUS FROM link_customer_order l
LEFT JOIN {newest('eff_sat_customer_order', 'HK_LINK_CUSTOMER_ORDER')} e USING (HK_LINK_CUSTOMER_ORDER)""")
def q_latest_join(w, spark, folder):
    key = "HK_LINK_CUSTOMER_ORDER"
    eff = history.latest_per_key(w.eff_sat_customer_order.select(key, "IS_ACTIVE", "ORDER_STATUS", "LOAD_DATETIME"), key, ["LOAD_DATETIME"])
    return w.link_customer_order.select(key).join(eff.drop("LOAD_DATETIME"), key, "left")


@query("join_to_snapshot", """SELECT p.HK_CUSTOMER, p.PIT_LOAD_DATETIME, m.LOYALTY_TIER, m.CUSTOMER_SEGMENT FROM pit_customer p
LEFT JOIN sat_customer_demographics m ON p.HK_CUSTOMER = m.HK_CUSTOMER AND p.SAT_CUSTOMER_DEMOGRAPHICS_LDTS = m.LOAD_DATETIME""")
def q_snapshot_join(w, spark, folder):
    sat = w.sat_customer_demographics.select(
        "HK_CUSTOMER", F.col("LOAD_DATETIME").alias("SAT_CUSTOMER_DEMOGRAPHICS_LDTS"), "LOYALTY_TIER", "CUSTOMER_SEGMENT")
    return (
        w.pit_customer.join(sat, ["HK_CUSTOMER", "SAT_CUSTOMER_DEMOGRAPHICS_LDTS"], "left")
        .select("HK_CUSTOMER", "PIT_LOAD_DATETIME", "LOYALTY_TIER", "CUSTOMER_SEGMENT")
    )


# ---- aggregates -----------------------------------------------------------------------------
@query("agg_group_basic", """SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS average,
  min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders GROUP BY o_custkey""")
def q_group(w, spark, folder):
    return table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.round(F.avg("o_totalprice"), 4).alias("average"),
        F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"),
    )


@query("agg_count_distinct", """SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag""")
def q_distinct(w, spark, folder):
    # Two stages per column: distinct (group, value) pairs first, so a group with most rows is spread over many tasks.
    li = table(spark, folder, "lineitem")
    orders = li.select("l_returnflag", "l_orderkey").distinct().groupBy("l_returnflag").agg(F.count("l_orderkey").alias("orders"))
    parts = li.select("l_returnflag", "l_partkey").distinct().groupBy("l_returnflag").agg(F.count("l_partkey").alias("parts"))
    return orders.join(parts, "l_returnflag", "full_outer")


@query("agg_conditional_distinct", """SELECT date_trunc('month', o.o_orderdate)::DATE AS month,
  count(DISTINCT CASE WHEN date_trunc('month', f.first_date) = date_trunc('month', o.o_orderdate) THEN o.o_custkey END) AS new_customers,
  count(DISTINCT CASE WHEN date_trunc('month', f.first_date) < date_trunc('month', o.o_orderdate) THEN o.o_custkey END) AS returning_customers
FROM orders o JOIN (SELECT o_custkey, min(o_orderdate) AS first_date FROM orders GROUP BY o_custkey) f ON o.o_custkey = f.o_custkey GROUP BY 1""")
def q_conditional_distinct(w, spark, folder):
    month = F.trunc(F.to_date("o_orderdate"), "month").alias("month")
    monthly = table(spark, folder, "orders").select("o_custkey", month).distinct()
    first = F.min("month").over(Window.partitionBy("o_custkey"))  # at most one row per customer and month
    return monthly.withColumn("first_month", first).groupBy("month").agg(
        F.count_if(F.col("first_month") == F.col("month")).alias("new_customers"),
        F.count_if(F.col("first_month") < F.col("month")).alias("returning_customers"),
    )


@query("agg_global", """SELECT count(*) AS n, max(o_orderdate) AS latest, min(o_orderdate) AS earliest FROM orders""")
def q_global(w, spark, folder):
    return table(spark, folder, "orders").agg(
        F.count("*").alias("n"), F.max("o_orderdate").alias("latest"), F.min("o_orderdate").alias("earliest"))


@query("agg_having", """SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_having(w, spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("cnt")).where("cnt > 1")


@query("agg_array_distinct", """SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS event_types FROM events GROUP BY user_id""")
def q_array_distinct(w, spark, folder):
    return table(spark, folder, "events").groupBy("user_id").agg(
        F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("event_types"))


@query("agg_first_order", """SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, f.first_date, o.o_orderdate = f.first_date AS is_first
FROM orders o JOIN (SELECT o_custkey, min(o_orderdate) AS first_date FROM orders GROUP BY o_custkey) f ON o.o_custkey = f.o_custkey""")
def q_first_order(w, spark, folder):
    # An aggregate joined back, not a window: partial minima shrink a hot customer before the exchange
    # and the join can split its rows.
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    first = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_date"))
    return orders.join(first, "o_custkey").withColumn("is_first", F.col("o_orderdate") == F.col("first_date"))


@query("earliest_per_key", """SELECT user_id, ts, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""")
def q_earliest(w, spark, folder):
    return history.earliest_per_key(table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"])


@query("latest_per_key", """SELECT user_id, ts, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_latest(w, spark, folder):
    return history.latest_per_key(table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"])


# ---- windows --------------------------------------------------------------------------------
@query("win_row_number", """SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def q_row_number(w, spark, folder):
    newest_first = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    # row_number = 1 becomes a per-task group limit before the exchange
    return (
        table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
        .withColumn("rn", F.row_number().over(newest_first)).where("rn = 1").drop("rn")
    )


@query("win_lag", """SELECT HK_ORDER, ORDER_STATUS, LOAD_DATETIME, lag(ORDER_STATUS) OVER w AS PREVIOUS_STATUS, lag(LOAD_DATETIME) OVER w AS PREVIOUS_STATUS_TS
FROM sat_order_details WINDOW w AS (PARTITION BY HK_ORDER ORDER BY LOAD_DATETIME)""")
def q_lag(w, spark, folder):
    sat = w.sat_order_details.select("HK_ORDER", "ORDER_STATUS", "LOAD_DATETIME")
    return history.previous_of(sat, "HK_ORDER", ["LOAD_DATETIME"], {"PREVIOUS_STATUS": "ORDER_STATUS", "PREVIOUS_STATUS_TS": "LOAD_DATETIME"})


@query("win_lag_consecutive_dup", """SELECT HK_CUSTOMER, HD_CUSTOMER_DETAILS, LOAD_DATETIME FROM (
  SELECT *, lag(HD_CUSTOMER_DETAILS) OVER (PARTITION BY HK_CUSTOMER ORDER BY LOAD_DATETIME) AS prev FROM stg_customers) WHERE prev = HD_CUSTOMER_DETAILS""")
def q_consecutive(w, spark, folder):
    rows = w.stg_customers.select("HK_CUSTOMER", "HD_CUSTOMER_DETAILS", "LOAD_DATETIME")
    seen = history.previous_of(rows, "HK_CUSTOMER", ["LOAD_DATETIME"], {"prev": "HD_CUSTOMER_DETAILS"})
    return seen.where("prev = HD_CUSTOMER_DETAILS").drop("prev")


@query("win_ntile", """SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS quintile,
  CAST(ntile(7) OVER (ORDER BY o_orderdate DESC, o_orderkey) AS INTEGER) AS recency FROM orders""")
def q_ntile(w, spark, folder):
    orders = table(spark, folder, "orders")
    ranks, rows = ranking.global_ranks(orders, "o_orderkey", {
        "PRICE": F.col("o_totalprice"), "DAYS": dates.days_between(F.col("o_orderdate"), at(w.as_of)),
    })
    return ranks.select("o_orderkey", ranking.ntile_of(F.col("PRICE_POSITION"), rows, 5).alias("quintile"),
                        ranking.ntile_of(F.col("DAYS_POSITION"), rows, 7).alias("recency"))


@query("win_percent_rank", """SELECT c_custkey, percent_rank() OVER (ORDER BY c_nationkey) AS by_nation, percent_rank() OVER (ORDER BY c_acctbal) AS by_balance FROM customer""")
def q_percent_rank(w, spark, folder):
    ranks, rows = ranking.global_ranks(table(spark, folder, "customer"), "c_custkey", {"N": F.col("c_nationkey"), "B": F.col("c_acctbal")})
    return ranks.select("c_custkey", ranking.percent_rank_of(F.col("N_RANK"), rows).alias("by_nation"),
                        ranking.percent_rank_of(F.col("B_RANK"), rows).alias("by_balance"))


# ---- order, set operations -------------------------------------------------------------------
@query("sort_report", """SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL ORDER BY o_orderpriority, n DESC""")
def q_sort(w, spark, folder):
    return table(spark, folder, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n")).orderBy("o_orderpriority", F.desc("n"))


@query("topk_latest", """SELECT event_id, user_id, ts FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 1""")
def q_topk(w, spark, folder):
    return table(spark, folder, "events").where("event_type = 'error'").select("event_id", "user_id", "ts").orderBy(F.desc("ts"), F.desc("event_id")).limit(1)


@query("union_all", """SELECT 'customer' AS side, c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier', s_nationkey, s_acctbal FROM supplier""")
def q_union_all(w, spark, folder):
    left = table(spark, folder, "customer").select(F.lit("customer").alias("side"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    right = table(spark, folder, "supplier").select(F.lit("supplier").alias("side"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return left.unionByName(right)


@query("union_distinct", """SELECT HK_CUSTOMER, LOAD_DATETIME FROM hub_customer UNION SELECT HK_CUSTOMER, LOAD_DATETIME FROM sat_customer_details
UNION SELECT HK_CUSTOMER, LOAD_DATETIME FROM sat_customer_demographics""")
def q_union_distinct(w, spark, folder):
    parts = [t.select("HK_CUSTOMER", "LOAD_DATETIME") for t in (w.hub_customer, w.sat_customer_details, w.sat_customer_demographics)]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


# ---- scalar functions -------------------------------------------------------------------------
@query("fn_string", """SELECT c_custkey, trim('  ' || c_name || ' ') AS trimmed, upper(c_name) AS up, lower(c_mktsegment) AS low,
  upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS words, concat('S-', c_mktsegment) AS joined, c_name || '/' || c_mktsegment AS piped,
  concat_ws('|', c_name, NULL, c_mktsegment) AS ws, left(c_name, 4) AS l4, right(c_name, 4) AS r4, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS padded,
  regexp_replace(c_name, '^(.{2})(.*)(#.*)$', '\\1***\\3') AS masked, c_name LIKE '%#0000001%' AS liked FROM customer""")
def q_string(w, spark, folder):
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        "c_custkey", F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"), F.upper(name).alias("up"), F.lower(seg).alias("low"),
        text.capitalise_words(seg).alias("words"), F.concat(F.lit("S-"), seg).alias("joined"), F.concat(name, F.lit("/"), seg).alias("piped"),
        F.concat_ws("|", name, F.lit(None).cast("string"), seg).alias("ws"), F.left(name, F.lit(4)).alias("l4"), F.right(name, F.lit(4)).alias("r4"),
        F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("padded"),
        F.regexp_replace(name, "^(.{2})(.*)(#.*)$", "$1***$3").alias("masked"), name.like("%#0000001%").alias("liked"),
    )


@query("fn_date", """SELECT o_orderkey, CAST(year(d) AS INTEGER) AS y, CAST(quarter(d) AS INTEGER) AS q, CAST(month(d) AS INTEGER) AS m, CAST(weekofyear(d) AS INTEGER) AS w,
  CAST(dayofyear(d) AS INTEGER) AS doy, CAST(day(d) AS INTEGER) AS dom, CAST(dayofweek(d) AS INTEGER) AS dow, strftime(d, '%a') AS dn, strftime(d, '%b') AS mn,
  last_day(d) AS ld, strftime(d, '%Y%m%d') AS dk, make_date(year(d), 1, 1) AS jan1, CAST(date_trunc('month', d) AS DATE) AS m1 FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def q_date(w, spark, folder):
    d = F.to_date("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey", F.year(d).alias("y"), F.quarter(d).alias("q"), F.month(d).alias("m"), F.weekofyear(d).alias("w"), F.dayofyear(d).alias("doy"),
        F.dayofmonth(d).alias("dom"), dates.weekday_from_sunday(d).alias("dow"), F.dayname(d).alias("dn"), F.monthname(d).alias("mn"), F.last_day(d).alias("ld"),
        dates.date_key(d).alias("dk"), F.make_date(F.year(d), F.lit(1), F.lit(1)).alias("jan1"), F.trunc(d, "month").alias("m1"),
    )


@query("fn_datediff", f"""SELECT event_id, date_diff('second', ts, {SQL_EVENTS_NOW}) AS secs, date_diff('minute', ts, {SQL_EVENTS_NOW}) AS mins,
  CAST(date_diff('hour', ts, {SQL_EVENTS_NOW}) AS INTEGER) AS hours, CAST(date_diff('day', ts, {SQL_EVENTS_NOW}) AS INTEGER) AS days,
  CAST(date_diff('month', ts, TIMESTAMP '2025-03-01') AS INTEGER) AS months, ts + INTERVAL 5 HOUR AS plus_hours, ts - INTERVAL 7 DAY AS minus_days,
  CAST(CAST(ts AS DATE) + INTERVAL 2 YEAR AS DATE) AS plus_years FROM events""")
def q_datediff(w, spark, folder):
    ts, now = F.col("ts"), at(AS_OF_EVENTS)
    return table(spark, folder, "events").select(
        "event_id", dates.seconds_between(ts, now).alias("secs"), dates.minutes_between(ts, now).alias("mins"), dates.hours_between(ts, now).alias("hours"),
        dates.days_between(ts, now).alias("days"), dates.months_between(ts, at("2025-03-01 00:00:00")).alias("months"),
        dates.add_hours(ts, 5).alias("plus_hours"), dates.add_days(ts, -7).alias("minus_days"), F.add_months(F.to_date(ts), 24).alias("plus_years"),
    )


@query("fn_math", """SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_shipdate, CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)), 1) AS DOUBLE) AS rounded, CAST(ceil(l_quantity / 3.0::DOUBLE) AS BIGINT) AS boxes,
  CAST(CAST(l_extendedprice AS DECIMAL(18,4)) - CAST(l_quantity AS DECIMAL(18,4)) AS DOUBLE) AS less FROM lineitem""")
def q_math(w, spark, folder):
    price, qty = F.col("l_extendedprice").cast("decimal(18,4)"), F.col("l_quantity")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_shipdate", F.round(price, 1).alias("rounded"), F.ceil(qty / 3.0).alias("boxes"),
        (price - qty.cast("decimal(18,4)")).alias("less"),
    )


@query("fn_conditional", """SELECT ORDER_ID, ORDER_STATUS, _LOADED_AT, CAST(coalesce(DISCOUNT_AMOUNT, 0) AS DOUBLE) AS discount, CAST(nullif(TAX_AMOUNT, 0) AS DOUBLE) AS tax,
  CASE WHEN FULFILLMENT_DATE IS NULL THEN 'OPEN' WHEN ORDER_STATUS IN ('shipped') THEN 'MOVING' ELSE 'DONE' END AS state,
  nullif(ORDER_STATUS, 'pending') IN ('confirmed', 'shipped') AS three_valued FROM raw_orders""")
def q_conditional(w, spark, folder):
    zero = F.lit(0).cast("decimal(18,4)")
    return w.landing.orders.select(
        "ORDER_ID", "ORDER_STATUS", "_LOADED_AT", F.coalesce("DISCOUNT_AMOUNT", zero).alias("discount"), F.nullif("TAX_AMOUNT", zero).alias("tax"),
        F.when(F.col("FULFILLMENT_DATE").isNull(), "OPEN").when(F.col("ORDER_STATUS").isin("shipped"), "MOVING").otherwise("DONE").alias("state"),
        F.nullif("ORDER_STATUS", F.lit("pending")).isin("confirmed", "shipped").alias("three_valued"),
    )


@query("fn_cast", """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS as_text, CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR) AS as_decimal_text,
  CAST(o_orderdate AS DATE) AS as_date, try_cast(o_orderpriority AS DOUBLE) AS as_double, try_cast(left(o_orderpriority, 1) AS INTEGER) AS as_int FROM orders""")
def q_cast(w, spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("as_text"), F.col("o_totalprice").cast("decimal(18,4)").cast("string").alias("as_decimal_text"),
        F.col("o_orderdate").cast("date").alias("as_date"), F.col("o_orderpriority").try_cast("double").alias("as_double"),
        F.left("o_orderpriority", F.lit(1)).try_cast("int").alias("as_int"),
    )


@query("fn_hash", "SELECT p_partkey, sha256(p_name) AS h FROM part")
def q_hash(w, spark, folder):
    return table(spark, folder, "part").select("p_partkey", F.sha2("p_name", 256).alias("h"))


@query("fn_json_array", """SELECT e.event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, u.tag, '{"type":"' || event_type || '","user":' || user_id || '}' AS object_text
FROM events e, LATERAL (SELECT unnest([event_type, CAST(user_id % 3 AS VARCHAR)]) AS tag) u""")
def q_json(w, spark, folder):
    props = F.parse_json("props")
    tagged = table(spark, folder, "events").withColumn("tag", F.explode(F.array("event_type", (F.col("user_id") % 3).cast("string"))))
    return tagged.select(
        "event_id", F.variant_get(props, "$.k", "int").alias("k"), "tag",
        F.to_json(F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"))).alias("object_text"),
    )


@query("fn_uuid_meta", f"SELECT event_id, {hd('event_id', 'event_type')} AS ROW_UUID FROM events")
def q_uuid(w, spark, folder):
    return table(spark, folder, "events").select("event_id", row_id(F.col("event_id"), F.col("event_type")).alias("ROW_UUID"))


# ---- reference lists ----------------------------------------------------------------------------
LISTS = {  # list -> its code and name, and the staged column that uses the code
    "country_codes": ("country_code", "country_name", "stg_customers", "COUNTRY_CODE"),
    "order_status_mapping": ("order_status_code", "order_status_name", "stg_orders", "ORDER_STATUS"),
    "payment_methods": ("payment_method_code", "payment_method_name", "stg_orders", "PAYMENT_METHOD"),
    "product_categories": ("category_name", "department", "stg_products", "CATEGORY"),
}


@query("seed_load", " UNION ALL ".join(
    f"SELECT '{n}' AS LIST, {n}.{code} AS CODE, {n}.{name} AS NAME, count(u.{used}) AS USES FROM {values(n)} LEFT JOIN {staged} u ON upper({n}.{code}) = u.{used} GROUP BY ALL"
    for n, (code, name, staged, used) in LISTS.items()))
def q_seed_load(w, spark, folder):
    """Every entry of the four lists with the number of staged rows that use it."""
    out = None
    for n, (code, name, staged, used) in LISTS.items():
        uses = getattr(w, staged).groupBy(F.col(used).alias("used")).agg(F.count("*").alias("USES"))
        entries = seeds.seed(spark, n).select(F.lit(n).alias("LIST"), F.col(code).alias("CODE"), F.col(name).alias("NAME"))
        counted = entries.join(uses, F.upper("CODE") == F.col("used"), "left").select("LIST", "CODE", "NAME", F.coalesce("USES", F.lit(0)).alias("USES"))
        out = counted if out is None else out.unionByName(counted)
    return out


@query("seed_enrich", f"""SELECT o.ORDER_ID, o.LOAD_DATETIME, o.ORDER_STATUS, order_status_mapping.status_category, CAST(order_status_mapping.is_terminal AS BOOLEAN) AS is_terminal, payment_methods.payment_type
FROM stg_orders o LEFT JOIN {values('order_status_mapping')} ON o.ORDER_STATUS = order_status_mapping.order_status_code
LEFT JOIN {values('payment_methods')} ON o.PAYMENT_METHOD = payment_methods.payment_method_code""")
def q_seed_enrich(w, spark, folder):
    status, payment = seeds.seed(spark, "order_status_mapping"), seeds.seed(spark, "payment_methods")
    out = seeds.enrich(w.stg_orders, status, "ORDER_STATUS", "order_status_code")
    out = seeds.enrich(out, payment, "PAYMENT_METHOD", "payment_method_code")
    return out.select("ORDER_ID", "LOAD_DATETIME", "ORDER_STATUS", "status_category", "is_terminal", "payment_type")


@query("category_hierarchy", """SELECT c.category_name, c.parent_category, coalesce(p.category_name, c.category_name) AS top_category, CASE WHEN p.category_name IS NULL THEN 1 ELSE 2 END AS depth
FROM (SELECT DISTINCT upper(p_name) AS category_name, upper(p_type) AS parent_category FROM part UNION SELECT DISTINCT upper(p_type), NULL FROM part WHERE p_type <> 'ECONOMY') c
LEFT JOIN (SELECT DISTINCT upper(p_type) AS category_name FROM part WHERE p_type <> 'ECONOMY' UNION SELECT DISTINCT upper(p_name) FROM part) p ON c.parent_category = p.category_name""")
def q_hierarchy(w, spark, folder):
    part = table(spark, folder, "part")
    children = part.select(F.upper("p_name").alias("category_name"), F.upper("p_type").alias("parent_category"))
    tops = part.where("p_type <> 'ECONOMY'").select(F.upper("p_type").alias("category_name"), F.lit(None).cast("string").alias("parent_category"))
    return seeds.category_hierarchy(children.union(tops).distinct())


@query("archive_older_than", f"SELECT HK_ORDER, ORDER_ID, LOAD_DATETIME, RECORD_SOURCE, CAST(year(LOAD_DATETIME) AS INTEGER) AS LOAD_YEAR FROM hub_order WHERE LOAD_DATETIME < CAST({AS_OF} AS DATE) - INTERVAL 2 YEAR")
def q_archive(w, spark, folder):
    from ..sources.tables import archive_older_than
    return archive_older_than(w.hub_order, w.as_of)


# ---- product search ------------------------------------------------------------------------------
CTES["search_tf"] = """SELECT PRODUCT_ID, term, count(*) AS tf FROM (
  SELECT PRODUCT_ID, unnest(string_split(lower(PRODUCT_DESCRIPTION), ' ')) AS term FROM product_search_corpus) WHERE term <> '' GROUP BY ALL"""
CTES["search_idf"] = """SELECT term, ln((1 + (SELECT count(*) FROM product_search_corpus)) / (1 + count(*))::DOUBLE) + 1 AS idf FROM search_tf GROUP BY term"""
CTES["search_queries"] = "SELECT DISTINCT p_type || ' ' || p_brand AS QUERY_ID, p_type || ' ' || p_brand AS q FROM part"
CTES["search_query_terms"] = """SELECT QUERY_ID, term, idf * tf AS qw, sqrt(sum(idf * tf * idf * tf) OVER (PARTITION BY QUERY_ID)) AS qn FROM (
  SELECT QUERY_ID, term, count(*) AS tf FROM (SELECT QUERY_ID, unnest(string_split(lower(q), ' ')) AS term FROM search_queries) GROUP BY ALL) JOIN search_idf USING (term)"""
CTES["search_weights"] = """SELECT PRODUCT_ID, term, idf * tf AS w, sqrt(sum(idf * tf * idf * tf) OVER (PARTITION BY PRODUCT_ID)) AS n
FROM search_tf JOIN search_idf USING (term)"""


@query("product_search_topk", """SELECT QUERY_ID, PRODUCT_ID, round(SCORE, 6) AS SCORE FROM (
  SELECT q.QUERY_ID, d.PRODUCT_ID, sum(q.qw * d.w) / (any_value(q.qn) * any_value(d.n)) AS SCORE
  FROM search_query_terms q JOIN search_weights d ON q.term = d.term GROUP BY q.QUERY_ID, d.PRODUCT_ID)
QUALIFY row_number() OVER (PARTITION BY QUERY_ID ORDER BY round(SCORE, 9) DESC, PRODUCT_ID) <= 3""")
def q_search(w, spark, folder):
    from ..plans.search import search_topk
    asked = F.concat_ws(" ", "p_type", "p_brand")
    wanted = table(spark, folder, "part").select(asked.alias("QUERY_ID"), asked.alias("QUERY_TEXT")).distinct()
    found = search_topk(w.product_search_corpus, wanted, "PRODUCT_ID", "PRODUCT_DESCRIPTION", "QUERY_ID", "QUERY_TEXT", 3)
    return found.select("QUERY_ID", "PRODUCT_ID", F.round("SCORE", 6).alias("SCORE"))
