"""Named SQL expressions of the check side: landing, staging, vault, silver and gold.

Written for the checking engine only and independent of the DataFrame code.
"""

from __future__ import annotations

from .base import CTES

AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"
AS_OF_EVENTS = "TIMESTAMP '2024-01-31 00:00:00'"


def digest(null: str, *cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{null}')" for c in cols)
    return f"sha256(concat_ws('||', {parts}))"


def hk(*cols: str) -> str:
    return digest("", *cols)


def hd(*cols: str) -> str:
    return digest("^^", *cols)


def stamp(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"


def initcap(col: str) -> str:
    return f"upper(left({col}, 1)) || lower(substr({col}, 2))"


NO_FILE = ", '{}' AS _FILE_NAME, CAST(NULL AS BIGINT) AS _FILE_ROW_NUMBER"

CTES["raw_customers"] = """
SELECT concat(' c', CAST(k AS string)) AS CUSTOMER_ID,
  lower(c_mktsegment) AS FIRST_NAME, concat('CUST', CAST(k AS string)) AS LAST_NAME,
  CASE WHEN et='signup' THEN concat(' Cust', CAST(k AS string), '.', CAST(ev AS string), '@Example.COM ') ELSE concat('Cust', CAST(k AS string), '@Example.COM') END AS EMAIL,
  CASE WHEN k % 23 = 0 THEN NULL ELSE concat('+1555', lpad(CAST(k AS string), 7, '0')) END AS PHONE,
  CAST(DATE '1950-01-01' + CAST((k*37) % 18000 AS int) AS date) AS DATE_OF_BIRTH,
  CASE k % 3 WHEN 0 THEN 'f' WHEN 1 THEN 'm' ELSE NULL END AS GENDER,
  CASE n_nationkey % 5 WHEN 0 THEN 'us' WHEN 1 THEN 'gb' WHEN 2 THEN 'de' WHEN 3 THEN 'fr' ELSE 'xx' END AS COUNTRY_CODE,
  n_name AS CITY, r_name AS STATE, lpad(CAST(k % 100000 AS string), 5, '0') AS POSTAL_CODE,
  TIMESTAMP '1995-01-01 00:00:00' AS REGISTRATION_DATE,
  c_mktsegment AS CUSTOMER_SEGMENT,
  CASE WHEN et='purchase' AND val >= 100 THEN 'platinum' WHEN et='purchase' AND val >= 50 THEN 'gold'
       WHEN c_acctbal >= 5000 THEN 'silver' WHEN c_acctbal < 0 THEN NULL ELSE 'bronze' END AS LOYALTY_TIER,
  ts AS _LOADED_AT""" + NO_FILE.format("customer.parquet") + """
FROM (
  SELECT c_custkey AS k, CAST(NULL AS string) AS et, 0.0 AS val, 0 AS ev, TIMESTAMP '1995-01-01 00:00:00' AS ts FROM customer
  UNION ALL
  SELECT user_id, event_type, value, CAST(event_id % 3 AS int), ts FROM events
) v JOIN customer ON c_custkey = k JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""

CTES["raw_orders"] = """
SELECT concat(' o', CAST(o_orderkey AS string)) AS ORDER_ID, concat('c', CAST(o_custkey AS string), ' ') AS CUSTOMER_ID,
  o_orderdate AS ORDER_DATE, s.st AS ORDER_STATUS,
  CAST(floor(o_totalprice / 10) / CAST(100 AS double) AS decimal(18,4)) AS TOTAL_AMOUNT,
  CASE o_orderkey % 3 WHEN 0 THEN 'usd' WHEN 1 THEN 'eur' ELSE 'gbp' END AS CURRENCY_CODE,
  CASE o_orderkey % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'paypal' WHEN 2 THEN 'bank_transfer' ELSE 'gift_card' END AS PAYMENT_METHOD,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'overnight' WHEN o_orderpriority = '2-HIGH' THEN 'express' ELSE 'standard' END AS SHIPPING_METHOD,
  concat(CAST(o_custkey AS string), ' Main St') AS SHIPPING_ADDRESS, concat(CAST(o_custkey AS string), ' Main St') AS BILLING_ADDRESS,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(CAST(floor(o_totalprice / 10) / CAST(100 AS double) AS decimal(18,4)) * CAST(o_orderkey % 5 AS decimal(2,0)) / 100 AS decimal(18,4)) END AS DISCOUNT_AMOUNT,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(CAST(floor(o_totalprice / 10) / CAST(100 AS double) AS decimal(18,4)) * CAST(0.08 AS decimal(3,2)) AS decimal(18,4)) END AS TAX_AMOUNT,
  CASE WHEN s.i BETWEEN 2 AND 3 THEN o_orderdate + (o_orderkey % 96) * INTERVAL '1' HOUR ELSE NULL END AS FULFILLMENT_DATE,
  o_orderdate + s.i * INTERVAL '1' DAY AS _LOADED_AT""" + NO_FILE.format("orders.parquet") + """
FROM orders CROSS JOIN (VALUES (0,'pending'),(1,'confirmed'),(2,'shipped'),(3,'delivered'),(4,'cancelled'),(5,'refunded')) AS s(i, st)
WHERE s.i <= 1 OR (s.i = 2 AND o_orderstatus IN ('P','F')) OR (s.i = 3 AND o_orderstatus = 'F')
   OR (s.i = 4 AND o_orderkey % 17 = 0) OR (s.i = 5 AND o_orderkey % 29 = 0)"""

CTES["raw_products"] = """
SELECT concat('p', CAST(p_partkey AS string)) AS PRODUCT_ID, concat(' ', p_name) AS PRODUCT_NAME, lower(p_type) AS CATEGORY,
  p_name AS SUBCATEGORY, p_brand AS BRAND,
  CASE WHEN p_partkey % 101 = 0 THEN NULL WHEN s.i = 1 THEN CAST(CAST(p_retailprice AS decimal(18,4)) * CAST(1.1 AS decimal(2,1)) AS decimal(18,4)) ELSE CAST(p_retailprice AS decimal(18,4)) END AS UNIT_PRICE,
  CASE WHEN p_partkey % 50 = 0 THEN CAST(0 AS decimal(18,4)) ELSE CAST(CAST(p_retailprice AS decimal(18,4)) * CAST(0.6 AS decimal(2,1)) AS decimal(18,4)) END AS COST_PRICE,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_size AS decimal(10,3)) END AS WEIGHT_KG,
  CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_partkey % 20 <> 0 END AS IS_ACTIVE,
  TIMESTAMP '1995-01-01 00:00:00' AS CREATED_AT,
  CASE WHEN s.i = 0 THEN TIMESTAMP '1995-01-01 00:00:00' ELSE TIMESTAMP '1998-01-01 00:00:00' END AS UPDATED_AT,
  CASE WHEN s.i = 0 THEN TIMESTAMP '1995-01-01 00:00:00' ELSE TIMESTAMP '1998-01-01 00:00:00' END AS _LOADED_AT""" + NO_FILE.format("part.parquet") + """
FROM part CROSS JOIN (VALUES (0),(1)) AS s(i) WHERE s.i = 0 OR p_partkey % 3 = 0"""

CTES["raw_order_items"] = """
SELECT concat_ws('-', CAST(l_orderkey AS string), CAST(l_linenumber AS string), CAST(l_partkey AS string), CAST(l_suppkey AS string),
         CAST(CAST(l_extendedprice AS decimal(18,4)) AS string), CAST(CAST(l_shipdate AS date) AS string)) AS ORDER_ITEM_ID,
  concat('o', CAST(l_orderkey AS string)) AS ORDER_ID, concat('p', CAST(l_partkey AS string)) AS PRODUCT_ID,
  CAST(l_quantity AS decimal(10,0)) AS QUANTITY,
  CAST(floor(l_extendedprice * 100 / l_quantity) / CAST(100 AS double) AS decimal(18,4)) AS UNIT_PRICE,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_discount * 100 AS decimal(5,2)) END AS DISCOUNT_PERCENT,
  CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST(l_extendedprice AS decimal(18,4)) END AS LINE_TOTAL,
  l_shipdate AS _LOADED_AT""" + NO_FILE.format("lineitem.parquet") + """
FROM lineitem"""

# ---- staging -----------------------------------------------------------------------------
_META = "_LOADED_AT, _FILE_NAME, _FILE_ROW_NUMBER"


def _staged(clean: str, keys: dict[str, str], source: str) -> str:
    hashed = ", ".join(f"{expr} AS {name}" for name, expr in keys.items())
    return f"""SELECT *, {hashed}, _LOADED_AT AS LOAD_DATETIME, '{source}' AS RECORD_SOURCE,
  CAST({AS_OF} AS DATE) AS APPLIED_DATE FROM ({clean})"""


CTES["stg_customers"] = _staged(f"""
SELECT trim(upper(CUSTOMER_ID)) AS CUSTOMER_ID, trim({initcap('FIRST_NAME')}) AS FIRST_NAME, trim({initcap('LAST_NAME')}) AS LAST_NAME,
  trim(lower(EMAIL)) AS EMAIL, trim(PHONE) AS PHONE, trim(upper(COUNTRY_CODE)) AS COUNTRY_CODE, trim({initcap('CITY')}) AS CITY,
  trim(upper(STATE)) AS STATE, trim(POSTAL_CODE) AS POSTAL_CODE, REGISTRATION_DATE, DATE_OF_BIRTH, trim(upper(GENDER)) AS GENDER,
  trim(upper(CUSTOMER_SEGMENT)) AS CUSTOMER_SEGMENT, trim(upper(LOYALTY_TIER)) AS LOYALTY_TIER, {_META}
FROM raw_customers""", {
    "HK_CUSTOMER": hk("CUSTOMER_ID"),
    "HD_CUSTOMER_DETAILS": hd("FIRST_NAME", "LAST_NAME", "EMAIL", "PHONE", "COUNTRY_CODE", "CITY", "STATE", "POSTAL_CODE",
                              stamp("REGISTRATION_DATE")),
    "HD_CUSTOMER_DEMOGRAPHICS": hd("DATE_OF_BIRTH", "GENDER", "CUSTOMER_SEGMENT", "LOYALTY_TIER"),
}, "ECOMMERCE.RAW_CUSTOMERS")

CTES["stg_orders"] = _staged(f"""
SELECT trim(upper(ORDER_ID)) AS ORDER_ID, trim(upper(CUSTOMER_ID)) AS CUSTOMER_ID, ORDER_DATE, trim(upper(ORDER_STATUS)) AS ORDER_STATUS,
  trim(upper(SHIPPING_METHOD)) AS SHIPPING_METHOD, trim(SHIPPING_ADDRESS) AS SHIPPING_ADDRESS, trim(BILLING_ADDRESS) AS BILLING_ADDRESS,
  FULFILLMENT_DATE, CAST(coalesce(TOTAL_AMOUNT, 0) AS DECIMAL(18,4)) AS TOTAL_AMOUNT, trim(upper(CURRENCY_CODE)) AS CURRENCY_CODE,
  trim(upper(PAYMENT_METHOD)) AS PAYMENT_METHOD, CAST(coalesce(DISCOUNT_AMOUNT, 0) AS DECIMAL(18,4)) AS DISCOUNT_AMOUNT,
  CAST(coalesce(TAX_AMOUNT, 0) AS DECIMAL(18,4)) AS TAX_AMOUNT, {_META}
FROM raw_orders""", {
    "HK_ORDER": hk("ORDER_ID"), "HK_CUSTOMER": hk("CUSTOMER_ID"), "HK_LINK_CUSTOMER_ORDER": hk("CUSTOMER_ID", "ORDER_ID"),
    "HD_ORDER_DETAILS": hd("ORDER_STATUS", "SHIPPING_METHOD", "SHIPPING_ADDRESS", "BILLING_ADDRESS", stamp("FULFILLMENT_DATE")),
    "HD_ORDER_FINANCIALS": hd("TOTAL_AMOUNT", "CURRENCY_CODE", "PAYMENT_METHOD", "DISCOUNT_AMOUNT", "TAX_AMOUNT"),
}, "ECOMMERCE.RAW_ORDERS")

CTES["stg_products"] = _staged(f"""
SELECT trim(upper(PRODUCT_ID)) AS PRODUCT_ID, trim(PRODUCT_NAME) AS PRODUCT_NAME, trim(upper(CATEGORY)) AS CATEGORY,
  trim(upper(SUBCATEGORY)) AS SUBCATEGORY, trim(upper(BRAND)) AS BRAND, CAST(coalesce(WEIGHT_KG, 0) AS DECIMAL(10,3)) AS WEIGHT_KG,
  coalesce(IS_ACTIVE, true) AS IS_ACTIVE, CREATED_AT, UPDATED_AT, CAST(coalesce(UNIT_PRICE, 0) AS DECIMAL(18,4)) AS UNIT_PRICE,
  CAST(coalesce(COST_PRICE, 0) AS DECIMAL(18,4)) AS COST_PRICE, {_META}
FROM raw_products""", {
    "HK_PRODUCT": hk("PRODUCT_ID"),
    "HD_PRODUCT_DETAILS": hd("PRODUCT_NAME", "CATEGORY", "SUBCATEGORY", "BRAND", "WEIGHT_KG", "IS_ACTIVE"),
    "HD_PRODUCT_PRICING": hd("UNIT_PRICE", "COST_PRICE"),
}, "ECOMMERCE.RAW_PRODUCTS")

CTES["stg_order_items"] = _staged(f"""
SELECT trim(upper(ORDER_ITEM_ID)) AS ORDER_ITEM_ID, trim(upper(ORDER_ID)) AS ORDER_ID, trim(upper(PRODUCT_ID)) AS PRODUCT_ID, QUANTITY, UNIT_PRICE,
  CAST(coalesce(DISCOUNT_PERCENT, 0) AS DECIMAL(5,2)) AS DISCOUNT_PERCENT,
  coalesce(LINE_TOTAL, CAST(QUANTITY * UNIT_PRICE * CAST(100 - coalesce(DISCOUNT_PERCENT, 0) AS DECIMAL(5,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4))) AS LINE_TOTAL,
  {_META}
FROM raw_order_items""", {
    "HK_ORDER": hk("ORDER_ID"), "HK_PRODUCT": hk("PRODUCT_ID"), "HK_LINK_ORDER_PRODUCT": hk("ORDER_ID", "PRODUCT_ID", "ORDER_ITEM_ID"),
    "HD_ORDER_ITEM_DETAILS": hd("QUANTITY", "UNIT_PRICE", "DISCOUNT_PERCENT", "LINE_TOTAL"),
}, "ECOMMERCE.RAW_ORDER_ITEMS")


# ---- raw vault -----------------------------------------------------------------------------
def _first(staged: str, key: str, cols: str) -> str:
    return f"""SELECT {key}, {cols}, LOAD_DATETIME, RECORD_SOURCE FROM {staged}
QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY LOAD_DATETIME, RECORD_SOURCE, {cols}) = 1"""


CTES["hub_customer"] = _first("stg_customers", "HK_CUSTOMER", "CUSTOMER_ID")
CTES["hub_order"] = _first("stg_orders", "HK_ORDER", "ORDER_ID")
CTES["hub_product"] = _first("stg_products", "HK_PRODUCT", "PRODUCT_ID")
CTES["link_customer_order"] = _first("stg_orders", "HK_LINK_CUSTOMER_ORDER", "HK_CUSTOMER, HK_ORDER")
CTES["link_order_product"] = _first("stg_order_items", "HK_LINK_ORDER_PRODUCT", "HK_ORDER, HK_PRODUCT, ORDER_ITEM_ID")


def _changes(staged: str, key: str, mark: str, cols: str) -> str:
    return f"""SELECT {key}, {cols}, LOAD_DATETIME, RECORD_SOURCE FROM (
  SELECT *, lag({mark}) OVER (PARTITION BY {key} ORDER BY LOAD_DATETIME) AS before_mark
  FROM (SELECT * FROM {staged} QUALIFY row_number() OVER (PARTITION BY {key}, LOAD_DATETIME ORDER BY RECORD_SOURCE, {mark}) = 1)
) WHERE before_mark IS DISTINCT FROM {mark}"""


def _satellite(staged: str, key: str, diff: str, cols: str) -> str:
    return _changes(f"(SELECT *, {diff} AS HASH_DIFF FROM {staged})", key, "HASH_DIFF", f"HASH_DIFF, {cols}")


SAT_COLUMNS = {
    "sat_customer_details": ("stg_customers", "HK_CUSTOMER", "HD_CUSTOMER_DETAILS",
                             "FIRST_NAME, LAST_NAME, EMAIL, PHONE, COUNTRY_CODE, CITY, STATE, POSTAL_CODE, REGISTRATION_DATE"),
    "sat_customer_demographics": ("stg_customers", "HK_CUSTOMER", "HD_CUSTOMER_DEMOGRAPHICS",
                                  "DATE_OF_BIRTH, GENDER, CUSTOMER_SEGMENT, LOYALTY_TIER"),
    "sat_order_details": ("stg_orders", "HK_ORDER", "HD_ORDER_DETAILS",
                          "ORDER_DATE, ORDER_STATUS, SHIPPING_METHOD, SHIPPING_ADDRESS, BILLING_ADDRESS, FULFILLMENT_DATE"),
    "sat_order_financials": ("stg_orders", "HK_ORDER", "HD_ORDER_FINANCIALS",
                             "TOTAL_AMOUNT, CURRENCY_CODE, PAYMENT_METHOD, DISCOUNT_AMOUNT, TAX_AMOUNT"),
    "sat_product_details": ("stg_products", "HK_PRODUCT", "HD_PRODUCT_DETAILS",
                            "PRODUCT_NAME, CATEGORY, SUBCATEGORY, BRAND, WEIGHT_KG, IS_ACTIVE, CREATED_AT, UPDATED_AT"),
    "sat_product_pricing": ("stg_products", "HK_PRODUCT", "HD_PRODUCT_PRICING", "UNIT_PRICE, COST_PRICE"),
}
for _name, _args in SAT_COLUMNS.items():
    CTES[_name] = _satellite(*_args)

CTES["eff_rows"] = f"""SELECT HK_LINK_CUSTOMER_ORDER, HK_CUSTOMER, HK_ORDER,
  ORDER_STATUS NOT IN ('CANCELLED', 'RETURNED', 'REFUNDED') AS IS_ACTIVE, ORDER_DATE AS EFFECTIVE_FROM,
  CASE WHEN ORDER_STATUS IN ('CANCELLED', 'RETURNED', 'REFUNDED') THEN LOAD_DATETIME ELSE TIMESTAMP '9999-12-31 00:00:00' END AS EFFECTIVE_TO,
  ORDER_STATUS, LOAD_DATETIME, RECORD_SOURCE FROM stg_orders"""
CTES["eff_sat_customer_order"] = _changes("eff_rows", "HK_LINK_CUSTOMER_ORDER", "IS_ACTIVE",
                                          "HK_CUSTOMER, HK_ORDER, IS_ACTIVE, EFFECTIVE_FROM, EFFECTIVE_TO, ORDER_STATUS")


# ---- silver --------------------------------------------------------------------------------
def _pit(hub: str, key: str, sats: dict[str, str], with_hash: bool) -> str:
    spine = " UNION ".join(f"SELECT {key}, LOAD_DATETIME AS PIT_LOAD_DATETIME FROM {t}" for t in (hub, *sats.values()))
    cols, joins = [], []
    for i, (name, table) in enumerate(sats.items()):
        cols.append(f"coalesce(s{i}.LOAD_DATETIME, TIMESTAMP '1900-01-01 00:00:00') AS {name}_LDTS")
        if with_hash:
            cols.append(f"coalesce(s{i}.HASH_DIFF, repeat('0', 64)) AS {name}_HD")
        joins.append(f"ASOF LEFT JOIN {table} s{i} ON p.{key} = s{i}.{key} AND p.PIT_LOAD_DATETIME >= s{i}.LOAD_DATETIME")
    return f"SELECT p.{key}, p.PIT_LOAD_DATETIME, {', '.join(cols)} FROM ({spine}) p {' '.join(joins)}"


CTES["pit_customer"] = _pit("hub_customer", "HK_CUSTOMER", {
    "SAT_CUSTOMER_DETAILS": "sat_customer_details", "SAT_CUSTOMER_DEMOGRAPHICS": "sat_customer_demographics"}, True)
CTES["pit_order"] = _pit("hub_order", "HK_ORDER", {
    "SAT_ORDER_DETAILS": "sat_order_details", "SAT_ORDER_FINANCIALS": "sat_order_financials"}, False)


def newest(table: str, key: str) -> str:
    return f"(SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY LOAD_DATETIME DESC) = 1)"


CTES["bridge_customer_order"] = f"""SELECT l.HK_LINK_CUSTOMER_ORDER, l.HK_CUSTOMER, l.HK_ORDER, l.LOAD_DATETIME AS LINK_LOAD_DATETIME,
  l.RECORD_SOURCE AS LINK_RECORD_SOURCE, e.IS_ACTIVE, e.EFFECTIVE_FROM, e.EFFECTIVE_TO, e.ORDER_STATUS AS EFF_ORDER_STATUS
FROM link_customer_order l LEFT JOIN {newest('eff_sat_customer_order', 'HK_LINK_CUSTOMER_ORDER')} e USING (HK_LINK_CUSTOMER_ORDER)"""
CTES["hub_bridge"] = """SELECT h.HK_CUSTOMER, h.CUSTOMER_ID, l.HK_LINK_CUSTOMER_ORDER, l.HK_ORDER, o.ORDER_ID, l.LOAD_DATETIME AS LINK_LOAD_DATETIME
FROM hub_customer h JOIN link_customer_order l ON h.HK_CUSTOMER = l.HK_CUSTOMER JOIN hub_order o ON l.HK_ORDER = o.HK_ORDER"""
CTES["pit_customer_current"] = f"""SELECT h.HK_CUSTOMER, h.CUSTOMER_ID, d.HK_CUSTOMER AS SAT_DETAILS_HK,
  coalesce(d.LOAD_DATETIME, TIMESTAMP '1900-01-01 00:00:00') AS SAT_DETAILS_LOAD_DT, m.HK_CUSTOMER AS SAT_DEMOGRAPHICS_HK,
  coalesce(m.LOAD_DATETIME, TIMESTAMP '1900-01-01 00:00:00') AS SAT_DEMOGRAPHICS_LOAD_DT
FROM hub_customer h LEFT JOIN {newest('sat_customer_details', 'HK_CUSTOMER')} d ON h.HK_CUSTOMER = d.HK_CUSTOMER
LEFT JOIN {newest('sat_customer_demographics', 'HK_CUSTOMER')} m ON h.HK_CUSTOMER = m.HK_CUSTOMER"""

CTES["bv_order_lifecycle"] = f"""SELECT h.HK_ORDER, h.ORDER_ID, c.ORDER_DATE, c.ORDER_STATUS AS CURRENT_STATUS, c.FULFILLMENT_DATE, c.SHIPPING_METHOD,
  f.TOTAL_AMOUNT, f.CURRENCY_CODE, f.PAYMENT_METHOD, f.DISCOUNT_AMOUNT, f.TAX_AMOUNT,
  f.TOTAL_AMOUNT - f.DISCOUNT_AMOUNT + f.TAX_AMOUNT AS NET_AMOUNT, t.TOTAL_STATUS_CHANGES,
  CAST(date_diff('hour', c.ORDER_DATE, c.FULFILLMENT_DATE) AS INTEGER) AS HOURS_TO_FULFILLMENT,
  CAST(date_diff('day', c.ORDER_DATE, {AS_OF}) AS INTEGER) AS DAYS_SINCE_ORDER,
  CASE WHEN c.ORDER_STATUS IN ('DELIVERED', 'SHIPPED') AND c.SHIPPING_METHOD = 'EXPRESS'
         AND date_diff('hour', c.ORDER_DATE, coalesce(c.FULFILLMENT_DATE, {AS_OF})) <= 24 THEN true
       WHEN c.ORDER_STATUS IN ('DELIVERED', 'SHIPPED') AND c.SHIPPING_METHOD = 'STANDARD'
         AND date_diff('hour', c.ORDER_DATE, coalesce(c.FULFILLMENT_DATE, {AS_OF})) <= 72 THEN true
       WHEN c.ORDER_STATUS IN ('PENDING', 'CONFIRMED') THEN NULL ELSE false END AS SLA_MET,
  CASE c.ORDER_STATUS WHEN 'DELIVERED' THEN 'COMPLETE' WHEN 'SHIPPED' THEN 'IN_TRANSIT' WHEN 'CONFIRMED' THEN 'PROCESSING'
    WHEN 'PENDING' THEN 'AWAITING_CONFIRMATION' WHEN 'CANCELLED' THEN 'CANCELLED' WHEN 'RETURNED' THEN 'RETURNED'
    WHEN 'REFUNDED' THEN 'REFUNDED' ELSE 'UNKNOWN' END AS LIFECYCLE_STAGE,
  c.ORDER_STATUS IN ('DELIVERED', 'CANCELLED', 'RETURNED', 'REFUNDED') AS IS_TERMINAL, {AS_OF} AS COMPUTED_AT
FROM hub_order h JOIN {newest('sat_order_details', 'HK_ORDER')} c ON h.HK_ORDER = c.HK_ORDER
LEFT JOIN {newest('sat_order_financials', 'HK_ORDER')} f ON h.HK_ORDER = f.HK_ORDER
LEFT JOIN (SELECT HK_ORDER, count(*) AS TOTAL_STATUS_CHANGES FROM sat_order_details GROUP BY HK_ORDER) t ON h.HK_ORDER = t.HK_ORDER"""

CTES["conformed_orders"] = f"""SELECT h.HK_ORDER, h.ORDER_ID, h.LOAD_DATETIME AS FIRST_LOADED_AT, l.HK_CUSTOMER, d.ORDER_DATE, d.ORDER_STATUS, d.SHIPPING_METHOD,
  d.SHIPPING_ADDRESS, d.BILLING_ADDRESS, d.FULFILLMENT_DATE, f.TOTAL_AMOUNT, f.CURRENCY_CODE, f.PAYMENT_METHOD, f.DISCOUNT_AMOUNT, f.TAX_AMOUNT,
  b.NET_AMOUNT, b.LIFECYCLE_STAGE, b.IS_TERMINAL, b.SLA_MET, b.HOURS_TO_FULFILLMENT, b.DAYS_SINCE_ORDER, b.TOTAL_STATUS_CHANGES,
  d.LOAD_DATETIME AS DETAILS_LAST_UPDATED, f.LOAD_DATETIME AS FINANCIALS_LAST_UPDATED, {AS_OF} AS CONFORMED_AT
FROM hub_order h LEFT JOIN {newest('sat_order_details', 'HK_ORDER')} d ON h.HK_ORDER = d.HK_ORDER
LEFT JOIN {newest('sat_order_financials', 'HK_ORDER')} f ON h.HK_ORDER = f.HK_ORDER
LEFT JOIN link_customer_order l ON h.HK_ORDER = l.HK_ORDER LEFT JOIN bv_order_lifecycle b ON h.HK_ORDER = b.HK_ORDER"""

CTES["order_history"] = f"""SELECT l.HK_CUSTOMER, count(DISTINCT l.HK_ORDER) AS TOTAL_ORDERS, max(d.ORDER_DATE) AS LAST_ORDER_DATE,
  min(d.ORDER_DATE) AS FIRST_ORDER_DATE, sum(f.TOTAL_AMOUNT) AS TOTAL_REVENUE,
  round(CAST(sum(f.TOTAL_AMOUNT) AS DOUBLE) / count(f.TOTAL_AMOUNT), 8) AS AVG_ORDER_VALUE,
  CAST(date_diff('day', max(d.ORDER_DATE), {AS_OF}) AS INTEGER) AS DAYS_SINCE_LAST_ORDER
FROM link_customer_order l JOIN {newest('sat_order_details', 'HK_ORDER')} d ON l.HK_ORDER = d.HK_ORDER AND d.ORDER_STATUS NOT IN ('CANCELLED', 'REFUNDED')
JOIN {newest('sat_order_financials', 'HK_ORDER')} f ON l.HK_ORDER = f.HK_ORDER GROUP BY l.HK_CUSTOMER"""

CTES["rfm_scored"] = """SELECT *, CAST(ntile(5) OVER (ORDER BY DAYS_SINCE_LAST_ORDER DESC, HK_CUSTOMER) AS INTEGER) AS R,
  CAST(ntile(5) OVER (ORDER BY TOTAL_ORDERS, HK_CUSTOMER) AS INTEGER) AS F,
  CAST(ntile(5) OVER (ORDER BY TOTAL_REVENUE, HK_CUSTOMER) AS INTEGER) AS M FROM order_history"""

CTES["bv_customer_classification"] = f"""SELECT *, RECENCY_SCORE + FREQUENCY_SCORE + MONETARY_SCORE AS RFM_TOTAL_SCORE,
  CASE WHEN TOTAL_REVENUE >= 10000 THEN 'PLATINUM' WHEN TOTAL_REVENUE >= 5000 THEN 'GOLD' WHEN TOTAL_REVENUE >= 1000 THEN 'SILVER'
    WHEN TOTAL_REVENUE > 0 THEN 'BRONZE' ELSE 'NEW' END AS LTV_TIER,
  CASE WHEN DAYS_SINCE_LAST_ORDER > 365 THEN 'HIGH' WHEN DAYS_SINCE_LAST_ORDER > 180 THEN 'MEDIUM' WHEN DAYS_SINCE_LAST_ORDER > 90 THEN 'LOW' ELSE 'ACTIVE' END AS CHURN_RISK,
  CASE WHEN RECENCY_SCORE >= 4 AND FREQUENCY_SCORE >= 4 THEN 'CHAMPION' WHEN RECENCY_SCORE >= 4 AND FREQUENCY_SCORE >= 2 THEN 'LOYAL'
    WHEN RECENCY_SCORE >= 3 AND MONETARY_SCORE >= 4 THEN 'BIG_SPENDER' WHEN RECENCY_SCORE >= 4 AND FREQUENCY_SCORE = 1 THEN 'NEW_CUSTOMER'
    WHEN RECENCY_SCORE <= 2 AND FREQUENCY_SCORE >= 3 THEN 'AT_RISK' WHEN RECENCY_SCORE <= 2 AND FREQUENCY_SCORE <= 2 THEN 'LOST' ELSE 'REGULAR' END AS RFM_SEGMENT,
  {AS_OF} AS CLASSIFIED_AT
FROM (SELECT h.HK_CUSTOMER, h.CUSTOMER_ID, d.FIRST_NAME, d.LAST_NAME, d.COUNTRY_CODE, d.REGISTRATION_DATE, m.CUSTOMER_SEGMENT, m.LOYALTY_TIER,
  coalesce(r.TOTAL_ORDERS, 0) AS TOTAL_ORDERS, r.LAST_ORDER_DATE, r.FIRST_ORDER_DATE, coalesce(r.TOTAL_REVENUE, 0) AS TOTAL_REVENUE,
  coalesce(r.AVG_ORDER_VALUE, 0) AS AVG_ORDER_VALUE, coalesce(r.DAYS_SINCE_LAST_ORDER, 9999) AS DAYS_SINCE_LAST_ORDER,
  coalesce(r.R, 1) AS RECENCY_SCORE, coalesce(r.F, 1) AS FREQUENCY_SCORE, coalesce(r.M, 1) AS MONETARY_SCORE
  FROM hub_customer h LEFT JOIN {newest('sat_customer_details', 'HK_CUSTOMER')} d ON h.HK_CUSTOMER = d.HK_CUSTOMER
  LEFT JOIN {newest('sat_customer_demographics', 'HK_CUSTOMER')} m ON h.HK_CUSTOMER = m.HK_CUSTOMER
  LEFT JOIN rfm_scored r ON h.HK_CUSTOMER = r.HK_CUSTOMER)"""

CTES["conformed_customers"] = f"""SELECT h.HK_CUSTOMER, h.CUSTOMER_ID, h.LOAD_DATETIME AS FIRST_LOADED_AT, d.FIRST_NAME, d.LAST_NAME, d.EMAIL, d.PHONE, d.COUNTRY_CODE,
  d.CITY, d.STATE, d.POSTAL_CODE, d.REGISTRATION_DATE, m.DATE_OF_BIRTH, m.GENDER, m.CUSTOMER_SEGMENT, m.LOYALTY_TIER, c.TOTAL_ORDERS, c.TOTAL_REVENUE,
  c.AVG_ORDER_VALUE, c.LAST_ORDER_DATE, c.DAYS_SINCE_LAST_ORDER, c.RECENCY_SCORE, c.FREQUENCY_SCORE, c.MONETARY_SCORE, c.RFM_TOTAL_SCORE, c.RFM_SEGMENT,
  c.LTV_TIER, c.CHURN_RISK, d.LOAD_DATETIME AS DETAILS_LAST_UPDATED, m.LOAD_DATETIME AS DEMOGRAPHICS_LAST_UPDATED, c.CLASSIFIED_AT, {AS_OF} AS CONFORMED_AT
FROM hub_customer h LEFT JOIN {newest('sat_customer_details', 'HK_CUSTOMER')} d ON h.HK_CUSTOMER = d.HK_CUSTOMER
LEFT JOIN {newest('sat_customer_demographics', 'HK_CUSTOMER')} m ON h.HK_CUSTOMER = m.HK_CUSTOMER
LEFT JOIN bv_customer_classification c ON h.HK_CUSTOMER = c.HK_CUSTOMER"""


# ---- gold ----------------------------------------------------------------------------------
def calendar(days: str) -> str:
    return f"""SELECT strftime(d, '%Y%m%d') AS DATE_KEY, d AS DATE_DAY, CAST(year(d) AS INTEGER) AS CALENDAR_YEAR, CAST(quarter(d) AS INTEGER) AS CALENDAR_QUARTER,
  CAST(month(d) AS INTEGER) AS CALENDAR_MONTH, CAST(weekofyear(d) AS INTEGER) AS CALENDAR_WEEK, CAST(dayofyear(d) AS INTEGER) AS DAY_OF_YEAR,
  CAST(day(d) AS INTEGER) AS DAY_OF_MONTH, CAST(dayofweek(d) AS INTEGER) AS DAY_OF_WEEK, strftime(d, '%a') AS DAY_NAME, strftime(d, '%b') AS MONTH_NAME,
  'Q' || quarter(d) AS QUARTER_NAME, year(d) || '-Q' || quarter(d) AS YEAR_QUARTER, strftime(d, '%Y-%m') AS YEAR_MONTH,
  dayofweek(d) IN (0, 6) AS IS_WEEKEND, dayofweek(d) NOT IN (0, 6) AS IS_WEEKDAY, day(d) = 1 AS IS_FIRST_OF_MONTH, d = last_day(d) AS IS_LAST_OF_MONTH,
  d = CAST({AS_OF} AS DATE) AS IS_TODAY, CAST(date_diff('day', d, CAST({AS_OF} AS DATE)) AS INTEGER) AS DAYS_AGO,
  CAST(CASE WHEN month(d) >= 4 THEN year(d) ELSE year(d) - 1 END AS INTEGER) AS FISCAL_YEAR,
  CAST(CASE WHEN month(d) >= 4 THEN ceil((month(d) - 3) / 3.0) ELSE ceil((month(d) + 9) / 3.0) END AS INTEGER) AS FISCAL_QUARTER
FROM ({days})"""


CTES["dim_date"] = calendar("SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d")

CTES["dim_customer"] = f"""SELECT {hk('HK_CUSTOMER')} AS CUSTOMER_SK, HK_CUSTOMER, CUSTOMER_ID, FIRST_NAME, LAST_NAME, FIRST_NAME || ' ' || LAST_NAME AS FULL_NAME, EMAIL, PHONE,
  COUNTRY_CODE, CITY, STATE, POSTAL_CODE, REGISTRATION_DATE, DATE_OF_BIRTH, GENDER, CUSTOMER_SEGMENT, LOYALTY_TIER, RFM_SEGMENT, LTV_TIER, CHURN_RISK, TOTAL_ORDERS,
  TOTAL_REVENUE, AVG_ORDER_VALUE, RECENCY_SCORE, FREQUENCY_SCORE, MONETARY_SCORE,
  CASE WHEN CHURN_RISK = 'HIGH' OR DAYS_SINCE_LAST_ORDER > 365 THEN false ELSE true END AS IS_ACTIVE, FIRST_LOADED_AT, LAST_ORDER_DATE,
  CONFORMED_AT AS LAST_UPDATED_AT, true AS IS_CURRENT, FIRST_LOADED_AT AS EFFECTIVE_FROM, TIMESTAMP '9999-12-31 00:00:00' AS EFFECTIVE_TO FROM conformed_customers"""

CTES["dim_product"] = f"""SELECT {hk('h.HK_PRODUCT')} AS PRODUCT_SK, h.HK_PRODUCT, h.PRODUCT_ID, d.PRODUCT_NAME, d.CATEGORY, d.SUBCATEGORY, d.BRAND, d.WEIGHT_KG, d.IS_ACTIVE,
  d.CREATED_AT AS PRODUCT_CREATED_AT, d.UPDATED_AT AS PRODUCT_UPDATED_AT, p.UNIT_PRICE, p.COST_PRICE,
  CASE WHEN p.COST_PRICE > 0 THEN round((CAST(p.UNIT_PRICE AS DOUBLE) - p.COST_PRICE) / p.COST_PRICE * 100, 2) ELSE 0 END AS MARGIN_PERCENT,
  h.LOAD_DATETIME AS FIRST_LOADED_AT, d.LOAD_DATETIME AS DETAILS_LAST_UPDATED, p.LOAD_DATETIME AS PRICING_LAST_UPDATED, true AS IS_CURRENT,
  h.LOAD_DATETIME AS EFFECTIVE_FROM, TIMESTAMP '9999-12-31 00:00:00' AS EFFECTIVE_TO
FROM hub_product h LEFT JOIN {newest('sat_product_details', 'HK_PRODUCT')} d ON h.HK_PRODUCT = d.HK_PRODUCT
LEFT JOIN {newest('sat_product_pricing', 'HK_PRODUCT')} p ON h.HK_PRODUCT = p.HK_PRODUCT"""

CTES["fct_orders"] = f"""SELECT {hk('ORDER_ID')} AS ORDER_SK, HK_ORDER, ORDER_ID, HK_CUSTOMER, {hk('HK_CUSTOMER')} AS CUSTOMER_SK, strftime(ORDER_DATE, '%Y%m%d') AS ORDER_DATE_KEY,
  ORDER_DATE, FULFILLMENT_DATE, ORDER_STATUS, LIFECYCLE_STAGE, IS_TERMINAL, SHIPPING_METHOD, PAYMENT_METHOD, CURRENCY_CODE, TOTAL_AMOUNT, DISCOUNT_AMOUNT, TAX_AMOUNT,
  NET_AMOUNT, HOURS_TO_FULFILLMENT, TOTAL_STATUS_CHANGES, SLA_MET, CONFORMED_AT AS UPDATED_AT FROM conformed_orders"""

CTES["fct_order_items"] = f"""SELECT {hk('i.ORDER_ITEM_ID')} AS ORDER_ITEM_SK, {hk('i.ORDER_ID')} AS ORDER_SK, {hk('i.HK_PRODUCT')} AS PRODUCT_SK, i.HK_LINK_ORDER_PRODUCT, i.HK_ORDER,
  i.HK_PRODUCT, i.ORDER_ITEM_ID, i.ORDER_ID, i.PRODUCT_ID, strftime(o.ORDER_DATE, '%Y%m%d') AS ORDER_DATE_KEY, o.ORDER_DATE, i.QUANTITY, i.UNIT_PRICE, i.DISCOUNT_PERCENT,
  i.LINE_TOTAL, i.QUANTITY * i.UNIT_PRICE AS GROSS_AMOUNT,
  i.QUANTITY * i.UNIT_PRICE * i.DISCOUNT_PERCENT * CAST(0.01 AS DECIMAL(3,2)) AS DISCOUNT_AMOUNT, o.CURRENCY_CODE, i.LOAD_DATETIME AS UPDATED_AT
FROM stg_order_items i LEFT JOIN conformed_orders o ON i.HK_ORDER = o.HK_ORDER"""

CTES["dated_orders"] = """SELECT f.*, d.CALENDAR_YEAR, d.CALENDAR_MONTH, d.YEAR_MONTH, d.CALENDAR_QUARTER, d.YEAR_QUARTER
FROM fct_orders f JOIN dim_date d ON f.ORDER_DATE_KEY = d.DATE_KEY WHERE f.ORDER_STATUS NOT IN ('CANCELLED', 'REFUNDED')"""

CTES["agg_monthly_revenue"] = f"""SELECT o.CALENDAR_YEAR, o.CALENDAR_MONTH, o.YEAR_MONTH, o.CALENDAR_QUARTER, o.YEAR_QUARTER, o.CURRENCY_CODE, count(*) AS TOTAL_ORDERS,
  CAST(sum(o.TOTAL_AMOUNT) AS DOUBLE) AS GROSS_REVENUE, CAST(sum(o.NET_AMOUNT) AS DOUBLE) AS NET_REVENUE, CAST(sum(o.DISCOUNT_AMOUNT) AS DOUBLE) AS TOTAL_DISCOUNTS,
  CAST(sum(o.TAX_AMOUNT) AS DOUBLE) AS TOTAL_TAX, CAST(sum(o.TOTAL_AMOUNT) AS DOUBLE) / count(*) AS AVG_ORDER_VALUE, count(DISTINCT o.HK_CUSTOMER) AS UNIQUE_CUSTOMERS,
  count(DISTINCT CASE WHEN date_trunc('month', c.FIRST_ORDER_DATE) = date_trunc('month', o.ORDER_DATE) THEN o.HK_CUSTOMER END) AS NEW_CUSTOMERS,
  count(DISTINCT CASE WHEN date_trunc('month', c.FIRST_ORDER_DATE) < date_trunc('month', o.ORDER_DATE) THEN o.HK_CUSTOMER END) AS RETURNING_CUSTOMERS,
  {AS_OF} AS AGGREGATED_AT
FROM dated_orders o LEFT JOIN (SELECT HK_CUSTOMER, min(ORDER_DATE) AS FIRST_ORDER_DATE FROM dated_orders GROUP BY HK_CUSTOMER) c ON o.HK_CUSTOMER = c.HK_CUSTOMER
GROUP BY ALL"""

CTES["agg_customer_ltv"] = f"""SELECT CUSTOMER_SK, HK_CUSTOMER, CUSTOMER_ID, FULL_NAME, COUNTRY_CODE, CUSTOMER_SEGMENT, LOYALTY_TIER, RFM_SEGMENT, n AS LIFETIME_ORDER_COUNT,
  CAST(spend AS DOUBLE) AS LIFETIME_SPEND, CASE WHEN n > 0 THEN CAST(spend AS DOUBLE) / n ELSE 0 END AS LIFETIME_AOV, FIRST_ORDER_DATE, LAST_ORDER_DATE, m AS TENURE_MONTHS,
  CAST(coalesce(date_diff('day', LAST_ORDER_DATE, {AS_OF}), 9999) AS INTEGER) AS DAYS_SINCE_LAST_ORDER,
  CASE WHEN m > 0 THEN ((n * 200 + m) // (2 * m)) / 100.0::DOUBLE ELSE 0 END AS ORDERS_PER_MONTH,
  CASE WHEN m > 0 THEN ((s * 200 + 10000 * m) // (20000 * m))::DOUBLE / 100 ELSE 0 END AS MONTHLY_SPEND_RATE,
  CASE WHEN m > 0 THEN ((s * 2400 + 10000 * m) // (20000 * m))::DOUBLE / 100 ELSE 0 END AS PREDICTED_12M_VALUE,
  LTV_TIER, CHURN_RISK, percent_rank() OVER (ORDER BY spend) AS SPEND_PERCENTILE, {AS_OF} AS AGGREGATED_AT
FROM (SELECT c.*, coalesce(o.n, 0) AS n, coalesce(o.spend, 0) AS spend, CAST(coalesce(o.spend, 0) * 10000 AS HUGEINT) AS s, o.FIRST_ORDER_DATE, o.LAST_ORDER_DATE,
  CAST(coalesce(date_diff('month', o.FIRST_ORDER_DATE, o.LAST_ORDER_DATE), 0) AS INTEGER) AS m
  FROM (SELECT * EXCLUDE (LAST_ORDER_DATE) FROM dim_customer) c LEFT JOIN (SELECT HK_CUSTOMER, count(*) AS n, sum(NET_AMOUNT) AS spend, min(ORDER_DATE) AS FIRST_ORDER_DATE,
    max(ORDER_DATE) AS LAST_ORDER_DATE FROM fct_orders WHERE ORDER_STATUS NOT IN ('CANCELLED', 'REFUNDED') GROUP BY HK_CUSTOMER) o ON c.HK_CUSTOMER = o.HK_CUSTOMER)"""

CTES["customer_order_stats"] = f"""SELECT l.HK_CUSTOMER, count(DISTINCT l.HK_ORDER) AS ORDER_COUNT, sum(f.TOTAL_AMOUNT) AS TOTAL_REVENUE,
  CAST(sum(f.TOTAL_AMOUNT) AS DOUBLE) / count(f.TOTAL_AMOUNT) AS AVG_ORDER_VALUE, sum(f.DISCOUNT_AMOUNT) AS TOTAL_DISCOUNT,
  min(f.LOAD_DATETIME) AS FIRST_ORDER_DATE, max(f.LOAD_DATETIME) AS LAST_ORDER_DATE
FROM link_customer_order l LEFT JOIN {newest('sat_order_financials', 'HK_ORDER')} f ON l.HK_ORDER = f.HK_ORDER GROUP BY l.HK_CUSTOMER"""

CTES["agg_revenue_by_segment"] = f"""SELECT m.CUSTOMER_SEGMENT, m.LOYALTY_TIER, count(DISTINCT p.HK_CUSTOMER) AS CUSTOMER_COUNT, count(DISTINCT b.HK_ORDER) AS ORDER_COUNT,
  CAST(sum(f.TOTAL_AMOUNT) AS DOUBLE) AS TOTAL_REVENUE, CAST(sum(f.TOTAL_AMOUNT) AS DOUBLE) / count(f.TOTAL_AMOUNT) AS AVG_ORDER_VALUE,
  CAST(sum(f.DISCOUNT_AMOUNT) AS DOUBLE) AS TOTAL_DISCOUNTS, {AS_OF} AS REFRESHED_AT
FROM pit_customer_current p LEFT JOIN sat_customer_demographics m ON p.SAT_DEMOGRAPHICS_HK = m.HK_CUSTOMER AND p.SAT_DEMOGRAPHICS_LOAD_DT = m.LOAD_DATETIME
LEFT JOIN hub_bridge b ON p.HK_CUSTOMER = b.HK_CUSTOMER LEFT JOIN {newest('sat_order_financials', 'HK_ORDER')} f ON b.HK_ORDER = f.HK_ORDER
GROUP BY m.CUSTOMER_SEGMENT, m.LOYALTY_TIER"""

CTES["dp_customer_360"] = f"""SELECT h.CUSTOMER_ID, d.FIRST_NAME, d.LAST_NAME, d.EMAIL, d.PHONE, d.COUNTRY_CODE, d.CITY, d.STATE, m.CUSTOMER_SEGMENT, m.LOYALTY_TIER,
  coalesce(s.ORDER_COUNT, 0) AS LIFETIME_ORDERS, CAST(coalesce(s.TOTAL_REVENUE, 0) AS DOUBLE) AS LIFETIME_REVENUE, coalesce(s.AVG_ORDER_VALUE, 0) AS AVG_ORDER_VALUE,
  s.FIRST_ORDER_DATE, s.LAST_ORDER_DATE, h.LOAD_DATETIME AS FIRST_SEEN_DATE, {AS_OF} AS SNAPSHOT_AT
FROM hub_customer h LEFT JOIN {newest('sat_customer_details', 'HK_CUSTOMER')} d ON h.HK_CUSTOMER = d.HK_CUSTOMER
LEFT JOIN {newest('sat_customer_demographics', 'HK_CUSTOMER')} m ON h.HK_CUSTOMER = m.HK_CUSTOMER LEFT JOIN customer_order_stats s ON h.HK_CUSTOMER = s.HK_CUSTOMER"""

CTES["product_sales"] = """SELECT l.HK_PRODUCT, sum(i.QUANTITY) AS UNITS_SOLD, sum(i.LINE_TOTAL) AS REVENUE
FROM link_order_product l LEFT JOIN raw_order_items i ON l.ORDER_ITEM_ID = i.ORDER_ITEM_ID GROUP BY l.HK_PRODUCT"""

CTES["dp_product_performance"] = f"""SELECT p.PRODUCT_ID, p.PRODUCT_NAME, p.CATEGORY, p.SUBCATEGORY, p.BRAND, CAST(p.UNIT_PRICE AS DOUBLE) AS CURRENT_PRICE, CAST(p.COST_PRICE AS DOUBLE) AS COST_PRICE,
  round((CAST(p.UNIT_PRICE AS DOUBLE) - p.COST_PRICE) / nullif(p.UNIT_PRICE, 0) * 100, 4) AS MARGIN_PERCENT, CAST(coalesce(s.UNITS_SOLD, 0) AS DOUBLE) AS LIFETIME_UNITS_SOLD,
  CAST(coalesce(s.REVENUE, 0) AS DOUBLE) AS LIFETIME_REVENUE, p.IS_ACTIVE, {AS_OF} AS SNAPSHOT_AT FROM dim_product p LEFT JOIN product_sales s ON p.HK_PRODUCT = s.HK_PRODUCT"""

CTES["feature_base"] = f"""SELECT h.CUSTOMER_ID, h.HK_CUSTOMER, m.CUSTOMER_SEGMENT, m.LOYALTY_TIER, coalesce(s.ORDER_COUNT, 0) AS n,
  CAST(coalesce(s.TOTAL_REVENUE, 0) AS DOUBLE) AS rev, coalesce(s.AVG_ORDER_VALUE, 0) AS aov, CAST(coalesce(s.TOTAL_DISCOUNT, 0) AS DOUBLE) AS disc,
  CAST(date_diff('day', h.LOAD_DATETIME, {AS_OF}) AS INTEGER) AS days, CAST(coalesce(date_diff('day', s.LAST_ORDER_DATE, {AS_OF}), 999) AS INTEGER) AS idle
FROM hub_customer h LEFT JOIN {newest('sat_customer_demographics', 'HK_CUSTOMER')} m ON h.HK_CUSTOMER = m.HK_CUSTOMER LEFT JOIN customer_order_stats s ON h.HK_CUSTOMER = s.HK_CUSTOMER"""
CLV = """CASE WHEN n = 0 THEN 0.0 ELSE round(CAST(n AS DOUBLE) / (CAST(greatest(coalesce(days, 1), 1) AS DOUBLE) / 365.0::DOUBLE) * aov *
  CAST(CASE LOYALTY_TIER WHEN 'PLATINUM' THEN 1.5 WHEN 'GOLD' THEN 1.3 WHEN 'SILVER' THEN 1.1 ELSE 1.0 END AS DOUBLE), 2) END"""
CTES["feature_store_customer"] = f"""SELECT CUSTOMER_ID, HK_CUSTOMER, CUSTOMER_SEGMENT, LOYALTY_TIER, n AS FEATURE_ORDER_COUNT, rev AS FEATURE_TOTAL_REVENUE, aov AS FEATURE_AVG_ORDER_VALUE,
  disc AS FEATURE_TOTAL_DISCOUNT, days AS FEATURE_DAYS_SINCE_REGISTRATION, idle AS FEATURE_DAYS_SINCE_LAST_ORDER, {CLV} AS FEATURE_PREDICTED_CLV, {AS_OF} AS FEATURE_COMPUTED_AT FROM feature_base"""

CTES["product_search_corpus"] = """SELECT PRODUCT_ID, PRODUCT_NAME, CATEGORY, SUBCATEGORY, BRAND,
  PRODUCT_NAME || ' ' || coalesce(CATEGORY, '') || ' ' || coalesce(SUBCATEGORY, '') || ' ' || coalesce(BRAND, '') AS PRODUCT_DESCRIPTION,
  CAST(UNIT_PRICE AS DOUBLE) AS UNIT_PRICE, CAST(COST_PRICE AS DOUBLE) AS COST_PRICE FROM dim_product"""

CTES["customer_profile_text"] = f"""SELECT h.CUSTOMER_ID, d.FIRST_NAME, d.LAST_NAME, d.EMAIL,
  'Classify this customer profile into one of: HIGH_VALUE, GROWTH, AT_RISK, CHURNED. Segment: ' || coalesce(m.CUSTOMER_SEGMENT, 'UNKNOWN')
   || ', Loyalty: ' || coalesce(m.LOYALTY_TIER, 'NONE') || ', Orders: ' || coalesce(CAST(s.ORDER_COUNT AS VARCHAR), '0') AS CLASSIFY_TEXT,
  'Customer ' || d.FIRST_NAME || ' ' || d.LAST_NAME || ' is in segment ' || coalesce(m.CUSTOMER_SEGMENT, 'UNKNOWN') || ' with loyalty tier ' || coalesce(m.LOYALTY_TIER, 'NONE')
   || ' and has placed ' || coalesce(CAST(s.ORDER_COUNT AS VARCHAR), '0') || ' orders.' AS SUMMARY_TEXT,
  s.ORDER_COUNT, CAST(s.TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE, m.CUSTOMER_SEGMENT, m.LOYALTY_TIER
FROM hub_customer h LEFT JOIN {newest('sat_customer_details', 'HK_CUSTOMER')} d ON h.HK_CUSTOMER = d.HK_CUSTOMER
LEFT JOIN {newest('sat_customer_demographics', 'HK_CUSTOMER')} m ON h.HK_CUSTOMER = m.HK_CUSTOMER LEFT JOIN customer_order_stats s ON h.HK_CUSTOMER = s.HK_CUSTOMER"""
