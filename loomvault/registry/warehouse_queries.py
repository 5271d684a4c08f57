"""Staging, vault, silver, gold and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import at
from ..operators.history import scd2_intervals
from ..plans import gold, semantic, vault
from ..plans import warehouse as loaders
from ..sources import testbed
from .base import doubles, query
from .ctes import SAT_COLUMNS, calendar, newest

MONEY = {
    "stg_orders": ("TOTAL_AMOUNT", "DISCOUNT_AMOUNT", "TAX_AMOUNT"),
    "stg_products": ("WEIGHT_KG", "UNIT_PRICE", "COST_PRICE"),
    "stg_order_items": ("QUANTITY", "UNIT_PRICE", "DISCOUNT_PERCENT", "LINE_TOTAL"),
    "sat_order_financials": ("TOTAL_AMOUNT", "DISCOUNT_AMOUNT", "TAX_AMOUNT"),
    "sat_product_details": ("WEIGHT_KG",),
    "sat_product_pricing": ("UNIT_PRICE", "COST_PRICE"),
    "bv_order_lifecycle": ("TOTAL_AMOUNT", "DISCOUNT_AMOUNT", "TAX_AMOUNT", "NET_AMOUNT"),
    "conformed_orders": ("TOTAL_AMOUNT", "DISCOUNT_AMOUNT", "TAX_AMOUNT", "NET_AMOUNT"),
    "bv_customer_classification": ("TOTAL_REVENUE", "AVG_ORDER_VALUE"),
    "conformed_customers": ("TOTAL_REVENUE", "AVG_ORDER_VALUE"),
    "dim_customer": ("TOTAL_REVENUE", "AVG_ORDER_VALUE"),
    "dim_product": ("WEIGHT_KG", "UNIT_PRICE", "COST_PRICE", "MARGIN_PERCENT"),
    "fct_orders": ("TOTAL_AMOUNT", "DISCOUNT_AMOUNT", "TAX_AMOUNT", "NET_AMOUNT"),
    "fct_order_items": ("QUANTITY", "UNIT_PRICE", "DISCOUNT_PERCENT", "LINE_TOTAL", "GROSS_AMOUNT", "DISCOUNT_AMOUNT"),
}
OPEN_ENDED = {name: ("EFFECTIVE_TO",) for name in ("eff_sat_customer_order", "bridge_customer_order", "dim_customer", "dim_product")}


def _frame_query(name: str) -> None:
    query(name, doubles(name, *MONEY.get(name, ()), texts=OPEN_ENDED.get(name, ())))(
        lambda w, spark, folder, name=name: getattr(w, name)
    )


for _name in (
    "stg_customers", "stg_orders", "stg_products", "stg_order_items",
    "hub_customer", "hub_order", "hub_product", "link_customer_order", "link_order_product",
    *SAT_COLUMNS, "pit_customer", "pit_order", "bridge_customer_order", "hub_bridge",
    "bv_order_lifecycle", "bv_customer_classification", "conformed_orders", "conformed_customers",
    "dim_customer", "dim_product", "fct_orders", "fct_order_items",
    "agg_monthly_revenue", "agg_customer_ltv", "agg_revenue_by_segment", "dp_customer_360", "dp_product_performance",
    "feature_store_customer", "product_search_corpus", "customer_profile_text",
):
    _frame_query(_name)


# ---- loaders in two batches: the second batch meets the first as its target ---------------
HALF = "1998-01-01 00:00:00"
EVENT_HALF = "2024-01-10 00:00:00"


def _batches(staged, cut: str = HALF):
    return staged.where(F.col("LOAD_DATETIME") < at(cut)), staged.where(F.col("LOAD_DATETIME") >= at(cut))


def two_batches(load, staged, cut: str = HALF):
    """First batch into an empty table, second batch against it."""
    first, second = _batches(staged, cut)
    stored = load(first)
    return stored.unionByName(load(second, stored))


@query("load_hub", doubles("hub_order"))
def load_hub(w, spark, folder):
    return two_batches(loaders.load_hub_order, w.stg_orders)


@query("load_link", doubles("link_customer_order"))
def load_link(w, spark, folder):
    return two_batches(loaders.load_link_customer_order, w.stg_orders)


@query("load_satellite", doubles("sat_customer_demographics"))
def load_satellite(w, spark, folder):
    return two_batches(loaders.load_sat_customer_demographics, w.stg_customers, EVENT_HALF)


@query("load_eff_satellite", doubles("eff_sat_customer_order", texts=("EFFECTIVE_TO",)))
def load_eff_satellite(w, spark, folder):
    return two_batches(loaders.load_eff_sat_customer_order, w.stg_orders)


query("eff_sat_customer_order", doubles("eff_sat_customer_order", texts=("EFFECTIVE_TO",)))(
    lambda w, spark, folder: w.eff_sat_customer_order
)


@query("load_pit", """SELECT p.HK_PRODUCT, p.t AS PIT_LOAD_DATETIME, d.LOAD_DATETIME AS DETAILS_LDTS, d.HASH_DIFF AS DETAILS_HD,
  r.LOAD_DATETIME AS PRICING_LDTS, r.HASH_DIFF AS PRICING_HD
FROM (SELECT HK_PRODUCT, LOAD_DATETIME AS t FROM hub_product UNION SELECT HK_PRODUCT, LOAD_DATETIME FROM sat_product_details
      UNION SELECT HK_PRODUCT, LOAD_DATETIME FROM sat_product_pricing) p
ASOF LEFT JOIN sat_product_details d ON p.HK_PRODUCT = d.HK_PRODUCT AND p.t >= d.LOAD_DATETIME
ASOF LEFT JOIN sat_product_pricing r ON p.HK_PRODUCT = r.HK_PRODUCT AND p.t >= r.LOAD_DATETIME""")
def load_pit(w, spark, folder):
    return vault.load_pit(w.hub_product, "HK_PRODUCT", {"DETAILS": w.sat_product_details, "PRICING": w.sat_product_pricing})


@query("load_bridge", """SELECT HK_LINK_CUSTOMER_ORDER, HK_CUSTOMER, HK_ORDER, LINK_LOAD_DATETIME, LINK_RECORD_SOURCE, IS_ACTIVE, EFFECTIVE_FROM,
  strftime(EFFECTIVE_TO, '%Y-%m-%d %H:%M:%S') AS EFFECTIVE_TO FROM bridge_customer_order WHERE IS_ACTIVE""")
def load_bridge(w, spark, folder):
    return vault.load_bridge(w.link_customer_order, "HK_LINK_CUSTOMER_ORDER", ["HK_CUSTOMER", "HK_ORDER"],
                             w.eff_sat_customer_order, active_only=True)


query("pit_current", doubles("pit_customer_current"))(lambda w, spark, folder: w.pit_customer_current)


@query("snapshot_scd2", f"""SELECT * REPLACE (strftime(VALID_TO, '%Y-%m-%d %H:%M:%S') AS VALID_TO) FROM (
  SELECT a.* EXCLUDE (RECORD_SOURCE), a.LOAD_DATETIME AS VALID_FROM, CASE WHEN b.LOAD_DATETIME > a.LOAD_DATETIME THEN b.LOAD_DATETIME END AS VALID_TO
  FROM (SELECT * FROM sat_customer_details WHERE LOAD_DATETIME < TIMESTAMP '{EVENT_HALF}' QUALIFY row_number() OVER (PARTITION BY HK_CUSTOMER ORDER BY LOAD_DATETIME DESC) = 1) a
  JOIN {newest('sat_customer_details', 'HK_CUSTOMER')} b USING (HK_CUSTOMER)
  UNION ALL
  SELECT b.* EXCLUDE (RECORD_SOURCE), b.LOAD_DATETIME, NULL FROM {newest('sat_customer_details', 'HK_CUSTOMER')} b WHERE b.LOAD_DATETIME >= TIMESTAMP '{EVENT_HALF}')""")
def snapshot_scd2(w, spark, folder):
    sat = w.sat_customer_details.drop("RECORD_SOURCE")
    early = vault.vault_as_of(sat.where(F.col("LOAD_DATETIME") < at(EVENT_HALF)), "HK_CUSTOMER", w.as_of.replace("2001", "2024"))
    state = vault.snapshot_scd2(None, early, "HK_CUSTOMER", "LOAD_DATETIME", testbed.AS_OF_EVENTS)
    now = vault.vault_as_of(sat, "HK_CUSTOMER", testbed.AS_OF_EVENTS)
    return vault.snapshot_scd2(state, now, "HK_CUSTOMER", "LOAD_DATETIME", testbed.AS_OF_EVENTS)


@query("vault_as_of", f"""SELECT HK_ORDER, ORDER_STATUS, ORDER_DATE, LOAD_DATETIME FROM sat_order_details WHERE LOAD_DATETIME <= TIMESTAMP '{HALF}'
QUALIFY row_number() OVER (PARTITION BY HK_ORDER ORDER BY LOAD_DATETIME DESC) = 1""")
def vault_as_of(w, spark, folder):
    sat = w.sat_order_details.select("HK_ORDER", "ORDER_STATUS", "ORDER_DATE", "LOAD_DATETIME")
    return vault.vault_as_of(sat, "HK_ORDER", HALF)


@query("scd2_intervals", """SELECT HK_CUSTOMER, EMAIL, LOAD_DATETIME, LOAD_DATETIME AS VALID_FROM,
  strftime(coalesce(lead(LOAD_DATETIME) OVER w, TIMESTAMP '9999-12-31 00:00:00'), '%Y-%m-%d %H:%M:%S') AS VALID_TO,
  lead(LOAD_DATETIME) OVER w IS NULL AS IS_CURRENT FROM sat_customer_details WINDOW w AS (PARTITION BY HK_CUSTOMER ORDER BY LOAD_DATETIME)""")
def scd2(w, spark, folder):
    return scd2_intervals(w.sat_customer_details.select("HK_CUSTOMER", "EMAIL", "LOAD_DATETIME"), "HK_CUSTOMER", "LOAD_DATETIME")


@query("dim_date", calendar("""SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), last_day(CAST(max(o_orderdate) AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM orders"""))
def dim_date(w, spark, folder):
    return gold.calendar_of(w.landing.orders, "ORDER_DATE", w.as_of)


@query("secure_customer_profiles", """SELECT CUSTOMER_SK, CUSTOMER_ID, left(FULL_NAME, 1) || '****' AS FULL_NAME,
  CASE WHEN regexp_matches(EMAIL, '^.{2}.*@.*$') THEN regexp_replace(EMAIL, '^(.{2})(.*)(@.*)$', '\\1***\\3') WHEN EMAIL IS NOT NULL THEN '***' END AS EMAIL,
  '***-***-' || right(PHONE, 4) AS PHONE, COUNTRY_CODE, CITY, STATE, GENDER, CUSTOMER_SEGMENT, LOYALTY_TIER, RFM_SEGMENT, LTV_TIER, CHURN_RISK, IS_ACTIVE, TOTAL_ORDERS,
  CAST(TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE, CAST(AVG_ORDER_VALUE AS DOUBLE) AS AVG_ORDER_VALUE, LAST_ORDER_DATE, LAST_UPDATED_AT FROM dim_customer WHERE IS_CURRENT""")
def secure_customer_profiles(w, spark, folder):
    from ..operators.governance import secure_customer_profiles as view
    return view(w.dim_customer, "ANALYST")


# ---- metric layer ---------------------------------------------------------------------------
@query("sv_customer_360", """SELECT COUNTRY_CODE AS country, CUSTOMER_SEGMENT AS segment, LOYALTY_TIER AS loyalty_tier, RFM_SEGMENT AS rfm_segment, LTV_TIER AS ltv_tier,
  CAST(sum(TOTAL_REVENUE) AS DOUBLE) AS total_revenue, CAST(sum(CAST(AVG_ORDER_VALUE AS DECIMAL(22,8))) AS DOUBLE) / count(*) AS avg_order_value, CAST(sum(TOTAL_ORDERS) AS BIGINT)::DOUBLE AS total_orders,
  count(*) FILTER (WHERE IS_ACTIVE) AS active_customers, count(*) FILTER (WHERE CHURN_RISK = 'HIGH') / count(*) AS churn_rate
FROM dim_customer GROUP BY ALL""")
def sv_customer_360(w, spark, folder):
    view = semantic.customer_view(w.dim_customer)
    return semantic.semantic_query(view, list(view.metrics), list(view.dimensions))


@query("sv_revenue_analytics", """SELECT CAST(date_trunc('month', ORDER_DATE) AS DATE) AS order_date, CURRENCY_CODE AS currency, LIFECYCLE_STAGE AS lifecycle_stage,
  PAYMENT_METHOD AS payment_method, SHIPPING_METHOD AS shipping_method, CAST(sum(TOTAL_AMOUNT) AS DOUBLE) AS gross_revenue, CAST(sum(NET_AMOUNT) AS DOUBLE) AS net_revenue,
  CAST(sum(DISCOUNT_AMOUNT) AS DOUBLE) AS total_discounts, avg(HOURS_TO_FULFILLMENT) AS avg_fulfillment_hours,
  count(*) FILTER (WHERE SLA_MET) / count(*) AS sla_compliance_rate, count(*) AS order_count
FROM fct_orders GROUP BY ALL""")
def sv_revenue_analytics(w, spark, folder):
    view = semantic.revenue_view(w.fct_orders)
    return semantic.semantic_query(view, list(view.metrics), list(view.dimensions), grain="month")


@query("sv_product_performance", """SELECT p.CATEGORY AS category, p.SUBCATEGORY AS subcategory, p.BRAND AS brand, p.IS_ACTIVE AS is_active, CAST(sum(i.QUANTITY) AS DOUBLE) AS units_sold,
  CAST(sum(i.LINE_TOTAL) AS DOUBLE) AS product_revenue, CAST(sum(CAST(p.MARGIN_PERCENT AS DECIMAL(18,2))) AS DOUBLE) / count(p.MARGIN_PERCENT) AS margin_percent,
  CAST(sum((CAST(i.LINE_TOTAL * 10000 AS HUGEINT) * 2000 + CAST(i.QUANTITY AS HUGEINT)) // (2 * CAST(i.QUANTITY AS HUGEINT))) AS DOUBLE) / 1e7 / count(i.LINE_TOTAL) AS avg_selling_price
FROM dim_product p LEFT JOIN fct_order_items i ON p.PRODUCT_SK = i.PRODUCT_SK GROUP BY ALL""")
def sv_product_performance(w, spark, folder):
    view = semantic.product_view(w.dim_product, w.fct_order_items)
    return semantic.semantic_query(view, list(view.metrics), list(view.dimensions))


@query("predict_clv", f"""SELECT CUSTOMER_ID, FEATURE_PREDICTED_CLV AS PREDICTED_CLV FROM feature_store_customer""")
def predict_clv(w, spark, folder):
    return w.feature_store_customer.select("CUSTOMER_ID", F.col("FEATURE_PREDICTED_CLV").alias("PREDICTED_CLV"))
