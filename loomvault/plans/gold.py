"""Dimensions, facts, aggregates and data products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import dates
from ..functions.keys import hash_key, surrogate_key
from ..functions.scoring import predict_clv
from ..operators.ranking import global_ranks, percent_rank_of
from ..session import cut_lineage
from .silver import current


def dim_date(spark: SparkSession, start: str, end: str, as_of: str) -> DataFrame:
    """Calendar of the half-open range [start, end)."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))).alias("DATE_DAY")
    )
    return calendar_columns(days, as_of)


def calendar_of(instants: DataFrame, column: str, as_of: str) -> DataFrame:
    """Calendar over the whole months that a table's instants span."""
    span = instants.agg(
        F.trunc(F.to_date(F.min(column)), "month").alias("first"), F.last_day(F.to_date(F.max(column))).alias("last")
    )
    return calendar_columns(span.select(F.explode(F.sequence("first", "last")).alias("DATE_DAY")), as_of)


def calendar_columns(days: DataFrame, as_of: str) -> DataFrame:
    day = F.col("DATE_DAY")
    weekday = dates.weekday_from_sunday(day)
    weekend = weekday.isin(0, 6)
    today = F.to_date(dates.at(as_of))
    return days.select(
        F.date_format(day, "yyyyMMdd").alias("DATE_KEY"),
        day,
        F.year(day).alias("CALENDAR_YEAR"),
        F.quarter(day).alias("CALENDAR_QUARTER"),
        F.month(day).alias("CALENDAR_MONTH"),
        F.weekofyear(day).alias("CALENDAR_WEEK"),
        F.dayofyear(day).alias("DAY_OF_YEAR"),
        F.dayofmonth(day).alias("DAY_OF_MONTH"),
        weekday.alias("DAY_OF_WEEK"),
        F.dayname(day).alias("DAY_NAME"),
        F.monthname(day).alias("MONTH_NAME"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("QUARTER_NAME"),
        F.concat(F.year(day), F.lit("-Q"), F.quarter(day)).alias("YEAR_QUARTER"),
        F.date_format(day, "yyyy-MM").alias("YEAR_MONTH"),
        weekend.alias("IS_WEEKEND"),
        (~weekend).alias("IS_WEEKDAY"),
        (F.dayofmonth(day) == 1).alias("IS_FIRST_OF_MONTH"),
        (day == F.last_day(day)).alias("IS_LAST_OF_MONTH"),
        (day == today).alias("IS_TODAY"),
        F.datediff(today, day).alias("DAYS_AGO"),
        dates.fiscal_year(day).alias("FISCAL_YEAR"),
        dates.fiscal_quarter(day).alias("FISCAL_QUARTER"),
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    lapsed = (F.col("CHURN_RISK") == "HIGH") | (F.col("DAYS_SINCE_LAST_ORDER") > 365)
    return customers.select(
        surrogate_key(customers, "HK_CUSTOMER").alias("CUSTOMER_SK"), "HK_CUSTOMER", "CUSTOMER_ID",
        "FIRST_NAME", "LAST_NAME", F.concat("FIRST_NAME", F.lit(" "), "LAST_NAME").alias("FULL_NAME"),
        "EMAIL", "PHONE", "COUNTRY_CODE", "CITY", "STATE", "POSTAL_CODE", "REGISTRATION_DATE",
        "DATE_OF_BIRTH", "GENDER", "CUSTOMER_SEGMENT", "LOYALTY_TIER", "RFM_SEGMENT", "LTV_TIER", "CHURN_RISK",
        "TOTAL_ORDERS", "TOTAL_REVENUE", "AVG_ORDER_VALUE", "RECENCY_SCORE", "FREQUENCY_SCORE", "MONETARY_SCORE",
        F.when(lapsed, False).otherwise(True).alias("IS_ACTIVE"),
        "FIRST_LOADED_AT", "LAST_ORDER_DATE", F.col("CONFORMED_AT").alias("LAST_UPDATED_AT"),
        F.lit(True).alias("IS_CURRENT"), F.col("FIRST_LOADED_AT").alias("EFFECTIVE_FROM"),
        dates.end_of_time().alias("EFFECTIVE_TO"),
    )


def dim_product(hub_product: DataFrame, details: DataFrame, pricing: DataFrame) -> DataFrame:
    hub = hub_product.select("HK_PRODUCT", "PRODUCT_ID", F.col("LOAD_DATETIME").alias("FIRST_LOADED_AT"))
    det = current(details, "HK_PRODUCT").withColumnRenamed("LOAD_DATETIME", "DETAILS_LAST_UPDATED")
    price = current(pricing, "HK_PRODUCT").withColumnRenamed("LOAD_DATETIME", "PRICING_LAST_UPDATED")
    joined = hub.join(det, "HK_PRODUCT", "left").join(price, "HK_PRODUCT", "left")
    margin = F.when(
        F.col("COST_PRICE") > 0,
        F.round((F.col("UNIT_PRICE") - F.col("COST_PRICE")) / F.col("COST_PRICE") * 100, 2),
    ).otherwise(0)
    return joined.select(
        surrogate_key(joined, "HK_PRODUCT").alias("PRODUCT_SK"), "HK_PRODUCT", "PRODUCT_ID",
        "PRODUCT_NAME", "CATEGORY", "SUBCATEGORY", "BRAND", "WEIGHT_KG", "IS_ACTIVE",
        F.col("CREATED_AT").alias("PRODUCT_CREATED_AT"), F.col("UPDATED_AT").alias("PRODUCT_UPDATED_AT"),
        "UNIT_PRICE", "COST_PRICE", margin.cast("decimal(18,2)").alias("MARGIN_PERCENT"),
        "FIRST_LOADED_AT", "DETAILS_LAST_UPDATED", "PRICING_LAST_UPDATED",
        F.lit(True).alias("IS_CURRENT"), F.col("FIRST_LOADED_AT").alias("EFFECTIVE_FROM"),
        dates.end_of_time().alias("EFFECTIVE_TO"),
    )


def fct_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        surrogate_key(orders, "ORDER_ID").alias("ORDER_SK"), "HK_ORDER", "ORDER_ID", "HK_CUSTOMER",
        surrogate_key(orders, "HK_CUSTOMER").alias("CUSTOMER_SK"),
        dates.date_key(F.col("ORDER_DATE")).alias("ORDER_DATE_KEY"),
        "ORDER_DATE", "FULFILLMENT_DATE", "ORDER_STATUS", "LIFECYCLE_STAGE", "IS_TERMINAL", "SHIPPING_METHOD",
        "PAYMENT_METHOD", "CURRENCY_CODE", "TOTAL_AMOUNT", "DISCOUNT_AMOUNT", "TAX_AMOUNT", "NET_AMOUNT",
        "HOURS_TO_FULFILLMENT", "TOTAL_STATUS_CHANGES", "SLA_MET", F.col("CONFORMED_AT").alias("UPDATED_AT"),
    )


def fct_order_items(staged_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items with their order's date and currency; two order columns and no digest reach the exchange."""
    order = orders.select("ORDER_ID", "ORDER_DATE", "CURRENCY_CODE")
    items = staged_items.select(
        "ORDER_ITEM_ID", "ORDER_ID", "PRODUCT_ID", "QUANTITY", "UNIT_PRICE", "DISCOUNT_PERCENT", "LINE_TOTAL", "LOAD_DATETIME",
    )
    gross = F.col("QUANTITY") * F.col("UNIT_PRICE")
    joined = items.join(order, "ORDER_ID", "left")
    keyed = joined.withColumns({
        "HK_LINK_ORDER_PRODUCT": hash_key(joined, "ORDER_ID", "PRODUCT_ID", "ORDER_ITEM_ID"),
        "HK_ORDER": hash_key(joined, "ORDER_ID"), "HK_PRODUCT": hash_key(joined, "PRODUCT_ID"),
    })
    return keyed.select(
        surrogate_key(keyed, "ORDER_ITEM_ID").alias("ORDER_ITEM_SK"), surrogate_key(keyed, "ORDER_ID").alias("ORDER_SK"),
        surrogate_key(keyed, "HK_PRODUCT").alias("PRODUCT_SK"),
        "HK_LINK_ORDER_PRODUCT", "HK_ORDER", "HK_PRODUCT", "ORDER_ITEM_ID", "ORDER_ID", "PRODUCT_ID",
        dates.date_key(F.col("ORDER_DATE")).alias("ORDER_DATE_KEY"), "ORDER_DATE",
        "QUANTITY", "UNIT_PRICE", "DISCOUNT_PERCENT", "LINE_TOTAL",
        gross.alias("GROSS_AMOUNT"),
        (gross * (F.col("DISCOUNT_PERCENT") / 100)).cast("decimal(28,6)").alias("DISCOUNT_AMOUNT"),
        "CURRENCY_CODE", F.col("LOAD_DATETIME").alias("UPDATED_AT"),
    )


def counted(orders: DataFrame) -> DataFrame:
    return orders.where(~F.col("ORDER_STATUS").isin(*config.UNCOUNTED_STATUSES))


MONTH_KEYS = ("CALENDAR_YEAR", "CALENDAR_MONTH", "YEAR_MONTH", "CALENDAR_QUARTER", "YEAR_QUARTER", "CURRENCY_CODE")


REVENUE = {"TOTAL_AMOUNT": "GROSS_REVENUE", "NET_AMOUNT": "NET_REVENUE", "DISCOUNT_AMOUNT": "TOTAL_DISCOUNTS", "TAX_AMOUNT": "TOTAL_TAX"}
REVENUE_TYPES = {"NET_AMOUNT": "decimal(30,4)"}  # others decimal(28,4)


def customer_months(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Counted orders reduced to (customer, month, currency): their number, amounts and how many amounts there are."""
    # A calendar has one row per day: a few thousand rows whatever the fact's size.
    days = F.broadcast(calendar.select("DATE_KEY", *MONTH_KEYS[:5]))
    dated = counted(orders).join(days, F.col("ORDER_DATE_KEY") == F.col("DATE_KEY"))
    return dated.groupBy("HK_CUSTOMER", *MONTH_KEYS).agg(
        F.count("*").alias("n"), *[F.sum(c).cast(REVENUE_TYPES.get(c, "decimal(28,4)")).alias(c) for c in REVENUE],
        *[F.count(c).alias(f"{c}_KNOWN") for c in REVENUE])


def month_parts(months: DataFrame) -> DataFrame:
    """What customers add to each month: all columns are sums, so parts of customers may be added and taken away.

    A customer's first month is a window over few rows (at most months x currencies per customer, however many orders it
    has), and the three distinct counts become plain counts of flagged rows.
    """
    tagged = months.withColumn("first_month", F.min("YEAR_MONTH").over(Window.partitionBy("HK_CUSTOMER")))
    known = F.col("HK_CUSTOMER").isNotNull()
    return tagged.groupBy(*MONTH_KEYS).agg(
        F.sum("n").alias("TOTAL_ORDERS"),
        *[F.sum(c).cast(REVENUE_TYPES.get(c, "decimal(28,4)")).alias(total) for c, total in REVENUE.items()],
        *[F.sum(f"{c}_KNOWN").alias(f"{c}_KNOWN") for c in REVENUE],
        F.count_if(known).alias("UNIQUE_CUSTOMERS"),
        F.count_if(known & (F.col("first_month") == F.col("YEAR_MONTH"))).alias("NEW_CUSTOMERS"),
        F.count_if(known & (F.col("first_month") < F.col("YEAR_MONTH"))).alias("RETURNING_CUSTOMERS"),
    )


def monthly_revenue_of(parts: DataFrame, as_of: str) -> DataFrame:
    """Month x currency revenue from its summed parts."""
    average = F.when(F.col("TOTAL_AMOUNT_KNOWN") > 0, F.col("GROSS_REVENUE").cast("double") / F.col("TOTAL_ORDERS"))
    totals = [F.when(F.col(f"{c}_KNOWN") > 0, F.col(total)).alias(total) for c, total in REVENUE.items()]  # no amount is no total, not 0
    return parts.select(*MONTH_KEYS, "TOTAL_ORDERS", *totals, average.alias("AVG_ORDER_VALUE"), "UNIQUE_CUSTOMERS", "NEW_CUSTOMERS",
                        "RETURNING_CUSTOMERS", dates.at(as_of).alias("AGGREGATED_AT"))


def agg_monthly_revenue(orders: DataFrame, calendar: DataFrame, as_of: str) -> DataFrame:
    """Month x currency revenue with distinct, new and returning customers."""
    return monthly_revenue_of(month_parts(customer_months(orders, calendar)), as_of)


def customer_spend(orders: DataFrame) -> DataFrame:
    return counted(orders).groupBy("HK_CUSTOMER").agg(
        F.count("*").alias("ORDER_COUNT"),
        F.sum("NET_AMOUNT").alias("TOTAL_SPEND"),
        F.min("ORDER_DATE").alias("FIRST_ORDER_DATE"),
        F.max("ORDER_DATE").alias("LAST_ORDER_DATE"),
    )


def agg_customer_ltv(customers: DataFrame, spend: DataFrame, as_of: str) -> DataFrame:
    now = dates.at(as_of)
    people = customers.select("CUSTOMER_SK", "HK_CUSTOMER", "CUSTOMER_ID", "FULL_NAME", "COUNTRY_CODE",
                              "CUSTOMER_SEGMENT", "LOYALTY_TIER", "RFM_SEGMENT", "LTV_TIER", "CHURN_RISK")
    base = people.join(spend, "HK_CUSTOMER", "left").withColumns({
        "LIFETIME_SPEND": F.coalesce(F.col("TOTAL_SPEND"), F.lit(0)).cast("decimal(30,4)"),
        "TENURE_MONTHS": F.coalesce(dates.months_between(F.col("FIRST_ORDER_DATE"), F.col("LAST_ORDER_DATE")), F.lit(0)),
    })
    base = cut_lineage(base)  # read by the ranking and by the join
    ranks, rows = global_ranks(base.select("HK_CUSTOMER", "LIFETIME_SPEND"), "HK_CUSTOMER", {"SPEND": F.col("LIFETIME_SPEND")})
    lasted = F.col("TENURE_MONTHS") > 0
    months = F.col("TENURE_MONTHS").cast("decimal(10,0)")
    total, count = F.col("TOTAL_SPEND").cast("decimal(28,4)"), F.col("ORDER_COUNT").cast("decimal(20,0)")

    def rate(col: Column) -> Column:
        return F.when(lasted, F.round(col, 2)).otherwise(F.lit(0)).cast("decimal(30,2)")

    return base.join(ranks, "HK_CUSTOMER", "left").select(
        "CUSTOMER_SK", "HK_CUSTOMER", "CUSTOMER_ID", "FULL_NAME", "COUNTRY_CODE", "CUSTOMER_SEGMENT", "LOYALTY_TIER",
        "RFM_SEGMENT",
        F.coalesce("ORDER_COUNT", F.lit(0)).alias("LIFETIME_ORDER_COUNT"),
        "LIFETIME_SPEND",
        F.coalesce(F.col("TOTAL_SPEND").cast("double") / F.col("ORDER_COUNT"), F.lit(0.0)).alias("LIFETIME_AOV"),
        "FIRST_ORDER_DATE", "LAST_ORDER_DATE", "TENURE_MONTHS",
        F.coalesce(dates.days_between(F.col("LAST_ORDER_DATE"), now), F.lit(config.NEVER_ORDERED_DAYS)).alias("DAYS_SINCE_LAST_ORDER"),
        rate(count / F.nullif(months, F.lit(0).cast("decimal(10,0)"))).alias("ORDERS_PER_MONTH"),
        rate(total / F.nullif(months, F.lit(0).cast("decimal(10,0)"))).alias("MONTHLY_SPEND_RATE"),
        rate(total / F.nullif(months, F.lit(0).cast("decimal(10,0)")) * 12).alias("PREDICTED_12M_VALUE"),
        "LTV_TIER", "CHURN_RISK",
        percent_rank_of(F.col("SPEND_RANK"), rows).alias("SPEND_PERCENTILE"),
        now.alias("AGGREGATED_AT"),
    )


def customer_order_stats(link: DataFrame, financials: DataFrame) -> DataFrame:
    """All orders per customer with their newest amounts, cancelled ones included."""
    money = current(financials.select("HK_ORDER", "TOTAL_AMOUNT", "DISCOUNT_AMOUNT", "LOAD_DATETIME"), "HK_ORDER")
    return link.select("HK_ORDER", "HK_CUSTOMER").join(money, "HK_ORDER", "left").groupBy("HK_CUSTOMER").agg(
        F.count("*").alias("ORDER_COUNT"),
        F.sum("TOTAL_AMOUNT").alias("TOTAL_REVENUE"),
        F.count("TOTAL_AMOUNT").alias("PRICED_ORDERS"),
        F.sum("DISCOUNT_AMOUNT").alias("TOTAL_DISCOUNT"),
        F.min("LOAD_DATETIME").alias("FIRST_ORDER_DATE"),
        F.max("LOAD_DATETIME").alias("LAST_ORDER_DATE"),
    )


def _average(total: str, count: str):
    return F.col(total).cast("double") / F.nullif(F.col(count), F.lit(0))


def agg_revenue_by_segment(pit: DataFrame, demographics: DataFrame, link: DataFrame, financials: DataFrame,
                           as_of: str) -> DataFrame:
    """Segment x tier at the PIT pointer. Orders are reduced per customer before the segment join."""
    stats = customer_order_stats(link, financials)
    at_pointer = demographics.select(
        F.col("HK_CUSTOMER").alias("SAT_DEMOGRAPHICS_HK"), F.col("LOAD_DATETIME").alias("SAT_DEMOGRAPHICS_LOAD_DT"),
        "CUSTOMER_SEGMENT", "LOYALTY_TIER",
    )
    joined = (
        pit.select("HK_CUSTOMER", "SAT_DEMOGRAPHICS_HK", "SAT_DEMOGRAPHICS_LOAD_DT")
        .join(at_pointer, ["SAT_DEMOGRAPHICS_HK", "SAT_DEMOGRAPHICS_LOAD_DT"], "left")
        .join(stats, "HK_CUSTOMER", "left")
    )
    return joined.groupBy("CUSTOMER_SEGMENT", "LOYALTY_TIER").agg(
        F.count("*").alias("CUSTOMER_COUNT"),
        F.coalesce(F.sum("ORDER_COUNT"), F.lit(0)).alias("ORDER_COUNT"),
        F.sum("TOTAL_REVENUE").cast("decimal(28,4)").alias("TOTAL_REVENUE"),
        (F.sum("TOTAL_REVENUE").cast("double") / F.nullif(F.sum("PRICED_ORDERS"), F.lit(0))).alias("AVG_ORDER_VALUE"),
        F.sum("TOTAL_DISCOUNT").cast("decimal(28,4)").alias("TOTAL_DISCOUNTS"),
    ).withColumn("REFRESHED_AT", dates.at(as_of))


def dp_customer_360(hub: DataFrame, details: DataFrame, demographics: DataFrame, stats: DataFrame, as_of: str) -> DataFrame:
    det = current(details, "HK_CUSTOMER").select("HK_CUSTOMER", "FIRST_NAME", "LAST_NAME", "EMAIL", "PHONE",
                                                 "COUNTRY_CODE", "CITY", "STATE")
    dem = current(demographics, "HK_CUSTOMER").select("HK_CUSTOMER", "CUSTOMER_SEGMENT", "LOYALTY_TIER")
    base = hub.select("HK_CUSTOMER", "CUSTOMER_ID", F.col("LOAD_DATETIME").alias("FIRST_SEEN_DATE"))
    joined = base.join(det, "HK_CUSTOMER", "left").join(dem, "HK_CUSTOMER", "left").join(stats, "HK_CUSTOMER", "left")
    return joined.select(
        "CUSTOMER_ID", "FIRST_NAME", "LAST_NAME", "EMAIL", "PHONE", "COUNTRY_CODE", "CITY", "STATE",
        "CUSTOMER_SEGMENT", "LOYALTY_TIER",
        F.coalesce("ORDER_COUNT", F.lit(0)).alias("LIFETIME_ORDERS"),
        F.coalesce(F.col("TOTAL_REVENUE"), F.lit(0)).cast("decimal(28,4)").alias("LIFETIME_REVENUE"),
        F.coalesce(_average("TOTAL_REVENUE", "PRICED_ORDERS"), F.lit(0.0)).alias("AVG_ORDER_VALUE"),
        "FIRST_ORDER_DATE", "LAST_ORDER_DATE", "FIRST_SEEN_DATE", dates.at(as_of).alias("SNAPSHOT_AT"),
    )


def product_sales(link: DataFrame, raw_items: DataFrame) -> DataFrame:
    """Units and delivered line totals per product. A line total that was never delivered counts nothing."""
    sold = raw_items.select("ORDER_ITEM_ID", "QUANTITY", "LINE_TOTAL")
    return link.select("ORDER_ITEM_ID", "HK_PRODUCT").join(sold, "ORDER_ITEM_ID", "left").groupBy("HK_PRODUCT").agg(
        F.sum("QUANTITY").alias("UNITS_SOLD"), F.sum("LINE_TOTAL").alias("REVENUE")
    )


def dp_product_performance(products: DataFrame, sales: DataFrame, as_of: str) -> DataFrame:
    margin = (F.col("UNIT_PRICE") - F.col("COST_PRICE")) / F.nullif(F.col("UNIT_PRICE"), F.lit(0).cast("decimal(18,4)")) * 100
    return products.join(sales, "HK_PRODUCT", "left").select(
        "PRODUCT_ID", "PRODUCT_NAME", "CATEGORY", "SUBCATEGORY", "BRAND", F.col("UNIT_PRICE").alias("CURRENT_PRICE"),
        "COST_PRICE", F.round(margin, 4).cast("decimal(18,4)").alias("MARGIN_PERCENT"),
        F.coalesce(F.col("UNITS_SOLD"), F.lit(0)).cast("decimal(20,0)").alias("LIFETIME_UNITS_SOLD"),
        F.coalesce(F.col("REVENUE"), F.lit(0)).cast("decimal(28,4)").alias("LIFETIME_REVENUE"),
        "IS_ACTIVE", dates.at(as_of).alias("SNAPSHOT_AT"),
    )


def feature_store_customer(hub: DataFrame, demographics: DataFrame, stats: DataFrame, as_of: str) -> DataFrame:
    now = dates.at(as_of)
    dem = current(demographics, "HK_CUSTOMER").select("HK_CUSTOMER", "CUSTOMER_SEGMENT", "LOYALTY_TIER")
    base = hub.select("HK_CUSTOMER", "CUSTOMER_ID", "LOAD_DATETIME")
    joined = base.join(dem, "HK_CUSTOMER", "left").join(stats, "HK_CUSTOMER", "left")
    orders = F.coalesce("ORDER_COUNT", F.lit(0))
    average = F.coalesce(_average("TOTAL_REVENUE", "PRICED_ORDERS"), F.lit(0.0))
    known_for = dates.days_between(F.col("LOAD_DATETIME"), now)
    return joined.select(
        "CUSTOMER_ID", "HK_CUSTOMER", "CUSTOMER_SEGMENT", "LOYALTY_TIER",
        orders.alias("FEATURE_ORDER_COUNT"),
        F.coalesce(F.col("TOTAL_REVENUE"), F.lit(0)).cast("decimal(28,4)").alias("FEATURE_TOTAL_REVENUE"),
        average.alias("FEATURE_AVG_ORDER_VALUE"),
        F.coalesce(F.col("TOTAL_DISCOUNT"), F.lit(0)).cast("decimal(28,4)").alias("FEATURE_TOTAL_DISCOUNT"),
        known_for.alias("FEATURE_DAYS_SINCE_REGISTRATION"),
        F.coalesce(dates.days_between(F.col("LAST_ORDER_DATE"), now), F.lit(config.FEATURE_NEVER_ORDERED_DAYS)).alias("FEATURE_DAYS_SINCE_LAST_ORDER"),
        predict_clv(orders, average, known_for, F.col("LOYALTY_TIER")).alias("FEATURE_PREDICTED_CLV"),
        now.alias("FEATURE_COMPUTED_AT"),
    )


def product_search_corpus(products: DataFrame) -> DataFrame:
    text = F.concat("PRODUCT_NAME", *[
        part for c in ("CATEGORY", "SUBCATEGORY", "BRAND") for part in (F.lit(" "), F.coalesce(c, F.lit("")))
    ])
    return products.select("PRODUCT_ID", "PRODUCT_NAME", "CATEGORY", "SUBCATEGORY", "BRAND",
                           text.alias("PRODUCT_DESCRIPTION"), "UNIT_PRICE", "COST_PRICE")


def customer_profile_text(hub: DataFrame, details: DataFrame, demographics: DataFrame, stats: DataFrame) -> DataFrame:
    """The two prompts an external text model would receive for each customer."""
    det = current(details, "HK_CUSTOMER").select("HK_CUSTOMER", "FIRST_NAME", "LAST_NAME", "EMAIL")
    dem = current(demographics, "HK_CUSTOMER").select("HK_CUSTOMER", "CUSTOMER_SEGMENT", "LOYALTY_TIER")
    joined = (
        hub.select("HK_CUSTOMER", "CUSTOMER_ID").join(det, "HK_CUSTOMER", "left").join(dem, "HK_CUSTOMER", "left")
        .join(stats.select("HK_CUSTOMER", "ORDER_COUNT", "TOTAL_REVENUE"), "HK_CUSTOMER", "left")
    )
    segment = F.coalesce("CUSTOMER_SEGMENT", F.lit("UNKNOWN"))
    tier = F.coalesce("LOYALTY_TIER", F.lit("NONE"))
    orders = F.coalesce(F.col("ORDER_COUNT").cast("string"), F.lit("0"))
    classify = F.concat(
        F.lit("Classify this customer profile into one of: HIGH_VALUE, GROWTH, AT_RISK, CHURNED. Segment: "), segment,
        F.lit(", Loyalty: "), tier, F.lit(", Orders: "), orders,
    )
    summary = F.concat(
        F.lit("Customer "), "FIRST_NAME", F.lit(" "), "LAST_NAME", F.lit(" is in segment "), segment,
        F.lit(" with loyalty tier "), tier, F.lit(" and has placed "), orders, F.lit(" orders."),
    )
    return joined.select("CUSTOMER_ID", "FIRST_NAME", "LAST_NAME", "EMAIL", classify.alias("CLASSIFY_TEXT"),
                         summary.alias("SUMMARY_TEXT"), "ORDER_COUNT", "TOTAL_REVENUE", "CUSTOMER_SEGMENT", "LOYALTY_TIER")
