"""Business vault rules and conformed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import scoring
from ..functions.dates import at, days_between, hours_between
from ..functions.keys import has_key, hash_diff, hash_key, packed
from ..operators.history import latest_per_key, newest_kept
from ..operators.ranking import global_ranks, ntile_of
from . import staging

MONEY_AVG = "decimal(22,8)"


def current(satellite: DataFrame, key: str) -> DataFrame:
    """Newest version per key, without the columns no consumer reads."""
    return latest_per_key(satellite.drop("HASH_DIFF", "RECORD_SOURCE"), key, ["LOAD_DATETIME"])


def order_states(details: DataFrame) -> DataFrame:
    """Newest details per order plus the number of recorded states, in one aggregate."""
    payload = [c for c in details.columns if c not in ("HK_ORDER", "HASH_DIFF", "RECORD_SOURCE")]
    return details.groupBy("HK_ORDER").agg(
        F.max_by(F.struct(*payload), "LOAD_DATETIME").alias("_row"),
        F.count("*").alias("TOTAL_STATUS_CHANGES"),
    ).select("HK_ORDER", "_row.*", "TOTAL_STATUS_CHANGES")


def net_amount() -> Column:
    return (F.col("TOTAL_AMOUNT") - F.col("DISCOUNT_AMOUNT") + F.col("TAX_AMOUNT")).cast("decimal(20,4)")


def with_lifecycle(orders: DataFrame, as_of: str) -> DataFrame:
    """Lifecycle columns of joined order rows; all NULL where an order has no details."""
    now = at(as_of)
    has_details = F.col("TOTAL_STATUS_CHANGES").isNotNull()
    taken = hours_between(F.col("ORDER_DATE"), F.coalesce(F.col("FULFILLMENT_DATE"), now))
    status = F.col("ORDER_STATUS")

    def only(col: Column) -> Column:
        return F.when(has_details, col)

    return orders.withColumns({
        "NET_AMOUNT": only(net_amount()),
        "HOURS_TO_FULFILLMENT": only(hours_between(F.col("ORDER_DATE"), F.col("FULFILLMENT_DATE"))),
        "DAYS_SINCE_ORDER": only(days_between(F.col("ORDER_DATE"), now)),
        "SLA_MET": only(scoring.sla_met(status, F.col("SHIPPING_METHOD"), taken)),
        "LIFECYCLE_STAGE": only(scoring.lifecycle_stage(status)),
        "IS_TERMINAL": only(status.isin(*config.TERMINAL_STATUSES)),
    })


def joined_orders(hub_order: DataFrame, order_details: DataFrame, order_financials: DataFrame, as_of: str) -> DataFrame:
    """Hub, newest details and newest financials of each order: joins on one key, one exchange per input."""
    details = order_states(order_details).withColumnRenamed("LOAD_DATETIME", "DETAILS_LAST_UPDATED")
    money = current(order_financials, "HK_ORDER").withColumnRenamed("LOAD_DATETIME", "FINANCIALS_LAST_UPDATED")
    hub = hub_order.select("HK_ORDER", "ORDER_ID", F.col("LOAD_DATETIME").alias("FIRST_LOADED_AT"))
    return with_lifecycle(hub.join(details, "HK_ORDER", "left").join(money, "HK_ORDER", "left"), as_of)


def bv_order_lifecycle(orders: DataFrame, as_of: str) -> DataFrame:
    return orders.where("TOTAL_STATUS_CHANGES is not null").select(
        "HK_ORDER", "ORDER_ID", "ORDER_DATE", F.col("ORDER_STATUS").alias("CURRENT_STATUS"), "FULFILLMENT_DATE",
        "SHIPPING_METHOD", "TOTAL_AMOUNT", "CURRENCY_CODE", "PAYMENT_METHOD", "DISCOUNT_AMOUNT", "TAX_AMOUNT",
        "NET_AMOUNT", "TOTAL_STATUS_CHANGES", "HOURS_TO_FULFILLMENT", "DAYS_SINCE_ORDER", "SLA_MET",
        "LIFECYCLE_STAGE", "IS_TERMINAL", at(as_of).alias("COMPUTED_AT"),
    )


def conformed_orders(orders: DataFrame, link_customer_order: DataFrame, as_of: str) -> DataFrame:
    owner = link_customer_order.select("HK_ORDER", "HK_CUSTOMER")
    return orders.join(owner, "HK_ORDER", "left").select(
        "HK_ORDER", "ORDER_ID", "FIRST_LOADED_AT", "HK_CUSTOMER",
        "ORDER_DATE", "ORDER_STATUS", "SHIPPING_METHOD", "SHIPPING_ADDRESS", "BILLING_ADDRESS", "FULFILLMENT_DATE",
        "TOTAL_AMOUNT", "CURRENCY_CODE", "PAYMENT_METHOD", "DISCOUNT_AMOUNT", "TAX_AMOUNT",
        "NET_AMOUNT", "LIFECYCLE_STAGE", "IS_TERMINAL", "SLA_MET", "HOURS_TO_FULFILLMENT", "DAYS_SINCE_ORDER",
        "TOTAL_STATUS_CHANGES", "DETAILS_LAST_UPDATED", "FINANCIALS_LAST_UPDATED", at(as_of).alias("CONFORMED_AT"),
    )


def item_orders(hub_order: DataFrame, order_details: DataFrame, order_financials: DataFrame, link_customer_order: DataFrame) -> DataFrame:
    """Of conformed orders, the columns that line items take: the same rows, of which only these columns and the bytes of the key are exchanged."""
    key = packed(F.col("HK_ORDER")).alias("HK_ORDER")
    state = current(order_details.select(key, "ORDER_DATE", "LOAD_DATETIME"), "HK_ORDER").drop("LOAD_DATETIME")
    money = current(order_financials.select(key, "CURRENCY_CODE", "LOAD_DATETIME"), "HK_ORDER").drop("LOAD_DATETIME")
    joined = hub_order.select(key, "ORDER_ID").join(state, "HK_ORDER", "left").join(money, "HK_ORDER", "left")
    return joined.join(link_customer_order.select(key), "HK_ORDER", "left").select("ORDER_ID", "ORDER_DATE", "CURRENCY_CODE")


def order_history(link_customer_order: DataFrame, order_details: DataFrame, order_financials: DataFrame,
                  as_of: str) -> DataFrame:
    """Counted orders per customer. The newest version of an order decides whether it counts."""
    state = current(order_details.select("HK_ORDER", "ORDER_DATE", "ORDER_STATUS", "LOAD_DATETIME"), "HK_ORDER")
    money = current(order_financials.select("HK_ORDER", "TOTAL_AMOUNT", "LOAD_DATETIME"), "HK_ORDER")
    counted = (
        link_customer_order.select("HK_ORDER", "HK_CUSTOMER")
        .join(state.where(~F.col("ORDER_STATUS").isin(*config.UNCOUNTED_STATUSES)).drop("LOAD_DATETIME"), "HK_ORDER")
        .join(money.drop("LOAD_DATETIME"), "HK_ORDER")
    )
    # A link holds each (customer, order) once and each order has one newest state: rows = distinct orders.
    return _per_customer(counted, "HK_CUSTOMER", as_of)


def _per_customer(counted: DataFrame, key: str, as_of: str, *more: Column) -> DataFrame:
    return counted.groupBy(key).agg(
        F.count("*").alias("TOTAL_ORDERS"),
        F.max("ORDER_DATE").alias("LAST_ORDER_DATE"),
        F.min("ORDER_DATE").alias("FIRST_ORDER_DATE"),
        F.sum("TOTAL_AMOUNT").alias("TOTAL_REVENUE"),
        F.avg("TOTAL_AMOUNT").cast(MONEY_AVG).alias("AVG_ORDER_VALUE"),
        *more,
    ).withColumn("DAYS_SINCE_LAST_ORDER", days_between(F.col("LAST_ORDER_DATE"), at(as_of)))


def first_order_history(staged_orders: DataFrame, as_of: str) -> DataFrame:
    """``order_history`` of a first load, from staged rows: an order's versions move once, by business key and without digests.

    Both satellites hold every order that has a key, so an order has a newest version of each. ``TOTAL_SPEND`` is the sum of net amounts.
    """
    keyed = staged_orders.where(has_key("ORDER_ID"))
    versions = keyed.select("ORDER_ID", "ORDER_DATE", *staging.ORDER_DETAILS_HASHED, *staging.ORDER_FINANCIALS, "LOAD_DATETIME")
    newest = newest_kept(versions, "ORDER_ID", "LOAD_DATETIME", {
        "details": (lambda rows: hash_diff(rows, *staging.ORDER_DETAILS_HASHED), ["ORDER_DATE", "ORDER_STATUS"]),
        "money": (lambda rows: hash_diff(rows, *staging.ORDER_FINANCIALS), ["TOTAL_AMOUNT", "DISCOUNT_AMOUNT", "TAX_AMOUNT"]),
    }).select("ORDER_ID", "details.*", "money.*").where(~F.col("ORDER_STATUS").isin(*config.UNCOUNTED_STATUSES)).withColumn("NET_AMOUNT", net_amount())
    owners = staged_orders.where(has_key("CUSTOMER_ID", "ORDER_ID")).select("CUSTOMER_ID", "ORDER_ID").distinct()
    summed = _per_customer(owners.join(newest, "ORDER_ID"), "CUSTOMER_ID", as_of, F.sum("NET_AMOUNT").alias("TOTAL_SPEND"))
    return summed.withColumn("HK_CUSTOMER", hash_key(summed, "CUSTOMER_ID")).drop("CUSTOMER_ID")


def rfm_scores(history: DataFrame) -> DataFrame:
    """Quintiles of recency, frequency and revenue over all customers; ties go by customer key."""
    ranks, rows = global_ranks(history, "HK_CUSTOMER", {
        "RECENCY": -F.col("DAYS_SINCE_LAST_ORDER"),
        "FREQUENCY": F.col("TOTAL_ORDERS"),
        "MONETARY": F.col("TOTAL_REVENUE"),
    })
    return ranks.select("HK_CUSTOMER", *[
        ntile_of(F.col(f"{m}_POSITION"), rows, 5).alias(f"{m}_SCORE") for m in ("RECENCY", "FREQUENCY", "MONETARY")
    ])


def bv_customer_classification(hub_customer: DataFrame, details: DataFrame, demographics: DataFrame,
                               history: DataFrame, as_of: str) -> DataFrame:
    """``history`` is read by the ranking and by the join, so it should be stored."""
    who = current(details.select("HK_CUSTOMER", "FIRST_NAME", "LAST_NAME", "COUNTRY_CODE", "REGISTRATION_DATE",
                                 "LOAD_DATETIME"), "HK_CUSTOMER").drop("LOAD_DATETIME")
    what = current(demographics.select("HK_CUSTOMER", "CUSTOMER_SEGMENT", "LOYALTY_TIER", "LOAD_DATETIME"),
                   "HK_CUSTOMER").drop("LOAD_DATETIME")
    scored = history.join(rfm_scores(history), "HK_CUSTOMER")
    base = (
        hub_customer.select("HK_CUSTOMER", "CUSTOMER_ID")
        .join(who, "HK_CUSTOMER", "left").join(what, "HK_CUSTOMER", "left").join(scored, "HK_CUSTOMER", "left")
    )
    filled = base.withColumns({
        "TOTAL_ORDERS": F.coalesce("TOTAL_ORDERS", F.lit(0)),
        "TOTAL_REVENUE": F.coalesce(F.col("TOTAL_REVENUE"), F.lit(0).cast("decimal(28,4)")),
        "AVG_ORDER_VALUE": F.coalesce(F.col("AVG_ORDER_VALUE"), F.lit(0).cast(MONEY_AVG)),
        "DAYS_SINCE_LAST_ORDER": F.coalesce("DAYS_SINCE_LAST_ORDER", F.lit(config.NEVER_ORDERED_DAYS)),
        **{f"{m}_SCORE": F.coalesce(f"{m}_SCORE", F.lit(1)) for m in ("RECENCY", "FREQUENCY", "MONETARY")},
    })
    r, f, m = F.col("RECENCY_SCORE"), F.col("FREQUENCY_SCORE"), F.col("MONETARY_SCORE")
    return filled.select(
        "HK_CUSTOMER", "CUSTOMER_ID", "FIRST_NAME", "LAST_NAME", "COUNTRY_CODE", "REGISTRATION_DATE",
        "CUSTOMER_SEGMENT", "LOYALTY_TIER", "TOTAL_ORDERS", "LAST_ORDER_DATE", "FIRST_ORDER_DATE", "TOTAL_REVENUE",
        "AVG_ORDER_VALUE", "DAYS_SINCE_LAST_ORDER", "RECENCY_SCORE", "FREQUENCY_SCORE", "MONETARY_SCORE",
        (r + f + m).alias("RFM_TOTAL_SCORE"),
        scoring.ltv_tier(F.col("TOTAL_REVENUE")).alias("LTV_TIER"),
        scoring.churn_risk(F.col("DAYS_SINCE_LAST_ORDER")).alias("CHURN_RISK"),
        scoring.rfm_segment(r, f, m).alias("RFM_SEGMENT"),
        at(as_of).alias("CLASSIFIED_AT"),
    )


def conformed_customers(hub_customer: DataFrame, details: DataFrame, demographics: DataFrame,
                        classification: DataFrame, as_of: str) -> DataFrame:
    hub = hub_customer.select("HK_CUSTOMER", "CUSTOMER_ID", F.col("LOAD_DATETIME").alias("FIRST_LOADED_AT"))
    det = current(details, "HK_CUSTOMER").withColumnRenamed("LOAD_DATETIME", "DETAILS_LAST_UPDATED")
    dem = current(demographics, "HK_CUSTOMER").withColumnRenamed("LOAD_DATETIME", "DEMOGRAPHICS_LAST_UPDATED")
    cls = classification.select(
        "HK_CUSTOMER", "TOTAL_ORDERS", "TOTAL_REVENUE", "AVG_ORDER_VALUE", "LAST_ORDER_DATE", "DAYS_SINCE_LAST_ORDER",
        "RECENCY_SCORE", "FREQUENCY_SCORE", "MONETARY_SCORE", "RFM_TOTAL_SCORE", "RFM_SEGMENT", "LTV_TIER",
        "CHURN_RISK", "CLASSIFIED_AT",
    )
    return (
        hub.join(det, "HK_CUSTOMER", "left").join(dem, "HK_CUSTOMER", "left").join(cls, "HK_CUSTOMER", "left")
        .withColumn("CONFORMED_AT", at(as_of))
    )
