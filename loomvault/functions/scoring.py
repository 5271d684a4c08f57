"""Business rules that turn measures into labels and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def bucket_at_least(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose lower bound the value reaches."""
    label = F.lit(otherwise)
    for bound, name in reversed(steps):
        label = F.when(value >= bound, name).otherwise(label)
    return label


def bucket_above(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose bound the value exceeds."""
    label = F.lit(otherwise)
    for bound, name in reversed(steps):
        label = F.when(value > bound, name).otherwise(label)
    return label


def bucket_at_most(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose upper bound holds the value."""
    label = F.lit(otherwise)
    for bound, name in reversed(steps):
        label = F.when(value <= bound, name).otherwise(label)
    return label


def ltv_tier(revenue: Column) -> Column:
    paying = F.when(revenue > 0, "BRONZE").otherwise("NEW")
    label = paying
    for bound, name in reversed(config.LTV_TIERS):
        label = F.when(revenue >= bound, name).otherwise(label)
    return label


def churn_risk(days_since_order: Column) -> Column:
    return bucket_above(days_since_order, config.CHURN_DAYS, "ACTIVE")


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    recent, lapsed = r >= 4, r <= 2
    return (
        F.when(recent & (f >= 4), "CHAMPION")
        .when(recent & (f >= 2), "LOYAL")
        .when((r >= 3) & (m >= 4), "BIG_SPENDER")
        .when(recent & (f == 1), "NEW_CUSTOMER")
        .when(lapsed & (f >= 3), "AT_RISK")
        .when(lapsed & (f <= 2), "LOST")
        .otherwise("REGULAR")
    )


def lifecycle_stage(status: Column) -> Column:
    label = F.lit("UNKNOWN")
    for code, stage in config.STAGE_BY_STATUS.items():
        label = F.when(status == code, stage).otherwise(label)
    return label


def sla_met(status: Column, shipping: Column, hours_taken: Column) -> Column:
    """TRUE in time, FALSE late or closed without delivery, NULL while still open."""
    in_time = F.lit(False)
    for method, hours in config.SLA_HOURS.items():
        in_time = in_time | ((shipping == method) & (hours_taken <= hours))
    return (
        F.when(status.isin("DELIVERED", "SHIPPED") & in_time, True)
        .when(status.isin("PENDING", "CONFIRMED"), F.lit(None).cast("boolean"))
        .otherwise(False)
    )


def predict_clv(orders: Column, avg_value: Column, days_known: Column, tier: Column) -> Column:
    """Twelve-month projection from the yearly purchase rate, weighted by loyalty tier."""
    factor = F.lit(1.0)
    for name, weight in config.CLV_TIER_FACTOR.items():
        factor = F.when(tier == name, weight).otherwise(factor)
    days = F.greatest(F.coalesce(days_known, F.lit(1)), F.lit(1)).cast("double")
    yearly = orders.cast("double") / (days / F.lit(365.0))
    value = F.round(yearly * F.coalesce(avg_value.cast("double"), F.lit(0.0)) * factor, 2)
    return F.when(F.coalesce(orders, F.lit(0)) == 0, F.lit(0.0)).otherwise(value)
