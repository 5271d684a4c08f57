"""Named metrics and dimensions over gold tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Metric:
    """SUM and COUNT_TRUE add up, AVERAGE and RATIO divide two sums.

    ``weight`` names the number of detail rows one base row stands for.
    """

    kind: str
    expression: Column
    description: str
    weight: Column | None = None

    def aggregate(self) -> Column:
        value, weight = self.expression, self.weight
        if self.kind == "SUM":
            return F.sum(value).cast("double")
        if self.kind == "COUNT":
            return F.count(F.lit(1))
        if self.kind == "COUNT_TRUE":
            return F.count_if(value)
        if self.kind == "AVERAGE":
            heavy = F.lit(1) if weight is None else weight
            total = F.sum(value * heavy).cast("double")  # decimals add up exactly, in any order
            return total / F.nullif(F.sum(F.when(value.isNotNull(), heavy)), F.lit(0))
        if self.kind == "AVERAGE_OF_SUMS":
            return F.sum(value).cast("double") / F.nullif(F.sum(weight), F.lit(0))
        if self.kind == "RATIO":
            return F.count_if(value).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0))
        raise ValueError(f"unknown metric kind {self.kind}")


@dataclass(frozen=True)
class SemanticView:
    base: DataFrame
    metrics: Mapping[str, Metric]
    dimensions: Mapping[str, Column]
    time_dimensions: Sequence[str] = ()


def semantic_query(view: SemanticView, metrics: Sequence[str], dimensions: Sequence[str] = (),
                   filters: Column | None = None, grain: str | None = None) -> DataFrame:
    """Aggregate the asked metrics by the asked dimensions.

    The filter is placed under the aggregate, so it reaches the scan of the base table. ``grain``
    (day, month, quarter, year) truncates time dimensions.
    """
    unknown = [m for m in metrics if m not in view.metrics] + [d for d in dimensions if d not in view.dimensions]
    if unknown:
        raise KeyError(f"not part of the view: {unknown}")
    keys = []
    for name in dimensions:
        col = view.dimensions[name]
        if name in view.time_dimensions and grain:
            col = F.to_date(col) if grain == "day" else F.trunc(F.to_date(col), grain)
        keys.append(col.alias(name))
    rows = view.base if filters is None else view.base.where(filters)
    return rows.groupBy(*keys).agg(*[view.metrics[m].aggregate().alias(m) for m in metrics])


def customer_view(dim_customer: DataFrame) -> SemanticView:
    c = F.col
    return SemanticView(
        dim_customer,
        {
            "total_revenue": Metric("SUM", c("TOTAL_REVENUE"), "Lifetime revenue of counted orders"),
            "avg_order_value": Metric("AVERAGE", c("AVG_ORDER_VALUE"), "Average of customers' order values"),
            "total_orders": Metric("SUM", c("TOTAL_ORDERS"), "Counted orders"),
            "active_customers": Metric("COUNT_TRUE", c("IS_ACTIVE"), "Customers with a recent order"),
            "churn_rate": Metric("RATIO", c("CHURN_RISK") == "HIGH", "Share of customers at high churn risk"),
        },
        {
            "country": c("COUNTRY_CODE"), "segment": c("CUSTOMER_SEGMENT"), "loyalty_tier": c("LOYALTY_TIER"),
            "rfm_segment": c("RFM_SEGMENT"), "ltv_tier": c("LTV_TIER"),
        },
    )


def revenue_view(fct_orders: DataFrame) -> SemanticView:
    c = F.col
    return SemanticView(
        fct_orders,
        {
            "gross_revenue": Metric("SUM", c("TOTAL_AMOUNT"), "Order amounts before discounts"),
            "net_revenue": Metric("SUM", c("NET_AMOUNT"), "Amounts after discounts and tax"),
            "total_discounts": Metric("SUM", c("DISCOUNT_AMOUNT"), "Discounts given"),
            "avg_fulfillment_hours": Metric("AVERAGE", c("HOURS_TO_FULFILLMENT"), "Hours from order to fulfilment"),
            "sla_compliance_rate": Metric("RATIO", c("SLA_MET"), "Share of orders that met their service level"),
            "order_count": Metric("COUNT", F.lit(1), "Orders"),
        },
        {
            "order_date": c("ORDER_DATE"), "currency": c("CURRENCY_CODE"), "lifecycle_stage": c("LIFECYCLE_STAGE"),
            "payment_method": c("PAYMENT_METHOD"), "shipping_method": c("SHIPPING_METHOD"),
        },
        time_dimensions=("order_date",),
    )


def product_view(dim_product: DataFrame, fct_order_items: DataFrame) -> SemanticView:
    """Products with their items. Items are reduced to one row per product before the join, so a
    best-seller never reaches one join task as detail rows; LINES keeps the number of joined rows."""
    c = F.col
    price = F.col("LINE_TOTAL") / F.nullif(F.col("QUANTITY"), F.lit(0).cast("decimal(10,0)"))
    sold = fct_order_items.groupBy("PRODUCT_SK").agg(
        F.sum("QUANTITY").alias("QUANTITY"), F.sum("LINE_TOTAL").alias("LINE_TOTAL"),
        F.count("*").alias("ITEM_ROWS"),
        F.sum(price.cast("decimal(25,7)")).alias("PRICE_SUM"), F.count(price).alias("PRICE_ROWS"),
    )
    base = dim_product.join(sold, "PRODUCT_SK", "left").withColumn("LINES", F.coalesce("ITEM_ROWS", F.lit(1)))
    return SemanticView(
        base,
        {
            "units_sold": Metric("SUM", c("QUANTITY"), "Units sold"),
            "product_revenue": Metric("SUM", c("LINE_TOTAL"), "Line totals"),
            "margin_percent": Metric("AVERAGE", c("MARGIN_PERCENT"), "Margin on cost over sold lines", c("LINES")),
            "avg_selling_price": Metric("AVERAGE_OF_SUMS", c("PRICE_SUM"), "Price per unit after discounts", c("PRICE_ROWS")),
        },
        {"category": c("CATEGORY"), "subcategory": c("SUBCATEGORY"), "brand": c("BRAND"), "is_active": c("IS_ACTIVE")},
    )
