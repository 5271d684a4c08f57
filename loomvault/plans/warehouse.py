"""One run of the whole warehouse: lazily built frames, or tables written layer by layer."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, stored
from ..sources import testbed
from . import gold, silver, staging, vault


@dataclass(frozen=True)
class Landing:
    customers: DataFrame
    orders: DataFrame
    products: DataFrame
    order_items: DataFrame


class Warehouse:
    """Frames by name. Without a store every frame stays lazy, so a query reads only what it needs.

    With ``keep`` (name, frame -> frame) each shared frame passes through storage, which cuts the
    lineage between layers: see ``loomvault.sources.tables.TableFolder``.
    """

    def __init__(self, spark: SparkSession, landing: Landing, as_of: str,
                 calendar: tuple[str, str] = ("2020-01-01", "2030-12-31"),
                 keep: Callable[[str, DataFrame], DataFrame] | None = None):
        self.spark, self.landing, self.as_of, self.calendar = spark, landing, as_of, calendar
        self._stored = keep is not None
        self._keep = keep or (lambda name, frame: frame)

    @classmethod
    def from_test_tables(cls, spark: SparkSession, folder: str, **options) -> Warehouse:
        landing = Landing(
            testbed.raw_customers(spark, folder), testbed.raw_orders(spark, folder),
            testbed.raw_products(spark, folder), testbed.raw_order_items(spark, folder),
        )
        return cls(spark, landing, testbed.AS_OF_ORDERS, ("1995-01-01", "2002-01-01"), **options)

    # ---- staging: projections, never stored ------------------------------------------
    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stage_customers(self.landing.customers, self.as_of)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stage_orders(self.landing.orders, self.as_of)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stage_products(self.landing.products, self.as_of)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stage_order_items(self.landing.order_items, self.as_of)

    # ---- raw vault ---------------------------------------------------------------------
    @cached_property
    def hub_customer(self) -> DataFrame:
        return self._keep("hub_customer", load_hub_customer(self.stg_customers, late=staging.CUSTOMERS))

    @cached_property
    def hub_order(self) -> DataFrame:
        return self._keep("hub_order", load_hub_order(self.stg_orders, late=staging.ORDERS))

    @cached_property
    def hub_product(self) -> DataFrame:
        return self._keep("hub_product", load_hub_product(self.stg_products, late=staging.PRODUCTS))

    @cached_property
    def link_customer_order(self) -> DataFrame:
        return self._keep("link_customer_order", load_link_customer_order(self.stg_orders, late=staging.ORDERS))

    @cached_property
    def link_order_product(self) -> DataFrame:
        return self._keep("link_order_product", load_link_order_product(self.stg_order_items, late=staging.ORDER_ITEMS))

    @cached_property
    def sat_customer_details(self) -> DataFrame:
        return self._keep("sat_customer_details", load_sat_customer_details(self.stg_customers, hashed=staging.CUSTOMER_DETAILS))

    @cached_property
    def sat_customer_demographics(self) -> DataFrame:
        return self._keep("sat_customer_demographics", load_sat_customer_demographics(self.stg_customers, hashed=staging.CUSTOMER_DEMOGRAPHICS))

    @cached_property
    def sat_order_details(self) -> DataFrame:
        return self._keep("sat_order_details", load_sat_order_details(self.stg_orders, hashed=staging.ORDER_DETAILS_HASHED))

    @cached_property
    def sat_order_financials(self) -> DataFrame:
        return self._keep("sat_order_financials", load_sat_order_financials(self.stg_orders, hashed=staging.ORDER_FINANCIALS))

    @cached_property
    def sat_product_details(self) -> DataFrame:
        return self._keep("sat_product_details", load_sat_product_details(self.stg_products, hashed=staging.PRODUCT_DETAILS_HASHED))

    @cached_property
    def sat_product_pricing(self) -> DataFrame:
        return self._keep("sat_product_pricing", load_sat_product_pricing(self.stg_products, hashed=staging.PRODUCT_PRICING))

    @cached_property
    def eff_sat_customer_order(self) -> DataFrame:
        return self._keep("eff_sat_customer_order", load_eff_sat_customer_order(self.stg_orders))

    # ---- silver ------------------------------------------------------------------------
    @cached_property
    def pit_customer(self) -> DataFrame:
        return self._keep("pit_customer", vault.load_pit(self.hub_customer, "HK_CUSTOMER", {
            "SAT_CUSTOMER_DETAILS": self.sat_customer_details,
            "SAT_CUSTOMER_DEMOGRAPHICS": self.sat_customer_demographics,
        }, cuts=vault.cuts_of(self.stg_customers, "HK_CUSTOMER", "CUSTOMER_ID")))

    @cached_property
    def pit_order(self) -> DataFrame:
        return self._keep("pit_order", vault.load_pit(self.hub_order, "HK_ORDER", {
            "SAT_ORDER_DETAILS": self.sat_order_details, "SAT_ORDER_FINANCIALS": self.sat_order_financials,
        }, with_hash_diff=False, cuts=vault.cuts_of(self.stg_orders, "HK_ORDER", "ORDER_ID")))

    @cached_property
    def pit_customer_current(self) -> DataFrame:
        return vault.pit_current(self.hub_customer, "HK_CUSTOMER", "CUSTOMER_ID", {
            "DETAILS": self.sat_customer_details, "DEMOGRAPHICS": self.sat_customer_demographics,
        })

    @cached_property
    def bridge_customer_order(self) -> DataFrame:
        bridge = vault.load_bridge(
            self.link_customer_order, "HK_LINK_CUSTOMER_ORDER", ["HK_CUSTOMER", "HK_ORDER"],
            self.eff_sat_customer_order, extra=["ORDER_STATUS"], digests=LINK_DIGESTS,
        )
        return self._keep("bridge_customer_order", bridge.withColumnRenamed("ORDER_STATUS", "EFF_ORDER_STATUS"))

    @cached_property
    def hub_bridge(self) -> DataFrame:
        return vault.hub_bridge(self.hub_customer, self.link_customer_order, self.hub_order, "HK_CUSTOMER", "HK_ORDER",
                                "CUSTOMER_ID", "ORDER_ID", "HK_LINK_CUSTOMER_ORDER")

    @cached_property
    def joined_orders(self) -> DataFrame:
        return silver.joined_orders(self.hub_order, self.sat_order_details, self.sat_order_financials, self.as_of)

    @cached_property
    def bv_order_lifecycle(self) -> DataFrame:
        return self._keep("bv_order_lifecycle", silver.bv_order_lifecycle(self.joined_orders, self.as_of))

    @cached_property
    def conformed_orders(self) -> DataFrame:
        return self._keep("conformed_orders", silver.conformed_orders(self.joined_orders, self.link_customer_order, self.as_of))

    @cached_property
    def item_orders(self) -> DataFrame:
        # Three columns an order: what the vault joins exchange for them is gone before the items move.
        if self._stored:
            return self.conformed_orders
        return stored(silver.item_orders(self.hub_order, self.sat_order_details, self.sat_order_financials, self.link_customer_order), "item-orders")

    @cached_property
    def order_history(self) -> DataFrame:
        # One row per customer, read by the ranking, by joins and by lifetime values: the order joins below it run once.
        if self._stored:
            return cut_lineage(silver.order_history(self.link_customer_order, self.sat_order_details, self.sat_order_financials, self.as_of))
        return cut_lineage(silver.first_order_history(self.stg_orders, self.as_of))

    @cached_property
    def bv_customer_classification(self) -> DataFrame:
        return self._keep("bv_customer_classification", silver.bv_customer_classification(
            self.hub_customer, self.sat_customer_details, self.sat_customer_demographics, self.order_history, self.as_of))

    @cached_property
    def conformed_customers(self) -> DataFrame:
        return self._keep("conformed_customers", silver.conformed_customers(
            self.hub_customer, self.sat_customer_details, self.sat_customer_demographics,
            self.bv_customer_classification, self.as_of))

    # ---- gold --------------------------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.spark, *self.calendar, self.as_of)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._keep("dim_customer", gold.dim_customer(self.conformed_customers))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._keep("dim_product", gold.dim_product(self.hub_product, self.sat_product_details, self.sat_product_pricing))

    @cached_property
    def fct_orders(self) -> DataFrame:
        return self._keep("fct_orders", gold.fct_orders(self.conformed_orders))

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return self._keep("fct_order_items", gold.fct_order_items(self.stg_order_items, self.item_orders))

    @cached_property
    def agg_monthly_revenue(self) -> DataFrame:
        return self._keep("agg_monthly_revenue", gold.agg_monthly_revenue(self.fct_orders, self.dim_date, self.as_of))

    @cached_property
    def customer_spend(self) -> DataFrame:
        """What ``customer_spend`` makes of the facts; without a store the order history has it already."""
        if self._stored:
            return gold.customer_spend(self.fct_orders)
        return self.order_history.select("HK_CUSTOMER", F.col("TOTAL_ORDERS").alias("ORDER_COUNT"), "TOTAL_SPEND", "FIRST_ORDER_DATE", "LAST_ORDER_DATE")

    @cached_property
    def agg_customer_ltv(self) -> DataFrame:
        return self._keep("agg_customer_ltv", gold.agg_customer_ltv(self.dim_customer, self.customer_spend, self.as_of))

    @cached_property
    def agg_revenue_by_segment(self) -> DataFrame:
        return gold.agg_revenue_by_segment(self.pit_customer_current, self.sat_customer_demographics,
                                           self.link_customer_order, self.sat_order_financials, self.as_of)

    @cached_property
    def customer_order_stats(self) -> DataFrame:
        return gold.customer_order_stats(self.link_customer_order, self.sat_order_financials)

    @cached_property
    def dp_customer_360(self) -> DataFrame:
        return gold.dp_customer_360(self.hub_customer, self.sat_customer_details, self.sat_customer_demographics,
                                    self.customer_order_stats, self.as_of)

    @cached_property
    def dp_product_performance(self) -> DataFrame:
        sales = gold.product_sales(self.link_order_product, self.landing.order_items)
        return gold.dp_product_performance(self.dim_product, sales, self.as_of)

    @cached_property
    def feature_store_customer(self) -> DataFrame:
        return gold.feature_store_customer(self.hub_customer, self.sat_customer_demographics,
                                           self.customer_order_stats, self.as_of)

    @cached_property
    def product_search_corpus(self) -> DataFrame:
        return gold.product_search_corpus(self.dim_product)

    @cached_property
    def customer_profile_text(self) -> DataFrame:
        return gold.customer_profile_text(self.hub_customer, self.sat_customer_details,
                                          self.sat_customer_demographics, self.customer_order_stats)


LINK_DIGESTS = ("HK_LINK_CUSTOMER_ORDER", "HK_CUSTOMER", "HK_ORDER")


def load_hub_customer(staged, target=None, **options):
    return vault.load_hub(staged, "HK_CUSTOMER", "CUSTOMER_ID", target, **options)


def load_hub_order(staged, target=None, **options):
    return vault.load_hub(staged, "HK_ORDER", "ORDER_ID", target, **options)


def load_hub_product(staged, target=None, **options):
    return vault.load_hub(staged, "HK_PRODUCT", "PRODUCT_ID", target, **options)


def load_link_customer_order(staged, target=None, **options):
    return vault.load_link(staged, "HK_LINK_CUSTOMER_ORDER", ["HK_CUSTOMER", "HK_ORDER"], target,
                           business_keys=["CUSTOMER_ID", "ORDER_ID"], **options)


def load_link_order_product(staged, target=None, **options):
    return vault.load_link(staged, "HK_LINK_ORDER_PRODUCT", ["HK_ORDER", "HK_PRODUCT"], target,
                           business_keys=["ORDER_ID", "PRODUCT_ID"], child_keys=["ORDER_ITEM_ID"], **options)


def load_sat_customer_details(staged, target=None, **options):
    return vault.load_satellite(staged, "HK_CUSTOMER", "HD_CUSTOMER_DETAILS", staging.CUSTOMER_DETAILS, target,
                                business_key="CUSTOMER_ID", **options)


def load_sat_customer_demographics(staged, target=None, **options):
    return vault.load_satellite(staged, "HK_CUSTOMER", "HD_CUSTOMER_DEMOGRAPHICS", staging.CUSTOMER_DEMOGRAPHICS, target,
                                business_key="CUSTOMER_ID", **options)


def load_sat_order_details(staged, target=None, **options):
    return vault.load_satellite(staged, "HK_ORDER", "HD_ORDER_DETAILS", ("ORDER_DATE", *staging.ORDER_DETAILS_HASHED), target,
                                business_key="ORDER_ID", **options)


def load_sat_order_financials(staged, target=None, **options):
    return vault.load_satellite(staged, "HK_ORDER", "HD_ORDER_FINANCIALS", staging.ORDER_FINANCIALS, target,
                                business_key="ORDER_ID", **options)


def load_sat_product_details(staged, target=None, **options):
    return vault.load_satellite(staged, "HK_PRODUCT", "HD_PRODUCT_DETAILS",
                                (*staging.PRODUCT_DETAILS_HASHED, "CREATED_AT", "UPDATED_AT"), target,
                                business_key="PRODUCT_ID", **options)


def load_sat_product_pricing(staged, target=None, **options):
    return vault.load_satellite(staged, "HK_PRODUCT", "HD_PRODUCT_PRICING", staging.PRODUCT_PRICING, target,
                                business_key="PRODUCT_ID", **options)


def load_eff_sat_customer_order(staged, target=None, **options):
    return vault.load_eff_satellite(staged, "HK_LINK_CUSTOMER_ORDER", ["HK_CUSTOMER", "HK_ORDER"], "ORDER_STATUS",
                                    "ORDER_DATE", target, business_keys=["CUSTOMER_ID", "ORDER_ID"], digests=LINK_DIGESTS, **options)
