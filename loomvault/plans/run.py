"""One load of the stored warehouse: vault batches appended, checks, then silver and gold refreshed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.changes import change_feed, without_keys
from ..sources.tables import TableFolder
from ..streaming.known import BUCKET, load_known
from ..streaming.vault_stream import refresh_pit
from . import deltas, gold
from . import warehouse as w

VAULT_LOADS = {
    "hub_customer": (w.load_hub_customer, "stg_customers"),
    "hub_order": (w.load_hub_order, "stg_orders"),
    "hub_product": (w.load_hub_product, "stg_products"),
    "link_customer_order": (w.load_link_customer_order, "stg_orders"),
    "link_order_product": (w.load_link_order_product, "stg_order_items"),
    "sat_customer_details": (w.load_sat_customer_details, "stg_customers"),
    "sat_customer_demographics": (w.load_sat_customer_demographics, "stg_customers"),
    "sat_order_details": (w.load_sat_order_details, "stg_orders"),
    "sat_order_financials": (w.load_sat_order_financials, "stg_orders"),
    "sat_product_details": (w.load_sat_product_details, "stg_products"),
    "sat_product_pricing": (w.load_sat_product_pricing, "stg_products"),
    "eff_sat_customer_order": (w.load_eff_sat_customer_order, "stg_orders"),
}
# key of each vault table, and what tells a version from the one before
KEYED = {
    "hub_customer": ("HK_CUSTOMER", None), "hub_order": ("HK_ORDER", None), "hub_product": ("HK_PRODUCT", None),
    "link_customer_order": ("HK_LINK_CUSTOMER_ORDER", None), "link_order_product": ("HK_LINK_ORDER_PRODUCT", None),
    "sat_customer_details": ("HK_CUSTOMER", "HASH_DIFF"), "sat_customer_demographics": ("HK_CUSTOMER", "HASH_DIFF"),
    "sat_order_details": ("HK_ORDER", "HASH_DIFF"), "sat_order_financials": ("HK_ORDER", "HASH_DIFF"),
    "sat_product_details": ("HK_PRODUCT", "HASH_DIFF"), "sat_product_pricing": ("HK_PRODUCT", "HASH_DIFF"),
    "eff_sat_customer_order": ("HK_LINK_CUSTOMER_ORDER", "IS_ACTIVE"),
}
PENDING = "pending_order_items"
PITS = {
    "pit_customer": ("HK_CUSTOMER", "stg_customers", "hub_customer",
                     {"SAT_CUSTOMER_DETAILS": "sat_customer_details", "SAT_CUSTOMER_DEMOGRAPHICS": "sat_customer_demographics"}),
    "pit_order": ("HK_ORDER", "stg_orders", "hub_order",
                  {"SAT_ORDER_DETAILS": "sat_order_details", "SAT_ORDER_FINANCIALS": "sat_order_financials"}),
}
MONTH = "ORDER_MONTH"


class GateFailed(RuntimeError):
    """A layer's checks found offending rows; the next layer was not built."""


def gate(layer: str, offending: DataFrame) -> None:
    sample = offending.take(5)
    if sample:
        raise GateFailed(f"{layer}: {[r.asDict() for r in sample]}")


def run_batch(spark: SparkSession, landing: w.Landing, tables: TableFolder, as_of: str, batch: int,
              calendar: tuple[str, str], buckets: int = 64, late_orders: bool = False) -> w.Warehouse:
    """Load one landing batch. Running the same batch again gives the same tables.

    Vault tables only grow; of them a batch reads what is known of its own keys. Items whose order is not known yet are kept in a table
    of their own and met by the orders of every later batch; without ``late_orders`` such items fail the vault's check. PIT rows, the bridge and facts are rewritten for the partitions the
    batch touches, monthly revenue from the changes of orders; conformed tables, dimensions and lifetime values are rebuilt from stored tables.
    """
    fresh = w.Warehouse(spark, landing, as_of, calendar)
    for name, (load, staged) in VAULT_LOADS.items():
        load_known(getattr(fresh, staged), load, tables, name, batch, *KEYED[name], buckets)
    stored = {name: tables.read(name) for name in VAULT_LOADS}
    gate("vault", quality.vault_integrity([
        ("LINK_CUSTOMER_ORDER.HK_CUSTOMER", stored["link_customer_order"], "HK_CUSTOMER", stored["hub_customer"]),
        ("LINK_CUSTOMER_ORDER.HK_ORDER", stored["link_customer_order"], "HK_ORDER", stored["hub_order"]),
        *([] if late_orders else [("LINK_ORDER_PRODUCT.HK_ORDER", stored["link_order_product"], "HK_ORDER", stored["hub_order"])]),
        ("LINK_ORDER_PRODUCT.HK_PRODUCT", stored["link_order_product"], "HK_PRODUCT", stored["hub_product"]),
    ]))

    def shared(name: str, frame: DataFrame) -> DataFrame:
        return tables.keep(name, frame) if name.startswith(("conformed_", "bv_", "dim_", "agg_")) else frame

    built = w.Warehouse(spark, landing, as_of, calendar, keep=shared)
    vars(built).update(stored)

    for name, (key, staged, hub, satellites) in PITS.items():
        refresh_pit(tables, getattr(fresh, staged), key, hub, satellites, name, buckets, with_hash_diff=name == "pit_customer")
        vars(built)[name] = tables.read(name).drop(BUCKET)
    bridge = deltas.refresh_bridge(tables, fresh.stg_orders, "HK_LINK_CUSTOMER_ORDER", ["HK_CUSTOMER", "HK_ORDER"], stored["link_customer_order"],
                                   stored["eff_sat_customer_order"], "bridge_customer_order", batch, ["ORDER_STATUS"], buckets, w.LINK_DIGESTS)
    vars(built)["bridge_customer_order"] = bridge.drop(BUCKET).withColumnRenamed("ORDER_STATUS", "EFF_ORDER_STATUS")
    gate("silver", quality.pit_completeness(built.hub_customer, built.pit_customer, "HK_CUSTOMER"))

    touched_orders = fresh.stg_orders.select("HK_ORDER").distinct()
    tables.begin(PENDING, batch)
    waiting = tables.read(PENDING)
    items = fresh.stg_order_items if waiting is None else fresh.stg_order_items.unionByName(
        without_keys(waiting, fresh.stg_order_items, ["ORDER_ITEM_ID"]))
    tables.replace(PENDING, items.join(built.conformed_orders.select("HK_ORDER"), "HK_ORDER", "left_anti").select(*items.columns))
    tables.begin("fct_orders", batch)
    orders_before = tables.read("fct_orders")
    for name, key, rows in (
        ("fct_orders", "ORDER_SK", built.fct_orders.join(touched_orders, "HK_ORDER", "left_semi")),
        ("fct_order_items", "ORDER_ITEM_SK", gold.fct_order_items(items, built.conformed_orders)),
    ):
        monthly = rows.withColumn(MONTH, F.date_format("ORDER_DATE", "yyyy-MM"))
        kept = tables.upsert(name, monthly, [key], MONTH, sort_by=["ORDER_DATE_KEY"])
        if kept is not None:  # a partitioned table without rows has no files yet
            vars(built)[name] = kept.drop(MONTH)
    gate("gold", quality.duplicate_keys({"CUSTOMER_SK": built.dim_customer, "PRODUCT_SK": built.dim_product}))
    gate("gold", quality.fact_measures(built.fct_orders))
    now = built.fct_orders.join(touched_orders, "HK_ORDER", "left_semi")
    before = now.limit(0) if orders_before is None else orders_before.drop(MONTH).join(touched_orders, "HK_ORDER", "left_semi").select(*now.columns)
    revenue = deltas.refresh_revenue(tables, change_feed(before, now, ["ORDER_SK"]), built.dim_date, as_of, batch, buckets)
    vars(built)["agg_monthly_revenue"] = tables.keep("agg_monthly_revenue", revenue)
    built.agg_customer_ltv  # stored by ``shared``
    return built
