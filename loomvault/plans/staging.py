"""Cleansed landing rows with hash keys, hash diffs and load metadata. Projections only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import at
from ..functions.keys import hash_diff, hash_key
from ..functions.text import clean_lower, clean_upper, clean_words

MONEY = "decimal(18,4)"
CUSTOMERS, ORDERS, PRODUCTS, ORDER_ITEMS = (f"ECOMMERCE.RAW_{name}" for name in ("CUSTOMERS", "ORDERS", "PRODUCTS", "ORDER_ITEMS"))
CARRIED = ("_LOADED_AT", "_FILE_NAME", "_FILE_ROW_NUMBER")


def _or_zero(name: str, target: str = MONEY) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast(target)


def stage(raw: DataFrame, cleansed: Mapping[str, Column], keys: Mapping[str, Sequence[str]],
          diffs: Mapping[str, Sequence[str]], source: str, as_of: str) -> DataFrame:
    """One staged table: cleansed columns, then keys and diffs computed from the cleansed values."""
    clean = raw.select(*[col.alias(name) for name, col in cleansed.items()], *CARRIED)
    hashed = {name: hash_key(clean, *parts) for name, parts in keys.items()}
    hashed |= {name: hash_diff(clean, *parts) for name, parts in diffs.items()}
    return clean.withColumns(hashed | {
        "LOAD_DATETIME": F.col("_LOADED_AT"),
        "RECORD_SOURCE": F.lit(source),
        "APPLIED_DATE": F.to_date(at(as_of)),
    })


def _plain(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def _upper(*names: str) -> dict[str, Column]:
    return {n: clean_upper(n) for n in names}


def _trimmed(*names: str) -> dict[str, Column]:
    return {n: F.trim(F.col(n)) for n in names}


def _words(*names: str) -> dict[str, Column]:
    return {n: clean_words(n) for n in names}


CUSTOMER_DETAILS = ("FIRST_NAME", "LAST_NAME", "EMAIL", "PHONE", "COUNTRY_CODE", "CITY", "STATE", "POSTAL_CODE",
                    "REGISTRATION_DATE")
CUSTOMER_DEMOGRAPHICS = ("DATE_OF_BIRTH", "GENDER", "CUSTOMER_SEGMENT", "LOYALTY_TIER")
ORDER_DETAILS_HASHED = ("ORDER_STATUS", "SHIPPING_METHOD", "SHIPPING_ADDRESS", "BILLING_ADDRESS", "FULFILLMENT_DATE")
ORDER_FINANCIALS = ("TOTAL_AMOUNT", "CURRENCY_CODE", "PAYMENT_METHOD", "DISCOUNT_AMOUNT", "TAX_AMOUNT")
PRODUCT_DETAILS_HASHED = ("PRODUCT_NAME", "CATEGORY", "SUBCATEGORY", "BRAND", "WEIGHT_KG", "IS_ACTIVE")
PRODUCT_PRICING = ("UNIT_PRICE", "COST_PRICE")
ORDER_ITEM_MEASURES = ("QUANTITY", "UNIT_PRICE", "DISCOUNT_PERCENT", "LINE_TOTAL")


def stage_customers(raw: DataFrame, as_of: str) -> DataFrame:
    cleansed = (
        _upper("CUSTOMER_ID") | _words("FIRST_NAME", "LAST_NAME") | {"EMAIL": clean_lower("EMAIL")}
        | _trimmed("PHONE") | _upper("COUNTRY_CODE") | _words("CITY") | _upper("STATE") | _trimmed("POSTAL_CODE")
        | _plain("REGISTRATION_DATE", "DATE_OF_BIRTH") | _upper("GENDER", "CUSTOMER_SEGMENT", "LOYALTY_TIER")
    )
    return stage(
        raw, cleansed, {"HK_CUSTOMER": ["CUSTOMER_ID"]},
        {"HD_CUSTOMER_DETAILS": CUSTOMER_DETAILS, "HD_CUSTOMER_DEMOGRAPHICS": CUSTOMER_DEMOGRAPHICS},
        CUSTOMERS, as_of,
    )


def stage_orders(raw: DataFrame, as_of: str) -> DataFrame:
    cleansed = (
        _upper("ORDER_ID", "CUSTOMER_ID") | _plain("ORDER_DATE") | _upper("ORDER_STATUS", "SHIPPING_METHOD")
        | _trimmed("SHIPPING_ADDRESS", "BILLING_ADDRESS") | _plain("FULFILLMENT_DATE")
        | {"TOTAL_AMOUNT": _or_zero("TOTAL_AMOUNT")} | _upper("CURRENCY_CODE", "PAYMENT_METHOD")
        | {n: _or_zero(n) for n in ("DISCOUNT_AMOUNT", "TAX_AMOUNT")}
    )
    return stage(
        raw, cleansed,
        {"HK_ORDER": ["ORDER_ID"], "HK_CUSTOMER": ["CUSTOMER_ID"], "HK_LINK_CUSTOMER_ORDER": ["CUSTOMER_ID", "ORDER_ID"]},
        {"HD_ORDER_DETAILS": ORDER_DETAILS_HASHED, "HD_ORDER_FINANCIALS": ORDER_FINANCIALS},
        ORDERS, as_of,
    )


def stage_products(raw: DataFrame, as_of: str) -> DataFrame:
    cleansed = (
        _upper("PRODUCT_ID") | _trimmed("PRODUCT_NAME") | _upper("CATEGORY", "SUBCATEGORY", "BRAND")
        | {"WEIGHT_KG": _or_zero("WEIGHT_KG", "decimal(10,3)"), "IS_ACTIVE": F.coalesce("IS_ACTIVE", F.lit(True))}
        | _plain("CREATED_AT", "UPDATED_AT") | {n: _or_zero(n) for n in PRODUCT_PRICING}
    )
    return stage(
        raw, cleansed, {"HK_PRODUCT": ["PRODUCT_ID"]},
        {"HD_PRODUCT_DETAILS": PRODUCT_DETAILS_HASHED, "HD_PRODUCT_PRICING": PRODUCT_PRICING},
        PRODUCTS, as_of,
    )


def stage_order_items(raw: DataFrame, as_of: str) -> DataFrame:
    discount = F.coalesce(F.col("DISCOUNT_PERCENT"), F.lit(0)).cast("decimal(5,2)")
    computed = (F.col("QUANTITY") * F.col("UNIT_PRICE") * (F.lit(1) - discount / 100)).cast(MONEY)
    cleansed = _upper("ORDER_ITEM_ID", "ORDER_ID", "PRODUCT_ID") | _plain("QUANTITY", "UNIT_PRICE") | {
        "DISCOUNT_PERCENT": discount, "LINE_TOTAL": F.coalesce(F.col("LINE_TOTAL"), computed),
    }
    return stage(
        raw, cleansed,
        {"HK_ORDER": ["ORDER_ID"], "HK_PRODUCT": ["PRODUCT_ID"],
         "HK_LINK_ORDER_PRODUCT": ["ORDER_ID", "PRODUCT_ID", "ORDER_ITEM_ID"]},
        {"HD_ORDER_ITEM_DETAILS": ORDER_ITEM_MEASURES},
        ORDER_ITEMS, as_of,
    )
