"""Reference lists and their lookups."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: reference lists, in their natural order ---------------------------------
COUNTRY_CODES = """country_code,country_name,region,sub_region
US,United States,Americas,Northern America
GB,United Kingdom,Europe,Northern Europe
DE,Germany,Europe,Western Europe
FR,France,Europe,Western Europe
CA,Canada,Americas,Northern America
AU,Australia,Oceania,Australia and New Zealand
JP,Japan,Asia,Eastern Asia
IN,India,Asia,Southern Asia
BR,Brazil,Americas,South America
MX,Mexico,Americas,Central America
IT,Italy,Europe,Southern Europe
ES,Spain,Europe,Southern Europe
NL,Netherlands,Europe,Western Europe
SE,Sweden,Europe,Northern Europe
NO,Norway,Europe,Northern Europe
DK,Denmark,Europe,Northern Europe
FI,Finland,Europe,Northern Europe
IE,Ireland,Europe,Northern Europe
SG,Singapore,Asia,South-Eastern Asia
NZ,New Zealand,Oceania,Australia and New Zealand
"""
ORDER_STATUS_MAPPING = """order_status_code,order_status_name,status_category,is_terminal,display_order
PENDING,Pending,Open,false,1
CONFIRMED,Confirmed,Open,false,2
PROCESSING,Processing,Open,false,3
SHIPPED,Shipped,In Transit,false,4
DELIVERED,Delivered,Complete,true,5
CANCELLED,Cancelled,Closed,true,6
RETURNED,Returned,Closed,true,7
REFUNDED,Refunded,Closed,true,8
ON_HOLD,On Hold,Open,false,9
BACKORDERED,Backordered,Open,false,10
"""
PAYMENT_METHODS = """payment_method_code,payment_method_name,payment_type,is_digital
CREDIT_CARD,Credit Card,Card,true
DEBIT_CARD,Debit Card,Card,true
PAYPAL,PayPal,Digital Wallet,true
APPLE_PAY,Apple Pay,Digital Wallet,true
GOOGLE_PAY,Google Pay,Digital Wallet,true
BANK_TRANSFER,Bank Transfer,Bank,true
WIRE_TRANSFER,Wire Transfer,Bank,true
COD,Cash on Delivery,Cash,false
GIFT_CARD,Gift Card,Prepaid,true
CRYPTO,Cryptocurrency,Digital Currency,true
"""
PRODUCT_CATEGORIES = """category_id,category_name,parent_category,department
1,Electronics,,Technology
2,Smartphones,Electronics,Technology
3,Laptops,Electronics,Technology
4,Accessories,Electronics,Technology
5,Clothing,,Fashion
6,Men's Clothing,Clothing,Fashion
7,Women's Clothing,Clothing,Fashion
8,Footwear,Clothing,Fashion
9,Home & Garden,,Home
10,Furniture,Home & Garden,Home
11,Kitchen,Home & Garden,Home
12,Sports & Outdoors,,Sports
13,Fitness,Sports & Outdoors,Sports
14,Camping,Sports & Outdoors,Sports
15,Books & Media,,Entertainment
"""

SEEDS = {
    "country_codes": (COUNTRY_CODES, "country_code string, country_name string, region string, sub_region string", "country_code"),
    "order_status_mapping": (
        ORDER_STATUS_MAPPING,
        "order_status_code string, order_status_name string, status_category string, is_terminal boolean, display_order int",
        "order_status_code"),
    "payment_methods": (
        PAYMENT_METHODS, "payment_method_code string, payment_method_name string, payment_type string, is_digital boolean",
        "payment_method_code"),
    "product_categories": (
        PRODUCT_CATEGORIES, "category_id int, category_name string, parent_category string, department string", "category_id"),
}


def check_seed_key(seed: DataFrame, key: str) -> DataFrame:
    """Rows that break the key: NULL or repeated values."""
    return seed.groupBy(key).count().where(F.col(key).isNull() | (F.col("count") > 1))


def seed(spark: SparkSession, name: str) -> DataFrame:
    """A built-in reference list: a local relation of at most twenty rows."""
    text, schema, _ = SEEDS[name]
    header, *rows = csv.reader(io.StringIO(text))
    frame = spark.createDataFrame([[v or None for v in r] for r in rows], ", ".join(f"{h} string" for h in header))
    wanted = [part.split() for part in schema.split(", ")]
    return frame.select(*[F.col(column).cast(dtype) for column, dtype in wanted])


def read_seed(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """A reference list kept as a CSV file; refuses a broken key."""
    frame = spark.read.csv(path, header=True, schema=schema)
    if not check_seed_key(frame, key).isEmpty():
        raise ValueError(f"seed {path}: {key} must be unique and not null")
    return frame


def enrich(df: DataFrame, lookup: DataFrame, column: str, key: str) -> DataFrame:
    """Left lookup of a code in a reference list; the list is small by definition."""
    return df.join(F.broadcast(lookup), df[column] == lookup[key], "left").drop(lookup[key])


def category_hierarchy(categories: DataFrame, name: str = "category_name", parent: str = "parent_category") -> DataFrame:
    """Each category with its top level: itself, or its parent where it has one that exists."""
    tops = categories.select(F.col(name).alias("_parent_name")).distinct()
    joined = categories.join(tops, F.col(parent) == F.col("_parent_name"), "left")
    return joined.select(
        *categories.columns,
        F.coalesce("_parent_name", name).alias("top_category"),
        F.when(F.col("_parent_name").isNull(), 1).otherwise(2).alias("depth"),
    )
