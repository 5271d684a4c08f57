"""Landing tables derived from the TPC-H-like parquet tables.

They are dirty on purpose: stray blanks, mixed case, missing amounts, unknown countries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import add_days, add_hours, at
from ..operators.sizes import scanned_bytes

AS_OF_ORDERS = "2001-08-02 00:00:00"
AS_OF_EVENTS = "2024-01-31 00:00:00"
_EPOCH = "1995-01-01 00:00:00"
SPREAD_BYTES = 16 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _spread(df: DataFrame, *key: str) -> DataFrame:
    """A table stored in a few splits is dealt out to all cores before rows are widened and hashed.

    Only small tables: a large one already has more splits than cores and is read where it lies.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = scanned_bytes(df)
    return df.repartition(cores, *key) if size is not None and size < cores * SPREAD_BYTES else df


def _text(name: str):
    return F.col(name).cast("string")


def _with_load_metadata(df: DataFrame, file_name: str) -> DataFrame:
    return df.withColumns({"_FILE_NAME": F.lit(file_name), "_FILE_ROW_NUMBER": F.lit(None).cast("bigint")})


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    places = table(spark, folder, "nation").join(table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey"))
    first = customer.select(
        F.col("c_custkey").alias("k"), F.lit(None).cast("string").alias("et"), F.lit(0.0).alias("val"),
        F.lit(0).alias("ev"), at(_EPOCH).alias("ts"),
    )
    later = _spread(table(spark, folder, "events"), "event_id").select(
        F.col("user_id").alias("k"), F.col("event_type").alias("et"), F.col("value").alias("val"),
        (F.col("event_id") % 3).cast("int").alias("ev"), "ts",
    )
    joined = (
        first.unionByName(later).join(customer, F.expr("c_custkey = k"))
        .join(F.broadcast(places), F.expr("n_nationkey = c_nationkey"))  # nation and region are fixed-size
    )
    k, buys = _text("k"), F.col("et") == "purchase"
    return _with_load_metadata(joined.select(
        F.concat(F.lit(" c"), k).alias("CUSTOMER_ID"),
        F.lower("c_mktsegment").alias("FIRST_NAME"),
        F.concat(F.lit("CUST"), k).alias("LAST_NAME"),
        F.when(F.col("et") == "signup", F.concat(F.lit(" Cust"), k, F.lit("."), _text("ev"), F.lit("@Example.COM ")))
        .otherwise(F.concat(F.lit("Cust"), k, F.lit("@Example.COM"))).alias("EMAIL"),
        F.when(F.col("k") % 23 != 0, F.concat(F.lit("+1555"), F.lpad(k, 7, "0"))).alias("PHONE"),
        F.date_add(F.lit("1950-01-01").cast("date"), ((F.col("k") * 37) % 18000).cast("int")).alias("DATE_OF_BIRTH"),
        F.when(F.col("k") % 3 == 0, "f").when(F.col("k") % 3 == 1, "m").alias("GENDER"),
        F.element_at(F.array(*[F.lit(c) for c in ("us", "gb", "de", "fr", "xx")]),
                     (F.col("n_nationkey") % 5 + 1).cast("int")).alias("COUNTRY_CODE"),
        F.col("n_name").alias("CITY"),
        F.col("r_name").alias("STATE"),
        F.lpad((F.col("k") % 100000).cast("string"), 5, "0").alias("POSTAL_CODE"),
        at(_EPOCH).alias("REGISTRATION_DATE"),
        F.col("c_mktsegment").alias("CUSTOMER_SEGMENT"),
        F.when(buys & (F.col("val") >= 100), "platinum").when(buys & (F.col("val") >= 50), "gold")
        .when(F.col("c_acctbal") >= 5000, "silver").when(F.col("c_acctbal") >= 0, "bronze").alias("LOYALTY_TIER"),
        F.col("ts").alias("_LOADED_AT"),
    ), "customer.parquet")


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    key, state = F.col("o_orderkey"), F.col("o_orderstatus")
    steps = F.array_compact(F.array(
        F.struct(F.lit(0).alias("i"), F.lit("pending").alias("st")),
        F.struct(F.lit(1).alias("i"), F.lit("confirmed").alias("st")),
        F.when(state.isin("P", "F"), F.struct(F.lit(2).alias("i"), F.lit("shipped").alias("st"))),
        F.when(state == "F", F.struct(F.lit(3).alias("i"), F.lit("delivered").alias("st"))),
        F.when(key % 17 == 0, F.struct(F.lit(4).alias("i"), F.lit("cancelled").alias("st"))),
        F.when(key % 29 == 0, F.struct(F.lit(5).alias("i"), F.lit("refunded").alias("st"))),
    ))
    total = F.expr("cast(floor(o_totalprice / 10) / 100d as decimal(18,4))")
    versions = _spread(table(spark, folder, "orders"), "o_orderkey").withColumn("total", total).select("*", F.explode(steps).alias("s")).select("*", "s.*")
    return _with_load_metadata(versions.select(
        F.concat(F.lit(" o"), _text("o_orderkey")).alias("ORDER_ID"),
        F.concat(F.lit("c"), _text("o_custkey"), F.lit(" ")).alias("CUSTOMER_ID"),
        F.col("o_orderdate").alias("ORDER_DATE"),
        F.col("st").alias("ORDER_STATUS"),
        F.col("total").alias("TOTAL_AMOUNT"),
        F.when(key % 3 == 0, "usd").when(key % 3 == 1, "eur").otherwise("gbp").alias("CURRENCY_CODE"),
        F.when(key % 4 == 0, "credit_card").when(key % 4 == 1, "paypal").when(key % 4 == 2, "bank_transfer")
        .otherwise("gift_card").alias("PAYMENT_METHOD"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "overnight").when(F.col("o_orderpriority") == "2-HIGH", "express")
        .otherwise("standard").alias("SHIPPING_METHOD"),
        F.concat(_text("o_custkey"), F.lit(" Main St")).alias("SHIPPING_ADDRESS"),
        F.concat(_text("o_custkey"), F.lit(" Main St")).alias("BILLING_ADDRESS"),
        F.when(key % 7 != 0, F.expr("cast(total * cast(o_orderkey % 5 as decimal(2,0)) / 100 as decimal(18,4))")).alias("DISCOUNT_AMOUNT"),
        F.when(key % 11 != 0, F.expr("cast(total * 0.08BD as decimal(18,4))")).alias("TAX_AMOUNT"),
        F.when(F.col("i").isin(2, 3), add_hours(F.col("o_orderdate"), key % 96)).alias("FULFILLMENT_DATE"),
        add_days(F.col("o_orderdate"), F.col("i")).alias("_LOADED_AT"),
    ), "orders.parquet")


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    versions = _spread(table(spark, folder, "part"), "p_partkey").select(
        "*", F.explode(F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("i")
    )
    price = F.col("p_retailprice").cast("decimal(18,4)")
    changed = F.when(F.col("i") == 0, at(_EPOCH)).otherwise(at("1998-01-01 00:00:00"))
    return _with_load_metadata(versions.select(
        F.concat(F.lit("p"), _text("p_partkey")).alias("PRODUCT_ID"),
        F.concat(F.lit(" "), "p_name").alias("PRODUCT_NAME"),
        F.lower("p_type").alias("CATEGORY"),
        F.col("p_name").alias("SUBCATEGORY"),
        F.col("p_brand").alias("BRAND"),
        F.when(key % 101 == 0, F.lit(None).cast("decimal(18,4)"))
        .when(F.col("i") == 1, (price * F.expr("1.1BD")).cast("decimal(18,4)")).otherwise(price).alias("UNIT_PRICE"),
        F.when(key % 50 == 0, F.lit(0).cast("decimal(18,4)"))
        .otherwise((price * F.expr("0.6BD")).cast("decimal(18,4)")).alias("COST_PRICE"),
        F.when(key % 13 != 0, F.col("p_size").cast("decimal(10,3)")).alias("WEIGHT_KG"),
        F.when(key % 19 != 0, key % 20 != 0).alias("IS_ACTIVE"),
        at(_EPOCH).alias("CREATED_AT"),
        changed.alias("UPDATED_AT"),
        changed.alias("_LOADED_AT"),
    ), "part.parquet")


def raw_order_items(spark: SparkSession, folder: str) -> DataFrame:
    line, price = F.col("l_linenumber"), F.col("l_extendedprice")
    return _with_load_metadata(_spread(table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber").select(
        F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber"), _text("l_partkey"), _text("l_suppkey"),
                    price.cast("decimal(18,4)").cast("string"),
                    F.to_date("l_shipdate").cast("string")).alias("ORDER_ITEM_ID"),
        F.concat(F.lit("o"), _text("l_orderkey")).alias("ORDER_ID"),
        F.concat(F.lit("p"), _text("l_partkey")).alias("PRODUCT_ID"),
        F.col("l_quantity").cast("decimal(10,0)").alias("QUANTITY"),
        F.expr("cast(floor(l_extendedprice * 100 / l_quantity) / 100d as decimal(18,4))").alias("UNIT_PRICE"),
        F.when(line != 7, (F.col("l_discount") * 100).cast("decimal(5,2)")).alias("DISCOUNT_PERCENT"),
        F.when(line % 2 != 0, price.cast("decimal(18,4)")).alias("LINE_TOTAL"),
        F.col("l_shipdate").alias("_LOADED_AT"),
    ), "lineitem.parquet")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """Event rows in the shape of the row-level streaming landing table."""
    return shape_stream_events(table(spark, folder, "events"))


def shape_stream_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.try_parse_json("props").alias("RECORD_CONTENT"),
        F.parse_json(F.to_json(F.struct("event_id", "event_type"))).alias("RECORD_METADATA"),
        F.col("ts").alias("_LOADED_AT"),
        F.concat(F.lit("events-"), (F.col("user_id") % 4).cast("string")).alias("_CHANNEL_NAME"),
        _text("event_id").alias("_OFFSET_TOKEN"),
        (F.col("user_id") % 4).alias("_PARTITION_ID"),
        F.lit("events").alias("_TOPIC_NAME"),
    )


def cdc_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events in the shape of the change log's landing table."""
    image = F.parse_json(F.to_json(F.struct("event_id", "event_type", "value")))
    return table(spark, folder, "events").select(
        _text("event_id").alias("CDC_ID"), F.lit("shop").alias("SOURCE_DATABASE"), F.lit("public").alias("SOURCE_SCHEMA"), F.lit("events").alias("SOURCE_TABLE"),
        F.when(F.col("event_id") % 9 == 0, "DELETE").otherwise("INSERT").alias("CDC_OPERATION"),
        F.when(F.col("event_id") % 9 == 0, image).alias("RECORD_BEFORE"), F.when(F.col("event_id") % 9 != 0, image).alias("RECORD_AFTER"),
        F.col("ts").alias("CDC_TIMESTAMP"), _text("user_id").alias("TRANSACTION_ID"), F.lpad(_text("event_id"), 12, "0").alias("LSN"),
        F.col("ts").alias("_LOADED_AT"), F.lit(None).cast("string").alias("_FLOW_FILE_UUID"))


def event_texts(events: DataFrame) -> DataFrame:
    """Event rows as they are delivered, the payload still text.

    Every thousandth has no offset, every fiftieth a payload that is cut off.
    """
    number = F.col("event_id")
    return events.select(
        "event_id", F.when(number % 50 == 49, F.left("props", F.lit(3))).otherwise(F.col("props")).alias("RECORD_TEXT"),
        F.parse_json(F.to_json(F.struct("event_id", "event_type"))).alias("RECORD_METADATA"), F.col("ts").alias("_LOADED_AT"),
        F.concat(F.lit("events-"), (F.col("user_id") % 4).cast("string")).alias("_CHANNEL_NAME"),
        F.when(number % 1000 != 5, _text("event_id")).alias("_OFFSET_TOKEN"), (F.col("user_id") % 4).alias("_PARTITION_ID"), F.lit("events").alias("_TOPIC_NAME"))


def file_ingestion_log(spark: SparkSession, folder: str) -> DataFrame:
    """One load record per event: the type is the source system, the value its duration in seconds."""
    events = table(spark, folder, "events")
    return events.select(
        _text("event_id").alias("INGESTION_ID"),
        F.concat(F.lit("file-"), _text("event_id"), F.lit(".json")).alias("FILE_NAME"),
        F.upper("event_type").alias("SOURCE_SYSTEM"),
        F.concat(F.lit("PIPE_"), F.upper("event_type")).alias("PIPE_NAME"),
        F.when(F.col("event_id") % 10 == 0, "FAILED").otherwise("LOADED").alias("STATUS"),
        (F.col("event_id") % 1000).alias("ROWS_LOADED"),
        F.col("ts").alias("LOAD_START_TS"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.floor("value").cast("decimal(18,6)"))).alias("LOAD_END_TS"),
    )


def error_event_log(spark: SparkSession, folder: str) -> DataFrame:
    errors = table(spark, folder, "events").where(F.col("event_type") == "error")
    return errors.select(
        _text("event_id").alias("ERROR_ID"), F.col("ts").alias("ERROR_TIMESTAMP"),
        F.concat(F.lit("JOB_"), (F.col("user_id") % 5).cast("string")).alias("PROCEDURE_NAME"),
        F.concat(F.lit("E"), (F.col("event_id") % 7).cast("string")).alias("ERROR_CODE"),
        F.col("props").alias("ERROR_MESSAGE"),
        F.when(F.col("value") >= 50, "CRITICAL").otherwise("ERROR").alias("SEVERITY"),
    )


def cost_attribution(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.select(
        _text("event_id").alias("ATTRIBUTION_ID"),
        F.element_at(F.array(*[F.lit(w) for w in ("LOADER_WH", "TRANSFORMER_WH", "CI_WH", "DEV_WH", "ANALYTICS_WH")]),
                     (F.col("user_id") % 5 + 1).cast("int")).alias("WAREHOUSE_NAME"),
        F.col("event_type").alias("QUERY_TAG"),
        F.concat(F.lit("CC"), (F.col("user_id") % 3).cast("string")).alias("COST_CENTER"),
        F.expr("cast(floor(value * 100) / 10000d as decimal(12,4))").alias("CREDITS_USED"),
        F.lit(1).cast("bigint").alias("QUERIES_EXECUTED"),
        (F.col("event_id") * 1024).alias("BYTES_SCANNED"),
        F.col("ts").alias("PERIOD_START"), F.col("ts").alias("PERIOD_END"),
    )


def refresh_history(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.select(
        F.concat(F.lit("GROUP_"), (F.col("user_id") % 10).cast("string")).alias("GROUP_NAME"),
        F.col("ts").alias("REFRESH_START"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.floor(F.col("value") * 60).cast("decimal(18,6)"))).alias("REFRESH_END"),
        F.col("event_id").alias("BYTES_TRANSFERRED"),
        (F.col("event_id") % 50).alias("OBJECT_COUNT"),
        F.when(F.col("event_type") == "click", "RUNNING").otherwise("IDLE").alias("SCHEDULING_STATE"),
    )
