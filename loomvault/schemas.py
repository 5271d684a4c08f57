"""Declared schemas of landing, change-log and control tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
_S, _TS, _L, _B = T.StringType(), T.TimestampNTZType(), T.LongType(), T.BooleanType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, not required) for name, dtype, required in fields])


def _opt(dtype, *names):
    return [(n, dtype, False) for n in names]


LOAD_METADATA = [("_LOADED_AT", _TS, False), ("_FILE_NAME", _S, False), ("_FILE_ROW_NUMBER", _L, False)]

RAW_CUSTOMERS = _struct(
    ("CUSTOMER_ID", _S, True),
    *_opt(_S, "FIRST_NAME", "LAST_NAME", "EMAIL", "PHONE"),
    ("DATE_OF_BIRTH", T.DateType(), False),
    *_opt(_S, "GENDER", "COUNTRY_CODE", "CITY", "STATE", "POSTAL_CODE"),
    ("REGISTRATION_DATE", _TS, False),
    *_opt(_S, "CUSTOMER_SEGMENT", "LOYALTY_TIER"),
    *LOAD_METADATA,
)

RAW_ORDERS = _struct(
    ("ORDER_ID", _S, True), ("CUSTOMER_ID", _S, True), ("ORDER_DATE", _TS, True), ("ORDER_STATUS", _S, False),
    ("TOTAL_AMOUNT", MONEY, False),
    *_opt(_S, "CURRENCY_CODE", "PAYMENT_METHOD", "SHIPPING_METHOD", "SHIPPING_ADDRESS", "BILLING_ADDRESS"),
    ("DISCOUNT_AMOUNT", MONEY, False), ("TAX_AMOUNT", MONEY, False), ("FULFILLMENT_DATE", _TS, False),
    *LOAD_METADATA,
)

RAW_PRODUCTS = _struct(
    ("PRODUCT_ID", _S, True), ("PRODUCT_NAME", _S, True), *_opt(_S, "CATEGORY", "SUBCATEGORY", "BRAND"),
    ("UNIT_PRICE", MONEY, False), ("COST_PRICE", MONEY, False), ("WEIGHT_KG", T.DecimalType(10, 3), False),
    ("IS_ACTIVE", _B, False), ("CREATED_AT", _TS, False), ("UPDATED_AT", _TS, False),
    *LOAD_METADATA,
)

RAW_ORDER_ITEMS = _struct(
    ("ORDER_ITEM_ID", _S, True), ("ORDER_ID", _S, True), ("PRODUCT_ID", _S, True),
    ("QUANTITY", T.DecimalType(10, 0), True), ("UNIT_PRICE", MONEY, True),
    ("DISCOUNT_PERCENT", T.DecimalType(5, 2), False), ("LINE_TOTAL", MONEY, False),
    *LOAD_METADATA,
)

RAW_STREAM_EVENTS = _struct(
    ("RECORD_CONTENT", T.VariantType(), True), ("RECORD_METADATA", T.VariantType(), False),
    ("_LOADED_AT", _TS, False), ("_CHANNEL_NAME", _S, False), ("_OFFSET_TOKEN", _S, False),
    ("_PARTITION_ID", _L, False), ("_TOPIC_NAME", _S, False),
)

RAW_CDC_EVENTS = _struct(
    ("CDC_ID", _S, True), ("SOURCE_DATABASE", _S, True), ("SOURCE_SCHEMA", _S, False), ("SOURCE_TABLE", _S, True),
    ("CDC_OPERATION", _S, True), ("RECORD_BEFORE", T.VariantType(), False), ("RECORD_AFTER", T.VariantType(), False),
    ("CDC_TIMESTAMP", _TS, True), ("TRANSACTION_ID", _S, False), ("LSN", _S, False), ("_LOADED_AT", _TS, False),
    ("_FLOW_FILE_UUID", _S, False),
)

LANDING = {
    "RAW_CUSTOMERS": RAW_CUSTOMERS, "RAW_ORDERS": RAW_ORDERS, "RAW_PRODUCTS": RAW_PRODUCTS,
    "RAW_ORDER_ITEMS": RAW_ORDER_ITEMS, "RAW_STREAM_EVENTS": RAW_STREAM_EVENTS, "RAW_CDC_EVENTS": RAW_CDC_EVENTS,
}

FILE_INGESTION_LOG = _struct(
    ("INGESTION_ID", _S, True), ("FILE_NAME", _S, True), ("FILE_PATH", _S, True), ("STAGE_NAME", _S, True),
    ("SOURCE_SYSTEM", _S, True), ("FILE_FORMAT", _S, True), ("FILE_SIZE_BYTES", _L, False), ("ROW_COUNT", _L, False),
    ("ROWS_PARSED", _L, False), ("ROWS_LOADED", _L, False), ("ERRORS_SEEN", _L, False),
    ("FIRST_ERROR_MESSAGE", _S, False), ("STATUS", _S, True), ("PIPE_NAME", _S, False),
    ("LOAD_START_TS", _TS, False), ("LOAD_END_TS", _TS, False), ("CREATED_AT", _TS, False),
)

SCHEMA_REGISTRY = _struct(
    ("REGISTRY_ID", _S, True), ("SOURCE_SYSTEM", _S, True), ("TABLE_NAME", _S, True), ("COLUMN_NAME", _S, True),
    ("DATA_TYPE", _S, True), ("ORDINAL_POSITION", T.IntegerType(), True), ("IS_NULLABLE", _B, False),
    ("IS_PRIMARY_KEY", _B, False), ("SCHEMA_VERSION", T.IntegerType(), False), ("DETECTED_AT", _TS, False),
    ("IS_CURRENT", _B, False), ("PREVIOUS_DATA_TYPE", _S, False), ("CHANGE_TYPE", _S, False),
)

TASK_EXECUTION_LOG = _struct(
    ("EXECUTION_ID", _S, True), ("TASK_NAME", _S, True), ("TASK_TYPE", _S, True), ("DAG_ID", _S, False),
    ("RUN_ID", _S, False), ("MODEL_NAME", _S, False), ("STATUS", _S, True), ("ROWS_AFFECTED", _L, False),
    ("EXECUTION_TIME_SEC", T.DecimalType(12, 2), False), ("ERROR_MESSAGE", _S, False), ("STARTED_AT", _TS, False),
    ("COMPLETED_AT", _TS, False),
)

DQ_TEST_RESULTS = _struct(
    ("TEST_ID", _S, True), ("TEST_NAME", _S, True), ("TEST_TYPE", _S, True), ("MODEL_NAME", _S, False),
    ("COLUMN_NAME", _S, False), ("SEVERITY", _S, False), ("STATUS", _S, True), ("FAILURES_COUNT", _L, False),
    ("ROWS_SCANNED", _L, False), ("EXECUTED_AT", _TS, False),
)

ERROR_EVENT_LOG = _struct(
    ("ERROR_ID", _S, True), ("ERROR_TIMESTAMP", _TS, True), ("PROCEDURE_NAME", _S, True), ("ERROR_CODE", _S, False),
    ("ERROR_MESSAGE", _S, True), ("ERROR_STATE", _S, False), ("STACK_TRACE", _S, False),
    ("INPUT_PARAMETERS", _S, False), ("SEVERITY", _S, False), ("RESOLUTION_STATUS", _S, False),
    ("RESOLVED_BY", _S, False), ("RESOLVED_AT", _TS, False), ("CREATED_AT", _TS, False),
)

COST_ATTRIBUTION = _struct(
    ("ATTRIBUTION_ID", _S, True), ("WAREHOUSE_NAME", _S, True), ("QUERY_TAG", _S, False), ("COST_CENTER", _S, False),
    ("CREDITS_USED", T.DecimalType(12, 4), True), ("QUERIES_EXECUTED", _L, False), ("BYTES_SCANNED", _L, False),
    ("PERIOD_START", _TS, True), ("PERIOD_END", _TS, True),
)

REFRESH_HISTORY = _struct(
    ("GROUP_NAME", _S, True), ("REFRESH_START", _TS, True), ("REFRESH_END", _TS, False),
    ("BYTES_TRANSFERRED", _L, False), ("OBJECT_COUNT", _L, False),
)

DATA_PRODUCT_REGISTRY = _struct(
    ("PRODUCT_ID", _S, True), ("PRODUCT_NAME", _S, True), ("PRODUCT_DOMAIN", _S, True), ("PRODUCT_OWNER", _S, True),
    ("PRODUCT_VERSION", _S, False), ("PRODUCT_TIER", _S, False), ("PRODUCT_TYPE", _S, True),
    ("DATABASE_NAME", _S, True), ("SCHEMA_NAME", _S, True), ("OBJECT_NAME", _S, True), ("DESCRIPTION", _S, False),
    ("SLA_FRESHNESS_HOURS", T.IntegerType(), False), ("SLA_UPTIME_PERCENT", T.DecimalType(5, 2), False),
    ("QUALITY_SCORE", T.DecimalType(5, 2), False), ("CONSUMERS", T.ArrayType(_S), False), ("CONTRACT_SCHEMA", _S, False),
    ("IS_ACTIVE", _B, False), ("PUBLISHED_AT", _TS, False), ("LAST_REFRESHED_AT", _TS, False),
    ("CREATED_AT", _TS, False),
)

CONTROL = {
    "FILE_INGESTION_LOG": FILE_INGESTION_LOG, "SCHEMA_REGISTRY": SCHEMA_REGISTRY,
    "TASK_EXECUTION_LOG": TASK_EXECUTION_LOG, "DQ_TEST_RESULTS": DQ_TEST_RESULTS,
    "ERROR_EVENT_LOG": ERROR_EVENT_LOG, "COST_ATTRIBUTION": COST_ATTRIBUTION, "REFRESH_HISTORY": REFRESH_HISTORY,
    "DATA_PRODUCT_REGISTRY": DATA_PRODUCT_REGISTRY,
}


class SchemaDrift(ValueError):
    """A frame does not have the columns its table declares."""


def assert_schema(df, expected: T.StructType) -> None:
    """The ``fail`` policy: same column names and types, any nullability."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in expected}
    if have != want:
        added, gone = sorted(have.keys() - want.keys()), sorted(want.keys() - have.keys())
        changed = sorted(n for n in have.keys() & want.keys() if have[n] != want[n])
        raise SchemaDrift(f"added {added}, missing {gone}, retyped {changed}")


def sync_columns(table, incoming):
    """The ``sync`` policy: the incoming columns rule; the stored rows gain NULLs and lose the rest."""
    wanted = incoming.columns
    kept = table.select(*[c for c in table.columns if c in wanted])
    return kept.unionByName(incoming, allowMissingColumns=True).select(*wanted)
