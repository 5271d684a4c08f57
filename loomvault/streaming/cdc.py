"""Change events of operational databases: envelopes, routing, images, dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import cdc_apply

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_OPTIONS = {"timestampNTZFormat": MICROS, "ignoreNullFields": "false"}

# fixed values: envelope field -> landing column
ENVELOPE = {
    "operation": "CDC_OPERATION", "before": "RECORD_BEFORE", "after": "RECORD_AFTER", "timestamp": "CDC_TIMESTAMP",
    "transaction_id": "TRANSACTION_ID", "lsn": "LSN",
}
ENVELOPE_SOURCE = {"db": "SOURCE_DATABASE", "schema": "SOURCE_SCHEMA", "table": "SOURCE_TABLE"}


def split_dead_letters(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose text is JSON, rows whose text is not)."""
    parsed = F.try_parse_json(column)
    return df.where(parsed.isNotNull()), df.where(parsed.isNull())


def open_envelopes(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Envelope text to the columns of the change landing table; images stay JSON text.

    What is no JSON, or no instant, is NULL. The columns ``keep`` stay as they are.
    """
    doc = F.try_parse_json(column)
    text = {target: F.variant_get(doc, f"$.{field}", "string") for field, target in ENVELOPE.items() if field not in ("before", "after")}
    images = {ENVELOPE[f]: F.to_json(F.variant_get(doc, f"$.{f}", "variant")) for f in ("before", "after")}
    origin = {target: F.variant_get(doc, f"$.source.{field}", "string") for field, target in ENVELOPE_SOURCE.items()}
    out = df.select(*keep, *[c.alias(n) for n, c in {**origin, **text, **images}.items()])
    return out.withColumn("CDC_TIMESTAMP", F.col("CDC_TIMESTAMP").try_cast("timestamp_ntz"))


def route(events: DataFrame, tables: Sequence[str]) -> dict[str, DataFrame]:
    """Change events per source table. Each is a filter on the landing table's clustering column."""
    return {t: events.where(F.col("SOURCE_TABLE") == t) for t in tables}


def image_of(log: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Log rows with the after image as columns; a deleted row keeps the keys of its before image."""
    after = F.from_json("RECORD_AFTER", schema, JSON_OPTIONS)
    before = F.from_json("RECORD_BEFORE", schema, JSON_OPTIONS)
    opened = log.select("CDC_OPERATION", "CDC_TIMESTAMP", "LSN", after.alias("a"), before.alias("b"))
    columns = [
        (F.coalesce(f"a.{n}", f"b.{n}") if n in keys else F.col(f"a.{n}")).alias(n) for n in schema.names
    ]
    return opened.select(*columns, "CDC_OPERATION", "CDC_TIMESTAMP", "LSN")


def apply_log(target: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State of a table after a change log: the last change per key by (time, log position) wins."""
    return cdc_apply(target, image_of(log, target.schema, keys), keys, "CDC_OPERATION", ["CDC_TIMESTAMP", "LSN"])
