"""A stream of change events applied to several stored tables, each change once.

Every table is kept by key bucket, with the position (time, log position) of the change that made each row. A micro-batch reads
and writes the buckets of its own keys only. A change counts where its position is beyond the one stored for its key, so repeats and late
events of an earlier state change nothing; a deleted key stays as a mark without which a late insert would bring it back. A batch
that failed after some of its tables runs again from the tables as they were before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.tables import TableFolder
from . import cdc
from .known import BUCKET

TIME, LSN, GONE = "_CHANGE_TIME", "_CHANGE_LSN", "_GONE"
OPERATIONS = ("INSERT", "UPDATE", "DELETE")  # fixed values


@dataclass(frozen=True)
class Target:
    """A stored table that change events of one source table go to."""

    name: str
    schema: T.StructType
    keys: Sequence[str]


def judged(batch: DataFrame, column: str, sources: Sequence[str]) -> DataFrame:
    """The batch with its envelopes opened, and REASON: why an event cannot be applied, NULL where it can."""
    opened = cdc.open_envelopes(batch, column, keep=batch.columns)
    after, before = (F.nullif(F.col(c), F.lit("null")) for c in ("RECORD_AFTER", "RECORD_BEFORE"))  # a JSON null is no image
    image = F.when(F.col("CDC_OPERATION") == "DELETE", F.coalesce(after, before)).otherwise(after)
    reason = (
        F.when(F.try_parse_json(column).isNull(), "NO_JSON")
        .when(~F.coalesce(F.col("SOURCE_TABLE").isin(list(sources)), F.lit(False)), "UNKNOWN_TABLE")
        .when(~F.coalesce(F.col("CDC_OPERATION").isin(list(OPERATIONS)), F.lit(False)), "UNKNOWN_OPERATION")
        .when(F.col("CDC_TIMESTAMP").isNull() | F.col("LSN").isNull(), "NO_POSITION")
        .when(image.isNull(), "NO_IMAGE")
    )
    return opened.withColumn("REASON", reason)


def _bucketed(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a key, that of the last position; of different rows at one position the same one whatever their order."""
    payload = [c for c in rows.columns if c not in keys]
    order = F.struct(TIME, LSN, F.xxhash64(*[c for c in payload if c != BUCKET]))
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*payload), order).alias("_row")).select(*keys, "_row.*").select(*rows.columns)


def seed(tables: TableFolder, target: Target, rows: DataFrame, buckets: int = 64) -> None:
    """Begin a target with the rows of a snapshot; any change counts against them."""
    start = rows.select(*target.schema.names, F.lit(None).cast("timestamp_ntz").alias(TIME), F.lit(None).cast("string").alias(LSN), F.lit(False).alias(GONE))
    tables.replace(target.name, _bucketed(start, target.keys, buckets), BUCKET)


def current(tables: TableFolder, target: Target) -> DataFrame:
    """The rows of a target as the changes so far left them."""
    stored = tables.read(target.name)
    if stored is None:
        return tables.spark.createDataFrame([], target.schema)
    return stored.where(~F.col(GONE)).select(*target.schema.names)


def apply_to(log: DataFrame, target: Target, tables: TableFolder, batch_id: int, buckets: int = 64) -> None:
    """Apply change rows of one source table to its target. Running the batch again gives the same table."""
    tables.begin(target.name, batch_id)
    image = cdc.image_of(log, target.schema, target.keys).withColumns(
        {GONE: F.col("CDC_OPERATION") == "DELETE"}).withColumnsRenamed({"CDC_TIMESTAMP": TIME, "LSN": LSN}).drop("CDC_OPERATION")
    fresh = _newest(_bucketed(image, target.keys, buckets), target.keys)
    touched = [str(r[0]) for r in fresh.select(BUCKET).distinct().collect()]  # at most one row a bucket
    if not touched:
        return
    stored = tables.read_parts(target.name, touched)
    merged = fresh if stored is None else _newest(stored.unionByName(fresh), target.keys)
    tables.replace_parts(target.name, merged, BUCKET, touched)


def apply_batch(batch: DataFrame, targets: Mapping[str, Target], tables: TableFolder, batch_id: int, column: str = "text",
                log: str = "changes", buckets: int = 64) -> None:
    """Apply one micro-batch of envelopes to all targets, by source table.

    ``<log>_dead_letters`` gets the events that cannot be applied, as they came and with the REASON; ``<log>_commits`` a row per source
    table with the events, the first and the last position of the batch.
    """
    opened = judged(batch, column, list(targets)).persist()  # read once a target; recomputed from the source if an executor is lost
    try:
        good = opened.where("REASON is null")
        for source, target in targets.items():
            apply_to(good.where(F.col("SOURCE_TABLE") == source), target, tables, batch_id, buckets)
        tables.append(f"{log}_dead_letters", opened.where("REASON is not null").select(*batch.columns, "REASON"), batch_id)
        position = F.struct("CDC_TIMESTAMP", "LSN")
        commits = good.groupBy("SOURCE_TABLE").agg(F.count("*").alias("EVENTS"), F.min(position).alias("FIRST"), F.max(position).alias("LAST"))
        tables.append(f"{log}_commits", commits.withColumn("BATCH_ID", F.lit(batch_id).cast("bigint")), batch_id)
    finally:
        opened.unpersist()


def stream_apply(changes: DataFrame, targets: Mapping[str, Target], tables: TableFolder, checkpoint: str, column: str = "text",
                 log: str = "changes", buckets: int = 64) -> StreamingQuery:
    """Keep several tables up to date from one stream of change envelopes."""
    return (changes.writeStream.foreachBatch(lambda batch, batch_id: apply_batch(batch, targets, tables, batch_id, column, log, buckets))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
