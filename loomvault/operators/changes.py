"""Upserts, change feeds and change logs on keyed tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import row_id

ACTION, IS_UPDATE, ROW_ID = "_ACTION", "_IS_UPDATE", "_ROW_ID"
FEED_COLUMNS = (ACTION, IS_UPDATE, ROW_ID)


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Keys by value: NULL is a value like any other. The right side's keys are named ``_k0``, ``_k1`` and so on."""
    return reduce(and_, (left[k].eqNullSafe(right[f"_k{i}"]) for i, k in enumerate(keys)))


def _keys_of(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]


def without_keys(df: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``gone``."""
    other = gone.select(*_keys_of(gone, keys))
    return df.join(other, same_key(df, other, keys), "left_anti")


def with_keys(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``known``."""
    other = known.select(*_keys_of(known, keys))
    return df.join(other, same_key(df, other, keys), "left_semi")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows take the source's values, unmatched source rows are added.

    The source must hold each key once. Columns are matched by name; a column missing on one side
    is filled with NULL.
    """
    kept = without_keys(target, source, keys)
    return kept.unionByName(source, allowMissingColumns=True)


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str], append_only: bool = False) -> DataFrame:
    """Net changes between two versions: an update is a DELETE of the old and an INSERT of the new row."""
    columns = after.columns
    old = before.select(*_keys_of(before, keys), F.struct(*columns).alias("_old"))
    new = after.select(*keys, F.struct(*columns).alias("_new"))
    if append_only:
        added = without_keys(new, before, keys)
        pairs = added.select(*keys, F.lit("INSERT").alias(ACTION), F.lit(False).alias(IS_UPDATE), F.col("_new").alias("_row"))
    else:
        both = new.join(old, same_key(new, old, keys), "full_outer").where("not (_old <=> _new)")
        both = both.withColumns({k: F.when(F.col("_new").isNull(), F.col(f"_k{i}")).otherwise(F.col(k)) for i, k in enumerate(keys)})
        update = F.col("_old").isNotNull() & F.col("_new").isNotNull()
        sides = F.array(
            F.when(F.col("_old").isNotNull(), F.struct(F.lit("DELETE").alias("a"), F.col("_old").alias("r"))),
            F.when(F.col("_new").isNotNull(), F.struct(F.lit("INSERT").alias("a"), F.col("_new").alias("r"))),
        )
        pairs = (
            both.select(*keys, update.alias(IS_UPDATE), F.explode(F.array_compact(sides)).alias("_s"))
            .select(*keys, F.col("_s.a").alias(ACTION), IS_UPDATE, F.col("_s.r").alias("_row"))
        )
    tagged = pairs.withColumn(ROW_ID, row_id(*[F.col(k) for k in keys]))
    return tagged.select("_row.*", *FEED_COLUMNS)


def initial_rows(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first read of a feed that shows rows already present."""
    return table.withColumns({
        ACTION: F.lit("INSERT"), IS_UPDATE: F.lit(False), ROW_ID: row_id(*[F.col(k) for k in keys]),
    })


def has_changes(feed: DataFrame) -> bool:
    return not feed.isEmpty()


def cdc_merge(target: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Apply the INSERT half of a feed: known keys change only on a flagged update.

    A matched row that is not flagged as an update is ignored, and deletes are ignored.
    """
    incoming = feed.where(F.col(ACTION) == "INSERT")
    updates = with_keys(incoming.where(IS_UPDATE), target, keys)
    inserts = without_keys(incoming, target, keys)
    return merge_upsert(target, updates.unionByName(inserts).drop(*FEED_COLUMNS), keys)


def feed_apply(target: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Apply a whole feed, deletes included: ``feed_apply(a, change_feed(a, b)) == b``."""
    added = feed.where(F.col(ACTION) == "INSERT").drop(*FEED_COLUMNS)
    return without_keys(target, feed.select(*keys).distinct(), keys).unionByName(added)


def last_change_per_key(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest log entry per key by (time, log position)."""
    payload = [c for c in log.columns if c not in keys]
    picked = log.groupBy(*keys).agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*log.columns)


def cdc_apply(target: DataFrame, log: DataFrame, keys: Sequence[str], operation: str,
              order: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Apply an INSERT / UPDATE / DELETE log whose rows carry the after image as columns."""
    last = last_change_per_key(log, keys, order)
    alive = last.where(F.col(operation) != "DELETE").drop(operation, *order, *drop)
    return without_keys(target, last, keys).unionByName(alive, allowMissingColumns=True)
