"""Data quality checks. Each returns the offending rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import add_days, at, hours_between
from ..functions.keys import row_id
from .history import previous_of


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("CNT")).where("CNT > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Distinct values outside the list with their counts; NULL is a matter for ``not_null``."""
    return df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("CNT"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    known = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(known, column, "left_anti")


def between(df: DataFrame, column: str, low: Any = None, high: Any = None) -> DataFrame:
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < low)
    if high is not None:
        outside = outside | (F.col(column) > high)
    return df.where(outside)


def inline_checks(df: DataFrame, checks: Sequence[tuple[str, str, str, int]]) -> DataFrame:
    """(name, kind, column, threshold) -> one row of booleans, all in one pass over the table."""
    measures = {
        "null_check": lambda c, limit: F.count_if(F.col(c).isNull()) <= limit,
        "unique_check": lambda c, limit: (F.count("*") - F.count_distinct(F.col(c))) <= limit,
        "row_count": lambda c, limit: F.count("*") > limit,
    }
    return df.agg(*[measures[kind](column, limit).alias(name) for name, kind, column, limit in checks])


def hub_integrity(df: DataFrame, key: str, hub: DataFrame) -> DataFrame:
    """Keys that no hub row explains; the ghost key is exempt."""
    return relationships(df.where(F.col(key) != config.GHOST_KEY).select(key), key, hub, key)


def link_integrity(link: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    """(FK_COLUMN, FK_VALUE) of every link key without its hub row."""
    parts = [
        relationships(link.select(c), c, hub, c).select(F.lit(c).alias("FK_COLUMN"), F.col(c).alias("FK_VALUE"))
        for c, hub in parents.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def vault_integrity(checks: Sequence[tuple[str, DataFrame, str, DataFrame]]) -> DataFrame:
    """(name, child, key, hub) for every relation of the vault -> CHECK_NAME, ORPHAN_KEY."""
    parts = [
        relationships(child.select(key), key, hub, key).select(F.lit(name).alias("CHECK_NAME"), F.col(key).alias("ORPHAN_KEY"))
        for name, child, key, hub in checks
    ]
    return reduce(DataFrame.unionByName, parts)


def satellite_repeats(sat: DataFrame, key: str, hash_diff: str = "HASH_DIFF") -> DataFrame:
    """Versions equal to the version before them."""
    rows = sat.select(key, hash_diff, "LOAD_DATETIME")
    seen = previous_of(rows, key, ["LOAD_DATETIME"], {"PREV_HASH_DIFF": hash_diff})
    return seen.where(F.col(hash_diff) == F.col("PREV_HASH_DIFF"))


def duplicate_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(KEY_COLUMN, KEY_VALUE, CNT) for keys that occur more than once."""
    parts = [
        unique(df, key).select(F.lit(key).alias("KEY_COLUMN"), F.col(key).alias("KEY_VALUE"), "CNT") for key, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def fact_measures(orders: DataFrame, lowest_net: float = -1000) -> DataFrame:
    c = F.col
    return orders.where((c("TOTAL_AMOUNT") < 0) | (c("NET_AMOUNT") < lowest_net) | (c("DISCOUNT_AMOUNT") < 0) | (c("TAX_AMOUNT") < 0))


def pit_completeness(hub: DataFrame, pit: DataFrame, key: str) -> DataFrame:
    """Hub rows that no PIT row covers."""
    return hub.join(pit.select(key), key, "left_anti")


def volume(tables: Mapping[str, DataFrame], minimum: Mapping[str, int]) -> DataFrame:
    """Row counts against the least expected; one result row per table."""
    parts = [
        tables[name].agg(F.count("*").alias("ROWS_SCANNED")).select(
            F.concat(F.lit("volume_check_"), F.lit(name)).alias("TEST_NAME"), F.lit("CUSTOM").alias("TEST_TYPE"), F.lit(name).alias("MODEL_NAME"),
            F.when(F.col("ROWS_SCANNED") >= least, "PASS").otherwise("FAIL").alias("STATUS"),
            F.when(F.col("ROWS_SCANNED") >= least, 0).otherwise(1).cast("bigint").alias("FAILURES_COUNT"),
            "ROWS_SCANNED", F.lit("ERROR").alias("SEVERITY"),
        ) for name, least in minimum.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def source_freshness(sources: Mapping[str, DataFrame], now: str, column: str = "_LOADED_AT",
                     warn: int = config.FRESHNESS_WARN_HOURS, error: int = config.FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Age of each source's newest row: pass, warn or error."""
    parts = []
    for name, df in sources.items():
        newest = df.agg(F.max(column).alias("LATEST"))
        age = hours_between(F.col("LATEST"), at(now))
        parts.append(newest.select(
            F.lit(name).alias("SOURCE"), "LATEST", age.alias("AGE_HOURS"),
            F.when(age > error, "error").when(age > warn, "warn").when(age.isNull(), "error").otherwise("pass").alias("STATUS"),
        ))
    return reduce(DataFrame.unionByName, parts)


def result_row(name: str, failures: DataFrame, scanned: DataFrame, model: str, column: str | None, now: str,
               severity: str = "WARN", test_type: str = "GENERIC") -> DataFrame:
    """A check's outcome in the shape of the results log."""
    counts = failures.agg(F.count("*").alias("f")).select("f", scanned.agg(F.count("*")).scalar().alias("s"))
    return counts.select(
        row_id(F.lit(name), F.lit(model), F.lit(column), F.lit(now)).alias("TEST_ID"), F.lit(name).alias("TEST_NAME"),
        F.lit(test_type).alias("TEST_TYPE"), F.lit(model).alias("MODEL_NAME"), F.lit(column).cast("string").alias("COLUMN_NAME"),
        F.lit(severity).alias("SEVERITY"),
        F.when(F.col("f") == 0, "PASS").otherwise("FAIL" if severity == "ERROR" else "WARN").alias("STATUS"),
        F.col("f").alias("FAILURES_COUNT"), F.col("s").alias("ROWS_SCANNED"), at(now).alias("EXECUTED_AT"),
    )


def quality_report(results: DataFrame, now: str) -> DataFrame:
    """Results of the last day by status."""
    recent = results.where(F.col("EXECUTED_AT") >= add_days(at(now), -1))
    return recent.groupBy("STATUS").agg(
        F.count("*").alias("TEST_COUNT"), F.sum("FAILURES_COUNT").alias("TOTAL_FAILURES")).orderBy("STATUS")
