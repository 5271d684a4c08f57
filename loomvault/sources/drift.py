"""Schema registry: inferred columns, drift against the registered version, next version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import at
from ..functions.keys import row_id
from ..schemas import SCHEMA_REGISTRY
from .formats import NULL_TOKENS


@dataclass(frozen=True)
class DriftResult:
    changes: DataFrame
    registry: DataFrame
    version: int
    drifted: bool


def inferred_columns(df: DataFrame) -> DataFrame:
    """One row per column of a frame, in order."""
    rows = [(f.name, f.dataType.simpleString(), i + 1, f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "COLUMN_NAME string, DATA_TYPE string, ORDINAL_POSITION int, IS_NULLABLE boolean")


# The lattice of types, narrow to wide: a type holds a value if its test does. A column has the first type that holds all its values.
DATE_FORM = r"^\d{4}-\d{2}-\d{2}$"
STAMP_FORM = r"^\d{4}-\d{2}-\d{2}([ T].*)?$"


def _fits(value: Column) -> dict[str, Column]:
    return {
        "boolean": F.lower(value).isin("true", "false"),
        "int": value.try_cast("int").isNotNull() & value.rlike(r"^[+-]?\d+$"),
        "bigint": value.try_cast("bigint").isNotNull() & value.rlike(r"^[+-]?\d+$"),
        "double": value.try_cast("double").isNotNull(),
        "date": value.try_cast("date").isNotNull() & value.rlike(DATE_FORM),
        "timestamp": value.try_cast("timestamp_ntz").isNotNull() & value.rlike(STAMP_FORM),
    }


def column_types(text: DataFrame) -> DataFrame:
    """One row per text column: the narrowest type that holds every value of every row, string where none does or there is none.

    One aggregate over all rows: a count per column and type. Counts of parts add up, so types of files or batches may be merged.
    """
    # "column" and "type" go by place: names may hold anything
    named = {f.name: F.trim(F.col(f"`{f.name}`")) for f in text.schema}
    tests = {(i, kind): test for i, value in enumerate(named.values()) for kind, test in
             {"values": value.isNotNull() & ~value.isin(*NULL_TOKENS), **{k: t & ~value.isin(*NULL_TOKENS) for k, t in _fits(value).items()}}.items()}
    counts = text.agg(*[F.count_if(test).alias(f"{i}_{kind}") for (i, kind), test in tests.items()])
    rows = []
    for i, name in enumerate(named):
        n = F.col(f"{i}_values")
        best = F.lit("string")
        for kind in reversed(_fits(F.lit("")).keys()):
            best = F.when((n > 0) & (F.col(f"{i}_{kind}") == n), kind).otherwise(best)
        rows.append(F.struct(F.lit(name).alias("COLUMN_NAME"), best.alias("DATA_TYPE"), F.lit(i + 1).alias("ORDINAL_POSITION"), F.lit(True).alias("IS_NULLABLE")))
    return counts.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def infer_from_files(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Columns of delimited files: names from the header, types from all rows, so that one odd value shows."""
    return column_types(spark.read.csv(path, header=True, sep=sep))


def detect_drift(inferred: DataFrame, registry: DataFrame | None, source: str, table: str, now: str) -> DriftResult:
    """ADD, TYPE_CHANGE and REMOVE against the current version; the registry after registration."""
    spark = inferred.sparkSession
    registry = spark.createDataFrame([], SCHEMA_REGISTRY) if registry is None else registry
    mine = (F.col("SOURCE_SYSTEM") == source) & (F.col("TABLE_NAME") == table)
    current = registry.where(mine & F.col("IS_CURRENT"))
    old = current.select("COLUMN_NAME", F.col("DATA_TYPE").alias("OLD_TYPE"))
    diff = inferred.join(old, "COLUMN_NAME", "full_outer").withColumn("CHANGE_TYPE", (
        F.when(F.col("OLD_TYPE").isNull(), "ADD").when(F.col("DATA_TYPE").isNull(), "REMOVE")
        .when(F.col("DATA_TYPE") != F.col("OLD_TYPE"), "TYPE_CHANGE")
    ))
    changes = diff.where("CHANGE_TYPE is not null").select("COLUMN_NAME", "CHANGE_TYPE", F.col("DATA_TYPE").alias("NEW_TYPE"), "OLD_TYPE")
    version = current.agg(F.max("SCHEMA_VERSION").alias("v")).first()["v"] or 0
    drifted = not changes.isEmpty()
    if not drifted:
        return DriftResult(changes, registry, max(version, 1), False)
    closed = registry.withColumn("IS_CURRENT", F.col("IS_CURRENT") & ~mine)
    fresh = diff.where("DATA_TYPE is not null").select(
        row_id(F.lit(source), F.lit(table), F.col("COLUMN_NAME"), F.lit(version + 1)).alias("REGISTRY_ID"),
        F.lit(source).alias("SOURCE_SYSTEM"), F.lit(table).alias("TABLE_NAME"), "COLUMN_NAME", "DATA_TYPE", "ORDINAL_POSITION", "IS_NULLABLE",
        F.lit(False).alias("IS_PRIMARY_KEY"), F.lit(version + 1).alias("SCHEMA_VERSION"), at(now).alias("DETECTED_AT"), F.lit(True).alias("IS_CURRENT"),
        F.col("OLD_TYPE").alias("PREVIOUS_DATA_TYPE"), "CHANGE_TYPE",
    )
    return DriftResult(changes, closed.unionByName(fresh), version + 1, True)
