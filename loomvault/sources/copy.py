"""Loading staged files into a table: whole files only, columns matched by name, every file logged."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import at
from ..functions.keys import row_id
from .formats import SEPARATORS, Stage, file_name, file_size, read_delimited, read_json_by_name
from .tables import TableFolder

LOG = "file_ingestion_log"


@dataclass(frozen=True)
class CopyResult:
    rows: DataFrame
    log: DataFrame


def match_by_name(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The schema's columns found in a frame whatever their case; missing ones are NULL."""
    have = {c.lower(): c for c in df.columns}
    return [
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]


def staged_rows(spark: SparkSession, stage: Stage) -> DataFrame:
    """Typed rows with ``_FILE_NAME``, ``_FILE_SIZE`` and ``_broken``; names are matched file by file."""
    if stage.kind in SEPARATORS:
        return read_delimited(spark, stage.location, stage.schema, SEPARATORS[stage.kind], strict=True, by_name=True)
    if stage.kind == "json":
        return read_json_by_name(spark, stage.location, stage.schema)
    if stage.kind == "parquet":
        return rows_by_file_schema(spark, stage)
    raw = spark.read.format(stage.kind).load(stage.location)
    return raw.select(*match_by_name(raw, stage.schema), file_name(), file_size(), F.lit(False).alias("_broken"))


def staged_files(spark: SparkSession, location: str | list[str]) -> DataFrame:
    """(_FILE_NAME, _FILE_SIZE) of the files of a place, also of those without a row. Only the listing is read."""
    return spark.read.format("binaryFile").load(location).select(file_name(), file_size())


def rows_by_file_schema(spark: SparkSession, stage: Stage) -> DataFrame:
    """Parquet files, each read with the schema of its own footer; files of one schema are read together.

    Footers are read first, side by side. A value that does not convert to the declared type marks its row; a file that is no Parquet
    gives one marked row of NULLs.
    """
    groups: dict[str, list[str]] = {}
    schemas: dict[str, T.StructType] = {}
    unreadable = []
    files = [(unquote(r["_FILE_NAME"]), r["_FILE_NAME"], r["_FILE_SIZE"]) for r in staged_files(spark, stage.location).collect()]  # the listing

    def footer(path: str) -> T.StructType | None:
        try:
            return spark.read.parquet(path).schema
        except Exception:  # whatever the reader says of a file that it cannot open, the file is skipped and logged
            return None

    with ThreadPoolExecutor(16) as pool:
        found = list(pool.map(lambda f: footer(f[0]), files))
    for (path, name, size), schema in zip(files, found):
        if schema is None:
            unreadable.append((name, size))
        else:
            groups.setdefault(schema.json(), []).append(path)
            schemas[schema.json()] = schema
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in stage.schema]
    out = spark.createDataFrame(unreadable, "_FILE_NAME string, _FILE_SIZE bigint").select(*nothing, "_FILE_NAME", "_FILE_SIZE", F.lit(True).alias("_broken"))
    for key, paths in groups.items():
        have = {f.name.lower(): f for f in schemas[key]}
        values, broken = [], F.lit(False)
        for f in stage.schema:
            given = have.get(f.name.lower())
            if given is None:
                values.append(F.lit(None).cast(f.dataType).alias(f.name))
                continue
            column = F.col(f"`{given.name}`")
            if given.dataType != f.dataType:
                simple = isinstance(given.dataType, T.AtomicType) and isinstance(f.dataType, T.AtomicType)
                typed = column.cast("string").try_cast(f.dataType) if simple else F.lit(None).cast(f.dataType)
                broken = broken | (column.isNotNull() & typed.isNull())
                column = typed
            values.append(column.alias(f.name))
        if not any(f.name.lower() in have for f in stage.schema):
            broken = F.lit(True)
        rows = spark.read.schema(schemas[key]).parquet(*paths).select(*values, file_name(), file_size(), broken.alias("_broken"))
        out = out.unionByName(rows)
    return out


def accept_files(rows: DataFrame, stage: Stage, source_system: str, now: str, pipe: str = "",
                 done: DataFrame | None = None, listing: DataFrame | None = None) -> CopyResult:
    """Rows of the clean files and one log row per file, with ``listing`` also for files without rows.

    A file with any broken row is skipped whole. Files that ``done`` logs as loaded are left out.
    """
    files = rows.groupBy("_FILE_NAME").agg(F.count("*").alias("n"), F.count_if("_broken").alias("bad"), F.max("_FILE_SIZE").alias("size"))
    if listing is not None:
        files = listing.join(files, "_FILE_NAME", "left").select(
            "_FILE_NAME", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0)).alias("bad"), F.col("_FILE_SIZE").alias("size"))
    if done is not None:
        loaded = done.where("STATUS = 'LOADED'").select(F.col("FILE_PATH").alias("_FILE_NAME"))
        rows, files = rows.join(loaded, "_FILE_NAME", "left_anti"), files.join(loaded, "_FILE_NAME", "left_anti")
    skipped = files.where("bad > 0").select("_FILE_NAME")
    kept = rows.join(skipped, "_FILE_NAME", "left_anti").drop("_broken", "_FILE_SIZE").withColumn("_LOADED_AT", at(now))
    clean = F.col("bad") == 0
    log = files.select(
        row_id(F.col("_FILE_NAME"), F.lit(now)).alias("INGESTION_ID"),
        F.element_at(F.split("_FILE_NAME", "/"), -1).alias("FILE_NAME"), F.col("_FILE_NAME").alias("FILE_PATH"),
        F.lit(stage.location).alias("STAGE_NAME"), F.lit(source_system).alias("SOURCE_SYSTEM"), F.lit(stage.kind).alias("FILE_FORMAT"),
        F.col("size").alias("FILE_SIZE_BYTES"), F.col("n").alias("ROW_COUNT"), F.col("n").alias("ROWS_PARSED"),
        F.when(clean, F.col("n")).otherwise(0).cast("bigint").alias("ROWS_LOADED"), F.col("bad").alias("ERRORS_SEEN"),
        F.when(~clean, F.concat(F.col("bad").cast("string"), F.lit(" rows do not fit the schema"))).alias("FIRST_ERROR_MESSAGE"),
        F.when(clean, "LOADED").otherwise("SKIPPED").alias("STATUS"), F.lit(pipe).alias("PIPE_NAME"),
        at(now).alias("LOAD_START_TS"), at(now).alias("LOAD_END_TS"), at(now).alias("CREATED_AT"),
    )
    return CopyResult(kept, log)


def copy_into(spark: SparkSession, stage: Stage, source_system: str, now: str, pipe: str = "",
              done: DataFrame | None = None) -> CopyResult:
    return accept_files(staged_rows(spark, stage), stage, source_system, now, pipe, done, staged_files(spark, stage.location))


def copy_to_table(spark: SparkSession, stage: Stage, tables: TableFolder, name: str, source_system: str, now: str,
                  batch: int) -> DataFrame:
    """Append the clean files of a stage to a table and log them; the log makes a later run load nothing twice."""
    result = copy_into(spark, stage, source_system, now, done=tables.read(LOG, before_batch=batch))
    tables.append(name, result.rows, batch)
    tables.append(LOG, result.log, batch)
    return tables.read(name)
