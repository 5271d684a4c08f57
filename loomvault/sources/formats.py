"""Readers for landed files, and stages that name a place with a format."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import at

# fixed values: text that stands for NULL in delimited files
NULL_TOKENS = ("NULL", "null", "", "NA", "N/A")



def file_name() -> Column:
    return F.col("_metadata.file_path").alias("_FILE_NAME")


def file_size() -> Column:
    return F.col("_metadata.file_size").alias("_FILE_SIZE")


def as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def typed(text: DataFrame, schema: T.StructType, strict: bool) -> DataFrame:
    """Null tokens to NULL, then the declared types; a value that does not convert marks its row."""
    cleaned = {f.name: F.when(~F.trim(F.col(f.name)).isin(*NULL_TOKENS), F.trim(F.col(f.name))) for f in schema}
    converted = {n: c.try_cast(schema[n].dataType) for n, c in cleaned.items()}
    out = [converted[f.name].alias(f.name) for f in schema]
    others = [F.col(c) for c in text.columns if c not in cleaned]
    if strict:
        broken = F.lit(False)
        for f in schema:
            broken = broken | (cleaned[f.name].isNotNull() & converted[f.name].isNull())
        out.append(broken.alias("_broken"))
    return text.select(*out, *others)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", strict: bool = False,
                   by_name: bool = False) -> DataFrame:
    """Delimited text with a header line. Short rows are padded with NULL, extra fields are dropped.

    By position, headers are skipped unread. ``by_name`` matches the header names of each file to the
    schema whatever their order and case; a column that a file lacks is NULL. ``strict`` adds
    ``_broken`` for rows with a value that does not convert, and for all rows of a file whose header
    has no name of the schema.
    """
    options = {
        "header": "true", "sep": sep, "quote": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
        "mode": "PERMISSIVE",
    }
    if not by_name:
        text = spark.read.options(**options).schema(as_text(schema)).csv(path).select("*", file_name())
        return typed(text, schema, strict)
    headers = file_headers(spark, path, sep)
    width = headers.agg(F.max(F.size("_names"))).first()[0] or 1
    places = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    fields = spark.read.options(**options).schema(places).csv(path).select(F.array(*places.names).alias("_fields"), file_name(), file_size())
    fields = fields.join(headers, "_FILE_NAME")
    text = fields.select(*[
        F.get("_fields", F.array_position("_names", f.name.lower()).cast("int") - 1).alias(f.name) for f in schema
    ], "_FILE_NAME", "_FILE_SIZE", F.arrays_overlap("_names", F.array(*[F.lit(f.name.lower()) for f in schema])).alias("_fits"))
    out = typed(text, schema, strict)
    return (out.withColumn("_broken", F.col("_broken") | ~F.col("_fits")) if strict else out.drop("_FILE_SIZE")).drop("_fits")


def file_headers(spark: SparkSession, path: str | list[str], sep: str) -> DataFrame:
    """(_FILE_NAME, _names): the lower-case header names of each file, from the first line of its first block."""
    lines = spark.read.text(path).select("value", file_name(), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"))
    first = lines.where((F.col("at") == 0) & (F.trim("value") != "")).groupBy("_FILE_NAME").agg(F.min_by("value", "id").alias("line"))
    parts = F.split(F.regexp_replace("line", "\ufeff", ""), re.escape(sep), -1)
    return first.select("_FILE_NAME", F.transform(parts, lambda n: F.lower(F.trim(F.regexp_replace(F.trim(n), '^"|"$', "")))).alias("_names"))


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False,
              strict: bool = False) -> DataFrame:
    """JSON documents or arrays of them; arrays become rows, NULL members stay.

    One document or array per line can be read in splits; ``multi_line`` is for files that hold a
    single document or array spread over lines, each of which one task has to parse whole. With a
    schema, a document that is no JSON gives no row, or with ``strict`` a row of NULLs that is marked ``_broken``. A value of
    another type is NULL and not marked; ``read_json_by_name`` marks it.
    """
    if schema is None:
        reader = spark.read.option("multiLine", str(multi_line).lower()).option("mode", "PERMISSIVE")
        return reader.json(path).select("*", file_name())
    documents = spark.read.text(path, wholetext=multi_line).where(F.trim("value") != "").select(
        F.from_json("value", T.ArrayType(schema)).alias("_rows"), file_name())  # a document alone is an array of one
    if not strict:
        return documents.select(F.explode("_rows").alias("_row"), "_FILE_NAME").select("_row.*", "_FILE_NAME")
    broken = F.array(F.lit(None).cast(schema))
    marked = documents.select(F.explode(F.coalesce("_rows", broken)).alias("_row"), "_FILE_NAME", F.col("_rows").isNull().alias("_broken"))
    return marked.select("_row.*", "_FILE_NAME", "_broken")


def read_json_by_name(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """One JSON document or array per line, member names matched to the schema whatever their case.

    ``_broken`` marks a line that is no JSON object and a member that does not convert.
    """
    members = "map<string,string>"
    lines = spark.read.text(path).where(F.trim("value") != "").select("value", file_name(), file_size())
    many = F.from_json("value", f"array<{members}>")
    nothing = F.array(F.lit(None).cast(members))
    parsed = F.when(F.startswith(F.trim("value"), F.lit("[")), F.coalesce(many, nothing)).otherwise(F.array(F.from_json("value", members)))
    rows = lines.select(F.explode(parsed).alias("_row"), "_FILE_NAME", "_FILE_SIZE")
    out, broken = [], F.col("_row").isNull()
    for f in schema:
        text = F.get(F.filter(F.map_entries("_row"), lambda e: F.lower(e["key"]) == f.name.lower()), F.lit(0))["value"]
        if isinstance(f.dataType, T.VariantType):
            value = F.try_parse_json(text)
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            value = F.from_json(text, f.dataType)
        else:
            value = text.try_cast(f.dataType)
        out.append(value.alias(f.name))
        broken = broken | (text.isNotNull() & value.isNull())
    return rows.select(*out, "_FILE_NAME", "_FILE_SIZE", broken.alias("_broken"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Needs Spark's avro module on the class path; says so where it is missing."""
    try:
        return spark.read.format("avro").load(path)
    except AnalysisException as missing:
        raise RuntimeError("the avro module is not on the class path") from missing


@dataclass(frozen=True)
class Stage:
    """A place and the format of its files. The scheme of the location is Spark's business."""

    location: str
    kind: str  # csv_pipe | csv_comma | json | parquet | avro
    schema: T.StructType | None = None


SEPARATORS = {"csv_pipe": "|", "csv_comma": ","}


def read_stage(spark: SparkSession, stage: Stage, loaded_at: str, sub_path: str = "") -> DataFrame:
    """Staged rows with the file they come from, their order in the file, and the load time."""
    path = f"{stage.location.rstrip('/')}/{sub_path}".rstrip("/")
    if stage.kind in SEPARATORS:
        rows = read_delimited(spark, path, stage.schema, SEPARATORS[stage.kind])
    elif stage.kind == "json":
        rows = read_json(spark, path, stage.schema)
    elif stage.kind == "parquet":
        reader = spark.read.schema(stage.schema) if stage.schema else spark.read
        rows = reader.parquet(path).select("*", F.col("_metadata.file_path").alias("_FILE_NAME"))
    elif stage.kind == "avro":
        rows = read_avro(spark, path).select("*", F.col("_metadata.file_path").alias("_FILE_NAME"))
    else:
        raise ValueError(f"unknown format {stage.kind}")
    return number_file_rows(rows).withColumn("_LOADED_AT", at(loaded_at))


def number_file_rows(rows: DataFrame) -> DataFrame:
    """Row number inside each file, without bringing a file's rows into one task.

    Spark numbers rows by (partition, position). Counting rows per file and partition gives each
    partition's offset in its file; only those counts are ordered. A file is cut into partitions in
    the order of its bytes, but partitions are packed by size, so the order comes from the block start.
    """
    tagged = rows.withColumns({"_id": F.monotonically_increasing_id()})
    # Position inside the partition is the low 33 bits of the id; one file's rows are consecutive there.
    spans = tagged.groupBy("_FILE_NAME", F.shiftright("_id", 33).alias("_part")).agg(
        F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_FILE_NAME").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    joined = tagged.withColumn("_part", F.shiftright("_id", 33)).join(offsets, ["_FILE_NAME", "_part"])
    return joined.withColumn("_FILE_ROW_NUMBER", F.col("_before") + F.col("_id") - F.col("_first") + 1).drop("_id", "_part", "_first", "_before")
