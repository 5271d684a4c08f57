"""Helpers shared by the operators: columns added by Arrow batches, document identity, tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import stored  # noqa: F401 - for the operators

# Texts handled at once inside a task, in characters. Bounds memory; never changes a result.
CHUNK_CHARS = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def named(column: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def without(df: DataFrame, *names: str) -> list[Column]:
    """The columns of ``df`` but for those whose name equals one of ``names``, whatever the case."""
    gone = {n.lower() for n in names}
    return [named(c) for c in df.columns if c.lower() not in gone]


def chunks(sizes: list[int], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes add up to ``most`` at the most, or one larger item."""
    start = total = 0
    for at, size in enumerate(sizes):
        if at > start and total + size > most:
            yield start, at
            start, total = at, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def map_in_arrow(df: DataFrame, fn: Callable, out: T.StructType) -> DataFrame:
    """``mapInArrow`` for columns of any name: ``fn`` sees and gives columns by position, named c0, c1 and so on."""
    plain = T.StructType([T.StructField(f"c{k}", f.dataType, True) for k, f in enumerate(out.fields)])
    return df.toDF(*(f"c{k}" for k in range(len(df.columns)))).mapInArrow(fn, plain).toDF(*out.names)


def by_place(arrays: list, schema: pa.Schema) -> pa.RecordBatch:
    """A batch of these columns, named by place, in the types of ``schema``."""
    cast = [c.cast(f.type) if c.type != f.type else c for c, f in zip(arrays, schema, strict=True)]
    return pa.RecordBatch.from_arrays(cast, [f"c{k}" for k in range(len(cast))])


def add_columns(df: DataFrame, text: str, fields: T.StructType, fn: Callable[[list], list], keep_text: bool = True) -> DataFrame:
    """``df`` with columns computed from one text column in Arrow batches, with no shuffle.

    ``fn`` takes a list of texts (None for null) and returns one Arrow array per field. A column of
    ``df`` that has the name of a new field is replaced. All other columns pass through unchanged.
    """
    given = "__text"
    while given in df.columns:
        given += "_"
    drop = [f.name for f in fields] + ([] if keep_text else [text])
    kept = without(df, *drop)
    source = df.select(*kept, named(text).cast("string").alias(given))
    out = T.StructType([*source.schema.fields[:-1], *fields])
    schema = to_arrow_schema(out)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            sizes = pa.compute.fill_null(pa.compute.utf8_length(texts), 0).to_pylist()
            for lo, hi in chunks(sizes):
                part = batch.slice(lo, hi - lo)
                new = fn(part.column(part.num_columns - 1).to_pylist())
                yield by_place([*part.columns[:-1], *new], schema)

    return map_in_arrow(source, rows, out)


def bucket_of_fold(doc_id: Column) -> Column:
    """The fold 0, 1 or 2 of a document; fold 1 is held out of training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(0))


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "documents").select(*(columns or ("doc_id", "text")))
