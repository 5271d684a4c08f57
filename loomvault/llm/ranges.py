"""Rows in one global order: dealt to key ranges, numbered inside each, and shifted by the totals of the ranges before."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import by_place, map_in_arrow, stored

PART, AT, BEFORE, RUN = "__part", "__at", "__before", "__run"


def in_order(df: DataFrame, by: list[Column], label: str, weight: str | None = None, run: str | None = None) -> DataFrame:
    """``df`` stored in the order ``by``, with the number of its range and what stands before each row in that range.

    ``__at`` counts rows, ``__before`` sums ``weight`` (both without the row itself), and ``__run`` is ``__before`` of the first
    row of the range that has the row's ``run`` with no other between. Ranges ascend with their number. The bounds of ranges come from
    a sample, so the rows are stored: nothing is dealt a second time. ``by`` must tell all rows apart for ranges to split ties.
    """
    names = df.columns
    source = df.repartitionByRange(*by).sortWithinPartitions(*by)
    more = [T.StructField(PART, T.IntegerType()), T.StructField(AT, T.LongType()), T.StructField(BEFORE, T.LongType()), T.StructField(RUN, T.LongType())]
    out = T.StructType([*source.schema.fields, *more])
    schema = to_arrow_schema(out)
    heavy = names.index(weight) if weight else None
    same = names.index(run) if run else None

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        at = before = began = 0
        last = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sizes = np.ones(n, np.int64) if heavy is None else batch.column(heavy).to_numpy(zero_copy_only=False)
            ahead = before + np.cumsum(sizes) - sizes
            starts = ahead
            if same is not None:
                key = batch.column(same)
                fresh = np.ones(n, bool)
                fresh[1:] = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
                fresh[0] = key[0].as_py() != last
                where = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
                starts = np.where(where < 0, began, ahead[np.maximum(where, 0)])
                last, began = key[n - 1].as_py(), int(starts[-1])
            yield by_place([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n)), pa.array(ahead), pa.array(starts)], schema)
            at, before = at + n, int(ahead[-1] + sizes[-1])

    return stored(map_in_arrow(source, number, out), label)


def totals(ordered: DataFrame, weight: str | None = None, run: str | None = None) -> list:
    """One row a range, ascending: its number, rows ``n``, ``total`` weight, first and last ``run`` and where its last run begins."""
    sized = F.count("*") if weight is None else F.sum(weight)
    ends = [F.min_by(run, AT).alias("first"), F.max_by(run, AT).alias("last"), F.max_by(RUN, AT).alias("began")] if run else []
    return ordered.groupBy(PART).agg(F.count("*").alias("n"), sized.alias("total"), *ends).orderBy(PART).collect()
