"""Ordered work on a key's rows, in stretches of time that one task can hold.

An ordered window over a key puts all rows of the key into one task. Here every key's rows are cut into segments of time; windows
run inside (key, segment), and the edge between segments is carried over by one row per segment (a segmented scan).

The cuts come from a sample that the data itself decides: a (key, instant) is a sampled point if its hash is divisible by
``one_in``. A key with two segments' worth of points is cut at every ``POINTS``-th of them, other keys are not, so a segment has about ``one_in *
POINTS`` distinct instants however many rows the key has. The sample is part of the plan: nothing runs while a frame is built, a
retried task finds the same cuts, and the plan is the same at every size. Where no key is cut, the join with
the cuts and all work on edges fall away at run time, as they meet an empty side.

``one_in`` grows with the bytes scanned, so that the cuts, which are broadcast, stay below ``MOST_CUTS`` numbers in all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizes import scanned_bytes

SEGMENT = "_segment"
ONE_IN = 1 << 16
POINTS = 16
MOST_CUTS = 1 << 20
MOST_PER_KEY = 1 << 12  # cuts of one key that its rows are compared with
_KEY, _CUTS = "_cut_key", "_cuts"


def cut_points(df: DataFrame, key: str, instant: str, one_in: int | None = None, points: int = POINTS) -> DataFrame:
    """(key, cuts): the instants at which a key is cut, ascending, for the keys that are cut."""
    if one_in is None:
        # every row takes a byte of the scan at least
        one_in = max(ONE_IN, (scanned_bytes(df) or 0) // (MOST_CUTS * points))
    sampled = df.select(F.col(key).alias(_KEY), F.col(instant).alias("_at")).where(F.pmod(F.xxhash64(_KEY, "_at"), F.lit(one_in)) == 0)
    each = sampled.groupBy(_KEY).agg(F.array_sort(F.collect_set("_at")).alias("_points")).where(F.size("_points") >= 2 * points)
    step = F.greatest(F.lit(points), F.ceil(F.size("_points") / F.lit(MOST_PER_KEY)))
    return each.select(_KEY, F.filter("_points", lambda p, i: i % step == step - 1).alias(_CUTS))


def segmented(df: DataFrame, key: str, instant: str, cuts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``df`` with the number of the segment of each row: 0 where the key is not cut, else 1, 2, ... ascending with time.

    Rows with equal instants share a segment; those without one are in the first. NULL is a key too. The second frame has the rows
    of cut keys only: an inner join, so that nothing below it runs where no key is cut.
    """
    same = F.col(key).eqNullSafe(F.col(_KEY))
    number = _segment_of(F.col(_CUTS), F.col(instant))
    every = df.join(F.broadcast(cuts), same, "left").withColumn(SEGMENT, F.when(F.col(_CUTS).isNull(), 0).otherwise(number))
    cut = df.join(F.broadcast(cuts), same).withColumn(SEGMENT, number)
    return every.drop(_KEY, _CUTS), cut.drop(_KEY, _CUTS)


def _segment_of(cuts: Column, value: Column, block: int = 64) -> Column:
    """1 + number of cuts below the value: find the block first, then look inside it."""
    heads = F.filter(F.sequence(F.lit(1), F.size(cuts), F.lit(block)), lambda i: F.get(cuts, i - 1) < value)
    start = F.greatest(F.size(heads) - 1, F.lit(0)) * block
    inside = F.size(F.filter(F.slice(cuts, start + 1, F.lit(block)), lambda c: c < value))
    return start + inside + 1


def with_edges(rows: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    """Rows joined with the edge of their segment; ``edges`` holds key, segment and more, for cut keys only."""
    return rows.join(edges.withColumnsRenamed({key: "_edge_key", SEGMENT: "_edge_segment"}), (
        F.col(SEGMENT) == F.col("_edge_segment")) & F.col(key).eqNullSafe(F.col("_edge_key")), "left").drop("_edge_key", "_edge_segment")
