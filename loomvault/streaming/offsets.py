"""Which offsets of a stream have landed: a few intervals for each (topic, partition) instead of the landed rows themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.history import asof_join, next_of, previous_of
from ..operators.segments import cut_points
from ..operators.sizes import dealt

EVENT_BYTES = 16 << 20  # of stored data for each partition of the events of a batch
TOPIC, PARTITION, TOKEN = "_TOPIC_NAME", "_PARTITION_ID", "_OFFSET_TOKEN"
SCHEMA = "lane string, low bigint, high bigint"
TOKENS = f"{TOPIC} string, {PARTITION} bigint, {TOKEN} string"


def with_offset(events: DataFrame) -> DataFrame:
    """Adds ``lane`` (topic and partition) and ``offset``, both NULL for an event whose place in the stream is not a whole number."""
    offset = F.col(TOKEN).try_cast("bigint")
    plain = (F.concat(F.lit(""), offset.cast("string")) == F.col(TOKEN)) & F.col(TOPIC).isNotNull() & F.col(PARTITION).isNotNull()
    return events.withColumns({"lane": F.when(plain, F.concat_ws("/", F.col(PARTITION).cast("string"), TOPIC)), "offset": F.when(plain, offset)})


def each_once(events: DataFrame) -> DataFrame:
    """One event of each lane and offset."""
    placed = events.where("lane is not null")
    return dealt(placed, EVENT_BYTES, "lane", "offset").dropDuplicates(["lane", "offset"])


def not_landed(events: DataFrame, intervals: DataFrame | None, numbered: DataFrame | None = None) -> DataFrame:
    """Events (with lane and offset) that no interval holds, each offset once. Events without an offset all stay.

    An offset is looked up in the last interval that begins at or before it. Events and intervals go through one exchange,
    a lane of any size in segments. ``numbered`` may hold ``each_once`` of the events where that is stored: it is read several times.
    """
    numbered = each_once(events) if numbered is None else numbered
    if intervals is None:  # nothing has landed
        return numbered.unionByName(events.where("lane is null"))
    starts = intervals.select("lane", F.col("low").alias("_low"), F.col("high").alias("_high"))
    found = asof_join(numbered, starts, "lane", "offset", "_low", ["_high"], cut_points(numbered, "lane", "offset"))
    fresh = found.where("_high is null or _high < offset").select(*events.columns)
    return fresh.unionByName(events.where("lane is null"))


def islands(offsets: DataFrame) -> DataFrame:
    """Maximal intervals of consecutive offsets of each lane; (lane, offset) must be distinct."""
    cuts = cut_points(offsets, "lane", "offset")
    before = previous_of(offsets.select("lane", "offset"), "lane", ["offset"], {"_before": "offset"}, cuts)
    around = next_of(before, "lane", ["offset"], {"_after": "offset"}, cuts)
    first = F.col("_before").isNull() | (F.col("_before") < F.col("offset") - 1)
    last = F.col("_after").isNull() | (F.col("_after") > F.col("offset") + 1)
    ends = around.select("lane", "offset", first.alias("first"), last.alias("last")).where("first or last")
    # two rows an interval at the most: the n-th beginning of a lane belongs to the n-th end
    place = Window.partitionBy("lane", "kind").orderBy("offset")
    kinds = ends.select("lane", "offset", F.explode(F.array_compact(F.array(F.when(F.col("first"), "low"), F.when(F.col("last"), "high")))).alias("kind"))
    numbered = kinds.withColumn("n", F.row_number().over(place))
    return numbered.groupBy("lane", "n").agg(*[F.max(F.when(F.col("kind") == k, F.col("offset"))).alias(k) for k in ("low", "high")]).drop("n")


def joined(intervals: DataFrame) -> DataFrame:
    """Intervals of a lane that touch or overlap made one. Works on intervals only, of which a gapless lane has one."""
    order = Window.partitionBy("lane").orderBy("low", "high")
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reach.isNull() | (F.col("low") > reach + 1), 1).otherwise(0)
    grouped = intervals.withColumn("_begins", begins).withColumn("_group", F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy("lane", "_group").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("_group")
