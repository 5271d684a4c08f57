"""Operators over versioned rows: latest, earliest, previous, next, as-of, intervals."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import end_of_time
from .segments import SEGMENT, cut_points, segmented, with_edges
from .sizes import dealt

SORTED_BYTES = 1 << 20  # of stored data for each partition whose rows are sorted; a stored row becomes several versions


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole latest row per key. Partial aggregation keeps one candidate per key and task."""
    return _extreme_per_key(df, key, order, F.max_by)


def earliest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole earliest row per key."""
    return _extreme_per_key(df, key, order, F.min_by)


def _extreme_per_key(df, key, order, pick) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in df.columns if c not in keys]
    ordering = F.struct(*order) if len(order) > 1 else F.col(order[0])
    picked = df.groupBy(*keys).agg(pick(F.struct(*payload), ordering).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def previous_of(df: DataFrame, key: str, order: Sequence[str], columns: dict[str, str],
                cuts: DataFrame | None = None) -> DataFrame:
    """Add the previous row's values within a key; ``columns`` maps new name -> source column.

    Here and below ``cuts`` are the points at which keys are cut into segments, see ``segments.cut_points``;
    by default those of the rows themselves. They change the plan, never the result.
    """
    return _neighbour(df, key, order, columns, backwards=False, cuts=cuts)


def next_of(df: DataFrame, key: str, order: Sequence[str], columns: dict[str, str],
            cuts: DataFrame | None = None) -> DataFrame:
    """Add the next row's values within a key."""
    return _neighbour(df, key, order, columns, backwards=True, cuts=cuts)


def _neighbour(df, key, order, columns, backwards, cuts) -> DataFrame:
    rows, cut = segmented(df, key, order[0], cut_points(df, key, order[0]) if cuts is None else cuts)
    sources = list(dict.fromkeys(columns.values()))
    near = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(sources)])
    reach, pick = (F.lead, F.min_by) if backwards else (F.lag, F.max_by)
    inside = Window.partitionBy(key, SEGMENT).orderBy(*order)
    ends = cut.groupBy(key, SEGMENT).agg(pick(near, F.struct(*order)).alias("_end"))
    across = Window.partitionBy(key).orderBy(SEGMENT)  # one row per segment of a key
    edges = ends.select(key, SEGMENT, reach("_end").over(across).alias("_edge")).where("_edge is not null")
    found = with_edges(rows.withColumn("_near", reach(near).over(inside)), key, edges).withColumn("_near", F.coalesce("_near", "_edge"))
    return found.select(*df.columns, *[F.col(f"_near.v{sources.index(src)}").alias(new) for new, src in columns.items()])


def carry_forward(df: DataFrame, key: str, instant: str, columns: Sequence[str],
                  cuts: DataFrame | None = None) -> DataFrame:
    """Replace each column by its last non-null value at or before the row's instant."""
    rows, cut = segmented(df, key, instant, cut_points(df, key, instant) if cuts is None else cuts)
    so_far = (
        Window.partitionBy(key, SEGMENT).orderBy(instant)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ends = cut.groupBy(key, SEGMENT).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(instant))).alias(f"_end_{c}") for c in columns]
    )
    before = Window.partitionBy(key).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    edges = ends.select(key, SEGMENT, *[F.last(f"_end_{c}", ignorenulls=True).over(before).alias(f"_edge_{c}") for c in columns])
    own = rows.withColumns({f"_own_{c}": F.last(c, ignorenulls=True).over(so_far) for c in columns})
    filled = {c: F.coalesce(f"_own_{c}", f"_edge_{c}") for c in columns}
    return with_edges(own, key, edges).withColumns(filled).select(*df.columns)


def drop_repeats(df: DataFrame, key: str, instant: str, mark: str, ties: Sequence[str] = (),
                 seed: str | None = None, cuts: DataFrame | None = None, mark_of: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """Keep a row only where ``mark`` differs from the previous row of the key.

    Rows of one key with the same instant count once: the first by ``ties`` stays. ``seed`` names a
    column with the mark that precedes the key's first row, NULL where there is none. With ``mark_of`` the rows have no mark yet:
    it is made behind the exchange, and the result has it as its last column.
    """
    order = [instant, *[t for t in ties if t != mark], mark]
    rows, cut = segmented(df, key, instant, cut_points(df, key, instant) if cuts is None else cuts)
    columns = df.columns
    if mark_of is not None:
        rows, cut = (some.repartition(F.col(key), F.col(SEGMENT)).withColumn(mark, mark_of(df)) for some in (rows, cut))
        columns = [*columns, mark]
    inside = Window.partitionBy(key, SEGMENT).orderBy(*order)
    here = F.struct(F.col(mark).alias("mark"))

    def once(some: DataFrame) -> DataFrame:  # equal instants once, NULL too
        numbered = some.withColumns({"_before": F.lag(instant).over(inside), "_nth": F.row_number().over(inside)})
        return numbered.where((F.col("_nth") == 1) | ~F.col("_before").eqNullSafe(F.col(instant)))

    single = once(rows)
    ends = once(cut.select(key, SEGMENT, *order)).groupBy(key, SEGMENT).agg(F.max_by(here, F.struct(instant)).alias("_end"))
    edges = ends.select(key, SEGMENT, F.lag("_end").over(Window.partitionBy(key).orderBy(SEGMENT)).alias("_edge")).where("_edge is not null")
    marked = with_edges(single.withColumn("_seen", F.lag(here).over(inside)), key, edges).withColumn("_seen", F.coalesce("_seen", "_edge"))
    before, known = F.col("_seen.mark"), F.col("_seen").isNotNull()
    if seed is not None:
        before, known = F.when(known, before).otherwise(F.col(seed)), known | F.col(seed).isNotNull()
    return marked.where(~known | ~before.eqNullSafe(F.col(mark))).select(*columns)


def newest_kept(df: DataFrame, key: str, instant: str, versions: Mapping[str, tuple[Callable[[DataFrame], Column], Sequence[str]]],
                cuts: DataFrame | None = None) -> DataFrame:
    """(key, <name> ...): for each name its columns in the newest row that ``drop_repeats`` keeps by its mark, as one struct.

    All marks are made behind one exchange. A segment of a key is reduced to one row: where its last run of equal marks starts, and, for
    cut keys only, its first and last mark, which tell whether that run began in an earlier segment. The struct is NULL where that row has no instant.
    """
    rows, _ = segmented(df, key, instant, cut_points(df, key, instant) if cuts is None else cuts)
    made = dealt(rows, SORTED_BYTES, key, SEGMENT).select(key, SEGMENT, instant, *[
        F.struct(mark_of(df).alias("_mark"), *payload).alias(name) for name, (mark_of, payload) in versions.items()])
    single = made.groupBy(key, SEGMENT, instant).agg(*[F.min(name).alias(name) for name in versions])  # equal instants once, NULL too
    inside, at_instant = Window.partitionBy(key, SEGMENT).orderBy(instant), F.struct(instant)
    started = single.withColumns({f"_new_{name}": ~F.col(f"{name}._mark").eqNullSafe(F.lag(f"{name}._mark").over(inside)) for name in versions})
    ends = []
    for name, (_, payload) in versions.items():
        new, mark = F.col(f"_new_{name}"), F.when(F.col(SEGMENT) > 0, F.col(f"{name}._mark"))
        row = F.struct(F.col(instant).isNotNull().alias("dated"), *[F.col(f"{name}.{c}").alias(c) for c in payload])
        ends += [F.max_by(F.when(new, row), F.when(new, at_instant)).alias(f"_row_{name}"), (F.count_if(new) == 1).alias(f"_one_{name}"),
                 F.min_by(mark, at_instant).alias(f"_first_{name}"), F.max_by(mark, at_instant).alias(f"_last_{name}")]
    across = Window.partitionBy(key).orderBy(SEGMENT)
    begun = started.groupBy(key, SEGMENT).agg(*ends).withColumns({
        f"_begun_{name}": ~F.col(f"_one_{name}") | F.lag(F.lit(True)).over(across).isNull()
        | ~F.lag(f"_last_{name}").over(across).eqNullSafe(F.col(f"_first_{name}")) for name in versions})
    kept = begun.groupBy(key).agg(*[F.max_by(f"_row_{name}", F.when(F.col(f"_begun_{name}"), F.col(SEGMENT))).alias(name) for name in versions])
    return kept.select(key, *[
        F.when(F.col(f"{name}.dated"), F.struct(*[F.col(f"{name}.{c}").alias(c) for c in payload])).alias(name) for name, (_, payload) in versions.items()])


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
              columns: Sequence[str], cuts: DataFrame | None = None) -> DataFrame:
    """For each left row the latest right row with ``right_time <= left_time``.

    Both sides go through one exchange as a single stream of rows; nothing is compared pairwise.
    Right rows sharing an instant must be unique per key. A NULL key matches nothing: such left rows
    take NULLs without passing through the window.
    """
    loose = left.where(F.col(key).isNull()).select("*", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in (right_time, *columns)])
    left, right = left.where(F.col(key).isNotNull()), right.where(F.col(key).isNotNull())
    carried = F.struct(F.col(right_time), *columns)
    left_part = left.select(F.struct(*left.columns).alias("_left"), F.col(key), F.col(left_time).alias("_at"))
    right_part = right.select(F.col(key), F.col(right_time).alias("_at"), carried.alias("_right"))
    stream = left_part.unionByName(right_part, allowMissingColumns=True)
    matched = carry_forward(stream, key, "_at", ["_right"], cuts).where("_left is not null")
    return matched.select("_left.*", *[F.col(f"_right.{c}") for c in (right_time, *columns)]).unionAll(loose)


def scd2_intervals(df: DataFrame, key: str, instant: str, cuts: DataFrame | None = None) -> DataFrame:
    """VALID_FROM / VALID_TO / IS_CURRENT for each version of a key."""
    with_next = next_of(df, key, [instant], {"_next": instant}, cuts)
    return with_next.select(
        *df.columns,
        F.col(instant).alias("VALID_FROM"),
        F.coalesce("_next", end_of_time()).alias("VALID_TO"),
        F.col("_next").isNull().alias("IS_CURRENT"),
    )
