"""Exact global ranks without a single-task window."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def global_ranks(df: DataFrame, key: str, measures: Mapping[str, Column]) -> tuple[DataFrame, int]:
    """Ascending position and rank of every row for several measures at once.

    Returns (key, <m>_POSITION, <m>_RANK ...) and the number of rows. Positions break ties by
    ``key``, which must be unique. One range exchange on (measure, value, key) splits even a value
    shared by most rows; each range is numbered on its own and shifted by the counts before it.
    Measures keep their types: a value is a struct with one field per type, of which a measure fills one.
    """
    spark = df.sparkSession
    types = {f.name: f.dataType.simpleString() for f in df.select(*[col.alias(name) for name, col in measures.items()]).schema}
    kinds = {kind: f"v{i}" for i, kind in enumerate(dict.fromkeys(types.values()))}
    pairs = F.array(*[
        F.struct(F.lit(name).alias("m"), F.struct(*[
            (col if kind == types[name] else F.lit(None)).cast(kind).alias(field) for kind, field in kinds.items()]).alias("v"))
        for name, col in measures.items()
    ])
    value_type = "struct<" + ",".join(f"{field}:{kind}" for kind, field in kinds.items()) + ">"
    flat = df.select(F.col(key).alias("k"), F.explode(pairs).alias("p")).select("k", "p.m", "p.v")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = flat.repartitionByRange(parts, "m", "v", "k").withColumn("part", F.spark_partition_id())
    inside = Window.partitionBy("part", "m")
    numbered = ranged.select(
        "k", "m", "v", "part",
        F.row_number().over(inside.orderBy("v", "k")).alias("rn"),
        F.rank().over(inside.orderBy("v")).alias("rk"),
    )
    # Range bounds come from a sample, so a second evaluation could cut elsewhere.
    fixed = cut_lineage(numbered)
    stats = (
        fixed.groupBy("m", "part")
        .agg(F.count("*").alias("n"), F.min_by("v", "rn").alias("lo"), F.max_by("v", "rn").alias("hi"), F.max("rk").alias("hi_rk"))
        .collect()  # one row per range and measure
    )
    shifts, total = _shifts(stats)
    table = spark.createDataFrame(shifts, f"m string, part int, before bigint, lo {value_type}, lo_rank bigint")
    placed = fixed.join(F.broadcast(table.withColumnRenamed("lo", "lo_v")), ["m", "part"]).select(
        "k", "m",
        (F.col("rn") + F.col("before")).alias("pos"),
        F.when(F.col("v").eqNullSafe(F.col("lo_v")), F.col("lo_rank")).otherwise(F.col("rk") + F.col("before")).alias("rank"),
    )
    wide = placed.groupBy(F.col("k").alias(key)).agg(*[
        F.max(F.when(F.col("m") == name, F.col(src))).alias(f"{name}_{out}")
        for name in measures for src, out in (("pos", "POSITION"), ("rank", "RANK"))
    ])
    return wide, total


def _shifts(stats) -> tuple[list[tuple], int]:
    """Rows before each range, and the rank of its lowest value if that value began earlier."""
    def same(a, b) -> bool:  # NaN is a value like any other
        return a is not _shifts and all(x == y or x != x and y != y for x, y in zip(a, b))

    out, total = [], 0
    for measure in sorted({s["m"] for s in stats}):
        before, run_value, run_rank = 0, _shifts, 1  # no value equals this one; NULLs are values and come first
        for s in sorted((s for s in stats if s["m"] == measure), key=lambda s: s["part"]):
            lo_rank = run_rank if same(run_value, s["lo"]) else before + 1
            out.append((measure, s["part"], before, s["lo"], lo_rank))
            if not same(s["hi"], s["lo"]):
                run_rank = before + s["hi_rk"]
            else:
                run_rank = lo_rank
            run_value = s["hi"]
            before += s["n"]
        total = before
    return out, total


def ntile_of(position: Column, rows: int, buckets: int) -> Column:
    """Bucket of a 1-based position; the first ``rows % buckets`` buckets hold one row more."""
    size, larger = divmod(rows, buckets)
    head = larger * (size + 1)
    in_head = F.ceil(position / F.lit(size + 1))
    if size == 0:
        return in_head.cast("int")
    in_tail = F.lit(larger) + F.ceil((position - head) / F.lit(size))
    return F.when(position <= head, in_head).otherwise(in_tail).cast("int")


def percent_rank_of(rank: Column, rows: int) -> Column:
    if rows <= 1:
        return F.lit(0.0)
    return (rank - 1).cast("double") / F.lit(float(rows - 1))
