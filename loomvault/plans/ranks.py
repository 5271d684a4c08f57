"""Exact positions and ranks kept up to date from changes, without sorting all rows again.

Rows lie in bins of consecutive (value, key), numbered inside each bin; a small table holds a row per bin with its lower bound, its count and
its end values. A change renumbers the bins it falls in. All other rows keep what is stored: their position is that inside the bin
plus the counts of the bins before. A value shared by many rows lies in several bins, as the key divides it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import _shifts
from ..session import cut_lineage
from ..sources.tables import TableFolder

BIN, SIGN = "BIN", "SIGN"
BINS = 256
GROWN = 3  # times the mean size: a larger bin has all bins cut anew


def _bounds_table(name: str) -> str:
    return f"{name}_bins"


def _numbered(rows: DataFrame) -> DataFrame:
    inside = Window.partitionBy(BIN)
    return rows.select("k", "v", BIN, F.row_number().over(inside.orderBy("v", "k")).alias("rn"), F.rank().over(inside.orderBy("v")).alias("rk"))


def _sizes(numbered: DataFrame) -> DataFrame:
    return numbered.groupBy(BIN).agg(F.count("*").alias("n"), F.min_by("v", "rn").alias("lo"), F.max_by("v", "rn").alias("hi"), F.max("rk").alias("hi_rk"))


def build_ranks(tables: TableFolder, name: str, rows: DataFrame, key: str, value: Column, bins: int = BINS) -> None:
    """Sort all rows once and store them in bins. Keys must be unique; NULLs are values and come first."""
    flat = rows.select(F.col(key).alias("k"), value.alias("v"))
    # bounds of ranges come from a sample, so the rows are fixed before anything is read twice
    ranged = cut_lineage(flat.repartitionByRange(bins, "v", "k").withColumn(BIN, F.spark_partition_id()))
    bounds = ranged.groupBy(BIN).agg(F.min(F.struct("v", "k")).alias("from"))
    tables.replace(name, _numbered(ranged), BIN)
    stored = tables.read(name)
    if stored is None:  # no row, so no bin: any value falls in the first
        one = tables.spark.range(1).select(F.lit(0).alias(BIN), F.lit(0).cast("bigint").alias("n"), *[F.lit(None).cast(flat.schema["v"].dataType).alias(c) for c in ("lo", "hi")],
                                           F.lit(0).alias("hi_rk"))
        first = F.struct(F.lit(None).cast(flat.schema["v"].dataType).alias("v"), F.lit(None).cast(flat.schema["k"].dataType).alias("k"))
        tables.replace(_bounds_table(name), one.withColumn("from", first))
        return
    tables.replace(_bounds_table(name), _sizes(stored).join(bounds, BIN))


def _bin_of(bins: list, value: Column, key: Column, types: dict[str, T.DataType]) -> Column:
    """The last bin whose lower bound is not above (value, key), the first one for anything lower."""
    def bound(b) -> Column:
        return F.struct(*[F.lit(b["from"][c]).cast(types[c]).alias(c) for c in ("v", "k")])
    numbers = F.array(*[F.lit(b[BIN]) for b in bins])
    if len(bins) == 1:
        return numbers[0]
    here = F.struct(value.alias("v"), key.alias("k"))
    return F.get(numbers, F.size(F.filter(F.array(*[bound(b) for b in bins[1:]]), lambda low: low <= here)))


def change_ranks(tables: TableFolder, name: str, changes: DataFrame, key: str, value: Column, batch: int, bins: int = BINS) -> None:
    """Take in rows that came (SIGN 1) and rows that went (SIGN -1, with the value they had). Running a batch again gives the same ranks."""
    for table in (name, _bounds_table(name)):
        tables.begin(table, batch)
    known = tables.read(_bounds_table(name))
    found = known.select(BIN, "from").orderBy(BIN).collect()  # at most ``bins`` rows; bins ascend with their bounds
    types = {f.name: f.dataType for f in known.schema["from"].dataType}
    signed = changes.select(F.col(key).cast(types["k"]).alias("k"), value.cast(types["v"]).alias("v"), SIGN)
    placed = signed.withColumn(BIN, _bin_of(found, F.col("v"), F.col("k"), types))
    touched = [r[0] for r in placed.select(BIN).distinct().collect()]
    if not touched:
        return
    # rows of a key, stored or changed, add up to one where the key has the value now
    stored = tables.read_parts(name, [str(b) for b in touched])
    every = placed if stored is None else placed.unionByName(stored.select("k", "v", F.lit(1).alias(SIGN), BIN))
    left = every.groupBy("k", "v", BIN).agg(F.sum(SIGN).alias("n")).where("n > 0")
    tables.replace_parts(name, _numbered(left), BIN, [str(b) for b in touched])
    now = tables.read_parts(name, [str(b) for b in touched])
    sizes = _sizes(known.select("lo", BIN, "hi_rk").where(F.lit(False)).select(F.col("lo").alias("v"), BIN, F.col("hi_rk").alias("rn"), F.col("hi_rk").alias("rk"))
                   if now is None else now)
    renewed = known.where(F.col(BIN).isin(touched)).select(BIN, "from").join(F.broadcast(sizes), BIN, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    merged = known.where(~F.col(BIN).isin(touched)).unionByName(renewed.select(*known.columns))
    tables.replace(_bounds_table(name), merged)
    largest, total = tables.read(_bounds_table(name)).agg(F.max("n"), F.sum("n")).first()
    if largest > GROWN * -(-total // bins):
        build_ranks(tables, name, tables.read(name).withColumnRenamed("v", "_v_"), "k", F.col("_v_"), bins)


def read_ranks(tables: TableFolder, name: str, key: str, measure: str) -> tuple[DataFrame, int]:
    """(key, <measure>, <measure>_POSITION, <measure>_RANK) of all rows, and their number. Nothing is sorted or exchanged."""
    bins = tables.read(_bounds_table(name))
    v = bins.schema["lo"].dataType
    sized = bins.where("n > 0").select(F.lit(measure).alias("m"), F.col(BIN).alias("part"), "n", *[F.struct(F.col(c).alias("v")).alias(c) for c in ("lo", "hi")], "hi_rk")
    shifts, total = _shifts(sized.collect())  # one row a bin
    stored = tables.read(name)
    if stored is None:
        return tables.spark.createDataFrame([], T.StructType([
            T.StructField(key, bins.schema["from"].dataType["k"].dataType), T.StructField(measure, v),
            T.StructField(f"{measure}_POSITION", T.LongType()), T.StructField(f"{measure}_RANK", T.LongType())])), 0
    kind = T.StructType([T.StructField("m", T.StringType()), T.StructField(BIN, T.IntegerType()), T.StructField("before", T.LongType()),
                         T.StructField("lo", T.StructType([T.StructField("v", v)])), T.StructField("lo_rank", T.LongType())])
    placed = stored.join(F.broadcast(tables.spark.createDataFrame(shifts, kind).drop("m")), BIN)
    rank = F.when(F.col("v").eqNullSafe(F.col("lo.v")), F.col("lo_rank")).otherwise(F.col("rk") + F.col("before"))
    return placed.select(F.col("k").alias(key), F.col("v").alias(measure), (F.col("rn") + F.col("before")).alias(f"{measure}_POSITION"),
                         rank.cast("bigint").alias(f"{measure}_RANK")), total
