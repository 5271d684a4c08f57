"""Balanced contiguous shards: global prefix sums of byte sizes from per-range totals, cut at equal targets.

All rows stand in one order, by the hash of their text, then key: so equal texts are neighbours. Rows are dealt to ranges
of that order, each range sums up its own sizes, and the totals of the ranges before give every row the bytes before it in the
whole table. A row goes to the shard in whose share of the bytes its middle lies. A group of equal texts goes as a whole where its first row
goes, unless it has more than 1 / ``WHOLE`` of a shard's bytes: such groups are cut like other rows. So a shard differs from its share by
at most that part and half a row at either end. Shards are stretches of the order, so the slot of a row is its place less that of the shard's first row.

Only (key, size, checksum, hash) move, once. The driver gets one row a range, one a shard and the groups above the bound, of
which there are at most shards * ``WHOLE``. A third of all rows of one text, or of one key, is dealt to as many ranges as any other third, since the
order goes on by key and number of the row.

Defined cases: null texts have no bytes and belong with empty ones; a null key comes first among equal texts; repeated rows are
rows of their own; texts of any length are whole, one longer than a shard's share has a shard that is larger; there may be fewer
rows than shards, then some shards are empty; an empty table gives an empty table; columns with the name of a new one are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named, stored, without
from .ranges import AT, BEFORE, PART, RUN, in_order, totals

WHOLE = 32
ADDED = ("size", "text_crc32", "shard", "slot")


def assign_shards(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text", overhead: int = 16, keep_text: bool = False) -> DataFrame:
    """``df`` with ``size`` (bytes of the text and ``overhead``), ``text_crc32``, ``shard`` from 0 and ``slot`` (place in the shard, from 0)."""
    if shards < 1 or overhead < 1:
        raise ValueError("shards and overhead are 1 or more")
    body = F.coalesce(named(text).cast("string"), F.lit(""))
    sized = stored(df.select(
        *without(df, *ADDED, *([] if keep_text else [text])), (F.octet_length(body).cast("long") + overhead).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.sha2(body.cast("binary"), 256).alias("__same"), named(key).alias("__key"),
        F.monotonically_increasing_id().alias("__row")), "shards")
    names = [c for c in sized.columns if not c.startswith("__")]
    total = sized.agg(F.sum("size")).first()[0] or 0
    groups = sized.groupBy("__same").agg(F.sum("size").alias("bytes"))
    large = groups.filter(F.col("bytes") * (shards * WHOLE) > total).select("__same").withColumn("__large", F.lit(True))
    ordered = in_order(sized, [F.col("__same"), F.col("__key").asc_nulls_first(), F.col("__row")], "shards-ordered", weight="size", run="__same")

    # What stands before each range, and where the run begins that it goes on with.
    rows = before = 0
    last, began, shift = None, 0, []
    for part in totals(ordered, "size", "__same"):
        goes_on = part["first"] == last
        shift.append((part[PART], rows, before, part["first"], began if goes_on else before))
        if not (goes_on and part["last"] == last):  # else the range is one run that began earlier
            began = before + part["began"]
        last, rows, before = part["last"], rows + part["n"], before + part["total"]
    table = df.sparkSession.createDataFrame(shift, f"{PART} int, __rows long, __bytes long, __first string, __began long")
    own = F.col("__bytes") + F.col(BEFORE)
    group = F.when(F.col("__same") == F.col("__first"), F.col("__began")).otherwise(F.col("__bytes") + F.col(RUN))
    start = F.when(F.col("__large"), own).otherwise(group)
    placed = ordered.join(F.broadcast(table), PART).join(F.broadcast(large), "__same", "left").select(
        *map(named, names), (F.col("__rows") + F.col(AT)).alias("__place"), (start * 2 + F.col("size")).cast("decimal(20,0)").alias("__twice"))
    # whole numbers only: no quotient is rounded
    placed = placed.withColumn("shard", F.expr(f"cast(__twice * {shards} div {max(2 * total, 1)} as int)")).drop("__twice")
    firsts = F.broadcast(placed.groupBy("shard").agg(F.min("__place").alias("__head")))  # a row a shard
    return placed.join(firsts, "shard").select(*map(named, names), "shard", (F.col("__place") - F.col("__head")).alias("slot"))


def write_shards(df: DataFrame, shards: int, path: str, key: str = "doc_id", text: str = "text", files: int = 1) -> None:
    """The rows with their texts as Parquet, a folder a shard (``shard=k``), each of ``files`` files sorted by slot."""
    placed = assign_shards(df, shards, key, text, keep_text=True)
    parted = placed.repartitionByRange(shards * files, "shard", "slot").sortWithinPartitions("shard", "slot")
    parted.write.partitionBy("shard").parquet(path)
