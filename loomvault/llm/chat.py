"""Chat formatting in budgeted windows, in DataFrame functions only.

A turn is ``<turn>role``, a line break, the text and ``</turn>`` with a line break. Inside texts and
roles ``\\`` is written ``\\s`` and ``<`` is written ``\\l`` (in roles also the line break ``\\n``), so
no text can hold a mark and all are read back exactly.

The turns of a conversation are cut in blocks of ``BLOCK`` turns by their place in it, whatever their
numbers are. Blocks are handled apart, so that a conversation of any length is spread over tasks. In a
block, running sums of the turns' tokens (words and marks) choose windows: as many turns as the budget
holds, one at least. Each window begins with the system turn of the conversation and up to ``HISTORY``
turns before it, within a share of the budget. Assistant texts are the targets; in the repeated turns
they are masked, so that each is a target once.

Conversations of one block need no places: only their number of rows is counted. The rows of longer
ones are stored, dealt to ranges of (conversation, turn, role, text, row) and counted there; only the
first conversation of a range can have begun in an earlier one, so one row a range carries the places on.

Defined cases: null texts and roles are empty; turns are ordered by (turn, role, text), nulls first;
rows with equal turn numbers, equal rows too, are all kept, in that order, in any number; a turn above the budget gets a window of its
own, whole; a conversation without a system turn has none to repeat; a null conversation id is one
conversation; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import named, stored

BUDGET = 2048
HISTORY = 4
HISTORY_SHARE = 0.25
BLOCK = 256
TURN, END = "<turn>", "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` with the place ``at`` of each in its conversation; 0 throughout where one block holds it, as turns are sorted inside blocks."""
    longer = rows.groupBy("conv_id").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK).select(F.col("conv_id").alias("__c"))
    same = F.col("conv_id").eqNullSafe(F.col("__c"))
    order = ["turn", "role", "text", "__row"]
    # stored first: a task that runs again must find every row under its number, or equal rows could go to two ranges or none
    long = stored(rows.join(longer, same, "left_semi").withColumn("__row", F.monotonically_increasing_id()), "chat-rows")
    ranges = stored(long.repartitionByRange("conv_id", *order).withColumn("__part", F.spark_partition_id()), "chat-ranges")

    # rows of a conversation in earlier ranges: zero but for the first conversation of a range, so one row a range at most
    sizes = ranges.groupBy("conv_id", "__part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    begun = sizes.withColumn("begun", F.sum("n").over(earlier)).filter("begun > 0").select(
        F.col("__part").alias("__p"), F.col("conv_id").alias("__c"), "begun")
    inside = F.row_number().over(Window.partitionBy("conv_id", "__part").orderBy(*order)) - 1
    long = ranges.withColumn("__at", inside).join(F.broadcast(begun), (F.col("__part") == F.col("__p")) & same, "left")
    long = long.select("conv_id", "turn", "role", "text", (F.col("__at") + F.coalesce("begun", F.lit(0))).alias("at"))
    return rows.join(longer, same, "left_anti").withColumn("at", F.lit(0).cast("long")).unionByName(long)


def format_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: ``conv_id``, ``block``, ``window``, ``formatted``, ``repeated`` (turns at its
    beginning that other windows show too) and ``loss`` (start and length of each target, in code points)."""
    rows = df.select(named(conv).alias("conv_id"), named(turn).cast("long").alias("turn"),
                     F.coalesce(named(role).cast("string"), F.lit("")).alias("role"), F.coalesce(named(text).cast("string"), F.lit("")).alias("text"))
    tokens = (F.regexp_count("text", F.lit(r"\S+")) + 3).cast("long")
    turn_of = lambda old: F.struct("at", "turn", "role", "text", tokens.alias("tokens"), F.lit(old).alias("old")).alias("t")
    placed = _placed(rows)
    turns = placed.select("conv_id", F.floor(F.col("at") / BLOCK).alias("block"), turn_of(False))
    # the last turns of a block are also history of the next one
    carried = placed.filter(F.pmod("at", F.lit(BLOCK)) >= max(BLOCK - history, 0)).select(
        "conv_id", (F.floor(F.col("at") / BLOCK) + 1).alias("block"), turn_of(True))
    system = (rows.filter("role = 'system'").groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text")).alias("system")))
    blocks = turns.unionByName(carried).groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("t")).alias("all"))
    blocks = blocks.filter(F.exists("all", lambda t: ~t["old"]))
    blocks = blocks.join(system.withColumnRenamed("conv_id", "__c"), F.col("conv_id").eqNullSafe(F.col("__c")), "left").drop("__c")
    blocks = blocks.withColumn("system_tokens", F.coalesce(F.regexp_count("system.text", F.lit(r"\S+")) + 3, F.lit(0)).cast("long"))
    kept_for = F.floor(F.lit(budget) * HISTORY_SHARE).cast("long")
    room = F.greatest(F.lit(1), F.lit(budget) - F.col("system_tokens") - kept_for)

    # first and last turn of each window, from running sums
    none = F.expr("cast(array() as array<struct<first: int, last: int>>)")
    start = F.struct(F.lit(0).alias("i"), F.lit(0).cast("int").alias("first"), F.lit(0).cast("long").alias("sum"), none.alias("done"))

    def take(state: Column, t: Column) -> Column:
        full = ~t["old"] & (state["i"] > state["first"]) & (state["sum"] + t["tokens"] > F.col("room"))
        closed = F.struct(state["first"].alias("first"), (state["i"] - 1).alias("last"))
        first = F.when(t["old"], state["i"] + 1).when(full, state["i"]).otherwise(state["first"])
        total = F.when(t["old"], F.lit(0).cast("long")).when(full, t["tokens"]).otherwise(state["sum"] + t["tokens"])
        return F.struct((state["i"] + 1).alias("i"), first.alias("first"), total.alias("sum"),
                        F.when(full, F.concat(state["done"], F.array(closed))).otherwise(state["done"]).alias("done"))

    windows = blocks.withColumn("room", room).withColumn("cut", F.aggregate(
        "all", start, take, lambda s: F.concat(s["done"], F.array(F.struct(s["first"].alias("first"), (s["i"] - 1).alias("last"))))))
    windows = windows.select("conv_id", "block", "all", "system", F.posexplode("cut").alias("window", "span"))
    fresh = F.slice("all", F.col("span.first") + 1, F.col("span.last") - F.col("span.first") + 1)
    before = F.slice("all", F.greatest(F.col("span.first") - history + 1, F.lit(1)), F.least(F.lit(history), F.col("span.first")))
    windows = windows.select("conv_id", "block", "window", "system", fresh.alias("fresh"), before.alias("before"))
    # history within its share, the latest turns first; the system turn stands for itself
    tally = F.aggregate(F.reverse("before"), F.struct(F.lit(0).cast("long").alias("sum"), F.lit(True).alias("on"), F.lit(0).alias("n")), lambda s, t: F.struct(
        (s["sum"] + t["tokens"]).alias("sum"), (s["on"] & (s["sum"] + t["tokens"] <= kept_for)).alias("on"),
        (s["n"] + (s["on"] & (s["sum"] + t["tokens"] <= kept_for)).cast("int")).alias("n")), lambda s: s["n"])
    windows = windows.withColumn("n", tally).withColumn("history", F.slice("before", F.size("before") - F.col("n") + 1, F.col("n")))
    same = lambda t: (t["turn"].eqNullSafe(F.col("system.turn")) & (t["role"] == F.col("system.role")) & (t["text"] == F.col("system.text")))
    windows = windows.withColumn("history", F.filter("history", lambda t: F.col("system").isNull() | ~same(t)))
    alone = F.col("system").isNotNull() & ~F.exists("fresh", same)
    plain = lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    lead = F.concat(F.when(alone, F.array(F.struct(F.col("system.role").alias("role"), F.col("system.text").alias("text")))).otherwise(
        F.expr("cast(array() as array<struct<role: string, text: string>>)")), F.transform("history", plain))
    windows = windows.withColumn("lead", lead).withColumn("repeated", F.size("lead"))
    written = F.transform(F.concat("lead", F.transform("fresh", plain)), lambda t: F.struct(
        F.concat(F.lit(TURN), escape_role(t["role"]), F.lit("\n")).alias("open"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("target")))
    windows = windows.withColumn("written", written)
    formatted = F.array_join(F.transform("written", lambda w: F.concat(w["open"], w["body"], F.lit(END))), "")
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).alias("i"), F.expr("cast(array() as array<struct<start: bigint, length: bigint>>)").alias("loss"))
    loss = F.aggregate("written", begin, lambda s, w: F.struct(
        (s["at"] + F.length(w["open"]) + F.length(w["body"]) + len(END)).alias("at"), (s["i"] + 1).alias("i"),
        F.when(w["target"] & (s["i"] >= F.col("repeated")), F.concat(s["loss"], F.array(F.struct(
            (s["at"] + F.length(w["open"])).alias("start"), F.length(w["body"]).cast("long").alias("length"))))).otherwise(s["loss"]).alias("loss")),
        lambda s: s["loss"])
    return windows.select("conv_id", "block", "window", formatted.alias("formatted"), "repeated", loss.alias("loss"))


def read_chats(windows: DataFrame) -> DataFrame:
    """``windows`` with ``turns`` (role, text; repeated turns left out) and ``targets``, read from ``formatted``."""
    parts = F.split("formatted", "(?<=</turn>)\n")
    pieces = F.filter(parts, lambda p: p != "")
    own = F.slice(pieces, F.col("repeated") + 1, F.greatest(F.size(pieces) - F.col("repeated"), F.lit(0)))

    def read(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(len(TURN) + 1), F.length(piece) - len(TURN) - len(END) + 1)
        return F.struct(unescape_role(F.substring_index(inner, "\n", 1)).alias("role"),
                        unescape(F.substring(inner, F.instr(inner, "\n") + 1, F.length(inner))).alias("text"))

    targets = F.transform("loss", lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return windows.withColumn("turns", F.transform(own, read)).withColumn("targets", targets)
