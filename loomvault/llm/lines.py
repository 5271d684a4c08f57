"""Near-duplicate line removal by a join on runs of words, in DataFrame functions only.

The lines of all documents are the parts between line breaks, the words of a line those between spaces.
Two lines are near if they are equal, or if edits of a word (put in, left out or changed) make them equal, of which the longer allows one for
each full ``LEAST`` of its words, ``max_edits`` at the most (None: no other bound). A line
goes if an earlier line, in the order of (key, text hash, place), is near it;
blank lines stay. Every line is judged on the input, not on what is left.

1. Equal lines meet in a minimum of their place; the earliest of them goes on, and is stored with its place.
2. A line gives hashes of some of its runs of ``RUN`` words. In one order of all runs, the first of a line are taken, up to where
   no k edits can touch all those taken: an edit touches only the runs that hold its word, so that is where k + 1 of them lie apart.
   Of two lines with k edits between them, each then has a run taken that the other has too, and the first such run in that order is
   taken in both. k is the most that the line allows with any partner. In the order taken here the most frequent runs of a sample come
   last; the sample decides only how many pairs meet.
3. Each line meets the earliest line of its runs; those that are not settled by it meet all earlier ones. Of the pairs, those go on whose
   lengths differ by no more than the edits allowed, and whose parities of words by no more than two bits an edit.
4. Of these the lines are taken out once, and more parities of their words leave few pairs of lines that have long runs in common only.
   Of those that are left the words are read, and the distance is computed where neither line has more words that the other lacks than edits.
5. The places that stay are gathered per document and the texts cut accordingly.

Lines, the runs that several lines have, pairs, and the lines that go are stored, each by a plan of its own, so that what a step exchanges is gone
from disk before the next begins. The texts move at the end only, by document.

Defined cases: null texts have no line and stay null; an empty text has one blank line; repeated rows
(equal key and text) are one document, in each of the equal rows; null keys come first in the order;
texts and lines of any length are whole; an empty table gives an empty table; columns with the name of
a new column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import named, stored

LEAST = 8
# Words of a run. With k edits at most in 7 k words and more, k + 1 runs always find room in a line.
RUN = 3
# The most frequent runs of one document in SHARE come last: decides only how many lines meet.
OFTEN, SHARE = 4000, 32
# 64 parities of a line's words go with each of its runs, WIDE times as many are compared where two lines meet: decides only how many are read.
WIDE = 4
# How many runs are tried, in eighths of k + 1, before as many as k edits can never touch.
TRIES = (10, 12, 15)


def _words(line: Column) -> Column:
    return F.filter(F.split(line, " "), lambda w: w != "")


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\f\x0b")) == ""


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = named(text).cast("string")
    return docs.select(named(key).alias("__key"), F.hash(F.coalesce(body, F.lit(""))).alias("__mark"), body.alias("__text"))


def _per_doc(docs: DataFrame, per_doc: DataFrame, how: str) -> DataFrame:
    """Documents with the one row that belongs to each; the small side is the hashed one."""
    right = per_doc.withColumnsRenamed({"__key": "__k", "__mark": "__m"}).hint("shuffle_hash")
    return docs.join(right, (F.col("__mark") == F.col("__m")) & F.col("__key").eqNullSafe(F.col("__k")), how).drop("__k", "__m")


def _hashes(line: Column) -> Column:
    return F.transform(_words(line), lambda w: F.xxhash64(w))


# The numbers of all runs in a line, in their order, from the hashes of its words.
RUNS = f"transform(sequence(0, size(h) - {RUN}), i -> shiftrightunsigned(xxhash64({', '.join(f'get(h, i + {j})' for j in range(RUN))}), 27))"


def _often(texts: DataFrame) -> list[int]:
    """The most frequent runs of a sample of the texts."""
    some = texts.filter(F.pmod(F.xxhash64("__text"), F.lit(SHARE)) == 0)
    lines = some.select(F.explode(F.split("__text", "\n", -1)).alias("line")).select(_hashes(F.col("line")).alias("h"))
    runs = lines.select(F.explode(F.expr(f"CASE WHEN size(h) >= {LEAST - 1} THEN array_distinct({RUNS}) END")).alias("x"))
    return [r.x for r in runs.groupBy("x").agg(F.count("*").alias("c")).filter("c > 1").orderBy(F.desc("c"), "x").limit(OFTEN).collect()]


def _keys(often: list[int], most: int | None) -> Column:
    """From the hashes ``h`` of a line's words, the numbers of its first runs, of which k edits cannot touch all.

    k is the most that the line allows with any partner: one of n words has at most n / LEAST edits to a shorter one and
    n / (LEAST - 1) to a longer one.
    """
    edits = f"cast(size(h) div {LEAST - 1} as int)" if most is None else f"least(cast(size(h) div {LEAST - 1} as int), {most})"
    last = f" + CASE WHEN x IN ({', '.join(f'{x}L' for x in often)}) THEN {1 << 61}L ELSE 0L END" if often else ""
    # class, number and place in one value: sorted by it, the runs stand in the one order of all runs
    ordered = f"sort_array(transform({RUNS}, (x, i) -> x * {1 << 24}L + least(i, {(1 << 24) - 1}){last}))"
    # how many runs lie apart: from left to right, each that begins where the one counted last has ended; the count is above bit 32
    places = f"sort_array(transform(slice(s, 1, m), v -> v & {(1 << 24) - 1}L))"
    apart = f"shiftright(aggregate({places}, 0L, (a, p) -> CASE WHEN p >= (a & 4294967295L) THEN (shiftright(a, 32) + 1) * 4294967296L + p + {RUN} ELSE a END), 32)"
    tries = f"transform(array({', '.join(map(str, TRIES))}), f -> cast((f * (k + 1) + 7) div 8 as int))"
    taken = f"aggregate({tries}, 0, (got, m) -> CASE WHEN got > 0 THEN got WHEN {apart} > k THEN m ELSE 0 END, got -> CASE WHEN got > 0 THEN got ELSE {RUN} * k + 1 END)"
    # one value each for the sorted runs and the edits, so that they are made once a line
    first = f"get(transform(array({edits}), k -> {taken}), 0)"
    return F.expr(f"CASE WHEN size(h) >= {LEAST - 1} THEN get(transform(array({ordered}), s -> array_distinct(transform(slice(s, 1, {first}), v -> shiftright(v, 24)))), 0) END")


def _parities(hashes: Column) -> Column:
    """64 bits, each whether the words that fall on it are odd in number: an edit changes two at most."""
    def flip(bits: Column, h: Column) -> Column:
        return bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int")))
    return F.aggregate(hashes, F.lit(0).cast("long"), flip)


def _sketch(hashes: Column) -> Column:
    """``WIDE`` times 64 such bits: 64 are too few for the edits of a line of a hundred words."""
    return F.transform(F.sequence(F.lit(0), F.lit(WIDE - 1)), lambda j: _parities(F.filter(hashes, lambda h: F.pmod(F.shiftright(h, 6), F.lit(WIDE)) == j)))


def _bound(longer: Column, most: int | None) -> Column:
    edits = F.floor(longer / LEAST).cast("int")
    return edits if most is None else F.least(edits, F.lit(most))


def _within(a: Column, b: Column, edits: Column) -> Column:
    """Whether two arrays of words differ by at most ``edits`` edits: each word becomes one character, the same in both.

    The character is 20 bits of the word's hash, or where two words of a pair have the same, their place among the words of both.
    """
    def character(w: Column) -> Column:
        return F.xxhash64(w).bitwiseAND(F.lit(0xFFFFF)) + 0x10000

    def counted(both: Column) -> Callable[[Column], Column]:
        def of(w: Column) -> Column:
            at = F.array_position(both, w)
            return F.when(at < 0xD800, at).otherwise(at + 0x800)  # no surrogates
        return of

    def near(of: Callable[[Column], Column]) -> Column:
        x, y = (F.decode(F.unhex(F.array_join(F.transform(words, lambda w: F.lpad(F.hex(of(w)), 8, "0")), "")), "UTF-32") for words in (a, b))
        return F.call_function("levenshtein", x, y, edits) >= 0

    # as a variable, the words of both are gathered once a pair, not once a word
    own = lambda both: F.size(F.array_distinct(F.transform(both, character))) == F.size(both)
    return F.get(F.transform(F.array(F.array_distinct(F.concat(a, b))), lambda both: F.when(own(both), near(character)).otherwise(near(counted(both)))), F.lit(0))


def _likely(met: DataFrame, most: int | None) -> DataFrame:
    """Of lines (first) that met an earlier one (other), the pairs that their lengths and parities do not tell apart."""
    edits = _bound(F.greatest("n", "n_other"), most)
    differ = F.bit_count(F.col("bits").bitwiseXOR(F.col("bits_other")))
    return (met.filter((F.col("other") < F.col("first")) & (F.abs(F.col("n") - F.col("n_other")) <= edits) & (differ <= 2 * edits))
            .select("first", "other", edits.alias("edits")).distinct())


def _verified(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """The lines (first) that are near the earlier one (other)."""
    pairs = stored(pairs.withColumnRenamed("first", "later"), "line-pairs")
    places = pairs.select(F.explode(F.array("later", "other")).alias("place")).distinct()
    some = lines.join(places, F.col("first") == F.col("place"), "left_semi").select("first", "line", _hashes(F.col("line")).alias("h"))
    some = stored(some.select("first", "line", _sketch(F.col("h")).alias("sketch")), "paired-lines")

    def both_of(pairs: DataFrame, column: str) -> DataFrame:
        # nothing is renamed below the joins: one exchange of the lines serves both
        had = some.select("first", column).alias("l")
        earlier = pairs.join(had, F.col("other") == F.col("l.first")).select("later", "other", "edits", F.col(column).alias(f"{column}_other"))
        return earlier.join(had, F.col("later") == F.col("l.first"))

    differ = F.aggregate(F.zip_with("sketch", "sketch_other", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    pairs = stored(both_of(pairs, "sketch").filter(differ <= 2 * F.col("edits")).select("later", "other", "edits"), "line-pairs")
    a, b, edits = F.col("a"), F.col("b"), F.col("edits")
    both = both_of(pairs, "line").select("first", "edits", _words(F.col("line")).alias("a"), _words(F.col("line_other")).alias("b"))
    lacks = F.greatest(F.size(F.array_except(a, b)), F.size(F.array_except(b, a)))
    near = both.filter(F.when(lacks <= edits, _within(a, b, edits)).otherwise(F.lit(False)))
    return stored(near.select("first").distinct(), "near-lines")


def _near(lines: DataFrame, often: list[int], most: int | None) -> DataFrame:
    """Of the distinct lines, those (first) that have an earlier line within the bound."""
    hashed = lines.select("first", _hashes(F.col("line")).alias("h"))
    # never null: a join or filter below then adds no test of its own, and one exchange serves them all
    about = [F.coalesce(F.size("h"), F.lit(0)).alias("n"), F.coalesce(_parities(F.col("h")), F.lit(0)).alias("bits")]
    # made beside the hashes, so once a line and not once a key
    keyed = hashed.select("first", "h", *about).select("first", "n", "bits", F.explode(_keys(often, most)).alias("k"))
    keyed = keyed.select("first", "n", "bits", F.coalesce("k", F.lit(0)).alias("k")).repartition("k")
    group = Window.partitionBy("k")
    every = keyed.withColumns({"c": F.count("*").over(group), "m": F.min(F.struct("first", "n", "bits")).over(group)}).filter("c > 1")
    every = stored(every, "line-runs")  # most runs are in one line only and go here
    met = every.filter("m.first < first")
    least = met.select("first", "n", "bits", F.col("m.first").alias("other"), F.col("m.n").alias("n_other"), F.col("m.bits").alias("bits_other"))
    gone = _verified(lines, _likely(least, most))
    left = met.filter("c > 2").select("k", "first", "n", "bits", F.col("m.first").alias("least")).join(gone, "first", "left_anti")
    every = every.filter("c > 2").select("k", "first", "n", "bits").withColumnsRenamed({"first": "other", "n": "n_other", "bits": "bits_other"})
    more = _verified(lines, _likely(every.join(left.hint("shuffle_hash"), "k").filter("other > least"), most))
    return gone.unionByName(more)


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", max_edits: int | None = 1) -> DataFrame:
    """``df`` with its text less the lines that go, and ``n_lines`` and ``n_removed``.

    ``max_edits`` 0 finds equal lines only; None bounds the edits by the length of the line alone.
    """
    if max_edits is not None and max_edits < 0:
        raise ValueError("max_edits is None, 0 or more")
    texts = _keyed(df, key, text)
    every = texts.filter("__text is not null").select("__key", "__mark", F.posexplode(F.split("__text", "\n", -1)).alias("pos", "line"))
    every = every.filter(~_blank(F.col("line")))
    hashed = every.select(F.xxhash64("line").alias("l1"), F.xxhash64(F.lit(7), "line").alias("l2"), F.struct("__key", "__mark", "pos").alias("first"), "line")
    earliest = F.min(F.struct("first", "line") if max_edits != 0 else F.struct("first")).alias("earliest")
    kept = stored(hashed.groupBy("l1", "l2").agg(earliest).select("earliest.*"), "lines")
    if max_edits != 0:
        kept = kept.join(_near(kept, _often(texts), max_edits), "first", "left_anti")
    kept = kept.select("first.*").groupBy("__key", "__mark").agg(F.collect_set("pos").alias("kept"))

    lines = F.split("__text", "\n", -1)
    # a place stays if it is kept or blank; the places of a document are looked up in a map
    marks = F.map_from_entries(F.transform(F.coalesce("kept", F.array().cast("array<int>")), lambda p: F.struct(p, F.lit(True))))
    stay = F.filter(F.transform("lines", lambda x, i: F.struct(x.alias("x"), (F.element_at("marks", i).isNotNull() | _blank(x)).alias("keep"))), lambda s: s["keep"])
    others = [c for c in df.columns if c.lower() not in ("n_lines", "n_removed")]
    extra = [c for c in others if c not in (key, text)]
    if extra:
        body = named(text).cast("string")
        source = df.select(*map(named, others), named(key).alias("__key"), F.hash(F.coalesce(body, F.lit(""))).alias("__mark"), body.alias("__text"))
    else:
        source = texts  # the shuffled texts serve all reads
    joined = _per_doc(source, kept, "left").withColumn("lines", lines).withColumn("marks", marks).withColumn("stay", stay)
    columns = {c: named(c) for c in others}
    columns[key] = F.col("__key")
    columns[text] = F.when(F.col("__text").isNotNull(), F.array_join(F.transform("stay", lambda s: s["x"]), "\n"))
    n = F.when(F.col("__text").isNull(), F.lit(0)).otherwise(F.size("lines")).cast("long")
    return joined.select(*(columns[c].alias(c) for c in others), n.alias("n_lines"),
                         (n - F.when(F.col("__text").isNull(), F.lit(0)).otherwise(F.size("stay"))).alias("n_removed"))
