"""Steps of the removal of near lines: what they leave on disk, and the bound of the wider parities."""

import random
import time

from pyspark.sql import functions as F

from loomvault.llm import lines


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_steps_leave_no_shuffle_files_and_texts_move_once(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(40):
        line = rng.sample(words, 24)
        near = [*line[:5], "other", *line[6:]]
        docs.append((i, "\n".join(" ".join(x) for x in (line, near, rng.sample(words, 9)))))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    before = shuffle_files(spark)
    out = lines.dedup_lines(df, max_edits=None)
    until = time.time() + 10
    # a sample's most frequent runs are collected, which leaves the files of that small step
    while len(left := shuffle_files(spark) - before) > 20 and time.time() < until:
        time.sleep(0.2)
    assert len({n.split("_")[1] for n in left}) <= 3
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(split" not in plan and plan.count("levenshtein") == 0
    assert sum(r.n_removed for r in out.collect()) >= 40


def test_an_edit_changes_two_of_the_wider_parities_at_most(spark):
    rng = random.Random(11)
    pairs = []
    for _ in range(60):
        a = [rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(rng.randint(8, 120))]
        b, edits = list(a), rng.randint(0, 6)
        for _ in range(edits):
            at = rng.randrange(len(b))
            b[at:at + 1] = rng.choice([[], [b[at], "new"], [f"x{rng.randint(0, 99)}"]])
        pairs.append((" ".join(a), " ".join(b), edits))
    df = spark.createDataFrame(pairs, "a string, b string, edits int")
    made = df.select("edits", *[lines._sketch(lines._hashes(F.col(c))).alias(c) for c in "ab"]).collect()
    for r in made:
        assert len(r.a) == lines.WIDE
        assert sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(r.a, r.b, strict=True)) <= 2 * r.edits
