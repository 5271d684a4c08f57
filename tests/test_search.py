"""Text search against a plain version, and what its pruning leaves out."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomvault.plans import search

RARE = [f"r{k}" for k in range(60)]


def plain(docs, asked, k):
    tf = {d: Counter(t for t in x.lower().split(" ") if t) for d, x in docs}
    df = Counter(t for c in tf.values() for t in c)
    idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items()}
    out = []
    for q, text in asked:
        weights = {t: n * idf[t] for t, n in Counter(t for t in text.lower().split(" ") if t).items() if t in idf}
        scores = []
        for d, c in tf.items():
            if weights.keys() & c.keys():
                length = math.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items())) * math.sqrt(sum(v * v for v in weights.values()))
                scores.append((-round(sum(v * c[t] * idf[t] for t, v in weights.items()) / length, 9), d))
        out += [(q, d, -s) for s, d in sorted(scores)[:k]]
    return sorted(out)


def corpus(seed, n, shared):
    """Texts of a few rare words each; all have the word that every query has as well."""
    rng = random.Random(seed)
    return [(k, " ".join(["The"] * shared + rng.sample(RARE, 4))) for k in range(n)]


@pytest.mark.parametrize("probe", [1, 10, 10_000])
def test_best_documents_equal_a_plain_search(spark, monkeypatch, probe):
    docs = corpus(3, 400, 1) + [(1000, ""), (1001, "the"), (1002, "the"), (1003, "alone")]
    asked = [(f"q{k}", t.replace("The", "the") + " missing") for k, t in corpus(4, 25, 1)] + [("common", "the"), ("one", "alone the"), ("none", "missing"), ("empty", "")]
    best = search.split_terms
    monkeypatch.setattr(search, "split_terms", lambda *given: best(*given, probe=probe))
    got = search.search_topk(spark.createDataFrame(docs, "d long, x string"), spark.createDataFrame(asked, "q string, t string"), "d", "x", "q", "t", 3)
    assert sorted((r.q, r.d, round(r.SCORE, 9)) for r in got.collect()) == plain(docs, asked, 3)


def test_a_word_that_all_share_is_not_joined_with_every_query(spark):
    n, m = 3000, 40
    postings = spark.createDataFrame([(d, t, 1.0 if t != "The" else 0.05) for d, x in corpus(5, n, 1) for t in x.split(" ")], "d long, term string, u double")
    df = Counter(r.term for r in postings.collect())
    terms = [(f"q{k}", t, df[t], 0.5 if t != "The" else 0.05) for k, x in corpus(6, m, 1) for t in x.split(" ")]
    asked = spark.createDataFrame(terms, "q string, term string, df long, x double").withColumn("bound", F.col("x") * F.when(F.col("term") == "The", 0.05).otherwise(1.0))
    split = search.split_terms(postings, asked, "q", "d", 3)
    assert {r.term for r in split.where("not essential").collect()} >= {"The"}
    joined = postings.join(split.where("essential"), "term").count()
    left = search.candidates(postings, split, "q", "d").count()
    assert left <= joined < 0.3 * n * m
