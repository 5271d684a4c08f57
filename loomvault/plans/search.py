"""Text search over a corpus as a batch job: TF-IDF cosine, best k per query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sizes import broadcast_if_small
from ..session import cut_lineage

# Postings that a query's rarest terms should have, so that the k-th best of their documents is a good threshold. Decides only
# how many rows are joined.
PROBE = 200
# Scores are compared at nine decimals; a document nearer to the threshold than this is kept.
MARGIN = 1e-8


def _terms(df: DataFrame, key: str, text: str) -> DataFrame:
    words = df.select(key, F.explode(F.split(F.lower(text), " ")).alias("term")).where("term <> ''")
    return words.groupBy(key, "term").agg(F.count("*").alias("tf"))


def _scores(postings: DataFrame, terms: DataFrame, query_key: str, doc_key: str) -> DataFrame:
    """(query, document, part): what some terms of each query give to the documents that have them."""
    joined = postings.join(broadcast_if_small(terms.select(query_key, "term", "x")), "term")
    return joined.groupBy(query_key, doc_key).agg(F.sum(F.col("x") * F.col("u")).alias("part"))


def split_terms(postings: DataFrame, query_terms: DataFrame, query_key: str, doc_key: str, k: int, probe: int = PROBE) -> DataFrame:
    """Query terms with the threshold of their query, whether they are ``essential``, and the most that those which are not can ``add``.

    The rarest terms of a query give a lower bound of its k-th score. Terms are then taken from the weakest on as long as all of them
    together stay below that threshold: a document that has no other term of the query is not among the k best.
    """
    rare = Window.partitionBy(query_key).orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    first = query_terms.withColumn("seen", F.coalesce(F.sum("df").over(rare), F.lit(0))).where(F.col("seen") < probe)
    ranked = Window.partitionBy(query_key).orderBy(F.desc("part"), doc_key)
    kth = (
        _scores(postings, first, query_key, doc_key).withColumn("rn", F.row_number().over(ranked)).where(F.col("rn") <= k)
        .where(F.col("rn") == k).select(query_key, F.col("part").alias("threshold"))
    )
    weakest = Window.partitionBy(query_key).orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, 0)
    marked = query_terms.join(kth, query_key, "left").withColumn("upto", F.sum("bound").over(weakest))
    marked = marked.withColumn("essential", F.coalesce(F.col("upto") >= F.col("threshold") - MARGIN, F.lit(True)))
    add = F.sum(F.when(~F.col("essential"), F.col("bound")).otherwise(0.0)).over(Window.partitionBy(query_key))
    return marked.withColumn("add", add).drop("upto")


def candidates(postings: DataFrame, split: DataFrame, query_key: str, doc_key: str) -> DataFrame:
    """(query, document, part) of the documents that can still reach the k-th score, scored by the essential terms."""
    parts = _scores(postings, split.where("essential"), query_key, doc_key)
    limits = split.select(query_key, "threshold", "add").distinct()
    reach = F.col("threshold").isNull() | (F.col("part") + F.col("add") >= F.col("threshold") - MARGIN)
    return parts.join(broadcast_if_small(limits), query_key).where(reach).select(query_key, doc_key, "part")


def search_topk(corpus: DataFrame, queries: DataFrame, doc_key: str, doc_text: str, query_key: str, query_text: str,
                k: int) -> DataFrame:
    """(query, document, SCORE) for the k best documents of each query.

    Only terms that occur in some query can score, so postings are cut to those; document lengths come from one aggregate over all
    terms. Postings of a query's common terms are not joined with it where they cannot bring a document among the k best: only the
    documents that its other terms leave look them up, by (document, term).
    """
    terms = _terms(corpus, doc_key, doc_text)
    asked = _terms(queries, query_key, query_text)
    documents = corpus.agg(F.count("*")).scalar()
    rarity = F.log((F.lit(1) + documents) / (F.lit(1) + F.col("df")).cast("double")) + 1
    idf = terms.groupBy("term").agg(F.count("*").alias("df")).select("term", "df", rarity.alias("idf"))
    weight: Column = F.col("idf") * F.col("tf")
    weighted = terms.join(idf, "term").select(doc_key, "term", weight.alias("w"))
    lengths = weighted.groupBy(doc_key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n"))
    wanted = asked.select("term").distinct()
    postings = weighted.join(broadcast_if_small(wanted), "term", "left_semi").join(lengths, doc_key).select(
        doc_key, "term", (F.col("w") / F.col("n")).alias("u"))
    postings = cut_lineage(postings)  # read by the probe, the essential terms and the look-up
    query_terms = asked.join(idf, "term").select(query_key, "term", "df", weight.alias("qw"))
    query_lengths = query_terms.groupBy(query_key).agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qn"))
    most = postings.groupBy("term").agg(F.max("u").alias("most"))
    x = F.col("qw") / F.col("qn")
    query_terms = query_terms.join(query_lengths, query_key).join(most, "term").select(query_key, "term", "df", x.alias("x"), (x * F.col("most")).alias("bound"))
    split = cut_lineage(split_terms(postings, query_terms, query_key, doc_key, k))  # one row per query and term
    found = candidates(postings, split, query_key, doc_key)
    rest = split.where("not essential").select(query_key, "term", "x")
    looked_up = (
        found.select(query_key, doc_key).join(broadcast_if_small(rest), query_key).join(postings, [doc_key, "term"])
        .select(query_key, doc_key, (F.col("x") * F.col("u")).alias("part"))
    )
    scored = found.unionByName(looked_up).groupBy(query_key, doc_key).agg(F.sum("part").alias("SCORE"))
    best = Window.partitionBy(query_key).orderBy(F.desc(F.round("SCORE", 9)), doc_key)
    # rank <= k is applied per task before the exchange, so no query's matches meet in one task
    return scored.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k).drop("rn")
