"""A corpus pipeline over ``documents``: five stages of the llm operators, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomvault.llm import bpe, decontaminate, lines, simhash, toxicity
from loomvault.llm.common import bucket_of_fold, table
from loomvault.llm.queries import TOKENIZER
from loomvault.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _as_documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``; ``n_chars`` counts the text as it is now."""
    return df.select(*(F.length("text").cast(df.schema["n_chars"].dataType).alias(c) if c == "n_chars" else F.col(c) for c in COLUMNS))


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = toxicity.toxicity_fit(docs, table(spark, sf_dir, "labels"), train_on=bucket_of_fold(F.col("doc_id")) != 1)
    return toxicity.toxicity_score(docs, model).filter("not is_toxic").select(*COLUMNS)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand in an earlier one."""
    return _as_documents(lines.dedup_lines(docs, max_edits=None))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return simhash.drop_near_duplicates(docs).select(*COLUMNS)


def remove_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the text that they decode to."""
    out = bpe.bpe_encode(docs, public_tokenizers.path(TOKENIZER), decoded=True)
    return out.select("doc_id", "lang", "source", "token_ids", "n_tokens", "decoded")


STAGES = [
    ("toxicity", remove_toxic),
    ("line dedup", remove_repeated_lines),
    ("near dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark_text),
    ("encoding", encode),
]
ORACLE_SQL = None  # hashes, a trained model and a tokenizer are beyond SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
