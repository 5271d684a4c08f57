"""The operators as registered queries over the whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, fingerprint, html_text, langid, lines, repeats, resample, shards, simhash, toxicity, whiten
from .common import bucket_of_fold, documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = "word_bpe_49k.json"


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


@query("op1_line_dedup")
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = lines.dedup_lines(documents(spark, folder), max_edits=None)
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"),
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query("op2_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = repeats.find_repeats(documents(spark, folder), keep="none")
    removed = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed_spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_chat_formatting")
def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """The digests need all turns of a conversation in one row; the windows themselves do not."""
    hostile = r"\### Assistant: </turn> ok"
    given = table(spark, folder, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", hostile), (-7, 1, "assistant", hostile)], "conv_id long, turn long, role string, text string")
    read = chat.read_chats(chat.format_chats(given.unionByName(extra)))
    parts = read.select("conv_id", F.struct(
        "block", "window", F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.size("turns").cast("long").alias("n"), F.array_join("targets", "").alias("loss"), F.length("formatted").cast("long").alias("chars")).alias("w"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("w"))
    add = lambda field: F.aggregate("w", F.lit(0).cast("long"), lambda s, x: s + x[field])
    text = lambda field: F.array_join(F.transform("w", lambda x: x[field]), "")
    return whole.select("conv_id", add("n").alias("n_turns"), F.sha2(text("turns"), 256).alias("turns_sha256"),
                        F.length(text("loss")).cast("long").alias("loss_chars"), F.sha2(text("loss"), 256).alias("loss_sha256"),
                        add("chars").alias("formatted_chars"))


@query("op4_simhash")
def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder)).select(
        "doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


@query("op5_html_extraction")
def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    out = html_text.extract_main_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


@query("op6_document_fingerprints")
def document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.compare_with_next(documents(spark, folder))


@query("op7_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text", "lang")
    held_out = bucket_of_fold(F.col("doc_id")) == 1
    model = langid.language_fit(docs, train_on=~held_out)
    out = langid.language_predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query("op8_toxicity")
def toxicity_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = bucket_of_fold(F.col("doc_id")) == 1
    model = toxicity.toxicity_fit(docs, table(spark, folder, "labels"), train_on=~held_out)
    out = toxicity.toxicity_score(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), F.col("is_toxic").cast("int").alias("predicted"))


# Words as in the operator; windows of 13 words, or the whole item; hits as distinct word places.
DECONTAMINATION_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT DISTINCT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op9_benchmark_decontamination", DECONTAMINATION_SQL)
def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    out = decontaminate.find_benchmark_text(documents(spark, folder), table(spark, folder, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), "contaminated")


@query("op10_bpe")
def bpe_query(spark: SparkSession, folder: str) -> DataFrame:
    out = bpe.bpe_encode(documents(spark, folder), public_tokenizers.path(TOKENIZER), decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


# The CRC-32 of a string, by its table of 256 remainders.
CRC_TABLE = """
crc AS (SELECT list(r ORDER BY b) AS t FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r FROM (SELECT unnest(range(256)) AS b)))"""


def crc_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a string, where ``crc`` is joined."""
    digit = "instr('0123456789ABCDEF', {}) - 1".format
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST(({digit('h[1]')}) * 16 + {digit('h[2]')} AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295)"


RESAMPLING_SQL = f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
dw AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(w) AS w FROM d) GROUP BY ALL),
bw AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM b) GROUP BY ALL),
words AS (SELECT w, {crc_sql("w")} % 10000 AS bucket FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc),
s AS (SELECT bucket, sum(n) AS n FROM dw JOIN words USING (w) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM bw JOIN words USING (w) GROUP BY bucket),
sums AS (SELECT CAST((SELECT coalesce(sum(n), 0) FROM s) AS DOUBLE) AS s_all, CAST((SELECT coalesce(sum(n), 0) FROM t) AS DOUBLE) AS t_all),
gains AS (SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * (s_all + 10000) / ((CAST(coalesce(s.n, 0) AS DOUBLE) + 1) * (t_all + 10000)))) AS BIGINT) AS gain
          FROM s FULL JOIN t USING (bucket), sums),
weights AS (SELECT doc_id, CAST(floor(sum(n * gain) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight FROM dw JOIN words USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (SELECT doc_id, CAST(len(d.w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || sha256('2024:' || CAST(doc_id AS VARCHAR))[1:8] AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
           FROM d LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN r <= n * 10 // 100 THEN r END AS BIGINT) AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""


@query("op11_importance_resampling", RESAMPLING_SQL)
def importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    out = resample.resample(documents(spark, folder), table(spark, folder, "benchmark"), percent=10, min_words=20, keep_text=False)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


# The order is that of the operator; whole numbers only.
SHARDING_SQL = f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 16 AS size, sha256(coalesce(text, '')) AS same FROM documents),
o AS (SELECT doc_id, size, same, sum(size) OVER (ORDER BY same, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before,
             sum(size) OVER (PARTITION BY same) AS bytes, sum(size) OVER () AS total FROM d),
p AS (SELECT *, CASE WHEN bytes * {40 * shards.WHOLE} > total THEN before ELSE min(before) OVER (PARTITION BY same) END AS start FROM o),
q AS (SELECT *, CAST((2 * start + size) * 40 // (2 * total) AS INTEGER) AS shard FROM p),
c AS (SELECT text, {crc_sql("text")} AS text_crc32 FROM (SELECT DISTINCT text FROM d), crc)
SELECT q.doc_id, CAST(q.size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY q.same, q.doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM q JOIN d ON q.doc_id = d.doc_id JOIN c USING (text)
"""


@query("op12_sharding", SHARDING_SQL)
def sharding(spark: SparkSession, folder: str) -> DataFrame:
    out = shards.assign_shards(documents(spark, folder), shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op13_embedding_whitening")
def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    out = whiten.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"), components=32)
    return out.select("vec_id", *whiten.ADDED)
