"""The registered queries of this subpackage; each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import centroids, chat, common, imatch, linededup, minhash, packing, piecebpe, rules, simhash, token_store, unigram, whitening
from .sharding import ShardStore


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.work_path(spark, "tokens")
    token_store.write_tokens(common.table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), end_id=2)
    return token_store.digests(spark, path)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), capacity=2048, end_id=0)


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.digests(common.materialize(chat.windows(rows.union(own)), "windows"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "n_left", F.sha2("text", 256).alias("text_sha256"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(common.table(spark, sf_dir, "documents"), percent=85)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six arrivals by ranges of doc_id, each appended as small shards; then compaction, and the documents as the manifest has them.

    Null doc_id: in the first arrival. Repeated rows, null and empty texts: kept as they are. No rows: one empty arrival, no rows.
    """
    docs = common.table(spark, sf_dir, "documents")
    store = ShardStore(spark, common.work_path(spark, "shards"))
    cuts = docs.agg(F.percentile_approx("doc_id", [k / 6 for k in range(1, 6)], 1000)).first()[0]
    if not cuts:
        store.append(docs)
    else:
        low = None
        for high in [*sorted(set(cuts)), None]:
            inside = F.lit(True) if low is None else F.col("doc_id") > low
            inside = inside if high is None else inside & (F.col("doc_id") <= high)
            store.append(docs.where(inside | F.col("doc_id").isNull() if low is None else inside))
            low = high
            store.compact(target=64 << 20, fanout=4)
    store.compact(target=64 << 20, fanout=4, finish=True)
    store.vacuum()
    return store.read().select("doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("text_sha256"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(common.table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.count_tokens(common.table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.judge(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return out.select("doc_id", *[f"stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecebpe.round_trip_digests(common.table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(common.table(spark, sf_dir, "embeddings"), components=16)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(common.table(spark, sf_dir, "embeddings"), k=40, rounds=5)


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(common.table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_token_output,
        op2_best_fit_packing,
        op3_chat_formatting,
        op4_line_dedup,
        op5_minhash_near_dedup,
        op6_sharding,
        op7_fingerprints,
        op8_token_counts,
        op9_quality_rules,
        op10_sentencepiece,
        op11_embedding_whitening,
        op12_centroid_clustering,
        op13_simhash_near_dedup,
        pipeline,
    )
    return {f.__name__: f for f in own}


#: Windows as chat.windows makes them, by recursion over the new turns.
OP3_SQL = r"""
WITH RECURSIVE src AS (
  SELECT coalesce('c' || conv_id, 'r' || row_number() OVER ()) AS k, conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT 'c-1', -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT 'c-1', -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), t AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn, role, text) - 1 AS i,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]{1,4}')) + 4 AS cost,
    12 + length(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|n|>')) + 1
      + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 11 AS chars
  FROM src
), p AS (
  SELECT *, sum(cost) OVER w - cost AS cb, sum(chars) OVER w - chars AS hb FROM t WINDOW w AS (PARTITION BY k ORDER BY i)
), c AS (
  SELECT k, max(i) + 1 AS n, max(CASE WHEN i = 0 AND role = 'system' THEN 1 ELSE 0 END) AS sys,
    max(CASE WHEN i = 0 AND role = 'system' THEN cost ELSE 0 END) AS syscost, max(CASE WHEN i = 0 AND role = 'system' THEN chars ELSE 0 END) AS syschars
  FROM p GROUP BY k
), h AS (
  SELECT a.k, a.i, a.cost, a.cb, a.hb, c.sys, c.syscost, c.syschars,
    a.cb - coalesce(min(b.cb), a.cb) AS oldcost, a.hb - coalesce(min(b.hb), a.hb) AS oldchars
  FROM p a JOIN c USING (k) LEFT JOIN p b ON b.k = a.k AND b.i < a.i AND b.i >= c.sys AND a.cb - b.cb <= 96
  GROUP BY a.k, a.i, a.cost, a.cb, a.hb, c.sys, c.syscost, c.syschars
), r AS (
  SELECT k, i, cb AS start, 0::HUGEINT AS old, 0::HUGEINT AS extra FROM h WHERE i = sys
  UNION ALL
  SELECT h.k, h.i,
    CASE WHEN h.cb + h.cost - r.start + r.old <= 384 - h.syscost THEN r.start ELSE h.cb END,
    CASE WHEN h.cb + h.cost - r.start + r.old <= 384 - h.syscost THEN r.old ELSE h.oldcost END,
    CASE WHEN h.cb + h.cost - r.start + r.old <= 384 - h.syscost THEN 0 ELSE h.syschars + h.oldchars END
  FROM r JOIN h ON h.k = r.k AND h.i = r.i + 1
), e AS (SELECT k, sum(extra) AS extra FROM r GROUP BY k)
SELECT any_value(p.conv_id) AS conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '')) AS loss_sha256,
  (sum(chars) + max(coalesce(extra, 0)))::BIGINT AS formatted_chars
FROM p LEFT JOIN e ON p.k = e.k GROUP BY p.k
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_formatting": OP3_SQL, "op6_sharding": "SELECT doc_id, lang, source, n_chars, sha256(text) AS text_sha256 FROM documents"}
