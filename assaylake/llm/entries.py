"""Queries of this subpackage: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm import ball_clusters, chat_format, embed_dedup, hard_negatives, lang_id, line_dedup, lm_score, packing, pii, sentencepieces, simhash, suffix_leaks, topk


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Vocabulary files stay outside the repository; the folder is a parameter of the environment."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(docs))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.sql("SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    return chat_format.digest(chat_format.format_conversations(rows.unionByName(tricky)))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lm_score.score(docs, lm_score.fit(docs, good, singles=False))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), query_every=50, k=5, scale=256)


def op9_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op11_ball_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_clusters.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label=moved, anchor_every=100, positives=5, negatives=5, scale=256)


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_leaks.digest(suffix_leaks.overlaps(docs, table(spark, sf_dir, "benchmark"), window=10, keep_text=False))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_sentencepiece": op1_sentencepiece, "op2_packing": op2_packing, "op3_pii": op3_pii, "op4_chat_format": op4_chat_format, "op5_simhash": op5_simhash, "op6_line_dedup": op6_line_dedup, "op7_lm_score": op7_lm_score, "op8_topk": op8_topk, "op9_embed_dedup": op9_embed_dedup, "op10_language_id": op10_language_id, "op11_ball_clusters": op11_ball_clusters, "op12_hard_negatives": op12_hard_negatives, "op13_decontaminate": op13_decontaminate}


def oracle_sql() -> dict[str, str]:
    return {"op4_chat_format": chat_format.ORACLE, "op6_line_dedup": line_dedup.ORACLE, "op8_topk": topk.ORACLE, "op9_embed_dedup": embed_dedup.ORACLE, "op11_ball_clusters": ball_clusters.ORACLE, "op12_hard_negatives": hard_negatives.ORACLE, "op13_decontaminate": suffix_leaks.ORACLE}
