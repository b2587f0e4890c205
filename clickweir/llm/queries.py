"""One query for each operator, over its whole table, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm import bpe, ngram_lm, sql, toxicity
from clickweir.llm.minhash import near_duplicates
from clickweir.llm.ann import nearest
from clickweir.llm.centroids import cluster
from clickweir.llm.conversations import damaged, repair
from clickweir.llm.decontaminate import find_passages, prepare
from clickweir.llm.embed_dedup import near_vectors
from clickweir.llm.licenses import scan
from clickweir.llm.mixing import mix
from clickweir.llm.sharding import shard
from clickweir.llm.token_counts import token_counts

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies: five-word shingles, similarity 0.75 or more."""
    return near_duplicates(spark, table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors of one label at cosine 0.98 or more."""
    return near_vectors(spark, table(spark, sf_dir, "embeddings"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and truncated totals at every encoded length that occurs."""
    return token_counts(spark, table(spark, sf_dir, "documents"), TOKENIZER)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    return bpe.round_trip(spark, table(spark, sf_dir, "documents"), TOKENIZER).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes from every document: weights 5, 2, 1, 150 % of all words."""
    return mix(spark, table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth id among all rows."""
    return nearest(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return scan(spark, table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model that never saw a third of the ids."""
    documents = table(spark, sf_dir, "documents")
    held_out = ngram_lm.left_out(F.col("doc_id"), 3, 1)
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = toxicity.train(documents, labels)
    return toxicity.score(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", "n_sentences", "offending"
    )


def op9_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards of near equal bytes by a k-d tree over id, source, language and length."""
    return shard(spark, table(spark, sf_dir, "documents"))


def op10_ngram_lm(spark: SparkSession, sf_dir: str, order: int = ngram_lm.ORDER) -> DataFrame:
    """Probabilities of all documents by a model that never saw a seventh of the ids."""
    documents = table(spark, sf_dir, "documents")
    held_out = ngram_lm.left_out(F.col("doc_id"), 7, 2)
    model = ngram_lm.train(spark, documents.where(~held_out), order=order)
    return ngram_lm.score(documents, model).withColumn("held_out", held_out)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repairs of all conversations, damaged by checksum before."""
    rows = damaged(table(spark, sf_dir, "conversations"))
    return repair(rows, present=F.col("present"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items of the benchmark in every document."""
    benchmark = prepare(spark, table(spark, sf_dir, "benchmark"))
    found = find_passages(table(spark, sf_dir, "documents"), benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty clusters of integer vectors after five rounds."""
    found = cluster(spark, table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256)
    return found.withColumn("centroid_sha256", digest).drop("centroid")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash_dedup": op1_minhash_dedup,
        "op2_embedding_dedup": op2_embedding_dedup,
        "op3_token_counts": op3_token_counts,
        "op4_bpe": op4_bpe,
        "op5_mixing": op5_mixing,
        "op6_nearest_neighbours": op6_nearest_neighbours,
        "op7_licenses": op7_licenses,
        "op8_toxicity": op8_toxicity,
        "op9_kd_sharding": op9_kd_sharding,
        "op10_ngram_lm": op10_ngram_lm,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_decontamination": op12_decontamination,
        "op13_centroid_clustering": op13_centroid_clustering,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_dedup": sql.MINHASH_DEDUP,
        "op2_embedding_dedup": sql.EMBEDDING_DEDUP,
        "op5_mixing": sql.MIXING,
        "op11_conversation_repair": sql.CONVERSATION_REPAIR,
        "op12_decontamination": sql.DECONTAMINATION,
        "op13_centroid_clustering": sql.CENTROID_CLUSTERING,
    }
