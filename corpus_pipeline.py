"""The corpus pipeline: clean, deduplicate, mix, encode.

Each stage gets the documents that the stage before it kept, written and read again, and
returns the documents that it keeps, with all their columns; the last returns their texts
as token ids, and the digest of what these decode to. No stage can be stated in SQL as a whole, so there is no ``ORACLE_SQL``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm import bpe, minhash, mixing, toxicity
from clickweir.session import fresh_folder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7; the model learns from all labels of the corpus."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.clean(docs, toxicity.train(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.one_of_each(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed(spark, docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian, four bytes each) and the SHA-256 of the text
    decoded from them, of every document."""
    return bpe.round_trip(spark, docs, TOKENIZER).select(
        "doc_id", "n_tokens", "ids", F.sha2("text", 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_folder(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
