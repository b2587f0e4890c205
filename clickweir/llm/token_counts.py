"""Token counts of a corpus from the exact histogram of encoded lengths.

The corpus is encoded once and reduced to (length, documents). Sums over the histogram's
suffixes then answer, for every context limit, how many documents reach it and how many
tokens remain when longer documents are cut there; quantiles are found the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweir.llm.bpe import encoded_lengths
from clickweir.llm.components import stored

BLOCK = 1024  # lengths whose suffix sums one task works out


def length_histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """(length, n_docs): how many documents have each encoded length; null lengths are left out."""
    return (
        lengths.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("long").alias("length"))
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, taken as a context limit:

    length, n_docs, docs_at_least (documents of this length or more), tokens_at_least
    (their tokens), truncated_total (tokens of the corpus if every document is cut at
    this length), docs_share_below (share of documents that are shorter: the length is
    the quantile of any level from there to the next length's share), all_docs.

    Blocks of lengths are summed apart and then shifted by the sums of the blocks above,
    so no task sees more than one block or one row a block.
    """
    blocks = histogram.withColumn("block", F.expr(f"length div {BLOCK}"))
    inside = Window.partitionBy("block").orderBy(F.desc("length"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()  # one row a block
    totals = (
        blocks.groupBy("block")
        .agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("length")).alias("t"))
        .select(
            "block",
            F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
            F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
            F.sum("d").over(every).alias("all_docs"),
            F.sum("t").over(every).alias("all_tokens"),
        )
    )
    return (
        blocks.join(totals, "block")
        .withColumn("docs_at_least", F.col("docs_above") + F.sum("n_docs").over(inside))
        .withColumn(
            "tokens_at_least",
            F.col("tokens_above") + F.sum(F.col("n_docs") * F.col("length")).over(inside),
        )
        .select(
            "length",
            "n_docs",
            "docs_at_least",
            "tokens_at_least",
            (
                F.col("all_tokens")
                - F.col("tokens_at_least")
                + F.col("length") * F.col("docs_at_least")
            ).alias("truncated_total"),
            ((F.col("all_docs") - F.col("docs_at_least")) / F.col("all_docs")).alias(
                "docs_share_below"
            ),
            "all_docs",
        )
    )


def quantiles(sums: DataFrame, levels: list[float]) -> DataFrame:
    """(level, length): the smallest length that at least ``level`` of the documents don't exceed."""
    asked = ", ".join(f"{float(level)!r}D" for level in levels)
    return (
        sums.withColumn("upto", 1 - (F.expr("docs_at_least - n_docs")) / F.col("all_docs"))
        .withColumn("level", F.explode(F.expr(f"array({asked})")))
        .where("upto >= level - 1e-12")
        .groupBy("level")
        .agg(F.min("length").alias("length"))
    )


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context, docs_over, total): tokens left when documents are cut at each context limit.

    A limit between two lengths is answered from the next larger length; one above all
    lengths cuts nothing. An empty corpus gives no rows.
    """
    asked = ", ".join(f"{int(limit)}L" for limit in limits)
    return (
        sums.withColumn("context", F.explode(F.expr(f"array({asked})")))
        .groupBy("context")
        .agg(
            F.max(
                F.expr(
                    "case when length > context then docs_at_least else 0 end"
                )
            ).alias("docs_over"),
            F.max("tokens_at_least").alias("all_tokens"),
            F.max(
                F.expr("case when length > context then tokens_at_least else 0 end")
            ).alias("tokens_over"),
        )
        .select(
            "context",
            "docs_over",
            (
                F.col("all_tokens")
                - F.col("tokens_over")
                + F.col("context") * F.col("docs_over")
            ).alias("total"),
        )
    )


def token_counts(
    spark: SparkSession, documents: DataFrame, path: str, text_column: str = "text"
) -> DataFrame:
    """Suffix sums over the encoded lengths of all documents.

    Null and empty texts have length 0; repeated rows count each time; no documents, no
    rows. The histogram is stored, so that the corpus is encoded once.
    """
    lengths = encoded_lengths(spark, documents, path, text_column)
    return suffix_sums(stored(spark, length_histogram(lengths), "token-lengths"))
