"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Sources share a token budget by weight, none above a multiple of its own size. The budget
is cut into blocks of equal tokens; the blocks go to the sources by highest quotients
target / (2k + 1), and each source's blocks go to its shards in the same way. In a shard
the documents lie on a circle in seeded order, and the shard's quota is the run of blocks
from a seeded first block on, so a document is taken whole, in part, or more than once.
Only DataFrame operations; the selection is arithmetic on positions, so its cost does not
depend on the number of blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweir.llm.components import stored, unused

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixSettings:
    """``budget``: tokens to take as a multiple of all tokens; ``most``: of a source's own."""

    weights: Sequence[float] = (5, 2, 1)
    budget: float = 1.5
    most: int = 2
    block_tokens: int = 32
    documents_a_shard: int = 4096
    seed: str = "mix-1"


def _number(text: Column) -> Column:
    """48 bits of a text's digest, the same in every engine."""
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def targets(sources: DataFrame, settings: MixSettings) -> DataFrame:
    """Adds weight and target to (source, source_size); one row a source.

    Weights repeat over the sources in code point order, null last. The level of tokens a
    unit of weight is the largest of the levels that result when the sources that reach
    their limit first are taken out one after another.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = ", ".join(f"{float(w)!r}D" for w in settings.weights)
    weighted = sources.withColumn("place", F.row_number().over(ordered) - 1).withColumn(
        "weight", F.expr(f"element_at(array({cycle}), cast(place % {len(settings.weights)} as int) + 1)")
    )
    limit = F.col("source_size") * F.lit(settings.most)
    filling = Window.orderBy(limit / F.col("weight"), "place")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    return (
        weighted.withColumn("limit", limit)
        .withColumn("budget", F.sum("source_size").over(whole) * F.lit(float(settings.budget)))
        .withColumn(
            "level",
            (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0)))
            / F.sum("weight").over(onward),
        )
        .withColumn("level", F.max("level").over(whole))
        .withColumn(
            "target", F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight"))
        )
        .drop("place", "limit", "budget", "level")
    )


def sainte_lague(
    frame: DataFrame, groups: Sequence[str], key: str, votes: str, seats: str
) -> DataFrame:
    """Adds ``quota``: the ``seats`` of each group shared among its rows by highest quotients.

    Every row first gets its votes over the group's divisor, rounded. The few seats too
    many or too few are then decided by quotients. How many of a row's quotients can matter
    is bounded by its share, so about three rows are compared for each row of the frame.
    Ties go to the smaller key, null last.
    """
    group = Window.partitionBy(*groups)
    first = (
        frame.withColumn("_all", F.sum(F.col(votes).cast("double")).over(group))
        .withColumn(
            "_share",
            F.when(F.col("_all") > 0, F.col(votes) / F.col("_all")).otherwise(F.lit(0.0)),
        )
        .withColumn("_first", F.floor(F.col("_share") * F.col(seats) + 0.5).cast("long"))
        .withColumn(
            "_gap",
            F.when(F.col("_all") > 0, F.col(seats) - F.sum("_first").over(group))
            .otherwise(F.lit(0))
            .cast("long"),
        )
        .withColumn(
            "_place",
            F.row_number().over(Window.partitionBy(*groups).orderBy(F.col(key).asc_nulls_last())),
        )
        .withColumn(
            "_reach",
            F.ceil(F.col("_share") * (F.abs("_gap") + F.count(F.lit(1)).over(group))) + 1,
        )
    )
    # k-th further seat, or k-th seat to give up
    steps = first.where("_gap <> 0").withColumn("_k", F.explode(F.expr("sequence(1L, _reach)")))
    seat = F.when(F.col("_gap") > 0, F.col("_first") + F.col("_k")).otherwise(
        F.col("_first") - F.col("_k") + 1
    )
    quotient = F.col(votes) / (2 * F.col("_seat") - 1)
    best = Window.partitionBy(*groups).orderBy(
        F.when(F.col("_gap") > 0, -quotient).otherwise(quotient),
        F.when(F.col("_gap") > 0, F.col("_place")).otherwise(-F.col("_place")),
    )
    moved = (
        steps.withColumn("_seat", seat)
        .where("_seat > 0")
        .withColumn("_rank", F.row_number().over(best))
        .where("_rank <= abs(_gap)")
        .groupBy(*[F.col(g).alias(f"_g_{g}") for g in groups], F.col(key).alias("_g_key"))
        .agg(F.sum(F.signum(F.col("_gap").cast("double"))).cast("long").alias("_moved"))
    )
    same = F.col(key).eqNullSafe(F.col("_g_key"))
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return (
        first.join(moved, same, "left")
        .withColumn("quota", F.col("_first") + F.coalesce("_moved", F.lit(0)))
        .select(*frame.columns, "quota")
    )


def mix(
    spark: SparkSession,
    documents: DataFrame,
    settings: MixSettings = MixSettings(),
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """doc_id, source, size, source_size, weight, target, shard, taken for every row.

    Size is the number of words, 0 for null and empty texts, which are never taken. A null
    source is a source of its own; null ids and repeated rows are documents like others.
    A run over the same rows gives the same result, whatever their order. Other columns
    are not read. No documents, no rows.
    """
    size = F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")
    sized = stored(
        spark,
        documents.select(
            F.col(id_column).cast("long").alias("doc_id"),
            F.col(source_column).cast("string").alias("source"),
            size.alias("size"),
        ),
        "mix-sizes",
    )
    block = settings.block_tokens
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.ceil(F.count(F.lit(1)) / F.lit(settings.documents_a_shard)).alias("shards"),
    )
    shared = targets(sources, settings).withColumn("_one", F.lit(1))
    shared = shared.withColumn(
        "blocks",
        F.floor(F.sum("target").over(Window.partitionBy("_one")) / block + 0.5),
    )
    shared = sainte_lague(shared, ["_one"], "source", "target", "blocks").select(
        F.col("source").alias("of"), "source_size", "shards", "weight", "target",
        F.col("quota").alias("source_blocks"),
    )
    shared = stored(spark, shared, "mix-sources")
    seed = F.concat(F.lit(settings.seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    placed = (
        sized.join(shared, F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("shard", _number(seed) % F.col("shards"))
    )
    cells = placed.groupBy("source", "shard").agg(
        F.sum("size").alias("cell_size"), F.first("source_blocks").alias("source_blocks")
    )
    start = _number(
        F.concat_ws(
            ":", F.lit(settings.seed), F.coalesce("source", F.lit("")), F.col("shard").cast("string")
        )
    )
    cells = (
        sainte_lague(cells, ["source"], "shard", "cell_size", "source_blocks")
        .withColumn("taken_words", F.least(F.col("quota") * block, F.col("cell_size") * settings.most))
        .withColumn(
            "begin",
            F.when(
                F.col("cell_size") > 0, start % F.ceil(F.col("cell_size") / block) * block
            ).otherwise(F.lit(0)),
        )
        .select(
            F.col("source").alias("of"), F.col("shard").alias("part"), "cell_size", "taken_words", "begin"
        )
    )
    cells = stored(spark, cells, "mix-cells")
    circle = Window.partitionBy("source", "shard").orderBy(
        F.md5(seed), "size", "doc_id"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = placed.withColumn("upto", F.sum("size").over(circle)).join(
        cells,
        F.col("source").eqNullSafe(F.col("of")) & (F.col("shard") == F.col("part")),
    )
    taken = None
    for turn in range(settings.most + 1):
        ahead = F.col("cell_size") * turn
        part = F.greatest(
            F.lit(0),
            F.least(F.col("upto") + ahead, F.col("begin") + F.col("taken_words"))
            - F.greatest(F.col("upto") - F.col("size") + ahead, F.col("begin")),
        )
        taken = part if taken is None else taken + part
    return laid.select(
        "doc_id", "source", "size", "source_size", "weight", "target", "shard",
        taken.cast("long").alias("taken"),
    )


def mixed(
    spark: SparkSession,
    documents: DataFrame,
    settings: MixSettings = MixSettings(),
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The mixed corpus: the rows of documents, with all their columns, as often as taken.

    A document stands in the result round(taken / size) times, so the few that a quota
    cuts are taken whole or not. Rows that share id, source and size share their number
    evenly, rounded. Texts without words are never taken.
    """
    plan = mix(spark, documents, settings, id_column, text_column, source_column)
    id_name, source_name, size_name, copies_name, time_name = (
        unused(documents, name) for name in ("id", "source", "size", "copies", "time")
    )
    share = F.floor(F.sum(F.col("taken")) / F.sum(F.col("size")) + 0.5).cast("int")
    copies = (
        plan.where("size > 0")
        .groupBy(
            F.col("doc_id").alias(id_name), F.col("source").alias(source_name),
            F.col("size").alias(size_name),
        )
        .agg(share.alias(copies_name))
        .where(F.col(copies_name) > 0)
    )
    size = F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")
    same = (
        F.col(id_column).cast("long").eqNullSafe(F.col(id_name))
        & F.col(source_column).cast("string").eqNullSafe(F.col(source_name))
        & (size == F.col(size_name))
    )
    times = F.explode(F.sequence(F.lit(1), F.col(copies_name)))
    return documents.join(copies, same).withColumn(time_name, times).select(*documents.columns)
