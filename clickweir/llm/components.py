"""Connected components of a link table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.session import fresh_folder


def stored(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again, which cuts its lineage."""
    path = fresh_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def unused(frame: DataFrame, name: str) -> str:
    """A column name like this one that the frame does not have in any spelling."""
    taken = {column.lower() for column in frame.columns}
    name = f"_{name}"
    while name in taken:
        name += "_"
    return name


def _to_smallest(edges: DataFrame) -> DataFrame:
    """Connect every node's neighbours (u, v) to the smallest of them and the node."""
    smallest = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(smallest, "u")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("h")
    ).first()
    return row["n"], row["h"]


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (u, v): root is the smallest node reachable.

    Alternates connecting the larger and the smaller neighbours of every node to its
    smallest one until nothing changes; the number of rounds grows with the logarithm of
    the longest chain. Rows with u = v or a null are ignored; a node without links is
    not returned. Each round is written to the shared folder, so a lost executor costs
    one round. A hot node meets one row of minima, so its rows can be split over tasks.
    """
    edges = links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = stored(spark, edges.distinct(), "links")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        larger = (
            _to_smallest(both)
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        joined = _to_smallest(larger)
        smaller = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(joined.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        edges = stored(spark, smaller, "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
