"""Centroid clustering of integer vectors with JVM-native expressions.

Components become integers, so every distance, sum and centroid is exact and a run gives
the same result whatever the order of the rows. A round is one pass: ``zip_with`` and
``aggregate`` multiply each vector with the centroids, which stand in the plan as literal
arrays, which gives the squared distances; ``array_min`` over (distance, number) chooses the
cluster; and the sums of the columns, partly added up in every task, are all that is
exchanged: one row a centroid.

An inner product needs few bits of a 64-bit integer, so a literal array holds several
centroids side by side, as many as the longest vector and centroid allow, and one pass over
the components gives the products with all of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm.components import stored

# squared lengths up to here leave room for distances in 64 bits; beyond it decimals count
NARROW = 1 << 59
# larger components are held at this bound, where decimals still hold the distances
WIDE = 1 << 55
LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class ClusterSettings:
    """The first centroids are the vectors with the smallest hashes of ``seed:id``."""

    size: int = 64
    clusters: int = 40
    rounds: int = 5
    scale: int = 256
    seed: int = 2


def integer_vectors(
    vectors: DataFrame, settings: ClusterSettings, id_column: str, vector_column: str
) -> DataFrame:
    """(vec_id, v, length) of the vectors of the right size whose components are all finite:
    integers, and the sum of their squares."""
    value = F.col(vector_column).cast("array<double>")
    finite = F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    limit = F.lit(float(WIDE))
    whole = F.transform(
        "x", lambda x: F.floor(F.least(F.greatest(x * settings.scale, -limit), limit))
    )
    squares = "transform(v, c -> cast(c as double) * c)"
    length = f"aggregate({squares}, 0D, (s, x) -> s + x)"
    exact = "aggregate(transform(v, c -> c * c), 0L, (s, x) -> s + x)"
    return (
        vectors.select(F.col(id_column).cast("long").alias("vec_id"), value.alias("x"))
        .where((F.size("x") == settings.size) & finite.eqNullSafe(F.lit(True)))
        .select("vec_id", whole.alias("v"))
        # a length that long integers may not hold needs no exact value
        .withColumn(
            "length", F.expr(f"CASE WHEN {length} < {float(NARROW)} THEN {exact} ELSE {1 << 62} END")
        )
    )


def _packed(vectors: DataFrame, centroids: Sequence[Sequence[int]], longest: int) -> DataFrame:
    """Adds ``best``; ``longest`` is the largest squared length of a vector."""
    lengths = [sum(c * c for c in centroid) for centroid in centroids]
    # no inner product, whole or partial, is larger than the product of the lengths
    width = (math.isqrt(longest * max(lengths)) + 1).bit_length() + 1
    together = max(1, 62 // width)
    half, mask = 1 << (width - 1), (1 << width) - 1
    packed, choices = [], []
    for first in range(0, len(centroids), together):
        group = centroids[first : first + together]
        literal = ",".join(
            f"{sum(c << (width * place) for place, c in enumerate(cs))}L" for cs in zip(*group)
        )
        # every field is made positive, so that none borrows from the next
        zero = sum(half << (width * place) for place in range(len(group)))
        packed.append(
            f"aggregate(zip_with(v, array({literal}), (a, b) -> a * b), {zero}L, (s, x) -> s + x)"
            f" as _p{first}"
        )
        for place in range(len(group)):
            product = f"((shiftright(_p{first}, {width * place}) & {mask}L) - {half}L)"
            distance = f"length + {lengths[first + place]}L - 2L * {product}"
            choices.append(f"struct({distance} as d, {first + place} as k)")
    # products in a projection of their own: one that is used often is not worked out again
    products = vectors.selectExpr("*", *packed)
    return products.selectExpr(*vectors.columns, _least(choices))


def _wide(vectors: DataFrame, centroids: Sequence[Sequence[int]]) -> DataFrame:
    """The same for vectors of any length, in decimals."""
    kind = "decimal(38,0)"
    choices = []
    for number, centroid in enumerate(centroids):
        literal = ",".join(f"{c}L" for c in centroid)
        squares = f"zip_with(v, array({literal}), (a, b) -> cast(a - b as {kind}) * (a - b))"
        distance = f"aggregate({squares}, cast(0 as {kind}), (s, x) -> cast(s + x as {kind}))"
        choices.append(f"struct({distance} as d, {number} as k)")
    return vectors.selectExpr("*", _least(choices))


def _least(choices: Sequence[str]) -> str:
    return f"array_min(array({', '.join(choices)})) as best"


def _assigned(vectors: DataFrame, centroids: Sequence[Sequence[int]], longest: int) -> DataFrame:
    """Adds ``best`` (d, k): the smallest squared distance of ``v``, and the smallest number
    of a centroid that has it."""
    if max(longest, *[sum(c * c for c in centroid) for centroid in centroids]) <= NARROW:
        return _packed(vectors, centroids, longest)
    return _wide(vectors, centroids)


def _moved(assigned: DataFrame, centroids: list[list[int]], halves: bool) -> list[list[int]]:
    """Every centroid that has vectors at the floor of their mean; the driver gets one row a
    centroid. ``halves``: the upper and lower bits of a component are added apart, so that
    no number of rows overflows their sums."""
    size = len(centroids[0])
    parts = {"s": "v[{i}]"}
    if halves:
        parts = {"h": "shiftright(v[{i}], 32)", "l": "v[{i}] & 4294967295L"}
    columns = [
        F.expr(f"sum({value.format(i=i)})").alias(f"{name}{i}")
        for name, value in parts.items()
        for i in range(size)
    ]
    found = assigned.groupBy(F.col("best.k").alias("k")).agg(F.count(F.lit(1)).alias("n"), *columns)
    out = list(centroids)
    for row in found.collect():
        sums = [
            (row[f"h{i}"] << 32) + row[f"l{i}"] if halves else row[f"s{i}"] for i in range(size)
        ]
        out[row["k"]] = [s // row["n"] for s in sums]
    return out


def cluster(
    spark: SparkSession,
    vectors: DataFrame,
    settings: ClusterSettings = ClusterSettings(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid for every kept vector.

    Kept are vectors of ``size`` components without null or non-finite ones; the others give
    no row. Repeated rows count each; a null id is a vector like others, hashed as an empty
    text. Of vectors with one hash the smaller components come first. With fewer vectors than
    ``clusters`` there is a centroid for each; without any, no rows. Components beyond 2^55 of
    the integer unit are held there. Distances and sums beyond 64 bits are returned as the
    largest 64-bit integer (clusters are still chosen exactly). Other columns are not read.
    """
    kept = stored(
        spark, integer_vectors(vectors, settings, id_column, vector_column), "centroid-vectors"
    )
    name = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = kept.orderBy(F.sha2(name, 256), "v").limit(settings.clusters).select("v").collect()
    centroids = [list(row["v"]) for row in first]
    if not centroids:
        return kept.select(
            "vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"),
            F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"),
            F.col("v").alias("centroid"),
        )
    longest, rows = kept.agg(F.max("length"), F.count(F.lit(1))).first()
    halves = longest > NARROW or math.isqrt(longest) * rows >= LARGEST
    for _ in range(settings.rounds):
        centroids = _moved(_assigned(kept, centroids, longest), centroids, halves)
    placed = _assigned(kept, centroids, longest).select(
        "vec_id", F.col("best.k").alias("cluster"), F.col("best.d").alias("exact")
    )
    placed = stored(spark, placed, "centroid-clusters")
    sums = placed.groupBy("cluster").agg(
        F.try_sum(F.col("exact").cast("decimal(38,0)")).alias("sum")
    )
    sums = {row["cluster"]: row["sum"] for row in sums.collect()}  # one row a centroid
    whole = None if None in sums.values() else sum(sums.values())
    table = spark.createDataFrame(
        [
            (k, _bounded(s), _bounded(whole), list(map(int, centroids[k])))
            for k, s in sorted(sums.items())
        ],
        "of int, cluster_inertia long, inertia long, centroid array<long>",
    )
    return placed.join(F.broadcast(table), F.col("cluster") == F.col("of")).select(
        "vec_id", "cluster",
        F.least("exact", F.lit(LARGEST)).cast("long").alias("distance"),
        "cluster_inertia", "inertia", "centroid",
    )


def _bounded(total) -> int:
    return LARGEST if total is None else min(int(total), LARGEST)
