"""Approximate nearest neighbours by a forest of random-projection trees.

Every tree splits the space by random directions, at the median of a bounded sample; all
rows are then put into the leaves. A query walks all trees through one shared priority
queue: the branch that it misses by the least margin, in whichever tree, comes next, until
it has chosen its number of leaves. The leaves' rows are ranked exactly, and the best of
all leaves are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweir.llm.components import stored
from clickweir.llm.vectors import cosines, usable_vectors


@dataclass(frozen=True)
class ForestSettings:
    """``sample``: rows that the trees are fitted to, at most; ``leaf``: of them in a leaf."""

    trees: int = 16
    sample: int = 16_384
    leaf: int = 32
    leaves: int = 512  # that a query looks into, in all trees together
    block: int = 4096  # rows of a leaf that one task takes at a time
    leaves_a_task: int = 16
    seed: int = 5


@dataclass(frozen=True)
class Tree:
    """Inner nodes by number: direction, threshold and children; ~leaf for a leaf."""

    directions: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    root: int


def grow(sample: np.ndarray, settings: ForestSettings, number: int) -> Tree:
    """Split the sample at medians of random directions until leaves are small."""
    random = np.random.Generator(np.random.PCG64([settings.seed, number]))
    directions, thresholds, children = [], [], []
    leaves = 0

    def split(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > settings.leaf:
            direction = random.normal(size=sample.shape[1])
            direction /= np.sqrt(direction @ direction)
            along = sample[rows] @ direction
            threshold = float(np.median(along))
            left = along < threshold
            if left.any():
                node = len(thresholds)
                directions.append(direction)
                thresholds.append(threshold)
                children.append([0, 0])
                children[node] = [split(rows[left]), split(rows[~left])]
                return node
        leaves += 1
        return ~(leaves - 1)

    root = split(np.arange(len(sample)))
    return Tree(
        np.array(directions).reshape(len(directions), sample.shape[1]),
        np.array(thresholds), np.array(children, dtype=np.int64).reshape(-1, 2), root,
    )


def leaf_of(tree: Tree, vectors: np.ndarray) -> np.ndarray:
    """The leaf of every vector."""
    node = np.full(len(vectors), tree.root, dtype=np.int64)
    while (inner := np.flatnonzero(node >= 0)).size:
        at = node[inner]
        along = (vectors[inner] * tree.directions[at]).sum(axis=1)
        node[inner] = tree.children[at, (along >= tree.thresholds[at]).astype(np.int64)]
    return ~node


def choose_leaves(forest: list[Tree], vector: np.ndarray, most: int) -> list[tuple[int, int]]:
    """(tree, leaf) pairs by smallest margin missed, over all trees together."""
    along = [tree.directions @ vector - tree.thresholds for tree in forest]
    queue = [(0.0, number, tree.root) for number, tree in enumerate(forest)]
    heapq.heapify(queue)
    found = []
    while queue and len(found) < most:
        missed, number, node = heapq.heappop(queue)
        while node >= 0:
            margin = along[number][node]
            near, far = forest[number].children[node][:: -1 if margin >= 0 else 1]
            heapq.heappush(queue, (max(missed, abs(margin)), number, far))
            node = near
        found.append((number, int(~node)))
    return found


def _unit(vectors: list[np.ndarray]) -> np.ndarray:
    table = np.stack(vectors)
    return table / np.sqrt((table * table).sum(axis=1))[:, None]


def _checked(batches: Iterator[pa.RecordBatch], size: int | None) -> Iterator[pa.RecordBatch]:
    """(vec_id, vector) of the usable vectors, as doubles in bytes; of one size, if given."""
    for whole in batches:
        for first in range(0, whole.num_rows, 2048):
            batch = whole.slice(first, 2048)
            usable, vectors = usable_vectors(batch.column(1))
            ids = batch.column(0).filter(pa.array(usable))
            fits = [size is None or len(v) == size for v in vectors]
            yield pa.RecordBatch.from_arrays(
                [
                    ids.filter(pa.array(fits, pa.bool_())),
                    pa.array([v.tobytes() for v, ok in zip(vectors, fits) if ok], pa.binary()),
                ],
                ["vec_id", "vector"],
            )


def _vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=np.float64) for x in column.to_pylist()]


def _placed(batches: Iterator[pa.RecordBatch], forest, queries: bool, most: int):
    """(tree, leaf, vec_id, vector): each row in all trees, or each query in its leaves."""
    trees = forest.value
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = _unit(_vectors(batch.column(1)))
        if queries:
            chosen = [choose_leaves(trees, v, most) for v in unit]
            rows = np.repeat(np.arange(len(unit)), [len(c) for c in chosen])
            tree, leaf = np.array([pair for c in chosen for pair in c], dtype=np.int32).T
        else:
            rows = np.tile(np.arange(len(unit)), len(trees))
            tree = np.repeat(np.arange(len(trees), dtype=np.int32), len(unit))
            leaf = np.concatenate([leaf_of(t, unit) for t in trees]).astype(np.int32)
        for first in range(0, len(rows), 8192):
            part = rows[first : first + 8192]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tree[first : first + 8192]), pa.array(leaf[first : first + 8192]),
                    batch.column(0).take(pa.array(part)), batch.column(1).take(pa.array(part)),
                ],
                ["tree", "leaf", "vec_id", "vector"],
            )


def _best(rows: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k best rows of each query in every leaf that they share, with exact scores."""
    out_q, out_v, out_s = [], [], []
    if rows.num_rows and queries.num_rows:
        row_leaf, row_id = rows["leaf"].to_numpy(), rows["vec_id"].to_numpy()
        q_leaf, q_id = queries["leaf"].to_numpy(), queries["vec_id"].to_numpy()
        raw, asked = np.stack(_vectors(rows["vector"])), np.stack(_vectors(queries["vector"]))
        row_order, q_order = np.argsort(row_leaf, kind="stable"), np.argsort(q_leaf, kind="stable")
        for leaf in np.intersect1d(row_leaf, q_leaf):
            own = row_order[slice(*np.searchsorted(row_leaf[row_order], [leaf, leaf + 1]))]
            who = q_order[slice(*np.searchsorted(q_leaf[q_order], [leaf, leaf + 1]))]
            unit = _unit(list(raw[own]))
            for first in range(0, len(who), 512):
                some = who[first : first + 512]
                rough = _unit(list(asked[some])) @ unit.T
                rough[q_id[some][:, None] == row_id[own][None, :]] = -np.inf
                level = -np.inf
                if len(own) > k:
                    level = np.partition(rough, len(own) - k, axis=1)[:, len(own) - k, None] - 1e-9
                near, far = np.nonzero((rough >= level) & np.isfinite(rough))
                out_q.append(q_id[some][near])
                out_v.append(row_id[own][far])
                out_s.append(cosines(asked[some][near], raw[own][far]))
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
    return pa.table(
        {
            "query_id": pa.array(join(out_q, np.int64)),
            "vec_id": pa.array(join(out_v, np.int64)),
            "score": pa.array(join(out_s, np.float64)),
        }
    )


def nearest(
    spark: SparkSession,
    embeddings: DataFrame,
    is_query: Column,
    k: int = 5,
    settings: ForestSettings = ForestSettings(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for every query row.

    ``is_query`` selects queries by the columns of embeddings; candidates are all rows but
    those with the query's own id. Nearest first, ties to the smaller id; fewer rows than k
    are all returned. The trees are fitted to at most ``sample`` rows (by hash of the id)
    and hold every row. Rows without id, with an unusable vector (null, empty, zero, with
    null or non-finite components) or with another number of components than most of the
    sample take no part. Rows that repeat an id are one candidate, at its best score; of
    equal vectors only the k + 1 smallest ids can be among the nearest, so only they are
    put into leaves. No rows, or no usable one: no result.
    """
    picked = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    ).where("vec_id is not null")
    form = "vec_id long, vector binary"
    sampled = (
        picked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.sample)
        .select("vec_id", "vector").mapInArrow(partial(_checked, size=None), form).toArrow()
    )
    sample = _vectors(sampled["vector"])
    sizes = np.bincount([len(v) for v in sample], minlength=1)
    size = int(sizes.argmax()) if len(sample) else 0
    table = np.unique(_unit([v for v in sample if len(v) == size]), axis=0) if size else None
    forest = [] if table is None else [grow(table, settings, n) for n in range(settings.trees)]
    trees = spark.sparkContext.broadcast(forest)
    only = partial(_checked, size=size)
    checked = stored(spark, picked.select("vec_id", "vector").mapInArrow(only, form).distinct(), "ann-rows")
    queries = picked.where("asked").select("vec_id", "vector").mapInArrow(only, form).distinct()
    equal = Window.partitionBy("vector").orderBy("vec_id")
    kept = checked.withColumn("n", F.row_number().over(equal)).where(F.col("n") <= k + 1).drop("n")
    kept = stored(spark, kept, "ann-kept")
    place = "tree int, leaf int, vec_id long, vector binary"
    rows = kept.mapInArrow(
        partial(_placed, forest=trees, queries=False, most=0), place
    )
    looks = queries.repartition(spark.sparkContext.defaultParallelism * 2, "vec_id").mapInArrow(
        partial(_placed, forest=trees, queries=True, most=settings.leaves), place
    )
    # leaves that hold many rows are cut into blocks; every block meets all their queries
    blocks = F.ceil(F.count(F.lit(1)) / F.lit(settings.block)).cast("int")
    counts = rows.groupBy("tree", "leaf").agg(blocks.alias("blocks"))
    large = stored(spark, counts.where("blocks > 1"), "ann-large")
    group = F.expr(f"leaf div {settings.leaves_a_task}").alias("group")
    row_side = rows.join(large, ["tree", "leaf"], "left").select(
        "tree", group, F.pmod(F.xxhash64("vec_id"), F.coalesce("blocks", F.lit(1))).cast("int").alias("block"),
        "leaf", "vec_id", "vector",
    )
    query_side = looks.join(large, ["tree", "leaf"], "left").select(
        "tree", group,
        F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("block"),
        "leaf", "vec_id", "vector",
    )

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        return _best(left, right, k)

    cell = ["tree", "group", "block"]
    ranked = (
        row_side.groupBy(*cell).cogroup(query_side.groupBy(*cell))
        .applyInArrow(best, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        ranked.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
