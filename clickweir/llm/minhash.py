"""Near-duplicate documents by circulant MinHash, confirmed on their full shingle sets.

One hash permutes the shingles into a large ring and a second, stored permutation gives
the ring's values. Shifting the second one circularly by k makes coordinate k of the
signature: the smallest value that any shingle of the document meets. A shingle's values
for all shifts lie side by side, so a signature is the minimum over rows of a table.
Bands of coordinates bring candidates together; links are confirmed exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweir.llm.components import components, stored, unused
from clickweir.llm.words import SPACE, mix, portions, shingle_sets

# ids up to this many (8 bytes each) may be sent to every executor
BROADCAST_IDS = 500_000
# buckets with more open classes than PAIRED are compared in blocks inside tasks
PAIRED = 16
BLOCK = 1024
PORTION_BYTES = 512 << 10  # of text at once


@dataclass(frozen=True)
class MinHashSettings:
    """32 bands of 4: a pair at similarity 0.75 is missed with probability 5e-6."""

    shingle_words: int = 5
    percent: int = 75
    bands: int = 32
    rows: int = 4
    ring_bits: int = 20
    seed: int = 7


_rings: dict[tuple[int, int, int], np.ndarray] = {}


def _ring(settings: MinHashSettings) -> np.ndarray:
    """Row p: the values that position p meets under every circular shift."""
    width = settings.bands * settings.rows
    key = (settings.ring_bits, settings.seed, width)
    if key not in _rings:
        order = np.random.Generator(np.random.PCG64(settings.seed)).permutation(
            np.uint32(1 << settings.ring_bits)
        )
        around = np.concatenate([order, order[:width]]).astype(np.uint32)
        _rings[key] = np.lib.stride_tricks.sliding_window_view(around, width)
    return _rings[key]


def signature(shingles: np.ndarray, settings: MinHashSettings) -> np.ndarray:
    """All coordinates of a non-empty set of shingle hashes."""
    ring = _ring(settings)
    positions = mix(shingles + np.uint64(settings.seed)) >> np.uint64(64 - settings.ring_bits)
    lowest = np.full(ring.shape[1], np.iinfo(np.uint32).max, dtype=np.uint32)
    for first in range(0, len(positions), 2048):
        np.minimum(lowest, ring[positions[first : first + 2048]].min(axis=0), out=lowest)
    return lowest


def band_keys(coordinates: np.ndarray, settings: MinHashSettings) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    table = coordinates.reshape(settings.bands, settings.rows).astype(np.uint64)
    keys = mix(np.arange(1, settings.bands + 1, dtype=np.uint64))
    for place in range(settings.rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + table[:, place])
    return keys.view(np.int64)


_SIGNED = "doc_id long, n_shingles long, same binary, bands array<long>"


def _sign(
    batches: Iterator[pa.RecordBatch], settings: MinHashSettings
) -> Iterator[pa.RecordBatch]:
    nothing = np.zeros(0, dtype=np.int64)
    for batch in portions(batches, most=PORTION_BYTES):
        counts, same, bands = [], [], []
        for shingles in shingle_sets(batch.column(1), settings.shingle_words, SPACE):
            counts.append(len(shingles))
            if len(shingles):
                same.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                bands.append(band_keys(signature(shingles, settings), settings))
            else:
                same.append(None)
                bands.append(nothing)
        ends = np.cumsum([0, *map(len, bands)], dtype=np.int32)
        flat = np.concatenate([nothing, *bands])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(same, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            ],
            ["doc_id", "n_shingles", "same", "bands"],
        )


def _sets(
    batches: Iterator[pa.RecordBatch], settings: MinHashSettings
) -> Iterator[pa.RecordBatch]:
    nothing = np.zeros(0, dtype=np.int64)
    for batch in portions(batches, most=PORTION_BYTES):
        found = [
            x.view(np.int64)
            for x in shingle_sets(batch.column(1), settings.shingle_words, SPACE)
        ]
        ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
        flat = np.concatenate([nothing, *found])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
            ["id", "shingles"],
        )


def _texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of some documents; a short list of ids spares the texts a shuffle."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return texts.join(ids, "doc_id", "left_semi")


def _confirmed(
    texts: DataFrame, pairs: DataFrame, settings: MinHashSettings
) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, as links (u, v)."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = _texts_of(texts, ids).mapInArrow(
        partial(_sets, settings=settings), "id long, shingles array<long>"
    )
    second = sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))
    first = sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    return (
        pairs.join(second, "b")
        .join(first, "a")
        .withColumn("common", common)
        .where(
            F.lit(100) * F.col("common")
            >= F.lit(settings.percent) * (F.size("of_a") + F.size("of_b") - F.col("common"))
        )
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )


def _block_links(table: pa.Table, settings: MinHashSettings) -> pa.Table:
    """Links between the members of one bucket's two blocks (or within one block).

    Every intersection is counted exactly: one member's shingles are flagged, and the
    flags summed over the others. A link is returned only if it joins two components that
    the links before it have not joined, so there are fewer links than members.
    """
    ids = table["rep"].to_numpy()
    roots = table["root"].to_numpy()
    first = table["block"].to_numpy() == table["lo"].to_numpy()
    alone = table["lo"][0] == table["hi"][0]
    column = table["text"].combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    sets = list(shingle_sets(column, settings.shingle_words, SPACE))
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    _, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flags = np.zeros(len(numbers) + 1, dtype=np.int32)
    parent = {int(x): int(x) for x in roots}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found_u, found_v = [], []
    # each bucket row is a non-empty set, as reduceat needs
    for i in np.flatnonzero(first):
        own = numbers[starts[i] : starts[i + 1]]
        flags[own] = 1
        common = np.add.reduceat(flags[numbers], starts[:-1])
        flags[own] = 0
        near = 100 * common >= settings.percent * (sizes[i] + sizes - common)
        near &= (roots != roots[i]) & (~first if not alone else ids > ids[i])
        for j in np.flatnonzero(near):
            a, b = find(int(roots[i])), find(int(roots[j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                found_u.append(int(ids[i]))
                found_v.append(int(ids[j]))
    return pa.table({"u": pa.array(found_u, pa.int64()), "v": pa.array(found_v, pa.int64())})


def _links_in_blocks(
    texts: DataFrame, open_rows: DataFrame, settings: MinHashSettings
) -> DataFrame:
    """Links across components in the buckets of open_rows (key, rep, root, open)."""
    blocks = F.ceil(F.col("open") / F.lit(BLOCK)).cast("int")
    spread = (
        open_rows.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "key", "rep", "root", "block",
            F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        )
    )

    def links(table: pa.Table) -> pa.Table:
        return _block_links(table, settings)

    members = _texts_of(texts, open_rows.select(F.col("rep").alias("doc_id")).distinct())
    return (
        spread.join(members.withColumnRenamed("doc_id", "rep"), "rep")
        .groupBy("key", "lo", "hi")
        .applyInArrow(links, "u long, v long")
    )


def near_duplicates(
    spark: SparkSession,
    documents: DataFrame,
    settings: MinHashSettings = MinHashSettings(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of documents.

    Texts with one set are one class, stood for by its smallest id. In every band's
    bucket each class meets the bucket's smallest class; a bucket whose classes are then
    not in one component has its remaining classes of different components compared as
    well, pair by pair if they are few, else in blocks inside tasks that return fewer
    links than members. So no candidate pair that could join two components is left out,
    while groups of near copies cost one comparison a member and bucket.

    Null or empty text: an empty set, linked with nothing, component_id is the own id.
    Null id: counted, but no part of any link; component_id null, kept false. Rows that
    repeat an id are one document with several texts: each row is returned, with the
    component of the id. Other columns, whatever their names, are not read.
    """
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    signed = stored(
        spark, texts.mapInArrow(partial(_sign, settings=settings), _SIGNED), "minhash"
    )
    linkable = signed.where("doc_id is not null and same is not null")
    classes = linkable.groupBy("same").agg(F.min("doc_id").alias("rep"))
    members = linkable.join(classes, "same").select("doc_id", "rep", "bands")
    copies = members.where("doc_id <> rep").select(
        F.col("doc_id").alias("u"), F.col("rep").alias("v")
    )
    buckets = (
        members.where("doc_id = rep").select("rep", F.explode("bands").alias("key")).distinct()
    )
    firsts = (
        buckets.groupBy("key")
        .agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    shared = stored(spark, buckets.join(firsts, "key"), "minhash-buckets")
    stars = (
        shared.where("rep <> first")
        .select(F.col("first").alias("a"), F.col("rep").alias("b"))
        .distinct()
    )
    stars = stored(spark, stars, "minhash-pairs")
    links = stored(spark, _confirmed(texts, stars, settings), "minhash-links")
    found = components(spark, links)
    # what the stars left open: buckets of three and more that are not one component
    placed = (
        shared.where("n > 2")
        .join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .select("key", "rep", "first", F.coalesce("root", "rep").alias("root"))
    )
    split = (
        placed.groupBy("key")
        .agg(
            F.min("root").alias("low"), F.max("root").alias("high"),
            (F.count(F.lit(1)) - 1).alias("open"),
        )
        .where("low <> high")
        .select("key", "open")
    )
    left_open = stored(spark, placed.where("rep <> first").join(split, "key"), "minhash-open")
    few = left_open.where(F.col("open") <= PAIRED)
    one = few.select("key", F.col("rep").alias("a"), F.col("root").alias("root_a"))
    two = few.select("key", F.col("rep").alias("b"), F.col("root").alias("root_b"))
    rest = (
        one.join(two, "key")
        .where("a < b and root_a <> root_b")
        .select("a", "b")
        .distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    rest = stored(spark, rest, "minhash-pairs")
    if not rest.isEmpty():
        links = links.union(_confirmed(texts, rest, settings))
    many = left_open.where(F.col("open") > PAIRED)
    if not many.isEmpty():
        links = links.union(_links_in_blocks(texts, many, settings))
    roots = stored(spark, components(spark, links.union(copies)), "minhash-roots")
    return (
        signed.select("doc_id", "n_shingles")
        .join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("root", "doc_id").alias("component_id"),
            F.coalesce(F.coalesce("root", "doc_id") == F.col("doc_id"), F.lit(False)).alias(
                "kept"
            ),
        )
    )


def one_of_each(
    spark: SparkSession,
    documents: DataFrame,
    settings: MinHashSettings = MinHashSettings(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of documents, with all their columns, of the smallest id in each component.

    Texts that share an id are told apart: each is compared for itself, and of those that
    are linked with each other or with those of other ids one stays. Of rows that repeat
    both id and text one stays. Rows without id cannot be told apart and all stay.
    """
    node, row = unused(documents, "node"), unused(documents, "row")
    key = F.col(id_column).cast("long")
    hashed = F.xxhash64(text_column)
    ids = documents.select(key.alias("id"), hashed.alias("hash"))
    several = (
        ids.groupBy("id")
        .agg(F.min("hash").alias("low"), F.max("hash").alias("high"))
        .where("id is not null and low <> high")
        .select("id")
    )
    several = stored(spark, several, "minhash-several")
    distinct = several.isEmpty()
    if distinct:
        nodes = documents.withColumn(node, key)
    else:
        other = several.select(F.col("id").alias(row))
        own = F.when(F.col(row).isNotNull(), F.xxhash64(key, text_column)).otherwise(key)
        nodes = (
            documents.join(_small(other), key == F.col(row), "left").withColumn(node, own).drop(row)
        )
    found = near_duplicates(spark, nodes, settings, node, text_column)
    found = found.where("doc_id is not null").select(F.col("doc_id").alias("n"), "component_id", "kept")
    if distinct:
        removed = found.where("not kept").select("n").distinct()
    else:  # a component's smallest id, not its smallest node
        ids = nodes.select(F.col(node).alias("n"), key.alias("id")).distinct()
        placed = found.select("n", "component_id").distinct().join(ids, "n")
        placed = stored(spark, placed, "minhash-placed")
        least = placed.groupBy("component_id").agg(F.min(F.struct("id", "n")).alias("least"))
        removed = placed.select("n").join(least.select("least.n"), "n", "left_anti")
    removed = stored(spark, removed.select(F.col("n").alias(row)), "minhash-removed")
    left = nodes.join(_small(removed), F.col(node) == F.col(row), "left_anti")
    repeated = left.groupBy(F.col(node).alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    repeated = repeated.where("n is not null and rows > 1").select(F.col("n").alias(row))
    repeated = stored(spark, repeated, "minhash-repeated")
    if repeated.isEmpty():
        return left.drop(node)
    again = F.col(node) == F.col(row)
    first = Window.partitionBy(node).orderBy(hashed)
    one = (
        left.join(repeated, again, "left_semi")
        .withColumn(row, F.row_number().over(first))
        .where(F.col(row) == 1)
        .drop(row)
    )
    return left.join(repeated, again, "left_anti").union(one).drop(node)


def _small(ids: DataFrame) -> DataFrame:
    """Ids for a join: sent to every executor if they are few."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
