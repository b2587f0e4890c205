"""Near-duplicate embeddings by randomised-rotation binary codes.

A vector of length one is rotated at random; its code is the sign of every coordinate and
its correction factor the inner product of the rotated vector with its code. Dividing the
inner product of a rotated second vector with the code by that factor estimates the cosine
without bias, and the factor bounds the error. Only pairs whose bound reaches the
threshold are computed exactly.

Codes and factors are stored once, with the rotated vector in whole steps of one byte for the
other side of an estimate. Vectors meet in buckets of code bits from several rotations, and
only these short forms are sent there: a first pass keeps the members that may have a
partner, the second one fetches the vectors of those alone and decides. Pairs never leave a
task, which returns members, sums and fewer links than vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm.components import components, stored
from clickweir.llm.vectors import cosines, usable_vectors
from clickweir.llm.words import mix

BLOCK = 1024  # members of a bucket that meet as one side
SMALL = 64  # buckets up to this size share tasks
ROWS_A_TASK = 4096
PAIRS_AT_ONCE = 1 << 18
MET = ["key", "same", "block", "lo", "hi", "task"]  # a member in a bucket, or in two blocks of it


@dataclass(frozen=True)
class EmbedSettings:
    threshold: float = 0.98
    miss: float = 1e-6  # chance that a pair at the threshold shares no bucket
    deviations: float = 6.0  # width of the confidence bound, in standard deviations
    seed: int = 11


def bucket_shape(rows: int, settings: EmbedSettings) -> tuple[int, int]:
    """(bits, buckets): longer keys and more of them as the table grows."""
    bits = max(8, math.ceil(math.log2(max(rows, 1))) + 2)
    agree = (1 - math.acos(settings.threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(settings.miss) / math.log1p(-agree))


_rotations: dict[tuple[int, int, int], np.ndarray] = {}


def rotation(size: int, number: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix; the same in every process."""
    key = (size, number, seed)
    if key not in _rotations:
        if len(_rotations) > 64:
            _rotations.clear()
        gauss = np.random.Generator(np.random.PCG64([seed, number, size])).normal(size=(size, size))
        q, r = np.linalg.qr(gauss)
        _rotations[key] = q * np.sign(np.diag(r))
    return _rotations[key]


@dataclass(frozen=True)
class Codes:
    """Short forms of vectors with equally many components, row by row.

    ``signs`` are the packed signs of the rotated unit vector, ``factors`` its inner product
    with them, ``steps`` its coordinates as multiples of ``scales``, rounded to whole ones.
    """

    signs: np.ndarray
    factors: np.ndarray
    steps: np.ndarray
    scales: np.ndarray

    def __getitem__(self, rows) -> Codes:
        return Codes(self.signs[rows], self.factors[rows], self.steps[rows], self.scales[rows])


def encode(vectors: np.ndarray, seed: int) -> Codes:
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    rotated = unit @ rotation(vectors.shape[1], 0, seed)
    scales = np.abs(rotated).max(axis=1) / 127
    return Codes(
        np.packbits(rotated >= 0, axis=1),
        np.abs(rotated).sum(axis=1) / math.sqrt(vectors.shape[1]),
        np.rint(rotated / scales[:, None]).astype(np.int8),
        scales,
    )


def may_reach(left: Codes, right: Codes, settings: EmbedSettings) -> np.ndarray:
    """Whether a pair's cosine can be at the threshold, row by row, given its estimate.

    The left side's steps meet the right side's signs. For a pair at cosine t the estimate
    errs by a standard deviation of at most sqrt(1 - t^2) * sqrt(1 - f^2) / (f * sqrt(D - 1)),
    and by the rounding of the steps, at most half a step a coordinate.
    """
    size = left.steps.shape[1]
    signs = np.unpackbits(right.signs, axis=1, count=size).view(np.int8)
    steps = left.steps.astype(np.int16)
    # inner product with +1 and -1: twice the sum where the sign is +1, less the whole sum
    inner = 2 * (steps * signs).sum(axis=1, dtype=np.int32) - steps.sum(axis=1, dtype=np.int32)
    estimate = inner * left.scales / math.sqrt(size) / right.factors
    rounding = left.scales * math.sqrt(size) / 2 / right.factors
    spread = math.sqrt(max(0.0, 1 - settings.threshold**2) / max(size - 1, 1))
    bound = spread * np.sqrt(np.maximum(0.0, 1 - right.factors**2)) / right.factors
    return estimate + rounding + settings.deviations * bound + 1e-9 >= settings.threshold


def _keys(vectors: np.ndarray, bits: int, buckets: int, seed: int) -> np.ndarray:
    """``buckets`` keys for each vector, of ``bits`` sign bits each."""
    size = vectors.shape[1]
    need = bits * buckets
    signs = [
        vectors @ rotation(size, 1 + number, seed) >= 0 for number in range(-(-need // size))
    ]
    table = np.concatenate(signs, axis=1)[:, :need].reshape(len(vectors), buckets, bits)
    out = np.repeat(
        mix(np.arange(1, buckets + 1, dtype=np.uint64))[None, :], len(vectors), axis=0
    )
    for first in range(0, bits, 32):
        part = table[:, :, first : first + 32].astype(np.uint64)
        weights = np.uint64(1) << np.arange(part.shape[2], dtype=np.uint64)
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + (part * weights).sum(axis=2))
    return out


SHORT = ("signs", "factor", "steps", "scale")
_CODED = (
    "vec_id long, same binary, vector binary, keys array<long>, "
    "signs binary, factor double, steps binary, scale double"
)


def _code(
    batches: Iterator[pa.RecordBatch], bits: int, buckets: int, settings: EmbedSettings
) -> Iterator[pa.RecordBatch]:
    """The class of equal vectors with equal labels, their codes and the keys of their buckets."""
    for whole in batches:
        for first in range(0, whole.num_rows, 2048):
            batch = whole.slice(first, 2048)
            usable, vectors = usable_vectors(batch.column(2))
            labels = batch.column(1).to_pylist()
            rows = np.flatnonzero(usable)
            same: list[bytes | None] = [None] * batch.num_rows
            data: list[bytes | None] = [None] * batch.num_rows
            keys: list[list[int] | None] = [None] * batch.num_rows
            signs, steps = ([None] * batch.num_rows for _ in range(2))
            factors, scales = ([None] * batch.num_rows for _ in range(2))
            by_size: dict[int, list[int]] = {}
            for place, row in enumerate(rows.tolist()):
                if labels[row] is not None:
                    by_size.setdefault(len(vectors[place]), []).append(place)
            for size, places in by_size.items():
                table = np.stack([vectors[p] for p in places])
                found = _keys(table, bits, buckets, settings.seed)
                codes = encode(table, settings.seed)
                for at, (place, own) in enumerate(zip(places, found)):
                    row = rows[place]
                    name = f"{labels[row]}\x00{size}".encode()
                    salt = hashlib.blake2b(name, digest_size=8).digest()
                    data[row] = vectors[place].tobytes()
                    same[row] = hashlib.blake2b(salt + data[row], digest_size=16).digest()
                    keys[row] = mix(own + np.frombuffer(salt, dtype=np.uint64)).view(np.int64)
                    signs[row], steps[row] = codes.signs[at].tobytes(), codes.steps[at].tobytes()
                    factors[row], scales[row] = codes.factors[at], codes.scales[at]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(same, pa.binary()),
                    pa.array(data, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(signs, pa.binary()),
                    pa.array(factors, pa.float64()),
                    pa.array(steps, pa.binary()),
                    pa.array(scales, pa.float64()),
                ],
                ["vec_id", "same", "vector", "keys", *SHORT],
            )


class _Sums:
    """Link counts of a task's vectors, and links that join what was apart."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray) -> None:
        self.ids, self.weights = ids, weights
        self.counts = np.zeros(len(ids), dtype=np.int64)
        self.parent = np.arange(len(ids))
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def add(self, one: np.ndarray, two: np.ndarray) -> None:
        np.add.at(self.counts, one, self.weights[two])
        np.add.at(self.counts, two, self.weights[one])
        for i, j in zip(one.tolist(), two.tolist()):
            a, b = self.find(i), self.find(j)
            if a != b:
                self.parent[a] = b
                self.links.append((int(self.ids[i]), int(self.ids[j])))


def _pairs(order: np.ndarray, keys: np.ndarray, block, low, high):
    """Index pairs within each run of one key, in portions; across two blocks if they differ."""
    edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
    one, two, held = [], [], 0
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        members = order[begin:end]
        if low[members[0]] != high[members[0]]:
            left = members[block[members] == low[members[0]]]
            right = members[block[members] == high[members[0]]]
        else:
            left = right = members
        step = max(1, PAIRS_AT_ONCE // max(len(right), 1))
        for at in range(0, len(left), step):
            some = left[at : at + step]
            a = np.repeat(some, len(right))
            b = np.tile(right, len(some))
            if left is right:
                keep = np.repeat(np.arange(at, at + len(some)), len(right)) < np.tile(
                    np.arange(len(right)), len(some)
                )
                a, b = a[keep], b[keep]
            one.append(a)
            two.append(b)
            held += len(a)
            if held >= PAIRS_AT_ONCE:
                yield np.concatenate(one), np.concatenate(two)
                one, two, held = [], [], 0
    if held:
        yield np.concatenate(one), np.concatenate(two)


def _candidates(table: pa.Table, settings: EmbedSettings):
    """For each number of components: its rows, and index pairs into them that may reach."""
    ids, key = table["rep"].to_numpy(), table["key"].to_numpy()
    block, low, high = (table[c].to_numpy() for c in ("block", "lo", "hi"))
    signs, steps = (table[c].to_pylist() for c in ("signs", "steps"))
    factors, scales = table["factor"].to_numpy(), table["scale"].to_numpy()
    sizes = np.array([len(x) for x in steps])
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        codes = Codes(
            np.frombuffer(b"".join(signs[i] for i in rows), np.uint8).reshape(len(rows), -1),
            factors[rows],
            np.frombuffer(b"".join(steps[i] for i in rows), np.int8).reshape(len(rows), -1),
            scales[rows],
        )
        order = np.lexsort((ids[rows], key[rows]))

        def pairs(codes=codes, order=order, rows=rows):
            for one, two in _pairs(order, key[rows][order], block[rows], low[rows], high[rows]):
                maybe = may_reach(codes[one], codes[two], settings)
                yield one[maybe], two[maybe]

        yield rows, pairs()


def _screen(table: pa.Table, settings: EmbedSettings) -> pa.Table:
    """The members of the buckets at hand that may have a partner there."""
    kept = np.zeros(table.num_rows, dtype=bool)
    for rows, pairs in _candidates(table, settings):
        for one, two in pairs:
            kept[rows[one]] = kept[rows[two]] = True
    return table.filter(pa.array(kept)).select(MET)


def _decide(table: pa.Table, settings: EmbedSettings) -> pa.Table:
    """Rows with n links more for the class ``same``, or with a link between ids u and v."""
    ids = table["rep"].to_numpy()
    key = table["key"].to_numpy()
    weights = table["copies"].to_numpy()
    all_keys = np.array(table["keys"].to_pylist(), dtype=np.int64).reshape(len(ids), -1)
    raw = table["vector"].to_pylist()
    names = table["same"].to_pylist()
    out_same, out_u, out_v, out_n = [], [], [], []
    for rows, pairs in _candidates(table, settings):
        vectors = np.frombuffer(b"".join(raw[i] for i in rows), dtype=np.float64)
        vectors = vectors.reshape(len(rows), -1)
        sums = _Sums(ids[rows], weights[rows])
        for one, two in pairs:
            # a pair that shares several buckets is decided in the first of them
            shared = all_keys[rows[one]] == all_keys[rows[two]]
            here = all_keys[rows[one], shared.argmax(axis=1)] == key[rows[one]]
            one, two = one[here], two[here]
            linked = cosines(vectors[one], vectors[two]) >= settings.threshold
            sums.add(one[linked], two[linked])
        some = np.flatnonzero(sums.counts)
        out_same += [names[i] for i in rows[some]] + [None] * len(sums.links)
        out_u += [None] * len(some) + [u for u, _ in sums.links]
        out_v += [None] * len(some) + [v for _, v in sums.links]
        out_n += [int(x) for x in sums.counts[some]] + [0] * len(sums.links)
    return pa.table(
        {
            "same": pa.array(out_same, pa.binary()),
            "u": pa.array(out_u, pa.int64()),
            "v": pa.array(out_v, pa.int64()),
            "n": pa.array(out_n, pa.int64()),
        }
    )


def near_vectors(
    spark: SparkSession,
    embeddings: DataFrame,
    settings: EmbedSettings = EmbedSettings(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of embeddings.

    Vectors are compared if their labels are equal and not null and they have the same
    number of components. Equal vectors with equal labels are one class: its members are
    linked with each other and share its links, each counted. Unusable vectors (null,
    empty, zero, with null or non-finite components) and null labels: no links, component
    the own id. Null ids: no part of any link, component_id null, kept false. Rows that
    repeat an id count as vectors of their own and share the id's component. Other columns
    are not read.
    """
    vectors = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).cast("string").alias("label"),
        F.col(vector_column).alias("vector"),
    )
    bits, buckets = bucket_shape(vectors.count(), settings)
    coded = stored(
        spark,
        vectors.mapInArrow(partial(_code, bits=bits, buckets=buckets, settings=settings), _CODED),
        "vector-codes",
    )
    linkable = coded.where("vec_id is not null and same is not null")
    classes = stored(
        spark,
        linkable.groupBy("same").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")),
        "vector-classes",
    )
    members = (
        linkable.join(classes.withColumnRenamed("rep", "vec_id"), ["same", "vec_id"])
        .dropDuplicates(["same"])
        .select("same", F.col("vec_id").alias("rep"), "copies", "vector", "keys", *SHORT)
    )
    members = stored(spark, members, "vector-members")
    keyed = members.select("same", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    blocks = F.ceil(F.col("m") / F.lit(BLOCK)).cast("int")
    met = stored(spark, keyed.join(shared, "key"), "vector-buckets")
    tasks = max(1, met.count() // ROWS_A_TASK)
    spread = (
        met.withColumn("block", F.pmod(F.xxhash64("same"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "key", "same", "block",
            F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
            # a large bucket is a task of its own
            F.when(F.col("m") > SMALL, F.col("key"))
            .otherwise(F.pmod(F.xxhash64("key"), F.lit(tasks)))
            .alias("task"),
        )
    )

    def screen(table: pa.Table) -> pa.Table:
        return _screen(table, settings)

    def decide(table: pa.Table) -> pa.Table:
        return _decide(table, settings)

    # vectors and key lists go to the buckets of members that may have a partner, no others
    likely = stored(
        spark,
        spread.join(members.select("same", "rep", *SHORT), "same")
        .groupBy("task", "lo", "hi")
        .applyInArrow(screen, "key long, same binary, block int, lo int, hi int, task long"),
        "vector-likely",
    )
    found = stored(
        spark,
        likely.join(members, "same").groupBy("task", "lo", "hi").applyInArrow(
            decide, "same binary, u long, v long, n long"
        ),
        "vector-links",
    )
    counts = found.where("v is null").groupBy("same").agg(F.sum("n").alias("near"))
    placed = linkable.select("vec_id", "same").join(classes, "same")
    copies = placed.where("vec_id <> rep").select(F.col("vec_id").alias("u"), F.col("rep").alias("v"))
    links = found.where("v is not null").select("u", "v").union(copies)
    roots = stored(spark, components(spark, links), "vector-roots")
    root = F.coalesce("root", "vec_id")
    return (
        coded.select("vec_id", "same")
        .join(classes, "same", "left")
        .join(counts, "same", "left")
        .join(roots.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select(
            "vec_id",
            F.when(
                F.col("vec_id").isNotNull(),
                F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("near", F.lit(0)),
            ).otherwise(F.lit(0)).cast("long").alias("n_links"),
            root.alias("component_id"),
            F.coalesce(root == F.col("vec_id"), F.lit(False)).alias("kept"),
        )
    )
