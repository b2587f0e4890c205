"""Centroid clustering against plain integers, and its edge cases."""

import hashlib
import math
import random

from llm_helpers import table_of

from clickweir.llm import queries as registered
from clickweir.llm.centroids import LARGEST, WIDE, ClusterSettings, cluster

SCHEMA = "vec_id long, embedding array<float>, label int"
DOUBLES = "vec_id long, embedding array<double>"


def plain(rows, size=64, clusters=40, rounds=5, bound=None):
    kept = []
    for vec_id, vector, *_ in rows:
        if vector is None or len(vector) != size:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(x * 256) if abs(x) < 1e300 else int(math.copysign(1 << 1000, x)) for x in vector]
        if bound:
            whole = [max(-bound, min(bound, x)) for x in whole]
        kept.append((vec_id, whole))
    name = lambda v: "" if v is None else str(v)
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{name(r[0])}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for k, own in groups.items():
            centroids[k] = [sum(column) // len(own) for column in zip(*own)]
    found = [(vec_id, *near(v)) for vec_id, v in kept]
    sums = {}
    for _, d, k in found:
        sums[k] = sums.get(k, 0) + d
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    cut = lambda x: min(x, LARGEST)
    return sorted(
        ((i, k, cut(d), cut(sums[k]), cut(sum(sums.values())), text[k]) for i, d, k in found), key=repr
    )


def as_rows(frame):
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in frame.select(names).collect()), key=repr)


def vectors(seed, count, scale=1.0):
    pick = random.Random(seed)
    import numpy as np

    return [
        (i, [float(np.float32(pick.gauss(0, scale))) for _ in range(64)], 0) for i in range(count)
    ]


def test_messy_vectors(spark, tmp_path):
    rows = vectors(1, 60)
    rows += [rows[3], (3, rows[4][1], 1), (None, rows[5][1], None), (None, rows[6][1], None)]
    nan, inf = float("nan"), float("inf")
    rows += [
        (100, None, 1), (101, [], 1), (102, [1.0] * 63, 1), (103, [0.0] * 64, 1),
        (104, [nan] + [0.0] * 63, 1), (105, [inf] + [0.0] * 63, 1), (106, [None] + [0.0] * 63, 1),
        (107, [-0.001] * 64, None), (108, [-0.0] * 64, 2),
    ]
    names = "v x best k length cluster distance centroid of".split()
    path = table_of(spark, tmp_path, "embeddings", rows, SCHEMA, names)
    got = as_rows(registered.op13_centroid_clustering(spark, path))
    assert got == plain(rows)
    assert {r[0] for r in got} >= {103, 107, 108} and not {r[0] for r in got} & {100, 101, 102, 104, 105, 106}


def test_empty_clusters_and_few_vectors(spark, tmp_path):
    rows = [(i, [float(i % 2)] * 64, 0) for i in range(50)]  # two different vectors
    path = table_of(spark, tmp_path, "embeddings", rows, SCHEMA)
    assert as_rows(registered.op13_centroid_clustering(spark, path)) == plain(rows)
    path = table_of(spark, tmp_path / "few", "embeddings", rows[:3], SCHEMA)
    assert as_rows(registered.op13_centroid_clustering(spark, path)) == plain(rows[:3])
    path = table_of(spark, tmp_path / "none", "embeddings", [], SCHEMA)
    assert registered.op13_centroid_clustering(spark, path).collect() == []


def test_large_components_are_exact(spark):
    # beyond what 64 bits hold distances are counted in decimals
    pick = random.Random(4)
    for scale in (1e4, 1e7, 1e12, 1e290):
        rows = [(i, [pick.uniform(-scale, scale) for _ in range(4)]) for i in range(20)]
        frame = spark.createDataFrame(rows, DOUBLES)
        settings = ClusterSettings(size=4, clusters=3, rounds=2)
        found = cluster(spark, frame, settings).collect()
        want = plain(rows, size=4, clusters=3, rounds=2, bound=WIDE)
        got = sorted(
            (
                (
                    r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"],
                    hashlib.sha256(",".join(map(str, r["centroid"])).encode()).hexdigest(),
                )
                for r in found
            ),
            key=repr,
        )
        assert got == want
