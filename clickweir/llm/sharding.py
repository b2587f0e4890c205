"""Sharding by a k-d tree over the documents' metadata.

A node that is to hold several shards is split across its widest metadata dimension, at
the weighted median (more exactly: at the share of bytes that its shards ask for), until
every leaf is one shard. Medians are found without sorting or moving rows: the bytes of a
node are summed in equal bins of the dimension, the bin that holds the cut is binned
again, until what is left to decide is below a tolerance. Only nodes x bins sums, whatever
the corpus, reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweir.llm.components import stored

BINS = 2048
WIDE = 31  # bits of a coordinate


@dataclass(frozen=True)
class ShardSettings:
    shards: int = 24
    dimensions: Sequence[str] = ("doc_id", "source", "lang", "n_chars")
    overhead: int = 8  # bytes a document counts beside its text
    tolerance: float = 0.0005  # of a shard's bytes, left undecided at a cut
    whole: float = 0.05  # of a shard's bytes: equal texts up to this are never divided
    rows_a_run: int = 2048  # documents that are numbered together


@dataclass
class Node:
    """Shards first .. first + count - 1; below it after the cut: left and right."""

    name: int
    first: int
    count: int
    axis: str = ""
    cut: int = 0
    exact: int | None = None  # cut among rows whose axis value equals ``cut``
    left: Node | None = field(default=None)
    right: Node | None = field(default=None)


def _coordinates(spark: SparkSession, rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Every dimension scaled to 0 .. 2^31 - 1 over the corpus, then made unique enough.

    Rows of one text have the smallest values among them in every dimension, and the low 32
    bits are the text's checksum: no cut along a dimension falls between equal texts. A text
    of very many rows is a skewed key of the join, which adaptive execution splits.
    """
    numbers = {}
    for i, kind in kinds.items():
        if kind == "string":
            numbers[i] = F.crc32(F.col(i)).cast("double")
        else:
            value = F.expr(f"try_cast(`{i}` as double)")
            numbers[i] = F.when(F.abs(value) < 1e300, value)
    rows = rows.select("doc_id", "size", "text_crc32", *[c.alias(i) for i, c in numbers.items()])
    ends = rows.agg(
        *[F.min(i).alias(f"{i}_low") for i in kinds], *[F.max(i).alias(f"{i}_high") for i in kinds]
    ).first()
    alike = (
        rows.groupBy("text_crc32", "size")
        .agg(F.count(F.lit(1)).alias("copies"), *[F.min(i).alias(f"{i}_least") for i in kinds])
        .where("copies > 1")
    )
    rows = rows.join(alike, ["text_crc32", "size"], "left").withColumns(
        {i: F.when(F.col("copies") > 1, F.col(f"{i}_least")).otherwise(F.col(i)) for i in kinds}
    )
    out = []
    for i in kinds:
        low, high = ends[f"{i}_low"], ends[f"{i}_high"]
        scaled = F.lit(0)
        if low is not None and high > low:
            scaled = F.coalesce(
                F.floor((F.col(i) - low) / (high - low) * float((1 << WIDE) - 1)), F.lit(0)
            )
        out.append(F.shiftleft(scaled.cast("long"), 32).bitwiseOR(F.col("text_crc32")).alias(i))
    finest = F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32"), 1).alias("finest")
    return rows.select("doc_id", "size", "text_crc32", finest, *out)


def _leaf(node: Node, pick) -> Column:
    """An expression over the tree: ``pick`` of the leaf that a row falls into."""
    if node.left is None:
        return F.lit(pick(node))
    below = F.col(node.axis) < node.cut
    if node.exact is not None:
        below = below | ((F.col(node.axis) == node.cut) & (F.col("finest") < node.exact))
    return F.when(below, _leaf(node.left, pick)).otherwise(_leaf(node.right, pick))


def _find_cuts(rows: DataFrame, root: Node, level: list[Node], axes, target: float, settings):
    """Choose axis and cut of every node of a level."""
    at = rows.withColumn("node", _leaf(root, lambda n: n.name))
    spans = at.groupBy("node").agg(
        F.sum("size").alias("bytes"),
        *[F.min(i).alias(f"{i}_low") for i in axes], *[F.max(i).alias(f"{i}_high") for i in axes],
    )
    found = {row["node"]: row for row in spans.collect()}  # one row a node
    open_nodes: dict[int, dict] = {}
    for node in level:
        row = found.get(node.name)
        if row is None:  # nothing to share out: any cut will do
            node.axis, node.cut = axes[0], 0
            continue
        width = {i: (row[f"{i}_high"] >> 32) - (row[f"{i}_low"] >> 32) for i in axes}
        node.axis = max(axes, key=lambda i: (width[i], row[f"{i}_high"] - row[f"{i}_low"]))
        open_nodes[node.name] = {
            "node": node, "column": node.axis, "within": None,
            "low": row[f"{node.axis}_low"], "high": row[f"{node.axis}_high"],
            "before": 0, "goal": row["bytes"] * (node.count // 2) / node.count,
        }
    slack = settings.tolerance * target
    while open_nodes:
        names = list(open_nodes)
        value, low, step, inside = F.lit(None), F.lit(None), F.lit(None), F.lit(False)
        for name in names:
            state = open_nodes[name]
            here = F.col("node") == name
            state["step"] = max(1, -(-(state["high"] - state["low"] + 1) // BINS))
            if state["within"] is not None:
                here = here & (F.col(state["node"].axis) == state["within"])
            bounded = here & F.col(state["column"]).between(state["low"], state["high"])
            inside = inside | bounded
            value = F.when(F.col("node") == name, F.col(state["column"])).otherwise(value)
            low = F.when(F.col("node") == name, F.lit(state["low"])).otherwise(low)
            step = F.when(F.col("node") == name, F.lit(state["step"])).otherwise(step)
        sums = (
            at.where(inside)
            .select("node", "size", value.cast("long").alias("v"), low.cast("long").alias("low"), step.cast("long").alias("step"))
            .withColumn("bin", F.expr("(v - low) div step"))
            .groupBy("node", "bin")
            .agg(F.sum("size").alias("bytes"), F.min("v").alias("low"), F.max("v").alias("high"))
            .collect()  # at most BINS rows a node
        )
        by_node: dict[int, list] = {name: [] for name in names}
        for row in sorted(sums, key=lambda row: (row["node"], row["bin"])):
            by_node[row["node"]].append(row)
        for name in names:
            state = open_nodes[name]
            node, total, chosen = state["node"], state["before"], by_node[name][-1]
            for row in by_node[name]:
                if total + row["bytes"] >= state["goal"]:
                    chosen = row
                    break
                total += row["bytes"]
            single = chosen["low"] == chosen["high"]
            if single and state["within"] is None and chosen["bytes"] > settings.whole * target:
                # copies of one text, too many to stay together: cut by the finest value
                open_nodes[name] = state | {
                    "within": chosen["low"], "column": "finest", "before": total,
                    "low": 0, "high": (1 << 63) - 1,
                }
                continue
            if not single and chosen["bytes"] > slack:
                state.update(low=chosen["low"], high=chosen["high"], before=total)
                continue
            nearer = state["goal"] - total <= total + chosen["bytes"] - state["goal"]
            cut = chosen["low"] if nearer else chosen["high"] + 1
            if state["within"] is None:
                node.cut = cut
            else:
                node.cut, node.exact = state["within"], cut
            del open_nodes[name]


def shard(
    spark: SparkSession,
    documents: DataFrame,
    settings: ShardSettings = ShardSettings(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    Sizes of the shards are near equal (law ``bytes``): a cut misses its share by at most
    half of a document, of the tolerance, or of a group of equal texts. Equal texts are in
    one shard, unless together they have more than the share ``whole`` of a shard's bytes:
    such a group may be divided by a cut, as keeping it would set the sizes apart.
    Null text: no bytes, checksum 0. Null, NaN or infinite metadata lies at the lower end
    of its dimension; dimensions that the table lacks are left out. Null ids and repeated
    rows are documents like others. Slots number a shard's rows from 0: runs of hashed ids
    are numbered apart and shifted. No documents, no rows.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    kinds, columns = {}, []
    types = dict(documents.dtypes)
    for i, name in enumerate(x for x in settings.dimensions if x in types):
        kinds[f"axis{i}"] = types[name]
        columns.append(F.col(name).alias(f"axis{i}"))
    if not kinds:
        kinds["axis0"] = "bigint"
        columns.append(F.lit(0).alias("axis0"))
    slim = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (F.octet_length(text) + settings.overhead).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        *columns,
    )
    slim = stored(spark, slim, "shard-metadata")
    rows = stored(spark, _coordinates(spark, slim, kinds), "shard-axes")
    total = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    root = Node(0, 0, settings.shards)
    names = 1
    level = [root] if root.count > 1 else []
    while level:
        _find_cuts(rows, root, level, list(kinds), (total["bytes"] or 0) / settings.shards, settings)
        following = []
        for node in level:
            half = node.count // 2
            node.left = Node(names, node.first, half)
            node.right = Node(names + 1, node.first + half, node.count - half)
            names += 2
            following += [n for n in (node.left, node.right) if n.count > 1]
        level = following
    runs = max(1, -(-total["n"] // (settings.shards * settings.rows_a_run)))
    placed = rows.select(
        "doc_id", "size", "text_crc32", "finest", _leaf(root, lambda n: n.first).alias("shard")
    ).withColumn("run", F.col("finest") % runs)
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy("shard", "run")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    )
    inside = Window.partitionBy("shard", "run").orderBy("finest", "doc_id", "size")
    return (
        placed.withColumn("number", F.row_number().over(inside))
        .join(shifts, ["shard", "run"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("shift") + F.col("number") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
