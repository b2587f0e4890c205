"""Exact offset ranges and row limits over a stored envelope, without sorting it.

A limit of n rows per topic partition means: rows up to the offset of the n-th
one. That offset is found from counts per offset bucket; only the bucket that
holds it is looked at row by row. No task ever sees more than one bucket of a
partition, whatever the size of the partition or of the limit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickweir.session import fresh_folder

BUCKET_BITS = 20
PLAIN_CONDITIONS = 64  # topic partitions that are named one by one in a filter
RANGE = ["_range", "_topic", "partition"]


@dataclass(frozen=True)
class OffsetRange:
    """Rows of partitions ``first..last`` (all when None) from ``start`` on.

    ``limit`` counts rows over the whole range, lowest (partition, offset) first;
    None means no limit. ``starts`` gives single partitions their own start.
    """

    first: int | None
    last: int | None
    start: int = 0
    limit: int | None = None
    starts: tuple[tuple[int, int], ...] = ()

    def condition(self):
        partition, offset = F.col("partition"), F.col("offset")
        inside = F.lit(True)
        if self.first is not None:
            inside = partition.between(self.first, self.last)
        own = [number for number, _ in self.starts]
        from_start = offset >= self.start
        if own:
            from_start = ~partition.isin(*own) & from_start
            for number, start in self.starts:
                from_start = from_start | ((partition == number) & (offset >= start))
        return inside & from_start


@dataclass(frozen=True)
class Taken:
    """What a step takes of one topic partition: the offsets from ``first`` to ``last``."""

    range: int
    topic: str
    partition: int
    first: int
    last: int
    rows: int


def select_ranges(
    messages: DataFrame,
    ranges: Sequence[OffsetRange],
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """Messages inside the given, non-overlapping ranges, limits applied exactly.

    The ranges come first as one plain condition, which reaches the scan. Every topic
    has its own ranges and limits, where the envelope names one.
    """
    open_ended = [n for n, part in enumerate(ranges) if part.limit is None]
    tagged = _tagged(messages, ranges)
    if len(open_ended) == len(ranges):
        return tagged.select(*messages.columns)
    positions = _limited(tagged, ranges)
    cutoffs = _cutoffs(_counts(positions, bucket_bits), positions, ranges, bucket_bits, {})
    # at most one row per topic partition
    joined = tagged.join(F.broadcast(cutoffs), RANGE, "left")
    within = F.col("offset") <= F.col("_cutoff")
    if open_ended:
        within = within | F.col("_range").isin(*open_ended)
    return joined.where(within).select(*messages.columns)


def take_ranges(
    messages: DataFrame,
    ranges: Sequence[OffsetRange],
    used: Mapping[int, int] | None = None,
    bucket_bits: int = BUCKET_BITS,
) -> tuple[DataFrame, list[Taken]]:
    """The same rows, and what they are, found out before they are read.

    ``used``: rows that earlier steps have taken of a range's limit. The counts per offset
    bucket are stored once in the shared folder and everything else is worked out from them;
    the driver sees one row a topic partition. The rows are then named by their first and
    last offsets, so reading them again gives the same ones, also from a source that grows.
    """
    spark = messages.sparkSession
    tagged = _tagged(messages, ranges)
    positions = tagged.select(*RANGE, "offset")
    folder = fresh_folder(spark, "offset-counts")
    _counts(positions, bucket_bits).write.parquet(folder)
    counts = spark.read.parquet(folder)
    totals = counts.groupBy(*RANGE).agg(
        F.min("_first").alias("_first"), F.max("_top").alias("_top"), F.sum("_rows").alias("_total")
    )
    limited = counts.where(F.col("_range").isin(*_limited_numbers(ranges)))
    cutoffs = _cutoffs(limited, positions, ranges, bucket_bits, used or {}, with_rows=True)
    found = totals.join(cutoffs, RANGE, "left").collect()  # one row a topic partition
    taken = []
    for row in found:
        last, rows = row["_cutoff"], row["_taken"]
        if ranges[row["_range"]].limit is None:
            last, rows = row["_top"], row["_total"]
        if last is not None:
            taken.append(
                Taken(row["_range"], row["_topic"], row["partition"], row["_first"], last, rows)
            )
    return _rows_of(messages, taken), taken


def _rows_of(messages: DataFrame, taken: Sequence[Taken]) -> DataFrame:
    """The messages at these offsets: a condition where it is short, else a small join."""
    if not taken:
        return messages.limit(0)
    topic = F.coalesce(F.col("topic"), F.lit("")) if "topic" in messages.columns else F.lit("")
    if len(taken) <= PLAIN_CONDITIONS:
        inside = F.lit(False)
        for part in taken:
            own = (F.col("partition") == part.partition) & F.col("offset").between(part.first, part.last)
            inside = inside | (own & (topic == part.topic))
        return messages.where(inside)
    spark = messages.sparkSession
    table = spark.createDataFrame(
        [(part.topic, part.partition, part.first, part.last) for part in taken],
        "_topic string, _partition int, _first long, _last long",
    )
    # one row a topic partition, as collected
    same = (
        (topic == F.col("_topic"))
        & (F.col("partition") == F.col("_partition"))
        & F.col("offset").between(F.col("_first"), F.col("_last"))
    )
    return messages.join(F.broadcast(table), same, "left_semi")


def _tagged(messages: DataFrame, ranges: Sequence[OffsetRange]) -> DataFrame:
    """The messages inside the ranges, with the range and topic of each."""
    tag, inside = F, F.lit(False)
    for number, part in enumerate(ranges):
        tag = tag.when(part.condition(), F.lit(number))
        inside = inside | part.condition()
    topic = F.col("topic") if "topic" in messages.columns else F.lit(None).cast("string")
    return (
        messages.where(inside)
        .withColumn("_range", tag)
        .withColumn("_topic", F.coalesce(topic, F.lit("")))
    )


def _limited_numbers(ranges: Sequence[OffsetRange]) -> list[int]:
    return [n for n, part in enumerate(ranges) if part.limit is not None]


def _limited(tagged: DataFrame, ranges: Sequence[OffsetRange]) -> DataFrame:
    return tagged.where(F.col("_range").isin(*_limited_numbers(ranges))).select(*RANGE, "offset")


def _counts(positions: DataFrame, bucket_bits: int) -> DataFrame:
    """Rows of every offset bucket, and its first and last offset."""
    return positions.groupBy(*RANGE, F.shiftright("offset", bucket_bits).alias("_slot")).agg(
        F.count("*").alias("_rows"), F.min("offset").alias("_first"), F.max("offset").alias("_top")
    )


def _cutoffs(
    counts: DataFrame,
    positions: DataFrame,
    ranges: Sequence[OffsetRange],
    bucket_bits: int,
    used: Mapping[int, int],
    with_rows: bool = False,
) -> DataFrame:
    """(range, topic, partition) -> highest offset still inside the limit (and the rows)."""
    limits = F
    for number in _limited_numbers(ranges):
        left = max(ranges[number].limit - used.get(number, 0), 0)
        limits = limits.when(F.col("_range") == number, F.lit(left))
    if limits is F:
        limits = F.lit(None).cast("bigint")
    slot = F.shiftright("offset", bucket_bits)

    # rows of a range in lower partitions; one row per topic partition here
    totals = counts.groupBy(*RANGE).agg(F.sum("_rows").alias("_total"))
    earlier = (
        W.partitionBy("_range", "_topic")
        .orderBy("partition")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_total").over(earlier), F.lit(0))
    quotas = totals.select(
        *RANGE, "_total", (limits - before).cast("bigint").alias("_quota")
    )

    along = W.partitionBy(*RANGE).orderBy("_slot")
    reached = F.sum("_rows").over(along)
    filled = (
        counts.withColumn("_reached", reached)
        .join(F.broadcast(quotas), RANGE)
        .withColumn("_needed", F.col("_quota") - F.col("_reached") + F.col("_rows"))
        .where(F.col("_needed") > 0)
        .withColumn("_taken", F.least("_quota", "_total"))
    )
    # buckets taken whole need no look at their rows
    whole = filled.where(F.col("_needed") >= F.col("_rows")).select(
        *RANGE, "_taken", F.col("_top").alias("_cutoff")
    )
    split = filled.where(F.col("_needed") < F.col("_rows")).select(
        *RANGE, "_slot", "_needed", "_taken"
    )
    inside = positions.withColumn("_slot", slot).join(
        F.broadcast(split), [*RANGE, "_slot"]
    )
    order = W.partitionBy(*RANGE).orderBy("offset")
    partial = (
        inside.withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") == F.col("_needed"))
        .select(*RANGE, "_taken", F.col("offset").alias("_cutoff"))
    )
    found = whole.unionByName(partial).groupBy(*RANGE).agg(
        F.max("_cutoff").alias("_cutoff"), F.max("_taken").alias("_taken")
    )
    return found if with_rows else found.drop("_taken")
