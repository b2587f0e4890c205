"""Keyed results of a stream as a table that can be read while it is written.

Every micro-batch writes the rows it changed as one more segment, a folder that nothing
overwrites, and then publishes a manifest that names it. A reader takes the segments of one
manifest and folds them to the latest row per key, so it sees whole batches only, and the
same ones for as long as it reads. A batch that is replayed after a failure finds that it
has been published.

Compaction merges the segments of a level, once there are enough of them, into one of the
next level, beside the running query: both publish by adding a version, and the later one
takes up what the earlier one did. Segments may be laid out by slices of a time column;
what has expired is then dropped by slices, without reading or rewriting any.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from clickweir.session import prepare_streaming
from clickweir.sinks.manifests import Manifest, ManifestLog

CHANGE = "change_number"  # which of two rows of a key is the later one
SLICE = "time_slice"
SEGMENT = "segment"
FANOUT = 8  # segments of a level that are merged
TRIES = 20


class TwoWriters(RuntimeError):
    """Another stream has written to the table meanwhile."""


def manifests(spark: SparkSession, path: str) -> ManifestLog:
    return ManifestLog(spark, f"{path.rstrip('/')}/manifests")


def start_keyed(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    output_mode: str = "update",
    name: str | None = None,
    slices: tuple[str, int] | None = None,
) -> StreamingQuery:
    """Write every change of ``changes`` to the table at ``path``; one stream a table.

    ``slices``: a BIGINT time column and the width of a slice in its unit, for a table
    that is to expire. Rows without a time are in slice 0.
    """
    prepare_streaming(changes.sparkSession)
    log = manifests(changes.sparkSession, path)
    stream = checkpoint.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        before = log.latest()
        if has_batch(before, stream, batch_id):
            # its rows are there; the stream's state has still to be brought up to them
            batch.write.format("noop").mode("overwrite").save()
            return
        number = before.state.get("changes", -1) + 1
        segment = uuid.uuid4().hex
        _write_segment(batch.withColumn(CHANGE, F.lit(number).cast("long")), path, segment, slices)
        part = {SEGMENT: segment, "level": 0}
        watermark = watermark_of(log, stream, batch_id)

        def add(latest: Manifest):
            if latest.state.get("changes", -1) != number - 1:
                raise TwoWriters(f"{path} has changes of another stream")
            state = {**latest.state, "changes": number, "stream": stream, "batch": batch_id}
            if watermark is not None:
                state["watermark"] = watermark
            if slices:
                state["slices"] = list(slices)
            return state, [part], None

        publish(log, add)

    writer = (
        changes.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"availableNow": True}))
    )
    if name:
        writer = writer.queryName(name)
    return writer.start()


def has_batch(manifest: Manifest, stream: str, batch_id: int) -> bool:
    """Whether that micro-batch of the stream has been published."""
    state = manifest.state
    return state.get("stream") == stream and state["batch"] >= batch_id


def publish(log: ManifestLog, make: Callable[[Manifest], tuple | None]) -> bool:
    """Publish what ``make`` makes of the latest manifest, as often as others are faster."""
    for _ in range(TRIES):
        latest = log.latest()
        made = make(latest)
        if made is None:
            return False
        if log.publish(latest.version + 1, *made):
            return True
    raise RuntimeError(f"{log.path}: {TRIES} other writers were faster")


def watermark_of(log: ManifestLog, checkpoint: str, batch_id: int) -> int | None:
    """The event time, in ms, before which that micro-batch closed everything."""
    text = log.text(f"{checkpoint}/offsets/{batch_id}")
    if text is None:
        return None
    lines = text.splitlines()  # a version, the batch's metadata, and the sources' offsets
    return json.loads(lines[1]).get("batchWatermarkMs") if len(lines) > 1 else None


def _write_segment(
    rows: DataFrame, path: str, segment: str, slices: Sequence | None
) -> None:
    piece = F.lit(0)
    if slices:
        column, width = slices
        piece = F.coalesce(F.floor(F.col(column) / F.lit(width)), F.lit(0))
    rows.withColumn(SLICE, piece.cast("long")).write.partitionBy(SLICE).parquet(
        f"{path}/data/{SEGMENT}={segment}"
    )


def _segments(
    spark: SparkSession, path: str, schema: StructType, manifest: Manifest, segments: Sequence[str]
) -> DataFrame:
    """The rows of some segments that have not expired."""
    full = StructType(
        [*schema.fields, StructField(CHANGE, LongType()), StructField(SLICE, LongType())]
    )
    paths = [f"{path}/data/{SEGMENT}={name}" for name in segments]
    rows = spark.read.schema(full).option("basePath", f"{path}/data").parquet(*paths)
    floor = manifest.state.get("floor")
    return rows if floor is None else rows.where(F.col(SLICE) >= floor)


def _folded(rows: DataFrame, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The latest row of every key, and the number of its change."""
    values = [name for name in schema.fieldNames() if name not in keys]
    # column by column, which keeps fixed-width columns in a hash aggregation
    return rows.groupBy(*keys).agg(
        *[F.max_by(name, CHANGE).alias(name) for name in values], F.max(CHANGE).alias(CHANGE)
    )


def _typed(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_keyed(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    keys: Sequence[str],
    version: int | None = None,
) -> DataFrame:
    """The table as of a version, the latest one by default: per key its latest row.

    One aggregation over the segments with map-side combine. A text column that the key
    determines is better listed among the keys. The frame stays as it is while the stream
    and compaction go on, until ``vacuum_keyed`` forgets its version.
    """
    schema = _typed(schema)
    log = manifests(spark, path)
    manifest = log.latest() if version is None else log.read(version)
    names = [part[SEGMENT] for part in log.parts(manifest.version)]
    if not names:
        return spark.createDataFrame([], schema)
    rows = _segments(spark, path, schema, manifest, names)
    return _folded(rows, schema, keys).select(*schema.fieldNames())


def compact_keyed(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    keys: Sequence[str],
    fanout: int = FANOUT,
) -> int:
    """Merge the segments of the lowest level that has ``fanout`` of them; returns how many.

    Safe beside the running query and readers. Of each row the change's number is kept, so
    the order of segments does not matter. Called after every few batches, a row is
    rewritten once a level, and the levels grow with the logarithm of the table.
    """
    schema = _typed(schema)
    log = manifests(spark, path)
    before = log.latest()
    levels: dict[int, list[str]] = {}
    for part in log.parts(before.version):
        levels.setdefault(part["level"], []).append(part[SEGMENT])
    full = [level for level, names in sorted(levels.items()) if len(names) >= fanout]
    if not full:
        return 0
    level, names = full[0], levels[full[0]]
    merged = uuid.uuid4().hex
    rows = _folded(_segments(spark, path, schema, before, names), schema, keys)
    _write_segment(rows, path, merged, before.state.get("slices"))

    def swap(latest: Manifest):
        parts = log.parts(latest.version)
        if not {part[SEGMENT] for part in parts} >= set(names):
            return None  # another compaction has merged them
        kept = [part for part in parts if part[SEGMENT] not in names]
        return latest.state, [], [{SEGMENT: merged, "level": level + 1}, *kept]

    return len(names) if publish(log, swap) else 0


def expire_keyed(spark: SparkSession, path: str, retention: int) -> int | None:
    """Drop the slices that ended more than ``retention`` before the stream's watermark.

    Nothing is read or rewritten: readers leave the slices out from the next version on, and
    compaction does not carry them over. A row that the stream may still change is never in
    them. Returns the first slice that is kept; None for a table without slices or watermark.
    """
    log = manifests(spark, path)
    kept: list[int] = []

    def raise_floor(latest: Manifest):
        kept.clear()
        slices, watermark = latest.state.get("slices"), latest.state.get("watermark")
        if not slices or not watermark:
            return None
        floor = (watermark - retention) // slices[1]
        kept.append(max(floor, latest.state.get("floor", floor)))
        if latest.state.get("floor") == kept[0]:
            return None
        return {**latest.state, "floor": kept[0]}, [], None

    publish(log, raise_floor)
    return kept[0] if kept else None


def vacuum_keyed(spark: SparkSession, path: str, versions: int = 100) -> int:
    """Delete segments and slices that none of the last ``versions`` manifests shows.

    Segments younger than the oldest of these may be about to be published and stay.
    Returns how many folders were deleted.
    """
    log = manifests(spark, path)
    known = log.versions()
    if not known:
        return 0
    recent = known[-versions:]
    shown = {part[SEGMENT] for version in recent for part in log.parts(version)}
    floors = [log.read(version).state.get("floor") for version in recent]
    since = log.time_of(recent[0])
    deleted = 0
    for folder, modified in log.children_with_times(f"{path}/data"):
        name = folder.removeprefix(f"{SEGMENT}=")
        if name not in shown:
            if modified < since:
                log.remove(f"{path}/data/{folder}")
                deleted += 1
        elif None not in floors:
            for piece in log.children(f"{path}/data/{folder}"):
                if piece.startswith(f"{SLICE}=") and int(piece.split("=")[1]) < min(floors):
                    log.remove(f"{path}/data/{folder}/{piece}")
                    deleted += 1
    return deleted
