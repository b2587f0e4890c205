"""Late rows kept: events with the watermark at which each was read.

A windowed aggregation drops what belongs to closed windows and tells only how many rows.
Here a stateless query stores every event with the watermark that held when it came. What
is late is then a plain condition on a stored row, an event and a window at a time, so the
counters that leave late rows out and the list of what they left out come from the same
rows: together they are every event in every window, however often either is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from clickweir.operators.windows import (
    COUNTERS,
    GRACE,
    WINDOW_HOP,
    WINDOW_SIZE,
    counted_windows,
    with_event_time,
)
from clickweir.sinks.manifests import Manifest
from clickweir.streaming.keyed import (
    SEGMENT,
    TwoWriters,
    has_batch,
    manifests,
    publish,
    watermark_of,
)

CUT = "watermark_ms"  # what ended by then was closed when the event was read


def start_stamped(
    events: DataFrame,
    path: str,
    checkpoint: str,
    grace: str = GRACE,
    latest_ms: int | Column | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Store the rows of ``events`` (``_server_time`` in ms) with ``watermark_ms``.

    One stream a table. Each micro-batch is a folder of its own that a manifest names once
    it is complete; a replayed one finds that it has been published. The first batch has
    watermark 0. ``grace`` and ``latest_ms`` as in ``with_event_time``.
    """
    spark = events.sparkSession
    columns = events.columns
    if CUT in columns:
        raise ValueError(f"the events have a column {CUT} of their own")
    log = manifests(spark, path)
    stream = checkpoint.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        before = log.latest()
        if has_batch(before, stream, batch_id):
            # its rows are there; the watermark has still to be moved by their times
            batch.write.format("noop").mode("overwrite").save()
            return
        if before.state.get("stream", stream) != stream:
            raise TwoWriters(f"{path} has rows of another stream")
        cut = watermark_of(log, stream, batch_id) or 0
        segment = uuid.uuid4().hex
        stamped = batch.select(*columns, F.lit(cut).cast("long").alias(CUT))
        stamped.write.parquet(f"{path}/data/{SEGMENT}={segment}")

        def add(latest: Manifest):
            if latest.version != before.version:
                raise TwoWriters(f"{path} has rows of another stream")
            return {"stream": stream, "batch": batch_id, CUT: cut}, [{SEGMENT: segment}], None

        publish(log, add)

    return (
        with_event_time(events, grace, latest_ms)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_stamped(
    spark: SparkSession, path: str, schema: StructType | str, version: int | None = None
) -> DataFrame:
    """The events of all batches up to a version; ``schema`` is that of the events."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    full = StructType([*schema.fields, StructField(CUT, LongType())])
    log = manifests(spark, path)
    names = [part[SEGMENT] for part in log.parts(version)]
    if not names:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(*[f"{path}/data/{SEGMENT}={name}" for name in names])


def _in_windows(
    stamped: DataFrame, size: str, hop: str, latest_ms: int | Column | None
) -> DataFrame:
    timed = with_event_time(stamped, None, latest_ms)
    return timed.withColumn("window", F.window("_event_time", size, hop))


def _late() -> Column:
    return F.unix_millis("window.end") <= F.col(CUT)


def late_windows(
    stamped: DataFrame,
    size: str = WINDOW_SIZE,
    hop: str = WINDOW_HOP,
    latest_ms: int | Column | None = None,
) -> DataFrame:
    """The events that came too late, one row for each closed window they belong to.

    All columns of the event, ``watermark_ms``, and ``agg_time``, the window's start. An
    event that some of its windows were still open for counts in those. Events without a
    usable time are in no window and not listed. No shuffle.
    """
    late = _in_windows(stamped, size, hop, latest_ms).where(_late())
    return late.select(*stamped.columns, F.unix_millis("window.start").alias("agg_time"))


def timely_counters(
    stamped: DataFrame,
    counters: Mapping[str, int] = COUNTERS,
    size: str = WINDOW_SIZE,
    hop: str = WINDOW_HOP,
    latest_ms: int | Column | None = None,
) -> DataFrame:
    """Hopping counters without what ``late_windows`` lists, open windows included."""
    timely = _in_windows(stamped, size, hop, latest_ms).where(~_late())
    return counted_windows(timely, counters)
