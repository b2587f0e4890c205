"""Declared streams: a topic with typed columns, a key and an event-time column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.functions.decisions import event_timestamp
from clickweir.operators.parse import parse_events
from clickweir.operators.windows import GRACE


@dataclass(frozen=True)
class StreamSpec:
    """How to read one topic.

    ``columns`` is a DDL string without the key; ``document`` names a column for the
    whole text. ``time_column`` holds epoch milliseconds and, when set, becomes the
    timestamp column ``event_time`` with ``grace`` as the lateness bound on a stream.
    """

    name: str
    topic: str
    columns: str
    key: str = "rowkey"
    document: str | None = None
    time_column: str | None = None
    grace: str = GRACE
    match: str = "sql"
    skip_bad_records: bool = True

    def open(self, messages: DataFrame) -> DataFrame:
        """Typed rows of this stream from an envelope, streaming or not."""
        own = messages.where(F.col("topic") == self.topic)
        events = parse_events(
            own,
            self.columns,
            match=self.match,
            rowkey=self.key,
            document=self.document,
            skip_rejects=self.skip_bad_records,
        )
        if not self.time_column:
            return events
        time = event_timestamp(F.col(self.time_column))
        timed = events.withColumn("event_time", time)
        if timed.isStreaming:
            return timed.withWatermark("event_time", self.grace)
        return timed

    def register(self, messages: DataFrame) -> DataFrame:
        """``open`` and make the rows available to SQL under the stream's name."""
        events = self.open(messages)
        events.createOrReplaceTempView(self.name)
        return events
