"""Per-cookie counters over event-time windows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickweir.functions.decisions import event_timestamp

# --- Fixed values: event ids counted per cookie, and the window ---------------
COUNTERS = {
    "cnt_pixel": 3506,
    "cnt_item_view": 301,
    "cnt_phone_view": 303,
    "cnt_app_item": 2649,
    "cnt_app_call": 2650,
}
WINDOW_SIZE = "10 minutes"
WINDOW_HOP = "2 minutes"
GRACE = "1 minute"
# ------------------------------------------------------------------------------

FLAG = "is_logged_in"


def cookie_events(
    events: DataFrame, counters: Mapping[str, int] = COUNTERS
) -> DataFrame:
    """Rows that can count: keyed, real traffic, one of the counted event ids."""
    return events.where(
        (F.col("rowkey") > "")
        & (F.col("_ua_is_test") == 0)
        & F.col("eid").isin(*counters.values())
    )


def with_event_time(
    events: DataFrame, grace: str | None = GRACE, latest_ms: int | Column | None = None
) -> DataFrame:
    """Add ``_event_time`` from ``_server_time``; on a stream also the watermark.

    Times that no timestamp can hold, or beyond ``latest_ms``, are NULL: their rows fall
    into no window and do not move the watermark. ``untimely_events`` lists them.
    ``latest_ms`` may be a column: ``by_message_time`` bounds each event by the time at
    which its own message arrived.
    """
    time = event_timestamp(F.col("_server_time"), latest_ms)
    timed = events.withColumn("_event_time", time)
    if timed.isStreaming and grace:
        return timed.withWatermark("_event_time", grace)
    return timed


def by_message_time(ahead_ms: int, timestamp: str = "timestamp") -> Column:
    """The latest time, in ms, that an event may claim: its message's, and so much more.

    A clock that runs ahead then only loses its own events; it cannot close the windows of
    all others. The bound is the message's own, so a replay gives the same result.
    """
    return F.unix_millis(timestamp) + F.lit(ahead_ms)


def untimely_events(events: DataFrame, latest_ms: int | Column | None = None) -> DataFrame:
    """The events that have a time, but none that a window can be found for."""
    time = event_timestamp(F.col("_server_time"), latest_ms)
    return events.where(F.col("_server_time").isNotNull() & time.isNull())


def _count_aggregates(counters: Mapping[str, int]) -> list[Column]:
    return [
        F.max(F.when(F.col("uid") > 0, 1).otherwise(0)).alias(FLAG),
        *[
            F.sum(F.when(F.col("eid") == eid, 1).otherwise(0)).alias(name)
            for name, eid in counters.items()
        ],
    ]


def _merge_aggregates(counters: Mapping[str, int]) -> list[Column]:
    return [
        F.max(FLAG).alias(FLAG),
        *[F.sum(name).alias(name) for name in counters],
    ]


def _window_rows(windowed: DataFrame, counters: Mapping[str, int]) -> DataFrame:
    """``u`` repeats the group key: within a group the latest key is the key."""
    return windowed.select(
        "rowkey",
        F.unix_millis("window.start").alias("agg_time"),
        F.col("rowkey").alias("u"),
        FLAG,
        *counters,
    )


def counted_windows(
    windowed: DataFrame, counters: Mapping[str, int] = COUNTERS
) -> DataFrame:
    """Counters of events that have a ``window`` each already."""
    return _window_rows(
        windowed.groupBy("rowkey", "window").agg(*_count_aggregates(counters)), counters
    )


def hopping_counters(
    events: DataFrame,
    counters: Mapping[str, int] = COUNTERS,
    size: str = WINDOW_SIZE,
    hop: str = WINDOW_HOP,
    grace: str | None = GRACE,
    latest_ms: int | Column | None = None,
) -> DataFrame:
    """Counters per (rowkey, window); ``agg_time`` is the window start in epoch ms.

    One shuffle. All aggregates are sums and maxima of fixed width, so they are
    combined before it: a hot key reaches its reducer as one row per map task and
    window, however many events it has.
    """
    timed = with_event_time(events, grace, latest_ms)
    windowed = timed.groupBy(
        "rowkey", F.window("_event_time", size, hop).alias("window")
    ).agg(*_count_aggregates(counters))
    return _window_rows(windowed, counters)


def hopping_counters_by_pane(
    events: DataFrame,
    counters: Mapping[str, int] = COUNTERS,
    size: str = WINDOW_SIZE,
    hop: str = WINDOW_HOP,
    grace: str | None = GRACE,
    latest_ms: int | Column | None = None,
) -> DataFrame:
    """The same rows, with events folded into hop-sized panes first.

    Each pane, instead of each event, is then copied into the windows that contain
    it. Worth a second shuffle when a cookie has several events per pane; ``size``
    must be a multiple of ``hop``.
    """
    timed = with_event_time(events, grace, latest_ms)
    panes = timed.groupBy(
        "rowkey", F.window("_event_time", hop).alias("pane")
    ).agg(*_count_aggregates(counters))
    windowed = (
        panes.withColumn("_pane_time", F.window_time("pane"))
        .groupBy("rowkey", F.window("_pane_time", size, hop).alias("window"))
        .agg(*_merge_aggregates(counters))
    )
    return _window_rows(windowed, counters)


def tumbling_counters(
    events: DataFrame,
    counters: Mapping[str, int] = COUNTERS,
    size: str = WINDOW_SIZE,
    grace: str | None = GRACE,
    latest_ms: int | Column | None = None,
) -> DataFrame:
    """Counters per (rowkey, adjoining window)."""
    timed = with_event_time(events, grace, latest_ms)
    windowed = timed.groupBy(
        "rowkey", F.window("_event_time", size).alias("window")
    ).agg(*_count_aggregates(counters))
    return _window_rows(windowed, counters)


def session_counters(
    events: DataFrame,
    counters: Mapping[str, int] = COUNTERS,
    gap_ms: int = 600_000,
    grace: str | None = GRACE,
    latest_ms: int | Column | None = None,
) -> DataFrame:
    """Counters per (rowkey, session): a pause longer than ``gap_ms`` ends one.

    ``agg_time`` is the first event, ``session_end`` the last one plus the gap.
    A stream uses the built-in session window. In batch that operator would sort
    every event of a key in one task, so events are first folded into gap-sized
    panes, which cannot straddle a session break: the per-key work is then bounded
    by the covered time span over the gap, not by the number of events.
    """
    timed = with_event_time(events, grace, latest_ms)
    if events.isStreaming:
        session = F.session_window("_event_time", f"{gap_ms} milliseconds")
        windowed = timed.groupBy("rowkey", session.alias("window")).agg(
            *_count_aggregates(counters)
        )
        ends = windowed.withColumn("session_end", F.unix_millis("window.end"))
        return ends.select(
            "rowkey",
            F.unix_millis("window.start").alias("agg_time"),
            "session_end",
            F.col("rowkey").alias("u"),
            FLAG,
            *counters,
        )
    time = F.col("_server_time")
    panes = (
        timed.where(F.col("_event_time").isNotNull())
        .withColumn("_pane", F.floor(time / gap_ms))
        .groupBy("rowkey", "_pane")
        .agg(
            F.min(time).alias("_first"),
            F.max(time).alias("_last"),
            *_count_aggregates(counters),
        )
    )
    by_key = W.partitionBy("rowkey").orderBy("_pane")
    pause = F.col("_first") - F.lag("_last").over(by_key)
    starts = panes.withColumn("_starts", F.when(pause <= gap_ms, 0).otherwise(1))
    numbered = starts.withColumn("_session", F.sum("_starts").over(by_key))
    return (
        numbered.groupBy("rowkey", "_session")
        .agg(
            F.min("_first").alias("agg_time"),
            (F.max("_last") + gap_ms).alias("session_end"),
            *_merge_aggregates(counters),
        )
        .select("rowkey", "agg_time", "session_end", F.col("rowkey").alias("u"), FLAG, *counters)
    )


def session_panes(
    events: DataFrame,
    counters: Mapping[str, int] = COUNTERS,
    gap_ms: int = 600_000,
    grace: str | None = GRACE,
    latest_ms: int | Column | None = None,
) -> DataFrame:
    """First and last event and counters per (rowkey, pane of ``gap_ms``).

    A pane cannot straddle a session break, so panes are sessions in parts. Fixed-width
    sums and extremes: hash aggregation before and after the shuffle, and the state of a
    stream holds one row for each key and pane, however many events there are.
    """
    timed = with_event_time(events, grace, latest_ms)
    pane = F.window("_event_time", f"{gap_ms} milliseconds").alias("_pane")
    return (
        timed.groupBy("rowkey", pane)
        .agg(
            F.min("_server_time").alias("first_ms"),
            F.max("_server_time").alias("last_ms"),
            *_count_aggregates(counters),
        )
        .drop("_pane")
    )


def pane_sessions(
    panes: DataFrame, counters: Mapping[str, int] = COUNTERS, gap_ms: int = 600_000
) -> DataFrame:
    """The rows of ``session_counters`` from panes, streaming or not.

    A pane counts as one event that lasts from its first to its last. On a stream the
    panes have to be final ones in the order in which they were closed: they are then out
    of order by less than a pane, which is the delay of the watermark here, and no pane
    comes too late.
    """
    timed = panes.withColumn("_first", F.timestamp_millis("first_ms"))
    if panes.isStreaming:
        timed = timed.withWatermark("_first", f"{gap_ms} milliseconds")
    lasting = F.col("last_ms") - F.col("first_ms") + F.lit(gap_ms)
    session = F.session_window("_first", F.concat(lasting.cast("string"), F.lit(" milliseconds")))
    merged = timed.groupBy("rowkey", session.alias("window")).agg(*_merge_aggregates(counters))
    ends = merged.withColumn("session_end", F.unix_millis("window.end"))
    return ends.select(
        "rowkey",
        F.unix_millis("window.start").alias("agg_time"),
        "session_end",
        F.col("rowkey").alias("u"),
        FLAG,
        *counters,
    )
