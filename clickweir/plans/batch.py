"""The chain of jobs over a stored set of messages, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from clickweir.operators.enrich import (
    EVENT_COLUMNS,
    LOAD_TEST_MARKER,
    enrich,
)
from clickweir.operators.features import cookie_features
from clickweir.operators.parse import parse_events
from clickweir.operators.windows import (
    cookie_events,
    hopping_counters,
    hopping_counters_by_pane,
)


def enriched_events(
    messages: DataFrame,
    fallback_time: Column,
    load_test_marker: str = LOAD_TEST_MARKER,
) -> DataFrame:
    """Typed and enriched events. Unlike the streaming chain nothing is written as
    text in between, so each document is tokenised once."""
    return enrich(parse_events(messages, EVENT_COLUMNS), fallback_time, load_test_marker)


def cookie_windows(
    messages: DataFrame,
    fallback_time: Column,
    panes: bool = False,
    load_test_marker: str = LOAD_TEST_MARKER,
) -> DataFrame:
    events = cookie_events(enriched_events(messages, fallback_time, load_test_marker))
    return hopping_counters_by_pane(events) if panes else hopping_counters(events)


def features(
    messages: DataFrame,
    fallback_time: Column,
    ratio_mode: str = "integer",
    panes: bool = False,
    load_test_marker: str = LOAD_TEST_MARKER,
) -> DataFrame:
    windows = cookie_windows(messages, fallback_time, panes, load_test_marker)
    return cookie_features(windows, ratio_mode)
