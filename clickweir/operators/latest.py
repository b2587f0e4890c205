"""The value a key had last, by offset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_offset(value: str | Column, offset: str = "offset") -> Column:
    """Aggregate: the non-null value at the highest offset.

    Offsets only compare within one topic partition, so the grouping key must
    never be spread over several (a keyed topic guarantees that).
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.max_by(column, F.when(column.isNotNull(), F.col(offset)))


def latest_rows(
    events: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    offset: str = "offset",
) -> DataFrame:
    """Latest non-null value of each column per key."""
    return events.groupBy(*keys).agg(
        *[latest_by_offset(name, offset).alias(name) for name in columns]
    )
