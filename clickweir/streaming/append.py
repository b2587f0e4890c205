"""Continuous append of messages to an existing table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clickweir.sinks.tables import append_to_table


def start_table_append(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    nulls: str = "keep",
    slices: int | None = None,
    types: dict[str, str] | None = None,
    batch_column: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append every message to ``table``, one insert per micro-batch.

    An insert that fails half-way is repeated whole: at least once. With
    ``batch_column``, a BIGINT column the table is partitioned by, each micro-batch
    has a partition of its own that a repetition overwrites: exactly once, for one
    stream per table. The streaming file sink is no alternative here, its log would
    hide the rows the table already has.
    """
    spark = messages.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        own = (batch_column, batch_id) if batch_column else None
        append_to_table(batch, table, nulls, slices, types, replace=own)
        spark.catalog.refreshTable(table)  # the batch ran in a session of its own

    return (
        messages.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )
