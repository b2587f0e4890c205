"""Append to an existing table, with the schema taken from the catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    NumericType,
    StringType,
    StructType,
)

from clickweir.operators.parse import parse_events
from clickweir.sources.catalog import appendable_schema

# Target columns filled from the message, not from its payload.
MESSAGE_COLUMNS = ("_partition", "_offset", "_timestamp")

NULL_POLICIES = ("keep", "default")


def table_rows(
    messages: DataFrame,
    schema: StructType,
    nulls: str = "keep",
    types: dict[str, str] | None = None,
) -> DataFrame:
    """Rows shaped for ``schema``: payload fields read with ``append`` coercion,
    message columns from the envelope. ``nulls='default'`` stores 0 or '' instead."""
    if nulls not in NULL_POLICIES:
        raise ValueError(f"unknown null policy {nulls!r}; expected one of {NULL_POLICIES}")
    own = [f.name for f in schema if f.name in MESSAGE_COLUMNS]
    payload = StructType([f for f in schema if f.name not in MESSAGE_COLUMNS])
    tagged = messages.withColumns(
        {
            "_partition": F.col("partition"),
            "_offset": F.col("offset"),
            "_timestamp": F.unix_millis("timestamp"),
        }
    )
    rows = parse_events(
        tagged, payload, mode="append", keep=own, rowkey=None, types=types
    )
    return rows.select(
        *[
            _filled(F.col(f.name).cast(f.dataType), f.dataType, nulls).alias(f.name)
            for f in schema
        ]
    )


def _filled(column: Column, kind: DataType, nulls: str) -> Column:
    if nulls == "keep":
        return column
    if isinstance(kind, NumericType):
        return F.coalesce(column, F.lit(0).cast(kind))
    if isinstance(kind, StringType):
        return F.coalesce(column, F.lit(""))
    if isinstance(kind, BooleanType):
        return F.coalesce(column, F.lit(False))
    return column


def append_to_table(
    messages: DataFrame,
    table: str,
    nulls: str = "keep",
    slices: int | None = None,
    types: dict[str, str] | None = None,
    replace: tuple[str, int] | None = None,
) -> None:
    """Append a batch of messages to ``table``.

    Columns the table fills in by itself are not written. ``slices`` sets the number
    of parallel writers; by default the partitioning of the input stays, which needs
    no shuffle. ``replace`` names one partition of the table, by column and value, and
    writes that anew instead.
    """
    schema = appendable_schema(messages.sparkSession, table)
    verb = "INTO"
    partition = ""
    if replace:
        column, number = replace
        schema = StructType([field for field in schema if field.name != column])
        verb, partition = "OVERWRITE", f" PARTITION (`{column}` = {number})"
    rows = table_rows(messages, schema, nulls, types)
    if slices:
        rows = rows.repartition(slices)
    names = ", ".join(f"`{name}`" for name in schema.fieldNames())
    messages.sparkSession.sql(
        f"INSERT {verb} {table}{partition} ({names}) SELECT {names} FROM {{rows}}",
        rows=rows,
    )
