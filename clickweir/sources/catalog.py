"""Schemas of existing tables, as targets for an append."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from clickweir.functions.coerce import stored_type

# Column metadata Spark keeps for values the table fills in by itself.
_SELF_FILLED = ("CURRENT_DEFAULT", "GENERATION_EXPRESSION", "generationExpression")


def appendable_schema(spark: SparkSession, table: str) -> StructType:
    """Columns of ``table`` a writer must provide, in table order.

    Columns with a default or a generation expression are left to the table.
    """
    return StructType(
        [
            StructField(field.name, field.dataType, field.nullable)
            for field in spark.table(table).schema
            if not any(mark in field.metadata for mark in _SELF_FILLED)
        ]
    )


def columns_from_table(
    spark: SparkSession, columns_table: str, table: str
) -> dict[str, str]:
    """Column name -> logical type out of a table that describes tables.

    ``columns_table`` has the columns ``database, table, name, type, default_kind``;
    ``table`` is ``database.table``. Entries with a default of their own are left
    out. The result is as small as one table's column list.
    """
    described = (
        spark.table(columns_table)
        .where(
            (F.concat_ws(".", "database", "table") == table)
            & (F.coalesce(F.col("default_kind"), F.lit("")) == "")
        )
        .select("name", "type")
    )
    return {row["name"]: row["type"].lower() for row in described.collect()}


def schema_of(types: dict[str, str]) -> StructType:
    """Spark schema that holds the given logical types."""
    return StructType.fromDDL(
        ", ".join(f"`{name}` {stored_type(kind)}" for name, kind in types.items())
    )
