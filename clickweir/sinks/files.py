"""File sinks: text lines, ORC and typed Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickweir.functions.coerce import coerce, stored_type
from clickweir.functions.hashing import text_hash, text_hash_items
from clickweir.functions.text import null_text
from clickweir.operators.parse import extract_fields, parse_events
from clickweir.sinks.export_spec import parse_typed_columns
from clickweir.sinks.render import render_lines

# Type names of the typed batch that are not stored as hashes.
# An integer timestamp counts seconds.
BATCH_TYPES = {
    "timestamp": "uint32",
    "integer": "int",
    "boolean": "boolean",
    "float": "float",
    "number": "float",
}


def write_lines(
    messages: DataFrame,
    path: str,
    spec: str,
    delimiter: str = "|",
    newline: str = "\n",
    hash_method: str = "compat",
    mode: str = "append",
    compression: str | None = None,
    max_records_per_file: int | None = None,
    spelling: str = "decoded",
) -> None:
    """Write an export as text files, one line per record."""
    lines = render_lines(messages, spec, delimiter, hash_method, spelling)
    writer = lines.write.mode(mode)
    writer = writer.option("lineSep", newline)
    if compression:
        writer = writer.option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.text(path)


def typed_rows(messages: DataFrame, columns: str, mode: str = "prefix") -> DataFrame:
    """Payload fields as ``name:type,...``, numbers read by their prefix.

    Every scalar type is honoured; types without a text form give NULL columns.
    """
    wanted = parse_typed_columns(columns)
    schema = StructType.fromDDL(
        ", ".join(f"`{c.name}` {stored_type(c.type)}" for c in wanted)
    )
    return parse_events(
        messages,
        schema,
        mode=mode,
        keep=(),
        rowkey=None,
        types={c.name: c.type for c in wanted},
    )


def write_orc(
    messages: DataFrame,
    path: str,
    columns: str,
    mode: str = "append",
    compression: str = "zlib",
    max_records_per_file: int | None = None,
) -> None:
    writer = typed_rows(messages, columns).write.mode(mode).option(
        "compression", compression
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.orc(path)


def typed_batch(
    messages: DataFrame, columns: str, hash_method: str = "compat"
) -> DataFrame:
    """Compact typed rows: ``_timestamp`` in seconds, ``_key`` and every text column
    as hashes, arrays as ``type[]``. Write with ``.write.parquet``."""
    wanted = parse_typed_columns(columns)
    raw = {f"_raw_{n}": column.name for n, column in enumerate(wanted)}
    texts = extract_fields(
        messages.select(
            F.floor(F.unix_millis("timestamp") / 1000).cast("bigint").alias("_timestamp"),
            text_hash(F.col("key"), hash_method).alias("_key"),
            F.col("value").alias("_text"),
        ),
        raw,
        ["_timestamp", "_key"],
        "_text",
    )
    return texts.select(
        "_timestamp",
        "_key",
        *[
            _batch_value(F.col(alias), column.type, hash_method).alias(column.name)
            for alias, column in zip(raw, wanted)
        ],
    )


def _batch_value(raw: Column, type_name: str, hash_method: str) -> Column:
    text = null_text(raw)
    name = type_name.strip().lower()
    base = name.removesuffix("[]")
    if base in BATCH_TYPES:
        suffix = "[]" if name.endswith("[]") else ""
        return coerce(text, BATCH_TYPES[base] + suffix, "append")
    if not name.endswith("[]"):
        return text_hash(text, hash_method)
    return text_hash_items(F.from_json(text, "array<string>"), hash_method)
