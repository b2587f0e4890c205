"""Export projections. Each is one pass over the messages and never shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.functions.document import (
    document_map,
    last_entry,
    number_spelling,
    written_entries,
)
from clickweir.functions.hashing import text_hash
from clickweir.functions.text import null_text
from clickweir.operators.parse import extract_fields
from clickweir.sinks.export_spec import ExportField, ExportSpec

DELIMITER = "|"
GROUP_DELIMITER = ","
SPELLINGS = ("decoded", "message")


def header_columns(headers) -> list[Column]:
    """Message attributes as text; the timestamp in epoch milliseconds."""
    made = {
        "partition": F.col("partition").cast("string"),
        "offset": F.col("offset").cast("string"),
        "key": F.col("key"),
        "timestamp": F.unix_millis("timestamp").cast("string"),
    }
    return [F.coalesce(made[name], F.lit("")) for name in headers]


# Characters that would break a line, and how JSON writes them.
LINE_BREAKING = {"\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def one_line(text: Column) -> Column:
    """Control characters as the message wrote them, so that a record is one line."""
    for character, written in LINE_BREAKING.items():
        text = F.replace(text, F.lit(character), F.lit(written))
    return text


def _joined(cells: list[Column], delimiter: str) -> Column:
    return F.concat_ws(delimiter, *[F.coalesce(cell, F.lit("")) for cell in cells])


def render_lines(
    messages: DataFrame,
    spec: ExportSpec | str,
    delimiter: str = DELIMITER,
    hash_method: str = "compat",
    spelling: str = "decoded",
) -> DataFrame:
    """One text column ``line`` for the modes json, eav and columns.

    ``spelling``: strings ``decoded``, or everything in the characters of the ``message``
    (escapes and the blanks of nested values as they are, also under hash()).

    Nothing is quoted; control characters of a value keep their JSON spelling, so every
    record is one line (json writes the text as it is). NULL is the empty cell. A message whose payload is
    no document gives the text itself (json), no line (eav) or empty cells (columns).
    """
    own = ExportSpec.parse(spec) if isinstance(spec, str) else spec
    headers = header_columns(own.headers)
    if own.mode == "json":
        line = _joined([*headers, F.col("value")], delimiter)
        return messages.select(line.alias("line"))
    if own.mode == "eav":
        rows = entity_rows(messages, own.headers, spelling)
        cells = [
            *[F.col(name) for name in own.headers], one_line(F.col("field")), one_line(F.col("text"))
        ]
        return rows.select(_joined(cells, delimiter).alias("line"))
    if own.mode != "columns":
        raise ValueError(f"mode {own.mode!r} has no text form; use sparse_groups")
    values = field_values(messages, own, hash_method, spelling)
    cells: list[Column] = [F.col(f"_head_{n}") for n in range(len(headers))]
    position = 0
    for members in own.groups.values():
        columns = [one_line(F.col(f"_cell_{position + n}")) for n in range(len(members))]
        position += len(members)
        if len(columns) == 1:
            cells += columns
        else:
            inner = _joined(columns, GROUP_DELIMITER)
            cells.append(F.concat(F.lit("{"), inner, F.lit("}")))
    return values.select(_joined(cells, delimiter).alias("line"))


def _check_spelling(spelling: str) -> None:
    if spelling not in SPELLINGS:
        raise ValueError(f"unknown spelling {spelling!r}; expected one of {SPELLINGS}")


def field_values(
    messages: DataFrame,
    spec: ExportSpec,
    hash_method: str = "compat",
    spelling: str = "decoded",
) -> DataFrame:
    """Header cells ``_head_n`` and value cells ``_cell_n``, in output order."""
    _check_spelling(spelling)
    ordered = [item for members in spec.groups.values() for item in members]
    heads = [
        column.alias(f"_head_{n}")
        for n, column in enumerate(header_columns(spec.headers))
    ]
    held = [f"_head_{n}" for n in range(len(heads))]
    value = F.col("_value")
    messages = messages.select(*heads, F.col("value").alias("_value"))
    if spelling == "message":
        document = messages.select("*", written_entries(value).alias("_entries"))
        base = document.select(
            *held,
            *[_written_text(F.col("_entries"), i).alias(f"_raw_{n}") for n, i in enumerate(ordered)],
        )
        cells = [
            text_hash(raw, hash_method).cast("string") if item.hashed else raw
            for item, raw in ((i, F.col(f"_raw_{n}")) for n, i in enumerate(ordered))
        ]
        return base.select(*held, *[cell.alias(f"_cell_{n}") for n, cell in enumerate(cells)])
    if any(item.hashed for item in ordered):
        # hash() also covers explicit nulls, so presence of the key must be known
        document = messages.select("*", document_map(value).alias("_map"))
        base = document.select(
            *held,
            "_value",
            *[_map_text(F.col("_map"), i).alias(f"_raw_{n}") for n, i in enumerate(ordered)],
        )
    else:
        raw = {f"_raw_{n}": item.key for n, item in enumerate(ordered)}
        base = extract_fields(messages, raw, [*held, "_value"], "_value")
    cells = [
        _cell(item, value, F.col(f"_raw_{n}"), hash_method)
        for n, item in enumerate(ordered)
    ]
    return base.select(
        *held, *[cell.alias(f"_cell_{n}") for n, cell in enumerate(cells)]
    )


def _map_text(document: Column, item: ExportField) -> Column:
    """Text of a field; under hash() the last entry counts, whatever it holds."""
    if not item.hashed:
        return last_entry(document, item.key)
    entries = F.filter(F.map_entries(document), lambda entry: entry["key"] == item.key)
    return F.try_element_at(
        F.transform(entries, lambda entry: F.coalesce(entry["value"], F.lit("null"))),
        F.lit(-1),
    )


def _written_text(entries: Column, item: ExportField) -> Column:
    """The last entry of a field under hash(), the last that is not null otherwise."""
    own = F.filter(
        entries,
        lambda entry: (entry["key"] == item.key)
        & (F.lit(item.hashed) | null_text(entry["text"]).isNotNull()),
    )
    return F.try_element_at(own, F.lit(-1))["text"]


def _cell(item: ExportField, value: Column, raw: Column, hash_method: str) -> Column:
    text = raw if item.hashed else null_text(raw)
    spelled = number_spelling(value, F.lit(item.key), text)
    return text_hash(spelled, hash_method).cast("string") if item.hashed else spelled


def entity_rows(messages: DataFrame, headers=(), spelling: str = "decoded") -> DataFrame:
    """One row per top-level key: header columns, ``field`` and raw ``text``.

    No null rule: a null value is the text ``null``, and a repeated key gives one
    row per occurrence.
    """
    heads = [
        column.alias(name) for name, column in zip(headers, header_columns(headers))
    ]
    _check_spelling(spelling)
    if spelling == "message":
        return messages.select(*heads, F.inline(written_entries(F.col("value")))).toDF(
            *headers, "field", "text"
        )
    entries = messages.select(
        *heads,
        F.col("value").alias("_value"),
        F.explode(document_map(F.col("value"))).alias("field", "_text"),
    )
    text = number_spelling(F.col("_value"), F.col("field"), F.col("_text"))
    return entries.select(
        *headers, "field", F.coalesce(text, F.lit("null")).alias("text")
    )


def sparse_groups(
    messages: DataFrame,
    spec: ExportSpec | str,
    layout: str = "map",
    hash_method: str = "compat",
    spelling: str = "decoded",
) -> DataFrame:
    """Only the present fields, one column per value group.

    ``map`` keys them by field name; ``positions`` stores their index in the group,
    which is smaller when names are long. The unnamed group is called ``values``.
    """
    own = ExportSpec.parse(spec) if isinstance(spec, str) else spec
    if layout not in ("map", "positions"):
        raise ValueError(f"unknown layout {layout!r}; expected map or positions")
    cells = field_values(messages, own, hash_method, spelling)
    columns, position = [], 0
    for group, members in own.groups.items():
        texts = [F.col(f"_cell_{position + n}") for n in range(len(members))]
        position += len(members)
        entries = [
            F.struct(
                (F.lit(item.key) if layout == "map" else F.lit(place)).alias("position"),
                text.alias("text"),
            )
            for place, (item, text) in enumerate(zip(members, texts))
        ]
        present = F.filter(F.array(*entries), lambda entry: entry["text"].isNotNull())
        column = F.map_from_entries(present) if layout == "map" else present
        columns.append(column.alias(group or "values"))
    heads = [
        F.col(f"_head_{n}").alias(name) for n, name in enumerate(own.headers)
    ]
    return cells.select(*heads, *columns)
