"""The text form of an export: ``header;...;mode``.

    timestamp;columns:hash(uuid),uid,eid=ids,dt=ids
    partition;offset;json
    key;eav
    array:uid,eid,ua=agent
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# Message attributes that may precede the value, and the modes.
HEADERS = ("partition", "offset", "key", "timestamp")
PLAIN_MODES = ("json", "eav")
FIELD_MODES = ("array", "columns")


@dataclass(frozen=True)
class ExportField:
    key: str
    hashed: bool
    group: str


@dataclass(frozen=True)
class ExportSpec:
    headers: tuple[str, ...] = ()
    mode: str = "json"
    fields: tuple[ExportField, ...] = field(default=())

    @classmethod
    def parse(cls, text: str) -> ExportSpec:
        headers: list[str] = []
        mode, fields = "json", ()
        for part in (piece.strip() for piece in text.split(";")):
            name, colon, rest = part.partition(":")
            if part in HEADERS:
                headers.append(part)
            elif part in PLAIN_MODES:
                mode, fields = part, ()
            elif name in FIELD_MODES and colon:
                mode = name
                fields = tuple(
                    _field(item.strip(), grouped=mode == "array")
                    for item in rest.split(",")
                )
            elif part:
                raise ValueError(f"unknown export part {part!r}")
        return cls(tuple(headers), mode, fields)

    @property
    def groups(self) -> dict[str, list[ExportField]]:
        """Fields by group; groups by first appearance, members as given."""
        grouped: dict[str, list[ExportField]] = {}
        for item in self.fields:
            grouped.setdefault(item.group, []).append(item)
        return grouped


def _field(text: str, grouped: bool) -> ExportField:
    expression, equals, group = text.partition("=")
    call = re.fullmatch(r"(\w+)\((.*)\)", expression)
    if call and call[1] != "hash":
        raise ValueError(f"unknown function {call[1]!r} in {text!r}")
    key = call[2] if call else expression
    if not key:
        raise ValueError(f"field without a name: {text!r}")
    if not equals:
        group = "" if grouped else key
    return ExportField(key, bool(call), group)


@dataclass(frozen=True)
class TypedColumn:
    name: str
    type: str


def parse_typed_columns(text: str) -> list[TypedColumn]:
    """``name:type,...``; commas inside brackets belong to a type."""
    columns = []
    for item in _outer_commas(text):
        name, colon, kind = item.strip().partition(":")
        if not (name and colon and kind):
            raise ValueError(f"expected name:type, got {item!r}")
        columns.append(TypedColumn(name.strip(), kind.strip()))
    return columns


def _outer_commas(text: str) -> list[str]:
    parts, depth = [""], 0
    for char in text:
        depth += (char in "(<") - (char in ")>")
        if char == "," and depth == 0:
            parts.append("")
        else:
            parts[-1] += char
    return parts
