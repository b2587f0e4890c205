"""Whole-document helpers on a JSON text column.

Multi-field extraction lives in ``operators.parse`` (one pass over the text for
all requested keys). The functions here serve the cases that need the whole
set of keys, or that change the document.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickweir.functions.text import null_text

_NEGATIVE_ONE = -1

# Fixed value: what JSON allows around a document. Producers often end messages with it.
JSON_BLANKS = " \t\r\n"
NESTING = 32  # of values whose own spelling is looked up; deeper ones come decoded


def document_text(value: Column) -> Column:
    """The text without the blanks behind its last character."""
    return F.rtrim(value, F.lit(JSON_BLANKS))


def is_document(value: Column) -> Column:
    """True when the text is a JSON object (an empty one included)."""
    return F.json_object_keys(value).isNotNull()


def reject_reason(value: Column, whole: bool = False) -> Column:
    """Why a payload is not an event document; NULL when it is one.

    Readers take the first object of a text. With ``whole``, anything after it is a
    reason as well: such a text cannot be extended.
    """
    valid = extendable(value) if whole else is_document(value)
    reason = F.when(value.isNull(), F.lit("missing")).when(
        valid, F.lit(None).cast("string")
    )
    if whole:
        reason = reason.when(is_document(value), F.lit("trailing_text"))
    return reason.when(
        F.try_parse_json(value).isNotNull(), F.lit("not_object")
    ).otherwise(F.lit("malformed"))


def document_map(value: Column) -> Column:
    """All top-level keys with their values as text.

    A key that occurs twice keeps both entries, in document order; read it
    through ``last_entry``, never through ``map[key]``.
    """
    return F.from_json(value, "map<string,string>")


def last_entry(document: Column, key: str) -> Column:
    """Text of the last non-null entry of ``key`` in a ``document_map``."""
    hits = F.filter(
        F.map_entries(document),
        lambda entry: (entry["key"] == key) & null_text(entry["value"]).isNotNull(),
    )
    return F.try_element_at(hits, F.lit(_NEGATIVE_ONE))["value"]


def spelled_key(keys: Column, name: str) -> Column:
    """How a document spells an unquoted SQL name, given its keys.

    The upper-case name if the document has it, otherwise the last key equal to it
    in upper case, otherwise NULL.
    """
    upper = name.upper()
    variants = F.filter(keys, lambda key: F.upper(key) == upper)
    return F.when(F.array_contains(keys, upper), F.lit(upper)).otherwise(
        F.try_element_at(variants, F.lit(_NEGATIVE_ONE))
    )


def extendable(value: Column) -> Column:
    """True for the text of exactly one JSON object, up to surrounding blanks.

    The reader stops at the end of the first object, so what follows it has to be
    looked at as well: a key put before the last brace must come back as the last
    key. One pass over the text settles both.
    """
    body = document_text(value)
    probe = F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.lit(',"":0}'))
    last_key = F.try_element_at(F.json_object_keys(probe), F.lit(_NEGATIVE_ONE))
    checked = F.when(value.rlike(r"^\s*\{\s*\}\s*$"), True).otherwise(
        body.endswith("}") & last_key.eqNullSafe("")
    )
    return F.coalesce(checked, F.lit(False))


def extend_document(
    value: Column, added: Mapping[str, Column], valid: Column | None = None
) -> Column:
    """Append BIGINT fields to a JSON object, as text.

    Known and unknown fields keep their types, order and spelling. On a key
    conflict the document ends up with both and every reader here takes the
    last, i.e. the added one. NULL where ``valid`` (by default ``extendable``) is
    not true; a caller that has filtered on it already passes ``lit(True)``.
    """
    parts: list[Column] = []
    for name, number in added.items():
        comma = "," if parts else ""
        parts.append(F.lit(f"{comma}{json.dumps(name)}:"))
        parts.append(F.coalesce(number.cast("string"), F.lit("null")))
    body = document_text(value)
    head = F.substring(body, F.lit(1), F.length(body) - 1)
    separator = F.when(head.rlike(r"^\s*\{\s*$"), "").otherwise(",")
    joined = F.concat(head, separator, *parts, F.lit("}")) if parts else value
    return F.when(extendable(value) if valid is None else valid, joined)


def _member_pattern() -> str:
    """One ``"key": value`` of an object, as a pattern with the two as groups.

    Values nest ``NESTING`` deep at most. Every repetition is possessive: a text is passed
    over once, without backtracking, however long it is.
    """
    string = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    nested = ""
    for _ in range(NESTING):
        inside = "|".join(filter(None, [r'[^\[\]{}"]++', string, nested]))
        nested = rf"[\[{{](?:{inside})*+[\]}}]"
    return rf'(?s)({string})\s*+:\s*+({string}|{nested}|[^\s,\[\]{{}}"]++)'


def written_entries(value: Column) -> Column:
    """All top-level entries, ``key`` and ``text``, in the characters of the message.

    Strings lose their quotes and keep their escapes, nested values keep their blanks,
    numbers their spelling; a repeated key keeps all its entries, in order. A document that
    nests deeper than ``NESTING`` gives decoded text (``document_map``), one that is
    malformed gives NULL.
    """
    pattern = F.lit(_member_pattern())
    keys = F.regexp_extract_all(value, pattern, F.lit(1))
    texts = F.regexp_extract_all(value, pattern, F.lit(2))
    quoted = r'(?s)^"(.*)"$'
    written = F.zip_with(
        keys,
        texts,
        lambda key, text: F.struct(
            F.regexp_replace(key, quoted, "$1").alias("key"),
            F.regexp_replace(text, quoted, "$1").alias("text"),
        ),
    )
    decoded = F.transform(
        F.map_entries(document_map(value)),
        lambda entry: F.struct(entry["key"].alias("key"), entry["value"].alias("text")),
    )
    found = F.json_object_keys(value)
    return F.when(
        found.isNotNull(), F.when(F.size(found) == F.size(keys), written).otherwise(decoded)
    )


def number_spelling(value: Column, key: Column, text: Column) -> Column:
    """Undo the reformatting of fractional numbers by the JSON reader.

    The reader returns ``1.7E9`` for ``1700000000.0``. Text exports want the
    characters of the message, so look the number up in it: among the numbers
    written after this key, take the last one with the same numeric value. Only where
    these are spelled in several ways (a nested value may have the same key) the top-level
    entries are told apart. Anything that is not a fractional number passes through
    untouched.
    """
    pattern = F.concat(
        F.lit('"\\Q'), key, F.lit('\\E"\\s*:\\s*(-?[0-9]+(?:\\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)')
    )
    fractional = text.rlike(r"^-?[0-9]+\.[0-9]+(E-?[0-9]+)?$")
    target = text.try_cast("double")
    written = F.filter(
        F.regexp_extract_all(value, pattern, F.lit(1)),
        lambda number: number.try_cast("double") == target,
    )
    own = F.filter(
        written_entries(value),
        lambda entry: (entry["key"] == key) & (entry["text"].try_cast("double") == target),
    )
    spelled = F.when(
        F.size(F.array_distinct(written)) > 1, F.try_element_at(own, F.lit(_NEGATIVE_ONE))["text"]
    ).otherwise(F.try_element_at(written, F.lit(_NEGATIVE_ONE)))
    return F.when(fractional, F.coalesce(spelled, text)).otherwise(text)
