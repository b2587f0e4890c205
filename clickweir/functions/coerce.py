"""Typed reading of JSON text values.

Four modes, all total: no input makes a task fail.

``strict``  whole text must be a literal of the type, otherwise NULL.
``number``  like strict, and integer targets also take decimal notation,
            truncated toward zero (``1.0`` and ``1.7e3`` are integers on the wire).
``prefix``  the longest numeric prefix counts, garbage is 0, integers saturate
            at 64 bits and narrower ones keep the low bits.
``append``  ``prefix``, and a word such as ``true`` counts as 1 in integer columns.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickweir.functions.text import is_true_word

MODES = ("strict", "number", "prefix", "append")

# Logical type -> Spark type that can hold every value of it.
STORED_AS = {
    "uint8": "smallint",
    "uint16": "int",
    "uint32": "bigint",
    "uint64": "decimal(20,0)",
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "float32": "float",
    "float64": "double",
    "integer": "int",
    "long": "bigint",
    "short": "smallint",
    "byte": "tinyint",
    "number": "float",
    "real": "float",
    "text": "string",
    "varchar": "string",
    "char": "string",
    "time": "string",  # kept as HH:mm:ss
    "numeric": "decimal(38,9)",
    "decimal": "decimal(38,9)",
}

_UNSIGNED_BITS = {"uint8": 8, "uint16": 16, "uint32": 32, "uint64": 64}
_SIGNED_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}

_INT_PREFIX = r"^\s*([+-]?)0*([0-9]*)"
_FLOAT_PREFIX = (
    r"(?i)^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?"
    r"|[+-]?inf(?:inity)?|nan)"
)


def stored_type(type_name: str) -> str:
    """Spark type name for a logical type name (``uint32`` -> ``bigint``)."""
    name = type_name.strip().lower()
    if name.endswith("[]"):
        return f"array<{stored_type(name[:-2])}>"
    if re.fullmatch(r"(varchar|char)\(\d+\)", name):
        return "string"
    if name.startswith("numeric("):
        return "decimal" + name[len("numeric"):]
    return STORED_AS.get(name, name)


def coerce(text: Column, type_name: str, mode: str = "strict") -> Column:
    """Read ``text`` as ``type_name``; NULL text stays NULL in every mode."""
    if mode not in MODES:
        raise ValueError(f"unknown coercion mode {mode!r}; expected one of {MODES}")
    name = type_name.strip().lower()
    if name.endswith("[]"):
        items = F.from_json(text, "array<string>")
        return F.transform(items, lambda item: coerce(item, name[:-2], mode))
    stored = stored_type(name)
    if name == "time":
        moment = F.concat(F.lit("1970-01-01 "), F.trim(text)).try_cast("timestamp_ntz")
        return F.date_format(moment, "HH:mm:ss")
    if stored == "string":
        return text
    if stored.startswith(("array<", "map<", "struct<")):
        return F.from_json(text, stored)
    if mode in ("strict", "number"):
        return _literal(text, name, stored, decimals=mode == "number")
    if name in _UNSIGNED_BITS:
        number = _prefix_unsigned(text, _UNSIGNED_BITS[name], stored)
    elif stored in _SIGNED_BITS:
        number = _prefix_signed(text, _SIGNED_BITS[stored], stored)
    elif stored in ("float", "double"):
        return _prefix_float(text, stored)
    elif stored == "boolean":
        return text.startswith("t")
    else:
        return F.trim(text).try_cast(stored)
    if mode == "append":
        one = F.lit(1).cast(stored)
        number = F.when((number == 0) & is_true_word(text), one).otherwise(number)
    return number


def _literal(text: Column, name: str, stored: str, decimals: bool) -> Column:
    trimmed = F.trim(text)
    value = trimmed.try_cast(stored)
    if decimals and stored in _SIGNED_BITS:
        value = F.coalesce(value, trimmed.try_cast("decimal(38,18)").try_cast(stored))
    if name in _UNSIGNED_BITS:
        top = F.lit(str(2 ** _UNSIGNED_BITS[name] - 1)).cast(stored)
        value = F.when((value >= 0) & (value <= top), value)
    return value


def _decimal(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(38,0)")


def _prefix_parts(text: Column) -> tuple[Column, Column]:
    """(sign text, magnitude as decimal); more than 20 digits is 'too large'."""
    sign = F.regexp_extract(text, _INT_PREFIX, 1)
    digits = F.regexp_extract(text, _INT_PREFIX, 2)
    magnitude = (
        F.when(digits == "", _decimal(0))
        .when(F.length(digits) > 20, _decimal(10**20))
        .otherwise(digits.try_cast("decimal(38,0)"))
    )
    return sign, magnitude


def _prefix_signed(text: Column, bits: int, stored: str) -> Column:
    sign, magnitude = _prefix_parts(text)
    signed = F.when(sign == "-", -magnitude).otherwise(magnitude)
    wide = F.least(
        F.greatest(signed, _decimal(-(2**63))), _decimal(2**63 - 1)
    ).cast("bigint")
    if bits == 64:
        return F.when(text.isNotNull(), wide)
    low = wide.bitwiseAND(F.lit(2**bits - 1).cast("bigint"))
    wrapped = F.when(low >= 2 ** (bits - 1), low - 2**bits).otherwise(low)
    return F.when(text.isNotNull(), wrapped.cast(stored))


def _prefix_unsigned(text: Column, bits: int, stored: str) -> Column:
    if bits < 32:
        wide = _prefix_signed(text, 64, "bigint")
        return wide.bitwiseAND(F.lit(2**bits - 1).cast("bigint")).cast(stored)
    sign, magnitude = _prefix_parts(text)
    top = _decimal(2**64 - 1)
    modulus = _decimal(2**64)
    word = (
        F.when(magnitude > top, top)
        .when((sign == "-") & (magnitude > 0), modulus - magnitude)
        .otherwise(magnitude)
    )
    value = word if bits == 64 else F.pmod(word, _decimal(2**bits))
    return F.when(text.isNotNull(), value.cast(stored))


def _prefix_float(text: Column, stored: str) -> Column:
    token = F.regexp_extract(text, _FLOAT_PREFIX, 1)
    zero = F.lit(0).cast(stored)
    return F.when(text.isNotNull(), F.coalesce(token.try_cast(stored), zero))
