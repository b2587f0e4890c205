"""Null-preserving typed import of text columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.functions.coerce import coerce


def import_rows(
    rows: DataFrame,
    types: dict[str, str],
    keep: Sequence[str] = (),
    required: Sequence[str] = (),
    null_marker: str | None = "",
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of a text table read as ``types``.

    A value that does not convert becomes NULL in its own column and row. A row in
    which a ``required`` column has no value is left out as a whole and comes back,
    as text, in the second result with the columns at fault. ``null_marker`` is the
    spelling of NULL in the text.
    """
    unknown = sorted(set(required) - set(types))
    if unknown:
        raise ValueError(f"required columns without a type: {unknown}")

    def text(name: str):
        column = F.col(name).cast("string")
        return column if null_marker is None else F.nullif(column, F.lit(null_marker))

    typed = {name: coerce(text(name), kind, "strict") for name, kind in types.items()}
    missing = [F.when(typed[name].isNull(), F.lit(name)) for name in required]
    if not missing:
        accepted = rows.select(*keep, *[c.alias(n) for n, c in typed.items()])
        rejected = rows.select(
            *keep, *types, F.lit(None).cast("array<string>").alias("missing")
        ).where(F.lit(False))
        return accepted, rejected
    complete = reduce(
        lambda left, right: left & right, [typed[n].isNotNull() for n in required]
    )
    accepted = rows.where(complete).select(
        *keep, *[c.alias(n) for n, c in typed.items()]
    )
    rejected = rows.where(~complete).select(
        *keep, *types, F.array_compact(F.array(*missing)).alias("missing")
    )
    return accepted, rejected
