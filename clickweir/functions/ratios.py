"""Ratio of two counters, guarded against small denominators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATIO_MODES = ("integer", "fraction")


def guarded_ratio(
    numerator: Column,
    denominator: Column,
    floor: int,
    default: int,
    mode: str = "integer",
) -> Column:
    """``numerator / denominator`` where the denominator is at least ``floor``.

    ``integer`` divides like INT / INT in SQL engines that truncate, which is what
    existing results were produced with; ``fraction`` is the true ratio. A missing
    numerator is 0; below the floor the ratio is ``default``.
    """
    if mode not in RATIO_MODES:
        raise ValueError(f"unknown ratio mode {mode!r}; expected one of {RATIO_MODES}")
    count = F.coalesce(numerator, F.lit(0))
    ratio = count / denominator
    if mode == "integer":
        # counters are non-negative and far below 2^53, so the floor is exact
        ratio = F.floor(ratio)
    return F.when(denominator >= floor, ratio.cast("double")).otherwise(
        F.lit(float(default))
    )
