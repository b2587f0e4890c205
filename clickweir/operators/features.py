"""Behaviour features of a cookie, folded from its windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.functions.ratios import guarded_ratio

# Smallest denominator that counts, and the thresholds.
MIN_VIEWS = 5
BROKEN_CTR_ABOVE = 0.95
BROKEN_BACKEND_BELOW = 0.2


def cookie_features(windows: DataFrame, ratio_mode: str = "integer") -> DataFrame:
    """One row per cookie ``u`` from its window counters.

    Only minima and maxima are taken, so counting the same window twice changes
    nothing. Feed closed windows: an unfinished one can show a ratio that its final
    state does not have. One shuffle, combined before it.
    """

    def ratio(numerator: str, denominator: str, default: int):
        return guarded_ratio(
            F.col(numerator), F.col(denominator), MIN_VIEWS, default, ratio_mode
        )

    return windows.groupBy("u").agg(
        F.max("agg_time").alias("agg_time"),
        (F.max("cnt_pixel") > 0).alias("has_pixel"),
        (F.max(ratio("cnt_phone_view", "cnt_item_view", 0)) > BROKEN_CTR_ABOVE).alias(
            "has_ctr_broken"
        ),
        (F.min(ratio("cnt_app_item", "cnt_item_view", 1)) < BROKEN_BACKEND_BELOW).alias(
            "has_frontback_iv_broken"
        ),
        (F.min(ratio("cnt_app_call", "cnt_phone_view", 1)) < BROKEN_BACKEND_BELOW).alias(
            "has_frontback_ph_broken"
        ),
    )
