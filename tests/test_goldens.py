"""Aggregates observed once on both engines, for the sf0.01 tables."""

import pytest
from pyspark.sql import functions as F

from checks import messages as m
from checks import queries as q

SF001 = "/root/testdata/sf0.01"


def test_core_totals(spark):
    row = q.enriched(spark, SF001).agg(
        F.count("*"),
        F.sum("_server_time"),
        F.sum("_apptype_id"),
        F.sum("_clientsideapp_id"),
        F.sum("_ua_is_test"),
        F.count("rowkey"),
        F.count("dtm"),
    ).first()
    assert tuple(row) == (10000, 16200939705305144, 433627, 60821, 857, 9887, 7500)


def test_platform_counts(spark):
    rows = q.enriched(spark, SF001).groupBy("_platform_id").count().collect()
    assert {r[0]: r[1] for r in rows} == {
        0: 899, 1: 1414, 2: 1563, 3: 1421, 4: 1280, 5: 672, 6: 674, 7: 894, 8: 361,
        16547000007: 822,
    }


@pytest.mark.parametrize("query", [q.cookies_hopping, q.cookies_hopping_panes])
def test_hopping_totals(spark, query):
    row = query(spark, SF001).agg(
        F.count("*"),
        *[
            F.sum(name)
            for name in (
                "agg_time", "is_logged_in", "cnt_pixel", "cnt_item_view",
                "cnt_phone_view", "cnt_app_item", "cnt_app_call",
            )
        ],
    ).first()
    assert tuple(row) == (40371, 68369676711600000, 26786, 8260, 8100, 8090, 8025, 8195)


@pytest.mark.parametrize(
    "sf, windows, most_views, integer, fraction",
    [
        ("0.001", 225, 14, (15, 14, 10, 14), (15, 14, 1, 4)),
        ("0.01", 2249, 16, (150, 126, 131, 125), (150, 126, 19, 16)),
        ("0.1", 22491, 16, (1500, 1195, 1263, 1275), (1500, 1195, 167, 168)),
    ],
)
def test_feature_counts_on_the_compressed_clock(
    spark, sf, windows, most_views, integer, fraction
):
    folder = f"/root/testdata/sf{sf}"
    rows = q.cookies_hopping_fast(spark, folder)
    assert tuple(rows.agg(F.count("*"), F.max("cnt_item_view")).first()) == (
        windows, most_views,
    )
    for mode, expected in (("integer", integer), ("fraction", fraction)):
        counts = q.fast_features(mode)(spark, folder).agg(
            F.count("*"),
            F.count_if("has_ctr_broken"),
            F.count_if("has_frontback_iv_broken"),
            F.count_if("has_frontback_ph_broken"),
        )
        assert tuple(counts.first()) == expected


def test_compressed_clock_keeps_every_event(spark):
    assert m.compressed_clock(spark, SF001).count() == 10000
