"""Enrichment rules of a click event: when it happened and where it came from.

The rules are tables; the functions below turn a table into one CASE expression
in which the first matching line wins and NULL inputs match nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
# Two pairings of client and source recur below.
#   mobile site API:      app 17 with src_id 2 or 141, or with src 12
#   site recommendations: app 18 with src_id 141
MOBILE_API_APP, MOBILE_API_SRC_IDS, MOBILE_API_SRC = 17, (2, 141), 12
RECOMMENDER_APP, RECOMMENDER_SRC_ID = 18, 141

# Application type: packaged apps share one type, the two pairings have theirs,
# anything else is its own source number.
PACKAGED_APP_SRC_IDS = (148, 149, 150)
PACKAGED_APP_TYPE = 11
MOBILE_TYPE = 3
SITE_TYPE = 1

# Client application reported by the packaged apps, by src_id.
CLIENT_APP_BY_SRC_ID = {148: 3, 149: 23, 150: 1}

# Platforms in order of precedence:
#   (platform, src_ids, legacy src values, legacy source codes, apps, pairing)
# Legacy columns count only for events without src_id.
PLATFORMS = (
    (1, (1, 96), (11,), (), (), "recommender"),   # site
    (2, (3, 95), (13,), (), (), "mobile_api"),    # mobile site
    (3, (148,), (), (), (3,), None),              # Android
    (4, (150,), (), (), (1,), None),              # iOS
    (5, (4,), (), (4,), (), None),                # administration
    (6, (6,), (), (6,), (), None),                # automatic upload
    (7, (149,), (), (), (23,), None),             # Android, second app
    (16547000007, (12, 209), (), (12,), (), None),  # professional accounts
    (8, (163,), (), (), (), None),                # messenger
)

# Epoch milliseconds of the first instant of year 1 and the last of year 9999.
FIRST_MS, LAST_MS = -62135596800000, 253402300799999
# ----------------------------------------------------------------------------


def event_timestamp(millis: Column, latest_ms: int | Column | None = None) -> Column:
    """Epoch milliseconds as a timestamp; NULL outside the years 1 to 9999.

    Any later time moves a stream's watermark up to it, and all earlier rows are then
    late. ``latest_ms`` makes times beyond it NULL as well, which keeps one wrong
    clock from doing so.
    """
    inside = millis.between(FIRST_MS, LAST_MS)
    if latest_ms is not None:
        inside = inside & (millis <= latest_ms)
    return F.when(inside, F.timestamp_millis(millis))


def legacy_source_code(src: Column) -> Column:
    """Source number packed into an old ``src``: last two digits above 100, last
    one below; exactly 100 carries none."""
    return F.when(src > 100, src % 100).when(src < 100, src % 10)


def _mobile_api(src_id: Column, src: Column, app: Column) -> Column:
    source = src_id.isin(*MOBILE_API_SRC_IDS) | (src == MOBILE_API_SRC)
    return (app == MOBILE_API_APP) & source


def _recommender(src_id: Column, app: Column) -> Column:
    return (app == RECOMMENDER_APP) & (src_id == RECOMMENDER_SRC_ID)


def server_time(dtm: Column, dt: Column, fallback: Column) -> Column:
    """Event time in epoch ms: fractional seconds, else whole seconds, else the
    fallback (the message time, a literal, or the clock). The fallback also stands in
    for a time that does not fit a BIGINT."""
    stated = F.when(dtm > 0, (dtm * 1000).try_cast("bigint")).when(
        dt > 0, dt.cast("bigint") * 1000
    )
    return F.coalesce(stated, fallback.cast("bigint"))


def clock_ms() -> Column:
    """Current time in epoch ms (one value per micro-batch or query)."""
    return F.unix_millis(F.current_timestamp())


def app_type(src_id: Column, src: Column, app: Column) -> Column:
    return (
        F.when(src_id.isin(*PACKAGED_APP_SRC_IDS), PACKAGED_APP_TYPE)
        .when(_mobile_api(src_id, src, app), MOBILE_TYPE)
        .when(_recommender(src_id, app), SITE_TYPE)
        .when(src_id > 0, src_id)
        .otherwise(F.coalesce(legacy_source_code(src), F.lit(0)))
        .cast("bigint")
    )


def client_app(src_id: Column, app: Column) -> Column:
    known = [
        F.when(src_id == source, client)
        for source, client in CLIENT_APP_BY_SRC_ID.items()
    ]
    web = (app == MOBILE_API_APP) | _recommender(src_id, app)
    reported = F.when(web, 0).when(app > 0, app).otherwise(0)
    return F.coalesce(*known, reported).cast("bigint")


def platform(src_id: Column, src: Column, app: Column) -> Column:
    code = legacy_source_code(src)
    pairings = {
        "recommender": _recommender(src_id, app),
        "mobile_api": _mobile_api(src_id, src, app),
    }
    case = F
    for number, src_ids, old_srcs, codes, apps, pairing in PLATFORMS:
        tests = [src_id.isin(*src_ids)]
        if old_srcs:
            tests.append(src_id.isNull() & src.isin(*old_srcs))
        if codes:
            tests.append(src_id.isNull() & code.isin(*codes))
        if apps:
            tests.append(app.isin(*apps))
        if pairing:
            tests.append(pairings[pairing])
        matches = reduce(lambda left, right: left | right, tests)
        case = case.when(matches, F.lit(number).cast("bigint"))
    return case.otherwise(F.lit(0).cast("bigint"))


def is_load_test(agent: Column, marker: str) -> Column:
    """1 for user agents that carry the load generator's marker."""
    return F.when(agent.contains(marker), 1).otherwise(0).cast("bigint")
