"""Enrichment of click events and the extended document they are stored as."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.functions import decisions
from clickweir.functions.document import extend_document, extendable, reject_reason
from clickweir.operators.parse import parse_events

# Payload fields of a click event.
EVENT_COLUMNS = (
    "uuid string, dt int, dtm double, eid int, src_id int, src int, app int, "
    "uid int, ua string, cid int, params string, infm_raw_params string"
)
# Names of the added fields, in document order.
ADDED_FIELDS = (
    "_server_time",
    "_apptype_id",
    "_clientsideapp_id",
    "_platform_id",
    "_ua_is_test",
)
# Part of the user agent of synthetic load; pass your generator's own.
LOAD_TEST_MARKER = "LoadTest"

# What becomes of a message.
KIND, DOCUMENT, REJECT = "kind", "document", "reject"

ExtraFields = Mapping[str, Callable[[], Column]]


def enrich(
    events: DataFrame,
    fallback_time: Column | None = None,
    load_test_marker: str = LOAD_TEST_MARKER,
) -> DataFrame:
    """Add server time, application type, client application, platform and the
    load-test flag, all BIGINT.

    ``fallback_time`` (epoch ms) stands in for events that carry no time of their
    own; without it the clock does, which makes a replay differ from the first run.
    """
    src_id, src, app = F.col("src_id"), F.col("src"), F.col("app")
    fallback = decisions.clock_ms() if fallback_time is None else fallback_time
    added = {
        "_server_time": decisions.server_time(F.col("dtm"), F.col("dt"), fallback),
        "_apptype_id": decisions.app_type(src_id, src, app),
        "_clientsideapp_id": decisions.client_app(src_id, app),
        "_platform_id": decisions.platform(src_id, src, app),
        "_ua_is_test": decisions.is_load_test(F.col("ua"), load_test_marker),
    }
    return events.withColumns(added)


def extended_documents(
    messages: DataFrame,
    fallback_time: Column | None = None,
    load_test_marker: str = LOAD_TEST_MARKER,
    extra_fields: ExtraFields | None = None,
    match: str = "exact",
    skip_rejects: bool = False,
) -> DataFrame:
    """Envelopes whose documents carry the added fields: ``rowkey, value`` plus
    the envelope's partition, offset and timestamp.

    ``extra_fields`` maps further names to functions returning a BIGINT column
    over the parsed event (a category classifier, for instance). Payloads that
    are not documents come back with a NULL value, or are left out by
    ``skip_rejects``; ``parse.rejects`` tells about them.
    """
    document = F.col("_document")
    valid = None
    if skip_rejects:
        messages, valid = messages.where(extendable(F.col("value"))), F.lit(True)
    events = parse_events(
        messages, EVENT_COLUMNS, match=match, document="_document"
    )
    full = enrich(events, fallback_time, load_test_marker)
    added = {name: F.col(name) for name in ADDED_FIELDS}
    for name, make in (extra_fields or {}).items():
        added[name] = make().cast("bigint")
    value = extend_document(document, added, valid)
    return full.select(
        "rowkey", value.alias("value"), "partition", "offset", "timestamp"
    )


def split_documents(
    messages: DataFrame,
    fallback_time: Column | None = None,
    load_test_marker: str = LOAD_TEST_MARKER,
    include_value: bool = False,
    topic: str = "CLICKSTREAM_CORE",
) -> DataFrame:
    """Every message once: its extended document, or why there is none.

    The envelope with ``reason`` and ``kind``. Documents are keyed by row key under
    ``topic``; rejects have a reason and, only if asked for, their text. What makes a
    payload a reject is worked out once and carried through the pass that reads its fields.
    """
    reason = F.col("_reason")
    judged = messages.withColumn("_reason", reject_reason(F.col("value"), whole=True))
    events = parse_events(
        judged, EVENT_COLUMNS, keep=("partition", "offset", "timestamp", "_reason"),
        document="_document",
    )
    full = enrich(events, fallback_time, load_test_marker)
    added = {name: F.col(name) for name in ADDED_FIELDS}
    extended = extend_document(F.col("_document"), added, reason.isNull())
    left = F.col("_document") if include_value else F.lit(None).cast("string")
    return full.select(
        F.when(reason.isNull(), F.col("rowkey")).alias("key"),
        F.when(reason.isNull(), extended).otherwise(left).alias("value"),
        F.when(reason.isNull(), F.lit(topic)).alias("topic"),
        "partition", "offset", "timestamp",
        reason.alias("reason"),
        F.when(reason.isNull(), DOCUMENT).otherwise(REJECT).alias(KIND),
    )


def rekey(documents: DataFrame, buckets: int) -> DataFrame:
    """Lay documents out by row key: each key in one of ``buckets`` groups.

    Adds ``key_bucket``; write with ``partitionBy("key_bucket")``. The rebalance hint
    lets adaptive execution merge small groups and split one that a hot key made
    large over several tasks, so a key shares a directory, never a single task. A
    topic writer needs none of this: it places messages by their key.
    """
    bucket = F.pmod(F.hash("rowkey"), F.lit(buckets))
    return documents.withColumn("key_bucket", bucket).hint(
        "rebalance", F.col("key_bucket")
    )
