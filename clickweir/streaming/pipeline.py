"""The chained jobs as streaming queries.

    messages -> documents -> cookie windows -> cookie features

Each arrow is one query with its own checkpoint, and a table between two of them:
stateful stages cannot be chained in one query unless both only emit final rows.
All outputs are idempotent, so any query can be killed and started again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from clickweir.operators.enrich import (
    DOCUMENT,
    KIND,
    LOAD_TEST_MARKER,
    REJECT,
    extended_documents,
    split_documents,
)
from clickweir.operators.features import cookie_features
from clickweir.operators.parse import parse_events, rejects
from clickweir.operators.windows import (
    by_message_time,
    cookie_events,
    hopping_counters,
    hopping_counters_by_pane,
    pane_sessions,
    session_panes,
)
from clickweir.session import prepare_streaming
from clickweir.sources.envelope import ENVELOPE
from clickweir.sources.kafka import DURABLE_WRITER
from clickweir.streaming.keyed import compact_keyed, expire_keyed, read_keyed, start_keyed
from clickweir.streaming.late import (
    late_windows,
    read_stamped,
    start_stamped,
    timely_counters,
)

# Payload fields the window job reads, topic names of the stages.
WINDOW_COLUMNS = "eid int, uid int, _server_time bigint, _ua_is_test int"
DOCUMENT_TOPIC = "CLICKSTREAM_CORE"
WINDOW_TOPIC = "CLICKSTREAM_COOKIES"

WINDOW_SCHEMA = (
    "rowkey string, agg_time bigint, u string, is_logged_in int, cnt_pixel bigint, "
    "cnt_item_view bigint, cnt_phone_view bigint, cnt_app_item bigint, "
    "cnt_app_call bigint"
)
COUNTED_SCHEMA = (
    "rowkey string, eid int, uid int, _server_time bigint, _ua_is_test int, "
    "partition int, offset bigint, timestamp timestamp"
)
PANE_SCHEMA = (
    "rowkey string, first_ms bigint, last_ms bigint, is_logged_in int, cnt_pixel bigint, "
    "cnt_item_view bigint, cnt_phone_view bigint, cnt_app_item bigint, cnt_app_call bigint"
)
SESSION_SCHEMA = (
    "rowkey string, agg_time bigint, session_end bigint, u string, is_logged_in int, "
    "cnt_pixel bigint, cnt_item_view bigint, cnt_phone_view bigint, cnt_app_item bigint, "
    "cnt_app_call bigint"
)
FEATURE_SCHEMA = (
    "u string, agg_time bigint, has_pixel boolean, has_ctr_broken boolean, "
    "has_frontback_iv_broken boolean, has_frontback_ph_broken boolean"
)
# ``u`` repeats ``rowkey``.
WINDOW_KEYS = ("rowkey", "u", "agg_time")


@dataclass(frozen=True)
class Stages:
    """Folders of one deployment of the chain, all below ``root``."""

    root: str

    @property
    def documents(self) -> str:
        return f"{self.root}/documents"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def split(self) -> str:
        return f"{self.root}/split"

    @property
    def windows(self) -> str:
        return f"{self.root}/windows"

    @property
    def stamped(self) -> str:
        return f"{self.root}/stamped"

    @property
    def panes(self) -> str:
        return f"{self.root}/panes"

    @property
    def sessions(self) -> str:
        return f"{self.root}/sessions"

    @property
    def features(self) -> str:
        return f"{self.root}/features"

    def checkpoint(self, stage: str) -> str:
        return f"{self.root}/checkpoints/{stage}"


def document_envelope(documents: DataFrame, topic: str = DOCUMENT_TOPIC) -> DataFrame:
    """Extended documents as messages again: keyed by row key, same position."""
    return documents.select(
        F.col("rowkey").alias("key"),
        "value",
        F.lit(topic).alias("topic"),
        "partition",
        "offset",
        "timestamp",
    )


def windows_of(
    documents: DataFrame, panes: bool = False, ahead_ms: int | None = None
) -> DataFrame:
    """Cookie windows from document messages, streaming or not.

    ``ahead_ms``: events that claim to be so much later than their message count nowhere
    and do not move the watermark.
    """
    keep = () if ahead_ms is None else ("timestamp",)
    events = parse_events(documents, WINDOW_COLUMNS, keep=keep)
    make = hopping_counters_by_pane if panes else hopping_counters
    latest = None if ahead_ms is None else by_message_time(ahead_ms)
    return make(cookie_events(events), latest_ms=latest)


def start_documents(
    messages: DataFrame,
    stages: Stages,
    fallback_time: Column | None = None,
    load_test_marker: str = LOAD_TEST_MARKER,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Stage 1: enrich and store documents. Stateless, appended exactly once."""
    if fallback_time is None:
        fallback_time = F.unix_millis("timestamp")
    documents = extended_documents(
        messages, fallback_time, load_test_marker, skip_rejects=True
    )
    return (
        document_envelope(documents)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", stages.documents)
        .option("checkpointLocation", stages.checkpoint("documents"))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_rejects(
    messages: DataFrame,
    stages: Stages,
    include_value: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The log of payloads that stage 1 left out: position and reason."""
    return (
        rejects(messages, include_value, whole=True)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", stages.rejects)
        .option("checkpointLocation", stages.checkpoint("rejects"))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_split(
    messages: DataFrame,
    stages: Stages,
    fallback_time: Column | None = None,
    load_test_marker: str = LOAD_TEST_MARKER,
    include_value: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Stage 1 and the log of rejects in one pass: each payload is read and judged once.

    One sink with a folder for either kind, so that a micro-batch's documents and rejects
    are there together or not at all. ``read_split`` and ``stream_split`` read a kind.
    """
    if fallback_time is None:
        fallback_time = F.unix_millis("timestamp")
    return (
        split_documents(messages, fallback_time, load_test_marker, include_value)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(KIND)
        .option("path", stages.split)
        .option("checkpointLocation", stages.checkpoint("split"))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_split(spark: SparkSession, stages: Stages, kind: str) -> DataFrame:
    """The documents or the rejects that ``start_split`` has stored."""
    return _kind_of(spark.read, stages, kind)


def stream_split(spark: SparkSession, stages: Stages, kind: str = DOCUMENT) -> DataFrame:
    """The same as a stream; documents are messages for the next stage."""
    return _kind_of(spark.readStream, stages, kind)


def _kind_of(reader, stages: Stages, kind: str) -> DataFrame:
    if kind not in (DOCUMENT, REJECT):
        raise ValueError(f"unknown kind {kind!r}")
    schema = StructType(
        [*ENVELOPE, StructField("reason", StringType()), StructField(KIND, StringType())]
    )
    rows = reader.schema(schema).parquet(stages.split).where(F.col(KIND) == kind)
    columns = ENVELOPE.fieldNames() if kind == DOCUMENT else ["partition", "offset", "reason", "value"]
    return rows.select(*columns)


def stream_documents(spark: SparkSession, stages: Stages) -> DataFrame:
    return spark.readStream.schema(ENVELOPE).parquet(stages.documents)


def start_final_windows(
    documents: DataFrame,
    stages: Stages,
    panes: bool = False,
    trigger: dict | None = None,
    ahead_ms: int | None = None,
) -> StreamingQuery:
    """Stage 2, final form: a window appears once, when no event can reach it."""
    prepare_streaming(documents.sparkSession)
    return (
        windows_of(documents, panes, ahead_ms)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", stages.windows)
        .option("checkpointLocation", stages.checkpoint("windows"))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_window_changes(
    documents: DataFrame,
    stages: Stages,
    trigger: dict | None = None,
    slice_ms: int | None = None,
    final: bool = False,
    ahead_ms: int | None = None,
) -> StreamingQuery:
    """Stage 2, change form: a window is written again whenever it changes.

    ``final``: only once, when it is closed. With ``slice_ms`` windows are laid out by the
    slice that their start is in, and ``expire_windows`` drops old slices.
    """
    return start_keyed(
        windows_of(documents, ahead_ms=ahead_ms),
        stages.windows,
        stages.checkpoint("windows"),
        trigger,
        "append" if final else "update",
        slices=("agg_time", slice_ms) if slice_ms else None,
    )


def start_counted(
    documents: DataFrame,
    stages: Stages,
    trigger: dict | None = None,
    ahead_ms: int | None = None,
) -> StreamingQuery:
    """Stage 2 with late rows kept: the events that count, each with the watermark at which
    it was read. ``read_timely_windows`` and ``read_late_windows`` part them."""
    events = parse_events(documents, WINDOW_COLUMNS)
    fields = [field.name for field in StructType.fromDDL(COUNTED_SCHEMA)]
    return start_stamped(
        cookie_events(events).select(*fields),
        stages.stamped,
        stages.checkpoint("stamped"),
        latest_ms=None if ahead_ms is None else by_message_time(ahead_ms),
        trigger=trigger,
    )


def read_timely_windows(
    spark: SparkSession, stages: Stages, ahead_ms: int | None = None
) -> DataFrame:
    latest = None if ahead_ms is None else by_message_time(ahead_ms)
    stamped = read_stamped(spark, stages.stamped, COUNTED_SCHEMA)
    return timely_counters(stamped, latest_ms=latest)


def read_late_windows(
    spark: SparkSession, stages: Stages, ahead_ms: int | None = None
) -> DataFrame:
    """Position and times of every event that a closed window was left without."""
    latest = None if ahead_ms is None else by_message_time(ahead_ms)
    stamped = read_stamped(spark, stages.stamped, COUNTED_SCHEMA)
    return late_windows(stamped, latest_ms=latest)


def start_session_panes(
    events: DataFrame,
    stages: Stages,
    gap_ms: int = 600_000,
    trigger: dict | None = None,
    latest_ms: int | Column | None = None,
) -> StreamingQuery:
    """Sessions for hot keys, first part: final panes of a gap's length.

    Events are combined per key and pane before the shuffle, so neither the network nor
    the state sees how many a key has. ``start_sessions`` joins the panes to sessions.
    """
    prepare_streaming(events.sparkSession)
    return (
        session_panes(events, gap_ms=gap_ms, latest_ms=latest_ms)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", stages.panes)
        .option("checkpointLocation", stages.checkpoint("panes"))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_sessions(
    spark: SparkSession,
    stages: Stages,
    gap_ms: int = 600_000,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Second part: a session appears once, when no pane can extend it.

    A session is then out about two gaps and the grace period after its last event.
    """
    prepare_streaming(spark)
    panes = spark.readStream.schema(PANE_SCHEMA).parquet(stages.panes)
    return (
        pane_sessions(panes, gap_ms=gap_ms)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", stages.sessions)
        .option("checkpointLocation", stages.checkpoint("sessions"))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_sessions(spark: SparkSession, stages: Stages) -> DataFrame:
    return spark.read.schema(SESSION_SCHEMA).parquet(stages.sessions)


def expire_windows(spark: SparkSession, stages: Stages, retention_ms: int) -> int | None:
    """Drop the slices of windows that ended so long before the stream's watermark."""
    return expire_keyed(spark, stages.windows, retention_ms)


def compact_windows(spark: SparkSession, stages: Stages) -> int:
    """Merge segments of changed windows, beside the running stage."""
    return compact_keyed(spark, stages.windows, WINDOW_SCHEMA, WINDOW_KEYS)


def read_final_windows(spark: SparkSession, stages: Stages) -> DataFrame:
    return spark.read.schema(WINDOW_SCHEMA).parquet(stages.windows)


def read_window_changes(spark: SparkSession, stages: Stages) -> DataFrame:
    return read_keyed(spark, stages.windows, WINDOW_SCHEMA, WINDOW_KEYS)


def start_features(
    spark: SparkSession,
    stages: Stages,
    ratio_mode: str = "integer",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Stage 3: features over the final windows of stage 2.

    State is one small row per cookie and is never dropped; give it the RocksDB
    state store (``session.SESSION_DEFAULTS``) and enough shuffle partitions.
    """
    windows = spark.readStream.schema(WINDOW_SCHEMA).parquet(stages.windows)
    return start_keyed(
        cookie_features(windows, ratio_mode),
        stages.features,
        stages.checkpoint("features"),
        trigger,
    )


def read_features(spark: SparkSession, stages: Stages) -> DataFrame:
    return read_keyed(spark, stages.features, FEATURE_SCHEMA, ["u"])


def start_topic_writer(
    documents: DataFrame,
    topic: str,
    options: dict[str, str],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Publish documents to a topic, keyed by row key so that each key stays in one
    partition. ``options`` from ``sources.kafka`` add to the durable defaults there;
    needs the connector package."""
    return (
        documents.select(F.col("rowkey").alias("key"), "value")
        .writeStream.format("kafka")
        .options(**{**DURABLE_WRITER, **options})
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
