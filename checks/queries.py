"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import messages as m
from clickweir.functions.coerce import coerce
from clickweir.functions.hashing import text_hash
from clickweir.functions.text import null_text
from clickweir.operators import enrich, features, imports, latest, parse, windows
from clickweir.plans import batch, positions, sql_job
from clickweir.session import fresh_folder
from clickweir.sinks import files, render, tables
from clickweir.sinks.manifests import ManifestLog
from clickweir.sources.envelope import read_replay, stream_replay, write_replay
from clickweir.sources.stream_spec import StreamSpec
from clickweir.sources.task_spec import TaskSpec
from clickweir.streaming import keyed, late, pipeline
from clickweir.streaming.append import start_table_append

Query = Callable[[SparkSession, str], DataFrame]

TASKS_PER_CORE = 3  # that stored messages are dealt out to


def no_clock() -> Column:
    """Events without a time of their own get 0, so that results repeat."""
    return F.lit(0)


# --- enrichment ---------------------------------------------------------------


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.enriched_events(m.clickstream(spark, sf_dir), no_clock())


def core_field(column: str, name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return enriched(spark, sf_dir).select("offset", F.col(column).alias(name))

    return query


def core_enriched(spark, sf_dir):
    return enriched(spark, sf_dir).drop("timestamp", "infm_raw_params")


def core_extend_json(spark, sf_dir):
    documents = enrich.extended_documents(m.clickstream(spark, sf_dir), no_clock())
    return documents.select("offset", "rowkey", "value")


def core_rekey(spark, sf_dir):
    folder = fresh_folder(spark, "rekeyed")
    rows = enrich.rekey(core_extend_json(spark, sf_dir), buckets=8)
    rows.write.partitionBy("key_bucket").parquet(folder)
    return spark.read.parquet(folder).select("offset", "rowkey", "value")


def core_extend_json_messy(spark, sf_dir):
    documents = enrich.extended_documents(m.messy(spark, sf_dir), no_clock())
    reread = parse.extract_fields(documents, ["_ua_is_test"], ["offset"])
    return reread.select("offset", F.col("_ua_is_test").isNotNull().alias("extended"))


def core_extend_json_ends(spark, sf_dir):
    documents = enrich.extended_documents(m.odd_ends(spark, sf_dir), no_clock())
    return documents.select("offset", "rowkey", "value")


def rejects_ends(spark, sf_dir):
    return parse.rejects(m.odd_ends(spark, sf_dir), whole=True)


# --- extraction and typing ----------------------------------------------------


def parse_top_level(spark, sf_dir):
    names = ["eid", "uid", "ua", "o"]
    fields = parse.extract_fields(m.messy(spark, sf_dir), names, ["offset"])
    return fields.select("offset", *[null_text(F.col(n)).alias(n) for n in names])


def parse_typed(spark, sf_dir):
    return parse.parse_events(
        m.messy(spark, sf_dir), "eid int, uid int", keep=["offset"], rowkey=None
    )


def parse_case_fallback(spark, sf_dir):
    return parse.parse_events(
        m.messy(spark, sf_dir), "eid int, uid int", keep=["offset"], rowkey=None, match="sql"
    )


def null_normalise(spark, sf_dir):
    raw = parse.extract_fields(m.messy(spark, sf_dir), {"raw": "ua"}, [])
    return (
        raw.groupBy(
            F.coalesce("raw", F.lit("absent")).alias("raw"),
            null_text(F.col("raw")).alias("text"),
        )
        .agg(F.count("*").alias("n"))
    )


def parse_rejects(spark, sf_dir):
    return parse.rejects(m.messy(spark, sf_dir), include_value=True)


def parse_whole_document(spark, sf_dir):
    return parse.parse_events(
        m.messy(spark, sf_dir), "eid int", keep=["offset"], document="document"
    ).select("offset", "rowkey", "document")


def _core_stream_spec() -> StreamSpec:
    return StreamSpec(
        name="clickstream_eid_time",
        topic=pipeline.DOCUMENT_TOPIC,
        columns=pipeline.WINDOW_COLUMNS,
        time_column="_server_time",
    )


def _stored_messages(spark, sf_dir) -> DataFrame:
    """The click stream, stored as it is in a topic.

    The events are dealt out first: a table of few row groups would leave all that reads
    its messages to as few tasks. Only stored texts are filtered without being made anew
    for each use that a condition has for them.
    """
    folder = fresh_folder(spark, "messages")
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    events = m.events_table(spark, sf_dir).repartition(tasks)
    m.clickstream_rows(events).write.parquet(folder)
    return read_replay(spark, folder)


def _store_documents(spark, sf_dir) -> str:
    """Extended documents, stored between the jobs as they are in a topic."""
    folder = fresh_folder(spark, "documents")
    documents = enrich.extended_documents(
        _stored_messages(spark, sf_dir), no_clock(), skip_rejects=True
    )
    pipeline.document_envelope(documents).write.parquet(folder)
    return folder


def _core_messages(spark, sf_dir):
    return read_replay(spark, _store_documents(spark, sf_dir))


def declared_stream(spark, sf_dir):
    rows = _core_stream_spec().open(_core_messages(spark, sf_dir))
    return rows.select(
        "rowkey", "eid", "uid", "_server_time", "_ua_is_test",
        F.unix_millis("event_time").alias("event_ms"),
    )


def coercion(types: dict[str, tuple[str, str]]) -> Query:
    """Column name -> (type, mode), all over the same odd numbers."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = m.events_table(spark, sf_dir).select(
            F.col("event_id").alias("offset"), m.odd_number_text().alias("text")
        )
        columns = []
        for name, (kind, mode) in types.items():
            column = coerce(F.col("text"), kind, mode)
            columns.append((column.cast("string") if kind == "uint64" else column).alias(name))
        return rows.select("offset", *columns)

    return query


def _import_parts(spark, sf_dir):
    number = F.col("event_id")
    rows = m.events_table(spark, sf_dir).select(
        "event_id",
        F.when(number % 6 == 0, "bad").otherwise(F.col("user_id").cast("string")).alias("id"),
        F.when(number % 5 == 0, "")
        .when(number % 5 == 1, "x1")
        .otherwise(F.col("value").cast("string"))
        .alias("amount"),
        F.when(number % 7 == 0, "2024-13-01")
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("day"),
        F.col("event_type").alias("kind"),
    )
    types = {"id": "int", "amount": "double", "day": "date", "kind": "varchar"}
    return imports.import_rows(rows, types, keep=["event_id"], required=["id"])


def import_null_safe(spark, sf_dir):
    accepted, _ = _import_parts(spark, sf_dir)
    return accepted.withColumn("day", F.col("day").cast("string"))


def import_rejected(spark, sf_dir):
    _, rejected = _import_parts(spark, sf_dir)
    return rejected.withColumn("missing", F.array_join("missing", ","))


# --- windows and features -----------------------------------------------------


def filter_cookie_events(spark, sf_dir):
    return windows.cookie_events(enriched(spark, sf_dir)).select(
        "offset", "rowkey", "eid", "uid", F.col("_server_time").alias("server_time")
    )


def cookies_hopping(spark, sf_dir):
    return batch.cookie_windows(m.clickstream(spark, sf_dir), no_clock())


def cookies_hopping_untimely(spark, sf_dir):
    return batch.cookie_windows(m.untimely(spark, sf_dir), no_clock())


def cookies_hopping_panes(spark, sf_dir):
    return batch.cookie_windows(m.clickstream(spark, sf_dir), no_clock(), panes=True)


def cookies_hopping_fast(spark, sf_dir):
    return windows.hopping_counters(m.compressed_clock(spark, sf_dir))


def cookies_hopping_fast_panes(spark, sf_dir):
    return windows.hopping_counters_by_pane(m.compressed_clock(spark, sf_dir))


def cookies_tumbling(spark, sf_dir):
    return windows.tumbling_counters(windows.cookie_events(enriched(spark, sf_dir)))


def cookies_session(spark, sf_dir):
    return windows.session_counters(windows.cookie_events(enriched(spark, sf_dir)))


def latest_by_offset(spark, sf_dir):
    events = enriched(spark, sf_dir).where(F.col("rowkey").isNotNull())
    return latest.latest_rows(events, ["rowkey"], ["ua", "src_id", "uid"])


def fast_features(mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return features.cookie_features(cookies_hopping_fast(spark, sf_dir), mode)

    return query


def message_features(mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return batch.features(m.clickstream(spark, sf_dir), no_clock(), mode)

    return query


SQL_COUNTS = ", ".join(f"count_if(eid = {i}) AS {n}" for n, i in windows.COUNTERS.items())
SQL_EVENTS = ", ".join(map(str, windows.COUNTERS.values()))
SQL_WINDOW = f"window(event_time, '{windows.WINDOW_SIZE}', '{windows.WINDOW_HOP}')"
SQL_JOB = (
    (
        "cookie_windows",
        f"""
        SELECT rowkey AS u, window_start_ms({SQL_WINDOW}) AS agg_time, {SQL_COUNTS}
        FROM clickstream_eid_time
        WHERE rowkey > '' AND _ua_is_test = 0 AND eid IN ({SQL_EVENTS})
        GROUP BY rowkey, {SQL_WINDOW}
        """,
    ),
    (
        "cookie_flags",
        """
        SELECT u, max(agg_time) AS agg_time, max(cnt_pixel) > 0 AS has_pixel,
               max(if(cnt_item_view >= 5, int_ratio(cnt_phone_view, cnt_item_view), 0)) > 0.95
                 AS has_ctr_broken,
               min(if(cnt_item_view >= 5, int_ratio(cnt_app_item, cnt_item_view), 1)) < 0.2
                 AS has_frontback_iv_broken,
               min(if(cnt_phone_view >= 5, int_ratio(cnt_app_call, cnt_phone_view), 1)) < 0.2
                 AS has_frontback_ph_broken
        FROM cookie_windows GROUP BY u
        """,
    ),
)


def sql_job_query(spark, sf_dir):
    return sql_job.run_sql(
        spark, {_core_stream_spec(): _core_messages(spark, sf_dir)}, SQL_JOB
    )


def sql_job_core(spark, sf_dir):
    """The first job in SQL: the added fields go into the whole document."""
    sql_job.register_functions(spark)
    events = enriched(spark, sf_dir).select("offset", "_server_time", "_platform_id")
    documents = m.odd_ends(spark, sf_dir).select("offset", "value")
    events.join(documents, "offset").createOrReplaceTempView("core_events")
    return spark.sql(
        """SELECT offset, extend_json(map('_server_time', _server_time,
                  '_platform_id', _platform_id), value) AS value FROM core_events"""
    )


def sql_stream(changes: bool) -> Query:
    """The windows of the SQL job over a stream, as finals or as the latest changes."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = fresh_folder(spark, "sql-stream")
        source = _store_documents(spark, sf_dir)
        job = sql_job.start_sql(
            spark, {_core_stream_spec(): stream_replay(spark, source)}, SQL_JOB[:1],
            f"{folder}/out", f"{folder}/checkpoint", changes=changes,
        )
        _drain(job)
        schema = "u string, agg_time long, " + ", ".join(f"{n} long" for n in windows.COUNTERS)
        if changes:
            return keyed.read_keyed(spark, f"{folder}/out", schema, ["u", "agg_time"])
        return spark.read.schema(schema).parquet(f"{folder}/out")

    return query


# --- exports ------------------------------------------------------------------


def export(
    spec: str, source: Query = m.clickstream, delimiter: str = "|", spelling: str = "decoded"
) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return render.render_lines(source(spark, sf_dir), spec, delimiter, spelling=spelling)

    return query


COLUMN_SPEC = "timestamp;columns:uid,eid,dt,dtm,src_id,src,ua"
GROUP_SPEC = "partition;offset;columns:uid,eid=ids,app=ids,cid,dt=rest,src=rest,dtm=rest"
SPARSE_SPEC = "offset;array:uid,ua=agent,dt,app=agent,dtm"


def export_eav(spark, sf_dir):
    return render.entity_rows(m.messy(spark, sf_dir), ["offset"])


def sparse(layout: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = render.sparse_groups(m.clickstream(spark, sf_dir), SPARSE_SPEC, layout)
        parts = None
        for group in ("values", "agent"):
            if layout == "map":
                part = rows.select(
                    "offset", F.lit(group).alias("grp"), F.explode(group).alias("field", "text")
                )
            else:
                part = rows.select(
                    "offset", F.lit(group).alias("grp"), F.explode(group).alias("entry")
                ).select(
                    "offset", "grp", F.col("entry.position").alias("place"),
                    F.col("entry.text").alias("text"),
                )
            parts = part if parts is None else parts.unionByName(part)
        return parts

    return query


def export_text_files(spark, sf_dir):
    folder = fresh_folder(spark, "lines")
    files.write_lines(m.clickstream(spark, sf_dir), folder, GROUP_SPEC, compression="gzip")
    return spark.read.text(folder).withColumnRenamed("value", "line")


def hash_query(method: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        fields = m.event_fields()
        rows = m.events_table(spark, sf_dir).select(
            F.col("event_id").alias("offset"),
            fields["uuid"].alias("uuid"), fields["ua"].alias("ua"), m.row_key().alias("key"),
            F.col("props").alias("props"), fields["cid"].cast("string").alias("cid"),
        )
        names = ["uuid", "ua", "key", "props", "cid"]
        return rows.select(
            "offset", *[text_hash(F.col(n), method).alias(f"{n}_hash") for n in names]
        )

    return query


def hash_documents(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents.select("doc_id", text_hash(F.col("text"), "compat").alias("text_hash"))


ORC_COLUMNS = (
    "src_id:bigint,src:bigint,uuid:string,uid:bigint,eid:bigint,dt:bigint,dtm:double,ua:boolean"
)


def orc_roundtrip(spark, sf_dir):
    folder = fresh_folder(spark, "orc")
    files.write_orc(m.clickstream(spark, sf_dir), folder, ORC_COLUMNS)
    return spark.read.orc(folder).withColumnRenamed("ua", "flag")


def typed_batch(spark, sf_dir):
    folder = fresh_folder(spark, "batch")
    rows = files.typed_batch(
        m.clickstream(spark, sf_dir), "eid:integer,dt:timestamp,uuid:boolean,ua:string"
    )
    rows.withColumnRenamed("uuid", "ok").write.parquet(folder)
    return spark.read.parquet(folder)


TABLE_DDL = (
    "_partition INT, _offset BIGINT, _timestamp BIGINT, eid BIGINT, uid INT, dtm DOUBLE, "
    "ua STRING, app SMALLINT"
)


def new_table(spark: SparkSession, label: str, ddl: str) -> tuple[str, str]:
    """An empty external table in the shared folder: (name, location)."""
    location = fresh_folder(spark, label)
    name = location.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet LOCATION '{location}'")
    return name, location


def appended(ddl: str, nulls: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        name, _ = new_table(spark, "append", ddl)
        tables.append_to_table(m.clickstream(spark, sf_dir), name, nulls)
        return spark.table(name)

    return query


def task(spec: str, stored: dict[int, int] | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = fresh_folder(spark, "replay")
        write_replay(m.clickstream(spark, sf_dir), folder)
        rows = TaskSpec.parse(spec).select(read_replay(spark, folder), stored)
        return rows.select("partition", "offset", "key", "value")

    return query


class _Lost(RuntimeError):
    """An executor or driver that is lost before its run is published."""


def task_resume(spark, sf_dir):
    """Two bounded runs from stored positions, and a third that dies between them."""
    folder = fresh_folder(spark, "resume")
    write_replay(m.clickstream(spark, sf_dir), f"{folder}/in")
    messages = read_replay(spark, f"{folder}/in")
    log = ManifestLog(spark, f"{folder}/log")

    def write(rows: DataFrame, name: str) -> None:
        rows.write.parquet(f"{folder}/out/{name}")

    def dies(rows: DataFrame, name: str) -> None:
        write(rows, name)
        raise _Lost

    for limit, step in ((1500, write), (700, dies), (2200, write)):
        spec = TaskSpec.parse(f"%:-1000:{limit}")
        try:
            positions.run_from_positions(messages, spec, log, step, start_earliest=True)
        except _Lost:
            pass
    rows = positions.read_published(spark, log, f"{folder}/out", messages.schema)
    return rows.select("partition", "offset", "key", "value")


LIMITED = "0:40:700,1:-2:300,2-3:-2:1100"


def stream_limits(spark, sf_dir):
    """Several clauses over three deliveries, a run for each: the counters go on."""
    folder = fresh_folder(spark, "limits")
    log = ManifestLog(spark, f"{folder}/log")
    messages = m.clickstream(spark, sf_dir)
    most = m.events_table(spark, sf_dir).agg(F.max("event_id")).first()[0]
    third = F.floor(F.col("offset") * 3 / (most + 1))

    def write(rows: DataFrame, name: str) -> None:
        rows.write.parquet(f"{folder}/out/{name}")

    for delivery in range(3):
        messages.where(third == delivery).write.mode("append").parquet(f"{folder}/in")
        query = positions.start_from_positions(
            stream_replay(spark, f"{folder}/in"), TaskSpec.parse(LIMITED), log,
            f"{folder}/checkpoint", write,
        )
        _drain(query)
    rows = positions.read_published(spark, log, f"{folder}/out", messages.schema)
    return rows.select("partition", "offset", "key", "value")


def task_two_topics(spark, sf_dir):
    """Every topic has the task's limit for itself."""
    topic = F.when(F.col("offset") % 3 == 0, "second").otherwise(F.col("topic"))
    folder = fresh_folder(spark, "replay")
    write_replay(m.clickstream(spark, sf_dir).withColumn("topic", topic), folder)
    rows = TaskSpec.parse("0-2:5:60,3:-2:7").select(read_replay(spark, folder))
    return rows.select("topic", "partition", "offset")


# --- streams ------------------------------------------------------------------


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of files."""
    schema = m.events_table(spark, sf_dir).schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )


def clickstream_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.envelope(events_stream(spark, sf_dir), m.document(), m.row_key())


def _drain(query) -> None:
    query.awaitTermination()


def _stages(spark: SparkSession, label: str) -> pipeline.Stages:
    return pipeline.Stages(fresh_folder(spark, label))


def _file_sink(rows: DataFrame, spark: SparkSession, label: str, fmt: str = "parquet") -> DataFrame:
    """Run a stream to its end into files and read them back."""
    folder = fresh_folder(spark, label)
    _drain(
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    schema = rows.schema
    return spark.read.schema(schema).format(fmt).load(f"{folder}/out")


def _keyed_sink(rows: DataFrame, spark: SparkSession, label: str, keys) -> DataFrame:
    folder = fresh_folder(spark, label)
    _drain(keyed.start_keyed(rows, f"{folder}/out", f"{folder}/checkpoint"))
    return keyed.read_keyed(spark, f"{folder}/out", rows.schema, keys)


def _stream_counted(spark, sf_dir):
    return windows.cookie_events(
        batch.enriched_events(clickstream_stream(spark, sf_dir), no_clock())
    )


def stream_append_final(spark, sf_dir):
    rows = windows.hopping_counters(_stream_counted(spark, sf_dir))
    return _file_sink(rows, spark, "final")


def _fast_stream(spark, sf_dir):
    return m.compressed_clock_rows(events_stream(spark, sf_dir))


def stream_append_panes(spark, sf_dir):
    rows = windows.hopping_counters_by_pane(_fast_stream(spark, sf_dir))
    return _file_sink(rows, spark, "panes")


def stream_update_upsert(spark, sf_dir):
    rows = windows.hopping_counters(_stream_counted(spark, sf_dir))
    return _keyed_sink(rows, spark, "upsert", pipeline.WINDOW_KEYS)


def stream_tumbling(spark, sf_dir):
    rows = windows.tumbling_counters(_stream_counted(spark, sf_dir))
    return _keyed_sink(rows, spark, "tumbling", pipeline.WINDOW_KEYS)


def stream_session(spark, sf_dir):
    rows = windows.session_counters(_stream_counted(spark, sf_dir))
    return _file_sink(rows, spark, "session")


def _late_last(spark, sf_dir, folder: str):
    """Three deliveries: every tenth event comes last, after the watermark has passed."""
    events = m.compressed_clock(spark, sf_dir)
    late_ones = F.col("offset") % 10 == 9
    half = F.col("_server_time") < m.EPOCH_MS + 600_000
    for delivery in (~late_ones & half, ~late_ones & ~half, late_ones):
        events.where(delivery).write.mode("append").parquet(f"{folder}/in")
        yield spark.readStream.schema(events.schema).parquet(f"{folder}/in")


def stream_late_drop(spark, sf_dir):
    """Every tenth event is delivered last, after the watermark has passed."""
    folder = fresh_folder(spark, "late")
    rows = None
    for stream in _late_last(spark, sf_dir, folder):
        rows = windows.hopping_counters(stream)
        _drain(keyed.start_keyed(rows, f"{folder}/out", f"{folder}/checkpoint"))
    return keyed.read_keyed(spark, f"{folder}/out", rows.schema, pipeline.WINDOW_KEYS)


def _stamped(spark, sf_dir, label: str) -> DataFrame:
    folder = fresh_folder(spark, label)
    schema = None
    for stream in _late_last(spark, sf_dir, folder):
        schema = stream.schema
        _drain(late.start_stamped(stream, f"{folder}/out", f"{folder}/checkpoint"))
    return late.read_stamped(spark, f"{folder}/out", schema)


def stream_late_rows(spark, sf_dir):
    """What stream_late_drop drops: each event and window, and the watermark it missed."""
    found = late.late_windows(_stamped(spark, sf_dir, "late-rows"))
    return found.select("rowkey", "offset", "eid", "_server_time", "agg_time", late.CUT)


def stream_late_counters(spark, sf_dir):
    """What stream_late_drop counts, from the events that stream_late_rows are taken from."""
    return late.timely_counters(_stamped(spark, sf_dir, "late-counters"))


PANE_GAP_MS = 20_000


def stream_session_panes(spark, sf_dir):
    """Sessions from final panes, in three deliveries; every third event has one key."""
    stages = _stages(spark, "session-panes")
    for stream in _in_thirds(spark, sf_dir, stages.root):
        hot = F.when(F.col("offset") % 3 == 0, "hot").otherwise(F.col("rowkey"))
        events = stream.withColumn("rowkey", hot)
        _drain(pipeline.start_session_panes(events, stages, PANE_GAP_MS))
        _drain(pipeline.start_sessions(spark, stages, PANE_GAP_MS))
    return pipeline.read_sessions(spark, stages)


def _in_thirds(spark, sf_dir, folder: str):
    """The events on the compressed clock as three deliveries in time order, one at a time."""
    events = m.compressed_clock(spark, sf_dir)
    low, high = events.agg(F.min("_server_time"), F.max("_server_time")).first()
    third = F.floor((F.col("_server_time") - low) * 3 / (high - low + 1))
    for delivery in range(3):
        events.where(third == delivery).write.mode("append").parquet(f"{folder}/in")
        yield spark.readStream.schema(events.schema).parquet(f"{folder}/in")


def stream_compacted(spark, sf_dir):
    """Changes of windows, with segments merged and old ones deleted after every delivery."""
    folder = fresh_folder(spark, "compacted")
    rows = None
    for stream in _in_thirds(spark, sf_dir, folder):
        rows = windows.hopping_counters(stream)
        _drain(keyed.start_keyed(rows, f"{folder}/out", f"{folder}/checkpoint"))
        keyed.compact_keyed(spark, f"{folder}/out", rows.schema, pipeline.WINDOW_KEYS, fanout=2)
        keyed.vacuum_keyed(spark, f"{folder}/out", versions=1)
    return keyed.read_keyed(spark, f"{folder}/out", rows.schema, pipeline.WINDOW_KEYS)


RETENTION_MS = 360_000
SLICE_MS = 240_000


def stream_retention(spark, sf_dir):
    """Final windows of which whole slices expire by the stream's watermark."""
    folder = fresh_folder(spark, "retention")
    rows = None
    for stream in _in_thirds(spark, sf_dir, folder):
        rows = windows.hopping_counters(stream)
        query = keyed.start_keyed(
            rows, f"{folder}/out", f"{folder}/checkpoint", output_mode="append",
            slices=("agg_time", SLICE_MS),
        )
        _drain(query)
        keyed.expire_keyed(spark, f"{folder}/out", RETENTION_MS)
    return keyed.read_keyed(spark, f"{folder}/out", rows.schema, pipeline.WINDOW_KEYS)


def stream_far_future(spark, sf_dir):
    """Final windows though every 53rd event claims to be 1000 days ahead of its message."""
    folder = fresh_folder(spark, "far-future")
    rows = None
    wrong = F.when(F.col("offset") % 53 == 0, 86_400_000 * 1000).otherwise(0)
    for stream in _in_thirds(spark, sf_dir, folder):
        events = stream.withColumn("timestamp", F.timestamp_millis("_server_time"))
        events = events.withColumn("_server_time", F.col("_server_time") + wrong)
        rows = windows.hopping_counters(events, latest_ms=windows.by_message_time(5_000))
        query = keyed.start_keyed(
            rows, f"{folder}/out", f"{folder}/checkpoint", output_mode="append"
        )
        _drain(query)
    return keyed.read_keyed(spark, f"{folder}/out", rows.schema, pipeline.WINDOW_KEYS)


def stream_split(spark, sf_dir):
    """Documents and rejects of one pass over texts with odd ends."""
    stages = _stages(spark, "split")
    messages = m.odd_ends_rows(events_stream(spark, sf_dir))
    _drain(pipeline.start_split(messages, stages, no_clock()))
    documents = pipeline.read_split(spark, stages, "document").select(
        "partition", "offset", "key", "value", F.lit(None).cast("string").alias("reason")
    )
    rejected = pipeline.read_split(spark, stages, "reject").select(
        "partition", "offset", F.lit(None).cast("string").alias("key"), "value", "reason"
    )
    return documents.unionByName(rejected)


def stream_documents(spark, sf_dir):
    stages = _stages(spark, "documents")
    _drain(pipeline.start_documents(clickstream_stream(spark, sf_dir), stages))
    return spark.read.parquet(stages.documents).drop("timestamp")


def messy_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.envelope(events_stream(spark, sf_dir), m.messy_document(), m.row_key())


def stream_rejects(spark, sf_dir):
    stages = _stages(spark, "rejects")
    _drain(pipeline.start_rejects(messy_stream(spark, sf_dir), stages, include_value=True))
    return spark.read.parquet(stages.rejects)


def stream_features(spark, sf_dir):
    stages = _stages(spark, "features")
    rows = windows.hopping_counters(_fast_stream(spark, sf_dir))
    _drain(
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", stages.windows)
        .option("checkpointLocation", stages.checkpoint("windows"))
        .trigger(availableNow=True)
        .start()
    )
    _drain(pipeline.start_features(spark, stages))
    return pipeline.read_features(spark, stages)


def pipeline_end_to_end(spark, sf_dir):
    """Messages to documents to windows to features, three queries."""
    stages = _stages(spark, "chain")
    _drain(pipeline.start_documents(clickstream_stream(spark, sf_dir), stages))
    _drain(pipeline.start_final_windows(pipeline.stream_documents(spark, stages), stages))
    _drain(pipeline.start_features(spark, stages))
    return pipeline.read_features(spark, stages)


def stream_table_append(spark, sf_dir):
    name, location = new_table(spark, "continuous", TABLE_DDL)
    checkpoint = fresh_folder(spark, "checkpoint")
    _drain(start_table_append(clickstream_stream(spark, sf_dir), name, checkpoint))
    return spark.table(name)


def stream_export_columns(spark, sf_dir):
    rows = render.render_lines(clickstream_stream(spark, sf_dir), COLUMN_SPEC)
    return _file_sink(
        rows.withColumnRenamed("line", "value"), spark, "text", "text"
    ).withColumnRenamed("value", "line")


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "core_server_time": core_field("_server_time", "server_time"),
        "core_apptype": core_field("_apptype_id", "apptype"),
        "core_clientapp": core_field("_clientsideapp_id", "clientapp"),
        "core_platform": core_field("_platform_id", "platform"),
        "core_is_test": core_field("_ua_is_test", "is_test"),
        "core_enriched": core_enriched,
        "core_extend_json": core_extend_json,
        "core_extend_json_messy": core_extend_json_messy,
        "core_extend_json_ends": core_extend_json_ends,
        "rejects_ends": rejects_ends,
        "core_rekey": core_rekey,
        "parse_top_level": parse_top_level,
        "parse_typed": parse_typed,
        "parse_case_fallback": parse_case_fallback,
        "null_normalise": null_normalise,
        "parse_rejects": parse_rejects,
        "parse_whole_document": parse_whole_document,
        "declared_stream": declared_stream,
        "coerce_strict": coercion(
            {
                "i32": ("int", "strict"),
                "i64": ("bigint", "strict"),
                "f64": ("double", "strict"),
                "u8": ("uint8", "strict"),
                "flag": ("boolean", "strict"),
            }
        ),
        "coerce_number": coercion({"i32": ("int", "number")}),
        "coerce_prefix_int": coercion({"i32": ("int", "prefix"), "i64": ("bigint", "prefix")}),
        "coerce_unsigned": coercion(
            {
                "u8": ("uint8", "prefix"),
                "u32": ("uint32", "prefix"),
                "u64": ("uint64", "prefix"),
            }
        ),
        "coerce_truthy": coercion(
            {
                "u8": ("uint8", "append"),
                "i32": ("int", "append"),
                "i64": ("bigint", "append"),
            }
        ),
        "coerce_float": coercion({"f64": ("double", "prefix")}),
        "coerce_boolean": coercion({"flag": ("boolean", "prefix")}),
        "import_null_safe": import_null_safe,
        "import_rejected": import_rejected,
        "filter_cookie_events": filter_cookie_events,
        "cookies_hopping": cookies_hopping,
        "cookies_hopping_panes": cookies_hopping_panes,
        "cookies_hopping_untimely": cookies_hopping_untimely,
        "cookies_hopping_fast": cookies_hopping_fast,
        "cookies_hopping_fast_panes": cookies_hopping_fast_panes,
        "cookies_tumbling": cookies_tumbling,
        "cookies_session": cookies_session,
        "latest_by_offset": latest_by_offset,
        "features_integer": fast_features("integer"),
        "features_fraction": fast_features("fraction"),
        "features_integer_messages": message_features("integer"),
        "features_fraction_messages": message_features("fraction"),
        "sql_job": sql_job_query,
        "sql_job_core": sql_job_core,
        "sql_stream_final": sql_stream(False),
        "sql_stream_changes": sql_stream(True),
        "export_json_lines": export("partition;offset;key;timestamp;json"),
        "export_columns": export(COLUMN_SPEC),
        "export_columns_messy": export("offset;columns:uid,eid,o", m.messy, ";"),
        "export_grouped": export(GROUP_SPEC),
        "export_eav": export_eav,
        "export_sparse_map": sparse("map"),
        "export_sparse_positions": sparse("positions"),
        "export_columns_spelled": export("offset;columns:uid,o,p,params", m.spelled),
        "export_message_spelling": export(
            "offset;columns:uid,o,s,p,hash(params),hash(s),hash(uid)", m.spelled, spelling="message"
        ),
        "export_eav_spelling": export("offset;eav", m.spelled, spelling="message"),
        "export_hash": export("offset;columns:hash(uuid),uid,hash(ua)"),
        "export_text_files": export_text_files,
        "hash_compat": hash_query("compat"),
        "hash_xxhash": hash_query("xxhash64"),
        "hash_documents": hash_documents,
        "orc_roundtrip": orc_roundtrip,
        "typed_batch": typed_batch,
        "table_append": appended(TABLE_DDL, "keep"),
        "table_append_defaults": appended(TABLE_DDL, "default"),
        "table_append_self_filled": appended(
            "_offset BIGINT, uid INT, origin STRING DEFAULT 'stream'", "keep"
        ),
        "task_spec_limit": task("0:100:700,1:-2:55,3:0:100000"),
        "task_spec_range": task("1-3:500:3000"),
        "task_spec_two_topics": task_two_topics,
        "task_spec_total": task("*:-2:4321"),
        "task_spec_resume": task_resume,
        "stream_limits": stream_limits,
        "task_spec_stored": task("0-3:-1000:6000", {0: 900, 1: 10, 2: 0, 3: 0}),
        "stream_append_final": stream_append_final,
        "stream_append_panes": stream_append_panes,
        "stream_update_upsert": stream_update_upsert,
        "stream_tumbling": stream_tumbling,
        "stream_session": stream_session,
        "stream_late_drop": stream_late_drop,
        "stream_late_rows": stream_late_rows,
        "stream_late_counters": stream_late_counters,
        "stream_session_panes": stream_session_panes,
        "stream_compacted": stream_compacted,
        "stream_retention": stream_retention,
        "stream_far_future": stream_far_future,
        "stream_split": stream_split,
        "stream_documents": stream_documents,
        "stream_rejects": stream_rejects,
        "stream_features": stream_features,
        "pipeline_end_to_end": pipeline_end_to_end,
        "stream_table_append": stream_table_append,
        "stream_export_columns": stream_export_columns,
    }
    return found
