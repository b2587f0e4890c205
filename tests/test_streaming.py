"""Streams over files that arrive one delivery at a time."""

import pytest
from pyspark.sql import functions as F

from checks import messages as m
from checks import queries as q
from clickweir.operators import enrich, windows
from clickweir.operators.features import cookie_features
from clickweir.plans import batch
from clickweir.session import fresh_folder
from clickweir.sinks.tables import append_to_table
from clickweir.sources.envelope import stream_replay, write_replay
from clickweir.streaming import keyed, late, pipeline
from clickweir.streaming.append import start_table_append
from clickweir.streaming.run import Observed, ProgressSums, run_bounded

EVENT = "rowkey string, eid int, uid int, _server_time bigint, _ua_is_test bigint"
MINUTE = 60_000


class Deliveries:
    """A folder of event files and a query over it that is restarted each time."""

    def __init__(self, spark, make=windows.hopping_counters):
        self.spark, self.make = spark, make
        self.folder = fresh_folder(spark, "deliveries")
        self.late = 0

    def deliver(self, *rows):
        events = [(key, 301, 1, int(minute * MINUTE), 0) for key, minute in rows]
        frame = self.spark.createDataFrame(events, EVENT).coalesce(1)
        frame.write.mode("append").parquet(f"{self.folder}/in")
        stream = self.spark.readStream.schema(EVENT).parquet(f"{self.folder}/in")
        self.rows = self.make(stream)
        query = (
            self.rows.writeStream.format("parquet")
            .option("path", f"{self.folder}/out")
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        observed = Observed()
        assert run_bounded(query, observed=observed) == "finished"
        self.late += observed.late

    def result(self):
        found = self.spark.read.schema(self.rows.schema).parquet(f"{self.folder}/out")
        return {
            (r["rowkey"], r["agg_time"] // MINUTE): r["cnt_item_view"] for r in found.collect()
        }


def test_final_results_and_late_rows(spark):
    runs = Deliveries(spark)
    runs.deliver(("a", 1), ("a", 20))
    assert runs.result() == {("a", -8): 1, ("a", -6): 1, ("a", -4): 1, ("a", -2): 1, ("a", 0): 1}
    runs.deliver(("a", 12), ("b", 21))
    # minute 19 is safe: three of the five windows around minute 12 are closed
    assert runs.late == 3
    runs.deliver(("a", 9.5), ("c", 60))
    assert runs.late == 3 + 5
    found = runs.result()
    assert found[("a", 0)] == 1
    assert found[("a", 12)] == 2 and found[("b", 20)] == 1
    assert not any(key == "c" for key, _ in found)


def test_an_untimely_event_stops_nothing(spark):
    runs = Deliveries(spark)
    runs.deliver(("a", 1), ("bad", 1.5e14), ("bad", -1.5e14), ("a", 20))
    runs.deliver(("a", 21), ("bad", 1.5e14))
    runs.deliver(("c", 60))
    found = runs.result()
    assert found[("a", 0)] == 1 and runs.late == 0
    assert not any(key == "bad" for key, _ in found)


def test_restart_repeats_nothing(spark):
    runs = Deliveries(spark)
    for minute in (1, 30, 60, 90):
        runs.deliver(("a", minute))
    out = spark.read.parquet(f"{runs.folder}/out")
    assert out.groupBy("rowkey", "agg_time").count().where("count > 1").count() == 0
    assert out.count() == 15


def test_panes_agree_with_the_plain_form(spark):
    plain, panes = Deliveries(spark), Deliveries(spark, windows.hopping_counters_by_pane)
    for rows in ([("a", 1), ("a", 1.5), ("b", 3)], [("a", 20)], [("b", 41)], [("b", 90)]):
        plain.deliver(*rows)
        panes.deliver(*rows)
    assert plain.result() == panes.result()


def test_sessions_close_after_the_gap(spark):
    runs = Deliveries(spark, windows.session_counters)
    runs.deliver(("a", 1), ("a", 9), ("a", 18), ("b", 3))
    runs.deliver(("a", 40))
    runs.deliver(("a", 80))
    assert runs.result() == {("a", 1): 3, ("b", 3): 1, ("a", 40): 1}


def test_batch_sessions_agree_with_the_built_in_ones(spark, sf_dir):
    events = m.compressed_clock(spark, sf_dir)
    gap = 20_000
    own = windows.session_counters(events, gap_ms=gap).select(
        "rowkey", "agg_time", "session_end", "cnt_item_view"
    )
    session = F.session_window(F.timestamp_millis("_server_time"), f"{gap} milliseconds")
    built_in = events.groupBy("rowkey", session.alias("s")).agg(
        F.count_if(F.col("eid") == 301).alias("cnt_item_view")
    ).select(
        "rowkey", F.unix_millis("s.start").alias("agg_time"),
        F.unix_millis("s.end").alias("session_end"), "cnt_item_view",
    )
    assert own.count() > 50
    assert own.exceptAll(built_in).count() == 0 == built_in.exceptAll(own).count()


def test_update_equals_batch(spark, sf_dir):
    streamed = q.stream_update_upsert(spark, sf_dir)
    stored = q.cookies_hopping(spark, sf_dir).select(*streamed.columns)
    assert streamed.exceptAll(stored).count() == 0 == stored.exceptAll(streamed).count()


def test_features_do_not_change_when_windows_repeat(spark, sf_dir):
    rows = q.cookies_hopping_fast(spark, sf_dir)
    once, twice = cookie_features(rows), cookie_features(rows.unionByName(rows))
    assert once.exceptAll(twice).count() == 0 == twice.exceptAll(once).count()


def test_chain_in_several_deliveries(spark, sf_dir):
    """Three queries restarted after every delivery end up where one batch does."""
    stages = pipeline.Stages(fresh_folder(spark, "chain"))
    source = fresh_folder(spark, "source")
    everything = m.clickstream(spark, sf_dir)
    bounds = everything.agg(F.max("offset")).first()[0]
    for low, high in ((0, bounds // 3), (bounds // 3, 2 * bounds // 3), (2 * bounds // 3, bounds + 1)):
        write_replay(everything.where(F.col("offset").between(low, high - 1)), source)
        pipeline.start_documents(stream_replay(spark, source), stages).awaitTermination()
        pipeline.start_rejects(stream_replay(spark, source), stages).awaitTermination()
        pipeline.start_final_windows(
            pipeline.stream_documents(spark, stages), stages
        ).awaitTermination()
        pipeline.start_features(spark, stages).awaitTermination()
    own_time = F.unix_millis("timestamp")
    expected_windows = batch.cookie_windows(everything, own_time)
    newest = windows.cookie_events(batch.enriched_events(everything, own_time)).agg(
        F.max("_server_time")
    ).first()[0]
    closed = expected_windows.where(F.col("agg_time") + 600_000 <= newest - MINUTE)
    found = pipeline.read_final_windows(spark, stages).select(*closed.columns)
    assert found.exceptAll(closed).count() == 0 == closed.exceptAll(found).count()
    expected = cookie_features(closed)
    features = pipeline.read_features(spark, stages)
    assert features.exceptAll(expected).count() == 0 == expected.exceptAll(features).count()
    assert spark.read.schema("reason string").parquet(stages.rejects).count() == 0


def test_window_changes_read_back(spark, sf_dir):
    stages = pipeline.Stages(fresh_folder(spark, "changes"))
    documents = q.clickstream_stream(spark, sf_dir)
    pipeline.start_documents(documents, stages).awaitTermination()
    pipeline.start_window_changes(
        pipeline.stream_documents(spark, stages), stages
    ).awaitTermination()
    expected = batch.cookie_windows(m.clickstream(spark, sf_dir), F.unix_millis("timestamp"))
    found = pipeline.read_window_changes(spark, stages).select(*expected.columns)
    assert found.exceptAll(expected).count() == 0 == expected.exceptAll(found).count()


@pytest.mark.parametrize(
    "ddl, options",
    [
        ("uid INT", {}),
        ("uid INT", {"slices": 2}),
        ("uid INT, day STRING DEFAULT 'd'", {}),
        ("uid INT, day STRING DEFAULT 'd'", {"batch_column": "batch"}),
    ],
)
def test_table_append_over_restarts(spark, sf_dir, ddl, options):
    location = fresh_folder(spark, "appended")
    name = location.rsplit("/", 1)[1].replace("-", "_")
    parted = "batch_column" in options
    spark.sql(
        f"CREATE TABLE {name} ({ddl}{', batch BIGINT' if parted else ''}) USING parquet "
        f"{'PARTITIONED BY (batch)' if parted else ''} LOCATION '{location}'"
    )
    if not parted:
        spark.sql(f"INSERT INTO {name} (uid) VALUES (-1)")
    checkpoint = fresh_folder(spark, "checkpoint")
    for _ in range(2):
        rows = q.clickstream_stream(spark, sf_dir)
        start_table_append(rows, name, checkpoint, **options).awaitTermination()
    expected = m.events_table(spark, sf_dir).count()
    assert spark.table(name).where("uid >= 0").count() == expected
    assert spark.table(name).where("uid = -1").count() == (0 if parted else 1)
    if parted:
        # the same micro-batch once more, as after a crash before its commit
        rows = m.clickstream(spark, sf_dir)
        append_to_table(rows, name, replace=("batch", 0))
        assert spark.table(name).count() == expected
        assert {r["day"] for r in spark.table(name).select("day").distinct().collect()} == {"d"}


def endless(spark):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 50).load()
    return (
        rate.writeStream.format("noop")
        .option("checkpointLocation", fresh_folder(spark, "rate"))
        .start()
    )


def test_bounded_runs(spark, sf_dir):
    assert run_bounded(endless(spark), max_duration=1, idle_timeout=None) == "duration"
    assert run_bounded(endless(spark), max_duration=60, max_rows=1) == "limit"
    assert run_bounded(endless(spark), max_duration=60, keep_going=lambda: False) == "released"
    idle = (
        q.clickstream_stream(spark, sf_dir)
        .writeStream.format("noop")
        .option("checkpointLocation", fresh_folder(spark, "idle"))
        .start()
    )
    assert run_bounded(idle, max_duration=60, idle_timeout=3) == "idle"
    assert not idle.isActive


def test_a_finished_query_ends_the_run(spark, sf_dir):
    query = (
        q.clickstream_stream(spark, sf_dir)
        .writeStream.format("noop")
        .option("checkpointLocation", fresh_folder(spark, "finished"))
        .trigger(availableNow=True)
        .start()
    )
    observed = Observed()
    assert run_bounded(query, max_duration=60, observed=observed) == "finished"
    assert observed.rows == m.events_table(spark, sf_dir).count() and observed.complete


def test_split_reads_each_payload_once(spark, messages):
    """Documents and rejects of one query, with one pass over the text for the fields."""
    stages = pipeline.Stages(fresh_folder(spark, "split"))
    texts = ['{"uid":1,"dt":5}', "[1]", None, '{"uid":2}{"uid":3}', "{}", '{"a":tru}', '{"uid":4} \n']
    write_replay(messages(texts), f"{stages.root}/in")
    for value in (True, True):  # the second run finds nothing new
        pipeline.start_split(
            stream_replay(spark, f"{stages.root}/in"), stages, F.lit(9), include_value=value
        ).awaitTermination()
    documents = pipeline.read_split(spark, stages, "document").orderBy("offset").collect()
    assert [r["offset"] for r in documents] == [0, 4, 6]
    assert documents[0]["value"].startswith('{"uid":1,"dt":5,"_server_time":5000,')
    assert documents[1]["value"].startswith('{"_server_time":9,')
    rejected = pipeline.read_split(spark, stages, "reject").orderBy("offset").collect()
    assert [(r["offset"], r["reason"]) for r in rejected] == [
        (1, "not_object"), (2, "missing"), (3, "trailing_text"), (5, "malformed")
    ]
    assert [r["value"] for r in rejected] == [texts[i] for i in (1, 2, 3, 5)]
    plan = enrich.split_documents(messages(texts), F.lit(9))._jdf.queryExecution().toString()
    executed = plan[plan.index("Physical Plan") :]
    assert executed.count("json_tuple") == 1
    seen = pipeline.stream_split(spark, stages)
    assert seen.isStreaming and seen.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    with pytest.raises(ValueError, match="unknown kind"):
        pipeline.read_split(spark, stages, "other")


def test_windows_expire_in_the_chain(spark, sf_dir):
    stages = pipeline.Stages(fresh_folder(spark, "expiring"))
    documents = q.clickstream_stream(spark, sf_dir)
    pipeline.start_documents(documents, stages).awaitTermination()
    pipeline.start_window_changes(
        pipeline.stream_documents(spark, stages), stages, slice_ms=3_600_000, final=True
    ).awaitTermination()
    everything = pipeline.read_window_changes(spark, stages)
    whole = everything.count()
    floor = pipeline.expire_windows(spark, stages, 24 * 3_600_000)
    kept = pipeline.read_window_changes(spark, stages)
    assert 0 < kept.count() < whole and everything.count() == whole
    assert kept.where(F.col("agg_time") < floor * 3_600_000).count() == 0
    assert everything.where(F.col("agg_time") >= floor * 3_600_000).count() == kept.count()
    assert pipeline.compact_windows(spark, stages) == 0


def test_a_wrong_clock_closes_no_windows(spark):
    """One event far ahead of its message: the others' windows stay open."""
    later = 1_000 * 24 * 60 * MINUTE

    def bounded(stream):
        own = stream.withColumn("timestamp", F.timestamp_millis(F.col("_server_time") % later))
        return windows.hopping_counters(own, latest_ms=windows.by_message_time(5_000))

    runs, plain = Deliveries(spark, bounded), Deliveries(spark)
    for one in (runs, plain):
        one.deliver(("a", 1), ("bad", 1 + later / MINUTE), ("a", 20))
        one.deliver(("a", 19.5), ("c", 60))
    assert runs.late == 0 and plain.late == 10
    assert ("bad", 0) not in runs.result() and runs.result()[("a", 12)] == 2


def test_listener_counts_what_reports_say(spark):
    sums = ProgressSums()
    spark.streams.addListener(sums)
    try:
        folder = fresh_folder(spark, "listener")
        for rows in ([("a", 1), ("a", 20)], [("a", 12), ("b", 21)]):
            events = [(key, 301, 1, minute * MINUTE, 0) for key, minute in rows]
            spark.createDataFrame(events, EVENT).coalesce(1).write.mode("append").parquet(f"{folder}/in")
            stream = spark.readStream.schema(EVENT).parquet(f"{folder}/in")
            query = keyed.start_keyed(
                windows.hopping_counters(stream), f"{folder}/out", f"{folder}/checkpoint"
            )
            query.awaitTermination()
            assert sums.wait(query)
            assert sums.rows(query) == 2
        assert sums.late(query) == 3
    finally:
        spark.streams.removeListener(sums)


class Stamped:
    """Events of several deliveries, stamped, and the same through the built-in operator."""

    def __init__(self, spark):
        self.spark, self.folder = spark, fresh_folder(spark, "stamped")

    def deliver(self, *rows):
        events = [(key, 301, 1, None if t is None else int(t * MINUTE), 0) for key, t in rows]
        self.spark.createDataFrame(events, EVENT).coalesce(1).write.mode("append").parquet(
            f"{self.folder}/in"
        )
        self.start().awaitTermination()
        stream = self.spark.readStream.schema(EVENT).parquet(f"{self.folder}/in")
        counted = windows.hopping_counters(stream)
        keyed.start_keyed(counted, f"{self.folder}/out", f"{self.folder}/c2").awaitTermination()

    def start(self):
        stream = self.spark.readStream.schema(EVENT).parquet(f"{self.folder}/in")
        return late.start_stamped(stream, f"{self.folder}/stamped", f"{self.folder}/c1")

    def rows(self, version=None):
        return late.read_stamped(self.spark, f"{self.folder}/stamped", EVENT, version)


def test_late_rows_are_kept_and_leave_what_was_counted(spark):
    runs = Stamped(spark)
    runs.deliver(("a", 1), ("a", 20), ("a", None))
    runs.deliver(("a", 12), ("b", 21))
    runs.deliver(("a", 9.5), ("c", 60), ("d", 1))
    listed = {
        (r["rowkey"], r["_server_time"] / MINUTE, r["agg_time"] // MINUTE, r[late.CUT] // MINUTE)
        for r in late.late_windows(runs.rows()).collect()
    }
    assert listed == {
        *[("a", 12.0, w, 19) for w in (4, 6, 8)],
        *[("a", 9.5, w, 20) for w in (0, 2, 4, 6, 8)],
        *[("d", 1.0, w, 20) for w in (-8, -6, -4, -2, 0)],
    }
    ours = late.timely_counters(runs.rows())
    counted = keyed.read_keyed(spark, f"{runs.folder}/out", ours.schema, pipeline.WINDOW_KEYS)
    assert ours.count() > 10
    assert ours.exceptAll(counted).count() == 0 == counted.exceptAll(ours).count()


def test_stamped_batches_repeat_nothing_and_are_read_whole(spark):
    runs = Stamped(spark)
    assert runs.rows().count() == 0
    runs.deliver(("a", 1))
    runs.deliver(("a", 2), ("b", 3))
    assert runs.rows().count() == 3 and runs.rows(version=0).count() == 1
    # published, but the stream does not know: the batch is run again and changes nothing
    log = keyed.manifests(spark, runs.folder + "/stamped")
    for name in log.children(f"{runs.folder}/c1/commits"):
        if not name.startswith(".") and name == "1":
            log.remove(f"{runs.folder}/c1/commits/{name}")
            log.remove(f"{runs.folder}/c1/commits/.{name}.crc")
    runs.start().awaitTermination()
    assert runs.rows().count() == 3
    stream = spark.readStream.schema(EVENT).parquet(f"{runs.folder}/in")
    other = late.start_stamped(stream, f"{runs.folder}/stamped", f"{runs.folder}/c3")
    with pytest.raises(Exception, match="another stream"):
        other.awaitTermination()
    with pytest.raises(ValueError, match="watermark_ms"):
        late.start_stamped(runs.rows(), "x", "y")


def test_late_windows_of_the_chain(spark, sf_dir):
    """Stage 2 with late rows kept: both parts together are all events in all windows."""
    stages = pipeline.Stages(fresh_folder(spark, "chain-late"))
    messages = m.clickstream(spark, sf_dir)
    documents = pipeline.document_envelope(enrich.extended_documents(messages, F.lit(0)))
    first = F.col("offset") % 3 == 0
    for delivery in (~first, first):
        documents.where(delivery).write.mode("append").parquet(stages.documents)
        pipeline.start_counted(pipeline.stream_documents(spark, stages), stages).awaitTermination()
    everything = pipeline.windows_of(documents)
    timely = pipeline.read_timely_windows(spark, stages)
    lost = pipeline.read_late_windows(spark, stages)
    total = F.sum(sum(F.col(name) for name in windows.COUNTERS))
    assert 0 < lost.count()
    assert everything.agg(total).first()[0] == timely.agg(total).first()[0] + lost.count()


def test_sessions_from_panes_agree_with_batch(spark):
    """Pauses of just the gap, one key with most rows, panes that touch, deliveries in order."""
    stages = pipeline.Stages(fresh_folder(spark, "pane-sessions"))
    gap = 600_000
    minutes = [("hot", t / 10) for t in range(400)]
    minutes += [("a", t) for t in (1, 11, 21, 31.5, 31.6, 55, 70, 200)]
    minutes += [("b", t) for t in (0, 9.99, 10, 20, 30.001, 100, 110, 120.001)]
    events = [(key, 301, 1, int(round(t * MINUTE)), 0) for key, t in minutes] + [
        ("end", 301, 1, 1000 * MINUTE, 0), ("end", 301, 1, 1011 * MINUTE, 0), ("none", 301, 1, None, 0)
    ]
    frame = spark.createDataFrame(events, EVENT)
    parts = [
        "_server_time < 1500000 or _server_time is null",
        "_server_time between 1500000 and 4000000",
        "_server_time > 4000000",
    ]
    for part in parts:
        frame.where(part).coalesce(1).write.mode("append").parquet(f"{stages.root}/in")
        stream = spark.readStream.schema(EVENT).parquet(f"{stages.root}/in")
        pipeline.start_session_panes(stream, stages, gap).awaitTermination()
        pipeline.start_sessions(spark, stages, gap).awaitTermination()
    found = pipeline.read_sessions(spark, stages)
    batch_rows = windows.session_counters(frame, gap_ms=gap)
    expected = batch_rows.where("rowkey <> 'end'")
    assert expected.count() == 10
    assert found.exceptAll(expected).count() == 0 == expected.exceptAll(found).count()
    # and the same panes without a stream
    again = windows.pane_sessions(windows.session_panes(frame, gap_ms=gap), gap_ms=gap)
    assert again.exceptAll(batch_rows).count() == 0 == batch_rows.exceptAll(again).count()
    # the hot key's 400 events are one row for each pane
    assert spark.read.parquet(stages.panes).where("rowkey = 'hot'").count() == 4
