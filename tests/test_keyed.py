"""The keyed table: snapshots, replay, compaction beside the stream, retention."""

import threading

import pytest
from pyspark.sql import functions as F

from clickweir.operators import windows
from clickweir.session import fresh_folder
from clickweir.streaming import keyed

SCHEMA = "k string, n bigint"
MINUTE = 60_000


class Counts:
    """How often keys were delivered, as a table of changes."""

    def __init__(self, spark):
        self.spark = spark
        self.folder = fresh_folder(spark, "keyed")
        self.path = f"{self.folder}/out"
        self.log = keyed.manifests(spark, self.path)

    def start(self, checkpoint="checkpoint"):
        counts = self.spark.readStream.schema("k string").parquet(f"{self.folder}/in")
        return keyed.start_keyed(
            counts.groupBy("k").agg(F.count("*").alias("n")), self.path,
            f"{self.folder}/{checkpoint}",
        )

    def deliver(self, keys):
        frame = self.spark.createDataFrame([(k,) for k in keys], "k string")
        frame.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        self.start().awaitTermination()

    def table(self, version=None):
        rows = keyed.read_keyed(self.spark, self.path, SCHEMA, ["k"], version).collect()
        return {r["k"]: r["n"] for r in rows}

    def segments(self):
        return [(part["level"], part[keyed.SEGMENT]) for part in self.log.parts()]


@pytest.fixture
def counts(spark):
    return Counts(spark)


def test_latest_row_of_every_key_and_older_versions(counts):
    counts.deliver("ab")
    counts.deliver("ac")
    assert counts.table() == {"a": 2, "b": 1, "c": 1}
    assert counts.table(0) == {"a": 1, "b": 1}
    assert keyed.read_keyed(counts.spark, counts.folder + "/none", SCHEMA, ["k"]).count() == 0


def test_a_replayed_batch_is_published_once(counts):
    counts.deliver("ab")
    log = counts.log
    # the manifest is there, the stream's own commit is lost: the batch runs again
    log.remove(f"{counts.folder}/checkpoint/commits/0")
    log.remove(f"{counts.folder}/checkpoint/commits/.0.crc")
    before = log.versions()
    counts.start().awaitTermination()
    assert log.versions() == before and counts.table() == {"a": 1, "b": 1}


def test_readers_see_no_half_written_batch(counts, monkeypatch):
    counts.deliver("ab")
    seen = []
    write = keyed._write_segment

    def reading(rows, path, segment, slices):
        seen.append(counts.table())
        write(rows, path, segment, slices)
        seen.append(counts.table())  # written, not yet published

    monkeypatch.setattr(keyed, "_write_segment", reading)
    counts.deliver("bbc")
    assert seen == [{"a": 1, "b": 1}] * 2
    assert counts.table() == {"a": 1, "b": 3, "c": 1}


def test_a_reader_keeps_its_version_while_segments_are_merged(counts):
    for keys in ("ab", "bc", "cd"):
        counts.deliver(keys)
    frame = keyed.read_keyed(counts.spark, counts.path, SCHEMA, ["k"])
    before = {r["k"]: r["n"] for r in frame.collect()}
    assert keyed.compact_keyed(counts.spark, counts.path, SCHEMA, ["k"], fanout=3) == 3
    counts.deliver("de")
    assert {r["k"]: r["n"] for r in frame.collect()} == before == {"a": 1, "b": 2, "c": 2, "d": 1}
    assert counts.table() == {"a": 1, "b": 2, "c": 2, "d": 2, "e": 1}
    assert [level for level, _ in counts.segments()] == [1, 0]


def test_levels(counts):
    for number in range(6):
        counts.deliver("ab"[: 1 + number % 2])
        while keyed.compact_keyed(counts.spark, counts.path, SCHEMA, ["k"], fanout=2):
            pass
    assert counts.table() == {"a": 6, "b": 3}
    levels = [level for level, _ in counts.segments()]
    assert sorted(levels) == [1, 2] and keyed.compact_keyed(counts.spark, counts.path, SCHEMA, ["k"], 2) == 0


def test_compaction_beside_the_stream(counts, monkeypatch):
    """A batch is published between the reading and the publishing of a compaction."""
    counts.deliver("ab")
    counts.deliver("bc")
    write = keyed._write_segment

    def slow(rows, path, segment, slices):
        write(rows, path, segment, slices)
        monkeypatch.setattr(keyed, "_write_segment", write)
        counts.deliver("cd")

    monkeypatch.setattr(keyed, "_write_segment", slow)
    assert keyed.compact_keyed(counts.spark, counts.path, SCHEMA, ["k"], fanout=2) == 2
    assert counts.table() == {"a": 1, "b": 2, "c": 2, "d": 1}
    assert [level for level, _ in counts.segments()] == [1, 0]


def test_two_compactions_at_once(counts, monkeypatch):
    counts.deliver("ab")
    counts.deliver("bc")
    write, found = keyed._write_segment, []

    def overtaken(rows, path, segment, slices):
        write(rows, path, segment, slices)
        monkeypatch.setattr(keyed, "_write_segment", write)
        found.append(keyed.compact_keyed(counts.spark, counts.path, SCHEMA, ["k"], fanout=2))

    monkeypatch.setattr(keyed, "_write_segment", overtaken)
    assert keyed.compact_keyed(counts.spark, counts.path, SCHEMA, ["k"], fanout=2) == 0
    assert found == [2] and counts.table() == {"a": 1, "b": 2, "c": 1}


def test_a_second_stream_is_refused(counts, monkeypatch):
    counts.deliver("ab")
    write = keyed._write_segment

    def meanwhile(rows, path, segment, slices):
        write(rows, path, segment, slices)
        monkeypatch.setattr(keyed, "_write_segment", write)
        thread = threading.Thread(target=lambda: counts.start("other").awaitTermination())
        thread.start()
        thread.join()

    monkeypatch.setattr(keyed, "_write_segment", meanwhile)
    with pytest.raises(Exception, match="another stream"):
        counts.deliver("c")


def test_vacuum_keeps_what_recent_versions_show(counts):
    for keys in ("a", "b", "c"):
        counts.deliver(keys)
    keyed.compact_keyed(counts.spark, counts.path, SCHEMA, ["k"], fanout=3)
    assert keyed.vacuum_keyed(counts.spark, counts.path) == 0
    assert counts.table(2) == {"a": 1, "b": 1, "c": 1}
    counts.deliver("d")
    assert keyed.vacuum_keyed(counts.spark, counts.path, versions=1) == 3
    assert counts.table() == {"a": 1, "b": 1, "c": 1, "d": 1}


EVENT = "rowkey string, eid int, uid int, _server_time bigint, _ua_is_test bigint"


class Windows:
    def __init__(self, spark):
        self.spark, self.folder = spark, fresh_folder(spark, "slices")

    def deliver(self, *rows):
        events = [(key, 301, 1, int(minute * MINUTE), 0) for key, minute in rows]
        frame = self.spark.createDataFrame(events, EVENT).coalesce(1)
        frame.write.mode("append").parquet(f"{self.folder}/in")
        stream = self.spark.readStream.schema(EVENT).parquet(f"{self.folder}/in")
        self.rows = windows.tumbling_counters(stream)
        keyed.start_keyed(
            self.rows, f"{self.folder}/out", f"{self.folder}/checkpoint", output_mode="append",
            slices=("agg_time", 20 * MINUTE),
        ).awaitTermination()

    def expire(self, minutes):
        return keyed.expire_keyed(self.spark, f"{self.folder}/out", minutes * MINUTE)

    def result(self):
        found = keyed.read_keyed(self.spark, f"{self.folder}/out", self.rows.schema, ["rowkey", "u", "agg_time"])
        return sorted((r["agg_time"] // MINUTE, r["cnt_item_view"]) for r in found.collect())


def test_slices_expire_by_the_streams_watermark(spark):
    table = Windows(spark)
    table.deliver(("a", 1), ("a", 12), ("a", 25), ("a", 61))  # the watermark is at minute 60
    assert table.result() == [(0, 1), (10, 1), (20, 1)]
    assert table.expire(40) == 1  # slice 0 ended 40 minutes before
    assert table.result() == [(20, 1)]
    # timely though late: its window is open, so its slice is not one that has expired
    table.deliver(("a", 60.5), ("a", 100))
    assert table.result() == [(20, 1), (60, 2)]
    assert table.expire(40) == 2 and table.expire(90) == 2  # the floor never sinks
    assert table.result() == [(60, 2)]
    path = f"{table.folder}/out"
    assert keyed.vacuum_keyed(spark, path, versions=1) > 0
    assert table.result() == [(60, 2)]
    assert keyed.expire_keyed(spark, f"{table.folder}/nothing", 5) is None
