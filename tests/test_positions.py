"""Runs that continue where the last one stopped."""

import pytest
from pyspark.sql import functions as F

from clickweir.operators.limits import OffsetRange, select_ranges, take_ranges
from clickweir.plans import positions as p
from clickweir.session import fresh_folder
from clickweir.sinks.manifests import WHOLE, ManifestLog
from clickweir.sources.envelope import ENVELOPE, stream_replay
from clickweir.sources.task_spec import TaskSpec


def envelope(spark, rows):
    """Rows (partition, offset)."""
    frame = spark.createDataFrame(rows, "partition int, offset long")
    return frame.select(
        F.lit("k").alias("key"), F.concat_ws(":", "partition", "offset").alias("value"),
        F.lit("t").alias("topic"), "partition", "offset", F.current_timestamp().alias("timestamp"),
    )


@pytest.fixture
def group(spark):
    return Group(spark)


class Group:
    def __init__(self, spark):
        self.spark = spark
        self.root = fresh_folder(spark, "group")
        self.log = ManifestLog(spark, f"{self.root}/log")

    def write(self, rows, folder):
        rows.write.parquet(f"{self.root}/out/{folder}")

    def run(self, messages, task, **options):
        return p.run_from_positions(messages, TaskSpec.parse(task), self.log, self.write, **options)

    def rows(self):
        found = p.read_published(self.spark, self.log, f"{self.root}/out", ENVELOPE)
        return sorted((r["partition"], r["offset"]) for r in found.collect())


ALL = [(p_, o) for p_ in range(3) for o in range(p_, 40, p_ + 1)]


def test_runs_continue_without_gap_or_repeat(spark, group):
    messages = envelope(spark, ALL)
    with pytest.raises(ValueError, match="no stored offsets"):
        group.run(messages, "%:-1000:10")
    taken = 0
    while taken < len(ALL):
        run = group.run(messages, "%:-1000:17", start_earliest=True)
        assert run.rows == min(17, len(ALL) - taken)
        taken += run.rows
        assert group.rows() == ALL[:taken]
    assert group.run(messages, "%:-1000:17", start_earliest=True).rows == 0
    assert p.positions(group.log.latest()) == {0: 40, 1: 40, 2: 39}


def test_a_crash_before_publishing_is_done_over(spark, group):
    messages = envelope(spark, ALL)
    group.run(messages, "%:-1000:5", start_earliest=True)

    def dies(rows, folder):
        group.write(rows, folder)
        raise OSError("lost")

    with pytest.raises(OSError):
        p.run_from_positions(
            messages, TaskSpec.parse("%:-1000:9"), group.log, dies, start_earliest=True
        )
    assert group.rows() == ALL[:5]
    group.run(messages, "%:-1000:9", start_earliest=True)
    assert group.rows() == ALL[:14]
    assert len(group.log.children(f"{group.root}/out")) == 3  # one of them an orphan


def test_of_two_runs_at_once_one_counts(spark, group):
    messages = envelope(spark, ALL)

    def overtaken(rows, folder):
        group.write(rows, folder)
        group.run(messages, "%:-1000:4", start_earliest=True)

    with pytest.raises(p.ConcurrentRun):
        p.run_from_positions(
            messages, TaskSpec.parse("%:-1000:9"), group.log, overtaken, start_earliest=True
        )
    assert group.rows() == ALL[:4]


def test_explicit_offsets_do_not_move_the_group(spark, group):
    messages = envelope(spark, ALL)
    group.run(messages, "%:-1000:5", start_earliest=True)
    group.run(messages, "0:2:2,2:0:1")
    assert p.positions(group.log.latest()) == {0: 5}
    assert group.rows() == sorted([*ALL[:5], (0, 2), (0, 3), (2, 2)])
    group.run(messages, "0-2:-2:3")  # earliest is symbolic: the group follows, never back
    assert p.positions(group.log.latest()) == {0: 5}


def test_topics_have_their_own_positions(spark, group):
    messages = envelope(spark, ALL)
    group.run(messages, "*:-2:5", topic="a")
    group.run(messages, "*:-2:7", topic="b")
    latest = group.log.latest()
    assert p.positions(latest, "a") == {0: 5} and p.positions(latest, "b") == {0: 7}


def test_taken_ranges_equal_selected_ones(spark):
    rows = [(p_, o * (p_ + 1)) for p_ in range(4) for o in range(50)]
    messages = envelope(spark, rows)
    for limits in [(0, None, 7), (3, 60, None), (1000, 1, 49), (50, 51, 50)]:
        ranges = [
            OffsetRange(0, 0, 5, limits[0]), OffsetRange(1, 2, 0, limits[1]),
            OffsetRange(3, 3, 8, limits[2]),
        ]
        for bits in (2, 4, 20):
            found, taken = take_ranges(messages, ranges, bucket_bits=bits)
            key = lambda frame: sorted((r["partition"], r["offset"]) for r in frame.collect())
            assert key(found) == key(select_ranges(messages, ranges, bits))
            assert sum(part.rows for part in taken) == found.count()
    _, taken = take_ranges(messages, [OffsetRange(1, 2, 0, 60)], {0: 55})
    assert [(t.partition, t.rows) for t in taken] == [(1, 5)]


def test_many_partitions_are_a_small_join(spark):
    messages = envelope(spark, [(p_, o) for p_ in range(100) for o in range(3)])
    found, taken = take_ranges(messages, [OffsetRange(None, None, 1, None)])
    assert len(taken) == 100 and found.count() == 200


class Streamed:
    def __init__(self, group, task, checkpoint="one"):
        self.group, self.task = group, TaskSpec.parse(task)
        self.checkpoint = f"{group.root}/{checkpoint}"
        self.inbox = f"{group.root}/in"

    def put(self, rows):
        envelope(self.group.spark, rows).coalesce(1).write.mode("append").parquet(self.inbox)

    def start(self, write=None):
        stream = stream_replay(self.group.spark, self.inbox, max_files_per_trigger=1)
        return p.start_from_positions(
            stream, self.task, self.group.log, self.checkpoint, write or self.group.write,
            start_earliest=True,
        )

    def run(self, write=None):
        return p.run_stream_from_positions(self.start(write), self.group.log, self.checkpoint)


def test_limits_of_several_clauses_cut_inside_a_batch(spark, group):
    stream = Streamed(group, "0:2:6,1-2:-2:9")
    stream.put([(q, o) for q in range(3) for o in range(0, 5)])
    stream.put([(q, o) for q in range(3) for o in range(5, 10)])
    stream.put([(q, o) for q in range(3) for o in range(10, 15)])
    assert stream.run() == "limit"
    first = [(0, o) for o in range(2, 8)]
    # nine rows of two partitions: the first batch has ten of them
    assert group.rows() == sorted(first + [(1, o) for o in range(5)] + [(2, o) for o in range(4)])
    assert p.positions(group.log.latest()) == {}  # clause 0 names an offset
    assert stream.run() == "limit" and len(group.rows()) == 15


def test_a_new_run_goes_on_at_the_positions(spark, group):
    stream = Streamed(group, "%:-1000:7")
    stream.put([(q, o) for q in range(2) for o in range(5)])
    assert stream.run() == "limit"
    assert group.rows() == [(0, o) for o in range(5)] + [(1, 0), (1, 1)]
    again = Streamed(group, "%:-1000:7", "two")
    assert again.run() == "finished"
    assert group.rows() == [(q, o) for q in range(2) for o in range(5)]
    assert p.positions(group.log.latest()) == {0: 5, 1: 5}


def test_a_batch_that_died_is_taken_once(spark, group):
    stream = Streamed(group, "%:-1000:100")
    stream.put([(0, o) for o in range(5)])
    assert stream.run() == "finished"
    stream.put([(0, o) for o in range(5, 9)])

    def dies(rows, folder):
        group.write(rows, folder)
        raise OSError("lost")

    with pytest.raises(Exception, match="lost"):
        stream.start(dies).awaitTermination()
    assert len(group.rows()) == 5
    stream.run()
    assert group.rows() == [(0, o) for o in range(9)]


def test_manifests(spark):
    log = ManifestLog(spark, fresh_folder(spark, "manifests"))
    assert log.versions() == [] and log.latest().version == -1 and log.parts() == []
    for version in range(WHOLE + 3):
        assert log.publish(version, {"n": version}, [f"p{version}"] * (version % 2))
    assert not log.publish(WHOLE, {"n": -1}, ["x"])
    assert log.latest().state == {"n": WHOLE + 2}
    assert log.parts() == [f"p{v}" for v in range(WHOLE + 3) if v % 2]
    assert log.parts(5) == ["p1", "p3", "p5"]
    assert log.read(WHOLE).whole == tuple(f"p{v}" for v in range(WHOLE) if v % 2)
    assert log.publish(WHOLE + 3, {}, [], whole=["only"]) and log.parts() == ["only"]
    assert all(name.endswith(".json") for name in log.children(log.path) if not name.startswith("."))
