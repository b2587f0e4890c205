import json

import pytest
from pyspark.sql import functions as F

from clickweir.operators.limits import OffsetRange, select_ranges
from clickweir.session import fresh_folder, shared_folder
from clickweir.sources.envelope import (
    ENVELOPE,
    as_envelope,
    read_replay,
    stream_replay,
    write_replay,
)
from clickweir.sources.kafka import Connection, from_environment
from clickweir.sources.stream_spec import StreamSpec
from clickweir.sources.task_spec import TaskSpec


@pytest.fixture(scope="module")
def topic(spark):
    """Three partitions with gaps in their offsets, the first far larger."""
    sizes = spark.createDataFrame([(0, 900), (1, 90), (2, 9)], "partition int, size int")
    rows = sizes.select(
        "partition", F.explode(F.sequence(F.lit(1), "size")).alias("n")
    )
    full = rows.select(
        F.lit("k").alias("key"),
        F.lit("{}").alias("value"),
        F.lit("t").alias("topic"),
        "partition",
        (F.col("n") * 3 + F.col("n") % 3).cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
    return full.select(*ENVELOPE.fieldNames()).cache()


def expected(topic, ranges):
    """Brute force on the driver: sort, then count."""
    rows = sorted((r["partition"], r["offset"]) for r in topic.collect())
    kept = []
    for part in ranges:
        own = dict(part.starts)
        mine = [
            (p, o)
            for p, o in rows
            if (part.first is None or part.first <= p <= part.last)
            and o >= own.get(p, part.start)
        ]
        kept += mine if part.limit is None else mine[: part.limit]
    return sorted(kept)


CASES = [
    [OffsetRange(None, None, 0, 1)],
    [OffsetRange(None, None, 0, 950)],
    [OffsetRange(None, None, 100, 10_000)],
    [OffsetRange(None, None, 0, 0)],
    [OffsetRange(None, None, 0, None)],
    [OffsetRange(0, 0, 50, 333), OffsetRange(1, 1, 0, 90), OffsetRange(2, 2, 0, 4)],
    [OffsetRange(1, 2, 5, 92), OffsetRange(0, 0, 2000, None)],
    [OffsetRange(0, 1, 0, 905, ((0, 2600),))],
    [OffsetRange(7, 9, 0, 5)],
]


@pytest.mark.parametrize("ranges", CASES)
@pytest.mark.parametrize("bucket", [0, 6, 20])
def test_limits_match_brute_force(topic, ranges, bucket):
    found = select_ranges(topic, ranges, bucket)
    assert found.columns == topic.columns
    assert sorted((r["partition"], r["offset"]) for r in found.collect()) == expected(
        topic, ranges
    )


def test_task_grammar():
    spec = TaskSpec.parse("0:5:10,2-4:-2:7")
    assert [(c.first, c.last, c.offset, c.limit, c.own_limit) for c in spec.clauses] == [
        (0, 0, 5, 10, True), (2, 4, -2, 7, False),
    ]
    assert spec.total_limit == 17 and not spec.commits
    assert TaskSpec.parse("%:-1000:1000000").commits
    assert TaskSpec.parse("*:-1:0").clauses[0].first is None


@pytest.mark.parametrize(
    "text",
    ["", "0:1", "0:1:2:3", "x:0:1", "-1:0:1", "1-:0:1", "3-1:0:1", "0:-5:1", "0:x:1",
     "0:0:-1", "0:0:x", "%:0:10", "*:0:1,0:0:1", "0:0:1,0-2:0:1"],
)
def test_task_errors(text):
    with pytest.raises(ValueError):
        TaskSpec.parse(text)


def test_task_select(topic):
    def taken(text, **options):
        rows = TaskSpec.parse(text).select(topic, **options).collect()
        return sorted((r["partition"], r["offset"]) for r in rows)

    every = expected(topic, [OffsetRange(None, None)])
    with pytest.raises(ValueError):
        taken("*:-1:100")
    with pytest.raises(Exception, match="no stored offset for partition 2"):
        taken("*:-1000:5000", stored={0: 10, 1: 0})
    assert taken("*:-2:999") == every
    assert taken("1:-2:2") == [p for p in every if p[0] == 1][:2]
    stored = {0: 10_000, 1: 100, 2: 0}
    assert taken("%:-1000:5", stored=stored) == [p for p in every if p[0] == 1 and p[1] >= 100][:5]
    assert len(taken("0-2:-1000:9999", stored={1: 100}, start_earliest=True)) == 999 - len(
        [p for p in every if p[0] == 1 and p[1] < 100]
    )
    with pytest.raises(ValueError):
        taken("0-2:-1000:5", stored={1: 100})
    with pytest.raises(ValueError):
        taken("*:-1000:5")


def test_task_options():
    options = TaskSpec.parse("0:5:10,2:7:1").options("t")
    assert json.loads(options["assign"]) == {"t": [0, 2]}
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 5, "2": 7}}
    assert json.loads(options["endingOffsets"]) == {"t": {"0": 15, "2": 8}}
    assert options["failOnDataLoss"] == "true"
    assert TaskSpec.parse("*:-1:5").options("t")["startingOffsets"] == "latest"
    assert TaskSpec.parse("*:-2:5").options("t")["subscribe"] == "t"
    explicit = TaskSpec.parse("*:9:5").options("t", partition_count=2, streaming=True)
    assert json.loads(explicit["startingOffsets"]) == {"t": {"0": 9, "1": 9}}
    assert explicit["maxOffsetsPerTrigger"] == "5"
    mixed = TaskSpec.parse("0-1:-1000:5").options("t", stored={0: 3}, start_earliest=True)
    assert json.loads(mixed["startingOffsets"]) == {"t": {"0": 3, "1": -2}}
    for text in ("0:0:5,1:0:5", "*:-2:0"):
        with pytest.raises(ValueError):
            TaskSpec.parse(text).options("t", streaming=True)
    for text in ("%:-1000:5", "0:-1000:5"):
        with pytest.raises(ValueError):
            TaskSpec.parse(text).options("t")
    with pytest.raises(ValueError):
        TaskSpec.parse("*:9:5").options("t")


def test_environment_settings():
    assert from_environment("$A", {"A": "x"}) == "x"
    assert from_environment("$", {}) == "$"
    assert from_environment("plain", {}) == "plain"
    with pytest.raises(KeyError):
        from_environment("$MISSING", {})
    options = Connection("b", user="$U", password="$P", sasl_mechanism="SCRAM-SHA-512").options(
        {"U": "me", "P": "secret"}
    )
    assert options["kafka.sasl.jaas.config"].startswith(
        "org.apache.kafka.common.security.scram.ScramLoginModule required"
    )
    with pytest.raises(ValueError):
        Connection("b", user="u", sasl_mechanism="GSSAPI").options({})


def test_replay_round_trip(spark, topic):
    folder = fresh_folder(spark, "replay")
    write_replay(topic, folder)
    back = read_replay(spark, folder)
    assert sorted(back.columns) == sorted(ENVELOPE.fieldNames())
    assert back.exceptAll(topic.select(*back.columns)).count() == 0
    assert back.count() == 999
    plan = back.where("partition = 1 and offset > 5")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(partition" in plan
    assert "GreaterThan(offset,5)" in plan
    assert stream_replay(spark, folder, max_files_per_trigger=1).isStreaming


def test_connector_rows_become_envelopes(spark):
    raw = spark.sql(
        "SELECT CAST('k' AS BINARY) key, CAST('{}' AS BINARY) value, 't' topic, 0 partition, "
        "1L offset, TIMESTAMP '2024-01-01 00:00:00' timestamp, 0 timestampType"
    )
    assert as_envelope(raw).schema.simpleString() == ENVELOPE.simpleString()
    assert as_envelope(raw).first()["key"] == "k"


def test_declared_stream(spark, messages):
    spec = StreamSpec("clicks", "t", "eid int, st bigint", document="$", time_column="st")
    rows = spec.register(messages(['{"EID":1,"st":1500}', "{bad", '{"eid":"x"}']))
    assert [tuple(r) for r in spark.sql(
        "SELECT rowkey, eid, unix_millis(event_time), `$` FROM clicks ORDER BY offset"
    ).collect()] == [
        ("u1", 1, 1500, '{"EID":1,"st":1500}'), ("u1", None, None, '{"eid":"x"}'),
    ]
    assert not rows.isStreaming
    assert spec.open(messages(["{}"], topic="other")).count() == 0


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")
