"""Runs that continue where the last one stopped, bounded or continuous, exactly once.

A group has a log of manifests. Each run, or each micro-batch of a continuous one, decides
which offsets of which partitions it takes, writes those rows into a folder of its own, and
then publishes one manifest that names the folder and holds the next positions. A run that
dies before that leaves a folder that no reader is told of, and is done over.

    log = ManifestLog(spark, "s3://.../groups/nightly")
    run_from_positions(messages, TaskSpec.parse("%:-1000:1000000"), log, write)

Only tasks with symbolic offsets move the positions; one with an explicit offset is a
re-read and leaves them where they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickweir.operators.limits import take_ranges
from clickweir.sinks.manifests import Manifest, ManifestLog
from clickweir.sources.task_spec import TaskSpec
from clickweir.streaming.run import MAX_DURATION, POLL_TIMEOUT, run_bounded

Write = Callable[[DataFrame, str], None]


class ConcurrentRun(RuntimeError):
    """Another run of the group published first; nothing of this one counts."""


@dataclass(frozen=True)
class Run:
    """One published step: its version, rows taken, and the folder they are in."""

    version: int
    rows: int
    folder: str
    exhausted: bool


def positions(manifest: Manifest, topic: str = "") -> dict[int, int]:
    """Next offset of every partition of a topic that has been read."""
    return {int(k): v for k, v in manifest.state.get("positions", {}).get(topic, {}).items()}


def run_from_positions(
    messages: DataFrame,
    task: TaskSpec,
    log: ManifestLog,
    write: Write,
    topic: str = "",
    start_earliest: bool = False,
) -> Run:
    """Take the task's rows from where the group stopped, write and publish them.

    ``write(rows, folder)`` stores the rows under that name, which no other attempt uses.
    ``messages`` hold one topic; ``topic`` names it in the log. A partition without a
    position is an error unless ``start_earliest``.
    """
    before = log.latest()
    selected, ranges = task.ranged(messages, positions(before, topic), start_earliest)
    return _step(selected, task, ranges, {}, before, log, write, topic)


def _step(messages, task, ranges, used, before, log, write, topic, run=None, own_state=None) -> Run:
    rows, taken = take_ranges(messages, ranges, used)
    folder = f"run-{before.version + 1:012d}-{uuid.uuid4().hex[:12]}"
    if taken:
        write(rows, folder)
    own = positions(before, topic)
    if task.commits:
        for part in taken:
            own[part.partition] = max(part.last + 1, own.get(part.partition, 0))
    for part in taken:
        used[part.range] = used.get(part.range, 0) + part.rows
    exhausted = all(
        part.limit is not None and used.get(number, 0) >= part.limit
        for number, part in enumerate(ranges)
    )
    # runs that still go on keep their counters beside those of others
    runs = {k: v for k, v in before.state.get("runs", {}).items() if not v["exhausted"]}
    if run is not None:
        runs[run] = {**own_state, "used": used, "exhausted": exhausted}
    state = {
        "positions": {**before.state.get("positions", {}), topic: own},
        "runs": runs,
    }
    if not log.publish(before.version + 1, state, [folder] if taken else []):
        raise ConcurrentRun(f"version {before.version + 1} of {log.path} is taken")
    return Run(before.version + 1, sum(part.rows for part in taken), folder, exhausted)


def start_from_positions(
    messages: DataFrame,
    task: TaskSpec,
    log: ManifestLog,
    checkpoint: str,
    write: Write,
    topic: str = "",
    start_earliest: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The same for a stream of messages: every micro-batch is one published step.

    A clause's limit is counted over the whole run, in the log, and cuts through the
    micro-batch that reaches it: of several partitions the lower come first there. Rows
    behind the cut are not taken and their positions stay. A run is named by its
    checkpoint: started again with it, it goes on, counters included; a micro-batch that
    was published before a crash is not taken again. A new checkpoint is a new run, which
    starts at the stored positions with fresh counters.
    """
    run = checkpoint.rstrip("/")

    def take(batch: DataFrame, batch_id: int) -> None:
        before = log.latest()
        state = before.state.get("runs", {}).get(run, {})
        if state and (state["batch"] >= batch_id or state["exhausted"]):
            return
        used = {int(k): v for k, v in state.get("used", {}).items()}
        started = state.get("started")
        if started is None:
            started = {str(k): v for k, v in positions(before, topic).items()}
        stored = {int(k): v for k, v in started.items()}
        selected, ranges = task.ranged(batch, stored, start_earliest)
        own_state = {"batch": batch_id, "started": started}
        _step(selected, task, ranges, used, before, log, write, topic, run, own_state)

    return (
        messages.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(take)
        .start()
    )


def exhausted(log: ManifestLog, checkpoint: str) -> bool:
    """Whether the run of this checkpoint has taken all that its limits allow."""
    state = log.latest().state.get("runs", {}).get(checkpoint.rstrip("/"), {})
    return bool(state.get("exhausted"))


def run_stream_from_positions(
    query: StreamingQuery,
    log: ManifestLog,
    checkpoint: str,
    max_duration: float = MAX_DURATION,
    idle_timeout: float | None = POLL_TIMEOUT,
    keep_going: Callable[[], bool] | None = None,
) -> str:
    """Let a started run go on until its limits or another bound is met; returns which."""

    def going() -> bool:
        return not exhausted(log, checkpoint) and (keep_going is None or keep_going())

    reason = run_bounded(query, max_duration, idle_timeout, None, going)
    return "limit" if exhausted(log, checkpoint) else reason


def published_folders(log: ManifestLog, version: int | None = None) -> list[str]:
    """The folders of all steps that count, in order; orphans of failed runs are not there."""
    return log.parts(version)


def read_published(
    spark: SparkSession, log: ManifestLog, root: str, schema, fmt: str = "parquet"
) -> DataFrame:
    """All rows that have been published below ``root``."""
    paths = [f"{root}/{folder}" for folder in published_folders(log)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(paths)

