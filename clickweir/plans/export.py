"""The exporter: part of a topic (or of a stored copy) into text, ORC or a table.

    spark-submit -m clickweir.plans.export --replay PATH --task "*:-2:1000000" \
        --format csv --columns "timestamp;columns:hash(uuid),uid,eid" --filename OUT

With ``--positions FOLDER`` a run begins where the group's last one stopped and its output
counts once it is published there (``plans.positions``): ``--task "%:-1000:1000000"``.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence
from dataclasses import dataclass, fields, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from clickweir.plans.positions import (
    positions,
    run_from_positions,
    run_stream_from_positions,
    start_from_positions,
)
from clickweir.session import build_session
from clickweir.sinks.files import typed_rows, write_lines, write_orc
from clickweir.sinks.jdbc import JdbcTarget, append_to_jdbc
from clickweir.sinks.manifests import ManifestLog
from clickweir.sinks.render import render_lines
from clickweir.sinks.tables import append_to_table
from clickweir.sources.catalog import columns_from_table
from clickweir.sources.envelope import read_replay, read_topic, stream_replay, stream_topic
from clickweir.sources.kafka import Connection
from clickweir.sources.task_spec import TaskSpec
from clickweir.streaming.append import start_table_append
from clickweir.streaming.run import run_bounded

# which of the target's options each format honours
HONOURED = {
    "csv": {"columns", "filename", "delimiter", "newline", "compression", "hash_method", "spelling"},
    "orc": {"columns", "filename", "compression"},
    "table": {"table", "nulls", "batch_column"},
    "jdbc": {
        "table", "columns_table", "host", "port", "user", "password", "database",
        "jdbc_url", "jdbc_driver", "nulls", "batch_size", "thread_count",
    },
}
FORMATS = tuple(HONOURED)


@dataclass
class ExportJob:
    """One export; every field is a command-line option of the same name."""

    task: str = ""
    format: str = "csv"
    columns: str = "json"
    filename: str = ""
    delimiter: str = "|"
    newline: str = "\n"
    compression: str = ""
    hash_method: str = "compat"
    spelling: str = "decoded"
    # source: a stored copy, or a topic
    replay: str = ""
    brokers: str = ""
    topic: str = ""
    group: str = ""
    security_protocol: str = ""
    sasl_mechanisms: str = ""
    kafka_user: str = ""
    kafka_password: str = ""
    ssl_ca_location: str = ""
    start_earliest: bool = False
    partition_count: int = 0
    # the group's positions and what its runs have published
    positions: str = ""
    # continuous run; without a group, its positions are those of the checkpoint
    checkpoint: str = ""
    max_duration: int = 300_000
    poll_timeout: int = 30_000
    lockfile: str = ""
    # table target
    table: str = ""
    columns_table: str = ""
    host: str = ""
    port: int = 0
    user: str = ""
    password: str = ""
    database: str = ""
    jdbc_url: str = ""
    jdbc_driver: str = ""
    batch_column: str = ""
    nulls: str = "default"
    batch_size: int = 500_000
    thread_count: int = 1

    def connection(self) -> Connection:
        return Connection(
            brokers=self.brokers,
            group=self.group,
            security_protocol=self.security_protocol,
            sasl_mechanism=self.sasl_mechanisms,
            user=self.kafka_user,
            password=self.kafka_password,
            ca_location=self.ssl_ca_location,
        )

    def check(self) -> None:
        """Refuse what the format does not honour, rather than ignore it."""
        if not self.task:
            raise ValueError("a task is needed: partitions:offset:limit")
        if self.format not in FORMATS:
            raise ValueError(f"unknown format {self.format!r}; expected one of {FORMATS}")
        known = set().union(*HONOURED.values())
        ignored = sorted(
            item.name
            for item in fields(self)
            if item.name in known - HONOURED[self.format]
            and getattr(self, item.name) != item.default
        )
        if ignored:
            raise ValueError(f"format {self.format!r} has no use for {ignored}")
        if self.positions and self.format == "jdbc":
            raise ValueError("format 'jdbc' cannot take rows back: it has no use for positions")
        if self.positions and self.format == "table" and not self.batch_column:
            raise ValueError("a table written from positions needs a batch_column of its own")

    def source_options(
        self, has_positions: bool = False, stored: dict[int, int] | None = None
    ) -> dict[str, str]:
        """``has_positions``: an earlier run has stored some in the checkpoint; ``stored``:
        those of the group."""
        spec = TaskSpec.parse(self.task)
        return {
            **self.connection().options(),
            **spec.options(
                self.topic,
                stored,
                start_earliest=self.start_earliest,
                partition_count=self.partition_count or None,
                streaming=bool(self.checkpoint),
                has_checkpoint=has_positions,
                counted=bool(self.positions),
            ),
        }

    def jdbc_target(self) -> JdbcTarget:
        return JdbcTarget(
            url=self.jdbc_url,
            table=self.table,
            host=self.host,
            port=self.port or None,
            database=self.database,
            user=self.user,
            password=self.password,
            driver=self.jdbc_driver,
            batch_size=self.batch_size,
            writers=self.thread_count,
        )


def export(messages: DataFrame, job: ExportJob) -> None:
    """Write a bounded set of messages as ``job`` says."""
    if job.format == "csv":
        write_lines(
            messages,
            job.filename,
            job.columns,
            job.delimiter,
            job.newline,
            job.hash_method,
            spelling=job.spelling,
            compression=job.compression or None,
        )
    elif job.format == "orc":
        write_orc(messages, job.filename, job.columns, compression=job.compression or "zlib")
    elif job.format == "table":
        append_to_table(messages, job.table, job.nulls)
    elif job.format == "jdbc":
        spark = messages.sparkSession
        types = columns_from_table(spark, job.columns_table, job.table)
        append_to_jdbc(messages, job.jdbc_target(), types, job.nulls)
    else:
        raise ValueError(f"unknown format {job.format!r}; expected one of {FORMATS}")


def run_export(spark: SparkSession, job: ExportJob) -> str:
    """Read, select and write; with a checkpoint as a bounded continuous run."""
    job.check()
    if job.positions:
        return _export_from_positions(spark, job)
    task = TaskSpec.parse(job.task)
    if job.replay:
        messages = read_replay(spark, job.replay)
        export(task.select(messages, start_earliest=job.start_earliest), job)
        return "finished"
    if not job.checkpoint:
        messages = read_topic(spark, job.source_options())
        export(task.select(messages, start_earliest=job.start_earliest), job)
        return "finished"
    resumed = checkpoint_exists(spark, job.checkpoint)
    messages = stream_topic(spark, job.source_options(has_positions=resumed))
    return run_bounded(
        _start(messages, job),
        max_duration=job.max_duration / 1000,
        idle_timeout=job.poll_timeout / 1000,
        max_rows=TaskSpec.parse(job.task).total_limit,
        keep_going=(lambda: os.path.exists(job.lockfile)) if job.lockfile else None,
    )


def _export_from_positions(spark: SparkSession, job: ExportJob) -> str:
    """One step, or with a checkpoint a continuous run, from the group's positions on."""
    task, log = TaskSpec.parse(job.task), ManifestLog(spark, job.positions)
    stored = positions(log.latest(), job.topic)

    def write(rows: DataFrame, folder: str) -> None:
        if job.format == "table":
            step = (job.batch_column, int(folder.split("-")[1]))
            append_to_table(rows, job.table, job.nulls, replace=step)
        else:
            export(rows, replace(job, filename=f"{job.filename}/{folder}"))

    if not job.checkpoint:
        messages = (
            read_replay(spark, job.replay)
            if job.replay
            else read_topic(spark, job.source_options(stored=stored))
        )
        run_from_positions(messages, task, log, write, job.topic, job.start_earliest)
        return "finished"
    resumed = checkpoint_exists(spark, job.checkpoint)
    messages = (
        stream_replay(spark, job.replay)
        if job.replay
        else stream_topic(spark, job.source_options(resumed, stored))
    )
    query = start_from_positions(
        messages, task, log, job.checkpoint, write, job.topic, job.start_earliest,
        {"processingTime": "0 seconds"},
    )
    return run_stream_from_positions(
        query,
        log,
        job.checkpoint,
        max_duration=job.max_duration / 1000,
        idle_timeout=job.poll_timeout / 1000,
        keep_going=(lambda: os.path.exists(job.lockfile)) if job.lockfile else None,
    )


def checkpoint_exists(spark: SparkSession, path: str) -> bool:
    """Whether a query has stored positions below this path."""
    try:
        return not spark.read.format("binaryFile").load(f"{path}/offsets").limit(1).isEmpty()
    except AnalysisException:
        return False  # there is no such folder


def _start(messages: DataFrame, job: ExportJob):
    trigger = {"processingTime": "0 seconds"}
    if job.format == "table":
        return start_table_append(
            messages, job.table, job.checkpoint, job.nulls,
            batch_column=job.batch_column or None, trigger=trigger,
        )
    if job.format == "csv":
        rows = render_lines(messages, job.columns, job.delimiter, job.hash_method, job.spelling)
        writer = rows.writeStream.format("text").option("lineSep", job.newline)
        if job.compression:
            writer = writer.option("compression", job.compression)
    elif job.format == "orc":
        writer = typed_rows(messages, job.columns).writeStream.format("orc")
        if job.compression:
            writer = writer.option("compression", job.compression)
    else:
        raise ValueError(f"format {job.format!r} has no continuous form")
    return (
        writer.option("path", job.filename)
        .option("checkpointLocation", job.checkpoint)
        .trigger(**trigger)
        .start()
    )


def parse_arguments(arguments: Sequence[str] | None = None) -> ExportJob:
    parser = argparse.ArgumentParser(prog="clickweir.plans.export", description=__doc__)
    defaults = ExportJob()
    for item in fields(ExportJob):
        option = "--" + item.name.replace("_", "-")
        default = getattr(defaults, item.name)
        if isinstance(default, bool):
            parser.add_argument(option, action="store_true")
        else:
            parser.add_argument(option, type=type(default), default=default)
    return ExportJob(**vars(parser.parse_args(arguments)))


if __name__ == "__main__":
    print(run_export(build_session("clickweir-export"), parse_arguments()))
