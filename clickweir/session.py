"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Applied by build_session(); a submitted job may override any of them.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # sessions are merged before the shuffle, so a hot key sends few rows
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # HotSpot leaves larger generated methods uncompiled; long CASE chains make them
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # call sites in error messages cost more than planning most of these queries
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


DEFAULT_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
)


def prepare_streaming(spark: SparkSession) -> None:
    """Settings that a stateful query's memory depends on, where the session has Spark's own.

    State moves to RocksDB, out of the heap, and sessions are merged before the shuffle.
    A running checkpoint keeps the settings that it was started with.
    """
    provider = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(provider, DEFAULT_PROVIDER) in ("", DEFAULT_PROVIDER):
        for name, value in SESSION_DEFAULTS.items():
            if ".stateStore." in name:
                spark.conf.set(name, value)
    merge = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    spark.conf.set(merge, SESSION_DEFAULTS[merge])


def build_session(
    app_name: str = "clickweir",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with this library's defaults.

    ``shuffle_partitions`` also fixes the number of state partitions of every
    streaming query at its first checkpoint, so size it for the cluster.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A session on one machine that names none gets a private one. On a cluster that is
    an error: every executor would write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir: {master} needs a shared folder")
        folder = tempfile.mkdtemp(prefix="clickweir-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder (Spark creates it on write)."""
    return f"{shared_folder(spark)}/clickweir/{label}-{uuid.uuid4().hex}"
