"""The message envelope and its two origins: a topic and files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

ENVELOPE = StructType(
    [
        StructField("key", StringType()),
        StructField("value", StringType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
    ]
)


def as_envelope(messages: DataFrame) -> DataFrame:
    """Bring connector output (binary key and value) to the envelope's types."""
    return messages.select(
        *[F.col(field.name).cast(field.dataType) for field in ENVELOPE]
    )


def read_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Bounded read of a topic; ``options`` from ``sources.kafka``.

    Needs the Kafka connector package on the classpath.
    """
    return as_envelope(spark.read.format("kafka").options(**options).load())


def stream_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Endless read of a topic; positions live in the query's checkpoint."""
    return as_envelope(spark.readStream.format("kafka").options(**options).load())


def read_replay(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Bounded read of stored envelopes. Filters on partition and offset reach the
    scan; store the copy with ``write_replay`` to skip whole partitions as well."""
    return spark.read.schema(ENVELOPE).format(fmt).load(path)


def stream_replay(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stored envelopes as a stream, oldest files first."""
    reader = spark.readStream.schema(ENVELOPE).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def write_replay(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Store envelopes, one directory per topic partition, without a shuffle.

    Meant for sources already laid out by partition, as a topic read is: each task
    then writes one file. Otherwise every task writes one file per partition.
    """
    messages.select(*ENVELOPE.fieldNames()).write.mode(mode).partitionBy(
        "partition"
    ).parquet(path)
