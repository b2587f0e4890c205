"""SQL as the entry point: declared streams as views, and the functions they need."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickweir.functions.document import JSON_BLANKS
from clickweir.session import prepare_streaming
from clickweir.sources.stream_spec import StreamSpec
from clickweir.streaming.keyed import start_keyed

# Native SQL functions: the analyzer replaces a call by its body, so they cost what
# the body costs and run on streams as well.
_BODY = f"trim(TRAILING {JSON_BLANKS!r} FROM document)"

SQL_FUNCTIONS = {
    "extend_json": rf"""
        (added MAP<STRING, BIGINT>, document STRING) RETURNS STRING
        RETURN CASE
          WHEN size(added) = 0 THEN document
          WHEN document RLIKE '^\\s*[{{]\\s*[}}]\\s*$' THEN to_json(added)
          WHEN endswith({_BODY}, '}}') AND try_element_at(json_object_keys(
              concat(left({_BODY}, length({_BODY}) - 1), ',"":0}}')), -1) <=> ''
            THEN concat(left({_BODY}, length({_BODY}) - 1), ',',
                        substring(to_json(added), 2))
        END""",
    "clock_ms": "() RETURNS BIGINT RETURN unix_millis(current_timestamp())",
    "window_start_ms": """
        (span STRUCT<start: TIMESTAMP, end: TIMESTAMP>) RETURNS BIGINT
        RETURN unix_millis(span.start)""",
    "int_ratio": """
        (numerator BIGINT, denominator BIGINT) RETURNS BIGINT
        RETURN coalesce(numerator, 0) DIV denominator""",
}


def register_functions(spark: SparkSession) -> None:
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {body}")


def start_sql(
    spark: SparkSession,
    declared: Mapping[StreamSpec, DataFrame],
    statements: Sequence[tuple[str, str]],
    path: str,
    checkpoint: str,
    changes: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run a job over declared streams and store what its last SELECT gives.

    Results are appended once they are final, as Parquet, or with ``changes`` logged
    whenever they change (read them with ``streaming.keyed.read_keyed``).
    """
    prepare_streaming(spark)
    result = run_sql(spark, declared, statements)
    if changes:
        return start_keyed(result, path, checkpoint, trigger)
    return (
        result.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def run_sql(
    spark: SparkSession,
    declared: Mapping[StreamSpec, DataFrame],
    statements: Sequence[tuple[str, str]],
) -> DataFrame:
    """Run a job file: declared streams first, then named SELECTs in order.

    Each SELECT becomes a view under its name and may use the ones before it; the
    last one is returned. The views are plans, nothing is stored in between.
    """
    register_functions(spark)
    for spec, messages in declared.items():
        spec.register(messages)
    result = None
    for name, query in statements:
        result = spark.sql(query)
        result.createOrReplaceTempView(name)
    if result is None:
        raise ValueError("a job needs at least one statement")
    return result
