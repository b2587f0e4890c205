"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The messages are stored as an envelope first, as a topic's consumer would find them,
so that making test messages is not part of any time. Each query then runs to its
last row; streams run from an empty checkpoint to the end of their input. A query's
time is the better of two runs, after one small warm-up of the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks import messages as m  # noqa: E402
from checks import queries as q  # noqa: E402
from clickweir.operators import enrich, parse, windows  # noqa: E402
from clickweir.operators.features import cookie_features  # noqa: E402
from clickweir.plans import batch  # noqa: E402
from clickweir.session import build_session, fresh_folder  # noqa: E402
from clickweir.sinks import files, render  # noqa: E402
from clickweir.sources.envelope import ENVELOPE, read_replay, stream_replay  # noqa: E402
from clickweir.sources.task_spec import TaskSpec  # noqa: E402
from clickweir.streaming import keyed, pipeline  # noqa: E402

RUNS = 2


def drained(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def headline(spark, replay: str, fast: str):
    """Name -> function that runs one query to its end."""
    clock = F.lit(0)

    def messages():
        return read_replay(spark, replay)

    def fast_events():
        return spark.read.parquet(fast)

    def stream_final():
        stages = pipeline.Stages(fresh_folder(spark, "bench-final"))
        rows = windows.hopping_counters(
            windows.cookie_events(batch.enriched_events(stream_replay(spark, replay), clock))
        )
        query = (
            rows.writeStream.format("parquet")
            .option("path", stages.windows)
            .option("checkpointLocation", stages.checkpoint("windows"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def stream_update():
        folder = fresh_folder(spark, "bench-update")
        rows = windows.hopping_counters(
            windows.cookie_events(batch.enriched_events(stream_replay(spark, replay), clock))
        )
        keyed.start_keyed(rows, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
        drained(keyed.read_keyed(spark, f"{folder}/out", rows.schema, pipeline.WINDOW_KEYS))

    def chain():
        stages = pipeline.Stages(fresh_folder(spark, "bench-chain"))
        pipeline.start_documents(stream_replay(spark, replay), stages).awaitTermination()
        pipeline.start_final_windows(
            pipeline.stream_documents(spark, stages), stages
        ).awaitTermination()
        pipeline.start_features(spark, stages).awaitTermination()
        drained(pipeline.read_features(spark, stages))

    return {
        "parse_enrich": lambda: drained(batch.enriched_events(messages(), clock)),
        "extend_json": lambda: drained(
            enrich.extended_documents(messages(), clock, skip_rejects=True)
        ),
        "rejects": lambda: drained(parse.rejects(messages())),
        "cookies_hopping": lambda: drained(batch.cookie_windows(messages(), clock)),
        "cookies_hopping_panes": lambda: drained(
            batch.cookie_windows(messages(), clock, panes=True)
        ),
        "cookies_session": lambda: drained(
            windows.session_counters(
                windows.cookie_events(batch.enriched_events(messages(), clock))
            )
        ),
        "features": lambda: drained(batch.features(messages(), clock)),
        "features_fast_clock": lambda: drained(
            cookie_features(windows.hopping_counters(fast_events()))
        ),
        "export_columns": lambda: drained(render.render_lines(messages(), q.COLUMN_SPEC)),
        "export_hash": lambda: drained(
            render.render_lines(messages(), "timestamp;columns:hash(uuid),uid,eid,dt,hash(ua)")
        ),
        "export_eav": lambda: drained(render.render_lines(messages(), "offset;eav")),
        "export_orc": lambda: files.write_orc(
            messages(), fresh_folder(spark, "bench-orc"), q.ORC_COLUMNS
        ),
        "task_limit": lambda: drained(
            TaskSpec.parse("0:100:7000,1-3:-2:30000").select(messages())
        ),
        "stream_append_final": stream_final,
        "stream_update_upsert": stream_update,
        "pipeline_end_to_end": chain,
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus) if cpus.isdigit() else 8,
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    replay, fast = fresh_folder(spark, "bench-replay"), fresh_folder(spark, "bench-fast")
    tasks = spark.sparkContext.defaultParallelism
    stored = m.clickstream(spark, sf_dir).select(*ENVELOPE.fieldNames())
    stored.repartition(tasks).write.parquet(replay)
    m.compressed_clock(spark, sf_dir).repartition(tasks).write.parquet(fast)
    events = spark.read.parquet(replay).count()

    times: dict[str, float] = {}
    for name, run in headline(spark, replay, fast).items():
        best = None
        for _ in range(RUNS):
            began = time.perf_counter()
            run()
            took = time.perf_counter() - began
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "events": events,
                "events_per_sec": {k: round(events / v) for k, v in times.items()},
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
