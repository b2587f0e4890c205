import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickweir.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "clickweir-tests",
        "local[8]",
        4,
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def messages(spark):
    """Envelopes from payload texts: one topic partition, offsets from 0."""
    from pyspark.sql import functions as F

    from clickweir.sources.envelope import ENVELOPE

    def make(values, key="u1", partition=0, topic="t"):
        rows = [
            (key, value, topic, partition, offset, None)
            for offset, value in enumerate(values)
        ]
        return spark.createDataFrame(rows, ENVELOPE).withColumn(
            "timestamp", F.timestamp_millis(F.col("offset") * 1000 + 5)
        )

    return make
