"""The SQL stream's documents are derived and written by many tasks."""

import pytest

from checks import queries as registered


@pytest.mark.parametrize("changes", [False, True])
def test_documents_are_not_one_task(spark, sf_dir, monkeypatch, tmp_path, changes):
    monkeypatch.setattr(registered, "fresh_folder", lambda spark, label: str(tmp_path / label))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    assert registered.sql_stream(changes)(spark, str(tmp_path / "sf")).count() > 0
    assert len(list((tmp_path / "documents").glob("part-*"))) > 1


@pytest.mark.parametrize("query", [registered.declared_stream, registered.sql_stream(False)])
def test_events_of_one_row_group_are_dealt_out(spark, sf_dir, monkeypatch, tmp_path, query):
    monkeypatch.setattr(registered, "fresh_folder", lambda spark, label: str(tmp_path / label))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.coalesce(1).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    assert query(spark, str(tmp_path / "sf")).count() > 0
    assert len(list((tmp_path / "documents").glob("part-*"))) > 1
