"""What flows store, shuffle and keep in streaming state as tables grow."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pytest

from smelter.entities import POLICIES
from smelter.plans import clean_new, increments
from smelter.sources import Lake, stream_events
from smelter.streaming import checked_schema, run_pending, start_checked, start_earliest, start_realtime_silver
from smelter.streaming.realtime import _once_per_batch
from tests.test_increments import load
from tests.test_streaming import event, typed, write


def state_operators(query):
    return max(len(p.stateOperators) for p in query.recentProgress)


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_tables_are_stored_as_zstd(spark, tmp_path, fmt):
    lake = Lake(str(tmp_path / "lake"), fmt)
    lake.overwrite(spark.range(9), "silver", "a")
    lake.append(spark.range(9), "bronze", "a")
    lake.write_batch(spark.range(9), "events", "a", 0)
    files = [f.name for f in Path(lake.root).rglob("part-*")]
    assert len(files) >= 3 and all(f".zstd.{fmt}" in f for f in files)


def test_typed_claims_keep_one_state_without_lateness(spark, tmp_path):
    write(tmp_path / "in", "1.json", [event(i, i, 5.0, claim="hot") for i in range(30)])
    stream = typed(stream_events(spark, str(tmp_path / "in")))
    query = run_pending(start_realtime_silver(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert state_operators(query) == 1 and spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_first_row_of_a_key_in_an_arrow_batch():
    keys = [["b", "a", None, "b", None, "a"], ["a", "c"], []]
    batches = [pa.record_batch([pa.array(range(len(k)), pa.int64()), pa.array(k, pa.string())], ["n", "key"]) for k in keys]
    assert [b.to_pydict()["n"] for b in _once_per_batch(1)(iter(batches))] == [[0, 1, 2], [0, 1], []]


def test_earliest_events_keep_no_state(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    write(tmp_path / "in", "1.json", [event(i, i, 5.0) for i in range(5)])
    stream = typed(stream_events(spark, str(tmp_path / "in")))
    run_pending(start_checked(stream, lake, lake.path("cp", "checked")))
    query = run_pending(start_earliest(spark, lake, checked_schema(stream), lake.path("cp", "earliest")))
    assert state_operators(query) == 0


def test_rows_that_meet_no_older_ones_are_reduced_once(spark, tmp_path, run, monkeypatch):
    lake, calls, latest = Lake(str(tmp_path / "lake")), [], increments.latest_per_key
    monkeypatch.setattr(increments, "latest_per_key", lambda *a, **k: calls.append(1) or latest(*a, **k))
    for times in (1, 3):
        load(spark, lake, tmp_path, [f"P{i % 7},C1,auto,{i + 1},x,2024-01-01" for i in range(20)], run)
        clean_new(spark, lake, POLICIES, run, buckets=2)
        assert len(calls) == times
