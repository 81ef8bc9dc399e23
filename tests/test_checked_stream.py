"""Checked events, their late rows and counts, and the earliest event of each key, over runs and replays."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from smelter.sources import Lake, stream_events
from smelter.streaming import (
    checked_schema,
    earliest_events,
    late_events,
    run_pending,
    start_checked,
    start_earliest,
    stored_quality,
)
from smelter.streaming.checked import CHECKED, LAYER, store_checked
from tests.test_streaming import event, typed, write


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def run(spark, lake, src, lateness=None, **options):
    stream = typed(stream_events(spark, str(src), **options))
    run_pending(start_checked(stream, lake, lake.path("cp", "checked"), lateness=lateness))
    schema = checked_schema(stream)
    run_pending(start_earliest(spark, lake, schema, lake.path("cp", "earliest")))
    return schema


def survivors(spark, lake, schema):
    rows = earliest_events(spark, lake, schema).collect()
    return {r.claim_id: (r.event_timestamp, float(r.claim_amount), r.copies) for r in rows}


def test_survivor_does_not_depend_on_order_or_split(spark, tmp_path):
    rng = random.Random(9)
    events = [event(i, rng.randrange(200), rng.choice([1.0, 2.0, 3.0]), claim=rng.choice(["hot", "hot", *map(str, range(9))])) for i in range(120)]
    want = {}
    for e in events:
        row = (dt.datetime.fromisoformat(e["event_timestamp"]).replace(tzinfo=None), e["claim_amount"])
        n = want.get(e["claim_id"], (row, 0))[1] + 1
        want[e["claim_id"]] = (min(want.get(e["claim_id"], (row, 0))[0], row), n)
    for attempt, options in enumerate(({}, {"maxFilesPerTrigger": "1"})):
        lake, src = Lake(str(tmp_path / f"lake{attempt}")), tmp_path / f"in{attempt}"
        rng.shuffle(events)
        for i in range(0, 120, 40):
            write(src, f"{i}.json", events[i : i + 40])
            schema = run(spark, lake, src, **options)
        assert survivors(spark, lake, schema) == {k: (*row, n) for k, (row, n) in want.items()}


def test_late_rows_and_counts_survive_restarts_and_replays(spark, lake, tmp_path):
    src, hour = tmp_path / "in", dt.timedelta(hours=1)
    write(src, "1.json", [event(1, 0, 5.0), event(2, 300, 2.0), event(3, 9, -1.0), {"claim_id": "c"}])
    run(spark, lake, src, hour)
    late = [event(4, 239, 7.0, claim="e2"), event(5, 10, 7.0, claim="late")]
    write(src, "2.json", [*late, event(6, 240, 1.0, claim="in time"), event(7, 400, 1.0), event(8, 5, None)])
    schema = run(spark, lake, src, hour)
    assert sorted((r.claim_id, r.batch_id) for r in late_events(spark, lake).collect()) == [("e2", 1), ("late", 1)]
    kept = earliest_events(spark, lake, schema)
    assert set(survivors(spark, lake, schema)) == {"e1", "e2", "in time", "e7"}
    assert survivors(spark, lake, schema)["e2"][1] == 2.0
    want = {"record_count": 9, "invalid_count": 3, "late_count": 2, "cleaned_count": 4, "dropped_count": 5, "pass_rate": 4 / 9 * 100}
    assert stored_quality(spark, lake, kept).first().asDict() == want

    # The same batch again, as after a failure: judged by what was known then, stored once.
    second = typed(spark.read.text(str(src / "2.json")))
    store_checked(second, lake, 1, lateness=hour)
    assert late_events(spark, lake).count() == 2 and lake.read(spark, LAYER, CHECKED).count() == 6
    assert stored_quality(spark, lake, kept).first().asDict() == want


def test_frequent_keys_are_combined_before_the_shuffle(spark, lake, tmp_path):
    src = tmp_path / "in"
    write(src, "1.json", [event(i, i, claim="hot") for i in range(50)])
    run(spark, lake, src)
    batch = spark.read.parquet(f"{lake.path(LAYER, CHECKED)}/*/is_late=false")
    text = batch.groupBy("claim_id").agg(F.min(F.struct("event_timestamp", "claim_amount")))
    assert "partial_min" in text._jdf.queryExecution().executedPlan().toString()


def test_nothing_stored(spark, lake, tmp_path):
    schema = checked_schema(typed(spark.createDataFrame([], "value string")))
    kept = earliest_events(spark, lake, schema)
    assert kept.count() == 0
    assert stored_quality(spark, lake, kept).first().asDict() == {
        "record_count": 0, "invalid_count": 0, "late_count": 0, "cleaned_count": 0, "dropped_count": 0, "pass_rate": 0.0,
    }
