"""Streams fed file by file: any split gives the batch result, replays change nothing."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from smelter.entities import CLAIM_EVENT_FIELDS
from smelter.operators.monitor import hourly_claims
from smelter.sources import Lake, extract_fields, stream_events, type_fields
from smelter.streaming import (
    hourly_view,
    rows_dropped_late,
    run_pending,
    start_alerts,
    start_fan_out,
    start_hourly_bounded,
    start_realtime_silver,
)
from smelter.streaming.hourly import store_partials

UTC = dt.timezone.utc
BASE = dt.datetime(2025, 1, 15, tzinfo=UTC)
TYPED = "claim_id string, policy_id string, customer_id string, claim_amount decimal(28,8), claim_status string, " \
        "event_timestamp timestamp"


def event(n, minutes, amount=1.0, customer="c", claim=None):
    return {"claim_id": claim or f"e{n}", "policy_id": "p", "customer_id": customer, "claim_amount": amount,
            "claim_status": " new ", "event_timestamp": (BASE + dt.timedelta(minutes=minutes)).isoformat()}


def random_events(n, seed=5):
    rng = random.Random(seed)
    return [event(i, rng.randrange(600), rng.choice([None, 0.01, 7, 33.33, 1e5]), rng.choice(["hot", "hot", "a", "b"]))
            for i in range(n)]


def write(folder, name, objects):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(map(json.dumps, objects)) + "\n")


def typed(df):
    return type_fields(extract_fields(df, CLAIM_EVENT_FIELDS), CLAIM_EVENT_FIELDS)


def contents(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def test_any_split_of_the_stream_gives_the_batch_result(spark, lake, tmp_path):
    events, src = random_events(300), tmp_path / "in"
    for i in range(0, 300, 60):
        write(src, f"{i}.json", events[i:i + 60])
    stream = stream_events(spark, str(src), maxFilesPerTrigger="1")
    run_pending(start_fan_out(stream, lake, str(tmp_path / "cp")))
    want = contents(hourly_claims(typed(spark.read.text(str(src)))))
    assert contents(hourly_view(spark, lake)) == want
    assert lake.read(spark, "events", "claims_events").select("batch_id").distinct().count() == 5

    # A batch played again replaces itself.
    stored = lake.read(spark, "events", "claims_events").where("batch_id = 2").drop("batch_id").cache()
    stored.count()
    store_partials(stored, lake, 2)
    assert contents(hourly_view(spark, lake)) == want
    stored.unpersist()

    # A late event changes its old hour; only new files are read.
    late = [event(1000, 5, 9.0, "a")]
    write(src, "late.json", late)
    run_pending(start_fan_out(stream_events(spark, str(src)), lake, str(tmp_path / "cp")))
    assert contents(hourly_view(spark, lake)) == contents(hourly_claims(typed(spark.read.text(str(src)))))
    assert lake.read(spark, "bronze", "claims_events").count() == 301


def test_view_of_nothing_is_empty(spark, lake):
    assert hourly_view(spark, lake).count() == 0
    assert hourly_view(spark, lake, bounded=True).count() == 0


def test_look_back_of_the_view_reads_recent_days_only(spark, lake):
    df = spark.createDataFrame(
        [("x", "p", "c", None, "s", BASE + dt.timedelta(days=d)) for d in range(10)], TYPED)
    store_partials(df, lake, 0)
    recent = hourly_view(spark, lake, as_of=BASE + dt.timedelta(days=9), back=dt.timedelta(days=7))
    assert recent.count() == 7  # strictly later than day 2
    text = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text and "GreaterThan(event_timestamp" in text
    assert hourly_view(spark, lake).count() == 10


def test_bounded_state_drops_late_events_and_says_so(spark, lake, tmp_path):
    src, cp = tmp_path / "in", str(tmp_path / "cp")
    write(src, "1.json", [event(1, 0), event(2, 300, 2.0)])
    run_pending(start_hourly_bounded(typed(stream_events(spark, str(src))), lake, cp, "1 hour"))
    write(src, "2.json", [event(3, 10), event(4, 310, 4.0)])
    query = run_pending(start_hourly_bounded(typed(stream_events(spark, str(src))), lake, cp, "1 hour"))
    assert rows_dropped_late(query) == 1
    got = {r.event_timestamp.hour: (r.claims_count, float(r.total_amount), float(r.avg_amount))
           for r in hourly_view(spark, lake, bounded=True).collect()}
    assert got == {0: (1, 1.0, 1.0), 5: (2, 6.0, 3.0)}


@pytest.mark.parametrize("lateness", ["1 day", None])
@pytest.mark.parametrize("spread", [0, 4])
def test_each_claim_once_over_several_runs(spark, tmp_path, lateness, spread):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = typed(stream_events(spark, str(src)))
        run_pending(start_realtime_silver(stream, out, cp, lateness=lateness, spread=spread))
        return sorted((r.claim_id, r.claim_amount) for r in spark.read.parquet(out).collect())

    hot = [event(i, i, 5.0, claim="hot") for i in range(40)]
    bad = [event(0, 1, -1.0, claim="a"), event(0, 1, None, claim="b"), {"claim_id": "c"}]
    write(src, "1.json", [*bad, *hot[:20], event(0, 3, 2.0, claim="a")])
    write(src, "2.json", hot[20:])
    # The invalid event of claim a does not displace the valid one.
    assert run() == [("a", 2.0), ("hot", 5.0)]
    write(src, "3.json", [event(0, 50, 7.0, claim="a"), event(0, 50, 7.0, claim="d")])
    assert run() == [("a", 2.0), ("d", 7.0), ("hot", 5.0)]
    assert run() == [("a", 2.0), ("d", 7.0), ("hot", 5.0)]
    # Older than all seen, but not by more than the lateness; and by more.
    write(src, "4.json", [event(0, -600, 3.0, claim="old"), event(0, -4000, 3.0, claim="too old")])
    kept = {c for c, _ in run()}
    assert kept == ({"a", "d", "hot", "old"} if lateness else {"a", "d", "hot", "old", "too old"})
    row = spark.read.parquet(out).where("claim_id = 'd'").first()
    assert (row.claim_status, row.is_current, row.effective_to) == ("NEW", True, None)
    assert row.effective_from == row.event_timestamp == (BASE + dt.timedelta(minutes=50)).replace(tzinfo=None)


def test_alert_stream_keeps_no_state(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    write(src, "1.json", [event(1, 0, 50000), event(2, 0, 50000.01), event(3, 0, None)])
    query = run_pending(start_alerts(typed(stream_events(spark, str(src))), out, str(tmp_path / "cp")))
    assert [r.claim_id for r in spark.read.parquet(out).collect()] == ["e2"]
    assert not any(p.stateOperators for p in query.recentProgress)
    assert spark.read.parquet(out).agg(F.count("*")).first()[0] == 1
