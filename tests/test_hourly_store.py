"""Hourly groups merged by day: the view stays the same, look-backs list few folders."""

import datetime as dt

from smelter.operators.monitor import hourly_claims
from smelter.sources import Lake
from smelter.streaming import hourly_view, merge_days
from smelter.streaming.hourly import DAYS, LAYER, MANIFEST, merged_days, store_partials
from tests.test_streaming import BASE, TYPED, contents


def batch(spark, days, amount, customer="c"):
    rows = [("x", "p", customer, amount, "s", None if d is None else BASE + dt.timedelta(days=d, minutes=m)) for d in days for m in (0, 70, 71)]
    return spark.createDataFrame(rows, TYPED)


def test_merging_changes_no_result(spark, tmp_path):
    from decimal import Decimal

    lake, seen = Lake(str(tmp_path)), None
    assert merge_days(spark, lake).generation == -1
    for number, (days, customer) in enumerate([([0, 1, 2], "c"), ([1, None], "c"), ([2, 5], "d"), ([None, 0], "d"), ([9], "c")]):
        rows = batch(spark, days, Decimal(number) if number else None, customer)
        store_partials(rows, lake, number)
        seen = rows if seen is None else seen.union(rows)
        want = contents(hourly_claims(seen))
        assert contents(hourly_view(spark, lake)) == want
        if number in (1, 3):
            # A merge that broke before its manifest left a folder; the next try replaces it.
            folder = f"{lake.path(LAYER, DAYS)}/batch_id={merged_days(spark, lake).generation + 1}/event_date=2025-01-16"
            batch(spark, [1], Decimal(7)).write.parquet(folder)
            state = merge_days(spark, lake)
            assert state.upto == number == merged_days(spark, lake).upto
            assert contents(hourly_view(spark, lake)) == want
            assert merge_days(spark, lake) == state
    assert lake.batches(spark, LAYER, MANIFEST) == [0, 1]
    assert state.days[BASE.date() + dt.timedelta(days=1)] == 0 and state.days[None] == 1  # untouched days keep their folder


def test_a_look_back_lists_its_days_and_open_batches(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for number in range(4):
        store_partials(batch(spark, range(20), None), lake, number)
    merge_days(spark, lake)
    store_partials(batch(spark, [19], None), lake, 4)
    recent = hourly_view(spark, lake, as_of=BASE + dt.timedelta(days=19, hours=2), back=dt.timedelta(days=7))
    text = recent._jdf.queryExecution().optimizedPlan().toString()
    folders = {f.rsplit("/", 2)[1] if DAYS in f else f.split("claims_hourly/")[1].split("/")[0] for f in recent.inputFiles()}
    assert folders == {f"event_date={(BASE + dt.timedelta(days=d)).date()}" for d in range(12, 20)} | {"batch_id=4"}
    assert "event_timestamp" in text
    counts = {((r.event_timestamp.date() - BASE.date()).days, r.event_timestamp.hour): r.claims_count for r in recent.collect()}
    # Strictly later than day 12, two o'clock.
    assert counts == {**{(d, h): n for d in range(13, 19) for h, n in ((0, 4), (1, 8))}, (19, 0): 5, (19, 1): 10}
