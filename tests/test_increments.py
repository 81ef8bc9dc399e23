"""Silver brought up to date by increments against silver rebuilt from all of bronze."""

import datetime as dt
import random
from pathlib import Path

import pytest

from smelter.entities import POLICIES
from smelter.plans import clean, clean_new, ingest, read_silver
from smelter.plans.increments import FINISHED
from smelter.session import Run
from smelter.sources import Lake

HEADER = "policy_id,customer_id,product_type,premium,status,start_date"
COUNTS = ("record_count", "duplicate_count", "invalid_count", "cleaned_count", "dropped_count", "pass_rate")


def load(spark, lake, folder, lines, run, header=HEADER):
    file = folder / f"{len(list(folder.glob('*.csv')))}.csv"
    file.write_text("\n".join([header, *lines]) + "\n")
    ingest(spark, lake, POLICIES, str(file), run)


def silver_rows(spark, lake):
    rows = read_silver(spark, lake, "policies").drop("processed_timestamp")
    return sorted(map(str, rows.select(*sorted(rows.columns)).collect()))


def rebuilt_rows(spark, lake, run):
    other = Lake(lake.root + "-rebuilt", lake.fmt)
    if not Path(other.path("bronze", "policies")).exists():
        Path(other.path("bronze", "x")).parent.mkdir(parents=True, exist_ok=True)
        Path(other.path("bronze", "policies")).symlink_to(lake.path("bronze", "policies"))
    metrics = clean(spark, other, POLICIES, run)
    return silver_rows(spark, other), metrics


def files(lake):
    root = Path(lake.path("silver", "policies"))
    return {str(f.relative_to(root)): f.stat().st_mtime_ns for f in root.rglob("*.parquet")}


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_increments_equal_a_rebuild(spark, tmp_path, run, fmt):
    lake, rng = Lake(str(tmp_path / "lake"), fmt), random.Random(3)
    key = lambda: "P0" if rng.random() < 0.3 else rng.choice(["", *(f"P{i}" for i in range(1, 40))])
    # Two files of one day, one of the day before that comes late, one of a later day with a new column.
    days = [(0, HEADER), (0, HEADER), (-1, HEADER), (2, HEADER + ",channel")]
    for i, (day, header) in enumerate(days):
        at = Run(run.ts + dt.timedelta(days=day, minutes=i), f"run-{i}")
        lines = [
            f"{key()},C{rng.randrange(9)},auto,{rng.choice(['10', '-1', 'x', '7.5'])},x,2024-01-0{rng.randrange(1, 9)}"
            for _ in range(60)
        ]
        if header != HEADER:
            lines = [line + ",web" for line in lines]
        load(spark, lake, tmp_path, lines, at, header)
        metrics = clean_new(spark, lake, POLICIES, at, buckets=4)
        expected, whole = rebuilt_rows(spark, lake, at)
        assert silver_rows(spark, lake) == expected and expected
        assert metrics["new_dates"] == 1
        if metrics["rewritten_buckets"] == 4:
            assert {c: metrics[c] for c in COUNTS} == {c: whole[c] for c in COUNTS}
    again = clean_new(spark, lake, POLICIES, run, buckets=4)
    assert again["new_dates"] == again["rewritten_buckets"] == again["record_count"] == 0
    assert silver_rows(spark, lake) == expected


def test_only_touched_buckets_are_read_and_written(spark, tmp_path, run):
    lake = Lake(str(tmp_path / "lake"))
    load(spark, lake, tmp_path, [f"P{i},C1,auto,10,x,2024-01-01" for i in range(80)], run)
    first = clean_new(spark, lake, POLICIES, run, buckets=16)
    before = files(lake)
    assert first["rewritten_buckets"] > 8 and first["record_count"] == 80
    later = Run(run.ts + dt.timedelta(days=1), "run-2")
    load(spark, lake, tmp_path, ["P7,C1,auto,20,x,2024-01-01"], later)
    second = clean_new(spark, lake, POLICIES, later, buckets=16)
    assert second["rewritten_buckets"] == 1 and second["duplicate_count"] == 1
    # Only the rows of P7's bucket were counted, so no other was read.
    assert second["record_count"] < 80
    after = files(lake)
    new = {f.split("/")[0] for f in set(after) - set(before)}
    assert len(new) == 1
    kept = {f for f in before if f.split("/")[0] not in new}
    assert kept and all(after[f] == before[f] for f in kept)
    assert silver_rows(spark, lake) == rebuilt_rows(spark, lake, later)[0]


def test_a_bucket_whose_rows_become_invalid_is_emptied(spark, tmp_path, run):
    lake = Lake(str(tmp_path / "lake"))
    load(spark, lake, tmp_path, ["P1,C1,auto,10,x,2024-01-01"], run)
    clean_new(spark, lake, POLICIES, run, 8)
    assert read_silver(spark, lake, "policies").count() == 1
    later = Run(run.ts + dt.timedelta(days=1), "run-2")
    load(spark, lake, tmp_path, ["P1,C1,auto,broken,x,2024-01-01"], later)
    metrics = clean_new(spark, lake, POLICIES, later, 8)
    assert metrics["cleaned_count"] == 0 and metrics["record_count"] == 2
    silver = read_silver(spark, lake, "policies")
    assert silver.count() == 0 and "premium" in silver.columns


def test_a_run_that_broke_is_repeated(spark, tmp_path, run):
    lake = Lake(str(tmp_path / "lake"))
    load(spark, lake, tmp_path, ["P1,C1,auto,10,x,2024-01-01", "P1,C1,auto,11,x,2024-01-01"], run)
    clean_new(spark, lake, POLICIES, run, 8)
    # Without its mark the run has not finished: nothing of it is counted twice.
    Path(lake.batch_path("silver", "policies" + FINISHED, 0), "_SUCCESS").unlink()
    assert clean_new(spark, lake, POLICIES, run, 8)["record_count"] == 2
    assert silver_rows(spark, lake) == rebuilt_rows(spark, lake, run)[0]


def test_without_rows_after_a_rebuild_and_with_lost_files(spark, tmp_path, run):
    lake = Lake(str(tmp_path / "lake"))
    load(spark, lake, tmp_path, [], run)
    assert clean_new(spark, lake, POLICIES, run, 8)["record_count"] == 0
    assert read_silver(spark, lake, "policies").count() == 0
    load(spark, lake, tmp_path, ["P1,C1,auto,10,x,2024-01-01", "P2,C1,auto,11,x,2024-01-01"], run)
    assert clean_new(spark, lake, POLICIES, run, 8)["cleaned_count"] == 2
    clean(spark, lake, POLICIES, run)
    assert clean_new(spark, lake, POLICIES, run, 8)["rewritten_buckets"] == 2
    assert clean_new(spark, lake, POLICIES, run, 8, everything=True)["cleaned_count"] == 2
    assert silver_rows(spark, lake) == rebuilt_rows(spark, lake, run)[0]
    next(Path(lake.path("bronze", "policies")).rglob("*.parquet")).unlink()
    with pytest.raises(ValueError, match="lost files"):
        clean_new(spark, lake, POLICIES, run, 8)
    with pytest.raises(ValueError, match="clean"):
        clean_new(spark, Lake(lake.root, "parquet", "db"), POLICIES, run)
