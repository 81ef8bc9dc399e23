"""A history merged batch by batch against the one built at once."""

import datetime as dt
import random
from pathlib import Path

from smelter.plans.history import VERSIONS, merge_history, read_history
from smelter.sources import Lake
from tests.test_operators import brute_history

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "k string, t timestamp, state string"


def files(lake, table):
    return {str(f.relative_to(lake.root)): f.stat().st_mtime_ns for f in Path(lake.path("silver", table)).rglob("*.parquet")}


def intervals(spark, lake):
    rows = read_history(spark, lake, "silver", "h").select("k", "state", "effective_from", "effective_to", "is_current")
    return sorted(map(tuple, rows.collect()), key=str)


def test_increments_equal_the_whole(spark, tmp_path):
    rng = random.Random(5)
    lake, rows = Lake(str(tmp_path)), []
    for batch_id in range(4):
        batch = [
            (rng.choice(["hot", "hot", None, *map(str, range(5))]), BASE + dt.timedelta(minutes=rng.randrange(300)), rng.choice(["a", "b", None]))
            for _ in range(150)
        ]
        batch.append(("hot", None, "a"))
        rows += batch
        for _ in range(2 if batch_id == 1 else 1):  # one batch is played again
            merge_history(spark, lake, "silver", "h", spark.createDataFrame(batch, SCHEMA), batch_id, "k", "t", buckets=4)
        assert intervals(spark, lake) == brute_history(rows)


def test_a_late_version_splits_an_interval(spark, tmp_path):
    lake = Lake(str(tmp_path))
    day = lambda d: BASE + dt.timedelta(days=d)
    for batch_id, batch in enumerate([[("x", day(1), "a"), ("x", day(5), "a"), ("x", day(9), "a")], [("x", day(3), "b")]]):
        merge_history(spark, lake, "silver", "h", spark.createDataFrame(batch, SCHEMA), batch_id, ["k"], "t", ["state"], 8)
    assert [(r[1], r[2], r[3]) for r in intervals(spark, lake)] == [
        ("a", day(1), day(3)), ("a", day(5), None), ("b", day(3), day(5)),
    ]


def test_only_touched_buckets_are_written(spark, tmp_path):
    lake = Lake(str(tmp_path))
    first = [(str(k), BASE + dt.timedelta(days=d), str(d)) for k in range(60) for d in range(3)]
    every = merge_history(spark, lake, "silver", "h", spark.createDataFrame(first, SCHEMA), 0, "k", "t", buckets=16)
    assert len(every) > 8
    before, versions = files(lake, "h"), files(lake, "h" + VERSIONS)
    touched = merge_history(spark, lake, "silver", "h", spark.createDataFrame([("7", BASE, "new")], SCHEMA), 1, "k", "t", buckets=16)
    assert len(touched) == 1
    after = files(lake, "h")
    here = f"key_bucket={touched[0]}/"
    kept = {f for f in before if here not in f}
    assert kept == {f for f in after if here not in f} and all(before[f] == after[f] for f in kept)
    assert not {f for f in before if here in f} & set(after)
    assert all(files(lake, "h" + VERSIONS)[f] == at for f, at in versions.items())
    empty = merge_history(spark, lake, "silver", "h", spark.createDataFrame([], SCHEMA), 2, "k", "t", buckets=16)
    assert empty == [] and files(lake, "h") == after
