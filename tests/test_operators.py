import datetime as dt
import random
from contextlib import contextmanager
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from smelter.entities import CLAIMS, ENTITIES
from smelter.functions import bin_time, moment, risk_score, utc_date
from smelter.operators import features, history, joins, monitor, quality
from smelter.operators.dedup import duplicate_keys, latest_per_key
from smelter.operators.lineage import LINEAGE_COLUMNS, add_lineage
from smelter.session import Run, scratch_dir, shuffle_partitions_for
from smelter.sources import extract_fields, read_event_array, read_raw_csv, type_fields
from tests.samples import event_objects

UTC = dt.timezone.utc


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- sources ----------------------------------------------------------------


def test_raw_csv_keeps_everything_as_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,c\n 1 ,"",007\nx\n1,2,3,4\n')
    df = read_raw_csv(spark, str(tmp_path / "a.csv"))
    assert {t for _, t in df.dtypes} == {"string"}
    assert [tuple(r) for r in df.collect()] == [(" 1 ", None, "007"), ("x", None, None), ("1", "2", "3")]


def test_lineage(spark, tmp_path, run):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("x\n1\n2\n")
    df = add_lineage(read_raw_csv(spark, str(tmp_path)), run)
    assert tuple(df.columns) == ("x", *LINEAGE_COLUMNS)
    rows = df.collect()
    assert {r.ingestion_timestamp for r in rows} == {run.ts.replace(tzinfo=None)}
    assert {r.ingestion_date for r in rows} == {run.ts.date()}
    assert {(r.process_id, r.source_system) for r in rows} == {("run-1", "legacy_csv")}
    assert {r.source_file_name.rsplit("/", 1)[1] for r in rows} == {"a.csv", "b.csv"}
    assert Run().process_id != Run().process_id


def test_event_array(spark, tmp_path):
    import json

    (tmp_path / "e.json").write_text(json.dumps(event_objects(), indent=1))
    df = read_event_array(spark, str(tmp_path / "e.json"), "claim_id string, claim_amount decimal(28,8)")
    assert df.count() == 5 and str(df.agg(F.max("claim_amount")).first()[0]) == "120000.00000000"


def test_event_fields(spark):
    documents = ['{"id": "a", "amount": 123456789012345678.12345678, "who": {"name": "x"}, "more": 1}',
                 '{"id": 5, "amount": "12.5"}', '{"amount": "abc", "who": 1}', "{broken", None]
    fields = (("id", "$.id", "string"), ("amount", "$.amount", "decimal"), ("name", "$.who.name", "string"))
    df = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "n int, value string")
    got = {r.n: (r.id, str(r.amount) if r.amount is not None else None, r.name)
           for r in type_fields(extract_fields(df, fields), fields).collect()}
    assert got == {
        0: ("a", "123456789012345678.12345678", "x"), 1: ("5", "12.50000000", None),
        2: (None, None, None), 3: (None, None, None), 4: (None, None, None)}
    as_bytes = extract_fields(df.withColumn("value", F.col("value").cast("binary")), fields)
    assert as_bytes.where("name = 'x'").count() == 1
    for bad in ((("a", "id", "string"),), (("a", "$.x[0]", "string"),), (("a", "$.x", "string"), ("b", "$.x.y", "string"))):
        with pytest.raises(ValueError):
            extract_fields(df, bad)
    with pytest.raises(ValueError):
        type_fields(extract_fields(df, fields), (("id", "$.id", "text"),))


# --- quality ----------------------------------------------------------------


def test_null_audit_is_one_pass(spark):
    df = spark.createDataFrame([(None, "p", None), ("c", None, None), ("d", "p", "1")],
                               "claim_id string, policy_id string, claim_amount string")
    full = df.withColumns({c: F.lit("x") for c in ("claim_date", "claim_status", "claim_type")})
    audit = quality.null_audit(full, CLAIMS.raw)
    assert {tuple(r) for r in audit.collect()} == {("claim_id", 1), ("policy_id", 1), ("claim_amount", 2)}
    with pytest.raises(ValueError, match="claim_date"):
        quality.check_columns(df, CLAIMS.raw)


def test_dq_metrics_of_an_empty_table(spark):
    df = spark.createDataFrame([], "claim_id string, policy_id string, claim_amount string, claim_date string")
    row = quality.dq_metrics(df, CLAIMS.typed, "claim_id").first()
    assert (row.record_count, row.cleaned_count, row.dropped_count, row.pass_rate) == (0, 0, 0, 0.0)


# --- dedup ------------------------------------------------------------------


def random_rows(n, keys, seed=7):
    rng = random.Random(seed)
    return [
        (rng.choice([*map(str, range(keys)), None]), rng.randrange(4), rng.choice([None, "a", "b"]), rng.random())
        for _ in range(n)
    ]


def best(rows):
    # NULL is least.
    low = lambda v: (v is not None, v)
    out = {}
    for r in rows:
        rank = tuple(low(v) if v is not None else (False,) for v in (r[1], r[2], r[3]))
        if r[0] not in out or rank > out[r[0]][0]:
            out[r[0]] = (rank, r)
    return {k: v[1] for k, v in out.items()}


@pytest.mark.parametrize("parts", [1, 5])
def test_latest_per_key(spark, parts):
    rows = random_rows(400, 30)
    df = spark.createDataFrame(rows, "k string, ingestion_timestamp int, a string, b double").repartition(parts)
    want = best(rows)
    kept = latest_per_key(df, "k")
    assert kept.columns == df.columns
    assert {r.k: tuple(r) for r in kept.collect()} == want and kept.count() == len(want)
    counted = latest_per_key(df, "k", copies="n")
    assert {r.k: tuple(r)[:4] for r in counted.collect()} == want
    assert counted.agg(F.sum("n")).first()[0] == 400
    twice = {r.k: r["count"] for r in duplicate_keys(df, "k").collect()}
    assert twice == {k: n for k, n in ((k, sum(r[0] == k for r in rows)) for k in want) if n > 1}


def test_dedup_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame(random_rows(10, 3), "k string, ingestion_timestamp int, a string, b double")
    text = plan(latest_per_key(df, "k"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert "partial_max" in plan(latest_per_key(df, "k", copies="n"))


def test_dedup_of_key_columns_only(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k string")
    assert latest_per_key(df, "k").count() == 2
    assert sorted(r.n for r in latest_per_key(df, "k", copies="n").collect()) == [2, 2]


# --- joins ------------------------------------------------------------------


def facts_with_a_frequent_key(spark, n=3000):
    # A third one key, a third no key.
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, (F.col("id") % 100).cast("string"))
    return spark.range(n).select(F.col("id").alias("fact"), key.alias("customer_id"))


@pytest.mark.parametrize("broadcast_limit", ["10MB", "-1"])
def test_split_join_is_complete(spark, broadcast_limit):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": broadcast_limit}):
        facts = facts_with_a_frequent_key(spark)
        per_key = facts.where("customer_id is not null and customer_id <> '7'").groupBy("customer_id").count()
        want = sorted(map(tuple, facts.join(per_key, "customer_id", "left").collect()), key=str)
        for rows_per_piece in (100, 5, 10**9):
            joined = joins.left_join_features(facts, per_key, "customer_id", rows_per_piece)
            assert joined.columns == ["customer_id", "fact", "count"]
            assert sorted(map(tuple, joined.collect()), key=str) == want


def test_split_join_spreads_the_frequent_key(spark):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        facts = facts_with_a_frequent_key(spark, 30_000)
        per_key = facts.where("customer_id is not null").groupBy("customer_id").count()

        def largest_task(df):
            sizes = df.groupBy(F.spark_partition_id()).count()
            return sizes.agg(F.max("count")).first()[0]

        spread = joins.left_join_features(facts, per_key, "customer_id", rows_per_piece=500)
        assert largest_task(spread) < 30_000 / 8 * 2
        assert "Cartesian" not in plan(spread) and "NestedLoop" not in plan(spread)
        equal = spark.createDataFrame([("7", "same")] * 1000, "customer_id string, fact string").repartition(4)
        parted = joins.left_join_features(equal, per_key, "customer_id", rows_per_piece=10)
        assert parted.count() == 1000 and largest_task(parted) < 400


def test_adaptive_execution_splits_the_frequent_key(spark, tmp_path):
    facts, per_key = str(tmp_path / "facts"), str(tmp_path / "features")
    wide = facts_with_a_frequent_key(spark, 60_000).withColumn("filler", F.sha2(F.col("fact").cast("string"), 512))
    wide.repartition(16).write.parquet(facts)
    wide.where("customer_id is not null").groupBy("customer_id").count().write.parquet(per_key)
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
    }
    with settings(spark, low):
        joined = joins.left_join_features(spark.read.parquet(facts), spark.read.parquet(per_key), "customer_id")
        rows = joined.collect()
        text = joined._jdf.queryExecution().executedPlan().toString()
    final = text[text.index("Final Plan") : text.index("Initial Plan")]
    assert "skew=true" in final and final.count("/facts]") == 1 and final.count("Exchange hashpartitioning") == 2
    assert len(rows) == 60_000 and {r["count"] for r in rows if r.customer_id == "hot"} == {20_000}
    assert {r["count"] for r in rows if r.customer_id is None} == {None}


# --- gold -------------------------------------------------------------------


def test_claims_without_customer_form_a_group(spark):
    claims = spark.createDataFrame([("a", None, 5.0), ("b", None, 7.0), (None, "c", 1.0)],
                                   "claim_id string, customer_id string, claim_amount double")
    got = {r.customer_id: tuple(r)[1:] for r in features.claims_features(claims).collect()}
    assert got == {None: (2, 12.0, 6.0, 7.0), "c": (0, 1.0, 1.0, 1.0)}
    # They join to nothing.
    policies = spark.createDataFrame([("p", None)], "policy_id string, customer_id string")
    row = features.risk_features(policies, features.claims_features(claims)).first()
    assert row.total_claims is None and row.overall_risk_score == 30.0


def test_risk_tiers_are_strict(spark):
    cases = [(None, None, 30.0), (0, 10000.0, 30.0), (1, 10000.0, 40.0), (1, 10000.01, 60.0), (1, 50000.0, 60.0),
             (1, 50000.01, 80.0), (3, 50000.01, 100.0), (9, 1.0, 100.0), (2, None, 50.0)]
    df = spark.createDataFrame([(c[0], c[1]) for c in cases], "n long, total double")
    scored = df.select(risk_score(F.col("n"), F.col("total")).alias("s"))
    assert [r.s for r in scored.collect()] == [c[2] for c in cases]
    assert dict(scored.dtypes)["s"] == "double"


def test_customers_without_policies_get_zero(spark):
    customers = spark.createDataFrame([("a", None), ("b", "x")], "customer_id string, note string")
    policies = spark.createDataFrame([("p", "a", 10.0, None), ("q", "a", 20.0, "ACTIVE")],
                                     "policy_id string, customer_id string, premium double, status string")
    got = features.customer_features(customers, features.policy_features(policies))
    assert sorted(map(tuple, got.collect())) == [("a", None, 2, 1, 15.0, 30.0), ("b", "x", 0, 0, 0.0, 0.0)]


def test_monthly_summary_takes_current_rows(spark):
    df = spark.sql("""SELECT * FROM VALUES ('a', date'2024-03-15', 5D, true), ('b', date'2024-03-01', 7D, true),
                      ('c', date'2024-03-01', 9D, false), ('d', date'2023-12-31', 1D, true)
                      AS t(claim_id, claim_date, claim_amount, is_current)""")
    got = [tuple(r) for r in features.monthly_summary(df).collect()]
    assert got == [(dt.datetime(2023, 12, 1), 2023, 12, 1, 1.0, 1.0, 1.0, 1.0, 1),
                   (dt.datetime(2024, 3, 1), 2024, 3, 2, 12.0, 6.0, 7.0, 5.0, 2)]
    assert features.preview(features.monthly_summary(df), rows=1).count() == 1


# --- events -----------------------------------------------------------------


def events(spark, rows):
    return spark.createDataFrame(
        [("id", "p", c, a, s, t) for c, a, s, t in rows],
        "claim_id string, policy_id string, customer_id string, claim_amount string, claim_status string, t string",
    ).select("claim_id", "policy_id", "customer_id", F.col("claim_amount").cast("decimal(28,8)"), "claim_status",
             F.to_timestamp("t").alias("event_timestamp"))


def test_hourly_claims(spark):
    df = events(spark, [("a", "1", "s", "2025-01-15 10:59:59.999"), ("a", None, "s", "2025-01-15 10:00:00"),
                        ("a", "4", "s", "2025-01-15 11:00:00"), ("a", None, "s", "2025-01-15 12:00:00")])
    got = {r.event_timestamp.hour: (r.claims_count, r.total_amount, r.avg_amount, r.max_amount)
           for r in monitor.hourly_claims(df).collect()}
    assert {h: (v[0], *(float(x) if x is not None else None for x in v[1:])) for h, v in got.items()} == {
        10: (2, 1.0, 1.0, 1.0), 11: (1, 4.0, 4.0, 4.0), 12: (1, None, None, None)}
    types = dict(monitor.hourly_claims(df).dtypes)
    assert types["total_amount"] == "decimal(38,8)" and types["avg_amount"] == "decimal(32,12)"


def test_bins_do_not_depend_on_the_zone(spark):
    for zone in ("UTC", "Asia/Kolkata", "Australia/Lord_Howe"):
        with settings(spark, {"spark.sql.session.timeZone": zone}):
            row = spark.sql("SELECT timestamp'1969-12-31T23:30:00Z' t").select(F.unix_seconds(bin_time(F.col("t")))).first()
            assert row[0] == -3600


def test_instants_do_not_depend_on_zones(spark):
    eastern = dt.timezone(dt.timedelta(hours=-5))
    same = [dt.datetime(2025, 1, 15, 11), dt.datetime(2025, 1, 15, 11, tzinfo=UTC),
            dt.datetime(2025, 1, 15, 6, tzinfo=eastern)]
    with settings(spark, {"spark.sql.session.timeZone": "Asia/Tokyo"}):
        row = spark.range(1).select(*[F.unix_seconds(moment(t)) for t in same],
                                    F.unix_seconds(Run(same[0]).ts_column), utc_date(moment(same[0])).cast("string")).first()
    assert set(row[:4]) == {1736938800} and row[4] == "2025-01-15"
    assert spark.range(1).select(utc_date(moment(dt.datetime(1969, 12, 31, 23))).cast("string")).first()[0] == "1969-12-31"


def test_look_back_is_strict(spark):
    as_of = dt.datetime(2025, 1, 15, 11, tzinfo=UTC)
    df = events(spark, [("a", "60000", "x", "2025-01-15 10:00:00"), ("b", "60000", "X", "2025-01-15 10:00:00.000001"),
                        ("c", "50000", "x", "2025-01-15 10:30:00"), ("d", "70000", "x", "2025-01-15 10:40:00"),
                        ("e", None, None, "2025-01-15 10:50:00")])
    alerts = monitor.high_value_alerts(df, as_of)
    assert alerts.columns == list(monitor.ALERT_COLUMNS)
    assert [r.customer_id for r in alerts.collect()] == ["d", "b"]
    counts = {r.claim_status: r["count_"] for r in monitor.status_counts(df, as_of, dt.timedelta(hours=1)).collect()}
    assert counts == {"X": 1, "x": 2, None: 1}
    # Without an instant, now: these events are long past.
    assert monitor.status_counts(df).count() == 0


def test_look_back_reaches_the_scan(spark, tmp_path):
    df = events(spark, [("a", "60000", "x", f"2025-01-{d:02d} 10:00:00") for d in range(1, 20)])
    path = str(tmp_path / "events")
    df.withColumn("event_date", F.to_date("event_timestamp")).write.partitionBy("event_date").parquet(path)
    alerts = monitor.high_value_alerts(spark.read.parquet(path), dt.datetime(2025, 1, 19, 10, 30, tzinfo=UTC))
    text = plan(alerts)
    assert "PushedFilters: [IsNotNull(event_timestamp), IsNotNull(claim_amount), GreaterThan(event_timestamp" in text
    assert "PartitionFilters: [isnotnull(event_date" in text and "event_date#" in text
    assert alerts.count() == 1
    live = plan(monitor.high_value_alerts(spark.read.parquet(path)))
    assert "GreaterThan(event_timestamp" in live and "PartitionFilters: [isnotnull(event_date" in live


# --- history ----------------------------------------------------------------


def brute_history(rows):
    """rows: (key, time, state)"""
    low = lambda v: (v is not None, v or "")
    out = []
    for key in {r[0] for r in rows}:
        newest = {}
        for _, t, s in (r for r in rows if r[0] == key and r[1] is not None):
            newest[t] = max(newest.get(t, s), s, key=low) if t in newest else s
        starts = []
        for t in sorted(newest):
            if not starts or starts[-1][1] != newest[t]:
                starts.append((t, newest[t]))
        ends = [t for t, _ in starts[1:]] + [None]
        out += [(key, s, t, end, end is None) for (t, s), end in zip(starts, ends)]
    return sorted(out, key=str)


@pytest.mark.parametrize("rows_per_piece", [10**9, 100, 1])
def test_history_against_brute_force(spark, rows_per_piece):
    rng = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for _ in range(1500):
        # One key holds a third of the rows, no key another part.
        key = rng.choice(["hot", "hot", None, *map(str, range(3))])
        time = None if rng.random() < 0.02 else base + dt.timedelta(minutes=rng.randrange(3000))
        rows.append((key, time, rng.choice(["a", "b", None])))
    df = spark.createDataFrame(rows, "k string, t timestamp, state string")
    got = history.build_history(df, "k", "t", rows_per_piece=rows_per_piece)
    have = [tuple(r) for r in got.select("k", "state", "effective_from", "effective_to", "is_current").collect()]
    assert sorted(have, key=str) == brute_history(rows)


def test_history_as_of_and_current(spark):
    df = spark.createDataFrame([("k", dt.datetime(2024, 1, d), s) for d, s in ((1, "a"), (2, "a"), (3, "b"))],
                               "k string, ingestion_timestamp timestamp, s string")
    versions = history.build_history(df, "k")
    assert [r.s for r in history.current_rows(versions).collect()] == ["b"]
    at = {d: [r.s for r in history.as_of(versions, f"2024-01-{d:02d}").collect()] for d in (1, 2, 3)}
    assert at == {1: ["a"], 2: ["a"], 3: ["b"]}
    assert history.as_of(versions, "2023-12-31").count() == 0


def test_ordinary_history_takes_one_shuffle(spark):
    df = spark.createDataFrame([("k", dt.datetime(2024, 1, 1), "a")] * 3, "k string, ingestion_timestamp timestamp, s string")
    versions = history.build_history(df, "k")
    versions.collect()
    rows = versions._jdf.queryExecution().executedPlan().toString()
    final = rows[rows.index("Final Plan"):rows.index("Initial Plan")]
    assert final.count("Exchange hashpartitioning") == 1 and "Range" not in final


# --- session ----------------------------------------------------------------


def test_sizes():
    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(100 * 1024**3) == 400
    assert shuffle_partitions_for(100 * 1024**4) == 409_600
    assert set(ENTITIES) == {"policies", "claims", "customers", "agents"}


def test_a_cluster_needs_a_shared_folder(spark):
    conf = SimpleNamespace(get=lambda key, default: default)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(cluster, "x")
    local = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="local[2]"))
    assert "x-" in scratch_dir(local, "x")


def test_scratch_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    if root:
        assert first.startswith(root)
