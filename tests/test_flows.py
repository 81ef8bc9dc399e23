"""Whole flows on the sample tables."""

import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from smelter.entities import ENTITIES, POLICIES
from smelter.operators.features import claims_features, monthly_summary
from smelter.operators.history import as_of
from smelter.operators.monitor import high_value_alerts, status_counts
from smelter.plans.batch import clean, ingest, repeated_keys, run_batch
from smelter.plans.realtime import run_realtime
from smelter.session import Run
from smelter.sources import Lake
from tests.samples import EVENT_FIELDS, TABLES, event_objects, write_tables

UTC = dt.timezone.utc


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_batch_run_gives_the_known_results(spark, lake, tmp_path, run):
    report = run_batch(spark, lake, write_tables(tmp_path), run)
    assert report["bronze_claims"] == {
        "record_count": 12, "null_claim_id": 0, "null_policy_id": 0, "null_claim_amount": 0,
    }
    assert report["silver_claims"]["cleaned_count"] == 12
    assert report["silver_claims"]["pass_rate"] == 100.0
    assert repeated_keys(spark, lake, POLICIES).count() == 0
    assert report["silver_policies"]["repeated_keys"] == 0 and "repeated_keys" not in report["silver_claims"]

    claims = lake.read(spark, "gold", "claims_features")
    measures = ["total_claims", "total_claim_amount", "avg_claim_amount", "max_claim_amount"]
    assert sorted(rows(claims, "customer_id", *measures)) == [
        ("C1", 4, 31950.0, 7987.5, 25000.0),
        ("C2", 2, 20000.0, 10000.0, 15000.0),
        ("C3", 2, 8700.0, 4350.0, 7500.0),
        ("C4", 1, 8000.0, 8000.0, 8000.0),
        ("C5", 1, 2200.0, 2200.0, 2200.0),
        ("C6", 1, 12000.0, 12000.0, 12000.0),
        ("C7", 1, 1800.0, 1800.0, 1800.0),
    ]
    customers = lake.read(spark, "gold", "customer_features")
    got = rows(customers, "customer_id", "total_policies", "active_policies", "avg_premium", "total_premium")
    assert sorted(got, key=lambda r: int(r[0][1:])) == [
        ("C1", 2, 2, 3100.25, 6200.5),
        ("C2", 2, 2, 3500.0, 7000.0),
        ("C3", 2, 2, 1540.0, 3080.0),
        ("C4", 1, 1, 1850.0, 1850.0),
        ("C5", 1, 0, 1100.0, 1100.0),
        ("C6", 1, 1, 3200.0, 3200.0),
        ("C7", 1, 1, 1350.0, 1350.0),
        ("C8", 0, 0, 0.0, 0.0),
        ("C9", 0, 0, 0.0, 0.0),
        ("C10", 0, 0, 0.0, 0.0),
    ]
    risk = lake.read(spark, "gold", "risk_features")
    assert dict(rows(risk, "policy_id", "overall_risk_score")) == {
        "P1": 90.0, "P2": 70.0, "P3": 50.0, "P4": 90.0, "P5": 40.0,
        "P6": 40.0, "P7": 70.0, "P8": 60.0, "P9": 40.0, "P10": 50.0,
    }
    # Columns outside the contract stay, as strings; one timestamp, the run's.
    types = dict(risk.dtypes)
    assert types["coverage_amount"] == "string" and types["end_date"] == "string"
    assert risk.columns[0] == "customer_id" and risk.columns.count("feature_timestamp") == 1
    monthly = lake.read(spark, "gold", "monthly_claims_summary").orderBy("claim_year_month")
    assert monthly.columns == [
        "claim_year_month", "claim_year", "claim_month", "total_claims", "total_claim_amount",
        "avg_claim_amount", "max_claim_amount", "min_claim_amount", "claim_count", "feature_timestamp",
    ]
    got = rows(monthly, "claim_month", "total_claims", "total_claim_amount", "avg_claim_amount",
               "max_claim_amount", "min_claim_amount")
    assert got == [
        (3, 1, 2500.0, 2500.0, 2500.0, 2500.0),
        (4, 1, 15000.0, 15000.0, 15000.0, 15000.0),
        (5, 1, 1200.0, 1200.0, 1200.0, 1200.0),
        (6, 2, 11500.0, 5750.0, 8000.0, 3500.0),
        (7, 2, 13800.0, 6900.0, 12000.0, 1800.0),
        (8, 2, 30000.0, 15000.0, 25000.0, 5000.0),
        (9, 3, 10650.0, 3550.0, 7500.0, 950.0),
    ]
    assert rows(lake.read(spark, "silver", "agents").where("agent_id = 'A7'"),
                "name", "agent_type", "status") == [("Office 7", "KIND 1", "AWAY")]


def test_second_run_appends_bronze_and_refreshes_silver(spark, lake, tmp_path, run):
    paths = write_tables(tmp_path, {"policies": [
        "policy_id,customer_id,product_type,premium,status,start_date", "P1,C1,auto,10,  active ,2024-01-01"]})
    ingest(spark, lake, POLICIES, paths["policies"], run)
    later = Run(run.ts + dt.timedelta(days=1), "run-2")
    paths = write_tables(tmp_path, {"policies": [
        "policy_id,customer_id,product_type,premium,status,start_date,channel",
        "P1,C1,auto,20,closed,2024-02-30,web", "P2,C1,auto,abc,x,2024-01-01,web", "P3,,auto,5,x,,"]})
    counts = ingest(spark, lake, POLICIES, paths["policies"], later)
    assert counts == {"record_count": 3, "null_policy_id": 0, "null_customer_id": 1}
    bronze = lake.read(spark, "bronze", "policies", merge_schema=True)
    assert bronze.count() == 4 and "channel" in bronze.columns
    assert {r[0] for r in bronze.select("process_id").distinct().collect()} == {"run-1", "run-2"}
    assert bronze.where("source_file_name not like '%/policies.csv'").count() == 0
    metrics = clean(spark, lake, POLICIES, later)
    assert {k: metrics[k] for k in ("record_count", "duplicate_count", "invalid_count", "cleaned_count",
                                    "dropped_count", "pass_rate", "failed_premium_not_null",
                                    "failed_customer_id_not_null")} == {
        "record_count": 4, "duplicate_count": 1, "invalid_count": 2, "cleaned_count": 1,
        "dropped_count": 3, "pass_rate": 25.0, "failed_premium_not_null": 1, "failed_customer_id_not_null": 1}
    silver = lake.read(spark, "silver", "policies")
    assert rows(silver, "policy_id", "premium", "status", "start_date", "is_current", "effective_from") == [
        ("P1", 20.0, "CLOSED", None, True, later.ts.replace(tzinfo=None))]


def test_validate_first_keeps_the_valid_twin(spark, lake, tmp_path, run):
    header = "policy_id,customer_id,product_type,premium,status,start_date"
    paths = write_tables(tmp_path, {"policies": [header, "P1,C1,a,10,x,2024-01-01"]})
    ingest(spark, lake, POLICIES, paths["policies"], run)
    paths = write_tables(tmp_path, {"policies": [header, "P1,C1,a,broken,x,2024-01-01"]})
    ingest(spark, lake, POLICIES, paths["policies"], Run(run.ts + dt.timedelta(days=1)))
    assert clean(spark, lake, POLICIES, run)["cleaned_count"] == 0
    assert clean(spark, lake, POLICIES, run, order="validate_first")["cleaned_count"] == 1
    assert rows(lake.read(spark, "silver", "policies"), "premium") == [(10.0,)]


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_a_first_run_without_claims(spark, tmp_path, run, fmt):
    lake = Lake(str(tmp_path / "lake"), fmt)
    tables = {name: lines if name != "claims" else lines[:1] for name, lines in TABLES.items()}
    report = run_batch(spark, lake, write_tables(tmp_path, tables), run)
    assert report["bronze_claims"]["record_count"] == 0
    assert report["silver_claims"]["pass_rate"] == 0.0
    assert lake.read(spark, "gold", "claims_features").count() == 0
    risk = lake.read(spark, "gold", "risk_features")
    assert risk.count() == 10 and risk.where("overall_risk_score = 30 and total_claims is null").count() == 10
    # The next day has some.
    later = Run(run.ts + dt.timedelta(days=1), "run-2")
    assert run_batch(spark, lake, write_tables(tmp_path), later)["silver_claims"]["cleaned_count"] == 12


def test_claims_edges(spark, lake, tmp_path, run):
    amounts = {"a": "abc", "b": "", "c": "0", "d": "-5", "e": "1e2", "f": "10"}
    lines = [f"{k},P,{v},2024-01-01,x,y" for k, v in amounts.items()]
    lines += ["g,P,10,2024-02-30,x,y", ",P,10,2024-01-01,x,y", ",P,11,2024-01-01,x,y", "h,,10,2024-01-01,x,y"]
    paths = write_tables(tmp_path, {
        "claims": ["claim_id,policy_id,claim_amount,claim_date,claim_status,claim_type", *lines]})
    assert ingest(spark, lake, ENTITIES["claims"], paths["claims"], run) == {
        "record_count": 10, "null_claim_id": 2, "null_policy_id": 1, "null_claim_amount": 1}
    metrics = clean(spark, lake, ENTITIES["claims"], run)
    assert (metrics["record_count"], metrics["duplicate_count"], metrics["cleaned_count"]) == (10, 1, 2)
    got = rows(lake.read(spark, "silver", "claims").orderBy("claim_id"), "claim_id", "claim_amount")
    assert got == [("e", 100.0), ("f", 10.0)]


def test_orc_lake(spark, tmp_path, run):
    lake = Lake(str(tmp_path / "lake"), fmt="orc")
    run_batch(spark, lake, write_tables(tmp_path), run)
    assert lake.read(spark, "gold", "risk_features").where("overall_risk_score = 90").count() == 2
    write_events(tmp_path / "events", "1.json", event_objects())
    assert run_realtime(spark, lake, str(tmp_path / "events"))["cleaned_count"] == 5
    assert lake.read(spark, "silver", "claims_realtime").count() == 5


def test_gold_reads_only_what_it_needs(spark, lake, tmp_path, run):
    run_batch(spark, lake, write_tables(tmp_path), run)

    def scan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    claims = lake.read(spark, "silver", "claims")
    assert "ReadSchema: struct<claim_id:string,customer_id:string,claim_amount:double>" in scan(claims_features(claims))
    monthly = scan(monthly_summary(claims))
    assert "EqualTo(is_current,true)" in monthly
    assert "ReadSchema: struct<claim_id:string,claim_date:date,claim_amount:double,is_current:boolean>" in monthly
    for text in (scan(claims_features(claims)), monthly):
        assert "partial_count" in text and "Python" not in text


def test_missing_column_stops_before_the_write(spark, lake, tmp_path, run):
    paths = write_tables(tmp_path, {"claims": ["claim_id,policy_id", "1,2"]})
    with pytest.raises(ValueError, match="claim_amount"):
        ingest(spark, lake, ENTITIES["claims"], paths["claims"], run)
    assert not (tmp_path / "lake").exists()
    # No contract, no check.
    assert ingest(spark, lake, replace(ENTITIES["claims"], raw=None), paths["claims"], run) == {"record_count": 1}


def test_descriptions_reach_the_catalog(spark, tmp_path, run):
    spark.sql("CREATE DATABASE IF NOT EXISTS smelter_test")
    lake = Lake(str(tmp_path / "lake"), database="smelter_test")
    for text in ("First's text", "Second \\ text"):
        lake.overwrite(spark.range(3), "gold", "numbers", text)
        assert spark.catalog.getTable("smelter_test.gold_numbers").description == text
    assert spark.table("smelter_test.gold_numbers").count() == 3
    spark.sql("DROP TABLE smelter_test.gold_numbers")


def write_events(folder, name, objects):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(o if isinstance(o, str) else json.dumps(o) for o in objects) + "\n")


def test_realtime_run(spark, lake, tmp_path):
    events = tmp_path / "events"
    write_events(events, "1.json", [*event_objects(), "{not json"])
    as_of_ts = dt.datetime(2025, 1, 15, 11, 0, tzinfo=UTC)
    counts = run_realtime(spark, lake, str(events), as_of=as_of_ts)
    assert counts == {"record_count": 6, "cleaned_count": 5, "dropped_count": 1, "late_count": 0, "pass_rate": 5 / 6 * 100}

    typed = lake.read(spark, "events", "claims_events")
    assert typed.count() == 6 and typed.where("claim_id is null").count() == 1
    assert dict(typed.dtypes)["claim_amount"] == "decimal(28,8)"
    assert rows(high_value_alerts(typed, as_of_ts), "claim_id") == [("CLM-RT-004",), ("CLM-RT-002",)]
    assert dict(rows(status_counts(typed, as_of_ts), "claim_status", "count_")) == {
        "SUBMITTED": 2, "APPROVED": 1, "UNDER_REVIEW": 1, "PAID": 1}
    bronze = lake.read(spark, "bronze", "claims_events")
    assert bronze.count() == 6 and dict(bronze.dtypes)["claim_amount"] == "string"

    silver = lake.read(spark, "silver", "claims_realtime")
    assert silver.count() == 5
    assert dict(silver.dtypes)["claim_type"] == "string" and silver.where("claim_type is not null").count() == 0
    assert silver.where("effective_from <> event_timestamp or not is_current").count() == 0
    gold = lake.read(spark, "gold", "realtime_claims_features")
    assert gold.count() == 5 and gold.where("claims_count = 1").count() == 5
    assert gold.select(F.min("event_timestamp")).first()[0] == dt.datetime(2025, 1, 15, 10)
    assert set(gold.columns) == {
        "customer_id", "event_timestamp", "claims_count", "total_amount", "avg_amount", "max_amount", "sync_timestamp"}

    # Again, with nothing new and then with a known and a new claim.
    assert run_realtime(spark, lake, str(events), as_of=as_of_ts)["record_count"] == 0
    assert lake.read(spark, "silver", "claims_realtime").count() == 5
    again = dict(zip(EVENT_FIELDS, ("CLM-RT-001", "P", "CUST-001", 1.0, " paid ", "2025-01-15T10:59:59.999Z")))
    fresh = dict(zip(EVENT_FIELDS, ("CLM-RT-006", "P", "CUST-001", 2.0, " paid ", "2025-01-15T11:00:00Z")))
    write_events(events, "2.json", [again, fresh])
    run_realtime(spark, lake, str(events), as_of=as_of_ts)
    silver = lake.read(spark, "silver", "claims_realtime")
    assert silver.count() == 6
    assert rows(silver.where("claim_id = 'CLM-RT-006'"), "claim_status") == [("PAID",)]
    gold = lake.read(spark, "gold", "realtime_claims_features").where("customer_id = 'CUST-001'")
    assert sorted(rows(gold, F.hour("event_timestamp"), "claims_count")) == [(10, 2), (11, 1)]
    assert as_of(silver, dt.datetime(2025, 1, 15, 10, 35, tzinfo=UTC)).count() == 2
