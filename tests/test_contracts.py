import json

import pytest
from pyspark.sql import functions as F

from smelter import contracts
from smelter.contracts import ColumnRule, ColumnSpec, Contract, load_contract, parse_contract
from smelter.entities import CUSTOMERS, POLICIES, REALTIME_CLAIMS
from smelter.functions.casts import cast_lenient
from smelter.operators.conform import compile_contract, conform

DOC = {
    "table_name": "silver_things",
    "business_columns": [
        {"name": "id", "type": "string", "nullable": False},
        {"name": "n", "type": "integer", "nullable": True, "validation": [
            {"rule": "greater_than", "value": 0}, {"rule": "less_than", "value": 120}]},
        {"name": "s", "type": "string", "nullable": True, "transformation": "upper_trim"},
    ],
    "technical_columns": [{"name": "ignored"}],
    "event_columns": [{"name": "at", "type": "timestamp"}],
    "scd_columns": ["effective_from"],
}


def test_parse_typed_and_raw():
    c = parse_contract(DOC)
    assert c.names == ["id", "n", "s", "at"] and c.mandatory == ["id"]
    assert c.columns[1].rules == (ColumnRule("greater_than", 0), ColumnRule("less_than", 120))
    raw = parse_contract({"required_columns": [{"name": "a", "nullable": False}, {"name": "b", "nullable": True}]})
    assert raw.names == ["a", "b"] and raw.mandatory == ["a"]


@pytest.mark.parametrize(
    "change",
    [
        {"name": "x", "type": "int", "nullable": True},
        {"name": "x", "type": "string", "nullable": True, "transformation": "lower"},
        {"name": "x", "type": "double", "nullable": True, "validation": [{"rule": "equals", "value": 1}]},
        {"name": "x", "type": "string"},
        {"name": "x", "nullable": True},
        {"name": "id", "type": "string", "nullable": True},
    ],
)
def test_unknown_or_missing_keywords_are_errors(change):
    with pytest.raises(ValueError):
        parse_contract({**DOC, "business_columns": [*DOC["business_columns"], change]})


def test_event_columns_take_no_rules():
    with pytest.raises(ValueError):
        parse_contract({**DOC, "event_columns": [{"name": "at", "type": "timestamp", "validation": []}]})
    with pytest.raises(ValueError):
        parse_contract({"table_name": "nothing"})


def test_load_contract(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(DOC))
    assert load_contract(spark, str(tmp_path / "c.json")) == parse_contract(DOC)
    if contracts.yaml is not None:
        (tmp_path / "c.yml").write_text(contracts.yaml.safe_dump(DOC))
        assert load_contract(spark, str(tmp_path / "c.yml")) == parse_contract(DOC)
    assert load_contract(spark, str(tmp_path / "none.yml"), on_missing="skip") is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_contract(spark, str(tmp_path / "none.yml"))


# What the non-ANSI casts of a string give.
INTEGERS = {
    "35.7": 35, "-0.9": 0, ".5": 0, "1e3": None, "99999999999": None, "2147483647": 2147483647, "2147483648": None,
    " 7 ": 7, "\t7": 7, "+7": 7, "7.": 7, "": None, "abc": None, "1 2": None, "0x1F": None, "NaN": None,
    "1234567890123456789012345678901234567890": None,
}
DOUBLES = {"1e3": 1000.0, "abc": None, "": None, " 2.5 ": 2.5, "-5": -5.0, "Infinity": float("inf"), "1,000": None}
DATES = {
    "2024-02-30": None, "2024-02-29": "2024-02-29", "2024": "2024-01-01", "2024-3-1": "2024-03-01",
    "2024-03-01T10:00:00": "2024-03-01", "01/02/2024": None, "": None,
}
TIMESTAMPS = {
    "2025-01-15T10:30:00Z": "2025-01-15 10:30:00", "2025-01-15T10:30:00+02:00": "2025-01-15 08:30:00",
    "2025-01-15": "2025-01-15 00:00:00", "later": None,
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for kind, cases in (("integer", INTEGERS), ("double", DOUBLES), ("date", DATES), ("timestamp", TIMESTAMPS)):
            df = spark.createDataFrame([(k,) for k in cases], "s string")
            out = df.select("s", cast_lenient(F.col("s"), kind, df.schema["s"].dataType).alias("v"))
            if kind in ("date", "timestamp"):
                out = out.withColumn("v", F.col("v").cast("string"))
            assert {r.s: r.v for r in out.collect()} == cases, kind
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_casts_of_typed_columns(spark):
    df = spark.sql("SELECT 35.7D d, timestamp'2024-03-01 10:00:00' t, 12.5BD m")
    types = {f.name: f.dataType for f in df.schema}
    row = df.select(
        cast_lenient(F.col("d"), "integer", types["d"]).alias("i"),
        cast_lenient(F.col("t"), "date", types["t"]).cast("string").alias("day"),
        cast_lenient(F.col("m"), "double", types["m"]).alias("x"),
    ).first()
    assert tuple(row) == (35, "2024-03-01", 12.5)


def test_conform_edges_of_customers(spark):
    ages = ["35.7", "1e3", "0", "120", "119", "0.9", None, "abc"]
    df = spark.createDataFrame([(f"c{i}", a, " m ", " Rome ", "x") for i, a in enumerate(ages)],
                               "customer_id string, age string, gender string, location string, email string")
    kept = conform(df, CUSTOMERS.typed)
    assert {r.customer_id: (r.age, r.gender, r.location, r.email) for r in kept.collect()} == {
        "c0": (35, "M", "Rome", "x"), "c4": (119, "M", "Rome", "x")}
    # join_date is contracted and absent: a NULL date.
    assert dict(kept.dtypes)["join_date"] == "date"


def test_trim_strips_spaces_only(spark):
    df = spark.createDataFrame([("p", "c", "1", "  active ", None, None), ("q", "c", "1", "\tactive", None, None)],
                               "policy_id string, customer_id string, premium string, status string, "
                               "product_type string, start_date string")
    assert [r.status for r in conform(df, POLICIES.typed).orderBy("policy_id").collect()] == ["ACTIVE", "\tACTIVE"]


def test_rule_on_null_drops_even_if_nullable(spark):
    rules = Contract("t", (ColumnSpec("v", "double", rules=(ColumnRule("greater_than", 0),)),))
    df = spark.createDataFrame([(None,), ("1",), ("NaN",), ("0",)], "v string")
    assert conform(df, rules).count() == 2  # 1 and NaN


def test_missing_mandatory_column(spark):
    with pytest.raises(ValueError, match="claim_amount"):
        compile_contract(REALTIME_CLAIMS, spark.createDataFrame([], "claim_id string, policy_id string, "
                                                                    "event_timestamp string").schema)


def test_column_names_with_dots(spark):
    rules = Contract("t", (ColumnSpec("a.b", "integer", nullable=False),))
    df = spark.createDataFrame([("1", "x"), ("y", "z")], ["a.b", "c"])
    assert [tuple(r) for r in conform(df, rules).collect()] == [(1, "x")]


def test_letter_case_does_not_hide_a_column(spark):
    df = spark.createDataFrame([("a", "1", "x")], "Claim_ID string, AMOUNT string, Status string")
    rules = Contract("t", (ColumnSpec("claim_id", nullable=False), ColumnSpec("amount", "double"),
                           ColumnSpec("status", transform="upper_trim")))
    assert conform(df, rules).first().asDict() == {"claim_id": "a", "amount": 1.0, "status": "X"}


def test_conform_is_one_projection_and_idempotent(spark):
    df = spark.createDataFrame([(f"c{i}", str(i), "m", "r", "2024-01-01") for i in range(50)],
                               "customer_id string, age string, gender string, location string, join_date string")
    once = conform(df, CUSTOMERS.typed)
    assert sorted(conform(once, CUSTOMERS.typed).collect()) == sorted(once.collect())
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter") <= 2 and plan.count("Project") <= 2
