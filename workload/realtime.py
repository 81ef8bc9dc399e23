"""Queries over whole real-time runs: events arrive in files, over several runs and micro-batches."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.contracts import load_contract
from smelter.operators import quality
from smelter.operators.monitor import TIME
from smelter.plans import run_realtime
from smelter.plans.realtime import GOLD, SILVER
from smelter.session import scratch_dir
from smelter.sources import Lake, read_event_array
from smelter.streaming import (
    checked_schema,
    earliest_events,
    rows_dropped_late,
    run_pending,
    start_checked,
    start_earliest,
    start_realtime_silver,
    stored_quality,
)
from smelter.streaming import late_events as stored_late_events
from smelter.streaming.realtime import quality as stream_quality
from workload.batch import AS_OF, HOURLY_7D_SQL, RUN, _gappy, customers_silver, hourly_output
from workload.registry import query
from workload.streams import _SILVER_SQL, ABOVE_TEN
from workload.tables import EVENTS_SQL, claim_events, plain_time, table, text

FILES = 4
DOCUMENT = ("claim_id", "policy_id", "customer_id", "claim_amount", "claim_status", TIME)


def _morning() -> Column:
    return F.coalesce(F.hour(TIME) < 12, F.lit(False))


def _members() -> Column:
    """One event as a struct whose time is text."""
    return F.struct(*[F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c) if c == TIME else c for c in DOCUMENT])


def _two_runs(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake after two runs: morning events first, the others later, two files a micro-batch."""
    lake = Lake(scratch_dir(spark, "realtime-run"))
    arriving = lake.path("files", "claims")
    events = claim_events(table(spark, sf_dir, "events"))
    for early in (_morning(), ~_morning()):
        drop = events.where(early).repartition(FILES, "claim_id")
        drop.select(F.to_json(_members()).alias("value")).write.mode("append").text(arriving)
        run_realtime(spark, lake, arriving, RUN, as_of=AS_OF, max_files_per_batch=2, contract=ABOVE_TEN)
    return lake


@query(f"SELECT *, TIMESTAMP '2024-01-31 00:00:00' AS sync_timestamp FROM ({HOURLY_7D_SQL})")
def realtime_run_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly rows in gold after two runs; morning hours of the second run meet stored partials."""
    gold = _two_runs(spark, sf_dir).read(spark, "gold", GOLD)
    return hourly_output(gold).withColumn("sync_timestamp", plain_time("sync_timestamp"))


@query(f"SELECT *, TRUE AS processed FROM ({_SILVER_SQL})")
def realtime_run_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed claims after two runs, under a contract of the caller."""
    claims = _two_runs(spark, sf_dir).read(spark, "silver", SILVER)
    times = {c: plain_time(c) for c in (TIME, "effective_from", "effective_to")}
    stamped = F.col("processed_timestamp").isNotNull().alias("processed")
    return claims.withColumns(times).select("*", stamped).drop("processed_timestamp", "ingestion_timestamp")


def _typed_stream(spark: SparkSession, sf_dir: str, folder: str, **options: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return claim_events(spark.readStream.schema(schema).options(**options).parquet(folder))


@query(f"""
WITH {EVENTS_SQL}, counted AS (
    SELECT 2 * count(*) AS record_count,
           count(DISTINCT claim_id) FILTER (policy_id IS NOT NULL AND event_timestamp IS NOT NULL AND claim_amount > 10)
               AS cleaned_count
    FROM claim_events)
SELECT record_count, cleaned_count, record_count - cleaned_count AS dropped_count, CAST(0 AS BIGINT) AS late_count,
       CASE WHEN record_count > 0 THEN CAST(cleaned_count AS DOUBLE) / CAST(record_count AS DOUBLE) * 100
            ELSE 0 END AS pass_rate
FROM counted
""")
def realtime_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts over many micro-batches; every event comes twice, in different batches."""
    lake = Lake(scratch_dir(spark, "realtime-quality"))
    folder = lake.path("files", "events")
    for _ in range(2):
        table(spark, sf_dir, "events").repartition(FILES, "event_id").write.mode("append").parquet(folder)
    stream = _typed_stream(spark, sf_dir, folder, maxFilesPerTrigger="1")
    path, checkpoint = lake.path("silver", SILVER), lake.path("checkpoints", "query")
    counts = stream_quality(run_pending(start_realtime_silver(stream, path, checkpoint, contract=ABOVE_TEN)))
    whole = ("record_count", "cleaned_count", "dropped_count", "late_count")
    return spark.createDataFrame(
        [(*(int(counts[c]) for c in whole), float(counts["pass_rate"]))],
        ", ".join(f"{c} bigint" for c in whole) + ", pass_rate double",
    )


@query(f"""
WITH {EVENTS_SQL}, valid AS (
    SELECT * FROM claim_events
    WHERE claim_id IS NOT NULL AND policy_id IS NOT NULL AND event_timestamp IS NOT NULL AND claim_amount > 10
), judged AS (
    SELECT claim_id, event_timestamp, hour(event_timestamp) >= 12 AND event_timestamp <=
           (SELECT date_trunc('milliseconds', max(event_timestamp)) - INTERVAL 10 DAY FROM valid
            WHERE hour(event_timestamp) < 12) AS late
    FROM valid
)
SELECT claim_id, event_timestamp, (SELECT count(*) FROM judged WHERE late) AS late_count FROM judged WHERE NOT late
""")
def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Morning events, then the others; of these, what is ten days behind the newest morning one is dropped and counted."""
    lake = Lake(scratch_dir(spark, "late-events"))
    folder, path = lake.path("files", "events"), lake.path("silver", SILVER)
    late = 0
    for early in (True, False):
        events = table(spark, sf_dir, "events")
        part = F.coalesce(F.hour("ts") < 12, F.lit(False)) == early
        events.where(part).write.mode("append").parquet(folder)
        stream = _typed_stream(spark, sf_dir, folder)
        silver = start_realtime_silver(
            stream, path, lake.path("checkpoints", "query"), contract=ABOVE_TEN, lateness="10 days"
        )
        late += rows_dropped_late(run_pending(silver))
    kept = spark.read.parquet(path)
    return kept.select("claim_id", plain_time(TIME), F.lit(late).cast("long").alias("late_count"))


# Of each event three versions arrive, the latest first and the earliest last; every third earliest one is invalid.
_VERSIONS_SQL = f"""
{EVENTS_SQL}, versions AS (
    SELECT 2 - v AS arrival, claim_id, policy_id, customer_id,
           CASE WHEN v = 0 AND CAST(claim_id AS BIGINT) % 3 = 0 THEN NULL ELSE CAST(claim_amount + v AS DOUBLE) END AS claim_amount,
           upper(trim(claim_status)) || '_' || v AS claim_status, CAST(NULL AS VARCHAR) AS claim_type,
           event_timestamp + v * INTERVAL 5 DAY AS event_timestamp
    FROM claim_events, (VALUES (0), (1), (2)) AS copies(v)
), valid AS (
    SELECT * FROM versions
    WHERE claim_id IS NOT NULL AND policy_id IS NOT NULL AND event_timestamp IS NOT NULL AND claim_amount > 10
)"""


def _arrivals(spark: SparkSession, sf_dir: str, lateness: dt.timedelta | None = dt.timedelta(days=20), **options: str):
    """A lake after three runs, each with one version of every event in two files, and the form of the rows."""
    lake = Lake(scratch_dir(spark, "realtime-versions"))
    folder, base = lake.path("files", "events"), table(spark, sf_dir, "events")
    for v in (2, 1, 0):
        shifted = {
            "ts": F.col("ts") + F.make_dt_interval(F.lit(5 * v)),
            "value": F.when((F.lit(v) > 0) | (F.col("event_id") % 3 != 0), F.col("value") + v),
            "event_type": F.concat("event_type", F.lit(f"_{v}")),
        }
        base.withColumns(shifted).repartition(2, "event_id").write.mode("append").parquet(folder)
        stream = claim_events(spark.readStream.schema(base.schema).options(**options).parquet(folder))
        run_pending(start_checked(stream, lake, lake.path("checkpoints", "checked"), ABOVE_TEN, lateness))
        run_pending(start_earliest(spark, lake, checked_schema(stream, ABOVE_TEN), lake.path("checkpoints", "earliest")))
    return lake, checked_schema(stream, ABOVE_TEN)


@query(f"""
WITH {_VERSIONS_SQL}
SELECT claim_id, policy_id, customer_id, claim_amount, claim_status, claim_type, event_timestamp,
       event_timestamp AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current, copies
FROM (SELECT *, count(*) OVER (PARTITION BY claim_id) AS copies,
             row_number() OVER (PARTITION BY claim_id ORDER BY event_timestamp, policy_id, customer_id, claim_amount, claim_status) AS rn
      FROM valid) WHERE rn = 1
""")
def realtime_silver_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest valid event of each claim, though later ones that differ arrive in runs before."""
    lake, schema = _arrivals(spark, sf_dir, None, maxFilesPerTrigger="1")
    claims = earliest_events(spark, lake, schema)
    return claims.withColumns({c: plain_time(c) for c in (TIME, "effective_from", "effective_to")})


_LATE_SQL = f"""
{_VERSIONS_SQL}, reached AS (
    SELECT arrival, max(max(event_timestamp)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
    FROM valid GROUP BY arrival
), judged AS (
    SELECT valid.*, coalesce(event_timestamp < newest - INTERVAL 20 DAY, FALSE) AS late FROM valid JOIN reached USING (arrival)
)"""


@query(f"""
WITH {_LATE_SQL}
SELECT claim_id, claim_amount, claim_status, event_timestamp FROM judged WHERE late
""")
def late_events_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events themselves that are over twenty days behind the newest of earlier runs."""
    lake, _ = _arrivals(spark, sf_dir)
    return stored_late_events(spark, lake).select("claim_id", "claim_amount", "claim_status", plain_time(TIME))


@query(f"""
WITH {_LATE_SQL}, counts AS (
    SELECT (SELECT count(*) FROM versions) AS record_count, (SELECT count(*) FROM versions) - count(*) AS invalid_count,
           count(*) FILTER (late) AS late_count, count(DISTINCT claim_id) FILTER (NOT late) AS cleaned_count
    FROM judged)
SELECT *, record_count - cleaned_count AS dropped_count,
       CASE WHEN record_count > 0 THEN CAST(cleaned_count AS DOUBLE) / CAST(record_count AS DOUBLE) * 100 ELSE 0 END AS pass_rate
FROM counts
""")
def realtime_quality_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts over three runs, from stored tables."""
    lake, schema = _arrivals(spark, sf_dir)
    return stored_quality(spark, lake, earliest_events(spark, lake, schema))


@query(f"""
WITH {EVENTS_SQL}
SELECT claim_id, policy_id, customer_id, CAST(claim_amount AS DOUBLE) AS claim_amount, claim_status, event_timestamp
FROM claim_events
""")
def event_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events from JSON files that each hold one array of up to a thousand objects."""
    folder = scratch_dir(spark, "event-arrays")
    events = claim_events(table(spark, sf_dir, "events"))
    place = F.floor(F.col("claim_id").cast("long") / 1000)
    arrays = events.groupBy(place.alias("file")).agg(F.to_json(F.collect_list(_members())).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    schema = ", ".join(f"{c} {'double' if c == 'claim_amount' else 'string'}" for c in DOCUMENT)
    read = read_event_array(spark, folder, schema)
    return read.withColumn(TIME, F.col(TIME).cast("timestamp").cast("timestamp_ntz"))


@query("""
SELECT 'given' AS contract, 'policy_id' AS column_name, count(*) FILTER (o_orderkey IS NULL) AS counted FROM orders
UNION ALL
SELECT 'given', 'customer_id', count(*) FILTER (o_custkey IS NULL OR o_orderpriority IS NULL OR o_orderpriority = '5-LOW')
FROM orders
UNION ALL
SELECT 'absent', CAST(NULL AS VARCHAR), count(*) FROM orders
""")
def contract_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs in the mandatory columns of a contract file; where the file is absent, rows go on unchecked."""
    folder = scratch_dir(spark, "contracts")
    columns = [{"name": c, "nullable": False} for c in ("policy_id", "customer_id")]
    document = json.dumps({"table_name": "orders", "required_columns": columns})
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.text(f"{folder}/orders")
    rows = _gappy(spark, sf_dir)

    def counted(name: str, on_missing: str) -> DataFrame:
        rules = load_contract(spark, f"{folder}/{name}", on_missing)
        if rules is None:
            return quality.row_count(rows).select(
                F.lit("absent").alias("contract"), F.lit(None).cast("string").alias("column_name"), F.col("row_count").alias("counted")
            )
        return quality.null_audit(rows, rules).select(
            F.lit("given").alias("contract"), "column_name", F.col("null_count").alias("counted")
        )

    return counted("orders", "error").unionByName(counted("nowhere", "skip"))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'Customers, typed and checked' AS description
FROM customer WHERE c_custkey IS NOT NULL AND c_nationkey > 0 AND c_nationkey < 120
""")
def table_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fully refreshed catalog table and the description that the catalog has of it."""
    root = scratch_dir(spark, "described")
    database = root.rsplit("/", 1)[1].replace("-", "_")
    lake = Lake(root, database=database)
    spark.sql(f"CREATE DATABASE `{database}`")
    try:
        lake.overwrite(customers_silver(spark, sf_dir), "silver", "customers", "Customers, typed and checked")
        said = spark.catalog.getTable(f"{database}.silver_customers").description
    finally:
        spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return lake.read(spark, "silver", "customers").select(text("customer_id").alias("customer_id"), F.lit(said).alias("description"))
