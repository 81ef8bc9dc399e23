"""Queries that run the events table through Structured Streaming.

Each call works in a new folder of the cluster's shared scratch space.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.contracts import ColumnRule, ColumnSpec, Contract
from smelter.session import scratch_dir
from smelter.sources import Lake
from smelter.streaming import (
    hourly_view,
    merge_days,
    run_pending,
    start_alerts,
    start_fan_out,
    start_hourly,
    start_hourly_bounded,
    start_realtime_silver,
)
from workload.batch import AS_OF, HOURLY_7D_SQL, HOURLY_SQL, as_doubles, hourly_output
from workload.registry import query
from workload.tables import EVENTS_SQL, claim_events, event_stream, plain_time, table


def _checkpoint(lake: Lake) -> str:
    return lake.path("checkpoints", "query")


@query(HOURLY_SQL)
def hourly_features_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly groups from stored partials; events of any age count."""
    lake = Lake(scratch_dir(spark, "hourly"))
    run_pending(start_hourly(claim_events(event_stream(spark, sf_dir)), lake, _checkpoint(lake)))
    return hourly_output(hourly_view(spark, lake))


@query(HOURLY_SQL)
def hourly_features_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly groups kept in streaming state behind a watermark."""
    lake = Lake(scratch_dir(spark, "hourly-bounded"))
    stream = claim_events(event_stream(spark, sf_dir))
    run_pending(start_hourly_bounded(stream, lake, _checkpoint(lake), lateness="40 days"))
    return hourly_output(hourly_view(spark, lake, bounded=True))


@query(HOURLY_7D_SQL)
def gold_sync_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last seven days of the stored hourly groups."""
    lake = Lake(scratch_dir(spark, "gold-sync"))
    run_pending(start_hourly(claim_events(event_stream(spark, sf_dir)), lake, _checkpoint(lake)))
    return hourly_output(hourly_view(spark, lake, as_of=AS_OF, back=dt.timedelta(days=7)))


@query(HOURLY_7D_SQL)
def gold_sync_7d_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same days from hourly groups that are merged by day after the first two of three runs."""
    lake = Lake(scratch_dir(spark, "gold-merged"))
    folder, events = lake.path("files", "events"), table(spark, sf_dir, "events")
    for part in range(3):
        events.where(F.pmod("event_id", F.lit(3)) == part).repartition(2).write.mode("append").parquet(folder)
        arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(folder)
        run_pending(start_hourly(claim_events(arriving), lake, _checkpoint(lake)))
        if part < 2:
            merge_days(spark, lake)
    return hourly_output(hourly_view(spark, lake, as_of=AS_OF, back=dt.timedelta(days=7)))


ABOVE_TEN = Contract(
    "claims_above_ten",
    (
        ColumnSpec("claim_id", nullable=False),
        ColumnSpec("policy_id", nullable=False),
        ColumnSpec("claim_amount", "double", nullable=False, rules=(ColumnRule("greater_than", 10),)),
        ColumnSpec("claim_status", transform="upper_trim"),
        ColumnSpec("claim_type", transform="upper_trim"),
        ColumnSpec("event_timestamp", "timestamp", nullable=False),
    ),
)

_SILVER_SQL = f"""
WITH {EVENTS_SQL}
SELECT claim_id, policy_id, customer_id, CAST(claim_amount AS DOUBLE) AS claim_amount,
       upper(trim(claim_status)) AS claim_status, CAST(NULL AS VARCHAR) AS claim_type, event_timestamp,
       event_timestamp AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current
FROM claim_events
WHERE claim_id IS NOT NULL AND policy_id IS NOT NULL AND event_timestamp IS NOT NULL AND claim_amount > 10
"""


def _silver(spark: SparkSession, sf_dir: str, lateness: str | None) -> DataFrame:
    lake = Lake(scratch_dir(spark, "realtime-silver"))
    sent_twice = event_stream(spark, sf_dir).unionByName(event_stream(spark, sf_dir))
    path = lake.path("silver", "claims_realtime")
    run_pending(
        start_realtime_silver(claim_events(sent_twice), path, _checkpoint(lake), contract=ABOVE_TEN, lateness=lateness)
    )
    times = {c: plain_time(c) for c in ("event_timestamp", "effective_from", "effective_to")}
    return spark.read.parquet(path).withColumns(times).drop("processed_timestamp")


@query(_SILVER_SQL)
def realtime_silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events with history columns, each once although all are sent twice."""
    return _silver(spark, sf_dir, lateness="40 days")


@query(_SILVER_SQL)
def realtime_silver_stream_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, remembering keys for ever."""
    return _silver(spark, sf_dir, lateness=None)


@query(f"""
WITH {EVENTS_SQL}
SELECT event_timestamp, claim_id, policy_id, customer_id, CAST(claim_amount AS DOUBLE) AS claim_amount, claim_status
FROM claim_events WHERE claim_amount > 100
""")
def high_value_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large events, stored as they arrive."""
    lake = Lake(scratch_dir(spark, "alerts"))
    path = lake.path("gold", "alerts")
    run_pending(start_alerts(claim_events(event_stream(spark, sf_dir)), path, _checkpoint(lake), threshold=100))
    alerts = as_doubles(spark.read.parquet(path), "claim_amount")
    return alerts.withColumn("event_timestamp", plain_time("event_timestamp"))


@query(f"""
WITH {EVENTS_SQL}
SELECT 'bronze' AS sink, claim_id, policy_id, customer_id, CAST(claim_amount AS DOUBLE) AS claim_amount,
       claim_status, event_timestamp
FROM claim_events
UNION ALL
SELECT 'typed', claim_id, policy_id, customer_id, CAST(claim_amount AS DOUBLE), claim_status, event_timestamp
FROM claim_events
""")
def dual_sink_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON events fanned out to a raw and a typed table; the rows of both."""
    lake = Lake(scratch_dir(spark, "dual-sink"))
    events = claim_events(event_stream(spark, sf_dir)).withColumn(
        "event_timestamp", F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    )
    documents = events.select(F.to_json(F.struct(*events.columns)).alias("value"))
    run_pending(start_fan_out(documents, lake, _checkpoint(lake), hourly=False))

    def rows(layer: str, sink: str) -> DataFrame:
        return lake.read(spark, layer, "claims_events").select(
            F.lit(sink).alias("sink"),
            "claim_id",
            "policy_id",
            "customer_id",
            F.col("claim_amount").cast("double").alias("claim_amount"),
            "claim_status",
            F.col("event_timestamp").cast("timestamp").cast("timestamp_ntz").alias("event_timestamp"),
        )

    return rows("bronze", "bronze").unionByName(rows("events", "typed"))
