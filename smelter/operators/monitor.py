"""Queries over the event table: hourly groups, alerts, status counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.timebins import HOUR, bin_time, look_back, time_after, utc_date

Instant = Column | dt.datetime | str | None

# The UTC day of TIME; stored event tables are partitioned by it.
TIME, DATE = "event_timestamp", "event_date"
HIGH_VALUE = 50000
ALERT_COLUMNS = (TIME, "claim_id", "policy_id", "customer_id", "claim_amount", "claim_status")
HOURLY_COLUMNS = ("customer_id", TIME, "claims_count", "total_amount", "avg_amount", "max_amount")


def _since(events: DataFrame, as_of: Instant, back: dt.timedelta) -> DataFrame:
    """Events of the look-back; other days' partitions are not read."""
    recent = time_after(F.col(TIME), as_of, back)
    if DATE in events.columns:
        recent = recent & (F.col(DATE) >= utc_date(look_back(as_of, back)))
    return events.where(recent)


def hourly_claims(events: DataFrame, width: dt.timedelta = HOUR) -> DataFrame:
    """Claims per customer and hour; the hour's start keeps the name of the time.

    ``claims_count`` counts events without an amount, the measures do not.
    """
    amount = F.col("claim_amount")
    return events.groupBy("customer_id", bin_time(F.col(TIME), width).alias(TIME)).agg(
        F.count(F.lit(1)).alias("claims_count"),
        F.sum(amount).alias("total_amount"),
        F.avg(amount).alias("avg_amount"),
        F.max(amount).alias("max_amount"),
    )


def high_value(events: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    """Events above the threshold; stateless, so also usable on a stream."""
    return events.where(F.col("claim_amount") > F.lit(threshold)).select(*ALERT_COLUMNS)


def high_value_alerts(
    events: DataFrame, as_of: Instant = None, threshold: float = HIGH_VALUE, back: dt.timedelta = HOUR
) -> DataFrame:
    """High-value events of the last hour, largest first."""
    return high_value(_since(events, as_of, back), threshold).orderBy(F.desc("claim_amount"))


def status_counts(events: DataFrame, as_of: Instant = None, back: dt.timedelta = dt.timedelta(days=1)) -> DataFrame:
    """Events of the last day per status as it was sent."""
    return _since(events, as_of, back).groupBy("claim_status").agg(F.count(F.lit(1)).alias("count_"))


def recent_hours(hourly: DataFrame, as_of: Instant = None, back: dt.timedelta = dt.timedelta(days=7)) -> DataFrame:
    """Hourly rows of the look-back; on a stored table the test reaches the scan."""
    return _since(hourly, as_of, back)
