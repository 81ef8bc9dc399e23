"""Event streams: two-table fan-out, hourly groups, typed real-time claims."""

from smelter.streaming.checked import (
    checked_schema,
    earliest_events,
    late_events,
    start_checked,
    start_earliest,
    stored_quality,
)
from smelter.streaming.fanout import start_fan_out
from smelter.streaming.hourly import hourly_view, merge_days, start_hourly, start_hourly_bounded
from smelter.streaming.progress import run_pending, rows_dropped_late
from smelter.streaming.realtime import quality, start_alerts, start_realtime_silver, typed_claims

__all__ = [
    "checked_schema",
    "earliest_events",
    "hourly_view",
    "late_events",
    "merge_days",
    "quality",
    "rows_dropped_late",
    "run_pending",
    "start_alerts",
    "start_checked",
    "start_earliest",
    "start_fan_out",
    "start_hourly",
    "start_hourly_bounded",
    "start_realtime_silver",
    "stored_quality",
    "typed_claims",
]
