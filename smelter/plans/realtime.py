"""The hourly real-time run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from smelter.operators.features import stamp
from smelter.operators.monitor import Instant
from smelter.session import Run
from smelter.sources.events import Field
from smelter.sources.lake import Lake
from smelter.sources.readers import stream_events
from smelter.contracts import Contract
from smelter.entities import CLAIM_EVENT_FIELDS, REALTIME_CLAIMS
from smelter.streaming.fanout import RAW_LAYER, TABLE, start_fan_out
from smelter.streaming.hourly import hourly_view, merge_days
from smelter.streaming.progress import run_pending
from smelter.streaming.realtime import quality, start_realtime_silver

SILVER = "claims_realtime"
# Formats whose tables may be a folder per micro-batch.
FILE_FORMATS = ("parquet", "orc", "json", "csv")
GOLD, GOLD_DESCRIPTION = "realtime_claims_features", "Hourly claims per customer of the last days"


def raw_event_schema(fields: tuple[Field, ...] = CLAIM_EVENT_FIELDS) -> str:
    return ", ".join(f"`{name}` string" for name, _, _ in fields) + ", ingestion_timestamp timestamp"


def sync_hourly(
    spark: SparkSession,
    lake: Lake,
    run: Run,
    as_of: Instant = None,
    back: dt.timedelta = dt.timedelta(days=7),
    bounded: bool = False,
) -> None:
    """Replace the gold table with the hourly rows of the look-back."""
    hourly = hourly_view(spark, lake, bounded, as_of if as_of is not None else run.ts_column, back)
    lake.overwrite(stamp(hourly, run, "sync_timestamp"), "gold", GOLD, GOLD_DESCRIPTION)


def run_realtime(
    spark: SparkSession,
    lake: Lake,
    events_path: str,
    run: Run | None = None,
    as_of: Instant = None,
    lateness: str | None = None,
    max_files_per_batch: int | None = None,
    contract: Contract = REALTIME_CLAIMS,
) -> dict[str, float]:
    """Take in pending events, bring typed claims up to date, sync gold.

    Returns the quality counts of the typed claims, which ``contract`` types and checks.  ``max_files_per_batch``
    bounds the size of one micro-batch, for instance when a backlog is taken in.

    The hourly groups of the run's batches are merged into one folder per day.  Safe to
    repeat: checkpoints below the lake's root remember what was done, and typed claims
    read the raw table only once its batches are complete, so a batch that is played
    again is never read half replaced.
    """
    if lake.fmt not in FILE_FORMATS:
        raise ValueError(f"real-time tables need a file format such as {FILE_FORMATS}, not {lake.fmt}")
    run = run or Run()
    checkpoints = lake.path("checkpoints", TABLE)
    bound = {"maxFilesPerTrigger": str(max_files_per_batch)} if max_files_per_batch else {}
    arriving = stream_events(spark, events_path, **bound)
    run_pending(start_fan_out(arriving, lake, f"{checkpoints}/fan_out"))
    merge_days(spark, lake)
    raw_table = f"{lake.path(RAW_LAYER, TABLE)}/*"
    stored = stream_events(spark, raw_table, fmt=lake.fmt, schema=raw_event_schema(), **bound)
    silver = start_realtime_silver(
        stored,
        lake.path("silver", SILVER),
        f"{checkpoints}/silver",
        fmt=lake.fmt,
        lateness=lateness,
        contract=contract,
    )
    run_pending(silver)
    sync_hourly(spark, lake, run, as_of)
    return quality(silver)
