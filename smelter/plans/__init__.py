"""Whole flows: the daily batch run and the hourly real-time run."""

from smelter.plans.batch import clean, ingest, run_batch
from smelter.plans.history import merge_history, read_history
from smelter.plans.increments import clean_new, read_silver
from smelter.plans.realtime import run_realtime, sync_hourly

__all__ = ["clean", "clean_new", "ingest", "merge_history", "read_history", "read_silver", "run_batch", "run_realtime", "sync_hourly"]
