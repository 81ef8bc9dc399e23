"""Reading raw files, tables and events; storing tables."""

from smelter.sources.events import extract_fields, type_fields
from smelter.sources.lake import Lake
from smelter.sources.readers import read_event_array, read_raw_csv, stream_events

__all__ = ["Lake", "extract_fields", "read_event_array", "read_raw_csv", "stream_events", "type_fields"]
