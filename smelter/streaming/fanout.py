"""One event stream into two tables: raw strings for history, types for queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from smelter.entities import CLAIM_EVENT_FIELDS
from smelter.functions.timebins import utc_date
from smelter.operators.monitor import DATE, TIME
from smelter.sources.events import Field, extract_fields, type_fields
from smelter.sources.lake import Lake
from smelter.streaming.hourly import store_partials
from smelter.streaming.progress import start

_TAKEN = "__taken"
RAW_LAYER, TYPED_LAYER, TABLE = "bronze", "events", "claims_events"


def start_fan_out(
    stream: DataFrame,
    lake: Lake,
    checkpoint: str,
    fields: Sequence[Field] = CLAIM_EVENT_FIELDS,
    table: str = TABLE,
    hourly: bool = True,
    every: str | None = None,
) -> StreamingQuery:
    """Store each event of ``stream`` (JSON in ``value``) in both tables.

    The source is read once: the typed table is made from the stored raw batch, and the
    hourly groups, if wanted, from the stored typed one, so a lost executor does not send the job
    back to the source.  Every write replaces its own batch and events carry the
    instant of their batch, so playing a batch again changes nothing.
    """
    names = [name for name, _, _ in fields]

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        raw = extract_fields(batch, fields).select(*names, F.col(_TAKEN).alias("ingestion_timestamp"))
        lake.write_batch(raw, RAW_LAYER, table, batch_id)
        stored = lake.read_batch(spark, RAW_LAYER, table, batch_id, raw.schema)
        typed = type_fields(stored.select(*names), fields)
        if TIME in names:
            typed = typed.withColumn(DATE, utc_date(F.col(TIME)))
            lake.write_batch(typed, TYPED_LAYER, table, batch_id, partition_by=[DATE])
        else:
            lake.write_batch(typed, TYPED_LAYER, table, batch_id)
        if hourly:
            store_partials(lake.read_batch(spark, TYPED_LAYER, table, batch_id, typed.schema), lake, batch_id)

    stream = stream.withColumn(_TAKEN, F.current_timestamp())  # in a stream: when the batch was planned, also if replayed
    return start(stream.writeStream.foreachBatch(store), checkpoint, every)
