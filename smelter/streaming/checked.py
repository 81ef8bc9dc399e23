"""Checked events with their late rows and counts kept, and the earliest event of each key.

A first query types and checks each micro-batch and stores it, late rows apart, with a
row of counts.  It keeps no streaming state: how far time had come is in the counts of
the batch before, so a batch that is played again is judged as it was the first time.
A second query stores, likewise without state, the earliest event of each key in each
of its batches; the view takes the earliest of those.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from smelter.contracts import Contract
from smelter.entities import REALTIME_CLAIMS
from smelter.functions.casts import ref
from smelter.operators.conform import compile_contract
from smelter.operators.history import stamp_current
from smelter.operators.monitor import TIME
from smelter.operators.quality import with_rates
from smelter.sources.lake import BATCH, Lake
from smelter.streaming.progress import start

LAYER, CHECKED, METRICS = "events", "claims_checked", "claims_checked_metrics"
EARLIEST = "claims_earliest"
LATE = "is_late"
# How many events of the key there have been.
COPIES = "copies"
_OK = "__ok"
# Counts of a micro-batch; ``newest`` is the newest valid time up to and with it, in microseconds.
_COUNTS = T.StructType([T.StructField(c, T.LongType()) for c in ("received", "valid", "late", "newest")])


def checked_schema(events: DataFrame, contract: Contract = REALTIME_CLAIMS) -> T.StructType:
    """Columns of the stored rows of ``events``."""
    return events.withColumns(compile_contract(contract, events.schema).columns).schema


def _newest_before(spark: SparkSession, lake: Lake, metrics: str, batch_id: int) -> int | None:
    if not batch_id:
        return None
    return lake.read_batch(spark, LAYER, metrics, batch_id - 1, _COUNTS).first()["newest"]


def store_checked(
    batch: DataFrame,
    lake: Lake,
    batch_id: int,
    contract: Contract = REALTIME_CLAIMS,
    lateness: dt.timedelta | None = None,
    table: str = CHECKED,
) -> None:
    """Store one micro-batch's valid rows, late ones apart, and its counts; both replace an earlier try.

    A row is late if it is more than ``lateness`` behind the newest valid time of the
    batches before.  The counts are observed by the tasks that write, without a shuffle
    between, so each row counts once even if tasks run again.
    """
    spark, metrics = batch.sparkSession, f"{table}_metrics"
    compiled = compile_contract(contract, batch.schema)
    newest = _newest_before(spark, lake, metrics, batch_id)
    time = F.unix_micros(ref(TIME))
    late = F.lit(False)
    if lateness is not None and newest is not None:
        late = F.coalesce(time < newest - lateness // dt.timedelta(microseconds=1), F.lit(False))
    marked = batch.withColumns(compiled.columns).withColumns({_OK: F.coalesce(compiled.passes, F.lit(False)), LATE: late})
    seen = Observation(f"{table}_{batch_id}")
    counted = marked.observe(
        seen,
        F.count(F.lit(1)).alias("received"),
        F.count_if(_OK).alias("valid"),
        F.count_if(F.col(_OK) & F.col(LATE)).alias("late"),
        F.max(F.when(F.col(_OK), time)).alias("newest"),
    )
    lake.write_batch(counted.where(_OK).drop(_OK), LAYER, table, batch_id, partition_by=[LATE], gather=False)
    counts = seen.get
    reached = max((t for t in (newest, counts["newest"]) if t is not None), default=None)
    row = (*(counts[c] or 0 for c in ("received", "valid", "late")), reached)
    lake.write_batch(spark.createDataFrame([row], _COUNTS).coalesce(1), LAYER, metrics, batch_id)


def start_checked(
    events: DataFrame,
    lake: Lake,
    checkpoint: str,
    contract: Contract = REALTIME_CLAIMS,
    lateness: dt.timedelta | None = None,
    table: str = CHECKED,
    every: str | None = None,
) -> StreamingQuery:
    """Store every valid event of the stream, late ones in a part of their own, and the counts of each batch."""

    def store(batch: DataFrame, batch_id: int) -> None:
        store_checked(batch, lake, batch_id, contract, lateness, table)

    return start(events.writeStream.foreachBatch(store), checkpoint, every)


def late_events(spark: SparkSession, lake: Lake, table: str = CHECKED) -> DataFrame:
    """The late rows, with the batch they came in."""
    return lake.read(spark, LAYER, table).where(F.col(LATE).cast("boolean")).drop(LATE)


def start_earliest(
    spark: SparkSession,
    lake: Lake,
    schema: T.StructType,
    checkpoint: str,
    key: str = "claim_id",
    table: str = CHECKED,
    target: str = EARLIEST,
    every: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Keep the earliest stored event of each key that came in time; of several at one time the least in all columns.

    Which event stays depends on the events alone, not on their order or on how they
    are split.  Each batch stores the earliest event and the count of each key it has;
    :func:`earliest_events` puts the batches together.  No streaming state is kept, so a
    batch costs what it brings, however many keys there have been.  Groups are combined
    before the shuffle, so a key that arrives very often sends one row per task.  Start
    it when :func:`start_checked` has ended its batch.
    """
    reader = spark.readStream.format(lake.fmt).schema(schema).options(**options)
    stored = reader.load(f"{lake.path(LAYER, table)}/*/{LATE}=false")

    def store(batch: DataFrame, batch_id: int) -> None:
        lake.write_batch(_earliest(batch, key, schema, F.count(F.lit(1))), "silver", target, batch_id)

    return start(stored.writeStream.foreachBatch(store), checkpoint, every)


def _earliest(rows: DataFrame, key: str, schema: T.StructType, copies: Column) -> DataFrame:
    rest = [c for c in schema.names if c not in (key, TIME)]
    groups = rows.groupBy(ref(key)).agg(F.min(F.struct(ref(TIME), *map(ref, rest))).alias("best"), copies.alias(COPIES))
    return groups.select(*[ref(c) if c == key else F.col("best")[c].alias(c) for c in schema.names], COPIES)


def earliest_events(
    spark: SparkSession, lake: Lake, schema: T.StructType, key: str = "claim_id", target: str = EARLIEST
) -> DataFrame:
    """The earliest event of each key, with history columns and the number of its copies."""
    wide = T.StructType([*schema.fields, T.StructField(COPIES, T.LongType()), T.StructField(BATCH, T.LongType())])
    stored = lake.read_or_empty(spark, "silver", target, wide)
    return stamp_current(_earliest(stored, key, schema, F.sum(COPIES)), since=TIME)


def stored_quality(spark: SparkSession, lake: Lake, kept: DataFrame, table: str = CHECKED) -> DataFrame:
    """One row of counts over every batch ever stored: records, kept, dropped, invalid, late and pass rate.

    ``kept`` is what :func:`earliest_events` gives.  The counts come from tables, so
    they outlast the queries and the driver, and a batch played again counts once.
    """
    batches = lake.read_or_empty(spark, LAYER, f"{table}_metrics", T.StructType([*_COUNTS.fields, T.StructField(BATCH, T.LongType())]))

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0).cast("long"))

    counts = batches.agg(
        total(F.col("received")).alias("record_count"),
        total(F.col("received") - F.col("valid")).alias("invalid_count"),
        total(F.col("late")).alias("late_count"),
    )
    return with_rates(counts.join(kept.agg(F.count(F.lit(1)).alias("cleaned_count"))))
