"""Hourly groups kept up to date as events arrive.

Events of any age must count, so nothing may be held back or dropped by a
watermark.  Each micro-batch stores its own partial groups; the view merges
them.  State is the stored partials: nothing grows in executor memory.

Partials pile up, a folder per batch and day.  ``merge_days`` adds those of finished
batches to one folder per day.  It writes the days it touches into a new generation
and then a manifest, which names the folder of every day and the last batch in them;
until the manifest is there, the one before holds, so a broken merge is just repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from smelter.functions.timebins import bin_time, utc_date
from smelter.operators.monitor import DATE, HOURLY_COLUMNS, TIME, Instant, recent_hours
from smelter.sources.lake import BATCH, Lake
from smelter.streaming.progress import start

LAYER, PARTIALS, BOUNDED = "events", "claims_hourly", "claims_hourly_bounded"
DAYS, MANIFEST = "claims_hourly_days", "claims_hourly_manifest"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: how Spark names the folder of a null

_SUM = T.DecimalType(38, 8)
_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField(TIME, T.TimestampType()),
        T.StructField("claims_count", T.LongType()),
        T.StructField("amounts", T.LongType()),
        T.StructField("total_amount", _SUM),
        T.StructField("max_amount", T.DecimalType(28, 8)),
        T.StructField(DATE, T.DateType()),
        T.StructField(BATCH, T.LongType()),
    ]
)


def _mergeable(events: DataFrame, *group) -> DataFrame:
    """Groups in a form that adds up: the average as sum and count of amounts."""
    amount = F.col("claim_amount")
    return events.groupBy(*group).agg(
        F.count(F.lit(1)).alias("claims_count"),
        F.count(amount).alias("amounts"),
        F.sum(amount).cast(_SUM).alias("total_amount"),
        F.max(amount).cast("decimal(28,8)").alias("max_amount"),
    )


def store_partials(events: DataFrame, lake: Lake, batch_id: int) -> None:
    """Store the hourly groups of one micro-batch, replacing an earlier try."""
    groups = _mergeable(events, F.col("customer_id"), bin_time(F.col(TIME)).alias(TIME))
    lake.write_batch(groups.withColumn(DATE, utc_date(F.col(TIME))), LAYER, PARTIALS, batch_id, partition_by=[DATE])


def start_hourly(stream: DataFrame, lake: Lake, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Maintain the hourly groups of a typed event stream; events of any age count.

    The first run takes in what the source already holds.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        store_partials(batch, lake, batch_id)

    return start(stream.writeStream.foreachBatch(store), checkpoint, every)


def start_hourly_bounded(
    stream: DataFrame, lake: Lake, checkpoint: str, lateness: str, every: str | None = None
) -> StreamingQuery:
    """The same with groups in streaming state, for at most ``lateness``.

    Later events are dropped (see ``rows_dropped_late``).  Each batch stores the
    groups it changed; the view takes the newest value of each.
    """
    windowed = stream.withWatermark(TIME, lateness)
    groups = _mergeable(windowed, "customer_id", F.window(TIME, "1 hour").alias("w"))
    flat = groups.select("customer_id", F.col("w.start").alias(TIME), *_SCHEMA.fieldNames()[2:6])

    def store(batch: DataFrame, batch_id: int) -> None:
        lake.write_batch(batch.withColumn(DATE, utc_date(F.col(TIME))), LAYER, BOUNDED, batch_id, partition_by=[DATE])

    return start(flat.writeStream.outputMode("update").foreachBatch(store), checkpoint, every)


@dataclass(frozen=True)
class Merged:
    """The newest manifest: its number, the last batch that is merged, and the folder of each day (None: no time)."""

    generation: int = -1
    upto: int = -1
    days: Mapping[dt.date | None, int] = field(default_factory=dict)


_ENTRY = T.StructType([T.StructField(DATE, T.DateType()), T.StructField("folder", T.LongType()), T.StructField("upto", T.LongType())])


def merged_days(spark: SparkSession, lake: Lake) -> Merged:
    """What has been merged so far; one row per day reaches the driver."""
    for number in reversed(lake.batches(spark, LAYER, MANIFEST)):
        entries = lake.read_batch(spark, LAYER, MANIFEST, number, _ENTRY).collect()
        if entries:
            return Merged(number, entries[0].upto, {e[DATE]: e.folder for e in entries})
    return Merged()


def merge_days(spark: SparkSession, lake: Lake) -> Merged:
    """Add all stored partials to the folders of their days; returns the new state.

    Only days that have new partials are read and written, as a new folder each.  Call
    it between runs of the query that stores partials.  Folders that the manifest no
    longer names may be removed once no reader uses them.
    """
    before = merged_days(spark, lake)
    opened = [b for b in lake.batches(spark, LAYER, PARTIALS) if b > before.upto]
    partials = _partials(spark, lake, opened)
    touched = {r[0] for r in partials.select(DATE).distinct().collect()}
    if not touched:
        return before
    old = _days(spark, lake, {d: f for d, f in before.days.items() if d in touched})
    after = Merged(before.generation + 1, opened[-1], {**before.days, **dict.fromkeys(touched, before.generation + 1)})
    groups = _added(partials.drop(BATCH).unionByName(old), "customer_id", TIME, DATE)
    lake.write_batch(groups, LAYER, DAYS, after.generation, partition_by=[DATE])
    manifest = spark.createDataFrame([(d, f, after.upto) for d, f in after.days.items()], _ENTRY)
    lake.write_batch(manifest.coalesce(1), LAYER, MANIFEST, after.generation)
    return after


def _partials(spark: SparkSession, lake: Lake, batches: Sequence[int]) -> DataFrame:
    if not batches:
        return spark.createDataFrame([], _SCHEMA)
    reader = spark.read.format(lake.fmt).schema(_SCHEMA).option("basePath", lake.path(LAYER, PARTIALS))
    return reader.load([lake.batch_path(LAYER, PARTIALS, b) for b in batches])


def _days(spark: SparkSession, lake: Lake, days: Mapping[dt.date | None, int]) -> DataFrame:
    schema = T.StructType([f for f in _SCHEMA.fields if f.name != BATCH])
    if not days:
        return spark.createDataFrame([], schema)
    reader = spark.read.format(lake.fmt).schema(schema).option("basePath", lake.path(LAYER, DAYS))
    stored = reader.load([f"{lake.batch_path(LAYER, DAYS, f)}/{DATE}={d or NO_DATE}" for d, f in days.items()])
    return stored.select(*schema.names)


def _added(rows: DataFrame, *group: str) -> DataFrame:
    return rows.groupBy(*group).agg(
        F.sum("claims_count").alias("claims_count"),
        F.sum("amounts").alias("amounts"),
        F.sum("total_amount").cast(_SUM).alias("total_amount"),
        F.max("max_amount").alias("max_amount"),
    )


def _first_day(as_of: Instant, back: dt.timedelta | None) -> dt.date | None:
    """The first UTC day of a look-back whose end is known here."""
    if back is None or not isinstance(as_of, dt.datetime):
        return None
    return ((as_of.astimezone(dt.timezone.utc) if as_of.tzinfo else as_of) - back).date()


def hourly_view(
    spark: SparkSession,
    lake: Lake,
    bounded: bool = False,
    as_of: Instant = None,
    back: dt.timedelta | None = None,
) -> DataFrame:
    """The hourly table: all of it, or the ``back`` before ``as_of``.

    The look-back test is on the stored columns, so other days are not read.  Of what
    ``merge_days`` has merged only the folders of the look-back's days are even listed,
    where ``as_of`` is given as an instant; beside them the batches since.
    """
    if bounded:
        stored = lake.read_or_empty(spark, LAYER, BOUNDED, _SCHEMA)
    else:
        state = merged_days(spark, lake)
        opened = _partials(spark, lake, [b for b in lake.batches(spark, LAYER, PARTIALS) if b > state.upto])
        first = _first_day(as_of, back)
        days = {d: f for d, f in state.days.items() if first is None or (d is not None and d >= first)}
        stored = opened.drop(BATCH).unionByName(_days(spark, lake, days))
    if back is not None:
        stored = recent_hours(stored, as_of, back)
    groups = stored.groupBy("customer_id", TIME)
    if bounded:
        newest = F.max(F.struct(BATCH, "claims_count", "amounts", "total_amount", "max_amount")).alias("newest")
        merged = groups.agg(newest).select("customer_id", TIME, "newest.*")
    else:
        merged = _added(stored, "customer_id", TIME)
    # These operand types give a quotient of scale 18; wider ones would round it.
    quotient = F.col("total_amount").try_cast("decimal(28,8)") / F.col("amounts").cast("decimal(19,0)")
    average = F.when(F.col("amounts") > 0, quotient)
    return merged.withColumn("avg_amount", average.cast("decimal(32,12)")).select(*HOURLY_COLUMNS)
