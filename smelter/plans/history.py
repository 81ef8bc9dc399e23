"""Stored history that grows batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.functions.casts import ref
from smelter.operators.history import build_history
from smelter.sources.lake import BATCH, Lake

BUCKET = "key_bucket"
# Suffix of the table that keeps every version a history was built from.
VERSIONS = "_versions"


def merge_history(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    table: str,
    batch: DataFrame,
    batch_id: int,
    keys: str | Sequence[str],
    since: str = "ingestion_timestamp",
    track: Sequence[str] | None = None,
    buckets: int = 1024,
) -> list[int]:
    """Add a batch of raw versions to a stored history; returns the key buckets that were rewritten.

    The history then equals :func:`build_history` over all batches so far, in whatever
    order they come and however late a version is: an interval that a late version
    falls into is split, which needs the sightings that the interval had swallowed.  So
    the versions themselves are kept, each batch in folders of its own, and the
    intervals of a bucket are built from all of that bucket's versions.  Only buckets
    with a key of the batch are read and written; all others keep their files.

    A batch that is merged again replaces itself, so after a failure the same call is
    simply repeated.  ``buckets`` must stay what it was at the first batch; the list
    of touched ones is all the driver sees.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    bucket = F.pmod(F.xxhash64(*map(ref, keys)), F.lit(buckets)).cast("int")
    versions = table + VERSIONS
    dated = batch.where(ref(since).isNotNull()).withColumn(BUCKET, bucket).withColumn(BATCH, F.lit(batch_id).cast("long"))
    lake.overwrite_partitions(dated, layer, versions, [BUCKET, BATCH])
    stored = lake.read(spark, layer, versions, schema=dated.schema)
    touched = sorted(r[0] for r in stored.where(F.col(BATCH) == batch_id).select(BUCKET).distinct().collect())
    if touched:
        of_buckets = stored.where(F.col(BUCKET).isin(touched)).drop(BATCH)
        tracked = list(track) if track is not None else [c for c in batch.columns if c not in keys and c != since]
        history = build_history(of_buckets, [BUCKET, *keys], since, tracked)
        lake.overwrite_partitions(history, layer, table, [BUCKET])
    return touched


def read_history(spark: SparkSession, lake: Lake, layer: str, table: str) -> DataFrame:
    """The intervals of a history that :func:`merge_history` keeps."""
    return lake.read(spark, layer, table).drop(BUCKET)
