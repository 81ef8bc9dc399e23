"""Silver tables that follow bronze without reading all of it again."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from smelter.entities import Entity
from smelter.functions.casts import ref
from smelter.operators.conform import compile_contract
from smelter.operators.dedup import latest_per_key
from smelter.operators.history import stamp_current
from smelter.operators.lineage import PARTITION_COLUMN
from smelter.operators.quality import COPIES, clean_counters, metrics_of
from smelter.plans.history import BUCKET
from smelter.session import Run
from smelter.sources.lake import BATCH, FILE_FORMATS, Lake

log = logging.getLogger(__name__)

# Suffixes of what is kept beside a silver table: the newest raw rows of one run, those of all runs
# so far, the bronze files that are in them, and what a finished run says about both.
NEW, NEWEST, FILES, FINISHED = "_new", "_newest", "_files", "_finished"
FINISHED_SCHEMA = "kind string, name string, value long"


def _finished(spark: SparkSession, lake: Lake, name: str) -> tuple[int, dict[str, int], dict[int, int]]:
    """The last finished run (-1: none), bronze files per date it knew, and the run that wrote each bucket."""
    runs = lake.batches(spark, "silver", name + FINISHED)
    # A run is finished when its last write is, which Spark marks in the folder.
    done = [r for r in runs if lake.is_complete(spark, lake.batch_path("silver", name + FINISHED, r))]
    if not done:
        return -1, {}, {}
    rows = lake.read_batch(spark, "silver", name + FINISHED, done[-1], FINISHED_SCHEMA).collect()
    dates = {r["name"]: r["value"] for r in rows if r["kind"] == "date"}
    return done[-1], dates, {int(r["name"]): r["value"] for r in rows if r["kind"] == "bucket"}


def _unseen(spark: SparkSession, lake: Lake, name: str, dates: list[str], last: int, run_id: int) -> DataFrame:
    """Bronze rows of these dates from files that no finished run has read; their names are stored."""
    raw = lake.read_folders(spark, "bronze", name, [f"{PARTITION_COLUMN}={d}" for d in dates])
    named = raw.withColumn("__file", F.col("_metadata.file_path"))
    if last >= 0:
        seen = lake.read(spark, "silver", name + FILES).where((F.col(BATCH) <= last) & F.col(PARTITION_COLUMN).isin(dates))
        named = named.join(seen.select(F.col("file").alias("__file")), "__file", "left_anti")
    files = named.select(F.col("__file").alias("file"), F.col(PARTITION_COLUMN).cast("string").alias(PARTITION_COLUMN))
    lake.write_batch(files.distinct(), "silver", name + FILES, run_id)
    return named.drop("__file")


def clean_new(
    spark: SparkSession, lake: Lake, entity: Entity, run: Run, buckets: int = 1024, everything: bool = False
) -> dict[str, float]:
    """Bring the entity's silver table up to date with bronze; returns metrics of what was rewritten.

    The rows then equal those of :func:`smelter.plans.clean` over all of bronze, but for
    ``processed_timestamp``, which in buckets left alone is that of the run that wrote
    them.  The newest raw row of each key is kept beside the table, by key bucket, with
    the number of rows it stands for.  A run reads the dates of bronze whose number of
    files has changed, of those the files it has not seen, and the kept rows of the
    buckets these touch; it writes those buckets and no others.  How many buckets that
    is follows the keys: an increment with keys of all buckets rewrites them all, still
    from one row per key.

    A run that breaks changes nothing that a later one reads, and is simply repeated.
    ``everything`` rewrites all buckets from the kept rows, as a changed contract needs;
    so does a table that :func:`clean` has rebuilt meanwhile.  Bronze only ever grows: a
    date with fewer files than before is an error.  ``buckets`` must stay what it was at
    the first run.  Needs a file format and no catalog database; the driver sees
    folder names, one count per date and one number per bucket.
    """
    if lake.fmt not in FILE_FORMATS or lake.database:
        raise ValueError("increments are kept in plain parquet or orc folders; use clean()")
    name = entity.name
    stored = lake.file_counts(spark, "bronze", name, PARTITION_COLUMN)
    last, known, owners = _finished(spark, lake, name)
    shrunk = sorted(d for d, files in known.items() if stored.get(d, 0) < files)
    if shrunk:
        raise ValueError(f"{name}: bronze has lost files of {shrunk}; use clean()")
    dates = sorted(d for d, files in stored.items() if files != known.get(d))
    run_id = last + 1
    touched: list[int] = []
    if dates:
        raw = _unseen(spark, lake, name, dates, last, run_id)
        bucket = F.pmod(F.xxhash64(ref(entity.key)), F.lit(buckets)).cast("int")
        new = latest_per_key(raw.withColumn(BUCKET, bucket), [BUCKET, entity.key], copies=COPIES)
        lake.write_batch(new, "silver", name + NEW, run_id, [BUCKET])
        touched = sorted(int(b) for b in lake.partition_values(spark, lake.batch_path("silver", name + NEW, run_id), BUCKET))
    if touched:
        kept = lake.read_folders(spark, "silver", name + NEW, [f"{BATCH}={run_id}"]).drop(BATCH)
        older = [f"{BATCH}={owners[b]}/{BUCKET}={b}" for b in touched if b in owners]
        if older:
            known = lake.read_folders(spark, "silver", name + NEWEST, older).drop(BATCH)
            kept = latest_per_key(known.unionByName(kept, allowMissingColumns=True), [BUCKET, entity.key], copies=COPIES)
        # Rows that meet no older ones are one per key already, in folders of their buckets, and need no shuffle.
        lake.write_batch(kept, "silver", name + NEWEST, run_id, [BUCKET], gather=bool(older))
        owners = {**owners, **dict.fromkeys(touched, run_id)}
    bucketed = bool(lake.partition_values(spark, lake.path("silver", name), BUCKET))
    rewritten = touched if bucketed and not everything else sorted(owners)
    metrics: dict[str, float] = metrics_of({})
    if rewritten:
        newest = lake.read_folders(spark, "silver", name + NEWEST, [f"{BATCH}={owners[b]}/{BUCKET}={b}" for b in rewritten])
        metrics = _refine(lake, entity, newest.drop(BATCH), run, rewritten, bucketed)
    elif dates and not bucketed:
        nothing = lake.read_folders(spark, "bronze", name, [f"{PARTITION_COLUMN}={d}" for d in dates])
        _refine(lake, entity, nothing.withColumns({BUCKET: F.lit(0), COPIES: F.lit(1)}), run, [], bucketed)
    if dates:
        rows = [("date", d, files) for d, files in stored.items()] + [("bucket", str(b), r) for b, r in owners.items()]
        lake.write_batch(spark.createDataFrame(rows, FINISHED_SCHEMA).coalesce(1), "silver", name + FINISHED, run_id)
    log.info("%s: dates %s, %d buckets: %s", name, dates, len(rewritten), metrics)
    return {**metrics, "new_dates": len(dates), "rewritten_buckets": len(rewritten)}


def _refine(lake: Lake, entity: Entity, newest: DataFrame, run: Run, rewritten: list[int], bucketed: bool) -> dict[str, float]:
    """Type, check and store the rows of these buckets in place of what the buckets held.

    The rows come from folders of their buckets and are written without a shuffle.
    """
    compiled = compile_contract(entity.typed, newest.schema)
    seen = Observation(f"clean_new_{entity.name}")
    typed = newest.withColumns(compiled.columns).observe(seen, *clean_counters(compiled))
    valid = typed.where(compiled.passes).drop(COPIES)
    silver = stamp_current(valid.withColumn("processed_timestamp", run.ts_column))
    spark, where = silver.sparkSession, ("silver", entity.name)
    if bucketed:
        lake.overwrite_partitions(silver, *where, [BUCKET], gather=False)
    else:
        lake.overwrite(silver, *where, entity.description, [BUCKET])
    metrics = metrics_of(seen.get)
    if bucketed and metrics["invalid_count"]:
        # The write leaves the old file of a bucket that has no valid row any more.
        filled = {r[0] for r in silver.select(BUCKET).distinct().collect()}
        lake.drop_partitions(spark, *where, BUCKET, sorted(set(rewritten) - filled))
    if not lake.partition_values(spark, lake.path(*where), BUCKET):
        lake.append_no_rows(silver, *where, BUCKET, 0)
    return metrics


def read_silver(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """A silver table, whether :func:`smelter.plans.clean` or :func:`clean_new` keeps it."""
    return lake.read(spark, "silver", name).drop(BUCKET)
