"""CSV files to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from smelter.entities import ENTITIES, Entity
from smelter.operators import features
from smelter.operators.conform import compile_contract
from smelter.operators.dedup import duplicate_keys, latest_per_key
from smelter.operators.history import stamp_current
from smelter.operators.lineage import PARTITION_COLUMN, SOURCE_SYSTEM, add_lineage
from smelter.operators.quality import COPIES, check_columns, clean_counters, metrics_of, null_counters
from smelter.plans.increments import clean_new, read_silver
from smelter.session import Run
from smelter.sources.lake import Lake
from smelter.sources.readers import read_raw_csv

log = logging.getLogger(__name__)

# Descriptions of the gold tables.
GOLD_DESCRIPTIONS = {
    "claims_features": "Claims features per customer",
    "customer_features": "Customers with their policy features",
    "risk_features": "Policies with claims features and risk score",
    "monthly_claims_summary": "Claims per month",
}


def ingest(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    paths: str | Sequence[str],
    run: Run,
    source_system: str = SOURCE_SYSTEM,
) -> dict[str, int]:
    """Append CSV files to the entity's bronze table; returns what was counted.

    Missing columns stop it before anything is written.  Row count and NULLs in
    mandatory columns are counted by the write itself, in the same single pass.
    An entity without a raw contract is ingested unchecked.
    """
    rules = entity.raw
    df = add_lineage(read_raw_csv(spark, paths), run, source_system)
    counters = [F.count(F.lit(1)).alias("record_count")]
    if rules is not None:
        check_columns(df, rules)
        counters += [c.alias(f"null_{n}") for c, n in zip(null_counters(rules), rules.mandatory)]
    seen = Observation(f"ingest_{entity.name}")
    lake.append(df.observe(seen, *counters), "bronze", entity.name, partition_by=[PARTITION_COLUMN])
    counts = {k: v or 0 for k, v in seen.get.items()}
    if not counts.get("record_count"):
        lake.append_no_rows(df, "bronze", entity.name, PARTITION_COLUMN, run.ts.date())
    for name, nulls in counts.items():
        if name.startswith("null_") and nulls:
            log.warning("%s: %d rows without %s", entity.name, nulls, name.removeprefix("null_"))
    return counts


def clean(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    run: Run,
    order: str = "dedup_first",
) -> dict[str, float]:
    """Rebuild the entity's silver table from all of bronze; returns its metrics.

    One job does it: the counts are observed after the only shuffle, in the
    tasks that write, so each written partition is counted once even if
    executors are lost.  ``order="validate_first"`` lets a valid row stand in
    for an invalid newer one of the same key.
    """
    if order not in ("dedup_first", "validate_first"):
        raise ValueError("order is 'dedup_first' or 'validate_first'")
    bronze = lake.read(spark, "bronze", entity.name, merge_schema=True)
    compiled = compile_contract(entity.typed, bronze.schema)
    if order == "dedup_first":
        survivors = latest_per_key(bronze, entity.key, copies=COPIES).withColumns(compiled.columns)
    else:
        typed = bronze.withColumns(compiled.columns)
        ok = F.coalesce(compiled.passes, F.lit(False))
        survivors = latest_per_key(typed.withColumn("__ok", ok), entity.key, ("__ok", "ingestion_timestamp"), COPIES)
        survivors = survivors.drop("__ok")
    seen = Observation(f"clean_{entity.name}")
    valid = survivors.observe(seen, *clean_counters(compiled)).where(compiled.passes).drop(COPIES)
    silver = stamp_current(valid.withColumn("processed_timestamp", run.ts_column))
    lake.overwrite(silver, "silver", entity.name, entity.description)
    metrics = metrics_of(seen.get)
    log.info("%s: %s", entity.name, metrics)
    return metrics


def repeated_keys(spark: SparkSession, lake: Lake, entity: Entity) -> DataFrame:
    """Keys on several silver rows; cleaning leaves none."""
    return duplicate_keys(read_silver(spark, lake, entity.name), entity.key)


def _gold(lake: Lake, name: str, df: DataFrame) -> None:
    lake.overwrite(df, "gold", name, GOLD_DESCRIPTIONS[name])


def build_claims_features(spark: SparkSession, lake: Lake, run: Run) -> None:
    claims = read_silver(spark, lake, "claims")
    _gold(lake, "claims_features", features.stamp(features.claims_features(claims), run))


def build_customer_features(spark: SparkSession, lake: Lake, run: Run) -> None:
    per_customer = features.policy_features(read_silver(spark, lake, "policies"))
    joined = features.customer_features(read_silver(spark, lake, "customers"), per_customer)
    _gold(lake, "customer_features", features.stamp(joined, run))


def build_risk_features(spark: SparkSession, lake: Lake, run: Run, **score) -> None:
    """Needs the stored claims features; their timestamp gives way to this run's."""
    policies = read_silver(spark, lake, "policies")
    per_customer = lake.read(spark, "gold", "claims_features")
    scored = features.risk_features(policies, per_customer, **score)
    _gold(lake, "risk_features", features.stamp(scored, run))


def build_monthly_summary(spark: SparkSession, lake: Lake, run: Run) -> None:
    summary = features.monthly_summary(read_silver(spark, lake, "claims"))
    _gold(lake, "monthly_claims_summary", features.stamp(summary, run))


def _together(*steps: Callable[[], object]) -> list:
    """Run independent steps at once, so that small ones do not wait for large ones."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


def run_batch(
    spark: SparkSession,
    lake: Lake,
    sources: Mapping[str, str | Sequence[str]],
    run: Run | None = None,
    entities: Mapping[str, Entity] = ENTITIES,
    incremental: bool = False,
    buckets: int = 1024,
) -> dict[str, dict]:
    """The daily run over the CSV files of all entities; returns all counts.

    Raw files are appended, silver and gold rebuilt from everything stored;
    ``incremental`` brings silver up to date by :func:`clean_new` instead, in this
    many ``buckets``.
    """
    if set(sources) != set(entities):
        raise ValueError(f"sources are needed for exactly these entities: {sorted(entities)}")
    run = run or Run()
    report: dict[str, dict] = {}

    def refine(name: str) -> None:
        report[f"bronze_{name}"] = ingest(spark, lake, entities[name], sources[name], run)
        refresh = partial(clean_new, buckets=buckets) if incremental else clean
        report[f"silver_{name}"] = refresh(spark, lake, entities[name], run)
        if entities[name].audit_keys:
            repeated = repeated_keys(spark, lake, entities[name]).count()
            report[f"silver_{name}"]["repeated_keys"] = repeated
            if repeated:
                log.warning("%s: %d keys on several rows after cleaning", name, repeated)

    def claims_then_risk() -> None:
        build_claims_features(spark, lake, run)
        build_risk_features(spark, lake, run)

    _together(*[partial(refine, name) for name in sources])
    _together(
        claims_then_risk,
        partial(build_customer_features, spark, lake, run),
        partial(build_monthly_summary, spark, lake, run),
    )
    return report
