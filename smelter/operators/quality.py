"""Checks and counts that tell how good a table is."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.contracts import Contract
from smelter.functions.casts import ref
from smelter.operators.conform import Compiled, compile_contract
from smelter.operators.dedup import latest_per_key

log = logging.getLogger(__name__)

COPIES = "__copies"


def check_columns(df: DataFrame, contract: Contract) -> None:
    """Raise ValueError unless every contract column exists; no job runs.

    Letter case counts only if the session is case sensitive, as in any Spark query.
    """
    strict = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    known = set(df.columns) if strict else {c.lower() for c in df.columns}
    absent = [c for c in contract.names if (c if strict else c.lower()) not in known]
    if absent:
        raise ValueError(f"{contract.table}: required columns are missing: {absent}")


def null_counters(contract: Contract) -> list[Column]:
    """One aggregate per mandatory column: how many rows lack it."""
    return [F.count_if(ref(c).isNull()).alias(c) for c in contract.mandatory]


def null_audit(df: DataFrame, contract: Contract) -> DataFrame:
    """(column_name, null_count) of the mandatory columns, from one pass.

    It reports and drops nothing.
    """
    check_columns(df, contract)
    return df.agg(*null_counters(contract)).unpivot([], contract.mandatory, "column_name", "null_count")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def clean_counters(compiled: Compiled) -> list[Column]:
    """Aggregates over deduplicated, cast, not yet filtered rows with ``COPIES``.

    A row can fail several checks, so the ``failed_`` counts may overlap.
    """
    ok = F.coalesce(compiled.passes, F.lit(False))
    failed = [
        F.count_if(~F.coalesce(check, F.lit(False))).alias(f"failed_{name}")
        for name, check in compiled.checks.items()
    ]
    return [
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("record_count"),
        F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("duplicate_count"),
        F.count_if(~ok).alias("invalid_count"),
        F.count_if(ok).alias("cleaned_count"),
        *failed,
    ]


def metrics_of(observed: dict[str, int | None]) -> dict[str, float]:
    """Observed :func:`clean_counters`, with what was dropped and the percentage that passed (0 of nothing)."""
    metrics = {k: v or 0 for k, v in observed.items()}
    records = metrics.setdefault("record_count", 0)
    cleaned = metrics.setdefault("cleaned_count", 0)
    return {**metrics, "dropped_count": records - cleaned, "pass_rate": cleaned / records * 100 if records else 0.0}


def with_rates(metrics: DataFrame) -> DataFrame:
    """Add what was dropped, and the percentage that passed (0 of nothing)."""
    rate = F.when(F.col("record_count") > 0, F.col("cleaned_count") / F.col("record_count") * 100)
    return metrics.withColumns(
        {
            "dropped_count": F.col("record_count") - F.col("cleaned_count"),
            "pass_rate": F.coalesce(rate, F.lit(0.0)),
        }
    )


def dq_metrics(
    df: DataFrame,
    contract: Contract,
    keys: str | Sequence[str],
    newest_by: Sequence[str] = ("ingestion_timestamp",),
) -> DataFrame:
    """One row: records, duplicates, invalid, cleaned, per-check failures, rates.

    One scan and one shuffle: each key's row carries the number of its copies.
    """
    survivors = latest_per_key(df, keys, newest_by, copies=COPIES)
    compiled = compile_contract(contract, survivors.schema)
    return with_rates(survivors.withColumns(compiled.columns).agg(*clean_counters(compiled)))
