"""One row per key, and the keys that have more."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smelter.functions.casts import ref

_RANK, _BEST = "__rank_in_key", "__best_of_key"


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    newest_by: Sequence[str] = ("ingestion_timestamp",),
    copies: str | None = None,
) -> DataFrame:
    """The newest row of each key; NULL keys count as one key.

    Ties on ``newest_by`` go by all other columns, so the result does not depend
    on how the data is split.  Either form below keeps one row per key and task
    before the shuffle, so a key that holds a third of the table sends one row
    per task, not a third of the table.

    ``copies`` names an extra column with the number of rows each key had.  Where
    ``df`` has it already, its rows stand for that many, and the counts are added.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    newest = [c for c in newest_by if c in df.columns]
    ranked = [*newest, *[c for c in df.columns if c not in keys and c not in newest and c != copies]]
    if copies is not None:
        best = F.max(F.struct(F.lit(0).alias(_RANK), *map(ref, ranked))).alias(_BEST)
        columns = [ref(c) if c in keys else F.col(_BEST)[c].alias(c) for c in df.columns if c != copies]
        rows = F.sum(ref(copies)) if copies in df.columns else F.count(F.lit(1))
        return df.groupBy(*map(ref, keys)).agg(best, rows.alias(copies)).select(*columns, copies)
    if not ranked:
        return df.distinct()
    window = Window.partitionBy(*map(ref, keys)).orderBy(*[ref(c).desc_nulls_last() for c in ranked])
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys on more than one row, with ``count``; NULL keys are one key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*map(ref, keys)).count().where(F.col("count") > 1)
