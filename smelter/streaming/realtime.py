"""Typed real-time claims, and alerts as they happen."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from smelter.contracts import Contract
from smelter.entities import REALTIME_CLAIMS
from smelter.operators.conform import conform
from smelter.operators.history import stamp_current
from smelter.operators.monitor import HIGH_VALUE, TIME, high_value
from smelter.streaming.progress import rows_dropped_late, start, whole_progress

SPREAD = 16
_PART = "__part"
_RECEIVED, _KEPT = "claims_received", "claims_kept"


def _once_per_batch(at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of the rows of one Arrow batch that agree in column ``at``, the first."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(at).dictionary_encode().indices.fill_null(-1).to_numpy()
            _, first = np.unique(codes, return_index=True)
            yield batch if len(first) == len(codes) else batch.take(pa.array(np.sort(first)))

    return reduce


def typed_claims(
    events: DataFrame,
    contract: Contract = REALTIME_CLAIMS,
    key: str = "claim_id",
    lateness: str | None = None,
    spread: int = SPREAD,
) -> DataFrame:
    """Valid events of a stream, the first seen of each key, with history columns.

    Rows are checked before they are deduplicated: an invalid event cannot
    displace a valid one, and rows without a key never reach the shuffle.

    With ``lateness`` a key is remembered that long; without it forever, which
    is exact but lets state grow with the number of keys.  A key that arrives
    very often is first reduced in ``spread`` parts, one row per part and key,
    so no single task gets all of it; ``spread=0`` saves that step's state.

    The query's progress carries the counts that ``quality`` reads.
    """
    received = events.observe(_RECEIVED, F.count(F.lit(1)).alias("n"))
    valid = conform(received, contract)
    if lateness:
        valid = valid.withWatermark(TIME, lateness)

    def first_of(df: DataFrame, *columns: str) -> DataFrame:
        subset = list(columns)
        return df.dropDuplicatesWithinWatermark(subset) if lateness else df.dropDuplicates(subset)

    if spread and not lateness:
        valid = valid.mapInArrow(_once_per_batch(valid.columns.index(key)), valid.schema)
    elif spread:
        part = F.pmod(F.spark_partition_id(), F.lit(spread))
        valid = first_of(valid.withColumn(_PART, part), key, _PART).drop(_PART)
    once = first_of(valid, key).observe(_KEPT, F.count(F.lit(1)).alias("n"))
    return stamp_current(once.withColumn("processed_timestamp", F.current_timestamp()), since=TIME)


def start_realtime_silver(
    events: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: str | None = None,
    **how,
) -> StreamingQuery:
    """Append :func:`typed_claims` of the stream to a table, each event once.

    ``how`` takes the parameters of ``typed_claims``.
    """
    writer = typed_claims(events, **how).writeStream.format(fmt).outputMode("append").option("path", path)
    return start(writer, checkpoint, every)


def quality(query: StreamingQuery) -> dict[str, float]:
    """Records, cleaned, dropped, late and pass rate of a query over :func:`typed_claims`.

    They cover every micro-batch of the query's run.  A stage that runs again after
    a lost executor may count received records twice.  ``late_count`` is the part
    of ``dropped_count`` that came behind the watermark.
    """
    batches = [p.observedMetrics for p in whole_progress(query) if p.numInputRows]
    records = sum(m[_RECEIVED].n for m in batches if _RECEIVED in m)
    cleaned = sum(m[_KEPT].n for m in batches if _KEPT in m)
    return {
        "record_count": records,
        "cleaned_count": cleaned,
        "dropped_count": records - cleaned,
        "late_count": rows_dropped_late(query),
        "pass_rate": cleaned / records * 100 if records else 0.0,
    }


def start_alerts(
    events: DataFrame,
    path: str,
    checkpoint: str,
    threshold: float = HIGH_VALUE,
    fmt: str = "parquet",
    every: str | None = None,
) -> StreamingQuery:
    """Append high-value events to a table as they arrive; keeps no state."""
    writer = high_value(events, threshold).writeStream.format(fmt).outputMode("append").option("path", path)
    return start(writer, checkpoint, every)
