"""Starting queries and reading their progress."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


# Micro-batches whose progress a query keeps, so that sums over a run are whole.
KEPT_BATCHES = 1_000_000
_RETENTION = "spark.sql.streaming.numRecentProgressUpdates"


def whole_progress(query: StreamingQuery) -> list:
    """The progress of every micro-batch of the query's run; an error if Spark has let some go."""
    progress = query.recentProgress
    if len(progress) >= KEPT_BATCHES:
        raise RuntimeError(f"more than {KEPT_BATCHES} micro-batches; their counts are no longer all known")
    return progress


def start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    """Start a query: every ``every`` (such as "1 minute"), or once over all pending data."""
    writer = writer.option("checkpointLocation", checkpoint)
    SparkSession.active().conf.set(_RETENTION, str(KEPT_BATCHES))
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_pending(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query started without ``every``; a failure is raised here."""
    query.awaitTermination()
    return query


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows the query's watermark has dropped during its run."""
    return sum(op.numRowsDroppedByWatermark for p in whole_progress(query) for op in p.stateOperators)
