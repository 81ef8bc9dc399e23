"""Lineage columns of raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.session import Run

SOURCE_SYSTEM = "legacy_csv"
PARTITION_COLUMN = "ingestion_date"
LINEAGE_COLUMNS = (
    "ingestion_timestamp",
    PARTITION_COLUMN,
    "source_system",
    "process_id",
    "source_file_name",
)


def add_lineage(df: DataFrame, run: Run, source_system: str = SOURCE_SYSTEM) -> DataFrame:
    """Say when, by which run and from which file each row came.

    Time and UUID are the run's, the same for every row and every action.  The
    file is that of the scan below, so call this right after reading.
    """
    return df.withColumns(
        {
            "ingestion_timestamp": run.ts_column,
            PARTITION_COLUMN: F.to_date(run.ts_column),
            "source_system": F.lit(source_system),
            "process_id": F.lit(run.process_id),
            "source_file_name": F.col("_metadata.file_path"),
        }
    )
