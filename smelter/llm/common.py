"""Shared helpers: tables in the shared folder, document columns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local master may do with one of its own where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="smelter-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts its lineage.

    A lost executor costs a re-read of files, not a re-run of what made them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Let rows go to Python workers in batches of at most 4 MB, which bounds the buffers of both sides for texts of any length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_of(other: str = "other") -> list[str]:
    """Names of the key of a document row: its id and the hash of its text.

    Rows that agree in both count as one document, so repeated rows get equal results.
    """
    return [f"{other}_id", f"{other}_hash"]


def with_row_key(docs: DataFrame, prefix: str) -> DataFrame:
    """``docs`` with the two key columns added; the prefix keeps clear of other columns."""
    names = row_of(prefix)
    return docs.withColumns({names[0]: F.col("doc_id"), names[1]: F.xxhash64(whole_text())})


def cuts_at_or_below(values: list[Column], cuts: list[tuple[int, ...]]) -> Column:
    """How many of the sorted ``cuts`` are at most the tuple of long columns: a binary search."""
    if not cuts:
        return F.lit(0)
    parts = [F.expr("array(" + ",".join(f"{x}L" for x in part) + ")") for part in zip(*cuts)]
    steps = F.expr("array(" + ",".join(str(1 << i) for i in reversed(range(len(cuts).bit_length()))) + ")")
    row = F.struct(*[v.alias(f"p{i}") for i, v in enumerate(values)])

    def reached(found: Column, step: Column) -> Column:
        cut = F.struct(*[F.get(part, found + step - 1).alias(f"p{i}") for i, part in enumerate(parts)])
        return F.when((found + step <= len(cuts)) & (cut <= row), found + step).otherwise(found)

    return F.aggregate(steps, F.lit(0), reached)
