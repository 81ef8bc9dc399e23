"""Where tables live, and the ways they are written."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

BATCH = "batch_id"
FILE_FORMATS = ("parquet", "orc")
# Of files of these formats; smaller than their default, which matters for tables that are rewritten whole.
COMPRESSION = "zstd"


@dataclass(frozen=True)
class Lake:
    """Tables below one root folder, in one format.

    With a ``database`` fully refreshed tables are also catalog tables there,
    named ``<layer>_<table>``, with their description as comment.  Without one a
    description is handed to the format as a write option, which parquet ignores.
    """

    root: str
    fmt: str = "parquet"
    database: str | None = None

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def read(
        self,
        spark: SparkSession,
        layer: str,
        table: str,
        merge_schema: bool = False,
        schema: T.StructType | str | None = None,
    ) -> DataFrame:
        """The whole table; ``merge_schema`` unites the columns of all appends."""
        reader = spark.read.format(self.fmt)
        if merge_schema:
            reader = reader.option("mergeSchema", True)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(self.path(layer, table))

    def read_or_empty(self, spark: SparkSession, layer: str, table: str, schema: T.StructType) -> DataFrame:
        """The table, or no rows if it has never been written."""
        try:
            return self.read(spark, layer, table, schema=schema)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def _writer(self, df: DataFrame) -> DataFrameWriter:
        writer = df.write.format(self.fmt)
        return writer.option("compression", COMPRESSION) if self.fmt in FILE_FORMATS else writer

    def append(self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()) -> None:
        """Add rows; a column the table lacks so far widens it."""
        writer = self._writer(df).mode("append").option("mergeSchema", True)
        writer.partitionBy(*partition_by).save(self.path(layer, table))

    def append_no_rows(self, df: DataFrame, layer: str, table: str, column: str, value: object) -> None:
        """Store the columns of ``df``, which has no rows, in partition ``column=value``.

        A partitioned write of no rows leaves no file, and so no table to read.
        Formats with a log of their own keep the columns anyway.
        """
        if self.fmt in FILE_FORMATS:
            schema = T.StructType([f for f in df.schema.fields if f.name != column])
            empty = df.sparkSession.createDataFrame([], schema)
            empty.write.format(self.fmt).mode("append").save(f"{self.path(layer, table)}/{column}={value}")

    def overwrite(
        self, df: DataFrame, layer: str, table: str, description: str = "", partition_by: Sequence[str] = ()
    ) -> None:
        """Replace all rows, and describe the table.  ``df`` must not read it."""
        writer = self._writer(df).mode("overwrite").option("overwriteSchema", True).partitionBy(*partition_by)
        if not self.database:
            writer.option("description", description).save(self.path(layer, table))
            return
        name = f"`{self.database}`.`{layer}_{table}`"
        writer.option("path", self.path(layer, table)).saveAsTable(name)
        text = description.replace("\\", "\\\\").replace("'", "\\'")
        df.sparkSession.sql(f"COMMENT ON TABLE {name} IS '{text}'")

    def overwrite_partitions(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str], gather: bool = True
    ) -> None:
        """Replace the partitions that ``df`` has rows of, and no others.

        Rows are brought together by partition first, as in :meth:`write_batch`.
        """
        if gather:
            df = df.hint("rebalance", *partition_by)
        writer = self._writer(df).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(self.path(layer, table))

    def batch_path(self, layer: str, table: str, batch_id: int) -> str:
        return f"{self.path(layer, table)}/{BATCH}={batch_id}"

    @staticmethod
    def _folder(spark: SparkSession, path: str):
        """(file system, path) as Hadoop's own objects."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder

    def partition_values(self, spark: SparkSession, path: str, column: str) -> list[str]:
        """Values of ``column`` among the partition folders right below ``path``, from one listing."""
        files, folder = self._folder(spark, path)
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        return [n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}=")]

    def batches(self, spark: SparkSession, layer: str, table: str) -> list[int]:
        """Numbers of the stored micro-batches, ascending, from one listing of the table's folder."""
        return sorted(map(int, self.partition_values(spark, self.path(layer, table), BATCH)))

    def is_complete(self, spark: SparkSession, path: str) -> bool:
        """Whether Spark's write of this folder has ended."""
        files, folder = self._folder(spark, path + "/_SUCCESS")
        return files.exists(folder)

    def file_counts(self, spark: SparkSession, layer: str, table: str, column: str) -> dict[str, int]:
        """Number of files below each partition folder of ``column``."""
        root = self.path(layer, table)
        counts = {}
        for value in self.partition_values(spark, root, column):
            files, folder = self._folder(spark, f"{root}/{column}={value}")
            counts[value] = files.getContentSummary(folder).getFileCount()
        return counts

    def read_folders(self, spark: SparkSession, layer: str, table: str, folders: Sequence[str]) -> DataFrame:
        """The rows below these partition folders, with the columns of them all; others are not listed."""
        root = self.path(layer, table)
        reader = spark.read.format(self.fmt).option("mergeSchema", True).option("basePath", root)
        return reader.load([f"{root}/{f}" for f in folders])

    def drop_partitions(self, spark: SparkSession, layer: str, table: str, column: str, values: Sequence[object]) -> None:
        """Remove the partition folders ``column=value``; those that do not exist are skipped."""
        for value in values:
            files, folder = self._folder(spark, f"{self.path(layer, table)}/{column}={value}")
            files.delete(folder, True)

    def write_batch(
        self, df: DataFrame, layer: str, table: str, batch_id: int, partition_by: Sequence[str] = (), gather: bool = True
    ) -> None:
        """Store a micro-batch in a folder of its own.

        A batch that is played again after a failure replaces itself, so each
        event is stored once.  Rows are brought together by partition first, or
        a backfill would write a file per task and partition; adaptive execution
        cuts partitions that are too large for one task and merges small ones.
        ``gather=False`` leaves them where they are, for few partitions.
        """
        if partition_by and gather:
            df = df.hint("rebalance", *partition_by)
        writer = self._writer(df).mode("overwrite").partitionBy(*partition_by)
        writer.save(self.batch_path(layer, table, batch_id))

    def read_batch(self, spark: SparkSession, layer: str, table: str, batch_id: int, schema: T.StructType) -> DataFrame:
        return spark.read.format(self.fmt).schema(schema).load(self.batch_path(layer, table, batch_id))
