"""Raw files and event streams."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


# Files whose heads are read at the same time.
HEADS_AT_ONCE = 32


def read_raw_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV files with a header line, every column a string, nothing inferred.

    Spark applies one header to all files of a read.  So files are grouped by their
    header line, each group is read with its own, and the groups are put together
    by column name; a column that a file lacks is NULL there.  Headers are found by
    opening each file and reading its first line, so no other byte is read twice; the
    driver lists files for every read anyway and here keeps one line per group.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("header", True).option("inferSchema", False)
    groups = _files_by_header(spark, paths)
    if len(groups) < 2:
        return reader.csv(paths)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(reader.csv, groups))


def _files_by_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The files of the paths, those with the same header line together; the largest group first."""
    files = [unquote(f) for f in spark.read.text(paths).inputFiles()]
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        for file, header in zip(files, pool.map(lambda f: _first_line(spark, conf, f), files)):
            if header is not None:
                groups.setdefault(header, []).append(file)
    return [sorted(groups[h]) for h in sorted(groups, key=lambda h: (-len(groups[h]), h))]


def _first_line(spark: SparkSession, conf: JavaObject, file: str) -> str | None:
    """The first line of a file, compressed or not, that is not blank; none if there is no such line."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stored = path.getFileSystem(conf).open(path)
    try:
        content = codec.createInputStream(stored) if codec is not None else stored
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, "UTF-8"))
        line = lines.readLine()
        while line is not None and not line.strip():
            line = lines.readLine()
        return line
    finally:
        stored.close()


def read_event_array(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON documents that hold an array of objects, one row per object.

    Such a file is read by one task; for volume write one object per line.
    """
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def stream_events(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "text",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Unbounded event source.

    ``text`` gives one JSON document per line in ``value``; any other Spark
    streaming source works the same, Kafka with its jar as ``fmt="kafka"``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()
