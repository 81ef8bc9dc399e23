"""Session settings, run identity and the shared scratch folder."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
import zipfile
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, SparkSession

from smelter.functions.timebins import instant

# Reduce-side partition size to aim for, and the least count.
TARGET_PARTITION_BYTES = 256 * 1024**2
MIN_SHUFFLE_PARTITIONS = 8

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shuffle_partitions_for(input_bytes: int) -> int:
    """Shuffle partitions that keep one reduce task near the target size.

    Adaptive execution merges partitions that turn out small but cannot cut an
    ordinary one that turns out large, so the count follows the input size.
    """
    wanted = -(-input_bytes // TARGET_PARTITION_BYTES)
    return max(MIN_SHUFFLE_PARTITIONS, wanted)


def build_session(
    app_name: str = "smelter",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    input_bytes: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with UTC, adaptive execution and disk-backed streaming state.

    Give ``shuffle_partitions``, or ``input_bytes`` to derive it; with neither
    the cluster's own setting stands.  With ``input_bytes`` small partitions are
    also merged up to the target size, which sets the size of stored files.
    """
    sizing = {}
    if input_bytes is not None:
        shuffle_partitions = shuffle_partitions or shuffle_partitions_for(input_bytes)
        sizing = {
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        }
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(sizing)
    settings.update(extra or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package's sources to the Python workers, once per application.

    Functions that run in tasks are found there by module name, and a worker knows
    neither the driver's import path nor its working folder.  A package that is
    itself inside an archive came by ``--py-files`` and is there already.
    """
    context = spark.sparkContext
    root = Path(__file__).resolve().parent
    if context.applicationId not in _SHIPPED and root.is_dir():
        archive = Path(tempfile.mkdtemp(prefix="smelter-src-")) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent).as_posix())
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: dates and hours are read as UTC everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder named by ``spark.checkpoint.dir``.

    Without that setting only a local master may fall back to a temporary
    folder; executors of a cluster do not share one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="smelter-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass(frozen=True)
class Run:
    """Identity of one run: a single instant and a single UUID for all its rows."""

    ts: dt.datetime = field(default_factory=_now)
    process_id: str = field(default_factory=lambda: str(uuid.uuid4()))

    @property
    def ts_column(self) -> Column:
        return instant(self.ts)
