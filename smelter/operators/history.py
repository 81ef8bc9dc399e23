"""History columns of typed tables: stamp, point-in-time read, full history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.functions.casts import ref
from smelter.functions.timebins import moment
from smelter.operators.dedup import latest_per_key
from smelter.operators.joins import ROWS_PER_PIECE, split_keys

FROM, TO, CURRENT = "effective_from", "effective_to", "is_current"


def stamp_current(df: DataFrame, since: str = "ingestion_timestamp") -> DataFrame:
    """Mark every row as current since its ``since`` time."""
    return df.withColumns(
        {FROM: ref(since), TO: F.lit(None).cast("timestamp"), CURRENT: F.lit(True)}
    )


def current_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(CURRENT))


def as_of(df: DataFrame, when: Column | dt.datetime | str) -> DataFrame:
    """Rows in force at ``when``: begun by then, not ended by then."""
    t = moment(when)
    return df.where((F.col(FROM) <= t) & (F.col(TO).isNull() | (F.col(TO) > t)))


_RANGE, _SEEN, _EDGE = "__range", "__seen", "__edge"


def _neighbour(keys: list[Column], time: str, value: Column, step: int) -> Column:
    """``value`` of the row before (-1) or after (+1) within the key."""
    window = Window.partitionBy(*keys).orderBy(ref(time))
    return (F.lag if step < 0 else F.lead)(value).over(window)


def _with_neighbour(df: DataFrame, keys: list[Column], time: str, name: str, value: Column, step: int) -> DataFrame:
    return df.withColumn(name, _neighbour(keys, time, value, step))


def _with_neighbour_in_ranges(
    df: DataFrame, keys: list[Column], time: str, name: str, value: Column, step: int
) -> DataFrame:
    """The same for keys too frequent for one task; ``_RANGE`` cuts them by time.

    Inside a range the neighbour is found as usual.  Only the first and last row
    of each range then meet in a window over the whole key.  Times are unique
    per key.
    """
    in_range = Window.partitionBy(*keys, _RANGE).orderBy(ref(time))
    edge = F.lag(F.lit(1)).over(in_range).isNull() | F.lead(F.lit(1)).over(in_range).isNull()
    inside = _neighbour([*keys, F.col(_RANGE)], time, F.struct(value.alias("v")), step)
    seen = df.withColumns({_SEEN: inside, _EDGE: edge})
    group = F.when(~F.col(_EDGE), F.col(_RANGE))
    outside = _neighbour([*keys, F.col(_EDGE), group], time, value, step)
    found = F.when(F.col(_SEEN).isNotNull(), F.col(_SEEN)["v"]).otherwise(outside)
    return seen.withColumn(name, found).drop(_SEEN, _EDGE)


def _intervals(rows: DataFrame, keys: list[str], since: str, track: list[str], with_neighbour) -> DataFrame:
    """Version intervals of rows that are unique by key and time."""
    key_cols = list(map(ref, keys))
    state = F.struct(*map(ref, track)) if track else F.struct(F.lit(1))
    marked = with_neighbour(rows, key_cols, since, "__before", state, -1)
    starts = marked.where(~state.eqNullSafe(F.col("__before"))).drop("__before").withColumn(FROM, ref(since))
    closed = with_neighbour(starts, key_cols, since, TO, ref(since), +1)
    return closed.withColumn(CURRENT, F.col(TO).isNull())


def build_history(
    df: DataFrame,
    keys: str | Sequence[str],
    since: str = "ingestion_timestamp",
    track: Sequence[str] | None = None,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Version intervals from all raw versions of each key.

    A version starts where one of the ``track`` columns (default: all but the
    keys and ``since``) differs from the version before, and ends where the next
    one starts.  Of several rows with the same key and time the greatest counts.
    Rows without a time are left out: they cannot be placed.

    Ordinary keys take one shuffle by key and one sort.  Keys with more than
    ``rows_per_piece`` rows are cut into ranges of time that Spark samples, so
    that no task holds all versions of one of them.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    track = list(track) if track is not None else [c for c in df.columns if c not in keys and c != since]
    dated = df.where(ref(since).isNotNull())
    frequent = F.broadcast(split_keys(dated, keys, rows_per_piece).toDF(*[f"__k{i}" for i in range(len(keys))], "__n"))
    same_key = reduce(Column.__and__, [ref(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])

    ordinary = dated.join(frequent, same_key, "left_anti").repartition(*map(ref, keys))
    one_per_time = latest_per_key(ordinary, [*keys, since], newest_by=track)
    history = _intervals(one_per_time, keys, since, track, _with_neighbour)

    many = latest_per_key(dated.join(frequent, same_key, "left_semi"), [*keys, since], newest_by=track)
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = many.repartitionByRange(ranges, *map(ref, [*keys, since])).withColumn(_RANGE, F.spark_partition_id())
    cut = _intervals(ranged, keys, since, track, _with_neighbour_in_ranges).drop(_RANGE)
    return history.unionByName(cut)
