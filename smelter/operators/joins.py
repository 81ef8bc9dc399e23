"""Left joins of a table with per-key features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.functions.casts import ref

# A key with more rows than this is joined in several pieces.
ROWS_PER_PIECE = 20_000_000
_PIECE, _PIECES = "__piece", "__pieces"


def split_keys(df: DataFrame, keys: Sequence[str], rows_per_piece: int) -> DataFrame:
    """Keys too frequent for one task, and into how many pieces to cut each.

    At most one key per ``rows_per_piece`` rows, some 50,000 for a trillion rows, so it may be broadcast.
    """
    key_cols = list(map(ref, keys))
    return (
        df.groupBy(*key_cols)
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > rows_per_piece)
        .select(*key_cols, F.ceil(F.col("__n") / rows_per_piece).cast("int").alias(_PIECES))
    )


def left_join_features(
    facts: DataFrame,
    features: DataFrame,
    on: str,
    rows_per_piece: int | None = None,
) -> DataFrame:
    """``facts`` left joined with ``features``, whose ``on`` is unique.

    Facts are read and shuffled once.  With ``features`` a stored table both sides of
    the join are plain exchanges, so adaptive execution sees a frequent key, or the
    rows without one, by the sizes of the shuffle itself, cuts those facts by the tasks
    that wrote them and gives each part the key's single features row.

    Where that is switched off, or ``features`` is grouped in the same job,
    ``rows_per_piece`` splits by hand, at the price of one more pass over the key
    column.  A frequent key's facts are then spread over several pieces by their place
    in the input, so that equal rows part too, and its features row is repeated for
    each; rows without a key are spread over as many pieces as a shuffle has
    partitions.  For this ``facts`` should be a stored table: a place is the same each
    time only if its rows come in the same order.

    ``on`` comes first in the result and stands there once.
    """
    if rows_per_piece is None:
        return facts.join(features, on, "left")
    split = F.broadcast(split_keys(facts.where(ref(on).isNotNull()), [on], rows_per_piece))
    row_hash = F.xxhash64(F.monotonically_increasing_id())
    null_pieces = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    piece = (
        F.when(ref(on).isNull(), F.pmod(row_hash, F.lit(null_pieces)).cast("int"))
        .when(F.col(_PIECES).isNotNull(), F.pmod(row_hash, F.col(_PIECES)).cast("int"))
        .otherwise(F.lit(0))
    )
    left = facts.join(split, on, "left").withColumn(_PIECE, piece).drop(_PIECES)
    pieces = F.sequence(F.lit(0), F.coalesce(F.col(_PIECES), F.lit(1)) - 1)
    right = features.join(split, on, "left").withColumn(_PIECE, F.explode(pieces)).drop(_PIECES)
    return left.join(right, [on, _PIECE], "left").drop(_PIECE)
