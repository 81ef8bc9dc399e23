"""Shards of equal size by histogram sort.

Rows are ordered by a key.  The driver holds candidate boundaries only: each round
counts exactly, over all rows, how many bytes and rows lie between neighbouring
candidates, and places new candidates where a boundary is not yet within
tolerance.  When all are, the rows move once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.common import cuts_at_or_below, partitions, saved, whole_text

Cut = tuple[int, int, int]  # rows with a smaller key lie below it

KEY = ("k1", "k2", "k3")
LEAST = -(2**63) + 1
# Candidates per round.
PROBES = 1024


@dataclass(frozen=True)
class Interval:
    """Rows from ``low`` (inclusive; None: from the start) to ``high`` (exclusive; None: to the end)."""

    low: Cut | None
    high: Cut | None
    rows_below: int
    bytes_below: int
    rows: int
    bytes: int
    spans: tuple[tuple[int, int], ...]  # least and greatest value of each key part


def _place(cuts: list[Cut]) -> Column:
    """How many of the sorted cuts a row does not lie below."""
    return cuts_at_or_below([F.col(k) for k in KEY], cuts)


def _candidates(interval: Interval, count: int) -> list[Cut]:
    """Evenly spaced cuts inside an interval, on the first part of the key that varies there."""
    head: tuple[int, ...] = ()
    for least, greatest in interval.spans:
        if least < greatest:
            step = greatest - least
            points = {least + 1 + (step - 1) * i // max(1, count - 1) for i in range(count)}
            rest = (LEAST,) * (len(KEY) - len(head) - 1)
            return sorted((*head, p, *rest) for p in points)
        head = (*head, least)
    return []


def _histogram(rows: DataFrame, cuts: list[Cut]) -> dict[int, tuple]:
    parts = [x for k in KEY for x in (F.min(k), F.max(k))]
    counted = rows.groupBy(_place(cuts).alias("at")).agg(F.count(F.lit(1)), F.sum("size"), *parts)
    return {r[0]: tuple(r)[1:] for r in counted.collect()}


def _intervals(cuts: list[Cut], counts: dict[int, tuple]) -> list[Interval]:
    found, rows, size = [], 0, 0
    edges = [None, *cuts, None]
    for at in range(len(cuts) + 1):
        if at in counts:
            n, b, *ends = counts[at]
            spans = tuple((ends[2 * i], ends[2 * i + 1]) for i in range(len(KEY)))
            found.append(Interval(edges[at], edges[at + 1], rows, size, n, b, spans))
            rows, size = rows + n, size + b
    return found


def splitters(rows: DataFrame, targets: list[tuple[int, int]]) -> list[Interval | None]:
    """For each (bytes, tolerance), sorted, the interval that starts at the boundary nearest to it.

    None stands for the boundary behind all rows.  A boundary is within tolerance,
    or no other lies nearer, since a single key is never cut.
    """
    known = _intervals([], _histogram(rows, []))
    while True:
        wanted: dict[int, None] = {}
        chosen: list[Interval | None] = []
        at = 0
        for target, tolerance in targets:
            while at < len(known) - 1 and known[at].bytes_below + known[at].bytes <= target:
                at += 1
            here = known[at]
            under, over = target - here.bytes_below, here.bytes_below + here.bytes - target
            if min(under, over) > tolerance and _candidates(here, 2):
                wanted[at] = None
            chosen.append(here if under <= over else known[at + 1] if at + 1 < len(known) else None)
        if not wanted:
            return chosen
        each = max(2, PROBES // len(wanted))
        cuts: set[Cut] = set()
        for i in wanted:
            cuts.update(_candidates(known[i], each))
            cuts.update(c for c in (known[i].low, known[i].high) if c is not None)
        ordered = sorted(cuts)
        fresh = _intervals(ordered, _histogram(rows, ordered))
        known = _merged(known, fresh, wanted)


def _merged(known: list[Interval], fresh: list[Interval], wanted: dict[int, None]) -> list[Interval]:
    """Known intervals, those that were refined replaced by their parts."""
    merged: list[Interval] = []
    for i, old in enumerate(known):
        if i not in wanted:
            merged.append(old)
        else:
            merged += [x for x in fresh if old.rows_below <= x.rows_below and x.rows_below + x.rows <= old.rows_below + old.rows]
    return merged


def histogram_shards(rows: DataFrame, shards: int = 16, tolerance: float = 0.001) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard, in key order).

    ``rows`` holds long columns k1, k2, k3 (the key, no nulls) and size, and any
    others; it is read once per round, so it should be a stored table.  Shards are
    ranges of the key whose sizes differ from the mean by at most ``tolerance`` of
    it, or by the largest row.  A range is dealt out in pieces, also cut by the
    histogram, so that no task sorts a whole shard and equal k1 do not stay together
    where that would upset the balance.
    """
    total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not total[0]:
        return rows.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    pieces = min(PROBES // (2 * shards), -(-partitions(rows.sparkSession) // shards))
    parts = max(1, pieces) * shards
    fine, loose = int(tolerance * total[1] / shards), total[1] // (4 * parts)
    targets = [(i * total[1] // parts, fine if i % (parts // shards) == 0 else loose) for i in range(1, parts)]
    starts = splitters(rows, targets)
    cuts = [x.low if x is not None else None for x in starts]
    open_ended = sum(c is None for c in cuts)
    real = [c for c in cuts[: len(cuts) - open_ended]]
    leading = sum(x is not None and x.low is None for x in starts)
    place = F.lit(leading) + _place(real[leading:]) if leading else _place(real)
    begins = [0, *[x.rows_below if x is not None else total[0] for x in starts]]
    per = parts // shards
    offsets = F.array(*[F.lit(b - begins[i // per * per]).cast("long") for i, b in enumerate(begins)])
    window = Window.partitionBy("__part").orderBy(*KEY)
    placed = rows.withColumn("__part", place)
    return placed.withColumns(
        {
            "shard": F.floor(F.col("__part") / per).cast("int"),
            "slot": F.row_number().over(window) - 1 + F.element_at(offsets, F.col("__part") + 1),
        }
    ).drop("__part")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) per row of ``docs`` (doc_id, text); other columns are ignored.

    The key is the hash of the text, then doc_id (null first), then the row's place
    in the input, so equal texts lie side by side and may still be cut.  The size is
    the text's UTF-8 bytes plus 1, of null text 1.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(whole_text()) + 1).cast("long").alias("size"),
        F.crc32(whole_text()).alias("text_crc32"),
        F.xxhash64(whole_text()).alias("k1"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("k2"),
        F.monotonically_increasing_id().alias("k3"),
    )
    dealt = histogram_shards(saved(keyed, "shard-keys"), shards)
    return dealt.select("doc_id", "size", "text_crc32", "shard", "slot")
