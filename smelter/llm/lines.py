"""Line dedup: lines equal to an earlier line, or within two edits of one, are removed.

Near-equal lines are found by a segment-partition join.  A line is cut into three
segments; a line within two edits of it, and not shorter, contains one of them
unchanged at a place that the lengths of both bound.  Every line is therefore
filed under its segments, by their number and its length, and looks up the
substrings at those places for its own length and the two below.  What meets is
compared by a sketch of its letter pairs, which two edits change in eight bits at
most, and then by banded bit-parallel edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.llm.common import partitions, saved, whole_text

EDITS = 2
# Lines of fewer code points are never compared: short ones agree by chance.
MIN_EQUAL = 12
MIN_NEAR = 32
# Runs of one key up to SMALL are compared row by row, up to BLOCK as a table; longer
# ones are cut into blocks, and every two blocks meet in a task of their own.
SMALL = 32
BLOCK = 2048
# Lines whose segments a task lists at once, about fifteen each, and line lengths whose cells it keeps at hand.
LINES_AT_ONCE, LENGTHS = 1_000, 1_024
# Ids of compared lines sent to all tasks, at most; beyond that the lines are joined.
BROADCAST_IDS = 500_000
LAST_ID = 2**63 - 1
_SKETCH_BITS = 4 * EDITS


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether at most ``edits`` insertions, deletions or substitutions turn ``a`` into ``b``.

    One column of the distance table at a time, as bits of the 2 * edits + 1 cells
    around its diagonal.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    start, end = 0, min(len(a), len(b))
    while start < end and a[start] == b[start]:
        start += 1
    stop = 0
    while stop < end - start and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    a, b = a[start : len(a) - stop], b[start : len(b) - stop]
    m, n = len(a), len(b)
    if m <= edits or n <= edits:
        return _distance(a, b) <= edits
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    width = 2 * edits + 1
    mask, top = (1 << width) - 1, 1 << (2 * edits)
    up, down, distance = (mask >> edits) << edits, 0, edits
    for j in range(1, n + 1):
        found = places.get(b[j - 1], 0)
        shift = j - edits - 1
        x = (found >> shift if shift >= 0 else found << -shift) & mask
        d0 = ((((x & up) + up) ^ up) | x | down) & mask
        hp = (down | ~(d0 | up)) & mask
        hn = d0 & up
        if j + edits <= m:
            distance += 0 if d0 & top else 1
        else:
            at = 1 << (m - j + edits)
            distance += bool(hp & at) - bool(hn & at)
        up = (hn | ~((d0 >> 1) | hp)) & mask
        down = (d0 >> 1) & hp
    return distance <= edits


def _distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (c != d))
    return row[-1]


@lru_cache(maxsize=LENGTHS)
def _cells(length: int) -> tuple[tuple[int, int, int, int], ...]:
    """(seed, start, end, role) of the substrings a line of this length files (0) and looks up (1)."""

    def segments(total: int) -> list[tuple[int, int]]:
        edges = [total * i // (EDITS + 1) for i in range(EDITS + 2)]
        return list(zip(edges, edges[1:]))

    cells = [(length * 4 + i, p, q, 0) for i, (p, q) in enumerate(segments(length))]
    for other in range(max(MIN_NEAR, length - EDITS), length + 1):
        shift = length - other
        for i, (p, q) in enumerate(segments(other)):
            low = max(0, p - i, p + shift - (EDITS - i))
            high = min(length - (q - p), p + i, p + shift + (EDITS - i))
            cells += [(other * 4 + i, at, at + q - p, 1) for at in range(low, high + 1)]
    return tuple(cells)


def _sketches(lines: list[str]) -> np.ndarray:
    """64 bits per line, each the parity of how many letter pairs hash to it."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    pairs = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)
    bits = np.uint64(1) << (pairs >> np.uint32(26)).astype(np.uint64)
    ends = np.cumsum([len(x) for x in lines])
    edges = np.stack([np.concatenate(([0], ends[:-1])), ends - 1], axis=1).ravel()
    edges[-1] = min(edges[-1], len(bits))
    bits = np.concatenate([bits, np.zeros(1, np.uint64)])
    return np.bitwise_xor.reduceat(bits, edges)[::2]


def line_id(line: str) -> int:
    """The hash of a line without its last bit, as a signed number."""
    value = xxhash.xxh64_intdigest(line, 42) & ~1
    return value - (1 << 64) if value >> 63 else value


def _segment_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, id with the role as last bit, sketch); each line once per batch."""
    digest = xxhash.xxh64_intdigest
    for batch in batches:
        lines: dict[str, None] = {}
        for text in batch.column(0):
            for line in text.as_py().split("\n"):
                if len(line) >= MIN_NEAR:
                    lines[line] = None
        listed = list(lines)
        for begin in range(0, len(listed), LINES_AT_ONCE):
            part = listed[begin : begin + LINES_AT_ONCE]
            keys: list[int] = []
            ids: list[int] = []
            counts = []
            for line in part:
                cells = _cells(len(line))
                keys += [digest(line[p:q], seed) for seed, p, q, _ in cells]
                one = digest(line, 42) & ~1
                ids += [one | role for *_, role in cells]
                counts.append(len(cells))
            sketches = np.repeat(_sketches(part), counts)
            columns = [np.array(keys, np.uint64), np.array(ids, np.uint64), sketches]
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], ["key", "id", "sketch"])


def _pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = (a & ~np.uint64(1)).view(np.int64), (b & ~np.uint64(1)).view(np.int64)
    return np.minimum(a, b), np.maximum(a, b)


def _near(a_id, a_sketch, b_id, b_sketch) -> np.ndarray:
    crossing = ((a_id ^ b_id) & np.uint64(1)).astype(bool) & ((a_id | np.uint64(1)) != (b_id | np.uint64(1)))
    return crossing & (np.bitwise_count(a_sketch ^ b_sketch) <= _SKETCH_BITS)


def _table_pairs(ids: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs inside one run of a key."""
    ids, once = np.unique(ids, return_index=True)
    sketches = sketches[once]
    filed = (ids & np.uint64(1)) == 0
    i_id, i_sketch, p_id, p_sketch = ids[filed], sketches[filed], ids[~filed], sketches[~filed]
    left, right = [], []
    for begin in range(0, len(p_id), 256):
        q, s = p_id[begin : begin + 256, None], p_sketch[begin : begin + 256, None]
        row, column = np.nonzero(_near(q, s, i_id[None, :], i_sketch[None, :]))
        left.append(q[row, 0])
        right.append(i_id[column])
    none = np.zeros(0, np.uint64)
    return _pairs(np.concatenate([none, *left]), np.concatenate([none, *right]))


def _found(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    zero = np.zeros(len(a), np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(a), pa.array(b), pa.array(zero), pa.array(np.full(len(a), -1, np.int32))], ["a", "b", "sketch", "block"]
    )


def _long(key: np.ndarray, ids: np.ndarray, sketches: np.ndarray, before: int) -> pa.RecordBatch:
    block = ((before + np.arange(len(key))) // BLOCK).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(ids.view(np.int64)), pa.array(sketches.view(np.int64)), pa.array(block)],
        ["a", "b", "sketch", "block"],
    )


def _in_runs(key: np.ndarray, ids: np.ndarray, sketches: np.ndarray) -> Iterator[pa.RecordBatch]:
    begins = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    lengths = np.diff(np.concatenate((begins, [len(key)])))
    small = np.repeat(lengths <= SMALL, lengths)
    k, i, s = key[small], ids[small], sketches[small]
    for step in range(1, min(SMALL, len(k))):
        same = np.flatnonzero(k[step:] == k[:-step])
        if not len(same):
            break
        same = same[_near(i[same], s[same], i[same + step], s[same + step])]
        if len(same):
            yield _found(*_pairs(i[same], i[same + step]))
    for begin, length in zip(begins[lengths > SMALL].tolist(), lengths[lengths > SMALL].tolist()):
        a, b = _table_pairs(ids[begin : begin + length], sketches[begin : begin + length])
        if len(a):
            yield _found(a, b)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, 0, -1), and rows (key, id, sketch, block) of runs too long for one task's memory."""
    held: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
    long_key, long_rows = None, 0
    for batch in batches:
        fresh = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)]
        k = np.concatenate((held[0], fresh[0]))
        i = np.concatenate((held[1], fresh[1].view(np.uint64)))
        s = np.concatenate((held[2], fresh[2].view(np.uint64)))
        if long_key is not None:
            n = int(np.searchsorted(k, long_key, side="right"))
            yield _long(k[:n], i[:n], s[:n], long_rows)
            long_rows += n
            k, i, s = k[n:], i[n:], s[n:]
            if not len(k):
                held = [k, i, s]
                continue
            long_key = None
        cut = int(np.searchsorted(k, k[-1])) if len(k) else 0
        if cut:
            yield from _in_runs(k[:cut], i[:cut], s[:cut])
        held = [k[cut:], i[cut:], s[cut:]]
        if len(held[0]) > BLOCK:
            long_key, long_rows = held[0][0], len(held[0])
            yield _long(*held, 0)
            held = [x[:0] for x in held]
    if len(held[0]):
        yield from _in_runs(*held)


def _block_pairs(_key, group):
    import pandas as pd

    a, b = _table_pairs(group["b"].to_numpy().view(np.uint64), group["sketch"].to_numpy().view(np.uint64))
    return pd.DataFrame({"a": a, "b": b})


def candidate_pairs(texts: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of line ids that share a segment and agree in their sketches."""
    keys = texts.mapInArrow(_segment_keys, "key long, id long, sketch long")
    dealt = keys.repartition(partitions(texts.sparkSession), "key").sortWithinPartitions("key")
    met = saved(dealt.mapInArrow(_meet, "a long, b long, sketch long, block int"), "line-pairs")
    pairs = met.where("block < 0").select("a", "b")
    rows = met.where("block >= 0").withColumnRenamed("a", "key")
    if not rows.isEmpty():
        rows = rows.groupBy("key", "b", "sketch").agg(F.min("block").alias("block"))
        last = rows.groupBy("key").agg(F.max("block").alias("last"))
        meetings = rows.join(last, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
        meetings = meetings.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")})
        grouped = meetings.select("key", "one", "two", "b", "sketch").groupBy("key", "one", "two")
        pairs = pairs.union(grouped.applyInPandas(_block_pairs, "a long, b long"))
    return pairs.distinct()


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [within(a.as_py(), b.as_py()) for a, b in zip(batch.column(2), batch.column(3))]
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _line_ids(line: Column) -> Column:
    return F.xxhash64(line).bitwiseAND(-2)


def near_lines(texts: DataFrame) -> DataFrame:
    """Links (a, b) between the ids of different lines within two edits, each once, a < b.

    ``texts`` has one column of texts without nulls.
    """
    pairs = saved(candidate_pairs(texts), "line-candidates")
    ids = saved(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "line-ids")
    lines = texts.select(F.explode_outer(F.split("text", "\n")).alias("line")).where(F.char_length("line") >= MIN_NEAR)
    few = ids.count() <= BROADCAST_IDS
    known = lines.withColumn("id", _line_ids(F.col("line"))).join(F.broadcast(ids) if few else ids, "id", "left_semi")
    known = saved(known.dropDuplicates(["id"]), "line-texts")
    sides = pairs.join(known.select(F.col("id").alias("a"), F.col("line").alias("one")), "a")
    sides = sides.join(known.select(F.col("id").alias("b"), F.col("line").alias("two")), "b")
    return sides.select("a", "b", "one", "two").mapInArrow(_verify, "a long, b long")


def _without_lines(at: int):
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, removed, links = [], [], [], []
            extra = batch.num_columns - 2
            for text, later, n in zip(batch.column(at), batch.column(extra), batch.column(extra + 1)):
                text, later = text.as_py(), set(later.as_py() or ())
                lines = (text or "").split("\n")
                kept, seen = [], set()
                for line in lines:
                    if len(line) >= MIN_EQUAL:
                        if line in seen or later and line_id(line) in later:
                            continue
                        seen.add(line)
                    kept.append(line)
                texts.append(text if len(kept) == len(lines) else "\n".join(kept))
                counts.append(len(lines))
                removed.append(len(lines) - len(kept))
                links.append(n.as_py() or 0)
            columns = [batch.column(i) for i in range(extra)]
            columns[at] = pa.array(texts, type=batch.column(at).type)
            numbers = [pa.array(x, pa.int64()) for x in (counts, removed, links)]
            yield pa.RecordBatch.from_arrays([*columns, *numbers], batch.schema.names[:extra] + list(COUNTS))

    return rewrite


COUNTS = ("lines", "removed_lines", "line_links")


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``text`` shortened, and the counts ``lines``, ``removed_lines``, ``line_links``.

    Of equal lines of at least 12 code points the first stays, by doc_id (null last)
    and place.  A line of at least 32 within two edits of another one is removed
    everywhere if the other occurs first (by the least doc_id that has it, then by
    id).  ``line_links`` counts the links between different lines that the
    document's lines take part in.  Rows that share a doc_id count as one document.
    No row is dropped: a text may end up empty.  Null texts stay null.  Columns of
    ``docs`` named like the counts are replaced; others pass through.
    """
    docs = docs.drop(*COUNTS)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    rows = docs.select(key.alias("doc"), whole_text().alias("text"))
    lines = rows.select("doc", F.explode_outer(F.split("text", "\n")).alias("line")).where(F.char_length("line") >= MIN_EQUAL)
    own = lines.select("doc", _line_ids(F.col("line")).alias("id"), F.xxhash64(F.lit(1), "line").alias("more"))
    first = own.groupBy("id", "more").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    links = saved(near_lines(rows.select("text")), "line-links")
    ends = links.select(F.col("a").alias("id")).union(links.select(F.col("b").alias("id")))
    degrees = ends.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    firsts = saved(first.join(degrees, "id", "left").where("last > first or n is not null"), "line-firsts")
    begins = firsts.where("n is not null").groupBy("id").agg(F.min("first").alias("first"))
    ordered = links.join(begins.select(F.col("id").alias("a"), F.col("first").alias("a_first")), "a").join(
        begins.select(F.col("id").alias("b"), F.col("first").alias("b_first")), "b"
    )
    worse = F.when(F.col("a_first") <= F.col("b_first"), F.col("b")).otherwise(F.col("a"))
    losers = ordered.select(worse.alias("id")).distinct().withColumn("lost", F.lit(True))
    marks = firsts.join(losers, "id", "left").select("id", "more", "first", "n", F.coalesce("lost", F.lit(False)).alias("lost"))
    mine = own.join(marks, ["id", "more"])
    gone = F.when(F.col("lost") | (F.col("doc") > F.col("first")), F.col("id"))
    lists = mine.groupBy(F.col("doc").alias("__doc")).agg(
        F.collect_set(gone).alias("__later"), F.sum("n").alias("__links")
    )
    known = docs.join(lists, key == F.col("__doc"), "left")
    known = known.select(*[docs[c] for c in docs.columns], "__later", "__links")
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.LongType()) for c in COUNTS]])
    return known.mapInArrow(_without_lines(docs.columns.index("text")), schema)
