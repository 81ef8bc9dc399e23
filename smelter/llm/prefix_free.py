"""Substring dedup by prefix-free parsing and suffix order.

A rolling hash over eight bytes sets triggers: the trigger of a window start is the
least hash among the next ``REACH`` positions.  Starts with the same trigger form a
phrase.  A window holds at least ``REACH`` more bytes than its trigger is away, so
equal windows have equal triggers at equal distance, wherever they occur.

A window is then a phrase suffix (from its start to the trigger) and a parse suffix
(from the trigger on).  Phrases whose parse suffix occurs once are done.  Phrases that
occur with the same surroundings several times are one dictionary entry, and all their
starts are repeats.  What is left are entries with one occurrence beside entries that
share their parse suffix's head; these are put into corpus order: suffix arrays of the
parse suffixes and of the (reversed) phrases with their common prefix lengths give,
for each distance to the trigger, the runs that agree on either side, and starts whose
two runs meet again are repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import partitions, saved, small_batches, whole_text

# Bytes of a repeated string.
LENGTH = 400
# Positions a trigger is sought in; also the most bytes of a phrase before its trigger.
REACH = 128
# Bytes from the trigger on that all windows of a phrase share.
HEAD = LENGTH - REACH + 1
# Bytes hashed for a trigger.
GRAM = 8
# Bytes that are parsed at a time; longer documents are parsed in pieces.
CHUNK = 1 << 18
# Dictionary entries with the same parse suffix head that one task puts into order;
# the windows of larger groups are dealt by their own hash.
GROUP = 4096
# Entries a task holds at once.
HELD = 16384

Batches = Iterator[pa.RecordBatch]
OCCURRENCE = "k long, f long, id long, h long, place long"


def _row_key() -> list[Column]:
    """Key of a row (two longs): doc_id, or a hash of the text where that is null, and a hash of the text."""
    text = whole_text()
    return [F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit("null"), text)).alias("id"), F.xxhash64(text).alias("h")]


def _triggers(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each window start the position of its trigger: the first least hash within reach."""
    grams = np.ndarray(len(data) - GRAM + 1, dtype="<u8", buffer=data, strides=(1,)).astype(np.uint64)
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    keys = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    rows = np.concatenate([keys, np.full(-len(keys) % REACH, np.uint64(2**64 - 1))]).reshape(-1, REACH)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[starts], ahead[starts + REACH - 1])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def phrases(pieces: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each piece with a window: its number, and first start, trigger and last start of its phrases."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces], np.int64)
    begins = np.cumsum(sizes) - sizes
    counts = np.maximum(sizes - LENGTH + 1, 0)
    if not counts.sum():
        return
    starts = np.repeat(begins - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    at = _triggers(data, starts)
    turns = np.flatnonzero(np.diff(at, prepend=-1))
    first, trigger, last = starts[turns], at[turns], starts[np.append(turns[1:], len(starts)) - 1]
    owner = np.searchsorted(begins, first, side="right") - 1
    cuts = np.flatnonzero(np.diff(owner, prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(owner))):
        i = int(owner[a])
        yield i, first[a:b] - begins[i], trigger[a:b] - begins[i], last[a:b] - begins[i]


def _pieces(texts: Iterator[tuple[int, bytes]]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, offset, bytes) gathered to about ``CHUNK`` bytes; pieces of a long text overlap by all but one byte of a window."""
    held, size = [], 0
    for row, data in texts:
        for offset in range(0, max(1, len(data) - LENGTH + 1), CHUNK):
            held.append((row, offset, data[offset : offset + CHUNK + LENGTH - 1]))
            size += len(held[-1][2])
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def _occurrences(batches: Batches) -> Batches:
    """Each phrase occurrence: hash of its parse suffix's head, of its whole surroundings, its row and place.

    The place packs first start, distance to the trigger and number of further starts.
    """
    names = ["k", "f", "id", "h", "place"]
    for batch in batches:
        ids, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts = ((row, t.as_buffer().to_pybytes()) for row, t in enumerate(batch.column(2)))
        for held in _pieces(texts):
            rows, places, heads, wholes = [], [], [], []
            for i, first, trigger, last in phrases([x[2] for x in held]):
                row, offset, data = held[i]
                for a, t, z in zip(first.tolist(), trigger.tolist(), last.tolist()):
                    heads.append(xxhash.xxh3_64_intdigest(data[t : t + HEAD]))
                    wholes.append(xxhash.xxh3_64_intdigest(data[a : z + LENGTH], (t - a) << 16 | (z - a)))
                places.append(((first + offset) << 16) | ((trigger - first) << 8) | (last - first))
                rows.append(np.full(len(first), row))
            if rows:
                row = np.concatenate(rows)
                keys = [np.array(x, np.uint64).view(np.int64) for x in (heads, wholes)]
                columns = [*keys, ids[row], hashes[row], np.concatenate(places)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _packed(batches: Batches) -> Batches:
    """Texts as zstd, for the shuffles."""
    codec = pa.Codec("zstd", compression_level=1)
    for batch in batches:
        texts = [t.as_buffer() for t in batch.column(2)]
        sizes = pa.array([t.size for t in texts], pa.int64())
        packed = pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), sizes, packed], ["id", "h", "doc_id", "n_bytes", "packed"])


def _unpacked(batch: pa.RecordBatch) -> Iterator[bytes]:
    codec = pa.Codec("zstd")
    for size, packed in zip(batch.column("n_bytes").to_pylist(), batch.column("packed")):
        yield codec.decompress(packed.as_buffer(), size, asbytes=True) if size else b""


ENTRY = "k long, id long, h long, place long, once boolean, dealt boolean, phrase binary, tail binary"


def _entries(batches: Batches) -> Batches:
    """Bytes of dictionary entries: the phrase up to its trigger, reversed, and what follows the head."""
    names = [x.split()[0] for x in ENTRY.split(", ")]
    for batch in batches:
        ids, hashes = batch.column("id").to_pylist(), batch.column("h").to_pylist()
        rows: list[tuple] = []
        for id_, h, data, wanted in zip(ids, hashes, _unpacked(batch), batch.column("wanted").to_pylist()):
            for x in wanted:
                start, back, more = x["place"] >> 16, x["place"] >> 8 & 255, x["place"] & 255
                at = start + back
                rows.append((x["k"], id_, h, x["place"], x["once"], x["dealt"], data[start:at][::-1], data[at + HEAD : start + more + LENGTH]))
            if len(rows) >= HELD:
                yield _batch(rows, names, ENTRY)
                rows = []
        if rows:
            yield _batch(rows, names, ENTRY)


_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _batch(rows: list[tuple], names: list[str], schema: str) -> pa.RecordBatch:
    kinds = [_ARROW[x.split()[1]] for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def suffix_order(group: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``strings`` within their groups, and each one's common prefix with the one before (-1: a new group)."""
    order = np.array(sorted(range(len(strings)), key=lambda i: (group[i], strings[i])), np.int64)
    lengths = np.array([len(s) for s in strings], np.int64)[order]
    padded = np.zeros((len(strings), REACH + 1), np.uint8)
    for row, i in enumerate(order):
        padded[row, : lengths[row]] = np.frombuffer(strings[i], np.uint8)
    common = np.full(len(strings), -1, np.int64)
    differ = padded[1:] != padded[:-1]
    agreed = np.where(differ.any(axis=1), differ.argmax(axis=1), REACH + 1)
    common[1:] = np.where(group[order][1:] == group[order][:-1], np.minimum(agreed, np.minimum(lengths[1:], lengths[:-1])), -1)
    return order, common


def repeats_in_corpus_order(group: np.ndarray, back: np.ndarray, more: np.ndarray, phrase: list[bytes], tail: list[bytes]) -> np.ndarray:
    """A row of marks per entry: at distance d from the trigger its window equals one of another entry of the group.

    At distance d a window's phrase suffix has d bytes and its parse suffix, behind the
    head, ``REACH`` - 1 - d.  Entries that agree on either are runs of its suffix array.
    """
    marks = np.zeros((len(group), REACH), bool)
    parse, parse_common = suffix_order(group, tail)
    words, words_common = suffix_order(group, phrase)
    run = np.empty((2, len(group)), np.int64)
    for d in range(REACH):
        owns = np.flatnonzero((d <= back) & (d >= back - more))
        if len(owns) < 2:
            continue
        run[0, parse] = np.cumsum(parse_common < REACH - 1 - d)
        run[1, words] = np.cumsum(words_common < d)
        _, where, times = np.unique(run[0, owns] * (len(group) + 1) + run[1, owns], return_inverse=True, return_counts=True)
        marks[owns, d] = times[where] > 1
    return marks


def _intervals(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    turns = np.flatnonzero(np.diff(starts, prepend=-2) != 1)
    return starts[turns], starts[np.append(turns[1:], len(starts)) - 1]


FOUND = "id long, h long, first long, last long"


def _ordered(batches: Batches) -> Batches:
    """Repeated starts of entries that occur once; entries arrive sorted by head."""
    names = [x.split()[0] for x in FOUND.split(", ")]

    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        heads, place, once = (table.column(c).to_numpy() for c in ("k", "place", "once"))
        group = np.cumsum(np.diff(heads, prepend=heads[:1]) != 0)
        back, more = place >> 8 & 255, place & 255
        marks = repeats_in_corpus_order(group, back, more, table.column("phrase").to_pylist(), table.column("tail").to_pylist())
        rows = []
        ids, hashes = table.column("id").to_pylist(), table.column("h").to_pylist()
        for i in np.flatnonzero(once & marks.any(axis=1)):
            trigger = (place[i] >> 16) + back[i]
            for a, z in zip(*_intervals(np.sort(trigger - np.flatnonzero(marks[i])))):
                rows.append((ids[i], hashes[i], int(a), int(z)))
        if rows:
            yield _batch(rows, names, FOUND)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        heads = batch.column("k").to_numpy()
        turns = np.flatnonzero(np.diff(heads)) + 1
        cut = int(turns[-1]) if len(turns) else 0
        if cut and sum(b.num_rows for b in held) + cut >= HELD:
            yield from found(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held, batch = [], batch.slice(cut)
        elif held and len(heads) and held[-1].column("k")[-1].as_py() != heads[0] and sum(b.num_rows for b in held) >= HELD:
            yield from found(pa.Table.from_batches(held))
            held = []
        if batch.num_rows:
            held.append(batch)
    if held:
        yield from found(pa.Table.from_batches(held))


WINDOW = "high long, low long, id long, h long, start long, once boolean"


def _windows(batches: Batches) -> Batches:
    """The windows of entries of large groups, each as a hash of head, phrase suffix and parse suffix."""
    names = [x.split()[0] for x in WINDOW.split(", ")]
    for batch in batches:
        rows: list[tuple] = []
        for x in batch.to_pylist():
            back, more = x["place"] >> 8 & 255, x["place"] & 255
            for d in range(back - more, back + 1):
                digest = xxhash.xxh3_128_digest(x["k"].to_bytes(8, "little", signed=True) + bytes([d]) + x["phrase"][:d] + x["tail"][: REACH - 1 - d])
                high, low = np.frombuffer(digest, "<i8").tolist()
                rows.append((high, low, x["id"], x["h"], (x["place"] >> 16) + back - d, x["once"]))
            if len(rows) >= HELD:
                yield _batch(rows, names, WINDOW)
                rows = []
        if rows:
            yield _batch(rows, names, WINDOW)


RESULT = "doc_id long, n_bytes long, removed array<struct<first:long,last:long>>, kept binary"


def _cut(batches: Batches) -> Batches:
    """Texts without the bytes of repeated windows, given the windows' starts as intervals."""
    spans = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    for batch in batches:
        removed, kept = [], []
        for data, found in zip(_unpacked(batch), batch.column("found").to_pylist()):
            runs: list[list[int]] = []
            for x in sorted((f["first"], f["last"] + LENGTH) for f in found or ()):
                if runs and x[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], x[1])
                else:
                    runs.append(list(x))
            edges = [0, *[e for r in runs for e in r], len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            removed.append([{"first": a, "last": b - 1} for a, b in runs])
        columns = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, spans), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "removed", "kept"])


def repeated_starts(docs: DataFrame) -> DataFrame:
    """(id, h, first, last): runs of window starts, by row key, whose window starts somewhere else too.

    Runs may repeat or overlap.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(*_row_key(), whole_text().alias("text"))
    found = rows.mapInArrow(_occurrences, OCCURRENCE)
    # Stored, so that each join below has plain exchanges on both sides, which adaptive execution splits at a hot head.
    repeated = saved(found.groupBy("k").count().where("count > 1").select("k"), "heads")
    live = saved(found.join(repeated, "k"), "phrases")
    first = F.min(F.struct("id", "h", "place")).alias("first")
    entries = saved(live.groupBy("k", "f").agg(F.count(F.lit(1)).alias("n"), first), "entries")
    groups = entries.groupBy("k").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    open_groups = saved(groups.where("kinds > 1 and least = 1").select("k", (F.col("kinds") > GROUP).alias("dealt")), "open")
    wanted = (
        entries.join(open_groups, "k")
        .select("first.*", F.struct("k", "first.place", (F.col("n") == 1).alias("once"), "dealt").alias("entry"))
        .groupBy("id", "h")
        .agg(F.collect_list("entry").alias("wanted"))
    )
    pack = docs.select(*_row_key(), whole_text().alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    packed = pack.mapInArrow(_packed, "id long, h long, doc_id long, n_bytes long, packed binary")
    texts = packed.join(wanted, ["id", "h"]).select("id", "h", "n_bytes", "packed", "wanted").mapInArrow(_entries, ENTRY)
    held = saved(texts, "dictionary")
    in_order = held.where("not dealt").repartition(partitions(docs.sparkSession), "k").sortWithinPartitions("k")
    ordered = in_order.mapInArrow(_ordered, FOUND)
    windows = held.where("dealt").mapInArrow(_windows, WINDOW)
    twice = saved(windows.groupBy("high", "low").count().where("count > 1").select("high", "low"), "windows")
    dealt = windows.where("once").join(twice, ["high", "low"]).select("id", "h", F.col("start").alias("first"), F.col("start").alias("last"))
    start = F.shiftright("place", 16)
    whole = live.join(entries.where("n > 1").select("k", "f"), ["k", "f"])
    whole = whole.select("id", "h", start.alias("first"), (start + F.col("place").bitwiseAND(255)).alias("last"))
    return whole.union(ordered).union(dealt)


def drop_repeated_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, removed, kept) per row of ``docs`` (doc_id, text); other columns are ignored.

    ``kept`` is the text's UTF-8 without every byte that lies in a string of ``LENGTH``
    bytes which starts at any other place too, in this row or another; ``removed`` lists
    the maximal runs taken out (first and last byte).  Strings are judged on the input,
    and every occurrence goes, the first one too.  It may split a character, hence
    bytes.  A null text is empty; texts shorter than ``LENGTH`` stay whole.  Each row is
    a document of its own, so rows that repeat another lose all their windows, also
    with equal or null doc_id.  A long run of one byte has a trigger per byte.

    Strings are told apart by 64-bit hashes of head and surroundings together, or 128
    bits.  Rows are shuffled by head after a count by head; entries of a head that more
    than ``GROUP`` of them share are dealt by single windows instead.
    """
    found = repeated_starts(docs).groupBy("id", "h").agg(F.collect_set(F.struct("first", "last")).alias("found"))
    pack = docs.select(*_row_key(), whole_text().alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    packed = pack.mapInArrow(_packed, "id long, h long, doc_id long, n_bytes long, packed binary")
    return packed.join(found, ["id", "h"], "left").select("doc_id", "n_bytes", "packed", "found").mapInArrow(_cut, RESULT)
