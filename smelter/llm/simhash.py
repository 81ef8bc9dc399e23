"""Near-duplicates by SimHash fingerprints and pigeonring filtering.

The 64 bits are cut into five segments laid out in a ring.  If two fingerprints
differ in at most four bits then, from some segment on, every chain of l
consecutive segments differs in at most l * 4/5 bits: 0, 1, 2, 3, 4 for one to
five segments.  Chains of two segments are found by a join key (first segment
whole, second with one bit masked); the longer chains prune the candidates, and
the chain of five is the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import partitions, saved, whole_text
from smelter.llm.components import connected_components

SHINGLE = 4
SEED = 42
LIMIT = 4
# Offsets and widths of the ring's segments.
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
# Runs of one key up to SMALL are compared pair by pair, up to BLOCK inside one task's
# memory; longer ones are cut into blocks and every two blocks meet in a task of their own.
SMALL = 32
BLOCK = 4096

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE = (np.arange(8) * 256)[None, :]
_SIGNS = np.uint64(1)
_PART = np.array([((1 << w) - 1) << o for o, w in SEGMENTS], dtype=np.uint64)
# _CHAIN[l - 1][i]: the bits of the l segments from segment i on.
_CHAIN = np.zeros((len(SEGMENTS), len(SEGMENTS)), dtype=np.uint64)
for _l in range(len(SEGMENTS)):
    for _i in range(len(SEGMENTS)):
        for _j in range(_l + 1):
            _CHAIN[_l][_i] |= _PART[(_i + _j) % len(SEGMENTS)]
_QUOTA = [(l + 1) * LIMIT // len(SEGMENTS) for l in range(len(SEGMENTS))]


def shingle_hashes(data: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles of UTF-8 text, repeats included; of the whole sequence if it has fewer words."""
    words = data.lower().split()  # bytes: only A-Z change, and only ASCII white space separates
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    return np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)


def folded(hashes: np.ndarray) -> int:
    """The unsigned SimHash of shingle hashes; 0 without any."""
    counts = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _BYTE).ravel(), minlength=2048).reshape(8, 256)
    bits = 2 * (counts @ _BITS) > len(hashes)
    return int(np.packbits(bits.reshape(64), bitorder="little").view("<u8")[0])


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of UTF-8 text; 0 without words."""
    return folded(shingle_hashes(data, shingle))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        found = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) per row; fp is the unsigned fingerprint as a signed long.  Null text counts as empty."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id long, fp long")


def _chain_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in range(0, batch.num_rows, 2000):
            fps = batch.column(0).slice(part, 2000).to_numpy(zero_copy_only=False).view(np.uint64)
            keys = []
            for i, (offset, width) in enumerate(SEGMENTS):
                after, after_width = SEGMENTS[(i + 1) % len(SEGMENTS)]
                head = (fps >> np.uint64(offset)) & np.uint64((1 << width) - 1)
                tail = (fps >> np.uint64(after)) & np.uint64((1 << after_width) - 1)
                for p in range(after_width):
                    masked = tail & np.uint64(~(1 << p) & 0xFFFF)
                    keys.append(np.uint64(i << 40 | p << 32) | head << np.uint64(16) | masked)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(fps.view(np.int64), len(keys)))],
                ["key", "fp"],
            )


def _linked(a: np.ndarray, b: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """Whether the ring's chains from segment ``start`` stay within their budgets, the last being all bits."""
    x = a ^ b
    keep = np.bitwise_count(x & _CHAIN[2][start]) <= _QUOTA[2]
    for length in (0, 1, 3, 4):
        keep &= np.bitwise_count(x & _CHAIN[length][start]) <= _QUOTA[length]
    return keep


def _forest(f: np.ndarray, start: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what is linked among ``f``; without ``start`` by the full check alone."""
    left, right, rest = [], [], np.arange(len(f))
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            at = todo.pop()
            if start is None:
                near = np.bitwise_count(f[rest] ^ f[at]) <= LIMIT
            else:
                near = _linked(f[rest], f[at], start)
            if near.any():
                new = rest[near]
                left.append(np.full(len(new), f[at], dtype=np.uint64))
                right.append(f[new])
                todo.extend(new.tolist())
                rest = rest[~near]
    none = np.zeros(0, dtype=np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _every(f: np.ndarray, start: int | None, mask: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All linked pairs among ``f``, some at a time; those of a run of which the bit ``mask`` is free.

    Fingerprints whose second segment agrees meet under every mask of it; only the
    run of the first mask gives their pair.
    """
    offset, width = SEGMENTS[((start or 0) + 1) % len(SEGMENTS)]
    tail = np.uint64(((1 << width) - 1) << offset)
    for at in range(len(f) - 1):
        rest = f[at + 1 :]
        if start is None:
            near = np.bitwise_count(rest ^ f[at]) <= LIMIT
        else:
            near = _linked(rest, f[at], start)
            if mask:
                near &= ((rest ^ f[at]) & tail) != 0
        if near.any():
            yield np.full(int(near.sum()), f[at], dtype=np.uint64), rest[near]


def _edges(a: np.ndarray, b: np.ndarray, block: np.ndarray | int) -> pa.RecordBatch:
    blocks = np.full(len(a), block, dtype=np.int32) if np.isscalar(block) else block.astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(blocks)], ["u", "v", "block"]
    )


def _in_runs(key: np.ndarray, fp: np.ndarray, every: bool) -> Iterator[pa.RecordBatch]:
    """Edges inside whole runs of equal keys, sorted by key."""
    begins = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    lengths = np.diff(np.concatenate((begins, [len(key)])))
    small = np.repeat(lengths <= SMALL, lengths)
    k, f = key[small], fp[small]
    for step in range(1, min(SMALL, len(k))):
        same = np.flatnonzero(k[step:] == k[:-step])
        if not len(same):
            break
        a, b, start = f[same], f[same + step], (k[same] >> 40)
        keep = (a != b) & _linked(a, b, start)
        if keep.any():
            yield _edges(a[keep], b[keep], -1)
    for begin, length in zip(begins[lengths > SMALL].tolist(), lengths[lengths > SMALL].tolist()):
        run, start, mask = np.unique(fp[begin : begin + length]), int(key[begin] >> 40), int(key[begin] >> 32 & 0xFF)
        for a, b in _every(run, start, mask) if every else [_forest(run, start)]:
            if len(a):
                yield _edges(a, b, -1)


def _match(batches: Iterator[pa.RecordBatch], every: bool) -> Iterator[pa.RecordBatch]:
    """Edges (block -1), and (key, fp, block) rows of runs too long for one task's memory."""
    held_k, held_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    long_key, long_rows = None, 0
    for batch in batches:
        k = np.concatenate((held_k, batch.column(0).to_numpy(zero_copy_only=False)))
        f = np.concatenate((held_f, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
        if long_key is not None:
            n = int(np.searchsorted(k, long_key, side="right"))
            yield _edges(k[:n].view(np.uint64), f[:n], (long_rows + np.arange(n)) // BLOCK)
            long_rows += n
            k, f = k[n:], f[n:]
            if not len(k):
                held_k, held_f = k, f
                continue
            long_key = None
        cut = int(np.searchsorted(k, k[-1])) if len(k) else 0
        if cut:
            yield from _in_runs(k[:cut], f[:cut], every)
        held_k, held_f = k[cut:], f[cut:]
        if len(held_k) > BLOCK:
            long_key, long_rows = held_k[0], len(held_k)
            yield _edges(held_k.view(np.uint64), held_f, np.arange(long_rows) // BLOCK)
            held_k, held_f = held_k[:0], held_f[:0]
    if len(held_k):
        yield from _in_runs(held_k, held_f, every)


def _block_pair(every: bool):
    def compare(_key, group):
        """Edges among the fingerprints of two blocks of one key."""
        import pandas as pd

        both = np.unique(group["fp"].to_numpy().view(np.uint64))
        found = list(_every(both, None)) if every else [_forest(both, None)]
        a, b = [np.concatenate([np.zeros(0, np.uint64), *side]) for side in zip(*found)] or [np.zeros(0, np.uint64)] * 2
        return pd.DataFrame({"u": a.view(np.int64), "v": b.view(np.int64)})

    return compare


def linked_fingerprints(distinct: DataFrame, every: bool = False) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs that differ in at most ``LIMIT`` bits.

    ``distinct`` has one long column ``fp`` without repeats.  With ``every`` the edges
    are all those pairs, in either order and some of them repeated.
    """
    spark = distinct.sparkSession
    keys = distinct.mapInArrow(_chain_keys, "key long, fp long")
    dealt = keys.repartition(partitions(spark), "key").sortWithinPartitions("key")
    found = saved(dealt.mapInArrow(lambda b: _match(b, every), "u long, v long, block int"), "links")
    edges = found.where("block < 0").select("u", "v")
    rows = found.where("block >= 0").select(F.col("u").alias("key"), F.col("v").alias("fp"), "block")
    if rows.isEmpty():
        return edges
    counts = rows.groupBy("key").agg(F.max("block").alias("last"))
    meetings = rows.join(counts, "key").select(
        "key", "fp", "block", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("with")
    )
    grouped = meetings.groupBy("key", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("two"))
    return edges.union(grouped.applyInPandas(_block_pair(every), "u long, v long"))


def near_duplicate_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text; other columns are ignored).

    Rows whose fingerprints differ in at most four bits are linked, also through
    others; ``component_id`` is the smallest doc_id reachable.  Equal fingerprints,
    so all copies, collapse before anything is compared.  Texts without words share
    fingerprint zero.  A null doc_id takes part, and is the component only of rows
    that reach no other id.
    """
    rows = saved(fingerprints(docs), "fingerprints")
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    groups = connected_components(linked_fingerprints(first.select("fp")))
    labelled = first.join(groups, first["fp"] == groups["node"], "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("component")
    )
    least = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = labelled.join(least, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")
