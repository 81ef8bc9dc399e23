"""Near copies by SimHash links, bands of least hashes and an exact check.

SimHash alone finds texts that differ in a word or two: at a similarity of 0.8 two
fingerprints differ in about ten bits of 64, where pigeonring chains no longer tell
near copies from chance.  Here its links are candidates, beside those of texts that
share a band of least shingle hashes; every candidate pair is then checked by the
share of shingles that both texts have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import saved, whole_text
from smelter.llm.components import connected_components
from smelter.llm.simhash import folded, linked_fingerprints, shingle_hashes

SHINGLE = 5
SIMILARITY = 0.8
# At a similarity of 0.8 all bands miss with a chance of 0.04 %, at 0.5 they meet with one of 47 %.
BANDS, ROWS = 20, 5
# Ids of candidates sent to all tasks, at most; beyond that the texts are joined.
BROADCAST_IDS = 500_000
# Keys of up to SMALL texts list their pairs; others are cut into blocks of so many texts and
# bytes, at most, and every two blocks meet in a task of their own.
SMALL = 32
BLOCK, BLOCK_BYTES = 2048, 16 << 20

_DRAWN = np.random.default_rng(42).integers(0, 2**64, (2, BANDS * ROWS), dtype=np.uint64)
_FLIP, _TIMES = _DRAWN[0], _DRAWN[1] | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def bands(hashes: np.ndarray) -> np.ndarray:
    """One key per band: a hash of the least shingle hashes under its orders."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(hashes), 4096):
        part = (hashes[begin : begin + 4096, None] ^ _FLIP) * _TIMES
        least = np.minimum(least, part.min(axis=0))
    rows = least.reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = (keys ^ rows[:, k]) * _STEP
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps, keys = [], []
        for text in batch.column(2).cast(pa.binary()):
            hashes = shingle_hashes(text.as_py(), SHINGLE)
            fps.append(folded(hashes))
            keys.append(bands(hashes) if len(hashes) else np.zeros(0, np.int64))
        ends = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.int64), *keys])
        columns = [batch.column(0), batch.column(1), pa.array(np.array(fps, np.uint64).view(np.int64))]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.ListArray.from_arrays(ends, pa.array(flat))], ["doc_id", "node", "fp", "bands"]
        )


def node_of(text: Column) -> Column:
    return F.xxhash64(text)


def _shared_keys(members: DataFrame) -> DataFrame:
    """The rows of ``members`` (key, node) whose key has more than one."""
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return members.join(counts, "key")


def _band_pairs(nodes: DataFrame) -> DataFrame:
    """(node, leader, shared): every member of a band's key with two members of it.

    One of the two is drawn for each key; the other is the one that meets most others
    in all its bands, which in a family of copies is the text they were made from.
    """
    crowded = saved(_shared_keys(nodes.select("node", F.explode("bands").alias("key"))), "crowded-bands")
    weight = crowded.groupBy("node").agg(F.sum("members").alias("weight"))
    rank = F.col("weight") * (1 << 20) + F.pmod(F.xxhash64("node"), F.lit(1 << 20))
    leaders = crowded.join(weight, "node").groupBy("key").agg(
        F.min_by("node", F.xxhash64("key", "node")).alias("drawn"), F.max_by("node", rank).alias("central")
    )
    met = crowded.select("node", "key").join(leaders, "key")
    met = met.select("node", F.explode(F.array_distinct(F.array("drawn", "central"))).alias("leader")).where("node <> leader")
    return met.groupBy("node", "leader").agg(F.count(F.lit(1)).alias("shared"))


def _fingerprint_pairs(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, leader, shared): texts of one fingerprint, and of fingerprints that SimHash links.

    With it (key, node): the texts of every fingerprint and of every link that have
    more texts than these pairs compare.
    """
    first = saved(nodes.groupBy("fp").agg(F.min("node").alias("leader")), "fingerprint-leaders")
    same = nodes.select("fp", "node").join(first, "fp").where("node <> leader").select("node", "leader")
    links = saved(linked_fingerprints(first.select("fp"), every=True).where("u <> v").distinct(), "fingerprint-links")
    ends = links.join(first.select(F.col("fp").alias("u"), F.col("leader").alias("node")), "u")
    ends = ends.join(first.select(F.col("fp").alias("v"), "leader"), "v").select("node", "leader")
    pairs = same.union(ends).withColumn("shared", F.lit(1).cast("long"))

    texts = nodes.groupBy("fp").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("fp")
    alike = nodes.select("fp", "node").join(texts, "fp").select(F.xxhash64(F.lit("one"), "fp").alias("key"), "node")
    sides = links.select(F.explode(F.array("u", "v")).alias("fp"), F.xxhash64(F.lit("two"), "u", "v").alias("key"))
    wide = sides.join(texts, "fp").select("key").distinct()
    linked = sides.join(wide, "key").join(nodes.select("fp", "node"), "fp").select("key", "node")
    return pairs, alike.union(linked)


def _alike(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    last, last_set = None, None
    for batch in batches:
        keep = []
        ids, ones, twos = batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary())
        for leader, one, two in zip(ids, ones, twos):
            if leader != last:
                last, last_set = leader, np.unique(shingle_hashes(two.as_py(), SHINGLE))
            mine = np.unique(shingle_hashes(one.as_py(), SHINGLE))
            both = len(np.intersect1d(mine, last_set, assume_unique=True))
            keep.append(both + 1e-9 >= similarity * (len(mine) + len(last_set) - both))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _checked(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) that are similar enough."""
    sides = pairs.select(F.col("node").alias("u"), F.col("leader").alias("v"))
    sides = sides.join(texts.select(F.col("node").alias("u"), F.col("text").alias("one")), "u")
    sides = sides.join(texts.select(F.col("node").alias("v"), F.col("text").alias("two")), "v")
    return sides.select("u", "v", "one", "two").mapInArrow(lambda b: _alike(b, similarity), "u long, v long")


def _shared_counts(ones: list[np.ndarray], twos: list[np.ndarray]) -> np.ndarray:
    """How many values each set of ``ones`` shares with each of ``twos``; sets are arrays without repeats."""
    sizes = [len(x) for x in (*ones, *twos)]
    row = np.repeat(np.arange(len(sizes)), sizes)
    _, column, times = np.unique(np.concatenate([*ones, *twos]), return_inverse=True, return_counts=True)
    row, column = row[times[column] > 1], column[times[column] > 1]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    counts = np.zeros((len(ones), len(twos)), np.float32)
    width = 4096
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (begin, begin + width))
        holds = np.zeros((len(sizes), width), np.float32)
        holds[row[a:b], column[a:b] - begin] = 1
        counts += holds[: len(ones)] @ holds[len(ones) :].T
    return counts


def _spanning(linked: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges of a forest that joins what a symmetric matrix links."""
    left, right, rest = [], [], np.arange(len(linked))
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            at = todo.pop()
            near = linked[at, rest]
            left.extend([at] * int(near.sum()))
            right.extend(rest[near].tolist())
            todo.extend(rest[near].tolist())
            rest = rest[~near]
    return left, right


def _block_pair(similarity: float):
    def compare(_key, group):
        """Checked edges between the texts of two blocks of one key, or inside one block."""
        import pandas as pd

        group = group.sort_values("block", kind="stable")
        sets = [np.unique(shingle_hashes(bytes(t), SHINGLE)) for t in group["text"]]
        sizes, at = np.array([len(x) for x in sets]), group["at"].to_numpy()
        n, cut = len(sets), int((group["block"] == group["block"].iloc[0]).sum())
        begin = 0 if cut == n else cut
        both = _shared_counts(sets[:cut], sets[begin:])
        alike = both + 1e-9 >= similarity * (sizes[:cut, None] + sizes[None, begin:] - both.astype(np.float64))
        linked = np.zeros((n, n), bool)
        linked[:cut, begin:] = alike & (at[:cut, None] != at[None, begin:])
        left, right = _spanning(linked | linked.T)
        node = group["node"].to_numpy()
        return pd.DataFrame({"u": node[left].astype(np.int64), "v": node[right].astype(np.int64)})

    return compare


def _apart_links(members: DataFrame, groups: DataFrame, done: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Checked edges between the texts of every key of ``members`` (key, node) that ``groups`` leaves apart.

    Pairs of ``done`` (node, leader) are not checked again where pairs are listed.
    """
    place = groups.select("node", F.col("component").alias("at"))
    placed = members.join(place, "node", "left").select("key", "node", F.coalesce("at", "node").alias("at"))
    sizes = texts.select("node", F.octet_length("text").alias("bytes"))
    placed = saved(placed.join(sizes, "node"), "key-members")
    counts = placed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.min("at").alias("low"), F.max("at").alias("high")
    )
    # Two members are a leader and the other one, so already checked.
    still = counts.where("low < high and n > 2").select("key", "n", F.col("bytes").alias("total"))
    open_rows = saved(placed.drop("bytes").join(still, "key"), "open-keys")

    few = open_rows.where(F.col("n") <= SMALL)
    other = few.select("key", F.col("node").alias("v"), F.col("at").alias("v_at"))
    listed = few.join(other, "key").where("node < v and at <> v_at").select(F.col("node").alias("u"), "v").distinct()
    known = done.select(F.least("node", "leader").alias("u"), F.greatest("node", "leader").alias("v"))
    pairs = listed.join(known, ["u", "v"], "left_anti").select(F.col("u").alias("node"), F.col("v").alias("leader"))
    links = _checked(pairs, texts, similarity)

    many = open_rows.where(F.col("n") > SMALL)
    if many.isEmpty():
        return links
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("total") / BLOCK_BYTES)).cast("int")
    dealt = many.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), "blocks").cast("int"))
    meetings = dealt.select("key", "node", "at", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    grouped = meetings.join(texts.select("node", F.col("text").cast("binary").alias("text")), "node").groupBy(
        "key", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("two")
    )
    return links.union(grouped.applyInPandas(_block_pair(similarity), "u long, v long"))


def similar_groups(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, node, component) for every row of ``docs`` (doc_id, text; other columns are ignored).

    ``node`` is the hash of the whole text, null counting as empty; rows with one
    ``component`` are near copies of each other, also through others: they share
    ``similarity`` or more of their different five-word shingles.  Texts without
    words are one component.

    The candidates that share most are checked first; of the others only those whose
    ends are still apart, so a large group costs a few checks per text and not one
    per pair.  Then all other pairs of a key whose ends are apart are checked too.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = rows.select("doc_id", node_of(F.col("text")).alias("node"), "text")
    marked = saved(rows.mapInArrow(_sketches, "doc_id long, node long, fp long, bands array<bigint>"), "sketches")
    nodes = saved(marked.select("node", "fp", "bands").dropDuplicates(["node"]), "sketch-nodes")
    linked, linked_keys = _fingerprint_pairs(nodes)
    pairs = _band_pairs(nodes).union(linked)
    pairs = saved(pairs.groupBy("node", "leader").agg(F.sum("shared").alias("shared")), "similar-candidates")
    ids = saved(pairs.select("node").union(pairs.select("leader")).distinct(), "similar-ids")
    few = ids.count() <= BROADCAST_IDS
    texts = rows.select("node", "text").join(F.broadcast(ids) if few else ids, "node", "left_semi")
    texts = saved(texts.dropDuplicates(["node"]), "similar-texts")

    best = pairs.groupBy("node").agg(F.max_by("leader", "shared").alias("leader"))
    links = saved(_checked(best, texts, similarity), "similar-links")
    groups = connected_components(links)
    place = [groups.select(F.col("node").alias(c), F.col("component").alias(f"{c}_at")) for c in ("node", "leader")]
    apart = pairs.join(place[0], "node", "left").join(place[1], "leader", "left")
    apart = apart.where(F.coalesce("node_at", "node") != F.coalesce("leader_at", "leader")).join(
        best, ["node", "leader"], "left_anti"
    )
    more = saved(_checked(apart, texts, similarity), "similar-links")
    links = links.union(more)
    groups = saved(connected_components(links), "leader-groups")
    members = _shared_keys(nodes.select(F.explode("bands").alias("key"), "node")).select("key", "node").union(linked_keys)
    rest = saved(_apart_links(members, groups, pairs, texts, similarity), "similar-links")
    groups = connected_components(links.union(rest))
    named = marked.select("doc_id", "node").join(groups, "node", "left")
    return named.select("doc_id", "node", F.coalesce("component", "node").alias("component"))
