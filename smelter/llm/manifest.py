"""Merkle manifest of a dataset: a digest per row, a tree of digests, and each row's proof.

Rows are ranked in their group.  The octal digits of a rank are the path of a leaf in
the tree, so a tree is built by grouping its digit columns away one by one; children
are nested into their parent.  That happens inside blocks of ``8 ** LEVELS`` leaves;
the roots of blocks are the leaves of the next round, until each tree is one block.
On the way back a block's nested children are unfolded into proofs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.common import partitions, saved

FAN = 8
# Tree levels within one block; a block nests up to FAN ** LEVELS leaves.
LEVELS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a row: each field as its byte count, a colon and its value; a null as a hyphen."""
    return _hash(*[_field(fields[name]) for name in FIELDS])


def _depth(count: Column) -> Column:
    """Levels above the leaves of a tree: the octal digits of its last rank."""
    return F.when(count > 1, F.length(F.conv((count - 1).cast("string"), 10, 8))).otherwise(0)


def _ranked(nodes: DataFrame, tree: list[str], order: list[str]) -> DataFrame:
    """``nodes`` with ``rank`` (from 0) in its tree and ``size`` of the tree.

    Rows are cut into ranges of (tree, order); each is ranked alone, and ranges are
    offset by the counts of those before.  ``__tie`` spreads rows equal in all of
    these, which may take any order among themselves.
    """
    spark = nodes.sparkSession
    tied = nodes.withColumn("__tie", F.monotonically_increasing_id())
    keys = [*tree, *order, "__tie"]
    ranged = saved(tied.repartitionByRange(partitions(spark), *keys).withColumn("__part", F.spark_partition_id()), "ranges")
    in_part = Window.partitionBy("__part", *tree).orderBy(*order, "__tie")
    before = Window.partitionBy(*tree).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        ranged.groupBy(*tree, "__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumns(
            {
                "__offset": F.coalesce(F.sum("__n").over(before), F.lit(0)),
                "size": F.sum("__n").over(Window.partitionBy(*tree)),
            }
        )
    )
    counts = counts.select(*[F.col(t).alias(f"__{t}") for t in tree], F.col("__part").alias("__at"), "__offset", "size")
    same = F.col("__part") == F.col("__at")
    for t in tree:
        same = same & F.col(t).eqNullSafe(F.col(f"__{t}"))
    ranked = ranged.withColumn("__row", F.row_number().over(in_part)).join(counts, same)
    place = (F.col("__offset") + F.col("__row") - 1).alias("rank")
    return ranked.select(*nodes.columns, place, "size")


def _blocks(nodes: DataFrame, tree: list[str]) -> DataFrame:
    """One row per block: its digest and its children, nested level by level.

    ``nodes`` has the tree's columns, rank, size and a struct ``node`` with the field
    ``hash``.  One exchange by block serves every grouping.  Where a tree has ended
    below the block's last level, a parent with a single child takes its digest over.
    """
    digits = [f"d{i}" for i in range(LEVELS)]
    block = [*tree, "size", "block"]
    rows = nodes.select(
        *tree,
        "size",
        F.expr(f"rank div {FAN**LEVELS}").alias("block"),
        *[F.expr(f"cast(rank div {FAN**i} % {FAN} as int)").alias(d) for i, d in enumerate(digits)],
        "node",
    ).repartition(partitions(nodes.sparkSession), *block)
    levels = _depth(F.col("size"))
    for i, digit in enumerate(digits):
        above = digits[i + 1 :]
        children = F.transform(F.sort_array(F.collect_list(F.struct(digit, "node"))), lambda c: c["node"])
        rows = rows.groupBy(*block, *above).agg(children.alias("children"))
        digests = F.transform("children", lambda c: c["hash"])
        parent = F.when(levels > i, F.sha2(F.array_join(digests, ""), 256)).otherwise(F.get(digests, 0))
        rows = rows.select(*block, *above, F.struct(parent.alias("hash"), "children").alias("node"))
    return rows


def _next(blocks: DataFrame, tree: list[str]) -> DataFrame:
    """Block roots as the nodes of the next round."""
    fewer = F.expr(f"size div {FAN**LEVELS} + cast(size % {FAN**LEVELS} > 0 as int)")
    return blocks.select(*tree, F.col("block").alias("rank"), fewer.alias("size"), F.struct(F.col("node.hash").alias("hash")).alias("node"))


STEPS = "array<struct<left:string,right:string>>"


def _unfolded(blocks: DataFrame, ups: DataFrame, tree: list[str]) -> DataFrame:
    """Every node of the blocks with ``proof``: the siblings left and right of its way to the root.

    ``ups`` has, for the root of each block, its ``proof`` and what it hands down
    (``top``).  Both kinds of rows meet in one grouping by block; then children are
    unfolded by nested transforms and exploded once.
    """

    def null(kind) -> Column:
        return F.lit(None).cast(kind)

    node, top = blocks.schema["node"].dataType, ups.schema["top"].dataType
    held = blocks.select(*tree, "block", "size", "node", null(STEPS).alias("up"), null(top).alias("top"))
    above = ups.select(
        *tree, F.col("rank").alias("block"), null("long").alias("size"), null(node).alias("node"), F.col("proof").alias("up"), "top"
    )
    kept = [F.first(c, ignorenulls=True).alias(c) for c in ("size", "node", "up", "top")]
    met = held.union(above).groupBy(*tree, "block").agg(*kept)
    levels = F.least(_depth(F.col("size")), F.lit(LEVELS))
    ways = F.array(F.struct(F.col("node").alias("node"), F.lit(0).cast("long").alias("place"), F.array().cast(STEPS).alias("way")))
    for i in reversed(range(LEVELS)):
        ways = F.flatten(F.transform(ways, _children(levels > i)))
    leaves = met.select(*tree, "block", "up", "top", F.inline(ways))
    rank = F.col("block") * FAN**LEVELS + F.col("place")
    return leaves.select(*tree, rank.alias("rank"), "top", "node", F.concat("way", "up").alias("proof"))


def _children(is_level: Column) -> Callable[[Column], Column]:
    """Children of a node, each with its own place and its siblings put before the node's own."""

    def unfold(parent: Column) -> Column:
        digests = F.transform(parent["node"]["children"], lambda c: c["hash"])

        def child(node: Column, at: Column) -> Column:
            left = F.array_join(F.slice(digests, F.lit(1), at), "")
            right = F.array_join(F.slice(digests, at + 2, F.lit(FAN)), "")
            step = F.array(F.struct(left.alias("left"), right.alias("right")))
            way = F.when(is_level, F.concat(step, parent["way"])).otherwise(parent["way"])
            return F.struct(node.alias("node"), (parent["place"] * FAN + at).alias("place"), way.alias("way"))

        return F.transform(parent["node"]["children"], child)

    return unfold


def _rounds(nodes: DataFrame, tree: list[str]) -> list[DataFrame]:
    """Blocks of every round, leaves first; the last has one block per tree."""
    rounds = []
    while True:
        blocks = saved(_blocks(nodes, tree), "blocks")
        rounds.append(blocks)
        largest = blocks.agg(F.max("size")).first()[0]
        if largest is None or largest <= FAN**LEVELS:
            return rounds
        nodes = _next(blocks, tree)


def _proofs(rounds: list[DataFrame], ups: DataFrame, tree: list[str]) -> DataFrame:
    """Leaves with their proofs; ``ups`` is what the roots of the trees have."""
    for blocks in reversed(rounds):
        leaves = _unfolded(blocks, ups, tree)
        ups = leaves.select(*tree, "rank", "proof", "top")
    return leaves


def merkle_tree(nodes: DataFrame, tree: list[str], order: list[str]) -> DataFrame:
    """Each node's proof in its tree.

    ``nodes`` has the columns of ``tree`` (null is a value like others) and ``order``,
    and a struct ``node`` with the field ``hash``.  Returns the tree's columns, rank,
    ``top`` (the root's digest), ``node`` and ``proof``, leaf first.  Nodes equal in
    ``order`` may stand in any order.
    """
    rounds = _rounds(_ranked(nodes, tree, order), tree)
    return _proofs(rounds, _roots(rounds[-1], tree), tree)


def _roots(blocks: DataFrame, tree: list[str]) -> DataFrame:
    return blocks.select(*tree, F.col("block").alias("rank"), F.array().cast(STEPS).alias("proof"), F.col("node.hash").alias("top"))


def folded(digest: Column, proof: Column) -> Column:
    """The root that a digest and its siblings lead to."""
    return F.aggregate(proof, digest, lambda acc, step: _hash(step["left"], acc, step["right"]))


def siblings(proof: Column) -> Column:
    """A proof's digests in one string, from the leaf up, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(docs: DataFrame, tampered_text: Column | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text): its digest and its proof.

    Leaves of one lang (null is a lang of its own) ascend by doc_id (null first), those
    that share a doc_id by their digest, so repeated rows have neighbouring leaves with
    a proof each.  Each run of eight nodes becomes one, also the last, shorter run,
    until one is left: the lang's subroot.  Subroots ascend by lang and lead to the
    root in the same way.  Null, empty and very long texts are hashed as they are; an
    empty table gives no rows; columns beyond the five are ignored.

    Returns doc_id, leaf, subroot, root, ``proof`` (the digests left and right of each
    step, leaf first) and ``tampered``: the digest with ``tampered_text`` for text,
    null where that is null.  A row never nests more than the ``8 ** LEVELS`` leaves of
    a block, and blocks meet the proofs of their roots by grouping: no step joins
    leaves with nodes.
    """
    fields = {name: F.col(name) for name in FIELDS}
    changed = F.lit(None).cast("string")
    if tampered_text is not None:
        changed = F.when(tampered_text.isNotNull(), leaf({**fields, "text": tampered_text}))
    digests = docs.select(
        F.col("lang").cast("string").alias("lang"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(fields).alias("hash"),
        changed.alias("tampered"),
    )
    nodes = digests.select("lang", "doc_id", "hash", F.struct("hash", "doc_id", "tampered").alias("node"))
    rounds = _rounds(_ranked(nodes, ["lang"], ["doc_id", "hash"]), ["lang"])
    subroots = rounds[-1].select(F.lit(0).alias("all"), "lang", F.struct(F.col("node.hash").alias("hash"), "lang").alias("node"))
    tops = merkle_tree(subroots, ["all"], ["lang"]).select(
        F.col("node.lang").alias("lang"),
        F.lit(0).cast("long").alias("rank"),
        "proof",
        F.struct(F.col("node.hash").alias("subroot"), F.col("top").alias("root")).alias("top"),
    )
    leaves = _proofs(rounds, saved(tops, "subroots"), ["lang"])
    return leaves.select(
        F.col("node.doc_id").alias("doc_id"),
        F.col("node.hash").alias("leaf"),
        F.col("top.subroot").alias("subroot"),
        F.col("top.root").alias("root"),
        "proof",
        F.col("node.tampered").alias("tampered"),
    )


def proofs_of_tampered(docs: DataFrame) -> DataFrame:
    """The manifest, checked against rows some of which had their text's A-Z lower-cased.

    Those are the rows whose doc_id, as decimal text, has a CRC-32 that 3 divides.
    """
    lowered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", UPPER, LOWER))
    rows = manifest(docs, lowered)
    root = folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), root.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _field_sql(name: str) -> str:
    return f"coalesce(octet_length(encode(CAST({name} AS VARCHAR))) || ':' || CAST({name} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(text if name == "text" else name) for name in FIELDS) + ")"


_BITS = "flatten(list_transform(range(1, len(d) + 1), lambda i: list_transform(range(0, 8), lambda b: (ascii(d[i]) >> b) & 1)))"
_CRC = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, {_BITS}),
    lambda c, b: xor(c >> 1, CASE WHEN (xor(c, b) & 1) = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)), 4294967295::BIGINT)"""

PROOFS_SQL = f"""
WITH RECURSIVE docs AS (
    SELECT *, CAST(doc_id AS VARCHAR) AS d, translate(text, '{UPPER}', '{LOWER}') AS lowered,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS li
    FROM documents
), leaves AS (
    SELECT doc_id, li, {_leaf_sql('text')} AS leaf,
           CASE WHEN d IS NOT NULL AND {_CRC} % 3 = 0 THEN {_leaf_sql('lowered')} ELSE {_leaf_sql('text')} END AS given
    FROM docs
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY li ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY li) AS n FROM leaves
), nodes AS (
    SELECT li, 0 AS level, r, leaf AS h, n FROM ranked
    UNION ALL
    SELECT li, level + 1, r // {FAN}, sha256(string_agg(h, '' ORDER BY r)), (any_value(n) + {FAN - 1}) // {FAN}
    FROM nodes WHERE n > 1 GROUP BY li, level, r // {FAN}
), runs AS (
    SELECT li, level, r // {FAN} AS parent, list(h ORDER BY r) AS hs FROM nodes WHERE n > 1 GROUP BY li, level, r // {FAN}
), subroots AS (
    SELECT li, h AS subroot FROM nodes WHERE n = 1
), upper AS (
    SELECT 0 AS level, li AS r, subroot AS h, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT level + 1, r // {FAN}, sha256(string_agg(h, '' ORDER BY r)), (any_value(n) + {FAN - 1}) // {FAN}
    FROM upper WHERE n > 1 GROUP BY level, r // {FAN}
), upper_runs AS (
    SELECT level, r // {FAN} AS parent, list(h ORDER BY r) AS hs FROM upper WHERE n > 1 GROUP BY level, r // {FAN}
), fold AS (
    SELECT li, r AS r0, 0 AS level, r, given AS acc, '' AS sibs, n FROM ranked
    UNION ALL
    SELECT f.li, r0, f.level + 1, f.r // {FAN},
           sha256(array_to_string(hs[1:f.r % {FAN}], '') || acc || array_to_string(hs[f.r % {FAN} + 2:], '')),
           sibs || array_to_string(hs[1:f.r % {FAN}], '') || array_to_string(hs[f.r % {FAN} + 2:], ''), (n + {FAN - 1}) // {FAN}
    FROM fold f JOIN runs ON runs.li = f.li AND runs.level = f.level AND runs.parent = f.r // {FAN} WHERE n > 1
), upper_fold AS (
    SELECT li, r0, 0 AS level, li AS r, acc, sibs, (SELECT count(*) FROM subroots) AS n FROM fold WHERE n = 1
    UNION ALL
    SELECT li, r0, f.level + 1, f.r // {FAN},
           sha256(array_to_string(hs[1:f.r % {FAN}], '') || acc || array_to_string(hs[f.r % {FAN} + 2:], '')),
           sibs || array_to_string(hs[1:f.r % {FAN}], '') || array_to_string(hs[f.r % {FAN} + 2:], ''), (n + {FAN - 1}) // {FAN}
    FROM upper_fold f JOIN upper_runs u ON u.level = f.level AND u.parent = f.r // {FAN} WHERE n > 1
)
SELECT doc_id, leaf, subroot, h AS root, sha256(sibs) AS proof_sha256, acc AS folded_root, acc = h AS verified
FROM ranked JOIN upper_fold f ON f.li = ranked.li AND f.r0 = ranked.r AND f.n = 1
JOIN subroots ON subroots.li = ranked.li CROSS JOIN (SELECT h FROM upper WHERE n = 1)
"""
