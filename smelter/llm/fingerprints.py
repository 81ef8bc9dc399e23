"""Document fingerprints by a homomorphic multiset hash of paragraphs.

Every paragraph gives a wide vector of numbers below 2**32; a document's vector is
the sum of its paragraphs' vectors modulo 2**32.  The order of paragraphs is
therefore free, and a paragraph is put in or taken out by adding or subtracting
its vector.  A vector has three bands:

* one lane counting units (see below),
* 16 lanes cut from the paragraph's SHA-512: these decide equality,
* 64 lanes that each count the paragraph's units whose hash has that bit set.  A
  unit is a word with the word after it in the paragraph.  Centred at half the
  number of units these lanes are sums of random signs, so the cosine of two
  bands estimates how much of their text two documents share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.common import cuts_at_or_below, partitions, whole_text

MODULUS = 1 << 32
EQUAL_LANES = 16
LIKE_LANES = 64
_LOW = MODULUS - 1
_PAIR = 1 | 1 << 32


def _paragraphs(body: Column) -> Column:
    """Pieces between newlines, empty ones included; they say themselves where they end."""
    return F.split(body, "\n")


def _adder(at: int):
    def add(total: Column, digest: Column) -> Column:
        return (total + F.conv(F.substring(digest, at, 8), 16, 10).cast("long")) % MODULUS

    return add


def _equality_lanes(digests: Column) -> Column:
    lanes = [
        F.aggregate(
            digests,
            F.lit(0).cast("long"),
            _adder(at),
        )
        for at in range(1, 8 * EQUAL_LANES + 1, 8)
    ]
    return F.array(*lanes)


def _unit_hashes(words: str) -> Column:
    later = F.slice(words, F.lit(2), F.size(words))
    return F.zip_with(words, later, lambda one, two: F.xxhash64(one, two))


def vectors(rows: DataFrame, keys: list[str], body: str) -> DataFrame:
    """``keys`` and ``vector`` (array of longs) of each row's text.

    Rows that agree in all keys must agree in their text.  If ``rows`` is already
    dealt by one of the keys, nothing is shuffled.  Null text counts as empty.
    """
    digests = F.transform(_paragraphs(whole_text(body)), lambda p: F.sha2(p, 512))
    keyed = rows.select(*keys, F.col(body), digests.alias("__digests"))
    keyed = keyed.select(*keys, F.col(body), _equality_lanes(F.col("__digests")).alias("__equal"))
    paragraphs = keyed.select(*keys, "__equal", F.explode_outer(_paragraphs(whole_text(body))).alias("__paragraph"))
    worded = paragraphs.select(*keys, "__equal", F.split("__paragraph", " ").alias("__words"))
    units = worded.select(*keys, "__equal", F.explode_outer(_unit_hashes("__words")).alias("__unit"))
    bits = [
        F.sum(F.shiftrightunsigned("__unit", j).bitwiseAND(_PAIR)).alias(f"__bit{j}") for j in range(LIKE_LANES // 2)
    ]
    counted = units.groupBy(*keys, "__equal").agg(F.count(F.lit(1)).alias("__units"), *bits)
    low = [F.col(f"__bit{j}").bitwiseAND(_LOW) for j in range(LIKE_LANES // 2)]
    high = [F.shiftrightunsigned(f"__bit{j}", 32) for j in range(LIKE_LANES // 2)]
    vector = F.concat(F.array(F.col("__units") % MODULUS), F.col("__equal"), F.array(*low, *high))
    return counted.select(*keys, vector.alias("vector"))


def combined(left: Column, right: Column) -> Column:
    """The vector of two documents' paragraphs together; also how a paragraph is inserted."""
    return F.zip_with(left, right, lambda a, b: (a + b) % MODULUS)


def without(left: Column, right: Column) -> Column:
    """``left`` with the paragraphs of ``right`` taken out."""
    return F.zip_with(left, right, lambda a, b: (a - b + MODULUS) % MODULUS)


def as_text(vector: Column) -> Column:
    """The vector as hex digits, eight per lane; equal multisets of paragraphs have equal text."""
    return F.array_join(F.transform(vector, lambda lane: F.lpad(F.lower(F.hex(lane)), 8, "0")), "")


def _centred(vector: Column) -> Column:
    return F.transform(
        F.slice(vector, EQUAL_LANES + 2, LIKE_LANES), lambda lane: (2 * lane - vector[0]).cast("double")
    )


def _product(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)


def likeness(left: Column, right: Column) -> Column:
    """0 to 1: 1 for equal vectors, else the cosine of the likeness bands, not below 0."""
    a, b = _centred(left), _centred(right)
    norm = F.sqrt(_product(a, a)) * F.sqrt(_product(b, b))
    cosine = F.when(norm > 0, _product(a, b) / norm).otherwise(F.lit(0.0))
    return F.when(left == right, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine)))


def with_next(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, body) with ``block``, ``pos`` and ``next_body``, and guests.

    The order is descending doc_id (null last), equal ids by the hash of the text.
    Blocks are ranges of doc_id cut at quantiles, so the only shuffle moves each
    text once; an id that holds several blocks' worth of rows is cut further by
    the hash.  Every block ends with a guest, a copy of the row that opens the
    block after it (after the last: the first), so that a row's successor is
    always in its own block.
    """
    spark = rows.sparkSession
    count = max(1, partitions(spark))
    keyed = rows.select("doc_id", "body", F.xxhash64("body").alias("hash"))
    cuts = rows.select(F.col("doc_id").cast("double").alias("x")).where("x is not null")
    marks = [int(x) for x in cuts.approxQuantile("x", [i / count for i in range(1, count)], 0.1 / count)]
    values = sorted(set(marks))
    block = cuts_at_or_below([F.col("doc_id")], [(v,) for v in values]) * count  # null sorts below all
    for hot in values:
        share = marks.count(hot)
        if share > 1:  # hashes are even, so ranges of them are
            part = F.floor((F.col("hash").cast("double") / 2.0**64 + 0.5) * share).cast("int")
            block = F.when(F.col("doc_id") == hot, block + F.least(part, F.lit(share - 1))).otherwise(block)
    placed = keyed.withColumn("block", block.cast("int"))
    thin = placed.select("block", "doc_id", "hash").groupBy("block", "doc_id").agg(F.max("hash").alias("hash"))
    heads = thin.groupBy("block").agg(F.max(F.struct("doc_id", "hash")).alias("head"))
    opening = {r["block"]: (r["head"]["doc_id"], r["head"]["hash"]) for r in heads.collect()}
    if not opening:
        guests = placed.limit(0)
    else:
        order = sorted(opening)  # a block is followed by the one below it
        hosts = [(order[(i + 1) % len(order)], *opening[b]) for i, b in enumerate(order)]
        listed = spark.createDataFrame(hosts, "host int, head_id long, head_hash long")
        guests = (
            placed.join(F.broadcast(listed), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("hash") == F.col("head_hash")))
            .select("doc_id", "body", "hash", F.col("host").alias("block"))
            .dropDuplicates(["block"])
        )
    everyone = placed.withColumn("guest", F.lit(0)).unionByName(guests.withColumn("guest", F.lit(1)))
    order_by = ["guest", F.desc_nulls_last("doc_id"), F.desc("hash")]
    window = Window.partitionBy("block").orderBy(*order_by)
    return everyone.select(
        "block",
        F.row_number().over(window).alias("pos"),
        "guest",
        "doc_id",
        "body",
        F.lead("body").over(window).alias("next_body"),
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text (doc_id, text) and of an edited copy of it, one row per row.

    The edited text has its last floor(n/2) code points replaced by as many (or
    all) from the start of the document that follows in descending doc_id, after
    the last the first.  Null text counts as empty; rows that repeat follow one
    another; other columns are ignored; no rows give no rows.
    """
    rows = with_next(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("body")))
    measured = rows.withColumn("n_chars", F.char_length("body").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("body"), F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring(F.coalesce("next_body", F.lit("")), F.lit(1), half),
    )
    texts = measured.select("block", "pos", "guest", "doc_id", "n_chars", "body", edited.alias("edited"))
    both = texts.select(
        "block",
        "pos",
        "guest",
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.inline(
            F.array(F.struct(F.lit(0).alias("which"), "body"), F.struct(F.lit(1).alias("which"), F.col("edited").alias("body")))
        ),
    ).where("guest = 0 or which = 0")
    keys = ["block", "pos", "which", "guest", "doc_id", "n_chars", "edited_sha256"]
    hashed = vectors(both, keys, "body")
    window = Window.partitionBy("block").orderBy("pos", "which")
    beside = hashed.select(
        *keys,
        "vector",
        F.lead("vector", 1).over(window).alias("edited_vector"),
        F.lead("vector", 2).over(window).alias("next_vector"),
    )
    return beside.where("guest = 0 and which = 0").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("vector")).alias("fingerprint"),
        as_text(F.col("edited_vector")).alias("edited_fingerprint"),
        likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
    )
