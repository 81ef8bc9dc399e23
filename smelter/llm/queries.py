"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm import (
    decontaminate,
    fingerprints,
    lines,
    manifest,
    pieces,
    pii,
    prefix_free,
    ranked,
    secret_scan,
    sharding,
    simhash,
    spans,
    toxicity,
)
from smelter.llm.common import table
from smelter.llm.registry import ORACLES, QUERIES, query  # noqa: F401

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@query()
def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by SimHash fingerprints."""
    groups = simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op2_edited_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset fingerprints of every document and of its edited copy."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query()
def op5_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of nearly equal bytes."""
    dealt = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(decontaminate.LEAKS_SQL)
def op10_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, also with other numbers or names."""
    leaks = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select(
        F.col("row_id").alias("doc_id"), "item_id", "matched", "item_windows", "coverage", "first_pos", "changed"
    )


@query()
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate for a secret, with the forest's verdict; values leave as hashes only."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "at",
        F.sha2("value", 256).alias("value_sha256"),
        F.col("length").cast("long").alias("length"),
        F.lower(F.regexp_extract(F.concat_ws(" ", "name", "before"), "^ ?[A-Za-z_ ]{0,40}$", 0)).alias("context"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("is_secret"),
    )


@query(spans.REPEATS_SQL)
def op8_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without sentences that repeat earlier ones."""
    kept = spans.drop_repeated_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "text", "sentences", "removed_sentences")


@query()
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines that equal or nearly equal earlier ones."""
    kept = lines.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "text", "lines", "removed_lines", "line_links")


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of a fifth of the ids are never learnt from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    result = toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return result.select(
        "doc_id",
        (toxicity.remainder(F.col("doc_id")) == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: fixed patterns, and what the field adds."""
    return pii.find(table(spark, sf_dir, "documents"))


@query()
def op4_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as pieces, with its four best segmentations and whether it decodes to itself."""
    model = pieces.model_bytes(PIECE_MODEL)
    return pieces.encode_documents(table(spark, sf_dir, "documents"), model)


@query(manifest.PROOFS_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest, proof and subroot of every row, checked against a tampered copy."""
    return manifest.proofs_of_tampered(table(spark, sf_dir, "documents"))


@query()
def op12_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without byte strings that also start elsewhere."""
    kept = prefix_free.drop_repeated_bytes(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(ranked.MATCHES_SQL)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for every benchmark item."""
    return ranked.best_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
