"""A training corpus from raw documents, as stages that each write a table the next one reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm import decontaminate, lines, pieces, similar, toxicity
from smelter.llm.common import saved, table, whole_text, with_row_key
from smelter.llm.queries import PIECE_MODEL
from smelter.session import ship_package


def _set_apart(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its other columns than doc_id and text under names that no operator uses, and the way back."""
    names = [c if c in ("doc_id", "text") else f"__source_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), [F.col(n).alias(c) for n, c in zip(names, docs.columns)]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; all columns stay, also one named ``toxicity``."""
    labels = table(spark, sf_dir, "labels")
    models = toxicity.train(docs.select("doc_id", "text"), labels)
    rows, back = _set_apart(docs)
    return toxicity.scored(rows, models).where("toxicity < 0.5").select(back)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that repeat; n_chars follows the text, all other columns stay."""
    rows, back = _set_apart(docs)
    kept = lines.drop_repeated_lines(rows).select(back)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest doc_id (null last), then text hash.

    Groups come from SimHash links and bands, checked exactly at 0.8 of five-word shingles.
    """
    groups = similar.similar_groups(docs.select("doc_id", "text"))
    row = F.xxhash64("doc_id", F.col("doc_id").isNull(), "node")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "node", row.alias("__row"))
    kept = groups.groupBy("component").agg(F.min(rank).alias("least")).select("least.__row")
    node = similar.node_of(whole_text())
    apart, back = _set_apart(docs)
    rows = apart.withColumn("__row", F.xxhash64(F.col("doc_id").cast("long"), F.col("doc_id").isNull(), node))
    return rows.join(kept, "__row", "left_semi").dropDuplicates(["__row"]).select(back)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    leaks = decontaminate.contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    keys = leaks.select(F.col("row_id").alias("leak_id"), F.col("row_hash").alias("leak_hash")).distinct()
    apart, back = _set_apart(docs)
    rows = with_row_key(apart, "__row")
    same = F.col("__row_id").eqNullSafe(F.col("leak_id")) & (F.col("__row_hash") == F.col("leak_hash"))
    return rows.join(keys, same, "left_anti").select(back)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with its next best segmentations."""
    return pieces.encode_documents(docs, pieces.model_bytes(PIECE_MODEL))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("piece_encoding", encode),
]

# Learned scores, hashes and piece lattices have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = table(ship_package(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
