"""A training-data pipeline over the documents: each stage works on what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.crf_quality import fit_field, judged
from vaultline.llm.jaccard_join import jaccard_components
from vaultline.llm.mixing import mix_sources
from vaultline.llm.piece_matching import encode_documents, load_pieces
from vaultline.llm.queries import DOMAIN, MIX_EPOCHS, MIX_PERCENT, MIX_SEED, PIECE_MODEL, mix_weights
from vaultline.llm.tables import WORD, short_batches, table, written
from vaultline.llm.template_lines import WHITE, drop_recurring_lines

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality field rejects go."""
    short_batches(spark)
    field = fit_field(docs, table(spark, sf_dir, "labels"))
    return docs.where(judged(F.col("text"), field)["score"] >= 0.5)


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go, and with them the documents that had nothing else; n_chars follows the text."""
    short_batches(spark)
    left = drop_recurring_lines(docs).where((F.col("n_dropped") == 0) | F.col("text").rlike(WORD))
    sizes = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", sizes.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id. Rows without an id stay."""
    short_batches(spark)
    others = jaccard_components(docs).where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(written(others, "near-duplicates"), "doc_id", "left_anti").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token budgets by target weights; a document is there once for each epoch that takes it.

    One that is taken in part goes on with its first words; n_chars follows the text.
    """
    chosen = mix_sources(docs, F.expr(DOMAIN), mix_weights(), MIX_PERCENT, MIX_EPOCHS, MIX_SEED)
    part = F.col("taken_tokens") < F.col("n_tokens")
    words = F.regexp_extract_all("text", F.lit(f"(?:{WHITE})?{WORD}"), F.lit(0))
    first = F.array_join(F.slice(words, F.lit(1), F.col("taken_tokens").cast("int")), "")
    cut = chosen.withColumn("text", F.when(part, first).otherwise(F.col("text")))
    sizes = F.when(part, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", sizes.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the texts that they decode to."""
    short_batches(spark)
    return encode_documents(docs, load_pieces(PIECE_MODEL))


STAGES: list[tuple[str, Stage]] = [
    ("quality_field", good_documents),
    ("recurring_lines", without_recurring_lines),
    ("ngram_jaccard_join", without_near_duplicates),
    ("source_mix", mixed),
    ("sentencepiece", encoded),
]

# Trained models and similarity joins have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
