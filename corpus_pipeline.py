"""From raw documents to packed training sequences.

Quality rules drop documents, line dedup drops repeated lines, near-dedup keeps one document of
each group, mixing takes each document as often as its source's target wants, and packing cuts
what is left into token sequences. Each stage takes what the one before it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import forest, lines, mixing, packing, quality
from textmill.llm.common import read_table
from textmill.runtime import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned ones reject."""
    return quality.keep_good(docs.select(COLUMNS), read_table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds; `n_chars` follows the text."""
    cleaned = lines.dedupe_lines(docs)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies, by five-word shingles."""
    kept = forest.near_components(docs).filter("kept").select(F.col("doc_id").alias("_llm_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_llm_id"]), "left_semi").select(COLUMNS)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to twice."""
    return mixing.take_copies(docs).select(COLUMNS)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces with their sequences; a document that was taken twice has its pieces twice."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near", near_stage),
    ("mix", mix_stage),
    ("pack", pack_stage),
]

#: Near-duplicate groups and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages from `documents` on, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
