"""The operators' queries."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import align, chat, exact, forest, lines, mixing, packing, partitions, quality, runs, secrets, sharding, tokens
from textmill.llm.common import read_table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(secrets.find_secrets(read_table(spark, sf_dir, "documents")))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.format_conversations(chat.with_extra(read_table(spark, sf_dir, "conversations"))))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read_table(spark, sf_dir, "documents"))


def op7_near_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_components(read_table(spark, sf_dir, "documents"), width=4)


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.dedupe_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "rule")


def op10_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.group_copies(read_table(spark, sf_dir, "documents"))


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    sha = lambda groups: hashlib.sha256(groups.encode()).hexdigest()
    return align.align_tokens(read_table(spark, sf_dir, "documents"), form=sha).withColumnRenamed("groups", "groups_sha256")


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(runs.periodic_runs(read_table(spark, sf_dir, "documents"), runs.planted))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_secrets,
        op2_mix,
        op3_shards,
        op4_chat,
        op5_pack,
        op6_token_counts,
        op7_near_components,
        op8_lines,
        op9_quality,
        op10_copies,
        op11_align,
        op12_runs,
        op13_nearest,
    )
}
