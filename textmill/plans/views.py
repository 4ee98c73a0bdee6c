"""Record views over the given Parquet tables.

`classified`: documents with a quality label are the confirmation task, conversation
turns the question task. `tagged`: every document as a token list with rule-made tags.
`payloads`: the confirmation records as JSON responses. All views read whole tables and
whole texts; faults (foreign labels, missing or short tag lists, truncated responses)
follow from the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.tags import after_previous
from textmill.sources.records import load_table
from textmill.spec import CONFIRMATION, ENTITIES, QUESTION

RECORDS_PER_RESPONSE = 25


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "documents", spread_by="doc_id")


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(task, ord, text, label)`; toxic documents and system turns have foreign labels."""
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    labels = load_table(spark, sf_dir, "labels")
    label = (
        F.when(F.col("toxic") == 1, "Unsure")
        .when(F.col("quality") == 1, "Affirm")
        .otherwise("Deny")
    )
    confirmation = docs.join(labels, "doc_id").select(
        F.lit(CONFIRMATION.name).alias("task"), F.col("doc_id").alias("ord"), "text", label.alias("label")
    )
    return confirmation.unionByName(questions(spark, sf_dir))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = (
        F.when(F.col("role") == "user", "Question")
        .when(F.col("role") == "assistant", "Statement")
        .otherwise(F.col("role"))
    )
    turns = load_table(spark, sf_dir, "conversations", spread_by="conv_id")
    # Room for the longest conversation, so that no two turns share an ordinal.
    room = (turns.agg(F.max("turn")).first()[0] or 0) + 1
    return turns.select(
        F.lit(QUESTION.name).alias("task"),
        (F.col("conv_id") * room + F.col("turn")).alias("ord"),
        "text",
        label.alias("label"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(ord, text)` of all documents."""
    return _docs(spark, sf_dir).select(F.col("doc_id").alias("ord"), "text")


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(task, ord, tokens, tags)` of all documents.

    Capitalised parts are projects (continued by a part with a comma), other parts with
    a comma are persons, parts with a full stop events; parts starting with a digit get a
    tag outside the map. Toxic documents lack tags, poor ones the last tag.
    """
    labels = load_table(spark, sf_dir, "labels")
    docs = _docs(spark, sf_dir).join(labels, "doc_id", "left")
    parts = F.filter(F.split("text", "[ \t\r\n]+"), lambda p: p != "")

    def tag(pair):
        before, part = pair["before"], pair["item"]
        return (
            F.when(part.rlike(r"^\p{Lu}"), "B-PROJ")
            .when(part.rlike("^[0-9]"), "B-XXX")
            .when(part.endswith(",") & before.rlike(r"^\p{Lu}"), "I-PROJ")
            .when(part.endswith(","), "B-PERS")
            .when(part.endswith(".") & before.endswith(","), "I-EVT")
            .when(part.endswith("."), "B-EVT")
            .otherwise("O")
        )

    tags = F.col("_tags")
    return (
        docs.select("doc_id", "quality", "toxic", parts.alias("tokens"))
        .withColumn("_tags", F.transform(after_previous(F.col("tokens"), ""), tag))
        .select(
            F.lit(ENTITIES.name).alias("task"),
            F.col("doc_id").alias("ord"),
            "tokens",
            F.when(F.col("toxic") == 1, None)
            .when(F.col("quality") == 0, F.slice(tags, F.lit(1), F.greatest(F.size(tags) - 1, F.lit(0))))
            .otherwise(tags)
            .alias("tags"),
        )
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(batch, payload)`: all documents, up to 25 consecutive ones per response.

    Poor documents come without their label, or as a bare number if they have one line. Toxic
    ones get a response of their own with a negative number: a lone object, cut off before its end if
    the document is poor, too. Documents without labels are good ones.
    """
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    joined = docs.join(load_table(spark, sf_dir, "labels"), "doc_id", "left")
    text = F.col("text").alias("text")
    full = F.to_json(F.struct(text, F.lit("Affirm").alias("label")))
    poor = F.coalesce(F.col("quality") == 0, F.lit(False))
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    item = (
        F.when(poor & ~F.contains("text", F.lit("\n")), F.col("doc_id").cast("string"))
        .when(poor, F.to_json(F.struct(text)))
        .otherwise(full)
    )
    # At most 25 documents share a batch number, so a group is bounded.
    batches = (
        joined.select(
            F.when(toxic, -1 - F.col("doc_id")).otherwise(F.expr(f"doc_id div {RECORDS_PER_RESPONSE}")).alias("batch"),
            F.struct("doc_id", item.alias("item")).alias("_i"),
            poor.alias("_poor"),
        )
        .groupBy("batch")
        .agg(F.array_sort(F.collect_list("_i")).alias("_items"), F.max("_poor").alias("_poor"))
    )
    body = F.concat(F.lit("["), F.array_join("_items.item", ","))
    alone = F.col("batch") < 0
    payload = (
        F.when(alone & F.col("_poor"), F.concat(F.lit('{"items": '), body))
        .when(alone, F.concat(F.lit('{"items": '), body, F.lit("]}")))
        .otherwise(F.concat(body, F.lit("]")))
    )
    return batches.select("batch", payload.alias("payload"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("ord"), "embedding")
