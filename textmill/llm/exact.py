"""Exact dedup: skew-safe combining of equal texts.

Texts are equal when they are identical after lower-casing A-Z. Copies are combined in
three steps, each of which compares the whole text and not only its digest:

1. every task combines the copies that it has read (partial aggregation),
2. the rows of a digest meet in `salts` separate groups,
3. the winners of these groups are combined to one row per text.

A text that fills a third of the table thus reaches any reducer as one row per task in
step 2 and as one row per salt in step 3. Documents get their group by the digest; where
one digest stands for several texts, by digest and text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import lower_ascii, text_or_empty
from textmill.runtime import materialize

SALTS = 8


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _combine(keyed: DataFrame, salts: int) -> DataFrame:
    """`(_digest, _norm, keep_id, group_size)`, one row per text."""
    salted = keyed.groupBy("_digest", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("_salt"), "_norm").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    return salted.groupBy("_digest", "_norm").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def group_copies(
    docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256_hex
) -> DataFrame:
    """`(doc_id, keep_id, group_size, kept, text_sha256)`, one row per row of `docs`.

    `keep_id` is the largest doc_id of the rows with an equal text and `group_size` their
    number. A null text counts as empty. A null doc_id never wins over another one and is
    not kept unless its whole group has none; rows that repeat the largest doc_id with the
    same text are all marked as kept. An empty table gives an empty result. Columns other
    than doc_id and text are not read. `digest` only steers where rows meet.
    """
    keyed = docs.select("doc_id", lower_ascii(text_or_empty()).alias("_norm"))
    keyed = keyed.select("doc_id", "_norm", digest(F.col("_norm")).alias("_digest"))
    groups = materialize(_combine(keyed, salts).drop("_norm"), "copies")
    shared = groups.groupBy("_digest").count().filter("count > 1").select("_digest")
    by_digest = keyed.join(groups, "_digest")
    if not shared.isEmpty():
        alone = groups.join(shared, "_digest", "left_anti")
        mixed = keyed.join(shared, "_digest", "left_semi")
        columns = ["doc_id", "_norm", "_digest", "keep_id", "group_size"]
        by_text = mixed.join(_combine(mixed, salts), ["_digest", "_norm"])
        by_digest = keyed.join(alone, "_digest").select(columns).unionByName(by_text.select(columns))
    sha = F.col("_digest") if digest is sha256_hex else sha256_hex(F.col("_norm"))
    return by_digest.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        sha.alias("text_sha256"),
    )
