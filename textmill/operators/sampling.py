"""Exact seeded sampling, class balancing and splitting.

Rows are ranked by md5(seed|ord), which depends on neither partitioning nor engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.operators.clean import ORD

_BUCKET_DIGITS = 3  # 4,096 buckets per group


def hash_key(seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(ORD).cast("string")))


def rank_flag(
    df: DataFrame, quota: DataFrame, group: Sequence[str], seed: str, flag: str
) -> DataFrame:
    """Add boolean `flag`: the row is among the first `n` of its group in hash order.

    `quota` has the group columns and `n`; the number of groups must be small (classes).
    Hash prefixes are counted first; only the one bucket per group that the cut falls
    into is ranked, which gives the group's cut key. All joins are against tables of one
    row per group (or group and bucket), so the records are never shuffled or sorted.
    """
    group = list(group)
    keyed = df.withColumn("_hash", hash_key(seed)).withColumn(
        "_bucket", F.substring("_hash", 1, _BUCKET_DIGITS)
    )
    before = (
        Window.partitionBy(*group)
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    edges = (
        keyed.groupBy(*group, "_bucket")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .join(F.broadcast(quota.select(*group, "n")), group)
        # The bucket in which the running count reaches n, or the last one below it.
        .filter((F.col("_before") < F.col("n")))
        .groupBy(*group)
        .agg(
            F.max("_bucket").alias("_bucket"),
            F.max_by(F.col("n") - F.col("_before"), "_bucket").alias("_need"),
        )
    )
    by_hash = Window.partitionBy(*group).orderBy("_hash", ORD)
    cuts = (
        keyed.select(*group, ORD, "_hash", "_bucket")
        .join(F.broadcast(edges), [*group, "_bucket"])
        .withColumn("_rank", F.row_number().over(by_hash))
        .filter(F.col("_rank") <= F.col("_need"))
        .groupBy(*group)
        .agg(F.max(F.struct("_hash", ORD)).alias("_cut"))
    )
    picked = F.coalesce(F.struct("_hash", ORD) <= F.col("_cut"), F.lit(False))
    return (
        keyed.join(F.broadcast(cuts), group, "left")
        .withColumn(flag, picked)
        .select(*df.columns, flag)
    )


def class_counts(df: DataFrame, by: Sequence[str] = ("task",)) -> DataFrame:
    return df.groupBy(*by, "label").agg(F.count("*").alias("rows"))


def balanced_counts(df: DataFrame, by: Sequence[str] = ("task",)) -> DataFrame:
    """The class counts that `undersample` leaves."""
    return class_counts(df, by).withColumn("rows", F.min("rows").over(Window.partitionBy(*by)))


def undersample(df: DataFrame, seed: str, by: Sequence[str] = ("task",)) -> DataFrame:
    """The same number of rows from every class of a task: that of its smallest class."""
    counts = class_counts(df, by)
    smallest = F.min("rows").over(Window.partitionBy(*by))
    quota = counts.withColumn("n", smallest)
    return rank_flag(df, quota, [*by, "label"], seed, "_keep").filter("_keep").drop("_keep")


def split_quota(counts: DataFrame, test_share: float, by: Sequence[str]) -> DataFrame:
    """Training rows per class: shares kept by largest remainder, ties by label."""
    task = Window.partitionBy(*by)
    n = F.sum("rows").over(task)
    n_train = n - F.ceil(F.lit(test_share) * n)
    exact = F.col("rows") * F.col("_train") / F.col("_all")
    ranked = (
        counts.withColumn("_all", n)
        .withColumn("_train", n_train)
        .withColumn("_floor", F.floor(exact))
        .withColumn("_left", F.col("_train") - F.sum("_floor").over(task))
        .withColumn(
            "_rank",
            F.row_number().over(task.orderBy(F.desc(exact - F.col("_floor")), "label")),
        )
    )
    extra = (F.col("_rank") <= F.col("_left")).cast("bigint")
    return ranked.withColumn("n", F.col("_floor") + extra)


def _as_split(df: DataFrame) -> DataFrame:
    split = F.when(F.col("_in_train"), "train").otherwise("test")
    return df.withColumn("split", split).drop("_in_train")


def split_stratified(
    df: DataFrame, test_share: float, seed: str, by: Sequence[str] = ("task",)
) -> DataFrame:
    """Add `split` (train/test) with ceil(test_share·n) test rows per task."""
    quota = split_quota(class_counts(df, by), test_share, by)
    return _as_split(rank_flag(df, quota, [*by, "label"], seed, "_in_train"))


def split_random(
    df: DataFrame, test_share: float, seed: str, by: Sequence[str] = ("task",)
) -> DataFrame:
    """`split_stratified` with one stratum per task."""
    counts = df.groupBy(*by).agg(F.count("*").alias("rows"))
    n = F.col("rows") - F.ceil(F.lit(test_share) * F.col("rows"))
    return _as_split(rank_flag(df, counts.withColumn("n", n), by, seed, "_in_train"))


def check_splittable(counts: DataFrame, test_share: float, by: Sequence[str]) -> None:
    """Raise before the job runs if a class is too small to be split."""
    task = Window.partitionBy(*by)
    bad = (
        counts.withColumn("_test", F.ceil(F.lit(test_share) * F.sum("rows").over(task)))
        .withColumn("_classes", F.count("*").over(task))
        .filter((F.col("rows") < 2) | (F.col("_test") < F.col("_classes")))
        .first()
    )
    if bad is not None:
        raise ValueError(f"class {bad['label']!r} is too small to split ({bad['rows']} rows)")


def sample_n(df: DataFrame, n: int, seed: str) -> DataFrame:
    """Exactly min(n, rows) rows; a top-n per task, so meant for report-sized samples."""
    return df.orderBy(hash_key(seed), ORD).limit(n)
