"""Diversity of a corpus from its vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators.sampling import sample_n


def diversity(vectors: DataFrame, sample: int | None = None, seed: str = "42") -> DataFrame:
    """Mean cosine over all pairs of `(ord, embedding)` rows, or of a seeded sample.

    The sum over pairs of unit vectors is (|Σu|² - n) / 2, so one sum per dimension
    replaces the pairs. Zero vectors have no direction and are left out.
    """
    rows = vectors if sample is None else sample_n(vectors, sample, seed)
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    square = F.aggregate(doubles, F.lit(0.0), lambda s, x: s + x * x)
    per_dim = (
        rows.select(doubles.alias("_v"), F.sqrt(square).alias("_norm"))
        .filter(F.col("_norm") > 0)
        .select("_norm", F.posexplode("_v").alias("_dim", "_x"))
        .groupBy("_dim")
        .agg(F.sum(F.col("_x") / F.col("_norm")).alias("_s"), F.count("*").alias("_n"))
    )
    n = F.max("_n")
    mean = (F.sum(F.col("_s") * F.col("_s")) - n) / (n * (n - 1))
    return per_dim.agg(n.alias("vectors"), F.when(n > 1, mean).alias("mean_cosine"))
