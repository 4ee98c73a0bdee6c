"""Three-tier routing: fixed rule, small model, escalation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def route(
    df: DataFrame,
    rules: Sequence[tuple[str, str]],
    threshold: float,
    predicted: str = "predicted",
    probability: str = "probability",
) -> DataFrame:
    """Add `tier` and `decision`: the first matching rule, else a confident prediction."""
    sure = F.col(probability) >= threshold
    tier, decision = None, None
    for pattern, outcome in rules:
        hit = F.col("text").rlike(pattern)
        tier = tier.when(hit, "rule") if tier is not None else F.when(hit, "rule")
        decision = decision.when(hit, outcome) if decision is not None else F.when(hit, outcome)
    if tier is None:
        tier, decision = F.when(sure, "model"), F.when(sure, F.col(predicted))
    else:
        tier, decision = tier.when(sure, "model"), decision.when(sure, F.col(predicted))
    return df.withColumn("tier", tier.otherwise("escalate")).withColumn(
        "decision", decision.otherwise("escalate")
    )
