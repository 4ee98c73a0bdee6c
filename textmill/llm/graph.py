"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.runtime import materialize


def components(links: DataFrame) -> DataFrame:
    """`(rep, component)` for every end of a link `(a, b)`: the smallest id that links reach.

    Each round maps a node to the smallest of itself and its neighbours and the links with
    it; a node that a component ends in never maps to another. Rounds shrink the links until none
    is left. Minima are combined before the shuffle, and every round is written.
    """
    edges = materialize(links.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low"))
        step = materialize(lowest.select(F.col("a").alias("node"), F.least("a", "low").alias("to")), "contracted")
        if labels is None:
            labels = step.select(F.col("node").alias("rep"), F.col("to").alias("component"))
        else:
            moved = labels.join(step, labels["component"] == step["node"], "left")
            labels = materialize(moved.select("rep", F.coalesce("to", "component").alias("component")), "labels")
        to = lambda name: step.select(F.col("node").alias(name), F.col("to").alias(f"to_{name}"))
        mapped = edges.join(to("a"), "a").join(to("b"), "b").filter("to_a <> to_b")
        mapped = mapped.select(F.greatest("to_a", "to_b").alias("a"), F.least("to_a", "to_b").alias("b"))
        edges = materialize(mapped.distinct(), "edges")
    if labels is None:
        return links.select(F.col("a").alias("rep"), F.col("b").alias("component")).limit(0)
    return labels


def extend(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components `found` after more links; only links between different components are followed."""
    at = lambda name: found.select(F.col("rep").alias(name), F.col("component").alias(f"at_{name}"))
    ends = links.join(at("a"), "a", "left").join(at("b"), "b", "left")
    moved = components(ends.select(F.coalesce("at_a", "a").alias("a"), F.coalesce("at_b", "b").alias("b")))
    moved = moved.select(F.col("rep").alias("old"), F.col("component").alias("new"))
    kept = found.join(moved, found["component"] == moved["old"], "left")
    kept = kept.select("rep", F.coalesce("new", "component").alias("component"))
    # What was a component of its own before the links came, or had no component.
    added = moved.select(F.col("old").alias("rep"), F.col("new").alias("component"))
    return kept.unionByName(added.join(found, "rep", "left_anti"))
