"""Summaries of counters and the exact top k."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textmill.operators import topk

ROWS = "term string, tf bigint"


def _zipf(n, terms, seed=1):
    draw = random.Random(seed)
    weights = [1 / (i + 1) for i in range(terms)]
    return [(f"t{i:05d}", draw.randint(1, 3)) for i in draw.choices(range(terms), weights, k=n)]


def _expected(rows, k):
    tf, df = Counter(), Counter()
    for term, n in rows:
        if term is not None:
            tf[term] += n
            df[term] += 1
    return [(t, tf[t], df[t]) for t in sorted(tf, key=lambda t: (-tf[t], t))[:k]]


@pytest.mark.parametrize("capacity", [None, 40, 200, 5000])
def test_equal_to_counting_everything(spark, capacity):
    rows = _zipf(30_000, 3_000)
    df = spark.createDataFrame(rows, ROWS).repartition(6)
    got = [tuple(r) for r in topk.top_k_exact(df, 20, capacity).collect()]
    assert got == _expected(rows, 20)


def test_counters_miss_at_most_the_error(spark):
    rows = _zipf(20_000, 2_000, seed=2)
    df = spark.createDataFrame(rows, ROWS).repartition(5).cache()
    stored = topk.summaries(df, 50).collect()
    tasks = {r["term"]: 0 for r in stored}
    error = sum(r["error"] for r in stored if r["term"] is None)
    for r in stored:
        tasks[r["term"]] += r["tf"]
    assert error > 0 and len(stored) <= 5 * 51
    for term, tf, _ in _expected(rows, 2_000):
        assert tasks.get(term, 0) <= tf <= tasks.get(term, 0) + error


def test_candidates_are_few_and_proven(spark):
    rows = _zipf(40_000, 4_000, seed=3)
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    found = topk.candidates(df, 10, 400)
    assert found.proven and 0 < found.error < found.floor
    terms = {r["term"] for r in found.terms.collect()}
    assert {t for t, _, _ in _expected(rows, 10)} <= terms and len(terms) < 400


def test_flat_counts_prove_nothing_and_stay_exact(spark):
    rows = [(f"t{i:04d}", 1) for i in range(3_000)] * 2
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    assert not topk.candidates(df, 5, 40).proven
    assert [tuple(r) for r in topk.top_k_exact(df, 5, 40).collect()] == _expected(rows, 5)


def test_odd_rows(spark):
    rows = [("b", 1), ("a", 1), (None, 99), ("", 1), ("b", 1), ("é好", 1), ("x" * 100_000, 1)]
    df = spark.createDataFrame(rows, ROWS)
    assert [tuple(r) for r in topk.top_k_exact(df, 3).collect()] == _expected(rows, 3)
    assert topk.top_k_exact(df, 100).count() == 5
    assert topk.top_k_exact(df.filter("false"), 3).count() == 0
    with pytest.raises(ValueError):
        topk.top_k_exact(df, 0)


def test_only_candidates_are_shuffled(spark):
    df = spark.createDataFrame(_zipf(40_000, 4_000, seed=3), ROWS).repartition(4)
    plan = topk.top_k_exact(df, 10, 400)._jdf.queryExecution().executedPlan().toString()
    # The semi-join comes before the grouping's exchange.
    assert plan.index("HashAggregate") < plan.index("Exchange hashpartitioning(term") < plan.index("BroadcastHashJoin")


def test_hot_term(spark):
    rows = [("hot", 1)] * 10_000 + [(f"t{i}", 1) for i in range(5_000)]
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    assert topk.top_k_exact(df, 1, 10).select(F.struct("*")).first()[0] == ("hot", 10_000, 10_000)
