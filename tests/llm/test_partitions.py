"""Learned partitions against brute force."""

import os

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from textmill.llm import partitions, queries
from textmill.llm.common import read_table

SCHEMA = "vec_id long, embedding array<float>, part int, row int, x int"


def brute(rows, is_query, k):
    """query_id to its (vec_id, score) list, of (vec_id, vector) rows that are fit to take part."""
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, (q, v) in enumerate(rows):
        if is_query(q):
            score = (x * x[i]).sum(axis=1)
            order = sorted((-score[j], rows[j][0], j) for j in range(len(rows)) if j != i)[:k]
            out[q] = [(vec_id, -s) for s, vec_id, _ in order]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / max(1, len(want[q])) for q in want])


def vectors(n, d=16, clusters=40, seed=3, length=False):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((clusters, d))[rng.integers(clusters, size=n)] + 0.6 * rng.standard_normal((n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return (x * rng.uniform(0.2, 3.0, (n, 1)) if length else x).astype(np.float32)


def table(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v], 1, 1, 1) for i, v in enumerate(x)], SCHEMA)


def test_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in read_table(spark, SF_DIR, "embeddings").select("vec_id", "embedding").collect()]
    got = results(queries.op13_nearest(spark, SF_DIR))
    want = brute(rows, lambda i: i % 20 == 0, 20)
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    assert recall(got, want) >= 0.9


@pytest.mark.parametrize("length", [False, True])
def test_recall_of_many_parts(spark, monkeypatch, length):
    """Several parts, fewer probes than parts, a bounded sample: recall, and exact scores in order."""
    for name, value in {"LEAST_PARTS": 16, "FIT_ROWS": 2_000, "HELD_OUT": 200, "ROW_BLOCK": 100, "QUERY_BLOCK": 50, "EPOCHS": 20}.items():
        monkeypatch.setattr(partitions, name, value)
    x = vectors(4_000, length=length)
    fitted = []
    fit = partitions.fit
    monkeypatch.setattr(partitions, "fit", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    got = results(partitions.nearest(table(spark, x), F.col("vec_id") % 20 == 0))
    want = brute(list(enumerate(x)), lambda i: i % 20 == 0, 20)
    assert fitted[0].n_parts == 16 and fitted[0].probes < 16
    assert recall(got, want) >= 0.9 and all(len(v) == 20 for v in got.values())
    for q, found in got.items():
        assert found == sorted(found, key=lambda r: (-r[1], r[0])) and q not in dict(found)
        for vec_id, score in found:
            assert score == pytest.approx(float(x[q].astype(np.float64) @ x[vec_id].astype(np.float64)), abs=1e-12)


def test_parts_are_balanced_and_cut_few_edges():
    x = vectors(1_024).astype(np.float64)
    near = partitions.nearest_in(x, x, 10, own=True)
    graph = partitions.Graph(near)
    part = partitions.balanced_parts(graph, 8, np.random.default_rng(1))
    assert set(np.bincount(part)) == {128}
    cut = np.mean(part[graph.a] != part[graph.b])
    shuffled = np.random.default_rng(2).permutation(part)
    assert cut < 0.5 * np.mean(shuffled[graph.a] != shuffled[graph.b])


@pytest.mark.parametrize("blocks", [{}, {"ROW_BLOCK": 8, "QUERY_BLOCK": 3}])
def test_ties_and_one_common_vector(spark, monkeypatch, blocks):
    """A third of all rows are one vector: its neighbours are the smallest ids, in one block or in many."""
    for name, value in blocks.items():
        monkeypatch.setattr(partitions, name, value)
    x = vectors(300)
    x[::3] = x[0]
    got = results(partitions.nearest(table(spark, x), F.col("vec_id") % 20 == 0))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in brute(list(enumerate(x)), lambda i: i % 20 == 0, 20).items()}
    assert [i for i, _ in got[60]] == [i for i in range(0, 66, 3) if i != 60][:20]


def test_few_candidates_in_the_probed_parts(spark):
    """A query whose part is too small goes on to others; with fewer rows than asked for, all are found."""
    router = partitions.Router([np.zeros((4, 1)), np.zeros(1), np.zeros((1, 4)), np.array([3.0, 2.0, 1.0, 0.0])], 1.0, 4, 1)
    x = vectors(30, d=3)

    class Spread(partitions.Router):
        def parts(self, x):
            return np.where(x[:, 0] > 0.5, 0, np.where(x[:, 0] > 0, 1, np.where(x[:, 1] > 0, 2, 3)))

    spread = Spread(router.weights, 1.0, 4, 1)
    for k in (5, 29, 50):
        got = results(partitions.nearest(table(spark, x), F.col("vec_id") == 7, k, router=spread))
        assert len(got[7]) == min(k, 29)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []),
        (8, [1.0, 0.0, 0.0]), (None, [3.0, 3.0]), (20, [2.0, 1.0]), (20, [2.0, 1.0]), (40, None), (60, [-inf, 0.0]), (80, [0.0, -1.0]),
    ]
    df = spark.createDataFrame([(i, v, 1, 1, 1) for i, v in rows], SCHEMA)
    got = partitions.nearest(df, F.col("vec_id") % 20 == 0).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert by[0] == [(1, 20, 2.0), (2, 20, 2.0), (3, 1, 0.5), (4, 80, 0.0)]
    assert by[80] == [(1, 0, 0.0), (2, 1, -0.5), (3, 20, -1.0), (4, 20, -1.0)]
    assert sorted(by[20]) == sorted(2 * [(1, 20, 5.0), (2, 0, 2.0), (3, 1, 1.5), (4, 80, -1.0)])
    assert set(by) == {0, 20, 80}
    assert partitions.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert partitions.nearest(df.filter("vec_id IN (0, 2)"), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1"), reason="larger table")
def test_recall_on_a_larger_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in read_table(spark, "/root/testdata/sf0.1", "embeddings").select("vec_id", "embedding").collect()]
    got = results(queries.op13_nearest(spark, "/root/testdata/sf0.1"))
    assert recall(got, brute(rows, lambda i: i % 20 == 0, 20)) >= 0.9
