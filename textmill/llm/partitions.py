"""Nearest neighbours by learned partitions (Dong et al., 2020).

On a sample of at most `FIT_ROWS` distinct vectors the graph of nearest neighbours is cut into equal parts, by recursive
bisection: a spectral order split in the middle, then exchanges that lower the number of cut edges. A small classifier learns
the part of a vector, and for a query the parts of its neighbours. Every row of the table is indexed in its most probable
part; a query goes to its most probable parts, as many as held-out queries of the sample need, and is compared
with all of their rows in double precision.

The largest inner product is the nearest neighbour once rows are scaled to the greatest norm and get one more component that
fills them up to the unit sphere, so vectors of any length can be partitioned.

Only counts per part and the sample reach the driver. A part is searched in blocks of rows and of queries, so that a part which
holds a third of all rows is many tasks; of equal vectors in a block, more than a result can hold need not be looked at.
Where a table has more than `MOST_PARTS` * `PART_ROWS` rows, parts grow with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.runtime import materialize

#: Vectors the index is fitted on at most, those of them held out for the number of probes, and neighbours in the graph.
FIT_ROWS, HELD_OUT, DEGREE = 16_000, 1_000, 10
#: Rows that a part should have, and the fewest and most parts.
PART_ROWS, LEAST_PARTS, MOST_PARTS = 32_768, 32, 256
#: Recall of the held-out queries that the number of probes must reach.
RECALL = 0.95
#: Hidden units, passes over the sample, rows of a step and step size of the classifier.
HIDDEN, EPOCHS, STEP_ROWS, RATE = 128, 40, 256, 3e-3
#: Most rows and queries of a block.
ROW_BLOCK, QUERY_BLOCK = 32_768, 2_048
#: Queries that are multiplied with a block at once.
AT_ONCE = 128
#: Relative error that inner products of a matrix product may have.
SLACK = 1e-12


def row_features(x: np.ndarray, norm: float) -> np.ndarray:
    """Rows as points of the unit sphere, one component more."""
    scaled = x / norm
    return np.column_stack([scaled, np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))])


def query_features(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros(len(x))])


def nearest_in(queries: np.ndarray, rows: np.ndarray, k: int, own: bool) -> np.ndarray:
    """Places of the `k` rows with the largest inner product; `own`: query i is row i and not its own neighbour."""
    out = np.zeros((len(queries), k), np.int64)
    for at in range(0, len(queries), 1000):
        score = queries[at : at + 1000] @ rows.T
        if own:
            score[np.arange(len(score)), at + np.arange(len(score))] = -np.inf
        out[at : at + 1000] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


class Graph:
    """An undirected graph as two arrays of ends, each edge in both directions."""

    def __init__(self, neighbours: np.ndarray):
        n, k = neighbours.shape
        a, b = np.repeat(np.arange(n), k), neighbours.ravel()
        edges = np.unique(np.concatenate([a * n + b, b * n + a]))
        self.n, self.a, self.b = n, edges // n, edges % n

    def restrict(self, nodes: np.ndarray) -> Graph:
        place = np.full(self.n, -1)
        place[nodes] = np.arange(len(nodes))
        inside = (place[self.a] >= 0) & (place[self.b] >= 0)
        part = object.__new__(Graph)
        part.n, part.a, part.b = len(nodes), place[self.a[inside]], place[self.b[inside]]
        return part

    def times(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.a, weights=x[self.b], minlength=self.n)


def bisect(graph: Graph, rng: np.random.Generator) -> np.ndarray:
    """Which half each node is in; halves differ by one node at most."""
    degree = np.maximum(np.bincount(graph.a, minlength=graph.n), 1).astype(float)
    x = rng.standard_normal(graph.n)
    for _ in range(60):  # power steps towards the slowest mode of a lazy walk, without the constant one
        x = 0.5 * (x + graph.times(x) / degree)
        x -= (degree * x).sum() / degree.sum()
        x /= np.sqrt((x * x).sum()) + 1e-300
    side = np.zeros(graph.n, bool)
    side[np.argsort(x, kind="stable")[graph.n // 2 :]] = True
    for _ in range(12):
        gain = graph.times(np.where(side, 1.0, -1.0)) * np.where(side, -1.0, 1.0)  # edges cut less the others
        up, down = np.flatnonzero(side), np.flatnonzero(~side)
        up, down = up[np.argsort(-gain[up], kind="stable")], down[np.argsort(-gain[down], kind="stable")]
        n = min(len(up), len(down))
        # Half of the pairs that win: neighbours that change sides together would undo each other's gain.
        swap = int((gain[up[:n]] + gain[down[:n]] > 0).sum()) // 2
        if not swap:
            break
        before, old = _cut(graph, side), side.copy()
        side[up[:swap]], side[down[:swap]] = False, True
        if _cut(graph, side) >= before:
            side = old
            break
    return side


def _cut(graph: Graph, side: np.ndarray) -> int:
    return int((side[graph.a] != side[graph.b]).sum())


def balanced_parts(graph: Graph, n_parts: int, rng: np.random.Generator) -> np.ndarray:
    """The part of each node, of a power of two parts of equal size."""
    part = np.zeros(graph.n, np.int64)
    for level in range(n_parts.bit_length() - 1):
        halves = part.copy()
        for p in range(1 << level):
            nodes = np.flatnonzero(part == p)
            halves[nodes] = 2 * p + bisect(graph.restrict(nodes), rng)
        part = halves
    return part


@dataclass
class Router:
    """Softmax over parts of one hidden layer."""

    weights: list[np.ndarray]
    norm: float
    n_parts: int
    probes: int

    def scores(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum(features @ w1 + b1, 0.0) @ w2 + b2

    def parts(self, x: np.ndarray) -> np.ndarray:
        return self.scores(row_features(x, self.norm)).argmax(axis=1)

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """All parts of each query, the most probable first."""
        return np.argsort(-self.scores(query_features(x)), axis=1, kind="stable")


def train(features: np.ndarray, target: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
    """Weights that lower the cross entropy to the target distributions, by Adam."""
    d, p = features.shape[1], target.shape[1]
    weights = [rng.standard_normal((d, HIDDEN)) * np.sqrt(2 / d), np.zeros(HIDDEN), rng.standard_normal((HIDDEN, p)) * np.sqrt(1 / HIDDEN), np.zeros(p)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step, last = 0, EPOCHS * -(-len(features) // STEP_ROWS)
    for _ in range(EPOCHS):
        order = rng.permutation(len(features))
        for at in range(0, len(order), STEP_ROWS):
            step += 1
            x, y = features[order[at : at + STEP_ROWS]], target[order[at : at + STEP_ROWS]]
            hidden = np.maximum(x @ weights[0] + weights[1], 0.0)
            logits = hidden @ weights[2] + weights[3]
            logits -= logits.max(axis=1, keepdims=True)
            out = np.exp(logits)
            out = (out / out.sum(axis=1, keepdims=True) - y) / len(x)
            back = (out @ weights[2].T) * (hidden > 0)
            for i, g in enumerate((x.T @ back, back.sum(axis=0), hidden.T @ out, out.sum(axis=0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                rate = RATE * (1 - (step - 1) / last)
                weights[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return weights


def fit(sample: np.ndarray, norm: float, n_rows: int, k: int) -> Router:
    """The index of a table of `n_rows` rows, whose greatest norm is `norm`."""
    rng = np.random.default_rng(7)
    sample = np.unique(sample, axis=0)
    rng.shuffle(sample)
    wanted = min(MOST_PARTS, max(LEAST_PARTS, n_rows // PART_ROWS), len(sample) // (4 * DEGREE))
    n_parts = 1 << max(0, wanted.bit_length() - 1)
    if n_parts == 1:
        return Router([np.zeros((sample.shape[1] + 1, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], norm, 1, 1)
    held, rows = np.split(sample, [min(HELD_OUT, len(sample) // 5)])
    near = nearest_in(rows, rows, DEGREE, own=True)
    part = balanced_parts(Graph(near), n_parts, rng)
    own = np.eye(n_parts)[part]
    around = own[near].mean(axis=1)
    weights = train(np.concatenate([row_features(rows, norm), query_features(rows)]), np.concatenate([own, 0.5 * (around + own)]), rng)
    router = Router(weights, norm, n_parts, n_parts)
    found = router.parts(rows)[nearest_in(held, rows, min(k, len(rows)), own=False)]
    ranked = router.ranked(held)
    place = np.zeros_like(ranked)
    np.put_along_axis(place, ranked, np.arange(n_parts)[None, :], axis=1)
    needed = np.take_along_axis(place, found, axis=1)  # the probe that meets each neighbour
    reached = (needed[:, :, None] <= np.arange(n_parts)).mean(axis=(0, 1))
    router.probes = int(np.argmax(reached >= RECALL)) + 1
    return router


def usable_vectors(rows: DataFrame, id_column: str, vector_column: str, is_query: Column) -> DataFrame:
    """`(row, vec_id, x, is_query)`: vectors with an id, the table's usual length, finite components and one that is not zero. Stored."""
    x = F.col("x")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    plain = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("x"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    plain = materialize(plain.filter(F.col("vec_id").isNotNull() & fine).withColumn("row", F.monotonically_increasing_id()), "vectors")
    usual = plain.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return plain.filter(F.size("x") == (usual["n"] if usual else 0))


def top_of_block(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """`(query, query_id, vec_id, row, score)`: the `k` nearest rows of a block for each of its queries."""
    x, ids, numbers = np.stack(rows["x"]), rows["vec_id"].to_numpy(), rows["row"].to_numpy()
    order = np.lexsort((numbers, ids))
    x, ids, numbers = x[order], ids[order], numbers[order]
    # Of equal vectors only the first ones by id can be among the k nearest, and one of them may be the query's own.
    _, same = np.unique(x, axis=0, return_inverse=True)
    by = np.argsort(same, kind="stable")
    starts = np.flatnonzero(np.diff(same[by], prepend=-1))
    place = np.arange(len(by)) - np.repeat(starts, np.diff(np.append(starts, len(by))))
    keep = np.sort(by[place <= k])
    x, ids, numbers = x[keep], ids[keep], numbers[keep]
    place_of = pd.Series(np.arange(len(numbers)), index=numbers)
    most = np.linalg.norm(x, axis=1).max()
    found = []
    for at in range(0, len(queries), AT_ONCE):
        part = queries.iloc[at : at + AT_ONCE]
        q, who = np.stack(part["x"]), part["row"].to_numpy()
        score = q @ x.T
        own = place_of.reindex(who).to_numpy()
        score[np.flatnonzero(~np.isnan(own)), own[~np.isnan(own)].astype(np.int64)] = -np.inf
        least = -np.partition(-score, min(k, score.shape[1]) - 1, axis=1)[:, min(k, score.shape[1]) - 1]
        margin = SLACK * np.linalg.norm(q, axis=1) * most
        i, j = np.nonzero((score >= (least - margin)[:, None]) & (score > -np.inf))
        exact = (q[i] * x[j]).sum(axis=1)  # the same sum for equal vectors, whatever block they are in
        first = np.lexsort((numbers[j], ids[j], -exact, i))
        i, j, exact = i[first], j[first], exact[first]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        i, j, exact = i[rank < k], j[rank < k], exact[rank < k]
        found.append(pd.DataFrame({"query": who[i], "query_id": part["vec_id"].to_numpy()[i], "vec_id": ids[j], "row": numbers[j], "score": exact}))
    return pd.concat(found, ignore_index=True)


def _part_of(router: Router, index: DataFrame) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column(2).flatten()).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(router.parts(x), pa.int32())], [*names, "part"])

    names = ["row", "vec_id", "x", "is_query"]
    return index.select(names).mapInArrow(assign, "row long, vec_id long, x array<double>, is_query boolean, part int")


def _probes_of(router: Router, queries: DataFrame, sizes: np.ndarray, k: int) -> DataFrame:
    """Queries with the parts they go to: the router's number, and more until these hold enough rows."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column(2).flatten()).reshape(batch.num_rows, -1)
                ranked = router.ranked(x)
                enough = (np.cumsum(sizes[ranked], axis=1) <= k).sum(axis=1) + 1  # the own row is one of them
                parts = [r[: max(router.probes, n)] for r, n in zip(ranked, enough.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, pa.list_(pa.int32()))], ["row", "vec_id", "x", "parts"])

    found = queries.select("row", "vec_id", "x").mapInArrow(choose, "row long, vec_id long, x array<double>, parts array<int>")
    return found.withColumn("part", F.explode("parts")).drop("parts")


def _number(counts: list[int], part: str = "part") -> Column:
    """The number in `counts` (at most `MOST_PARTS` of them) for a row's part."""
    return F.element_at(F.array(*[F.lit(c) for c in counts]), F.col(part) + 1)


def nearest(rows: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding", router: Router | None = None) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: the `k` nearest rows found for each row with `is_query`, by largest inner product.

    Rank 1 is the nearest, ties go to the smaller id. A query's own row is no candidate. With fewer than `k` candidates all are
    returned. Vectors that are null, zero, of another length than most or hold a null or non-finite component take no part, nor do rows without id.
    Rows that repeat an id or a vector are rows like others; an empty table gives no row. Other columns are not read.
    """
    spark = rows.sparkSession
    index = usable_vectors(rows, id_column, vector_column, is_query)
    squared = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    n_rows, norm = index.agg(F.count("*"), F.sqrt(F.max(squared))).first()
    if not n_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if router is None:
        few = F.pmod(F.xxhash64("vec_id", "x"), F.lit(1 << 20)) < min(1 << 20, (2 * FIT_ROWS << 20) // n_rows + 64)
        sample = index.filter(few).orderBy(F.xxhash64("vec_id", "x"), "row").limit(FIT_ROWS).select("x").toArrow().column("x").combine_chunks()
        router = fit(np.asarray(sample.flatten()).reshape(len(sample), -1), norm, n_rows, k)
    index = materialize(_part_of(router, index), "index")
    sizes = np.zeros(router.n_parts, np.int64)
    for part, n in index.groupBy("part").count().collect():  # at most MOST_PARTS rows
        sizes[part] = n
    sent = materialize(_probes_of(router, index.filter("is_query"), sizes, k), "queries")
    asked = np.zeros(router.n_parts, np.int64)
    for part, n in sent.groupBy("part").count().collect():
        asked[part] = n
    row_blocks = [max(1, -(-int(n) // ROW_BLOCK)) for n in sizes]
    query_blocks = [max(1, -(-int(n) // QUERY_BLOCK)) for n in asked]
    own = lambda counts: F.pmod(F.xxhash64("row"), _number(counts).cast("long")).cast("int")
    every = lambda counts: F.explode(F.sequence(F.lit(0), _number(counts) - 1))
    left = index.select("row", "vec_id", "x", "part", own(row_blocks).alias("row_block")).withColumn("query_block", every(query_blocks))
    right = sent.select("row", "vec_id", "x", "part", own(query_blocks).alias("query_block")).withColumn("row_block", every(row_blocks))
    keys = ["part", "row_block", "query_block"]
    schema = "query long, query_id long, vec_id long, row long, score double"

    def search(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(queries):
            return pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})
        return top_of_block(block, queries, k)

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
