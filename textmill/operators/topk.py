"""The exact k most frequent terms without a shuffle of the whole vocabulary.

Every task sums up its rows in a summary of at most `capacity` counters. Where terms exceed
them, the largest count beyond the capacity is taken from every counter, so a counter is
too low by at most the sum of these cuts, the summary's error. Summaries add up: counts by term,
errors over all tasks. Let `floor` be the k-th largest summed counter and `error` the summed
error. A term of the top k has `counter + error >= floor`, and if `error < floor` every such
term is in some summary. Only these candidates are then counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.runtime import materialize

#: Counters of a summary for each term asked for, and for each where a first try proves nothing.
COUNTERS_PER_TERM = (8, 64)
#: Candidates up to this many are broadcast, others joined by shuffle.
MAX_BROADCAST_TERMS = 1 << 18

_SUMMARY = "term string, tf bigint, df bigint, error bigint"
_FIELDS = pa.schema([("term", pa.string()), ("tf", pa.int64()), ("df", pa.int64())])


@dataclass(frozen=True)
class Candidates:
    """Terms that may be among the k most frequent.

    `error` bounds what the counters miss; at 0 `terms` already holds the exact counts.
    `proven` tells that no other term can enter; otherwise `terms` must not be used.
    """

    terms: DataFrame
    error: int
    floor: int
    proven: bool


def _summed(held: pa.Table) -> pa.Table:
    return held.group_by("term").aggregate([("tf", "sum"), ("df", "sum")]).rename_columns(_FIELDS.names)


def _cut(held: pa.Table, capacity: int) -> tuple[pa.Table, int]:
    """At most `capacity` counters of distinct terms, and what was taken from each."""
    if held.num_rows <= capacity:
        return held, 0
    place = pc.select_k_unstable(held["tf"], capacity + 1, [("tf", "descending")])[capacity].as_py()
    taken = held["tf"][place].as_py()
    held = held.set_column(1, "tf", pc.subtract(held["tf"], taken))
    return held.filter(pc.greater(held["tf"], 0)), taken


def _summarize(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, error = _FIELDS.empty_table(), 0
        for batch in batches:
            held = pa.concat_tables([held, pa.Table.from_batches([batch]).cast(_FIELDS)])
            if held.num_rows >= 4 * capacity:
                held = _summed(held)
                if held.num_rows >= 2 * capacity:
                    held, taken = _cut(held, capacity)
                    error += taken
        held, taken = _cut(_summed(held), capacity)
        # One row without a term tells the summary's error.
        out = pa.concat_tables([held, pa.table([[None], [0], [0]], schema=_FIELDS)])
        errors = pa.array([0] * held.num_rows + [error + taken], pa.int64())
        yield from out.append_column("error", errors).combine_chunks().to_batches()

    return run


def summaries(counts: DataFrame, capacity: int) -> DataFrame:
    """`(term, tf, df, error)`: at most `capacity` counters per task and one row with its error.

    `counts` holds `(term, tf)` in any number of rows; `df` counts them, or sums up what `counts` has as `df`.
    """
    rows = counts.filter(F.col("term").isNotNull()).select("term", F.col("tf").cast("bigint"), _df(counts).alias("df"))
    return rows.mapInArrow(_summarize(capacity), _SUMMARY)


def _df(counts: DataFrame) -> Column:
    """Documents that a row stands for."""
    return (F.col("df") if "df" in counts.columns else F.lit(1)).cast("bigint")


def candidates(counts: DataFrame, k: int, capacity: int) -> Candidates:
    """One pass over `counts`; what is shuffled are at most `capacity` rows per task."""
    stored = materialize(summaries(counts, capacity), "summaries")
    merged = stored.filter("term is not null").groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    merged = materialize(merged, "counters")
    error = stored.agg(F.sum("error")).first()[0] or 0
    # k values at most; the largest k come from a heap per task.
    top = merged.select("tf").orderBy(F.desc("tf")).limit(k).agg(F.count("*"), F.min("tf")).first()
    floor = top[1] if top[0] == k else 0
    proven = error == 0 or error < floor
    return Candidates(merged.filter(F.col("tf") + error >= floor), error, floor, proven)


def top_k_exact(counts: DataFrame, k: int, capacity: int | None = None) -> DataFrame:
    """`(term, tf, df)` of the k terms with the largest sum of `tf`, ties in term order.

    `counts` holds one row `(term, tf)` per term and document, `tf` above 0, or sums `(term, tf, df)` of some documents
    each; it is computed up to twice per try. Rows without a term count for nothing, an empty table gives an empty one,
    fewer than k terms give all. Repeated rows add up. If no summary proves its candidates (flat
    counts), every term is grouped.
    """
    if k < 1:
        raise ValueError(f"k must be positive: {k}")
    sizes = [capacity] if capacity else [k * n for n in COUNTERS_PER_TERM]
    for size in sizes:
        found = candidates(counts, k, size)
        if found.error == 0:
            return _first(found.terms, k)
        if found.proven:
            return _first(_grouped(_only(counts, found.terms.select("term"))), k)
    return _first(_grouped(counts.filter(F.col("term").isNotNull())), k)


def _only(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """Rows of the candidates, filtered before anything is shuffled where they are few."""
    few = terms.count() <= MAX_BROADCAST_TERMS
    return counts.join(F.broadcast(terms) if few else terms, "term", "left_semi")


def _grouped(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.sum("tf").cast("bigint").alias("tf"), F.sum(_df(counts)).alias("df"))


def _first(stats: DataFrame, k: int) -> DataFrame:
    return stats.select("term", "tf", "df").orderBy(F.desc("tf"), "term").limit(k)
