"""Exact similarity join of sets by prefix filter (Xiao et al., 2008), between components of sets that are known to be linked.

The elements of all sets are in one order, rare ones first. Two sets that reach a Jaccard similarity share
one of their first elements, the fewer the nearer it is to 1; what comes after the first shared one bounds their overlap, and so
do the parities of their elements by hash (the bitmap filter of Sandes et al., 2017): sets whose bitmaps differ in d bits
differ in d elements at least. No pair at the threshold is left out, whatever the order is; a better order leaves fewer pairs.

The order comes from the document frequencies of all sets: a task counts the elements of about `COUNTED` set members at a time and
hands on those that occur there more than once, and the `RANKED` most frequent ones are the order table. All others are
rare and are ordered by their hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.runtime import materialize

#: Slack for thresholds that are not exact in binary; it only lets more pairs through.
SLACK = 1e-6
#: Set members that are counted at a time, and the most elements of the order table.
COUNTED, RANKED = 1 << 21, 1 << 19
#: Words of 64 bits in a bitmap.
WORDS = 4
#: Rows of one element beyond which it is joined by classes of set size.
HOT_ROWS = 10_000
BITS = [f"bits{i}" for i in range(WORDS)]
_ODD = np.uint64(0x9E3779B97F4A7C15)


def frequent_members(sets: Iterator[np.ndarray | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Elements (64-bit) that several of the sets hold, with their numbers of sets, for every `COUNTED` members; None marks the end."""
    held, size = [], 0
    for members in sets:
        if members is not None:
            held.append(members)
            size += len(members)
        if held and (members is None or size >= COUNTED):
            x, n = np.unique(np.concatenate(held), return_counts=True)
            yield x[n > 1], n[n > 1]
            held, size = [], 0


def order_table(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent elements of `(x, n)`, sorted as unsigned numbers, and their frequencies; `RANKED` at most."""
    counts = materialize(counts.groupBy("x").agg(F.sum("n").alias("n")), "frequencies")
    level = F.floor(F.log2(F.col("n").cast("double")) * 16)
    cut, held = 1 << 20, 0
    for step, n in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # a thousand at most
        held += n
        if held > RANKED:
            break
        cut = step
    table = counts.filter(level >= cut).toArrow()
    x, n = table.column("x").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(x)
    return x[order], n[order]


def first_members(members: np.ndarray, order: tuple[np.ndarray, np.ndarray], threshold: float) -> np.ndarray:
    """The members of a set, rare ones first, of which it shares one with every set that reaches the threshold."""
    known, frequency = order
    rank = np.zeros(len(members), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, members), len(known) - 1)
        rank = np.where(known[at] == members, frequency[at], 0)
    least = int(np.ceil(threshold * len(members) - SLACK))
    return members[np.lexsort((members, rank))[: len(members) - least + 1]]


def parities(members: np.ndarray) -> np.ndarray:
    """`WORDS` numbers whose bits tell whether an odd number of members hash to them."""
    place = (members * _ODD) >> np.uint64(64 - (WORDS * 64 - 1).bit_length())
    odd = np.bincount(place.astype(np.int64), minlength=WORDS * 64) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_columns(sets: list[np.ndarray], order: tuple[np.ndarray, np.ndarray], threshold: float) -> list[pa.Array]:
    """Arrow columns `size`, `xs` and the bitmap words of sets."""
    lists = [first_members(s, order, threshold).view(np.int64) for s in sets]
    bits = np.array([parities(s) for s in sets], np.int64).reshape(-1, WORDS)
    return [pa.array(map(len, sets), pa.int64()), pa.array(lists, pa.list_(pa.int64())), *(pa.array(bits[:, i]) for i in range(WORDS))]


SET_COLUMNS = ["size", "xs", *BITS]
SET_SCHEMA = "size long, xs array<long>, " + ", ".join(f"{b} long" for b in BITS)


def _needed(s: str, t: str, threshold: float) -> Column:
    """The least overlap of linked sets of sizes `s` and `t`."""
    return threshold / (1 + threshold) * (F.col(s) + F.col(t)) - SLACK


def open_pairs(lists: DataFrame, threshold: float) -> DataFrame:
    """`(a, b)`, a < b, of the `lists` `(rep, component, size, xs, bits…)` with different components that may reach the threshold.

    An element that one component alone holds gives no pairs, so a group of linked sets costs its rows. Where
    several meet, the rows outside the largest are held against the others, by size classes if they are many. The rest of the
    lists then bounds the overlap once more: wherever the shorter prefix ends, all that both have before it was seen.
    """
    placed = lists.select("component", "rep", "size", F.posexplode("xs").alias("place", "x"))
    held = placed.groupBy("x").agg(F.min("component").alias("low"), F.max("component").alias("high"), (F.count("*") > HOT_ROWS).alias("hot"))
    # Bitmaps join the rows that are left; with all rows they would be most of what is shuffled.
    rows = placed.join(held.filter("low < high").select("x", "hot"), "x").join(lists.select("rep", *BITS).hint("merge"), "rep")
    rows = materialize(rows, "shared")
    largest = rows.groupBy("x", "component").count().groupBy("x").agg(F.max(F.struct("count", "component"))["component"].alias("largest"))
    # Sizes of linked sets differ by a factor of 1 / threshold at most, so their classes by one.
    size_class = F.floor(F.log(F.col("size").cast("double")) / -np.log(min(threshold, 0.99))).cast("int")
    near = lambda *steps: F.array(*[size_class + s for s in steps])
    none = F.array(F.lit(-9))
    left = rows.join(largest, "x").filter("component <> largest")
    left = left.withColumn("part", F.when(F.col("hot"), size_class).otherwise(-9))
    left = left.select("x", "part", "largest", F.col("rep").alias("a_"), F.col("component").alias("in_a"), F.col("size").alias("s"), F.col("place").alias("i"), *BITS)
    right = rows.withColumn("part", F.explode(F.when(F.col("hot"), near(-1, 0, 1)).otherwise(none)))
    right = right.select(F.col("x").alias("x_"), F.col("part").alias("part_"), F.col("rep").alias("c_"), F.col("component").alias("in_c"), F.col("size").alias("t"), F.col("place").alias("j"), *[F.col(b).alias(f"{b}_") for b in BITS])
    once = (F.col("in_c") == F.col("largest")) | (F.col("a_") < F.col("c_"))
    met = left.hint("merge").join(right, (F.col("x") == F.col("x_")) & (F.col("part") == F.col("part_")) & (F.col("in_a") != F.col("in_c")) & once & _fits(threshold))
    return _bounded(met.select(F.least("a_", "c_").alias("a"), F.greatest("a_", "c_").alias("b")).distinct(), lists, threshold)


def _fits(threshold: float) -> Column:
    """Whether sets of sizes `s`, `t` that meet at places `i`, `j` of their lists may be linked, by what comes after and by their bitmaps."""
    after = F.least(F.col("s") - F.col("i"), F.col("t") - F.col("j"))
    differ = sum((F.bit_count(F.col(b).bitwiseXOR(F.col(f"{b}_"))) for b in BITS), F.lit(0))
    return (after >= _needed("s", "t", threshold)) & (F.col("s") + F.col("t") - differ >= 2 * _needed("s", "t", threshold))


def _bounded(pairs: DataFrame, lists: DataFrame, threshold: float) -> DataFrame:
    """The `pairs` whose lists leave room for enough overlap."""
    pairs = materialize(pairs, "met")
    side = lambda name: lists.select(F.col("rep").alias(name), F.col("size").alias(f"size_{name}"), F.col("xs").alias(f"xs_{name}"))
    both = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
    rest = F.greatest(F.col("size_a") - F.size("xs_a"), F.col("size_b") - F.size("xs_b"))
    most = F.size(F.array_intersect("xs_a", "xs_b")) + rest
    return both.filter(most >= _needed("size_a", "size_b", threshold)).select("a", "b")


def member_counts(sets: DataFrame) -> DataFrame:
    """`(x, n)`: parts of the frequencies of the elements of `sets` `(members array<long>)`, for `order_table`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists() -> Iterator[np.ndarray | None]:
            for batch in batches:
                for members in batch.column(0):
                    yield np.asarray(members.values, np.int64)
            yield None

        for x, n in frequent_members(lists()):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(n, pa.int64())], ["x", "n"])

    return sets.select("members").mapInArrow(count, "x long, n long")


def with_first_members(sets: DataFrame, order: tuple[np.ndarray, np.ndarray], threshold: float) -> DataFrame:
    """`(rep, size, xs, bits…)` of sets `(rep, members)` without repeated members."""
    shared = sets.sparkSession.sparkContext.broadcast(order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = [np.sort(np.asarray(m.values, np.int64).view(np.uint64)) for m in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *set_columns(members, shared.value, threshold)], ["rep", *SET_COLUMNS])

    return sets.select("rep", "members").mapInArrow(cut, "rep long, " + SET_SCHEMA)


def leader_pairs(lists: DataFrame, threshold: float) -> DataFrame:
    """`(a, b)`: each list with the lowest one that has one of its first elements, if they may be linked; a pair for each such element at most."""
    rows = materialize(lists.select("rep", "size", *BITS, F.posexplode("xs").alias("place", "x")), "first-members")
    lowest = rows.groupBy("x").agg(F.min(F.struct("rep", "size", "place", *BITS)).alias("l"), F.count("*").alias("n")).filter("n > 1")
    lowest = lowest.select("x", F.col("l.rep").alias("a"), F.col("l.size").alias("t"), F.col("l.place").alias("j"), *[F.col(f"l.{b}").alias(f"{b}_") for b in BITS])
    met = rows.withColumnsRenamed({"size": "s", "place": "i"}).join(lowest, "x").filter("a < rep").filter(_fits(threshold))
    return _bounded(met.select("a", F.col("rep").alias("b")).distinct(), lists, threshold)
