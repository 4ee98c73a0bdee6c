"""Mixing sources to target weights by Pareto order sampling.

A source's target in words is a number of whole copies of all its documents, which are
certain, and a remainder below one copy. For the remainder each document gets an inclusion
probability in proportion to its size, certain where this reaches 1, and documents are taken
in the order of their random odds divided by their inclusion odds until the remainder is
filled. The sample has a fixed size, in words, up to one document.

The place where a source's order is cut is found without sorting the source: words are
summed by 4,096 intervals of the logarithm of the rank, then by 4,096 intervals of the one
that holds the cut, and only what remains is ordered, a few millionths of the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import random_unit, text_or_empty, words_of
from textmill.operators.indexing import global_index
from textmill.runtime import materialize

SHARE = 1.5
WEIGHTS = (3, 1, 2)
MOST_COPIES = 2
#: Intervals of a level, and the range of log ranks that they divide.
CELLS = 4096
LOG_RANGE = 64.0


def source_targets(sources: DataFrame, share: float, weights: Sequence[int], most: int) -> DataFrame:
    """Add `source_no` and `target` to `(source, source_size)`.

    Sources are numbered by code point, null last, and weighted by their number. Targets
    above `most` times the size are cut there and the excess is shared out by weight again.
    """
    ordered = global_index(sources.withColumn("_llm_null", F.col("source").isNull()), ["_llm_null", "source"], "source_no")
    table = F.array(*[F.lit(int(w)) for w in weights])
    weight = F.element_at(table, (F.col("source_no") % len(weights) + 1).cast("int"))
    ordered = materialize(ordered.drop("_llm_null").withColumn("_llm_weight", weight), "sources")
    cap = F.col("source_size") * most
    total = ordered.agg(F.sum("source_size")).first()[0] or 0
    wanted, level, before = share * total, 0.0, -1
    while True:
        above = F.lit(level) * F.col("_llm_weight") > cap
        if before < 0:
            above = F.lit(False)
        n, capped, free = ordered.agg(
            F.sum(above.cast("long")), F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("_llm_weight")))
        ).first()
        if n is None or n == before or not free:
            break
        before, level = n, (wanted - capped) / free
    target = F.lit(level) * F.col("_llm_weight")
    return ordered.withColumn("target", F.when(target > cap, cap.cast("double")).otherwise(target)).drop("_llm_weight")


def _cell(log_rank: Column, depth: int) -> Column:
    """Number of the interval of a level; log ranks outside the range fall into its end intervals."""
    width = 2 * LOG_RANGE / CELLS ** (depth + 1)
    inside = F.least(F.greatest(log_rank, F.lit(-LOG_RANGE)), F.lit(LOG_RANGE)) + LOG_RANGE
    return F.floor(inside / width)


def _cuts(ranked: DataFrame, left: DataFrame) -> DataFrame:
    """`(source_no, _llm_cut_rank, _llm_cut_id)`: the last document taken of each source that is cut.

    `left` has the words `_llm_left` to fill. A source without a row is taken as a whole.
    """
    for depth in range(2):
        cell = f"_llm_cell{depth}"
        here = ranked.join(left, [c for c in left.columns if c != "_llm_left"])
        sums = here.groupBy(*left.columns, cell).agg(F.sum("size").alias("_llm_words"))
        # At most 4,096 rows of a source, or two intervals' rounding more.
        order = Window.partitionBy("source_no").orderBy(cell)
        upto = F.sum("_llm_words").over(order)
        left = (
            sums.withColumn("_llm_upto", upto)
            .filter(F.col("_llm_upto") > F.col("_llm_left"))
            .withColumn("_llm_first", F.min(cell).over(Window.partitionBy("source_no")))
            .filter(F.col(cell) == F.col("_llm_first"))
            .withColumn("_llm_left", F.col("_llm_left") - F.col("_llm_upto") + F.col("_llm_words"))
            .drop("_llm_words", "_llm_upto", "_llm_first")
        )
        left = materialize(left, "cuts")
    here = ranked.join(left, [c for c in left.columns if c != "_llm_left"])
    # Rows that repeat a doc_id are peers and are taken or left together.
    peers = here.groupBy("source_no", "_llm_left", "_llm_rank", "doc_id").agg(F.sum("size").alias("_llm_words"))
    order = Window.partitionBy("source_no").orderBy("_llm_rank", F.col("doc_id").asc_nulls_first())
    summed = peers.withColumn("_llm_upto", F.sum("_llm_words").over(order))
    over = F.col("_llm_upto") - F.col("_llm_left")
    # The one that passes the mark is taken if that comes nearer to it than stopping short.
    taken = summed.filter((over <= 0) | ((over < F.col("_llm_words")) & (2 * over < F.col("_llm_words"))))
    last = taken.groupBy("source_no").agg(F.max(F.struct("_llm_rank", "doc_id")).alias("_llm_cut"))
    return (
        left.join(last, "source_no", "left")
        .select(
            "source_no",
            F.col("_llm_cut._llm_rank").alias("_llm_cut_rank"),
            F.col("_llm_cut.doc_id").alias("_llm_cut_id"),
            F.col("_llm_cell0").alias("_llm_cut0"),
            F.col("_llm_cell1").alias("_llm_cut1"),
        )
    )


def mix_sources(
    docs: DataFrame,
    share: float = SHARE,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = "mix",
) -> DataFrame:
    """`(doc_id, source, size, source_size, target, copies, taken)`, one row per row of `docs`.

    `size` counts words, 0 for a null text. A null source is a source, the last one. `copies`
    is how often the mix takes the document, 0 to `most`, and `taken` the words of these copies.
    Random numbers depend on doc_id, source and `seed` alone, so reruns agree; rows that repeat
    a doc_id in a source are taken alike. Documents without words are never sampled, only
    copied whole. Only doc_id, text and source are read; an empty table gives an empty result.
    """
    sized = docs.select("doc_id", "source", F.size(words_of(text_or_empty())).cast("long").alias("size"))
    sized = materialize(sized, "sizes")
    square = F.col("size").cast("double") * F.col("size")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(square).alias("_llm_squares"))
    sources = source_targets(sources, share, weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = sources.withColumn("_llm_whole", whole)
    sources = materialize(sources.withColumn("_llm_left", F.col("target") - F.col("_llm_whole") * F.col("source_size")), "targets")

    joined = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    chance = F.when(
        (F.col("size") > 0) & (F.col("_llm_left") > 0), F.least(F.lit(1.0), F.col("_llm_left") * F.col("size") / F.col("_llm_squares"))
    )
    joined = joined.withColumn("_llm_chance", chance).withColumn("_llm_unit", random_unit(seed, F.col("source"), F.col("doc_id")))
    odds = (F.col("_llm_unit") / (1 - F.col("_llm_unit"))) / (F.col("_llm_chance") / (1 - F.col("_llm_chance")))
    joined = joined.withColumn("_llm_rank", F.when(F.col("_llm_chance") >= 1, 0.0).otherwise(odds))
    log_rank = F.when(F.col("_llm_rank") > 0, F.log("_llm_rank")).otherwise(-LOG_RANGE)
    for depth in range(2):
        joined = joined.withColumn(f"_llm_cell{depth}", F.when(F.col("_llm_rank").isNotNull(), _cell(log_rank, depth)))
    ranked = materialize(joined.drop("_llm_unit", "_llm_chance", "_llm_squares", "_llm_left"), "ranks")

    drawn = ranked.filter(F.col("_llm_rank").isNotNull())
    cuts = _cuts(drawn, sources.filter(F.col("_llm_left") > 0).select("source_no", "_llm_left"))
    before = F.col("_llm_cell1") < F.col("_llm_cut1")
    same = F.col("_llm_cell1") == F.col("_llm_cut1")
    least_id = F.lit(-(2**63)).cast("long")
    upto = F.struct(F.col("_llm_rank").alias("r"), F.coalesce("doc_id", least_id).alias("i")) <= F.struct(
        F.col("_llm_cut_rank").alias("r"), F.coalesce("_llm_cut_id", least_id).alias("i")
    )
    inside = F.col("_llm_cut_rank").isNotNull() & upto
    extra = F.col("_llm_rank").isNotNull() & (F.col("_llm_cut1").isNull() | before | (same & inside))
    return (
        ranked.join(cuts, "source_no", "left")
        .withColumn("copies", F.col("_llm_whole") + F.coalesce(extra, F.lit(False)).cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def take_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that the mix takes, a row taken twice coming twice."""
    mixed = mix_sources(docs, **options).select(
        F.col("doc_id").alias("_llm_id"), F.col("source").alias("_llm_source"), F.col("copies").alias("_llm_copies")
    )
    # One row per document, also where rows repeat a doc_id; the largest number holds for all of them.
    chosen = mixed.filter("_llm_copies > 0").groupBy("_llm_id", "_llm_source").agg(F.max("_llm_copies").alias("_llm_copies"))
    same = docs["doc_id"].eqNullSafe(chosen["_llm_id"]) & docs["source"].eqNullSafe(chosen["_llm_source"])
    columns = [docs[c] for c in docs.columns]
    repeated = docs.join(chosen, same).select(*columns, F.explode(F.sequence(F.lit(1), F.col("_llm_copies"))).alias("_llm_copy"))
    return repeated.drop("_llm_copy")
