"""Dense global numbering without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.runtime import materialize

_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition above, row below


def global_index(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """Add `name` = start, start+1, … in the order of `order`.

    A range-partitioned sort gives every task its slice of the order; a row's number is
    its place in the slice plus the sizes of the slices before it. The sorted table is
    written first, because slice bounds may differ if a lost task is run again.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_index_slice", F.spark_partition_id())
        .withColumn("_index_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    )
    placed = materialize(placed, "index")
    # One row per slice, so this window is as small as the number of partitions.
    before = Window.orderBy("_index_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_index_slice")
        .agg(F.count("*").alias("_index_rows"))
        .select("_index_slice", F.coalesce(F.sum("_index_rows").over(before), F.lit(0)).alias("_index_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_index_slice")
        .withColumn(name, F.col("_index_offset") + F.col("_index_row") + start)
        .drop("_index_slice", "_index_row", "_index_offset")
    )
