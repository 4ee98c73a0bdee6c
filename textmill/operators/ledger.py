"""Exact dedupe of a new batch against all earlier ones.

A ledger holds one row `(key, ord, batch)` per key ever accepted, stored in buckets of the
key. A batch's keys are brought to the same buckets and joined there, so only the batch is
shuffled, never the ledger.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.clean import ORD
from textmill.sources.records import skip_if_missing

_ROW = "key string, ord bigint, batch bigint"


class KeyLedger:
    """Keys and the rows that brought them, under a folder every executor can reach.

    `buckets` counts when the ledger is made and stays with it; choose it so that a bucket of the final
    ledger fits a task. One batch is admitted at a time: two writers at once may accept the same key.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark = spark
        self.buckets = self._stored_buckets(path, buckets)
        self._table = f"textmill_ledger_{hashlib.md5(path.encode()).hexdigest()}"
        # The catalog entry only describes the files; another session makes it again.
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._table} ({_ROW}) USING parquet "
            f"CLUSTERED BY (key) INTO {self.buckets} BUCKETS LOCATION '{path}/keys'"
        )

    def _stored_buckets(self, path: str, buckets: int) -> int:
        """The number the files were written with; another would miss keys."""
        if buckets < 1:
            raise ValueError(f"buckets must be positive: {buckets}")
        settings = f"{path}/settings"
        found = skip_if_missing(lambda: self.spark.read.schema("buckets int").json(settings))
        if found is None:
            found = self.spark.createDataFrame([(buckets,)], "buckets int")
            found.coalesce(1).write.json(settings)
        return found.first()["buckets"]

    def rows(self) -> DataFrame:
        return self.spark.read.table(self._table)

    def unseen(self, keyed: DataFrame) -> DataFrame:
        """`(key, ord)` with the lowest `ord` of every key of `keyed` that the ledger lacks."""
        # The explicit number of partitions is the ledger's, so neither side moves for the join.
        first = keyed.repartition(self.buckets, "key").groupBy("key").agg(F.min(ORD).alias(ORD))
        return first.join(self.rows().select("key"), "key", "left_anti")

    def admit(self, df: DataFrame, key: Column, batch: int) -> DataFrame:
        """The rows of `df` that are the first with their key, in this batch and all earlier ones.

        `df` has a column `ord`, unique in the batch; null keys equal each other. The rows come from what the
        ledger notes for `batch`: a batch that is given again, whole or after a crash halfway,
        adds no key twice and returns the same rows. An empty batch returns none.
        """
        keyed = df.select(F.coalesce(F.sha2(key.cast("string"), 256), F.lit("")).alias("key"), ORD)
        self.unseen(keyed).select("key", ORD, F.lit(batch).cast("bigint").alias("batch")).write.insertInto(self._table)
        mine = self.rows().filter(F.col("batch") == batch).select(ORD)
        return df.join(mine, ORD, "left_semi").select(*df.columns)
