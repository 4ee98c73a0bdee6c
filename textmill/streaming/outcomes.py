"""Payload ingest that also stores what became of each response and what was rejected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textmill.functions import payload as pf
from textmill.operators.ingest import accepted_records, batch_outcomes, explode_payload
from textmill.runtime import materialize
from textmill.streaming.ingest import PAYLOAD_FILE

SINKS = ("records", "outcomes", "rejects")


def rejected(df: DataFrame, expected: tuple[str, ...]) -> DataFrame:
    """`(…, pos, raw, reason)`: items without the expected keys, and whole payloads that are no list.

    A missing payload is `unparsable`; an empty list rejects nothing.
    """
    others = [c for c in df.columns if c != "payload"]
    items = explode_payload(df).filter(~pf.has_keys(F.col("item"), expected))
    by_item = items.select(*others, F.col("pos").cast("bigint"), F.col("item").alias("raw"), F.lit("missing_keys").alias("reason"))
    payload = F.col("payload")
    reason = F.when(~pf.is_parsable(payload), "unparsable").when(pf.payload_items(payload).isNull(), "not_a_list")
    whole = df.select(*others, F.lit(None).cast("bigint").alias("pos"), payload.alias("raw"), reason.alias("reason"))
    return by_item.unionByName(whole.filter(F.col("reason").isNotNull()))


def _write(df: DataFrame, root: str, sink: str, epoch: int) -> None:
    # An epoch replaces itself, so a repeated one adds nothing.
    df.write.mode("overwrite").parquet(f"{root}/{sink}/epoch={epoch}")


def ingest_outcomes_stream(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    expected: tuple[str, ...],
    schema: StructType,
    files_per_epoch: int = 1000,
) -> None:
    """Take in all new payload files and write `records`, `outcomes` and `rejects` below `root`.

    Each micro-batch is read from the source once and stored; the three sinks come from that
    copy, each in a folder of its epoch. A run that ends between two sinks is repeated from the
    checkpoint's file list for that epoch, and every sink overwrites what the first try left.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        stored = materialize(batch, "epoch")
        _write(accepted_records(stored, expected, schema), root, "records", epoch)
        _write(batch_outcomes(stored, expected), root, "outcomes", epoch)
        _write(rejected(stored, expected), root, "rejects", epoch)

    payloads = spark.readStream.schema(PAYLOAD_FILE).option("maxFilesPerTrigger", files_per_epoch).json(source)
    query = (
        payloads.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
