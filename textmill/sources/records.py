"""Record files and Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from textmill.operators.indexing import global_index
from textmill.spec import TaskSpec

CORRUPT = "_corrupt_record"

TEXT_RECORD = StructType(
    [StructField("text", StringType()), StructField("label", StringType())]
)
TAGGED_RECORD = StructType(
    [
        StructField("tokens", ArrayType(StringType())),
        StructField("tags", ArrayType(StringType())),
    ]
)


def record_schema(task: TaskSpec) -> StructType:
    return TAGGED_RECORD if task.is_tagging else TEXT_RECORD


def read_records(
    spark: SparkSession,
    path: str,
    task: TaskSpec,
    strict: bool = False,
    has_ord: bool = True,
) -> DataFrame:
    """JSON Lines as `(ord, task, …record)`.

    Without a stored ordinal, lines are numbered by file name and place in the file, so
    that "keep first" follows the files. `strict` fails on a malformed line; by default
    such lines stay in `_corrupt_record` for `split_rejects`.

    Lines are parsed by `from_json` with all fields: the JSON reader only parses the
    columns a query asks for and would let a line pass whose other fields are wrong.
    """
    fields = record_schema(task).fields
    if has_ord:
        fields = [StructField("ord", LongType()), *fields]
    options = {"mode": "FAILFAST"}
    if not strict:
        fields = [*fields, StructField(CORRUPT, StringType())]
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = spark.read.text(path).filter(F.trim("value") != "")
    record = F.from_json("value", StructType(fields), options).alias("_r")
    if has_ord:
        df = lines.select(record).select("_r.*")
    else:
        place = ["_file", "_block", "_line"]
        placed = lines.select(
            record,
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
        )
        df = global_index(placed.select("_r.*", *place), place, "ord").drop(*place)
    return df.withColumn("task", F.lit(task.name))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, rejected lines) of a permissive read."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.filter(F.col(CORRUPT).isNotNull()).select("task", "ord", CORRUPT)


def skip_if_missing(load: Callable[[], DataFrame]) -> DataFrame | None:
    """The loaded table, or None where its path does not exist."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_table(
    spark: SparkSession, directory: str, name: str, spread_by: str | None = None
) -> DataFrame:
    """A Parquet table.

    With `spread_by`, a table that comes in fewer splits than there are cores is
    hash-partitioned by that column, so that text work does not run in one task. Tables
    with enough splits, as any large one, are read as they are.
    """
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if spread_by and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, spread_by)
    return df


def write_records(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("task", "split"), compression: str | None = None) -> None:
    """JSON Lines, replaced as a whole and partitioned by task and split.

    Tagged records are gzip files unless another `compression` is asked for: characters and their tags as JSON are several times their text. Others are plain.
    """
    chosen = compression or ("gzip" if "tokens" in df.columns else "none")
    df.write.mode("overwrite").option("compression", chosen).partitionBy(*partition_by).json(path)


def append_records(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
