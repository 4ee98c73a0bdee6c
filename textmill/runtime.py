"""Session settings, shared storage and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings that hold at any scale; sizes of a given cluster stay with the cluster.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Removes the shuffle files of a query when it ends.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Bytes after which a batch of rows goes to a Python worker. By its rows alone (10,000) a batch grows with the texts, in the
#: executor's native memory as in the worker's.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BATCH_BYTES = 4 << 20

_local_dirs: dict[str, str] = {}


def local_session(cores: int | str = 8, memory: str = "16g", **conf: str) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("textmill")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`.

    Only a local master may go without the setting; it then gets one temporary
    folder per application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if configured:
        return f"{configured.rstrip('/')}/textmill/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="run-textmill-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def bound_batches(spark: SparkSession) -> None:
    """Bound the batches of this session by their bytes, unless it has a bound of its own. The bound stays, for plans that run after the call."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(MOST_BATCH_BYTES))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Used where a table is read more than once or its lineage must be cut: the copy
    survives lost executors, keeps column pruning and gives the planner real sizes. The shuffle
    files behind it are removed with the end of the write, not whenever the driver collects garbage.
    Batches for Python workers are bounded by bytes from here on, see `bound_batches`.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = new_path(spark, label)
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def holding(rows: DataFrame, ends: DataFrame, key: str) -> DataFrame:
    """The `rows` whose `key` (bigint) is among the distinct ones of `ends`. A bitmap of their hashes, 2 MB at any size, keeps most of the others out of the shuffle."""
    place = F.pmod(F.xxhash64(key), F.lit(1 << 24))
    spot, bit = F.floor(place / 32768), (place % 32768).cast("int")
    maps = ends.groupBy(spot.alias("_spot")).agg(F.bitmap_construct_agg(bit).alias("_map"))
    marked = rows.withColumns({"_spot": spot, "_bit": bit}).join(F.broadcast(maps), "_spot")
    byte = F.conv(F.hex(F.expr("substring(_map, _bit div 8 + 1, 1)")), 16, 10).cast("int")
    return marked.filter(F.getbit(byte, F.col("_bit") % 8) == 1).select(rows.columns).join(ends.hint("merge"), key, "left_semi")


def partition_by_row(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition by the unique `key` ahead of heavy work inside each row.

    The number of partitions is the cluster's shuffle setting. AQE would size them by
    their bytes and put a small but expensive text table into one task.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(n, spark.sparkContext.defaultParallelism), key)
