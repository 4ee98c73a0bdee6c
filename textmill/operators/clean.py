"""Exact deduplication, cleaning and the counts of what each stage removes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from textmill.functions import tags as tag_fn
from textmill.functions.text import normalize_text
from textmill.spec import TaskSpec

ORD = "ord"
#: Tokens that are re-cut together (or one row). Their characters and tags are one batch, which the executor holds beside its heap.
TOKENS = 1 << 14


def first_rows(df: DataFrame, key: Column, by: Sequence[str] = ()) -> DataFrame:
    """`(*by, ord, copies)`: the lowest `ord` of every key and how many rows share the key.

    Only (hash, ord) pairs are grouped, combined before the shuffle, so neither a long
    text nor a key that holds most rows reaches one task. Null keys equal each other.
    """
    keyed = df.select(*by, ORD, F.sha2(key, 256).alias("_key"))
    first = keyed.groupBy(*by, "_key").agg(F.min(ORD).alias(ORD), F.count("*").alias("copies"))
    return first.drop("_key")


def dedupe_exact(df: DataFrame, key: Column, by: Sequence[str] = (), first: DataFrame | None = None) -> DataFrame:
    """Keep the row with the lowest `ord` per key; null keys equal each other.

    The rows move once, for the semi-join on the unique `ord`. `first` may hold stored `first_rows`.
    """
    first = first_rows(df, key, by) if first is None else first
    return df.join(first.select(*by, ORD), [*by, ORD], "left_semi")


def dedupe_tagged(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`dedupe_exact` on the joined tokens; missing and empty lists share one key."""
    return dedupe_exact(df, tag_fn.dedupe_key(F.col("tokens")), by)


def removed_counts(first: DataFrame, cleaned: DataFrame) -> DataFrame:
    """`stage_counts` from what a job stored anyway: `first_rows` by task and the cleaned rows.

    No text is read. Tasks that lost every row are listed with 0 kept. Counts of stored tables
    stay right when a lost executor's tasks run twice, which counters kept by the tasks would not.
    """
    before = first.groupBy("task").agg(F.sum("copies").alias("loaded"), F.count("*").alias("_unique"))
    after = cleaned.groupBy(F.col("task").alias("_task")).agg(F.count("*").alias("_kept"))
    kept = F.coalesce("_kept", F.lit(0).cast("bigint"))
    return before.join(after, F.col("task").eqNullSafe(F.col("_task")), "left").select(
        "task",
        "loaded",
        (F.col("loaded") - F.col("_unique")).alias("removed_duplicates"),
        (F.col("_unique") - kept).alias("removed_invalid"),
        kept.alias("kept"),
    )


def is_valid(tasks: Sequence[TaskSpec], text: Column | None = None) -> Column:
    """The label belongs to its task and the text is not empty."""
    text = F.col("text") if text is None else text
    known = [(F.col("task") == t.name) & F.col("label").isin(*t.labels) for t in tasks]
    valid = reduce(lambda a, b: a | b, known) & (text != "")
    return F.coalesce(valid, F.lit(False))


def clean_classified(df: DataFrame, tasks: Sequence[TaskSpec]) -> DataFrame:
    """Normalised text; rows with a foreign label or an empty text are dropped."""
    return df.withColumn("text", normalize_text(F.col("text"))).filter(is_valid(tasks))


def clean_tagged(df: DataFrame) -> DataFrame:
    """Rows with both lists, re-cut to one character per token (see `tag_fn.char_tokens` and `tag_fn.char_tags`).

    A batch's characters and tags are cut in one go: expressions on lists make several lists for every token.
    """
    columns = [c for c in df.columns if c not in ("tokens", "tags")]
    rows = df.filter(F.col("tokens").isNotNull() & F.col("tags").isNotNull()).select(*columns, "tokens", "tags")
    schema = StructType([*(df.schema[c] for c in columns), *(StructField(c, ArrayType(StringType())) for c in ("tokens", "tags"))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                *kept, tokens, tags = part.columns
                yield pa.RecordBatch.from_arrays([*kept, *_characters(tokens, tags)], [*columns, "tokens", "tags"])

    return rows.mapInArrow(cut, schema)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about `TOKENS` tokens, or one row."""
    ends = np.cumsum(pc.list_value_length(batch.column("tokens")).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + TOKENS, side="right")))
        yield batch.slice(start, end - start)
        start = end


def _characters(tokens: pa.ListArray, tags: pa.ListArray) -> tuple[pa.ListArray, pa.ListArray]:
    """Characters of the paired tokens with their tags, as lists without nulls among the characters."""
    n_tokens, n_tags = (pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in (tokens, tags))
    n = np.minimum(n_tokens, n_tags)

    def paired(lists: pa.ListArray, sizes: np.ndarray) -> pa.Array:
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return lists.flatten().filter(pa.array(place < np.repeat(n, sizes)))

    words, marks = paired(tokens, n_tokens), paired(tags, n_tags).dictionary_encode()
    # Null and empty tokens vanish with their tags.
    lengths = pc.fill_null(pc.utf8_length(words), 0).to_numpy(zero_copy_only=False)
    held = np.bincount(np.repeat(np.arange(len(n)), n), weights=lengths, minlength=len(n)).astype(np.int64)
    offsets = pa.array(np.concatenate([[0], np.cumsum(held)]), pa.int32())

    data = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pc.fill_null(words, "")), "")[0].as_buffer()
    starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) if data.size else np.empty(0, np.int64)
    bounds = pa.py_buffer(np.append(starts, data.size).astype(np.int32))
    characters = pa.StringArray.from_buffers(len(starts), bounds, data)

    names = [t.as_py() for t in marks.dictionary]
    follow = [f"I-{t[2:]}" if t.startswith("B-") else t for t in names]
    code = np.repeat(pc.fill_null(marks.indices, 2 * len(names)).to_numpy(zero_copy_only=False).astype(np.int64), lengths)
    later = np.ones(len(code), bool)
    later[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    # Tags after the first character stand behind the others; null tags stay null.
    code[later & (code < len(names))] += len(names)
    spread = pa.array([*names, *follow, None], pa.string()).take(pa.array(code))
    return pa.ListArray.from_arrays(offsets, characters), pa.ListArray.from_arrays(offsets, spread)


def stage_counts(df: DataFrame, tasks: Sequence[TaskSpec]) -> DataFrame:
    """Rows per task when loaded, after dedupe and after cleaning, in one pass.

    Whether a key's kept row survives cleaning is decided by its lowest-`ord` row, so
    one grouping by key gives all three numbers.
    """
    flagged = df.select(
        "task",
        ORD,
        F.sha2("text", 256).alias("_key"),
        is_valid(tasks, normalize_text(F.col("text"))).alias("_valid"),
    )
    # min over (ord, flag) keeps the flag of the first row with map-side combining.
    per_key = flagged.groupBy("task", "_key").agg(
        F.count("*").alias("_rows"),
        F.min_by("_valid", ORD).alias("_valid"),
    )
    return per_key.groupBy("task").agg(
        F.sum("_rows").alias("loaded"),
        (F.sum("_rows") - F.count("*")).alias("removed_duplicates"),
        F.count_if(~F.col("_valid")).alias("removed_invalid"),
        F.count_if("_valid").alias("kept"),
    )
