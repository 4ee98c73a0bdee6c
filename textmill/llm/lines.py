"""Line dedup that is incremental and reversible.

The state of a `LineIndex` is three tables in the shared folder: the references (a line key
and a document that holds it), the counts (references, smallest and largest document of a
key), which are exact, and the filters, one row per shard of the key space with two cuckoo
filters, of all keys and of the keys that several documents share. An insertion looks up
only those keys in the counts that the first filter may hold; dedup of documents looks up
only those that the second one may hold. Deleting documents takes their references out,
recounts the keys concerned and deletes what has gone from the filters, so that lines
come back when the document that kept them goes.

Filters are probed with distinct keys, spread over the shards by hash, so a line that a third of
the documents hold is one key of one shard. Lines are joined to shared keys by a shuffled
join, in which Spark splits the rows of a hot key.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textmill.llm.common import blocks
from textmill.llm.cuckoo import CuckooFilter
from textmill.runtime import materialize

MIN_LENGTH = 10
KEYS_PER_SHARD = 200_000
#: Bytes of text of a block, or a single longer text.
BLOCK_BYTES = 4 << 20
KEY = ["h1", "h2"]
_REFS = "h1 long, h2 long, doc_id long"
_FILTERS = "shard int, held binary, shared binary"


def line_key(line: bytes, min_length: int = MIN_LENGTH) -> bytes | None:
    """128-bit hash of a line without outer white space and with A-Z in lower case, None if it is too short."""
    key = line.strip().lower()  # of bytes: ASCII white space and ASCII letters only
    if len(key) < min_length or len(key) < 4 * min_length and len(key.decode("utf-8", "replace")) < min_length:
        return None
    return xxhash.xxh3_128_digest(key)


def line_references(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """`(h1, h2, doc_id)`: the distinct line keys of each row. Rows without doc_id or text have none."""

    def keys(batches):
        for batch in batches:
            for ids, texts in blocks(batch.column(0), batch.column(1), BLOCK_BYTES):
                digests, owners = [], []
                for doc_id, text in zip(ids, texts, strict=True):
                    own = {line_key(line, min_length) for line in text.split(b"\n")} - {None}
                    digests.extend(own)
                    owners.extend([doc_id] * len(own))
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(owners, pa.int64())], ["h1", "h2", "doc_id"])

    rows = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(keys, _REFS)


def _small(batch: pa.RecordBatch, rows: int = 500):
    """Slices of a batch, so that what is made of it in Python stays small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


@dataclass
class LineIndex:
    """References, counts and filters of the lines of inserted documents."""

    spark: SparkSession
    min_length: int = MIN_LENGTH
    shards: int = 0
    refs: DataFrame | None = None
    counts: DataFrame | None = None
    filters: DataFrame | None = None

    def _shard(self):
        return F.pmod(F.col("h2"), F.lit(self.shards)).cast("int").alias("shard")

    def _probe(self, keys: DataFrame, name: str) -> DataFrame:
        """The keys that filter `name` may hold."""

        def look(shard, keys: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            if not len(own) or not len(keys):
                return keys.iloc[:0][KEY]
            held = CuckooFilter.from_bytes(own[name].iloc[0])
            return keys.loc[held.contains(keys["h1"].to_numpy(), keys["h2"].to_numpy()), KEY]

        grouped = keys.select(*KEY, self._shard()).groupBy("shard")
        return grouped.cogroup(self.filters.select("shard", name).groupBy("shard")).applyInPandas(look, "h1 long, h2 long")

    def _change(self, changed: DataFrame) -> DataFrame:
        """The filters after the changes; `changed` has the state of keys before (`old_`) and after."""

        def apply(shard, rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            out = {"shard": shard[0]}
            for name in ("held", "shared"):
                before, after = rows[f"old_{name}"].to_numpy(bool), rows[name].to_numpy(bool)
                pick = lambda mask: (rows.loc[mask, "h1"].to_numpy(), rows.loc[mask, "h2"].to_numpy())
                added, gone = pick(after & ~before), pick(before & ~after)
                built = CuckooFilter.from_bytes(own[name].iloc[0]) if len(own) else CuckooFilter.for_keys(len(added[0]))
                built.delete(*gone)
                out[name] = built.to_bytes() if built.insert(*added) else b""  # full: made anew below
            return pd.DataFrame([out])

        old = self.filters if self.filters is not None else self.spark.createDataFrame([], _FILTERS)
        grouped = changed.withColumn("shard", self._shard()).groupBy("shard")
        new = materialize(grouped.cogroup(old.groupBy("shard")).applyInPandas(apply, _FILTERS), "filters")
        return new.unionByName(old.join(new.select("shard"), "shard", "left_anti"))

    def _rebuild(self, counts: DataFrame) -> DataFrame:
        """Filters of all keys, in as many shards as they need now."""
        self.shards = max(1, -(-counts.count() // KEYS_PER_SHARD))

        def build(shard, rows: pd.DataFrame) -> pd.DataFrame:
            out = {"shard": shard[0]}
            for name in ("held", "shared"):
                h1, h2 = (rows.loc[rows[name], k].to_numpy() for k in KEY)
                built, room = CuckooFilter.for_keys(2 * len(h1)), 2 * len(h1)
                while not built.insert(h1, h2):
                    room *= 2
                    built = CuckooFilter.for_keys(room)
                out[name] = built.to_bytes()
            return pd.DataFrame([out])

        keys = counts.select(*KEY, self._shard(), F.lit(True).alias("held"), (F.col("min_doc") < F.col("max_doc")).alias("shared"))
        return materialize(keys.groupBy("shard").applyInPandas(build, _FILTERS), "filters")

    def _settle(self, changed: DataFrame) -> None:
        """Take changed keys (`old_*` null where new, `n_refs` null where gone) into counts and filters."""
        changed = materialize(changed, "changed-lines")
        now = changed.filter("n_refs IS NOT NULL").select(*KEY, "n_refs", "min_doc", "max_doc")
        if self.counts is None:
            self.counts, self.filters = now, self._rebuild(now)
            return
        self.counts = materialize(self.counts.join(changed.select(KEY), KEY, "left_anti").unionByName(now), "line-counts")
        flags = changed.select(
            *KEY,
            F.col("old_min").isNotNull().alias("old_held"),
            F.coalesce(F.col("old_min") < F.col("old_max"), F.lit(False)).alias("old_shared"),
            F.col("n_refs").isNotNull().alias("held"),
            F.coalesce(F.col("min_doc") < F.col("max_doc"), F.lit(False)).alias("shared"),
        )
        filters = materialize(self._change(flags), "filters")
        full = filters.filter((F.length("held") == 0) | (F.length("shared") == 0)).count()
        self.filters = self._rebuild(self.counts) if full else filters

    def insert(self, docs: DataFrame) -> DataFrame:
        """Add documents and return their references. Lines of a document that are in already are not counted again."""
        refs = materialize(line_references(docs, self.min_length), "line-refs")
        new = refs
        if self.refs is not None:
            new = materialize(refs.join(self.refs, [*KEY, "doc_id"], "left_anti"), "line-refs")
        batch = new.groupBy(KEY).agg(F.count("*").alias("add_refs"), F.min("doc_id").alias("add_min"), F.max("doc_id").alias("add_max"))
        if self.counts is None:
            merged = batch.select("*", *(F.lit(None).cast("long").alias(c) for c in ("old_refs", "old_min", "old_max")))
        else:
            batch = materialize(batch, "line-batch")
            old = self.counts.toDF(*KEY, "old_refs", "old_min", "old_max")
            known = materialize(self._probe(batch, "held"), "known-lines")
            found = batch.join(known, KEY, "left_semi").join(old, KEY, "left")
            fresh = batch.join(known, KEY, "left_anti")
            merged = found.unionByName(fresh, allowMissingColumns=True)
        self._settle(
            merged.select(
                *KEY,
                "old_min",
                "old_max",
                (F.coalesce("old_refs", F.lit(0)) + F.col("add_refs")).alias("n_refs"),
                F.least("old_min", "add_min").alias("min_doc"),
                F.greatest("old_max", "add_max").alias("max_doc"),
            )
        )
        self.refs = new if self.refs is None else self.refs.unionByName(new)
        return refs

    def delete(self, doc_ids: DataFrame) -> None:
        """Take the documents of a table with a column doc_id out; ids that were never inserted change nothing."""
        if self.refs is None:
            return
        ids = doc_ids.select("doc_id").distinct()
        touched = self.refs.join(ids, "doc_id", "left_semi").select(KEY).distinct()
        touched = materialize(touched, "touched-lines")
        self.refs = materialize(self.refs.join(ids, "doc_id", "left_anti"), "line-refs")
        left = self.refs.join(touched, KEY, "left_semi").groupBy(KEY)
        left = left.agg(F.count("*").alias("n_refs"), F.min("doc_id").alias("min_doc"), F.max("doc_id").alias("max_doc"))
        old = self.counts.select(*KEY, F.col("min_doc").alias("old_min"), F.col("max_doc").alias("old_max"))
        self._settle(touched.join(old, KEY).join(left, KEY, "left"))

    def dedupe(self, docs: DataFrame, refs: DataFrame | None = None) -> DataFrame:
        """`docs` with `text` without its repeated lines, and `n_lines` and `n_dropped` added.

        A line goes if several inserted documents hold its key and this one is not the one with
        the smallest doc_id. `refs` are the references of `docs`, if known. A null or empty text is
        one empty line, and the text that remains is empty then. Rows without doc_id keep all
        lines and count for no key; rows that repeat a doc_id are one document. Columns of `docs` called
        n_lines or n_dropped are replaced. Before any insertion, and where only one document holds a key, nothing goes;
        of documents that hold a key equally the smallest doc_id keeps its lines. An empty table gives no row.
        """
        refs = line_references(docs, self.min_length) if refs is None else refs
        if self.counts is None:
            drops = refs.limit(0)
        else:
            likely = self._probe(refs.select(KEY).distinct(), "shared")
            shared = self.counts.filter("min_doc < max_doc").join(likely, KEY, "left_semi").select(*KEY, "min_doc")
            # A table of its own, so that both sides are shuffled and Spark can split the lines of a hot key.
            drops = refs.join(materialize(shared, "shared-lines"), KEY).filter("doc_id <> min_doc")
        listed = drops.groupBy(F.col("doc_id").alias("_llm_id")).agg(F.collect_set(F.struct(*KEY)).alias("_llm_keys"))
        rest = docs.drop("n_lines", "n_dropped", "_llm_id", "_llm_keys")
        joined = rest.join(listed, rest["doc_id"] == listed["_llm_id"], "left").drop("_llm_id")
        return _without_lines(joined.withColumn("text", F.col("text").cast("binary")), self.min_length)


def _without_lines(df: DataFrame, min_length: int) -> DataFrame:
    kept = [f for f in df.schema.fields if f.name != "_llm_keys"]
    names = [f.name for f in kept]
    at = names.index("text")

    def clean(batches):
        for whole in batches:
            for batch in _small(whole):
                texts, n_lines, n_dropped = [], [], []
                for text, keys in zip(batch.column("text").to_pylist(), batch.column("_llm_keys").to_pylist(), strict=True):
                    lines = (text or b"").split(b"\n")
                    if keys:
                        gone = {np.array([k["h1"], k["h2"]], np.int64).tobytes() for k in keys}
                        left = [line for line in lines if line_key(line, min_length) not in gone]
                        texts.append(b"\n".join(left).decode("utf-8", "replace"))
                    else:
                        left = lines
                        texts.append((text or b"").decode("utf-8", "replace"))
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(left))
                columns = [batch.column(n) for n in names]
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*names, "n_lines", "n_dropped"]
                )

    schema = StructType([StructField("text", StringType()) if f.name == "text" else f for f in kept])
    return df.mapInArrow(clean, schema.add("n_lines", "long").add("n_dropped", "long"))


def dedupe_lines(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Insert all `docs` into a new index and dedupe them with it; see `LineIndex.dedupe`."""
    index = LineIndex(docs.sparkSession, min_length)
    refs = index.insert(docs)
    return index.dedupe(docs, refs)
