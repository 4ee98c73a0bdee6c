"""Near duplicates by an LSH forest of MinHash signatures.

Documents with the same shingle set are one class, and the class's smallest doc_id stands
for it. Each tree of the forest orders the classes by a label of several minima; neighbours in
that order are the classes with the longest common prefix, however long it is there: a few
minima where texts differ, the whole label among near copies. Neighbours become candidates from
`least_prefix` common minima on. Candidates are confirmed on the full shingle sets, first the nearest
ones of some trees, then those of all trees that still lie in different components. A class has a
bounded number of neighbours, so a group of any size costs in proportion to its size.

The forest only makes the bulk of the links cheap: what it leaves in different components is joined
exactly, see `prefixes` and `setjoin.open_pairs`, so that no link is lost.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import blocks
from textmill.llm.graph import components, extend
from textmill.runtime import holding, materialize
from textmill.setjoin import COUNTED, SET_COLUMNS, SET_SCHEMA, frequent_members, open_pairs, order_table, set_columns

SHINGLE_WORDS = 5
PERCENT = 80
TREES, DEPTH = 16, 8
#: Common minima that neighbours need, neighbours on each side, and trees of the first confirmation.
LEAST_PREFIX, REACH, FIRST_TREES = 2, 2, 2
#: Frequent shingles of a row of the table that hands them on.
SEEN_ROW = 1 << 16
#: Bytes of text of a block, or a single longer text.
BLOCK_BYTES = 4 << 20
#: Shingle sets that a confirming task keeps.
SETS_KEPT = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; texts with fewer words have one, texts without words none."""
    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    mixed = hashes[: len(words) - width + 1].copy()
    for i in range(1, width):
        mixed *= _ODD
        mixed ^= mixed >> np.uint64(29)
        mixed += hashes[i : len(words) - width + 1 + i]
    return np.unique(mixed)


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = lambda name: np.array([xxhash.xxh3_64_intdigest(f"{name}{i}") for i in range(n)], np.uint64)
    return draw("multiplier") | np.uint64(1), draw("offset")


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    """Big-endian 32-bit minima, so that bytes sort like numbers."""
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(shingles), 2048):
        part = shingles[start : start + 2048, None] * a
        part += b
        least = np.minimum(least, (part >> np.uint64(32)).astype(np.uint32).min(axis=0))
    return least.astype(">u4").tobytes()


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def signatures(docs: DataFrame, width: int, trees: int, depth: int) -> DataFrame:
    """`(doc_id, n_shingles, set_key, signature, seen, times)`, one row per row of `docs`.

    Further rows, with `n_shingles` -1, hold in `seen` the shingles that several of the texts of a part of a task have, and their numbers.
    """
    schema = "doc_id long, n_shingles long, set_key binary, signature binary, seen array<long>, times array<long>"
    names = [c.split()[0] for c in schema.split(", ")]
    lists = pa.list_(pa.int64())

    def frequent(sets):
        for x, n in frequent_members(iter([*sets, None])):
            for at in range(0, len(x), SEEN_ROW):
                seen, times = (pa.array([v[at : at + SEEN_ROW].astype(np.int64)], lists) for v in (x, n))
                yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([-1], pa.int64()), *[pa.array([None], pa.binary())] * 2, seen, times], names)

    def sign(batches):
        a, b = _coefficients(trees * depth)
        held, size = [], 0
        for batch in batches:
            for ids, texts in blocks(batch.column(0), batch.column(1), BLOCK_BYTES):
                sets = [shingle_set(t or b"", width) for t in texts]
                none = pa.nulls(len(ids), lists)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array(map(set_key, sets), pa.binary()), pa.array([signature(s, a, b) for s in sets], pa.binary()), none, none],
                    names,
                )
                held += sets
                size += sum(map(len, sets))
                if size >= COUNTED:
                    yield from frequent(held)
                    held, size = [], 0
        yield from frequent(held)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(sign, schema)


def _pairs(rows: pd.DataFrame, least_prefix: int, reach: int, percent: int) -> pd.DataFrame:
    """Neighbours in the order of the rows, with their distance."""
    tree, rep, size = (rows[c].to_numpy() for c in ("tree", "rep", "size"))
    width = len(rows["label"].iloc[0]) // 4 if len(rows) else 1
    label = np.frombuffer(b"".join(rows["label"]), ">u4").reshape(-1, width)
    found = []
    for lag in range(1, min(reach, len(rows) - 1) + 1):
        x, y = slice(None, -lag), slice(lag, None)
        fits = (label[x, :least_prefix] == label[y, :least_prefix]).all(axis=1) & (tree[x] == tree[y]) & (rep[x] != rep[y])
        fits &= 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
        found.append(pd.DataFrame({"a": np.minimum(rep[x], rep[y])[fits], "b": np.maximum(rep[x], rep[y])[fits], "tree": tree[x][fits], "lag": lag}))
    return pd.concat(found) if found else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("a", "b", "tree", "lag")})


def neighbours(classes: DataFrame, trees: int, depth: int, least_prefix: int, reach: int, percent: int) -> DataFrame:
    """`(a, b, tree, lag)`: candidates among `(rep, size, signature)`.

    The order of all trees is cut into ranges. A task pairs the rows of its range and hands on
    its first and last rows, which are paired with those of the next ranges: a few rows per range.
    """
    bytes_each = 4 * depth
    label = F.substring("signature", F.col("tree") * bytes_each + 1, F.lit(bytes_each))
    rows = classes.select("rep", "size", "signature", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    order = ["tree", "label", "rep"]
    # Labels are cut from the stored signatures twice, for the ranges' sample and for the sort: cheaper than a copy of all.
    ordered = rows.select("tree", label.alias("label"), "rep", "size").repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "a long, b long, tree int, lag int, label binary, rep long, size long"

    def pair(batches):
        held, kept, first = None, 0, []
        for batch in batches:
            rows = batch.to_pandas()
            if not len(rows):
                continue
            if len(first) < reach:
                first.extend(rows.iloc[: reach - len(first)].to_dict("records"))
            joined = pd.concat([held, rows], ignore_index=True) if held is not None else rows
            # Pairs inside the rows carried over were found with the batch before.
            pairs = _pairs(joined, least_prefix, reach, percent)
            if held is not None and kept > 1:
                old = _pairs(held, least_prefix, reach, percent)
                pairs = pd.concat([pairs, old, old]).drop_duplicates(keep=False) if len(old) else pairs
            held = joined.iloc[-reach:].reset_index(drop=True)
            kept = len(held)
            yield _batch(pairs)
        if held is not None:
            edges = pd.concat([pd.DataFrame(first), held]).drop_duplicates(["tree", "rep"])
            yield _batch(edges)

    def _batch(frame: pd.DataFrame) -> pa.RecordBatch:
        types = {"a": pa.int64(), "b": pa.int64(), "tree": pa.int32(), "lag": pa.int32(), "label": pa.binary(), "rep": pa.int64(), "size": pa.int64()}
        none = pd.Series([None] * len(frame), dtype=object)
        return pa.RecordBatch.from_arrays([pa.array(list(frame[c]) if c in frame else none, t) for c, t in types.items()], list(types))

    found = materialize(ordered.mapInArrow(pair, schema), "neighbours")
    # Twice `reach` rows per range of the sort.
    edges = found.filter("rep IS NOT NULL").select("tree", "label", "rep", "size").repartition(1).sortWithinPartitions(*order)

    def across(frames):
        rows = pd.concat(list(frames), ignore_index=True)
        yield _pairs(rows, least_prefix, reach, percent)

    return found.filter("a IS NOT NULL").select("a", "b", "tree", "lag").unionByName(edges.mapInPandas(across, "a long, b long, tree int, lag int"))


def compare(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """`(a, b, size_a, size_b, both)` of the full sets of pairs `(a, b)`."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    names = ["a", "b", "size_a", "size_b", "both"]

    def check(batches):
        sets: OrderedDict[int, np.ndarray] = OrderedDict()

        def of(doc_id: int, text) -> np.ndarray:
            if doc_id not in sets:
                sets[doc_id] = shingle_set(text.as_py(), width)
                if len(sets) > SETS_KEPT:
                    sets.popitem(last=False)
            return sets[doc_id]

        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows: list[list] = [[], [], []]
                ids = [part.column(c).to_pylist() for c in ("a", "b")]
                for i, (a, b) in enumerate(zip(*ids, strict=True)):
                    x, y = of(a, part.column("text_a")[i]), of(b, part.column("text_b")[i])
                    both = np.intersect1d(x, y, assume_unique=True)
                    for column, value in zip(rows, (len(x), len(y), len(both)), strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (*ids, *rows)], names)

    # Texts move by shuffle at any size; what is small here is not small in a large corpus.
    joined = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(check, "a long, b long, size_a long, size_b long, both long")


def _linked(percent: int):
    return 100 * F.col("both") >= percent * (F.col("size_a") + F.col("size_b") - F.col("both"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).filter("doc_id IS NOT NULL AND text IS NOT NULL")


def prefixes(docs: DataFrame, classes: DataFrame, order: tuple[np.ndarray, np.ndarray], width: int, percent: int) -> DataFrame:
    """`(rep, size, xs, bits…)`: the first shingles of each class, those that few texts have first, and its bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def cut(batches):
        for batch in batches:
            for ids, texts in blocks(batch.column(0), batch.column(1), BLOCK_BYTES):
                sets = [shingle_set(t, width) for t in texts]
                arrays = [pa.array(map(set_key, sets), pa.binary()), pa.array(ids, pa.int64()), *set_columns(sets, shared.value, percent / 100)]
                yield pa.RecordBatch.from_arrays(arrays, ["set_key", "rep", *SET_COLUMNS])

    lists = _texts(docs).mapInArrow(cut, "set_key binary, rep long, " + SET_SCHEMA)
    # Rows that repeat a doc_id have a list for each of their sets.
    return lists.join(classes.select("set_key", "rep"), ["set_key", "rep"], "left_semi").dropDuplicates(["set_key"]).select("rep", *SET_COLUMNS)


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components, with these, null for a class alone."""
    side = lambda name: found.select(F.col("rep").alias(name), F.col("component").alias(f"component_{name}"))
    joined = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return joined.filter(F.coalesce("component_a", "a") != F.coalesce("component_b", "b"))


def near_components(
    docs: DataFrame,
    width: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    trees: int = TREES,
    depth: int = DEPTH,
    least_prefix: int = LEAST_PREFIX,
    reach: int = REACH,
) -> DataFrame:
    """`(doc_id, n_shingles, component_id, kept)`, one row per row of `docs`.

    Documents are linked when 100 * intersection >= percent * union of their sets of `width`-word
    shingles, A-Z taken as lower case; `component_id` is the smallest doc_id that links reach and `kept`
    marks it. A text with fewer words is one shingle; a text without words, or null, has no
    shingle and is linked with nothing. A row without doc_id is linked with nothing, has no component and is kept.
    Rows that repeat a doc_id are one node, linked with what any of them is. Other columns are not read.
    """
    stored = materialize(signatures(docs, width, trees, depth), "signatures")
    signed = stored.filter("n_shingles >= 0").drop("seen", "times")
    usable = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = usable.groupBy("set_key").agg(F.min(F.struct("doc_id", "n_shingles", "signature")).alias("_c"))
    classes = materialize(classes.select("set_key", F.col("_c.doc_id").alias("rep"), F.col("_c.n_shingles").alias("size"), F.col("_c.signature").alias("signature")), "classes")
    candidates = materialize(
        neighbours(classes, trees, depth, least_prefix, reach, percent).groupBy("a", "b").agg(F.min(F.struct("lag", "tree")).alias("near")), "candidates"
    )
    ends = candidates.select(F.col("a").alias("doc_id")).union(candidates.select("b")).distinct()
    # Where rows repeat a doc_id, any one of their texts stands for it in the forest.
    texts = holding(_texts(docs), ends, "doc_id")
    repeated = not usable.groupBy("doc_id").count().filter("count > 1").isEmpty()
    if repeated:
        texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"))
    texts = materialize(texts, "candidate-texts")

    first = (F.col("near.lag") == 1) & (F.col("near.tree") < FIRST_TREES)
    tried = materialize(compare(candidates.filter(first).select("a", "b"), texts, width), "compared")
    links = tried.filter(_linked(percent)).select("a", "b")
    found = materialize(components(links), "components")
    rest = _apart(candidates.filter(~first).select("a", "b"), found)
    more = materialize(compare(rest.select("a", "b"), texts, width), "compared")
    links = more.filter(_linked(percent)).select("a", "b")
    found = materialize(extend(found, links), "components")

    same = usable.join(classes.select("set_key", "rep"), "set_key").select("doc_id", "rep")
    twice = same.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b").select("a", "b")
    found = materialize(extend(found, twice), "components")

    counts = stored.filter("n_shingles < 0").select(F.explode(F.arrays_zip("seen", "times")).alias("c"))
    order = order_table(counts.select(F.col("c.seen").alias("x"), F.col("c.times").alias("n")))
    lists = prefixes(docs, classes, order, width, percent).join(found, "rep", "left")
    lists = materialize(lists.select("rep", F.coalesce("component", "rep").alias("component"), *SET_COLUMNS), "prefixes")
    pairs = materialize(open_pairs(lists, percent / 100), "open-pairs")
    ends = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = holding(_texts(docs), ends, "doc_id")
    # Here every text of a repeated doc_id is compared.
    texts = materialize(texts.distinct() if repeated else texts, "open-texts")
    linked = materialize(extend(found, compare(pairs, texts, width).filter(_linked(percent)).select("a", "b")), "components")

    rows = signed.join(classes.select("set_key", "rep"), "set_key", "left").join(linked, "rep", "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component", "rep"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
