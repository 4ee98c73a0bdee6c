"""TF-IDF features as long tables `(ord, block, ix, weight)`."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from textmill.functions import text as text_fn
from textmill.operators import windows
from textmill.operators.clean import ORD
from textmill.runtime import new_path, partition_by_row
from textmill.spec import MAX_FEATURES

Grams = Callable[[Column], Column]

#: Kind of a stored vector that lists its non-zero entries.
SPARSE = 0

#: n-grams the model is fitted on, and those computed when it is served.
FIT_GRAMS: dict[str, Grams] = {
    "word": text_fn.word_ngrams,
    "char": text_fn.char_wb_ngrams,
}
SERVE_GRAMS: dict[str, Grams] = {
    "word": text_fn.words,
    "char": text_fn.char_ngrams,
}


#: Texts whose windows are counted without a list of them, and the windows: lowest and highest length, inside words or not.
WINDOWS: dict[Grams, tuple[Grams, tuple[int, int, bool]]] = {
    text_fn.char_wb_ngrams: (text_fn.padded_words, (2, 5, True)),
    text_fn.char_ngrams: (F.lower, (2, 5, False)),
}


def _counted(fn: Grams) -> tuple[Column, tuple[int, int, bool] | None]:
    """What is sent to Python for a block: a text and its windows' shape, or the list of its terms."""
    prepare, shape = WINDOWS.get(fn, (fn, None))
    return prepare(F.col("text")), shape


def _prepared(docs: DataFrame, parts: Sequence[Column]) -> DataFrame:
    """`(ord, …)`: what is counted, partitioned and sorted by document; rows that share an `ord` are one."""
    rows = partition_by_row(docs.select(ORD, "text"), ORD).sortWithinPartitions(ORD)
    return rows.select(ORD, *[part.alias(f"b{i}") for i, part in enumerate(parts)])


def term_counts(docs: DataFrame, grams: dict[str, Grams]) -> DataFrame:
    """Occurrences `tf` per (ord, block, term).

    The text is partitioned by document, and some documents' terms are counted at a time, before they become rows. What
    moves is the text, not its n-grams, which are an order of magnitude larger, and no task groups the n-grams of many documents.
    """
    names, parts = list(grams), [_counted(fn) for fn in grams.values()]
    shapes = [shape for _, shape in parts]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from windows.document_counts(batches, shapes)

    rows = _prepared(docs, [part for part, _ in parts]).mapInArrow(count, f"{_key(docs)}, block int, term string, tf bigint")
    block = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("block") + 1)
    return rows.select(ORD, block.alias("block"), "term", "tf")


def _key(docs: DataFrame) -> str:
    return f"{ORD} {dict(docs.dtypes)[ORD]}"


def term_sums(docs: DataFrame, block: str, fn: Grams) -> DataFrame:
    """`(block, term, tf, df)`: total frequency and document frequency of some documents each, to be summed up."""
    part, shape = _counted(fn)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from windows.term_sums(batches, shape)

    rows = _prepared(docs, [part]).mapInArrow(count, "term string, tf bigint, df bigint")
    return rows.select(F.lit(block).alias("block"), "term", "tf", "df")


def corpus_stats(sums: DataFrame) -> DataFrame:
    """Total frequency and document frequency per term, combined before the shuffle."""
    return sums.groupBy("block", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def idf(n_docs: Column, df: Column) -> Column:
    return F.log((1 + n_docs) / (1 + df)) + 1


def top_k_terms(stats: DataFrame, k: int) -> DataFrame:
    """The k most frequent terms, ties in term order; per-partition heaps, then a merge."""
    return stats.orderBy(F.desc("tf"), "term").limit(k)


def fit_vocabulary(
    docs: DataFrame,
    grams: dict[str, Grams] | None = None,
    max_features: dict[str, int] | None = None,
) -> DataFrame:
    """Vocabulary `(block, ix, feature, term, tf, df, idf)` of at most 15,000 rows.

    `ix` counts terms in order inside a block; `feature` is the position in the joined
    vector, words first.
    """
    grams = grams or FIT_GRAMS
    sizes = max_features or MAX_FEATURES
    n_docs = docs.agg(F.count("*").alias("_n"))
    blocks = [
        top_k_terms(corpus_stats(term_sums(docs, block, fn)), sizes[block]).select(
            F.lit(i).alias("_place"), "*"
        )
        for i, (block, fn) in enumerate(grams.items())
    ]
    table = blocks[0]
    for block in blocks[1:]:
        table = table.unionByName(block)
    # Bounded by the block sizes, so one task may order it.
    in_block = Window.partitionBy("block").orderBy("term")
    overall = Window.orderBy("_place", "term")
    return (
        table.withColumn("ix", (F.row_number().over(in_block) - 1).cast("int"))
        .withColumn("feature", (F.row_number().over(overall) - 1).cast("int"))
        .join(F.broadcast(n_docs))
        .select("block", "ix", "feature", "term", "tf", "df", idf(F.col("_n"), F.col("df")).alias("idf"))
    )


#: n-grams of both sides.
SIDES: dict[str, dict[str, Grams]] = {"fit": FIT_GRAMS, "serve": SERVE_GRAMS}


def _weight(side: str, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weight of a term; served idf weights have single precision."""
    return (1 + np.log(tf)) * idf if side == "fit" else tf * idf.astype(np.float32).astype(float)


def _weights(docs: DataFrame, vocab: DataFrame, sides: Sequence[str], build: Callable, schema: str) -> DataFrame:
    """What `build(keys, entries)` gives for some documents at a time, `schema` after the key.

    `entries[side, block]` holds `(document, ix, feature, weight)`, L2-normalised per document; `keys` are the documents. All sides
    and blocks of a document come from one pass over its text.
    """
    chosen = [(side, block, *_counted(fn)) for side in sides for block, fn in SIDES[side].items()]
    # The vocabulary holds at most 15,000 rows.
    rows = vocab.select("block", "term", "ix", "feature", "idf").collect()
    tables = {}
    for block in {block for _, block, *_ in chosen}:
        own = [r for r in rows if r["block"] == block]
        numbers = [np.array([r[c] for r in own], t) for c, t in (("ix", np.int32), ("feature", np.int32), ("idf", float))]
        tables[block] = ([r["term"] for r in own], *numbers)
    sent = docs.sparkSession.sparkContext.broadcast(tables)
    shapes = [(side, block, shape) for side, block, _, shape in chosen]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = {block: pa.array(table[0], pa.string()) for block, table in sent.value.items()}
        for rows, document in windows.pieces(batches):
            entries = {}
            for column, (side, block, shape) in zip(rows.columns[1:], shapes):
                _, ix, feature, idf = sent.value[block]
                owner, place, tf = windows.known_counts(column, document, shape, terms[block])
                weight = _weight(side, tf, idf[place])
                # A known term has a weight above 0, so the norm is never 0 here.
                norm = np.sqrt(np.bincount(owner, weights=weight * weight, minlength=int(document[-1]) + 1))
                entries[side, block] = owner, ix[place], feature[place], weight / norm[owner]
            first = np.append(True, document[1:] != document[:-1])
            yield from build(rows.column(0).filter(pa.array(first)), entries)

    return _prepared(docs, [part for *_, part, _ in chosen]).mapInArrow(weigh, f"{_key(docs)}, {schema}")


def _weigh(docs: DataFrame, vocab: DataFrame, side: str) -> DataFrame:
    """`(ord, block, ix, feature, weight)`, L2-normalised per block."""

    def rows(keys: pa.Array, entries: dict) -> Iterator[pa.RecordBatch]:
        for (_, block), (owner, ix, feature, weight) in entries.items():
            names = pa.array([block]).take(pa.array(np.zeros(len(owner), np.int32)))
            arrays = [keys.take(pa.array(owner)), names, pa.array(ix), pa.array(feature), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(arrays, [ORD, "block", "ix", "feature", "weight"])

    return _weights(docs, vocab, [side], rows, "block string, ix int, feature int, weight double")


def tfidf_transform(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Weights as fitted: (1 + ln tf)·idf on word 1-2-grams and in-word char 2-5-grams."""
    return _weigh(docs, vocab, "fit")


def tfidf_serve(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Weights as served: tf·idf on single words and char 2-5-grams across spaces.

    The result has single precision.
    """
    return _weigh(docs, vocab, "serve").withColumn("weight", F.col("weight").cast("float"))


def zero_vectors(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """Documents without any known term."""
    return docs.select(ORD).join(weights.select(ORD), ORD, "left_anti")


def vector_entries(weights: DataFrame) -> DataFrame:
    """`(ord, ix, value)`: the non-zero entries of each document's vector, in its order within a partition."""
    entries = weights.filter(F.col("weight") != 0).repartition(ORD).sortWithinPartitions(ORD, "feature")
    return entries.select(ORD, F.col("feature").cast("bigint").alias("ix"), F.col("weight").alias("value"))


def skew(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Cosine of fitted and served weights per document and block.

    Both sides have norm 1 per block, so the product over shared entries is the cosine.
    """

    def cosines(keys: pa.Array, entries: dict) -> Iterator[pa.RecordBatch]:
        for block in FIT_GRAMS:
            sides = []
            for side, kind in (("fit", float), ("serve", np.float32)):
                owner, ix, _, weight = entries[side, block]
                sides.append((owner << 32 | ix, weight.astype(kind).astype(float)))
            (fit, x), (serve, y) = sides
            _, i, j = np.intersect1d(fit, serve, assume_unique=True, return_indices=True)
            total = np.bincount(fit[i] >> 32, weights=x[i] * y[j], minlength=len(keys))
            # A document without a common entry has the cosine 0, one without any entry has none.
            owner = np.union1d(fit >> 32, serve >> 32)
            names = pa.array([block]).take(pa.array(np.zeros(len(owner), np.int32)))
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(owner)), names, pa.array(total[owner])], [ORD, "block", "cosine"])

    return _weights(docs, vocab, ["fit", "serve"], cosines, "block string, cosine double")


def assemble(docs: DataFrame, weights: DataFrame, width: int) -> DataFrame:
    """`docs` with a sparse `features` vector; documents of unknown terms only get zeros.

    The parts of a vector are written as columns and read back as its type, so no row passes
    through Python. The result is a stored table, which training may read many times.
    """
    spark = docs.sparkSession
    rows = weights.groupBy(ORD).agg(
        F.array_sort(
            F.collect_list(F.struct("feature", F.col("weight").cast("double").alias("weight")))
        ).alias("_entries")
    )
    parts = F.struct(
        F.lit(SPARSE).cast("tinyint").alias("type"),
        F.lit(width).cast("int").alias("size"),
        F.coalesce(F.col("_entries.feature"), F.array()).cast("array<int>").alias("indices"),
        F.coalesce(F.col("_entries.weight"), F.array()).cast("array<double>").alias("values"),
    )
    plain = docs.join(rows, ORD, "left").select(*docs.columns, parts.alias("features"))
    path = new_path(spark, "vectors")
    plain.write.parquet(path)
    fields = [f for f in plain.schema.fields if f.name != "features"]
    return spark.read.schema(StructType([*fields, StructField("features", VectorUDT())])).parquet(path)
