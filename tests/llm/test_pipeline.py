"""Each stage of the pipeline on its own input against brute force."""

from collections import Counter, defaultdict

import brute
import corpus_pipeline as pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textmill.llm import mixing
from textmill.runtime import BATCH_BYTES, MOST_BATCH_BYTES, bound_batches, materialize

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, documents):
    """The input of each stage and, at the end, the result."""
    out = [documents]
    for name, stage in pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF_DIR), f"test-{name}"))
    return out


def texts_of(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_columns(documents, steps):
    assert [name for name, _ in pipeline.STAGES] == ["quality", "lines", "near", "mix", "pack"]
    for df in steps[:-1]:
        assert df.dtypes == documents.dtypes


def test_quality(steps):
    before, after = dict(texts_of(steps[0])), dict(texts_of(steps[1]))
    assert all(before[i] == t for i, t in after.items())
    for i, text in before.items():
        n, _, symbols, lines, repeats = brute.statistics(text)
        if n < 10 or 100 * repeats > 20 * n:
            assert i not in after
        elif not symbols and not lines and not repeats:
            assert i in after  # nothing that a rule could hold against it


def test_lines(steps):
    want = {i: text for i, (_, _, text) in brute.deduped_lines(texts_of(steps[1])).items()}
    assert dict(texts_of(steps[2])) == want
    assert {r["doc_id"]: r["n_chars"] for r in steps[2].collect()} == {i: len(t) for i, t in want.items()}


def test_near(steps):
    found = brute.components(texts_of(steps[2]), 5)
    assert sorted(texts_of(steps[3])) == sorted((i, t) for i, t in texts_of(steps[2]) if found[i][1] == i)


def test_mix(steps):
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(steps[3]).collect()}
    text = dict(texts_of(steps[3]))
    assert Counter(texts_of(steps[4])) == Counter({(i, text[i]): n for i, n in copies.items() if n})


def test_pack(steps):
    pieces, rooms = Counter(), defaultdict(int)
    for r in steps[5].collect():
        pieces[r["doc_id"]] += r["piece"] == 0
        rooms[r["sequence_id"]] += r["length"]
    assert pieces == Counter(i for i, _ in texts_of(steps[4]))
    assert max(rooms.values()) <= 1024 and len(rooms) <= 1.05 * -(-sum(rooms.values()) // 1024) + 1


def test_run_is_the_stages(spark, steps):
    key = ("doc_id", "piece", "ids_crc32")
    run = Counter(tuple(r) for r in pipeline.run(spark, SF_DIR).select(*key).collect())
    assert run == Counter(tuple(r) for r in steps[5].select(*key).collect())


def test_stages_on_odd_rows(spark, odd):
    docs = odd.select("doc_id", "text", "source").selectExpr("doc_id", "text", "'en' AS lang", "source", "cast(0 AS long) AS n_chars")
    for empty in (False, True):
        rows = docs.limit(0) if empty else docs
        for name, stage in pipeline.STAGES:
            rows = materialize(stage(spark, rows, SF_DIR), f"odd-{name}")
        assert empty == rows.isEmpty()


def test_batches_are_bounded_by_bytes(spark):
    """Texts go to Python workers in batches of some bytes, however many rows that is; a longer text goes alone."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([sum(map(len, batch.column(1).to_pylist()))])], ["n", "size"])

    session = spark.newSession()
    n_letters = F.when(F.col("id") == 7, 3 * MOST_BATCH_BYTES).otherwise(20_000).cast("int")
    docs = session.range(1_000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), n_letters).alias("text"))
    docs = materialize(docs, "test-long").coalesce(1)
    found = docs.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in found) == 1_000 and sum(r["size"] for r in found) == 999 * 20_000 + 3 * MOST_BATCH_BYTES
    longest = max(found, key=lambda r: r["size"])
    assert longest["size"] < 4 * MOST_BATCH_BYTES
    assert all(r["size"] <= MOST_BATCH_BYTES + 20_000 for r in found if r is not longest)


def test_batches_keep_the_bound_of_the_session(spark):
    session = spark.newSession()
    session.conf.set(BATCH_BYTES, "1234567")
    bound_batches(session)
    assert session.conf.get(BATCH_BYTES) == "1234567"
    fresh = spark.newSession()
    bound_batches(fresh)
    assert fresh.conf.get(BATCH_BYTES) == str(MOST_BATCH_BYTES)
