import math

import pytest
from pyspark.sql import functions as F

from textmill.operators import features
from textmill.sources import artifacts

DOCS = "ord bigint, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(1, "aa bb aa"), (2, "bb"), (3, "cc")], DOCS)


@pytest.fixture(scope="module")
def vocab(docs):
    return features.fit_vocabulary(docs).persist()


def test_vocabulary(vocab):
    words = {r["term"]: r for r in vocab.filter("block = 'word'").collect()}
    assert [t for t, _ in sorted(words.items(), key=lambda x: x[1]["ix"])] == ["aa", "aa bb", "bb", "bb aa", "cc"]
    assert (words["aa"]["tf"], words["aa"]["df"]) == (2, 1)
    assert words["bb"]["idf"] == pytest.approx(math.log(4 / 3) + 1)
    n = len(words)
    chars = vocab.filter("block = 'char'").collect()
    assert all(r["feature"] == r["ix"] + n for r in chars)


def test_fitted_weights_by_hand(docs, vocab):
    got = {r["ix"]: r["weight"] for r in features.tfidf_transform(docs, vocab).filter("ord = 1 and block = 'word'").collect()}
    rare, common = math.log(4 / 2) + 1, math.log(4 / 3) + 1
    raw = [(1 + math.log(2)) * rare, rare, common, rare]
    norm = math.sqrt(sum(x * x for x in raw))
    assert [got[i] for i in range(4)] == pytest.approx([x / norm for x in raw])


def test_served_weights_by_hand(docs, vocab):
    got = {r["ix"]: r["weight"] for r in features.tfidf_serve(docs, vocab).filter("ord = 1 and block = 'word'").collect()}
    rare, common = math.log(4 / 2) + 1, math.log(4 / 3) + 1
    norm = math.hypot(2 * rare, common)
    assert got == pytest.approx({0: 2 * rare / norm, 2: common / norm}, rel=1e-6)


def test_unknown_terms(spark, docs, vocab):
    new = spark.createDataFrame([(7, "zz"), (8, "aa zz")], DOCS)
    weights = features.tfidf_serve(new, vocab).filter("block = 'word'")
    assert [r["ord"] for r in features.zero_vectors(new, weights).collect()] == [7]
    width = vocab.count()
    got = {r["ord"]: r["features"] for r in features.assemble(new, features.tfidf_transform(new, vocab), width).collect()}
    assert got[7].numNonzeros() == 0 and got[7].size == width and got[8].numNonzeros() > 0
    entries = features.vector_entries(features.tfidf_serve(new, vocab)).collect()
    vector = features.assemble(new, features.tfidf_serve(new, vocab), width).filter("ord = 8").first()["features"]
    assert {r["ord"] for r in entries} == {8}
    assert [(r["ix"], r["value"]) for r in entries] == list(zip(vector.indices.tolist(), vector.values.tolist()))


def test_ties_at_the_cut(spark):
    stats = spark.createDataFrame([("d", 1), ("b", 1), ("c", 2), ("a", 1)], "term string, tf bigint")
    assert [r["term"] for r in features.top_k_terms(stats, 3).collect()] == ["c", "a", "b"]


def test_skew_is_the_cosine(docs, vocab):
    def vectors(df):
        out = {}
        for r in df.collect():
            out.setdefault((r["ord"], r["block"]), {})[r["ix"]] = r["weight"]
        return out

    fit, serve = vectors(features.tfidf_transform(docs, vocab)), vectors(features.tfidf_serve(docs, vocab))
    for r in features.skew(docs, vocab).collect():
        a, b = fit.get((r["ord"], r["block"]), {}), serve.get((r["ord"], r["block"]), {})
        assert r["cosine"] == pytest.approx(sum(a[i] * b.get(i, 0) for i in a), rel=1e-6)


def test_one_document_may_hold_most_grams(spark):
    big = " ".join(f"w{i % 700}x" for i in range(20_000))
    df = spark.createDataFrame([(1, big), (2, "w1x")], DOCS)
    counts = features.term_counts(df, {"word": features.FIT_GRAMS["word"]})
    assert counts.filter("term = 'w1x'").agg(F.sum("tf")).first()[0] == sum(i % 700 == 1 for i in range(20_000)) + 1


def test_artifact_round_trip(spark, vocab, tmp_path):
    path = str(tmp_path / "vocab")
    artifacts.write_tfidf_artifact(vocab, path)
    back = artifacts.read_tfidf_artifact(spark, path)
    assert back.count() == vocab.count()
    assert dict(back.dtypes)["idf"] == "float"


def test_no_exchange_between_text_and_weights(spark, docs, vocab):
    terms = spark.createDataFrame(vocab.collect(), vocab.schema)
    plan = features.tfidf_transform(docs, terms)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
