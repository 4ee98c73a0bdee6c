import itertools
import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from textmill.operators import classify, routing, tagging
from textmill.plans import jobs
from textmill.sources import artifacts
from textmill.spec import ENTITIES

TAG_MAP = ENTITIES.tag_map
SENTENCES = "ord bigint, tokens array<string>, tags array<string>"


def newton(x, y, w, c, rounds=50):
    """Optimum of |beta|²/2 + c·Σ w·log-loss with a free bias."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([1.0] * x.shape[1] + [0.0])
    beta = np.zeros(x1.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x1 @ beta))
        grad = ridge @ beta + c * x1.T @ (w * (p - y))
        hess = ridge + c * (x1.T * (w * p * (1 - p))) @ x1
        beta -= np.linalg.solve(hess, grad)
    return beta


def test_classifier_against_newton(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4))
    y = (x @ [1, -2, 0.5, 0] + rng.normal(size=300) > 0.7).astype(float)
    data = [("yes" if t else "no", Vectors.dense(r)) for r, t in zip(x, y)]
    df = spark.createDataFrame(data, ["label", "features"])
    model = classify.train_classifier(df, max_iter=300, tol=1e-12)
    n, pos = len(y), y.sum()
    w = np.where(y == 1, n / (2 * pos), n / (2 * (n - pos)))
    want = newton(x, y, w, 20.0)
    lr = model.stages[1]
    assert np.append(lr.coefficients.toArray(), lr.intercept) == pytest.approx(want, abs=1e-4)

    scored = classify.score(df, model)
    p = 1 / (1 + np.exp(-(np.hstack([x, np.ones((n, 1))]) @ want)))
    loss = -np.mean(np.log(np.where(y == 1, p, 1 - p)))
    assert classify.mean_loss(scored).first()["mean_loss"] == pytest.approx(loss, abs=1e-4)

    artifacts.save_model(model, str(tmp_path / "m"))
    again = artifacts.load_model(str(tmp_path / "m"))
    unlabelled = classify.score(df.drop("label"), again)
    assert "label" not in unlabelled.columns
    assert [r["predicted"] for r in unlabelled.collect()] == ["yes" if q > 0.5 else "no" for q in p]


def test_training_merges_partitions_of_few_bytes(spark, tmp_path, monkeypatch):
    given, train = [], classify.train_classifier
    monkeypatch.setattr(classify, "train_classifier", lambda rows, **kw: given.append(kw.get("partitions")) or train(rows, **kw))
    texts = [(i, "yes sure of course" if i % 2 else "no never not", "Affirm" if i % 2 else "Deny") for i in range(20)]
    docs = spark.createDataFrame(texts, "ord bigint, text string, label string").repartition(8)
    scored = jobs.train_text_task(docs, docs)[2]
    assert given == [1]
    assert [r["ord"] for r in scored.filter("label = predicted").orderBy("ord").collect()] == list(range(20))
    spark.range(20_000).write.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(classify, "PARTITION_BYTES", 1_000)
    assert classify.partitions_for(spark.read.parquet(str(tmp_path / "t"))) > 10


def _report(spark, pairs):
    df = spark.createDataFrame(pairs, "label string, predicted string")
    out = classify.classification_report(classify.confusion(df)).collect()
    return {r["class"]: (round(r["precision"], 4), round(r["recall"], 4), round(r["f1"], 4), r["support"]) for r in out}


def test_classification_report(spark):
    got = _report(spark, [("a", "a"), ("a", "a"), ("a", "b"), ("c", "b")])
    assert got["a"] == (1.0, 0.6667, 0.8, 3)
    assert got["b"] == (0.0, 0.0, 0.0, 0)  # never true
    assert got["c"] == (0.0, 0.0, 0.0, 1)  # never predicted
    assert got["accuracy"][2] == 0.5
    assert got["macro avg"] == (0.3333, 0.2222, 0.2667, 4)
    assert got["weighted avg"] == (0.75, 0.5, 0.6, 4)
    assert _report(spark, [("a", "a")])["macro avg"] == (1.0, 1.0, 1.0, 1)


def test_entity_report(spark):
    data = [(1, ["O", "B-X", "I-X"], ["B-X", "O", "I-X", "O"])]
    df = spark.createDataFrame(data, "ord bigint, tags array<string>, predicted array<string>")
    got = {r["class"]: r["support"] for r in tagging.entity_report(df).collect()}
    assert got["O"] == 0 and got["B-X"] == 1 and got["I-X"] == 1 and got["accuracy"] == 2
    strict = {r["class"]: r["support"] for r in tagging.entity_report(df, strict=True).collect()}
    assert strict["accuracy"] == 3
    none = spark.createDataFrame([(1, ["O"], ["O"])], df.schema)
    assert tagging.entity_report(none).filter("class = 'O'").count() == 0


@pytest.fixture(scope="module")
def train(spark):
    data = [
        (1, ["b", "a", "c"], ["B-PROJ", "I-PROJ", "O"]),
        (2, ["a", "c"], ["O", "O"]),
        (3, [], []),
    ]
    return spark.createDataFrame(data, SENTENCES)


@pytest.fixture(scope="module")
def vocab(train):
    return tagging.token_index(train)


def test_token_index_and_artifact(spark, vocab, tmp_path):
    ids = {r["token"]: r["ix"] for r in vocab.collect()}
    assert ids == {"<PAD>": 0, "a": 1, "b": 2, "c": 3, "<UNK>": 4}
    artifacts.write_index_artifact(vocab.filter("token <> '<UNK>'"), TAG_MAP, str(tmp_path / "ix"))
    tokens, tags = artifacts.read_index_artifact(spark, str(tmp_path / "ix"))
    assert {r["token"]: r["ix"] for r in tokens.collect()} == ids
    assert {r["tag"]: r["ix"] for r in tags.collect()} == TAG_MAP


def test_global_index_over_many_slices(spark):
    from textmill.operators.indexing import global_index

    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(13)
    got = [(r["k"], r["ix"]) for r in global_index(df, ["k"], "ix", start=3).orderBy("k").collect()]
    assert [i for _, i in got] == list(range(3, 5003))


def test_encode_decode_and_pad(spark, train, vocab):
    new = spark.createDataFrame([(1, ["c", "?", "a"], ["O"] * 3), (2, [], []), (3, ["a"], ["O"])], SENTENCES)
    coded = tagging.encode_tokens(new, vocab)
    assert {r["ord"]: r["ids"] for r in coded.collect()} == {1: [3, 4, 1], 2: [], 3: [1]}
    got = {r["ord"]: (r["batch"], r["padded"], r["mask"]) for r in tagging.pad_batch(coded, 2).collect()}
    assert got == {
        1: (0, [3, 4, 1], [True] * 3), 2: (0, [0, 0, 0], [False] * 3), 3: (1, [1], [True]),
    }
    bad = spark.createDataFrame([(1, ["a"], ["B-XXX"]), (2, ["a"], ["I-EVT"])], SENTENCES)
    assert [(r["ord"], r["tag_ids"]) for r in tagging.encode_tags(bad, TAG_MAP).collect()] == [(2, [6])]
    assert [r["ord"] for r in tagging.unknown_tags(bad, TAG_MAP).collect()] == [1]
    with pytest.raises(Exception, match="unknown tag"):
        tagging.encode_tags(bad, TAG_MAP, strict=True).collect()
    ids = spark.createDataFrame([([0, 1, 99],)], "ids array<int>")
    assert ids.select(tagging.decode_tags(F.col("ids"), TAG_MAP).alias("t")).first()["t"] == ["O", "B-PROJ", "O"]


def test_large_vocabularies_are_joined_by_shuffle(spark, train, vocab, monkeypatch):
    emissions, transitions = tagging.tag_emissions(train, TAG_MAP), tagging.tag_transitions(train, TAG_MAP)
    small = tagging.tag_viterbi(train, emissions, transitions, TAG_MAP).select("ord", "predicted").collect()
    monkeypatch.setattr(tagging, "MAX_BROADCAST_BYTES", 2)
    assert sorted(tagging.tag_viterbi(train, emissions, transitions, TAG_MAP).select("ord", "predicted").collect()) == sorted(small)
    got = {r["ord"]: r["ids"] for r in tagging.encode_tokens(train, vocab).collect()}
    assert got == {1: [2, 1, 3], 2: [1, 3], 3: []}


def test_score_tables(train):
    emissions = {r["token"]: r["scores"] for r in tagging.tag_emissions(train, TAG_MAP).collect()}
    assert emissions["a"][0] == pytest.approx(math.log(2 / 9)) and emissions["a"][2] == pytest.approx(math.log(2 / 9))
    assert emissions["<UNK>"][0] == pytest.approx(math.log(4 / 12))
    steps = {(r["prev"], r["tag"]): r["score"] for r in tagging.tag_transitions(train, TAG_MAP).collect()}
    assert len(steps) == 56
    assert steps["<START>", "O"] == pytest.approx(math.log(2 / 9))
    assert steps["I-PROJ", "O"] == pytest.approx(math.log(2 / 8))
    assert steps["B-EVT", "O"] == pytest.approx(math.log(1 / 7))


def test_viterbi_against_enumeration():
    rng = np.random.default_rng(5)
    for _ in range(30):
        table, steps = rng.normal(size=(6, 3)), rng.normal(size=(4, 3))
        ids = [rng.integers(0, 6, n) for n in rng.integers(0, 7, 5)]
        for cells in (1, 100):
            for x, path in zip(ids, tagging.best_paths(ids, table, steps, cells)):
                def total(p):
                    return sum(table[t, k] + steps[q, k] for t, k, q in zip(x, p, (3, *p)))

                best = max(itertools.product(range(3), repeat=len(x)), key=total)
                assert tuple(path) == best


def test_taggers_run_on_tables(train):
    emissions = tagging.tag_emissions(train, TAG_MAP)
    greedy = {r["ord"]: r["predicted"] for r in tagging.tag_greedy(train, emissions, TAG_MAP).collect()}
    assert greedy == {1: ["B-PROJ", "O", "O"], 2: ["O", "O"], 3: []}
    steps = tagging.tag_transitions(train, TAG_MAP)
    paths = {r["ord"]: r["predicted"] for r in tagging.tag_viterbi(train, emissions, steps, TAG_MAP).collect()}
    assert paths == {1: ["B-PROJ", "I-PROJ", "O"], 2: ["O", "O"], 3: []}


def test_route(spark):
    data = [("stop now", "a", 0.9), ("hm", "b", 0.9), ("hm", "b", 0.5)]
    df = spark.createDataFrame(data, "text string, predicted string, probability double")
    got = [(r["tier"], r["decision"]) for r in routing.route(df, [("^stop", "halt")], 0.8).collect()]
    assert got == [("rule", "halt"), ("model", "b"), ("escalate", "escalate")]
    assert routing.route(df, [], 0.8).filter("tier = 'rule'").count() == 0
