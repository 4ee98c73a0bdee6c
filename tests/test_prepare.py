"""Dedupe, cleaning, sampling, reports."""

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textmill.functions import tags as tag_fn
from textmill.operators import clean, report, sampling
from textmill.spec import CLASSIFICATION, ENTITIES

RECORD = "task string, ord bigint, text string, label string"
TAGGED = "task string, ord bigint, tokens array<string>, tags array<string>"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_dedupe_exact_keeps_the_first(spark):
    data = [("t", 5, "a", "x"), ("t", 2, "a", "y"), ("t", 3, None, "x"), ("t", 4, None, "x"), ("t", 6, "A", "x"), ("u", 9, "a", "x")]
    df = spark.createDataFrame(data, RECORD)
    kept = clean.dedupe_exact(df, F.col("text"), by=["task"])
    assert [r[1] for r in rows(kept, "task", "ord")] == [2, 3, 6, 9]
    again = clean.dedupe_exact(kept, F.col("text"), by=["task"])
    assert again.count() == 4


def test_dedupe_tagged_shares_the_empty_key(spark):
    data = [("t", 2, None, ["O"]), ("t", 3, [], []), ("t", 4, ["a", "b"], ["O", "O"]), ("t", 1, ["ab"], ["O"])]
    kept = clean.dedupe_tagged(spark.createDataFrame(data, TAGGED), by=["task"])
    assert [r[0] for r in rows(kept, "ord")] == [1, 2]


def test_clean_and_stage_counts(spark):
    data = [
        ("confirmation", 1, " Yes\t ", "Affirm"),
        ("confirmation", 2, " Yes\t ", "Deny"),
        ("confirmation", 3, "   ", "Affirm"),
        ("confirmation", 4, "no", "Unsure"),
        ("confirmation", 5, None, "Deny"),
        ("is_question", 6, "no", "Affirm"),
        ("is_question", 7, "why", "Question"),
    ]
    df = spark.createDataFrame(data, RECORD)
    kept = clean.clean_classified(clean.dedupe_exact(df, F.col("text"), ["task"]), CLASSIFICATION.tasks)
    assert rows(kept, "ord", "text") == [(1, "yes"), (7, "why")]
    counts = {r["task"]: r.asDict() for r in clean.stage_counts(df, CLASSIFICATION.tasks).collect()}
    assert counts["confirmation"] == {"task": "confirmation", "loaded": 5, "removed_duplicates": 1, "removed_invalid": 3, "kept": 1}
    assert counts["is_question"]["kept"] == 1


def test_clean_tagged_skips_missing_lists(spark):
    data = [("t", 1, ["ab"], ["B-X"]), ("t", 2, None, ["O"]), ("t", 3, ["a"], None)]
    got = clean.clean_tagged(spark.createDataFrame(data, TAGGED)).collect()
    assert [(r.ord, r.tokens, r.tags) for r in got] == [(1, ["a", "b"], ["B-X", "I-X"])]


def _records(spark, counts, parts=4):
    data, i = [], 0
    for label, n in counts.items():
        for _ in range(n):
            data.append(("t", i, f"text {i}", label))
            i += 1
    return spark.createDataFrame(data, RECORD).repartition(parts)


def _plain_rank(df, seed, n_of):
    import hashlib

    groups = {}
    for r in df.collect():
        groups.setdefault(r["label"], []).append((hashlib.md5(f"{seed}|{r['ord']}".encode()).hexdigest(), r["ord"]))
    return {o for label, keys in groups.items() for _, o in sorted(keys)[: n_of(label)]}


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_undersample_equals_plain_ranking(spark, parts):
    df = _records(spark, {"a": 700, "b": 301}, parts)
    got = {r["ord"] for r in sampling.undersample(df, "s").collect()}
    assert got == _plain_rank(df, "s", lambda _: 301)


def test_one_label_may_hold_nearly_all_rows(spark):
    df = _records(spark, {"a": 20_000, "b": 3})
    picked = sampling.undersample(df, "s").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in picked} == {"a": 3, "b": 3}


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_split_stratified(spark, parts):
    df = _records(spark, {"a": 7, "b": 3}, parts)
    split = sampling.split_stratified(df, 0.25, "s").collect()
    assert len(split) == 10
    counts = Counter((r["split"], r["label"]) for r in split)
    assert sum(n for (s, _), n in counts.items() if s == "test") == 3
    assert counts[("train", "a")] == 5 and counts[("train", "b")] == 2
    want = _plain_rank(df, "s", lambda x: {"a": 5, "b": 2}[x])
    assert {r["ord"] for r in split if r["split"] == "train"} == want


def test_split_random_is_complete_and_exact(spark):
    df = _records(spark, {"a": 101})
    split = sampling.split_random(df, 0.2, "s").collect()
    assert Counter(r["split"] for r in split) == {"train": 80, "test": 21}
    assert len({r["ord"] for r in split}) == 101


def test_too_small_class_is_refused(spark):
    counts = sampling.class_counts(_records(spark, {"a": 9, "b": 1}))
    with pytest.raises(ValueError, match="too small"):
        sampling.check_splittable(counts, 0.2, ["task"])
    fine = sampling.class_counts(_records(spark, {"a": 9, "b": 9}))
    sampling.check_splittable(fine, 0.2, ["task"])


def test_sample_n(spark):
    df = _records(spark, {"a": 50})
    assert sampling.sample_n(df, 7, "s").count() == 7
    assert sampling.sample_n(df, 70, "s").count() == 50


def test_quality_reports(spark):
    df = _records(spark, {"a": 3, None: 2})
    assert rows(report.quality_report(df).filter("key is not null"), "section", "key", "value") == [("label", "a", 3), ("rows", "total", 5)]
    assert report.quality_report(df).filter("key is null").first()["value"] == 2
    tagged = spark.createDataFrame([("t", 1, ["a", "b"], ["O", "B-X"]), ("t", 2, [], [])], TAGGED)
    assert rows(report.quality_report_tags(tagged), "section", "key", "value") == [
        ("rows", "total", 2), ("tag", "B-X", 1), ("tag", "O", 1),
    ]


def test_label_order_and_weights(spark):
    df = _records(spark, {"b": 2, "a": 2, "c": 5})
    assert [r["label"] for r in report.label_counts(df).collect()] == ["c", "a", "b"]
    weights = {r["label"]: (r["weight"], r["min_rows"]) for r in report.class_weights(df).collect()}
    assert weights["c"] == (9 / 15, 2) and weights["a"] == (1.5, 2)


def test_contracts_tags(spark):
    data = [
        ("t", 1, ["a", "b"], ["B-PROJ", "I-PROJ"]),
        ("t", 2, ["ab"], ["I-EVT"]),
        ("t", 3, ["c"], ["B-XXX"]),
        ("t", 4, ["c"], ["O"]),
        ("t", 5, list("lengthy"), None),
    ]
    df = spark.createDataFrame(data, TAGGED)
    got = {r["check"]: r for r in report.contracts_tags(df, ENTITIES.tag_map).collect()}
    assert {c: r["violations"] for c, r in got.items()} == {
        "equal_lengths": 1, "known_tags": 2, "tag_order": 2, "single_characters": 1,
        "share_without_entity": 0, "sentence_length": 4, "unique": 2, "all_types_occur": 2,
    }
    assert got["share_without_entity"]["value"] == 0.2 and got["share_without_entity"]["passed"]


def test_contracts_text(spark):
    data = [("t", 1, "好", "a"), ("t", 2, "好", "b"), ("t", 3, "x", "a"), ("t", 4, "y好", "a")]
    df = spark.createDataFrame(data, RECORD)
    got = {r["check"]: (r["violations"], r["value"]) for r in report.contracts_text(df, "Han").collect()}
    assert got == {"unique": (1, 0.25), "balanced": (0, 3.0), "script": (1, 0.25)}


def test_ner_statistics(spark):
    df = spark.createDataFrame([("t", 1, ["a", "b"], ["B-X", "I-X"]), ("t", 2, ["c"], ["O"])], TAGGED)
    got = {r["key"]: r["value"] for r in report.ner_statistics(df).collect()}
    assert got["X"] == 1 and got["share_without_entity"] == 0.5 and got["median_length"] == 1.5


def test_clean_tagged_against_expressions(spark, monkeypatch):
    monkeypatch.setattr(clean, "TOKENS", 5)
    rows = [
        (1, "t", ["ab", None, "", "é😀x"], ["B-X", "O", "B-Y", "B-Z"]),
        (2, "t", ["abc", "d"], ["I-X"]),
        (3, "t", ["ab"], ["O", "B-X"]),
        (4, "t", ["ab", "cd", "e"], [None, "B-", "odd"]),
        (5, "t", [], []),
        (6, None, ["a"], []),
        (7, "t", None, ["O"]),
        (8, "t", ["a"], None),
        (None, "t", ["\u0000a", "B"] * 9, ["B-B-", "b-x"] * 9),
    ]
    df = spark.createDataFrame(rows, "ord bigint, task string, tokens array<string>, tags array<string>").repartition(2)
    both = df.filter("tokens is not null and tags is not null")
    pair = F.col("tokens"), F.col("tags")
    want = both.select("ord", "task", tag_fn.char_tokens(*pair).alias("tokens"), tag_fn.char_tags(*pair).alias("tags"))
    got = clean.clean_tagged(df)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert clean.clean_tagged(df.limit(0)).count() == 0
    assert "transform" not in got._jdf.queryExecution().executedPlan().toString()


def test_few_tokens_are_cut_at_a_time():
    rows = [["abcdef"] * 400] * 300 + [["ab"] * 50_000, []]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string())), pa.array([["O"] * len(r) for r in rows], pa.list_(pa.string()))], ["tokens", "tags"])
    parts = list(clean._parts(batch))
    assert sum(p.num_rows for p in parts) == 302
    cut = [clean._characters(*p.columns) for p in parts]
    assert sum(len(tokens.flatten()) for tokens, _ in cut) == 300 * 2_400 + 100_000
    assert all(p.num_rows == 1 or tokens.nbytes + tags.nbytes < 2 << 20 for p, (tokens, tags) in zip(parts, cut))
