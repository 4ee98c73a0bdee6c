import json

import pytest

from textmill.operators import clean
from textmill.plans import jobs
from textmill.sources import records
from textmill.spec import CLASSIFICATION, CONFIRMATION, ENTITIES, TAGGING


def _payloads(folder, items, per_file=20):
    folder.mkdir(parents=True)
    for n in range(0, len(items), per_file):
        body = json.dumps(items[n : n + per_file], ensure_ascii=False)
        (folder / f"{n:05d}.json").write_text(json.dumps({"batch": n, "payload": body}) + "\n")


def test_classification_job(spark, tmp_path):
    """Payload files to stored models and batch predictions; one task has no input."""
    items = []
    for i in range(60):
        items.append({"text": f"Yes please {i} do it", "label": "Affirm"})
        if i < 40:
            items.append({"text": f"No {i} never that", "label": "Deny"})
    items += [{"text": "Yes please 1 do it", "label": "Affirm"}, {"text": "?", "label": "Other"}, {"text": "x"}]
    _payloads(tmp_path / "payloads" / CONFIRMATION.name, items)
    root = str(tmp_path)
    done = jobs.run(spark, CLASSIFICATION, root, date="20240101")
    assert done["ingest"] == {"confirmation": "done", "is_question": "skipped"}
    assert done["refine"] == "done"
    assert done["train"]["is_question"] == "skipped" and done["export"]["is_question"] == "skipped"
    report = {r["class"]: r for r in done["train"]["confirmation"].collect()}
    assert report["accuracy"]["support"] == 16 and report["accuracy"]["f1"] == 1.0

    split = spark.read.json(f"{root}/processed").groupBy("split", "label").count().collect()
    assert {(r["split"], r["label"]): r["count"] for r in split} == {
        ("train", "Affirm"): 32, ("train", "Deny"): 32, ("test", "Affirm"): 8, ("test", "Deny"): 8,
    }
    removed = {r["task"]: r for r in spark.read.json(f"{root}/reports/removed_20240101").collect()}
    # The item without a label never became a record.
    assert {c: removed["confirmation"][c] for c in ("loaded", "removed_duplicates", "removed_invalid", "kept")} == {
        "loaded": 102, "removed_duplicates": 1, "removed_invalid": 1, "kept": 100,
    }
    lines = [r["value"] for r in spark.read.text(f"{root}/reports/confirmation_quality_report_20240101").collect()]
    assert lines[0].startswith("# confirmation") and "| rows | total | 100 |" in lines

    new = spark.createDataFrame([(1, "yes please"), (2, "never that"), (3, "")], "ord bigint, text string")
    got = {r["ord"]: r["predicted"] for r in jobs.predict_texts(new, f"{root}/models", CONFIRMATION).collect()}
    assert got[1] == "Affirm" and got[2] == "Deny" and got[3] in CONFIRMATION.labels


def test_tagging_job(spark, tmp_path):
    items = []
    for i in range(50):
        items.append({"tokens": ["ab", "z", str(i)], "tags": ["B-PROJ", "O", "O"]})
    items.append({"tokens": "broken", "tags": ["O"]})
    _payloads(tmp_path / "payloads" / ENTITIES.name, items)
    root = str(tmp_path)
    done = jobs.run(spark, TAGGING, root)
    report = {r["class"]: r["f1"] for r in done["train"][ENTITIES.name].collect()}
    assert report["B-PROJ"] == 1.0 and report["I-PROJ"] == 1.0
    assert done["export"] == {ENTITIES.name: "done"}
    new = spark.createDataFrame([(1, "abz")], "ord bigint, text string")
    got = jobs.predict_tags(new, f"{root}/models", ENTITIES).first()
    assert got["predicted"] == ["B-PROJ", "I-PROJ", "O"]


def test_steps(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown steps"):
        jobs.run(spark, TAGGING, str(tmp_path), steps=("refine", "bake"))
    assert jobs.run(spark, TAGGING, str(tmp_path), steps=("refine",)) == {"refine": "skipped"}


def test_refine_stops_when_nothing_is_left(spark):
    df = spark.createDataFrame([("confirmation", 1, " ", "Affirm")], "task string, ord bigint, text string, label string")
    assert jobs.refine(df, CLASSIFICATION) is None


def test_near_duplicates_on_request(spark):
    base = "the quick brown fox jumps over the lazy dog again and again " * 4
    data = [("confirmation", i, base + ("." if i == 1 else ""), "Affirm") for i in range(2)]
    data += [("confirmation", 10 + i, f"other words {i * 7919} {i * 104729} here", label) for i, label in enumerate(["Affirm", "Deny"] * 4)]
    df = spark.createDataFrame(data, "task string, ord bigint, text string, label string")
    plain = jobs.refine(df, CLASSIFICATION).cleaned.count()
    fewer = jobs.refine(df, CLASSIFICATION, near_duplicates=True).cleaned.count()
    assert (plain, fewer) == (10, 9)


def test_removed_rows_equal_their_own_pass(spark):
    data = [("confirmation", i, text, label) for i, (text, label) in enumerate(
        [(None, "Affirm"), (None, "Deny"), ("", "Deny"), ("a", "Affirm"), ("a", "Deny"), ("b", "Other"), ("b", "Deny"), ("c", None)]
        + [(f"t{i}", ("Affirm", "Deny")[i % 2]) for i in range(20)]
    )]
    data += [("is_question", 100 + i, "?", "Other") for i in range(3)]
    df = spark.createDataFrame(data, "task string, ord bigint, text string, label string")
    got = {tuple(r) for r in jobs.refine(df, CLASSIFICATION).removed.collect()}
    columns = ("task", "loaded", "removed_duplicates", "removed_invalid", "kept")
    plain = clean.stage_counts(df, CLASSIFICATION.tasks).select(*columns)
    assert got == {tuple(r) for r in plain.collect()} and ("is_question", 3, 2, 1, 0) in got


def test_written_records_are_compressed(spark, tmp_path):
    rows = spark.createDataFrame([(1, ["a", "b"] * 500, ["O", "I-PROJ"] * 500, "t", "train")], "ord bigint, tokens array<string>, tags array<string>, task string, split string")
    records.write_records(rows, str(tmp_path / "out"))
    files = [p for p in (tmp_path / "out").rglob("part-*")]
    assert files and sum(p.stat().st_size for p in files) < 2_000
    assert spark.read.schema(rows.schema).json(str(tmp_path / "out")).collect() == rows.collect()
