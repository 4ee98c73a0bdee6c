import json

import pytest

from textmill.operators import ingest
from textmill.sources import records
from textmill.spec import CONFIRMATION, ENTITIES
from textmill.streaming import ingest as streams

KEYS = ("text", "label")


def test_batch_outcomes_and_records(spark):
    good = {"text": "a", "label": "b"}
    data = [
        (1, json.dumps([good, 3, {"text": "x"}])),
        (2, json.dumps(good)),
        (3, "[" + json.dumps(good)),
        (4, json.dumps([{"text": "x"}])),
        (5, "[]"),
    ]
    df = spark.createDataFrame(data, "batch bigint, payload string")
    got = {r["batch"]: (r["outcome"], r["accepted"]) for r in ingest.batch_outcomes(df, KEYS).collect()}
    assert got == {
        1: ("accepted", 1), 2: ("not_a_list", 0), 3: ("unparsable", 0),
        4: ("no_valid_item", 0), 5: ("no_valid_item", 0),
    }
    rows = ingest.accepted_records(df, KEYS, records.TEXT_RECORD).collect()
    assert [(r.batch, r.pos, r.text, r.label) for r in rows] == [(1, 0, "a", "b")]


def test_quota(spark):
    existing = spark.createDataFrame([("a",)] * 3 + [("b",)] * 10 + [("c",)] * 12, "task string")
    tasks = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "task string")
    plan = ingest.quota(existing, tasks, target=10, per_request=4)
    got = {r["task"]: (r["existing"], r["deficit"], r["requests"]) for r in plan.collect()}
    assert got == {"a": (3, 7, 2), "d": (0, 10, 3)}
    assert ingest.expand_requests(plan).count() == 5


def test_read_records_keeps_file_order_and_rejects(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"text":"1","label":"x"}\n{"text":"2"\n{"text":"3","label":"x","more":1}\n')
    (tmp_path / "b.json").write_text('{"text":"4","label":"é好"}\n' * 50)
    df = records.read_records(spark, str(tmp_path), CONFIRMATION, has_ord=False)
    good, bad = records.split_rejects(df)
    rows = good.orderBy("ord").collect()
    assert [r["text"] for r in rows][:3] == ["1", "3", "4"] and rows[-1]["label"] == "é好"
    assert [r["ord"] for r in rows] == [0, *range(2, 53)]
    assert [r[records.CORRUPT] for r in bad.collect()] == ['{"text":"2"']
    with pytest.raises(Exception, match="FAILFAST"):
        records.read_records(spark, str(tmp_path), CONFIRMATION, strict=True).collect()


def test_wrong_types_are_rejected(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"ord":1,"tokens":["a"],"tags":["O"]}\n{"ord":2,"tokens":"a","tags":["O"]}\n')
    good, bad = records.split_rejects(records.read_records(spark, str(tmp_path), ENTITIES))
    assert [r["ord"] for r in good.collect()] == [1]
    assert good.select("ord").count() == 1
    assert bad.count() == 1


def test_missing_source_is_skipped(spark, tmp_path):
    load = lambda: records.read_records(spark, str(tmp_path / "none"), CONFIRMATION)
    assert records.skip_if_missing(load) is None


def test_write_and_append(spark, tmp_path):
    df = spark.createDataFrame([("t", 1, "好", "x", "train")], "task string, ord bigint, text string, label string, split string")
    records.write_records(df, str(tmp_path / "w"))
    files = list((tmp_path / "w" / "task=t" / "split=train").glob("*.json"))
    assert any("好" in f.read_text() for f in files)
    for _ in range(2):
        records.append_records(df, str(tmp_path / "a"))
    assert spark.read.json(str(tmp_path / "a")).count() == 2


def _payload_file(folder, name, *texts):
    folder.mkdir(exist_ok=True)
    body = json.dumps([{"text": t, "label": "x"} for t in texts])
    (folder / name).write_text(json.dumps({"batch": 1, "payload": body}) + "\n")


def test_stream_takes_each_file_once(spark, tmp_path):
    src, sink, state = tmp_path / "src", str(tmp_path / "sink"), str(tmp_path / "state")

    def ingest_now():
        streams.ingest_stream(spark, str(src), sink, state, KEYS, records.TEXT_RECORD)
        return spark.read.parquet(sink).count()

    _payload_file(src, "1.json", "a", "b")
    assert ingest_now() == 2
    assert ingest_now() == 2
    _payload_file(src, "2.json", "a")
    assert ingest_now() == 3

    unique, seen = str(tmp_path / "unique"), str(tmp_path / "seen")
    schema = spark.read.parquet(sink).schema
    streams.dedupe_stream(spark, sink, unique, seen, schema)
    assert sorted(r["text"] for r in spark.read.parquet(unique).collect()) == ["a", "b"]
    _payload_file(src, "3.json", "b", "c")
    assert ingest_now() == 5
    streams.dedupe_stream(spark, sink, unique, seen, schema)
    assert sorted(r["text"] for r in spark.read.parquet(unique).collect()) == ["a", "b", "c"]
