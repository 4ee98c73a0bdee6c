"""Streamed outcomes and rejects, restarts included."""

import json

import pytest

from textmill.operators import ingest
from textmill.sources import records
from textmill.streaming import outcomes

KEYS = ("text", "label")
GOOD = {"text": "a", "label": "b"}
PAYLOADS = [
    json.dumps([GOOD, 3, {"text": "x"}, GOOD]), json.dumps(GOOD), "[" + json.dumps(GOOD), "[]", "", None,
    json.dumps([{"text": "long " * 20_000, "label": None}]), json.dumps([{}]),
]


def _files(folder, payloads, start=0):
    folder.mkdir(exist_ok=True)
    for n, payload in enumerate(payloads, start):
        (folder / f"{n:03d}.json").write_text(json.dumps({"batch": n, "payload": payload}) + "\n")


def _run(spark, tmp_path):
    outcomes.ingest_outcomes_stream(
        spark, str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "state"), KEYS, records.TEXT_RECORD, 3
    )


def _stored(spark, tmp_path, sink, *columns):
    rows = spark.read.parquet(f"{tmp_path}/out/{sink}").select(*columns).collect()
    return sorted((tuple(r) for r in rows), key=str)


def _check(spark, tmp_path, payloads):
    df = spark.createDataFrame(list(enumerate(payloads)), "batch bigint, payload string")
    plain = sorted((tuple(r) for r in ingest.batch_outcomes(df, KEYS).collect()), key=str)
    assert _stored(spark, tmp_path, "outcomes", "batch", "outcome", "accepted") == plain
    taken = _stored(spark, tmp_path, "records", "batch", "pos")
    assert len(taken) == sum(r[2] for r in plain)
    assert taken == sorted(((r["batch"], r["pos"]) for r in ingest.accepted_records(df, KEYS, records.TEXT_RECORD).collect()), key=str)


def test_sinks_agree_with_the_batch_operators(spark, tmp_path):
    _files(tmp_path / "src", PAYLOADS)
    _run(spark, tmp_path)
    _check(spark, tmp_path, PAYLOADS)
    assert _stored(spark, tmp_path, "rejects", "batch", "pos", "reason") == sorted(
        [
            (0, 1, "missing_keys"), (0, 2, "missing_keys"), (1, None, "not_a_list"), (2, None, "unparsable"),
            (4, None, "unparsable"), (5, None, "unparsable"), (7, 0, "missing_keys"),
        ],
        key=str,
    )
    _files(tmp_path / "src", [PAYLOADS[0]], start=len(PAYLOADS))
    for _ in range(2):
        _run(spark, tmp_path)
    _check(spark, tmp_path, [*PAYLOADS, PAYLOADS[0]])


@pytest.mark.parametrize("broken", outcomes.SINKS)
def test_restart_between_sinks(spark, tmp_path, monkeypatch, broken):
    _files(tmp_path / "src", PAYLOADS[:4])
    write = outcomes._write

    def fail_after(df, root, sink, epoch):
        write(df, root, sink, epoch)
        if sink == broken and epoch == 1:
            raise RuntimeError("lost")

    monkeypatch.setattr(outcomes, "_write", fail_after)
    with pytest.raises(Exception, match="lost"):
        _run(spark, tmp_path)
    monkeypatch.setattr(outcomes, "_write", write)
    _run(spark, tmp_path)
    _check(spark, tmp_path, PAYLOADS[:4])
