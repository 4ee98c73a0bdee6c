"""Batches against a ledger of keys."""

import random

from pyspark.sql import functions as F

from textmill.operators import clean
from textmill.operators.ledger import KeyLedger

ROWS = "ord bigint, text string"


def _frame(spark, rows):
    return spark.createDataFrame(rows, ROWS).withColumn("batch", F.lit("clash"))


def _ords(df):
    return sorted(r["ord"] for r in df.collect())


def test_batches_equal_one_run(spark, tmp_path):
    draw = random.Random(6)
    rows = [(i, draw.choice([None, "", "hot", "x" * 50_000, f"t{draw.randint(0, 60)}"])) for i in range(400)]
    ledger = KeyLedger(spark, str(tmp_path / "ledger"), 4)
    taken = []
    for batch, start in enumerate(range(0, 400, 100)):
        taken += _ords(ledger.admit(_frame(spark, rows[start : start + 100]), F.col("text"), batch))
    whole = clean.dedupe_exact(spark.createDataFrame(rows, ROWS), F.col("text"))
    assert sorted(taken) == _ords(whole)
    assert ledger.rows().count() == ledger.rows().select("key").distinct().count() == len(taken)


def test_a_batch_given_again(spark, tmp_path):
    ledger = KeyLedger(spark, str(tmp_path / "ledger"), 4)
    one, two = _frame(spark, [(1, "a"), (2, "b"), (3, "a")]), _frame(spark, [(4, "b"), (5, "c")])
    assert _ords(ledger.admit(one, F.col("text"), 1)) == [1, 2]
    assert _ords(ledger.admit(two, F.col("text"), 2)) == [5]
    assert _ords(ledger.admit(one, F.col("text"), 1)) == [1, 2]
    assert _ords(ledger.admit(two, F.col("text"), 2)) == [5]
    assert _ords(ledger.admit(one.filter("false"), F.col("text"), 3)) == []
    assert ledger.rows().count() == 3


def test_half_a_batch_was_written(spark, tmp_path):
    ledger = KeyLedger(spark, str(tmp_path / "ledger"), 4)
    rows = [(i, f"t{i}") for i in range(20)]
    ledger.admit(_frame(spark, rows[:9]), F.col("text"), 1)
    assert _ords(ledger.admit(_frame(spark, rows), F.col("text"), 1)) == list(range(20))


def test_another_session_keeps_the_buckets(spark, tmp_path):
    path = str(tmp_path / "ledger")
    KeyLedger(spark, path, 4).admit(_frame(spark, [(1, "a")]), F.col("text"), 1)
    other = spark.newSession()
    other.sql(f"DROP TABLE {KeyLedger(spark, path)._table}")
    again = KeyLedger(other, path, 7)
    assert again.buckets == 4 and again.rows().count() == 1
    assert _ords(again.admit(_frame(other, [(2, "a"), (3, "b")]), F.col("text"), 2)) == [3]


def test_the_ledger_does_not_move(spark, tmp_path):
    ledger = KeyLedger(spark, str(tmp_path / "ledger"), 4)
    for batch in range(2):
        ledger.admit(_frame(spark, [(i, f"t{i}") for i in range(batch * 9, batch * 9 + 12)]), F.col("text"), batch)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed = spark.createDataFrame([("k", 1)], "key string, ord bigint")
        plan = ledger.unseen(keyed)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert "REPARTITION_BY_NUM" in plan
