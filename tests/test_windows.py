"""Counts of windows and words against the lists of them."""

import random

import pytest
from pyspark.sql import functions as F

from textmill.functions import text as text_fn
from textmill.operators import features, windows

WIDE = "".join(chr(0x4E00 + i) for i in range(6000))
TEXTS = ["aa  bb\taa\n\n x", "", None, " ", "a", "İSTANBUL ß \u0000 b\u0000 \u0000", "😀😀 a😀b c", WIDE, WIDE[:500] * 2, "aa bb cc"]
DOCS = "ord bigint, text string"


@pytest.mark.parametrize("points", [7, 1 << 20])
def test_counts_against_lists(spark, monkeypatch, points):
    monkeypatch.setattr(windows, "POINTS", points)
    draw = random.Random(1)
    rows = [*enumerate(TEXTS), (50, "".join(draw.choice("ab c") for _ in range(2000)))]
    # A repeated or missing `ord` is one document.
    for more in ([], [(9, "aa bb"), (None, "zz zz"), (None, "zz")]):
        df = spark.createDataFrame(rows + more, DOCS).repartition(3)
        for grams in (features.FIT_GRAMS, features.SERVE_GRAMS):
            got = {(r["ord"], r["block"], r["term"]): r["tf"] for r in features.term_counts(df, grams).collect()}
            want = {}
            for block, fn in grams.items():
                listed = df.select("ord", fn(F.col("text")).alias("terms")).collect()
                for r in listed:
                    for term in r["terms"] or []:
                        want[r["ord"], block, term] = want.get((r["ord"], block, term), 0) + 1
                sums = features.corpus_stats(features.term_sums(df, block, fn)).collect()
                found = [(t, n) for (_, b, t), n in want.items() if b == block]
                totals = {}
                for term, n in found:
                    tf, documents = totals.get(term, (0, 0))
                    totals[term] = tf + n, documents + 1
                assert {r["term"]: (r["tf"], r["df"]) for r in sums} == totals
            assert got == want


def test_no_grouping_by_document(spark):
    """The n-grams of a task's documents are not grouped in one table, which does not fit at scale."""
    df = spark.createDataFrame([(1, "aa bb")], DOCS)
    for plan in (features.term_counts(df, {"char": text_fn.char_ngrams}), features.term_sums(df, "char", text_fn.char_ngrams)):
        assert "HashAggregate" not in plan._jdf.queryExecution().executedPlan().toString()
