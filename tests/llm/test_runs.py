"""Periodic runs against a scan of every lag."""

import random
import zlib
from fractions import Fraction

import numpy as np
from brute import sha, words

from textmill.llm import queries, runs
from textmill.llm.common import read_table
from conftest import SF_DIR

A, B, C = b"a", b"b", b"c"


def brute_runs(found):
    """Every stretch that agrees with itself at a lag, unless a shorter lag does too."""
    n, out = len(found), []
    seen = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in found], int)
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        long = edges[1::2] - edges[::2] + q >= max(6, 4 * q)
        for a, b in zip(edges[::2][long], edges[1::2][long]):
            start, length = int(a), int(b - a) + q
            part = ids[start : start + length]
            if not any((part[:-d] == part[d:]).all() for d in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    found = words(text)
    n, h = len(found), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        found = [w if i < a else found[a + (i - a) % p] for i, w in enumerate(found)]
    out = brute_runs(found)
    gone = {i for s, length, q in out for i in range(s + q, s + length)}
    best = min(out, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in out)
    return (doc_id, len(out), *top, sha(listed), sha(" ".join(w for i, w in enumerate(found) if i not in gone)))


def test_random_lists():
    rng = random.Random(4)
    for _ in range(400):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            unit = [rng.choice("abc").encode() for _ in range(rng.randrange(1, 6))]
            parts += unit * rng.randrange(1, 9) + unit[: rng.randrange(len(unit) + 1)]
        found, _ = runs.runs_of([parts, [], parts[:5]], [None] * 3)
        assert found[0] == brute_runs(parts) and found[1] == [] and found[2] == brute_runs(parts[:5])


def test_thresholds():
    one = lambda x: runs.runs_of([x], [None])
    assert one([A] * 5)[0] == [[]] and one([A] * 6) == ([[(0, 6, 1)]], [[A]])
    assert one([A, B] * 3 + [A])[0] == [[]]
    assert one([C] + [A, B] * 4 + [C]) == ([[(1, 8, 2)]], [[C, A, B, C]])
    # Two runs that overlap in words, and a multiple of a period that is no run of its own.
    assert one([A] * 8 + [B] + [A] * 8 + [B])[0] == [[(0, 8, 1), (9, 8, 1)]]
    assert one(([A] * 7 + [B]) * 4)[0] == [[(0, 7, 1), (0, 32, 8), (8, 7, 1), (16, 7, 1), (24, 7, 1)]]


def test_splitting_leaves_only_frequent_words():
    ids = np.array([0, 1, 0, 2, 0, 0, 0, 0, 0, 0, 3, 0, 0, 0, 0])
    assert runs.surviving(ids, np.array([0, len(ids)])) == [(4, 10)]
    assert runs.surviving(np.zeros(12, np.int64), np.array([0, 6, 6, 12])) == [(0, 6), (6, 12)]
    assert runs.surviving(np.zeros(0, np.int64), np.array([0, 0])) == []


def test_long_runs_are_linear():
    """A long text of one word, and one long period: a scan of all pairs of places would not end."""
    found, kept = runs.runs_of([[A] * 300_000, [str(i).encode() for i in range(50_000)] * 5], [None, None])
    assert found == [[(0, 300_000, 1)], [(0, 250_000, 50_000)]] and list(map(len, kept)) == [1, 50_000]


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in read_table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op12_runs(spark, SF_DIR).collect()]
    assert sorted(got) == sorted(brute_row(*d) for d in docs)
    assert sum(r[1] > 0 for r in got) > 10


def test_odd_rows(odd, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    got = [tuple(r) for r in runs.run_digests(runs.periodic_runs(odd, runs.planted)).collect()]
    assert sorted(got, key=repr) == sorted((brute_row(*r) for r in rows), key=repr)
    assert runs.run_digests(runs.periodic_runs(nothing)).count() == 0


def test_text_and_order(spark):
    docs = spark.createDataFrame([(1, "x  y\ty y\ny y y y z"), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in runs.periodic_runs(docs).collect()}
    assert rows[1]["collapsed"] == "x y z" and [tuple(r) for r in rows[1]["runs"]] == [(1, 7, 1)]
    assert rows[2]["collapsed"] == "" and rows[2]["n_words"] == 0 and rows[2]["runs"] == []
    turned = runs.periodic_runs(docs, lambda i, n: np.arange(n)[::-1]).filter("doc_id = 1").first()
    assert turned["collapsed"] == "z y x"
