"""Periodic runs of words by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q, at least `REPEATS` periods and `LEAST_WORDS`
words long, that no neighbouring word extends. Every word of a run occurs at least `REPEATS` times in it,
so a word that is rarer than that within its segment of a text lies in no run and splits the segment. The
parts are counted anew and split again until all words of all segments are frequent enough, for all texts of a
block at once. Ordinary prose leaves next to nothing. What survives is scanned lag by lag: a run with
period q holds `REPEATS` equal words at multiples of q, so a lag costs the segment's length over q, and only where
such anchors agree is the stretch followed word by word.

Python runs on Arrow blocks inside the tasks; nothing is shuffled, and a text never leaves its task.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import blocks

#: Periods and words that a run has at least.
REPEATS, LEAST_WORDS = 4, 6
#: Bytes of text of a block, or a single longer text.
BLOCK_BYTES = 4 << 20

Run = tuple[int, int, int]  # start, length, period


def surviving(ids: np.ndarray, bounds: np.ndarray, repeats: int = REPEATS, least: int = LEAST_WORDS) -> list[tuple[int, int]]:
    """Segments `(from, to)` of word ids, inside the texts that `bounds` separates, whose words all occur `repeats` times in them."""
    at = np.arange(len(ids))
    segment = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    n_words = int(ids.max(initial=0)) + 1
    while len(at):
        _, key, count = np.unique(segment * n_words + ids[at], return_inverse=True, return_counts=True)
        frequent = count[key] >= repeats
        if frequent.all():
            break
        at, segment = at[frequent], segment[frequent]
        opens = np.ones(len(at), bool)
        opens[1:] = (np.diff(at) != 1) | (np.diff(segment) != 0)
        segment = np.cumsum(opens) - 1
        long = np.bincount(segment, minlength=1)[segment] >= least
        at, segment = at[long], segment[long]
    first = np.flatnonzero(np.diff(segment, prepend=-1))
    last = np.append(first[1:], len(at))[: len(first)] - 1
    return [(int(a), int(b) + 1) for a, b in zip(at[first], at[last], strict=True) if b - a + 1 >= least]


def _matches(x: np.ndarray, y: np.ndarray) -> int:
    """How many first elements agree, looking at blocks of growing length."""
    at, width, n = 0, 64, min(len(x), len(y))
    while at < n:
        differ = x[at : at + width][: n - at] != y[at : at + width][: n - at]
        if differ.any():
            return at + int(differ.argmax())
        at, width = at + len(differ), 2 * width
    return n


def lag_scan(words: np.ndarray, repeats: int = REPEATS, least: int = LEAST_WORDS) -> list[Run]:
    """All runs of a segment.

    A stretch that agrees with itself at lag q and lies in a run whose period divides q is that run and is
    passed over; by the theorem of Fine and Wilf no other shorter period is possible at this length.
    """
    n, runs, holding = len(words), [], []
    for lag in range(1, n // repeats + 1):
        anchors = words[::lag]
        same = anchors[1:] == anchors[:-1]
        hits = same[: len(same) - repeats + 2].copy()
        for i in range(1, repeats - 1):
            hits &= same[i : len(same) - repeats + 2 + i]
        starts = np.flatnonzero(hits) * lag
        if not len(starts):
            continue
        span = (repeats - 1) * lag
        # Runs that are too short to hold the anchors of this lag hold none of a longer one either.
        holding = [r for r in holding if r[1] > span]
        for start, length, period in holding:
            if lag % period == 0:
                starts = starts[(starts < start) | (starts + span >= start + length)]
        at = 0
        while at < len(starts):
            anchor = int(starts[at])
            after = _matches(words[anchor : n - lag], words[anchor + lag :])
            before = _matches(words[:anchor][::-1], words[lag : anchor + lag][::-1])
            run = (anchor - before, before + after + lag, lag)
            # Anchors may also agree by chance beyond the end of a run with a shorter period.
            known = any(lag % p == 0 and s <= run[0] and run[0] + run[1] <= s + n_run for s, n_run, p in holding)
            if run[1] >= max(least, repeats * lag) and not known:
                runs.append(run)
                holding.append(run)
            at = int(np.searchsorted(starts, anchor + after, side="left"))
    return runs


def runs_of(lists: list[list[bytes]], order: list[np.ndarray | None]) -> tuple[list[list[Run]], list[list[bytes]]]:
    """Runs by start and period, and the words outside repetitions, of each list of words, read in the given order."""
    flat = pa.array(chain.from_iterable(lists), pa.binary())
    ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    lists = list(lists)
    for i, new in enumerate(order):
        if new is not None:
            ids[bounds[i] : bounds[i + 1]] = ids[bounds[i] : bounds[i + 1]][new]
            lists[i] = [lists[i][j] for j in new.tolist()]
    found: list[list[Run]] = [[] for _ in lists]
    for a, b in surviving(ids, bounds):
        text = int(np.searchsorted(bounds, a, side="right")) - 1
        shift = a - int(bounds[text])
        found[text] += [(s + shift, n, q) for s, n, q in lag_scan(ids[a:b])]
    kept = []
    for words, runs in zip(lists, found, strict=True):
        runs.sort(key=lambda r: (r[0], r[2]))
        if runs:
            drop = np.zeros(len(words), bool)
            for start, length, period in runs:
                drop[start + period : start + length] = True
            words = [w for w, gone in zip(words, drop.tolist(), strict=True) if not gone]
        kept.append(words)
    return found, kept


def periodic_runs(docs: DataFrame, reorder: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """`(doc_id, n_words, runs array<struct<start, length, period>>, collapsed)`, one row per row of `docs`.

    Words are runs of characters other than \\x20 and \\x09-\\x0D, numbered from 0 and compared as they stand. `runs`
    are in the order of start and period; `collapsed` are the words that no run holds after its first period,
    joined by one space. `reorder(doc_id, n_words)` may give the places of the words to read instead, one for each word.

    A null or empty text, or one of white space, has no words, no runs and collapses to the empty string. Very long texts are
    one block each. Rows that repeat a doc_id, or have none, are treated like all others; an empty table
    gives no row. Only doc_id and text are read, so other columns may have any name.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    names = ["doc_id", "n_words", "runs", "collapsed"]

    def detect(batches):
        for batch in batches:
            for ids, texts in blocks(batch.column(0), batch.column(1), BLOCK_BYTES):
                lists = [(t or b"").split() for t in texts]
                order = [reorder(i, len(words)) if reorder else None for i, words in zip(ids, lists, strict=True)]
                found, kept = runs_of(lists, order)
                rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found]
                columns = [
                    pa.array(ids, pa.int64()),
                    pa.array([len(words) for words in lists], pa.int64()),
                    pa.array(rows, pa.list_(run)),
                    pa.array([b" ".join(words) for words in kept], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    return rows.mapInArrow(detect, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The order that makes one in ten texts periodic from some word on, by the CRC-32 of its decimal doc_id."""
    import zlib

    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    places = np.arange(n)
    places[start:] = start + (places[start:] - start) % period
    return places


def run_digests(found: DataFrame) -> DataFrame:
    """The run of the greatest exponent and digests of `periodic_runs`.

    Exponents are compared as exact fractions; of equal ones the smallest start, then the smallest period counts.
    """
    run = F.struct(*[F.lit(None).cast("long").alias(c) for c in ("start", "length", "period")])
    higher = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    # Runs come by start and period, so an equal exponent never replaces an earlier run.
    best = F.reduce("runs", run, lambda top, x: F.when(top["start"].isNull() | higher(x, top), x).otherwise(top))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("_best"), sha(F.array_join(lines, "")).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"))
    exponent = F.expr("1000 * _best.length div _best.period")
    return rows.select("doc_id", "n_runs", "_best.start", "_best.length", "_best.period", exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
