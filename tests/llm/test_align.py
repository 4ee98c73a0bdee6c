"""Token alignment against whole texts and all pairs of tokens."""

import hashlib
import json
import random
from collections import Counter, defaultdict
from functools import cache
from pathlib import Path

import numpy as np
import pytest
from conftest import SF_DIR
from tokenizers import Tokenizer

from textmill.llm import align, queries
from textmill.llm.common import read_table
from textmill.llm.tokens import public_path

STRANGE = [
    "a <|endoftext|> b </s><s><unk> c", "x▁y", "a▁ b", "tab\tand  two spaces \n line", " lead", "trail ", "\x00 nul", "é ü 漢字かな 😀👍🏽 z",
    "it's they'll 'twas", "1234567 8.9e-10 ...!!!", "　wide　space", "\x1c x \x1c", "<0x41> <0x0A>", "a" * 3000, "ab " * 2000, "漢字" * 2000,
]


@pytest.fixture(scope="module")
def pair():
    return align.tokenizer_pair(public_path(align.FIRST), public_path(align.SECOND))


@cache
def named():
    """The first vocabulary by its own library."""
    model = Tokenizer.from_file(public_path(align.FIRST))
    model.encode_special_tokens = True
    return model


def whole(pair, text):
    """Tokens of the whole text as `(id, from, to)` of both sides, None if there are none."""
    if not text:
        return None
    ids = [named().encode(" " + text, add_special_tokens=False).ids, pair.second.encode(text)]
    spans = []
    for side, table in zip(ids, pair.bytes):
        at, out = 0, []
        for i in side:
            out.append((i, at, at + len(table[i])))
            at += len(table[i])
        spans.append(out)
    joined = [b"".join(table[i] for i in side) for side, table in zip(ids, pair.bytes)]
    return spans if joined == [(" " + text).encode()] * 2 else None


def brute(pair, texts):
    """Rows of texts, in order."""
    found = []
    for text in texts:
        spans = whole(pair, text)
        if spans is None:
            found.append(None)
            continue
        a, b = spans
        ends = sorted({t for *_, t in a} & {t for *_, t in b})
        groups, i, k = [], 0, 0
        for end in ends:
            x, y = [], []
            while i < len(a) and a[i][2] <= end:
                x.append(a[i][0])
                i += 1
            while k < len(b) and b[k][2] <= end:
                y.append(b[k][0])
                k += 1
            groups.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
        links, start = [], 0
        for x, low, high in a:
            while start < len(b) and b[start][2] <= low:
                start += 1
            j = start
            while j < len(b) and b[j][1] < high:
                links.append((x, b[j][0]))
                j += 1
        found.append((len(a), len(b), groups, links))
    counts = Counter(p for x in found if x for p in set(x[3]))
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    rows = []
    for x in found:
        if x is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = x
        best = sum(counts[p] == most[p[0]] for p in links)
        rows.append((n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), ";".join(groups)))
    return rows


def rows_of(df):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return sorted(((r["doc_id"], *(r[c] for c in names)) for r in df.collect()), key=repr)


def spelt(pair, text):
    parts = align.split_parts(text.encode())
    distinct = list(dict.fromkeys(parts))
    spelling = pair.spell(distinct)
    return pair.tokens(spelling, np.array([distinct.index(p) for p in parts])), spelling.right.all()


def test_parts_encode_like_whole_texts(spark, pair):
    texts = [r["text"] for r in read_table(spark, SF_DIR, "documents").select("text").collect()] + STRANGE
    for text in texts:
        spans = whole(pair, text)
        tokens, right = spelt(pair, text)
        assert right == (spans is not None), text
        if spans:
            assert [tokens.a.tolist(), tokens.b.tolist()] == [[i for i, *_ in side] for side in spans]


def test_merges_out_of_order(tmp_path):
    file = json.loads(Path(public_path(align.FIRST)).read_text(encoding="utf-8"))
    merges = file["model"]["merges"]
    merges[0], merges[1] = merges[1], merges[0]
    (tmp_path / "v.json").write_text(json.dumps(file), encoding="utf-8")
    with pytest.raises(ValueError, match="order"):
        align.rank_encoding(str(tmp_path / "v.json"))


def test_composition_is_associative(pair):
    rng = random.Random(1)
    text = "Zürich's tokenizers' 漢字 straddle-boundaries, antidisestablishmentarianism 😀 " * 3
    tokens, _ = spelt(pair, text)
    total = int(tokens.a_end[-1])
    want = align.START.then(align.Fragment.of(tokens, pair.names), pair.names)
    opened = 0
    for _ in range(60):
        cuts = sorted({0, total, *(rng.randrange(total) for _ in range(rng.randrange(0, 40)))})
        parts = [align.Fragment.of(tokens.between(a, b), pair.names) for a, b in zip(cuts, cuts[1:])]
        opened += sum(not p.cut or len(p.suffix.a) > 0 for p in parts)
        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            parts[i : i + 2] = [parts[i].then(parts[i + 1], pair.names)]
        got = align.START.then(parts[0], pair.names)
        assert (got.n_a, got.n_b, got.n_groups, got.closed) == (want.n_a, want.n_b, want.n_groups, want.closed)
        assert (got.pairs == want.pairs).all() and (got.times == want.times).all() and len(got.suffix.a) == len(got.suffix.b) == 0
    assert opened > 100


def test_odd_rows(odd, nothing, pair):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    want = brute(pair, [t for _, t in rows])
    assert rows_of(align.align_tokens(odd)) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=repr)
    assert align.align_tokens(nothing).count() == 0


@pytest.mark.parametrize("most, ranges", [(40, {}), (0, {"long_bytes": 20, "span_chars": 15, "range_bytes": 7, "fan": 2}), (1 << 20, {"long_bytes": 500, "span_chars": 60, "range_bytes": 200, "fan": 3})])
def test_rare_pairs_and_long_documents(spark, pair, most, ranges):
    """Counts that are not broadcast, and documents in many fragments, give what whole documents give."""
    rng = random.Random(2)
    words = "the tokenizers' straddle Zürich antidisestablishmentarianism 漢字 of and 12345 x😀".split()
    texts = STRANGE[:12] + [" ".join(rng.choices(words, k=rng.randrange(1, 120))) for _ in range(30)] + [None, "", "漢字" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = brute(pair, texts)
    assert rows_of(align.align_tokens(docs, most_broadcast=most, **ranges)) == sorted(((i, *w) for i, w in enumerate(want)), key=repr)


def test_whole_table(spark, pair):
    docs = [(r["doc_id"], r["text"]) for r in read_table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    want = brute(pair, [t for _, t in docs])
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest() if x else ""
    got = [(r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in queries.op11_align(spark, SF_DIR).collect()]
    assert sorted(got) == sorted((i, *w[:-1], sha(w[-1])) for (i, _), w in zip(docs, want))
    assert np.mean([r[1] > 0 for r in got]) > 0.9
