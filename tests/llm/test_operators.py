"""Every operator against a brute-force version, and on odd rows."""

import random
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from textmill.llm import chat, exact, forest, lines, mixing, packing, quality, secrets, sharding, tokens
from textmill.llm.common import read_table


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def texts_of(df):
    return rows_of(df, "doc_id", "text")


# op1


def check_secrets(df):
    got = {(r["doc_id"], r["base_sha256"]): r for r in secrets.secret_digests(secrets.find_secrets(df)).collect()}
    assert sum(1 for _ in got) <= df.count()
    for doc_id, text in texts_of(df):
        spans = brute.base_spans(text)
        row = got[doc_id, brute.sha(",".join(s for *_, s in spans))]
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == tuple(sum(k == i for _, k, _ in spans) for i in range(3))
        assert set(s for *_, s in spans) <= set(row["spans"].split(","))


def test_secrets(documents, odd, nothing):
    check_secrets(documents)
    check_secrets(odd)
    assert secrets.find_secrets(nothing).count() == 0


def test_long_secrets(spark):
    text = f"ftp://{'u' * 400}:{'p' * 500}@host bearer{' ' * 30}{'x' * 20} -----BEGIN {'A ' * 60}PRIVATE KEY-----"
    spans = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["spans"]
    assert [s["kind"] for s in spans] == ["login", "bearer", "pem"]


def test_patterns_that_fold_case_by_themselves():
    from textmill.llm.trigrams import trigram_query

    assert trigram_query("(?i)kelvin") is True and trigram_query("a(?i:kelvin)") is True
    assert trigram_query("(?ai)kelvin") is not True and trigram_query("kelvin") is not True


def test_secret_edges(spark):
    texts = [
        "PASSWD='abcdef' secret=tok token = \"a.b/c=\" api_key:xxxxxx apikey:12345",
        "AKIAAKIA0000 AKIA" + "Z" * 16 + " AKIA" + "9" * 15,
        "f" * 23 + " " + "0" * 24 + "g" + "abcdef" * 9,
        "é" * 5 + "token=token=abcdef secret: secret: longvalue",
        "paſſword=abcdefgh Key",
        "x" * 300 + "-----BEGIN RSA PRIVATE KEY----- https://u:p@h bearer " + "a" * 20,
    ]
    check_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_trigram_queries():
    from textmill.llm.trigrams import BlockIndex, trigram_query, trigrams_of

    queries = [trigram_query(r.pattern, r.flags) for r in secrets.RULES]
    assert [q is True for q in queries] == [r.kind == "hex" for r in secrets.RULES]
    assert trigram_query("ab(cd|xy)*z+") is True
    assert trigrams_of(trigram_query("abc(d|e)f")) == {b"abc", b"bcd", b"bce", b"cdf", b"cef"}
    index = BlockIndex([b"", b"abcde", b"bcd", b"abc bcd"], {b"abc", b"bcd"})
    assert index.candidates(("and", (b"abc", b"bcd"))).tolist() == [1, 3]
    assert index.candidates(("or", (b"abc", b"bcd"))).tolist() == [1, 2, 3]


# op2


def check_mix(df, near=True):
    mixed = mixing.mix_sources(df)
    got = rows_of(mixed, "doc_id", "source", "size", "source_size", "target", "copies", "taken")
    assert sorted(got, key=repr) == sorted(rows_of(mixing.mix_sources(df.repartition(7)), *mixed.columns), key=repr)
    sizes, most = Counter(), Counter()
    for _, source, text in rows_of(df, "doc_id", "source", "text"):
        sizes[source] += len(brute.words(text))
        most[source] = max(most[source], len(brute.words(text)))
    wanted = brute.targets(sizes)
    taken = Counter()
    for _, source, size, source_size, target, copies, words in got:
        assert source_size == sizes[source] and target == pytest.approx(wanted[source]) and 0 <= copies <= 2 and words == copies * size
        taken[source] += words
    for source in sizes:
        assert abs(taken[source] - wanted[source]) <= (most[source] / 2 if near else most[source] * 2) + 1e-6
    return got


def test_mix(documents, odd, nothing):
    assert len(check_mix(documents)) == documents.count()
    check_mix(odd, near=False)
    assert mixing.mix_sources(nothing).count() == 0


def test_take_copies(documents):
    copies = {i: n for i, n in rows_of(mixing.mix_sources(documents), "doc_id", "copies") if n}
    assert Counter(i for (i,) in rows_of(mixing.take_copies(documents), "doc_id")) == copies


# op3


def test_shards(documents, odd, nothing):
    for df in (documents, odd):
        got = sharding.shard_documents(df).collect()
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
            (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts_of(df)
        )
        slots = defaultdict(list)
        for r in got:
            slots[r["shard"]].append(r["slot"])
            assert 0 <= r["shard"] < 8 and r["grown_shard"] in (r["shard"], 8) and r["law"] == "key"
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(nothing).count() == 0


def test_shard_weights(spark):
    keys = spark.range(20_000).select(F.col("id").alias("doc_id"))
    tree = sharding.topology(8)
    heavy = [sharding.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in tree]
    both = sharding.place(sharding.place(keys, tree, "old"), heavy, "new").collect()
    share = Counter(r["new"] for r in both)
    assert share[5] / 20_000 == pytest.approx(0.3, abs=0.02) and share[0] / 20_000 == pytest.approx(0.1, abs=0.01)
    where = {x.shard: x for x in tree}
    for r in both:
        if r["old"] != r["new"]:  # rows come into the subtree that got heavier, or change places inside its rack or region
            assert where[r["new"]].region == where[5].region
    more = sharding.place(sharding.place(keys, sharding.topology(11), "old"), sharding.topology(12), "new")
    assert more.filter("old <> new AND new <> 11").count() == 0 and more.filter("new = 11").count() > 1000


# op4


def check_chat(df):
    windows = chat.format_conversations(df).cache()
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(windows).collect()}
    assert got == brute.conversations(rows_of(df, "conv_id", "turn", "role", "text"))
    return windows


def test_chat(spark, nothing):
    table = chat.with_extra(read_table(spark, "/root/testdata/sf0.001", "conversations"))
    check_chat(table)
    rows = [(1, 0, "system", "be & <kind>"), (1, None, "user", None), (None, 1, None, "x"), (2, 1, "assistant", "same"), (2, 1, "assistant", "same")]
    rows += [(3, 0, "system", "always </turn> this")] + [(3, i, "assistant" if i % 2 == 0 else "user", f"turn {i} &lt; " + "w " * (i % 90)) for i in range(1, 300)]
    rows += [(4, 0, "user", "long " * 5000), (4, 1, "assistant", "<seen user>&amp;</turn>\n")]
    windows = check_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("tokens", F.lit("x")))
    of3 = windows.filter("conv_id = 3").orderBy("window").collect()
    assert len(of3) > 5 and all(r["tokens"] <= chat.BUDGET for r in of3)
    assert all(r["text"].startswith("<seen system>always &lt;/turn&gt; this</turn>") for r in of3[1:])
    assert any(r["text"].count("<seen ") > 1 for r in of3)
    assert chat.read_back(chat.format_conversations(table.limit(0))).count() == 0


def test_chat_keeps_the_budget(spark):
    def turns(conv, sizes, system):
        sizes = [system, *sizes] if system else sizes
        roles = ["system" if system and i == 0 else ("assistant" if i % 2 else "user") for i in range(len(sizes))]
        return [(conv, i, role, "w " * (n - chat.OVERHEAD)) for i, (role, n) in enumerate(zip(roles, sizes))]

    rng = random.Random(3)
    sizes = {
        1: ([250, 500] * 20, 404), 2: ([700] * 9, 0), 3: ([250, 500] * 20, 0), 4: ([30] * 400, 20), 5: ([900, 5, 5] * 5, 104),
        6: ([20, 30] * 5, 2000), 7: ([rng.randint(4, 600) for _ in range(300)], 50), 8: ([3000, 10, 10], 0),
    }
    df = spark.createDataFrame([r for conv, (s, system) in sizes.items() for r in turns(conv, s, system)], "conv_id long, turn long, role string, text string")
    for name in ("window", "upto", "head", "body", "loss", "_room", "lead_tokens", "seen"):
        df = df.withColumn(name, F.lit("x"))
    windows = check_chat(df).collect()
    for conv, (given, system) in sizes.items():
        own = sorted((r for r in windows if r["conv_id"] == conv), key=lambda r: r["window"])
        for i, r in enumerate(own):
            new, seen = r["text"].count("<turn "), r["text"].count("<seen ")
            assert seen >= (1 if i and system else 0)
            if r["tokens"] > chat.BUDGET:  # one turn that does not fit beside the system turn
                assert new == 1 and seen == (1 if i and system else 0)
                assert system + max(given) > chat.BUDGET
        # Cells and crossing turns: at most two windows for the room of one, and one more.
        room = max(chat.BUDGET - chat.HISTORY - system, 1)
        assert len(own) <= min(2 * (sum(given) + system) / room + 1, len(given) + 1)
    assert all(r["tokens"] <= chat.BUDGET for r in windows if r["conv_id"] in (1, 2, 3, 4, 7))
    assert any(r["text"].count("<seen ") > 1 for r in windows if r["conv_id"] == 4)


# op5


def check_packing(df):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokens.public_path(packing.VOCABULARY))
    want = Counter()
    for doc_id, text in texts_of(df):
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        bounds = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            data = b"".join(i.to_bytes(4, "little") for i in ids[a:b])
            want[doc_id, piece, a, b - a, zlib.crc32(data)] += 1
    got = packing.pack_documents(df).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    inside = defaultdict(list)
    for r in got:
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in inside.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, [*parts[1:], (sum(n for _, n in parts), 0)], strict=True))
        assert sum(n for _, n in parts) <= 1024
    least = -(-sum(n for parts in inside.values() for _, n in parts) // 1024)
    assert len(inside) <= 1.03 * least + 1


def test_packing(documents, odd, nothing):
    check_packing(documents)
    check_packing(odd)
    assert packing.pack_documents(nothing).count() == 0


def test_plan_holds_every_piece():
    import numpy as np

    rng = np.random.default_rng(3)
    for scale in (3, 5000):
        counts = np.concatenate([[0], rng.integers(0, scale, 64)])
        plan = packing.plan_packing(counts, 64)
        assert (sum(n * taken for taken, n in plan) == counts).all()
        assert all((taken * np.arange(65)).sum() <= 64 for taken, _ in plan)
        used, least = sum(n for _, n in plan), -(-int((counts * np.arange(65)).sum()) // 64)
        assert used <= 1.02 * least + 2 + max(0, counts[33:].sum() - least)


def histogram(pairs):
    import numpy as np

    counts = np.zeros(packing.CAPACITY + 1, np.int64)
    for length, n in pairs:
        counts[length] += n
    return counts


@pytest.mark.parametrize(
    "pairs, most",
    [
        ([(100, 1000)], 100),
        ([(402, 2000)], 1000),
        ([(400, 1000), (300, 1000)], 750),
        ([(350, 3000), (330, 3000)], 2250),
        ([(360, 4000), (304, 4000), (200, 10)], 2669),
        ([(1024, 7), (1, 3)], 8),
        ([], 0),
    ],
)
def test_plan_of_repeated_lengths(pairs, most):
    import numpy as np

    counts = histogram(pairs)
    plan = packing.plan_packing(counts)
    assert (sum((n * taken for taken, n in plan), np.zeros_like(counts)) == counts).all()
    assert sum(n for _, n in plan) <= most <= max(most, sum(n for _, n in packing.best_fit(counts, packing.CAPACITY)))


def test_program_is_used_and_no_worse_than_best_fit(documents):
    pieces = packing.cut_pieces(documents).groupBy("length").count().collect()
    counts = histogram([(r["length"], r["count"]) for r in pieces])
    plan, plain = packing.plan_packing(counts), packing.best_fit(counts, packing.CAPACITY)
    least = -(-int((counts * range(packing.CAPACITY + 1)).sum()) // packing.CAPACITY)
    n = sum(n for _, n in plan)
    assert n <= sum(n for _, n in plain) and n <= 1.01 * least + 1
    counts[packing.CAPACITY] = 0
    program = {taken.tobytes() for taken, _ in packing.solve_program(counts, packing.CAPACITY)}
    assert sum(n for taken, n in plan if taken.tobytes() in program) > 0.1 * n


def test_best_fit_puts_equal_pieces_together():
    import numpy as np

    counts = histogram([(500, 3), (250, 5), (24, 1)])
    plan = packing.best_fit(counts, packing.CAPACITY)
    assert (sum(n * taken for taken, n in plan) == counts).all() and sum(n for _, n in plan) == 3
    assert all((taken * np.arange(packing.CAPACITY + 1)).sum() <= packing.CAPACITY for taken, _ in plan)


# op6


def test_token_counts(documents, odd, nothing):
    pieces = tokens.load_pieces(tokens.public_path(tokens.VOCABULARY))
    longest, rarest = max(map(len, pieces)), min(pieces.values())

    def plain(word):
        word = tokens.WORD_START + word
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            n = len(word[end - 1].encode())
            options = [(best[end - 1][0] + n * rarest, best[end - 1][1] - n)]
            for start in range(max(0, end - longest), end):
                if word[start:end] in pieces:
                    options.append((best[start][0] + pieces[word[start:end]], best[start][1] - 1))
            best.append(max(options))
        return -best[-1][1]

    for df in (documents, odd):
        want = Counter()
        for doc_id, text in texts_of(df):
            found = brute.words(text)
            known = {w: plain(w) for w in set(found)}
            want[doc_id, len(found), sum(known[w] for w in found)] += 1
        assert Counter(tuple(r) for r in tokens.count_tokens(df).collect()) == want
    assert tokens.count_tokens(nothing).count() == 0


def test_trie_starts_anew(monkeypatch):
    pieces = {"▁": -1.0, "a": -2.0, "b": -2.5, "ab": -3.0, "▁ab": -3.5}
    words = [w.encode() for w in ("ab", "abab", "aab", "é", "ab", "bbb")]
    whole = [tokens.TokenTrie(pieces).count([[w]])[0] for w in words]
    monkeypatch.setattr(tokens, "MOST_WORDS", 3)
    trie = tokens.TokenTrie(pieces)
    assert [trie.count([[w]])[0] for w in words] == whole and trie.count([words, [], words[:2]]) == [sum(whole), 0, sum(whole[:2])]
    assert len(trie.counts) == 5


# op7


@pytest.mark.parametrize("width", [4, 5])
def test_near_components(documents, width):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in forest.near_components(documents, width=width).collect()}
    assert got == brute.components(texts_of(documents), width)


def test_near_components_odd(odd, nothing):
    got = sorted((tuple(r) for r in forest.near_components(odd).collect()), key=repr)
    by = defaultdict(set)
    for doc_id, n, component, kept in got:
        by[doc_id].add((n, component, kept))
    assert len(got) == odd.count()
    assert by[1] == {(len(brute.shingles(odd.filter("doc_id = 1").first()["text"], 5)), 1, True)}
    assert {c for i in (2, 3) for _, c, _ in by[i]} == {1} and not any(k for i in (2, 3) for *_, k in by[i])
    assert {c for _, c, _ in by[8]} == {7}
    for i in (4, 5, 6):
        assert by[i] == {(0, i, True)}
    assert all(component is None and kept for _, component, kept in by[None])
    assert forest.near_components(nothing).count() == 0


def test_near_group_of_many(spark):
    """A chain of edits and a group of copies with a word changed each."""
    base = [f"w{i}" for i in range(200)]
    rows = [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in range(0, 200)]
    chain = [f"c{i}" for i in range(120)]
    for k in range(40):
        chain = [*chain]
        chain[(7 * k) % 120] = f"d{k}"
        rows.append(" ".join(chain))
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in forest.near_components(df, width=4).collect()}
    assert got == brute.components(list(enumerate(rows)), 4)


def changed(base, words):
    """`base` with the words of `words` at their places."""
    return " ".join(words.get(k, w) for k, w in enumerate(base))


def test_near_pairs_in_a_template(spark):
    """Texts of one template that are not linked (Jaccard 0.72), and pairs among them that are (0.82)."""
    base, places = [f"w{i}" for i in range(203)], range(10, 200, 24)
    rows = [changed(base, {k: f"x{i}k{k}" for k in places}) for i in range(600)]
    for i in range(0, 600, 20):
        rows.append(changed(base, {k: f"x{i}k{k}" if n < 3 else f"y{i}k{k}" for n, k in enumerate(places)}))
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in forest.near_components(df, width=4).collect()}
    assert got == brute.components(list(enumerate(rows)), 4)
    assert len({c for _, c in got.values()}) == 600


def test_near_bridged_groups(spark):
    """Couples of groups of near copies, linked by one pair only, by a forest of few trees: what it misses is joined exactly."""
    places, n, rows = range(5, 200, 30), 300, []
    for g in (6, 7):
        one = [f"g{g}w{i}" for i in range(203)]
        two = changed(one, {k: f"g{g}v{k}" for k in places}).split()
        ends = changed(one, {k: two[k] for k in [*places][:1]}), changed(two, {k: one[k] for k in [*places][-1:]})
        for base, end in zip((one, two), ends, strict=True):
            copies = [changed(base, {(7 * i) % 203: f"g{g}x{i}"}) for i in range(n)]
            rows += [*copies[: n // 2], end, *copies[n // 2 :]]
        x, y = (brute.shingles(e, 4) for e in ends)
        assert 0.8 <= len(x & y) / len(x | y) < 0.83
        x, y = (brute.shingles(t, 4) for t in (ends[0], " ".join(two)))
        assert len(x & y) / len(x | y) < 0.79
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in forest.near_components(df, width=4, trees=4).collect()}
    assert got == {i: i - i % (2 * n + 2) for i in range(len(rows))}


# op8


def digest_of(deduped):
    return {(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in deduped.collect()}


def test_lines(documents):
    want = brute.deduped_lines(texts_of(documents))
    assert digest_of(lines.dedupe_lines(documents)) == {(i, *v) for i, v in want.items()}


def test_lines_of_an_empty_index(spark, odd):
    index = lines.LineIndex(spark)
    index.delete(odd.select("doc_id"))
    got = index.dedupe(odd.select("doc_id", "text")).collect()
    assert len(got) == odd.count() and all(r["n_dropped"] == 0 for r in got)


def test_lines_odd(odd, nothing):
    got = lines.dedupe_lines(odd)
    assert set(got.columns) == {*odd.columns, "n_dropped"} and got.count() == odd.count()
    rows = [r for r in texts_of(odd) if r[0] is not None]
    want = {(i, *v) for i, v in brute.deduped_lines(rows).items()}
    assert digest_of(got.filter("doc_id IS NOT NULL")) == want
    assert got.filter("doc_id IS NULL AND n_dropped > 0").count() == 0
    assert lines.dedupe_lines(nothing).count() == 0


def test_lines_come_back(spark, documents):
    """Insertion in parts equals insertion at once; deletion equals never having inserted."""
    early, late = documents.filter("doc_id < 120"), documents.filter("doc_id >= 100")
    index = lines.LineIndex(spark)
    index.insert(early)
    index.insert(late)
    assert digest_of(index.dedupe(documents)) == digest_of(lines.dedupe_lines(documents))
    index.delete(documents.filter("doc_id % 3 = 0").select("doc_id"))
    rest = documents.filter("doc_id % 3 <> 0")
    assert digest_of(index.dedupe(rest)) == digest_of(lines.dedupe_lines(rest))
    counts = {tuple(r) for r in index.counts.select("h1", "h2", "n_refs", "min_doc", "max_doc").collect()}
    fresh = lines.LineIndex(spark)
    fresh.insert(rest)
    assert counts == {tuple(r) for r in fresh.counts.select("h1", "h2", "n_refs", "min_doc", "max_doc").collect()}


def test_cuckoo_filter():
    import numpy as np

    from textmill.llm.cuckoo import CuckooFilter

    rng = np.random.default_rng(1)
    h1, h2 = rng.integers(-(2**63), 2**63 - 1, (2, 50_000))
    held = CuckooFilter.for_keys(50_000)
    assert held.insert(h1, h2) and held.contains(h1, h2).all()
    other = rng.integers(-(2**63), 2**63 - 1, (2, 50_000))
    assert held.contains(*other).mean() < 0.001
    held.delete(h1[:20_000], h2[:20_000])
    assert held.contains(h1[20_000:], h2[20_000:]).all() and held.contains(h1[:20_000], h2[:20_000]).mean() < 0.001
    again = CuckooFilter.from_bytes(held.to_bytes())
    assert (again.table == held.table).all()
    small = CuckooFilter(16)
    assert not small.insert(h1[:1000], h2[:1000])


# op9


def test_statistics(documents, odd, nothing):
    for df in (documents, odd):
        got = Counter(tuple(r) for r in quality.text_statistics(df.select("doc_id", "text")).select("doc_id", *quality.COUNTS).collect())
        assert got == Counter((i, *brute.statistics(t)) for i, t in texts_of(df))
    assert quality.text_statistics(nothing).count() == 0


def test_decision_list(spark):
    rows = []
    for i in range(900):
        bad = i % 5 == 0
        rows.append({"words": 100.0 + i % 90, "word_length": 5.0, "symbols_per_word": 2.0 if bad and i % 2 else 0.01 * (i % 7), "repeated_lines": 9.0 if bad and i % 2 == 0 else float(i % 3), "repeated_share": 0.0, "bad": int(bad), "prune": i % 3 == 0})
    rules = quality.learn_rules(rows)
    assert 1 <= len(rules) <= 3
    hit = [any(all(c.holds(r) for c in rule) for rule in rules) for r in rows]
    assert all(h == bool(r["bad"]) for h, r in zip(hit, rows, strict=True))
    assert quality.learn_rules([r for r in rows if not r["bad"]]) == [] and quality.learn_rules([]) == []


def test_judge(spark, documents, odd, nothing):
    labels = read_table(spark, "/root/testdata/sf0.01", "labels")
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    judged = quality.judge(docs, labels).join(labels, "doc_id").toPandas()
    assert judged[judged["quality"] == 1]["kept"].mean() > 0.96  # the base rules reject the others
    assert judged[(judged["quality"] == 1) & ~judged["base_failed"]]["kept"].mean() > 0.995
    assert judged[judged["quality"] == 0]["kept"].mean() < 0.5
    none = labels.limit(0)
    assert quality.judge(odd, none).count() == odd.count() and quality.judge(nothing, none).count() == 0
    assert set(quality.judge(odd, none).columns) == {*odd.columns, *quality.COUNTS, "base_failed", "rule", "kept"}
    kept = quality.keep_good(documents, labels)
    assert kept.columns == documents.columns and 0 < kept.count() < documents.count()


# op10


def test_copies(documents, odd, nothing):
    for df in (documents, odd):
        for digest in (exact.sha256_hex, lambda t: F.substring(F.md5(t), 1, 1)):
            got = exact.group_copies(df, digest=digest)
            assert sorted(rows_of(got, "doc_id", "keep_id", "group_size", "text_sha256"), key=repr) == brute.copies(texts_of(df))
            assert got.filter("kept <> (doc_id <=> keep_id)").count() == 0
    assert exact.group_copies(nothing).count() == 0


def test_repeated_labels_and_documents_change_no_sample(spark):
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(12 + i % 5))) for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id bigint, quality int")
    many = spark.range(500).select(F.lit(3).cast("bigint").alias("doc_id"), F.lit(1).alias("quality"))
    copies = spark.range(300).select(F.lit(3).cast("bigint").alias("doc_id"), F.lit(texts[3][1]).alias("text"))
    plain = quality.labelled_sample(docs, labels)
    assert quality.labelled_sample(docs.unionByName(copies), labels.unionByName(many)) == plain
    assert len(plain) == len({r["doc_id"] for r in plain}) == 30
    both = labels.unionByName(labels.withColumn("quality", F.lit(0)))
    assert {r["bad"] for r in quality.labelled_sample(docs, both)} == {1}
    assert quality.labelled_sample(docs.filter("false"), labels) == []
