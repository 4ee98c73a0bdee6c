import pytest

from textmill.functions import payload, tags, text

LISTS = "tokens array<string>, tags array<string>"


@pytest.mark.parametrize(
    "raw, want",
    [
        ("　 Ab C \t\n d", "ab c d"),
        ("A\x1c\x1fB", "a b"),
        ("İ", "i̇"),
        ("", ""),
        ("    ", ""),
        (None, None),
    ],
)
def test_normalize(one, raw, want):
    assert one(text.normalize_text, "text string", raw) == want


def test_words_and_bigrams(one):
    assert one(text.words, "text string", "A été 不是的, x_1 b") == ["été", "不是的", "x_1"]
    assert one(text.word_ngrams, "text string", "one two three") == [
        "one", "two", "three", "one two", "two three",
    ]
    assert one(text.word_ngrams, "text string", "single") == ["single"]
    assert one(text.word_ngrams, "text string", "") == []


def test_char_wb_ngrams(one):
    got = one(text.char_wb_ngrams, "text string", "不 ok")
    assert sorted(got) == sorted([" 不", "不 ", " 不 ", " o", "ok", "k ", " ok", "ok ", " ok "])
    assert one(text.char_wb_ngrams, "text string", "  ") == []


@pytest.mark.parametrize("raw", ["", "a", "ab", "a bC😀e", "x" * 30])
def test_char_ngrams_against_slices(one, raw):
    low = raw.lower()
    want = [low[i : i + n] for n in range(2, 6) for i in range(len(low) - n + 1)]
    assert one(text.char_ngrams, "text string", raw) == want


@pytest.mark.parametrize("raw", ["Hello  big World", "a", "不是 的", "one\ttwo"])
def test_char_wb_against_slices(one, raw):
    want = []
    for word in raw.lower().split():
        w = f" {word} "
        for n in range(2, 6):
            want += [w[i : i + n] for i in range(len(w) - n + 1)]
    assert sorted(one(text.char_wb_ngrams, "text string", raw)) == sorted(want)


def _bio(one, tokens, tag_list):
    return list(
        zip(
            one(tags.char_tokens, LISTS, tokens, tag_list),
            one(tags.char_tags, LISTS, tokens, tag_list),
            strict=True,
        )
    )


def test_char_bio(one):
    assert _bio(one, ["ab", "c"], ["B-X", "O"]) == [("a", "B-X"), ("b", "I-X"), ("c", "O")]
    assert _bio(one, ["ab", "cd"], ["O", "I-X"]) == [("a", "O"), ("b", "O"), ("c", "I-X"), ("d", "I-X")]
    assert _bio(one, ["a", "b", "c"], ["O", "B-X"]) == [("a", "O"), ("b", "B-X")]
    assert _bio(one, ["a😀"], ["B-X"]) == [("a", "B-X"), ("😀", "I-X")]
    assert _bio(one, ["", None, "a"], ["B-X", "B-Y", "O"]) == [("a", "O")]
    assert _bio(one, [], []) == []


def test_rendering_and_keys(one):
    got = one(tags.render, LISTS, ["a", "b"], ["O", "B-X"])
    assert got == "a [b|B-X]"
    assert one(tags.dedupe_key, "tokens array<string>", None) == ""
    assert one(tags.dedupe_key, "tokens array<string>", ["a", None, "b"]) == "ab"


@pytest.mark.parametrize(
    "tag_list, bad",
    [
        (["I-X"], True),
        (["O", "I-X"], True),
        (["B-X", "I-Y"], True),
        (["B-X", "I-X", "I-X", "O"], False),
        ([], False),
        (None, None),
    ],
)
def test_bad_transition(one, tag_list, bad):
    assert one(tags.bad_transition, "tags array<string>", tag_list) is bad


def test_argmax_takes_the_first(one):
    assert one(tags.argmax, "s array<double>", [1.0, 3.0, 3.0]) == 1


@pytest.mark.parametrize(
    "body, items",
    [
        ('[{"text":"a"}, 3, [1]]', ['{"text":"a"}', "3", "[1]"]),
        ('{"text":"a"}', None),
        ("7", None),
        ('[{"text":"a"}', None),
        ("[]", []),
    ],
)
def test_payload_items(one, body, items):
    assert one(payload.payload_items, "p string", body) == items


@pytest.mark.parametrize(
    "item, ok",
    [
        ('{"text":"a","label":"b"}', True),
        ('{"text":null,"label":null}', True),
        ('{"text":"a","label":"b","more":1}', True),
        ('{"text":"a"}', False),
        ("3", False),
        ("[1]", False),
    ],
)
def test_has_keys(one, item, ok):
    assert one(lambda i: payload.has_keys(i, ("text", "label")), "i string", item) is ok
