"""Text normalisation and n-gram arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space plus the four ASCII separators that Python also counts.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
#: Maximal runs of two or more letters, digits or underscores.
WORD = r"[\p{L}\p{N}_]{2,}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def normalize_text(text: Column) -> Column:
    """Lower-case, collapse white-space runs to one space, strip."""
    return F.trim(F.regexp_replace(F.lower(text), WHITESPACE_RUN, " "))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def word_ngrams(text: Column) -> Column:
    """Words followed by the pairs of neighbouring words."""

    def with_pairs(w: Column) -> Column:
        n_pairs = F.greatest(F.size(w) - 1, F.lit(0))
        pairs = F.zip_with(
            F.slice(w, F.lit(1), n_pairs),
            F.slice(w, F.lit(2), n_pairs),
            lambda a, b: F.concat_ws(" ", a, b),
        )
        return F.concat(w, pairs)

    return let(words(text), with_pairs)


def _windows(text: Column, body: str) -> Column:
    # The look-ahead captures a window, the final "." moves on by one code point, so
    # windows overlap and the scan stays linear in the length of the text.
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=({body}))."), F.lit(1))


def char_ngrams(text: Column, low: int = 2, high: int = 5) -> Column:
    """All character windows of the whole lower-cased text, spaces included."""
    return let(
        F.lower(text),
        lambda t: F.concat(*[_windows(t, f".{{{n}}}") for n in range(low, high + 1)]),
    )


def padded_words(text: Column) -> Column:
    """The normalised text; every word owns a space on both sides, so what crosses words holds two spaces."""
    return F.concat(F.lit(" "), F.replace(normalize_text(text), F.lit(" "), F.lit("  ")), F.lit(" "))


def char_wb_ngrams(text: Column, low: int = 2, high: int = 5) -> Column:
    """Character windows inside each word padded with one space on both sides."""
    bodies = [f"(?:(?!  ).){{{n - 1}}}." for n in range(low, high + 1)]
    return let(padded_words(text), lambda t: F.concat(*[_windows(t, b) for b in bodies]))


def chars(text: Column) -> Column:
    """The text as a list of characters (code points)."""
    empty = F.array().cast("array<string>")
    return F.when(text == "", empty).otherwise(F.split(text, ""))


def rows_of(items: Column) -> Column:
    """Generator of the list's elements, plus a NULL row for an empty list.

    A plain `explode` makes the optimizer add a filter on the list's size, which it
    pushes down to where the list is computed, so that it is computed twice. Callers drop
    the NULL rows instead.
    """
    return F.explode_outer(items)
