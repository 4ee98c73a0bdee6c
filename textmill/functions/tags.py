"""Expressions on token and tag lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.text import chars


def zip_to_shorter(tokens: Column, tags: Column) -> Column:
    """Pairs (token, tag), cut to the shorter list; null and empty tokens are left out."""
    n = F.least(F.size(tokens), F.size(tags))
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), n),
        F.slice(tags, F.lit(1), n),
        lambda token, tag: F.struct(token.alias("token"), tag.alias("tag")),
    )
    return F.filter(pairs, lambda p: F.coalesce(p["token"], F.lit("")) != "")


def char_tokens(tokens: Column, tags: Column) -> Column:
    """The characters of all paired tokens: one split of the joined text."""
    n = F.least(F.size(tokens), F.size(tags))
    # Joining skips null tokens and empty ones vanish in it, as in `zip_to_shorter`.
    return chars(F.array_join(F.slice(tokens, F.lit(1), n), ""))


def char_tags(tokens: Column, tags: Column) -> Column:
    """One tag per character of `char_tokens`.

    The first character of a token keeps the tag; those after it turn `B-X` into `I-X`
    and repeat any other tag.
    """

    def spread(pair: Column) -> Column:
        tag, more = pair["tag"], F.length(pair["token"]) - 1
        follow = F.when(
            tag.startswith("B-"), F.concat(F.lit("I-"), F.substring(tag, 3, 2**30))
        ).otherwise(tag)
        return F.concat(F.array(tag), F.array_repeat(follow, more))

    return F.flatten(F.transform(zip_to_shorter(tokens, tags), spread))


def dedupe_key(tokens: Column) -> Column:
    """Tokens joined without a separator; a missing list gives the empty key."""
    return F.coalesce(F.concat_ws("", tokens), F.lit(""))


def render(tokens: Column, tags: Column) -> Column:
    """`[token|tag]` for tagged tokens, the bare token otherwise, joined by spaces."""
    shown = F.zip_with(
        tokens,
        tags,
        lambda token, tag: F.when(tag == "O", token).otherwise(
            F.concat(F.lit("["), token, F.lit("|"), tag, F.lit("]"))
        ),
    )
    return F.array_join(shown, " ")


def argmax(scores: Column) -> Column:
    """0-based index of the greatest score, the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def entity_type(tag: Column) -> Column:
    """`X` of `B-X` or `I-X`."""
    return F.substring(tag, 3, 2**30)


def after_previous(items: Column, first: str) -> Column:
    """Pairs (before, item); `first` stands before the first item."""
    # Shifting and zipping stays linear. Indexing into `items` from inside a lambda would
    # build the list anew for every element wherever the optimizer inlines it.
    n = F.greatest(F.size(items) - 1, F.lit(0))
    shifted = F.concat(F.array(F.lit(first)), F.slice(items, F.lit(1), n))
    pairs = F.zip_with(
        shifted, items, lambda before, item: F.struct(before.alias("before"), item.alias("item"))
    )
    # An empty list would still pair `first` with nothing.
    return F.slice(pairs, F.lit(1), F.size(items))


def bad_transition(tags: Column) -> Column:
    """True if some `I-X` does not follow `B-X` or `I-X`; NULL for a missing list."""

    def breaks(pair: Column) -> Column:
        before, tag = F.coalesce(pair["before"], F.lit("O")), pair["item"]
        continues = before.rlike("^[BI]-") & (entity_type(before) == entity_type(tag))
        return F.coalesce(tag.startswith("I-") & ~continues, F.lit(False))

    return F.exists(after_previous(tags, "O"), breaks)
