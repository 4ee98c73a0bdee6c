"""Boolean trigram queries of regular expressions, and a trigram index over a block of texts.

A query is True (every text may match), a trigram of three
bytes, or a tuple ("and" | "or", parts). It is derived from the parsed expression by
the strings that each part must begin with, end with or be (Cox, 2012). All letters are in
lower case, in queries and in the index.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from re import _constants as ops
from re import _parser as parser

import numpy as np

#: Sets of strings of a part that grow beyond this are given up for what they imply.
MOST_STRINGS = 48
Query = bool | bytes | tuple


def both(a: Query, b: Query) -> Query:
    return b if a is True else a if b is True or a == b else ("and", (a, b))


def either(a: Query, b: Query) -> Query:
    return True if a is True or b is True else a if a == b else ("or", (a, b))


def containing(strings: set[bytes]) -> Query:
    """The query for texts with at least one of the strings."""
    query: Query | None = None
    for s in sorted(strings):
        one: Query = True
        for i in range(len(s) - 2):
            one = both(one, s[i : i + 3])
        query = one if query is None else either(query, one)
    return True if query is None else query


@dataclass
class Part:
    """What is known of the strings that a part of an expression matches."""

    exact: set[bytes] | None = None
    prefix: set[bytes] = field(default_factory=lambda: {b""})
    suffix: set[bytes] = field(default_factory=lambda: {b""})
    query: Query = True

    def ends(self) -> tuple[set[bytes], set[bytes]]:
        return (self.exact, self.exact) if self.exact is not None else (self.prefix, self.suffix)

    def demand(self) -> Query:
        prefix, suffix = self.ends()
        return both(self.query, both(containing(prefix), containing(suffix)))


def _cross(a: set[bytes], b: set[bytes]) -> set[bytes] | None:
    return {x + y for x in a for y in b} if len(a) * len(b) <= MOST_STRINGS else None


def _then(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None and (strings := _cross(a.exact, b.exact)) is not None:
        return Part(exact=strings)
    (a_pre, a_suf), (b_pre, b_suf) = a.ends(), b.ends()
    middle = _cross(a_suf, b_pre)
    query = both(both(a.query, b.query), containing(middle) if middle is not None else both(containing(a_suf), containing(b_pre)))
    prefix = _cross(a.exact, b_pre) if a.exact is not None else a_pre
    suffix = _cross(a_suf, b.exact) if b.exact is not None else b_suf
    return Part(None, prefix or a_pre, suffix or b_suf, both(query, containing(prefix or a_pre)))


def _or(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None and len(a.exact | b.exact) <= MOST_STRINGS:
        return Part(exact=a.exact | b.exact)
    (a_pre, a_suf), (b_pre, b_suf) = a.ends(), b.ends()
    few = len(a_pre | b_pre) <= MOST_STRINGS and len(a_suf | b_suf) <= MOST_STRINGS
    return Part(None, a_pre | b_pre if few else {b""}, a_suf | b_suf if few else {b""}, either(a.demand(), b.demand()))


def _char(code: int) -> Part:
    return Part(exact={chr(code).lower().encode() if code < 128 else chr(code).encode()})


def _class(items: list) -> Part:
    codes: set[int] = set()
    for op, value in items:
        if op is ops.LITERAL:
            codes.add(value)
        elif op is ops.RANGE and value[1] - value[0] < 8:
            codes.update(range(value[0], value[1] + 1))
        else:
            return Part()
    strings = set().union(*[_char(c).exact for c in codes])
    return Part(exact=strings) if len(strings) <= 8 else Part()


def _sequence(nodes) -> Part:
    out = Part(exact={b""})
    for op, value in nodes:
        out = _then(out, _node(op, value))
    return out


def _node(op, value) -> Part:
    if op is ops.LITERAL:
        return _char(value)
    if op is ops.IN:
        return _class(value)
    if op is ops.AT or op in (ops.ASSERT, ops.ASSERT_NOT):
        return Part(exact={b""})
    if op is ops.SUBPATTERN:
        return _sequence(value[3])
    if op is ops.ATOMIC_GROUP:
        return _sequence(value)
    if op is ops.BRANCH:
        parts = [_sequence(p) for p in value[1]]
        out = parts[0]
        for p in parts[1:]:
            out = _or(out, p)
        return out
    if op in (ops.MAX_REPEAT, ops.MIN_REPEAT, ops.POSSESSIVE_REPEAT):
        least, most, inner = value
        part = _sequence(inner)
        if least == most == 1:
            return part
        if least == 0:
            return _or(Part(exact={b""}), part) if most == 1 else Part()
        return Part(None, *part.ends(), part.demand())
    return Part()


def trigram_query(pattern: str, flags: int = 0) -> Query:
    """The query that every text with a match fulfils, True if there is none.

    Ignoring case needs re.ASCII, as the index folds ASCII letters only; a pattern that asks for more by flags of its own has no query.
    """
    if flags & re.IGNORECASE and not flags & re.ASCII:
        raise ValueError("a pattern that ignores case must be ASCII")
    parsed = parser.parse(pattern, flags)
    if not parsed.state.flags & re.ASCII and (parsed.state.flags & re.IGNORECASE or _folds_inside(parsed)):
        return True
    return _sequence(parsed).demand()


def _folds_inside(item) -> bool:
    """Whether a part of a parsed pattern ignores case by flags of its own, as in (?i:...)."""
    if isinstance(item, parser.SubPattern):
        return any(_folds_inside(x) for x in item)
    if not isinstance(item, tuple | list):
        return False
    own = len(item) == 2 and str(item[0]) == "SUBPATTERN" and bool(item[1][1] & re.IGNORECASE)
    return own or any(_folds_inside(x) for x in item)


def trigrams_of(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set() if query is True else set().union(*[trigrams_of(q) for q in query[1]])


class BlockIndex:
    """Postings of the given trigrams over a block of texts in lower case."""

    def __init__(self, texts: list[bytes], wanted: set[bytes]):
        self.n = len(texts)
        data = np.frombuffer(b"\xff\xff".join([*texts, b""]), np.uint8)  # \xff is in no text
        codes = data[:-2].astype(np.uint32)
        codes <<= 8
        codes |= data[1:-1]
        codes <<= 8
        codes |= data[2:]
        slot = np.zeros(1 << 24, np.uint8) if len(wanted) < 255 else np.zeros(1 << 24, np.uint16)
        order = sorted(wanted)
        for i, gram in enumerate(order, 1):
            slot[int.from_bytes(gram)] = i
        hits = slot[codes]
        at = np.flatnonzero(hits)
        starts = np.cumsum([0] + [len(t) + 2 for t in texts])
        owner = np.searchsorted(starts, at, side="right") - 1
        pairs = np.unique(hits[at].astype(np.int64) * max(self.n, 1) + owner)
        grams, docs = np.divmod(pairs, max(self.n, 1))
        self.postings = {g: docs[grams == i] for i, g in enumerate(order, 1)}

    def candidates(self, query: Query) -> np.ndarray:
        """Numbers of the texts that fulfil the query, in order."""
        if query is True:
            return np.arange(self.n)
        if isinstance(query, bytes):
            return self.postings[query]
        lists = [self.candidates(q) for q in query[1]]
        out = lists[0]
        for other in lists[1:]:
            out = np.intersect1d(out, other, assume_unique=True) if query[0] == "and" else np.union1d(out, other)
        return out
