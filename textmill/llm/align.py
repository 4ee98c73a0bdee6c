"""Alignment of two tokenizers' tokens by an associative monoid of fragments.

Both tokenizers spell the same bytes: a space and the text. A fragment is what a byte range knows: the tokens of
both sides that end in it, cut at the offsets where both sides end. What lies before the first common end is its open
prefix, what comes after the last one its open suffix, and the groups between are closed. Fragments of neighbouring
ranges compose: an open suffix and the open prefix after it become one closed group. Composition is associative, so
the fragments of a very long document, made by many tasks, are reduced in a tree; a shorter document is one fragment.

A text is tokenized in parts: neither tokenizer has a token across a single space between two other characters (the
first starts a pre-token there, the second has no piece with a space after another character), so each
distinct part of a block is encoded and aligned once, and a very long text in spans that end at such spaces.

Pairs of ids that some document links are counted over the whole corpus. The most frequent ones, at most
`MOST_BROADCAST`, go to every task as one sorted table; each of the others is in fewer documents than any of those,
so that a join by shuffle has no hot key.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import blocks
from textmill.llm.tokens import public_path
from textmill.runtime import materialize

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text of a block, or a single longer text.
BLOCK_BYTES = 4 << 20
#: Bytes from which a document is cut into spans of at least so many characters, whose fragments cover ranges of so many bytes.
LONG_BYTES, SPAN_CHARS, RANGE_BYTES = 1 << 16, 1 << 15, 1 << 14
#: Fragments that one step of the tree composes, about.
FAN = 16
#: Id pairs whose counts are sent to every task.
MOST_BROADCAST = 1 << 20
#: Parts that the second tokenizer takes as one line.
LINE_PARTS = 64
#: Ids are below this, so that two of them make one number.
WIDTH = 1 << 20
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_LEVELS = 8


def _byte_level() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def rank_encoding(path: str):
    """The byte-level BPE vocabulary of a `tokenizers` file as ranks, which encodes several times faster.

    The ids are the same if each merge makes the id after that of the merge before it and bytes come first, which is checked
    for every entry. The pattern of pre-tokens is the one of `ByteLevel` with its regex. Special tokens are left out.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as lines:
        file = json.load(lines)
    model, back = file["model"], _byte_level()
    special = {t["content"] for t in file["added_tokens"]}
    decode = lambda token: bytes(back[c] for c in token)
    ranks = {decode(token): i for token, i in model["vocab"].items() if token not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if sorted(ranks.values()) != list(range(len(ranks))) or any(ranks[decode(x + y)] != 256 + i for i, (x, y) in enumerate(merges)):
        raise ValueError(f"the merges of {path} are not in the order of their ids")
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


def ragged(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places `first[i]` to `first[i] + n[i] - 1` of all i, one after the other."""
    upto = np.cumsum(n)
    return np.repeat(first - upto + n, n) + np.arange(upto[-1] if len(n) else 0)


@dataclass
class Spelling:
    """Both sides' ids of some parts: a part's ids are `n` ones from `first` on. `right`: they spell a space and the part."""

    ids: list[np.ndarray]
    first: list[np.ndarray]
    n: list[np.ndarray]
    right: np.ndarray


class TokenizerPair:
    """Ids of text parts by both tokenizers, and the bytes of all ids."""

    def __init__(self, first: str, second: str):
        import sentencepiece

        self.first, ranks = rank_encoding(first)
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        self.bytes = [[b""] * len(ranks), [self._piece(i) for i in range(self.second.get_piece_size())]]
        for token, rank in ranks.items():
            self.bytes[0][rank] = token
        if max(map(len, self.bytes)) > WIDTH:
            raise ValueError(f"vocabularies have at most {WIDTH} ids")
        self.sizes = [np.array(list(map(len, table)), np.int64) for table in self.bytes]
        # Decimal ids with what may follow them in the text of groups.
        self.names = np.array([f"{i}{end}" for end in (",", "|", ";") for i in range(max(map(len, self.bytes)))], dtype=object)

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, side: int, parts: list[str]) -> np.ndarray:
        """Ids of `parts`, each after a space, one after the other; all but one part alone must begin and end with other characters."""
        if side == 0:
            return np.array(self.first.encode_ordinary(" " + " ".join(parts)), np.int64)
        lines = [" ".join(parts[i : i + LINE_PARTS]) for i in range(0, len(parts), LINE_PARTS)]
        return np.fromiter(chain.from_iterable(self.second.encode(lines, num_threads=1)), np.int64)

    def _alone(self, side: int, parts: list[str], raw: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        ids = [self.encode(side, [p]) for p in parts]
        return ids, np.array([b"".join(map(self.bytes[side].__getitem__, x.tolist())) == r for x, r in zip(ids, raw, strict=True)], bool)

    def spell(self, parts: list[str]) -> Spelling:
        """Both sides' ids of distinct parts: of most of them in one call, of those with white space at an end by themselves."""
        plain = np.array([p == p.strip() and p != "" and "▁" not in p for p in parts], bool)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        raw = [b" " + parts[i].encode() for i in order]
        n_plain = int(plain.sum())
        simple, odd = [parts[i] for i in order[:n_plain]], [parts[i] for i in order[n_plain:]]
        bounds, joined = np.cumsum([0, *map(len, raw[:n_plain])]), b"".join(raw[:n_plain])
        spelling = Spelling([], [], [], np.ones(len(parts), bool))
        for side in (0, 1):
            ids = self.encode(side, simple) if simple else np.zeros(0, np.int64)
            ends = np.concatenate([[0], np.cumsum(self.sizes[side][ids])])
            upto = np.searchsorted(ends, bounds)
            right = np.ones(len(order), bool)
            if b"".join(map(self.bytes[side].__getitem__, ids.tolist())) != joined or (ends[upto] != bounds).any():
                lists, right[:n_plain] = self._alone(side, simple, raw[:n_plain])
                ids, upto = np.concatenate(lists), np.cumsum([0, *map(len, lists)])
            lists, right[n_plain:] = self._alone(side, odd, raw[n_plain:])
            upto = np.concatenate([upto, len(ids) + np.cumsum([len(x) for x in lists], dtype=np.int64)])
            first, n = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
            first[order], n[order] = upto[:-1], np.diff(upto)
            spelling.ids.append(np.concatenate([ids, *lists]))
            spelling.first.append(first)
            spelling.n.append(n)
            spelling.right[order] &= right
        return spelling

    def tokens(self, spelling: Spelling, codes: np.ndarray) -> Tokens:
        """Tokens of the parts `codes`, one after the other."""
        a, b = (ids[ragged(first[codes], n[codes])] for ids, first, n in zip(spelling.ids, spelling.first, spelling.n, strict=True))
        return Tokens(a, np.cumsum(self.sizes[0][a]), b, np.cumsum(self.sizes[1][b]))


@cache
def tokenizer_pair(first: str, second: str) -> TokenizerPair:
    """One per worker process, kept from task to task."""
    return TokenizerPair(first, second)


@dataclass
class Tokens:
    """Ids of both sides with the byte offsets of their ends."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def between(self, low: int, high: int) -> Tokens:
        """Those that end after `low` and not after `high`."""
        i, j = np.searchsorted(self.a_end, [low, high], side="right")
        k, m = np.searchsorted(self.b_end, [low, high], side="right")
        return Tokens(self.a[i:j], self.a_end[i:j], self.b[k:m], self.b_end[k:m])

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate([getattr(self, f), getattr(other, f)]) for f in ("a", "a_end", "b", "b_end")))


NONE = Tokens(*[np.zeros(0, np.int64)] * 4)


def overlaps(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The common ends of both sides, the ends of the stretches that no end of a token cuts, and the id pair over each stretch.

    Every overlap of two tokens is one stretch. A pair is `a * WIDTH + b`.
    """
    if not len(tokens.a) and not len(tokens.b):
        return (np.zeros(0, np.int64),) * 3
    low = min(x[0] for x in (tokens.a_end, tokens.b_end) if len(x))
    mark = np.zeros(max(x[-1] for x in (tokens.a_end, tokens.b_end) if len(x)) - low + 1, np.uint8)
    mark[tokens.a_end - low] = 1
    mark[tokens.b_end - low] += 2
    at = np.flatnonzero(mark)
    mark = mark[at]
    a, b = np.cumsum(mark & 1) - (mark & 1), np.cumsum(mark >> 1) - (mark >> 1)
    # Stretches after the last end of a side lie in a token that ends later.
    inside = (a < len(tokens.a)) & (b < len(tokens.b))
    return at[mark == 3] + low, at[inside] + low, tokens.a[a[inside]] * WIDTH + tokens.b[b[inside]]


def group_texts(tokens: Tokens, common: np.ndarray, names: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The parts of the groups' text in order, and how many of them come before each group and at the end."""
    size = len(names) // 3
    group = np.concatenate([2 * np.searchsorted(common, tokens.a_end), 2 * np.searchsorted(common, tokens.b_end) + 1])
    order = np.argsort(group, kind="stable")
    group, ids = group[order], np.concatenate([tokens.a, tokens.b])[order]
    last = np.append(group[1:] != group[:-1], True)[: len(group)]
    follow = np.where(last, 1 + group % 2, 0)
    return names[ids + follow * size].tolist(), np.searchsorted(group, 2 * np.arange(len(common) + 1))


@dataclass
class Fragment:
    """A byte range of one document: open prefix, closed groups, open suffix. Without a common end all tokens are prefix."""

    n_a: int
    n_b: int
    cut: bool
    prefix: Tokens
    suffix: Tokens
    n_groups: int
    closed: str  # each group ends with a semicolon
    pairs: np.ndarray  # sorted, each once
    times: np.ndarray

    @classmethod
    def of(cls, tokens: Tokens, names: np.ndarray) -> Fragment:
        common, none = overlaps(tokens)[0], np.zeros(0, np.int64)
        if not len(common):
            return cls(len(tokens.a), len(tokens.b), False, tokens, NONE, 0, "", none, none)
        inner = tokens.between(common[0], common[-1])
        texts, _ = group_texts(inner, common[1:], names)
        pairs, times = np.unique(overlaps(inner)[2], return_counts=True)
        far = np.iinfo(np.int64).max
        return cls(len(tokens.a), len(tokens.b), True, tokens.between(-1, common[0]), tokens.between(common[-1], far), len(common) - 1, "".join(texts), pairs, times)

    def then(self, other: Fragment, names: np.ndarray) -> Fragment:
        """The fragment of both ranges; `other` comes right after."""
        n_a, n_b = self.n_a + other.n_a, self.n_b + other.n_b
        if not self.cut:
            return Fragment(n_a, n_b, other.cut, self.prefix + other.prefix, other.suffix, other.n_groups, other.closed, other.pairs, other.times)
        if not other.cut:
            return Fragment(n_a, n_b, True, self.prefix, self.suffix + other.prefix, self.n_groups, self.closed, self.pairs, self.times)
        middle = self.suffix + other.prefix
        common, _, links = overlaps(middle)
        text = "".join(group_texts(middle, common, names)[0])
        found = np.concatenate([self.pairs, links, other.pairs])
        times = np.concatenate([self.times, np.ones(len(found) - len(self.pairs) - len(other.pairs), np.int64), other.times])
        pairs, at = np.unique(found, return_inverse=True)
        total = np.bincount(at, weights=times, minlength=len(pairs)).astype(np.int64)
        return Fragment(n_a, n_b, True, self.prefix, other.suffix, self.n_groups + 1 + other.n_groups, self.closed + text + other.closed, pairs, total)


#: What a document starts with: the common end at offset 0.
START = Fragment(0, 0, True, NONE, NONE, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))


def split_parts(text: bytes | None) -> list[str]:
    """A text between its single spaces; none if it is empty or no UTF-8."""
    try:
        return _SAFE.split(text.decode()) if text else []
    except UnicodeDecodeError:
        return []


def align_block(pair: TokenizerPair, texts: list[bytes | None], form: Callable[[str], str]) -> list[tuple]:
    """`(n_a, n_b, n_groups, n_links, groups, pairs, times)` of each text.

    A part is a closed fragment, made once for all its places in the block; a text is composed of those of its parts.
    """
    none = np.zeros(0, np.int64)
    out: list[tuple] = [(0, 0, 0, 0, "", none, none)] * len(texts)
    split = [split_parts(t) for t in texts]
    coded = pa.array(chain.from_iterable(split), pa.large_string()).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(split)), [len(parts) for parts in split])
    spelling = pair.spell(coded.dictionary.to_pylist())
    wrong = np.zeros(len(split), bool)
    wrong[owner[~spelling.right[codes]]] = True
    codes, owner = codes[~wrong[owner]], owner[~wrong[owner]]
    if not len(codes):
        return out
    used, codes = np.unique(codes, return_inverse=True)
    tokens = pair.tokens(spelling, used)
    common, ends, links = overlaps(tokens)
    part_ends = tokens.a_end[np.cumsum(spelling.n[0][used]) - 1]
    names, before = group_texts(tokens, common, pair.names)
    upto = [np.searchsorted(x, part_ends, side="right") for x in (tokens.a_end, tokens.b_end, common, ends)]
    counted = [np.diff(x, prepend=0) for x in upto]
    bounds = [0, *before[upto[2]].tolist()]
    written = ["".join(names[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
    found = links[ragged(upto[3][codes] - counted[3][codes], counted[3][codes])]
    space = WIDTH * WIDTH
    keys, times = np.unique(np.repeat(owner, counted[3][codes]) * space + found, return_counts=True)
    totals = [np.bincount(owner, x[codes], len(texts)).astype(np.int64).tolist() for x in counted]
    at, own = np.searchsorted(owner, np.arange(len(texts) + 1)), np.searchsorted(keys, np.arange(len(texts) + 1) * space)
    places = codes.tolist()
    for i in np.unique(owner).tolist():
        text = "".join(map(written.__getitem__, places[at[i] : at[i + 1]]))[:-1]
        mine = slice(own[i], own[i + 1])
        out[i] = (*(x[i] for x in totals), form(text), keys[mine] - i * space, times[mine])
    return out


_RESULT = {
    "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
    "groups": pa.string(), "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int64()),
}
_RESULT_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


def _result(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_RESULT)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _RESULT.values(), strict=True)], list(_RESULT))


def cut_spans(docs: DataFrame, span_chars: int = SPAN_CHARS) -> DataFrame:
    """`(row, doc_id, start, text)`: spans of long texts that end before a single space between other characters.

    `start` is the span's first byte in a space and the text, -1 if the text is no UTF-8. A text without such a space is one span.
    """
    names = ["row", "doc_id", "start", "text"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row, doc_id, raw = (batch.column(c)[i].as_py() for c in range(3))
                start, at = 0, 0
                try:
                    text = raw.decode()
                except UnicodeDecodeError:
                    text, start = "", -1
                while at is not None:
                    safe = _SAFE.search(text, min(at + span_chars, len(text)))
                    part = text[at : safe.start()] if safe else text[at:]
                    yield pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([doc_id], pa.int64()), pa.array([start], pa.int64()), pa.array([part], pa.string())], names)
                    start += 1 + len(part.encode())
                    at = safe.end() if safe else None

    return docs.select("row", "doc_id", "text").mapInArrow(cut, "row long, doc_id long, start long, text string")


_STATE = "row long, doc_id long, start long, right boolean, n_a long, n_b long, cut boolean, n_groups long, closed string, pairs binary, times binary, " + ", ".join(
    f"{part}_{side} binary" for part in ("prefix", "suffix") for side in ("a", "a_end", "b", "b_end")
)


def _pack(row: int, doc_id: int | None, start: int, right: bool, f: Fragment) -> dict:
    state = {"row": row, "doc_id": doc_id, "start": start, "right": right, "n_a": f.n_a, "n_b": f.n_b, "cut": f.cut, "n_groups": f.n_groups, "closed": f.closed}
    state |= {"pairs": f.pairs.astype(np.int64).tobytes(), "times": f.times.astype(np.int64).tobytes()}
    return state | {f"{part}_{side}": getattr(getattr(f, part), side).tobytes() for part in ("prefix", "suffix") for side in ("a", "a_end", "b", "b_end")}


def _unpack(state) -> Fragment:
    numbers = lambda name: np.frombuffer(state[name], np.int64)
    prefix, suffix = (Tokens(*(numbers(f"{part}_{side}") for side in ("a", "a_end", "b", "b_end"))) for part in ("prefix", "suffix"))
    return Fragment(int(state["n_a"]), int(state["n_b"]), bool(state["cut"]), prefix, suffix, int(state["n_groups"]), state["closed"], numbers("pairs"), numbers("times"))


def fragments(spans: DataFrame, locate: Callable[[], TokenizerPair], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The fragments of every span, one for each range of `range_bytes` of its document that it meets."""
    columns = [c.split()[0] for c in _STATE.split(", ")]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = locate()
        for frame in frames:
            rows = []
            for row, doc_id, start, text in frame.itertuples(index=False):
                coded = pa.array(_SAFE.split(text), pa.large_string()).dictionary_encode()
                spelling = pair.spell(coded.dictionary.to_pylist())
                right = start >= 0 and bool(spelling.right.all())
                start, end, tokens = max(start, 0), start, NONE
                if right:
                    tokens = pair.tokens(spelling, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
                    tokens = Tokens(tokens.a, tokens.a_end + start, tokens.b, tokens.b_end + start)
                    end = int(tokens.a_end[-1])
                for low in [start, *range(start - start % range_bytes + range_bytes, end, range_bytes)]:
                    high = min(end, low - low % range_bytes + range_bytes)
                    rows.append(_pack(row, None if pd.isna(doc_id) else int(doc_id), low, right, Fragment.of(tokens.between(low, high), pair.names)))
            if rows:
                yield pd.DataFrame(rows, columns=columns)

    return spans.mapInPandas(cut, _STATE)


def reduce_fragments(found: DataFrame, locate: Callable[[], TokenizerPair], range_bytes: int = RANGE_BYTES, fan: int = FAN) -> DataFrame:
    """One fragment for each document: neighbours are composed by about `fan`, level by level, each level written."""
    columns = [c.split()[0] for c in _STATE.split(", ")]

    def compose(frame: pd.DataFrame) -> pd.DataFrame:
        pair = locate()
        rows = frame.sort_values("start").to_dict("records")
        whole = _unpack(rows[0])
        for state in rows[1:]:
            whole = whole.then(_unpack(state), pair.names)
        doc_id = rows[0]["doc_id"]
        return pd.DataFrame([_pack(rows[0]["row"], None if pd.isna(doc_id) else int(doc_id), rows[0]["start"], all(s["right"] for s in rows), whole)], columns=columns)

    found, reach = materialize(found, "fragments"), range_bytes
    longest = found.agg(F.max("start")).first()[0]
    composed = False
    while longest is not None and (reach <= longest or not composed):
        reach, composed = reach * fan, True
        found = found.withColumn("_part", F.floor(F.col("start") / reach)).groupBy("row", "_part").applyInPandas(compose, _STATE)
        found = materialize(found, "fragments")
    return found


def aligned(
    docs: DataFrame,
    form: Callable[[str], str],
    locate: Callable[[], TokenizerPair],
    long_bytes: int = LONG_BYTES,
    span_chars: int = SPAN_CHARS,
    range_bytes: int = RANGE_BYTES,
    fan: int = FAN,
) -> DataFrame:
    """`(doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times)`: what each document's tokens say alone, stored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    long = F.coalesce(F.octet_length("text") > long_bytes, F.lit(False))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = locate()
        for batch in batches:
            for ids, texts in blocks(batch.column(0), batch.column(1), BLOCK_BYTES):
                yield _result([(i, *x) for i, x in zip(ids, align_block(pair, texts, form), strict=True)])

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = locate()
        for frame in frames:
            out = []
            for state in frame.to_dict("records"):
                doc_id = None if pd.isna(state["doc_id"]) else int(state["doc_id"])
                f = START.then(_unpack(state), pair.names)
                right = bool(state["right"])
                out.append((doc_id, f.n_a, f.n_b, f.n_groups, int(f.times.sum()), form(f.closed[:-1]), f.pairs, f.times) if right else (doc_id, 0, 0, 0, 0, "", [], []))
            yield _result(out).to_pandas()

    spans = materialize(cut_spans(rows.filter(long).withColumn("row", F.monotonically_increasing_id()), span_chars), "spans")
    # A document's spans go to as many tasks as there are.
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    composed = reduce_fragments(fragments(spans.repartition(n, "row", "start"), locate, range_bytes), locate, range_bytes, fan)
    both = rows.filter(~long).mapInArrow(whole, _RESULT_SCHEMA).unionByName(composed.mapInPandas(finish, _RESULT_SCHEMA))
    return materialize(both, "aligned")


def _level(count: Column) -> Column:
    return F.floor(F.log2(count.cast("double")) * _LEVELS).cast("int")


def pair_counts(documents: DataFrame) -> DataFrame:
    """`(pair, n, best)`: documents that hold each linked id pair, and whether no pair of the same first id has more. Stored."""
    counts = materialize(documents.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    first = F.shiftright("pair", WIDTH.bit_length() - 1)
    # One row for each id of the first vocabulary at most.
    top = counts.groupBy(first.alias("first")).agg(F.max("n").alias("most"))
    return counts.withColumn("first", first).join(F.broadcast(top), "first").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_tokens(
    docs: DataFrame,
    form: Callable[[str], str] = str,
    first: str = FIRST,
    second: str = SECOND,
    locate: Callable[[str], str] = public_path,
    most_broadcast: int = MOST_BROADCAST,
    **ranges: int,
) -> DataFrame:
    """`(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`, one row per row of `docs`.

    Both tokenizers encode a space and the text; special tokens' strings are plain text. `groups` lists the ids between
    offsets where tokens of both sides end, as `a,a|b;a|b,b`, and `form` makes of that what is kept. Links are the pairs of tokens whose
    bytes overlap; a pair of ids counts as often as there are rows that link it. `n_best` are the links whose
    count no other pair of the same first id exceeds (ties included), and `count_sum` is the sum of the counts of all links.

    A null or empty text, or one that the tokens of a side do not spell byte for byte, has no tokens: zeros, and
    `groups` is the empty string. Very long texts are cut into spans and composed across tasks; one without a single space between other characters
    stays one span. Rows that repeat a doc_id or have none are rows like others. An empty table
    gives no row. Only doc_id and text are read.
    """

    def load() -> TokenizerPair:
        return tokenizer_pair(locate(first), locate(second))

    spark = docs.sparkSession
    documents = aligned(docs, form, load, **ranges)
    counts = materialize(pair_counts(documents), "scored-pairs")
    left, cut = most_broadcast, 64 * _LEVELS
    for level, n in counts.groupBy(_level(F.col("n")).alias("level")).count().orderBy(F.desc("level")).collect():  # a few hundred at most
        left -= n
        if left < 0:
            break
        cut = level
    frequent = counts.filter(_level(F.col("n")) >= cut).orderBy("pair").toArrow()
    table = spark.sparkContext.broadcast(tuple(frequent.column(c).to_numpy() for c in ("pair", "n", "best")))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum", "rare", "rare_times"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = table.value
        for batch in batches:
            lists = batch.column(6)
            bounds = np.asarray(lists.offsets)
            pairs, times = (np.asarray(batch.column(c).values)[bounds[0] : bounds[-1]] for c in (6, 7))
            bounds = bounds - bounds[0]
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            seen = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[bounds])
            n_best = total(np.where(seen, best[at], False) * times if len(keys) else 0 * times)
            count_sum = total(np.where(seen, n[at], 0) * times if len(keys) else 0 * times)
            upto = pa.array(np.concatenate([[0], np.cumsum(~seen)])[bounds], pa.int32())
            rare = [pa.ListArray.from_arrays(upto, pa.array(x[~seen], pa.int64())) for x in (pairs, times)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), *rare], names)

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long, rare array<long>, rare_times array<long>"
    looked = documents.select(*_RESULT).mapInArrow(look_up, schema)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    if left >= 0:
        return looked.select(columns)
    looked = materialize(looked.withColumn("row", F.monotonically_increasing_id()), "looked-up")
    rest = looked.select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("_r")).select("row", F.col("_r.rare").alias("pair"), F.col("_r.rare_times").alias("times"))
    rest = rest.join(counts.filter(_level(F.col("n")) < cut), "pair").groupBy("row")
    rest = rest.agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("n") * F.col("times")).alias("_sum"))
    more = lambda name, by: (F.col(name) + F.coalesce(by, F.lit(0))).alias(name)
    joined = looked.join(rest, "row", "left")
    return joined.withColumns({"n_best": more("n_best", F.col("_best")), "count_sum": more("count_sum", F.col("_sum"))}).select(columns)
