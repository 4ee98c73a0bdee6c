"""Best-fit packing of token sequences by a configuration linear program.

Documents are cut into pieces of at most `capacity` tokens. Only the histogram of piece lengths
reaches the driver, at most `capacity` numbers at any input size. There the linear program over
configurations (which lengths share a sequence, and how many sequences do so) is solved by multiplicative
weights: a length's price falls as it gets covered, and the configurations of the highest total
price are found by knapsack dynamic programming. Multiplicities are rounded down, and what that
leaves goes to sequences by best fit, in whole runs of equal sequences.

Pieces get their sequence from the plan by their number in the order of length, so
neither pieces nor sequences are ever gathered.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import cache, cached_property
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import blocks
from textmill.llm.align import rank_encoding
from textmill.llm.tokens import public_path
from textmill.operators.indexing import global_index
from textmill.runtime import materialize

CAPACITY = 1024
VOCABULARY = "byte_bpe_50k.json"
#: Characters below are Latin letters and the signs among them.
LATIN_END = "\u0250"
#: Id that ends every document.
END_ID = 2
#: The string that the vocabulary file takes for one id.
SPECIAL = "<|endoftext|>"
#: Bytes of text of a block, or a single longer text. Larger ones take memory and no less time.
BLOCK_BYTES = 1 << 20
#: Growth of the first prices with length (one long piece is worth more than short ones that fill as much), fall of the prices, and configurations of a pricing.
POWER, RATE, MOST_CONFIGURATIONS = 1.1, 0.2, 32
#: Least share of a length's count that a pricing covers; with many lengths the share is larger, so that the pricings stay about as many.
LEAST_STEP = 0.1
#: Room that configurations of the program may leave, tried in turn.
WASTE = (CAPACITY, 16, 2, 0)


class PartTokenizer:
    """Ids of a block of texts as little-endian unsigned 32-bit bytes.

    A single space between two other characters always begins a new pre-token of this byte-level
    vocabulary, so a block is split at such spaces and each distinct part is encoded once, all in one
    call on the vocabulary's merges as ranks, see `rank_encoding`. Texts with other white
    space at a split are encoded whole; those that hold the end-of-text string by the library of the file.
    """

    def __init__(self, path: str):
        self.path = path
        self.ranks, ranks = rank_encoding(path)
        self.spaced = np.zeros(len(ranks), bool)
        self.spaced[[rank for token, rank in ranks.items() if token.startswith(b" ")]] = True

    @cached_property
    def model(self):
        """The vocabulary file itself, loaded only if a text needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def whole(self, text: str) -> bytes:
        if SPECIAL in text:
            ids = self.model.encode(text, add_special_tokens=False).ids
        else:
            ids = self.ranks.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()

    def block(self, texts: list[str]) -> list[bytes]:
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds = np.asarray(split.offsets)
        coded = split.values.dictionary_encode()
        codes, parts = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        alone = pc.and_(pc.equal(pc.utf8_trim_whitespace(parts), parts), pc.not_equal(parts, "")).to_numpy(zero_copy_only=False)
        ids = np.array(self.ranks.encode_ordinary("".join([" " + p for p in parts.filter(pa.array(alone)).to_pylist()])), "<u4")
        # A token that begins with a space begins the next part.
        starts = np.append(np.flatnonzero(self.spaced[ids]), len(ids))
        first, length = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        first[alone], length[alone] = starts[:-1], np.diff(starts)
        out = []
        for text, a, b in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = codes[a:b]
            if not alone[own].all() or SPECIAL in text:
                out.append(self.whole(text))
                continue
            n = length[own[1:]]
            upto = np.cumsum(n)
            at = np.repeat(first[own[1:]] - upto + n, n) + np.arange(upto[-1] if len(n) else 0)
            out.append(self.whole(text.partition(" ")[0]) + ids[at].tobytes())
        return out


@cache
def part_tokenizer(path: str) -> PartTokenizer:
    """One per worker process, kept from task to task."""
    return PartTokenizer(path)


def cut_pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    locate: Callable[[str], str] = public_path,
) -> DataFrame:
    """`(doc_id, piece, start, length, ids_crc32)`: the token pieces of each row of `docs`.

    A document longer than `capacity` is cut so that all pieces but the first have that length.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = part_tokenizer(locate(vocabulary))
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for doc_ids, texts in blocks(batch.column(0), batch.column(1), BLOCK_BYTES):
                rows: list[list] = [[], [], [], [], []]
                encoded = tokenizer.block([(t or b"").decode("utf-8", "replace") for t in texts])
                for doc_id, ids in zip(doc_ids, encoded, strict=True):
                    ids += end
                    n = len(ids) // 4
                    bounds = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                        for column, value in zip(rows, (doc_id, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])), strict=True):
                            column.append(value)
                columns = [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), *[pa.int64()] * 3), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def price_out(prices: np.ndarray, left: np.ndarray, capacity: int, most: int) -> list[np.ndarray]:
    """The configuration of the highest total price for each of the `most` longest lengths as its longest piece, with no more pieces than are `left`.

    One knapsack over the lengths in order, with a length's pieces in bundles of 1, 2, 4, …, prices the best filling beside every length.
    Long pieces, which fit in the fewest configurations, choose first.
    """
    bundles = []
    for length in np.flatnonzero(left):
        rest, size = min(int(left[length]), capacity // int(length)), 1
        while rest:
            size = min(size, rest)
            bundles.append((int(length), size))
            rest, size = rest - size, 2 * size
    best = np.zeros((len(bundles) + 1, capacity + 1))
    last = np.zeros((len(bundles) + 1, capacity + 1), np.int32)  # the last bundle taken, counted from 1
    for i, (length, size) in enumerate(bundles, 1):
        best[i], last[i] = best[i - 1], last[i - 1]
        with_it = best[i - 1, : capacity + 1 - length * size] + prices[length] * size
        better = with_it > best[i, length * size :]
        best[i, length * size :][better] = with_it[better]
        last[i, length * size :][better] = i
    longest = {length: i for i, (length, _) in reversed(list(enumerate(bundles)))}  # bundles of shorter pieces
    found = []
    for length in sorted(longest, reverse=True)[:most]:
        taken = np.zeros(len(prices), np.int64)
        more = min(int(left[length]), capacity // length)
        # As many pieces of the longest length as pay, the rest from shorter ones.
        values = [n * prices[length] + best[longest[length], capacity - n * length] for n in range(1, more + 1)]
        taken[length] = 1 + int(np.argmax(values))
        i, room = longest[length], capacity - length * int(taken[length])
        while i := int(last[i, room]):
            piece, size = bundles[i - 1]
            taken[piece] += size
            room -= piece * size
            i -= 1
        found.append(taken)
    return found


def solve_program(counts: np.ndarray, capacity: int, step: float = 1.0) -> list[tuple[np.ndarray, float]]:
    """Configurations with multiplicities that together cover `counts` (index: length), but for less than one piece of a length.

    Prices start at the length itself, the best dual values if no room is wasted, with a little more for long pieces, and fall
    exponentially with the share of a length that is covered. Each pricing adds to its best configurations until
    their scarcest length has gained the share `step` of its count, one piece at least. A configuration may leave room.
    """
    share = np.where(counts > 0, counts, 1)
    left, length = counts.astype(float), np.arange(len(counts))
    used: dict[bytes, list] = {}
    while (left >= 1).any():
        whole = np.floor(left + 1e-9).astype(np.int64)
        prices = np.where(whole > 0, length**POWER * np.exp(RATE * left / share), 0.0)
        for taken in price_out(prices, whole, capacity, MOST_CONFIGURATIONS):
            held = taken > 0
            if (left[held] < taken[held]).any():
                continue  # another configuration of this pricing has taken its pieces
            amount = (np.minimum(left[held], np.maximum(taken[held], step * counts[held])) / taken[held]).min()
            left[held] -= amount * taken[held]
            left[left < 1e-9] = 0.0
            used.setdefault(taken.tobytes(), [taken, 0.0])[1] += amount
    return [(taken, amount) for taken, amount in used.values()]


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[np.ndarray, int]]:
    """Configurations and how many sequences use each; together they hold `counts[length]` pieces exactly.

    Multiplicities of the program's solution are rounded down, one sequence at least where the pieces are still there. How much
    room a configuration may leave, so that its sequences are kept, is chosen among `WASTE`, the step of the program among two; the pieces of the others and those
    that rounding leaves go to best fit. The plan with the fewest sequences counts, of equal ones that with the most of the program's.
    """
    alone, whole = counts.astype(np.int64).copy(), []
    if alone[capacity]:
        full = np.zeros(len(counts), np.int64)
        full[capacity] = 1
        whole = [(full, int(alone[capacity]))]
        alone[capacity] = 0
    length = np.arange(len(counts))
    room = lambda taken: capacity - int((taken * length).sum())
    steps = {1.0, max(LEAST_STEP, np.count_nonzero(alone) / CAPACITY)}
    programs = [sorted(solve_program(alone, capacity, step), key=lambda x: (room(x[0]), -x[1])) for step in sorted(steps)]
    plans = []
    for program, waste in product(programs, WASTE):
        left, plan = alone.copy(), []
        for taken, amount in program:
            if room(taken) > waste:
                continue
            held = taken > 0
            n = min(max(1, int(amount + 1e-9)), int((left[held] // taken[held]).min()))
            if n:
                plan.append((taken, n))
                left -= n * taken
        used = sum(n for _, n in plan)
        plans.append((used, whole + plan + best_fit(left, capacity)))
    return min(plans, key=lambda x: (sum(n for _, n in x[1]), -x[0]))[1]


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Best fit by decreasing length, in whole runs of equal sequences.

    Pieces of a length go to the fullest sequences that have room for them, as many to each as it can take, then to new ones.
    """
    by_room: dict[int, dict[bytes, int]] = {}
    left = counts.astype(np.int64).copy()
    empty = np.zeros(len(counts), np.int64).tobytes()

    def put(before: bytes, room: int, length: int, each: int, n: int) -> None:
        held = np.frombuffer(before, np.int64).copy()
        held[length] += each
        after = by_room.setdefault(room - each * length, {})
        after[held.tobytes()] = after.get(held.tobytes(), 0) + n

    for length in np.flatnonzero(left)[::-1].tolist():
        for room in range(length, capacity):
            each = room // length
            if not left[length]:
                break
            for before, have in list(by_room.get(room, {}).items()):
                n = min(have, int(left[length]) // each)
                rest = int(left[length]) - n * each if n < have else 0
                taken = n + (rest > 0)
                if not taken:
                    break
                by_room[room][before] = have - taken
                if have == taken:
                    del by_room[room][before]
                if n:
                    put(before, room, length, each, n)
                if rest:
                    put(before, room, length, rest, 1)
                left[length] -= n * each + rest
        each = capacity // length
        n, rest = divmod(int(left[length]), each)
        if n:
            put(empty, capacity, length, each, n)
        if rest:
            put(empty, capacity, length, rest, 1)
        left[length] = 0
    return [(np.frombuffer(held, np.int64), n) for same in by_room.values() for held, n in same.items()]


def plan_table(plan: list[tuple[np.ndarray, int]], counts: np.ndarray) -> pd.DataFrame:
    """The plan by piece number: `first` piece of a run, its first sequence, pieces per sequence and offset there."""
    next_piece = np.concatenate([[0], np.cumsum(counts)[:-1]])
    rows, sequence = [], 0
    for taken, n in plan:
        offset = 0
        for length in np.flatnonzero(taken)[::-1]:
            rows.append((next_piece[length], sequence, taken[length], offset))
            next_piece[length] += n * taken[length]
            offset += length * taken[length]
        sequence += n
    return pd.DataFrame(rows, columns=["first", "sequence", "per", "offset"]).sort_values("first", ignore_index=True)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, **options) -> DataFrame:
    """`(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`, one row per piece of a row of `docs`.

    A null or empty text is a piece of one id, the end. Rows without doc_id or that repeat
    others are packed like all. An empty table gives no piece. Only doc_id and text are read.
    """
    pieces = materialize(cut_pieces(docs, capacity, **options), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        counts[length] = n
    table = plan_table(plan_packing(counts, capacity), counts)
    first, sequence, per, offset = (table[c].to_numpy(np.int64) for c in table.columns)

    @F.pandas_udf("sequence_id long, offset long")
    def place(at: pd.Series, length: pd.Series) -> pd.DataFrame:
        run = np.searchsorted(first, at.to_numpy(), side="right") - 1
        number, slot = np.divmod(at.to_numpy() - first[run], per[run])
        return pd.DataFrame({"sequence_id": sequence[run] + number, "offset": offset[run] + slot * length.to_numpy()})

    numbered = global_index(pieces, ["length", "doc_id", "piece"], "_llm_at")
    placed = numbered.withColumn("_llm_place", place("_llm_at", "length"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "_llm_place.sequence_id", "_llm_place.offset")
