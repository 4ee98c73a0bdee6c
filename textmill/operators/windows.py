"""Counting character windows and list items, a batch of documents at a time.

A batch's texts are one array of code points. A window is packed into a number, from dense ids of the characters that
occur, and windows are counted by sorting these numbers, so only distinct windows become strings again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Code points or list items that are counted together (or one document).
POINTS = 1 << 18

_SPACE = 32


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of some whole documents, with `POINTS` code points and items at most or of one document, and each row's document in them.

    The batches are sorted by their first column, whose equal or null values are one document.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()
        if not rows:
            held = []
            continue
        new = _new_document(rows[0].column(0))
        # The last document may go on in the next batch.
        end = int(np.flatnonzero(new)[-1])
        yield from _cut(rows[0].slice(0, end), new[:end])
        held = [rows[0].slice(end)]
    for rows in held:
        yield from _cut(rows, _new_document(rows.column(0)))


def _new_document(keys: pa.Array) -> np.ndarray:
    codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.append(True, codes[1:] != codes[:-1])


def _cut(rows: pa.RecordBatch, new: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    if not rows.num_rows:
        return
    at = np.flatnonzero(new)
    sizes = np.add.reduceat(sum(_sizes(c) for c in rows.columns[1:]), at)
    bounds, held = [0], 0
    for n, size in enumerate(sizes.tolist()):
        if n > bounds[-1] and held + size > POINTS:
            bounds.append(n)
            held = 0
        held += size
    ends = np.append(at, rows.num_rows)
    for first, last in zip(bounds, [*bounds[1:], len(at)]):
        start, end = int(ends[first]), int(ends[last])
        yield rows.slice(start, end - start), np.cumsum(new[start:end]) - 1


def _bits(n: int) -> int:
    return max(1, (n - 1).bit_length())


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted keys."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))


def _per_text(found: np.ndarray, owner: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`(text, number, tf)`, by text, of numbers of `bits` bits."""
    keys = np.sort((owner << bits) | found)
    at = _starts(keys)
    return keys[at] >> bits, keys[at] & ((1 << bits) - 1), np.diff(at, append=len(keys))


def _pairs(found: np.ndarray, owner: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """`number`, and of its pairs with owners, which have `bits` bits: the number's place, the owner and `tf`."""
    keys = np.sort((found << bits) | owner)
    at = _starts(keys)
    number = keys[at] >> bits
    first = np.append(True, number[1:] != number[:-1])
    return number[first], np.cumsum(first) - 1, keys[at] & ((1 << bits) - 1), np.diff(at, append=len(keys))


def _room(points: np.ndarray, lengths: np.ndarray, in_words: bool) -> np.ndarray:
    """How far a window may reach from each place: to the text's end, or to the next pair of spaces."""
    last = np.zeros(len(points), bool)
    last[np.cumsum(lengths[lengths > 0]) - 1] = True
    if in_words:
        last[:-1] |= (points[:-1] == _SPACE) & (points[1:] == _SPACE)
    ends = np.flatnonzero(last) + 1
    return np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(points))


def _strings(points: np.ndarray) -> pa.Array:
    """Each row of code points as a string."""
    size = 1 + (points >= 0x80).astype(np.int32) + (points >= 0x800) + (points >= 0x10000)
    offsets = np.concatenate([[0], np.cumsum(size.sum(axis=1, dtype=np.int64))]).astype(np.int32)
    data = points.astype("<u4").tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(points), pa.py_buffer(offsets), pa.py_buffer(data))


def packed_windows(texts: Sequence[str | None], document: np.ndarray, low: int, high: int, in_words: bool) -> Iterator[tuple]:
    """For each length `(number, document, bits, spell)`: the windows as numbers of `bits` bits with the documents of their texts.

    `spell` turns numbers into strings. Windows of `in_words` never hold two spaces in a row; null texts have none.
    """
    lengths = np.array([len(t) if t else 0 for t in texts], np.int64)
    points = np.frombuffer("".join(t for t in texts if t).encode("utf-32-le"), np.uint32)
    if not len(points):
        return
    room_for = int(points.max()) + 1
    seen = np.zeros(room_for, bool)
    seen[points] = True
    alphabet = np.flatnonzero(seen).astype(np.uint32)
    dense = np.zeros(room_for, np.int64)
    dense[alphabet] = np.arange(len(alphabet))
    ids, width, most = dense[points], _bits(len(alphabet)), _bits(int(document[-1]) + 1)
    room, owner = _room(points, lengths, in_words), np.repeat(document, lengths)
    # A number starts with a row of `heads`; `tails` ids of `width` bits follow.
    grams, heads, bits, tails = ids, alphabet[:, None], width, 0

    def speller(heads: np.ndarray, tails: int):
        def spell(numbers: np.ndarray) -> np.ndarray:
            rest = [alphabet[(numbers >> (width * i)) & ((1 << width) - 1)] for i in range(tails - 1, -1, -1)]
            return np.column_stack([heads[numbers >> (width * tails)], *rest])

        return spell

    for n in range(2, high + 1):
        if len(points) < n:
            return
        if bits + width + most > 63:
            # Too many characters for one number: the shorter windows are numbered among themselves.
            values, grams = np.unique(grams, return_inverse=True)
            heads, bits, tails = speller(heads, tails)(values), _bits(len(values)), 0
        grams = (grams[:-1] << width) | ids[n - 1 :]
        bits, tails = bits + width, tails + 1
        real = room[: len(grams)] >= n
        if n >= low and real.any():
            spell = speller(heads, tails)
            yield grams[real], owner[: len(grams)][real], bits, lambda x, spell=spell: _strings(spell(x))


def packed_items(lists: pa.ListArray, document: np.ndarray) -> Iterator[tuple]:
    """As `packed_windows` for the items of lists; null lists and items count for nothing."""
    coded = lists.flatten().dictionary_encode()
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    owner = np.repeat(document, lengths)
    real = coded.indices.is_valid().to_numpy(zero_copy_only=False)
    found = coded.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[real]
    if len(found):
        yield found, owner[real], _bits(len(coded.dictionary)), lambda x: coded.dictionary.take(pa.array(x))


def _sizes(column: pa.Array) -> np.ndarray:
    if pa.types.is_list(column.type):
        return column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return pc.utf8_length(column).fill_null(0).to_numpy(zero_copy_only=False)


def _packed(column: pa.Array, document: np.ndarray, shape: tuple[int, int, bool] | None) -> Iterator[tuple]:
    return packed_items(column, document) if shape is None else packed_windows(column.to_pylist(), document, *shape)


def document_counts(batches: Iterator[pa.RecordBatch], shapes: Sequence[tuple | None]) -> Iterator[pa.RecordBatch]:
    """`(ord, block, term, tf)`; `shapes` tells `(low, high, in_words)` of the columns with texts after `ord`, None of those with lists."""
    for rows, document in pieces(batches):
        keys = rows.column(0).take(pa.array(_starts(document)))
        for block, (column, shape) in enumerate(zip(rows.columns[1:], shapes)):
            for found, owner, bits, spell in _packed(column, document, shape):
                text, number, tf = _per_text(found, owner, bits)
                block_column = pa.array(np.full(len(text), block, np.int32))
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(text)), block_column, spell(number).cast(pa.string()), pa.array(tf, pa.int64())], ["ord", "block", "term", "tf"])


def term_sums(batches: Iterator[pa.RecordBatch], shape: tuple | None) -> Iterator[pa.RecordBatch]:
    """`(term, tf, df)` of some documents at a time."""
    for rows, document in pieces(batches):
        for found, owner, _, spell in _packed(rows.column(1), document, shape):
            number, place, _, tf = _pairs(found, owner, _bits(int(document[-1]) + 1))
            arrays = [spell(number).cast(pa.string()), pa.array(np.bincount(place, weights=tf).astype(np.int64)), pa.array(np.bincount(place))]
            yield pa.RecordBatch.from_arrays(arrays, ["term", "tf", "df"])


def known_counts(column: pa.Array, document: np.ndarray, shape: tuple | None, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`(document, place, tf)` of what is found of `terms`, by its place there."""
    out = [(np.empty(0, np.int64),) * 3]
    for found, owner, _, spell in _packed(column, document, shape):
        number, at, held, tf = _pairs(found, owner, _bits(int(document[-1]) + 1))
        place = pc.fill_null(pc.index_in(spell(number).cast(pa.string()), value_set=terms), -1).to_numpy(zero_copy_only=False)[at]
        known = place >= 0
        out.append((held[known], place[known], tf[known]))
    return tuple(np.concatenate(x) for x in zip(*out))
