"""Whole texts as arrays: words, their 64-bit names and shingles, for Arrow batches.

Words are maximal runs of bytes of a 256-entry class. Every class used here separates
at ASCII bytes only, so runs of bytes are runs of code points too. A-Z is lower-cased.
Texts are handled in pieces of bounded size; nothing is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

_ODD = 0x9E3779B97F4A7C15
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(separators: list[tuple[int, int]]) -> np.ndarray:
    """True for word bytes; `separators` are inclusive ranges of bytes, after lower-casing."""
    words = np.ones(256, dtype=bool)
    for first, last in separators:
        words[first : last + 1] = False
    return words


#: `[^\x20\x09-\x0D]+`
SPACED = byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing
ALPHANUMERIC = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, as many as asked for."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def grown(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
                table = np.full(size, base, dtype=np.uint64)
                table[0] = 1
                setattr(cls, name, np.cumprod(table))
        return cls.up, cls.down


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its row offsets; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + n + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def _names(data: np.ndarray, is_word: np.ndarray, breaks: np.ndarray):
    """Start of each word and its 64-bit name; `breaks` are the offsets where texts begin."""
    low = _LOWER[data]
    word = is_word[low]
    if not word.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    before[breaks] = False
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    after[breaks[breaks > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after)
    up, down = _Powers.grown(len(data))
    total = np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(data)])
    begun = np.where(starts > 0, total[starts - 1], np.uint64(0))
    return starts, mix((total[ends] - begun) * down[starts])


def pieces(data: np.ndarray, is_word: np.ndarray) -> Iterator[np.ndarray]:
    """A long text cut between words into pieces of about a slice."""
    at = 0
    while at < len(data):
        end = min(at + SLICE_BYTES, len(data))
        while end < len(data) and is_word[_LOWER[data[end]]]:
            run = is_word[_LOWER[data[end : end + SLICE_BYTES]]]
            end += int(run.argmin()) if not run.all() else len(run)
        yield data[at:end]
        at = end


def word_slices(
    column: pa.Array, is_word: np.ndarray, recode: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, names of all words, word offset of each row) for runs of whole texts.

    With `recode`, bytes are replaced by the table first and repeats of one are dropped.
    """
    data, bounds = text_buffers(column)
    if recode is not None and len(data):
        data = recode[data]
        keep = np.ones(len(data), bool)
        keep[1:] = data[1:] != data[:-1]
        keep[bounds[:-1][bounds[:-1] < len(data)]] = True
        bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
        data = data[keep]
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + SLICE_BYTES, "right")) - 1)
        part = data[bounds[row] : bounds[end]]
        if end == row + 1 and len(part) > SLICE_BYTES:
            names = np.concatenate([_names(p, is_word, np.zeros(1, np.int64))[1] for p in pieces(part, is_word)])
            yield row, names, np.array([0, len(names)])
        else:
            local = bounds[row : end + 1] - bounds[row]
            starts, names = _names(part, is_word, local[:-1][local[:-1] < len(part)])
            yield row, names, np.searchsorted(starts, local)
        row = end


def shingles(names: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit shingle names in text order and their offsets per row.

    A row with fewer words than `size`, but not none, has its whole sequence as one.
    """
    counts = np.diff(offsets)
    short = np.flatnonzero((counts > 0) & (counts < size))
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    if len(names) >= size:
        rolled = np.full(len(names) - size + 1, size, dtype=np.uint64)
        for k in range(size):
            rolled = mix(rolled * np.uint64(_ODD) + names[k : k + len(rolled)])
    else:
        rolled = np.zeros(0, np.uint64)
    ends = np.cumsum(made)
    begin = ends - made
    # Position of each shingle's first word: its rank inside the row on top of the row's offset.
    first = np.repeat(offsets[:-1] - begin, made) + np.arange(ends[-1] if len(ends) else 0)
    out = np.zeros(len(first), np.uint64)
    whole = np.repeat(counts >= size, made)
    out[whole] = rolled[first[whole]]
    for row in short:
        value = np.full(1, counts[row], dtype=np.uint64)
        for name in names[offsets[row] : offsets[row + 1]]:
            value = mix(value * np.uint64(_ODD) + name)
        out[begin[row]] = value[0]
    return out, np.concatenate([[0], ends]).astype(np.int64)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    ordered = np.sort(values)
    if len(ordered) < 2:
        return ordered
    keep = np.empty(len(ordered), bool)
    keep[0] = True
    np.not_equal(ordered[1:], ordered[:-1], out=keep[1:])
    return ordered[keep]
