"""Token ids of texts by the distinct pieces between their ASCII white space.

A slice of texts is cut by Arrow, its pieces are dictionary-encoded, each distinct one is
looked up once, and the ids of all are gathered by offset. Pieces a task has met before are
remembered in a table of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of texts that are cut together; a longer text comes alone.
SLICE_BYTES = 1 << 20
#: Longer pieces are not remembered.
LONGEST_REMEMBERED = 64


class Memory:
    """Ids of words or pieces; `learn` gives those of the ones not met before, as bytes.

    The latest ones are remembered, twice `remembered` at most.
    """

    def __init__(self, learn: Callable[[list], dict], remembered: int):
        self.learn, self.remembered = learn, remembered
        self.known: dict = {}
        self.before: dict = {}

    def __call__(self, keys: list) -> list[bytes]:
        if len(self.known) > self.remembered:
            self.before, self.known = self.known, {}
        known, before = self.known, self.before
        out = list(map(known.get, keys))
        unknown = []
        for k in [k for k, ids in enumerate(out) if ids is None]:
            if (ids := before.get(keys[k])) is not None:
                out[k] = known[keys[k]] = ids
            else:
                unknown.append(k)
        if unknown:
            made = self.learn([keys[k] for k in unknown])
            for k in unknown:
                key = keys[k]
                out[k] = made[key]
                if len(key) <= LONGEST_REMEMBERED:
                    known[key] = made[key]
        return out


def gathered(store: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `store` that begin at `starts`, one after another, and the end of each."""
    stops = np.cumsum(lengths)
    at = np.arange(stops[-1] if len(stops) else 0) + np.repeat(starts - (stops - lengths), lengths)
    return store[at], stops


class Shelf:
    """Ids of numbered pieces in one array, where those of each begin and how many they are."""

    def __init__(self, kind: str):
        self.number: dict[str, int] = {}
        self.ids, self.starts, self.lengths = np.empty(0, kind), np.empty(0, np.int64), np.empty(0, np.int64)

    def find(self, keys: list[str]) -> np.ndarray:
        """The number of each piece here, -1 for the others."""
        return np.fromiter(map(self.number.get, keys, repeat(-1)), np.int64, len(keys))

    def add(self, keys: list[str], store: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The numbers of pieces that were not here."""
        numbers = np.arange(len(self.number), len(self.number) + len(keys))
        self.number.update(zip(keys, numbers.tolist(), strict=True))
        ids, stops = gathered(store, starts, lengths)
        self.starts = np.concatenate([self.starts, stops - lengths + len(self.ids)])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])
        return numbers


class ArrayMemory:
    """As `Memory`, with the ids of all remembered pieces in arrays instead of an object each.

    `learn` and a call, each for distinct pieces, give an array of ids, and where in it those
    of each piece begin and how many they are.
    """

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]], kind: str, remembered: int):
        self.learn, self.kind, self.remembered = learn, kind, remembered
        self.known, self.before = Shelf(kind), Shelf(kind)

    def __call__(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.known.number) > self.remembered:
            self.before, self.known = self.known, Shelf(self.kind)
        known, before = self.known, self.before
        numbers = known.find(keys)
        missing = np.flatnonzero(numbers < 0)
        names = [keys[k] for k in missing.tolist()]
        old = before.find(names)
        met = old >= 0
        again = old[met]
        numbers[missing[met]] = known.add(list(compress(names, met)), before.ids, before.starts[again], before.lengths[again])
        missing, names = missing[~met], list(compress(names, ~met))
        if not names:
            return known.ids, known.starts[numbers], known.lengths[numbers]
        ids, starts, lengths = self.learn(names)
        short = np.fromiter(map(len, names), np.int64, len(names)) <= LONGEST_REMEMBERED
        numbers[missing[short]] = known.add(list(compress(names, short)), ids, starts[short], lengths[short])
        if short.all():
            return known.ids, known.starts[numbers], known.lengths[numbers]
        # Those not remembered have no number; their ids follow the others.
        out_starts, out_lengths = known.starts[numbers], known.lengths[numbers]
        long = missing[~short]
        out_starts[long], out_lengths[long] = starts[~short] + len(known.ids), lengths[~short]
        return np.concatenate([known.ids, ids]), out_starts, out_lengths


class PieceTable:
    """Ids of texts as arrays of type `kind`, looked up piece by piece."""

    def __init__(
        self, learn: Callable[[list[str]], dict[str, bytes]], kind: str, remembered: int, slice_bytes: int = SLICE_BYTES
    ):
        self.ids, self.kind, self.slice_bytes = Memory(learn, remembered), np.dtype(kind), slice_bytes

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, offsets of the rows) of runs of texts, in order; a null is an empty text."""
        texts = texts.fill_null("")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        row = 0
        while row < len(texts):
            limit = (ends[row - 1] if row else 0) + self.slice_bytes
            end = max(row + 1, int(np.searchsorted(ends, limit, "right")))
            lists = pc.ascii_split_whitespace(texts.slice(row, end - row))
            ids, stops = gathered(*self._looked_up(lists.flatten().dictionary_encode()))
            places = lists.offsets.to_numpy()
            yield ids, np.concatenate([[0], stops])[places - places[0]]
            row = end

    def _looked_up(self, coded: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An array of ids, and where in it those of each piece begin and how many they are."""
        found = self.ids(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        code = coded.indices.to_numpy()
        return np.frombuffer(b"".join(found), self.kind), (np.cumsum(lengths) - lengths)[code], lengths[code]


class ArrayTable(PieceTable):
    """A table over an `ArrayMemory`. Pieces to which `same` gives the same text are looked up as one."""

    def __init__(self, memory: ArrayMemory, slice_bytes: int, same: Callable[[pa.Array], pa.Array]):
        self.ids, self.slice_bytes, self.same = memory, slice_bytes, same

    def _looked_up(self, coded: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        distinct = self.same(coded.dictionary).dictionary_encode()
        store, starts, lengths = self.ids(distinct.dictionary.to_numpy(zero_copy_only=False).tolist())
        code = distinct.indices.to_numpy()[coded.indices.to_numpy()]
        return store, starts[code], lengths[code]
