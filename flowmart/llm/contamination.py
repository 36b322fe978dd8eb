"""Benchmark decontamination as a prefix-filtered set join.

A window is a run of 13 words of an item, or all words of a shorter item. The shingles of
a window (three words, or all of a shorter window) are ordered by how often they occur in
all documents. A document window equals an item window only if all shingles are shared,
so a prefix of one shingle, the rarest, is necessary. Documents look their shingles up in
the index of prefixes; a match at a place gives the window's only possible start, which
must leave room for the whole window inside the document; then all words are compared.

The index is broadcast in blocks of at most about `BLOCK_WINDOWS` windows, whatever the
size of the benchmark; each block adds its findings to the documents' rows in one more
narrow step, so documents are neither shuffled nor joined.

Defined cases: a null text has no words. A document without words is not hit. An item
without words has no window; items that repeat an item_id count as one, a null item_id is
written as an empty text. Every document row is decided alone, so repeats and null ids
have no effect. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowmart.llm.arrow import bound_batches, map_arrow, text_function, unused
from flowmart.llm.words import ALPHANUMERIC, shingles, text_buffers, word_slices
from flowmart.session import Scratch

WINDOW = 13
SHINGLE = 3
#: Windows of one broadcast block: 13 words of 8 bytes each, 14 MB.
BLOCK_WINDOWS = 1 << 17

FOUND = "struct<n_words:bigint,spans:array<bigint>,items:array<string>>"


def _windows(batches: Iterator[pa.RecordBatch], length: int, size: int) -> Iterator[pa.RecordBatch]:
    """(item, words, tokens) per window of every item; tokens are its shingles, in place."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for row, names, offsets in word_slices(batch.column(1), ALPHANUMERIC):
            for k in range(len(offsets) - 1):
                words = names[offsets[k] : offsets[k + 1]]
                if not len(words):
                    continue
                wide = min(length, len(words))
                tokens, _ = shingles(words, np.array([0, len(words)]), min(size, wide))
                starts = np.arange(len(words) - wide + 1)
                for part in np.array_split(starts, max(1, len(starts) >> 12)):
                    w = words[part[:, None] + np.arange(wide)]
                    t = tokens[part[:, None] + np.arange(wide - min(size, wide) + 1)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids[row + k]] * len(part), pa.string()),
                            pa.FixedSizeListArray.from_arrays(pa.array(w.ravel().view(np.int64)), wide).cast(pa.list_(pa.int64())),
                            pa.FixedSizeListArray.from_arrays(pa.array(t.ravel().view(np.int64)), t.shape[1]).cast(pa.list_(pa.int64())),
                        ],
                        names=["item", "words", "tokens"],
                    )


class _Lookup:
    """Places of values in a sorted list; a bit table answers for most of the absent ones."""

    BITS = 22

    def __init__(self, values: np.ndarray):
        self.values = values
        self.table = np.zeros(1 << self.BITS, bool)
        self.table[self._low(values)] = True

    def _low(self, values: np.ndarray) -> np.ndarray:
        return (values >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in `queries` that are listed, and their places in the list."""
        at = np.flatnonzero(self.table[self._low(queries)])
        place = np.minimum(np.searchsorted(self.values, queries[at]), len(self.values) - 1)
        hit = self.values[place] == queries[at]
        return at[hit], place[hit]


def _token_places(names: np.ndarray, offsets: np.ndarray, sizes: list[int], look: _Lookup):
    """(first word, place in the list, size) of listed shingles that lie inside one text."""
    for size in sizes:
        if len(names) < size:
            continue
        made, _ = shingles(names, np.array([0, len(names)]), size)
        at, place = look(made)
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + size <= offsets[row + 1]
        yield at[inside], place[inside], size


def _count_tokens(batches: Iterator[pa.RecordBatch], tokens, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """(token, occurrences) of this task's documents."""
    look = _Lookup(tokens.value)
    counts = np.zeros(len(tokens.value), np.int64)
    for batch in batches:
        for _, names, offsets in word_slices(batch.column(0), ALPHANUMERIC):
            for _, place, _ in _token_places(names, offsets, sizes, look):
                counts += np.bincount(place, minlength=len(counts))
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(tokens.value[used].view(np.int64)), pa.array(counts[used])], names=["token", "n"]
    )


def _expand(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All members of the ranges, and the range each comes from."""
    sizes = ends - starts
    source = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(source)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes), source


def _find(texts: pa.Array, index: dict, look: _Lookup) -> pa.Array:
    """Word count, hit spans [start, end, start, end, ...] and items of each text."""
    n_words, span_lists, item_lists = [], [], []
    ids = index["ids"]
    for _, names, offsets in word_slices(texts, ALPHANUMERIC):
        rows = len(offsets) - 1
        cover = np.zeros(len(names) + 1, np.int64)
        found_rows, found_windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at, place, size in _token_places(names, offsets, index["sizes"], look):
            entry, source = _expand(index["token_starts"][place], index["token_starts"][place + 1])
            first = at[source] - index["offset"][entry]
            length = index["length"][entry]
            row = np.searchsorted(offsets, at[source], "right") - 1
            room = (index["size"][entry] == size) & (first >= offsets[row]) & (first + length <= offsets[row + 1])
            entry, first, length, row = entry[room], first[room], length[room], row[room]
            same = np.ones(len(entry), bool)
            for k in range(index["words"].shape[1]):
                inside = np.flatnonzero(same & (k < length))
                same[inside] = names[first[inside] + k] == index["words"][entry[inside], k]
            np.add.at(cover, first[same], 1)
            np.add.at(cover, first[same] + length[same], -1)
            found_rows.append(row[same])
            found_windows.append(entry[same])
        hit = np.cumsum(cover[:-1]) > 0
        n_words.append(np.diff(offsets))
        row = np.concatenate(found_rows)
        window = np.concatenate(found_windows)
        by_row: dict[int, set] = {}
        for r, w in set(zip(row.tolist(), window.tolist(), strict=True)):
            a, b = index["item_starts"][w], index["item_starts"][w + 1]
            by_row.setdefault(r, set()).update(index["items"][a:b].tolist())
        for r in range(rows):
            if r in by_row:
                mine = np.concatenate([[False], hit[offsets[r] : offsets[r + 1]], [False]])
                span_lists.append(np.flatnonzero(mine[1:] != mine[:-1]).tolist())
                item_lists.append([ids[i] for i in sorted(by_row[r])])
            else:
                span_lists.append([])
                item_lists.append([])
    return pa.StructArray.from_arrays(
        [
            pa.array(np.concatenate(n_words) if n_words else np.zeros(0, np.int64), pa.int64()),
            pa.array(span_lists, pa.list_(pa.int64())),
            pa.array(item_lists, pa.list_(pa.string())),
        ],
        names=["n_words", "spans", "items"],
    )


def _index(rows: list, counts: dict[int, int], size: int) -> dict:
    """Windows sorted by their rarest token. `rows` has (words, tokens, items), one per window."""
    length = np.array([len(r.words) for r in rows], np.int64)
    wide = int(length.max())
    words = np.zeros((len(rows), wide), np.int64)
    rarest, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    for k, row in enumerate(rows):
        words[k, : len(row.words)] = row.words
        offset[k] = min(range(len(row.tokens)), key=lambda i: (counts.get(row.tokens[i], 0), row.tokens[i], i))
        rarest[k] = row.tokens[offset[k]]
    order = np.argsort(rarest.view(np.uint64), kind="stable")
    ids = sorted({i for row in rows for i in row.items})
    number = {i: k for k, i in enumerate(ids)}
    items = [[number[i] for i in rows[k].items] for k in order]
    tokens, starts = np.unique(rarest.view(np.uint64)[order], return_index=True)
    return {
        "tokens": tokens,
        "token_starts": np.append(starts, len(rows)).astype(np.int64),
        "offset": offset[order],
        "length": length[order],
        "size": np.minimum(length[order], size),
        "sizes": sorted({int(x) for x in np.minimum(length, size)}),
        "words": words[order].view(np.uint64),
        "ids": ids,
        "items": np.array([i for x in items for i in x], np.int64),
        "item_starts": np.concatenate([[0], np.cumsum([len(x) for x in items])]).astype(np.int64),
    }


def _merged(spans: list[list[int]]) -> int:
    """Words that lie in any span."""
    total, reached = 0, 0
    for start, end in sorted(p for s in spans for p in zip(s[::2], s[1::2], strict=True)):
        total += max(0, end - max(start, reached))
        reached = max(reached, end)
    return total


def _union(*columns: pa.Array) -> pa.Array:
    lists = [c.to_pylist() for c in columns]
    return pa.array([_merged(list(row)) for row in zip(*lists, strict=True)], pa.int64())


def _count_words(texts: pa.Array) -> pa.Array:
    counts = [np.diff(offsets) for _, _, offsets in word_slices(texts, ALPHANUMERIC)]
    return pa.array(np.concatenate(counts) if counts else np.zeros(len(text_buffers(texts)[1]) - 1, np.int64), pa.int64())


def benchmark_blocks(
    docs: DataFrame, benchmark: DataFrame, length: int = WINDOW, size: int = SHINGLE, block_windows: int = BLOCK_WINDOWS
) -> Iterator[dict]:
    """Indexes of the benchmark's windows, block by block."""
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
        kind = "item string, words array<bigint>, tokens array<bigint>"
        made = map_arrow(items, lambda batches: _windows(batches, length, size), kind).distinct()
        made = scratch.pin(made.withColumn("part", F.xxhash64("words")), "windows")
        # Windows are counted with their items, so a window that all items share fits its block too.
        blocks = max(1, -(-made.count() // block_windows))
        made = made.withColumn("part", F.pmod("part", F.lit(blocks)))
        for block in range(blocks):
            rows = made.where(F.col("part") == block).groupBy("words").agg(
                F.first("tokens").alias("tokens"), F.sort_array(F.collect_set("item")).alias("items")
            ).collect()
            if not rows:
                continue
            sizes = sorted({min(len(r.words), size) for r in rows})
            listed = np.unique(np.array([t for r in rows for t in r.tokens], np.int64).view(np.uint64))
            tokens = spark.sparkContext.broadcast(listed)
            counts = map_arrow(
                docs.select("text"), lambda batches, t=tokens, s=sizes: _count_tokens(batches, t, s), "token bigint, n bigint"
            )
            counted = {r.token: r.n for r in counts.groupBy("token").agg(F.sum("n").alias("n")).collect()}
            yield _index(rows, counted, size)


def with_contamination(docs: DataFrame, benchmark: DataFrame, name: str = "contamination", **options) -> DataFrame:
    """`docs` with one more column: n_words, n_hit, n_items, items (sorted ids), contaminated."""
    spark = docs.sparkSession
    bound_batches(spark)
    found: list[Column] = []

    def search(index: dict) -> Column:
        held = spark.sparkContext.broadcast(index)

        def prepare():
            look = _Lookup(held.value["tokens"])
            return lambda texts: _find(texts, held.value, look)

        return text_function(prepare, FOUND)("text")

    found = [search(index) for index in benchmark_blocks(docs, benchmark, **options)]
    if found:
        n_words = found[0]["n_words"]
        items = F.array_sort(F.array_distinct(F.concat(*[f["items"] for f in found])))
        if len(found) > 1:
            n_hit = text_function(lambda: _union, "bigint")(*[f["spans"] for f in found])
        else:  # a text's spans don't overlap: starts at even places, ends at odd ones
            n_hit = F.aggregate(found[0]["spans"], F.lit(0).cast("bigint"), lambda total, at: at - total)
    else:
        n_words, n_hit = text_function(lambda: _count_words, "bigint")("text"), F.lit(0).cast("bigint")
        items = F.array().cast("array<string>")
    return docs.withColumn(
        name,
        F.struct(
            n_words.alias("n_words"),
            n_hit.alias("n_hit"),
            F.size(items).cast("bigint").alias("n_items"),
            items.alias("items"),
            ((n_hit > 0) & (20 * n_hit >= n_words)).alias("contaminated"),
        ),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of `docs` that are not contaminated, with all their columns."""
    name = unused(docs, "_contamination")
    marked = with_contamination(docs, benchmark, name, **options)
    return marked.where(~F.col(name)["contaminated"]).drop(name)
