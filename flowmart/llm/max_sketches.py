"""Ranked lexical search with hashed max-sketches.

Every document is folded into a sketch: each distinct term falls on one coordinate of two
regions, as wide as the document has terms, and a coordinate keeps the largest impact of its
terms. The impact of a term grows with its occurrences, and all else in it is the same
throughout a document, so occurrences are what is kept, in a byte each (255: any number).
The sketches are a table, the index; it serves any queries.

Queries are looked up in batches: the smaller of a term's two coordinates bounds its impact,
and the weighted sum over an item's terms bounds the document's score.

1. Each task keeps the best documents by bound; the best of all are scored on their texts.
   The k-th best of these scores is a threshold: a document whose bound is below can't rank.
2. The others are looked up again, joined with their texts and scored in the order of falling
   bounds. Each score may raise the task's threshold, and where bounds fall below, it stops.
   Each task hands on its k best an item, of which the k best of all are the result.

Counts of documents per term go over all documents; a bit table of fixed size, of the hashes
of all queried terms, keeps the others from being counted. A batch of queries is bounded in
items and terms, and the index is read twice per batch.

Defined cases: a row is a document; rows that repeat doc_id and text rank one after another.
Equal scores rank by doc_id, missing ones first, then by a hash of the text. Documents and
items without terms, null or empty, rank nowhere and have no rows. Each row of the items is
a query of its own, also where item_id is missing or repeated. Other columns play no part
and may have any name. Terms are told apart by 64 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowmart.llm.arrow import bound_batches, text_function
from flowmart.llm.words import ALPHANUMERIC, word_slices
from flowmart.session import Scratch

#: Items and distinct terms of a batch of queries; a longer item is a batch of its own.
BATCH_ITEMS, BATCH_TERMS = 256, 1 << 16
#: Bits of the table of queried terms: 1 MB.
TABLE_BITS = 23
#: Occurrences a coordinate can tell; the last value stands for any more.
MOST = 255
SCALE = 10**9
MAX_IMPACT = 10**6
NARROWEST = 16
#: Cells of a table of documents by terms, and pairs scored at a time.
TABLE_CELLS, PAIRS = 1 << 19, 1 << 12
#: Term counts a task holds before it hands them on.
HELD_COUNTS = 1 << 20
SALTS = 32

INDEX = "doc_id bigint, mark bigint, n bigint, sketch binary, term bigint, df bigint"


def term_counts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, words per row, row of each distinct term, the term, its occurrences) of runs of texts."""
    for first, names, offsets in word_slices(column, ALPHANUMERIC):
        rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        order = np.lexsort((names, rows))
        names = names[order]
        new = np.ones(len(names), bool)
        new[1:] = (names[1:] != names[:-1]) | (rows[1:] != rows[:-1])
        at = np.flatnonzero(new)
        yield first, np.diff(offsets), rows[at], names[at], np.diff(np.append(at, len(names)))


def _bit(terms: np.ndarray) -> np.ndarray:
    return (terms >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _width(distinct: np.ndarray) -> np.ndarray:
    """Coordinates of a region: the next power of two."""
    return np.maximum(NARROWEST, 1 << np.ceil(np.log2(np.maximum(distinct, 1))).astype(np.int64))


def _coordinates(terms: np.ndarray, width: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """A term's place in both regions."""
    mask = np.uint64(width - 1) if np.isscalar(width) else (width - 1).astype(np.uint64)
    return (terms & mask).astype(np.int64), ((terms >> np.uint64(24)) & mask).astype(np.int64) + width


def _indexed(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sketches of documents, and counts of documents per term of the table."""
    terms, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]

    def summed() -> None:
        every, at = np.unique(np.concatenate(terms), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts), len(every)).astype(np.int64)
        terms[:], counts[:] = [every], [total]

    def handed() -> pa.RecordBatch:
        summed()
        columns = [pa.nulls(len(terms[0]), pa.int64())] * 3 + [pa.nulls(len(terms[0]), pa.binary())]
        out = pa.RecordBatch.from_arrays(
            [*columns, pa.array(terms[0].view(np.int64)), pa.array(counts[0])],
            names=["doc_id", "mark", "n", "sketch", "term", "df"],
        )
        terms[:], counts[:] = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        return out

    for batch in batches:
        for first, n, rows, names, times in term_counts(batch.column("text")):
            width = _width(np.bincount(rows, minlength=len(n)))
            starts = np.concatenate([[0], np.cumsum(2 * width)])
            sketch = np.zeros(starts[-1], np.uint8)
            for place in _coordinates(names, width[rows]):
                np.maximum.at(sketch, starts[rows] + place, np.minimum(times, MOST).astype(np.uint8))
            part = batch.slice(first, len(n))
            binary = pa.Array.from_buffers(
                pa.binary(), len(n), [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(sketch)]
            )
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("mark"), pa.array(n.astype(np.int64)), binary, none, none],
                names=["doc_id", "mark", "n", "sketch", "term", "df"],
            )
            seen, df = np.unique(names[table[_bit(names)]], return_counts=True)
            terms.append(seen)
            counts.append(df)
        if sum(map(len, terms)) > HELD_COUNTS:
            summed()
            if len(terms[0]) > HELD_COUNTS // 2:
                yield handed()
    if sum(map(len, terms)):
        yield handed()


@dataclass(frozen=True)
class Queries:
    """A batch of items: their terms, one after another, as places in the sorted vocabulary."""

    ids: np.ndarray
    vocabulary: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    starts: np.ndarray
    documents: int
    words: int

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """The `m` of documents of `n` terms."""
        return 50 + (50 * n * self.documents) // self.words

    def bounds(self, n: np.ndarray, sketches: pa.Array) -> np.ndarray:
        """Upper bounds of the scores, documents by items."""
        out = np.zeros((len(n), len(self.ids)), np.int64)
        data = np.frombuffer(sketches.buffers()[2] or b"", np.uint8)
        offsets = np.frombuffer(sketches.buffers()[1], np.int32)[sketches.offset : sketches.offset + len(n) + 1]
        widths = np.diff(offsets) // 2
        m = self.lengths(n)
        times = np.arange(MOST + 1)
        for width in np.unique(widths):
            one, two = _coordinates(self.vocabulary, int(width))
            same = np.flatnonzero((widths == width) & (n > 0))
            strip = max(1, TABLE_CELLS // max(len(self.vocabulary), len(self.terms), 2 * int(width)))
            for rows in np.array_split(same, max(1, -(-len(same) // strip))):
                table = data[offsets[rows][:, None] + np.arange(2 * width)]
                most = np.minimum(table[:, one], table[:, two])
                impacts = impact(times, m[rows][:, None])
                impacts[:, MOST] = MAX_IMPACT
                parts = np.take_along_axis(impacts, most.astype(np.intp), axis=1)[:, self.terms]
                out[rows] = np.add.reduceat(parts * self.weights, self.starts[:-1], axis=1)
        return out

    def scores(self, impacts: np.ndarray, rows: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Exact scores of pairs; `impacts` has documents by vocabulary."""
        lengths = np.diff(self.starts)[items]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(self.starts[items] - ends + lengths, lengths)
        parts = impacts[np.repeat(rows, lengths), self.terms[at]] * self.weights[at]
        return np.add.reduceat(parts, ends - lengths)


def impact(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (SCALE * times) // (1000 * times + 20 * m)


class Best:
    """The best documents of each item so far, by (value falling, doc_id, mark)."""

    def __init__(self, items: int, k: int, least: np.ndarray | None = None):
        self.k = k
        self.least = np.ones(items, np.int64) if least is None else np.maximum(least, 1)
        self.held = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, bool)]

    def add(self, items: np.ndarray, values: np.ndarray, ids: np.ndarray, marks: np.ndarray, named: np.ndarray) -> None:
        good = values >= self.least[items]
        if not good.any():
            return
        new = [x[good] for x in (items, values, ids, marks, named)]
        item, value, doc, mark, has = (np.concatenate(x) for x in zip(self.held, new, strict=True))
        order = np.lexsort((mark, doc, has, -value, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        full = rank == self.k - 1
        self.least[item[full]] = np.maximum(self.least[item[full]], value[order][full])
        keep = order[rank < self.k]
        self.held = [item[rank < self.k], value[keep], doc[keep], mark[keep], has[keep]]

    def rows(self, ids: np.ndarray) -> pa.RecordBatch:
        item, value, doc, mark, has = self.held
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[item]), pa.array(doc, mask=~has), pa.array(mark), pa.array(value)],
            names=["query", "doc_id", "mark", "value"],
        )


FOUND = "query bigint, doc_id bigint, mark bigint, value bigint"


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.fill_null(0).to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)


def _best_bounds(batches: Iterator[pa.RecordBatch], queries: Queries, k: int) -> Iterator[pa.RecordBatch]:
    best = Best(len(queries.ids), k)
    for batch in batches:
        if not batch.num_rows:
            continue
        bounds = queries.bounds(batch.column("n").to_numpy(), batch.column("sketch"))
        rows, items = np.nonzero(bounds >= best.least)
        ids, named = _ids(batch.column("doc_id"))
        best.add(items, bounds[rows, items], ids[rows], batch.column("mark").to_numpy()[rows], named[rows])
    yield best.rows(queries.ids)


def _above(batches: Iterator[pa.RecordBatch], queries: Queries, least: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Documents with items whose bound reaches `least`, and these bounds."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bounds = queries.bounds(batch.column("n").to_numpy(), batch.column("sketch"))
        rows, items = np.nonzero(bounds >= least)
        counts = np.bincount(rows, minlength=batch.num_rows)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        listed = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (items.astype(np.int16), bounds[rows, items])]
        out = pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), *listed], names=["doc_id", "mark", "items", "bounds"]
        )
        yield out.filter(pa.array(counts > 0))


def _rescored(batches: Iterator[pa.RecordBatch], queries: Queries, least: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """The task's best documents by exact score; pairs come in the order of falling bounds."""
    best = Best(len(queries.ids), k, least)
    strip = max(1, TABLE_CELLS // len(queries.vocabulary))
    for batch in batches:
        ids, named = _ids(batch.column("doc_id"))
        marks = batch.column("mark").to_numpy()
        listed = batch.column("items")
        for first, n, rows, names, times in term_counts(batch.column("text")):
            place = np.minimum(np.searchsorted(queries.vocabulary, names), len(queries.vocabulary) - 1)
            asked = queries.vocabulary[place] == names
            rows, place, times = rows[asked], place[asked], times[asked]
            value = impact(times, queries.lengths(n)[rows])
            for low in range(0, len(n), strip):
                high = min(low + strip, len(n))
                a, b = np.searchsorted(rows, [low, high])
                table = np.zeros((high - low, len(queries.vocabulary)), np.int64)
                table[rows[a:b] - low, place[a:b]] = value[a:b]
                here = listed.slice(first + low, high - low)
                pair_rows = np.repeat(np.arange(high - low), here.value_lengths().to_numpy())
                pair_items = here.flatten().to_numpy().astype(np.int64)
                bounds = batch.column("bounds").slice(first + low, high - low).flatten().to_numpy()
                order = np.argsort(-bounds, kind="stable")
                for start in range(0, len(order), PAIRS):
                    some = order[start : start + PAIRS]
                    some = some[bounds[some] >= best.least[pair_items[some]]]
                    if not len(some):
                        continue
                    r, q = pair_rows[some], pair_items[some]
                    doc = first + low + r
                    best.add(q, queries.scores(table, r, q), ids[doc], marks[doc], named[doc])
    yield best.rows(queries.ids)


def _top(found: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first `k` rows a query, in two steps so that no task sees all rows of one."""
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order)))
    every = some.where(F.col("rank") <= k).drop("salt", "rank")
    ranked = every.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def _term_table(terms: DataFrame) -> np.ndarray:
    """Bits of the hashes of all queried terms; of fixed size, so it may go to the driver."""
    bits = terms.select(F.shiftrightunsigned("term", 64 - TABLE_BITS).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 5)).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))"))
    table = np.zeros((1 << TABLE_BITS) // 32, np.uint32)
    for word, bits in words.collect():
        table[word] = bits
    return np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)


def _batches(weights: DataFrame, documents: int, words: int) -> Iterator[Queries]:
    """Batches of the items' weighted terms; one batch at a time is on the driver."""

    def made() -> Queries:
        terms = np.array(held["term"], np.int64).view(np.uint64)
        vocabulary, at = np.unique(terms, return_inverse=True)
        ids, starts = np.unique(np.array(held["query"], np.int64), return_index=True)
        return Queries(
            ids, vocabulary, at, np.array(held["weight"], np.int64), np.append(starts, len(terms)), documents, words
        )

    held: dict[str, list] = {"query": [], "term": [], "weight": []}
    items, last = 0, None
    for row in weights.orderBy("query").toLocalIterator():
        if row["query"] != last:
            if items == BATCH_ITEMS or len(held["term"]) >= BATCH_TERMS:
                yield made()
                held, items = {name: [] for name in held}, 0
            items, last = items + 1, row["query"]
        for name, values in held.items():
            values.append(row[name])
    if items:
        yield made()


def rank(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The `k` best documents of each item: item_id, rank (from 1), doc_id, score, text_mark (xxhash64)."""
    spark = docs.sparkSession
    bound_batches(spark)

    def distinct_terms(column: pa.Array) -> pa.Array:
        parts = [(np.bincount(rows, minlength=len(n)), names) for _, n, rows, names, _ in term_counts(column)]
        offsets = np.concatenate([[0], *(counts for counts, _ in parts)]).cumsum().astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.uint64), *(names for _, names in parts)])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))

    terms_of = text_function(lambda: distinct_terms, "array<bigint>")
    best_first = [F.desc("value"), F.asc("doc_id"), F.asc("mark")]
    with Scratch(spark) as scratch:
        asked = scratch.pin(
            items.select("item_id", terms_of("text").alias("terms")).withColumn("query", F.monotonically_increasing_id()),
            "items",
        )
        terms = asked.select("query", F.explode("terms").alias("term"))
        table = _term_table(terms)
        rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))
        made = scratch.pin(rows.mapInArrow(lambda batches: _indexed(batches, table), INDEX), "index")
        index = made.where("sketch is not null").select("doc_id", "mark", "n", "sketch")
        documents, words = index.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

        counted = made.where("term is not null").groupBy("term").agg(F.sum("df").alias("df"))
        weight = F.floor(1000 * F.log(F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double")))
        weights = terms.join(counted, "term").select("query", "term", weight.alias("weight"))
        weights = scratch.pin(weights.where("weight > 0"), "weights")

        def scored(candidates: DataFrame, queries: Queries, least: np.ndarray) -> DataFrame:
            once = candidates.withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})
            same = [rows.doc_id.eqNullSafe(once._id), rows.mark == once._mark]
            joined = rows.join(once, same).select("doc_id", "text", "mark", "items", "bounds")
            return joined.mapInArrow(lambda batches: _rescored(batches, queries, least, k), FOUND)

        results = spark.createDataFrame([], FOUND + ", rank int")
        for number, queries in enumerate(_batches(weights, documents, words)):
            none = np.zeros(len(queries.ids), np.int64)
            place = {int(q): i for i, q in enumerate(queries.ids)}
            bounds = index.mapInArrow(lambda batches, queries=queries: _best_bounds(batches, queries, k), FOUND)
            listed = F.create_map(*[F.lit(x) for pair in place.items() for x in pair])[F.col("query")].cast("smallint")
            # At most k documents an item, of a bounded batch of items.
            seeds = _top(bounds, k, *best_first).groupBy("doc_id", "mark").agg(
                F.collect_list(F.struct(listed.alias("item"), "value")).alias("pairs")
            )
            seeds = scratch.pin(
                seeds.select("doc_id", "mark", F.col("pairs.item").alias("items"), F.col("pairs.value").alias("bounds")),
                "seeds",
            )
            first = _top(scored(F.broadcast(seeds), queries, none), k, *best_first).where(F.col("rank") == k)
            least = none.copy()
            for row in first.collect():
                least[place[row["query"]]] = row["value"]
            least = np.maximum(least, 1)
            above = index.mapInArrow(
                lambda batches, queries=queries, least=least: _above(batches, queries, least),
                "doc_id bigint, mark bigint, items array<smallint>, bounds array<bigint>",
            )
            found = scratch.pin(_top(scored(above.dropDuplicates(["doc_id", "mark"]), queries, least), k, *best_first), f"found-{number}")
            scratch.keep(f"found-{number}")
            results = found if not number else results.unionByName(found)
        scratch.keep("items")
        return results.join(asked.select("query", "item_id"), "query").select(
            "item_id", "rank", "doc_id", F.col("value").alias("score"), F.col("mark").alias("text_mark")
        )
