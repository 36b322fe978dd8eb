"""Near-duplicate detection with HyperMinHash sketches.

1. Each text becomes a set of 64-bit shingle names and a sketch (`hyperminhash`). Texts
   with equal sets are one class from then on.
2. Each band of four registers is a bucket key. Classes that share a bucket with another
   one get their full sets, read again from the texts.
3. In each bucket every class is paired with one centre (that of most copies). Pairs
   whose estimate, corrected for chance agreement, can belong to the threshold are
   verified on full sets. Verified links give first components.
4. Buckets that still hold several components are compared without their centre, in
   blocks of bounded size, class by class of different components. Before sets are
   compared, the estimate and an exact bound must allow the link: the names are dealt to
   256 cells, and each cell whose sums differ shows a shingle that only one has.
5. Components of all links; their smallest doc_id names them.

Pairs inside one component of step 3 are not looked at again, which loses no component.
A link of the threshold similarity s escapes all bands with probability (1 - s^4)^32:
1e-10 at 0.85, 5e-8 at 0.8. The estimate may be off by 4.7 standard deviations.

Defined cases: null and empty texts and texts without words have no shingles and link
with nothing, their component is their own doc_id. Texts of fewer words than a shingle
has are one shingle. Rows that repeat a doc_id are told apart by their texts; equal rows
share one result. A component whose rows all lack doc_id has a null name, its rows count
as kept. `near_dedup` leaves one of equal rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowmart.llm import hyperminhash
from flowmart.llm.arrow import bound_batches, map_arrow, text_function, unused
from flowmart.llm.links import components
from flowmart.llm.words import SPACED, distinct, shingles, word_slices
from flowmart.session import Scratch

#: Standard deviations by which an estimate may miss.
DEVIATIONS = 4.7
#: Members of a bucket that are compared with as many others at a time.
BLOCK_MEMBERS = 1024
CELLS = 256

SKETCH = "struct<n:bigint,first:bigint,second:bigint,bands:array<bigint>>"
SET = "struct<shingles:array<bigint>,cells:binary>"


def text_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle names of each text."""
    for _, names, offsets in word_slices(column, SPACED):
        made, bounds = shingles(names, offsets, size)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield distinct(made[a:b])


def _lists(values: np.ndarray, lengths: list[int]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _sketches(column: pa.Array, size: int) -> pa.Array:
    numbers, bands, lengths = [], [], []
    for items in text_sets(column, size):
        if len(items):
            numbers.append((len(items), np.bitwise_xor.reduce(items), np.sum(items * (items | np.uint64(1)))))
            bands.append(hyperminhash.bands(hyperminhash.registers(items)))
        else:
            numbers.append((0, 0, 0))
        lengths.append(hyperminhash.BANDS if len(items) else 0)
    table = np.array(numbers, dtype=np.uint64).reshape(-1, 3).view(np.int64)
    flat = np.concatenate(bands) if bands else np.zeros(0, np.uint64)
    return pa.StructArray.from_arrays(
        [*(pa.array(np.ascontiguousarray(table[:, k])) for k in range(3)), _lists(flat, lengths)],
        names=["n", "first", "second", "bands"],
    )


def _cells(items: np.ndarray) -> bytes:
    """Sum of the low bytes of the names in each of 256 cells, modulo 256."""
    cell = (items >> np.uint64(8)) & np.uint64(CELLS - 1)
    low = (items & np.uint64(255)).astype(np.float64)
    return np.bincount(cell.astype(np.int64), low, CELLS).astype(np.uint64).astype(np.uint8).tobytes()


def _sets(column: pa.Array, size: int) -> pa.Array:
    sets = list(text_sets(column, size))
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return pa.StructArray.from_arrays(
        [_lists(flat, [len(s) for s in sets]), pa.array([_cells(s) for s in sets], pa.binary())],
        names=["shingles", "cells"],
    )


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False) if pa.types.is_list(column.type) else b"".join(column.to_pylist())
    return np.frombuffer(np.ascontiguousarray(flat).tobytes() if not isinstance(flat, bytes) else flat, kind).reshape(-1, width)


def least_estimate(percent: int) -> float:
    share = percent / 100
    return share - DEVIATIONS * math.sqrt(share * (1 - share) / hyperminhash.BUCKETS)


def least_shared(total: np.ndarray, percent: int) -> np.ndarray:
    """Shared shingles that sets of `total` shingles together need."""
    return -(-percent * total // (100 + percent))


def _estimates(left: pa.Array, right: pa.Array) -> pa.Array:
    a = _matrix(left, np.uint16, hyperminhash.BUCKETS)
    b = _matrix(right, np.uint16, hyperminhash.BUCKETS)
    return pa.array(hyperminhash.estimate(a, b))


def _verified(left: pa.Array, right: pa.Array, percent: int) -> pa.Array:
    out = np.zeros(len(left), bool)
    a_bounds, b_bounds = left.offsets.to_numpy(), right.offsets.to_numpy()
    a_all, b_all = left.values.to_numpy(), right.values.to_numpy()
    for k in range(len(left)):
        a, b = a_all[a_bounds[k] : a_bounds[k + 1]], b_all[b_bounds[k] : b_bounds[k + 1]]
        both = np.sort(np.concatenate([a, b]))
        shared = np.count_nonzero(both[1:] == both[:-1])
        out[k] = 100 * shared >= percent * (len(both) - shared)
    return pa.array(out)


class _Members:
    """Rows of one block as arrays."""

    def __init__(self, rows: pa.RecordBatch):
        self.node = rows.column("node").to_numpy()
        self.component = rows.column("component").to_numpy()
        self.n = rows.column("n").to_numpy()
        self.side = rows.column("side").to_numpy(zero_copy_only=False)
        self.bands = _matrix(rows.column("bands"), np.int64, hyperminhash.BANDS)
        self.registers = self.bands.view(np.uint16)
        self.cells = _matrix(rows.column("cells"), np.uint8, CELLS)

    def pairs(self, band: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Node pairs of different components whose estimate and bound allow a link.

        A pair that meets in several buckets comes from that of its first common band.
        """
        left, right = np.flatnonzero(self.side != 1), np.flatnonzero(self.side != 0)
        found: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
        # Rows of a strip times columns: bounded, however many pairs fail.
        for strip in np.array_split(left, max(1, len(left) * len(right) // (1 << 18))):
            a, b = (x.ravel() for x in np.meshgrid(strip, right, indexing="ij"))
            keep = (self.component[a] != self.component[b]) & (
                (self.side[a] != 2) | (self.side[b] != 2) | (self.node[a] < self.node[b])
            )
            a, b = a[keep], b[keep]
            total = self.n[a] + self.n[b]
            need = least_shared(total, percent)
            keep = np.minimum(self.n[a], self.n[b]) >= need
            for part in np.array_split(np.flatnonzero(keep), max(1, len(a) // (1 << 14))):
                x, y = a[part], b[part]
                apart = np.count_nonzero(self.cells[x] != self.cells[y], axis=1)
                good = apart <= total[part] - 2 * need[part]
                x, y = x[good], y[good]
                good = hyperminhash.estimate(self.registers[x], self.registers[y]) >= least_estimate(percent)
                x, y = x[good], y[good]
                good = ~(self.bands[x, :band] == self.bands[y, :band]).any(axis=1)
                found.append(np.stack([self.node[x[good]], self.node[y[good]]], axis=1))
        both = np.concatenate(found)
        return both[:, 0], both[:, 1]


def _block_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of every block; rows come sorted by block, and a block is of bounded size."""
    keys = ["band", "key", "low", "high"]
    held: list[pa.RecordBatch] = []

    def flush(table: pa.Table, end: bool) -> tuple[list[pa.RecordBatch], pa.Table]:
        cut = np.ones(len(table) + 1, bool)
        same = np.ones(max(len(table) - 1, 0), bool)
        for key in keys:
            values = table.column(key).to_numpy()
            same &= values[1:] == values[:-1]
        cut[1:-1] = ~same
        cut[-1] = end
        at = np.flatnonzero(cut)
        outs = []
        for a, b in zip(at[:-1], at[1:], strict=True):
            if b - a > 1:
                rows = table.slice(a, b - a).combine_chunks().to_batches()[0]
                x, y = _Members(rows).pairs(int(rows.column("band")[0].as_py()), percent)
                if len(x):
                    outs.append(pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"]))
        return outs, table.slice(at[-1])

    for batch in batches:
        held.append(batch)
        outs, rest = flush(pa.Table.from_batches(held), False)
        held = rest.to_batches()
        yield from outs
    if held:
        yield from flush(pa.Table.from_batches(held), True)[0]


def _blocked(members: DataFrame, block: int) -> DataFrame:
    """Copies of each member for the blocks it is compared in.

    `inside` marks members of the bucket's main component; these are compared with those
    outside only. Sides: 0 and 1 are compared with each other, 2 with all.
    """
    buckets = members.groupBy("band", "key").agg(
        F.ceil(F.count_if("inside") / block).cast("int").alias("ins"),
        F.ceil(F.count_if(~F.col("inside")) / block).cast("int").alias("outs"),
    )
    rows = members.join(buckets, ["band", "key"])
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("inside"), F.col("ins")).otherwise(F.col("outs"))).cast("int")
    rows = rows.withColumn("mine", mine)
    others = F.sequence(F.lit(0), F.col("outs") - 1)

    def place(low, high, side):
        return F.struct(low.alias("low"), high.alias("high"), side.cast("int").alias("side"))

    # Inside blocks have negative numbers.
    within = F.transform(others, lambda o: place(o, -1 - F.col("mine"), F.lit(1)))
    across = F.transform(
        F.when(F.col("ins") > 0, F.sequence(F.lit(0), F.col("ins") - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: place(F.col("mine"), -1 - i, F.lit(0)),
    )
    among = F.transform(
        others,
        lambda o: place(
            F.least("mine", o), F.greatest("mine", o),
            F.when(o == F.col("mine"), 2).when(o > F.col("mine"), 0).otherwise(1),
        ),
    )
    places = F.when(F.col("inside"), within).otherwise(F.concat(across, among))
    return rows.select("band", "key", "node", "component", F.explode(places).alias("p")).select(
        "band", "key", "p.low", "p.high", "p.side", "node", "component"
    )


def near_components(docs: DataFrame, size: int = 5, percent: int = 80, block: int = BLOCK_MEMBERS) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id, kept, text_mark (xxhash64 of the text)."""
    spark = docs.sparkSession
    bound_batches(spark)
    sketch = text_function(lambda: lambda texts: _sketches(texts, size), SKETCH)
    full = text_function(lambda: lambda texts: _sets(texts, size), SET)
    estimated = text_function(lambda: _estimates, "double")
    verified = text_function(lambda: lambda a, b: _verified(a, b, percent), "boolean")
    mark = F.xxhash64(F.coalesce("text", F.lit("")))

    with Scratch(spark) as scratch:
        texts = docs.select("doc_id", "text", mark.alias("mark"))
        rows = scratch.pin(texts.withColumn("s", sketch("text")).select("doc_id", "mark", "s.*"), "sketches")
        classes = rows.where("n > 0").groupBy("n", "first", "second").agg(
            F.min(F.struct("doc_id", "mark")).alias("one"),
            F.min("doc_id").alias("smallest"),
            F.count("*").alias("copies"),
            F.first("bands").alias("bands"),
        )
        classes = scratch.pin(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

        members = classes.select("node", "copies", F.posexplode("bands").alias("band", "key"))
        busy = members.groupBy("band", "key").agg(
            F.count("*").alias("size"), F.min(F.struct(-F.col("copies"), "node")).alias("centre")
        )
        members = scratch.pin(
            members.join(busy.where("size > 1"), ["band", "key"]).select("band", "key", "node", F.col("centre.node").alias("centre")),
            "members",
        )
        nodes = members.select("node").distinct()
        chosen = scratch.pin(classes.join(nodes, "node").select("node", "n", "bands", "one.doc_id", "one.mark"), "chosen")
        same = [texts.doc_id.eqNullSafe(chosen.doc_id), texts.mark == chosen.mark]
        sets = scratch.pin(
            texts.join(chosen, same).select("node", "n", "bands", full("text").alias("s")).select("node", "n", "bands", "s.*"),
            "sets",
        )

        def confirmed(pairs: DataFrame, label: str) -> DataFrame:
            left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
            right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
            joined = pairs.join(left, "a").join(right, "b")
            return scratch.pin(joined.where(verified("left", "right")).select("a", "b"), label)

        small = chosen.select("node", "n", "bands")
        pairs = members.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
        pairs = pairs.join(small.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("bands").alias("left")), "a")
        pairs = pairs.join(small.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bands").alias("right")), "b")
        pairs = pairs.where("100 * least(n_a, n_b) >= %d * greatest(n_a, n_b)" % percent)
        pairs = pairs.where(estimated("left", "right") >= least_estimate(percent)).select("a", "b")
        first_links = confirmed(pairs, "first-links")
        first = components(first_links, scratch, "first-components")

        grouped = members.join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = grouped.groupBy("band", "key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.max(F.when(F.col("node") == F.col("centre"), F.col("component"))).alias("main"),
        )
        apart = grouped.join(mixed.where("low < high").drop("low", "high"), ["band", "key"])
        apart = scratch.pin(
            apart.select("band", "key", "node", "component", (F.col("component") == F.col("main")).alias("inside")), "apart"
        )
        blocks = _blocked(apart, block).join(sets.select("node", "n", "bands", "cells"), "node")
        keys = ["band", "key", "low", "high"]
        dealt = blocks.repartition(*keys).sortWithinPartitions(*keys)
        rest = map_arrow(dealt, lambda batches: _block_pairs(batches, percent), "a bigint, b bigint")
        rest = scratch.pin(rest, "rest")
        rest_links = confirmed(rest, "rest-links")
        scratch.drop("sets", "apart", "rest", "members", "chosen")

        chains = first.select(F.col("node").alias("a"), F.col("component").alias("b"))
        linked = components(chains.unionByName(rest_links), scratch, "components")
        named = classes.select("n", "first", "second", "node", "smallest").join(linked, "node", "left")
        named = scratch.pin(named.withColumn("component", F.coalesce("component", "node")).drop("bands"), "named")
        least = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
        named = named.join(least, "component").select("n", "first", "second", "component_id")
        whole = rows.where("n > 0").join(named, ["n", "first", "second"])
        out = whole.select("doc_id", "mark", "n", "component_id").unionByName(
            rows.where("n = 0").select("doc_id", "mark", "n", F.col("doc_id").alias("component_id"))
        )
        for label in ("sketches", "named"):
            scratch.keep(label)
        return out.select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
            F.col("mark").alias("text_mark"),
        )


def near_dedup(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Rows of `docs` that stay, one of each component, with all their columns."""
    with Scratch(docs.sparkSession) as scratch:
        found = near_components(docs, size, percent).where("kept")
        kept = found.groupBy(F.col("doc_id").alias("_kept_id"), F.col("text_mark").alias("_kept_mark"))
        kept = scratch.pin(kept.agg(F.count("*").alias("_copies")), "kept")
        mark = unused(docs, "_mark")
        mine = docs.withColumn(mark, F.xxhash64(F.coalesce("text", F.lit(""))))
        same = [mine.doc_id.eqNullSafe(kept._kept_id), mine[mark] == kept._kept_mark]
        left = mine.join(kept, same, "left_semi")
        if not kept.where("_copies > 1").isEmpty():
            left = left.dropDuplicates(["doc_id", mark])
        scratch.keep("kept")
        return left.drop(mark)
