"""N-gram Jaccard join by vertical partitioning.

All n-grams (shingles of words) stand in one global order, rare ones first, and the order is
cut into fragments of about equal mass. A document's set falls into one segment per fragment.

1. Occurrences of all shingles are summed in a table of fixed size by hash; the logarithm of
   a cell's sum, then the hash, give the global order and the fragments' bounds. The order is
   a matter of cost only: any order gives the same links.
2. A set that must share p of its n shingles with any partner shares one of its first
   n - p + 1 with it. Sets that have one of these in common meet in the shingle's group.
   Equal sets are one class from the start.
3. In each group every class is paired with one centre. Pairs whose sizes, places in the
   order and profiles can't exclude a link are counted: each fragment joins the two segments
   and counts their overlap on its own, and the partial counts are summed per pair.
4. Groups that then still hold several components are compared without their centre, in
   blocks of bounded size, class by class of different components, and counted likewise.
5. Components of all links; their smallest doc_id names them.

Pairs inside one component of step 3 are not counted again, which loses no component. A
profile has, for 256 cells of a set's hashes, their number and the sum of a byte; cells that
differ show shingles that only one set has. All filters are exact. A class that is in very
many pairs has its segments copied as often as its pairs are dealt out.

Defined cases: null and empty texts and texts without words have no shingles and link with
nothing, their component is their own doc_id. Texts of fewer words than a shingle has are one
shingle. Rows that repeat a doc_id are told apart by their texts; equal rows share one result.
A component whose rows all lack doc_id has a null name. Other columns play no part and may
have any name. Shingles are told apart by 64 bits, equal sets by 128 and their size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowmart.llm.arrow import bound_batches, text_function
from flowmart.llm.links import components
from flowmart.llm.words import SPACED, distinct, shingles, word_slices
from flowmart.session import Scratch

FRAGMENTS = 8
#: Cells of the table of occurrences, and of a part of it on its way: 1 MB on the driver.
TABLE_BITS, PART_BITS = 20, 10
#: Cells of a profile.
CELLS = 256
#: Members of a group that are compared with as many others at a time.
BLOCK_MEMBERS = 1024
#: Pairs of one class that read one copy of its segments.
SHARED_PAIRS = 4096

SKETCH = "struct<n:bigint,first:bigint,second:bigint,prefix:array<bigint>,profile:binary>"


def text_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle names of each text."""
    for _, names, offsets in word_slices(column, SPACED):
        made, bounds = shingles(names, offsets, size)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield distinct(made[a:b])


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.uint64), *values])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


# --- the global order ----------------------------------------------------------


def _occurrences(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Occurrences by cell over all texts of a task, in parts."""
    table = np.zeros(1 << TABLE_BITS, np.int64)
    held: list[np.ndarray] = []
    for batch in batches:
        for items in text_sets(batch.column(0), size):
            held.append(items)
            if len(held) == 4096:
                table += _cell_counts(held)
                held = []
    table += _cell_counts(held)
    parts = table.astype("<u4").reshape(-1, 1 << PART_BITS)
    some = np.flatnonzero(parts.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(some.astype(np.int32)), pa.array([parts[k].tobytes() for k in some], pa.binary())], names=["part", "counts"]
    )


def _cell_counts(sets: list[np.ndarray]) -> np.ndarray:
    every = np.concatenate([np.zeros(0, np.uint64), *sets])
    return np.bincount((every >> np.uint64(64 - TABLE_BITS)).astype(np.int64), minlength=1 << TABLE_BITS)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the parts of one number, which come one after another."""
    last, total = None, np.zeros(1 << PART_BITS, np.int64)

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([last], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "counts"]
        )

    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if part != last:
                if last is not None:
                    yield done()
                last, total = part, np.zeros(1 << PART_BITS, np.int64)
            total = total + np.frombuffer(counts, "<u4")
    if last is not None:
        yield done()


class GlobalOrder:
    """Rare shingles first: by the logarithm of their cell's occurrences, then by hash."""

    def __init__(self, counts: np.ndarray, fragments: int = FRAGMENTS):
        self.ranks = np.minimum(255, 4 * np.log2(1 + counts)).astype(np.uint8)
        mass = np.bincount(self.ranks, counts, 256)
        ends = np.cumsum(mass)
        at = np.arange(1, fragments) * ends[-1] / fragments
        rank = np.searchsorted(ends, at)
        inside = (at - (ends[rank] - mass[rank])) / np.maximum(mass[rank], 1)
        self.pivots = (rank.astype(np.uint64) << np.uint64(56)) | (inside * 2.0**55).astype(np.uint64) << np.uint64(1)

    def places(self, items: np.ndarray) -> np.ndarray:
        """What the order sorts by; shingles of one place follow each other by name."""
        rank = self.ranks[(items >> np.uint64(64 - TABLE_BITS)).astype(np.int64)].astype(np.uint64)
        return (rank << np.uint64(56)) | (items >> np.uint64(8))

    def prefix(self, items: np.ndarray, percent: int) -> np.ndarray:
        """The first of sorted `items`, of which a partner has one at least, in order."""
        length = len(items) - -(-percent * len(items) // 100) + 1
        return items[np.argsort(self.places(items), kind="stable")[:length]]

    def segments(self, items: np.ndarray) -> list[np.ndarray]:
        """Sorted items of each fragment."""
        fragment = np.searchsorted(self.pivots, self.places(items), "right")
        order = np.argsort(fragment, kind="stable")
        return np.split(items[order], np.cumsum(np.bincount(fragment, minlength=len(self.pivots) + 1))[:-1])


def global_order(texts: DataFrame, size: int, scratch: Scratch) -> GlobalOrder:
    parts = texts.select("text").mapInArrow(lambda batches: _occurrences(batches, size), "part int, counts binary")
    summed = parts.repartition("part").sortWithinPartitions("part").mapInArrow(_summed, "part int, counts binary")
    counts = np.zeros((1 << TABLE_BITS >> PART_BITS, 1 << PART_BITS), np.int64)
    for part, total in summed.collect():  # a table of fixed size
        counts[part] = np.frombuffer(total, np.int64)
    return GlobalOrder(counts.ravel())


# --- sketches and bounds -------------------------------------------------------


def _profile(items: np.ndarray) -> bytes:
    """Number of names in each of 256 cells, and the sum of their low bytes, modulo 256."""
    cell = ((items >> np.uint64(8)) & np.uint64(CELLS - 1)).astype(np.int64)
    sums = np.bincount(cell, (items & np.uint64(255)).astype(np.float64), CELLS)
    return (np.concatenate([np.bincount(cell, minlength=CELLS), sums]).astype(np.int64) & 255).astype(np.uint8).tobytes()


def least_apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A lower bound of how many names rows of two profile tables don't share."""
    off = left[:, :CELLS] - right[:, :CELLS]  # modulo 256
    off = np.minimum(off, -off).astype(np.int64)
    other = left[:, CELLS:] != right[:, CELLS:]
    return (off + 2 * (other & (off == 0))).sum(axis=1)


def least_shared(total: np.ndarray, percent: int) -> np.ndarray:
    """Shared shingles that sets of `total` shingles together need."""
    return -(-percent * total // (100 + percent))


def _profiles(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 2 * CELLS)


def _may_link(left: pa.Array, right: pa.Array, sizes: pa.Array, percent: int) -> pa.Array:
    total = sizes.to_numpy()
    apart = least_apart(_profiles(left), _profiles(right))
    return pa.array(apart <= total - 2 * least_shared(total, percent))


def _sketched(column: pa.Array, size: int, percent: int, order: GlobalOrder) -> pa.Array:
    numbers, prefixes, profiles = [], [], []
    for items in text_sets(column, size):
        numbers.append((len(items), np.bitwise_xor.reduce(items), np.sum(items * (items | np.uint64(1)))) if len(items) else (0, 0, 0))
        prefixes.append(order.prefix(items, percent) if len(items) else items)
        profiles.append(_profile(items))
    table = np.array(numbers, dtype=np.uint64).reshape(-1, 3).view(np.int64)
    return pa.StructArray.from_arrays(
        [*(pa.array(np.ascontiguousarray(table[:, k])) for k in range(3)), _lists(prefixes), pa.array(profiles, pa.binary())],
        names=["n", "first", "second", "prefix", "profile"],
    )


def _segmented(column: pa.Array, size: int, order: GlobalOrder) -> pa.Array:
    made = [order.segments(items) for items in text_sets(column, size)]
    inner = _lists([segment for row in made for segment in row])
    width = len(order.pivots) + 1
    return pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1, dtype=np.int32) * width), inner)


def _overlaps(left: pa.Array, right: pa.Array) -> pa.Array:
    """Shared names of sorted lists, row by row."""
    a_rows = np.repeat(np.arange(len(left)), left.value_lengths().to_numpy())
    b_rows = np.repeat(np.arange(len(right)), right.value_lengths().to_numpy())
    rows = np.concatenate([a_rows, b_rows])
    names = np.concatenate([left.flatten().to_numpy(), right.flatten().to_numpy()])
    order = np.lexsort((names, rows))
    rows, names = rows[order], names[order]
    same = (names[1:] == names[:-1]) & (rows[1:] == rows[:-1])
    return pa.array(np.bincount(rows[1:][same], minlength=len(left)).astype(np.int64))


# --- groups of one shingle -----------------------------------------------------


def _dealt(members: DataFrame, block: int, scratch: Scratch) -> DataFrame:
    """Copies of each member of a shingle's group for the blocks it is compared in.

    `inside` marks members of the group's main component, which are compared with those
    outside only. Sides: 0 and 1 are compared with each other, 2 with all.
    """
    sizes = members.groupBy("shingle").agg(
        F.ceil(F.count_if("inside") / block).cast("int").alias("ins"),
        F.ceil(F.count_if(~F.col("inside")) / block).cast("int").alias("outs"),
    )
    # Pinned, so that the join may split a group of very many members.
    rows = members.join(scratch.pin(sizes, "sizes"), "shingle")
    own = F.pmod(F.xxhash64("node"), F.when(F.col("inside"), F.col("ins")).otherwise(F.col("outs"))).cast("int")
    outs = F.sequence(F.lit(0), F.col("outs") - 1)
    ins = F.when(F.col("ins") > 0, F.sequence(F.lit(0), F.col("ins") - 1)).otherwise(F.array().cast("array<int>"))

    def block_of(low, high, side):
        return F.struct(low.alias("low"), high.alias("high"), side.cast("int").alias("side"))

    among = F.transform(
        outs,
        lambda o: block_of(
            F.least("own", o), F.greatest("own", o),
            F.when(o == F.col("own"), 2).when(o > F.col("own"), 0).otherwise(1),
        ),
    )
    # Blocks of inside members have negative numbers.
    across = F.transform(ins, lambda i: block_of(F.col("own"), -1 - i, F.lit(0)))
    within = F.transform(outs, lambda o: block_of(o, -1 - F.col("own"), F.lit(1)))
    places = F.when(F.col("inside"), within).otherwise(F.concat(among, across))
    placed = rows.withColumn("own", own).select("shingle", "node", "component", F.explode(places).alias("place"))
    return placed.select("shingle", "place.low", "place.high", "place.side", "node", "component")


def _block_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of different components in a block that may link; rows come block by block."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        new = _block_starts(table)
        last = int(new[-1]) if len(new) else 0
        yield from _pairs(table.slice(0, last).combine_chunks(), percent)
        rest = table.slice(last)
    if rest is not None:
        yield from _pairs(rest.combine_chunks(), percent)


def _block_starts(table: pa.Table) -> np.ndarray:
    new = np.ones(len(table), bool)
    if len(table):
        same = np.ones(len(table) - 1, bool)
        for key in ("shingle", "low", "high"):
            values = table.column(key).to_numpy()
            same &= values[1:] == values[:-1]
        new[1:] = ~same
    return np.flatnonzero(new)


def _pairs(table: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    starts = _block_starts(table)
    if len(starts) == len(table):
        return
    block = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(table))))
    node, component, n, side = (table.column(c).to_numpy() for c in ("node", "component", "n", "side"))
    profile = _profiles(table.column("profile").combine_chunks())
    for step in range(1, len(table)):
        a = np.flatnonzero(block[step:] == block[:-step])
        if not len(a):
            break
        b = a + step
        keep = (component[a] != component[b]) & ((side[a] != side[b]) | (side[a] == 2))
        a, b = a[keep], b[keep]
        total = n[a] + n[b]
        need = least_shared(total, percent)
        keep = np.minimum(n[a], n[b]) >= need
        a, b, room = a[keep], b[keep], (total - 2 * need)[keep]
        for part in np.array_split(np.arange(len(a)), len(a) // 4096 + 1):
            x, y = a[part], b[part]
            good = least_apart(profile[x], profile[y]) <= room[part]
            x, y = node[x[good]], node[y[good]]
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], names=["a", "b"])


# --- the join ------------------------------------------------------------------


def _spread(pairs: DataFrame, segments: DataFrame, side: str, label: str, scratch: Scratch) -> DataFrame:
    """Pairs with the segments of one side, as column `<side>_items`.

    A class of more pairs than `SHARED_PAIRS` has its segments copied, and each copy joins a
    share of the pairs, so that no task gets all pairs of one class.
    """
    node = F.col("node").alias(side)
    busy = pairs.groupBy(side).agg(F.ceil(F.count("*") / (SHARED_PAIRS * FRAGMENTS)).cast("int").alias("copies"))
    busy = scratch.pin(busy.where("copies > 1"), label)
    other = "b" if side == "a" else "a"
    if busy.isEmpty():
        return pairs.join(segments.select(node, "fragment", F.col("items").alias(f"{side}_items")), [side, "fragment"])
    copies = F.coalesce("copies", F.lit(1))
    dealt = pairs.join(busy, side, "left").withColumn("copy", F.pmod(F.xxhash64(other), copies).cast("int")).drop("copies")
    own = segments.select(node, "fragment", F.col("items").alias(f"{side}_items")).join(busy, side, "left")
    own = own.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("copies")
    return dealt.join(own, [side, "fragment", "copy"]).drop("copy")


def jaccard_components(
    docs: DataFrame, size: int = 5, percent: int = 80, block: int = BLOCK_MEMBERS
) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id, text_mark (xxhash64 of the text)."""
    spark = docs.sparkSession
    bound_batches(spark)
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    overlap = text_function(lambda: _overlaps, "bigint")
    may_link = text_function(lambda: lambda a, b, total: _may_link(a, b, total, percent), "boolean")

    with Scratch(spark) as scratch:
        texts = docs.select("doc_id", "text", mark.alias("mark"))
        order = global_order(texts, size, scratch)
        sketch = text_function(lambda: lambda column: _sketched(column, size, percent, order), SKETCH)
        segmented = text_function(lambda: lambda column: _segmented(column, size, order), "array<array<bigint>>")

        rows = scratch.pin(texts.withColumn("s", sketch("text")).select("doc_id", "mark", "s.*"), "sketches")
        classes = rows.where("n > 0").groupBy("n", "first", "second").agg(
            F.min(F.struct("doc_id", "mark")).alias("one"),
            F.min("doc_id").alias("smallest"),
            F.count("*").alias("copies"),
            F.first("prefix").alias("prefix"),
            F.first("profile").alias("profile"),
        )
        classes = scratch.pin(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
        profiles = classes.select("node", "n", "profile")

        firsts = classes.select("node", "n", "copies", F.posexplode("prefix").alias("place", "shingle"))
        # Most shingles stand alone: only their counts are dealt out, the rest follows for groups.
        groups = firsts.groupBy("shingle").agg(F.count("*").alias("size")).where("size > 1").select("shingle")
        grouped = scratch.pin(firsts.join(scratch.pin(groups, "groups"), "shingle"), "grouped")
        scratch.drop("groups")
        centre = F.min(F.struct(-F.col("copies"), "node", "n", "place")).alias("centre")
        centres = scratch.pin(grouped.groupBy("shingle").agg(centre), "centres")
        members = scratch.pin(
            grouped.join(centres, "shingle").select(
                "shingle", "node", "n", "place",
                F.col("centre.node").alias("centre"), F.col("centre.n").alias("centre_n"), F.col("centre.place").alias("centre_place"),
            ),
            "members",
        )
        scratch.drop("grouped", "centres")

        def linked(pairs: DataFrame, label: str) -> DataFrame:
            """Pairs (a, b, total) whose overlap, counted fragment by fragment, makes a link."""
            nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            chosen = classes.join(nodes, "node").select("node", "one.doc_id", "one.mark")
            same = [texts.doc_id.eqNullSafe(chosen.doc_id), texts.mark == chosen.mark]
            # Repeated rows of a chosen text would count twice.
            once = texts.join(chosen, same).select("node", "text").dropDuplicates(["node"])
            segments = once.select("node", F.posexplode(segmented("text")).alias("fragment", "items")).where(F.size("items") > 0)
            segments = scratch.pin(segments, f"{label}-segments")
            spread = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))))
            spread = _spread(spread, segments, "a", f"{label}-busy-a", scratch)
            spread = _spread(spread, segments, "b", f"{label}-busy-b", scratch)
            partial = spread.select("a", "b", "total", overlap("a_items", "b_items").alias("shared"))
            whole = partial.groupBy("a", "b", "total").agg(F.sum("shared").alias("shared"))
            links = scratch.pin(whole.where(f"100 * shared >= {percent} * (total - shared)").select("a", "b"), label)
            scratch.drop(f"{label}-segments")
            return links

        total = F.col("n") + F.col("centre_n")
        need = F.ceil(percent * total / (100 + percent))
        left = F.least(F.col("n") - F.col("place"), F.col("centre_n") - F.col("centre_place"))
        pairs = members.where((F.col("node") != F.col("centre")) & (left >= need) & (F.least("n", "centre_n") >= need))
        pairs = pairs.select(F.col("node").alias("a"), F.col("centre").alias("b"), total.alias("total")).distinct()
        for side in ("a", "b"):
            one = profiles.select(F.col("node").alias(side), F.col("profile").alias(f"{side}_profile"))
            pairs = pairs.join(one, side)
        pairs = pairs.where(may_link("a_profile", "b_profile", "total")).select("a", "b", "total")
        first_links = linked(scratch.pin(pairs, "first-pairs"), "first-links")
        scratch.drop("first-pairs")
        first = components(first_links, scratch, "first-components")

        grouped = members.select("shingle", "node", "centre").join(first, "node", "left")
        grouped = grouped.withColumn("component", F.coalesce("component", "node"))
        mixed = grouped.groupBy("shingle").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.max(F.when(F.col("node") == F.col("centre"), F.col("component"))).alias("main"),
        )
        mixed = scratch.pin(mixed.where("low < high").select("shingle", "main"), "mixed")
        apart = grouped.join(mixed, "shingle")
        apart = scratch.pin(
            apart.select("shingle", "node", "component", (F.col("component") == F.col("main")).alias("inside")), "apart"
        )
        scratch.drop("members", "mixed")
        keys = ["shingle", "low", "high"]
        blocks = _dealt(apart, block, scratch).join(profiles, "node").repartition(*keys).sortWithinPartitions(*keys)
        rest = blocks.mapInArrow(lambda batches: _block_pairs(batches, percent), "a bigint, b bigint").distinct()
        for side in ("a", "b"):
            rest = rest.join(profiles.select(F.col("node").alias(side), F.col("n").alias(f"{side}_n")), side)
        rest = rest.select("a", "b", (F.col("a_n") + F.col("b_n")).alias("total"))
        rest = scratch.pin(rest, "rest-pairs")
        scratch.drop("apart")
        rest_links = linked(rest, "rest-links")
        scratch.drop("rest-pairs")

        chains = first.select(F.col("node").alias("a"), F.col("component").alias("b"))
        joined = components(chains.unionByName(rest_links), scratch, "components")
        named = classes.select("n", "first", "second", "node", "smallest").join(joined, "node", "left")
        named = scratch.pin(named.withColumn("component", F.coalesce("component", "node")), "named")
        least = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
        named = named.join(least, "component").select("n", "first", "second", "component_id")
        found = rows.where("n > 0").join(named, ["n", "first", "second"]).select("doc_id", "mark", "n", "component_id")
        alone = rows.where("n = 0").select("doc_id", "mark", "n", F.col("doc_id").alias("component_id"))
        for label in ("sketches", "named"):
            scratch.keep(label)
        return found.unionByName(alone).select(
            "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("mark").alias("text_mark")
        )
