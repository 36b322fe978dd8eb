"""Merkle manifest of a table by time-forward processing.

Every row is a leaf: the digest of its doc_id, source, lang, n_chars and text. The leaves of
a source, ascending by doc_id, form a tree of three children a node; the roots of the sources
form another one. Nodes are labelled so that children come before their parent: by the last
leaf below them, then by height. A forward sweep takes the nodes in label order; a priority
queue ordered by label brings each node its children's digests. A backward sweep takes them
in the opposite order; the queue brings each node the part of the proof above it, so leaves
get whole proofs.

The queue is external. Inside a block of 3^7 leaves it is a heap that holds a few messages
per level. A message to a label outside the block (the digest of a block's top, the proof
above it) is a row, which Spark's sort by (tree, block, position) brings to the task of that
label; a round of Spark each handles seven levels. A source holding most rows is as many
blocks as it needs, no task gathers more than one block, and the driver sees counts only.

Defined cases: null values have the digest text `-`. Leaves without doc_id come first, equal
doc_ids follow the order of their digests, so repeated rows are leaves of their own. Rows
without source are one source, the first. An empty table has no rows and no root. A run of
one node has no siblings but is hashed; a source of one leaf has that leaf as its root. Other
columns play no part and may have any name.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowmart.llm.arrow import bound_batches
from flowmart.session import Scratch

ARITY = 3
LEVELS = 7

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<left:string,right:string>>"


def _part(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row; `changed` columns stand in for its own."""
    return _sha256(F.concat(*[_part(changed.get(name, F.col(name))) for name in FIELDS]))


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its proof lead to."""
    return F.aggregate(proof, leaf, lambda digest, step: _sha256(F.concat(step["left"], digest, step["right"])))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return _sha256(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""))


class Sweep:
    """One block's nodes, in both directions; `levels` above its leaves, or as many as lead to one node."""

    def __init__(self, leaves: list[str], levels: int | None):
        self.leaves = leaves
        self.children: dict[tuple[int, int], list[str]] = {}
        height, widths = 0, [len(leaves)]
        while height < levels if levels is not None else widths[-1] > 1:
            widths.append(-(-widths[-1] // ARITY))
            height += 1
        self.height = height

    def _label(self, level: int, place: int) -> tuple[int, int]:
        """Last leaf below a node, and its height."""
        return min((place + 1) * ARITY**level, len(self.leaves)) - 1, level

    def forward(self) -> str:
        """Digest of the top node."""
        queue: list[tuple[int, int, int, str]] = []
        top = ""

        def send(level: int, place: int, digest: str) -> None:
            if level == self.height:
                nonlocal top
                top = digest
            else:
                heapq.heappush(queue, (*self._label(level + 1, place // ARITY), place, digest))

        for leaf, digest in enumerate(self.leaves):
            send(0, leaf, digest)
            while queue and queue[0][0] == leaf:
                _, level, place, first = heapq.heappop(queue)
                got = [first]
                while queue and queue[0][:2] == (leaf, level):
                    got.append(heapq.heappop(queue)[3])
                self.children[level, place // ARITY] = got
                send(level, place // ARITY, hashlib.sha256("".join(got).encode()).hexdigest())
        return top

    def backward(self, above: tuple | None) -> list[tuple | None]:
        """Proof of each leaf, as (left, right, rest); `above` is that of the top."""
        out: list[tuple | None] = [None] * len(self.leaves)
        last, level = self._label(self.height, 0)
        queue = [(-last, -level, 0, above)]
        while queue:
            _, level, place, rest = heapq.heappop(queue)
            if not level:
                out[place] = rest
                continue
            got = self.children[-level, place]
            for k in range(len(got)):
                child = place * ARITY + k
                last, height = self._label(-level - 1, child)
                message = ("".join(got[:k]), "".join(got[k + 1 :]), rest)
                heapq.heappush(queue, (-last, -height, child, message))
        return out


def _blocks(batches: Iterator[pa.RecordBatch], first: int) -> Iterator[pa.Table]:
    """Runs of rows that begin where `idx` is a multiple of the block size, or is `first` if that is negative."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        idx = batch.column("idx").to_numpy()
        starts = (idx == first if first < 0 else idx % first == 0).nonzero()[0].tolist()
        at = 0
        for start in starts:
            held.append(batch.slice(at, start - at))
            if any(b.num_rows for b in held):
                yield pa.Table.from_batches(held).combine_chunks()
            held, at = [], start
        held.append(batch.slice(at))
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks()


def _levels(total: int, levels: int) -> int | None:
    return None if total <= ARITY**levels else levels


def _tops(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    size = ARITY**levels
    for block in _blocks(batches, size):
        total = block.column("total")[0].as_py()
        top = Sweep(block.column("digest").to_pylist(), _levels(total, levels)).forward()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block.column("tree")[0].as_py()], pa.string()),
                pa.array([block.column("idx")[0].as_py() // size], pa.int64()),
                pa.array([top]),
                pa.array([-(-total // size)], pa.int64()),
            ],
            names=["tree", "idx", "digest", "total"],
        )


def _proofs(batches: Iterator[pa.RecordBatch], levels: int, kept: list[str]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches, -1):
        above = None
        for step in reversed(block.column("proof")[0].as_py()):
            above = (step["left"], step["right"], above)
        rows = block.slice(1)
        sweep = Sweep(rows.column("digest").to_pylist(), _levels(rows.column("total")[0].as_py(), levels))
        sweep.forward()
        lefts: list[str] = []
        rights: list[str] = []
        offsets = [0]
        for rest in sweep.backward(above):
            while rest is not None:
                lefts.append(rest[0])
                rights.append(rest[1])
                rest = rest[2]
            offsets.append(len(lefts))
        steps = pa.StructArray.from_arrays([pa.array(lefts, pa.string()), pa.array(rights, pa.string())], names=["left", "right"])
        proof = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), steps)
        whole = [rows.column(name).combine_chunks() for name in kept]
        yield pa.RecordBatch.from_arrays([*whole, proof], names=[*kept, "proof"])


def _numbered(rows: DataFrame, order: list[str], scratch: Scratch, label: str) -> DataFrame:
    """Add `idx`, the place inside the row's `tree` by `order`, and `total`, the tree's size.

    Rows are dealt out by ranges of (tree, order). Only the counts of trees per range meet.
    """
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    dealt = scratch.pin(dealt.withColumn("at", F.monotonically_increasing_id()), f"{label}-sorted")
    part = F.shiftright("at", 33)
    runs = dealt.groupBy("tree", part.alias("part")).agg(F.min("at").alias("start"), F.count("*").alias("n"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = scratch.pin(
        runs.select(
            "tree", "part", "start",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
            F.sum("n").over(Window.partitionBy("tree")).alias("total"),
        ),
        f"{label}-runs",
    )
    placed = dealt.withColumn("part", part).join(runs, ["tree", "part"])
    return placed.withColumn("idx", F.col("at") - F.col("start") + F.col("before")).drop("at", "part", "start", "before")


def _with_block(rows: DataFrame, levels: int) -> DataFrame:
    return rows.withColumn("block", F.expr(f"idx div {ARITY**levels}"))


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")


def _forward(rows: DataFrame, scratch: Scratch, label: str, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Rows of each round, and the top (tree, digest) of each tree."""
    rounds, tops = [rows], None
    while True:
        here = _with_block(rounds[-1].select("tree", "idx", "digest", "total"), levels)
        made = _dealt(here).mapInArrow(
            lambda batches: _tops(batches, levels), "tree string, idx bigint, digest string, total bigint"
        )
        made = scratch.pin(made, f"{label}-round-{len(rounds)}")
        done = made.where("total = 1").select("tree", "digest")
        tops = done if tops is None else tops.unionByName(done)
        if made.where("total > 1").isEmpty():
            return rounds, tops
        rounds.append(made.where("total > 1"))


def _backward(
    rounds: list[DataFrame], tops: DataFrame, kept: list[str], scratch: Scratch, label: str, levels: int
) -> DataFrame:
    """`kept` columns and proof of every row of the first round; `tops` has the proof above each tree."""
    size = ARITY**levels
    above = None
    for k in reversed(range(len(rounds))):
        names = kept if not k else ["tree", "idx"]
        rows = _with_block(rounds[k], levels)
        # A tree that ends in this round gets what is above it; others get it block by block.
        ended = rounds[k].where((F.col("total") <= size) & (F.col("idx") == 0)).select("tree")
        starts = tops.join(ended, "tree").select("tree", F.lit(0).cast("bigint").alias("block"), "proof")
        if above is not None:
            starts = starts.unionByName(above.select("tree", F.col("idx").alias("block"), "proof"))
        messages = starts.withColumn("idx", F.lit(-1).cast("bigint"))
        both = rows.unionByName(messages, allowMissingColumns=True)
        schema = ", ".join(f"{name} {rows.schema[name].dataType.simpleString()}" for name in names)
        above = _dealt(both).mapInArrow(
            lambda batches, names=names: _proofs(batches, levels, names), f"{schema}, proof {PROOF}"
        )
        if k:
            above = scratch.pin(above, f"{label}-proofs-{k}")
    return above


def manifest(docs: DataFrame, kept: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """Per row of `docs`: doc_id, source, kept (of that column, null if none), leaf, proof, subroot, root.

    A proof has a step per level up to the root: the digests left and right of the node.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    with Scratch(spark) as scratch:
        rows = docs.select(
            # Sources in byte order after the missing one, and never null.
            F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("source"))).alias("tree"),
            "doc_id",
            "source",
            (F.lit(None).cast("string") if kept is None else kept).alias("kept"),
            leaf_digest().alias("digest"),
        )
        rows = scratch.pin(_numbered(rows, ["doc_id", "digest"], scratch, "leaves"), "leaves")
        scratch.drop("leaves-sorted", "leaves-runs")
        rounds, tops = _forward(rows, scratch, "leaves", levels)

        sources = tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
        sources = scratch.pin(_numbered(sources, ["name"], scratch, "sources"), "sources")
        upper, root = _forward(sources, scratch, "sources", levels)
        whole = root.select("tree", F.array().cast(PROOF).alias("proof"))
        roots = _backward(upper, whole, ["name", "digest"], scratch, "sources", levels)
        roots = scratch.pin(
            roots.select(
                F.col("name").alias("tree"),
                F.col("digest").alias("subroot"),
                root.select("digest").scalar().alias("root"),
                "proof",
            ),
            "roots",
        )
        names = ["tree", "doc_id", "source", "kept", "digest"]
        made = _backward(rounds, roots.select("tree", "proof"), names, scratch, "leaves", levels)
        made = made.withColumnRenamed("digest", "leaf").join(roots.drop("proof"), "tree")
        for label in list(scratch.paths):
            if label in ("leaves", "roots", "leaves-proofs-1"):
                scratch.keep(label)
        return made.select("doc_id", "source", "kept", "leaf", "proof", "subroot", "root")
