"""Line dedup by a log-template tree.

Lines are parsed down a tree of fixed depth: the first level is a line's number of
tokens, the next ones its leading tokens; a token with a digit is a variable field from
the start. Lines that reach one leaf are compared place by place. A token is a constant
or a variable field by how many of the leaf's documents have it at its place; no one bound
suits leaves of all sizes, so every bound of at least `min_docs` documents is tried: each
makes the tokens that reach it constants, and these are a template of the line. A template
recurs if constants make up `share` of its tokens and it is found in at least `min_docs`
documents; lines with a recurring template are dropped from all documents. A field whose
values recur themselves stays a field, as its values are rarer than the words around it.
Leaves that lost lines are counted again without them, until none loses any: there a rarer
template may share field values with a frequent one.

A line of more than `long_tokens` tokens is told whole as well: one that stands in
`long_docs` documents with equal tokens, digits included, is dropped from all documents.

On Spark all of this is counting: leaves, then distinct lines of frequent leaves, their
tokens by place, and templates, each combined in the map task, so no group is gathered. A
bit table of fixed size, of the hashes of frequent leaves and long lines, goes to all tasks and spares
the other lines the way; what it lets through by chance is sorted out by a join.

Defined cases: tokens are runs between ASCII white space, A-Z lower-cased; lines end at
line feeds. Lines of fewer than `min_tokens` tokens are kept. A line counts once per
document, documents being rows, so repeated rows count as often as they occur. A null or
empty text has no lines and stays as it is (null becomes empty). Other columns of the
table play no part. Tokens and lines are told apart by 32 and 64 bits of hash.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from flowmart.llm.arrow import bound_batches, text_function
from flowmart.llm.words import SPACED, mix, word_slices
from flowmart.session import Scratch

DEPTH = 3
MIN_DOCS = 3
MIN_TOKENS = 5
SHARE = 0.7
#: Equal lines of more tokens than these recur in so many documents.
LONG_TOKENS, LONG_DOCS = 50, 2
#: Bits of the table of frequent leaves: 1 MB.
TABLE_BITS = 23

LINES = "array<struct<place:int,leaf:bigint,line:bigint,exact:bigint,tokens:array<int>>>"

_FIELD = re.compile(r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*")
_DIGIT = re.compile("[0-9]")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def text_lines(text: str | None) -> list[str]:
    return text.split("\n") if text else []


def _named(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of all tokens, token offsets, and a hash of each line's tokens with their places."""
    names, bounds = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for _, found, offsets in word_slices(pa.array(lines, pa.large_string()), SPACED):
        bounds.append(offsets[1:] + bounds[-1][-1])
        names.append(found)
    names, bounds = np.concatenate(names), np.concatenate(bounds)
    inside = np.arange(len(names)) - np.repeat(bounds[:-1], np.diff(bounds))
    spread = np.concatenate([[np.uint64(0)], np.cumsum(mix(names + inside.astype(np.uint64) * _ODD))])
    return names, bounds, spread[bounds[1:]] - spread[bounds[:-1]]


def _parsed(texts: pa.Array, depth: int, min_tokens: int, long_tokens: int):
    """Of all lines long enough: (row, place, leaf, line, exact, names of all tokens, token offsets).

    `exact` tells long lines apart by all their tokens; it is 0 for others.
    """
    lines, rows, places, raw = [], [], [], {}
    for row, text in enumerate(texts.to_pylist()):
        digits = text and _DIGIT.search(text)
        for place, line in enumerate(text_lines(text)):
            if digits and _DIGIT.search(line):
                if len(line) > 2 * long_tokens:
                    raw[len(lines)] = line
                line = _FIELD.sub("\x01", line)
            lines.append(line)
            rows.append(row)
            places.append(place)
    names, bounds, hashes = _named(lines)
    counts = np.diff(bounds)
    exact = np.where(counts > long_tokens, hashes, np.uint64(0))
    numbered = [k for k in raw if counts[k] > long_tokens]
    exact[numbered] = _named([raw[k] for k in numbered])[2]
    exact = mix(exact * _ODD)
    long_enough = np.flatnonzero(counts >= max(min_tokens, 1))
    counts, starts = counts[long_enough], bounds[:-1][long_enough]
    leaf = mix(counts.astype(np.uint64))
    for k in range(depth):
        has = counts > k
        leaf[has] = mix(leaf[has] * _ODD + names[starts[has] + k])
    line = mix(hashes[long_enough] + leaf)
    return (
        np.array(rows, np.int64)[long_enough], np.array(places, np.int32)[long_enough],
        leaf, line, exact[long_enough], names, np.stack([starts, starts + counts], axis=1),
    )


def _leaves(texts: pa.Array, depth: int, min_tokens: int, long_tokens: int) -> pa.Array:
    """Distinct leaves and long lines of each text."""
    row, _, leaf, _, exact, _, _ = _parsed(texts, depth, min_tokens, long_tokens)
    whole = np.repeat([False, True], [len(row), np.count_nonzero(exact)])
    row, leaf = np.concatenate([row, row[exact != 0]]), np.concatenate([leaf, exact[exact != 0]])
    order = np.lexsort((whole, leaf, row))
    row, leaf, whole = row[order], leaf[order], whole[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (leaf[1:] != leaf[:-1]) | (whole[1:] != whole[:-1])
    offsets = np.searchsorted(row[keep], np.arange(len(texts) + 1)).astype(np.int32)
    items = pa.StructArray.from_arrays([pa.array(leaf[keep].view(np.int64)), pa.array(whole[keep])], names=["leaf", "whole"])
    return pa.ListArray.from_arrays(pa.array(offsets), items)


def _slot(leaf: np.ndarray) -> np.ndarray:
    return (leaf & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)


def _lines(texts: pa.Array, table: np.ndarray, depth: int, min_tokens: int, long_tokens: int) -> pa.Array:
    """Lines of each text that may be frequent or whose leaf may be."""
    row, place, leaf, line, exact, names, span = _parsed(texts, depth, min_tokens, long_tokens)
    by_leaf, by_line = (table[s >> 6] >> (s & 63).astype(np.uint64) & np.uint64(1) for s in (_slot(leaf), _slot(exact)))
    kept = np.flatnonzero(by_leaf | by_line & (exact != 0))
    row, place, leaf, line, exact, span = row[kept], place[kept], leaf[kept], line[kept], exact[kept], span[kept]
    counts = span[:, 1] - span[:, 0]
    bounds = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(bounds[-1]) + np.repeat(span[:, 0] - bounds[:-1], counts)
    tokens = (names[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
    items = pa.StructArray.from_arrays(
        [
            pa.array(place), pa.array(leaf.view(np.int64)), pa.array(line.view(np.int64)),
            pa.array(exact.view(np.int64)), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(tokens)),
        ],
        names=["place", "leaf", "line", "exact", "tokens"],
    )
    offsets = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), items)


def _without(texts: pa.Array, places: pa.Array) -> pa.Array:
    out = []
    for text, dropped in zip(texts.to_pylist(), places.to_pylist(), strict=True):
        gone = set(dropped or ())
        lines = text_lines(text)
        out.append("\n".join([x for k, x in enumerate(lines) if k not in gone]) if gone else text or "")
    return pa.array(out, pa.string())


def _lines_of_templates(tokens: DataFrame, scratch: Scratch, min_docs: int, share: float) -> DataFrame:
    """(leaf, line) of the lines with a recurring template."""
    constants = tokens.groupBy("leaf", "at", "token").agg(F.sum("docs").alias("n")).where(F.col("n") >= min_docs)
    # A line's templates: its tokens of n documents or more, for each n among them.
    steps = tokens.join(constants, ["leaf", "at", "token"]).groupBy("leaf", "line", "n").agg(
        F.count("*").alias("fixed"),
        F.bit_xor(F.xxhash64("at", "token")).alias("template"),
        F.first("size").alias("size"),
        F.first("docs").alias("docs"),
    )
    down = Window.partitionBy("leaf", "line").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    templates = steps.select(
        "leaf", "line", "docs", "size", F.sum("fixed").over(down).alias("fixed"), F.bit_xor("template").over(down).alias("template")
    )
    templates = scratch.pin(templates.where(F.col("fixed") >= F.ceil(F.col("size") * F.lit(share))), "templates")
    # One line may stand for a template alone; lines of one document count as one document each.
    seen = templates.groupBy("leaf", "template").agg(F.sum("docs").alias("n")).where(F.col("n") >= min_docs)
    return templates.join(seen, ["leaf", "template"], "left_semi").select("leaf", "line").distinct()


def recurring_lines(
    docs: DataFrame, scratch: Scratch, depth: int, min_docs: int, min_tokens: int, share: float, long_tokens: int, long_docs: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(leaf, line) and (exact) of the lines to drop, and (doc_id, mark, place, leaf, line, exact) of the lines in question."""
    spark = docs.sparkSession
    leaves = text_function(lambda: lambda texts: _leaves(texts, depth, min_tokens, long_tokens), "array<struct<leaf:bigint,whole:boolean>>")
    counted = docs.select(F.inline(leaves("text"))).groupBy("leaf", "whole").agg(F.count("*").alias("docs"))
    counted = counted.where(F.col("docs") >= F.when(F.col("whole"), long_docs).otherwise(min_docs))
    counted = scratch.pin(counted.select("leaf", "whole"), "leaves")
    frequent = counted.where(~F.col("whole")).select("leaf")
    copies = counted.where("whole").select(F.col("leaf").alias("exact"))
    slot = F.col("leaf").bitwiseAND(F.lit((1 << TABLE_BITS) - 1))
    words = counted.groupBy(F.shiftright(slot, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast((leaf & {(1 << TABLE_BITS) - 1}) & 63 as int))")).alias("bits")
    )
    table = np.zeros(1 << (TABLE_BITS - 6), np.uint64)
    for r in words.collect():  # as many rows as the table has words, at most
        table[r.word] = np.uint64(r.bits & 0xFFFFFFFFFFFFFFFF)
    held = spark.sparkContext.broadcast(table)
    parsed = text_function(lambda: lambda texts: _lines(texts, held.value, depth, min_tokens, long_tokens), LINES)
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    # Rows are numbered before their lines are spread.
    rows = docs.select("doc_id", "text", mark.alias("mark"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("found", parsed("text"))
    rows = scratch.pin(rows.select("doc_id", "mark", "row", F.inline("found")), "lines")

    # A line counts once per document.
    once = rows.groupBy("row", "leaf", "line").agg(F.min("place").alias("place"))
    lines = once.groupBy("leaf", "line").agg(F.count("*").alias("docs"), F.min(F.struct("row", "place")).alias("one"))
    lines = scratch.pin(lines.join(frequent, "leaf", "left_semi"), "distinct")
    example = rows.select(F.struct("row", "place").alias("one"), "tokens")
    tokens = lines.join(example, "one").select(
        "leaf", "line", "docs", F.size("tokens").alias("size"), F.posexplode("tokens").alias("at", "token")
    )
    tokens = scratch.pin(tokens, "tokens")
    found = []
    while not found or not found[-1].isEmpty():
        if found:
            # Beside a frequent template a rarer one's field values may seem constants. Its lines
            # are told once those of the other are gone; leaves that lost none stay as they were.
            lost = found[-1]
            tokens = tokens.join(lost.select("leaf").distinct(), "leaf", "left_semi").join(lost, ["leaf", "line"], "left_anti")
            tokens = scratch.pin(tokens, "tokens")
        found.append(scratch.pin(_lines_of_templates(tokens, scratch, min_docs, share), f"recurring-{len(found)}"))
    return reduce(DataFrame.unionByName, found), copies, rows.select("doc_id", "mark", "place", "leaf", "line", "exact")


def without_recurring_lines(
    docs: DataFrame,
    depth: int = DEPTH,
    min_docs: int = MIN_DOCS,
    min_tokens: int = MIN_TOKENS,
    share: float = SHARE,
    long_tokens: int = LONG_TOKENS,
    long_docs: int = LONG_DOCS,
) -> DataFrame:
    """Per row of `docs`: doc_id, n_lines, n_dropped, and the text without its recurring lines."""
    spark = docs.sparkSession
    bound_batches(spark)
    with Scratch(spark) as scratch:
        recurring, copies, rows = recurring_lines(docs, scratch, depth, min_docs, min_tokens, share, long_tokens, long_docs)
        gone = rows.join(recurring, ["leaf", "line"], "left_semi").unionByName(rows.join(copies, "exact", "left_semi"))
        dropped = gone.groupBy("doc_id", "mark").agg(
            F.array_distinct(F.collect_list("place")).alias("places")
        )
        dropped = scratch.pin(dropped.withColumnsRenamed({"doc_id": "_id", "mark": "_mark"}), "dropped")
        texts = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))
        joined = texts.join(dropped, texts.doc_id.eqNullSafe(dropped._id) & (texts.mark == dropped._mark), "left")
        left = text_function(lambda: _without, "string")
        n_lines = F.when(F.coalesce("text", F.lit("")) == "", 0).otherwise(F.size(F.split("text", "\n", -1)))
        out = joined.select(
            "doc_id",
            n_lines.cast("bigint").alias("n_lines"),
            F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias("n_dropped"),
            left("text", "places").alias("text"),
        )
        scratch.keep("dropped")
        return out
