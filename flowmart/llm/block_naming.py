"""Exact dedup by deterministic block naming, with DataFrame functions only.

A text's UTF-8 bytes are cut into blocks of fixed size. Distinct blocks are sorted and
numbered; then adjacent pairs of numbers are sorted and numbered, and so on, until one
number is left per text. Texts are equal exactly when their numbers, and the counts of
rounds it took, are equal: every number stands for one content, which was compared as a
whole. A 64-bit fingerprint only deals blocks out and joins numbers back; where two
blocks share one, their rows are joined by content instead.

Defined cases: a null text is an empty one, which has one empty block. Rows without
doc_id form groups like others; if all rows of a group lack it, all count as kept. Rows
that repeat doc_id and text share one decision and each counts in `group_size`;
`exact_dedup` leaves one of them. Other columns play no part and may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from flowmart.llm.arrow import unused
from flowmart.session import Scratch

BLOCK_BYTES = 4096


def text_sha256(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _blocks(docs: DataFrame, size: int, fingerprint: Callable[[Column], Column]) -> DataFrame:
    """One row per block. The blocks are cut as one array, so a row never carries its whole text."""
    body = F.coalesce("text", F.lit("")).cast("binary")
    n = F.greatest(F.lit(1), F.ceil(F.octet_length(body) / size)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(body, i * size + 1, F.lit(size)))
    rows = docs.select("doc_id", text_sha256(F.col("text")).alias("sha"), n.alias("n"), F.posexplode(cut).alias("pos", "block"))
    return rows.withColumn("mark", fingerprint(F.col("block")))


def _numbered(distinct: DataFrame, *order: str) -> DataFrame:
    """Rows in sorted order inside each partition, each with its own number."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def _first_names(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, sha, n, pos, name) of every block."""
    names = scratch.pin(
        _numbered(blocks.select("mark", "block").distinct(), "mark", "block").select("mark", "name"), "block-names"
    )
    rows = scratch.pin(blocks.drop("block"), "blocks")
    shared = names.groupBy("mark").agg(F.count("*").alias("contents")).where("contents > 1").select("mark")
    if shared.isEmpty():
        return rows.join(names, "mark").drop("mark")
    shared = scratch.pin(shared, "shared-marks")
    alike = blocks.join(shared, "mark", "left_semi")
    told = _numbered(alike.select("mark", "block").distinct(), "mark", "block").withColumn("name", -1 - F.col("name"))
    told = scratch.pin(told, "told-apart")
    plain = rows.join(shared, "mark", "left_anti").join(names, "mark").drop("mark")
    return plain.unionByName(alike.join(told, ["mark", "block"]).drop("mark", "block"))


def identities(
    docs: DataFrame,
    scratch: Scratch,
    block_bytes: int = BLOCK_BYTES,
    fingerprint: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """(doc_id, sha, round, name) per row of `docs`; equal texts have equal (round, name)."""
    level = scratch.pin(_first_names(_blocks(docs, block_bytes, fingerprint), scratch), "level-0")
    whole = level.where("n = 1").select("doc_id", "sha", F.lit(0).alias("round"), "name")
    heads = level.where("n > 1 and pos = 0").select("doc_id", "sha")
    level = level.where("n > 1")
    done, rounds = None, 0
    while not level.isEmpty():
        rounds += 1
        even = F.col("pos") % 2 == 0
        pairs = level.groupBy("doc_id", "sha", "n", F.shiftright("pos", 1).alias("pos")).agg(
            F.max(F.when(even, F.col("name"))).alias("left"),
            F.max(F.when(~even, F.col("name"))).alias("right"),
        )
        # The number of the missing right half of an odd last block is no other number.
        pairs = pairs.withColumn("alone", F.col("right").isNull()).fillna(0, ["right"])
        keys = ["left", "right", "alone"]
        names = scratch.pin(_numbered(pairs.select(*keys).distinct(), *keys), f"names-{rounds}")
        named = pairs.join(names, keys).select("doc_id", "sha", F.shiftright(F.col("n") + 1, 1).alias("n"), "pos", "name")
        named = scratch.pin(named, f"level-{rounds}")
        scratch.drop(f"names-{rounds}")
        ended = named.where("n = 1").select("doc_id", "sha", F.lit(rounds).alias("round"), "name")
        done = ended if done is None else done.unionByName(ended)
        level = named.where("n > 1")
    if done is None:
        return whole
    same = [heads.doc_id.eqNullSafe(done.doc_id), heads.sha == done.sha]
    return whole.unionByName(heads.join(done, same).select(heads.doc_id, heads.sha, "round", "name"))


def exact_groups(docs: DataFrame, **options) -> DataFrame:
    """Per row of `docs`: doc_id, keep_id (largest of the group), group_size, kept, text_sha256."""
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.pin(identities(docs, scratch, **options), "identities")
        groups = rows.groupBy("round", "name").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        )
        out = rows.join(groups, ["round", "name"]).select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
        scratch.keep("identities")
        return out


def exact_dedup(docs: DataFrame, **options) -> DataFrame:
    """Rows of `docs` that stay, one of each group of equal texts, with all their columns."""
    with Scratch(docs.sparkSession) as scratch:
        groups = exact_groups(docs, **options)
        kept = scratch.pin(
            groups.where("kept").groupBy(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"))
            .agg(F.count("*").alias("_copies")),
            "kept",
        )
        sha = unused(docs, "_sha")
        mine = docs.withColumn(sha, text_sha256(F.col("text")))
        same = [mine.doc_id.eqNullSafe(kept._kept_id), mine[sha] == kept._kept_sha]
        left = mine.join(kept.drop("_copies"), same, "left_semi")
        if not kept.where("_copies > 1").isEmpty():
            left = left.dropDuplicates(["doc_id", sha])
        scratch.keep("kept")
        return left.drop(sha)
