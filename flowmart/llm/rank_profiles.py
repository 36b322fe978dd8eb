"""Language identification by rank-order profiles of n-grams.

N-grams of one to three bytes are taken inside words of the lower-cased text, with a mark
before and after each word; every ASCII sign but a letter separates words. A language's
profile is its most frequent n-grams, counted over all training texts, in order. A text's
own most frequent n-grams are compared with it: each adds the difference of the two
ranks, or the profile's length if the profile lacks it. The nearest profile wins; ties go
to the first name.

Defined cases: a null text or one without a letter is `und` with score 0. Without any
training row all texts are `und`. Rows without lang don't train. Every row is predicted
alone; repeated rows count as often as they occur in training. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowmart.llm.arrow import bound_batches, map_arrow, text_function, unused
from flowmart.llm.words import SLICE_BYTES, pieces, text_buffers

PROFILE = 400
#: Profiles are broadcast; this bounds them to a few MB.
MOST_LANGUAGES = 2048
UNDETERMINED = "und"

_GAP = 0x20
_CODES = np.arange(256, dtype=np.uint8)
_CODES[:128] = _GAP
_CODES[97:123] = np.arange(97, 123)
_CODE_BITS = 26


def _grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and code of every n-gram. The code is the bytes below two bits for the length."""
    rows = len(bounds) - 1
    lengths = np.diff(bounds)
    text = np.full(len(data) + rows + 1, _GAP, np.uint8)
    owner = np.concatenate([[0], np.repeat(np.arange(rows), lengths + 1)])
    text[np.arange(len(data)) + 1 + np.repeat(np.arange(rows), lengths)] = _CODES[data]
    gap = text == _GAP
    keep = np.ones(len(text), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    # The gap after a row's last word stays with that row even if a gap began before it.
    text, owner, gap = text[keep].astype(np.uint32), owner[keep], gap[keep]
    one = np.flatnonzero(~gap)
    two = np.flatnonzero(~(gap[:-1] & gap[1:]))
    three = np.flatnonzero(~gap[1:-1])
    codes = np.concatenate(
        [
            text[one],
            (text[two] << np.uint32(8) | text[two + 1]) | np.uint32(1 << 24),
            (text[three] << np.uint32(16) | text[three + 1] << np.uint32(8) | text[three + 2]) | np.uint32(2 << 24),
        ]
    )
    # An n-gram belongs to the row of its first letter.
    firsts = np.concatenate([one, two + gap[two], three + gap[three]])
    return owner[firsts], codes


def _slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, bytes and offsets of runs of whole texts."""
    data, bounds = text_buffers(texts)
    row = 0
    while row < len(bounds) - 1:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + SLICE_BYTES, "right")) - 1)
        yield row, end, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end


def _counted(groups: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, code, count) of each distinct pair, in order."""
    keys = groups.astype(np.uint64) << np.uint64(_CODE_BITS) | codes.astype(np.uint64)
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return (keys >> np.uint64(_CODE_BITS)).astype(np.int64), keys & np.uint64((1 << _CODE_BITS) - 1), counts


def _row_counts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, count) of a slice; a text longer than a slice is counted in pieces."""
    if len(bounds) > 2 or len(data) <= SLICE_BYTES:
        return _counted(*_grams(data, bounds))
    parts = [_counted(*_grams(p, np.array([0, len(p)]))) for p in pieces(data, _CODES != _GAP)]
    code, at = np.unique(np.concatenate([c for _, c, _ in parts]), return_inverse=True)
    count = np.bincount(at, np.concatenate([n for _, _, n in parts]), len(code)).astype(np.int64)
    return np.zeros(len(code), np.int64), code, count


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, code, n) of a task's texts, added up as far as memory allows."""

    def out(totals: dict[str, tuple]) -> Iterator[pa.RecordBatch]:
        for name, (codes, counts) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts)],
                names=["lang", "code", "n"],
            )

    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        names, lang = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        parts: dict[int, list] = {}
        for row, end, data, bounds in _slices(batch.column(1)):
            if end - row == 1:
                _, code, count = _row_counts(data, bounds)
                group = np.full(len(code), lang[row], np.int64)
            else:
                owner, codes = _grams(data, bounds)
                group, code, count = _counted(lang[row:end][owner], codes)
            for g in np.unique(group):
                parts.setdefault(int(g), []).append((code[group == g], count[group == g]))
        for g, found in parts.items():
            found += [totals[names[g]]] if names[g] in totals else []
            code, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
            totals[names[g]] = (code, np.bincount(at, np.concatenate([f[1] for f in found]), len(code)).astype(np.int64))
        if sum(len(c) for c, _ in totals.values()) > 1 << 20:
            yield from out(totals)
            totals = {}
    yield from out(totals)


def profiles(texts: DataFrame, length: int = PROFILE) -> dict[str, list[int]]:
    """Codes of the most frequent n-grams per language, most frequent first.

    `texts` has columns lang and text. Only the profiles come to the driver.
    """
    bound_batches(texts.sparkSession)
    rows = texts.where(F.col("lang").isNotNull()).select("lang", F.lower("text").alias("text"))
    counts = map_arrow(rows, _train, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= length)
    best = best.limit(length * MOST_LANGUAGES + 1).collect()
    if len(best) > length * MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    learned: dict[str, list[int]] = {}
    for row in sorted(best, key=lambda r: (r.lang, r.rank)):
        learned.setdefault(row.lang, []).append(row.code)
    return learned


def _table(learned: dict[str, list[int]], length: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language names, sorted codes of all profiles, and rank of each code in each language."""
    names = sorted(learned)
    codes = np.unique(np.array([c for n in names for c in learned[n]], np.uint64))
    ranks = np.full((len(codes) + 1, len(names)), length, np.int32)
    for k, name in enumerate(names):
        ranks[np.searchsorted(codes, np.array(learned[name], np.uint64)), k] = np.arange(len(learned[name]))
    return names, codes, ranks


def distances(texts: pa.Array, codes: np.ndarray, ranks: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Summed out-of-place distance of each text to each language, and n-grams compared."""
    total = np.zeros((len(texts), ranks.shape[1]), np.int64)
    used = np.zeros(len(texts), np.int64)
    for row, end, data, bounds in _slices(texts):
        owner, code, count = _row_counts(data, bounds)
        order = np.lexsort((code, -count, owner))
        owner, code = owner[order], code[order]
        starts = np.searchsorted(owner, np.arange(end - row + 1))
        rank = np.arange(len(owner)) - starts[owner]
        top = rank < length
        owner, code, rank = owner[top], code[top], rank[top]
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        at = np.where(codes[at] == code, at, len(codes))
        used[row:end] = np.bincount(owner, minlength=end - row)
        for k in range(ranks.shape[1]):
            known = ranks[at, k]
            apart = np.where(known < length, np.abs(known - rank), length)
            total[row:end, k] = np.bincount(owner, apart, end - row)
    return total, used


def predict(text: Column | str, learned: dict[str, list[int]], length: int = PROFILE) -> Column:
    """Struct of lang, score and distance: how much nearer the first profile is than the second.

    The score is the second distance's share of the first two together, 1 for a text
    that fits one profile exactly, 0.5 for one between two profiles. The distance is that to
    the first profile as a share of the largest there is: 1 where no n-gram is in it.
    """
    text = F.col(text) if isinstance(text, str) else text
    nothing = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"), F.lit(1.0).alias("distance"))
    if not learned:
        return nothing
    names, codes, ranks = _table(learned, length)

    def run(texts: pa.Array) -> pa.Array:
        total, used = distances(texts, codes, ranks, length)
        order = np.argsort(total, axis=1, kind="stable")
        best = np.take_along_axis(total, order[:, :1], 1)[:, 0]
        second = np.take_along_axis(total, order[:, 1:2], 1)[:, 0] if len(names) > 1 else np.ones(len(total))
        score = np.where(best + second > 0, second / np.maximum(best + second, 1), 0.5)
        return pa.StructArray.from_arrays(
            [
                pa.array([names[k] for k in order[:, 0]], pa.string()),
                pa.array(score.astype(np.float64)),
                pa.array(np.where(used > 0, best / np.maximum(used * length, 1), 1.0)),
            ],
            names=["lang", "score", "distance"],
        )

    guessed = text_function(lambda: run, "struct<lang:string,score:double,distance:double>")(F.lower(text))
    return F.when(has_letters(text), guessed).otherwise(nothing)


def has_letters(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"\p{L}")


def held_out(doc_id: Column | str, parts: int, part: int) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text, modulo `parts`. A null id isn't."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def languages(docs: DataFrame, length: int = PROFILE) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, lang_pred, score; learned from rows not held out."""
    bound_batches(docs.sparkSession)
    learned = profiles(docs.where(~held_out("doc_id", 4, 2)).select("lang", "text"), length)
    rows = docs.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), predict("text", learned, length).alias("p"))
    return rows.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def in_a_language(docs: DataFrame, length: int = PROFILE) -> DataFrame:
    """Rows of `docs` in a language, with all their columns; others go.

    Rows without a letter go, and those as far from every profile as a text can be: none of
    their most frequent n-grams is in one. A doubtful or foreign language is no reason, nor is
    the name of the nearest one. Where there is nothing to learn from, letters alone decide.
    """
    bound_batches(docs.sparkSession)
    learned = profiles(docs.where(~held_out("doc_id", 4, 2)).select("lang", "text"), length)
    if not learned:
        return docs.where(has_letters(docs["text"]))
    name = unused(docs, "_language")
    told = docs.withColumn(name, predict("text", learned, length))
    return told.where(F.col(name)["distance"] < 1).drop(name)
