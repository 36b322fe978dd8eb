"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are its words, and the shapes of its words: runs of capitals, other
letters, digits and each other sign; two more count words that follow themselves and
shingles that came before in the text. Terms are hashed into a fixed number of dimensions,
damped, and weighted by how rare they are over all documents. The singular vectors of a
labelled sample give the latent space. The sample's vectors are broadcast; each text's
cosine with every one of them is computed, in blocks, and its nearest neighbours vote
with their similarity.

The sample has at most `SAMPLE` labelled rows, those with the smallest hashes of their
ids; document frequencies cover all documents, and every text is scored as a whole.

Defined cases: a null text is an empty one. A text without terms, or unlike every
labelled one, gets the share of label 1 in the sample; without labelled rows all scores
are 0.5. Labels that are null or belong to no document are left out; of several labels of
one doc_id the mean counts, of several documents of one doc_id each is a row. Other
columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowmart.llm.arrow import bound_batches, text_function
from flowmart.llm.words import SPACED, shingles, word_slices

DIMENSIONS = 4096
#: The last dimensions count repeats.
REPEATS = 2
LATENT = 64
#: Labelled rows that make the space and vote.
SAMPLE = 4000
NEIGHBOURS = 25
BLOCK = 512

#: Classes of bytes; white space keeps its own value.
_SHAPES = np.arange(256, dtype=np.uint8)
_SHAPES[65:91], _SHAPES[97:123], _SHAPES[48:58], _SHAPES[128:] = 1, 2, 3, 2


def _term_counts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row, dimension, count) of the terms of runs of texts."""
    half = DIMENSIONS // 2
    for recode, base, bins in ((None, 0, half), (_SHAPES, half, half - REPEATS)):
        for first, names, offsets in word_slices(texts, SPACED, recode):
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            keys, counts = np.unique(row * half + (names % np.uint64(bins)).astype(np.int64), return_counts=True)
            yield first, keys // half, keys % half + base, counts
            if recode is None:
                yield from _repeats(first, names, offsets, row)


def _repeats(first: int, names: np.ndarray, offsets: np.ndarray, row: np.ndarray):
    """How many words follow themselves, and how many shingles of three words came before."""
    same = (names[1:] == names[:-1]) & (row[1:] == row[:-1])
    made, bounds = shingles(names, offsets, 3)
    mine = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((made, mine))
    again = (made[order][1:] == made[order][:-1]) & (mine[order][1:] == mine[order][:-1])
    for k, found in enumerate((row[1:][same], mine[order][1:][again])):
        rows, counts = np.unique(found, return_counts=True)
        yield first, rows, np.full(len(rows), DIMENSIONS - REPEATS + k), counts


def _count_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dimension, documents that have it) of a task; dimension -1 counts all."""
    total = np.zeros(DIMENSIONS, np.int64)
    n = 0
    for batch in batches:
        n += batch.num_rows
        for _, _, dimension, _ in _term_counts(batch.column(0)):
            total += np.bincount(dimension, minlength=DIMENSIONS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(-1, DIMENSIONS)), pa.array(np.concatenate([[n], total]))], names=["dimension", "n"]
    )


def _vectors(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Weighted term vectors of unit length, one row per text."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for first, row, dimension, count in _term_counts(texts):
        out[first + row, dimension] = (1 + np.log(count)) * weights[dimension]
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(length, 1e-12)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def _space(vectors: np.ndarray, latent: int) -> np.ndarray:
    """Leading right singular vectors, by a few rounds of subspace iteration."""
    basis = np.random.default_rng(7).standard_normal((vectors.shape[1], min(latent + 8, len(vectors)))).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(vectors.T @ (vectors @ basis))
    _, _, right = np.linalg.svd(vectors @ basis, full_matrices=False)
    return (basis @ right.T)[:, :latent].astype(np.float32)


def votes(points: np.ndarray, labelled: np.ndarray, labels: np.ndarray, neighbours: int) -> np.ndarray:
    """Similarity-weighted mean label of each point's nearest labelled vectors."""
    prior = float(labels.mean())
    out = np.full(len(points), prior)
    k = min(neighbours, len(labels))
    for start in range(0, len(points), BLOCK):
        cosine = points[start : start + BLOCK] @ labelled.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64)
        total = weight.sum(axis=1)
        found = total > 1e-9
        out[start : start + BLOCK][found] = (weight * labels[near]).sum(axis=1)[found] / total[found]
    return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, latent: int = LATENT) -> dict | None:
    """Weights, space and labelled vectors. `labels` has doc_id and label, `docs` doc_id and text."""
    bound_batches(docs.sparkSession)
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.avg("label").alias("label"))
    rows = docs.select("doc_id", "text").join(known, "doc_id").select("label", "text", F.xxhash64("doc_id").alias("_order"))
    counted = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_count_documents, "dimension bigint, n bigint")
    frequency = {r.dimension: r.n for r in counted.groupBy("dimension").agg(F.sum("n").alias("n")).collect()}
    weights = np.zeros(DIMENSIONS, np.float32)
    for dimension in range(DIMENSIONS):
        weights[dimension] = np.log((1 + frequency.get(-1, 0)) / (1 + frequency.get(dimension, 0))) + 0.1

    def features(texts: pa.Array) -> pa.Array:
        vectors = _vectors(texts, weights)
        made = [np.flatnonzero(v) for v in vectors]
        return pa.StructArray.from_arrays(
            [pa.array(made, pa.list_(pa.int32())), pa.array([v[m] for v, m in zip(vectors, made, strict=True)], pa.list_(pa.float32()))],
            names=["at", "value"],
        )

    # The rows of the smallest hashes, found on ids alone; their texts are joined to so many rows at most.
    least = rows.select("_order").orderBy("_order").limit(sample)
    edge = least.agg(F.max("_order")).first()[0]
    if edge is None:
        return None
    chosen = rows.where(F.col("_order") <= edge).limit(sample)
    made = chosen.select("label", "_order", text_function(lambda: features, "struct<at:array<int>,value:array<float>>")("text").alias("v"))
    found = sorted(made.collect(), key=lambda r: (r["_order"], r.label, r.v["at"]))
    vectors = np.zeros((len(found), DIMENSIONS), np.float32)
    for k, row in enumerate(found):
        vectors[k, row.v["at"]] = row.v["value"]
    space = _space(vectors, latent)
    return {
        "weights": weights,
        "space": space,
        "labelled": _unit(vectors @ space),
        "labels": np.array([r.label for r in found], np.float64),
    }


def score(text: Column | str, model: dict | None, spark, neighbours: int = NEIGHBOURS) -> Column:
    """Share of label 1 among the text's neighbours, 0 to 1."""
    if model is None:
        return F.lit(0.5)
    held = spark.sparkContext.broadcast(model)

    def prepare():
        m = held.value

        def run(texts: pa.Array) -> pa.Array:
            out = []
            for start in range(0, len(texts), BLOCK):
                points = _unit(_vectors(texts.slice(start, BLOCK), m["weights"]) @ m["space"])
                out.append(votes(points, m["labelled"], m["labels"], neighbours))
            return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

        return run

    return text_function(prepare, "double")(text)
