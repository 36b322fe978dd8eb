import random

import numpy as np
import pyarrow as pa
import pytest

from flowmart.llm import max_sketches
from flowmart.llm.max_sketches import rank

import brute

EXTRA = "text_mark int, rank string, query int, mark string, terms int, value string, sketch int"


def corpus():
    rnd = random.Random(7)
    vocabulary = [f"w{int(rnd.paretovariate(0.6))}" for _ in range(4000)]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([3, 40, 300])))) for i in range(500)]
    rows += [(600 + i, rows[3][1]) for i in range(90)]  # more copies than ranks
    rows += [(800, None), (801, ""), (802, "... !"), (None, rows[5][1]), (5, rows[6][1] + " more"), (803, "W1 w1, É w1"), (804, "w1 " * 200_000)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 5, 60])))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "nowhere"), (103, rows[3][1]), (104, "w1 w1 W1"), (104, "é w2"), (None, "w3 w4")]
    rnd.shuffle(rows)
    return rows, items


def result(spark, documents, rows, items, k):
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, query int")
    made = rank(documents(rows).repartition(6), asked, k)
    assert made.columns == ["item_id", "rank", "doc_id", "score", "text_mark"]
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in made.collect()), key=repr)


@pytest.mark.parametrize(("k", "batch"), [(50, 256), (3, 7)])
def test_ranks_are_those_of_all_scores(spark, documents, monkeypatch, k, batch):
    monkeypatch.setattr(max_sketches, "BATCH_ITEMS", batch)
    rows, items = corpus()
    assert result(spark, documents, rows, items, k) == sorted(brute.ranking(rows, items, k), key=repr)


def test_repeated_rows_rank_each(spark, documents):
    rows = [(1, "one two"), (1, "one two"), (2, "one"), (3, "three")]
    assert result(spark, documents, rows, [(9, "one two")], 5) == sorted(brute.ranking(rows, [(9, "one two")], 5), key=repr)


def test_empty_tables(spark, documents):
    assert result(spark, documents, [], [(1, "a b")], 5) == []
    assert result(spark, documents, [(1, "a b")], [], 5) == []
    assert result(spark, documents, [(1, None)], [(1, "a")], 5) == []


def test_bounds_are_not_below_scores():
    rnd = np.random.default_rng(1)
    texts = pa.array([" ".join(f"t{x}" for x in rnd.zipf(1.3, n)) for n in (1, 30, 400, 2000, 5)])
    rows = pa.RecordBatch.from_arrays([pa.array(range(5)), texts, pa.array(range(5))], names=["doc_id", "text", "mark"])
    made = list(max_sketches._indexed(iter([rows]), np.zeros(1 << max_sketches.TABLE_BITS, bool)))[0]
    terms = np.unique(np.concatenate([names for _, _, _, names, _ in max_sketches.term_counts(texts)]))
    picked = [np.sort(rnd.choice(len(terms), 20, replace=False)) for _ in range(30)]
    queries = max_sketches.Queries(
        np.arange(30), terms, np.concatenate(picked), rnd.integers(1, 9000, 600), np.arange(31) * 20, 5, 2436
    )
    n = made.column("n").to_numpy()
    bounds = queries.bounds(n, made.column("sketch"))
    for _, n, at, names, times in max_sketches.term_counts(texts):
        table = np.zeros((5, len(terms)), np.int64)
        table[at, np.searchsorted(terms, names)] = max_sketches.impact(times, queries.lengths(n)[at])
        exact = queries.scores(table, np.repeat(np.arange(5), 30), np.tile(np.arange(30), 5)).reshape(5, 30)
    assert (bounds >= exact).all() and (bounds[2] < queries.weights.sum() * max_sketches.MAX_IMPACT).all()
