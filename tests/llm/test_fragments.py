import random

import numpy as np
import pyarrow as pa
import pytest

from flowmart.llm import fragments
from flowmart.llm.fragments import GlobalOrder, jaccard_components

import brute
from test_near_duplicates import corpus, family


@pytest.mark.parametrize(("size", "percent", "block", "shared"), [(5, 80, 1024, 4096), (3, 85, 16, 1), (1, 50, 8, 4096)])
def test_components_match_all_pairs(documents, monkeypatch, size, percent, block, shared):
    monkeypatch.setattr(fragments, "SHARED_PAIRS", shared)
    rows = corpus()
    rnd = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(60))
    # One passage in many texts that are otherwise different, or mostly are the passage.
    rows += [(2000 + i, f"{passage} " + " ".join(f"u{rnd.randrange(10**6)}" for _ in range(rnd.choice([8, 200])))) for i in range(120)]
    got = jaccard_components(documents(rows).repartition(5), size, percent, block).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute.near_components(rows, size, percent)


def test_nulls_and_repeats(documents):
    text = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(5, text), (5, text), (5, "another text of some words here"), (7, text + " ok"), (None, text), (None, "alone"), (9, None), (10, "")]
    made = jaccard_components(documents(rows), 3, 80)
    assert made.columns == ["doc_id", "n_shingles", "component_id", "text_mark"]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in made.collect()), key=repr)
    assert got == sorted(
        [(5, 10, 5), (5, 10, 5), (5, 4, 5), (7, 11, 5), (None, 10, 5), (None, 1, None), (9, 0, 9), (10, 0, 10)], key=repr
    )


def test_empty_table(documents):
    assert jaccard_components(documents([])).count() == 0


def test_fragments_cut_the_order():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 50, 1 << fragments.TABLE_BITS)
    counts[:5000] = 10**6
    order = GlobalOrder(counts)
    items = np.sort(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    segments = order.segments(items)
    assert len(segments) == fragments.FRAGMENTS
    assert sorted(np.concatenate(segments).tolist()) == items.tolist()
    lows = [order.places(s).min() for s in segments if len(s)]
    highs = [order.places(s).max() for s in segments if len(s)]
    assert all(high <= low for high, low in zip(highs[:-1], lows[1:], strict=True))
    ranked = order.places(order.prefix(items, 80))
    assert len(ranked) == 1001 and (np.diff(ranked.astype(object)) >= 0).all()
    assert ranked.max() <= np.sort(order.places(items))[1000]


def test_profiles_never_exclude_a_link():
    rng = np.random.default_rng(6)
    for n in (3, 60, 900, 20_000):
        both = rng.integers(0, 2**64, n, dtype=np.uint64)
        own = [rng.integers(0, 2**64, max(1, n // 9), dtype=np.uint64) for _ in range(2)]
        sets = [np.unique(np.concatenate([both, x])) for x in own]
        tables = [np.frombuffer(fragments._profile(s), np.uint8)[None] for s in sets]
        apart = len(np.setxor1d(*sets))
        assert 0 < fragments.least_apart(*tables)[0] <= apart


def test_overlaps_of_lists():
    left = pa.array([[1, 2, 3], [], [5], [-1, 7]], pa.list_(pa.int64()))
    right = pa.array([[2, 3, 9], [1], [6], [-1, 7]], pa.list_(pa.int64()))
    assert fragments._overlaps(left, right).to_pylist() == [2, 0, 0, 2]
    assert fragments._overlaps(left.slice(0, 0), right.slice(0, 0)).to_pylist() == []


def test_large_family_is_one_component(documents):
    rows = list(enumerate(family(8, 300, 80, 2)))
    got = {r.component_id for r in jaccard_components(documents(rows), 5, 80, 32).collect()}
    assert got == {c for _, _, c in brute.near_components(rows, 5, 80)}
