import random

import numpy as np
import pytest

from flowmart.llm import hyperminhash
from flowmart.llm.links import components
from flowmart.llm.near_duplicates import near_components, near_dedup
from flowmart.session import Scratch

import brute


def family(seed, n, base_words, edits):
    """Copies of one text with some words replaced."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(5000)}" for _ in range(base_words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rnd.randint(0, edits)):
            text[rnd.randrange(len(text))] = f"z{rnd.randrange(10**6)}"
        out.append(" ".join(text))
    return out


def corpus():
    texts = family(1, 150, 120, 7) + family(2, 40, 40, 3) + family(3, 30, 9, 1) + family(4, 20, 3, 1)
    texts += ["", None, "  \n ", "one", "ONE", "one two", "One\ttwo", "a b c", "a  b c", "long " * 300_000, "x" * 1_000_000]
    texts += [f"{t} tail" for t in texts[:10]]
    random.Random(9).shuffle(texts)
    return [(100 + i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("size", "percent", "block"), [(3, 85, 1024), (5, 80, 16)])
def test_components_match_all_pairs(documents, size, percent, block):
    rows = corpus()
    got = near_components(documents(rows).repartition(5), size, percent, block).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute.near_components(rows, size, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_nulls_repeats_and_stage(documents):
    text = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(5, text), (5, text), (5, "another text of some words here"), (7, text + " ok"), (None, text), (None, "alone"), (9, None), (10, "")]
    docs = documents(rows)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_components(docs, 3, 80).collect()), key=repr)
    assert got == sorted(
        [
            (5, 10, 5, True), (5, 10, 5, True), (5, 4, 5, True), (7, 11, 5, False), (None, 10, 5, False),
            (None, 1, None, True), (9, 0, 9, True), (10, 0, 10, True),
        ],
        key=repr,
    )
    kept = near_dedup(docs, 3, 80)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [
        (0, "alone"), (5, "another text of some words here"), (5, text), (9, ""), (10, ""),
    ]


def test_empty_table(documents):
    assert near_components(documents([])).count() == 0


def test_estimate_follows_similarity():
    rng = np.random.default_rng(3)
    for n, share in ((2000, 0.5), (2000, 0.85), (60, 0.8)):
        errors = []
        for _ in range(40):
            both = rng.integers(0, 2**64, n, dtype=np.uint64)
            same = int(n * 2 * share / (1 + share))
            left, right = np.sort(both[:same]), np.sort(np.concatenate([both[:same], rng.integers(0, 2**64, n - same, dtype=np.uint64)]))
            left = np.sort(np.concatenate([left, both[same:]]))
            true = same / (2 * n - same)
            errors.append(hyperminhash.estimate(hyperminhash.registers(left), hyperminhash.registers(right)) - true)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_registers_hold_zeros_and_mantissa():
    value = np.uint64((5 << hyperminhash.VALUE_BITS) | (0b1011 << (hyperminhash.VALUE_BITS - 6)))
    register = int(hyperminhash.registers(np.array([value]))[5])
    assert register >> hyperminhash.MANTISSA_BITS == 2
    assert register & 1023 == 0b0110000000


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    hub = [(1000, 1000 + k) for k in range(1, 50)] + [(1049, 2000), (7, 7)]
    edges = spark.createDataFrame([(b, a) for a, b in chain + hub] + chain, "a long, b long")
    with Scratch(spark) as scratch:
        found = {r.node: r.component for r in components(edges, scratch, "test").collect()}
    assert {found[i] for i in range(61)} == {0}
    assert {found[i] for i in [*range(1000, 1050), 2000]} == {1000}
    assert len(found) == 61 + 51
