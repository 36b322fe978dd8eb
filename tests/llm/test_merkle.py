import random

import pytest
from pyspark.sql import functions as F

from flowmart.llm.merkle import Sweep, fold, leaf_digest, manifest, proof_digest

import brute

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, idx long, kept int, digest string"


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, 2, "y") for row in rows], SCHEMA)


def corpus():
    rnd = random.Random(4)
    rows = [(i, rnd.choice(["a", "b", "é", None, "z" * 40]), rnd.choice(["en", None]), rnd.choice([3, None]), f"text {i}") for i in range(400)]
    rows += [(1000 + i, "hot", "en", i, f"line\n{i}" * rnd.randint(0, 3)) for i in range(900)]
    rows += [(5000, "lone", "en", 1, "only one"), (None, "a", "en", 1, "no id"), (None, "a", None, None, None), (7, "", "en", 2, "")]
    rows += [(7, "a", "en", 2, "again"), (7, "a", "en", 2, "again"), (8, "b", "en", 1, "x\n" * 400_000)]
    rnd.shuffle(rows)
    return rows


def got(df):
    return sorted(
        ((r.doc_id, r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.proof]) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_is_that_of_plain_trees(spark, levels):
    rows = corpus()
    made = manifest(table(spark, rows).repartition(5), levels=levels)
    assert got(made) == sorted(brute.manifest(rows), key=repr)


def test_proofs_lead_to_the_root_and_tampering_is_found(spark):
    rows = corpus()
    docs = table(spark, rows)
    changed = leaf_digest(text=F.translate("text", "\n", ""))
    made = manifest(docs, changed).select(
        "doc_id", "leaf", "root", "kept", fold(F.col("leaf"), F.col("proof")).alias("own"),
        fold(F.col("kept"), F.col("proof")).alias("other"), proof_digest(F.col("proof")).alias("sum"),
    ).collect()
    want = {(x[0], x[1]): x for x in brute.manifest(rows)}
    for r in made:
        assert r.own == r.root
        assert (r.other == r.root) == (r.kept == r.leaf)
        assert r.sum == brute._digest(*[left + right for left, right in want[r.doc_id, r.leaf][4]])
    assert sum(r.kept != r.leaf for r in made) > 500


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_small_tables(spark, n):
    rows = [(i, "s", "en", 1, "t") for i in range(n)]
    assert got(manifest(table(spark, rows))) == (sorted(brute.manifest(rows), key=repr) if n else [])


def test_a_sweep_holds_few_messages(monkeypatch):
    from flowmart.llm import merkle

    longest = 0
    push = merkle.heapq.heappush

    def counted(queue, message):
        nonlocal longest
        push(queue, message)
        longest = max(longest, len(queue))

    monkeypatch.setattr(merkle.heapq, "heappush", counted)
    sweep = Sweep([brute._digest(str(k)) for k in range(3**7)], 7)
    sweep.forward()
    assert longest <= 3 * 7
    sweep.backward(None)
    assert longest <= 3 * 7
