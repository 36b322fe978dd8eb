"""The pipeline against a plain form of its stages."""

import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

import brute


def plain(rows, items, tokenizer):
    """(doc_id, token ids) of what stays of (doc_id, text) rows with distinct ids."""
    rows = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    largest = {}
    for doc_id, text in rows:
        largest[text] = max(largest.get(text, doc_id), doc_id)
    rows = [(i, t) for i, t in rows if largest[t] == i]
    first = {i for i, _, component in brute.near_components(rows, 5, 80) if i == component}
    rows = [(i, t) for i, t in rows if i in first]
    found = brute.contamination(rows, items)
    rows = [r for r, (n, hit, _) in zip(rows, found, strict=True) if not (hit and 20 * hit >= n)]
    return {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in rows}


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(corpus_pipeline.TOKENIZER)


def same(got, want, library):
    assert {r.doc_id for r in got} == set(want) and len(got) == len(want)
    for r in got:
        ids = want[r.doc_id]
        assert r.n_tokens == len(ids) and bytes(r.ids) == np.array(ids, "<u4").tobytes()
        text = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "decontamination", "bpe",
    ]


def test_run_matches_the_plain_form(spark, small, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    same(corpus_pipeline.run(spark, small).collect(), plain(docs, items, library), library)


def test_odd_rows_and_extra_columns(spark, documents, tmp_path, library):
    passage = " ".join(f"p{k}" for k in range(30))
    story = " ".join(f"word{k}" for k in range(60))
    rows = [
        (1, "one text"), (2, "one text"), (3, None), (4, ""), (5, "123 !!"), (6, story), (7, story + " more"),
        (8, passage), (9, passage + " " + " ".join(f"q{k}" for k in range(2000))), (10, "x" * 200_000), (11, "clean words stay here"),
    ]
    docs = documents(rows)
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, str(tmp_path))
        if name != "bpe":
            assert made.columns == docs.columns
        path = str(tmp_path / name)
        made.write.parquet(path)
        docs = spark.read.parquet(path)
    same(docs.collect(), plain(rows, [(1, passage)], library), library)
    assert {r.doc_id for r in docs.collect()} == {2, 6, 9, 10, 11}


def test_empty_table(spark, documents, tmp_path):
    documents([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
