import pytest
from pyspark.sql import functions as F

from flowmart.llm.block_naming import exact_dedup, exact_groups

from brute import sha256

LONG = "abcdefghij" * 2000
ROWS = [
    (1, "one"), (2, "one"), (3, None), (4, ""), (5, "One"), (6, LONG), (7, LONG + "x"), (8, LONG), (9, "x" + LONG),
    (10, "é" * 50), (11, "é" * 50), (12, "one "), (12, "one "), (None, "one"), (13, LONG[:4096]), (14, LONG[:4097]),
    (14, "two"), (15, LONG[:8192]), (None, "none"), (None, "none"),
]


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, sha256(text)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [16, 4096])
def test_groups_of_equal_texts(documents, block):
    got = exact_groups(documents(ROWS), block_bytes=block).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(ROWS)


def test_shared_fingerprints_are_told_apart_by_content(documents):
    few = lambda block: F.pmod(F.xxhash64(block), F.lit(3))
    got = exact_groups(documents(ROWS), block_bytes=64, fingerprint=few).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(ROWS)


def test_empty_table(documents):
    assert exact_groups(documents([])).count() == 0
    assert exact_dedup(documents([])).count() == 0


def test_one_row_of_each_group_stays_with_its_columns(documents):
    docs = documents(ROWS)
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns
    texts = sorted(r.text or "" for r in kept.collect())
    assert texts == sorted({t or "" for _, t in ROWS})
    by_text = {r.text or "": r.doc_id for r in kept.collect()}
    assert by_text["one"] == 2 and by_text[""] == 4 and by_text["none"] is None and by_text[LONG] == 8
    assert {r.sha for r in kept.collect()} == {"x"}


def test_plan_has_no_python(documents):
    plan = exact_groups(documents(ROWS))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
