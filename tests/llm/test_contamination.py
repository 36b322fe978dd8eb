import random

import pytest

from flowmart.llm.contamination import decontaminated, with_contamination

import brute


def case():
    rnd = random.Random(4)
    vocabulary = [f"w{k}" for k in range(40)] + ["Straße", "naïve", "日本"]
    items = [(k, " ".join(rnd.choice(vocabulary) for _ in range(n))) for k, n in enumerate([30, 13, 14, 5, 2, 1, 40, 13])]
    items += [(3, "repeated id with five words"), (None, "an item that has no number at all"), (11, None), (12, "!!! ..."), (13, items[0][1])]
    rows = []
    for k in range(120):
        text = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 80))]
        for _ in range(rnd.randint(0, 2)):
            words = (rnd.choice(items)[1] or "").split()
            cut = rnd.randint(0, len(words))
            at = rnd.randint(0, len(text))
            text[at:at] = words[cut // 3 :]
        rows.append((k, rnd.choice([" ", ", ", "\n"]).join(text).upper() if k % 3 else " ".join(text)))
    rows += [(500, None), (501, ""), (502, "?"), (None, items[0][1]), (503, "x " * 200_000 + items[0][1]), (504, items[1][1]), (504, items[1][1])]
    return rows, items


@pytest.mark.parametrize("block_windows", [1 << 17, 20])
def test_hits_match_all_windows(spark, documents, block_windows):
    rows, items = case()
    rows = rows if block_windows > 20 else rows[:60] + rows[-5:]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, found string")
    docs = documents(rows).repartition(3)
    got = with_contamination(docs, benchmark, "found", block_windows=block_windows).select("doc_id", "text", "found.*").collect()
    want = {t: w for (_, t), w in zip(rows, brute.contamination(rows, items), strict=True)}
    assert len(got) == len(rows)
    for r in got:
        n, hit, found = want[r.text]
        assert (r.n_words, r.n_hit, list(r["items"]), r.n_items) == (n, hit, found, len(found)), r.text[:80]
        assert r.contaminated == (hit > 0 and 20 * hit >= n)


def test_stage_keeps_clean_rows_whole(spark, documents):
    passage = " ".join(f"p{k}" for k in range(20))
    rows = [(1, passage), (2, passage + " q" * 400), (3, "clean"), (4, None), (3, "clean")]
    docs = documents(rows)
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    left = decontaminated(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 3, 4]


def test_empty_tables(spark, documents):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    row = with_contamination(documents([(1, "some words")]), benchmark, "found").select("found.*").first()
    assert (row.n_words, row.n_hit, row.n_items, row["items"], row.contaminated) == (2, 0, 0, [], False)
    full = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert with_contamination(documents([]), full, "found").count() == 0
