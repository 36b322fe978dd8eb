import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from flowmart.llm import rank_profiles
from flowmart.llm.queries import op7_rank_profiles


def grams(text):
    out = Counter()
    for word in bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in (text or "").lower().encode()).split():
        padded = b" " + word + b" "
        out.update(padded[k : k + 1] for k in range(1, len(padded) - 1))
        out.update(padded[k : k + 2] for k in range(len(padded) - 1))
        out.update(padded[k : k + 3] for k in range(len(padded) - 2))
    return {(len(g) - 1) << 24 | int.from_bytes(g, "big"): n for g, n in out.items()}


def ranked(counts, length):
    return sorted(counts, key=lambda c: (-counts[c], c))[:length]


TEXTS = [
    "The cat and the hat, the END.", None, "", "?! 12", "été à la plage", "x", "a" * 700_000 + " b", "one " * 100_000,
    "un deux trois un", "the the", "ß", "日本 語",
]


def test_grams_and_distances_match_the_plain_form():
    texts = pa.array([(t or "").lower() for t in TEXTS])
    learned = {"a": ranked(grams("the cat sat on the mat and the dog"), 50), "b": ranked(grams("un deux trois la plage été"), 50)}
    names, codes, ranks = rank_profiles._table(learned, 50)
    total, _ = rank_profiles.distances(texts, codes, ranks, 50)
    for row, text in enumerate(TEXTS):
        mine = ranked(grams(text), 50)
        for k, name in enumerate(names):
            place = {c: r for r, c in enumerate(learned[name])}
            assert total[row, k] == sum(abs(place[c] - r) if c in place else 50 for r, c in enumerate(mine)), text


def test_profiles_count_all_training_texts(spark):
    rows = [("en", t) for t in TEXTS] + [("fr", "le la les"), ("fr", "le"), (None, "zzz")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    learned = rank_profiles.profiles(df, 30)
    for name in ("en", "fr"):
        whole = Counter()
        for lang, text in rows:
            if lang == name:
                whole.update(grams(text))
        assert learned[name] == ranked(whole, 30)
    assert set(learned) == {"en", "fr"}


def test_defined_cases(documents):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "the"), (1, None), (2, "the cat"), (2, "the cat")]
    docs = documents(rows)
    got = rank_profiles.languages(docs).collect()
    assert len(got) == len(rows)
    for r, (doc_id, text) in zip(got, rows, strict=True):
        assert r.doc_id == doc_id
        assert r.held_out == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert r.lang_pred == ("en" if any(c.isalpha() for c in text or "") else "und")
        assert 0 <= r.score <= 1
    kept = rank_profiles.in_a_language(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(any(c.isalpha() for c in t or "") for _, t in rows)


def test_empty_and_unlabelled(documents):
    assert rank_profiles.languages(documents([])).count() == 0
    row = rank_profiles.languages(documents([(1, "word")], lang=None)).first()
    assert (row.lang_pred, row.score) == ("und", 0.0)


def test_held_out_accuracy(spark, small):
    found = op7_rank_profiles(spark, small).where("held_out")
    true = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang")
    share = found.join(true, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert share > 0.97
    assert np.isfinite(share)


def test_ranks_of_very_frequent_grams_follow_their_counts():
    text = "b " * 1_100_000 + "a " * 1_060_000
    learned = {"x": [ord("b"), ord("a")]}
    _, codes, ranks = rank_profiles._table(learned, 400)
    b_first, used = rank_profiles.distances(pa.array([text]), codes, ranks, 400)
    learned = {"x": [ord("a"), ord("b")]}
    _, codes, ranks = rank_profiles._table(learned, 400)
    a_first, _ = rank_profiles.distances(pa.array([text]), codes, ranks, 400)
    assert b_first[0, 0] < a_first[0, 0]


def test_stage_without_labels_keeps_texts_with_letters(documents):
    rows = [(1, "some words"), (2, "123 ..."), (3, None), (4, "ещё слова")]
    kept = rank_profiles.in_a_language(documents(rows, lang=None))
    assert {r.doc_id for r in kept.collect()} == {1, 4}


def test_stage_keeps_clean_texts_of_every_learned_language_and_a_learned_und(documents):
    words = {"en": "the quick brown fox and the lazy dog", "de": "der schnelle braune fuchs und der hund", "und": "zzyx qwv xkcd zzq"}
    names = sorted(words)
    rows = [(k, f"{words[names[k % 3]]} {k}") for k in range(60)]
    rows += [(100, "日本語の文章です"), (101, "Русский текст"), (102, "other words of some tongue"), (103, "4711")]
    kept = rank_profiles.in_a_language(documents(rows, lang=lambda i: names[i % 3] if i < 60 else None))
    assert {r.doc_id for r in kept.collect()} == {*range(60), 102}
