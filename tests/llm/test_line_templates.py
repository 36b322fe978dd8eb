import random
import re
from collections import Counter, defaultdict
from math import ceil

import pytest

from flowmart.llm.line_templates import without_recurring_lines

from brute import lower


def plain(rows, depth=3, min_docs=3, min_tokens=5, share=0.7):
    """(doc_id, lines, dropped lines, text) per row."""

    def tokens(line):
        return tuple("*" if re.search("[0-9]", w) else w for w in re.findall(r"[^\x20\x09-\x0D]+", lower(line)))

    parsed = [[tokens(line) for line in (text.split("\n") if text else [])] for _, text in rows]
    docs = Counter(t for lines in parsed for t in {x for x in lines if len(x) >= min_tokens})
    places = Counter()
    for t, n in docs.items():
        for k, token in enumerate(t):
            places[len(t), t[:depth], k, token] += n
    templates = defaultdict(int)
    of = {}
    for t, n in docs.items():
        fixed = tuple((k, x) for k, x in enumerate(t) if places[len(t), t[:depth], k, x] >= min_docs)
        if len(fixed) >= ceil(len(t) * share):
            of[t] = (len(t), t[:depth], fixed)
            templates[of[t]] += n
    out = []
    for (doc_id, text), lines in zip(rows, parsed, strict=True):
        gone = [t in of and templates[of[t]] >= min_docs for t in lines]
        kept = "\n".join(x for x, g in zip(text.split("\n") if text else [], gone, strict=True) if not g)
        out.append((doc_id, len(lines), sum(gone), kept))
    return sorted(out, key=repr)


def corpus():
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    shared = ["Copyright 2024 by the example company all rights reserved", "short one", "\tSign up  for our weekly letter today please "]
    rows = []
    for k in range(60):
        lines = [" ".join(word() for _ in range(rnd.randint(1, 12))) for _ in range(rnd.randint(0, 6))]
        if k % 3 == 0:
            lines.insert(0, f"Posted by user{k} on day {rnd.randint(1, 30)} at hour {rnd.randint(0, 23)} in {word()} news")
        if k % 4 == 0:
            lines.append(rnd.choice(shared))
        if k % 5 == 0:
            lines += ["the same start of a line then " + " ".join(word() for _ in range(5))]
        rows.append((k, "\n".join(lines)))
    passage = " ".join(word() for _ in range(60))
    rows += [(200 + k, f"{passage}\n{word()} has {word()} own {word()} {word()} words {word()}") for k in range(4)]
    rows += [(300, None), (301, ""), (302, "\n\n"), (None, passage), (303, passage + "\n" + passage), (304, "x y z v w u " * 50_000)]
    rows += [(305, "seen twice only by these two rows")] * 2 + [(306, "\n".join(["again and again and again"] * 5))]
    return rows


@pytest.mark.parametrize("options", [{}, {"depth": 2, "min_docs": 2, "min_tokens": 3, "share": 0.5}])
def test_lines_match_the_plain_form(documents, options):
    rows = corpus()
    got = without_recurring_lines(documents(rows).repartition(4), **options).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows, **options)


def test_what_recurs_goes_and_clean_lines_stay(documents):
    rows = corpus()
    got = {(r.doc_id, r.n_lines): r for r in without_recurring_lines(documents(rows)).collect()}
    assert got[200, 2].n_dropped == 1 and " own " in got[200, 2].text
    assert got[303, 2].n_dropped == 2 and got[303, 2].text == ""
    assert "Posted by" not in "".join(r.text for r in got.values())
    assert "short one" in "".join(r.text for r in got.values())
    assert got[305, 1].n_dropped == 0 and got[306, 5].n_dropped == 0


def test_empty_table(documents):
    assert without_recurring_lines(documents([])).count() == 0


@pytest.mark.parametrize("n", [50, 1_000, 10_000])
def test_a_field_of_recurring_values_stays_a_field_at_every_size(documents, n):
    rnd = random.Random(n)
    name = lambda k: "v" + "abcdefghij"[k // 100] + "abcdefghij"[k // 10 % 10] + "abcdefghij"[k % 10]
    line = lambda: f"the user named {name(rnd.randrange(200))} logged in to this site from {name(rnd.randrange(200))} just now"
    rows = [(k, f"own{name(k % 1000)}{k} words\n{line()}") for k in range(n)]
    # A rarer template, of the same field values, and a line of none share the leaf.
    rare = [(n + k, f"the user named {name(k)} took part in long debates on {name(k)} last night") for k in range(5)]
    lone = [(n + 9, "the user named here wrote nothing of what all others say in it")]
    assert {len(t.split("\n")[-1].split()) for _, t in rows + rare + lone} == {13}
    got = without_recurring_lines(documents(rows + rare + lone)).collect()
    assert {r.doc_id: r.n_dropped for r in got} == {k: int(k != n + 9) for k, _ in rows + rare + lone}


def test_a_long_passage_recurs_from_two_documents_on(documents):
    words = [f"w{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    passage, other, short = " ".join(words[:51]), " ".join(words[::-1][:51]), " ".join(words[5:55])
    rows = [(1, f"one of its own\n{passage}"), (2, f"{passage.upper()}\nnot like the first"), (3, f"{short}\nhere"), (4, short)]
    # Numbers are no fields of a long line told whole.
    rows += [(5, other + " 17"), (6, other + " 18"), (7, "a 7\n" + passage[1:] + " 5"), (8, "b\n" + passage[1:] + " 5")]
    rows += [(9, "\n".join([" ".join(words[2:60])] * 2))]
    got = {r.doc_id: r.n_dropped for r in without_recurring_lines(documents(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0, 6: 0, 7: 1, 8: 1, 9: 0}
