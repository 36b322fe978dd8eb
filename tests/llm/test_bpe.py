import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from flowmart.llm import bpe
from flowmart.llm.queries import TOKENIZER

import brute

ODD = [
    "a", "b", "e", "th", "in", "er", "the", "ing", " ", "  ", "\n", "\t", "'s", "'LL", "é", "É", "é", "Σ", "ς", "İ",
    "ß", "中", "文", "日本", " ", "\u0085", "\x1c", "\x1f", "\x00", "​", " ", "1", "23", "²", "½", "٣", "!", "...",
    "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "😀", "👩‍👧", "ﬁ", "Ⅷ", "한글", "_", "-", "'", "aaaa", "lll",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(TOKENIZER)


def texts(seed=5):
    rnd = random.Random(seed)
    mixed = ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 25))) for _ in range(2500)]
    letters = ["".join(rnd.choice("abcdeilnorstuth") for _ in range(rnd.randint(1, 200))) for _ in range(400)]
    return [*mixed, *letters, "", " ", "lo" * 3000, "é" * 2000, "x" * 50_000]


def test_ids_are_the_library_s(library, encoder):
    cases = texts()
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode_batch(cases)]
    for text, ids in zip(cases, got, strict=True):
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:80]
        machine = bpe.TokenText(encoder.text, encoder.merges.word_end, spelled=True)
        assert "".join(map(machine.feed, ids)) == library.decode(ids, skip_special_tokens=False)


def test_transducer_agrees_with_the_merges_and_keeps_little(encoder):
    rnd = random.Random(2)
    merges, transducer = encoder.merges, encoder.transducer
    assert merges.ordered
    for token in rnd.sample(sorted(merges.vocab), 3000):
        assert merges.merged(merges.symbols(token)) == [token]
        assert merges.edge(token) is not None
    words = ["".join(rnd.choice("thingerandoq") for _ in range(rnd.randint(1, 90))) for _ in range(800)]
    short = [w.encode() for w in words if len(w) <= bpe.LockStep.SYMBOLS]
    together = dict(zip(short, encoder.lock_step.encode(short), strict=True))
    for word in words:
        want = [merges.vocab[t] for t in merges.merged([*word[:-1], word[-1] + merges.word_end])]
        assert list(transducer.word(word)) == want
        if word.encode() in together:
            assert np.frombuffer(together[word.encode()], "<u4").tolist() == want
    assert max(len(kept) for kept, _ in transducer.states) <= merges.lookahead


def test_tokens_come_out_while_a_word_goes_on(encoder):
    word = "th" * 50_000
    seen, taken = [], 0

    class Symbols(str):
        def __getitem__(self, key):
            return Symbols(str.__getitem__(self, key))

        def __iter__(self):
            nonlocal taken
            for symbol in str.__iter__(self):
                taken += 1
                yield symbol

    for token in encoder.transducer.word(Symbols(word)):
        seen.append(token)
        if len(seen) == 100:
            assert taken < 100 * encoder.merges.longest + encoder.merges.lookahead
            break
    assert len(seen) == 100


def test_pairs_stay_apart_as_their_merges_say(encoder):
    rnd = random.Random(8)
    merges = encoder.merges
    tokens = [t for t in merges.vocab if not t.endswith("</w>")]
    right = sorted(merges.vocab)
    pairs = [(rnd.choice(tokens), rnd.choice(right)) for _ in range(3000)] + [("a", "a"), ("aa", "a"), ("a", "aa"), ("l", "ll")]
    plain = [merges.merged([*merges.symbols(x), *merges.symbols(y)]) == [x, y] for x, y in pairs]
    assert [merges.stay_apart(x, y) for x, y in pairs] == plain
    ids = np.array([[merges.vocab[x], merges.vocab[y]] for x, y in pairs])
    assert encoder.lock_step._stay_apart(ids[:, 0], ids[:, 1]).tolist() == plain


def test_bytes_become_text_across_tokens(encoder):
    def plain(data):
        symbols = "".join(bpe.SYMBOLS[b] for b in data)
        machine = bpe.TokenText(dict(enumerate(symbols)), "</w>", spelled=False)
        return "".join(machine.feed(k) for k in range(len(symbols))) + machine.finish()

    for text in ("naïve 日本 😀 x", "", "ascii"):
        assert plain(text.encode()) == text
    assert plain(b"a\xffb\xc3") == "a�b�"
    assert plain(b"\xe6\x97x") == "�x"
    ids = np.frombuffer(encoder.encode_batch(["Naïve 日本 café!"])[0], "<u4").tolist()
    machine = bpe.TokenText(encoder.text, "</w>", spelled=False)
    assert "".join(map(machine.feed, ids)) + machine.finish() == "naïve 日本 café ! "


def test_round_trip_rows(documents, library):
    rows = [(1, "The cat's HAT"), (2, None), (3, ""), (None, "日本 <|endoftext|>"), (1, "The cat's HAT"), (4, "word " * 100_000)]
    got = bpe.token_round_trip(documents(rows), TOKENIZER).collect()
    assert len(got) == len(rows)
    for row, (doc_id, text) in zip(got, rows, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert row.doc_id == doc_id and row.n_tokens == len(ids)
        assert bytes(row.ids) == np.array(ids, "<u4").tobytes()
        assert row.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.token_round_trip(documents([]), TOKENIZER).count() == 0


def test_query_matches_the_library(spark, small, library):
    from flowmart.llm.queries import op10_transducer

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = op10_transducer(spark, small).collect()
    assert {r.doc_id for r in got} == set(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id] or "", add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest)
        assert r.decoded_sha256 == brute.sha256(library.decode(ids, skip_special_tokens=False))


def test_every_code_point_as_the_library(library, encoder):
    """Alone between letters; in the planes without assignments every 61st."""
    points = [c for c in range(0x34000) if not 0xD800 <= c < 0xE000] + list(range(0x34000, 0x110000, 61)) + list(range(0xE0000, 0xE0200))
    texts = [" ".join(f"a{chr(c)}b" for c in points[k : k + 512]) for k in range(0, len(points), 512)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode_batch(texts)]
    assert [hex(points[512 * k]) for k in range(len(texts)) if got[k] != want[k]] == []


def test_random_texts_as_the_library(library, encoder):
    rnd = random.Random(11)
    ranges = [(0x20, 0x7F), (0xA0, 0x600), (0x1E00, 0x2100), (0x3040, 0x3100), (0x0, 0xD800), (0x10000, 0x20000)]
    texts = ["".join(chr(rnd.randrange(*rnd.choice(ranges))) for _ in range(14)) for _ in range(20_000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode_batch(texts)]
    assert [t for t, g, w in zip(texts, got, want, strict=True) if g != w] == []


def test_one_long_word_in_constant_memory(library, encoder, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 2000)
    rnd = random.Random(3)
    word = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzäöé") for _ in range(30_000))
    transducer = bpe.Transducer(encoder.merges)
    symbols = word.encode().decode("latin-1").translate(bpe._TO_SYMBOLS)
    assert list(transducer.word(symbols)) == library.encode(word, add_special_tokens=False).ids
    assert len(transducer.steps) <= 2001
    assert max(len(kept) for kept, _ in transducer.states) <= encoder.merges.lookahead


def test_decoding_is_the_machine_s(encoder):
    texts, word_end = bpe.token_texts(TOKENIZER)
    rnd = random.Random(8)
    rows = [[rnd.randrange(49408) for _ in range(n)] for n in (0, 1, 2, 500, 0, 7)]
    column = pa.array([np.array(r, "<u4").tobytes() for r in rows] + [None], pa.binary())
    for cut in (column, column.slice(2, 4)):
        got = bpe._decoded(TOKENIZER, True)(cut).to_pylist()
        for ids, text in zip(cut.to_pylist(), got, strict=True):
            machine = bpe.TokenText(texts, word_end, True)
            assert text == "".join(map(machine.feed, np.frombuffer(ids or b"", "<u4").tolist()))
