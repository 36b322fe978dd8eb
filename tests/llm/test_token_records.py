import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from flowmart.llm import crc32c, token_records
from flowmart.llm.queries import TOKENIZER
from flowmart.session import scratch_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def slow_crc(data):
    value = 0xFFFFFFFF
    for byte in data:
        value ^= byte
        for _ in range(8):
            value = (value >> 1) ^ (0x82F63B78 if value & 1 else 0)
    return value ^ 0xFFFFFFFF


def test_checksums():
    assert crc32c.checksums([b"123456789"]).tolist() == [0xE3069283]
    rng = np.random.default_rng(1)
    strings = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (4, 5, 127, 128, 129, 1000, 4096, 5000, 17)]
    assert crc32c.checksums(strings).tolist() == [slow_crc(s) for s in strings]
    assert crc32c.checksums([]).tolist() == []


def test_damage_is_found():
    data, offsets = token_records.framed([b"first record", b"second one"])
    assert token_records.unframed(data, offsets) == [b"first record", b"second one"]
    for at in (0, 9, 20, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            token_records.unframed(bytes(broken), offsets)


ROWS = [
    (5, "The cat's HAT sat"), (3, None), (9, ""), (None, "no id here"), (7, "日本 <|endoftext|> é"), (7, "again"),
    (7, "again"), (-4, "negative"), (2**62, "large"), (1, "word " * 200_000), (8, "a\x1cb \u0085c"), (10, "x" * 3000),
]


def test_files_hold_every_document_in_order(spark, documents, library):
    folder = scratch_path(spark, "records")
    index = token_records.write_records(documents(ROWS).repartition(4), folder, TOKENIZER)
    got = sorted(token_records.read_records(spark, folder, TOKENIZER).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i))
    want, start = {}, 0
    for doc_id, text in ROWS:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.setdefault(doc_id, set()).add((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r.start == start
        assert (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        start += r.n_tokens
    # A shuffled read of some records.
    some = index.where("doc_id in (5, 10)").orderBy("offset", ascending=False)
    picked = {r.doc_id: r for r in token_records.read_records(spark, folder, TOKENIZER, some).collect()}
    assert picked == {r.doc_id: r for r in got if r.doc_id in (5, 10)}


def test_empty_table(spark, documents):
    folder = scratch_path(spark, "records")
    token_records.write_records(documents([]), folder, TOKENIZER)
    assert token_records.read_records(spark, folder, TOKENIZER).count() == 0


def test_query_matches_the_library(spark, small, library):
    from flowmart.llm.queries import op3_token_records

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    start = 0
    for r in sorted(op3_token_records(spark, small).collect(), key=lambda r: r.doc_id):
        ids = np.array([*library.encode(docs.pop(r.doc_id) or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not docs


def test_unknown_pieces_make_no_object_each(library):
    # Long pieces, added tokens and both cases among others, in a memory that forgets.
    rng = np.random.default_rng(3)
    words = ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(1, 9, 3000)]
    words[::50] = [w.upper() for w in words[::50]]
    words[10:2500:500] = ["<|EndOfText|>", "a<|endoftext|>b", "é" * 70, "Z" * 300, "don't!"]
    texts = [" ".join(words[at : at + 300]) for at in range(0, 3000, 100)] + ["", None]
    encoder = token_records.PieceEncoder(TOKENIZER)
    encoder.table.slice_bytes, encoder.table.ids.remembered = 4000, 500
    for _ in range(2):
        got = encoder.encode(pa.array(texts, pa.string()))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(g, encoder.kind).tolist() for g in got] == want
    known = encoder.table.ids.known
    assert max(map(len, known.number)) <= token_records.LONGEST_REMEMBERED
    assert len(known.number) == len(known.starts) == len(known.lengths)
    assert len(known.ids) == known.lengths.sum()
    # Texts that differ in case only are learned once, in arrays.
    learned = []
    memory = token_records.ArrayMemory(lambda p: learned.append(p) or encoder._learned(p), encoder.kind, 500)
    encoder.table.ids = memory
    assert encoder.encode(["Cat cat CAT"])[0] == encoder.encode(["cat cat cat"])[0]
    assert learned == [["cat"]]
