"""Token ids in files of length-delimited records, with an offset index beside them.

A record is: length of the data (8 bytes), masked CRC-32C of these (4), the data, masked
CRC-32C of the data (4), all little-endian; readers of that common framing can read the
files. The data is a byte that is 1 if there is a doc_id, the doc_id (8 bytes), and the
ids, in 2 bytes each where the vocabulary allows it, else in 4.

Documents are dealt by ranges of doc_id and sorted inside, so file after file holds them
in ascending order. The index, a Parquet table beside the files, has a row per record:
file, byte offset, length, doc_id, token count and the file's tokens before it; a shuffled
read picks rows and reads their ranges only. Checksums are verified on each read.

Defined cases: a null text is an empty one and has the end id alone. A null doc_id comes
first; rows that repeat a doc_id follow one another, ordered by their texts' hashes.
Other columns play no part. An empty table makes files without records.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from flowmart.llm import crc32c
from flowmart.llm.arrow import bound_batches, once
from flowmart.llm.files import Ranges, committed, partition_id
from flowmart.llm.pieces import LONGEST_REMEMBERED, ArrayMemory, ArrayTable, gathered

END_ID = 2
#: Pieces remembered at a time, twice, some 200 bytes each; pieces encoded together.
REMEMBERED = 1 << 19
TOGETHER = 1000
#: Bytes of texts whose pieces are looked up together.
SLICE_BYTES = 4 << 20
HEAD = 12
FRAME = HEAD + 4
ID_BYTES = 9

INDEX = "part int, offset bigint, length bigint, doc_id bigint, n_tokens bigint, before bigint"
RECORD = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


class PieceEncoder:
    """The library's ids of a text, looked up by pieces between white space.

    The tokenizer cuts at white space itself and drops it, so a text's ids are those of
    its pieces. Frequent pieces are remembered, in a table of bounded size. Unknown ones
    are encoded together, with a space between any two, and the ids are dealt to them by
    where in the text their tokens begin.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = id_type(self.tokenizer.get_vocab_size())
        self.marks = {t.content[:1] for t in self.tokenizer.get_added_tokens_decoder().values()}
        # Where the tokenizer lower-cases itself, pieces that differ in case only are one.
        letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        normal = self.tokenizer.normalizer
        self.one_case = normal is not None and normal.normalize_str(letters) == letters.lower()
        self.table = ArrayTable(ArrayMemory(self._learned, self.kind, REMEMBERED), SLICE_BYTES, self._same)

    def _same(self, pieces: pa.Array) -> pa.Array:
        """Pieces in lower case where this is all one to the tokenizer."""
        if not self.one_case:
            return pieces
        lowered = pc.string_is_ascii(pieces)
        for mark in self.marks:  # it may begin an added token, which is looked for in the text as given
            lowered = pc.and_not(lowered, pc.match_substring(pieces, mark))
        return pc.if_else(lowered, pc.ascii_lower(pieces), pieces)

    def _alone(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = [np.array(self.tokenizer.encode(p, add_special_tokens=False).ids, self.kind) for p in pieces]
        return np.concatenate([np.empty(0, self.kind), *made]), np.fromiter(map(len, made), np.int64, len(made))

    def _together(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        text = " ".join(pieces)
        # A piece that may hold an added token is encoded alone, as is a long one.
        if sizes.max() > LONGEST_REMEMBERED or any(m in text for m in self.marks):
            return self._parted(pieces)
        made = self.tokenizer.encode(text, add_special_tokens=False)
        begins = np.fromiter((a for a, _ in made.offsets), np.int64, len(made))
        return np.array(made.ids, self.kind), np.diff(np.searchsorted(begins, np.cumsum(sizes + 1)), prepend=0)

    def _parted(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        alone = np.array([len(p) > LONGEST_REMEMBERED or any(m in p for m in self.marks) for p in pieces])
        one, other = list(compress(pieces, alone)), list(compress(pieces, ~alone))
        made = [self._alone(one), *([self._together(other)] if other else [])]
        lengths = np.empty(len(pieces), np.int64)
        order = np.concatenate([np.flatnonzero(alone), np.flatnonzero(~alone)])
        lengths[order] = np.concatenate([n for _, n in made])
        starts = np.empty(len(pieces), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        return gathered(np.concatenate([ids for ids, _ in made]), starts, lengths)[0], lengths

    def _learned(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        made = [self._together(pieces[at : at + TOGETHER]) for at in range(0, len(pieces), TOGETHER)]
        lengths = np.concatenate([n for _, n in made])
        return np.concatenate([ids for ids, _ in made]), np.cumsum(lengths) - lengths, lengths

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        return [ids[a:b].tobytes() for ids, at in self.table.encode(column) for a, b in zip(at[:-1], at[1:], strict=True)]


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def framed(payloads: list[bytes]) -> tuple[bytes, np.ndarray]:
    """All records one after another, and the offset of each and the end."""
    heads = [len(p).to_bytes(8, "little") for p in payloads]
    head_sums = crc32c.masked(crc32c.checksums(heads))
    data_sums = crc32c.masked(crc32c.checksums(payloads))
    parts = []
    for k, payload in enumerate(payloads):
        parts += [heads[k], head_sums[k].tobytes(), payload, data_sums[k].tobytes()]
    lengths = np.array([len(p) for p in payloads], np.int64)
    return b"".join(parts), np.concatenate([[0], np.cumsum(lengths + FRAME)])


def unframed(data: bytes, offsets: np.ndarray) -> list[bytes]:
    """Verified data of the records that begin at `offsets[:-1]` and end before the next."""
    bounds = list(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
    heads = [data[a : a + 8] for a, _ in bounds]
    payloads = [data[a + HEAD : b - 4] for a, b in bounds]
    head_sums = crc32c.masked(crc32c.checksums(heads))
    data_sums = crc32c.masked(crc32c.checksums(payloads))
    for k, (a, b) in enumerate(bounds):
        if heads[k] + head_sums[k].tobytes() != len(payloads[k]).to_bytes(8, "little") + data[a + 8 : a + HEAD]:
            raise ValueError(f"length of record {k} is damaged")
        if data_sums[k].tobytes() != data[b - 4 : b]:
            raise ValueError(f"data of record {k} is damaged")
    return payloads


def file_name(part: int) -> str:
    return f"tokens-{part:06d}.records"


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder, part = once(("pieces", tokenizer), lambda: PieceEncoder(tokenizer)), partition_id()
    size = np.dtype(encoder.kind).itemsize
    end = np.array([end_id], encoder.kind).tobytes()
    offset = before = 0
    with committed(f"{folder}/{file_name(part)}") as stream:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_pylist()
            made = [m + end for m in encoder.encode(batch.column(1))]
            heads = [bytes([i is not None]) + (i or 0).to_bytes(8, "little", signed=True) for i in ids]
            data, offsets = framed([h + m for h, m in zip(heads, made, strict=True)])
            stream.write(data)
            counts = np.array([len(m) // size for m in made], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(ids), pa.int32()),
                    pa.array(offset + offsets[:-1]),
                    pa.array(np.diff(offsets)),
                    pa.array(ids, pa.int64()),
                    pa.array(counts),
                    pa.array(before + np.cumsum(counts) - counts),
                ],
                names=["part", "offset", "length", "doc_id", "n_tokens", "before"],
            )
            offset += len(data)
            before += int(counts.sum())


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the files and their index below `folder`; the index is returned."""
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    # The hash splits a doc_id that holds many rows; equal rows give equal records in any order.
    dealt = rows.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark").select("doc_id", "text")
    dealt.mapInArrow(lambda batches: _write(batches, folder, tokenizer, end_id), INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def _read(batches: Iterator[pa.RecordBatch], folder: str, kind: str) -> Iterator[pa.RecordBatch]:
    files = Ranges(folder)
    for batch in batches:
        part = batch.column("part").to_numpy()
        offset = batch.column("offset").to_numpy()
        length = batch.column("length").to_numpy()
        # Rows that follow one another in a file are read at once.
        joined = (part[1:] == part[:-1]) & (offset[1:] == offset[:-1] + length[:-1])
        cuts = np.concatenate([[0], np.flatnonzero(~joined) + 1, [len(part)]]) if len(part) else np.zeros(1, int)
        doc_ids, counts, sums = [], [], []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            data = files.read(file_name(int(part[a])), int(offset[a]), int(offset[b - 1] + length[b - 1] - offset[a]))
            for record in unframed(data, np.append(offset[a:b], offset[b - 1] + length[b - 1]) - offset[a]):
                ids = np.frombuffer(record, kind, offset=ID_BYTES).astype("<u4")
                doc_ids.append(int.from_bytes(record[1:ID_BYTES], "little", signed=True) if record[0] else None)
                counts.append(len(ids))
                sums.append(zlib.crc32(ids.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), batch.column("start"), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def read_records(spark: SparkSession, folder: str, tokenizer: str, index: DataFrame | None = None) -> DataFrame:
    """Per record of `index` (the whole one if not given): doc_id, start, n_tokens, ids_crc32.

    All but `start` come from the verified record; `start` counts the ids of all records
    before it in all files.
    """
    bound_batches(spark)
    whole = spark.read.schema(INDEX).parquet(f"{folder}/index")
    parts = whole.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file, as many as the writing job had tasks.
    bases = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    rows = (whole if index is None else index).join(F.broadcast(bases), "part")
    rows = rows.select("part", "offset", "length", (F.col("base") + F.col("before")).alias("start"))
    kind = id_type(Tokenizer.from_file(tokenizer).get_vocab_size())
    return rows.mapInArrow(lambda batches: _read(batches, folder, kind), RECORD)
