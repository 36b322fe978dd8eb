"""WARC archives with a two-level capture index.

Each page becomes a record, a gzip member of its own, in the archive its task writes. Of
records with equal payloads the one with the smallest page_id is a response, the others
are revisits that refer to it and repeat neither payload nor its size in bytes on disk.

The index has two levels. Captures are sorted by their key, the URL with its host
reversed, and written as lines of compressed blocks. A directory beside each index file
has the first key, offset and length of each block; the first keys of the files
themselves are few enough to go to every task. A look-up searches these, then the
directory, then the block it reads, and ends with a range read of the record.

Defined cases: a null html has an empty payload, a null url an empty key and target.
Rows that repeat a page_id each get a record and a place in the index; those with equal
payloads are of one type. A null page_id refers to the group's smallest page_id, or is a
response where no row of the group has one. Other columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowmart.llm.arrow import bound_batches, text_function
from flowmart.llm.files import Ranges, committed, partition_id
from flowmart.session import Scratch

#: Lines of an index block.
BLOCK_LINES = 3000
LEVEL = 6
CAPTURED = "1970-01-01T00:00:00Z"  # pages carry no date of their own

CAPTURE = "key string, page_id bigint, part int, offset bigint, length bigint"
RECORD = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
    "url string, payload binary"
)


def capture_key(url: str | None) -> str:
    """Host labels from the last to the first, then path and query, in lower case."""
    try:
        parts = urlsplit((url or "").strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return quote((url or "").strip().lower(), safe=":/?&=%,;+@")
    if not host:
        return quote((url or "").strip().lower(), safe=":/?&=%,;+@")
    host = re.sub(r"^www\d*\.", "", host)
    default = {"http": 80, "https": 443}.get(parts.scheme)
    place = f":{port}" if port and port != default else ""
    query = f"?{parts.query}" if parts.query else ""
    return quote(",".join(reversed(host.split("."))) + place + ")" + (parts.path or "/") + query, safe=":/?&=%,;+@)")


def _keys(urls: pa.Array) -> pa.Array:
    return pa.array([capture_key(u) for u in urls.to_pylist()], pa.string())


def key_column(url: Column | str) -> Column:
    return text_function(lambda: _keys, "string")(url)


def record_types(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """`page_id, url, body` of each page and `first`, the page_id of the record it repeats."""
    body = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("body")).withColumn("mark", F.sha2("body", 256))
    groups = rows.groupBy("mark").agg(F.min("page_id").alias("first"))
    typed = rows.join(groups, "mark")
    repeats = (F.octet_length("body") >= min_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return typed.select("page_id", "url", "body", F.when(repeats, F.col("first")).alias("first"))


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(int=(1 << 127) | ((page_id or 0) % (1 << 64)))}>"


def warc_record(page_id: int | None, url: str | None, body: bytes, first: int | None) -> bytes:
    """One record: a response with its payload, or a revisit of page `first` without."""
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http + (body if first is None else b"")
    target = quote(url or "", safe="%:/?#[]@!$&'()*+,;=~")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {CAPTURED}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if first is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(first)}",
            f"X-Refers-To-Page: {first}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _headers(text: bytes) -> dict[str, str]:
    lines = text.decode("utf-8").split("\r\n")[1:]
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}


def parse_record(member: bytes) -> tuple:
    """The columns of `RECORD` from one gzip member; a response's payload is verified."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(_headers(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{fields['warc-record-id']}: payload and digest differ")
    page, first = fields.get("x-page-id"), fields.get("x-refers-to-page")
    return (
        int(page) if page is not None else None,
        size,
        digest,
        kind,
        int(first) if first is not None else None,
        fields["warc-target-uri"],
        payload if kind == "response" else None,
    )


def archive_name(part: int) -> str:
    return f"pages-{part:06d}.warc.gz"


def index_name(shard: int) -> str:
    return f"captures-{shard:06d}.gz"


def directory_name(shard: int) -> str:
    return f"captures-{shard:06d}.directory"


def _write_archives(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    part = partition_id()
    with committed(f"{folder}/{archive_name(part)}") as stream:
        body = b"software: flowmart\r\nformat: WARC File Format 1.1\r\n"
        head = (
            f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.UUID(int=part)}>\r\nWARC-Date: {CAPTURED}\r\n"
            f"Content-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n"
        )
        info = _member(head.encode() + body + b"\r\n\r\n")
        stream.write(info)
        offset = len(info)
        for batch in batches:
            ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
            first = batch.column("first").to_pylist()
            offsets, lengths = [], []
            for k, body in enumerate(batch.column("body")):
                data = _member(warc_record(ids[k], urls[k], body.as_py(), first[k]))
                stream.write(data)
                offsets.append(offset)
                lengths.append(len(data))
                offset += len(data)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([capture_key(u) for u in urls], pa.string()),
                    pa.array(ids, pa.int64()),
                    pa.array([part] * len(ids), pa.int32()),
                    pa.array(offsets, pa.int64()),
                    pa.array(lengths, pa.int64()),
                ],
                names=["key", "page_id", "part", "offset", "length"],
            )


def _line_key(key: str, page_id: int | None) -> str:
    """Sorts as (key, page_id) does, null first: ids are written shifted, in equal width."""
    return f"{key} {'-' if page_id is None else f'{page_id + (1 << 63):020d}'}"


def _write_index(batches: Iterator[pa.RecordBatch], folder: str, lines: int) -> Iterator[pa.RecordBatch]:
    """Blocks and directory of one index file; a row tells its first key and block count."""
    shard = partition_id()
    directory: list[tuple[str, int, int]] = []
    block: list[str] = []
    offset = 0
    with committed(f"{folder}/{index_name(shard)}") as stream:

        def close() -> None:
            nonlocal offset
            data = _member("".join(block).encode())
            stream.write(data)
            directory.append((block[0].partition("\t")[0], offset, len(data)))
            offset += len(data)
            block.clear()

        for batch in batches:
            for key, page_id, part, at, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block.append(f"{_line_key(key, page_id)}\t{json.dumps({'file': archive_name(part), 'offset': at, 'length': length})}\n")
                if len(block) == lines:
                    close()
        if block:
            close()
    with committed(f"{folder}/{directory_name(shard)}") as stream:
        stream.write("".join(f"{k}\t{a}\t{n}\n" for k, a, n in directory).encode())
    if directory:
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([directory[0][0]]), pa.array([len(directory)], pa.int64())],
            names=["shard", "first_key", "blocks"],
        )


def write_archive(pages: DataFrame, folder: str, min_bytes: int = 0, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write archives and index below `folder`; the index files' first keys are returned."""
    spark = pages.sparkSession
    bound_batches(spark)
    with Scratch(spark) as scratch:
        captures = record_types(pages, min_bytes).mapInArrow(lambda batches: _write_archives(batches, folder), CAPTURE)
        captures = scratch.pin(captures, "captures")
        # Ties of key and page_id are told apart by place, so a URL of many captures spreads.
        order = ["key", "page_id", "part", "offset"]
        dealt = captures.repartitionByRange(*order).sortWithinPartitions(*order)
        made = dealt.mapInArrow(
            lambda batches: _write_index(batches, folder, block_lines), "shard int, first_key string, blocks bigint"
        )
        made.write.parquet(f"{folder}/shards")
    return spark.read.parquet(f"{folder}/shards")


class CaptureIndex:
    """Look-ups in the two levels below a folder."""

    def __init__(self, folder: str, shards: list[tuple[str, int]]):
        self.ranges = Ranges(folder)
        self.firsts = [first for first, _ in shards]
        self.shards = [shard for _, shard in shards]
        self.directory = lru_cache(maxsize=64)(self._directory)
        self.block = lru_cache(maxsize=4)(self._block)

    def _directory(self, shard: int) -> tuple[list[str], list[tuple[int, int]]]:
        files, folder = self.ranges.files, self.ranges.folder
        with files.open_input_file(f"{folder}/{directory_name(shard)}") as file:
            rows = [line.split("\t") for line in file.read().decode().splitlines()]
        return [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows]

    def _block(self, shard: int, offset: int, length: int) -> tuple[list[str], list[str]]:
        text = zlib.decompress(self.ranges.read(index_name(shard), offset, length), 31).decode()
        rows = [line.split("\t") for line in text.split("\n")[:-1]]
        return [r[0] for r in rows], [r[1] for r in rows]

    def find(self, wanted: str) -> Iterator[dict]:
        """Places of all captures with the line key; they may run over several blocks and files."""
        at = max(bisect_left(self.firsts, wanted) - 1, 0)
        while at < len(self.firsts) and self.firsts[at] <= wanted:
            shard = self.shards[at]
            firsts, places = self.directory(shard)
            k = max(bisect_left(firsts, wanted) - 1, 0)
            while k < len(firsts) and firsts[k] <= wanted:
                keys, values = self.block(shard, *places[k])
                for j in range(bisect_left(keys, wanted), bisect_right(keys, wanted)):
                    yield json.loads(values[j])
                k += 1
            at += 1


def _look_up(batches: Iterator[pa.RecordBatch], folder: str, shards: list[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    index = CaptureIndex(folder, shards)
    for batch in batches:
        found = []
        for key, page_id in zip(batch.column("key").to_pylist(), batch.column("page_id").to_pylist(), strict=True):
            found += [(p["file"], p["offset"], p["length"]) for p in index.find(_line_key(key, page_id))]
        columns = list(zip(*found, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
            names=["file", "offset", "length"],
        )


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    ranges = Ranges(folder)
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [field.split(" ")[0] for field in RECORD.split(", ")]
    for batch in batches:
        rows = [
            parse_record(ranges.read(file, offset, length))
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True)
        ]
        columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names
        )


def read_captures(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """Records of the captures that `wanted` names by `url` and `page_id`, each once.

    Only the first key of each index file, one per task of the writing job, is collected.
    """
    bound_batches(spark)
    shards = sorted((r.first_key, r.shard) for r in spark.read.parquet(f"{folder}/shards").collect())
    keys = wanted.select(key_column("url").alias("key"), "page_id").distinct()
    # Sorted requests come to one block after another.
    keys = keys.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    places = keys.mapInArrow(lambda batches: _look_up(batches, folder, shards), "file string, offset bigint, length bigint")
    places = places.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return places.mapInArrow(lambda batches: _read(batches, folder), RECORD)
