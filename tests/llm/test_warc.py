import base64
import gzip
import hashlib

from pyspark.sql import functions as F

from flowmart.llm import warc
from flowmart.session import scratch_path

EXTRA = "key string, part int, body string, mark string"


def pages(spark, rows):
    full = [(i, u, h, "x", 1, "b", "m") for i, u, h in rows]
    return spark.createDataFrame(full, f"page_id long, url string, html string, {EXTRA}")


ROWS = [
    (1, "http://www.Example.com/a?b=1", "<p>one</p>"), (2, "https://example.com:8080/a", "<p>one</p>"), (3, None, None),
    (4, "not a url \r\nX-Evil: 1", ""), (5, "http://example.com/é ü", "é" * 50_000), (6, "http://example.com/a?b=1", "<p>two</p>"),
    (6, "http://example.com/a?b=1", "<p>two</p>"), (None, "http://other.org/", "<p>one</p>"), (None, "http://other.org/x", "only"),
    (7, "http://[bad/", "\r\n\r\nWARC/1.1\r\n\r\n"), (-3, "http://example.com/a?b=1", "negative"),
] + [(100 + k, "http://hot.example.com/same", f"copy {k % 3}") for k in range(60)]


def want(rows):
    groups = {}
    for page, _, html in rows:
        groups.setdefault(html or "", []).append(page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        first = min((p for p in groups[html or ""] if p is not None), default=None)
        repeat = first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "revisit" if repeat else "response", first if repeat else None))
    return sorted(out, key=repr)


def test_every_record_is_found_through_the_index(spark):
    df = pages(spark, ROWS).repartition(3)
    folder = scratch_path(spark, "warc")
    shards = warc.write_archive(df, folder, block_lines=4)
    assert shards.agg(F.max("blocks")).first()[0] >= 1
    got = warc.read_captures(spark, folder, df).collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == want(ROWS)
    for r in got:
        if r.record_type == "response":
            assert hashlib.sha1(r.payload).digest() == base64.b32decode(r.payload_digest)
    some = df.where("page_id = 6 or page_id is null or page_id = 130")
    assert sorted(repr(r.page_id) for r in warc.read_captures(spark, folder, some).collect()) == ["130", "6", "6", "None", "None"]
    absent = pages(spark, [(999, "http://example.com/a?b=1", ""), (1, "http://zzz.example.com/", "")])
    assert warc.read_captures(spark, folder, absent).count() == 0


def test_small_payloads_may_all_be_responses(spark):
    folder = scratch_path(spark, "warc")
    df = pages(spark, [(1, "http://a.org/1", "ab"), (2, "http://a.org/2", "ab"), (3, "http://a.org/3", "abc"), (4, "http://a.org/4", "abc")])
    warc.write_archive(df, folder, min_bytes=3)
    got = {r.page_id: r.record_type for r in warc.read_captures(spark, folder, df).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(spark):
    folder = scratch_path(spark, "warc")
    warc.write_archive(pages(spark, []), folder)
    assert warc.read_captures(spark, folder, pages(spark, ROWS[:2])).count() == 0


def test_keys_and_records():
    key = warc.capture_key
    assert key("http://www.Example.com/A?b=1#top") == "com,example)/a?b=1"
    assert key("https://blog.example.com:443/x") == "com,example,blog)/x"
    assert key("https://example.com:8443") == "com,example:8443)/"
    assert key(None) == "" and " " not in key("a b\n")
    member = gzip.compress(warc.warc_record(5, "http://a.org/\r\nX: 1", b"payload", None))
    raw = gzip.decompress(member)
    assert b"\r\nX: 1" not in raw.split(b"\r\n\r\n")[0]
    assert warc.parse_record(member)[:5] == (5, 7, base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), "response", None)


def test_look_ups_cross_blocks_and_files(tmp_path):
    class Fake(warc.CaptureIndex):
        def __init__(self, blocks):
            # Two files of several blocks each.
            self.blocks = {0: blocks[: len(blocks) // 2], 1: blocks[len(blocks) // 2 :]}
            self.firsts = [self.blocks[s][0][0] for s in (0, 1)]
            self.shards = [0, 1]
            self.directory = lambda s: ([b[0] for b in self.blocks[s]], [(k, 0) for k in range(len(self.blocks[s]))])
            self.block = lambda s, k, _: (self.blocks[s][k], [f'{{"file": "{s}", "offset": {k}, "length": {i}}}' for i in range(len(self.blocks[s][k]))])

    keys = [["a", "b", "b"], ["b", "b", "c"], ["c", "c", "c"], ["c", "d", "e"], ["e", "f", "g"], ["h", "h", "i"]]
    index = Fake(keys)
    flat = [k for block in keys for k in block]
    for wanted in "abcdefghijZ":
        assert len(list(index.find(wanted))) == flat.count(wanted), wanted
