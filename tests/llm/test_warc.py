import gzip
import hashlib

from tracemill.llm import shared, warc

from .common import seeded

SCHEMA = "page_id long, url string, html string, record_type string"
BIG = "<html>" + "ü" * 60 + "\r\n\r\nWARC/1.1\r\n" + "x" * 50


def sample():
    return [(1, "http://a.example/x y\r\nWARC-Type: evil", BIG, "e"), (2, None, BIG, "e"), (3, "http://b.example/", None, "e"), (4, "http://b.example/é", "", "e"),
            (5, "u", "short", "e"), (6, "u", "short", "e"), (7, "u", BIG + "!", "e"), (0, "http://late.example/", BIG, "e"), (8, "u", "z" * 100, "e"), (9, "u", "z" * 100, "e"), (9, "u", "z" * 100, "e")]


def test_round_trip(spark):
    path = shared.new_path(spark, "warc-test")
    warc.write(spark.createDataFrame(sample(), SCHEMA), path, file_bytes=100)
    got = sorted(warc.page_digests(warc.read(spark, path)).collect())
    want = []
    for i, _, html, _ in sample():
        raw = (html or "").encode()
        first = min(p for p, _, h, _ in sample() if (h or "") == (html or ""))
        again = len(raw) >= 100 and i > first
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    assert [tuple(r) for r in got] == sorted(want, key=lambda x: x[:2])
    back = {r.record_id: r for r in warc.read(spark, path, "bytes").filter("record_type = 'response'").collect()}
    assert bytes(back["<urn:page:0>"].payload) == BIG.encode() and bytes(back["<urn:page:3>"].payload) == b""
    assert back["<urn:page:4>"].target_uri == "http://b.example/é" and back["<urn:page:0>"].payload_digest.startswith("sha256:")
    one = warc.read(spark, path).filter("record_id = '<urn:page:1>'").collect()
    assert len(one) == 1 and one[0].target_uri == "http://a.example/x%20y%0D%0AWARC-Type:%20evil" and one[0].record_type == "revisit"


def test_filters_skip_payloads(spark, tmp_path):
    def record(kind, name, body, extra=b""):
        return b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Record-ID: " + name + b"\r\n" + extra + b"Content-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"

    head = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    data = record(b"warcinfo", b"<i>", b"software: x\r\n") + record(b"response", b"<r>", head + b"payload", b"Content-Type: application/http;\r\n msgtype=response\r\nWARC-Target-URI: http://x/\r\n") + record(b"resource", b"<s>", b"plain", b"WARC-Target-URI: http://y/\r\n")
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(data[: len(data) // 1]))
    (tmp_path / "_SUCCESS").write_bytes(b"")
    rows = warc.read(spark, str(tmp_path), "bytes").filter("record_type in ('response', 'resource') and target_uri like 'http://x%'").collect()
    assert [bytes(r.payload) for r in rows] == [b"payload"] * 2 and rows[0].http_head.startswith("HTTP/1.1 200")
    reader = warc.WarcReader({"path": str(tmp_path), "payload": "digest"})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "resource"), warc.EqualTo(("payload_bytes",), 5)]))
    assert [f.attribute for f in left] == [("payload_bytes",)]
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert [b.column("record_id").to_pylist() for b in batches] == [["<s>", "<s>"]]
    read_bytes = []

    class Counting:
        def __init__(self, f):
            self.f = f

        def __getattr__(self, k):
            return getattr(self.f, k)

        def read(self, n):
            read_bytes.append(n)
            return self.f.read(n)

    with open(tmp_path / "a.warc", "rb") as f:
        assert len(list(warc.records_of(Counting(f), reader.wanted, "digest"))) == 1
    assert read_bytes == [5]


def test_unwanted_members_are_not_inflated(spark):
    path = shared.new_path(spark, "warc-test")
    rng = seeded(5)
    noise = "".join(chr(33 + rng.randrange(90)) for _ in range(50_000))
    warc.write(spark.createDataFrame([(1, "u", noise, ""), (2, "u", "short", "")], SCHEMA).coalesce(1), path)
    files = warc._listed(warc.qualified(spark, path))
    assert all(not name.rsplit("/", 1)[1].startswith(".") for name, _ in files)
    sizes = []

    class Counting:
        def __init__(self, f):
            self.f, self.seek = f, f.seek

        def read(self, n):
            sizes.append(len(x := self.f.read(n)))
            return x

    for name, size in files:
        with warc._opened(name) as f:
            got = [x[1]["warc-record-id"] for x in warc.members_of(Counting(f), lambda h: h["warc-record-id"] == "<urn:page:2>", "bytes")]
    assert got == ["<urn:page:2>"] and size > 20_000 and sum(sizes) < 5_000
    assert gzip.decompress(open(files[0][0].removeprefix("file:"), "rb").read()).count(b"WARC/1.1") == 2  # plain gzip to others


def test_attempts_that_fail_leave_nothing(spark, tmp_path):
    import pyarrow as pa

    writer = warc.WarcWriter({"path": f"file:{tmp_path}", "file_bytes": "10"})
    done = writer.write(iter([pa.RecordBatch.from_arrays([pa.array(["a", "b"])], ["value"])]))
    assert warc._listed(f"file:{tmp_path}") == [] and len(done.files) == 2
    writer.abort([done, None])
    assert list(tmp_path.iterdir()) == []


def test_empty(spark):
    path = shared.new_path(spark, "warc-test")
    warc.write(spark.createDataFrame([], SCHEMA), path)
    assert warc.page_digests(warc.read(spark, path)).count() == 0
