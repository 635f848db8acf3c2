import gzip
import hashlib

from sparcel.llm import warc

SCHEMA = "page_id long, url string, html string, payload_bytes string"


def expected(rows):
    top = {}
    for i, _, h, _ in rows:
        b = (h or "").encode()
        if len(b) >= 1000:
            top[b] = max(top.get(b, -1), -1 if i is None else i)
    out = []
    for i, _, h, _ in rows:
        b = (h or "").encode()
        revisit = len(b) >= 1000 and top[b] != (-1 if i is None else i)
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", top[b] if revisit else None))
    return sorted(out, key=repr)


def pages():
    tricky = "WARC/1.1\r\nWARC-Type: response\r\n\r\nContent-Length: 3\r\n\r\n\r\n\r\nWARC/1.1\r\n" + "x" * 1000 + "\r\n\r\n\r\n\r\n"
    rows = [
        (1, "http://a.example/x?y=1#z", "short"), (2, "http://a.example/", "short"), (3, None, "é" * 600), (4, "http://b.example", "é" * 600),
        (5, "bad\r\nurl: 1", tricky), (9, "", tricky), (7, "http://c.example", None), (8, "http://c.example", ""), (None, "http://d.example", "q" * 2000),
        (10, "http://d.example", "q" * 2000), (None, None, "only null" * 200), (None, None, "only null" * 200), (11, "u", "long " * 200_000),
        (12, "u", "WARC/1.1\r\n"), (12, "u", "WARC/1.1\r\n"), (13, "u", "z" * 999), (14, "u", "z" * 999), (10, "http://d.example", "q" * 2000),
    ]
    return [(*r, "x") for r in rows]


def test_round_trip(spark, tmp_path):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    path = str(tmp_path / "warc")
    warc.write_archives(warc.archive_records(df), path)
    records = warc.read_archives(spark, path)
    assert records.count() == 3 * len(rows)
    assert records.where("not whole").count() == 0
    captures = warc.assemble(records)
    assert sorted(map(tuple, warc.page_captures(captures).collect()), key=repr) == expected(rows)
    one = captures.where("response.target_uri = 'http://a.example/x?y=1#z'").collect()
    assert len(one) == 1 and bytes(one[0].response.payload) == b"short"
    assert bytes(one[0].requests[0].payload) == b"" and len(one[0].metadata) == 1
    assert all(r.stated_digest == "sha1:" + r.payload_digest for r in records.where("type = 'response'").collect())


def test_other_archives(spark, tmp_path):
    def record(kind, rid, extra="", block=b"", content="application/http"):
        head = f"WARC/1.1\r\nwarc-type: {kind}\r\nWARC-Record-ID: {rid}\r\n{extra}Content-Type: {content}\r\nContent-Length: {len(block)}\r\n\r\n"
        return head.encode() + block + b"\r\n\r\n"

    data = record("warcinfo", "<i>", block=b"software: x\r\n", content="application/warc-fields")
    data += record("response", "<r1>", "WARC-Concurrent-To: <q1>\r\n", b"HTTP/1.0 200 OK\r\n\r\n\xff\x00binary")
    data += record("request", "<q1>", block=b"GET / HTTP/1.0\r\n\r\n")
    data += record("metadata", "<m2>", "WARC-Concurrent-To: <r2>\r\n", b"a: b\r\n", "application/warc-fields")
    data += record("response", "<r3>", block=b"HTTP/1.0 200 OK\r\n\r\ncut off here")[:-10]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(data[:200]) + gzip.compress(data[200:]))
    records = warc.read_archives(spark, str(tmp_path))
    assert {r.record_id: r.whole for r in records.collect()} == {"<i>": True, "<r1>": True, "<q1>": True, "<m2>": True, "<r3>": False}
    captures = {r.capture_id: r for r in warc.assemble(records).collect()}
    assert set(captures) == {"<r1>", "<r2>", "<r3>"}
    assert bytes(captures["<r1>"].response.payload) == b"\xff\x00binary"
    assert [q.record_id for q in captures["<r1>"].requests] == ["<q1>"]
    assert captures["<r2>"].response is None and captures["<r2>"].metadata[0].fields == "a: b\r\n"


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    path = str(tmp_path / "none")
    warc.write_archives(warc.archive_records(df), path)
    assert warc.page_captures(warc.assemble(warc.read_archives(spark, path))).count() == 0
