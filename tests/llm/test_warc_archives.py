"""Archives as others write them: chains of concurrent-to, several headers, broken files."""

import gzip

import pytest

from quiltgrid.llm import op7_warc as warc


def record(kind, record_id, block=b"", *more):
    head = ["WARC/1.0", f"WARC-Type: {kind}", *([f"WARC-Record-ID: {record_id}"] if record_id else []), *more, f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def after(i):
    return f"WARC-Concurrent-To: {i}"


HTTP = b"HTTP/1.1 200 OK\r\n\r\n"


@pytest.mark.parametrize("packed", ["plain", "one member", "a member each"])
def test_records_of_any_packing(packed):
    records = [record("response", "<r1>", HTTP + b"x" * 3_000_000), record("metadata", "<m1>", b"a: b", after("<r1>"), after("<q1>"), "X-É: \xff"), record("warcinfo", "<w>")]
    data = {"plain": b"".join, "one member": lambda r: gzip.compress(b"".join(r)), "a member each": lambda r: b"".join(map(gzip.compress, r))}[packed](records)
    found = list(warc.parse_warc(data))
    assert [(h["warc-record-id"], len(b), p) for h, b, p in found] == [(["<r1>"], 3_000_019, None), (["<m1>"], 4, None), (["<w>"], 0, None)]
    assert found[1][0]["warc-concurrent-to"] == ["<r1>", "<q1>"]
    assert all(len(piece) <= 1 << 20 for piece in warc.unpacked(data))


def test_broken_archives():
    good, cut = record("response", "<r>", HTTP + b"body"), record("response", "<c>", b"longer block")[:-10]
    ends = lambda data: [p for _, _, p in warc.parse_warc(data)]
    assert ends(good + cut) == [None, "block is cut off"]
    assert ends(good + b"WARC/1.0\r\nWARC-Type: resp") == [None, "headers are cut off"]
    assert ends(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nsome\r\n\r\n" + good) == ["no length", None]
    assert ends(b"WARC/1.0\r\nContent-Length: -4\r\n\r\nsome\r\n\r\n" + good) == ["no length", None]
    assert ends(record("metadata", None, b"x") + good) == ["no record id", None]
    assert ends(good + b"nothing of the kind") == [None, "no record"] and ends(b"") == [] and ends(b"\r\n") == []
    assert ends(gzip.compress(good + good)[:-12])[-1] == "compressed data is broken"
    assert ends(gzip.compress(good) + b"\x1f\x8bnonsense") == [None, "compressed data is broken"]
    assert [h["warc-type"] for h, _, _ in warc.parse_warc(b"WARC/1.0\r\nWARC-Type: \xff\xfe\r\nWARC-Record-ID: <a>\r\nContent-Length: 0\r\n\r\n")] == [["��"]]


def test_captures_of_chains(spark, tmp_path):
    """Request named by the response, metadata that names the response, long chains either way, and what is broken."""
    one = [record("request", "<q1>", b"GET"), record("response", "<r1>", HTTP + b"one", after("<q1>")), record("metadata", "<m1>", b"page-id: 1", after("<r1>"))]
    two = [record("response", "<r2>", HTTP + b"two"), record("request", "<q2>", b"GET", after("<r2>")), record("metadata", "<m2>", b"page-id: 2", after("<r2>"), after("<q2>"))]
    three = [record("response", "<a0>", HTTP), *(record("metadata" if k == 5 else "resource", f"<a{k}>", b"", after(f"<a{k - 1}>")) for k in range(1, 9)), record("request", "<zz>", b"", after("<a8>"))]
    alone = [record("metadata", "<m4>", b"page-id: 4", after("<gone>")), record("response", "<r5>", HTTP)]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"".join([*one, two[2]])))
    (tmp_path / "b.warc").write_bytes(b"".join([*two[:2], *three[::-1], *alone]) + record("response", "<late>", b"0123456789")[:-9])
    records = warc.read_warc(spark, str(tmp_path))
    assert {(r.record_id, r.problem, r.type) for r in records.where("problem is not null").collect()} == {("<late>", "block is cut off", None)}
    found = {r.capture_id: tuple(x and x.record_id for x in (r.request, r.answer, r.metadata)) for r in warc.assemble_transactions(records).collect()}
    assert found == {"<r1>": ("<q1>", "<r1>", "<m1>"), "<r2>": ("<q2>", "<r2>", "<m2>"), "<a0>": ("<zz>", "<a0>", "<a5>"), "<gone>": (None, None, "<m4>"), "<r5>": (None, "<r5>", None)}
