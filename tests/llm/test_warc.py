import gzip
import hashlib
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from streetpulse.llm import warc
from streetpulse.session import scratch_path


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def brute(rows):
    sized = [(p, (h or "").encode()) for p, _, h in rows]
    keep = {}
    for p, b in sized:
        if len(b) >= 1000 and p is not None:
            keep[b] = max(p, keep.get(b, p))
    out = []
    for p, b in sized:
        to = keep.get(b)
        revisit = to is not None and (p is None or p < to)
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()),
                  key=repr)


BIG = "é€😀<p>x</p>\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n" * 900
ROWS = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, BIG), (3, None, BIG), (None, "http://a/4", BIG),
        (None, None, None), (None, None, "y" * 5000), (5, "http://a/ \r\n5", "x" * 999), (6, "u", "x" * 999),
        (7, "u", ""), (8, "u", None), (9, "u", "z" * 8192), (9, "u", "z" * 8192), (10, "v", "\x00\x01\r\n0\r\n\r\n")]


def test_round_trip_equals_brute_force(spark):
    got = warc.warc_roundtrip(spark, pages(spark, ROWS), payloads=True)
    assert result(got) == brute(ROWS)
    assert all(r.complete for r in got.collect())
    assert max(r.segments for r in got.collect()) > 5
    sent = {hashlib.sha1((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in ROWS}
    for r in got.where("record_type = 'response'").collect():
        assert bytes(r.payload) == sent[r.payload_digest]


@pytest.mark.parametrize("segment, chunk", [(64, 7), (1000, 1000), (1 << 20, 3)])
def test_any_segment_and_chunk_size(spark, segment, chunk):
    rows = [(i, "u", "añb" * (i * 37)) for i in range(6)]
    got = warc.warc_roundtrip(spark, pages(spark, rows), segment_bytes=segment, chunk_bytes=chunk, archive_bytes=2000)
    assert result(got) == brute(rows)


def test_empty_table(spark):
    assert warc.warc_roundtrip(spark, pages(spark, [])).count() == 0


def test_extra_columns_do_not_clash(spark):
    df = pages(spark, ROWS[:2]).selectExpr("*", "'a' AS digest", "1 AS n", "2 AS salt", "3 AS keep", "4 AS segment")
    assert result(warc.warc_roundtrip(spark, df)) == brute(ROWS[:2])


def record(kind, rid, block, **more):
    head = {"WARC-Type": kind, "WARC-Record-ID": rid, **more, "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def read(spark, tmp_path, data):
    (tmp_path / "a.warc.gz").write_bytes(data)
    return warc.read_archives(spark, f"file://{tmp_path}").collect()


HTTP = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4\r\nWiki\r\n5;x=1\r\npedia\r\n0\r\n\r\n"


def segments(total, numbers=(1, 2, 3)):
    cut = {1: HTTP[:20], 2: HTTP[20:60], 3: HTTP[60:]}
    out = []
    for n in numbers:
        more = {"WARC-Segment-Number": n}
        if n > 1:
            more["WARC-Segment-Origin-ID"] = "<urn:x>"
        if n == 3:
            more["WARC-Segment-Total-Length"] = total
        out.append(record("response" if n == 1 else "continuation", "<urn:x>" if n == 1 else f"<urn:x{n}>", cut[n], **more))
    return out


def test_segments_in_any_order_and_gzip_members(spark, tmp_path):
    one, two, three = segments(len(HTTP))
    rows = read(spark, tmp_path, gzip.compress(three) + gzip.compress(one) + gzip.compress(two))
    assert [(r.payload, r.complete, r.segments) for r in rows] == [(b"Wikipedia", True, 3)]


@pytest.mark.parametrize("data", [b"".join(segments(len(HTTP) + 1)), b"".join(segments(len(HTTP), (1, 3))),
                                  b"".join(segments(len(HTTP), (1, 2))), b"".join(segments(len(HTTP)))[:-25]])
def test_gaps_wrong_totals_and_cut_files_are_incomplete(spark, tmp_path, data):
    rows = read(spark, tmp_path, data)
    assert len(rows) == 1 and not rows[0].complete and rows[0].payload is None


def test_broken_chunks():
    assert warc.decode_chunked(b"4\r\nWik") is None
    assert warc.decode_chunked(b"zz\r\nWiki\r\n0\r\n\r\n") is None
    assert warc.decode_chunked(b"4\r\nWiki\r\n") is None
    assert warc.decode_chunked(b"0\r\n\r\n") == b""


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40), max_size=8))
def test_chunks_join(parts):
    framed = b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"
    assert warc.decode_chunked(framed) == b"".join(parts)


def test_archives_parse_without_spark(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark, pages(spark, ROWS), path)
    blocks = []
    for r in spark.read.format("binaryFile").load(path).collect():
        blocks += list(warc.parse_records(io.BytesIO(gzip.decompress(r.content))))
    assert all(len(b) == int(h["content-length"]) <= 8192 for h, b in blocks)
    assert {h["warc-type"] for h, _ in blocks} == {"response", "revisit", "continuation"}
