"""WARC archives with segmented records.

Writing: every payload becomes an HTTP response in chunked transfer framing.
A block longer than ``segment_bytes`` is cut into a first record (segment 1)
and ``continuation`` records that name the first one as their origin; the last
one gives the total length. Of records with equal payloads of at least
``revisit_bytes`` one stays a response, the others become ``revisit`` records
without payload. Archives are written by Spark's text sink (record separator
included in the record), gzip-compressed, with its commit protocol.

Reading: each archive is parsed record by record by ``Content-Length``.
Segments are grouped by origin, ordered by segment number, checked for gaps and
against the total length, joined, and the chunked framing is decoded.

Defined cases: null or empty html is an empty payload; a null url leaves the
target header out; a null page_id leaves the page header out, and such rows are
revisits only of pages that have an id; repeated rows of one page are equally
responses (or revisits) and come back as often as written; an incomplete or
broken record comes back with ``complete`` false and no payload.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetpulse.llm.tables import stored
from streetpulse.session import scratch_path

CRLF = "\r\n"
SALTS = 32
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
HTTP_HEAD_EMPTY = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "2024-01-01T00:00:00Z"
PARSED = ("kind string, record_id string, page_id long, refers_id string, origin_id string, segment long, "
          "total long, digest string, n_bytes long, complete boolean, data binary")


def _chunked(body: Column, n: Column, size: int) -> Column:
    """HTTP/1.1 chunked framing of a binary column, as raw text."""
    def chunk(i: Column) -> Column:
        part = F.substring(body, (i * size + 1).cast("int"), F.lit(size))
        return F.concat(F.lower(F.hex(F.octet_length(part).cast("long"))), F.lit(CRLF),
                        part.cast("string"), F.lit(CRLF))
    count = F.ceil(n / F.lit(size)).cast("int")
    parts = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), chunk)) \
        .otherwise(F.array().cast("array<string>"))
    return F.concat(F.array_join(parts, ""), F.lit("0\r\n\r\n"))


def write_archives(spark: SparkSession, pages: DataFrame, path: str, segment_bytes: int = 8192,
                   chunk_bytes: int = 2048, revisit_bytes: int = 1000, archive_bytes: int = 32 << 20) -> None:
    """Write (page_id, url, html) rows as WARC records to ``path``. Payloads
    are dealt by digest and a salt of the page id, so copies of one payload
    spread over ``SALTS`` tasks and an archive file holds about
    ``archive_bytes`` of payload (the number of files follows the volume)."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("body")).select(
        "page_id", "url", "body", F.octet_length("body").cast("long").alias("n"), F.sha1("body").alias("digest"))
    groups = stored(rows.groupBy("digest", "n").agg(
        F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("copies")), "warc-digests")
    volume = groups.agg(F.sum(F.col("n") * F.col("copies"))).first()[0] or 0
    files = max(1, -(-volume // archive_bytes))
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    kept = (groups.where((F.col("copies") > 1) & (F.col("n") >= revisit_bytes) & F.col("keep").isNotNull())
            .select("digest", "keep", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
            .repartition(files, "digest", "salt"))
    dealt = rows.withColumn("salt", salt).repartition(files, "digest", "salt").join(kept, ["digest", "salt"], "left")

    def urn(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(":"),
                        F.col("digest"), F.lit(">"))
    revisit = F.col("keep").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("keep")))
    block = F.when(revisit, F.lit(HTTP_HEAD_EMPTY)).otherwise(
        F.concat(F.lit(HTTP_HEAD), _chunked(F.col("body"), F.col("n"), chunk_bytes)))
    records = dealt.select(
        "page_id", "digest", "keep", "url", revisit.alias("revisit"), urn(F.col("page_id")).alias("urn"),
        urn(F.col("keep")).alias("kept_urn"), block.cast("binary").alias("block"))
    records = records.withColumn("total", F.octet_length("block").cast("long")).withColumn(
        "segments", F.greatest(F.ceil(F.col("total") / segment_bytes).cast("int"), F.lit(1)))
    records = records.select("*", F.explode(F.sequence(F.lit(1), F.col("segments"))).alias("segment")).withColumn(
        "part", F.substring(F.col("block"), ((F.col("segment") - 1) * segment_bytes + 1).cast("int"),
                            F.lit(segment_bytes)))
    first, segmented = F.col("segment") == 1, F.col("segments") > 1

    def line(name: str, value: Column, on: Column) -> Column:
        return F.when(on & value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))) \
            .otherwise(F.lit(""))
    safe_url = F.regexp_replace("url", "[\\x00-\\x20\\x7F]", "%20")
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(~first, F.lit("continuation")).when(F.col("revisit"), F.lit("revisit"))
             .otherwise(F.lit("response")), F.lit(True)),
        line("WARC-Record-ID", F.when(first, F.col("urn")).otherwise(
            F.concat(F.expr("substring(urn, 1, char_length(urn) - 1)"), F.lit(":"), F.col("segment"), F.lit(">"))),
            F.lit(True)),
        line("WARC-Date", F.lit(WARC_DATE), F.lit(True)),
        line("WARC-Target-URI", safe_url, F.lit(True)),
        line("X-Page-ID", F.col("page_id"), first),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")), first),
        line("WARC-Profile", F.lit(REVISIT_PROFILE), F.col("revisit")),
        line("WARC-Refers-To", F.col("kept_urn"), F.col("revisit")),
        line("WARC-Segment-Number", F.col("segment"), segmented),
        line("WARC-Segment-Origin-ID", F.col("urn"), ~first),
        line("WARC-Segment-Total-Length", F.col("total"), segmented & (F.col("segment") == F.col("segments"))),
        line("Content-Type", F.lit("application/http; msgtype=response"), first),
        line("Content-Length", F.octet_length("part"), F.lit(True)),
        F.lit(CRLF))
    value = F.concat(head, F.col("part").cast("string"), F.lit("\r\n\r"))  # the sink adds the last \n
    records.select(value.alias("value")).write.option("compression", "gzip").option("lineSep", "\n").text(path)


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict, bytes]]:
    """(headers with lower-case names, block) of each record; a record cut off
    by the end of the file has a block shorter than its content-length."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue  # the empty lines between records
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(max(0, _number(headers.get("content-length")) or 0))


def decode_chunked(framed: bytes) -> bytes | None:
    """Payload of a chunked body; None when the framing is broken."""
    out, at = [], 0
    while (end := framed.find(b"\r\n", at)) >= 0:
        try:
            size = int(framed[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        if size == 0:
            return b"".join(out)
        part = framed[end + 2:end + 2 + size]
        if len(part) != size or framed[end + 2 + size:end + 4 + size] != b"\r\n":
            return None
        out.append(part)
        at = end + 4 + size
    return None


def http_payload(block: bytes) -> bytes | None:
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None
    coded = any(x.strip().lower() == b"transfer-encoding: chunked" for x in head.split(b"\r\n"))
    return decode_chunked(body) if coded else body


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


def _parsed_rows(content: bytes, segments: bool, payloads: bool) -> Iterator[tuple]:
    raw = io.BytesIO(content)
    stream = gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw
    for h, block in parse_records(io.BufferedReader(stream)):
        kind, is_segment = h.get("warc-type"), "warc-segment-number" in h
        if kind not in ("response", "revisit", "continuation") or is_segment != segments:
            continue
        whole = len(block) == _number(h.get("content-length"))
        said = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
        base = (kind, h.get("warc-record-id"), _number(h.get("x-page-id")), h.get("warc-refers-to"))
        if is_segment:
            yield (*base, h.get("warc-segment-origin-id", h.get("warc-record-id")),
                   _number(h["warc-segment-number"]), _number(h.get("warc-segment-total-length")), said,
                   len(block), whole, block)
        elif kind == "revisit":
            yield (*base, None, None, None, said, None, whole, None)
        else:
            payload = http_payload(block) if whole else None
            yield (*base, None, None, None, *_checked(payload, said), payload if payloads else None)


def _checked(payload: bytes | None, said: str | None) -> tuple[str | None, int | None, bool]:
    if payload is None:
        return said, None, False
    digest = hashlib.sha1(payload).hexdigest()
    return digest, len(payload), said in (None, digest)


def _parser(segments: bool, payloads: bool):
    names = [x.split()[0] for x in PARSED.split(", ")]

    def parse(batches):
        for pdf in batches:
            rows, held = [], 0
            for content in pdf["content"]:
                for row in _parsed_rows(content, segments, payloads):
                    rows.append(row)
                    held += len(row[-1] or b"") + 200
                    if held > 16 << 20:
                        yield _frame(rows, names)
                        rows, held = [], 0
            if rows:
                yield _frame(rows, names)
    return parse


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    for c in ("page_id", "segment", "total", "n_bytes"):
        out[c] = pd.array(out[c].tolist(), dtype="Int64")
    return out


def _decoder(payloads: bool):
    def decode(batches):
        for pdf in batches:
            got = [http_payload(bytes(b)) if ok else None for b, ok in zip(pdf["data"], pdf["complete"])]
            checked = [_checked(p, s) for p, s in zip(got, pdf["digest"])]
            yield pdf.assign(digest=[c[0] for c in checked],
                             n_bytes=pd.array([c[1] for c in checked], dtype="Int64"),
                             complete=[c[2] for c in checked],
                             data=[p if payloads else None for p in got])
    return decode


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record written to ``path``: page_id, payload_bytes,
    payload_digest, record_type, refers_to, segments, complete and, if asked
    for, the payload. Only segmented records are shuffled (by origin); a
    revisit finds its response by record id."""
    files = spark.read.format("binaryFile").load(path).select("content")
    single = files.mapInPandas(_parser(False, payloads), PARSED)
    pieces = files.mapInPandas(_parser(True, payloads), PARSED)
    # Equal rows written twice give equal segments twice: kept once, counted.
    joined = pieces.groupBy("origin_id").agg(
        F.max(F.when(F.col("segment") == 1, F.col("page_id"))).alias("page_id"),
        F.max(F.when(F.col("segment") == 1, F.col("digest"))).alias("digest"),
        F.max("total").alias("total"), F.max("segment").alias("segment"), F.min("complete").alias("complete"),
        F.count_if(F.col("segment") == 1).alias("times"),
        F.sort_array(F.collect_set(F.struct("segment", F.col("data").cast("string").alias("part")))).alias("parts"))
    joined = joined.withColumn("data", F.array_join(F.col("parts.part"), "").cast("binary"))
    # One part for each number from 1 to the last, and the stated total length.
    sound = (F.col("complete") & F.col("total").isNotNull() & (F.size("parts") == F.col("segment"))
             & (F.octet_length("data") == F.col("total")))
    joined = joined.select(
        F.lit("response").alias("kind"), F.col("origin_id").alias("record_id"), "page_id",
        F.lit(None).cast("string").alias("refers_id"), "origin_id", "segment", "total", "digest",
        F.lit(None).cast("long").alias("n_bytes"), F.coalesce(sound, F.lit(False)).alias("complete"), "data", "times")
    # Each as often as it was written.
    again = F.explode(F.sequence(F.lit(1), F.greatest(F.col("times"), F.lit(1)).cast("int")))
    rebuilt = joined.withColumn("again", again).drop("times", "again").mapInPandas(_decoder(payloads), PARSED)
    responses = single.where("kind = 'response'").unionByName(rebuilt)
    revisits = single.where("kind = 'revisit'")
    targets = responses.groupBy("record_id").agg(F.max("page_id").alias("target"), F.max("n_bytes").alias("bytes"),
                                                 F.max("digest").alias("held"))
    found = revisits.join(targets.withColumnRenamed("record_id", "refers_id"), "refers_id", "left")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "segments", "complete"]
    own = responses.select(
        "page_id", F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"), F.lit(None).cast("long").alias("refers_to"),
        F.coalesce("segment", F.lit(1).cast("long")).alias("segments"), "complete", F.col("data").alias("payload"))
    other = found.select(
        "page_id", F.when(F.col("held") == F.col("digest"), F.col("bytes")).alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), F.col("target").alias("refers_to"),
        F.lit(1).cast("long").alias("segments"),
        F.coalesce(F.col("complete") & (F.col("held") == F.col("digest")), F.lit(False)).alias("complete"),
        F.lit(None).cast("binary").alias("payload"))
    return own.unionByName(other).select(*out, *(["payload"] if payloads else []))


def warc_roundtrip(spark: SparkSession, pages: DataFrame, payloads: bool = False, **options) -> DataFrame:
    """Write ``pages`` to a fresh archive folder and read it back."""
    path = scratch_path(spark, "warc")
    write_archives(spark, pages, path, **options)
    return read_archives(spark, path, payloads)


# The same rows in SQL. A segment holds 8192 bytes of the framed block: the
# HTTP head, per chunk of 2048 bytes its size in hex and two line ends, the end.
WARC_SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha1(coalesce(html, '')) AS digest
  FROM pages),
g AS (SELECT digest, max(page_id) AS keep FROM p WHERE n >= 1000 GROUP BY digest HAVING count(*) > 1),
r AS (
  SELECT p.*, CASE WHEN p.page_id IS NULL OR p.page_id < g.keep THEN g.keep END AS refers_to,
         {len(HTTP_HEAD)} + n + (n // 2048) * 7
         + CASE WHEN n % 2048 > 0 THEN 4 + length(to_hex(n % 2048)) ELSE 0 END + 5 AS block
  FROM p LEFT JOIN g USING (digest))
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to,
       CASE WHEN refers_to IS NULL THEN (block + 8191) // 8192 ELSE 1 END::BIGINT AS segments, true AS complete
FROM r
"""
