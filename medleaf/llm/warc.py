"""WARC archives: writing, reading, and reassembly of segmented records.

Writer: every page is a record of type `response` (an HTTP message with chunked transfer coding) or, if an earlier page has
the same payload, `revisit`, which has the message's headers only and names the payload by its digest. A record whose block is longer than `segment_bytes` is cut: the first segment is a record of
its own, the rest are `continuation` records that name the first one's id, their number and, in the last, the total
length. Archives end at `archive_bytes`, so the segments of a page may lie in several. Every record is a gzip member.

Reader: parses each archive by itself, groups continuations by the id of their origin, orders them by number, checks that
none is missing and that lengths add up, decodes the chunked framing and compares digests. Revisits get the length of
the response that has their digest. Only keys and digests are shuffled for that, and for finding equal payloads, never
payloads.

Broken archives raise nothing: what is wrong with a record stands in `problem`, and reading goes on with the next one. Null
and empty payloads are records without content, payloads of any length are cut into segments, rows that repeat are
records each, an empty table gives an empty table. Columns other than page_id, url and html (or archive and content) are
not looked at, so that none can clash.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medleaf.llm.common import stored, table, utf8

LEAST_DUPLICATE = 100
CHUNK = 4096
_DATE = "2000-01-01T00:00:00Z"  # a fixed date: equal input, equal archives


def http_message(payload: bytes, chunk: int = CHUNK) -> bytes:
    """A response message whose body is the payload in chunks."""
    parts = [b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"]
    for at in range(0, len(payload), chunk):
        piece = payload[at : at + chunk]
        parts += (b"%x\r\n" % len(piece), piece, b"\r\n")
    return b"".join([*parts, b"0\r\n\r\n"])


def http_payload(block: bytes) -> bytes:
    """Body of a message, without its chunked framing; ValueError if a chunk is cut short or the last one is missing."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("message without an end of its headers")
    if not re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head.replace(b"\r\n", b"\n")):
        return body
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk size expected")
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size < 0:
            raise ValueError("chunk size expected")
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        parts.append(body[at : at + size])
        at += size + 2


def record(kind: str, record_id: str, block: bytes, more: dict[str, str]) -> bytes:
    """One record as a gzip member."""
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{record_id}>", "WARC-Date": _DATE, **more, "Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def members(data: bytes) -> Iterator[tuple[bytes, str | None]]:
    """(content, problem) of the gzip members of an archive; an archive that is not compressed is one."""
    if data[:2] != b"\x1f\x8b":
        yield data, None
        return
    while data:
        unpacker = zlib.decompressobj(31)
        try:
            content = unpacker.decompress(data) + unpacker.flush()
            yield content, None if unpacker.eof else "archive cut short"
            data = unpacker.unused_data
        except zlib.error:
            yield b"", "archive damaged"
            at = data.find(b"\x1f\x8b\x08", 1)
            data = data[at:] if at > 0 else b""


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """(fields with lower-case names, block, problem) of every record of an archive."""
    for member, problem in members(data):
        at, found = 0, False
        while (at := member.find(b"WARC/", at)) >= 0:
            found = True
            end = member.find(b"\r\n\r\n", at)
            if end < 0:
                yield {}, b"", problem or "header cut short"
                break
            lines = member[at:end].decode("utf-8", "replace").split("\r\n")[1:]
            fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            at = end + 4
            size = number(fields.get("content-length"))
            if size is None:
                yield fields, b"", "content length missing"
                continue
            block = member[at : at + size]
            at += size
            yield fields, block, None if len(block) == size else problem or "record cut short"
        if problem and not found:
            yield {}, b"", problem


def number(text: str | None, default: int | None = None) -> int | None:
    """A whole number that is not negative; the default for anything else."""
    return int(text) if text and text.isascii() and text.isdigit() and len(text) < 19 else default


def write_archives(pages: DataFrame, segment_bytes: int = 16_384, archive_bytes: int = 1_000_000) -> DataFrame:
    """(archive, content) from pages (page_id, url, html); null html is an empty payload, null ids and urls are left out of
    the headers. Pages that repeat the smallest id of a payload are responses each.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumn("digest", F.sha2("html", 256))
    keys = pages.filter(F.octet_length("html") >= LEAST_DUPLICATE).select("page_id", "digest")
    firsts = keys.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 and refers_to is not null").drop("n")
    again = keys.join(firsts, "digest").filter("page_id is null or page_id <> refers_to").distinct()
    again = stored(again.select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "refers_to"), "again")
    marked = pages.join(again, (pages["digest"] == again["again_digest"]) & pages["page_id"].eqNullSafe(again["again_id"]), "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, size, parts, serial = TaskContext.get().partitionId(), 0, 0, [], 0

        def name_of(n: int) -> str:
            return f"part-{part:06d}-{n:05d}.warc.gz"

        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")]
            for page_id, url, digest, refers_to, html in zip(*columns, utf8(batch, "html"), strict=True):
                serial += 1
                origin = str(uuid.UUID(bytes=hashlib.sha256(f"{part}/{serial}/{page_id}".encode()).digest()[:16]))
                fields = {"WARC-Payload-Digest": f"sha256:{digest}"}
                if url is not None:
                    fields["WARC-Target-URI"] = re.sub(r"[\r\n]", "", url)
                if page_id is not None:
                    fields["X-Page-ID"] = str(page_id)
                if refers_to is not None:
                    fields["X-Refers-To-Page-ID"] = str(refers_to)
                    fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                kind = "response" if refers_to is None else "revisit"
                block = http_message(html) if refers_to is None else http_message(b"").partition(b"\r\n\r\n")[0] + b"\r\n\r\n"
                if len(block) <= segment_bytes:
                    made = [record(kind, origin, block, fields)]
                else:
                    cuts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
                    made = [record(kind, origin, cuts[0], fields | {"WARC-Segment-Number": "1"})]
                    for k, cut in enumerate(cuts[1:], 2):
                        more = {"WARC-Segment-Origin-ID": f"<urn:uuid:{origin}>", "WARC-Segment-Number": str(k)}
                        if k == len(cuts):
                            more["WARC-Segment-Total-Length"] = str(len(block))
                        own = str(uuid.UUID(bytes=hashlib.sha256(f"{origin}/{k}".encode()).digest()[:16]))
                        made.append(record("continuation", own, cut, more))
                for one in made:
                    parts.append(one)
                    size += len(one)
                    if size >= archive_bytes:
                        done.append((name_of(number), b"".join(parts)))
                        number, size, parts = number + 1, 0, []
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in done], pa.string()), pa.array([c for _, c in done], pa.binary())], names=["archive", "content"])
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([name_of(number)]), pa.array([b"".join(parts)], pa.binary())], names=["archive", "content"])

    return marked.select("page_id", "url", "digest", "refers_to", "html").mapInArrow(write, "archive string, content binary")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Whole records of archives (archive, content): (page_id, url, record_type, refers_to, payload, payload_bytes,
    payload_digest, segments, problem). Archives may be files too: spark.read.format("binaryFile"), path renamed to archive.

    problem is null, or says what is wrong: a damaged record, a segment missing, lengths that do not add up, broken framing,
    another digest, a revisit of nothing. A revisit has no payload of its own, but the length and digest of its response's.
    Without payloads, that column is left out.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                rows = []
                for fields, block, problem in parse(content or b""):
                    origin = fields.get("warc-segment-origin-id", fields.get("warc-record-id", ""))
                    segmented = "warc-segment-number" in fields and bool(origin)
                    rows.append((origin, number(fields.get("warc-segment-number", "1"), 0), number(fields.get("warc-segment-total-length"), -1), list(fields.items()), block, segmented, problem))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["origin", "number", "total", "fields", "block", "segmented", "problem"])

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.bool_(), pa.string()]
    records = archives.select("content").mapInArrow(split, "origin string, number long, total long, fields map<string,string>, block binary, segmented boolean, problem string")
    records = stored(records, "records")
    one = F.struct("number", "block", "total", "fields", "problem")
    alone = records.filter("not segmented").select(F.array(one).alias("parts"))
    joined = records.filter("segmented").groupBy("origin").agg(F.array_sort(F.collect_list(one), lambda a, b: F.signum(a["number"] - b["number"]).cast("int")).alias("parts")).select("parts")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for parts in batch.column("parts").to_pylist():
                fields = dict(parts[0]["fields"])
                kind, payload, digest = fields.get("warc-type"), None, None
                block, problem = b"".join(p["block"] for p in parts), next((p["problem"] for p in parts if p["problem"]), None)
                said = fields.get("warc-payload-digest", "").removeprefix("sha256:")
                if problem:
                    pass
                elif [p["number"] for p in parts] != list(range(1, len(parts) + 1)):
                    problem = "segment missing"
                elif len(parts) > 1 and parts[-1]["total"] != len(block) or len(parts) == 1 and "warc-segment-number" in fields:
                    problem = "length differs from total"
                elif kind == "revisit":
                    digest = said or None
                else:
                    try:
                        payload = http_payload(block)
                    except ValueError as e:
                        problem = str(e)
                if payload is not None:
                    digest = hashlib.sha256(payload).hexdigest()
                    problem = None if said in ("", digest) else "digest differs"
                own = (fields.get("warc-target-uri"), kind, page_number(fields.get("x-refers-to-page-id")))
                shown = (payload,) if payloads else ()
                rows.append((page_number(fields.get("x-page-id")), *own, *shown, None if payload is None else len(payload), digest, len(parts), problem))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), shape, strict=True)], names=names)

    names = ["page_id", "url", "record_type", "refers_to", *(["payload"] if payloads else []), "payload_bytes", "payload_digest", "segments", "problem"]
    shape = [pa.int64(), pa.string(), pa.string(), pa.int64(), *([pa.binary()] if payloads else []), pa.int64(), pa.string(), pa.int32(), pa.string()]
    content = "payload binary, " if payloads else ""
    found = alone.union(joined).mapInArrow(whole, f"page_id long, url string, record_type string, refers_to long, {content}payload_bytes long, payload_digest string, segments int, problem string")
    if not payloads:
        found = stored(found, "found")
    revisit = F.coalesce(F.col("record_type") == "revisit", F.lit(False))
    # responses that are revisited, one row for each digest
    wanted = found.filter(revisit).select("payload_digest").distinct()
    lengths = found.filter(~revisit & F.col("problem").isNull()).join(wanted, "payload_digest", "left_semi").groupBy("payload_digest").agg(F.max("payload_bytes").alias("__bytes"))
    again = found.filter(revisit).join(lengths, "payload_digest", "left").withColumn("payload_bytes", F.col("__bytes"))
    again = again.withColumn("problem", F.coalesce("problem", F.when(F.col("__bytes").isNull(), F.lit("revisit of nothing"))))
    return found.filter(~revisit).unionByName(again.drop("__bytes"))


def page_number(text: str | None) -> int | None:
    """A page's id, which may be negative."""
    found = number((text or "").removeprefix("-"))
    return found if found is None or not text.startswith("-") else -found


def op8_segment_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    archives = stored(write_archives(table(spark, sf_dir, "pages")), "archives")
    return read_archives(archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "segments", "problem")


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     d AS (SELECT page_id, strlen(h) AS n, sha256(h) AS s FROM p),
     f AS (SELECT s, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY s)
SELECT d.page_id, d.n::BIGINT AS payload_bytes, d.s AS payload_digest,
       CASE WHEN f.first IS NOT NULL AND f.first <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> d.page_id THEN f.first END AS refers_to,
       CASE WHEN m <= 16384 OR f.first <> d.page_id THEN 1 ELSE ceil(m / 16384.0) END::INTEGER AS segments,
       NULL::VARCHAR AS problem
FROM (SELECT *, 89 + 5 + n + (n // 4096) * 8 + CASE WHEN n % 4096 = 0 THEN 0 ELSE length(printf('%x', n % 4096)) + 4 END AS m FROM d) d
LEFT JOIN f ON d.s = f.s
"""
