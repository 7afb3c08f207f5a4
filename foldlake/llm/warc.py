"""WARC archives: writing with revisit records and segments, and reading with segment reassembly.

A record whose block is longer than SEGMENT_BYTES is written as a first segment and continuation records. The reader
groups segments by their origin identifier, orders them by segment number, verifies the total length, decodes the
chunked transfer framing of the HTTP message and verifies the payload digest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlake.llm import common

SEGMENT_BYTES = 65_536
CHUNK_BYTES = 8_192
#: Payloads of at least so many bytes are written once and revisited.
REVISIT_BYTES = 0
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """payload in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; raises ValueError if the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk size is missing")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut off")
        parts.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP response message."""
    head, split, body = block.partition(b"\r\n\r\n")
    if not split:
        raise ValueError("the HTTP header does not end")
    return unchunked(body) if re.search(rb"^transfer-encoding:.*\bchunked", head, re.I | re.M) else body


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def one_line(text: str | None) -> str:
    """Text for a header field: line breaks and percent signs are percent-encoded."""
    return re.sub(r"[%\r\n]", lambda m: f"%{ord(m[0]):02X}", text or "")


def record(fields: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return b"".join((b"WARC/1.1\r\n", head.encode(), b"Content-Length: %d\r\n\r\n" % len(block), block, b"\r\n\r\n"))


def records(page: int | None, url: str | None, payload: bytes, keeper: int | None, segment: int = SEGMENT_BYTES) -> list[bytes]:
    """The records of one page: a response with its continuations, or a revisit of page keeper."""
    name = "" if page is None else str(page)
    sha = digest(payload)
    fields = {"WARC-Record-ID": f"<urn:page:{name}:{sha}>", "WARC-Date": DATE, "WARC-Target-URI": one_line(url)}
    fields |= {"WARC-Payload-Digest": f"sha1:{sha}", "Content-Type": "application/http; msgtype=response"}
    if page != keeper:
        refers = {"WARC-Refers-To": f"<urn:page:{keeper}:{sha}>", "WARC-Profile": REVISIT_PROFILE, "WARC-Payload-Length": str(len(payload))}
        return [record({"WARC-Type": "revisit"} | fields | refers, _HTTP[: _HTTP.index(b"Transfer")] + b"\r\n")]
    block = _HTTP + chunked(payload)
    if len(block) <= segment:
        return [record({"WARC-Type": "response"} | fields, block)]
    out = [record({"WARC-Type": "response"} | fields | {"WARC-Segment-Number": "1"}, block[:segment])]
    for number, at in enumerate(range(segment, len(block), segment), 2):
        more = {"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:page:{name}:{sha}:{number}>", "WARC-Date": DATE}
        more |= {"WARC-Segment-Origin-ID": fields["WARC-Record-ID"], "WARC-Segment-Number": str(number)}
        if at + segment >= len(block):
            more["WARC-Segment-Total-Length"] = str(len(block))
        out.append(record(more, block[at : at + segment]))
    return out


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record begins here")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            key, _, value = line.decode().partition(":")
            fields[key.lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("a record is cut off")
        yield fields, block


def _page(uri: str) -> int | None:
    got = re.match(r"<urn:page:(-?\d*):", uri)
    if got is None:
        raise ValueError(f"not an identifier of these archives: {uri}")
    return int(got[1]) if got[1] else None


def write(pages: DataFrame, out: str, revisit_bytes: int = REVISIT_BYTES, segment: int = SEGMENT_BYTES) -> DataFrame:
    """Writes every row of pages (page_id, url, html) as a record to gzipped archives below out; returns path, records.

    The payload is the html in UTF-8, a null html counts as empty. Of the records with equal payloads of at least
    revisit_bytes, the one with the largest page_id is a response and the others revisit it; if a row with that page_id
    is repeated, each of them is a response. Rows without page_id revisit too, unless no row of the group has one.
    """
    common.small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long"), "url", common.text_or_empty("html").cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    large = F.length("payload") >= revisit_bytes
    keepers = rows.where(large).groupBy("sha").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    keepers = keepers.where("n > 1").select(F.col("sha").alias("k_sha"), "keeper", F.lit(True).alias("shared"))
    rows = rows.join(keepers, F.col("sha") == F.col("k_sha"), "left")
    keeper = F.when(F.col("shared"), F.col("keeper")).otherwise(F.col("page_id"))
    rows = rows.select("page_id", "url", "payload", keeper.alias("keeper"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        path, n = f"{out}/{TaskContext.get().partitionId():06d}-{uuid4().hex}.warc.gz", 0

        def rest():
            yield first
            yield from batches

        with common.writing(path) as file:
            for batch in rest():
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for one in records(*row, segment=segment):
                        member = zlib.compressobj(1, zlib.DEFLATED, 31)
                        file.write(member.compress(one) + member.flush())
                    n += 1
        yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]})

    return common.materialize(rows.mapInArrow(archive, "path string, records long"), "warc-manifest")


_SCAN = pa.schema(
    [("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("sha", pa.string()), ("block", pa.binary())]
    + [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def _verified(block: bytes, sha: str) -> int:
    payload = http_payload(block)
    if digest(payload) != sha:
        raise ValueError("a payload differs from its digest")
    return len(payload)


def scan(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """A row for each record of the archives: records in one piece are decoded here, segments keep their block."""
    jobs = manifest.select("path").repartition(max(1, min(manifest.count(), 100_000)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                rows, held = [], 0
                with common.reading(path) as file, gzip.GzipFile(fileobj=file) as plain:
                    for fields, block in parse(io.BufferedReader(plain, 1 << 18)):
                        kind, number = fields["warc-type"], int(fields.get("warc-segment-number", 0))
                        total = fields.get("warc-segment-total-length")
                        sha = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        row = [None, number, int(total) if total else None, sha, None, None, None, kind, None]
                        if number:
                            row[0] = fields.get("warc-segment-origin-id", fields["warc-record-id"])
                            row[4] = block
                            held += len(block)
                        else:
                            row[5] = _page(fields["warc-record-id"])
                            if kind == "revisit":
                                row[6], row[8] = int(fields["warc-payload-length"]), _page(fields["warc-refers-to"])
                            else:
                                row[6] = _verified(block, sha)
                        rows.append(row)
                        if held > 4_000_000 or len(rows) >= 5_000:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return jobs.mapInArrow(read, _ddl(_SCAN))


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _SCAN, strict=True)], schema=_SCAN)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def reassemble(segments: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest for each segmented record.

    Segments of one origin meet in one row, which is one record's block and no more; a record that was written twice
    (a repeated row) has each segment twice and gives two results. Missing segments or a wrong length raise ValueError.
    """
    piece = F.struct("number", "total", "sha", "block")
    groups = segments.groupBy("origin").agg(
        F.array_sort(F.collect_set(piece)).alias("pieces"), F.sum(F.when(F.col("number") == 1, 1).otherwise(0)).alias("copies")
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                pieces = row["pieces"]
                block = b"".join(p["block"] for p in pieces)
                if [p["number"] for p in pieces] != list(range(1, len(pieces) + 1)) or pieces[-1]["total"] != len(block):
                    raise ValueError(f"segments of {row['origin']} are missing")
                sha = pieces[0]["sha"]
                out += [(_page(row["origin"]), _verified(block, sha), sha)] * row["copies"]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string()))],
                    names=["page_id", "payload_bytes", "payload_digest"],
                )

    return groups.mapInArrow(joined, "page_id long, payload_bytes long, payload_digest string")


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to for each page of the archives."""
    found = common.materialize(scan(spark, manifest), "warc-scan")
    columns = ["page_id", "payload_bytes", F.col("sha").alias("payload_digest"), "record_type", "refers_to"]
    whole = found.where("number = 0").select(*columns)
    parts = reassemble(found.where("number > 0").select("origin", "number", "total", "sha", "block"))
    return whole.unionByName(parts.select("*", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")))


def op6_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each page, read back from the archives; write() says what odd rows give."""
    return read(spark, write(common.table(spark, sf_dir, "pages"), common.work_path(spark, "warc")))
