"""WARC archives, and the converter from legacy ARC.

A page becomes a legacy ARC record (version 1 has five header fields, version 2 ten; the first record of a
file says which). The converter parses the header line by its version, takes the block by its declared
length, and synthesises what WARC wants and ARC lacks: a record identifier, an ISO timestamp, a record type
and a payload digest. Of pages with equal payloads of at least ``MIN_BYTES``, the one with the largest id is
a response and the others revisit it. Archives are written by Spark's text sink, whose line separator is the
end of a WARC record, and read back with ``binaryFile``: each part holds records of ``PART_BYTES`` (and one more of any
length) and is parsed as a stream by the declared lengths. Every record has an identifier of its own.

Defined cases: a null html is an empty payload, a null url an empty one; a null page_id is kept as such and
never becomes the response of a group that has another; repeated page_ids with equal payloads are all
written, the largest page_id's rows as responses; an empty table gives empty archives and no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.llm.common import read, slices, stored
from brightledger.sources.scratch import shared_folder

MIN_BYTES = 1000
PART_BYTES = 64_000_000
CRLF = "\r\n"
END = CRLF + CRLF
#: Header fields of the two ARC versions (fixed values of the format).
ARC_FIELDS = {
    "1": ("url", "ip", "date", "mime", "length"),
    "2": ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


# --- identifiers: a page_id and the number of its row travel in the free bits of a version 8 UUID, so a reader gets the page back


def record_id(page_id: int | None, serial: int = 0) -> str:
    """``serial`` has 57 bits: 2 ** 24 tasks of 2 ** 33 rows, as Spark numbers rows."""
    bits = 0 if page_id is None else page_id & (2**64 - 1)
    value = (bits >> 32 << 80) | (8 << 76) | (int(page_id is None) << 64) | (2 << 62) | (bits & (2**32 - 1))
    value |= (serial & (2**30 - 1)) << 32 | (serial >> 30 & 0x7FF) << 65 | (serial >> 41 & 0xFFFF) << 112
    return f"<urn:uuid:{uuid.UUID(int=value)}>"


def page_of(identifier: str) -> int | None:
    value = uuid.UUID(identifier.strip("<>").rpartition(":")[2]).int
    if value >> 64 & 1:
        return None
    bits = (value >> 80 & (2**32 - 1)) << 32 | value & (2**32 - 1)
    return bits - 2**64 if bits >> 63 else bits


# --- ARC


def arc_block(version: str, records: list[tuple[str, bytes]], date: str) -> bytes:
    """A legacy ARC file: the version block, then a record for each ``(url, payload)``."""
    fields = ARC_FIELDS[version]
    names = {"url": "URL", "ip": "IP-address", "date": "Archive-date", "mime": "Content-type", "status": "Result-code"}
    names |= {"checksum": "Checksum", "location": "Location", "offset": "Offset", "filename": "Filename", "length": "Archive-length"}

    def line(url: str, mime: str, length: int) -> bytes:
        values = {"url": url, "ip": "0.0.0.0", "date": date, "mime": mime, "status": "200", "length": str(length)}
        return (" ".join(values.get(f, "-") for f in fields) + "\n").encode()

    head = f"{version} 0 brightledger\n{' '.join(names[f] for f in fields)}\n".encode()
    out = io.BytesIO()
    out.write(line("filedesc://pages.arc", "text/plain", len(head)) + head + b"\n")
    for url, payload in records:
        out.write(line(url, "text/html", len(payload)) + payload + b"\n")
    return out.getvalue()


@dataclass
class ArcRecord:
    header: dict[str, str]
    payload: bytes


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file, by the header fields of its version and the declared lengths."""
    stream = io.BytesIO(data)
    first = stream.readline().decode().rstrip("\n").split(" ")
    block = stream.read(int(first[-1]))
    fields = ARC_FIELDS[block[:1].decode()]
    while line := stream.readline():
        if line == b"\n":
            continue
        values = line.decode().rstrip("\n").rsplit(" ", len(fields) - 1)  # a url may hold blanks
        header = dict(zip(fields, values, strict=True))
        payload = stream.read(int(header["length"]))
        if len(payload) != int(header["length"]):
            raise ValueError(f"truncated ARC record: {header['url']}")
        yield ArcRecord(header, payload)


# --- WARC


def warc_record(arc: ArcRecord, identifier: str, refers_to: str | None) -> bytes:
    """The equivalent WARC record without its end; a revisit keeps the HTTP header, not the payload."""
    day = arc.header["date"]
    http = f"HTTP/1.1 {arc.header.get('status', '200')} OK{CRLF}Content-Type: {arc.header['mime']}; charset=utf-8{CRLF}Content-Length: {len(arc.payload)}{END}"
    block = http.encode() + (b"" if refers_to is not None else arc.payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {identifier}",
        f"WARC-Date: {day[:4]}-{day[4:6]}-{day[6:8]}T{day[8:10]}:{day[10:12]}:{day[12:14]}Z",
        f"WARC-Target-URI: {arc.header['url']}",
        f"WARC-Payload-Digest: sha1:{hashlib.sha1(arc.payload).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines[5:5] = [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return CRLF.join(lines).encode() + END.encode() + block


def parse_warc(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers in lower case, block)`` of each record of a stream."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]) or stream.read(4) != END.encode():
            raise ValueError(f"truncated WARC record: {headers.get('warc-record-id')}")
        yield headers, block


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    version: str = "2", date: str = "20240101000000", min_bytes: int = MIN_BYTES,
) -> None:
    """Converts pages, as ARC records, to gzipped WARC parts under ``path``.

    Rows are numbered as they are read, twice: pages come from a table, or from a plan that gives the same rows in the same order.
    """
    html = F.coalesce(pages[html_col], F.lit(""))
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), F.coalesce(pages[url_col], F.lit("")).alias("url"), html.alias("html"))
    rows = rows.withColumns({"serial": F.monotonically_increasing_id(), "n": F.octet_length("html"), "digest": F.sha2("html", 256)})
    groups = stored(
        rows.where(F.col("n") >= min_bytes)
        .groupBy("digest", "n")
        .agg(F.count(F.lit(1)).alias("copies"), F.max(F.struct("page_id", "serial")).alias("last"))
        .where("copies > 1 and last.page_id is not null")
        .select("digest", "n", "last")
    )
    copy = ~F.col("page_id").eqNullSafe(F.col("last.page_id")) & F.col("last.page_id").isNotNull()
    rows = rows.join(groups, ["digest", "n"], "left").select("page_id", "serial", "url", "html", F.when(copy, F.col("last")).alias("refers_to"))

    def run(batches):
        archive, size = 0, 0
        for batch in slices(batches, 50):
            ids, serials, urls, htmls, refers = (c.to_pylist() for c in batch.columns)
            urls = [u.replace("\n", "%0A").replace("\r", "%0D") for u in urls]
            arc = arc_block(version, [(u, h.encode()) for u, h in zip(urls, htmls)], date)
            out, archives = [], []
            for record, page, serial, to in zip(parse_arc(arc), ids, serials, refers):
                value = warc_record(record, record_id(page, serial), to and record_id(to["page_id"], to["serial"]))
                out.append(value.decode())
                archives.append(archive)
                size += len(value)
                if size >= PART_BYTES:
                    archive, size = archive + 1, 0
            yield pa.record_batch([pa.array(out, pa.string()), pa.array(archives, pa.int32())], ["value", "archive"])

    records = rows.mapInArrow(run, "value string, archive int")
    records.write.option("lineSep", END).partitionBy("archive").text(path, compression="gzip")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""

    def run(batches):
        for batch in slices(batches, 1):
            rows = {"page_id": [], "payload_bytes": [], "payload_digest": [], "record_type": [], "refers_to": []}
            for content in batch.column(0):
                for headers, block in parse_warc(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    http, _, payload = block.partition(END.encode())
                    size = int(http.decode().rpartition("Content-Length:")[2])
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    if headers["warc-type"] == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
                        raise ValueError(f"payload does not match its digest: {headers['warc-record-id']}")
                    to = headers.get("warc-refers-to")
                    found = (page_of(headers["warc-record-id"]), size, digest, headers["warc-type"], to and page_of(to))
                    for column, value in zip(rows.values(), found):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.record_batch([pa.array(v, k) for v, k in zip(rows.values(), kinds)], list(rows))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt.gz").load(path)
    return files.select("content").mapInArrow(run, RESULT)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(read(spark, sf_dir, "pages"), path)
    return read_warc(spark, path)


SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages
), g AS (
  SELECT html, max(page_id) AS last FROM p WHERE n >= 1000 GROUP BY html
)
SELECT p.page_id, p.n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN g.last IS NULL OR g.last = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.last <> p.page_id THEN g.last END AS refers_to
FROM p LEFT JOIN g ON p.n >= 1000 AND p.html = g.html
"""
