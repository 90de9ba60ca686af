"""WARC archives: a writer with revisit records, and a reader that splits compressed files.

Every record is a gzip member of its own. The reader's tasks each scan a byte range for the gzip magic, accept a
place as the start of a member if it inflates to a WARC header, and own the records that start inside their range;
they read beyond its end to finish the last one. No index is needed and no file is read by one task alone.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import lookup, new_path

MAGIC = b"\x1f\x8b\x08"
RANGE_BYTES, CHUNK = 32 << 20, 1 << 20
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A member without content; its last byte is zero whatever comes before it.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
SCHEMA = ("path string, offset long, record_type string, page_id long, refers_to long, url string, "
          "payload_bytes long, payload_digest string, payload binary")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP headers of the full payload, and not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", "Content-Type: application/http;msgtype=response",
             f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", f"Content-Length: {len(block)}"]
    if is_revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_bytes: int = 0) -> None:
    """Writes a record for each row. Of equal payloads of at least ``min_bytes``, the smallest id is the response.

    A NULL payload is empty. Rows without an id are revisits if an equal payload has an id, else responses; rows that
    repeat the smallest id are all responses. Equal payloads are grouped by digest, counted before the shuffle, and
    the group's response comes back by ``lookup``, so copies of one page by the million meet in no task.

    Spark's text sink writes the bytes, so its commit holds for them. It puts a separator after each record: a zero
    byte, which is the last of every member (of its 4-byte length) below 16 MB; that byte is left off here. Larger
    members are followed by an empty one.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        html.alias("payload"), F.sha1(html).alias("digest"))
    groups = rows.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    rows = lookup(rows, groups, "digest", "n", F.xxhash64("page_id", "url"))
    revisit: Column = (F.octet_length("payload") >= min_bytes) & F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                raw = record(*row)
                member = gzip.compress(raw, 6, mtime=0)
                if member[-1]:
                    member += EMPTY_MEMBER
                out.append(member[:-1])
                size += len(member)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    made = rows.select("page_id", "url", "payload", "refers_to", revisit.alias("revisit")).mapInArrow(members, "member binary")
    made.select(F.col("member").cast("string")).write.option("lineSep", "\x00").text(path)


class _Window:
    """Bytes of a file by place, read in chunks."""

    def __init__(self, file):
        self.file, self.size, self.begin, self.data = file, file.size(), 0, b""

    def at(self, place: int, n: int) -> bytes:
        """At least ``n`` bytes from ``place`` on, fewer only at the end of the file."""
        if not (self.begin <= place and min(place + n, self.size) <= self.begin + len(self.data)):
            self.file.seek(place)
            self.begin, self.data = place, self.file.read(max(n, CHUNK))
        return self.data[place - self.begin:]


def inflate(window: _Window, place: int, head_only: bool = False) -> tuple[bytes, int] | None:
    """Content of the member at ``place`` and where it ends; None unless it is a member that begins with WARC/."""
    stream, out, at = zlib.decompressobj(31), bytearray(), place
    while not stream.eof:
        data = window.at(at, 1)[: 1 << 16]
        if not data:
            return None
        try:
            out += stream.decompress(data)
        except zlib.error:
            return None
        if len(out) >= 5 and not out.startswith(b"WARC/"):
            return None
        at += len(data)
    return (bytes(out), at - len(stream.unused_data)) if out.startswith(b"WARC/") else None


def parse(content: bytes) -> dict:
    """The columns of ``SCHEMA`` that a record's content gives."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    block = rest[: int(fields.get("content-length", 0))]
    kind = fields.get("warc-type")
    payload, size, digest = block, len(block), None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if kind == "revisit":
            lengths = [v for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.strip().lower() == b"content-length"]
            size, digest = int(lengths[0]) if lengths else None, fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    page = lambda v: int(n) if (n := (v or "").removeprefix("<urn:page:").rstrip(">")).lstrip("-").isdigit() else None
    return {"record_type": kind, "page_id": page(fields.get("warc-record-id")), "refers_to": page(fields.get("warc-refers-to")),
            "url": fields.get("warc-target-uri"), "payload_bytes": size,
            "payload_digest": digest or sha1_base32(payload), "payload": payload if kind != "revisit" else None}


def records_in(uri: str, start: int, end: int) -> Iterator[dict]:
    """Records of the file that start in [start, end)."""
    system, path = pafs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as file:
        window, place = _Window(file), start
        while place < end:
            data = window.at(place, len(MAGIC))
            found = data.find(MAGIC)
            if found < 0:
                if len(data) < len(MAGIC) or window.begin + len(window.data) >= window.size:
                    return
                place += len(data) - len(MAGIC) + 1
                continue
            place += found
            if place >= end:
                return
            member = inflate(window, place)
            if member is None:
                place += 1
                continue
            yield {"path": uri, "offset": place, **parse(member[0])}
            place = member[1]


def read_warc(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """Reads archives (compressed by record) as ``SCHEMA``; a NULL ``payload`` for revisits.

    Files are listed by Spark and cut into ranges of ``range_bytes``. A place that does not inflate to a WARC header
    is compressed data that looks like the magic, and is passed over. An archive that is cut short loses its last,
    unfinished record. ``page_id`` and ``refers_to`` are NULL for archives of other writers.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    tasks = max(1, min(ranges.count(), 20_000))
    schema = SCHEMA if with_payload else SCHEMA.rsplit(",", 1)[0]
    names = [f.strip().split()[0] for f in schema.split(",")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    arrow = pa.schema([(n, types[f.split()[1]]) for n, f in zip(names, schema.split(","))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                out, size = [], 0
                for row in records_in(uri, start, end):
                    out.append({n: row[n] for n in names})
                    size += len(row["payload"] or b"") if with_payload else 0
                    if size > 8 << 20 or len(out) >= 10_000:
                        yield pa.RecordBatch.from_pylist(out, schema=arrow)
                        out, size = [], 0
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    cut = ranges.select("path", "start", F.least(F.col("start") + range_bytes, "length").alias("end"))
    return cut.repartition(tasks).mapInArrow(read, schema)


def op2_warc(spark, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_warc(spark, path, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
coded AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS leader,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(
           [((instr('0123456789abcdef', substr(h, 1 + (5 * k + j) // 4, 1)) - 1) >> (3 - (5 * k + j) % 4) & 1) << (4 - j)
            for j in range(5)]) AS INTEGER), 1) for k in range(32)], '') AS payload_digest
  FROM hashed)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> leader THEN leader END AS refers_to
FROM coded
"""
