"""WARC archives as a chunked record table.

Writing: each page becomes one record of a WARC/1.1 file. Spark's text sink writes the
bytes (its separator is the last line feed of every record), so any store that Spark
reaches will do. Payloads that occur more than once are stored once, as the response of
the largest page_id; the others become revisit records that refer to it.

Reading: Spark lists the archives and deals them out; a task opens each through Arrow's
file systems and takes blocks of READ_BYTES bytes, unpacked as far as a block goes, never a
line, record or file at once. A payload comes out as rows (record_id, chunk_no, chunk) of
at most chunk_bytes bytes, and the SHA-1 is carried from chunk to chunk; the last chunk's
row holds the digest and the length. A record of any size, with or without line feeds,
needs the memory of a block and a chunk. Archives are plain or gzip-compressed, as a whole
or record by record; each is read by one task. Header names may be in any case, lines
without a colon are passed over, a missing length counts as 0. Of an archive that ends
inside a record the rest comes out as a chunk that is not the last.

Null html counts as empty. Rows with a null page_id or a null url are written like
others. Several rows with the group's largest page_id are all responses. Rows of one page_id
with different payloads are records of their own: such a record's id also holds the digest, so
a revisit refers to the record that stores its very payload. Empty tables give empty archives;
further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomseq.llm.common import fresh_path, materialise, table

CHUNK_BYTES, READ_BYTES = 1 << 18, 1 << 18
CHUNKS = "record_id string, record_type string, refers_to string, declared_digest string, declared_bytes long, chunk_no int, chunk binary, end_offset long, is_last boolean, payload_digest string"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of SHA-1: five hexadecimal digits are four base32 digits."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def plan_records(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """page_id, payload_digest, response_id (the page that stores the payload) and
    response_mark of each revisit; and the page_ids that occur with several payloads. Only small
    columns are shuffled, by digest and page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    small = pages.select("page_id", F.octet_length(payload).cast("long").alias("payload_bytes"), base32_sha1(payload).alias("payload_digest"))
    small = materialise(spark, small, "digests")
    groups = small.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
    shared = materialise(spark, groups.where("n > 1 and response_id is not null").select("payload_digest", "response_id"), "shared")
    several = small.groupBy("page_id").agg(F.min("payload_digest").alias("lo"), F.max("payload_digest").alias("hi")).where("page_id is not null and lo <> hi")
    several = materialise(spark, several.select("page_id", F.lit(True).alias("mark")), "several")
    revisits = small.join(shared, "payload_digest").where("page_id < response_id").select("page_id", "payload_digest", "response_id").distinct()
    return revisits.join(several.toDF("response_id", "response_mark"), "response_id", "left"), several


def _clean(value: Column) -> Column:
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"[\x00-\x20]", "%20")


def write_warc(spark: SparkSession, pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = 50_000) -> None:
    """Write pages (page_id, url, html) to gzip-compressed WARC files under path."""
    planned, several = plan_records(spark, pages, min_bytes)
    revisits = materialise(spark, planned, "revisits")
    html = F.coalesce(F.col("html"), F.lit(""))
    payload = html.cast("binary")
    # A page may occur several times with different payloads: each is judged by itself.
    rows = pages.select("page_id", "url", "html", base32_sha1(payload).alias("payload_digest")).join(revisits, ["page_id", "payload_digest"], "left").join(several, "page_id", "left")
    digest = F.col("payload_digest")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c, mark: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.when(F.col(mark), F.concat(F.lit(":"), digest)).otherwise(""), F.lit(">"))
    again = F.col("response_id").isNotNull()
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("page_id"), "mark")),
        line("WARC-Target-URI", _clean(F.col("url"))),
        line("WARC-Date", F.lit("2024-01-01T00:00:00Z")),
        F.when(again, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", urn(F.col("response_id"), "response_mark")))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        line("WARC-Payload-Length", F.octet_length(payload).cast("string")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(again, "0").otherwise(F.octet_length(payload).cast("string"))),
        F.lit("\r\n"),
        F.when(again, "").otherwise(html),
        F.lit("\r\n\r"),
    )
    rows.select(record.alias("value")).write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def _head(block: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n"))
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


def _number(value: str | None) -> int:
    return int(value) if value and value.isdigit() else 0


class _Reader:
    """Parser of a stream of WARC bytes; emits rows of CHUNKS."""

    def __init__(self, chunk_bytes: int):
        self.size, self.buffer, self.record = chunk_bytes, b"", None

    def feed(self, data: bytes) -> list[tuple]:
        buf = self.buffer + data
        at, rows = 0, []
        while True:
            if self.record is None:
                end = buf.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                head = _head(buf[at:end])
                at = end + 4
                self.left, self.no, self.done, self.sha = _number(head.get("content-length")), 0, 0, hashlib.sha1()
                declared = head.get("warc-payload-digest", "").removeprefix("sha1:")
                length = _number(head["warc-payload-length"]) if "warc-payload-length" in head else self.left
                self.record = (head.get("warc-record-id"), head.get("warc-type"), head.get("warc-refers-to"), declared, length)
            n = min(self.size, self.left)
            if len(buf) - at < n + (4 if n == self.left else 0):
                break
            rows.append(self._row(buf[at : at + n]))
            at += n
            if not self.left:
                at += 4
                self.record = None
        self.buffer = buf[at:]
        return rows

    def _row(self, chunk: bytes) -> tuple:
        self.sha.update(chunk)
        self.left -= len(chunk)
        self.done += len(chunk)
        last = not self.left
        self.no += 1
        return (*self.record, self.no - 1, chunk, self.done, last, base32(self.sha.digest()) if last else None)

    def finish(self) -> list[tuple]:
        """What is left of a record that the stream breaks off."""
        if self.record is None or not (self.left or self.done == 0):
            return []
        chunk = self.buffer[: self.left]
        return [(*self.record, self.no, chunk, self.done + len(chunk), False, None)]


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def unpacked(stream) -> Iterator[bytes]:
    """Blocks of READ_BYTES bytes at most of a stream that is plain or gzip, of one member or
    many."""
    block = stream.read(READ_BYTES)
    if block[:2] != b"\x1f\x8b":
        while block:
            yield block
            block = stream.read(READ_BYTES)
        return
    member = zlib.decompressobj(31)
    while block:
        out = member.decompress(block, READ_BYTES)
        if out:
            yield out
        block = member.unconsumed_tail
        if member.eof:
            block, member = member.unused_data.lstrip(b"\0"), zlib.decompressobj(31)
        block = block or stream.read(READ_BYTES)
    yield member.flush()


def records_of(uri: str, chunk_bytes: int) -> Iterator[list[tuple]]:
    """Lists of rows of CHUNKS of one archive."""
    if uri.startswith("file:"):
        system, path = pyarrow.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    else:
        system, path = pyarrow.fs.FileSystem.from_uri(uri)
    reader = _Reader(chunk_bytes)
    with system.open_input_stream(path, compression=None) as stream:
        for block in unpacked(stream):
            yield reader.feed(block)
    yield reader.finish()


def read_warc(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table (columns of CHUNKS) of the archives under path, which Arrow's file
    systems must be able to open. payload_digest is computed from the chunks that were read;
    a revisit has one empty chunk."""
    files = spark.read.format("binaryFile").load(path).select("path")
    kinds = [pa.string()] * 4 + [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.bool_(), pa.string()]
    fields = ["record_id", "record_type", "refers_to", "declared_digest", "declared_bytes", "chunk_no", "chunk", "end_offset", "is_last", "payload_digest"]

    def run(batches):
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                for rows in records_of(uri, chunk_bytes):
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=fields)

    return files.mapInArrow(run, CHUNKS)


def page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)(?::[A-Z2-7]*)?>$", 1).try_cast("long") if hasattr(Column, "try_cast") else F.regexp_extract(urn, r"^<urn:page:(-?\d+)(?::[A-Z2-7]*)?>$", 1).cast("long")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    write_warc(spark, table(spark, sf_dir, "pages"), path)
    last = read_warc(spark, path).where("is_last")
    stored = F.col("record_type") == "response"
    return last.select(
        page_of(F.col("record_id")).alias("page_id"),
        F.when(stored, F.col("end_offset")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(stored, F.col("payload_digest")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )


_DIGITS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {1 + 5 * i}, 5))::BIGINT >> {s}) & 31)::INTEGER, 1)" for i in range(8) for s in (15, 10, 5, 0))
SQL = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_DIGITS} AS payload_digest, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to FROM q"""
