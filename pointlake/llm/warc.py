"""WARC archives: write, normalise monolithic gzip, read back by offset.

``write_archives`` lets Spark's text writer put one record per row, ended by the record
separator, into gzip files: each file is one gzip stream over all its
records, which cannot be entered at a record. ``normalise`` inflates every such stream
once, in pieces of bounded size, rewrites each record as a gzip member of its own and writes a
sidecar index (offset, length, type, ids, digest per record) beside the archive.
``read_records`` seeks to the members that the sidecars name and parses them.

Equal payloads: of the rows with one payload digest, the one with the largest page_id is the
response and holds the payload; the others are revisit records that refer to it and hold
no block of their own but the HTTP header. Which digests repeat is worked out on (page_id, digest) alone.

Edge cases: a null html is the empty payload; a null url writes no target header and a
null page_id no page header (both come back as null); rows that tie in the largest
page_id are all responses; line breaks in urls are replaced by blanks; an empty table
writes nothing; a truncated or foreign archive raises ValueError; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import open_store, read_table, shared_folder, store, writing

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"
END = b"\r\n\r\n"
#: Records of one archive file at most, and the bytes that are read or inflated at once.
FILE_RECORDS = 20_000
PIECE = 1 << 20


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hexadecimal digits are four of base 32."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, bytes, keeper): keeper is the largest page_id with the
    digest for rows that revisit it, else null."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    many = rows.select("page_id", "digest", "bytes").filter(F.col("bytes") >= least)
    many = many.groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = rows.join(many.select("digest", "last"), "digest", "left")
    keeper = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return rows.select("page_id", "url", "payload", "digest", "bytes", keeper.alias("keeper"))


def record_text(rows: DataFrame) -> DataFrame:
    """One column ``record``: the record without its closing separator."""
    revisit = F.col("keeper").isNotNull()

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    block = F.when(revisit, F.length(http)).otherwise(F.length(http) + F.col("bytes"))
    head = F.concat(
        F.lit(VERSION + CRLF), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))), line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]+", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Profile", F.when(revisit, PROFILE)),
        line("WARC-Refers-To", F.when(revisit, _record_id(F.col("keeper"), F.col("digest")))),
        line("X-Page-Id", F.col("page_id").cast("string")), line("X-Payload-Length", F.col("bytes").cast("string")),
        line("X-Refers-To-Page", F.col("keeper").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", block.cast("string")), F.lit(CRLF))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    return rows.select(F.concat(head, http, body).alias("record"))


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> None:
    """Monolithic .txt.gz archives of ``pages`` (page_id, url, html) in ``folder``."""
    (record_text(with_revisits(pages, least)).write.option("compression", "gzip").option("lineSep", END.decode())
     .option("maxRecordsPerFile", FILE_RECORDS).text(folder))


class Inflated:
    """Bytes of a gzip stream (one member or many), inflated as they are asked for."""

    def __init__(self, source):
        self.source, self.engine, self.held, self.raw = source, zlib.decompressobj(31), bytearray(), b""

    def more(self) -> bool:
        while True:
            if self.engine.eof:
                self.raw = self.engine.unused_data or self.raw or self.source.read(PIECE)
                if not self.raw:
                    return False
                self.engine = zlib.decompressobj(31)
            data = self.engine.unconsumed_tail or self.raw or self.source.read(PIECE)
            self.raw = b""
            out = self.engine.decompress(data, PIECE)  # without data: output that the last call had no room for
            if not data and not out and not self.engine.eof:
                raise ValueError("the gzip stream is truncated")
            if out:
                self.held += out
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Through the mark; None at the end of the stream."""
        start = 0
        while (at := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                if self.held:
                    raise ValueError("a record is truncated")
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError("a record is truncated")
        data = bytes(self.held[:n])
        del self.held[:n]
        return data


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split(CRLF)
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:] if x)}


def records(source) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(headers, header bytes, block) of every record of a gzip stream."""
    stream = Inflated(source)
    while (head := stream.until(END)) is not None:
        fields = parse_head(head)
        block = stream.take(int(fields["content-length"]))
        if stream.take(len(END)) != END:
            raise ValueError("a record does not end in a separator")
        yield fields, head, block


def normalise_file(source, archive, sidecar) -> tuple[int, int]:
    """Rewrite one stream record by record; returns (records, bytes). The sidecar has a JSON line per record."""
    at = n = 0
    for fields, head, block in records(source):
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(head) + packer.compress(block) + packer.compress(END) + packer.flush()
        archive.write(member)
        entry = {"offset": at, "length": len(member), "type": fields["warc-type"], "id": fields["warc-record-id"],
                 "digest": fields.get("warc-payload-digest"), "uri": fields.get("warc-target-uri")}
        sidecar.write(json.dumps(entry, ensure_ascii=False).encode() + b"\n")
        at += len(member)
        n += 1
    return n, at


def _normaliser(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            fs, own = open_store(path)
            # raw bytes: Arrow would inflate a .gz name by itself
            with fs.open_input_stream(own, compression=None) as source, writing(target) as archive, writing(f"{target}.idx") as sidecar:
                n, size = normalise_file(source, archive, sidecar)
            yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([n], pa.int64()), pa.array([size], pa.int64())],
                                             names=["archive", "n_records", "n_bytes"])


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every gzip file in ``source`` to ``target``; returns (archive, n_records, n_bytes).
    A task handles a file as a stream, so memory holds one record, and a file is the unit of parallel work."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    name = F.concat(F.lit(f"{target}/"), F.regexp_replace(F.regexp_extract("path", "([^/]+)$", 1), r"(\.txt)?\.gz$", ".warc.gz"))
    files = store(files.select("path", name.alias("target")).filter(F.col("path").isNotNull()), "warc-files")
    # a partition per file, given as a number: else the few small rows would be coalesced into one task
    return store(files.repartition(max(1, files.count())).mapInArrow(_normaliser, "archive string, n_records long, n_bytes long"), "warc-archives")


RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                    ("refers_to", pa.int64()), ("url", pa.string()), ("archive", pa.string()), ("offset", pa.int64())])


def read_member(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one gzip member."""
    (fields, _, block), = records(pa.BufferReader(data))
    return fields, block.partition(END)[2]


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.column(0).to_pylist():
            fs, path = open_store(archive)
            rows = []
            with fs.open_input_file(path) as file, fs.open_input_stream(f"{path}.idx", compression=None) as sidecar:
                rest = b""
                while True:
                    piece = sidecar.read(PIECE)
                    *lines, rest = (rest + piece).split(b"\n")
                    for entry in map(json.loads, lines):
                        fields, payload = read_member(file.read_at(entry["length"], entry["offset"]))
                        rows.append(_row(fields, payload, archive, entry["offset"]))
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORD)
                        rows = []
                    if not piece:
                        break


def _row(fields: dict[str, str], payload: bytes, archive: str, offset: int) -> dict:
    said = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != said:
        raise ValueError(f"{archive}: the payload at {offset} does not match its digest")
    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page")
    return {"page_id": page and int(page), "payload_bytes": int(fields["x-payload-length"]), "payload_digest": said,
            "record_type": fields["warc-type"], "refers_to": refers and int(refers), "url": fields.get("warc-target-uri"),
            "archive": archive, "offset": offset}


def read_records(archives: DataFrame) -> DataFrame:
    """One row per record of the archives, found through their sidecars; payloads of responses are checked."""
    kinds = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
             "url string, archive string, offset long")
    return archives.select("archive").repartition(max(1, archives.count())).mapInArrow(_reader, kinds)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, folder = shared_folder(spark, "warc-monolithic"), shared_folder(spark, "warc")
    write_archives(read_table(spark, sf_dir, "pages"), raw)
    return read_records(normalise(spark, raw, folder)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS h FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keeper FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (5 * (3 - i % 4))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN NULL ELSE keeper END AS refers_to
FROM k
"""
