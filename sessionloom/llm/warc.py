"""WARC from legacy ARC archives.

Archives are part files of Spark's text writer, so they can lie in any store that Spark reaches
and a lost task leaves none half written: ARC and WARC records are a head, a body of declared
length and line ends.  Reading goes by the declared lengths alone; a body may hold anything.
Each file is read by one task, so a file is bounded: it has what one task wrote, the part of a
table that `spark.sql.files.maxPartitionBytes` gives it.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.session import materialise, new_path

from .rows import pieces, whole

BATCH_BYTES = 1 << 24
# Payloads shorter than this are stored each time.
LEAST_SHARED = 1000

# The record lines of ARC versions 1 and 2, and the profile of a revisit.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
       "Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _field(value: Column, missing: str) -> Column:
    """A value for a line of fields: blanks and control characters as %-codes."""
    coded = F.coalesce(value, F.lit(missing))
    for code in [*range(33), 127]:
        coded = F.replace(coded, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(coded == "", missing).otherwise(coded)


def write_arc(
    pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html",
    date: str = "20240101000000",
) -> None:
    """Write pages as ARC files, gzipped; tasks with odd numbers in version 2, others in 1.

    The body is an HTTP response with the id in the header X-Page-Id.  Null html is empty, a
    null or empty url is written as `unknown:`, a null id leaves the header out.
    """
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.coalesce(F.concat(F.lit("X-Page-Id: "), F.col(id).cast("string"), F.lit("\r\n")), F.lit("")),
        F.lit("\r\n"),
    )
    body = F.concat(head, whole(F.col(html))).cast("binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version = 1 + part % 2
        fields = f"{version} 0 sessionloom\n{ARC_FIELDS[version]}\n"
        first = f"filedesc://part-{part}.arc 0.0.0.0 {date} text/plain {len(fields)}\n{fields}".encode()
        more = "" if version == 1 else f" 200 - - 0 part-{part}.arc"
        for batch in pieces(batches, "body", BATCH_BYTES):
            records = [first] if first else []
            first = b""
            for url, body in zip(*[batch.column(n).to_pylist() for n in ("url", "body")], strict=True):
                line = f"{url} 0.0.0.0 {date} text/html{more} {len(body)}\n"
                records.append(line.encode() + body)
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    rows = pages.select(_field(F.col(url), "unknown:").alias("url"), body.alias("body"))
    rows.mapInArrow(run, "record binary").select(F.col("record").cast("string")).write.option(
        "compression", "gzip"
    ).text(path)


class Reader:
    """Lines and counted bytes of a file, plain or of gzip members, unpacked as needed."""

    def __init__(self, content: bytes, step: int = 1 << 20):
        self.packed = content[:2] == b"\x1f\x8b"
        self.rest = memoryview(content)
        self.step = step
        self.held = bytearray()
        self.unpack = zlib.decompressobj(31)

    def _more(self) -> bool:
        if not self.rest:
            return False
        part, self.rest = self.rest[: self.step], self.rest[self.step:]
        if not self.packed:
            self.held += part
            return True
        while part:
            self.held += self.unpack.decompress(part)
            part = self.unpack.unused_data
            if self.unpack.eof:
                self.unpack = zlib.decompressobj(31)
        return True

    def line(self) -> bytes | None:
        """The next line with its end, or None after the last."""
        at = 0
        while (end := self.held.find(b"\n", at)) < 0:
            at = len(self.held)
            if not self._more():
                return None if not self.held else self.read(len(self.held))
        return self.read(end + 1)

    def read(self, size: int) -> bytes:
        while len(self.held) < size and self._more():
            pass
        if len(self.held) < size:
            raise ValueError(f"an archive ends {size - len(self.held)} bytes before a record does")
        found = bytes(self.held[:size])
        del self.held[:size]
        return found


def arc_records(content: bytes) -> Iterator[dict[str, str | bytes]]:
    """The records of an ARC file after its version block: its fields by name, and `body`.

    The version block says which fields a record line has.  A line has them from the right, so
    that a URL may hold blanks.
    """
    reader, names = Reader(content), ARC_FIELDS[1].split()
    while (line := reader.line()) is not None:
        line = line.rstrip(b"\r\n")
        if not line:
            continue
        if line.startswith(b"filedesc://"):
            block = reader.read(int(line.rpartition(b" ")[2])).decode("latin-1").split("\n")
            version = int(block[0].split()[0])
            names = (block[1] if len(block) > 1 and block[1].strip() else ARC_FIELDS[version]).split()
            continue
        fields = dict(zip(names, line.decode(errors="replace").rsplit(" ", len(names) - 1), strict=True))
        yield fields | {"body": reader.read(int(fields["Archive-length"]))}


def warc_records(content: bytes) -> Iterator[dict[str, str | bytes]]:
    """The records of a WARC file: its fields by lower-case name, and `body`."""
    reader = Reader(content)
    while (line := reader.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        fields = {}
        while (line := reader.line()) is not None and line.strip():
            name, _, value = line.decode(errors="replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields | {"body": reader.read(int(fields["content-length"]))}


def _response(body: bytes) -> tuple[bytes, bytes, int | None]:
    """Head and payload of an HTTP response, and the page's id; all payload if it is none."""
    if not body.startswith(b"HTTP/"):
        return b"", body, None
    head, end, payload = body.partition(b"\r\n\r\n")
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"x-page-id":
            return head + end, payload, int(value)
    return head + end, payload, None


def _parsed(spark: SparkSession, path: str, shape: str, read, payload: bool) -> DataFrame:
    """Rows that `read` makes of the files below a path; without `payload`, it is left null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for name, content in zip(*[batch.column(c) for c in ("path", "content")], strict=True):
                for row in read(name.as_py().rpartition("/")[2], content.as_py()):
                    held.append(row if payload else row | {"payload": None})
                    size += 200 + len(held[-1]["payload"] or b"")
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, schema)

    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, types[t]) for n, t in (part.split() for part in shape.split(", "))])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, shape)


def read_arc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """ARC records with what WARC needs: record_id, made from file and place, and digests."""
    def read(name: str, content: bytes) -> Iterable[dict]:
        for place, record in enumerate(arc_records(content)):
            head, body, key = _response(record["body"])
            date = record["Archive-date"].ljust(14, "0")
            yield {
                "record_id": str(uuid.UUID(bytes=hashlib.md5(f"{name}#{place}".encode()).digest(), version=5)),
                "page_id": key, "url": record["URL"], "content_type": record["Content-type"],
                "date": f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z",
                "head": head, "payload": body, "payload_bytes": len(body),
                "payload_digest": hashlib.sha1(body).hexdigest(),
            }

    shape = (
        "record_id string, page_id long, url string, content_type string, date string, head binary, "
        "payload binary, payload_bytes long, payload_digest string"
    )
    return _parsed(spark, path, shape, read, payload)


def arc_to_warc(spark: SparkSession, arc: str, path: str, least: int = LEAST_SHARED) -> None:
    """Convert the ARC files below `arc` to WARC, gzipped.

    Of equal payloads of at least `least` bytes the one with the largest page id (then record
    id) is a response, and the others are revisits that refer to it and leave the payload out.
    A first pass keeps digests only; those of shared payloads are joined in a second one.
    """
    heads = materialise(
        read_arc(spark, arc, payload=False)
        .select("record_id", "page_id", "payload_bytes", "payload_digest"),
        "arc-heads",
    )
    large = heads.where(F.col("payload_bytes") >= least)
    last = F.max(F.struct("page_id", "record_id"))["record_id"]
    shared = materialise(
        large.groupBy(F.col("payload_digest").alias("digest"))
        .agg(last.alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1"),
        "shared-payloads",
    )
    revisits = materialise(
        large.join(shared, F.col("payload_digest") == F.col("digest"))
        .where("record_id <> refers_to").select(F.col("record_id").alias("of"), "refers_to"),
        "revisits",
    )
    records = read_arc(spark, arc).join(revisits, F.col("record_id") == F.col("of"), "left")
    again = F.col("refers_to").isNotNull()
    http = F.octet_length("head") > 0
    block = F.concat(F.col("head").cast("string"), F.when(again, "").otherwise(F.col("payload").cast("string")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    kind = F.when(again, "revisit").when(http, "response").otherwise("resource")
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), "record_id", F.lit(">"))),
        line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        F.when(again, F.concat(
            line("WARC-Profile", F.lit(REVISIT)),
            line("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), "refers_to", F.lit(">"))),
        )).otherwise(""),
        line("Content-Type", F.when(http, "application/http;msgtype=response").otherwise(F.col("content_type"))),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block, F.lit("\r\n\r"),  # the writer ends the line
    )
    records.select(record.alias("record")).write.option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """WARC records; the digest is computed from the payload, and a revisit's is the declared one.

    A response whose payload does not have its declared digest raises.
    """
    def plain(value: str | None) -> str | None:
        return value and value.removeprefix("<urn:uuid:").removesuffix(">")

    def read(name: str, content: bytes) -> Iterable[dict]:
        for record in warc_records(content):
            head, body, key = _response(record["body"])
            kind, declared = record["warc-type"], record["warc-payload-digest"].removeprefix("sha1:")
            if kind != "revisit" and hashlib.sha1(body).hexdigest() != declared:
                raise ValueError(f"{record['warc-record-id']} in {name} has another digest")
            yield {
                "record_id": plain(record["warc-record-id"]), "page_id": key, "record_type": kind,
                "url": record["warc-target-uri"], "date": record["warc-date"],
                "refers_to": plain(record.get("warc-refers-to")), "payload": body,
                "payload_bytes": len(body), "payload_digest": declared,
            }

    shape = (
        "record_id string, page_id long, record_type string, url string, date string, "
        "refers_to string, payload binary, payload_bytes long, payload_digest string"
    )
    return _parsed(spark, path, shape, read, payload)


def resolved(records: DataFrame) -> DataFrame:
    """Records of which revisits have the length of the payload they refer to, and its page id.

    `records` should be a written table; one response may be what very many revisits refer to,
    so this is a plain join that adaptive execution can split.
    """
    targets = records.where("record_type <> 'revisit'").select(
        F.col("record_id").alias("of"), F.col("page_id").alias("of_page"),
        F.col("payload_bytes").alias("of_bytes"),
    )
    return records.join(targets, records["refers_to"] == targets["of"], "left").select(
        "page_id", F.coalesce("of_bytes", "payload_bytes").alias("payload_bytes"), "payload_digest",
        "record_type", F.col("of_page").alias("refers_to"),
    )


def archive_pages(
    pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html",
    folder: str | None = None,
) -> DataFrame:
    """Pages through ARC into WARC and back: page_id, payload_bytes, payload_digest, record_type,
    refers_to, one row per row of `pages`.

    The archives stay below `folder`.  Null and empty html are empty payloads, stored as
    responses.  Rows that repeat an id are records of their own, of which the one with the
    largest record id is the response.  An empty table makes empty archives.  Other columns are
    not read.  Runs jobs when called.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "archives")
    write_arc(pages, f"{folder}/arc", id, url, html)
    arc_to_warc(spark, f"{folder}/arc", f"{folder}/warc")
    heads = read_warc(spark, f"{folder}/warc", payload=False).drop("payload")
    return resolved(materialise(heads, "warc-heads"))
