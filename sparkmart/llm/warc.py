"""WARC archives of pages, and a reader that salvages what damage leaves.

Writing is Spark's text writer: a row is a record's header and block, and the line separator is the
two line ends that close a WARC record. So the files are plain WARC 1.1 on any file system that Spark
reaches, and its commit protocol guards them. Of pages with equal payloads of MIN_REVISIT bytes and
more, the one with the smallest page_id is a response; the others are revisits, which have the HTTP
header only and refer to it.

Reading takes whole files as (path, content): a record is a version line, header fields and
Content-Length bytes, on its own or in a gzip member. It counts if it is framed and closed right, its
gzip checksum is, and so are the digests that it states. After a failed check the reader searches for
the next gzip signature or version line at which a record passes, goes on from there, and logs the
bytes in between as a gap with the reason. So damage costs the records that it touches and no others.
A record that is cut out or damaged beyond reading can't be put right; its bytes are in the gaps.

Defined results: a null html is an empty payload. Rows of one page_id and equal payloads are alike:
all responses or all revisits. Without page_id a page is a response, unless one with a page_id has
its payload. A null url gives no target, and white space and controls in one are percent-encoded.
Empty tables give no records, empty files neither records nor gaps. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .work import Work

#: Smaller payloads are never revisits.
MIN_REVISIT = 100
#: Records of a file at most, which bounds what a reading task holds at once.
FILE_RECORDS = 1_000
#: Payload bytes of the rows that a reading task hands over at a time.
BATCH_BYTES = 4 << 20

END = "\r\n\r\n"
UNSAFE = "[\\x00-\\x20\\x7F]"
#: The signatures that records start with, the fields that each has, and the profile of
#: a revisit.
VERSION, GZIP = b"WARC/1.", b"\x1f\x8b\x08"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "urn:page:"

RECORDS = (
    "path string, offset long, length long, gap string, record_type string, record_id string, target_uri string,"
    " refers_to string, payload_digest string, payload_bytes long, payload binary"
)


# writing


def judged(work: Work, pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_digest, payload_bytes, and refers_to of revisits.

    First pages are found by an aggregation without the texts; only payloads that occur more than once
    are kept, in a table whose size Spark knows when it decides how to join.
    """
    payload = F.coalesce(pages["html"], F.lit(""))
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    firsts = rows.where(F.col("payload_bytes") >= MIN_REVISIT).groupBy("payload_digest")
    firsts = firsts.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    found = rows.join(work.stored(firsts, "firsts"), "payload_digest", "left")
    return found.withColumn("refers_to", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))).drop("first")


def _field(name: str, value: Column) -> Column:
    """A header line; nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{PAGE}"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _one_line(url: Column) -> Column:
    """The url with white space and control characters percent-encoded."""
    code = lambda c: F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))
    encoded = F.transform(F.split(url, ""), lambda c: F.when(c.rlike(UNSAFE), code(c)).otherwise(c))
    return F.when(url.rlike(UNSAFE), F.array_join(encoded, "")).otherwise(url)


def records(rows: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One text column: every judged row as a record, without the two line ends that close it."""
    refers_to, digest = F.col("refers_to"), lambda text: F.concat(F.lit("sha256:"), text)
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ")
    http = F.concat(http, F.col("payload_bytes").cast("string"), F.lit(END))
    rows = rows.withColumn("_block", F.when(refers_to.isNull(), F.concat(http, F.col("payload"))).otherwise(http))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(refers_to.isNull(), F.lit("response")).otherwise(F.lit("revisit"))),
        _field("WARC-Record-ID", _urn(F.col("page_id"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", _one_line(F.col("url"))),
        _field("WARC-Refers-To", F.when(refers_to.isNotNull(), _urn(refers_to))),
        _field("WARC-Profile", F.when(refers_to.isNotNull(), F.lit(REVISIT))),
        _field("WARC-Block-Digest", digest(F.sha2("_block", 256))),
        _field("WARC-Payload-Digest", digest(F.col("payload_digest"))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", F.octet_length("_block").cast("string")),
    )
    return rows.select(F.concat(header, F.lit("\r\n"), F.col("_block")).alias("value"))


def write_archives(rows: DataFrame, path: str, file_records: int = FILE_RECORDS) -> None:
    """Judged rows as WARC files in a new folder."""
    records(rows).write.option("lineSep", END).option("maxRecordsPerFile", file_records).text(path)


# reading


@dataclass(frozen=True)
class Record:
    offset: int
    length: int
    header: dict[str, str]
    block: bytes

    def http(self) -> tuple[bytes, bytes]:
        """HTTP header and payload; a block that isn't HTTP is payload."""
        if not self.header.get("content-type", "").startswith("application/http"):
            return b"", self.block
        head, found, payload = self.block.partition(END.encode())
        return (head, payload) if found else (self.block, b"")


@dataclass(frozen=True)
class Gap:
    offset: int
    length: int
    why: str


class Damaged(Exception):
    """Why no record can be read at a place."""


def digest_differs(stated: str | None, content: bytes) -> bool:
    """Whether content has another digest than the one stated, in hex or base 32. Unknown algorithms pass."""
    name, _, value = (stated or "").partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in ("md5", "sha1", "sha256", "sha512"):
        return False
    found = hashlib.new(name, content).digest()
    return value.strip().lower() not in (found.hex(), base64.b32encode(found).decode().lower(), base64.b32encode(found).decode().rstrip("=").lower())


def parse_header(text: bytes) -> dict[str, str]:
    first, *lines = text.split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.\d+", first):
        raise Damaged("no version line")
    header: dict[str, str] = {}
    name = ""
    for line in lines:
        if line[:1] in (b" ", b"\t") and name:  # a folded value
            header[name] += " " + line.strip().decode("utf-8", "replace")
            continue
        key, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!#-'*+.^-z|~A-Z0-9-]+", key):
            raise Damaged("malformed header field")
        name = key.decode().lower()
        if re.search(rb"WARC/1\.\d+$", value) or name in header and name != "warc-concurrent-to":
            raise Damaged("header runs into another one")  # its own end was lost
        header[name] = value.strip().decode("utf-8", "replace")
    return header


class Salvage:
    """The records of a file and the gaps between them."""

    def __init__(self, data: bytes):
        self.data = data
        self._next: dict[bytes, int] = {}

    def _find(self, mark: bytes, at: int) -> int:
        """The next place of a mark, or the end. A place is kept until it is passed, so all searches
        together read the file once."""
        if self._next.get(mark, -1) < at:
            found = self.data.find(mark, at)
            self._next[mark] = found if found >= 0 else len(self.data)
        return self._next[mark]

    def __iter__(self) -> Iterator[Record | Gap]:
        data, at, start, why = self.data, 0, None, ""
        while at < len(data):
            try:
                found, end = self._member(at) if data.startswith(GZIP, at) else self._record(at)
            except Damaged as damage:
                if start is None:
                    start, why = at, str(damage)
                at = min(self._find(VERSION, at + 1), self._find(GZIP, at + 1))
                continue
            if start is not None:
                yield Gap(start, at - start, why)
                start = None
            yield from found
            at = end
        if start is not None:
            yield Gap(start, len(data) - start, why)

    def _record(self, at: int) -> tuple[list[Record | Gap], int]:
        data = self.data
        if not data.startswith(VERSION, at):
            raise Damaged("no version line")
        body = self._find(END.encode(), at) + len(END)
        if body > len(data):
            raise Damaged("header without an end")
        header = parse_header(data[at : body - len(END)])
        if missing := [name for name in MANDATORY if name not in header]:
            raise Damaged(f"no {missing[0]}")
        length = header["content-length"]
        if not (length.isascii() and length.isdigit()):
            raise Damaged("malformed content-length")
        end = body + int(length)
        if end > len(data):
            raise Damaged("block is cut short")
        record = Record(at, end - at, header, data[body:end])
        if digest_differs(header.get("warc-block-digest"), record.block):
            raise Damaged("block digest differs")
        if header.get("warc-type") != "revisit" and digest_differs(header.get("warc-payload-digest"), record.http()[1]):
            raise Damaged("payload digest differs")
        if not data.startswith(END.encode(), end):
            # the digest proves that the block is whole, whatever comes after it
            if not header.get("warc-block-digest"):
                raise Damaged("record isn't closed")
            return [record], end
        end += len(END)
        while data[end : end + 2] == b"\r\n":
            end += 2
        return [record], end

    def _member(self, at: int) -> tuple[list[Record | Gap], int]:
        """The records of a gzip member; zlib compares its checksum and length."""
        inflate, parts, end = zlib.decompressobj(31), [], at
        view = memoryview(self.data)
        try:
            while not inflate.eof:
                piece = view[end : end + (1 << 16)]
                if not piece:
                    raise Damaged("gzip member is cut short")
                parts.append(inflate.decompress(piece))
                end += len(piece)
        except zlib.error:
            raise Damaged("gzip member is damaged") from None
        end -= len(inflate.unused_data)
        inner = Salvage(b"".join(parts))
        found: list[Record | Gap] = []
        for x in inner:
            whole = (at, end - at)
            found.append(Record(*whole, x.header, x.block) if isinstance(x, Record) else Gap(*whole, f"in a gzip member: {x.why}"))
        return found, end


def _row(path: str, found: Record | Gap, payloads: bool) -> tuple:
    if isinstance(found, Gap):
        return (path, found.offset, found.length, found.why, *[None] * 7)
    header, (http, payload) = found.header, found.http()
    if header.get("warc-type") == "revisit":
        stated = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
        size, digest, payload = int(stated[1]) if stated else None, header.get("warc-payload-digest", "").partition(":")[2] or None, None
    else:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    fields = [header.get(f"warc-{name}") for name in ("type", "record-id", "target-uri", "refers-to")]
    return (path, found.offset, found.length, None, *fields, digest, size, payload if payloads else None)


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """A row for each record and each gap of the files (path, content), as `binaryFile` loads them."""
    names, kinds = zip(*(x.split() for x in RECORDS.split(", ")))
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(zip(*rows), kinds)], list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                path, content = batch.column("path")[i].as_py(), batch.column("content")[i].as_py()
                for found in Salvage(content or b""):
                    rows.append(_row(path, found, payloads))
                    held += len(rows[-1][-1] or b"") + 500
                    if held > BATCH_BYTES:
                        yield packed(rows)
                        rows, held = [], 0
        if rows:
            yield packed(rows)

    return files.select("path", "content").mapInArrow(run, RECORDS)


def load(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder as (path, content)."""
    return spark.read.format("binaryFile").load(path)


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back and tell what each record says of its page."""
    work = Work(spark)
    path = f"{work.dir}/archives"
    write_archives(judged(work, pages), path)
    found = read_archives(load(spark, path), payloads=False).where(F.col("gap").isNull())
    page = lambda urn: F.nullif(F.regexp_extract(urn, f"{PAGE}(-?[0-9]+)", 1), F.lit("")).cast("long")
    return found.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"),
    )
