"""WARC archives of pages, and a reader that salvages damaged ones.

Archives are plain WARC 1.1 with a gzip member per record. They are written by Spark's text
writer, so that any store works and a retried task replaces its own files: a member's last
byte is the high byte of its length, 0 below 16 MiB (an empty member follows a longer record),
and that byte is the writer's line end.

The reader takes an archive from member to member, or from record to record if
it isn't compressed. A record counts if its header, length, end and digests are right. One that is wrong inside but
whose stated length ends where a record has to end, with a version line or nothing behind it, is put in quarantine as a
whole, so that what its payload quotes is never taken for a record. Only where the framing itself is lost the reader
looks for the next member with a version line, or version line, goes on there, and reports the bytes between as a gap. Inside
a whole member, whose end is known, it looks only behind a sound record; else the member is the gap.

Records and gaps account for every byte of an archive once: those of a whole member have the member's bytes in common,
what came out of a damaged member before the damage is placed at its beginning, of no length, and a record that is wrong beside sound ones in
a member is a gap of no length at its end.

A task holds one archive. The writer begins a new one after so many bytes or records; a foreign archive must fit
a row of the reader, which takes files below 2 GiB.

Defined cases: null html is an empty payload and a null url an empty address; a null page_id
is written and read as null; of repeated rows all that have the smallest page_id of their
payload are responses; an empty table gives no record; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS_PER_FILE = 2000
BYTES_PER_FILE = 32 << 20
LINE_END = "\x00"
DATE = "2024-01-01T00:00:00Z"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
MAGIC = b"\x1f\x8b\x08"
FOUND = (
    "archive string, start long, end long, kind string, reason string, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header_value(text: str) -> str:
    """Without line ends and other control characters, which a header line can't hold."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record with its payload, or a revisit record of another page's."""
    revisit = refers_to is not None
    name = "" if page_id is None else page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_header_value(url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes) -> bytes:
    """A member whose last byte is 0."""
    member = gzip.compress(record, 6, mtime=0)
    return member if not member[-1] else member + gzip.compress(b"", 6, mtime=0)


def _archives(most_records: int, most_bytes: int):
    """A row per archive: its members without the last byte, which the text writer adds."""

    def row_of(members: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(members)[:-1]], pa.binary())], names=["members"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                record = build_record(row["page_id"], row["url"], row["payload"], base32_sha1(row["payload"]), row["refers_to"])
                members.append(gzip_member(record))
                size += len(members[-1])
                if size >= most_bytes or len(members) >= most_records:
                    yield row_of(members)
                    members, size = [], 0
        if members:
            yield row_of(members)

    return run


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, refers_to: null for the smallest page_id of a payload and for payloads below `least_bytes`."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    firsts = rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    joined = rows.join(firsts.where("n > 1"), "digest", "left")
    return joined.select("page_id", "url", "payload", F.when(F.col("page_id") != F.col("first"), F.col("first")).alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE, bytes_per_file: int = BYTES_PER_FILE
) -> None:
    """Write a record per page as compressed archives into a folder; an archive ends with the record that reaches a bound."""
    archives = revisits(pages, least_bytes).mapInArrow(_archives(records_per_file, bytes_per_file), "members binary")
    writer = archives.select(F.col("members").cast("string")).write.option("lineSep", LINE_END)
    writer.option("maxRecordsPerFile", 1).option("compression", "none").text(folder)


class Salvage:
    """Reads one archive; `found` gets a tuple per record and per gap."""

    def __init__(self, archive: str, data: bytes, with_payload: bool):
        self.archive, self.data, self.with_payload = archive, data, with_payload
        self.found: list[tuple] = []
        self.member_from = 0  # where the rows of the last member begin

    def read(self) -> list[tuple]:
        if self.data[:2] == MAGIC[:2] or (self.data.find(MAGIC) >= 0 and not VERSION.match(self.data)):
            self.compressed()
        else:
            self.plain()
        return self.found

    def gap(self, start: int, end: int, reason: str) -> None:
        self.found.append((self.archive, start, end, "gap", reason, *[None] * 7))

    def compressed(self) -> None:
        at, size = 0, len(self.data)
        while at < size:
            content, end, reason = self.member(at)
            if not reason:
                if content:
                    self.member_from = len(self.found)
                    self.whole_member(content, at, end)
                else:
                    self.empty_member(at, end)
                at = end
                continue
            later = self.next_member(at + 1)
            self.member_from = len(self.found)
            if content:  # what came out before the damage
                self.records(content, (at, at))
            self.gap(at, later, reason)
            at = later

    def empty_member(self, start: int, end: int) -> None:
        """Belongs to the member before it, as the writer's filler does."""
        rows = self.found[self.member_from :]
        self.found[self.member_from :] = [(r[0], end if r[1] == start else r[1], end, *r[3:]) if r[2] == start else r for r in rows]
        if not rows:
            self.gap(start, end, "empty member")

    def whole_member(self, content: bytes, start: int, end: int) -> None:
        sound, reason = self.records(content, (start, end))
        if reason:
            self.gap(start if not sound else end, end, reason)

    def records(self, data: bytes, place: tuple[int, int]) -> tuple[int, str]:
        """Sound records of a member's content, all at one place: their number, and what is wrong with the first that isn't."""
        at, sound, wrong = 0, 0, ""
        while at < len(data):
            row, end, reason = self.record(data, at)
            if not reason:
                self.found.append((self.archive, *place, "record", None, *row))
                sound += 1
            else:
                wrong = wrong or reason
                if end == at:  # the framing is lost
                    later = VERSION.search(data, at + 1) if sound else None
                    end = later.start() if later else len(data)
            at = end
        return sound, wrong

    def member(self, at: int) -> tuple[bytes, int, str]:
        """Content of the member at a place, where it ends, and what is wrong with it."""
        if self.data[at : at + 3] != MAGIC:
            return b"", at, "no member"
        unzip, parts, pos = zlib.decompressobj(31), [], at
        try:
            while not unzip.eof and pos < len(self.data):
                parts.append(unzip.decompress(self.data[pos : pos + (1 << 16)]))
                pos += 1 << 16
        except zlib.error as error:
            return b"".join(parts), at, f"damaged member: {error}"
        if not unzip.eof:
            return b"".join(parts), at, "truncated member"
        content = b"".join(parts)
        if content and not VERSION.match(content):
            return b"", at, "member without a version line"
        return content, min(pos, len(self.data)) - len(unzip.unused_data), ""

    def next_member(self, start: int) -> int:
        while (at := self.data.find(MAGIC, start)) >= 0:
            try:
                if VERSION.match(zlib.decompressobj(31).decompress(self.data[at : at + 4096], 64)):
                    return at
            except zlib.error:
                pass
            start = at + 1
        return len(self.data)

    def plain(self) -> None:
        """Records of an archive that isn't compressed."""
        at, data = 0, self.data
        while at < len(data):
            row, end, reason = self.record(data, at)
            if not reason:
                self.found.append((self.archive, at, end, "record", None, *row))
            else:
                if end == at:  # the framing is lost
                    later = VERSION.search(data, at + 1)
                    end = later.start() if later else len(data)
                self.gap(at, end, reason)
            at = end

    def record(self, data: bytes, at: int) -> tuple[tuple, int, str]:
        """A record's fields, where it ends, and what is wrong with it; it ends where it begins if that isn't known."""
        if not VERSION.match(data, at):
            return (), at, "no version line"
        head = data.find(b"\r\n\r\n", at)
        if head < 0:
            return (), at, "header without end"
        headers = {}
        for line in data[at:head].split(b"\r\n")[1:]:
            name, colon, value = line.partition(b":")
            if not colon:
                return (), at, "bad header line"
            headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        length = headers.get("content-length", "")
        if not re.fullmatch(r"[0-9]{1,18}", length):
            return (), at, "bad length"
        end = head + 4 + int(length)
        if data[end : end + 4] != b"\r\n\r\n":
            return (), at, "record without end"
        framed = end + 4 if end + 4 == len(data) or VERSION.match(data, end + 4) else at
        block = data[head + 4 : end]
        want = headers.get("warc-block-digest", "")
        if want.startswith("sha1:") and want[5:] != base32_sha1(block):
            return (), framed, "wrong block digest"
        kind = headers.get("warc-type", "")
        payload = block
        stated = len(block)
        if headers.get("content-type", "").startswith("application/http"):
            http, _, payload = block.partition(b"\r\n\r\n")
            m = re.search(rb"(?i)\r\ncontent-length:[ \t]*([0-9]{1,18})", http)
            stated = int(m[1]) if m else len(payload)
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        if kind != "revisit":
            if digest and digest != base32_sha1(payload):
                return (), framed, "wrong payload digest"
            if stated != len(payload):
                return (), framed, "wrong payload length"
        row = (kind, headers.get("warc-record-id"), headers.get("warc-target-uri"), headers.get("warc-refers-to"), stated, digest or None)
        return (*row, payload if self.with_payload and kind != "revisit" else None), end + 4, ""


def _salvage(with_payload: bool):
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in FOUND.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = Salvage(batch.column("path")[i].as_py(), batch.column("content")[i].as_py(), with_payload).read()
                for start in range(0, len(found), 500):
                    columns = zip(*found[start : start + 500], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Records and gaps of all archives in a folder; `kind` tells which, `start` and `end` where in the archive."""
    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "content")
    return files.mapInArrow(_salvage(with_payload), FOUND)


def pages_of(found: DataFrame) -> DataFrame:
    """page_id, payload size and digest, type and original of each page record."""
    number = lambda c: F.expr(f"CAST(nullif(regexp_extract({c}, '^<urn:page:(-?[0-9]*)>$', 1), '') AS BIGINT)")
    return found.where("kind = 'record'").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )
