"""WARC archives as a Spark data source, and pages written as response and revisit records."""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from .common import scratch, table

MANIFEST = "_committed.json"
#: Read columns that come from the record's header: name -> header.
HEADER_COLUMNS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "record_date": "warc-date",
    "content_type": "content-type",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
READ_SCHEMA = ", ".join([*(f"{c} string" for c in HEADER_COLUMNS), "payload_bytes long", "payload_sha256 string", "payload binary"])
READ_ARROW = pa.schema(
    [*((c, pa.string()) for c in HEADER_COLUMNS), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("payload", pa.binary())]
)
HTTP_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$")


def filesystem(path: str):
    """(pyarrow file system, path in it) of a path or URI of any store that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- writing


def record(kind: str, ident: str, uri: str | None, date: str, digest: str, payload: bytes, length: int, refers: str | None) -> bytes:
    """A record: the HTTP header names the full payload's length; a revisit ends there."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{ident}>", f"WARC-Date: {date}"]
    if uri is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <{refers}>")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 1) -> bytes:
    """A gzip member with an 'sl' extra field: its own length and that of its data, so that readers can skip it."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    total = 12 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """A file for each task attempt; readers see those that the commit lists, so that retries leave no copies."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.date = options.get("date", "2020-01-01T00:00:00Z")
        fs, at = filesystem(self.path)
        fs.create_dir(at, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        name, out = f"part-{uuid.uuid4().hex}.warc.gz", None
        fs, at = filesystem(self.path)
        for batch in iterator:
            if out is None:
                out = fs.open_output_stream(f"{at}/{name}", compression=None)
            for r in batch.to_pylist():
                payload = r["payload"] or b""
                data = record(r["record_type"], r["record_id"], r["target_uri"], self.date, r["payload_digest"], payload, r["payload_bytes"], r["refers_to"])
                out.write(member(data))
        if out is None:
            return Written([])
        out.close()
        return Written([name])

    def commit(self, messages: list) -> None:
        fs, at = filesystem(self.path)
        with fs.open_output_stream(f"{at}/{MANIFEST}") as f:
            f.write(json.dumps(sorted(x for m in messages if m for x in m.files)).encode())

    def abort(self, messages: list) -> None:
        fs, at = filesystem(self.path)
        for name in (x for m in messages if m for x in m.files):
            fs.delete_file(f"{at}/{name}")


# ---------------------------------------------------------------- reading


@dataclass
class Range(InputPartition):
    file: str
    start: int
    end: int

    def __post_init__(self):
        super().__init__(None)


def parse_header(data: bytes) -> dict[str, str]:
    """Header names in lower case; a name that is repeated keeps its last value."""
    out: dict[str, str] = {}
    last = None
    for line in data.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            out[last] = value.strip()
    return out


class Archive:
    """Records of one file that begin in [start, end). Headers are parsed first; `wanted` decides on the rest."""

    STEP = 1 << 16

    def __init__(self, handle, size: int, start: int, end: int):
        self.f, self.size, self.start, self.end = handle, size, start, end

    def at(self, offset: int, n: int) -> bytes:
        self.f.seek(offset)
        return self.f.read(n)

    def records(self, wanted) -> Iterator[tuple[dict[str, str], bytes]]:
        gz = self.at(0, 2) == b"\x1f\x8b"
        pos = self.start if not self.start else self.sync(gz)
        while pos < min(self.end, self.size):
            head, block, pos = (self.member if gz else self.plain)(pos, wanted)
            if block is not None:
                yield head, block

    def sync(self, gz: bool) -> int:
        """The first record that begins at or after start."""
        mark, pos = (b"\x1f\x8b\x08" if gz else b"WARC/1."), self.start
        while pos < min(self.end, self.size):
            chunk = self.at(pos, self.STEP + 16)
            i = chunk.find(mark)
            if i < 0 or i >= self.STEP:
                pos += self.STEP
                continue
            if self.begins(pos + i, gz):
                return pos + i
            pos += i + 1
        return self.size

    def begins(self, pos: int, gz: bool) -> bool:
        if gz:
            try:
                return zlib.decompressobj(31).decompress(self.at(pos, 4096), 64).startswith(b"WARC/")
            except zlib.error:
                return False
        if pos and self.at(max(0, pos - 4), min(4, pos)) != b"\r\n\r\n":
            return False
        head = self.at(pos, self.STEP).partition(b"\r\n\r\n")[0]
        length = parse_header(head).get("content-length", "")
        if not length.isdigit():
            return False
        after = pos + len(head) + 4 + int(length) + 4
        return after >= self.size or self.at(after, 5) == b"WARC/"

    def member(self, pos: int, wanted) -> tuple[dict[str, str], bytes | None, int]:
        first = self.at(pos, 4096)
        if first[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {pos}")
        total = None
        if first[3] & 4:
            extra, i = first[12 : 12 + struct.unpack("<H", first[10:12])[0]], 0
            while i + 4 <= len(extra):
                n = struct.unpack("<H", extra[i + 2 : i + 4])[0]
                if extra[i : i + 2] == b"sl" and n == 8:
                    total = struct.unpack("<I", extra[i + 4 : i + 8])[0]
                i += 4 + n
        z, data, read = zlib.decompressobj(31), b"", len(first)
        data = z.decompress(first, 8192)
        while b"\r\n\r\n" not in data and not z.eof:
            more = z.unconsumed_tail or self.at(pos + read, self.STEP)
            if not z.unconsumed_tail:
                if not more:
                    raise ValueError(f"the record at byte {pos} is cut off")
                read += len(more)
            data += z.decompress(more, 8192)
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = parse_header(head)
        keep = wanted(fields)
        if not keep and total:
            return fields, None, pos + total
        parts = [rest]
        while not z.eof:
            more = z.unconsumed_tail
            if not more:
                more = self.at(pos + read, max(self.STEP, total - read if total else 0))
                if not more:
                    raise ValueError(f"the record at byte {pos} is cut off")
                read += len(more)
            part = z.decompress(more, 1 << 20)
            if keep:
                parts.append(part)
        end = pos + read - len(z.unused_data)
        length = int(fields.get("content-length", "0"))
        return fields, b"".join(parts)[:length] if keep else None, end

    def plain(self, pos: int, wanted) -> tuple[dict[str, str], bytes | None, int]:
        data = self.at(pos, 4096)
        while b"\r\n\r\n" not in data:
            more = self.at(pos + len(data), self.STEP)
            if not more:
                raise ValueError(f"the record at byte {pos} is cut off")
            data += more
        n = data.index(b"\r\n\r\n") + 4
        fields = parse_header(data[: n - 4])
        length = int(fields.get("content-length", "0"))
        block = self.at(pos + n, length) if wanted(fields) else None
        return fields, block, pos + n + length + 4


class WarcReader(DataSourceReader):
    """Byte ranges of the files; filters on header columns are checked on the header alone."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.split = int(options.get("split_bytes", 128 << 20))
        self.payload = options.get("payload", "true").lower() == "true"
        self.digest = options.get("digest", "false").lower() == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", ("",))[0]
            if column not in HEADER_COLUMNS:
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((column, "in", (f.value,)))
            elif isinstance(f, In):
                self.tests.append((column, "in", tuple(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((column, "starts", f.value))
            elif isinstance(f, IsNotNull):
                self.tests.append((column, "set", None))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs as pafs

        fs, at = filesystem(self.path)
        info = fs.get_file_info(at)
        if info.type == pafs.FileType.File:
            files = [info]
        elif fs.get_file_info(f"{at}/{MANIFEST}").type == pafs.FileType.File:
            with fs.open_input_stream(f"{at}/{MANIFEST}") as f:
                files = fs.get_file_info([f"{at}/{x}" for x in json.loads(f.read())])
        else:
            files = fs.get_file_info(pafs.FileSelector(at))
            files = [x for x in files if re.search(r"\.warc(\.gz)?$", x.base_name)]
        files = sorted(files, key=lambda x: x.path)
        return [Range(x.path, s, min(s + self.split, x.size)) for x in files for s in range(0, x.size, self.split)]

    def wanted(self, fields: dict[str, str]) -> bool:
        for column, kind, value in self.tests:
            got = column_value(column, fields)
            if got is None or (kind == "in" and got not in value) or (kind == "starts" and not got.startswith(value)):
                return False
        return True

    def read(self, part: Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # there is no file at all
            return
        fs, _ = filesystem(self.path)
        rows: list[dict] = []
        held = 0
        with fs.open_input_file(part.file) as f:
            for fields, block in Archive(f, f.size(), part.start, part.end).records(self.wanted):
                row: dict = {c: column_value(c, fields) for c in HEADER_COLUMNS}
                payload, length = block, len(block)
                if (row["content_type"] or "").startswith("application/http"):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    said = HTTP_LENGTH.search(head + b"\r\n")
                    length = int(said[1]) if said and row["record_type"] == "revisit" else len(payload)
                row["payload_bytes"] = length
                if self.digest and row["record_type"] != "revisit":
                    row["payload_sha256"] = hashlib.sha256(payload).hexdigest()
                if self.payload:
                    row["payload"] = payload
                    held += len(payload)
                rows.append(row)
                held += 500
                if held > 16 << 20:
                    yield pa.RecordBatch.from_pylist(rows, READ_ARROW)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, READ_ARROW)


def column_value(column: str, fields: dict[str, str]) -> str | None:
    value = fields.get(HEADER_COLUMNS[column])
    if value is not None and column in ("record_id", "refers_to"):
        value = value.strip("<>")
    return value


class WarcSource(DataSource):
    """Format "warc". Read options: payload (false leaves the column null), digest (true adds payload_sha256 of the
    decoded payload), split_bytes. Write option: date. Files: gzip members or plain text, with or without skip fields."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """The records of one archive or a folder of them."""
    register(spark)
    return spark.read.format("warc").options(**{k: str(v) for k, v in options.items()}).load(path)


def page_records(pages: DataFrame, least: int = 100) -> DataFrame:
    """A record for each row of pages (page_id, url, html), as `write_warc` takes them.

    Of equal payloads of at least `least` bytes the smallest page_id is the response and the others are revisits of it;
    rows that repeat that page_id are responses too. Smaller payloads are all responses. A null html is an empty
    payload; a null page_id is larger than any other and its record's id ends in "null"; a null url has no target.
    Equal payloads are joined on their digest, so that many copies of one page are split over tasks.
    """
    ident = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")))
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    base = pages.select("page_id", F.col("url").cast("string").alias("target_uri"), body.alias("payload"))
    base = base.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    base = base.withColumn("payload_digest", F.sha2("payload", 256))
    light = base.where(F.col("payload_bytes") >= least).select("payload_digest", "page_id")
    firsts = light.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1").drop("n")
    joined = base.join(firsts, "payload_digest", "left")
    again: Column = (F.col("payload_bytes") >= least) & F.col("first_id").isNotNull()
    again = again & (F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id")))
    return joined.select(
        ident("page_id").alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        "payload_bytes",
        "payload_digest",
        F.when(again, ident("first_id")).alias("refers_to"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_warc(records: DataFrame, path: str) -> None:
    """records (see page_records) as .warc.gz files below path."""
    register(records.sparkSession)
    records.write.format("warc").mode("append").save(path)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages to archives and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    path = scratch(spark, "warc")
    write_warc(page_records(table(spark, sf_dir, "pages")), path)
    back = read_warc(spark, path, payload=False, digest=True).where(F.col("record_type").isin("response", "revisit"))
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    said = F.regexp_replace("payload_digest", "^sha256:", "")
    return back.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        F.coalesce("payload_sha256", said).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )
