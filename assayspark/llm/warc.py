"""WARC archives as a PySpark Python data source: writer, reader with pushdown, and revisit records for equal payloads.

Reading plans one partition per file (a file holds at most `records` records). Of every record the headers are parsed
first; type and header predicates are pushed down and checked there, and the block of an unwanted record is passed over
by its length: never copied, decoded or checked. The option `payload` says of which types blocks are decoded at all.

Files are written to a folder of their own attempt and moved into place once the job commits, so retried tasks and lost
executors leave nothing behind. Paths can be in any store that Arrow's file systems know.

Archives of other makers are read too. Only blocks whose Content-Type is application/http have HTTP headers before the
payload; of other records, warcinfo among them, the whole block is the payload. payload_bytes is what the block holds, but
for revisits, whose HTTP headers give it (null without). A record that is cut off at the end of a file is left out.

Null payloads count as empty. Records without url or date get empty header values. An empty table writes no file and
reads as no rows. Rows that repeat a page write a record each.
"""

from __future__ import annotations

import gzip
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage,
)

from assayspark.session import released, settle

# Fixed values of the format: header names by column, in the order in which they are written.
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "profile": "WARC-Profile",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value of the encoding
SCHEMA = "record_type string, record_id string, target_uri string, date string, payload_digest string, refers_to string, profile string, payload_bytes long, payload binary"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary column in upper-case base32: four letters for every five hex digits."""
    hexed, letters = F.sha1(payload), []
    for group in range(8):
        bits = F.conv(F.substring(hexed, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.lit(BASE32).substr(F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _clean(value: str | None) -> str:
    """Header values are single lines."""
    return "" if value is None else value.replace("\r", " ").replace("\n", " ")


def record(headers: dict[str, str | None], payload: bytes | None, payload_bytes: int) -> bytes:
    """One record: an HTTP response, or for a revisit its headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block = http if headers["record_type"] == "revisit" else http + (payload or b"")
    lines = ["WARC/1.1"] + [f"{name}: {_clean(headers.get(c))}" for c, name in HEADERS.items() if headers.get(c) is not None]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class File(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    paths: list[tuple[str, str]] = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, records: int):
        self.path, self.records, self.job = path.rstrip("/"), records, uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, root = _open(self.path)
        done, out, n = Written(), None, 0
        for batch in batches:
            columns = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc"
                    store.create_dir(f"{root}/_{self.job}", recursive=True)
                    out = store.open_output_stream(f"{root}/_{self.job}/{name}", buffer_size=1 << 20)
                    done.paths.append((f"{root}/_{self.job}/{name}", f"{root}/{name}"))
                headers = {c: columns[c][i].as_py() for c in HEADERS}
                out.write(record(headers, columns["payload"][i].as_py(), columns["payload_bytes"][i].as_py()))
                n += 1
                if n % self.records == 0:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        for message in messages:
            for made, final in message.paths if message else ():
                store.move(made, final)
        self._sweep(store, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._sweep(*_open(self.path))

    def _sweep(self, store: fs.FileSystem, root: str) -> None:
        if store.get_file_info(f"{root}/_{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/_{self.job}")


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: str):
        self.path, self.decoded = path.rstrip("/"), set(payload.split(",")) - {""}
        self.accept: list[tuple[str, str, frozenset[str]]] = []  # column, "in" or "starts", values

    def pushFilters(self, filters):
        """Take predicates on headers; every other one stays with Spark."""
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo) and isinstance(f.value, str):
                self.accept.append((column, "in", frozenset([f.value])))
            elif column in HEADERS and isinstance(f, In) and all(isinstance(v, str) for v in f.value):
                self.accept.append((column, "in", frozenset(f.value)))
            elif column in HEADERS and isinstance(f, StringStartsWith):
                self.accept.append((column, "starts", frozenset([f.value])))
            else:
                yield f

    def partitions(self) -> list[File]:
        store, root = _open(self.path)
        info = store.get_file_info(root)
        if info.type == fs.FileType.File:
            return [File(root)]
        files = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return [File(f.path) for f in files if f.is_file and f.base_name.endswith((".warc", ".warc.gz"))]

    def wanted(self, headers: dict[str, str]) -> bool:
        for column, how, values in self.accept:
            value = headers.get(HEADERS[column])
            if value is None or not (value in values if how == "in" else value.startswith(tuple(values))):
                return False
        return True

    def read(self, part: File | None) -> Iterator[tuple]:
        if part is None:  # nothing was planned: the folder holds no archive
            return
        store, _ = _open(self.path)
        with store.open_input_file(part.path) as raw:
            stream = io.BufferedReader(raw, 1 << 20)
            yield from self.records(gzip.GzipFile(fileobj=stream) if part.path.endswith(".gz") else stream)

    def records(self, stream: io.BufferedIOBase) -> Iterator[tuple]:
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.endswith(b"\n"):
                return  # cut off
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no record begins with {line[:40]!r}")
            headers = _headers(stream)
            if not headers.get("Content-Length", "").isdigit():
                return  # cut off within its headers
            length, kind = int(headers["Content-Length"]), headers.get("WARC-Type")
            if not self.wanted(headers):
                stream.seek(length, io.SEEK_CUR)
                continue
            begin = stream.tell()
            end, http = begin + length, {}
            if headers.get("Content-Type", "").replace(" ", "").startswith("application/http") and length:
                block = io.BytesIO(stream.read(length)) if kind in self.decoded else stream
                if block.readline().strip():  # the HTTP status
                    http = _headers(block)
                held = length - block.tell() if block is not stream else end - stream.tell()
                payload = block.read() if block is not stream else None
            else:
                held, payload = length, stream.read(length) if kind in self.decoded else None
            stream.seek(end)
            if not stream.readline():
                return  # cut off: the empty lines that close a record are not there
            told = http.get("Content-Length", "")
            size = held if kind != "revisit" else int(told) if told.isdigit() else None
            yield (*[headers.get(name) for name in HEADERS.values()], size, payload)


def _headers(stream: io.BufferedIOBase) -> dict[str, str]:
    found = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip()] = value.strip()
    return found


class Warc(DataSource):
    """format("warc"). Options: path; records, the most in a written file; payload, the types of which blocks are decoded."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "response"))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("records", 2000)))


def register(spark: SparkSession) -> None:
    """Make the format known to the session, with filter pushdown for Python data sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Warc)


def records_of(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """A record per page. Of pages with equal payloads of at least `least` bytes the one with the largest id is the
    response and the others revisit it. Payloads are found equal by SHA-256; only digests are grouped. The groups of two
    or more are written once, so that their size is known when the pages are joined with them: few travel to the pages."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("same", F.when(F.length("payload") >= least, F.sha2("payload", 256)))
    first = rows.where("same is not null").groupBy("same").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    rows = rows.join(settle(first.select("same", "first"), "equal-payloads"), "same", "left")
    revisits = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return rows.select(
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")).alias("record_id"),
        F.coalesce("url", F.lit("")).alias("target_uri"), F.lit(date).alias("date"),
        F.concat(F.lit("sha1:"), base32_sha1(F.col("payload"))).alias("payload_digest"),
        F.when(revisits, F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))).alias("refers_to"),
        F.when(revisits, REVISIT).alias("profile"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.when(~revisits, F.col("payload")).alias("payload"),
    )


def write(records: DataFrame, path: str, per_file: int = 2000) -> None:
    register(records.sparkSession)
    with released(records.sparkSession):
        records.write.format("warc").mode("append").option("records", per_file).save(path)


def read(spark: SparkSession, path: str, payload: str = "response") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", payload).load(path)


def page_number(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
