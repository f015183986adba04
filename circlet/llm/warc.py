"""Converter from legacy ARC archives to WARC, and readers of both.

ARC: a version block names the version; every record is one header line, whose fields depend on the version (1: URL, IP,
date, type, length; 2: also result code, checksum, location, offset, file name), then as many bytes as the last field
declares. Each record becomes a WARC record with an identifier (UUID from id and address), an ISO date from the 14
digits, the type ``response`` or ``revisit``, and SHA-1 digests of payload and block. Of equal payloads of at least
``REVISIT_BYTES`` bytes the one with the largest id is the response; the others revisit it without carrying the bytes.

Archives are written by the tasks into the shared folder, each in a file named by the task attempt, one gzip member a
record, closed at ``ARCHIVE_BYTES``. The manifest of complete files is a table that Spark commits, so what a lost
executor left half-written is never read. Reading back streams each archive by declared lengths.

Defined cases: null html is an empty payload; a null or empty address is ``about:blank``, blanks inside it are
percent-encoded; rows that repeat an id revisit by content like any others; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from circlet.llm.common import attach_group, materialize, shared_dir, small_batches

REVISIT_BYTES = 1000
ARC_BYTES = 4 << 20
ARCHIVE_BYTES = 64 << 20
ARC_FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "result", "checksum", "location", "offset", "filename", "length"),
}  # fixed: header lines of the two versions
ROW_HEADER = "X-Source-Row"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORDS = "page_id bigint, url string, ip string, date string, mime string, http binary, payload binary, sha1 string, sha256 string, bytes bigint"


# ---- ARC ------------------------------------------------------------------------------------


def arc_header(version: int, fields: dict[str, str]) -> bytes:
    return " ".join(str(fields.get(name) or "-") for name in ARC_FIELDS[version]).encode() + b"\n"


def arc_start(version: int, name: str, date: str) -> bytes:
    """The version block that opens an ARC file."""
    body = f"{version} 0 circlet\n{' '.join(n for n in ARC_FIELDS[version])}\n\n".encode()
    return arc_header(version, {"url": f"filedesc://{name}", "ip": "0.0.0.0", "date": date, "mime": "text/plain", "result": "200", "length": str(len(body))}) + body + b"\n"


def arc_record(version: int, url: str, ip: str, date: str, mime: str, body: bytes) -> bytes:
    return arc_header(version, {"url": url, "ip": ip, "date": date, "mime": mime, "result": "200", "length": str(len(body))}) + body + b"\n"


def parse_arc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and body of every record; the version block sets the fields that are expected."""
    version = None
    while line := stream.readline():
        if not line.strip():
            continue
        parts = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        body = stream.read(int(parts[-1]))
        if len(body) != int(parts[-1]):
            raise ValueError("an ARC record is shorter than it declares")
        if version is None:
            version = int(body.split(b" ", 1)[0])
            if version not in ARC_FIELDS or not parts[0].startswith("filedesc://"):
                raise ValueError("an ARC file must open with a version block")
            continue
        names = ARC_FIELDS[version]
        if len(parts) != len(names):
            raise ValueError(f"version {version} has {len(names)} fields, not {len(parts)}")
        yield dict(zip(names, parts)), body


def _address(url) -> str:
    return "".join(f"%{b:02X}" if b <= 32 or b == 127 else chr(b) for b in str(url).encode()).encode("latin-1").decode("utf-8") if isinstance(url, str) and url else "about:blank"


def arc_files(pages: DataFrame) -> DataFrame:
    """Pages as ARC files of a few MB each; even ids make files of version 1, odd ones of version 2."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            buffers: dict[int, bytearray] = {}
            for page_id, url, html in zip(pdf.page_id, pdf.url, pdf.html):
                number = None if pd.isna(page_id) else int(page_id)
                version = 1 + (number or 0) % 2
                payload = html.encode("utf-8") if isinstance(html, str) else b""
                date = f"2001{1 + (number or 0) % 12:02d}{1 + (number or 0) % 28:02d}{(number or 0) % 24:02d}0000"
                row = "" if number is None else str(number)
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{ROW_HEADER}: {row}\r\n\r\n".encode()
                if version not in buffers:
                    buffers[version] = bytearray(arc_start(version, f"pages-{row}.arc", date))
                buffers[version] += arc_record(version, _address(url), "0.0.0.0", date, "text/html", http + payload)
                if len(buffers[version]) >= ARC_BYTES:
                    yield pd.DataFrame({"version": [version], "content": [bytes(buffers.pop(version))]})
            for version, data in buffers.items():
                yield pd.DataFrame({"version": [version], "content": [bytes(data)]})

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInPandas(build, "version int, content binary")


def arc_records(files: DataFrame) -> DataFrame:
    """Parsed records of ARC files with the digests of their payloads."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        for pdf in batches:
            rows, size = [], 0
            for content in pdf.content:
                for fields, body in parse_arc(io.BytesIO(content)):
                    head, _, payload = body.partition(b"\r\n\r\n")
                    row = next((x.split(b":", 1)[1].strip() for x in head.split(b"\r\n") if x.startswith(ROW_HEADER.encode() + b":")), b"")
                    rows.append((int(row) if row else None, fields["url"], fields["ip"], fields["date"], fields["mime"], head + b"\r\n\r\n", payload,
                                 hashlib.sha1(payload).hexdigest(), hashlib.sha256(payload).hexdigest(), len(payload)))
                    size += len(payload)
                    if size > ARC_BYTES:
                        yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})
                        rows, size = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})

    return files.mapInPandas(parse, RECORDS)


# ---- WARC -----------------------------------------------------------------------------------


def record_id(row: str, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row} {url}')}>"


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(row: str, url: str, ip: str, date: str, http: bytes, payload: bytes, sha1: str, refers_to: str | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP headers and drops the payload."""
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(row, url)),
        ("WARC-Date", f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"), ("WARC-Target-URI", url),
        ("WARC-IP-Address", ip), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()),
        ("WARC-Block-Digest", _digest(block)), ("Source-Row", row),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("Refers-To-Source-Row", refers_to), ("Full-Payload-Length", str(len(payload)))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a WARC record must open with its version")
        fields: dict[str, str] = {}
        while (line := stream.readline()) and line.strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError("a WARC record is shorter than it declares")
        yield fields, block


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes the records as gzip members and returns the manifest: path, records, bytes."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        store, root = _open(folder)
        sink, path, count, size, number = None, "", 0, 0, 0

        def done():
            sink.close()
            return pd.DataFrame({"path": [path], "records": [count], "bytes": [size]})

        for pdf in batches:
            for row, url, ip, date, http, payload, sha1, target in zip(pdf.page_id, pdf.url, pdf.ip, pdf.date, pdf.http, pdf.payload, pdf.sha1, pdf.refers_to):
                if sink is None:
                    name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{number:04d}.warc.gz"
                    store.create_dir(root, recursive=True)
                    sink, path, count, size, number = store.open_output_stream(f"{root}/{name}"), f"{folder}/{name}", 0, 0, number + 1
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = warc_record("" if pd.isna(row) else str(int(row)), url, ip, date, bytes(http), bytes(payload), sha1, None if pd.isna(target) else str(int(target)))
                member = packer.compress(data) + packer.flush()
                sink.write(member)
                count, size = count + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    yield done()
                    sink = None
        if sink is not None:
            yield done()

    return records.mapInPandas(write, "path string, records bigint, bytes bigint")


class _Members(io.RawIOBase):
    """The bytes of a file of gzip members, one after another, without holding more than a block."""

    def __init__(self, source):
        self.source, self.inflate, self.left, self.data = source, None, b"", b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.data:
            if self.inflate is None or self.inflate.eof:
                self.left = (self.inflate.unused_data if self.inflate else b"") or self.left
                self.inflate = zlib.decompressobj(31)
            chunk = self.left or self.source.read(1 << 16)
            self.left = b""
            if not chunk:
                return 0
            self.data = self.inflate.decompress(chunk)
        n = min(len(buffer), len(self.data))
        buffer[:n], self.data = self.data[:n], self.data[n:]
        return n


def read_archives(manifest: DataFrame) -> DataFrame:
    """Records of the archives: page_id, url, type, payload (null in a revisit), lengths, digests, refers_to."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]

        def frame(rows):
            return pd.DataFrame(rows, columns=columns).astype({"page_id": "Int64", "refers_to": "Int64"})

        for pdf in batches:
            for path in pdf.path:
                store, name = _open(path)
                with store.open_input_stream(name) as source:
                    rows, size = [], 0
                    for fields, block in parse_warc(io.BufferedReader(_Members(source), 1 << 16)):
                        if fields["warc-block-digest"] != _digest(block):
                            raise ValueError(f"{path}: a block does not match its digest")
                        row, target = fields["source-row"], fields.get("refers-to-source-row")
                        payload = block.partition(b"\r\n\r\n")[2] if fields["warc-type"] == "response" else None
                        declared = base64.b32decode(fields["warc-payload-digest"][5:]).hex()
                        if payload is not None and hashlib.sha1(payload).hexdigest() != declared:
                            raise ValueError(f"{path}: a payload does not match its digest")
                        length = len(payload) if payload is not None else int(fields["full-payload-length"])
                        rows.append((int(row) if row else None, fields["warc-target-uri"], fields["warc-type"], payload, length, declared, int(target) if target else None))
                        size += len(block)
                        if size > ARC_BYTES:
                            yield frame(rows)
                            rows, size = [], 0
                    if rows:
                        yield frame(rows)

    schema = "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, payload_digest string, refers_to bigint"
    return manifest.select("path").repartition(max(1, manifest.count())).mapInPandas(read, schema)  # a task for each archive


def revisits(records: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, sha256, refers_to) of the records whose payload a record with a larger id carries."""
    narrow = materialize(records.where(F.col("bytes") >= least_bytes).select("page_id", "sha256"), "warc-digests")
    groups = narrow.groupBy("sha256").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = attach_group(narrow, groups, "sha256", "n", narrow.count())
    return pairs.where(F.col("page_id") != F.col("refers_to")).select("page_id", "sha256", "refers_to").dropDuplicates(["page_id", "sha256"])


def convert(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """ARC files of the pages, converted and written as WARC; returns the committed manifest."""
    with small_batches(pages.sparkSession):
        records = arc_records(arc_files(pages))
        pairs = revisits(records, least_bytes).hint("shuffle_hash")
        folder = f"{shared_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
        joined = records.select("page_id", "url", "ip", "date", "http", "payload", "sha1", "sha256").join(pairs, ["page_id", "sha256"], "left").drop("sha256")
        return materialize(write_archives(joined, folder), "warc-manifest")
