"""Records of text files by byte ranges, compressed ones too (S03-S06): a Spark data source.

A file is cut into ranges; a partition holds consecutive ranges, so that small ones do not make a task each. Plain files are cut anywhere; files of the blocked gzip form (BGZF, which alignment tools write)
are cut at their blocks, which name their own size; any other gzip file is one range. A line belongs to the range that
holds the byte before it, so every range but the first drops the line it starts in and reads one line past its end.
FASTQ records are found by their shape: a line with ``@`` two lines before one with ``+``, around texts of equal length;
a quality line cannot pass for one, since two lines after it stands a sequence.

``place`` orders records inside their file: the byte offset, or block offset * 65536 + offset in the block.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "circlet_records"
LINES = "path string, place bigint, value string"
FASTQ = "path string, place bigint, header string, seq string, qual string"
CHUNK = 1 << 20
BEYOND = 1 << 16  # bytes of the first read past the end of a range
TASKS = 256  # partitions of a table at most, while none has more than TASK_BYTES
TASK_BYTES = 64 << 20
ROWS = 4096
BGZF_HEAD = b"\x1f\x8b\x08\x04"


@dataclass
class Range:
    path: str
    start: int
    end: int
    size: int
    form: str  # plain, blocks, whole

    def cut(self, step: int) -> Iterator[Range]:
        """Ranges of ``step`` bytes, from the first byte on."""
        for start in range(self.start, self.end, max(1, step)):
            yield replace(self, start=start, end=min(start + step, self.end))


@dataclass
class Stretch(InputPartition):
    """What one task reads: stretches of files, each cut into ranges of ``step`` bytes as it is read."""

    parts: list[Range]
    step: int


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def block_size(head: bytes) -> int:
    """Size of the BGZF block that begins with ``head`` (18 bytes), or 0 if none does."""
    if len(head) < 18 or head[:4] != BGZF_HEAD or head[12:16] != b"BC\x02\x00" or int.from_bytes(head[10:12], "little") < 6:
        return 0
    return int.from_bytes(head[16:18], "little") + 1


def bgzf_block(data: bytes) -> bytes:
    """One block of at most 65,280 bytes of text."""
    packed = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packed.compress(data) + packed.flush()
    size = len(body) + 25
    return BGZF_HEAD + b"\x00\x00\x00\x00\x00\xff\x06\x00BC\x02\x00" + size.to_bytes(2, "little") + body + zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little")


BGZF_END = bgzf_block(b"")


def _pieces(part: Range) -> Iterator[tuple[int, bytes]]:
    """(place of the first byte, bytes) of a range and what follows it."""
    files, name = open_path(part.path)
    with files.open_input_file(name) as source:
        if part.form == "plain":
            at, more = part.start, BEYOND
            source.seek(at)
            while data := source.read(min(CHUNK, part.end - at) if at < part.end else more):
                more = more if at < part.end else min(CHUNK, 2 * more)
                yield at, data
                at += len(data)
        elif part.form == "whole":
            unpack, at = zlib.decompressobj(31), 0
            while packed := source.read(CHUNK):
                while packed:
                    data = unpack.decompress(packed)
                    if data:
                        yield at, data
                        at += len(data)
                    packed = unpack.unused_data
                    if unpack.eof and packed:
                        unpack = zlib.decompressobj(31)
        else:
            at = _first_block(source, part.start, part.size)
            while at < part.size:
                source.seek(at)
                size = block_size(head := source.read(18))
                if not size:
                    raise ValueError(f"{part.path}: no block at byte {at}")
                data = zlib.decompress((head + source.read(size - 18))[18:-8], -15)
                yield at << 16, data
                at += size


def _first_block(source, start: int, size: int) -> int:
    """First block at or after a byte: its head, followed by another block or the end of the file."""
    at = start
    source.seek(at)
    data = source.read(1 << 17)
    place = 0
    while (place := data.find(BGZF_HEAD, place)) >= 0:
        length = block_size(data[place : place + 18])
        after = at + place + length
        if length and (after == size or after < size and block_size(source.read_at(18, after))):
            return at + place
        place += 1
    return size


def _lines(part: Range) -> Iterator[tuple[int, bytes, bool]]:
    """(place, line, whether it belongs to a later range) in order, without the line that the range starts in."""
    rest, rest_at, skip = b"", 0, part.start > 0
    last = part.end if part.form == "plain" and part.end < part.size else None  # a line may start here at the latest
    for at, data in _pieces(part):
        if part.form == "blocks" and last is None and at >> 16 >= part.end:
            last = at
        low = 0
        while (end := data.find(b"\n", low)) >= 0:
            begin, line = (rest_at, rest + data[low:end]) if rest else (at + low, data[low:end])
            rest, low = b"", end + 1
            if skip:
                skip = False
            else:
                yield begin, line, last is not None and begin > last
        if low < len(data):
            rest_at = rest_at if rest else at + low
            rest += data[low:]
    if rest and not skip:
        yield rest_at, rest, last is not None and rest_at > last


def _fastq(part: Range) -> Iterator[tuple[int, bytes, bytes | None, bytes | None]]:
    """Records of a range. The last record of a file may end early.

    Of such a record nothing but its header tells it from a quality line at the end of the file, if it has no more lines: it is one
    unless it stands under a lone ``+`` or at the very start of its range.
    """
    window: deque[tuple[int, bytes, bool]] = deque()
    synced, before = part.start == 0, b"+"
    for line in _lines(part):
        window.append((line[0], line[1].rstrip(b"\r"), line[2]))
        if len(window) < 4:
            continue
        header, seq, plus, qual = (x[1] for x in window)
        if not synced and not (header[:1] == b"@" and plus[:1] == b"+" and len(seq) == len(qual)):
            _, before, later = window.popleft()
            if later:
                return
            continue
        synced = True
        if window[0][2]:
            return
        yield window[0][0], header, seq, qual
        window.clear()
    while not synced and window:
        header, after = window[0][1], window[1][1] if len(window) > 1 else None
        if header[:1] == b"@" and (after is not None and after[:1] != b"@" or after is None and before != b"+"):
            break
        before = window.popleft()[1]
    if window and not window[0][2] and window[0][1].strip():
        yield window[0][0], window[0][1], window[1][1] if len(window) > 1 else None, None


class RecordReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = schema.names
        self.kind = options.get("kind", "lines")
        self.bytes = int(options.get("rangebytes", 64 << 20))
        self.paths = [p for p in options["paths"].split("\n") if p]

    def partitions(self) -> list[Stretch]:
        """Stretches of whole ranges from the sizes of the files; a compressed file is looked at for its first bytes only."""
        listed = []
        for path in self.paths:
            files, name = open_path(path)
            info = files.get_file_info(name)
            found = [info] if info.type == fs.FileType.File else files.get_file_info(fs.FileSelector(name, recursive=True))
            scheme = path[: path.index("://") + 3] if "://" in path else ""
            for file in sorted((f for f in found if f.type == fs.FileType.File and f.base_name[:1] not in "._"), key=lambda f: f.path):
                form = "plain"
                if file.base_name.endswith((".gz", ".bgz")):
                    with files.open_input_file(file.path) as source:
                        form = "blocks" if block_size(source.read(18)) else "whole"
                listed.append(Range(path if info.type == fs.FileType.File else scheme + file.path, 0, file.size, file.size, form))
        return self._stretches(listed) or [Stretch([], self.bytes)]

    def _stretches(self, files: list[Range]) -> list[Stretch]:
        """Whole ranges side by side: few bytes a task in a small table, TASK_BYTES in a large one."""
        step = max(1, self.bytes)
        wanted = min(TASK_BYTES, -(-sum(f.size for f in files) // TASKS))
        out, parts, held = [], [], 0
        for file in files:
            for part in [file] if file.form == "whole" else file.cut(max(1, wanted // step) * step):
                if parts and held + part.end - part.start > wanted:
                    out.append(Stretch(parts, step))
                    parts, held = [], 0
                if part.end > part.start:
                    parts, held = [*parts, part], held + part.end - part.start
        return [*out, Stretch(parts, step)] if parts else out

    def read(self, stretch: Stretch) -> Iterator[pa.RecordBatch]:
        for part in stretch.parts:
            rows: list[tuple] = []
            for one in [part] if part.form == "whole" else part.cut(stretch.step):
                for row in self._records(one):
                    rows.append(row)
                    if len(rows) == ROWS:
                        yield self._batch(part.path, rows)
                        rows = []
            if rows:
                yield self._batch(part.path, rows)

    def _records(self, part: Range) -> Iterator[tuple]:
        if self.kind == "fastq":
            yield from _fastq(part)
            return
        for place, line, later in _lines(part):
            if later:
                return
            yield place, line.rstrip(b"\r")

    def _batch(self, path: str, rows: list[tuple]) -> pa.RecordBatch:
        """Only the columns asked for become Arrow columns."""
        every = ["place", "header", "seq", "qual"] if self.kind == "fastq" else ["place", "value"]
        made = {"path": lambda: pa.array([path] * len(rows))}
        for i, name in enumerate(every):
            made[name] = (lambda: pa.array([r[0] for r in rows], pa.int64())) if i == 0 else lambda i=i: pa.array([None if r[i] is None else r[i].decode("utf-8", "replace") for r in rows], pa.string())
        return pa.RecordBatch.from_arrays([made[n]() for n in self.names], names=self.names)


class RecordSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return FASTQ if self.options.get("kind") == "fastq" else LINES

    def reader(self, schema: StructType) -> RecordReader:
        return RecordReader(schema, dict(self.options))


def read_ranges(spark: SparkSession, paths: str | list[str], kind: str = "lines", columns: list[str] | None = None, range_bytes: int = 64 << 20) -> DataFrame:
    """Lines (path, place, value) or FASTQ records (path, place, header, seq, qual) of files and folders.

    ``columns`` are the ones to read; the others are never decoded.
    """
    spark.dataSource.register(RecordSource)
    listed = [paths] if isinstance(paths, str) else list(paths)
    kinds = dict(c.strip().split() for c in (FASTQ if kind == "fastq" else LINES).split(","))
    schema = ", ".join(f"{c} {kinds[c]}" for c in (columns or kinds))
    return spark.read.format(FORMAT).schema(schema).options(kind=kind, paths="\n".join(listed), rangebytes=str(range_bytes)).load()
