"""Exports that show only what was committed (S02, S16): a Spark data source that writes.

Tasks write files under names of their own and report them; the manifest is written once all have ended, from the reports of
the attempts that counted. Files of lost or repeated attempts lie beside and are in no manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from circlet.sources.ranges import BGZF_END, bgzf_block, open_path
from circlet.sources.tabular import text_form

FORMAT = "circlet_export"
MANIFEST = "id string, read_count bigint, read_list_file string"
BLOCK = 65_280


@dataclass
class Written(WriterCommitMessage):
    part: str | None
    files: int


class _File:
    """One export file, plain or in gzip blocks."""

    def __init__(self, folder: str, name: str, packed: bool):
        files, path = open_path(f"{folder}/{name}")
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.name, self.packed, self.rows, self.rest, self.out = name, packed, 0, bytearray(), files.open_output_stream(path, compression=None)

    def write(self, line: str) -> None:
        self.rest += line.encode() + b"\n"
        if len(self.rest) >= BLOCK:
            self._flush(len(self.rest) // BLOCK * BLOCK)

    def _flush(self, size: int) -> None:
        for low in range(0, size, BLOCK):
            data = bytes(self.rest[low : min(low + BLOCK, size)])
            self.out.write(bgzf_block(data) if self.packed else data)
        del self.rest[:size]

    def close(self) -> None:
        self._flush(len(self.rest))
        if self.packed:
            self.out.write(BGZF_END)
        self.out.close()


class ExportWriter(DataSourceArrowWriter):
    def __init__(self, schema: StructType, options: dict):
        self.names, self.folder, self.job = schema.names, options["path"].rstrip("/"), options["job"]
        self.packed, self.header = options.get("packed") == "true", options.get("header") != "false"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """Rows come sorted by key: a new key ends the file of the one before."""
        attempt, listed, file, key = uuid.uuid4().hex, [], None, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if file is None or row[0] != key:
                    if file is not None:
                        file.close()
                        listed.append((key, file.rows, file.name))
                    key = row[0]
                    name = quote("" if key is None else str(key), safe="")[:120]
                    file = _File(self.folder, f"data/{attempt}/{len(listed)}-{name}.tsv{'.gz' if self.packed else ''}", self.packed)
                    if self.header:
                        file.write("\t".join(self.names[1:]))
                file.write("\t".join("" if v is None else str(v) for v in row[1:]))
                file.rows += 1
        if file is None:
            return Written(None, 0)
        file.close()
        listed.append((key, file.rows, file.name))
        part = _File(self.folder, f"parts/{self.job}-{attempt}.json", False)
        for key, rows, name in listed:
            part.write(json.dumps({"id": key, "read_count": rows, "read_list_file": name}))
        part.close()
        return Written(part.name, len(listed))

    def commit(self, messages: list[Written | None]) -> None:
        """The manifest names one list of files for each task; it appears in one step."""
        done = [m for m in messages if m is not None and m.part]
        text = json.dumps({"files": sum(m.files for m in done), "parts": sorted(m.part for m in done)})
        files, path = open_path(f"{self.folder}/manifest.json")
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with files.open_output_stream(f"{path}.{self.job}") as out:
            out.write(text.encode())
        files.move(f"{path}.{self.job}", path)

    def abort(self, messages: list[Written | None]) -> None:
        """Nothing to undo: without a manifest the files do not show."""


class ExportSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> ExportWriter:
        return ExportWriter(schema, dict(self.options))


def export_keyed(df: DataFrame, folder: str, key: str, columns: list[str], distinct: list[str] | None = None, packed: bool = False, header: bool = True) -> DataFrame:
    """Files of the rows of every key, duplicates removed and sorted inside; returns the manifest.

    Keys spread by range together with the rows' order, so a key of any size is written by several tasks, in
    one file each; the files of a key follow each other in the manifest's ``part``.
    """
    spark = df.sparkSession
    spark.dataSource.register(ExportSource)
    rows = df.select(key, *[c for c in columns if c != key])
    rows = rows.dropDuplicates(distinct) if distinct else rows.distinct()
    order = [key, *[c for c in columns if c != key]]
    texts = [F.col(key).cast("string").alias(key), *[text_form(rows, c).cast("string").alias(c) for c in order[1:]]]
    spread = rows.select(*texts).repartitionByRange(*order).sortWithinPartitions(*order)
    spread.write.format(FORMAT).mode("append").options(path=folder, job=uuid.uuid4().hex, packed=str(packed).lower(), header=str(header).lower()).save()
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """id, read_count, read_list_file of all files of the last committed export."""
    files, path = open_path(f"{folder.rstrip('/')}/manifest.json")
    with files.open_input_stream(path) as source:
        parts = json.loads(source.read())["parts"]
    listed = [f"{folder.rstrip('/')}/{p}" for p in parts]
    return spark.read.schema(MANIFEST).json(listed) if listed else spark.createDataFrame([], MANIFEST)


def write_documents(rows: DataFrame, folder: str) -> int:
    """Writes one file for each row (name, text), under just that name; returns their number.

    A repeated attempt writes the same bytes again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                files, path = open_path(f"{folder.rstrip('/')}/{name}")
                files.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with files.open_output_stream(path, compression=None) as out:
                    out.write(text.encode())
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["name"])

    named = rows.toDF("name", "text").mapInArrow(run, "name string")
    return named.count()
