"""FASTQ records as a table."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from circlet.functions import reads as R

_FOLDED = "path string, record_no bigint, header string, seq string, qual string"


def _fold(batches):
    """Four lines make a record; what is left of a batch goes on to the next, files stay apart.

    A last record that ends early is kept with what it has.
    """
    current, pending, number = None, [], 0

    def record(lines):
        return (current, number, *lines[:2], *[None] * (2 - len(lines)), lines[3] if len(lines) > 3 else None)

    for pdf in batches:
        out = []
        for path, line in zip(pdf["path"], pdf["value"]):
            if path != current:
                if pending:
                    out.append(record(pending))
                current, pending, number = path, [], 0
            pending.append(line)
            if len(pending) == 4:
                out.append(record(pending))
                pending, number = [], number + 1
        yield pd.DataFrame(out, columns=["path", "record_no", "header", "seq", "qual"])
    if pending:
        yield pd.DataFrame([record(pending)], columns=["path", "record_no", "header", "seq", "qual"])


def _by_line_number(lines: DataFrame) -> DataFrame:
    """Records of splittable files: lines are numbered per file from the line counts of its blocks."""
    placed = lines.select(
        "value", "path", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
    )
    blocks = placed.groupBy("path", "block").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    line = F.col("offset") + F.col("row") - F.col("first")
    numbered = placed.join(offsets, ["path", "block"]).select("path", "value", F.floor(line / 4).alias("record_no"), (line % 4).alias("part"))
    part = lambda i: F.max(F.when(F.col("part") == i, F.col("value")))
    return numbered.groupBy("path", "record_no").agg(part(0).alias("header"), part(1).alias("seq"), part(3).alias("qual"))


def read_fastq(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(sample, read_id, mate, record_no, seq, qual), sequences in upper case.

    Compressed files cannot be split, so one task reads a file in order and folds lines in place.
    Plain files are split, numbered by block and regrouped. File names end in ``_R1`` or ``_R2``
    before the extension. The id is the first word of the header. A last record without all its lines
    is kept: what is missing is empty (the sequence) or null (the quality). Files are told apart by their whole path.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    packed = [p for p in paths if p.endswith(".gz")]
    plain = [p for p in paths if not p.endswith(".gz")]
    parts = []
    if packed:
        lines = spark.read.text(packed).select("value", F.col("_metadata.file_path").alias("path"))
        parts.append(lines.mapInPandas(_fold, _FOLDED))
    if plain:
        lines = spark.read.text(plain).withColumn("path", F.col("_metadata.file_path"))
        parts.append(_by_line_number(lines).select("path", "record_no", "header", "seq", "qual"))
    records = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return fastq_columns(records)


def fastq_columns(records: DataFrame) -> DataFrame:
    """Sample, id and mate of records with ``path``, ``record_no``, ``header``, ``seq`` and ``qual``."""
    records = records.where(F.trim("header") != "")
    stem = F.regexp_replace(F.url_decode(F.element_at(F.split("path", "/"), -1)), "(\\.mt_evidence)?\\.(fastq|fq)(\\.gz)?$", "")
    mate = F.regexp_extract(stem, "_(R[12])$", 1)
    return records.select(
        F.regexp_replace(stem, "_R[12]$", "").alias("sample"),
        R.first_word(F.substring("header", 2, 1 << 30)).alias("read_id"),
        F.when(mate == "", "R1").otherwise(mate).alias("mate"), "record_no", F.upper(F.trim(F.coalesce("seq", F.lit("")))).alias("seq"), "qual",
    )


def record_counts(reads: DataFrame) -> DataFrame:
    """Records per (sample, mate)."""
    return reads.groupBy("sample", "mate").agg(F.count(F.lit(1)).alias("records"))


def fragments(reads: DataFrame) -> DataFrame:
    """Fragments per sample are the records of the first mate."""
    return record_counts(reads).filter("mate = 'R1'").select("sample", F.col("records").alias("fragments"))
