"""Line deduplication by a range-partitioned, streamed sort of line hashes.

Every line becomes (128-bit hash of its key, document, position). The rows are range-partitioned and sorted by hash, then
document, then position, so one frequent line spreads over as many partitions as it needs. Each partition streams
through once: the first document of a hash keeps its lines, later documents lose theirs. Only the first run of a
partition may continue an earlier one; it is settled afterwards against the last hashes of all partitions (one row per
partition). The result is a compressed keep bitmap per document; texts do not travel with the lines.

Defined cases: a null or empty text is one empty line. Lines are split at ``\\n`` only. A key is the line without blanks
(space, 9 to 13) at both ends, A-Z lower-cased; keys under ``min_chars`` code points always stay. All lines of the
smallest document stay, however often it repeats them. Rows that repeat a doc_id count as that one document. A row
with a null id keeps all its lines and takes none from others. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circlet.llm.common import BLANKS, SLICE_ROWS, lean_worker, lower_ascii, materialize

MIN_CHARS = 10
DROPPED, OPEN, TAIL = 0, 1, 2


def line_key(line: Column) -> Column:
    return lower_ascii(F.trim(line, F.lit(BLANKS)))


def line_count(text: Column) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("bigint")


def line_hashes(docs: DataFrame, id_column: str, text_column: str, min_chars: int) -> DataFrame:
    lines = docs.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("doc_id"), F.posexplode(F.split(F.coalesce(F.col(text_column), F.lit("")), "\n", -1)).alias("pos", "line")
    )
    keyed = lines.select("doc_id", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"), "doc_id", "pos")


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First occurrences over one sorted partition, batch by batch."""
    lean_worker()
    last, first_doc, head = None, None, True
    for pdf in batches:
        if pdf.empty:
            continue
        h1, h2, doc = (pdf[c].to_numpy() for c in ("h1", "h2", "doc_id"))
        new = np.ones(len(pdf), dtype=bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        if last is not None:
            new[0] = (h1[0], h2[0]) != last
        if last is not None and new[0]:
            head = False
        run = np.cumsum(new) - 1  # -1: goes on from the batch before
        starts = doc[new]
        first = np.where(run >= 0, starts[np.maximum(run, 0)] if len(starts) else doc, first_doc if first_doc is not None else 0)
        in_head = (run <= 0 if last is None else run < 0) & head
        dropped = doc != first
        state = np.where(dropped, DROPPED, OPEN)
        out = dropped | in_head
        yield pd.DataFrame({"h1": h1[out], "h2": h2[out], "doc_id": doc[out], "pos": pdf["pos"].to_numpy()[out], "state": state[out].astype(np.int8)})
        if run[-1] > 0 or (run[-1] == 0 and last is not None):
            head = False
        last, first_doc = (h1[-1], h2[-1]), first[-1]
    if last is not None:
        yield pd.DataFrame({"h1": [last[0]], "h2": [last[1]], "doc_id": [first_doc], "pos": [-1], "state": np.array([TAIL], np.int8)})


def dropped_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, pos) of every line that goes."""
    hashes = materialize(line_hashes(docs, id_column, text_column, min_chars), "line-hashes")  # read twice: for the ranges, then for the shuffle
    order = ["h1", "h2", "doc_id", "pos"]
    ranged = hashes.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType(
        [T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), hashes.schema["doc_id"], T.StructField("pos", T.IntegerType()), T.StructField("state", T.ByteType())]
    )
    marks = materialize(ranged.mapInPandas(_stream, schema), "line-marks")
    tails = marks.where(F.col("state") == TAIL).groupBy("h1", "h2").agg(F.min("doc_id").alias("earlier"))  # a row per partition at most
    opened = marks.where(F.col("state") == OPEN).join(F.broadcast(tails), ["h1", "h2"], "left")
    late = opened.where(F.col("earlier") < F.col("doc_id"))
    return marks.where(F.col("state") == DROPPED).select("doc_id", "pos").unionByName(late.select("doc_id", "pos"))


def pack_bits(n_lines: int, dropped) -> bytes:
    """Keep bitmap of a document, deflated: bit i (least first) is 1 if line i stays."""
    keep = np.ones(n_lines, dtype=np.uint8)
    if dropped is not None and len(dropped):
        keep[np.asarray(dropped, dtype=np.int64)] = 0
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1)


def unpack_bits(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines, bitorder="little").astype(bool)


def line_bitmaps(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, n_lines, n_dropped, keep_bitmap of every document."""
    gone = dropped_lines(docs, id_column, text_column, min_chars).groupBy("doc_id").agg(F.collect_set("pos").alias("gone"))
    sizes = docs.select(F.col(id_column).alias("doc_id"), line_count(F.coalesce(F.col(text_column), F.lit(""))).alias("n_lines"))

    @F.pandas_udf("binary")
    def packed(n: pd.Series, lost: pd.Series) -> pd.Series:
        return pd.Series([pack_bits(int(a), b) for a, b in zip(n, lost)], dtype=object)

    joined = sizes.join(gone, "doc_id", "left")
    return joined.select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"), packed("n_lines", "gone").alias("keep_bitmap"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped and the kept text of every document."""
    texts = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))

    def kept(text: str, size: int, gone: int, bits: bytes) -> str:
        if not gone:
            return text
        return "\n".join(line for line, keep in zip(text.split("\n"), unpack_bits(bits, size)) if keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        for batch in (whole.slice(i, SLICE_ROWS) for whole in batches for i in range(0, whole.num_rows, SLICE_ROWS)):
            doc_id, n_lines, n_dropped, text, bitmap = batch.columns
            made = pa.array(map(kept, text.to_pylist(), n_lines.to_pylist(), n_dropped.to_pylist(), bitmap.to_pylist()), type=pa.string())
            yield pa.RecordBatch.from_arrays([doc_id, n_lines, n_dropped, made], names=["doc_id", "n_lines", "n_dropped", "kept_text"])

    masks = bitmaps.dropDuplicates(["doc_id"]).where(F.col("doc_id").isNotNull()).hint("shuffle_hash")
    joined = texts.join(masks, "doc_id", "left").select(
        "doc_id", F.coalesce(F.col("n_lines"), line_count(F.col("text"))).alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"), "text", "keep_bitmap"
    )
    return joined.mapInArrow(run, T.StructType([*[joined.schema[c] for c in ("doc_id", "n_lines", "n_dropped")], T.StructField("kept_text", T.StringType())]))
