"""Exact deduplication by two-pass Bloom filtering, in DataFrame functions only.

Pass one hashes every text to one bit in each half of a partitioned Bloom filter and keeps the bits that two or more rows
set. Only 8-byte slots move, summed in the map tasks first. Pass two probes the filter: a row whose two bits are both
set twice may repeat, and only such rows shuffle (as id and SHA-256). All others pass straight through. The exact
decision is made on SHA-256, so a false positive costs a little shuffle and changes nothing.

The broadcast filter has at most ``bits / 8`` bytes (16 MB at the default), whatever the input. When the rows outgrow
it, more of them take the exact way; raise ``bits`` (up to 2**32, 512 MB) for billions of documents.

Defined cases: a null text is the empty text. Rows with the same id and the same text are one document and come out
once. A null id is a document like others that never wins against a number. An empty table gives an empty result.
Names of other columns cannot clash: they travel inside one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from circlet.llm.common import attach_group, materialize

FILTER_BITS = 2**27
BLOCK_BITS = 32768  # what one bitmap of bitmap_construct_agg holds


def _slots(text: Column, bits: int) -> tuple[Column, Column]:
    half = bits // 2
    h = F.xxhash64(text)
    return h.bitwiseAND(F.lit(half - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(half - 1)) + F.lit(half)


def repeated_bits(texts: DataFrame, text: str, bits: int = FILTER_BITS) -> DataFrame:
    """The filter: bitmaps by block, with the bits that at least two rows set."""
    if bits & (bits - 1) or not 2 * BLOCK_BITS <= bits <= 2**32:
        raise ValueError("bits must be a power of two from 65536 to 2**32")
    slot = F.explode(F.array(*_slots(F.coalesce(F.col(text), F.lit("")), bits))).alias("slot")
    twice = texts.select(slot).groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.groupBy(F.shiftright("slot", 15).alias("block")).agg(
        F.bitmap_construct_agg(F.col("slot") % BLOCK_BITS).alias("bitmap")
    )


def _probe(rows: DataFrame, text: str, filt: DataFrame, bits: int) -> DataFrame:
    """Adds ``candidate``: whether both bits of the text were set twice."""
    out = rows
    for i, slot in enumerate(_slots(F.coalesce(F.col(text), F.lit("")), bits)):
        out = out.withColumn(f"slot{i}", slot)
        side = F.broadcast(filt.select(F.col("block").alias(f"block{i}"), F.col("bitmap").alias(f"bitmap{i}")))
        out = out.join(side, F.shiftright(f"slot{i}", 15) == F.col(f"block{i}"), "left")

    def bit(i: int) -> Column:
        place = F.col(f"slot{i}") % BLOCK_BITS
        byte = F.conv(F.hex(F.substring(F.col(f"bitmap{i}"), F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.coalesce(F.expr(f"bitmap{i} is not null") & (F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1), F.lit(False))

    return out.select(*rows.columns, (bit(0) & bit(1)).alias("candidate"))


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, candidate for every document."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    probed = _probe(rows, "text", repeated_bits(rows, "text", bits), bits)
    verdicts = materialize(probed.select("doc_id", F.sha2("text", 256).alias("text_sha256"), "candidate"), "exact-probe")
    alone = verdicts.where(~F.col("candidate")).select("doc_id", "text_sha256", "candidate", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"))
    maybe = verdicts.where("candidate").dropDuplicates(["text_sha256", "doc_id"])
    groups = maybe.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    grouped = attach_group(maybe, groups, "text_sha256", "group_size", verdicts.count())
    return alone.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "candidate"
    )


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """Whole rows of the documents that stay: rows that cannot repeat are not shuffled, nor are those of a very common text."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"), F.struct("*").alias("row"))
    probed = _probe(rows, "text", repeated_bits(rows, "text", bits), bits)
    alone = probed.where(~F.col("candidate")).select("row.*")
    maybe = probed.where("candidate").select("doc_id", F.sha2("text", 256).alias("sha"), "row")
    winners = maybe.groupBy("sha").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("size"))
    same = attach_group(maybe, winners, "sha", "size", docs.count()).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    kept = same.dropDuplicates(["sha"]).select("row.*")
    return alone.unionByName(kept)
