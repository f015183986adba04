"""Reciprocal-direction conflicts across rotations and callers (Q09)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from circlet.functions import coords as C


def flag_conflicts(rows: DataFrame, slop: int, length: int | None) -> DataFrame:
    """Add ``in_conflict``: some other row of the same read runs the opposite way within slop.

    Without a length the coordinates lie on no circle, and only the exact reverse counts.

    Rows are reduced to distinct coordinates per read first, so copies cost nothing, and the
    self join is hashed on a coordinate bucket as well as the read: one read with very many
    rows still spreads over tasks, and the semi join stops at the first partner.
    """
    keys = ["sample", "read_id", "left_breakpoint", "right_breakpoint"]
    points = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    if not length:
        back = points.select("sample", "read_id", F.col("left_breakpoint").alias("right_breakpoint"), F.col("right_breakpoint").alias("left_breakpoint"))
        own = (F.col("left_breakpoint") != F.col("right_breakpoint")) | (F.col("copies") > 1)
        hit = points.filter(own).join(back, keys, "left_semi").select(*keys, F.lit(True).alias("in_conflict"))
        return rows.join(hit, keys, "left").withColumn("in_conflict", F.col("in_conflict").isNotNull())
    width = 2 * slop + 1
    count = max(1, length // width)

    def bucket(pos):
        return F.least(F.floor((pos - 1) / F.lit(width)), F.lit(count - 1)).cast("int")

    left = F.col("left_breakpoint")
    mine = points.withColumn("bucket", bucket(left))
    reach = [bucket(C.normalize_pos(F.col("other_right") + d, length)) for d in (-slop, slop)]
    other = points.select(
        F.col("sample").alias("other_sample"),
        F.col("read_id").alias("other_read"),
        F.col("left_breakpoint").alias("other_left"),
        F.col("right_breakpoint").alias("other_right"),
    ).withColumn("other_bucket", F.explode(F.array_distinct(F.array(*reach))))
    same_point = (left == F.col("other_left")) & (F.col("right_breakpoint") == F.col("other_right"))
    condition = (
        (F.col("sample") == F.col("other_sample"))
        & (F.col("read_id") == F.col("other_read"))
        & (F.col("bucket") == F.col("other_bucket"))
        & (C.circular_distance("left_breakpoint", "other_right", length) <= slop)
        & (C.circular_distance("right_breakpoint", "other_left", length) <= slop)
        & (~same_point | (F.col("copies") > 1))
    )
    hit = mine.join(other, condition, "left_semi").select(*keys, F.lit(True).alias("in_conflict"))
    return rows.join(hit, keys, "left").withColumn("in_conflict", F.col("in_conflict").isNotNull())


def split_conflicts(rows: DataFrame, slop: int, length: int | None) -> tuple[DataFrame, DataFrame]:
    """(accepted, ambiguous); ambiguous rows carry status ``ambiguous_across_rotations``."""
    flagged = flag_conflicts(rows, slop, length)
    if "breakpoint_pair_id" not in rows.columns:
        flagged = flagged.withColumn("breakpoint_pair_id", C.breakpoint_pair_id("left_breakpoint", "right_breakpoint"))
    accepted = flagged.filter(~F.col("in_conflict")).drop("in_conflict")
    ambiguous = (
        flagged.filter("in_conflict")
        .drop("in_conflict")
        .withColumn("direction_status", F.lit("ambiguous_across_rotations"))
    )
    return accepted, ambiguous
