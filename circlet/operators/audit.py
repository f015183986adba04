"""Invariants and worked examples over the event tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from circlet.functions import coords as C
from circlet.operators.clusters import assign_clusters, cluster_table
from circlet.params import Params

MEMBER_KEY = ["species", "leader_left", "leader_right"]


def table_checks(tables: dict[str, DataFrame], length: int) -> DataFrame:
    """Size, sign and wrap-rule mismatches per table. What is missing on one side is a mismatch; a missing size always is."""
    left, right, size = F.col("left_breakpoint"), F.col("right_breakpoint"), F.col("deleted_size")
    expected = right <= left
    parts = []
    for name, df in tables.items():
        observed = F.coalesce(F.col("wraps_origin"), F.lit(False)) if "wraps_origin" in df.columns else expected
        parts.append(
            df.agg(
                F.count(F.lit(1)).alias("rows"),
                F.count_if(size.isNull() | ~size.eqNullSafe(C.directed_gap(left, right, length))).alias("size_mismatches"),
                F.count_if(size < 0).alias("negative_sizes"),
                F.count_if(~observed.eqNullSafe(expected)).alias("wrap_rule_mismatches"),
                F.count_if(expected).alias("origin_spanning_rows"),
            ).select(F.lit(name).alias("table"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


def _differs() -> Column:
    same = [F.col(f"read_{c}").eqNullSafe(F.col(c)) for c in ("left_breakpoint", "right_breakpoint", "deleted_size")]
    return ~(same[0] & same[1] & same[2])


def read_mismatches(members: DataFrame) -> DataFrame:
    """How many member rows differ from their representative."""
    return members.agg(
        F.count(F.lit(1)).alias("read_rows_with_cluster"),
        F.count_if(_differs()).alias("read_rows_different_from_cluster_representative"),
        F.coalesce(F.avg(_differs().cast("double")), F.lit(0.0)).alias("fraction_different"),
    )


def mismatch_examples(members: DataFrame, rows: int = 20) -> DataFrame:
    """The first examples in (sample, read, event) order."""
    columns = ["sample", "read_id", "exact_deletion_id", "rotation_name", "read_left_breakpoint", "read_right_breakpoint",
               "read_deleted_size", "left_breakpoint", "right_breakpoint", "deleted_size"]
    return members.filter(_differs()).select(*columns).orderBy(*columns).limit(rows)


def round_trip(spark: SparkSession, p: Params, positions: DataFrame | None = None) -> DataFrame:
    """Standard -> rotated -> standard over positions x rotations.

    Without ``positions``, the fixed set around the origin and the half rotation is used.
    """
    length, starts = p.length, p.rotation_starts
    if positions is None:
        half = starts.get("half", length // 2 + 1)
        fixed = sorted({1, 2, length - 1, length, half - 2, half - 1, half, half + 1})
        positions = spark.createDataFrame([(x,) for x in fixed], "standard_position int")
    turns = F.array(*[F.struct(F.lit(n).alias("rotation_name"), F.lit(s).alias("rotation_start")) for n, s in starts.items()])
    spread = positions.select("standard_position", F.inline(turns))
    out = spread.withColumn("rotated_position", C.rotated_pos("standard_position", length, F.col("rotation_start")))
    out = out.withColumn("back_to_standard", C.normalize_pos("rotated_position", length, F.col("rotation_start")))
    return out.withColumn("roundtrip_pass", F.col("back_to_standard") == F.col("standard_position"))


def recluster_check(raw: DataFrame, p: Params) -> DataFrame:
    """Cluster raw calls again and check the result."""
    clusters = cluster_table(assign_clusters(raw, p.slop, p.length), p.slop, p.length, p.min_support)
    checks = table_checks({"corrected merge from raw rotated calls": clusters}, p.length)
    return checks.withColumns({"breakpoint_slop_bp": F.lit(p.slop), "min_split_read_support": F.lit(p.min_support)})


def worked_examples(raw: DataFrame, members: DataFrame, p: Params) -> DataFrame:
    """The first row (by sample, read, event) of each kind of call, with sizes recomputed.

    "Near the rotated boundary" takes the call whose raw ends come closest to the ends of the
    rotated reference. One aggregate over the calls finds all kinds.
    """
    length = p.length
    fields = ("sample", "read_id", "rotation_name", "rotation_start", "raw_left_breakpoint", "raw_right_breakpoint",
              "left_breakpoint", "right_breakpoint", "wraps_origin", "deleted_size")
    row = F.struct(*fields)
    order = F.struct("sample", "read_id", "deletion_id", "rotation_name")
    normal, half, wraps = F.col("rotation_name") == "normal", F.col("rotation_name") == "half", F.col("wraps_origin")

    def edge(name):
        return F.least(F.abs(name), F.abs(F.col(name) - length))

    boundary = F.least(edge("raw_left_breakpoint"), edge("raw_right_breakpoint"))
    kinds = {
        "normal deletion from standard alignment": (normal & ~wraps, order),
        "normal deletion from offset alignment": (half & ~wraps, order),
        "origin-spanning deletion from offset alignment": (half & wraps, order),
        "deletion near offset-reference boundary": (half & ~wraps, F.struct(boundary.alias("d"), order.alias("o"))),
    }
    picks = raw.agg(*[F.min_by(F.when(test, row), F.when(test, by)).alias(f"k{i}") for i, (test, by) in enumerate(kinds.values())])
    listed = F.array(*[F.struct(F.lit(name).alias("example"), F.col(f"k{i}").alias("row")) for i, name in enumerate(kinds)])
    out = picks.select(F.inline(listed)).filter("row is not null").select("example", "row.*")
    both = members.groupBy(*MEMBER_KEY).agg(
        F.count_distinct("rotation_name").alias("n"), F.min("exact_deletion_id").alias("id"),
        F.min_by(F.struct(*fields), F.struct("sample", "read_id", "rotation_name")).alias("row"),
    ).filter("n > 1")
    merged = both.agg(F.min_by("row", F.struct("id", *MEMBER_KEY)).alias("row")).filter("row is not null").select(
        F.lit("merged call detected in both alignments").alias("example"), "row.*"
    )
    examples = out.unionByName(merged)
    recomputed = C.directed_gap("left_breakpoint", "right_breakpoint", length)
    return examples.withColumns(
        {
            "raw_left_converted_to_standard": C.normalize_pos("raw_left_breakpoint", length, F.col("rotation_start")),
            "raw_right_converted_to_standard": C.normalize_pos("raw_right_breakpoint", length, F.col("rotation_start")),
            "deleted_size_recomputed": recomputed,
            "size_matches": F.col("deleted_size") == recomputed,
            "deleted_interval": C.interval_text("left_breakpoint", "right_breakpoint", length),
        }
    )


def view_violations(locations: DataFrame, comparison: DataFrame) -> DataFrame:
    """Rows of the view tables that break their rules; empty when all is well."""
    a = locations.filter("exact_deletion_id is null or not coalesce(plot_support > 0, false)")
    b = comparison.filter(
        "exact_deletion_id is null or not coalesce(total_supporting_observations >= 1, false)"
        " or not coalesce(absolute_difference >= 0, false)"
    )
    return a.select(F.lit("locations").alias("table"), "exact_deletion_id").unionByName(
        b.select(F.lit("comparison").alias("table"), "exact_deletion_id")
    )
