"""Event clusters from leader assignments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from circlet.functions import coords as C
from circlet.operators.leader import assign_leaders
from circlet.operators.ranking import numbered

COORDINATE_ORDER = ("left_breakpoint", "right_breakpoint", "sample", "read_id", "rotation_name")
KEY = ("species", "leader_left", "leader_right")


def assign_clusters(rows: DataFrame, slop: int, length: int, order=COORDINATE_ORDER) -> DataFrame:
    """Rows with ``leader_left``/``leader_right``; (species, leader) is the cluster key.

    K05: the order is explicit. The remap path uses ``COORDINATE_ORDER``; the evidence path
    uses (sample, read_id, hypothesis).
    """
    order = [c for c in order if c in rows.columns]
    if slop <= 0:  # a coordinate leads itself; the join would only bring each row its own ends
        place = ["species", "left_breakpoint", "right_breakpoint"]
        own = rows.dropna(subset=place).withColumns({"leader_left": F.col("left_breakpoint"), "leader_right": F.col("right_breakpoint")})
        return own.select(*place, *[c for c in own.columns if c not in place])
    leaders = assign_leaders(rows, ["species"], "left_breakpoint", "right_breakpoint", order, slop, length)
    return rows.join(leaders, ["species", "left_breakpoint", "right_breakpoint"], "inner")


def support_rows(assigned: DataFrame, order=COORDINATE_ORDER) -> DataFrame:
    """The first row of every (sample, read) in a cluster; one fragment is one unit of support."""
    order = [c for c in order if c in assigned.columns]
    w = W.partitionBy(*KEY, "sample", "read_id").orderBy(*order)
    return assigned.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def _sorted_set(name: str):
    return F.array_sort(F.collect_set(F.col(name)))


def cluster_table(
    assigned: DataFrame, slop: int, length: int, min_support: int, order=COORDINATE_ORDER, version: str = "1"
) -> DataFrame:
    """Clusters with representative coordinates, support and provenance sets.

    The leader is the first row of its cluster, so medians are unwrapped around it.
    """
    support = support_rows(assigned, order).groupBy(*KEY).agg(
        F.percentile(C.unwrap("left_breakpoint", "leader_left", length), F.lit(0.5)).alias("_ml"),
        F.percentile(C.unwrap("right_breakpoint", "leader_right", length), F.lit(0.5)).alias("_mr"),
        F.count(F.lit(1)).alias("total_supporting_reads"),
        _sorted_set("sample").alias("supporting_samples"),
    )
    has = set(assigned.columns)
    provenance = [
        (_sorted_set("rotation_name") if "rotation_name" in has else F.array().cast("array<string>")).alias("rotations"),
        (_sorted_set("arc_assignment_method") if "arc_assignment_method" in has else F.array().cast("array<string>")).alias("_arcs"),
        (_sorted_set("direction_status") if "direction_status" in has else F.array().cast("array<string>")).alias("_statuses"),
    ]
    everything = assigned.groupBy(*KEY).agg(*provenance)
    joined = support.filter(F.col("total_supporting_reads") >= min_support).join(everything, list(KEY))
    placed = joined.withColumns(
        {
            "left_breakpoint": C.wrap_median("_ml", length),
            "right_breakpoint": C.wrap_median("_mr", length),
        }
    )
    record = C.directed_record("left_breakpoint", "right_breakpoint", length)
    out = placed.withColumns(record)

    def joined_or(name, default):
        return F.when(F.size(name) > 0, F.array_join(name, ";")).otherwise(default)

    return out.select(
        *KEY,
        C.deletion_id("left_breakpoint", "right_breakpoint", "deleted_size").alias("exact_deletion_id"),
        C.breakpoint_pair_id("left_breakpoint", "right_breakpoint").alias("breakpoint_pair_id"),
        "left_breakpoint", "right_breakpoint", *record,
        joined_or("_arcs", "alignment_directed").alias("arc_assignment_method"),
        joined_or("_statuses", "directed").alias("direction_status"),
        F.lit(version).alias("result_schema_version"),
        "total_supporting_reads",
        F.size("supporting_samples").alias("samples_with_signal"),
        "supporting_samples", "rotations",
        F.size("rotations").alias("rotation_count"),
        F.when(F.size("rotations") > 1, "multiple_rotations").otherwise("single_rotation").alias("rotation_agreement"),
        F.lit(slop).alias("clustered_breakpoint_slop_bp"),
    )


def member_rows(assigned: DataFrame, clusters: DataFrame, order=COORDINATE_ORDER) -> DataFrame:
    """Support rows of kept clusters with representative values; own values become ``read_*``."""
    own = ("left_breakpoint", "right_breakpoint", "deleted_size")
    taken = [
        "exact_deletion_id", "breakpoint_pair_id", *own, "wraps_origin", "deleted_interval",
        "complement_deleted_size", "complement_wraps_origin", "arc_assignment_method", "direction_status",
        "rotation_agreement", "result_schema_version",
    ]
    rows = support_rows(assigned, order).withColumnsRenamed({c: f"read_{c}" for c in own})
    rows = rows.drop(*taken, "deletion_id")
    return rows.join(clusters.select(*KEY, *taken), list(KEY))


def id_map(members: DataFrame) -> DataFrame:
    """(sample, read) -> event id."""
    reported = [c for c in ("reported_left_breakpoint", "reported_right_breakpoint") if c in members.columns]
    return members.select(
        "sample", "read_id", "exact_deletion_id", "breakpoint_pair_id", "left_breakpoint", "right_breakpoint",
        *reported, "direction_status", "result_schema_version",
    )


def duplicate_representatives(clusters: DataFrame) -> DataFrame:
    """Event ids shared by more than one cluster: medians of two clusters can coincide."""
    return clusters.groupBy("species", "exact_deletion_id").count().filter("count > 1")


def numbered_clusters(rows: DataFrame, slop: int, length: int, min_support: int) -> DataFrame:
    """Clusters that keep the leader's coordinates and get a number in leader order.

    Leaders come out in (species, left, right) order, so the number is the rank of the leader.
    """
    reported = rows if "canonical_orientation" in rows.columns else rows.withColumn(
        "canonical_orientation", F.lit("alignment_directed")
    )
    assigned = assign_clusters(reported, slop, length)
    leaders = assigned.select(*KEY).distinct()
    numbered_leaders = numbered(leaders, list(KEY), "number").withColumn("junction_id", F.format_string("mtDelJunc_%06d", F.col("number")))
    support = assigned.groupBy(*KEY).agg(
        F.count_distinct("sample", "read_id").alias("total_supporting_reads"),
        _sorted_set("sample").alias("supporting_samples"),
        _sorted_set("rotation_name").alias("rotations"),
        _sorted_set("canonical_orientation").alias("orientations"),
    )
    return (
        support.filter(F.col("total_supporting_reads") >= min_support)
        .join(numbered_leaders, list(KEY))
        .select(
            "junction_id", "species",
            F.col("leader_left").alias("left_breakpoint"), F.col("leader_right").alias("right_breakpoint"),
            C.directed_gap("leader_left", "leader_right", length).alias("deleted_size"),
            "total_supporting_reads", F.size("supporting_samples").alias("samples_with_signal"),
            "supporting_samples", "rotations", F.size("rotations").alias("rotation_count"), "orientations",
        )
    )
