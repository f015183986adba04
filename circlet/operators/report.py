"""Report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from circlet.operators.stats import control_rank, number_in
from circlet.params import Params


def _labelled() -> Column:
    return F.coalesce(F.trim("known_deletion_label"), F.lit("")) != ""


def target_ranks(clusters: DataFrame) -> DataFrame:
    """Per configured target its matches, support, best event and that event's rank among all.

    The rank is the number of events with more support (or the same support and a smaller id) plus
    one, counted against the few best events, so clusters are not sorted globally.
    """
    support = F.coalesce("total_supporting_reads", F.lit(0))
    matched = clusters.filter(_labelled())
    best = F.min_by(
        F.struct("exact_deletion_id", support.alias("n"), "left_breakpoint", "right_breakpoint", "deleted_size"),
        F.struct(-support, F.col("exact_deletion_id")),
    )
    per = matched.groupBy(F.col("known_deletion_label").alias("configured_deletion_target")).agg(
        F.count(F.lit(1)).alias("matching_exact_deletion_calls"), F.sum(support).alias("total_supporting_reads_across_matches"),
        best.alias("top"),
    )
    tops = per.select(F.col("top.exact_deletion_id").alias("_id"), F.col("top.n").alias("_n")).distinct()
    ahead = (support > F.col("_n")) | ((support == F.col("_n")) & (F.col("exact_deletion_id") < F.col("_id")))
    # `tops` has one row per configured target
    ranks = clusters.select("exact_deletion_id", "total_supporting_reads").join(F.broadcast(tops), ahead).groupBy("_id").agg(
        F.count(F.lit(1)).alias("_ahead")
    )
    overall = clusters.agg(F.max(support).alias("top_overall_exact_deletion_supporting_reads"))
    rank = F.coalesce("_ahead", F.lit(0)) + 1
    return (
        per.join(ranks, F.col("top.exact_deletion_id") == F.col("_id"), "left")
        .join(F.broadcast(overall), F.lit(True))
        .select(
            "configured_deletion_target", "matching_exact_deletion_calls", "total_supporting_reads_across_matches",
            F.col("top.exact_deletion_id").alias("top_matching_exact_deletion"),
            rank.alias("top_matching_rank_among_all_exact_deletions"), F.col("top.n").alias("top_matching_supporting_reads"),
            F.col("top.left_breakpoint").alias("top_left_breakpoint"), F.col("top.right_breakpoint").alias("top_right_breakpoint"),
            F.col("top.deleted_size").alias("top_deleted_size"), (rank == 1).alias("is_strongest"),
            "top_overall_exact_deletion_supporting_reads",
        )
    )


def default_order(table: DataFrame, ties: tuple[str, ...] = ("exact_deletion_id",)) -> list[Column]:
    """Sort keys for the columns the table has; configured targets and exclusive presence first."""
    have = set(table.columns)
    keys: list[Column] = []
    if "known_deletion_label" in have:
        keys.append((F.coalesce("known_deletion_label", F.lit("")) == "").asc())
    if "abundance_change" in have:
        keys.append((~F.coalesce("abundance_change", F.lit("")).startswith("present_only")).asc())
    for name in ("read_depth_fisher_q_value_bh", "read_depth_fisher_p", "q_value_bh", "p_value", "fisher_presence_p"):
        if name in have:
            keys.append(F.col(name).asc_nulls_last())
    for name in ("difference_per_million_mt_reads", "log2_fold_change_right_over_left"):
        if name in have:
            keys.append(F.abs(name).desc_nulls_last())
    for name in ("total_supporting_reads", "right_total_supporting_reads", "left_total_supporting_reads", "support_per_million_mt_reads",
                 "deletion_support_per_million_mt_reads", "unique_exact_deletions", "samples_with_signal", "deleted_size"):
        if name in have:
            keys.append(F.col(name).desc_nulls_last())
    return keys + [F.col(t) for t in ties if t in have]


def default_sort(table: DataFrame, ties: tuple[str, ...] = ("exact_deletion_id",)) -> DataFrame:
    return table.orderBy(*default_order(table, ties))


def display_table(clusters: DataFrame, p: Params) -> DataFrame:
    """Everything when it fits, else enough support or a configured target, up to the row cap."""
    if p.table_max_rows <= 0:
        return default_sort(clusters)
    total = clusters.agg(F.count(F.lit(1)).alias("_total"))
    include = F.coalesce("total_supporting_reads", F.lit(0)) >= p.table_min_reads
    if p.table_always_targets:
        include = include | _labelled()
    kept = clusters.join(F.broadcast(total), F.lit(True)).filter((F.col("_total") <= p.table_max_rows) | include).drop("_total")
    return default_sort(kept).limit(p.table_max_rows)


def display_counters(clusters: DataFrame, shown: DataFrame) -> DataFrame:
    """Rows, reads and target rows shown and in total, one row."""
    def counts(df, prefix):
        return df.agg(
            F.count(F.lit(1)).alias(f"{prefix}_rows"), F.coalesce(F.sum("total_supporting_reads"), F.lit(0)).alias(f"{prefix}_reads"),
            F.count_if(_labelled()).alias(f"{prefix}_target_rows"),
        )

    return counts(shown, "shown").join(counts(clusters, "total"), F.lit(True))


def group_counts(samples: DataFrame, group: str) -> DataFrame:
    """Samples per group in display order."""
    name = F.coalesce(F.col(group).cast("string"), F.lit("missing")).alias("group")
    both = {"age", "treatment"} <= set(samples.columns)
    extra = [F.min_by("age", "sample_ord").alias("age"), F.min_by("treatment", "sample_ord").alias("treatment")] if both else []
    table = samples.groupBy(name).agg(F.count(F.lit(1)).alias("sample_count"), *extra)
    order = [number_in(F.col("age")), control_rank(F.col("treatment"))] if both else []
    return table.orderBy(*order, "group")


SAMPLE_COLUMNS = ("sample_name", "biological_replicate", "dataset", "species", "layout", "condition", "deletion_status",
                  "age", "treatment", "tissue", "run_accession")


def compact_samples(samples: DataFrame, groups: list[str]) -> DataFrame:
    """The sample sheet cut to its descriptive columns."""
    names = [c for c in dict.fromkeys(("sample", *groups, *SAMPLE_COLUMNS)) if c in samples.columns]
    return samples.select(*names)


def evidence_composition(graded: DataFrame, enriched: DataFrame) -> DataFrame:
    """Clusters by evidence status and observations by evidence source."""
    a = graded.groupBy(F.coalesce("evidence_status", F.lit("unknown")).alias("name")).agg(F.count(F.lit(1)).alias("count"))
    b = enriched.groupBy(F.array_join("evidence_sources", ";").alias("name")).agg(F.count(F.lit(1)).alias("count"))
    return a.select(F.lit("cluster").alias("level"), "name", "count").unionByName(b.select(F.lit("observation").alias("level"), "name", "count"))


def disposition(candidates: DataFrame) -> DataFrame:
    """Source records by caller, status and reasons."""
    reason = F.when(F.size("filter_reason") == 0, "passed source filters").otherwise(F.array_join("filter_reason", ";"))
    return candidates.groupBy("evidence_source", "filter_status", reason.alias("filter_reason")).agg(F.count(F.lit(1)).alias("source_records"))


def circular_checks(clusters: DataFrame) -> DataFrame:
    """Events over the origin and configured-target matches, one row."""
    return clusters.agg(
        F.count_if("wraps_origin").alias("origin_spanning_exact_deletions"), F.count_if(_labelled()).alias("configured_target_matches")
    )


def headline(clusters: DataFrame, burden: DataFrame) -> DataFrame:
    """Events, supporting reads and mean burden, one row."""
    a = clusters.agg(F.count(F.lit(1)).alias("exact_deletions"), F.coalesce(F.sum("total_supporting_reads"), F.lit(0)).alias("supporting_reads"))
    b = burden.agg(F.avg(F.coalesce("deletion_support_per_million_mt_reads", F.lit(0.0))).alias("mean_burden"))
    return a.join(b, F.lit(True))
