"""Evidence join, counts per label and normalisation."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from circlet.operators.evidence import reason_list
from circlet.params import Params

KEY = ("species", "leader_left", "leader_right")
LABELS = {
    "exact": "exact_deletion_id",
    "affected": "affected_feature_label",
    "impact": "feature_impact_class",
    "gene_pair": "gene_pair_label",
}
MILLION = 1_000_000.0


def evidence_join(members: DataFrame, clusters: DataFrame) -> DataFrame:
    """Read rows with the columns of their cluster; the cluster's value wins on a name clash.

    One row per (sample, read, event): the one with the larger anchor sum. Ties take the first
    rotation and source in name order. The row is chosen beside the few columns that this takes; the others of the
    cluster come to the rows that stay.
    """
    order = ("rotation_name", "source", "read_left_breakpoint", "read_right_breakpoint")
    taken = clusters.drop("supporting_samples")
    own = [c for c in members.columns if c in KEY or c not in clusters.columns]
    columns = [*KEY, *[c for c in own if c not in KEY], *[c for c in taken.columns if c not in KEY]]
    few = [c for c in ("exact_deletion_id", "left_anchor_length", "right_anchor_length", *order) if c in taken.columns]
    placed = members.select(*own).join(taken.select(*KEY, *few), list(KEY))
    anchors = F.coalesce("left_anchor_length", F.lit(0)) + F.coalesce("right_anchor_length", F.lit(0))
    ties = [c for c in order if c in placed.columns]
    w = W.partitionBy("sample", "read_id", "exact_deletion_id").orderBy(anchors.desc(), *ties, "leader_left", "leader_right")
    chosen = placed.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    return chosen.join(taken.drop(*few[1:]), [*KEY, "exact_deletion_id"]).select(*columns)


def is_expected(df: DataFrame) -> Column:
    if "junction_interpretation" not in df.columns:
        return F.lit(False)
    return F.coalesce(F.col("junction_interpretation") == "expected_transcript_junction", F.lit(False))


def drop_expected(evidence: DataFrame, p: Params) -> DataFrame:
    """A02."""
    return evidence.filter(~is_expected(evidence)) if p.exclude_expected_transcripts else evidence


def label_counts(evidence: DataFrame, samples: DataFrame, labels: dict[str, str] = LABELS, by=()) -> DataFrame:
    """(label_kind, sample, label, reads) for every label kind in one pass.

    Rows of unknown samples and null labels are left out. ``by`` adds grouping columns.
    """
    have = {k: c for k, c in labels.items() if c in evidence.columns}
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("label")) for k, c in have.items()])
    long = evidence.select("sample", *by, F.explode(pairs).alias("x")).filter("x.label is not null")
    counts = long.groupBy(*by, F.col("x.kind").alias("label_kind"), "sample", F.col("x.label").alias("label")).agg(
        F.count(F.lit(1)).alias("reads")
    )
    return counts.join(samples.select("sample"), "sample", "left_semi")


def profile_counts(evidence: DataFrame, samples: DataFrame, p: Params, labels: dict[str, str] = LABELS) -> DataFrame:
    """A03 for all report profiles at once: counted per tier, then each tier's counts go to its profiles."""
    per_tier = label_counts(evidence, samples, labels, by=("quality_tier",))
    member = F.array_compact(
        F.array(*[F.when(F.col("quality_tier").isin(*tiers), F.lit(name)) for name, tiers in p.profiles.items()])
    )
    return (
        per_tier.withColumn("profile", F.explode(member))
        .groupBy("profile", "label_kind", "sample", "label")
        .agg(F.sum("reads").alias("reads"))
    )


def denominator(samples: DataFrame, p: Params) -> Column:
    name = "total_usable_reads" if p.denominator == "total_usable_reads" else "reads_passed_to_minimap2"
    return F.col(name).cast("double")


def with_denominator(samples: DataFrame, p: Params) -> DataFrame:
    return samples.withColumns(
        {"normalization_denominator": F.lit(p.denominator), "normalization_reads": denominator(samples, p)}
    )


def per_million(reads: Column, reads_total: Column) -> Column:
    """A zero denominator gives 0."""
    return F.coalesce(reads / F.nullif(reads_total, F.lit(0.0)), F.lit(0.0)) * MILLION


def normalized(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """Counts with ``per_million`` by the samples' ``normalization_reads``."""
    joined = counts.join(samples.select("sample", "normalization_reads"), "sample")
    return joined.withColumn("per_million", per_million(F.col("reads"), F.col("normalization_reads"))).drop("normalization_reads")


def alternative_matrix(ids: DataFrame, clusters: DataFrame, samples: DataFrame, p: Params) -> DataFrame:
    """Long form of the raw, per-million-fragments, per-million-reads and presence matrices.

    Every (sample, event) pair is present; a zero denominator leaves null.
    """
    kept = clusters.filter(~is_expected(clusters)) if p.exclude_expected_transcripts else clusters
    events = kept.select("exact_deletion_id").distinct()
    counted = ids.groupBy("sample", "exact_deletion_id").agg(F.count(F.lit(1)).alias("n"))
    full = dense(events, samples.select("sample", "million_fragments", "million_mt_reads"))
    out = full.join(counted, ["sample", "exact_deletion_id"], "left").withColumn("raw", F.coalesce("n", F.lit(0)))
    return out.select(
        "sample", "exact_deletion_id", "raw",
        (F.col("raw") / F.nullif("million_fragments", F.lit(0.0))).alias("per_million_fragments"),
        (F.col("raw") / F.nullif("million_mt_reads", F.lit(0.0))).alias("per_million_mt_reads"),
        (F.col("raw") > 0).cast("int").alias("presence"),
    )


def dense(labels: DataFrame, samples: DataFrame, limit: int = 20_000) -> DataFrame:
    """Every label with every sample. The sample sheet is checked to be small and goes in as a constant."""
    rows = samples.limit(limit + 1).collect()
    if len(rows) > limit:
        return labels.join(samples, F.lit(True))
    kind = samples.schema.simpleString()
    names = samples.columns
    listed = F.from_json(F.lit(json.dumps([r.asDict() for r in rows])), f"array<{kind}>")
    return labels.withColumn("_s", F.explode(listed)).select(*labels.columns, *[F.col("_s")[n].alias(n) for n in names])


def wide_matrix(counts: DataFrame, samples: DataFrame, value: str = "reads") -> DataFrame:
    """Export form of A03: one row per sample, one column per label, zero filled.

    Spark refuses more label columns than ``spark.sql.pivotMaxValues``; ``wide_rows`` and the long form have no limit.
    """
    pivoted = counts.groupBy("sample").pivot("label").agg(F.sum(value))
    labels = [c for c in pivoted.columns if c != "sample"]
    return samples.join(pivoted, "sample", "left").na.fill(0, labels)


def burden(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """Support, normalised support and distinct labels per sample, from the long counts."""
    norm = normalized(counts, samples)
    exact, affected = F.col("label_kind") == "exact", F.col("label_kind") == "affected"
    per = norm.groupBy("sample").agg(
        F.sum(F.when(exact, F.col("reads"))).alias("deletion_supporting_reads"),
        F.sum(F.when(exact, F.col("per_million"))).alias("deletion_support_per_million_mt_reads"),
        F.count_if(exact & (F.col("reads") > 0)).alias("unique_exact_deletions"),
        F.count_if(affected & (F.col("reads") > 0)).alias("unique_affected_feature_categories"),
    )
    names = [c for c in per.columns if c != "sample"]
    return samples.join(per, "sample", "left").na.fill(0, names)


def feature_burden(evidence: DataFrame, samples: DataFrame, details: str = "per_feature_overlap_details") -> DataFrame:
    """Reads per (sample, feature), one per overlap token, with per-million support."""
    tokens = F.filter(F.split(F.coalesce(F.col(details), F.lit("")), ";"), lambda t: t != "")
    named = evidence.select("sample", F.explode(tokens).alias("t")).select(
        "sample", F.split_part("t", F.lit(":"), F.lit(1)).alias("feature")
    )
    counts = named.groupBy("sample", "feature").agg(F.count(F.lit(1)).alias("supporting_reads"))
    joined = counts.join(samples, "sample", "left")
    value = per_million(F.col("supporting_reads"), F.coalesce("normalization_reads", F.lit(0.0)))
    return joined.withColumn("support_per_million_mt_reads", value)


def qc_summary(samples: DataFrame, before: DataFrame, ambiguous: DataFrame, burden_table: DataFrame, p: Params) -> DataFrame:
    """A19 and A20. ``before`` is the evidence join before the expected-transcript filter."""
    expected = is_expected(before)
    kept = ~expected if p.exclude_expected_transcripts else F.lit(True)
    secondary = F.coalesce(F.col("left_is_secondary"), F.lit(False)) | F.coalesce(F.col("right_is_secondary"), F.lit(False))
    reads = before.groupBy("sample").agg(
        F.count(F.lit(1)).alias("clustered_split_read_alignments_before_transcript_filter"),
        F.count_if(expected).alias("expected_transcript_compatible_split_reads"),
        F.count_if(~expected).alias("candidate_deletion_split_reads_before_transcript_filter"),
        F.count_if(kept & secondary).alias("primary_calls_using_secondary_alignments"),
        F.count_if(kept & (F.coalesce("min_mapq", F.lit(1)) <= 0)).alias("primary_calls_with_min_mapq_zero"),
    )
    excluded = ambiguous.groupBy("sample").agg(
        F.count(F.lit(1)).alias("ambiguous_direction_records_excluded"),
        F.count_distinct("read_id").alias("ambiguous_direction_reads_excluded"),
    )
    support = burden_table.select("sample", "deletion_supporting_reads", "unique_exact_deletions")
    out = samples.select("sample", "total_usable_reads", "reads_passed_to_minimap2")
    for part in (reads, excluded, support):
        out = out.join(part, "sample", "left")
    out = out.na.fill(0, [c for c in out.columns if c not in ("sample", "total_usable_reads", "reads_passed_to_minimap2")])
    warnings = reason_list(
        (F.col("reads_passed_to_minimap2") == 0, "no_mitochondrial_evidence_reads"),
        (F.col("ambiguous_direction_reads_excluded") > 0, "ambiguous_direction_evidence_excluded"),
        (F.col("primary_calls_using_secondary_alignments") > 0, "secondary_alignments_in_primary_calls"),
        (F.col("primary_calls_with_min_mapq_zero") > 0, "mapq_zero_alignments_in_primary_calls"),
    )
    return out.withColumns(
        {"expected_transcript_filter_applied": F.lit(p.exclude_expected_transcripts), "warning_flags": F.array_join(warnings, ";")}
    )


def wide_rows(counts: DataFrame, samples: DataFrame, value: str = "reads") -> DataFrame:
    """Export form of A03 for all label kinds: label_kind, sample, sorted labels, and a value for each, zero filled.

    A row holds the labels of its kind, as a line of the exported file does.
    """
    labels = counts.select("label_kind", "label").distinct()
    full = labels.join(samples.select("sample"), F.lit(True))  # the matrix itself: every label with every sample
    known = counts.groupBy("label_kind", "sample", "label").agg(F.sum(value).alias("v"))
    filled = full.join(known, ["label_kind", "sample", "label"], "left").withColumn("v", F.coalesce("v", F.lit(0)))
    row = F.sort_array(F.collect_list(F.struct("label", "v")))
    return filled.groupBy("label_kind", "sample").agg(row.alias("x")).select("label_kind", "sample", F.col("x.label").alias("labels"), F.col("x.v").alias("values"))
