"""Evidence tiers and report profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from circlet.functions import coords as C
from circlet.params import Params

TIERS = ("strong", "supported", "review", "rejected", "unknown")
KEY = ("species", "leader_left", "leader_right")
EXPECTED = "expected_transcript_junction"


def _column(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def share(test: Column) -> Column:
    """Share of true among known values; null when none is known."""
    return F.avg(test.cast("double"))


def _counted_values(own: DataFrame, key: list[str]) -> DataFrame:
    """What clusters tell about distinct samples, reads, coordinate pairs, alignment patterns and gene pairs: counted together, in one pass.

    Every observation becomes a row for each of these values; values are counted, then a cluster's counts meet in one
    aggregate. A cluster of any size is so reduced to its distinct values in the map tasks.
    """
    gene = _column(own, "gene_pair_label") if "gene_pair_label" in own.columns else F.lit(None)
    none, text = F.lit(None).cast("int"), lambda c: c.cast("string")

    def item(kind, value, left=none, right=none):
        return F.struct(F.lit(kind).alias("kind"), text(value).alias("text"), left.cast("int").alias("l"), right.cast("int").alias("r"))

    one = F.array(item("sample", F.col("sample")), item("read", F.col("read_id")), item("pair", F.lit(None), F.col("read_left_breakpoint"), F.col("read_right_breakpoint")), item("gene", gene))
    patterns = F.transform(F.coalesce("alignment_pattern_id", F.array().cast("array<string>")), lambda x: item("pattern", x))
    rows = own.select(*key, F.inline(F.concat(one, patterns))).filter("kind in ('sample', 'pair') or text is not null")
    counts = rows.groupBy(*key, "kind", "text", "l", "r").agg(F.count(F.lit(1)).alias("n"))
    of = {k: F.col("kind") == k for k in ("sample", "read", "pair", "pattern", "gene")}
    n, minus = F.col("n"), -F.col("n")
    return counts.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.when(of["sample"], F.struct(F.col("text").alias("sample"), "n")))).alias("_per_sample"),
        F.max(F.when(of["sample"], n)).alias("maximum_support_within_sample"),
        F.count_if(of["sample"] & (n >= 2)).alias("samples_with_replicated_support"),
        F.count_if(of["sample"]).alias("samples_with_signal"),
        F.count_if(of["read"]).alias("distinct_read_identifier_count"),
        F.count_if(of["pair"]).alias("distinct_exact_breakpoint_pair_count"),
        # ties: smallest pair in coordinate order
        F.min_by(F.struct(F.col("l").alias("read_left_breakpoint"), F.col("r").alias("read_right_breakpoint"), "n"), F.when(of["pair"], F.struct(minus, "l", "r"))).alias("_modal"),
        F.nullif(F.count_if(of["pattern"]), F.lit(0)).alias("distinct_alignment_pattern_count"),
        F.min_by("text", F.when(of["gene"], F.struct(minus, "text"))).alias("caller_gene_pair_label"),
        F.array_sort(F.collect_set(F.when(of["gene"], F.col("text")))).alias("caller_gene_pair_labels"),
    )


def observation_summary(obs: DataFrame, clusters: DataFrame, p: Params) -> DataFrame:
    """One row per cluster from its observations.

    ``obs`` carries the cluster key and each observation's own coordinates as
    ``read_left_breakpoint``/``read_right_breakpoint``. Sample counts, coordinate pairs, patterns and
    gene pairs are counted in a first step, so a very large cluster is reduced before it is merged.
    """
    key = list(KEY)
    centre = clusters.select(*key, F.col("left_breakpoint").alias("_cl"), F.col("right_breakpoint").alias("_cr"))
    own = obs.drop("left_breakpoint", "right_breakpoint").join(centre, key)
    own = own.withColumns(
        {
            "_dl": C.circular_distance("read_left_breakpoint", "_cl", p.length),
            "_dr": C.circular_distance("read_right_breakpoint", "_cr", p.length),
            "_rotations": F.size(F.filter("rotation_support", lambda r: r != "full_genome")),
        }
    )
    anchor = F.when(F.col("min_anchor_length") > 0, F.col("min_anchor_length"))
    half = F.lit(0.5)
    flat = own.groupBy(*key).agg(
        F.count(F.lit(1)).alias("distinct_observation_count"),
        F.sum("source_record_count").alias("raw_source_record_count"),
        F.count_if("star_support").alias("star_supporting_observations"),
        F.count_if("minimap2_support").alias("minimap2_supporting_observations"),
        F.count_if("both_callers_support").alias("both_caller_supporting_observations"),
        F.flatten(F.collect_set("evidence_sources")).alias("_sources"),
        share(F.col("primary_chain_evidence")).alias("primary_chain_evidence_fraction"),
        share(F.col("secondary_only_evidence")).alias("secondary_only_evidence_fraction"),
        F.percentile(anchor, half).alias("median_min_anchor_length"),
        F.min(anchor).alias("worst_min_anchor_length"),
        F.percentile("estimated_alignment_error_rate", half).alias("median_alignment_error_rate"),
        F.max("estimated_alignment_error_rate").alias("worst_alignment_error_rate"),
        F.percentile("query_union_coverage", half).alias("median_query_union_coverage"),
        share(F.col("query_segments_adjacent")).alias("adjacent_query_segment_fraction"),
        F.count_if(F.col("total_alignment_segments") > 2).alias("complex_alignment_chain_observation_count"),
        F.max("total_alignment_segments").alias("maximum_alignment_segment_count"),
        F.count_if(F.col("deletion_hypotheses_from_read") > 1).alias("multiple_hypothesis_observation_count"),
        F.percentile("_dl", half).alias("median_left_breakpoint_deviation_bp"),
        F.max("_dl").alias("maximum_left_breakpoint_deviation_bp"),
        F.percentile("_dr", half).alias("median_right_breakpoint_deviation_bp"),
        F.max("_dr").alias("maximum_right_breakpoint_deviation_bp"),
        F.count_if(F.col("_rotations") > 1).alias("both_rotation_supporting_observation_count"),
        share(F.col("_rotations") > 1).alias("both_rotation_supporting_observation_fraction"),
        F.coalesce(F.max(_column(own, "junction_repeat_length", "int")), F.lit(0)).alias("microhomology_or_repeat_length"),
        F.flatten(F.collect_set("nuclear_competition_status")).alias("_competition"),
        F.flatten(F.collect_set("observation_quality_flags")).alias("_flags"),
        F.count_if(F.col("direction_status") != "directed").alias("_undirected"),
    )
    out = flat.join(_counted_values(own, key), key)
    both = F.col("both_caller_supporting_observations") / F.col("distinct_observation_count")
    star, remap = F.col("star_supporting_observations") > 0, F.col("minimap2_supporting_observations") > 0
    return out.withColumns(
        {
            "support_per_sample": F.transform("_per_sample", lambda s: F.concat_ws(":", s["sample"], s["n"].cast("string"))),
            "supporting_samples": F.transform("_per_sample", lambda s: s["sample"]),
            "evidence_sources": F.array_sort(F.array_distinct("_sources")),
            "nuclear_competition_status": F.array_sort(F.array_distinct("_competition")),
            "both_caller_supporting_observation_fraction": both,
            "evidence_status": F.when(star & remap, "star_and_minimap2").when(star, "star_only").otherwise("minimap2_only"),
            "modal_observed_breakpoint_pair": F.concat_ws(":", "_modal.read_left_breakpoint", "_modal.read_right_breakpoint"),
            "modal_observed_breakpoint_pair_support": F.col("_modal.n"),
            "distinct_alignment_pattern_count": F.coalesce("distinct_alignment_pattern_count", F.lit(0)),
        }
    ).drop("_per_sample", "_sources", "_competition", "_modal")


def tier_columns(interpretation: Column, p: Params) -> dict[str, Column]:
    """Tier and reason of a cluster row that carries the T01 counts."""
    expected = F.lit(p.exclude_expected_transcripts) & F.coalesce(interpretation == EXPECTED, F.lit(False))
    total = F.coalesce("distinct_observation_count", F.lit(0))
    corroborated = (F.col("maximum_support_within_sample") >= 2) | (F.col("both_caller_supporting_observations") > 0)
    strong = (total >= p.minimum_strong) & corroborated
    undirected = F.coalesce(F.col("_undirected") > 0, F.lit(False))

    def chain(a, b, c, d, e):
        return F.when(expected, a).when(undirected, b).when(total < p.minimum_supported, c).when(strong, d).otherwise(e)

    return {
        "quality_tier": chain("rejected", "rejected", "review", "strong", "supported"),
        "quality_tier_reason": chain(
            "configured_expected_transcript_junction",
            "unresolved_direction_ambiguity",
            "fewer_than_minimum_supported_observations",
            "replicated_within_sample_or_cross_caller_corroboration",
            "multi_observation_support_without_strong_corroboration",
        ),
    }


def feature_of(text: Column) -> Column:
    """First feature name of an annotation text, ``intergenic`` when empty."""
    head = F.trim(F.split_part(F.split_part(F.coalesce(text, F.lit("")), F.lit(";"), F.lit(1)), F.lit(":"), F.lit(1)))
    return F.coalesce(F.nullif(head, F.lit("")), F.lit("intergenic"))


def flanking_pair(clusters: DataFrame) -> Column:
    """Label of the two flanking features."""
    sides = []
    for side in ("left", "right"):
        nearest = F.nullif(_column(clusters, f"nearest_{side}_feature"), F.lit(""))
        sides.append(feature_of(F.coalesce(nearest, _column(clusters, f"{side}_feature_overlap"))))
    return F.concat(sides[0], F.lit("--"), sides[1])


def grade(clusters: DataFrame, obs: DataFrame, p: Params) -> DataFrame:
    """Annotated clusters with summary, tier, reason, flags and gene-pair label."""
    summary = observation_summary(obs, clusters, p)
    kept = [c for c in clusters.columns if c in KEY or c not in summary.columns]
    joined = clusters.select(*kept).drop("total_supporting_reads").join(summary, list(KEY), "left")
    interpretation = _column(clusters, "junction_interpretation")
    extra = F.array_compact(
        F.array(
            F.when(F.col("distinct_observation_count") == 1, F.lit("singleton_cluster")),
            F.when(interpretation == EXPECTED, F.lit(EXPECTED)),
            F.when(F.col("_undirected") > 0, F.lit("direction_ambiguity")),
        )
    )
    flags = F.concat(F.coalesce("_flags", F.array().cast("array<string>")), extra)
    return joined.withColumns(
        {
            "distinct_observation_count": F.coalesce("distinct_observation_count", F.lit(0)),
            "breakpoint_flanking_gene_pair_label": flanking_pair(clusters),
            "quality_flags": F.array_sort(F.array_distinct(flags)),
            **tier_columns(interpretation, p),
        }
    ).withColumns(
        {
            "total_supporting_reads": F.col("distinct_observation_count"),
            "gene_pair_label": F.coalesce("caller_gene_pair_label", "breakpoint_flanking_gene_pair_label"),
        }
    ).drop("_undirected", "_flags")


def enrich_observations(obs: DataFrame, graded: DataFrame) -> DataFrame:
    """Tier and labels of the cluster on every observation."""
    taken = graded.select(
        *KEY, "quality_tier", "quality_tier_reason", F.col("quality_flags").alias("cluster_quality_flags"),
        "breakpoint_flanking_gene_pair_label",
    )
    out = obs.join(taken, list(KEY), "left")
    own = _column(obs, "gene_pair_label")
    return out.withColumns(
        {
            "quality_tier": F.coalesce("quality_tier", F.lit("review")),
            "gene_pair_label": F.coalesce(own, F.col("breakpoint_flanking_gene_pair_label")),
        }
    )


def observation_id_map(enriched: DataFrame) -> DataFrame:
    """Id map of observations."""
    return enriched.select("sample", "read_id", "exact_deletion_id", *KEY, "quality_tier", "evidence_sources")


def profile_table(spark, p: Params) -> DataFrame:
    """The configured profiles as a table (a handful of rows)."""
    rows = [(name, [t.strip().lower() for t in tiers if t.strip()]) for name, tiers in p.profiles.items()]
    return spark.createDataFrame([r for r in rows if r[1]], "report_profile string, tiers array<string>")


def profile_membership(graded: DataFrame, p: Params) -> DataFrame:
    """Every cluster in every profile, included or not and why."""
    profiles = [
        F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, tiers)).alias("tiers")) for name, tiers in p.profiles.items()
    ]
    spread = graded.withColumn("_p", F.explode(F.array(*profiles)))
    included = F.array_contains("_p.tiers", F.col("quality_tier"))
    return spread.select(
        *KEY, "exact_deletion_id", F.col("_p.name").alias("report_profile"), included.alias("included"),
        "quality_tier", "distinct_observation_count",
        F.when(included, "included_tier").otherwise(F.coalesce("quality_tier_reason", F.lit("tier_not_in_profile"))).alias("reason"),
    )


def filter_profile(graded: DataFrame, enriched: DataFrame, ids: DataFrame, profile: str, p: Params):
    """(clusters, observations, id map) of one profile."""
    if profile not in p.profiles:
        raise ValueError(f"unknown report profile: {profile}")
    kept = graded.filter(F.col("quality_tier").isin(*p.profiles[profile]))
    # joined on the cluster key: two clusters may share an event id
    keys = kept.select(*KEY)
    return kept, enriched.join(keys, list(KEY), "left_semi"), ids.join(keys, list(KEY), "left_semi")


def tier_summary(graded: DataFrame, enriched: DataFrame) -> DataFrame:
    """Counts per tier for clusters and observations, zero rows kept."""
    def counts(df, level):
        known = F.when(F.col("quality_tier").isin(*TIERS), F.col("quality_tier")).otherwise("unknown")
        per = df.groupBy(known.alias("quality_tier")).agg(F.count(F.lit(1)).alias("count"))
        tiers = df.sparkSession.createDataFrame([(t,) for t in TIERS], "quality_tier string")
        return tiers.join(per, "quality_tier", "left").select(
            F.lit(level).alias("level"), "quality_tier", F.coalesce("count", F.lit(0)).alias("count")
        )

    return counts(graded, "cluster").unionByName(counts(enriched, "observation"))


def profile_index(membership: DataFrame, p: Params) -> DataFrame:
    """Clusters and observations per profile, with the profile's role."""
    profiles = profile_table(membership.sparkSession, p)
    inc = membership.filter("included").groupBy("report_profile").agg(
        F.count_distinct("exact_deletion_id").alias("deletion_clusters"),
        F.sum("distinct_observation_count").alias("distinct_observations"),
    )
    role = F.when(F.col("report_profile") == p.primary_profile, "Primary interpretation").otherwise("Sensitivity view")
    return profiles.join(inc, "report_profile", "left").select(
        F.col("report_profile").alias("profile"), F.array_join("tiers", ", ").alias("included_tiers"),
        F.coalesce("deletion_clusters", F.lit(0)).alias("deletion_clusters"),
        F.coalesce("distinct_observations", F.lit(0)).alias("distinct_observations"), role.alias("role"),
    )
