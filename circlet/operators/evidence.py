"""Evidence from several callers, collapsed to physical observations (Q03-Q14)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from circlet.durable import materialize
from circlet.functions import coords as C
from circlet.functions import reads as R
from circlet.operators.conflicts import split_conflicts
from circlet.operators.features import Features
from circlet.operators.leader import assign_leaders
from circlet.params import Params

REMAP, CHIMERIC = "minimap2_remap", "star_chimeric"
FOLD_LIMIT = 64  # reads with more distinct coordinates go through the tiled clustering instead
ROW_LIMIT = 4096  # and so do reads with more rows


def reason_list(*rules: tuple[Column, str]) -> Column:
    """Names of the rules that hold, in rule order (a null rule does not hold)."""
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in rules]))


# ---- caller rows -------------------------------------------------------------------------


def remap_evidence(events: DataFrame) -> DataFrame:
    """Q06: evidence columns for remap events."""
    cigar_length = [R.cigar_lengths(c, "MISH=X") for c in ("left_cigar", "right_cigar")]
    length = F.greatest(*cigar_length, "query_first_end", "query_second_end", F.lit(1))
    anchors = F.col("left_anchor_length") + F.col("right_anchor_length")
    edits = F.coalesce("left_edit_distance", F.lit(0)) + F.coalesce("right_edit_distance", F.lit(0))

    def named_elsewhere(name):
        return F.size(F.filter(F.split(F.coalesce(F.col(name), F.lit("")), ";"), lambda x: x != "")) + 1

    base = events.withColumn("_length", length)
    pair = R.query_pair_metrics(
        "query_first_start", "query_first_end", "query_second_start", "query_second_end", "_length"
    )
    added = {k: v for k, v in pair.items() if k not in events.columns}
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    out = base.withColumns(
        {
            **added,
            "read_id": R.read_key("read_id"),
            "evidence_source": F.lit(REMAP),
            "estimated_alignment_error_rate": edits / F.greatest(F.lit(1), anchors),
            "left_clipped_fraction": 1.0 - F.col("left_anchor_length") / F.col("_length"),
            "right_clipped_fraction": 1.0 - F.col("right_anchor_length") / F.col("_length"),
            "total_alignment_segments": F.greatest(
                F.lit(2), named_elsewhere("left_sa_tag"), named_elsewhere("right_sa_tag")
            ),
            "alignment_pattern_id": F.concat_ws(
                ":", F.lit("minimap2"), text("rotation_name"), text("raw_left_breakpoint"),
                text("raw_right_breakpoint"), text("left_cigar"), text("right_cigar"),
            ),
            "nuclear_competition_status": F.lit("not_propagated"),
            "primary_chain_evidence": F.col("left_is_primary") | F.col("right_is_primary"),
            "secondary_only_evidence": F.col("left_is_secondary") & F.col("right_is_secondary"),
            "filter_status": F.lit("pass"),
            "filter_reason": F.array().cast("array<string>"),
        }
    )
    return out.drop("_length")


def judge_junctions(junctions: DataFrame, features: Features, p: Params, expected_pairs=()) -> DataFrame:
    """Q03-Q05: pass/fail with ordered reasons for every junction inside the circular contig.

    ``junctions`` comes from the junction reader. Failed rows are kept. Configured regions are no genes.
    ``expected_pairs`` holds (left name, right name, bidirectional, reason).
    """
    inside = junctions.filter(
        F.col("contig_a").isin(*p.contig_names) & F.col("contig_b").isin(*p.contig_names)
        & F.col("breakpoint_a").isNotNull() & F.col("breakpoint_b").isNotNull()
    )
    left, right = R.cigar_metrics("cigar_a"), R.cigar_metrics("cigar_b")
    base = inside.withColumns(
        {f"_l_{k}": v for k, v in left.items()} | {f"_r_{k}": v for k, v in right.items()}
    ).withColumns({"left_breakpoint": F.col("breakpoint_a"), "right_breakpoint": F.col("breakpoint_b")})
    pair = R.query_pair_metrics(
        "_l_query_start", "_l_query_end", "_r_query_start", "_r_query_end",
        F.greatest("_l_query_length", "_r_query_length"),
    )
    base = base.withColumns(pair).withColumns(C.directed_record("left_breakpoint", "right_breakpoint", p.length))
    genes = features.genes()
    for side, start in (("l", "start_a"), ("r", "start_b")):
        span = F.greatest(F.lit(0), F.col(f"_{side}_aligned_reference_length") - 1)
        first = F.coalesce(F.col(start), F.lit(0))
        base = genes.ranked_hits(base, first, first + span, f"_{side}_hits")
    names = {s: F.transform(f"_{s}_hits", lambda h: h["name"]) for s in ("l", "r")}
    base = base.withColumns({"_l_names": names["l"], "_r_names": names["r"]})
    top = {s: F.try_element_at(F.col(f"_{s}_hits"), F.lit(1)) for s in ("l", "r")}
    base = base.withColumns({"_l_top": top["l"], "_r_top": top["r"]})
    shared = F.greatest(
        F.lit(0), F.least("_l_top.end", "_r_top.end") - F.greatest("_l_top.start", "_r_top.start") + 1
    )
    shorter = F.least(
        F.col("_l_top.end") - F.col("_l_top.start") + 1, F.col("_r_top.end") - F.col("_r_top.start") + 1
    )
    both_genes = F.col("_l_top").isNotNull() & F.col("_r_top").isNotNull()
    overlapping = both_genes & (shorter > 0) & (shared / shorter > 0.5)
    expected = F.lit(False)
    ln, rn = F.lower("_l_top.name"), F.lower("_r_top.name")
    for first, second, both, *_ in expected_pairs:
        expected = expected | ((ln == first.lower()) & (rn == second.lower()))
        if both:
            expected = expected | ((ln == second.lower()) & (rn == first.lower()))
    size = F.col("deleted_size")
    reasons = reason_list(
        (F.lit(p.require_same_orientation) & (F.col("strand_a") != F.col("strand_b")), "incompatible_reference_orientation"),
        (F.col("_l_aligned_query_length") < p.junction_min_anchor, "left_anchor_short"),
        (F.col("_r_aligned_query_length") < p.junction_min_anchor, "right_anchor_short"),
        (size < p.min_deletion_size, "deletion_too_small"),
        (size > p.max_deletion_size, "deletion_too_large"),
        (F.col("query_overlap_bp") > p.junction_max_query_overlap, "query_overlap_too_large"),
        (F.col("query_gap_bp") > p.junction_max_query_gap, "query_gap_too_large"),
        (F.lit(p.require_gene_anchors) & ~both_genes, "missing_annotated_gene_anchor"),
        (F.lit(p.exclude_same_gene) & F.arrays_overlap("_l_names", "_r_names"), "same_gene_chimeric_alignment"),
        (overlapping, "substantially_overlapping_gene_anchors"),
        (both_genes & expected, "configured_expected_transcript_pair"),
    )
    score = F.coalesce("this_score", F.lit(0))
    best = F.coalesce("best_score", score)
    clipped = lambda s: 1.0 - F.col(f"_{s}_aligned_query_length") / F.greatest(F.lit(1), F.col(f"_{s}_query_length"))
    unknown = F.lit(None).cast("boolean")
    return base.withColumn("_reasons", reasons).select(
        "sample", F.lit(p.species).alias("species"), R.read_key("read_name").alias("read_id"),
        "left_breakpoint", "right_breakpoint", "deleted_size", "wraps_origin", "deleted_interval",
        "complement_deleted_size", "complement_wraps_origin",
        F.lit("alignment_directed").alias("arc_assignment_method"), F.lit("directed").alias("direction_status"),
        C.breakpoint_pair_id("left_breakpoint", "right_breakpoint").alias("breakpoint_pair_id"),
        F.lit("STAR_Chimeric.out.junction").alias("source"), F.lit(CHIMERIC).alias("evidence_source"),
        F.lit("full_genome").alias("rotation_name"), F.lit(1).alias("rotation_start"),
        F.col("left_breakpoint").alias("raw_left_breakpoint"), F.col("right_breakpoint").alias("raw_right_breakpoint"),
        F.col("left_breakpoint").alias("reported_left_breakpoint"),
        F.col("right_breakpoint").alias("reported_right_breakpoint"),
        F.col("_l_aligned_query_length").alias("left_anchor_length"),
        F.col("_r_aligned_query_length").alias("right_anchor_length"),
        F.least("_l_aligned_query_length", "_r_aligned_query_length").alias("min_anchor_length"),
        F.concat_ws(":", "strand_a", "strand_b").alias("strand"),
        F.col("cigar_a").alias("left_cigar"), F.col("cigar_b").alias("right_cigar"),
        score.alias("left_alignment_score"), score.alias("right_alignment_score"),
        F.col("num_chimeric_alignments").alias("chimeric_alignment_count"),
        F.col("max_possible_score").alias("chimeric_max_possible_score"),
        F.col("non_chimeric_score").alias("chimeric_non_chimeric_score"),
        best.alias("chimeric_best_score"), (best - score).alias("chimeric_score_delta"),
        F.col("_l_top.name").alias("left_gene"), F.col("_r_top.name").alias("right_gene"),
        F.concat(F.col("_l_top.name"), F.lit("--"), F.col("_r_top.name")).alias("gene_pair_label"),
        F.col("_l_names").alias("left_gene_hits"), F.col("_r_names").alias("right_gene_hits"),
        F.lit(2).alias("total_alignment_segments"),
        F.concat_ws(":", F.lit("star"), "left_breakpoint", "right_breakpoint", "cigar_a", "cigar_b").alias("alignment_pattern_id"),
        clipped("l").alias("left_clipped_fraction"), clipped("r").alias("right_clipped_fraction"),
        F.least(F.coalesce("repeat_left", F.lit(0)), F.coalesce("repeat_right", F.lit(0))).alias("junction_repeat_length"),
        F.lit("not_available_in_chimeric_record").alias("nuclear_competition_status"),
        *[unknown.alias(c) for c in ("left_is_primary", "right_is_primary", "left_is_secondary", "right_is_secondary",
                                     "left_is_supplementary", "right_is_supplementary", "primary_chain_evidence",
                                     "secondary_only_evidence")],
        *pair,
        F.when(F.size("_reasons") == 0, "pass").otherwise("fail").alias("filter_status"),
        F.col("_reasons").alias("filter_reason"),
    )


def library_layout(explicit: str = "", strategy: str = "") -> str:
    """Q07: layout of the library from its declared layout or strategy."""
    declared = explicit.strip().lower()
    if declared in ("single", "paired"):
        return declared
    return next((word for word in ("paired", "single") if word in strategy.lower()), "unknown")


def with_layout(rows: DataFrame, layout: str) -> DataFrame:
    """Q07: mate-context columns."""
    paired = layout == "paired"
    status = F.lit("not_available_from_retained_intermediates" if paired else "not_applicable")
    mate = ("mate_context_status", "both_mates_support_same_cluster", "non_supporting_mate_near_breakpoint",
            "mate_mapping_class", "mate_placement_discordant")
    return rows.withColumns(
        {
            "library_layout": F.lit(layout),
            "observation_unit": F.lit("sequenced_fragment" if paired else "read"),
            "paired_end_collapsed": F.lit("yes" if paired else "not_applicable"),
            **{name: status for name in mate},
        }
    )


def union_callers(*tables: DataFrame) -> DataFrame:
    """Q08."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


# ---- observations ------------------------------------------------------------------------


def _column(rows: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in rows.columns else F.lit(None).cast(kind)


def row_flags(rows: DataFrame) -> Column:
    """Q13: quality flags of one caller row."""
    return reason_list(
        ((F.col("evidence_source") == REMAP) & (F.coalesce("min_mapq", F.lit(0)) == 0), "min_mapq_zero"),
        (F.col("secondary_only_evidence"), "secondary_only"),
        (F.col("estimated_alignment_error_rate") > 0.15, "high_alignment_error"),
        (_column(rows, "chimeric_alignment_count", "int") > 1, "star_multimapping"),
        (F.col("query_gap_bp") > 0, "query_gap"),
        (F.col("query_overlap_bp") > 0, "query_overlap"),
        (F.col("total_alignment_segments") > 2, "complex_alignment_chain"),
    )


def _read_points(rows: DataFrame, slop: int, length: int, conflicts: bool, fold_limit: int) -> DataFrame:
    """Q09, Q10: one row per read: its distinct points with the leader of each (null in a conflict) and the number of leaders.

    Points, ordered by (left, right), are grouped greedily against each group's first member. ``conflicts`` leaves those out
    that another row of the read opposes. A ``crowded`` read, of more than ``fold_limit`` points or ``ROW_LIMIT`` rows, has none.
    """
    read = ["sample", "read_id"]
    known = rows.dropna(subset=[*read, "left_breakpoint", "right_breakpoint"])
    points = known.groupBy(*read, F.col("left_breakpoint").cast("int").alias("l"), F.col("right_breakpoint").cast("int").alias("r")).agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy(*read).orderBy("l", "r")
    head = points.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= fold_limit + 1)
    lists = head.groupBy(*read).agg(F.array_sort(F.collect_list(F.struct("l", "r", "n"))).alias("_all"), F.sum("n").alias("_rows"))
    crowded = (F.size("_all") > fold_limit) | (F.col("_rows") > ROW_LIMIT)
    none = F.array().cast("array<struct<l:int,r:int,n:bigint>>")

    def near(a, b):
        return C.circular_distance(a, b, length) <= slop

    def opposed(x):
        other = lambda y: (x["l"] != y["l"]) | (x["r"] != y["r"]) | (x["n"] > 1)
        return F.exists("_all", lambda y: near(x["l"], y["r"]) & near(x["r"], y["l"]) & other(y))

    def close(a, b):
        return near(a["l"], b["l"]) & near(a["r"], b["r"])

    def add(leaders, x):
        return F.when(F.exists(leaders, lambda y: close(x, y)), leaders).otherwise(F.concat(leaders, F.array(x)))

    kept = F.filter("_all", lambda x: ~opposed(x)) if conflicts else F.col("_all")
    led = lists.withColumns({"crowded": crowded, "_kept": F.when(crowded, none).otherwise(kept)}).withColumn("_leaders", F.aggregate("_kept", none, add))

    def placed(x):
        leader = F.when(F.array_contains("_kept", x), F.get(F.filter("_leaders", lambda y: close(x, y)), F.lit(0)))
        return F.struct(x["l"].alias("l"), x["r"].alias("r"), leader["l"].alias("leader_l"), leader["r"].alias("leader_r"))

    found = F.when(~F.col("crowded"), F.transform("_all", placed))
    return led.select(*read, "crowded", found.alias("_points"), F.size("_leaders").alias("hypothesis_count"))


def _tiled_hypotheses(rows: DataFrame, slop: int, length: int) -> DataFrame:
    """Q10 for crowded reads: clustered by tiles, so no read is ever collected whole."""
    read, order = ["sample", "read_id"], ["left_breakpoint", "right_breakpoint"]
    tiled = assign_leaders(rows.select(*read, *order).distinct(), read, *order, order, slop, length)
    counts = tiled.groupBy(*read).agg(F.count_distinct("leader_left", "leader_right").cast("int").alias("hypothesis_count"))
    return rows.join(tiled.join(counts, read), [*read, *order])


def _led(rows: DataFrame, points: DataFrame) -> DataFrame:
    """Rows of ordinary reads with ``leader_left``, ``leader_right`` and ``hypothesis_count``; a row in a conflict has no leader.

    Rows meet the points of their read by the read alone, so all that is counted per read afterwards needs no other shuffle.
    """
    own = F.get(F.filter("_points", lambda x: (x["l"] == F.col("left_breakpoint")) & (x["r"] == F.col("right_breakpoint"))), F.lit(0))
    met = rows.join(points.filter("not crowded").drop("crowded").hint("merge"), ["sample", "read_id"]).withColumn("_own", own).filter("_own is not null")
    return met.withColumns({"leader_left": F.col("_own.leader_l"), "leader_right": F.col("_own.leader_r")}).drop("_own", "_points")


def _divided(rows: DataFrame, slop: int, length: int, conflicts: bool, fold_limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary reads, as ``_led`` gives them, and those of crowded reads where there are any."""
    points = materialize(_read_points(rows, slop, length, conflicts, fold_limit), "read-points")
    busy = points.filter("crowded").select("sample", "read_id")
    if busy.isEmpty():
        return _led(rows, points), None
    return _led(rows, points), rows.dropna(subset=["left_breakpoint", "right_breakpoint"]).join(busy, ["sample", "read_id"], "left_semi")


def hypotheses(rows: DataFrame, slop: int, length: int, fold_limit: int = FOLD_LIMIT) -> DataFrame:
    """Q10: rows with the leader coordinate of their hypothesis and ``hypothesis_count`` of the read.

    Ordinary reads are folded in one expression over at most ``fold_limit`` coordinates. Reads with more, and those with more
    than ``ROW_LIMIT`` rows, are clustered by tiles.
    """
    ordinary, crowded = _divided(rows, slop, length, False, fold_limit)
    return ordinary if crowded is None else ordinary.unionByName(_tiled_hypotheses(crowded, slop, length))


def observations(rows: DataFrame, p: Params) -> DataFrame:
    """Q10-Q13: one row per (sample, read, hypothesis), callers and rotations merged.

    Positions use a median per caller and then across callers. Aggregation runs per caller first,
    so the second step sees at most one row per caller.
    """
    return _observed(*_divided(rows, p.slop, p.length, False, FOLD_LIMIT), p)


def _observed(ordinary: DataFrame, crowded: DataFrame | None, p: Params) -> DataFrame:
    """Observations of ordinary reads' rows and, apart from them, of crowded reads'."""
    out = _merged_callers(ordinary, p, True)
    return out if crowded is None else out.unionByName(_merged_callers(_tiled_hypotheses(crowded, p.slop, p.length), p, False))


def _merged_callers(rows: DataFrame, p: Params, listed: bool) -> DataFrame:
    """Q11-Q13 over rows with their hypothesis. ``listed``: a read has few rows, so the gene pairs of an observation are counted in a list."""
    rows = rows.withColumn("_flags", row_flags(rows))
    key = ["sample", "read_id", "leader_left", "leader_right"]
    length = p.length

    minimums = [c for c in ("left_anchor_length", "right_anchor_length", "min_anchor_length", "left_mapq", "right_mapq",
                            "min_mapq", "left_alignment_score", "right_alignment_score", "query_union_coverage",
                            "query_union_aligned_length", "total_aligned_query_length",
                            "query_junction_boundary_distance_from_read_end_min") if c in rows.columns]
    maximums = [c for c in ("left_edit_distance", "right_edit_distance", "read_length", "query_overlap_bp", "query_gap_bp",
                            "left_clipped_fraction", "right_clipped_fraction", "total_alignment_segments",
                            "junction_repeat_length", "estimated_alignment_error_rate") if c in rows.columns]
    any_flags = [c for c in ("left_is_primary", "right_is_primary", "left_is_secondary", "right_is_secondary",
                             "left_is_supplementary", "right_is_supplementary", "primary_chain_evidence") if c in rows.columns]
    texts = [c for c in ("strand", "left_cigar", "right_cigar", "alignment_pattern_id", "nuclear_competition_status",
                         "gene_pair_label", "rotation_name", "library_layout", "observation_unit", "paired_end_collapsed",
                         "mate_context_status", "both_mates_support_same_cluster", "non_supporting_mate_near_breakpoint",
                         "mate_mapping_class", "mate_placement_discordant") if c in rows.columns]
    pair_text = F.concat_ws(":", "evidence_source", "raw_left_breakpoint", "raw_right_breakpoint")
    have_genes = "gene_pair_label" in rows.columns
    is_named = F.col("gene_pair_label").isNotNull() & (F.col("evidence_source") == CHIMERIC) if have_genes else None
    point = F.struct("left_breakpoint", "right_breakpoint")
    genes = [F.collect_list(F.when(is_named, F.struct("gene_pair_label", point.alias("first")))).alias("_genes")] if have_genes and listed else []
    per_caller = rows.withColumn("_pair", pair_text).groupBy(*key, "evidence_source").agg(
        F.percentile(C.unwrap("left_breakpoint", "leader_left", length), F.lit(0.5)).alias("_ml"),
        F.percentile(C.unwrap("right_breakpoint", "leader_right", length), F.lit(0.5)).alias("_mr"),
        F.min(F.struct("left_breakpoint", "right_breakpoint")).alias("_first"),
        F.first("species").alias("species"),
        F.first("hypothesis_count").alias("hypothesis_count"),
        F.count(F.lit(1)).alias("records"),
        *[F.min(c).alias(c) for c in minimums],
        *[F.max(c).alias(c) for c in maximums],
        *[F.max(c).alias(c) for c in any_flags],
        F.min(F.coalesce("query_segments_adjacent", F.lit(False))).alias("query_segments_adjacent"),
        F.min(F.coalesce("secondary_only_evidence", F.lit(False))).alias("secondary_only_evidence"),
        F.collect_set(F.struct(*texts, "_pair", "_flags")).alias("_texts"),  # one set of rows of texts, not a set for each text
        *genes,
    )
    # the median is taken in the leader's frame, then moved to the frame of the caller's first row
    def caller_median(median, first, leader):
        shift = F.col("_first")[first] - C.unwrap(F.col("_first")[first], leader, length)
        return C.wrap_median(F.col(median) + shift, length)

    placed = per_caller.withColumns(
        {
            "_l": caller_median("_ml", "left_breakpoint", "leader_left"),
            "_r": caller_median("_mr", "right_breakpoint", "leader_right"),
        }
    )

    def merged(name):
        return F.array_distinct(F.array_compact(F.transform("_texts", lambda x: x[name])))

    by_source = F.array_sort(F.collect_list(F.struct("evidence_source", "_l", "_r")))
    level = placed.groupBy(*key).agg(
        by_source.alias("_callers"),
        F.first("species").alias("species"),
        F.first("hypothesis_count").alias("deletion_hypotheses_from_read"),
        F.sum("records").alias("source_record_count"),
        F.coalesce(F.sum(F.when(F.col("evidence_source") == CHIMERIC, F.col("records"))), F.lit(0)).alias("star_source_record_count"),
        F.coalesce(F.sum(F.when(F.col("evidence_source") == REMAP, F.col("records"))), F.lit(0)).alias("minimap2_source_record_count"),
        *[F.min(c).alias(c) for c in (*minimums, "query_segments_adjacent", "secondary_only_evidence")],
        *[F.max(c).alias(c) for c in (*maximums, *any_flags)],
        F.flatten(F.collect_list("_texts")).alias("_texts"),
        *([F.flatten(F.collect_list("_genes")).alias("_genes")] if genes else []),
    )
    level = level.withColumns(
        {
            **{c: F.array_sort(merged(c)) for c in texts},
            "source_coordinate_pairs": F.array_sort(merged("_pair")),
            "_flags": F.array_distinct(F.flatten(merged("_flags"))),
        }
    ).drop("_texts")

    def across(field):
        values = F.transform("_callers", lambda c: c[field])
        anchor = F.element_at(values, 1)
        unwrapped = F.array_sort(F.transform(values, lambda v: C.unwrap(v, anchor, length)))
        n = F.size(unwrapped)
        low = F.element_at(unwrapped, ((n + 1) / 2).cast("int"))
        high = F.element_at(unwrapped, (n / 2).cast("int") + 1)
        return C.wrap_median((low + high) / F.lit(2.0), length)

    out = level.withColumns({"left_breakpoint": across("_l"), "right_breakpoint": across("_r")})
    sources = F.transform("_callers", lambda c: c["evidence_source"])
    many = F.col("deletion_hypotheses_from_read") > 1
    flags = F.concat("_flags", F.when(many, F.array(F.lit("multiple_deletion_hypotheses"))).otherwise(F.array().cast("array<string>")))
    real_rotations = F.filter("rotation_name", lambda r: r != "full_genome")
    out = out.withColumns(
        {
            **C.directed_record("left_breakpoint", "right_breakpoint", length),
            "arc_assignment_method": F.lit("alignment_directed"),
            "direction_status": F.lit("directed"),
            "evidence_sources": sources,
            "star_support": F.array_contains(sources, CHIMERIC),
            "minimap2_support": F.array_contains(sources, REMAP),
            "both_callers_support": F.size(sources) > 1,
            "rotation_support": F.col("rotation_name"),
            "rotation_count": F.size("rotation_name"),
            "rotation_agreement": F.when(F.size(real_rotations) > 1, "multiple_rotations").otherwise("single_rotation"),
            "alignment_pattern_count": F.size("alignment_pattern_id"),
            "observation_quality_flags": F.array_sort(flags),
        }
    ).withColumnRenamed("leader_left", "hypothesis_left").withColumnRenamed("leader_right", "hypothesis_right")
    out = out.drop("_callers", "_flags", "rotation_name")
    if not have_genes:
        return out.withColumns(
            {"gene_pair_label": F.lit(None).cast("string"), "gene_pair_labels": F.array().cast("array<string>")}
        )
    out = out.withColumnRenamed("gene_pair_label", "gene_pair_labels")
    if listed:
        of = lambda x: F.filter("_genes", lambda g: g["gene_pair_label"] == x)
        ranked = F.transform(
            F.array_distinct(F.transform("_genes", lambda g: g["gene_pair_label"])),
            lambda x: F.struct((-F.size(of(x))).alias("n"), F.array_min(F.transform(of(x), lambda g: g["first"])).alias("first"), x.alias("label")),
        )
        return out.withColumn("gene_pair_label", F.array_min(ranked)["label"]).drop("_genes")
    named = rows.filter(is_named)
    counted = named.groupBy(*key, "gene_pair_label").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("left_breakpoint", "right_breakpoint")).alias("first")
    )
    best = F.min_by("gene_pair_label", F.struct(-F.col("n"), F.col("first"), F.col("gene_pair_label")))
    modal = counted.groupBy(*key).agg(best.alias("gene_pair_label"))
    modal = modal.withColumnRenamed("leader_left", "hypothesis_left").withColumnRenamed("leader_right", "hypothesis_right")
    return out.join(modal, ["sample", "read_id", "hypothesis_left", "hypothesis_right"], "left")


def consolidate(candidates: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """Q09-Q13: passing candidates -> (observations, ambiguous rows)."""
    passing = candidates.filter("filter_status = 'pass'")
    if p.ambiguous_direction_policy == "include":
        return observations(passing, p), split_conflicts(passing, p.slop, p.length)[1]
    ordinary, crowded = _divided(passing, p.slop, p.length, True, FOLD_LIMIT)
    opposed = ordinary.filter("leader_left is null").drop("leader_left", "leader_right", "hypothesis_count")
    ambiguous = opposed.withColumn("direction_status", F.lit("ambiguous_across_rotations"))
    if "breakpoint_pair_id" not in ambiguous.columns:
        ambiguous = ambiguous.withColumn("breakpoint_pair_id", C.breakpoint_pair_id("left_breakpoint", "right_breakpoint"))
    if crowded is not None:
        crowded, others = split_conflicts(crowded, p.slop, p.length)
        ambiguous = ambiguous.unionByName(others)
    return _observed(ordinary.filter("leader_left is not null"), crowded, p), ambiguous


OBSERVATION_ORDER = ("sample", "read_id", "hypothesis_left", "hypothesis_right")


def build_summary(candidates: DataFrame, ambiguous: DataFrame, obs: DataFrame, clusters: DataFrame, p: Params) -> DataFrame:
    """Q14: seven metrics of the consolidation."""
    source, passed = F.col("evidence_source"), F.col("filter_status") == "pass"
    one = candidates.agg(
        F.count_if(source == REMAP).alias("minimap2_source_candidates"),
        F.count_if(source == CHIMERIC).alias("star_source_candidates"),
        F.count_if(passed).alias("_pass"),
    )
    two = ambiguous.agg(F.count(F.lit(1)).alias("ambiguous_direction_records"))
    three = obs.agg(
        F.count(F.lit(1)).alias("canonical_distinct_observations"),
        F.count_if("both_callers_support").alias("both_caller_observations"),
    )
    four = clusters.agg(F.count(F.lit(1)).alias("canonical_deletion_clusters"))
    excluded = F.lit(0) if p.ambiguous_direction_policy == "include" else F.col("ambiguous_direction_records")
    row = one.join(two).join(three).join(four)  # four one-row tables
    row = row.withColumn("source_candidates_passing", F.col("_pass") - excluded)
    metrics = ["minimap2_source_candidates", "star_source_candidates", "source_candidates_passing",
               "ambiguous_direction_records", "canonical_distinct_observations", "canonical_deletion_clusters",
               "both_caller_observations"]
    return row.select(F.stack(F.lit(len(metrics)), *[x for m in metrics for x in (F.lit(m), F.col(m))]).alias("metric", "value"))
