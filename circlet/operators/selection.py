"""Which reads go on to realignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from circlet.functions import reads as R
from circlet.params import Params

READ = ("sample", "query_name", "mate")


def _fraction(alignments: DataFrame) -> Column:
    """Aligned share of the stored sequence where the reader gives it, else of the whole read."""
    names = ("stored_aligned_fraction", "aligned_fraction")
    return F.col(next(n for n in names if n in alignments.columns))


def category(p: Params) -> Column:
    """Record category; the first rule that holds decides."""
    circular = F.coalesce(F.col("reference_name").isin(*p.contig_names), F.lit(False))
    return (
        F.when(R.has_flag("flag", 4), "unmapped")
        .when(R.has_flag("flag", 2048), F.when(circular, "supplementary_mt").otherwise("supplementary_non_mt"))
        .when(R.has_flag("flag", 256), F.when(circular, "secondary_mt").otherwise("secondary_non_mt"))
        .when(~circular, "non_mt_primary")
        .when(F.col("mapq") < p.selection_min_mapq, "low_quality_mt")
        .when(F.coalesce("nh", F.lit(1)) > 1, "ambiguous_mt")
        .otherwise("high_confidence_mt")
    )


def policy(cat: Column, p: Params) -> Column:
    """Whether a category is selected under the include flags."""
    allowed = ["high_confidence_mt"]
    allowed += ["low_quality_mt"] * p.include_low_mapq + ["ambiguous_mt"] * p.include_multimappers
    allowed += ["supplementary_mt"] * p.include_supplementary_reads + ["secondary_mt"] * p.include_secondary_reads
    return cat.isin(*allowed)


def chimeric_names(junctions: DataFrame, p: Params) -> DataFrame:
    """Names in the junction file where either side is on the circular contig."""
    either = F.col("contig_a").isin(*p.contig_names) | F.col("contig_b").isin(*p.contig_names)
    return junctions.filter(either).select("sample", R.read_key("read_name").alias("clean_name")).distinct()


def classify(alignments: DataFrame, p: Params, chimeric: DataFrame | None = None) -> DataFrame:
    """Every record with category, ``selected`` and sorted ``reasons``."""
    base = alignments.withColumns({"mate": R.mate_number("flag"), "category": category(p)})
    marked = F.lit(False)
    if chimeric is not None and p.include_chimeric_reads:
        names = chimeric.select("sample", "clean_name", F.lit(True).alias("_chimeric"))
        base = base.withColumn("clean_name", R.read_key("query_name")).join(names, ["sample", "clean_name"], "left").drop("clean_name")
        marked = F.col("_chimeric").isNotNull()
    own = policy(F.col("category"), p)
    base = base.withColumns({"_own": own, "_mark": marked}).drop("_chimeric")
    mate_reason = F.lit(None).cast("string")
    if p.include_mates:
        named = base.filter(F.col("_own") | F.col("_mark")).select("sample", "query_name").distinct().withColumn("_mates", F.lit(True))
        base = base.join(named, ["sample", "query_name"], "left")
        mate_reason = F.when(F.col("_mates"), F.lit("mate_of_mt_evidence_read"))
    reasons = F.array_sort(
        F.array_compact(
            F.array(
                F.when(F.col("_own"), F.col("category")),
                F.when(F.col("_mark"), F.lit("full_genome_chimeric_mt_evidence")),
                mate_reason,
            )
        )
    )
    return base.withColumn("reasons", reasons).withColumn("selected", F.size("reasons") > 0).drop("_own", "_mark", "_mates")


def _first_primary(classified: DataFrame, keep: Column) -> DataFrame:
    primary = ~(R.has_flag("flag", 256) | R.has_flag("flag", 2048))
    w = W.partitionBy(*READ).orderBy("record_no")
    return classified.filter(primary & keep).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def selected_reads(classified: DataFrame) -> dict[str, DataFrame]:
    """The three outputs, one primary record per (name, mate)."""
    cat = F.col("category")
    return {
        "high_confidence": _first_primary(classified, cat == "high_confidence_mt"),
        "ambiguous": _first_primary(classified, cat.isin("ambiguous_mt", "low_quality_mt")),
        "evidence": _first_primary(classified, F.col("selected")),
    }


def classification_summary(classified: DataFrame) -> DataFrame:
    """Counts by category, by selected category and by reason, in one pass over the records."""
    names = F.concat(
        F.array(F.struct(F.lit("alignment_category").alias("table_type"), F.col("category").alias("name"))),
        F.when(
            F.col("selected"),
            F.array(F.struct(F.lit("selected_alignment_category").alias("table_type"), F.col("category").alias("name"))),
        ).otherwise(F.array().cast("array<struct<table_type:string,name:string>>")),
        F.transform("reasons", lambda r: F.struct(F.lit("selection_reason").alias("table_type"), r.alias("name"))),
    )
    return classified.select("sample", F.inline(names)).groupBy("sample", "table_type", "name").agg(F.count(F.lit(1)).alias("count"))


def selection_totals(classified: DataFrame) -> DataFrame:
    """Alignments, selected (name, mate) keys and written records per sample."""
    primary = ~(R.has_flag("flag", 256) | R.has_flag("flag", 2048))
    key = F.struct("query_name", "mate")
    return classified.groupBy("sample").agg(
        F.count(F.lit(1)).alias("total_alignments_examined"),
        F.count_distinct(F.when(F.col("selected"), key)).alias("mt_evidence_reads_selected"),
        F.count_distinct(F.when(F.col("selected") & primary, key)).alias("mt_evidence_fastq_records_written"),
    )


def competitive_groups(alignments: DataFrame, p: Params, session: Column | None = None) -> DataFrame:
    """One decision per (sample, name, mate) from its primary record and its competitors.

    A plain aggregate, so records of one read need not be adjacent in the input. ``session`` is a further
    grouping column: the session window that closes a read's group in a stream.
    """
    other = R.has_flag("flag", 256) | R.has_flag("flag", 2048)
    mapped = ~R.has_flag("flag", 4)
    circular = mapped & F.coalesce(F.col("reference_name").isin(*p.contig_names), F.lit(False))
    fraction = _fraction(alignments)
    strong_nuclear = mapped & ~circular & (fraction >= p.competitive_nuclear_aligned_fraction)
    kept = [c for c in ("flag", "mapq", "reference_name", "seq", "qual") if c in alignments.columns]
    first = F.min(
        F.when(~other, F.struct("record_no", *kept, fraction.alias("fraction"), mapped.alias("mapped"), circular.alias("circular")))
    )
    keys = [*READ] if session is None else [*READ, session]
    groups = alignments.withColumn("mate", R.mate_number("flag")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"),
        first.alias("primary"),
        F.max(other & circular).alias("_circular_competitor"),
        F.max(other & strong_nuclear).alias("_nuclear_competitor"),
    )
    top = F.col("primary")
    weak = (top["mapq"] < p.competitive_min_mapq) | (top["fraction"] < p.competitive_min_aligned_fraction)
    unclear = (top["mapq"] < p.competitive_ambiguous_mapq_below) | F.col("_nuclear_competitor")
    decision = (
        F.when(top.isNull(), "no_primary_alignment")
        .when(~top["mapped"], "primary_unmapped")
        .when(~top["circular"], F.when(F.col("_circular_competitor"), "nuclear_primary_with_mt_competitor").otherwise("nuclear_primary"))
        .when(weak, "weak_mt_primary")
        .when(unclear, "mt_primary_ambiguous")
        .otherwise("mt_primary_best")
    )
    return groups.withColumn("category", decision).drop("_circular_competitor", "_nuclear_competitor")


def retain(groups: DataFrame, p: Params) -> DataFrame:
    """R10."""
    kept = ["mt_primary_best"] + ["mt_primary_ambiguous"] * p.keep_ambiguous
    return groups.filter(F.col("category").isin(*kept))


def competitive_summary(groups: DataFrame, p: Params) -> DataFrame:
    """Per sample, records, groups per category and retained groups."""
    cat = F.col("category")
    names = ("mt_primary_best", "mt_primary_ambiguous", "nuclear_primary", "nuclear_primary_with_mt_competitor",
             "weak_mt_primary", "primary_unmapped", "no_primary_alignment")
    kept = ["mt_primary_best"] + ["mt_primary_ambiguous"] * p.keep_ambiguous
    return groups.groupBy("sample").agg(
        F.sum("records").alias("total_alignments_examined"),
        *[F.count_if(cat == n).alias(f"{n}_reads") for n in names],
        F.count_if(cat.isin(*kept)).alias("mt_evidence_reads_selected"),
    )


def depletion_candidates(alignments: DataFrame, p: Params) -> DataFrame:
    """R12, per record: primary records that are unmapped or only weakly placed, with the reason."""
    strong = (F.col("mapq") >= p.depletion_min_mapq) & (_fraction(alignments) >= p.depletion_min_aligned_fraction)
    primary = alignments.filter(~(R.has_flag("flag", 256) | R.has_flag("flag", 2048)))
    reason = F.when(R.has_flag("flag", 4), "primary_unmapped").when(~strong, "weak_or_partial_nuclear_alignment")
    return primary.withColumns({"mate": R.mate_number("flag"), "retention_reason": reason}).filter("retention_reason is not null")


def deplete_nuclear(alignments: DataFrame, p: Params) -> DataFrame:
    """First retained record of every (sample, name, mate)."""
    w = W.partitionBy(*READ).orderBy("record_no")
    return depletion_candidates(alignments, p).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def depletion_summary(alignments: DataFrame, retained: DataFrame, p: Params) -> DataFrame:
    """R12 counters."""
    primary = ~(R.has_flag("flag", 256) | R.has_flag("flag", 2048))
    unmapped = R.has_flag("flag", 4)
    strong = (F.col("mapq") >= p.depletion_min_mapq) & (_fraction(alignments) >= p.depletion_min_aligned_fraction)
    scan = alignments.groupBy("sample").agg(
        F.count(F.lit(1)).alias("alignment_records_examined"),
        F.count_if(R.has_flag("flag", 256)).alias("secondary_records"),
        F.count_if(R.has_flag("flag", 2048) & ~R.has_flag("flag", 256)).alias("supplementary_records"),
        F.count_if(primary & unmapped).alias("primary_unmapped_records"),
        F.count_if(primary & ~unmapped & strong).alias("strong_primary_nuclear_mapped_records"),
        F.count_if(primary & ~unmapped & ~strong).alias("weak_or_partial_primary_nuclear_mapped_records"),
    )
    kept = retained.groupBy("sample").agg(
        F.count(F.lit(1)).alias("retained_for_mitochondrial_remap"),
        F.count_if(F.col("retention_reason") == "primary_unmapped").alias("primary_unmapped_written"),
    )
    return scan.join(kept, "sample", "left").na.fill(0, ["retained_for_mitochondrial_remap", "primary_unmapped_written"])


def concat_mates(*mates: DataFrame | None) -> DataFrame:
    """Mate tables one under the other with ``mate`` 1, 2, ...; a missing one is skipped."""
    present = [(i, df) for i, df in enumerate(mates, 1) if df is not None]
    if not present:
        raise ValueError("no mate table given")
    out = None
    for number, df in present:
        part = df.withColumn("mate", F.lit(str(number)))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def mate_counts(reads: DataFrame) -> DataFrame:
    """Records per mate, and fragments (records of mate 1)."""
    per = reads.groupBy("sample").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("mate").isin("1", "R1", "")).alias("mate1_records"),
        F.count_if(F.col("mate").isin("2", "R2")).alias("mate2_records"),
    )
    return per.withColumn("fragments", F.col("mate1_records"))


def as_fastq(records: DataFrame) -> DataFrame:
    """Reads in their original orientation with /1 or /2 on the name."""
    back = R.has_flag("flag", 16)
    suffix = F.when(R.has_flag("flag", 128), "/2").when(R.has_flag("flag", 64), "/1").otherwise("")
    return records.select(
        "sample", F.concat(F.col("query_name"), suffix).alias("read_name"),
        R.forward_sequence("seq", back).alias("seq"), R.forward_quality("qual", "seq", back).alias("qual"),
    )
