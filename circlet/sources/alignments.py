"""SAM text and chimeric junction files as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from circlet.functions import coords as C
from circlet.functions import reads as R
from circlet.operators.evidence import reason_list
from circlet.params import Params
from circlet.sources.tabular import file_name, with_record_no


def parse_sam(lines: DataFrame) -> DataFrame:
    """Typed alignment columns from SAM text lines in ``value``; other columns are kept.

    Also derives query span, reference end and aligned/clipped fractions from the CIGAR. Lengths
    include hard clips; a record without CIGAR falls back to its sequence length. The fraction used by
    read selection is over the stored sequence and is 0 for a record without one.
    """
    others = [c for c in lines.columns if c != "value"]
    rows = lines.filter(~F.col("value").startswith("@") & (F.col("value") != ""))
    rows = rows.select(*others, F.split("value", "\t").alias("f")).filter(F.size("f") >= 11)

    def field(i) -> Column:
        return F.try_element_at("f", F.lit(i))

    star = lambda c: F.nullif(c, F.lit("*"))
    optional = F.slice("f", F.lit(12), F.greatest(F.size("f") - 11, F.lit(0)))
    pairs = F.transform(optional, lambda t: F.struct(F.substring(t, 1, 2).alias("k"), F.substring(t, 6, 1 << 30).alias("v")))
    names = F.transform(optional, lambda t: F.substring(t, 1, 2))
    tags = F.map_from_entries(F.filter(pairs, lambda t, i: F.array_position(names, t["k"]) == i + 1))  # the first of a repeated name
    typed = rows.select(
        *others,
        field(1).alias("query_name"), field(2).try_cast("int").alias("flag"), star(field(3)).alias("reference_name"),
        field(4).try_cast("int").alias("pos"), field(5).try_cast("int").alias("mapq"), star(field(6)).alias("cigar"),
        star(field(10)).alias("seq"), star(field(11)).alias("qual"), tags.alias("tags"),
    )
    span = R.cigar_metrics("cigar")
    typed = typed.withColumns({f"_{k}": v for k, v in span.items()}).withColumn("_soft", R.cigar_lengths("cigar", "S"))
    length = F.coalesce(F.nullif("_query_length", F.lit(0)), F.length("seq"), F.lit(0))
    stored = F.coalesce(F.length("seq"), F.lit(0))
    aligned = F.col("_aligned_query_length")
    # positions inside the stored sequence do not count hard clips
    hard = R.cigar_lengths(F.regexp_extract(F.coalesce("cigar", F.lit("")), "^((?:[0-9]+[H])*)", 1), "H")
    tag = lambda k: F.try_element_at(F.col("tags"), F.lit(k))
    share = lambda top, bottom: F.when(bottom > 0, top / bottom).otherwise(0.0)
    return typed.select(
        *others, "query_name", "flag", "reference_name", "pos", "mapq", "cigar", "seq", "qual", "tags",
        (F.col("_query_start") - hard).alias("query_start"), (F.col("_query_start") - hard + aligned).alias("query_end"),
        (F.col("pos") + F.col("_aligned_reference_length") - 1).alias("ref_end"),
        share(aligned, length).alias("aligned_fraction"), share(F.col("_soft"), length).alias("soft_clip_fraction"),
        share(aligned, stored).alias("stored_aligned_fraction"),
        F.coalesce(tag("NH").try_cast("int"), F.lit(1)).alias("nh"), tag("AS").try_cast("int").alias("alignment_score"),
        tag("NM").try_cast("int").alias("edit_distance"), tag("SA").alias("sa_tag"), tag("tp").alias("alignment_type"),
    )


def read_sam(spark: SparkSession, paths, p: Params) -> DataFrame:
    """Alignments of SAM files stored as ``<rotation>/<sample>.sam``."""
    lines = with_record_no(spark.read.text(paths))
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    starts = F.create_map(*[F.lit(x) for kv in p.rotation_starts.items() for x in kv])
    named = lines.select(
        "value", "record_no", F.regexp_replace(file_name(), "\\.sam$", "").alias("sample"), folder.alias("rotation_name"),
        F.coalesce(F.try_element_at(starts, folder), F.lit(1)).alias("rotation_start"), F.lit(p.species).alias("species"),
    )
    return parse_sam(named)


JUNCTION_FIELDS = (
    ("contig_a", "string"), ("breakpoint_a", "int"), ("strand_a", "string"), ("contig_b", "string"), ("breakpoint_b", "int"),
    ("strand_b", "string"), ("junction_type", "string"), ("repeat_left", "int"), ("repeat_right", "int"), ("read_name", "string"),
    ("start_a", "int"), ("cigar_a", "string"), ("start_b", "int"), ("cigar_b", "string"), ("num_chimeric_alignments", "int"),
    ("max_possible_score", "int"), ("non_chimeric_score", "int"), ("this_score", "int"), ("best_score", "int"),
)


def parse_junctions(lines: DataFrame, min_fields: int = 14, whitespace: bool = True) -> DataFrame:
    """Junction columns from text lines in ``value``; comments, headers and short lines are skipped.

    A line with too few tab fields is split at white space instead when ``whitespace`` is set.
    """
    others = [c for c in lines.columns if c != "value"]
    text = lines.filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    tabs = F.split("value", "\t")
    parts = F.when(F.size(tabs) >= min_fields, tabs).otherwise(F.split(F.trim("value"), "\\s+")) if whitespace else tabs
    rows = text.select(*others, parts.alias("f")).filter(F.size("f") >= min_fields)
    rows = rows.filter(~F.element_at("f", 1).isin("chr_donorA", "chromosome"))
    columns = [F.try_element_at(F.col("f"), F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(JUNCTION_FIELDS, 1)]
    return rows.select(*others, *columns)


def read_junctions(spark: SparkSession, paths, min_fields: int = 14, whitespace: bool = False) -> DataFrame:
    """Junctions of files named ``<sample>.Chimeric.out.junction``."""
    lines = spark.read.text(paths)
    name = file_name()
    sample = F.when(name.endswith(".Chimeric.out.junction"), F.regexp_replace(name, "\\.Chimeric\\.out\\.junction$", "")).otherwise(
        F.split_part(name, F.lit("."), F.lit(1))
    )
    return parse_junctions(lines.select("value", sample.alias("sample")), min_fields, whitespace)


def call_plain_junctions(junctions: DataFrame, p: Params, padding: int = 0, rotation_name: str = "normal", rotation_start: int = 1) -> DataFrame:
    """One event per junction line with pass/fail and the reasons in fixed order."""
    def at(name):
        return C.normalize_padded_pos(name, p.length, padding, rotation_start)

    base = junctions.filter("breakpoint_a is not null and breakpoint_b is not null").select(
        "sample", F.lit(p.species).alias("species"), F.col("read_name").alias("read_id"),
        at("breakpoint_a").alias("left_breakpoint"), at("breakpoint_b").alias("right_breakpoint"),
        R.cigar_lengths("cigar_a", "M=X").alias("left_anchor_length"), R.cigar_lengths("cigar_b", "M=X").alias("right_anchor_length"),
        F.concat_ws(":", "strand_a", "strand_b").alias("strand"), F.lit("STAR_Chimeric.out.junction").alias("source"),
        F.lit(rotation_name).alias("rotation_name"), F.lit(rotation_start).alias("rotation_start"),
        F.col("breakpoint_a").alias("raw_left_breakpoint"), F.col("breakpoint_b").alias("raw_right_breakpoint"),
    ).withColumn("deleted_size", C.directed_gap("left_breakpoint", "right_breakpoint", p.length))
    reasons = reason_list(
        (F.col("left_anchor_length") < p.min_anchor_length, "left_anchor_short"),
        (F.col("right_anchor_length") < p.min_anchor_length, "right_anchor_short"),
        (F.col("deleted_size") < p.min_deletion_size, "deletion_too_small"),
        (F.col("deleted_size") > p.max_deletion_size, "deletion_too_large"),
    )
    judged = base.withColumn("filter_reason", reasons)
    return judged.withColumn("filter_status", F.when(F.size("filter_reason") == 0, "pass").otherwise("fail"))


def plain_junction_summary(judged: DataFrame) -> DataFrame:
    """D12 counters per sample."""
    return judged.groupBy("sample").agg(
        F.count(F.lit(1)).alias("candidate_reads"), F.count_if(F.col("filter_status") == "pass").alias("passing_reads"),
        F.count_if(F.col("filter_status") == "fail").alias("failed_reads"),
    )
