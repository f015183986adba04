"""GTF annotation as a feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from circlet.params import Params

FEATURE_TYPES = ("gene", "transcript", "exon", "tRNA", "rRNA", "CDS")


def _attribute(key: str) -> Column:
    """Last value of ``key "value"``, null when absent."""
    found = F.regexp_extract_all("attributes", F.lit(f'(?:^|\\s|;){key}\\s+"([^"]+)"'), F.lit(1))
    return F.when(F.size(found) > 0, F.element_at(found, -1))


def parse_gtf(lines: DataFrame, p: Params) -> DataFrame:
    """The six feature types on the circular contig, with a name for each."""
    cells = lines.filter(~F.col("value").startswith("#")).select(F.split("value", "\t").alias("c")).filter(F.size("c") == 9)
    kept = cells.filter(F.element_at("c", 1).isin(*p.contig_names) & F.element_at("c", 3).isin(*FEATURE_TYPES))
    rows = kept.select(
        F.element_at("c", 1).alias("contig"), F.element_at("c", 4).cast("int").alias("start"), F.element_at("c", 5).cast("int").alias("end"),
        F.element_at("c", 7).alias("strand"), F.element_at("c", 3).alias("feature_type"), F.element_at("c", 9).alias("attributes"),
    )
    blank = F.lit("")
    name = F.coalesce(*[_attribute(k) for k in ("gene_name", "gene_id", "transcript_name", "transcript_id")], blank)
    return rows.select(
        "contig", "start", "end", "strand", "feature_type", F.coalesce(_attribute("gene_id"), blank).alias("gene_id"),
        name.alias("gene_name"), F.coalesce(_attribute("transcript_id"), blank).alias("transcript_id"),
        F.coalesce(_attribute("product"), blank).alias("product"),
    ).orderBy("start", "end", "feature_type")


def read_features(spark: SparkSession, path: str, p: Params) -> DataFrame:
    return parse_gtf(spark.read.text(path), p)


def without_contigs(lines: DataFrame, p: Params) -> DataFrame:
    """GTF lines that are comments or lie on other contigs; an empty result is an error."""
    contig = F.split_part("value", F.lit("\t"), F.lit(1))
    kept = lines.filter(F.col("value").startswith("#") | ~contig.isin(*p.contig_names))
    if kept.filter(~F.col("value").startswith("#")).isEmpty():
        raise ValueError("no annotation rows are left outside the circular contig; check contig_names")
    return kept
