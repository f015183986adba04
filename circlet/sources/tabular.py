"""Headered tables, per-sample summaries and keyed exports."""

from __future__ import annotations

import json
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_name() -> Column:
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)


def with_record_no(df: DataFrame) -> DataFrame:
    """Position of a row in its file, as (block start, running id): sorts in file order.

    One block is read by one task from start to end, so the running id is only ever compared inside
    a block.
    """
    number = F.struct(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
    )
    return df.withColumn("record_no", number)


def read_tsv(spark: SparkSession, paths, schema: str | T.StructType | None = None, sep: str = "\t") -> DataFrame:
    """Headered table(s); without a schema every column is a string."""
    reader = spark.read.option("sep", sep).option("header", True).option("enforceSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths)


def write_tsv(df: DataFrame, path: str, columns: list[str] | None = None, sep: str = "\t") -> None:
    """Ordered columns; names the table does not have are written empty, others are dropped.

    Lists are joined with ``;`` and flags written as yes/no, as the text form expects.
    """
    names = columns or df.columns
    picked = [text_form(df, n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in names]
    df.select(*picked).write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def text_form(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.BooleanType):
        return F.when(F.col(name), "yes").when(~F.col(name), "no").alias(name)
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StructType):
            return F.to_json(name).alias(name)
        return F.array_join(F.transform(name, lambda x: x.cast("string")), ";").alias(name)
    return F.col(name)


def sniff_separator(spark: SparkSession, path: str) -> str:
    """Tab when the first line has more tabs than commas."""
    rows = spark.read.text(path).limit(1).collect()
    line = rows[0][0] if rows else ""
    return "\t" if line.count("\t") > line.count(",") else ","


def read_run_table(spark: SparkSession, path: str) -> DataFrame:
    """Run table with its input order in ``record_no``."""
    return with_record_no(read_tsv(spark, path, sep=sniff_separator(spark, path)))


def _sample_of(suffix: str) -> Column:
    return F.regexp_replace(file_name(), suffix.replace(".", "\\.") + "$", "")


SUMMARY_SCHEMA = (
    "mt_evidence_fastq_records_written double, mt_evidence_reads_selected double, high_confidence_mt double"
)


def read_summaries(spark: SparkSession, paths, fallback: str = "mt_evidence_reads_selected") -> DataFrame:
    """(sample, mt_evidence_reads) from per-sample JSON documents, with a fallback key."""
    raw = spark.read.schema(SUMMARY_SCHEMA).option("multiLine", True).json(paths)
    count = F.coalesce("mt_evidence_fastq_records_written", fallback, F.lit(0.0))
    return raw.select(_sample_of(".mt_read_summary.json").alias("sample"), count.alias("mt_evidence_reads"))


def read_fragment_counts(spark: SparkSession, paths) -> DataFrame:
    """(sample, fragments); files hold metric/value rows or a ``fragments`` column.

    The sample is the folder name. Metrics fall back in a fixed order.
    """
    lines = with_record_no(spark.read.text(paths)).withColumn(
        "sample", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    )
    cells = lines.select("sample", "record_no", F.split("value", "\t").alias("c")).filter(F.size("c") > 0)
    header = cells.groupBy("sample").agg(F.min_by("c", "record_no").alias("h"), F.min("record_no").alias("first"))
    body = cells.join(header, "sample").filter(F.col("record_no") > F.col("first"))

    def cell(name):
        at = F.array_position("h", name).cast("int")
        return F.when(at > 0, F.try_element_at(F.col("c"), at))

    metric = F.when(F.array_contains("h", "metric"), cell("metric")).otherwise("total_fragments")
    value = F.when(F.array_contains("h", "metric"), cell("value")).otherwise(cell("fragments"))
    rows = body.select("sample", metric.alias("metric"), value.try_cast("double").alias("value"))

    def last(name):
        return F.max(F.when(F.col("metric") == name, F.col("value")))

    names = ("post_filtering_reads", "read1_after_filtering", "total_fragments")
    return rows.groupBy("sample").agg(F.coalesce(*[last(n) for n in names], F.lit(0.0)).alias("fragments"))


def export_by_key(df: DataFrame, path: str, key: str, columns: list[str], distinct: list[str] | None = None) -> DataFrame:
    """One folder per key, duplicates removed and sorted inside; returns the manifest.

    Rows are spread by key and a few salt values, so one very large key is written by several tasks.
    """
    rows = df.select(key, *[c for c in columns if c != key])
    rows = rows.dropDuplicates(distinct) if distinct else rows.distinct()
    order = [c for c in ("sample", "read_id", "mate") if c in rows.columns]
    salted = rows.withColumn("_salt", F.pmod(F.hash(*rows.columns), F.lit(8)))
    spread = salted.repartition(F.col(key), F.col("_salt")).sortWithinPartitions(key, *order).drop("_salt")
    spread.write.mode("overwrite").partitionBy(key).option("sep", "\t").option("header", True).csv(path)
    # the folder name escapes what a path cannot hold, as the writer does
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("read_count")).withColumn(
        "read_list_file", F.concat(F.lit(f"{key}="), F.col(key))
    )


BIOLOGICAL = ("sample", "dataset", "species", "condition", "age", "treatment", "tissue")
DERIVED = ("affected_feature_label", "affected_features", "fully_removed_features", "partially_overlapped_features",
           "feature_impact_class", "replication_arc_context", "minor_arc_deleted_bp", "major_arc_deleted_bp")
NO_DEFINITION = "Workflow-generated field; see the report method and table guide for context."


def column_category(name: Column) -> Column:
    """Category of a column by its name; the first rule that holds decides."""
    return (
        F.when(name.isin(*BIOLOGICAL), "biological_metadata")
        .when(name.contains("breakpoint") | name.isin("deleted_size", "deleted_interval", "wraps_origin"), "coordinates")
        .when(name.contains("support") | name.endswith("_reads") | name.endswith("_count"), "evidence_or_count")
        .when(name.contains("normalization") | name.contains("per_million"), "normalization")
        .when(name.isin(*DERIVED), "derived_annotation")
        .otherwise("workflow_or_analysis_field")
    )


def data_dictionary(spark: SparkSession, tables: Mapping[str, DataFrame], definitions: Mapping[str, str] | None = None) -> DataFrame:
    """(table, column, category, definition) from the schemas."""
    known = definitions or {}
    rows = [(t, c, known.get(c, NO_DEFINITION)) for t, df in sorted(tables.items()) for c in df.columns]
    table = spark.createDataFrame(rows, "table string, column string, definition string")
    return table.withColumn("category", column_category(F.col("column"))).select("table", "column", "category", "definition")


def flatten_settings(spark: SparkSession, config: Mapping) -> DataFrame:
    """Nested configuration as (setting, value) rows; names of nested settings are joined by dots.

    Texts and numbers stand as they are, anything else (lists, switches, nothing) as JSON.
    """
    wide = pd.json_normalize(json.loads(json.dumps(config, default=str)), sep=".").astype(object)
    rows = wide.melt(var_name="setting", value_name="value") if len(wide.columns) else pd.DataFrame({"setting": [], "value": []})
    bare = rows["value"].map(lambda v: isinstance(v, str | int | float) and not isinstance(v, bool))
    rows["value"] = rows["value"].where(bare, rows["value"].map(lambda v: json.dumps(v, sort_keys=True))).map(str)
    return spark.createDataFrame([tuple(r) for r in rows.itertuples(index=False)], "setting string, value string")


READ_PREPARATION = """
summary struct<
  sequencing:string,
  before_filtering:struct<total_reads:bigint,read1_mean_length:double,read2_mean_length:double,q30_rate:double>,
  after_filtering:struct<total_reads:bigint,read1_mean_length:double,read2_mean_length:double,q30_rate:double>>,
read1_before_filtering struct<total_cycles:int>, read2_before_filtering struct<total_cycles:int>,
filtering_result struct<too_short_reads:bigint>, adapter_cutting struct<adapter_trimmed_reads:bigint>
"""


def read_preparation(spark: SparkSession, samples: DataFrame, trim_reports, decisions=None) -> DataFrame:
    """Read-preparation numbers per sample from QC documents stored as ``<sample>/<name>.json``."""
    sample = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    raw = spark.read.schema(READ_PREPARATION).option("multiLine", True).json(trim_reports)
    report = raw.select(
        sample.alias("sample"),
        F.col("summary.sequencing").alias("sequencing_cycles"),
        F.col("read1_before_filtering.total_cycles").alias("read1_cycles_raw"),
        F.col("read2_before_filtering.total_cycles").alias("read2_cycles_raw"),
        *[F.col(f"summary.{stage}_filtering.{mate}_mean_length").alias(f"{mate}_mean_length_{name}")
          for stage, name in (("before", "raw"), ("after", "after_fastp")) for mate in ("read1", "read2")],
        F.col("summary.before_filtering.total_reads").alias("total_reads_raw"),
        F.col("summary.after_filtering.total_reads").alias("total_reads_after_fastp"),
        F.col("summary.before_filtering.q30_rate").alias("q30_rate_raw"),
        F.col("summary.after_filtering.q30_rate").alias("q30_rate_after_fastp"),
        F.col("adapter_cutting.adapter_trimmed_reads").alias("adapter_trimmed_reads"),
        F.col("filtering_result.too_short_reads").alias("too_short_reads_removed"),
    )
    out = samples.select("sample", "layout").join(report, "sample", "left")
    if decisions is None:
        return out.withColumns({"fastp_trimming_run": F.lit("not recorded"), "minimum_length_after_trimming": F.lit(None).cast("int")})
    made = spark.read.schema("trimmed string, minimum_length int").option("multiLine", True).json(decisions).select(
        sample.alias("sample"), F.col("trimmed").alias("fastp_trimming_run"), F.col("minimum_length").alias("minimum_length_after_trimming")
    )
    return out.join(made, "sample", "left").withColumn("fastp_trimming_run", F.coalesce("fastp_trimming_run", F.lit("not recorded")))
