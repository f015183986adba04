"""Sample sheets: resolve, enrich, validate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from circlet.params import Params

SINGLE = ("single", "single-end", "single_end", "se")
PAIRED = ("paired", "paired-end", "paired_end", "pe")


def sanitize(value: Column) -> Column:
    """Letters, digits and single underscores; NA when nothing is left."""
    text = F.regexp_replace(F.trim(F.coalesce(F.nullif(value, F.lit("")), F.lit("NA"))), "[^A-Za-z0-9]+", "_")
    return F.coalesce(F.nullif(F.trim(text, F.lit("_")), F.lit("")), F.lit("NA"))


def _cell(rows: DataFrame, *names: str) -> Column:
    """First non-empty of several columns that may be missing."""
    have = [F.nullif(F.col(f"`{n}`"), F.lit("")) for n in names if n in rows.columns]
    return F.coalesce(*have, F.lit(None).cast("string")) if have else F.lit(None).cast("string")


def _found(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 1), F.lit(""))


def derive_age(rows: DataFrame) -> Column:
    given = _cell(rows, "Age", "age")
    number = _found(_cell(rows, "Biological_Replicate"), "(\\d+)[A-Za-z]*")
    return F.when(given.isNotNull(), sanitize(given)).when(number.isNotNull(), F.concat(number, F.lit("mo"))).otherwise("NA")


def derive_treatment(rows: DataFrame) -> Column:
    given = _cell(rows, "treatment", "Treatment")
    letter = _found(_cell(rows, "Biological_Replicate"), "^\\d+([GC])")
    return F.when(given.isNotNull(), sanitize(given)).when(letter == "G", "GPA").when(letter == "C", "Control").otherwise("NA")


def derive_replicate(rows: DataFrame) -> Column:
    text = _cell(rows, "Biological_Replicate", "Sample Name", "Run")
    run = sanitize(F.coalesce(_cell(rows, "Run"), F.lit("1")))
    return F.coalesce(_found(text, "(?i)replicate[_ -]*(\\d+)"), _found(text, "[-_](\\d+)$"), run)


def normalize_layout(value: Column) -> Column:
    return F.when(F.lower(F.trim(F.coalesce(value, F.lit("")))) == "paired", "paired").otherwise("single")


def _template(text: str, values: dict[str, Column]) -> Column:
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(text):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            if name not in values:
                raise ValueError(f"unknown sample naming field: {name}")
            parts.append(values[name])
    return F.concat(*parts) if parts else F.lit("")


def resolve_samples(rows: DataFrame, dataset: str, species: str, template: str = "", fastq: DataFrame | None = None) -> DataFrame:
    """Sample sheet from run rows; repeated ids get ``_2``, ``_3``, ... in input order.

    ``rows`` carries ``record_no``; ``fastq`` maps run to the file list of the archive.
    """
    run = _cell(rows, "Run", "run_accession")
    age, treatment = derive_age(rows), derive_treatment(rows)
    named = rows.withColumns({"_run": run, "_age": age, "_treatment": treatment, "_replicate": derive_replicate(rows)}).filter("_run is not null")
    condition = sanitize(F.concat_ws("_", "_age", "_treatment"))
    empty = F.lit("")
    values = {
        "dataset": sanitize(F.lit(dataset)), "run": sanitize(_cell(rows, "Run")), "age": F.col("_age"), "treatment": F.col("_treatment"),
        "condition": condition, "replicate": F.col("_replicate"), "sample_name": sanitize(_cell(rows, "Sample Name")),
    }
    plain = F.concat(F.lit(f"{dataset}_"), F.coalesce(_cell(rows, "Run"), empty))
    based = named.withColumn("_base", sanitize(_template(template, values) if template else plain))
    nth = F.row_number().over(W.partitionBy("_base").orderBy("record_no"))
    out = based.withColumn("_nth", nth).withColumn(
        "_sample", F.when(F.col("_nth") == 1, F.col("_base")).otherwise(F.concat_ws("_", "_base", "_nth"))
    )
    files = F.lit(None).cast("string")
    if fastq is not None:
        out = out.join(fastq_urls(fastq), F.col("_run") == F.col("_fastq_run"), "left")
    first, second = (F.col("_fastq_1"), F.col("_fastq_2")) if fastq is not None else (files, files)
    text = lambda *names: F.coalesce(_cell(rows, *names), empty)
    return out.select(
        F.col("_sample").alias("sample"), F.lit(dataset).alias("dataset"), F.lit(species).alias("species"), F.col("_run").alias("run_accession"),
        F.coalesce(first, empty).alias("fastq_1"), F.coalesce(second, empty).alias("fastq_2"),
        normalize_layout(_cell(rows, "LibraryLayout", "layout")).alias("layout"), F.col("_age").alias("age"),
        F.col("_treatment").alias("treatment"), condition.alias("condition"), text("tissue", "Tissue", "source_name").alias("tissue"),
        text("BioProject").alias("bioproject"), text("BioSample").alias("biosample"), text("SRA Study", "SRAStudy").alias("sra_study"),
        text("Sample Name").alias("sample_name"), text("Biological_Replicate", "biological_replicate").alias("biological_replicate"),
        F.col("record_no").alias("sample_ord"),
    )


def fill_from_attributes(rows: DataFrame, attributes: DataFrame, key: str = "BioSample") -> DataFrame:
    """Cells that a run row lacks, filled from the attribute row of its biosample."""
    extra = [c for c in attributes.columns if c != key]
    renamed = attributes.dropDuplicates([key]).select(key, *[F.col(f"`{c}`").alias(f"_a_{c}") for c in extra])
    joined = rows.join(renamed, key, "left")
    filled = []
    for c in extra:
        own = F.nullif(F.col(f"`{c}`"), F.lit("")) if c in rows.columns else F.lit(None)
        filled.append(F.coalesce(own, F.col(f"`_a_{c}`")).alias(c))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns if c not in extra], *filled)


def fastq_urls(fastq: DataFrame) -> DataFrame:
    """Run -> first and second file of the archive's ``;`` list, with a scheme."""
    parts = F.filter(F.split("fastq_ftp", ";"), lambda x: x != "")
    full = F.transform(parts, lambda x: F.when(x.rlike("^https?://"), x).otherwise(F.concat(F.lit("https://"), x)))
    return fastq.filter("run_accession <> '' and fastq_ftp <> ''").dropDuplicates(["run_accession"]).select(
        F.col("run_accession").alias("_fastq_run"), F.try_element_at(full, F.lit(1)).alias("_fastq_1"), F.try_element_at(full, F.lit(2)).alias("_fastq_2")
    )


def violations(samples: DataFrame, p: Params, dataset: str = "", species: str = "", strategy: str = "unknown",
               groups: Iterable[str] = (), targets: Iterable[Mapping] = ()) -> DataFrame:
    """(rule, subject, detail) for everything wrong with a sample sheet or the configured targets."""
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    sample = text("sample")

    def rule(name, test, detail):
        return samples.filter(test).select(F.lit(name).alias("rule"), sample.alias("subject"), detail.cast("string").alias("detail"))

    layout = F.lower(text("layout"))
    # long spellings pass the check but only "paired" counts as paired, as when samples are resolved
    kind = normalize_layout(F.col("layout"))
    expected = {"paired_end_short_read": "paired", "single_end_short_read": "single"}.get(strategy.strip().lower(), "")
    second, first = text("fastq_2"), text("fastq_1")
    parts = [
        rule("empty_sample", sample == "", sample),
        samples.groupBy(sample.alias("subject")).count().filter("subject <> '' and count > 1").select(
            F.lit("duplicate_sample").alias("rule"), "subject", F.col("count").cast("string").alias("detail")
        ),
        rule("unsupported_layout", ~layout.isin(*SINGLE, *PAIRED), layout),
        rule("paired_without_second_file", (kind == "paired") & (second == ""), kind),
        rule("single_with_second_file", (kind == "single") & (second != ""), second),
        rule("no_input", (first == "") & (text("run_accession") == ""), first),
    ]
    if dataset:
        parts.append(rule("other_dataset", text("dataset") != dataset, text("dataset")))
    if species:
        parts.append(rule("other_species", text("species") != species, text("species")))
    if expected:
        parts.append(rule("layout_against_strategy", kind != expected, kind))
    parts += [rule("empty_group_value", text(g) == "", F.lit(g)) for g in groups]
    wrong = []
    for t in targets:
        numbers = [t.get(k) for k in ("left_breakpoint", "right_breakpoint", "deleted_size")]
        if all(n not in (None, "") for n in numbers):
            left, right, size = map(int, numbers)
            implied = right - left - 1 if right > left else p.length - left + right - 1
            if implied != size:
                wrong.append(("target_size", str(t.get("name", "unnamed")), f"{size} configured, {implied} implied"))
    if wrong:
        parts.append(samples.sparkSession.createDataFrame(wrong, "rule string, subject string, detail string"))
    return reduce(DataFrame.unionByName, parts)


def require_valid(samples: DataFrame, p: Params, **settings) -> DataFrame:
    """The sheet itself, or an error that names the first violations."""
    found = violations(samples, p, **settings).orderBy("rule", "subject").limit(5).collect()
    if found:
        raise ValueError("; ".join(f"{r.rule} {r.subject!r} {r.detail}" for r in found))
    return samples
