"""Tables behind the displays: locations, densities, rankings, ordination."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from circlet.functions import coords as C
from circlet.operators.annotate import with_arc_context
from circlet.operators.ranking import numbered, numbered_in_groups
from circlet.operators.stats import control_rank, number_in
from circlet.params import Params

MILLION = 1_000_000.0
COORDINATES = ("left_breakpoint", "right_breakpoint", "deleted_size")
LABEL_COLUMNS = ("affected_feature_label", "affected_features", "replication_arc_context", "major_arc_deleted_bp",
                 "minor_arc_deleted_bp", "known_deletion_label", "deleted_interval", "wraps_origin")


def representative_coordinates(reads: DataFrame, clusters: DataFrame, length: int, key: str = "exact_deletion_id") -> DataFrame:
    """Cluster coordinates on reads, missing labels filled from the cluster, size recomputed."""
    labels = [c for c in LABEL_COLUMNS if c in clusters.columns]
    taken = clusters.select(key, *[F.col(c).alias(f"_c_{c}") for c in (*COORDINATES, *labels)]).dropDuplicates([key])
    joined = reads.join(taken, key, "left")
    out = {c: F.coalesce(f"_c_{c}", c) if c in reads.columns else F.col(f"_c_{c}") for c in COORDINATES}
    for c in labels:
        own = F.col(c) if c in reads.columns else F.lit(None)
        if c in reads.columns and reads.schema[c].dataType.simpleString() == "string":
            own = F.nullif(own, F.lit(""))
        out[c] = F.coalesce(own, F.col(f"_c_{c}"))
    placed = joined.withColumns(out).drop(*[f"_c_{c}" for c in (*COORDINATES, *labels)])
    size = C.directed_gap("left_breakpoint", "right_breakpoint", length)
    known = F.col("left_breakpoint").isNotNull() & F.col("right_breakpoint").isNotNull()
    return placed.withColumn("deleted_size", F.when(known, size).otherwise(F.col("deleted_size")))


def location_table(reads: DataFrame, samples: DataFrame, group: str, p: Params) -> DataFrame:
    """Support per (group, event), filtered, ranked and optionally cut to the top of each group.

    Reads are counted per (event, sample) first, so a group that holds most reads costs no more than
    its distinct events.
    """
    labels = [c for c in LABEL_COLUMNS if c in reads.columns]
    key = [*COORDINATES, "exact_deletion_id"]
    usable = reads.filter(" and ".join(f"{c} is not null" for c in COORDINATES))
    per_sample = usable.groupBy("sample", *key).agg(
        F.count(F.lit(1)).alias("n"), *[F.min(c).alias(c) for c in labels]
    )
    name = F.coalesce(F.col(group).cast("string"), F.lit("missing"))
    sheet = samples.select("sample", name.alias("plot_group"), "normalization_reads")
    reads_total = F.col("normalization_reads")
    weight = F.when(reads_total > 0, MILLION / F.nullif(reads_total, F.lit(0.0))).otherwise(0.0)
    joined = per_sample.join(sheet, "sample", "left").withColumn("plot_group", F.coalesce("plot_group", F.lit("missing")))
    # rounded, so that equal support ties whatever the order in which samples were added
    support = F.round(F.sum(F.col("n") * F.coalesce(weight, F.lit(0.0))), 9)
    grouped = joined.groupBy("plot_group", *key).agg(
        F.sum("n").alias("supporting_reads"), support.alias("plot_support"),
        *[F.min(c).alias(c) for c in labels],
    )
    if p.view_min_support > 0:
        grouped = grouped.filter(F.col("plot_support") >= p.view_min_support)
    ranked = support_rank(grouped)
    return ranked.filter(F.col("support_rank") <= p.view_max_per_group) if p.view_max_per_group > 0 else ranked


def support_rank(table: DataFrame) -> DataFrame:
    """Unique rank in each group: support first, then id and coordinates; a group of any size spreads over tasks."""
    return numbered_in_groups(table, ["plot_group"], [F.col("plot_support").desc(), "exact_deletion_id", *COORDINATES], "support_rank")


def endpoint_density(locations: DataFrame, p: Params) -> DataFrame:
    """Both endpoints of every event in fixed-width bins, all bins present, smoothed round the circle."""
    length, width = p.length, max(1, p.density_bin)
    bins = -(-length // width)
    ends = locations.select(
        "plot_support", "supporting_reads",
        F.inline(F.array(F.struct(F.lit("left").alias("side"), F.col("left_breakpoint").alias("at")),
                         F.struct(F.lit("right").alias("side"), F.col("right_breakpoint").alias("at")))),
    ).filter(F.col("at").between(1, length) & F.col("plot_support").isNotNull())
    side = {s: F.col("side") == s for s in ("left", "right")}
    filled = ends.groupBy(F.floor((F.col("at") - 1) / F.lit(width)).cast("int").alias("bin_index")).agg(
        *[F.count_if(t).alias(f"{s}_endpoint_count") for s, t in side.items()],
        *[F.sum(F.when(t, F.col("plot_support")).otherwise(0.0)).alias(f"{s}_support") for s, t in side.items()],
        *[F.sum(F.when(t, F.col("supporting_reads")).otherwise(0)).alias(f"{s}_raw_supporting_reads") for s, t in side.items()],
    )
    every = locations.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin_index"))
    table = every.join(filled, "bin_index", "left").na.fill(0).withColumns(
        {
            "endpoint_count": F.col("left_endpoint_count") + F.col("right_endpoint_count"),
            "summed_support": F.col("left_support") + F.col("right_support"),
            "raw_supporting_reads": F.col("left_raw_supporting_reads") + F.col("right_raw_supporting_reads"),
            "bin_start": F.col("bin_index") * width + 1,
            "bin_end": F.least((F.col("bin_index") + 1) * width, F.lit(length)),
        }
    )
    table = table.withColumn("bin_midpoint", (F.col("bin_start") + F.col("bin_end")) / F.lit(2.0))
    smooth = circular_mean(table, ["summed_support", "endpoint_count"], p.density_smooth_bins, bins)
    return table.join(smooth, "bin_index")


def circular_mean(table: DataFrame, values: list[str], window: int, bins: int) -> DataFrame:
    """Mean over ``window`` neighbouring bins round the circle; an even window grows by one.

    Every bin sends its value to the bins it reaches (a bin reached twice counts twice).
    """
    radius = max(1, window + (window % 2 == 0)) // 2
    reach = F.transform(F.sequence(F.lit(-radius), F.lit(radius)), lambda d: F.pmod(F.col("bin_index") + d, F.lit(bins)).cast("int"))
    sent = table.select(F.explode(reach).alias("_to"), *values)
    means = [(F.sum(v) / F.lit(float(2 * radius + 1))).alias(f"smoothed_{v}") for v in values]
    return sent.groupBy(F.col("_to").alias("bin_index")).agg(*means)


def hotspots(density: DataFrame, p: Params, top: int = 8, min_spacing: int | None = None) -> DataFrame:
    """Highest local maxima round the circle that keep a minimum distance to each other; none in fewer than three bins.

    The candidates are bins, at most ``length / bin`` of them, so they are folded as one array.
    """
    length = p.length
    bins = -(-length // max(1, p.density_bin))
    spacing = max(1, int(length * 0.075 if min_spacing is None else min_spacing))
    y = density.select("bin_index", F.col("smoothed_summed_support").alias("y"))
    around = F.transform(F.array(F.lit(-1), F.lit(1)), lambda d: F.pmod(F.col("bin_index") + d, F.lit(bins)).cast("int"))
    neighbours = y.select(F.explode(around).alias("bin_index"), "y").groupBy("bin_index").agg(F.max("y").alias("_n"))
    # rounded, so that equal sums tie in whatever order they were added
    height = F.round("smoothed_summed_support", 9)
    peaks = density.join(neighbours, "bin_index").filter((height >= F.round("_n", 9)) & (height > 0) & F.lit(bins >= 3))
    listed = peaks.select(F.col("bin_midpoint").alias("coord"), height.alias("height"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("height")).alias("low"), "coord", "height")))
    none = F.array().cast("array<struct<coord:double,height:double>>")

    def add(chosen, peak):
        gap = lambda c: F.abs(peak["coord"] - c["coord"])
        apart = F.forall(chosen, lambda c: F.least(gap(c), F.lit(length) - gap(c)) >= spacing)
        return F.when((F.size(chosen) < top) & apart, F.concat(chosen, F.array(F.struct(peak["coord"].alias("coord"), peak["height"].alias("height"))))).otherwise(chosen)

    return listed.agg(F.aggregate(ordered, none, add).alias("chosen")).select(F.inline("chosen"))


def breakpoint_pairs(locations: DataFrame, length: int) -> DataFrame:
    """Support per breakpoint pair and group, the right end moved past the origin when it wraps."""
    crosses = F.col("right_breakpoint") < F.col("left_breakpoint")
    adjusted = F.when(crosses, F.col("right_breakpoint") + length).otherwise(F.col("right_breakpoint"))
    work = locations.withColumns({"crosses_origin": crosses, "adjusted_right_breakpoint": adjusted})
    return work.groupBy("plot_group", "left_breakpoint", "right_breakpoint", "adjusted_right_breakpoint", "crosses_origin").agg(
        F.sum("plot_support").alias("plot_support"), F.sum("supporting_reads").alias("supporting_reads"),
        F.min("support_rank").alias("support_rank"), F.min("deleted_size").alias("deleted_size"),
        F.count_distinct("exact_deletion_id").alias("pair_count"),
        F.array_join(F.array_sort(F.collect_set("exact_deletion_id")), "+").alias("exact_deletion_id"),
    )


def size_histogram(reads: DataFrame, samples: DataFrame, group: str, bins: int = 60) -> DataFrame:
    """Raw and weighted counts in equal-width bins over all sizes; the last edge is inclusive."""
    name = F.coalesce(F.col(group).cast("string"), F.lit("missing"))
    sheet = samples.select("sample", name.alias("group"), "normalization_reads")
    counted = reads.filter("deleted_size is not null").groupBy("sample", "deleted_size").agg(F.count(F.lit(1)).alias("n"))
    total = F.col("normalization_reads")
    weight = F.when(total > 0, MILLION / F.nullif(total, F.lit(0.0))).otherwise(0.0)
    placed = counted.join(sheet, "sample").withColumn("w", F.col("n") * weight)
    low_high = counted.agg(F.min("deleted_size").alias("lo"), F.max("deleted_size").alias("hi"))
    # numpy's rule for a single value: half a unit on both sides
    span = low_high.select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo").cast("double")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi").cast("double")).alias("hi"),
    )
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    index = F.least(F.floor((F.col("deleted_size") - F.col("lo")) / step), F.lit(bins - 1)).cast("int")
    spread = placed.join(F.broadcast(span), F.lit(True))  # one row of limits
    return spread.withColumns({"bin_index": index, "step": step}).groupBy("group", "bin_index").agg(
        F.min(F.col("lo") + F.col("bin_index") * F.col("step")).alias("bin_start"),
        F.min(F.col("lo") + (F.col("bin_index") + 1) * F.col("step")).alias("bin_end"),
        F.sum("n").alias("supporting_reads"), F.sum("w").alias("weighted_support"),
    )


def category_totals(values: DataFrame, top: int = 14, proportional: bool = False, other: str = "Other categories", by: str | None = None) -> DataFrame:
    """(group, category) totals or within-group percent, categories beyond the top n merged. ``by``: for each kind of category."""
    keys = [by] if by else []
    totals = values.groupBy(*keys, "group", "category").agg(F.sum("value").alias("value"))
    if proportional:
        whole = totals.groupBy(*keys, "group").agg(F.sum("value").alias("_whole"))
        totals = totals.join(whole, [*keys, "group"]).withColumn("value", F.col("value") / F.nullif("_whole", F.lit(0.0)) * 100).drop("_whole")
    sums = totals.groupBy(*keys, "category").agg(F.sum("value").alias("v"))
    # rounded, so that equal sums tie in whatever order they were added
    order = [F.round("v", 9).desc(), "category"]
    ranked = numbered_in_groups(sums, keys, order, "_rank") if by else numbered(sums, order, "_rank")
    best = ranked.filter(F.col("_rank") <= top).select(*keys, "category", F.lit(True).alias("_top"))
    kept = totals.join(F.broadcast(best), [*keys, "category"], "left")  # top categories of each kind
    named = F.when(F.col("_top"), F.col("category")).otherwise(other)
    return kept.groupBy(*keys, "group", named.alias("category")).agg(F.sum("value").alias("value"))


def top_features(feature_burden: DataFrame, group: str, order: DataFrame, top: int = 25) -> DataFrame:
    """Group sums of the features with the largest burden, with their genome order."""
    value = "support_per_million_mt_reads"
    grouped = feature_burden.groupBy(F.col(group).alias("group"), "feature").agg(F.sum(value).alias(value))
    best = grouped.groupBy("feature").agg(F.sum(value).alias("v")).orderBy(F.col("v").desc(), "feature").limit(top)
    starts = order.groupBy(F.col("gene_name").alias("feature")).agg(F.min("start").alias("genome_order"))
    return grouped.join(F.broadcast(best.select("feature")), "feature", "left_semi").join(starts, "feature", "left")


def short_label(label: Column, parts: int = 6) -> Column:
    """Feature label with its middle left out when it names many features."""
    names = F.filter(F.split(label, "\\+"), lambda x: x != "")
    many = F.concat(
        F.element_at(names, 1), F.lit(" ... "), F.element_at(names, -1), F.lit(" ("), F.size(names).cast("string"), F.lit(" features)")
    )
    return F.when(F.size(names) > parts, many).otherwise(label)


def recurrence(clusters: DataFrame, counts: DataFrame, samples: DataFrame, group: str, top: int = 22) -> DataFrame:
    """Events with most supporting reads, labelled, with normalised support per group."""
    arrow = F.concat(
        F.col("left_breakpoint").cast("string"), F.lit("->"), F.col("right_breakpoint").cast("string"), F.lit(" ("),
        F.col("deleted_size").cast("string"), F.lit(" bp) | "), short_label(F.coalesce("affected_feature_label", F.lit(""))),
    )
    best = clusters.orderBy(F.col("total_supporting_reads").desc(), "exact_deletion_id").limit(top).select(
        "exact_deletion_id", arrow.alias("label"), "total_supporting_reads"
    )
    placed = counts.filter("label_kind = 'exact'").join(samples.select("sample", F.col(group).alias("group")), "sample")
    sums = placed.groupBy("group", F.col("label").alias("exact_deletion_id")).agg(F.sum("per_million").alias("support_per_million"))
    return F.broadcast(best).join(sums, "exact_deletion_id", "left")


# ---- ordination --------------------------------------------------------------------------


class _PairSums:
    """One sample x sample matrix that grows with the samples that a task meets."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.total = np.zeros((0, 0))

    def add(self, names: list[str], values: np.ndarray, combine) -> None:
        at = [self.index.setdefault(n, len(self.index)) for n in names]
        if len(self.index) > len(self.total):
            grown = np.zeros((2 * len(self.index),) * 2)
            grown[: len(self.total), : len(self.total)] = self.total
            self.total = grown
        self.total[np.ix_(at, at)] += combine(values, values)

    def frame(self) -> pd.DataFrame:
        names = list(self.index)
        i, j = np.nonzero(self.total)
        return pd.DataFrame({"sample_a": [names[x] for x in i], "sample_b": [names[x] for x in j], "total": self.total[i, j]})


def sample_pair_sums(counts: DataFrame, samples: DataFrame, kind: str, value: str = "per_million", by: str | None = None) -> DataFrame:
    """(sample_a, sample_b, total) over all labels of the product or the minimum of two samples' values.

    A label's values form one row of at most one entry per sample. Each task adds its labels into one
    sample x sample matrix and emits that, so pairs of samples are never written per label. ``by`` names a column
    of label kinds that get a matrix each.
    """
    known = counts.filter(F.col(value) != 0).join(samples.select("sample"), "sample", "left_semi")
    key = F.col(by) if by else F.lit("")
    rows = known.groupBy(key.alias("_by"), "label").agg(F.collect_list(F.struct("sample", F.col(value).alias("v"))).alias("m"))
    combine = np.multiply.outer if kind == "product" else np.minimum.outer

    def add(batches):
        sums: dict[str, _PairSums] = {}
        for pdf in batches:
            for key, entries in zip(pdf["_by"], pdf["m"]):
                sums.setdefault(key, _PairSums()).add([e["sample"] for e in entries], np.array([e["v"] for e in entries], dtype=float), combine)
        for key, one in sums.items():
            yield one.frame().assign(_by=key)[["_by", "sample_a", "sample_b", "total"]]

    parts = rows.select("_by", "m").mapInPandas(add, "_by string, sample_a string, sample_b string, total double")
    whole = parts.groupBy("_by", "sample_a", "sample_b").agg(F.sum("total").alias("total"))
    return whole.withColumnRenamed("_by", by) if by else whole.drop("_by")


def _all_pairs(samples: DataFrame) -> DataFrame:
    a, b = samples.select(F.col("sample").alias("sample_a")), samples.select(F.col("sample").alias("sample_b"))
    return a.join(b, F.lit(True))  # sample sheet squared: the shape of the result


def bray_curtis(counts: DataFrame, samples: DataFrame, value: str = "per_million", by: str | None = None) -> DataFrame:
    """Sample x sample distance, from the sum of minima; two empty samples have distance 0. ``by``: for each label kind."""
    common = sample_pair_sums(counts, samples, "minimum", value, by)
    keys = [by] if by else []
    totals = counts.groupBy(*keys, "sample").agg(F.sum(value).alias("t"))
    a = totals.select(*keys, F.col("sample").alias("sample_a"), F.col("t").alias("ta"))
    b = totals.select(*keys, F.col("sample").alias("sample_b"), F.col("t").alias("tb"))
    every = _all_pairs(samples)
    every = every.join(counts.select(by).distinct(), F.lit(True)) if by else every  # a few label kinds
    out = every.join(common, [*keys, "sample_a", "sample_b"], "left").join(a, [*keys, "sample_a"], "left").join(b, [*keys, "sample_b"], "left")
    both = F.coalesce("ta", F.lit(0.0)) + F.coalesce("tb", F.lit(0.0))
    distance = 1.0 - 2.0 * F.coalesce("total", F.lit(0.0)) / F.nullif(both, F.lit(0.0))
    same = F.col("sample_a") == F.col("sample_b")
    return out.select(*keys, "sample_a", "sample_b", F.when(same, 0.0).otherwise(F.coalesce(distance, F.lit(0.0))).alias("distance"))


def centred_gram(counts: DataFrame, samples: DataFrame, value: str = "per_million") -> DataFrame:
    """Products of samples after removing the label means: the double-centred Gram matrix."""
    gram = _all_pairs(samples).join(sample_pair_sums(counts, samples, "product", value), ["sample_a", "sample_b"], "left")
    g = gram.withColumn("total", F.coalesce("total", F.lit(0.0)))
    rows = g.groupBy("sample_a").agg(F.avg("total").alias("ra"))
    columns = rows.select(F.col("sample_a").alias("sample_b"), F.col("ra").alias("rb"))
    grand = rows.agg(F.avg("ra").alias("ga"))
    joined = g.join(rows, "sample_a").join(columns, "sample_b").join(F.broadcast(grand), F.lit(True))
    return joined.select("sample_a", "sample_b", (F.col("total") - F.col("ra") - F.col("rb") + F.col("ga")).alias("value"))


# ---- comparisons and chords --------------------------------------------------------------


def comparison_ranking(comparison: DataFrame, arcs, length: int, key: str = "exact_deletion_id") -> DataFrame:
    """Events of each group pair by absolute difference, observations, id; pairs without evidence dropped."""
    total = F.coalesce("left_total_supporting_reads", F.lit(0)) + F.coalesce("right_total_supporting_reads", F.lit(0))
    usable = comparison.filter(
        "left_breakpoint is not null and right_breakpoint is not null and deleted_size is not null"
        " and difference_per_million_mt_reads is not null"
    ).withColumns({"absolute_difference": F.abs("difference_per_million_mt_reads"), "total_supporting_observations": total})
    order = [F.col("absolute_difference").desc(), F.col("total_supporting_observations").desc(), key]
    ranked = numbered_in_groups(usable.filter("total_supporting_observations >= 1"), ["left_group", "right_group"], order, "comparison_rank")
    return with_arc_context(ranked.drop("replication_arc_context", "minor_arc_deleted_bp", "major_arc_deleted_bp"), arcs, length)


def chord_table(locations: DataFrame, length: int) -> DataFrame:
    """Events with the angles of both ends."""
    return locations.withColumns(
        {
            "left_angle_degrees_clockwise_from_coordinate_1": C.angle_degrees("left_breakpoint", length),
            "right_angle_degrees_clockwise_from_coordinate_1": C.angle_degrees("right_breakpoint", length),
        }
    )


def chord_summary(locations: DataFrame) -> DataFrame:
    """Events and support range per group."""
    return locations.groupBy("plot_group").agg(
        F.count(F.lit(1)).alias("loaded_deletions"), F.min("plot_support").alias("support_min"), F.max("plot_support").alias("support_max")
    )


def linked_thresholds(locations: DataFrame, observations: int, size: int, support: float) -> DataFrame:
    """Lowest support that still shows every event with enough observations, and the reverse."""
    big = F.col("deleted_size") >= size
    return locations.groupBy("plot_group").agg(
        F.coalesce(
            F.min(F.when(big & (F.col("supporting_reads") >= observations), F.col("plot_support"))), F.max("plot_support")
        ).alias("support_threshold"),
        F.coalesce(F.min(F.when(big & (F.col("plot_support") >= support), F.col("supporting_reads"))), F.lit(0)).alias("observation_threshold"),
    )


# fixed values: significance presets of the comparison view (column, upper limit)
PRESETS = {
    "all": (None, 1.0),
    "replicate-significant": ("q_value_bh", 0.05),
    "replicate-suggestive": ("p_value", 0.05),
    "depth-significant": ("read_depth_fisher_q_value_bh", 0.05),
}


def comparison_preset(ranked: DataFrame, preset="all", min_observations=1, min_difference=0.0, direction="both") -> DataFrame:
    """Rows that pass a preset, the observation and effect limits and a direction."""
    column, limit = PRESETS.get(preset, PRESETS["all"])
    keep = (F.col("total_supporting_observations") >= min_observations) & (F.col("absolute_difference") >= min_difference)
    if column:
        keep = keep & F.coalesce(F.col(column) <= limit, F.lit(False))
    change = F.col("difference_per_million_mt_reads")
    if direction in ("left", "right"):
        keep = keep & ((change > 0) if direction == "right" else (change < 0))
    return ranked.filter(keep)


def group_order(samples: DataFrame, group: str) -> DataFrame:
    """Groups with their display position: age, then control-like treatments, then name."""
    name = F.coalesce(F.col(group).cast("string"), F.lit("missing"))
    if {"age", "treatment"} <= set(samples.columns):
        first = F.min_by(F.struct("age", "treatment"), F.col("sample_ord"))
        reps = samples.groupBy(name.alias("group")).agg(first.alias("_f"))
        keys = [number_in(F.col("_f.age")), F.lower("_f.age"), control_rank(F.col("_f.treatment")), F.lower("_f.treatment"), F.col("group")]
    else:
        reps = samples.select(name.alias("group")).distinct()
        keys = [control_rank(F.col("group")), F.lower("group"), number_in(F.col("group")), F.col("group")]
    # one row per group of the sample sheet
    return reps.withColumn("position", F.row_number().over(W.partitionBy(F.lit(1)).orderBy(*keys))).select("group", "position")


def group_means(burden: DataFrame, columns: list[str], value: str) -> DataFrame:
    """Mean, sample count and sample list per group or per cell of several factors."""
    return burden.filter(F.col(value).isNotNull()).groupBy(*columns).agg(
        F.avg(value).alias("mean_value"), F.count(F.lit(1)).alias("sample_count"),
        F.array_join(F.array_sort(F.collect_set("sample")), "; ").alias("samples"),
    )


def _decade(value: Column) -> Column:
    return F.pow(F.lit(10.0), F.floor(F.log10(value)))


def nice_floor(value: Column) -> Column:
    """Largest 1-2-5 value that is not above (positive input)."""
    scaled = value / _decade(value)
    return F.when(value <= 0, 0.0).otherwise(F.when(scaled < 2, 1.0).when(scaled < 5, 2.0).otherwise(5.0) * _decade(value))


def nice_ceiling(value: Column) -> Column:
    """Smallest 1-2-5 value that is not below (positive input)."""
    scaled = value / _decade(value)
    mantissa = F.when(scaled <= 1, 1.0).when(scaled <= 2, 2.0).when(scaled <= 5, 5.0).otherwise(10.0)
    return F.when(value <= 0, 0.0).otherwise(mantissa * _decade(value))


def nice_value(value: Column) -> Column:
    """Nearest 1-2-5 value by the fixed cuts 1.5, 3.5, 7.5."""
    scaled = value / _decade(value)
    mantissa = F.when(scaled <= 1.5, 1.0).when(scaled <= 3.5, 2.0).when(scaled <= 7.5, 5.0).otherwise(10.0)
    return F.when(value <= 0, 0.0).otherwise(mantissa * _decade(value))


def scale_limits(locations: DataFrame, value: str = "plot_support") -> DataFrame:
    """1-2-5 limits of the positive values and their 96th percentile, one row."""
    positive = F.when(F.col(value) > 0, F.col(value))
    row = locations.agg(F.min(positive).alias("support_min"), F.max(positive).alias("support_max"),
                        F.percentile(positive, F.lit(0.96)).alias("cap"))
    low, high = F.col("support_min"), F.col("support_max")
    return row.select(
        "support_min", "support_max", "cap",
        F.when(high.isNull(), 1.0).when(low >= high, nice_value(high)).otherwise(nice_floor(low)).alias("scale_low"),
        F.when(high.isNull(), 1.0).when(low >= high, nice_value(high)).otherwise(nice_ceiling(high)).alias("scale_high"),
    )


TECHNICAL_SUFFIXES = ("_denominator", "_read_count", "_reads_examined", "_reads", "_read_total")


def value_columns(matrix: DataFrame, metadata: list[str]) -> list[str]:
    """Label columns of an imported wide matrix: numeric, not metadata, not technical."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [
        f.name for f in matrix.schema.fields
        if f.name not in metadata and not f.name.endswith(TECHNICAL_SUFFIXES)
        and (f.dataType.simpleString() in numeric or f.dataType.simpleString().startswith("decimal"))
    ]


def melt(matrix: DataFrame, metadata: list[str], value: str = "reads") -> DataFrame:
    """An imported wide matrix in long form."""
    return matrix.unpivot(["sample"], value_columns(matrix, metadata), "label", value)


def melt_rows(wide: DataFrame, keys: list[str], value: str = "reads") -> DataFrame:
    """V21 of the form that ``matrix.wide_rows`` makes: one row for each label again."""
    pairs = F.arrays_zip("labels", "values")
    return wide.select(*keys, F.explode(pairs).alias("x")).select(*keys, F.col("x.labels").alias("label"), F.col("x.values").alias(value))
