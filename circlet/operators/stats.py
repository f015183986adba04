"""Group comparisons and models."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from circlet.functions import pvalues as P
from circlet.params import Params

MILLION = 1_000_000.0
PAIR = ("left_group", "right_group")


# ---- false discovery rate ----------------------------------------------------------------


def adjust(df: DataFrame, p_col: str, q_col: str, family: list[str] | None = None, buckets: int = 256) -> DataFrame:
    """Benjamini-Hochberg over each family (the whole table by default); nulls stay null.

    Equal p-values share one q, so the work is on distinct p-values with counts. They are cut into
    ranges at approximate quantiles; ranks and the running minimum are computed inside ranges and
    carried across them through one small row per range, so no task holds the whole table.
    """
    family = family or []
    p = F.col(p_col)
    # a constant stands in for "the whole table" so that joins and groupings always have a key
    keyed = df.withColumn("_f", F.to_json(F.struct(*family)) if family else F.lit("all"))
    points = keyed.filter(p.isNotNull() & ~F.isnan(p)).groupBy("_f", p.cast("double").alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    cuts = points.groupBy("_f").agg(
        F.percentile_approx("_p", [i / buckets for i in range(1, buckets)], 10_000).alias("_cuts")
    )
    cut = points.join(F.broadcast(cuts) if not family else cuts, "_f")
    cut = cut.withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col("_p")))).drop("_cuts")
    sizes = cut.groupBy("_f", "_b").agg(F.sum("_c").alias("_n"))
    wf = W.partitionBy("_f").orderBy("_b")
    sizes = sizes.withColumns(
        {
            "_before": F.coalesce(F.sum("_n").over(wf.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "_total": F.sum("_n").over(W.partitionBy("_f")),
        }
    )
    ranked = cut.join(sizes, ["_f", "_b"])
    up = W.partitionBy("_f", "_b").orderBy("_p").rowsBetween(W.unboundedPreceding, W.currentRow)
    down = W.partitionBy("_f", "_b").orderBy(F.col("_p").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    raw = ranked.withColumn("_raw", F.col("_p") * F.col("_total") / (F.col("_before") + F.sum("_c").over(up)))
    local = raw.withColumn("_local", F.min("_raw").over(down))
    mins = local.groupBy("_f", "_b").agg(F.min("_raw").alias("_m"))
    later = mins.withColumn(
        "_later", F.min("_m").over(W.partitionBy("_f").orderBy(F.col("_b").desc()).rowsBetween(W.unboundedPreceding, -1))
    ).drop("_m")
    q = local.join(later, ["_f", "_b"]).select("_f", "_p", F.least(F.lit(1.0), F.col("_local"), F.col("_later")).alias(q_col))
    return keyed.withColumn("_p", p.cast("double")).join(q, ["_f", "_p"], "left").drop("_f", "_p")


# ---- comparisons per label ---------------------------------------------------------------


def group_sizes(samples: DataFrame, group: str) -> DataFrame:
    """Groups with size, first appearance in the sample sheet and summed depth (a few rows)."""
    return samples.filter(F.col(group).isNotNull()).groupBy(F.col(group).alias("group")).agg(
        F.min("sample_ord").alias("ord"), F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("normalization_reads", F.lit(0.0))).alias("depth")
    )


def group_pairs(samples: DataFrame, group: str) -> DataFrame:
    """All group pairs, the group that appears first in the sample sheet on the left."""
    g = group_sizes(samples, group)
    left = g.select(*[F.col(c).alias(f"left_{c}") for c in g.columns])
    right = g.select(*[F.col(c).alias(f"right_{c}") for c in g.columns])
    return left.join(right, F.col("left_ord") < F.col("right_ord")).drop("left_ord", "right_ord")


def _u_statistics(values: DataFrame, keys: list[str]) -> DataFrame:
    """U of the left side and the tie term, from non-zero values only.

    ``values``: keys, ``is_left``, ``value`` > 0, and the numbers of zeros ``zeros_left``/``zeros_right``.
    All zeros tie below every value, so they never have to be materialised.
    """
    w = W.partitionBy(*keys).orderBy("value")
    ties = W.partitionBy(*keys, "value")
    zeros = F.col("zeros_left") + F.col("zeros_right")
    ranked = values.withColumns({"_tied": F.count(F.lit(1)).over(ties), "_rank": F.rank().over(w)})
    rank = zeros + F.col("_rank") + (F.col("_tied") - 1) / F.lit(2.0)
    per = ranked.groupBy(*keys).agg(
        F.sum(F.when(F.col("is_left"), rank)).alias("_rank_sum"),
        # summing (t^2 - 1) over the t tied values gives t^3 - t
        F.sum(F.col("_tied") * F.col("_tied") - 1).cast("double").alias("_tie"),
    )
    return per


def compare_groups(counts: DataFrame, samples: DataFrame, group: str, p: Params, keys=("label",)) -> DataFrame:
    """Every label between every two groups.

    ``counts`` is long and sparse (keys, sample, reads, per_million); absent samples count as zero
    through the group sizes, so zeros are never stored. Sums per group are one aggregate per label;
    the rank test runs on the non-zero values of the two groups.
    """
    keys = list(keys)
    pairs = F.broadcast(group_pairs(samples, group))  # one row per pair of groups in the sample sheet
    placed = counts.join(samples.select("sample", F.col(group).alias("group")), "sample").filter("group is not null")
    sums = placed.groupBy(*keys, "group").agg(
        F.sum("per_million").alias("pm"), F.sum("reads").alias("reads"),
        F.count_if(F.col("reads") > 0).alias("signal"), F.count_if(F.col("per_million") > 0).alias("values"),
    )
    by_group = sums.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("group", F.struct("pm", "reads", "signal", "values")))).alias("_g")
    )
    # labels of samples without a group still get their (zero) rows
    every = counts.select(*keys).distinct().join(by_group, keys, "left")
    table = every.join(pairs, F.lit(True))

    def of(side, field, zero):
        return F.coalesce(F.try_element_at(F.col("_g"), F.col(f"{side}_group"))[field], F.lit(zero))

    table = table.withColumns(
        {f"_{s}_{f}": of(s, f, z) for s in ("left", "right") for f, z in (("pm", 0.0), ("reads", 0), ("signal", 0), ("values", 0))}
    )
    left_mean, right_mean = F.col("_left_pm") / F.col("left_n"), F.col("_right_pm") / F.col("right_n")
    table = table.withColumns({"_lm": left_mean, "_rm": right_mean})
    values = placed.filter("per_million > 0").select(*keys, "group", F.col("per_million").alias("value"))
    sided = values.join(pairs, (F.col("group") == F.col("left_group")) | (F.col("group") == F.col("right_group")))
    sided = sided.join(
        table.select(*keys, *PAIR, (F.col("left_n") - F.col("_left_values")).alias("zeros_left"),
                     (F.col("right_n") - F.col("_right_values")).alias("zeros_right")),
        [*keys, *PAIR],
    ).withColumn("is_left", F.col("group") == F.col("left_group"))
    ranks = _u_statistics(sided, [*keys, *PAIR])
    out = table.join(ranks, [*keys, *PAIR], "left")
    zl, zr = F.col("left_n") - F.col("_left_values"), F.col("right_n") - F.col("_right_values")
    z = (zl + zr).cast("double")
    n1, n2 = F.col("left_n").cast("double"), F.col("right_n").cast("double")
    u = zl * (z + 1) / 2 + F.coalesce("_rank_sum", F.lit(0.0)) - n1 * (n1 + 1) / 2
    tie = F.coalesce("_tie", F.lit(0.0)) + z * z * z - z
    lm, rm = F.col("_lm"), F.col("_rm")
    pseudo = F.lit(p.log2_pseudocount)
    out = out.withColumns({"mann_whitney_u": u, "tie_term": tie})
    ld, rd = F.floor("left_depth"), F.floor("right_depth")
    return out.select(
        *keys, F.lit(group).alias("group_column"), *PAIR,
        lm.alias("left_mean_per_million_mt_reads"), rm.alias("right_mean_per_million_mt_reads"),
        (rm - lm).alias("difference_per_million_mt_reads"),
        F.when((lm <= 0) & (rm <= 0), "absent_in_both_groups").when(lm <= 0, "present_only_in_right_group")
        .when(rm <= 0, "present_only_in_left_group").when(rm > lm, "higher_in_right_group")
        .when(rm < lm, "higher_in_left_group").otherwise("same_group_mean").alias("abundance_change"),
        F.log2((rm + pseudo) / (lm + pseudo)).alias("log2_fold_change_right_over_left"),
        pseudo.alias("log2_fold_change_pseudocount_per_million"),
        F.when((lm > 0) & (rm > 0), rm / lm).alias("fold_change_right_over_left"),
        F.col("_left_reads").alias("left_total_supporting_reads"), F.col("_right_reads").alias("right_total_supporting_reads"),
        (F.col("_left_signal") + F.col("_right_signal")).alias("samples_with_signal"),
        "mann_whitney_u", "tie_term", F.col("left_n"), F.col("right_n"),
        F.lit("mann_whitney_u_normalized_support").alias("test"),
        P.mwu_p("mann_whitney_u", "left_n", "right_n", "tie_term").alias("p_value"),
        P.fisher(F.col("_left_reads"), F.col("_right_reads"), F.col("left_n") - F.col("_left_signal"),
                 F.col("right_n") - F.col("_right_signal")).alias("fisher_presence_p"),
        P.fisher(F.col("_left_reads"), F.greatest(ld - F.col("_left_reads"), F.lit(0)),
                 F.col("_right_reads"), F.greatest(rd - F.col("_right_reads"), F.lit(0))).alias("read_depth_fisher_p"),
    )


def with_q_values(comparison: DataFrame, family: list[str] | None = None) -> DataFrame:
    """A12 on both p-values of a comparison table."""
    first = adjust(comparison, "p_value", "q_value_bh", family)
    return adjust(first, "read_depth_fisher_p", "read_depth_fisher_q_value_bh", family)


EVENT_COLUMNS = ("left_breakpoint", "right_breakpoint", "deleted_size", "wraps_origin", "replication_arc_context",
                 "minor_arc_deleted_bp", "major_arc_deleted_bp", "affected_feature_label", "feature_impact_class",
                 "known_deletion_label")


def with_event_columns(comparison: DataFrame, clusters: DataFrame, label: str = "label") -> DataFrame:
    """A21."""
    taken = [c for c in EVENT_COLUMNS if c in clusters.columns]
    events = clusters.select(F.col("exact_deletion_id").alias(label), *taken).dropDuplicates([label])
    return comparison.join(events, label, "left")


# ---- metadata associations ---------------------------------------------------------------

NUMBER = r"([-+]?\d*\.?\d+)"


def numeric_metadata(samples: DataFrame, column: str) -> Column | None:
    """Numeric reading of a metadata column: the values, else their first number, else None."""
    text = F.col(column).cast("string")
    direct = text.try_cast("double")
    found = F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), NUMBER, 1), F.lit("")).try_cast("double")
    row = samples.agg(F.count(F.lit(1)), F.count(direct), F.count(found)).first()
    enough = max(3, row[0] // 2)
    if row[1] >= enough:
        return direct
    return found if row[2] >= enough else None


def _average_rank(value: str, keys: list[str]) -> Column:
    w = W.partitionBy(*keys).orderBy(value)
    return F.rank().over(w) + (F.count(F.lit(1)).over(W.partitionBy(*keys, value)) - 1) / F.lit(2.0)


OUTCOMES = ("deletion_support_per_million_mt_reads", "unique_exact_deletions")


def burden_associations(burden: DataFrame, columns: list[str], outcomes=OUTCOMES) -> DataFrame | None:
    """Rank correlation and slope for numeric metadata, rank test for two-level metadata."""
    parts = []
    for column in columns:
        if column not in burden.columns:
            continue
        levels = burden.agg(F.count_distinct(column)).first()[0]
        if levels < 2:
            continue
        x = numeric_metadata(burden, column)
        base = burden.select(
            F.col(column).cast("string").alias("level"), (x if x is not None else F.lit(None).cast("double")).alias("x"),
            F.explode(F.create_map(*[v for o in outcomes for v in (F.lit(o), F.coalesce(F.col(o).cast("double"), F.lit(0.0)))])).alias("outcome", "y"),
        )
        if x is not None:
            parts.append(_numeric_association(base.filter("x is not null"), column))
        elif levels == 2:
            parts.append(_categorical_association(base.filter("level is not null"), column))
    if not parts:
        return None
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return adjust(out, "p_value", "q_value_bh")


def _numeric_association(base: DataFrame, column: str) -> DataFrame:
    ranked = base.withColumns({"rx": _average_rank("x", ["outcome"]), "ry": _average_rank("y", ["outcome"])})
    per = ranked.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"), F.corr("rx", "ry").alias("spearman_rho"), F.corr("x", "y").alias("_r"),
        F.regr_slope("y", "x").alias("linear_slope"),
    ).filter("n >= 3")
    return per.select(
        F.lit(column).alias("metadata_column"), F.lit("numeric_or_ordered").alias("metadata_type"), "outcome",
        F.lit("spearman_and_linear_regression").alias("test"), "spearman_rho", "linear_slope",
        P.corr_p("spearman_rho", "n").alias("p_value"), P.corr_p("_r", "n").alias("linear_p"),
    )


def _categorical_association(base: DataFrame, column: str) -> DataFrame:
    first = F.min("level").over(W.partitionBy("outcome"))
    ranked = base.withColumns(
        {"is_left": F.col("level") == first, "_rank": _average_rank("y", ["outcome"]),
         "_tied": F.count(F.lit(1)).over(W.partitionBy("outcome", "y"))}
    )
    left, right = F.col("is_left"), ~F.col("is_left")
    per = ranked.groupBy("outcome").agg(
        F.min(F.when(left, F.col("level"))).alias("left_group"), F.min(F.when(right, F.col("level"))).alias("right_group"),
        F.avg(F.when(left, F.col("y"))).alias("left_mean"), F.avg(F.when(right, F.col("y"))).alias("right_mean"),
        F.count_if(left).alias("n1"), F.count_if(right).alias("n2"),
        F.sum(F.when(left, F.col("_rank"))).alias("_rs"), F.sum(F.col("_tied") * F.col("_tied") - 1).cast("double").alias("tie"),
    )
    u = F.col("_rs") - F.col("n1") * (F.col("n1") + 1) / F.lit(2.0)
    return per.withColumn("mann_whitney_u", u).select(
        F.lit(column).alias("metadata_column"), F.lit("categorical").alias("metadata_type"), "outcome",
        F.lit("mann_whitney_u").alias("test"), "left_group", "right_group", "left_mean", "right_mean", "mann_whitney_u",
        P.mwu_p("mann_whitney_u", "n1", "n2", "tie").alias("p_value"),
    )


# ---- deletion sizes ----------------------------------------------------------------------


def size_tests(evidence: DataFrame, samples: DataFrame, group: str) -> DataFrame:
    """Size distributions of two groups: largest gap of the running shares, and the rank test.

    Reads are first counted per (group, size); sizes lie on the circle, so everything after that is
    at most one row per group and size.
    """
    placed = evidence.join(samples.select("sample", F.col(group).alias("group")), "sample").filter(
        "group is not null and deleted_size is not null"
    )
    sizes = placed.groupBy("group", F.col("deleted_size").alias("size")).agg(F.count(F.lit(1)).alias("c"))
    medians = sizes.groupBy("group").agg(F.percentile("size", F.lit(0.5), F.col("c")).alias("median"), F.sum("c").alias("n"))
    pairs = group_pairs(samples, group).select(*PAIR)
    sided = sizes.join(F.broadcast(pairs), (F.col("group") == F.col("left_group")) | (F.col("group") == F.col("right_group")))
    both = sided.groupBy(*PAIR, "size").agg(
        F.sum(F.when(F.col("group") == F.col("left_group"), F.col("c")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("group") == F.col("right_group"), F.col("c")).otherwise(0)).alias("b"),
    )
    w = W.partitionBy(*PAIR).orderBy("size").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*PAIR)
    run = both.withColumns(
        {"ca": F.sum("a").over(w), "cb": F.sum("b").over(w), "na": F.sum("a").over(whole), "nb": F.sum("b").over(whole)}
    ).filter("na > 0 and nb > 0")
    t = F.col("a") + F.col("b")
    # average rank of a tied block: all before it, plus half of it
    rank = (F.col("ca") + F.col("cb")) - (t - 1) / F.lit(2.0)
    per = run.groupBy(*PAIR).agg(
        F.max(F.abs(F.col("ca") / F.col("na") - F.col("cb") / F.col("nb"))).alias("ks_d"),
        F.sum(rank * F.col("a")).alias("_rs"), F.first("na").alias("na"), F.first("nb").alias("nb"),
        F.sum(t.cast("double") * t * t - t).alias("tie"),
    )
    left = medians.select(F.col("group").alias("left_group"), F.col("median").alias("left_median_deleted_size"))
    right = medians.select(F.col("group").alias("right_group"), F.col("median").alias("right_median_deleted_size"))
    wide = per.join(left, "left_group").join(right, "right_group")
    u = F.col("_rs") - F.col("na") * (F.col("na") + 1) / F.lit(2.0)
    common = [
        F.lit(group).alias("group_column"), *map(F.col, PAIR), F.col("na").alias("left_n_deletion_supporting_reads"),
        F.col("nb").alias("right_n_deletion_supporting_reads"), F.col("left_median_deleted_size"), F.col("right_median_deleted_size"),
    ]
    wide = wide.withColumn("mann_whitney_u", u)
    ks = wide.select(*common, F.lit("kolmogorov_smirnov_unweighted_deletion_sizes").alias("test"), F.col("ks_d").alias("statistic"),
                     P.ks("ks_d", "na", "nb").alias("p_value"))
    mwu = wide.select(*common, F.lit("mann_whitney_u_unweighted_deletion_sizes").alias("test"),
                      F.col("mann_whitney_u").alias("statistic"), P.mwu_p("mann_whitney_u", "na", "nb", "tie").alias("p_value"))
    return adjust(ks.unionByName(mwu), "p_value", "q_value_bh")


def sample_size_metrics(evidence: DataFrame, samples: DataFrame) -> DataFrame:
    """Median deleted size and per-million support of size ranges per sample."""
    size = F.col("deleted_size")
    per = evidence.groupBy("sample").agg(
        F.percentile("deleted_size", F.lit(0.5)).alias("median_deletion_size"),
        F.count_if(size >= 5000).alias("_large"), F.count_if(size < 1000).alias("_small"),
        F.count_if((size >= 1000) & (size < 5000)).alias("_medium"),
    )
    reads = F.coalesce("normalization_reads", F.lit(0.0))
    weight = F.when(reads > 0, MILLION / F.nullif(reads, F.lit(0.0))).otherwise(0.0)
    joined = per.join(samples.select("sample", "normalization_reads"), "sample", "left")
    return joined.select(
        "sample", "median_deletion_size",
        (F.col("_large") * weight).alias("large_deletion_support_per_million_mt_reads"),
        (F.col("_small") * weight).alias("small_lt_1kb_support_per_million_mt_reads"),
        (F.col("_medium") * weight).alias("medium_1kb_to_4999bp_support_per_million_mt_reads"),
    )


def size_bins(evidence: DataFrame, samples: DataFrame, group: str) -> DataFrame:
    """Support and its split over three size ranges per group."""
    per = evidence.filter("deleted_size is not null").groupBy("sample", "deleted_size").agg(F.count(F.lit(1)).alias("c"))
    placed = per.join(samples.select("sample", F.col(group).cast("string").alias("group"), "normalization_reads"), "sample").filter("group is not null")
    reads = F.coalesce("normalization_reads", F.lit(0.0))
    support = F.col("c") * F.when(reads > 0, MILLION / F.nullif(reads, F.lit(0.0))).otherwise(0.0)
    size = F.col("deleted_size")
    ranges = {"small_lt_1kb": size < 1000, "medium_1kb_to_4999bp": (size >= 1000) & (size < 5000), "large_ge_5kb": size >= 5000}
    name = "{}_support_per_million_mt_reads".format
    out = placed.withColumn("_s", support).groupBy("group").agg(
        F.sum("c").alias("n_deletion_supporting_reads"),
        F.percentile("deleted_size", F.lit(0.5), F.col("c")).alias("median_deletion_size"),
        F.sum("_s").alias("total_support_per_million_mt_reads"),
        *[F.sum(F.when(test, F.col("_s")).otherwise(0.0)).alias(name(k)) for k, test in ranges.items()],
    )
    total = F.nullif("total_support_per_million_mt_reads", F.lit(0.0))
    return out.withColumns({f"{k}_fraction_of_support": F.col(name(k)) / total for k in ranges})


# ---- factorial model ---------------------------------------------------------------------

FIRST_NUMBER = r"(\d+(?:\.\d+)?)"


def number_in(text: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(text, FIRST_NUMBER, 1), F.lit("")).cast("double"), F.lit(1e9))


def control_rank(text: Column) -> Column:
    """0 for a control-like level."""
    low = F.lower(text)
    return F.when(low.contains("control") | low.isin("ctrl", "vehicle", "untreated"), 0).otherwise(1)


def _levels(samples: DataFrame, column: str, control_first: bool) -> list[str]:
    """Factor levels in model order; at most three are fetched, since only two-level factors are modelled."""
    text = F.col(column).cast("string")
    levels = samples.filter(text.isNotNull()).select(text.alias("v")).distinct()
    order = ([control_rank(F.col("v"))] if control_first else []) + [number_in(F.lower("v")), F.lower("v")]
    return [r[0] for r in levels.orderBy(*order).limit(3).collect()]


MODEL_OUTCOMES = (*OUTCOMES, "median_deletion_size", "large_deletion_support_per_million_mt_reads",
                  "small_lt_1kb_support_per_million_mt_reads", "medium_1kb_to_4999bp_support_per_million_mt_reads")


def factorial_model(metrics: DataFrame, outcomes=MODEL_OUTCOMES) -> DataFrame | None:
    """Two-by-two model with interaction per outcome, from cell means.

    ``metrics`` has one row per sample with age, treatment and the outcomes. Returns None unless both
    factors have exactly two levels. With an empty cell the model is not of full rank and the
    minimum-norm solution is taken from the four cell sums.
    """
    ages, treatments = _levels(metrics, "age", False), _levels(metrics, "treatment", True)
    if len(ages) != 2 or len(treatments) != 2:
        return None
    have = [o for o in outcomes if o in metrics.columns]
    values = F.array(*[F.struct(F.lit(o).alias("outcome"), F.col(o).cast("double").alias("y")) for o in have])
    long = metrics.select(
        (F.col("age").cast("string") == ages[1]).cast("int").alias("a"),
        (F.col("treatment").cast("string") == treatments[1]).cast("int").alias("t"),
        F.inline(values),
    ).filter("y is not null")
    cell = F.col("a") * 2 + F.col("t")
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in range(4):
        inside = F.when(cell == c, F.col("y"))
        aggs += [F.count(inside).alias(f"n{c}"), F.coalesce(F.avg(inside), F.lit(0.0)).alias(f"m{c}"),
                 F.coalesce(F.var_pop(inside) * F.count(inside), F.lit(0.0)).alias(f"s{c}")]
    cells = long.groupBy("outcome").agg(*aggs).filter("n >= 5")
    full = cells.filter("n0 > 0 and n1 > 0 and n2 > 0 and n3 > 0")
    m, n = [F.col(f"m{c}") for c in range(4)], [F.col(f"n{c}") for c in range(4)]
    sigma2 = (F.col("s0") + F.col("s1") + F.col("s2") + F.col("s3")) / (F.col("n") - 4)
    inv = [1.0 / k for k in n]
    terms = F.array(
        F.struct(F.lit("age").alias("term"), (m[2] - m[0]).alias("estimate"), F.sqrt(sigma2 * (inv[0] + inv[2])).alias("standard_error")),
        F.struct(F.lit("treatment").alias("term"), (m[1] - m[0]).alias("estimate"), F.sqrt(sigma2 * (inv[0] + inv[1])).alias("standard_error")),
        F.struct(F.lit("age:treatment").alias("term"), (m[3] - m[2] - m[1] + m[0]).alias("estimate"), F.sqrt(sigma2 * (inv[0] + inv[1] + inv[2] + inv[3])).alias("standard_error")),
    )
    solved = full.filter("n > 4").select("outcome", (F.col("n") - 4).cast("int").alias("degrees_of_freedom"), F.inline(terms))
    partial = cells.filter("not (n0 > 0 and n1 > 0 and n2 > 0 and n3 > 0) and n > 4")
    solved = solved.unionByName(partial.groupBy("outcome").applyInPandas(_minimum_norm, solved.schema))
    contrast = (
        F.when(F.col("term") == "age", f"{ages[1]} vs {ages[0]}")
        .when(F.col("term") == "treatment", f"{treatments[1]} vs {treatments[0]}")
        .otherwise(f"extra {treatments[1]} effect in {ages[1]}")
    )
    error = F.when(F.col("standard_error") > 0, F.col("standard_error"))
    out = solved.withColumn("standard_error", error).withColumn("t_statistic", F.col("estimate") / F.col("standard_error"))
    out = out.select(
        "outcome", "term", contrast.alias("contrast"), "estimate",
        F.when(F.col("estimate") > 0, "positive").when(F.col("estimate") < 0, "negative").otherwise("zero").alias("direction"),
        "standard_error", "t_statistic", "degrees_of_freedom", P.t_p("t_statistic", "degrees_of_freedom").alias("p_value"),
    )
    return adjust(out, "p_value", "q_value_bh")


def _minimum_norm(pdf: pd.DataFrame) -> pd.DataFrame:
    """One outcome, four cell summaries: least squares of minimum norm."""
    row = pdf.iloc[0]
    n = np.array([row[f"n{c}"] for c in range(4)], dtype=float)
    mean = np.array([row[f"m{c}"] for c in range(4)], dtype=float)
    design = np.array([[1, 0, 0, 0], [1, 0, 1, 0], [1, 1, 0, 0], [1, 1, 1, 1]], dtype=float)
    inverse = np.linalg.pinv(design.T @ (design * n[:, None]))
    beta = inverse @ (design.T @ (n * mean))
    dof = int(n.sum()) - 4
    sse = sum(row[f"s{c}"] for c in range(4)) + float((n * (mean - design @ beta) ** 2).sum())
    error = np.sqrt(np.clip(np.diag(sse / dof * inverse), 0.0, None))
    return pd.DataFrame(
        {"outcome": row["outcome"], "degrees_of_freedom": dof, "term": ["age", "treatment", "age:treatment"],
         "estimate": beta[1:], "standard_error": error[1:]}
    )
