"""Local reference support around breakpoints."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circlet.durable import materialize
from circlet.functions import coords as C
from circlet.functions import reads as R
from circlet.params import Params

KEY = ("species", "leader_left", "leader_right")


def eligible_samples(clusters: DataFrame, obs: DataFrame | None) -> DataFrame:
    """(cluster, sample) pairs with remap support; without observations, the listed samples."""
    if obs is not None and "minimap2_support" in obs.columns:
        return obs.filter("minimap2_support").select(*KEY, "sample").distinct()
    return clusters.select(*KEY, F.explode("supporting_samples").alias("sample")).filter("sample <> ''").distinct()


def candidate_positions(clusters: DataFrame, eligible: DataFrame) -> DataFrame:
    """Breakpoints of eligible events per sample."""
    ends = clusters.select(*KEY, F.explode(F.array("left_breakpoint", "right_breakpoint")).alias("position"))
    return ends.join(eligible, list(KEY)).select("sample", "position").distinct()


def primary_blocks(alignments: DataFrame, p: Params) -> DataFrame:
    """Standard-coordinate blocks of primary alignments, split at the origin: (sample, rotation_name, name, start, end)."""
    primary = ~(R.has_flag("flag", 4) | R.has_flag("flag", 256) | R.has_flag("flag", 2048))
    kept = alignments.filter(primary & (F.col("mapq") >= p.min_mapq)).select(
        "sample", "rotation_name", "rotation_start", F.col("query_name").alias("name"), F.col("pos").cast("int").alias("pos"), F.coalesce("cigar", F.lit("")).alias("cigar")
    )
    raw = aligned_blocks(kept)
    pieces = C.block_pieces(F.col("start"), F.col("end"), p.length, F.col("rotation_start"))
    return raw.select("sample", "rotation_name", "name", F.explode(pieces).alias("b")).select(
        "sample", "rotation_name", "name", "b.start", "b.end"
    )


def aligned_blocks(rows: DataFrame) -> DataFrame:
    """Gapless aligned blocks (``start``, ``end``, closed) of rows with ``pos`` and ``cigar``, which the result no longer has.

    The operations of a batch become one array each of letters and lengths; running sums of what they consume of the
    reference give all places at once, so a long CIGAR costs its length. Rows without a position have no block.
    """
    others = [c for c in rows.columns if c not in ("pos", "cigar")]
    schema = T.StructType([*[rows.schema[c] for c in others], *T._parse_datatype_string("start int, end int").fields])

    def run(batches):
        for batch in batches:
            cigars = batch.column(batch.schema.get_field_index("cigar")).to_pylist()
            found = [re.findall("([0-9]+)([MIDNSHP=X])", c) for c in cigars]
            count = np.array([len(f) for f in found], dtype=np.int64)
            length = np.array([int(n) for f in found for n, _ in f], dtype=np.int64)
            letter = np.array([op for f in found for _, op in f], dtype="U1")
            row = np.repeat(np.arange(len(found)), count)
            used = np.where(np.isin(letter, list("MDN=X")), length, 0)
            after = np.cumsum(used)
            first = np.cumsum(count) - count
            before = np.append(0, after)[first]  # consumed ahead of each row
            pos = batch.column(batch.schema.get_field_index("pos"))
            base = pc.fill_null(pos, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            start = base[row] + after - used - before[row]
            keep = np.isin(letter, list("M=X")) & (length > 0) & pos.is_valid().to_numpy(zero_copy_only=False)[row]
            at = pa.array(row[keep])
            columns = [batch.column(batch.schema.get_field_index(c)).take(at) for c in others]
            ends = (start + length - 1)[keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(start[keep].astype(np.int32)), pa.array(ends.astype(np.int32))], names=schema.names)

    return rows.mapInArrow(run, schema)


def _profile(steps: DataFrame, positions: DataFrame) -> DataFrame:
    """Running sum of +1/-1 steps, read off at the wanted positions.

    Steps are summed per position before the window, so a window holds at most two rows per
    position of the circle whatever the depth.
    """
    key = ["sample", "rotation_name"]
    # at most one row per position of the circle, sample and rotation: written once, used twice
    summed = materialize(steps.groupBy(*key, "position").agg(F.sum("step").alias("step")), "edges")
    rotations = summed.select(*key).distinct()
    wanted = positions.join(rotations, "sample").select(*key, "position", F.lit(0).cast("long").alias("step"), F.lit(True).alias("asked"))
    both = summed.withColumn("asked", F.lit(False)).unionByName(wanted).groupBy(*key, "position").agg(F.sum("step").alias("step"), F.max("asked").alias("asked"))
    w = W.partitionBy(*key).orderBy("position").rowsBetween(W.unboundedPreceding, W.currentRow)
    return both.withColumn("depth", F.sum("step").over(w)).filter("asked").select(*key, "position", "depth")


def _edges(intervals: DataFrame) -> DataFrame:
    """Closed intervals (low, high) -> +1 at low, -1 after high."""
    one = F.array(
        F.struct(F.col("low").alias("position"), F.lit(1).cast("long").alias("step")),
        F.struct((F.col("high") + 1).alias("position"), F.lit(-1).cast("long").alias("step")),
    )
    return intervals.filter("low <= high").select("sample", "rotation_name", F.explode(one).alias("e")).select(
        "sample", "rotation_name", "e.position", "e.step"
    )


def spanning_reads(blocks: DataFrame, positions: DataFrame, p: Params) -> DataFrame:
    """Distinct read names with blocks that cover the whole window around a position.

    A block covers the windows of the positions ``start + w .. end - w``, so per name the union of
    those spans is exactly where it counts once. Windows over the origin need a block that reaches
    the end and one that starts at 1, which gives one more span per name. Summing span edges
    replaces the position x block range join.
    """
    w, length = p.reference_window, p.length
    key = ["sample", "rotation_name", "name"]
    # of the blocks with one start only the longest matters: at most `length` rows per name go on
    longest = blocks.groupBy(*key, "start").agg(F.max("end").alias("end"))
    spans = longest.select(*key, (F.col("start") + w).alias("low"), (F.col("end") - w).alias("high")).filter("low <= high")
    before = W.partitionBy(*key).orderBy("low").rowsBetween(W.unboundedPreceding, -1)
    islands = W.partitionBy(*key).orderBy("low").rowsBetween(W.unboundedPreceding, W.currentRow)
    marked = spans.withColumn("fresh", F.coalesce(F.col("low") > F.max("high").over(before), F.lit(True)))
    merged = marked.withColumn("island", F.sum(F.col("fresh").cast("long")).over(islands))
    plain = merged.groupBy(*key, "island").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    # only blocks at the origin matter here, so the others are not shuffled a second time
    at_origin = blocks.filter((F.col("end") == length) | (F.col("start") == 1))
    ends = at_origin.groupBy(*key).agg(
        F.min(F.when(F.col("end") == length, F.col("start"))).alias("tail"),
        F.max(F.when(F.col("start") == 1, F.col("end"))).alias("head"),
    ).filter("tail is not null and head is not null")
    across = ends.select(
        "sample", "rotation_name",
        F.greatest(F.col("tail") + w - length, F.lit(1 - w)).alias("low"),
        F.least(F.col("head") - w, F.lit(w)).alias("high"),
    ).filter("low <= high")
    # positions <= 0 stand for length + position
    parts = F.array(
        F.struct((F.col("low") + length).alias("low"), (F.least("high", F.lit(0)) + length).alias("high")),
        F.struct(F.greatest("low", F.lit(1)).alias("low"), F.col("high")),
    )
    across = across.select("sample", "rotation_name", F.inline(parts))
    every = plain.select("sample", "rotation_name", "low", "high").unionByName(across)
    return _profile(_edges(every), positions)


def block_depth(blocks: DataFrame, positions: DataFrame, p: Params) -> DataFrame:
    """Depth of blocks shrunk by the window; counts blocks, and never joins pieces over the origin."""
    w = p.reference_window
    shrunk = blocks.select("sample", "rotation_name", (F.col("start") + w).alias("low"), (F.col("end") - w).alias("high"))
    return _profile(_edges(shrunk), positions)


def best_rotation(depths: DataFrame) -> DataFrame:
    """The largest count over rotations per (sample, position)."""
    return depths.groupBy("sample", "position").agg(F.max("depth").alias("depth"))


def reference_support(clusters: DataFrame, obs: DataFrame | None, depths: DataFrame, p: Params) -> DataFrame:
    """Split support against reads that span the breakpoints, per event."""
    key = list(KEY)
    eligible = eligible_samples(clusters, obs)
    located = clusters.select(*key, "exact_deletion_id", "left_breakpoint", "right_breakpoint", "total_supporting_reads")
    per_sample = located.join(eligible, key)
    best = best_rotation(depths)
    for side in ("left", "right"):
        side_depth = best.select("sample", F.col("position").alias(f"{side}_breakpoint"), F.col("depth").alias(f"_{side}"))
        per_sample = per_sample.join(side_depth, ["sample", f"{side}_breakpoint"], "left")
    sums = per_sample.groupBy(*key).agg(
        F.sum(F.coalesce("_left", F.lit(0))).alias("left_reference_spanning_reads"),
        F.sum(F.coalesce("_right", F.lit(0))).alias("right_reference_spanning_reads"),
        F.count(F.lit(1)).alias("_samples"),
    )
    out = located.join(sums, key, "left")
    if obs is not None and "minimap2_support" in obs.columns:
        split = obs.filter("minimap2_support").groupBy(*key).agg(F.count(F.lit(1)).alias("_split"))
        out = out.join(split, key, "left").withColumn("split_supporting_reads", F.coalesce("_split", F.lit(0))).drop("_split")
    else:
        out = out.withColumn("split_supporting_reads", F.coalesce("total_supporting_reads", F.lit(0)))
    smallest = F.least("left_reference_spanning_reads", "right_reference_spanning_reads")
    split_reads = F.col("split_supporting_reads")
    return out.select(
        *key, "exact_deletion_id", "split_supporting_reads", "left_reference_spanning_reads", "right_reference_spanning_reads",
        F.when(F.col("_samples") > 0, smallest).alias("reference_spanning_reads_min"),
        F.when(F.col("_samples") > 0, split_reads / F.nullif(split_reads + smallest, F.lit(0))).alias("local_split_support_fraction"),
        F.lit(p.reference_window).alias("reference_support_window_bp"),
        F.when(F.col("_samples") > 0, "indexed_primary_alignment_depth_max_across_rotations")
        .otherwise("not_available_without_minimap2_remap_evidence").alias("reference_support_method"),
    )


def cache_matches(cached: DataFrame, p: Params) -> bool:
    """A cached table may be reused when it names no window or only the configured one."""
    column = "reference_support_window_bp"
    other = cached.filter(F.col(column).isNotNull() & (F.col(column) != p.reference_window))
    return not cached.isEmpty() and other.isEmpty()


def reuse_support(clusters: DataFrame, obs: DataFrame | None, cached: DataFrame, p: Params) -> DataFrame:
    """Cached support by event id, relabelled; the rest is marked as not available."""
    values = ("split_supporting_reads", "left_reference_spanning_reads", "right_reference_spanning_reads",
              "reference_spanning_reads_min", "local_split_support_fraction")
    old = cached.dropDuplicates(["exact_deletion_id"]).select(
        "exact_deletion_id", *values, F.col("reference_support_window_bp").alias("_w"),
        F.col("reference_support_method").alias("_m"), F.lit(True).alias("_hit"),
    )
    has_remap = eligible_samples(clusters, obs).select(*KEY).distinct().withColumn("_remap", F.lit(True))
    out = clusters.select(*KEY, "exact_deletion_id").join(old, "exact_deletion_id", "left").join(has_remap, list(KEY), "left")
    reused = F.concat(F.lit("reused_existing_"), F.coalesce("_m", F.lit("remap_reference_support")))
    return out.select(
        *KEY, "exact_deletion_id", *values,
        F.when(F.col("_hit"), F.col("_w")).otherwise(F.lit(p.reference_window)).alias("reference_support_window_bp"),
        F.when(F.col("_hit"), reused)
        .when(F.col("_remap"), "not_available_in_existing_remap_support")
        .otherwise("not_available_without_minimap2_remap_evidence").alias("reference_support_method"),
    )
