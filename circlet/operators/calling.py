"""Split-alignment event calling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from circlet.durable import spread
from circlet.functions import coords as C
from circlet.functions import reads as R
from circlet.params import Params

CHAIN = ("sample", "species", "rotation_name", "rotation_start", "read_id", "chain_id")
SEGMENT = (
    "query_start", "query_end", "anchor_length", "ref_start_raw", "ref_end_raw", "ref_start", "ref_end",
    "strand", "mapq", "flag", "cigar", "is_primary", "is_secondary", "is_supplementary",
    "alignment_score", "edit_distance", "sa_tag", "alignment_type",
)
ORDER = ("query_start", "query_end", "ref_start_raw", "ref_end_raw", "flag", "cigar", "mapq")
BLOCK_WIDTHS = 64  # widths of the near range in a block of query positions


def split_evidence(alignments: DataFrame) -> DataFrame:
    """Records that are supplementary or name other alignments of the read."""
    return alignments.filter(R.has_flag("flag", 2048) | F.col("sa_tag").isNotNull())


def _segment_ok(p: Params):
    ok = (
        ~R.has_flag("flag", 4)
        & (F.col("mapq") >= p.min_mapq)
        & (F.col("query_end") - F.col("query_start") >= p.min_anchor_length)
        & (F.col("aligned_fraction") >= p.min_segment_aligned_fraction)
        & (F.col("soft_clip_fraction") <= p.max_soft_clip_fraction)
    )
    if not p.include_secondary:
        ok = ok & ~R.has_flag("flag", 256)
    if not p.include_supplementary:
        ok = ok & ~R.has_flag("flag", 2048)
    return F.coalesce(ok, F.lit(False))


def select_segments(split: DataFrame, p: Params) -> DataFrame:
    """Usable segments with standard coordinates.

    Input columns are those of the SAM reader plus ``species``, ``rotation_name``
    and ``rotation_start``.
    """
    kept = split.filter(_segment_ok(p))
    return kept.select(
        "sample", "species", "rotation_name", "rotation_start",
        R.read_key("query_name").alias("read_id"),
        R.chain_key("query_name", "flag").alias("chain_id"),
        "query_start", "query_end",
        (F.col("query_end") - F.col("query_start")).alias("anchor_length"),
        F.col("pos").alias("ref_start_raw"),
        F.col("ref_end").alias("ref_end_raw"),
        C.normalize_pos("pos", p.length, F.col("rotation_start")).alias("ref_start"),
        C.normalize_pos("ref_end", p.length, F.col("rotation_start")).alias("ref_end"),
        F.when(R.has_flag("flag", 16), "-").otherwise("+").alias("strand"),
        "mapq", "flag", "cigar",
        (~(R.has_flag("flag", 256) | R.has_flag("flag", 2048))).alias("is_primary"),
        R.has_flag("flag", 256).alias("is_secondary"),
        R.has_flag("flag", 2048).alias("is_supplementary"),
        "alignment_score", "edit_distance", "sa_tag", "alignment_type",
    )


def _order(prefix: str, columns) -> F.Column:
    return F.struct(*[F.col(prefix + c) for c in columns])


def pair_segments(segments: DataFrame, p: Params, rows: int | None = None) -> DataFrame:
    """Compatible ordered pairs of segments of one chain, as ``a_*`` and ``b_*``.

    A pair is compatible only when the second segment starts inside
    ``[a.query_end - max_overlap, a.query_end + max_gap]``. A segment is shuffled once, by its chain, strand and block of
    query positions; only one whose range reaches over the end of a block goes to the next block too, so a very long
    chain spreads over many tasks. Inside a block a window over that range of positions offers a segment only those
    that start there. Segments alone in their block leave before that window. ``rows`` is the number of segments, which
    is counted when not given.
    """
    segments = segments.filter(F.col("anchor_length") >= p.min_anchor_length)
    extra = [c for c in segments.columns if c not in CHAIN and c not in SEGMENT]
    fields = [c for c in (*SEGMENT, *extra) if c in segments.columns]
    order = [c for c in ORDER if c in segments.columns]
    if p.pairing_mode == "adjacent":
        return _adjacent_pairs(segments, fields, order, p)
    overlap, gap = p.max_query_overlap, p.max_query_gap
    width = overlap + gap + 1
    rows = segments.count() if rows is None else rows
    pairs = _near_pairs(segments, fields, order, overlap, gap, BLOCK_WIDTHS * width, rows)
    if p.min_anchor_length <= overlap:
        # second segments no longer than the allowed overlap may lie anywhere inside the first
        pairs = pairs.unionByName(_inner_pairs(segments, fields, order, overlap, width))
    return pairs


def _near_pairs(segments: DataFrame, fields, order, overlap: int, gap: int, size: int, rows: int) -> DataFrame:
    """Pairs whose second segment starts near the end of the first, from one shuffle of the segments.

    A row stands at its own start as a second segment, in the block of that start, and at its end as a first one, in the
    blocks that its range of starts touches.
    """
    place = ["sample", "rotation_name", "chain_id", "strand", "_block"]

    def block(col):
        return F.floor(col / F.lit(size)).cast("int")

    own = block(F.col("query_start"))
    reached = F.array_distinct(F.array(block(F.col("query_end") - overlap), block(F.col("query_end") + gap)))
    known = segments.dropna(subset=place[:-1])
    placed = known.withColumn("_block", F.explode(F.array_distinct(F.concat(F.array(own), reached)))).filter("_block is not null")
    placed = spread(placed, place, rows).withColumn("_hash", F.xxhash64(*place))  # rows sort by one number, not by texts that are mostly equal
    together = W.partitionBy("_hash", *place)
    start = F.when(own == F.col("_block"), F.col("query_start"))
    placed = placed.withColumns({"_n": F.count(F.lit(1)).over(together), "_low": F.min(start).over(together), "_high": F.max(start).over(together)}).filter("_n > 1")
    second = F.when(own == F.col("_block"), F.struct(F.lit(False).alias("_first"), F.col("query_start").alias("_at")))
    met = F.array_contains(reached, F.col("_block")) & (F.col("_high") >= F.col("query_end") - overlap) & (F.col("_low") <= F.col("query_end") + gap)
    first = F.when(met, F.struct(F.lit(True).alias("_first"), F.col("query_end").alias("_at")))
    stands = placed.select("*", F.inline(F.array_compact(F.array(second, first)))).filter("_at is not null").drop("_n", "_low", "_high")
    near = W.partitionBy("_hash", *place).orderBy("_at").rangeBetween(-overlap, gap)
    listed = stands.withColumn("_b", F.collect_list(F.when(~F.col("_first"), F.struct(*fields))).over(near))
    pairs = listed.filter("_first").withColumn("_b", F.explode("_b"))
    ahead = F.struct(*[F.col(c) for c in order]) < F.struct(*[F.col("_b")[c].alias(c) for c in order])
    return pairs.filter(ahead).select(
        *CHAIN, *[F.col(c).alias("a_" + c) for c in fields], *[F.col("_b")[c].alias("b_" + c) for c in fields]
    )


def _inner_pairs(segments: DataFrame, fields, order, overlap: int, width: int) -> DataFrame:
    """Pairs whose second segment is no longer than the overlap and starts ahead of the near range."""

    def bucket(col):
        return F.floor(col / F.lit(width)).cast("int")

    first = segments.select(*CHAIN, *[F.col(c).alias("a_" + c) for c in fields])
    second = segments.select(
        *[F.col(c).alias("_" + c) for c in ("sample", "rotation_name", "chain_id")],
        *[F.col(c).alias("b_" + c) for c in fields],
        bucket(F.col("query_start")).alias("_bucket"),
    )
    same_chain = (
        (F.col("sample") == F.col("_sample"))
        & (F.col("rotation_name") == F.col("_rotation_name"))
        & (F.col("chain_id") == F.col("_chain_id"))
        & (F.col("a_strand") == F.col("b_strand"))
        & (F.col("bucket") == F.col("_bucket"))
        & (_order("a_", order) < _order("b_", order))
    )
    inner_high = F.col("a_query_end") - overlap - 1
    span = F.sequence(bucket(F.col("a_query_start")), F.greatest(bucket(F.col("a_query_start")), bucket(inner_high)))
    wide = first.withColumn("bucket", F.explode(span))
    short = second.filter(F.col("b_query_end") - F.col("b_query_start") <= overlap)
    inside = (
        (F.col("b_query_start") <= inner_high)
        & (F.least("a_query_end", "b_query_end") - F.col("b_query_start") <= overlap)
    )
    return wide.join(short, same_chain & inside, "inner").drop("_sample", "_rotation_name", "_chain_id", "_bucket", "bucket")


def _adjacent_pairs(segments: DataFrame, fields, order, p: Params) -> DataFrame:
    """Each segment with the next one of its chain."""
    w = W.partitionBy("sample", "rotation_name", "chain_id").orderBy(*order)
    nxt = F.lead(F.struct(*fields)).over(w)
    pairs = segments.withColumn("_next", nxt).filter(F.col("_next").isNotNull())
    pairs = pairs.select(
        *CHAIN,
        *[F.col(c).alias("a_" + c) for c in fields],
        *[F.col("_next")[c].alias("b_" + c) for c in fields],
    )
    shared = F.least("a_query_end", "b_query_end") - F.greatest("a_query_start", "b_query_start")
    return pairs.filter(
        (F.col("a_strand") == F.col("b_strand"))
        & (F.greatest(F.lit(0), shared) <= p.max_query_overlap)
        & (F.greatest(F.lit(0), F.col("b_query_start") - F.col("a_query_end")) <= p.max_query_gap)
    )


def _with_ids(events: DataFrame) -> DataFrame:
    """The two text ids, after the chain columns."""
    ids = (
        C.deletion_id("left_breakpoint", "right_breakpoint", "deleted_size").alias("deletion_id"),
        C.breakpoint_pair_id("left_breakpoint", "right_breakpoint").alias("breakpoint_pair_id"),
    )
    return events.select(*CHAIN, *ids, *[c for c in events.columns if c not in CHAIN])


def events_from_pairs(pairs: DataFrame, p: Params) -> DataFrame:
    """One directed event per pair, normalised over strand, inside the size range."""
    return _with_ids(_plain_events(pairs, p))


def _plain_events(pairs: DataFrame, p: Params) -> DataFrame:
    """D07 without the text ids: breakpoints and size say the same in numbers."""
    plus = F.col("a_strand") == "+"

    def side(name, left):
        first, second = F.col("a_" + name), F.col("b_" + name)
        return F.when(plus, first if left else second).otherwise(second if left else first)

    have = {c[2:] for c in pairs.columns if c.startswith("a_")}
    base = pairs.withColumns({"_dl": side("ref_end", True), "_dr": side("ref_start", False)})
    if p.arc_assignment == "legacy_shortest_arc":
        base = base.withColumn("_arc", C.shortest_arc("_dl", "_dr", p.length))
        left, right = F.col("_arc")["left"], F.col("_arc")["right"]
        orientation = F.when(F.col("_arc")["reversed"], "reversed_to_shorter_interval").otherwise("reported")
    else:
        left, right, orientation = F.col("_dl"), F.col("_dr"), F.lit("alignment_directed")
    base = base.withColumns({"left_breakpoint": left, "right_breakpoint": right, "_orientation": orientation})
    base = base.withColumn("deleted_size", C.directed_gap("left_breakpoint", "right_breakpoint", p.length))
    base = base.filter(F.col("deleted_size").between(p.min_deletion_size, p.max_deletion_size))
    record = C.directed_record("left_breakpoint", "right_breakpoint", p.length)
    columns = {
        "left_breakpoint": F.col("left_breakpoint"),
        "right_breakpoint": F.col("right_breakpoint"),
        "deleted_size": F.col("deleted_size"),
        **{k: v for k, v in record.items() if k != "deleted_size"},
        "arc_assignment_method": F.lit(p.arc_assignment),
        "direction_status": F.lit("directed"),
        "directed_left_breakpoint": F.col("_dl"),
        "directed_right_breakpoint": F.col("_dr"),
        "directed_deleted_size": C.directed_gap("_dl", "_dr", p.length),
        "reported_left_breakpoint": F.col("_dl"),
        "reported_right_breakpoint": F.col("_dr"),
        "reported_deleted_size": C.directed_gap("_dl", "_dr", p.length),
        "canonical_orientation": F.col("_orientation"),
        "left_anchor_length": side("anchor_length", True),
        "right_anchor_length": side("anchor_length", False),
        "min_anchor_length": F.least("a_anchor_length", "b_anchor_length"),
        "strand": F.col("a_strand"),
        "source": F.lit("minimap2_split_alignment"),
        "raw_left_breakpoint": side("ref_end_raw", True),
        "raw_right_breakpoint": side("ref_start_raw", False),
        "left_mapq": side("mapq", True),
        "right_mapq": side("mapq", False),
        "min_mapq": F.least("a_mapq", "b_mapq"),
        "query_overlap_bp": F.greatest(
            F.lit(0), F.least("a_query_end", "b_query_end") - F.greatest("a_query_start", "b_query_start")
        ),
        "query_gap_bp": F.greatest(F.lit(0), F.col("b_query_start") - F.col("a_query_end")),
        "query_first_start": F.col("a_query_start"),
        "query_first_end": F.col("a_query_end"),
        "query_second_start": F.col("b_query_start"),
        "query_second_end": F.col("b_query_end"),
    }
    for name in ("ref_start", "ref_end", "ref_start_raw", "ref_end_raw"):
        columns[f"left_segment_{name}"] = side(name, True)
        columns[f"right_segment_{name}"] = side(name, False)
    provenance = ("cigar", "flag", "is_primary", "is_secondary", "is_supplementary",
                  "alignment_score", "edit_distance", "sa_tag", "alignment_type")
    for name in provenance:
        if name in have:
            columns[f"left_{name}"] = side(name, True)
            columns[f"right_{name}"] = side(name, False)
    return base.select(*CHAIN, *[expr.alias(name) for name, expr in columns.items()])


def _ends(columns=()) -> list[F.Column]:
    """The two breakpoints of an event whatever its direction, after the number that such rows sort by where there is one."""
    if "_low" in columns:
        return [F.col("_hash"), F.col("_low"), F.col("_high")]
    return [F.least("left_breakpoint", "right_breakpoint"), F.greatest("left_breakpoint", "right_breakpoint")]


def first_per_read(events: DataFrame) -> DataFrame:
    """One row per (read, event, rotation): the first in chain and query order."""
    order = [
        "chain_id", "query_first_start", "query_first_end", "query_second_start", "query_second_end",
        "raw_left_breakpoint", "raw_right_breakpoint", "left_mapq", "right_mapq",
        *[c for c in ("left_cigar", "right_cigar", "left_flag", "right_flag") if c in events.columns],
    ]
    w = W.partitionBy(*_ends(events.columns), "sample", "rotation_name", "read_id", "left_breakpoint", "right_breakpoint").orderBy(*order)
    return events.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def mark_reciprocal(events: DataFrame) -> DataFrame:
    """A read that supports both directions of one pair in one rotation is ambiguous.

    After D08 a window here holds at most the two directions of the pair.
    """
    w = W.partitionBy(*_ends(events.columns), "sample", "rotation_name", "read_id")
    left, right = F.col("directed_left_breakpoint"), F.col("directed_right_breakpoint")
    several = (F.min(left).over(w) != F.max(left).over(w)) | (F.min(right).over(w) != F.max(right).over(w))
    status = F.when(several, "ambiguous_reciprocal_alignments").otherwise(F.col("direction_status"))
    return events.withColumn("direction_status", status)


def apply_direction_policy(events: DataFrame, p: Params) -> DataFrame:
    """D10."""
    return events if p.ambiguous_direction_policy == "include" else events.filter("direction_status = 'directed'")


def call_candidates(segments: DataFrame, p: Params) -> DataFrame:
    """D04-D09 over usable segments: the candidate table.

    One shuffle, on the read and the two ends in either order, and one sort serve both D08 and D09; the text ids are made
    for what is left.
    """
    rows = segments.count()
    events = _plain_events(pair_segments(segments, p, rows), p)
    low, high = _ends()
    pair = ["sample", "rotation_name", "read_id", "_low", "_high"]
    placed = spread(events.withColumns({"_low": low, "_high": high}), pair, rows).withColumn("_hash", F.xxhash64(*pair))
    return _with_ids(mark_reciprocal(first_per_read(placed)).drop("_hash", "_low", "_high"))


def call_events(segments: DataFrame, p: Params) -> DataFrame:
    """The events that count as support."""
    return apply_direction_policy(call_candidates(segments, p), p)


def call_summary(alignments: DataFrame, candidates: DataFrame, p: Params) -> DataFrame:
    """Nine metrics per (sample, rotation), one row each."""
    keys = ["sample", "rotation_name"]
    is_split = F.coalesce(R.has_flag("flag", 2048) | F.col("sa_tag").isNotNull(), F.lit(False))
    used = is_split & _segment_ok(p)
    chain = F.when(used, R.chain_key("query_name", "flag"))
    scan = alignments.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("alignment_records"),
        F.count_if(~is_split).alias("records_without_split_evidence"),
        F.count_if(used).alias("segments_used"),
        F.count_if(is_split & ~used).alias("segments_rejected"),
        F.count_distinct(chain).alias("reads_with_usable_segments"),
        F.count_distinct(F.when(used, R.read_key("query_name"))).alias("fragments_with_usable_segments"),
    )
    directed = F.lit(True) if p.ambiguous_direction_policy == "include" else F.col("direction_status") == "directed"
    calls = candidates.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("candidate_deletion_records"),
        F.count_if(~directed).alias("ambiguous_direction_records"),
        F.count_if(directed).alias("deletion_supporting_records"),
    )
    metrics = [c for c in (*scan.columns, *calls.columns) if c not in keys]
    joined = scan.join(calls, keys, "left").na.fill(0, metrics)
    return joined.unpivot(keys, metrics, "metric", "value")
