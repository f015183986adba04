"""Coordinate and CIGAR expressions against fixed values."""

import pytest
from pyspark.sql import functions as F

from circlet.functions import coords as C
from circlet.functions import reads as R


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def pieces(value):
    return [(p["start"], p["end"]) for p in value]


def test_positions(spark):
    n = lambda pos: C.normalize_pos(F.lit(pos), 100, 51)
    assert one(spark, n(1), n(50), n(51)) == (51, 100, 1)
    padded = lambda pos: C.normalize_padded_pos(F.lit(pos), 16313, 1000)
    assert one(spark, padded(1001), padded(1000)) == (1, 16313)
    gap = lambda a, b, n: C.directed_gap(F.lit(a), F.lit(b), n)
    assert one(spark, gap(100, 500, 16313), gap(16000, 200, 16313), gap(7, 7, 100)) == (399, 512, 99)
    assert one(spark, C.rotate_text(F.lit("ABCDEFGHIJ"), 6)) == ("FGHIJABCDE",)
    with pytest.raises(ValueError):
        C.normalize_pos(F.lit(1), 0)


def test_directed_pair(spark):
    r = C.directed_record(F.lit(100), F.lit(800), 1000)
    assert one(spark, r["deleted_size"], r["complement_deleted_size"], r["wraps_origin"]) == (699, 299, False)
    size = lambda a, b: C.directed_gap(F.lit(a), F.lit(b), 16569)
    assert one(spark, size(8472, 13448), size(13448, 8472)) == (4975, 11592)
    assert one(spark, C.breakpoint_pair_id(F.lit(8472), F.lit(13448)), C.breakpoint_pair_id(F.lit(13448), F.lit(8472))) == ("mtPair_08472_13448",) * 2


def test_pieces(spark):
    row = one(
        spark, C.window_pieces(F.lit(5), F.lit(10), 100), C.deleted_pieces(F.lit(950), F.lit(1), 1000), C.deleted_pieces(F.lit(1000), F.lit(5), 1000),
        C.deleted_pieces(F.lit(5), F.lit(6), 1000), C.block_pieces(F.lit(95), F.lit(105), 100),
    )
    assert [pieces(v) for v in row] == [[(95, 100), (1, 15)], [(951, 1000)], [(1, 4)], [], [(95, 100), (1, 5)]]
    with pytest.raises(Exception, match="fall within"):
        one(spark, C.region_pieces(F.lit(0), F.lit(5), 100))


def test_round_trip_and_complement(spark):
    length = 313
    grid = spark.range(1, length + 1).select(F.col("id").cast("int").alias("a"), F.explode(F.sequence(F.lit(1), F.lit(length), F.lit(13))).alias("b"))
    back = C.normalize_pos(C.rotated_pos("a", length, F.col("b")), length, F.col("b"))
    total = C.directed_gap("a", "b", length) + C.directed_gap("b", "a", length)
    bad = grid.filter((back != F.col("a")) | ((F.col("a") != F.col("b")) & (total != length - 2)) | (C.pieces_length(C.deleted_pieces("a", "b", length)) != C.directed_gap("a", "b", length)))
    assert bad.count() == 0


def test_half_even_median(spark):
    assert one(spark, C.wrap_median(F.lit(100.5), 1000), C.wrap_median(F.lit(201.5), 1000), C.wrap_median(F.lit(0.5), 1000)) == (100, 202, 1000)


def test_cigar(spark):
    m = R.cigar_metrics(F.lit("25M24S"))
    assert one(spark, m["query_length"], m["query_start"], m["query_end"], m["aligned_query_length"]) == (49, 0, 25, 25)
    assert one(spark, R.cigar_lengths(F.lit("5S25M"), "M=X"), R.cigar_lengths(F.lit("10M1I10M2D5="), "M=X")) == (25, 25)
    p = R.query_pair_metrics(F.lit(0), F.lit(30), F.lit(20), F.lit(49), F.lit(49))
    assert one(spark, p["query_overlap_bp"], p["query_union_aligned_length"], p["query_union_coverage"], p["total_aligned_query_length"]) == (10, 49, 1.0, 59)
    assert pieces(one(spark, R.aligned_blocks(F.lit(10), F.lit("5S10M2I5M3D7M")))[0]) == [(10, 19), (20, 24), (28, 34)]


def test_read_names(spark):
    assert one(spark, R.read_key(F.lit("x/2/1")), R.read_key(F.lit("x/1")), R.chain_key(F.lit("x"), F.lit(64)), R.chain_key(F.lit("x/2"), F.lit(0))) == ("x", "x", "x/1", "x/2")
    assert one(spark, R.forward_sequence(F.lit("AACg"), F.lit(True)), R.forward_quality(F.lit(None).cast("string"), F.lit("AAC"), F.lit(True))) == ("cGTT", "III")
