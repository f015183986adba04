"""Pairing, conflicts and clustering against fixed values and brute force."""

import random
from dataclasses import replace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from circlet.durable import TASK_ROWS
from circlet.operators import calling as D
from circlet.operators import clusters as K
from circlet.operators import conflicts as X
from circlet.operators import evidence as Q
from circlet.operators.leader import assign_leaders
from circlet.operators.leader import greedy as tile_greedy
from circlet.operators.ranking import numbered, numbered_in_groups
from circlet.params import Params

SCHEMA = ("sample string, species string, rotation_name string, rotation_start int, read_id string, chain_id string, query_start int, query_end int,"
          " anchor_length int, ref_start_raw int, ref_end_raw int, ref_start int, ref_end int, strand string, mapq int, flag int, cigar string")  # fmt: skip


def segment(qs, qe, rs, re, strand="+", chain="r", read="r"):
    return ("s", "x", "normal", 1, read, chain, qs, qe, qe - qs, rs, re, rs, re, strand, 60, 0, "50M")


def called(spark, rows, p):
    out = D.call_candidates(spark.createDataFrame(rows, SCHEMA), p)
    return sorted((r.left_breakpoint, r.right_breakpoint, r.deleted_size, r.wraps_origin) for r in out.collect())


def test_pairs(spark):
    p = Params(length=1000, min_deletion_size=10, max_deletion_size=1000)
    assert called(spark, [segment(0, 50, 951, 980), segment(50, 100, 100, 149)], p) == [(980, 100, 119, True)]
    assert called(spark, [segment(0, 50, 100, 149, "-"), segment(50, 100, 951, 980, "-")], p) == [(980, 100, 119, True)]
    assert called(spark, [segment(0, 50, 800, 849, "-"), segment(50, 100, 100, 149, "-")], p) == [(149, 800, 650, False)]
    assert called(spark, [segment(0, 50, 1, 50), segment(50, 100, 700, 749, "-")], p) == []
    wide = replace(p, length=16313, max_query_overlap=12, max_deletion_size=16000)
    rows = [segment(0, 27, 4716, 4742, "-"), segment(20, 49, 4339, 4367, "-")]
    assert called(spark, rows, wide) == [(4367, 4716, 348, False)]


def test_mates(spark):
    p = Params(length=1000, min_deletion_size=10, max_deletion_size=1000)
    a, b = (0, 50, 100, 149), (50, 100, 500, 549)
    assert called(spark, [segment(*a, chain="r/1"), segment(*b, chain="r/2")], p) == []
    both = [segment(*s, chain=c) for s in (a, b) for c in ("r/1", "r/2")]
    assert called(spark, both, p) == [(149, 500, 350, False)]


def test_short_second_segment_inside_the_first(spark):
    p = Params(length=1000, min_deletion_size=1, max_deletion_size=1000, min_anchor_length=5, max_query_overlap=10)
    rng = random.Random(3)
    rows = [segment(q, q + n, r, r + n) for q, n, r in ((rng.randrange(0, 60), rng.choice((6, 9, 10, 25, 40)), rng.randrange(1, 900)) for _ in range(60))]
    expected = set()
    for a in rows:
        for b in rows:
            key = lambda s: (s[6], s[7], s[9], s[10])
            if key(a) < key(b) and min(a[7], b[7]) - b[6] <= 10 and b[6] - a[7] <= 20:
                left, right = a[12], b[11]
                size = right - left - 1 if right > left else 1000 - left + right - 1
                if 1 <= size <= 1000:
                    expected.add((left, right))
    assert {(l, r) for l, r, *_ in called(spark, rows, p)} == expected


def test_conflicts(spark):
    rows = spark.createDataFrame(
        [("s", "a", 100, 800), ("s", "a", 803, 98), ("s", "b", 100, 800), ("t", "a", 803, 98), ("s", "c", 5, 8), ("s", "d", 5, 8), ("s", "d", 5, 8)],
        "sample string, read_id string, left_breakpoint int, right_breakpoint int",
    )
    got = {(r.sample, r.read_id, r.left_breakpoint): r.in_conflict for r in X.flag_conflicts(rows, 5, 1000).collect()}
    # a row never meets itself (c), but two copies of a self-reciprocal row do meet (d)
    assert got == {("s", "a", 100): True, ("s", "a", 803): True, ("s", "b", 100): False, ("t", "a", 803): False, ("s", "c", 5): False, ("s", "d", 5): True}


EVENT = "species string, sample string, read_id string, left_breakpoint int, right_breakpoint int, deleted_size int, rotation_name string"


def test_cluster_goldens(spark):
    rows = lambda *xs: spark.createDataFrame([("x", "s", f"r{i}", l, r, 1, rot) for i, (l, r, rot) in enumerate(xs)], EVENT)
    leaders = lambda df, slop: K.assign_clusters(df, slop, 1000).select("leader_left", "leader_right").distinct().count()
    assert leaders(rows((999, 400, "n"), (1, 401, "n")), 3) == 1
    assert leaders(rows((100, 800, "n"), (800, 100, "n")), 3) == 2
    table = K.cluster_table(K.assign_clusters(rows((100, 201, "n"), (101, 202, "n")), 2, 1000), 2, 1000, 2).first()
    assert (table.left_breakpoint, table.right_breakpoint, table.deleted_size, table.total_supporting_reads) == (100, 202, 101, 2)
    same = spark.createDataFrame([("x", "s", "r", 100, 201, 1, "n"), ("x", "s", "r", 101, 201, 1, "h")], EVENT)
    one = K.cluster_table(K.assign_clusters(same, 2, 1000), 2, 1000, 1).first()
    assert (one.total_supporting_reads, one.rotation_agreement) == (1, "multiple_rotations")


def greedy(points, slop, length):
    d = lambda a, b: min(abs(a - b), length - abs(a - b))
    leaders, out = [], {}
    for l, r in points:
        if (l, r) in out:
            continue
        hit = next(((x, y) for x, y in leaders if d(l, x) <= slop and d(r, y) <= slop), None)
        if hit is None:
            leaders.append((l, r))
        out[l, r] = hit or (l, r)
    return out


def leaders_of(spark, points, slop, length, **options):
    """``points``: (l, r, order) -> {(l, r): leader}."""
    df = spark.createDataFrame([("x", *row) for row in points], "k string, l int, r int, o int").repartition(7)
    return {(r.l, r.r): (r.leader_left, r.leader_right) for r in assign_leaders(df, ["k"], "l", "r", ["o"], slop, length, **options).collect()}


@pytest.mark.parametrize("order", ["coordinate", "random"])
@pytest.mark.parametrize("tile_points", [100_000, 120])
def test_leaders_equal_brute_force(spark, order, tile_points):
    """Dense points, so that small tiles depend on each other; few passes are enough."""
    length, slop, passes = 600, 6, []
    rng = random.Random(5)
    points = [(rng.randrange(1, length + 1), rng.randrange(1, 120)) for _ in range(3000)]
    rows = [(l, r, (l * 1000 + r) if order == "coordinate" else i) for i, (l, r) in enumerate(points)]
    got = leaders_of(spark, rows, slop, length, tile_points=tile_points, passes=passes)
    assert got == greedy([(l, r) for l, r, _ in sorted(rows, key=lambda x: x[2])], slop, length)
    assert len(passes) < 6 and passes[-1] == 0


def test_leaders_of_a_lattice(spark):
    """Every place taken, in the order of coordinates: a shift goes from tile to tile, and the result stays exact."""
    length, slop = 120, 2
    rows = [(l, r, (l - 1) * length + r) for l in range(1, length + 1) for r in range(1, 61)]
    assert leaders_of(spark, rows, slop, length, tile_points=500) == greedy([(l, r) for l, r, _ in rows], slop, length)


def test_leaders_take_null_orders_first(spark):
    rows = [(10, 10, 5), (11, 11, None), (12, 12, 1), (40, 40, None)]
    assert leaders_of(spark, rows, 1, 100) == {(11, 11): (11, 11), (10, 10): (11, 11), (12, 12): (11, 11), (40, 40): (40, 40)}


@given(st.data())
@settings(max_examples=150, deadline=None)
def test_greedy_of_a_tile(data):
    slop = data.draw(st.integers(1, 9))
    length = data.draw(st.integers(4 * slop + 1, 8 * slop + 60))
    points = data.draw(st.lists(st.tuples(st.integers(1, length), st.integers(1, length)), unique=True, max_size=150))
    columns = np.array(points, dtype=np.int32).reshape(-1, 2)
    chosen = tile_greedy(columns[:, 0], columns[:, 1], np.zeros(len(points), dtype=bool), slop, length)
    assert {p: points[i] for p, i in zip(points, chosen.tolist())} == greedy(points, slop, length)


def test_numbers_of_rows(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(9)
    last = sorted(rows, key=lambda x: (-x[1], x[2]))
    assert {r.id: r.n for r in numbered(df, [F.desc("v"), "id"], "n").collect()} == {x[2]: i + 1 for i, x in enumerate(last)}
    grouped = {r.id: r.n for r in numbered_in_groups(df, ["g"], [F.desc("v"), "id"], "n").collect()}
    for g in ("a", "b", None):
        assert [grouped[x[2]] for x in last if x[0] == g] == list(range(1, 1 + sum(x[0] == g for x in rows)))
    assert numbered_in_groups(df.limit(0), ["g"], ["id"], "n").count() == 0


def test_hypotheses_of_a_busy_read(spark):
    """A read with more coordinates than the fold takes gives the same groups by tiles."""
    rng = random.Random(1)
    rows = [("s", "busy", rng.randrange(1, 1000), rng.randrange(1, 60)) for _ in range(300)] + [("s", "calm", 5, 9), ("s", "calm", 999, 8)]
    df = spark.createDataFrame(rows, "sample string, read_id string, left_breakpoint int, right_breakpoint int")
    out = Q.hypotheses(df, 8, 1000, fold_limit=20).collect()
    for read in ("busy", "calm"):
        want = greedy(sorted((l, r) for _, n, l, r in rows if n == read), 8, 1000)
        got = {(x.left_breakpoint, x.right_breakpoint): (x.leader_left, x.leader_right) for x in out if x.read_id == read}
        assert got == want
        assert {x.hypothesis_count for x in out if x.read_id == read} == {len(set(want.values()))}
    assert len(out) == len(rows)


def test_caller_medians_merge(spark):
    p = Params(length=16569, slop=5)
    columns = "sample string, species string, read_id string, left_breakpoint int, right_breakpoint int, evidence_source string, rotation_name string"
    rows = spark.createDataFrame([("s", "x", "r", 8102, 12936, Q.REMAP, "normal"), ("s", "x", "r", 8104, 12934, Q.CHIMERIC, "full_genome")], columns)
    null = lambda t: F.lit(None).cast(t)
    full = rows.withColumns(
        {"raw_left_breakpoint": F.col("left_breakpoint"), "raw_right_breakpoint": F.col("right_breakpoint"), "min_mapq": F.lit(9), "secondary_only_evidence": F.lit(False),
         "primary_chain_evidence": null("boolean"), "estimated_alignment_error_rate": null("double"), "query_gap_bp": F.lit(0), "query_overlap_bp": F.lit(1),
         "total_alignment_segments": F.lit(2), "query_segments_adjacent": F.lit(True), "alignment_pattern_id": F.lit("p"), "nuclear_competition_status": F.lit("n")}
    )
    got = Q.observations(full, p).collect()
    assert len(got) == 1
    assert (got[0].left_breakpoint, got[0].right_breakpoint, got[0].both_callers_support, got[0].source_record_count) == (8103, 12935, True, 2)
    assert got[0].observation_quality_flags == ["query_overlap"] and got[0].primary_chain_evidence is None


def test_pairs_shuffle_a_segment_once(spark):
    """One exchange of the segments, no join; pairs over the ends of blocks and rows with missing ends as by brute force."""
    p = Params(length=1000, min_deletion_size=1, max_deletion_size=1000)
    rng, size = random.Random(11), D.BLOCK_WIDTHS * 31
    rows = [segment(q, q + n, r, r + n, "+-"[r % 2], "ab"[q % 2]) for q, n, r in ((size * rng.randrange(0, 3) + rng.randrange(-70, 70) + 100, rng.randrange(20, 60), rng.randrange(1, 900)) for _ in range(150))]
    missing = [rows[0][:6] + (None,) + rows[0][7:], rows[0][:7] + (None,) + rows[0][8:], ("s", "x", "normal", 1, "r", None) + rows[0][6:]]
    pairs = D.pair_segments(spark.createDataFrame(rows + missing, SCHEMA), p)
    known = lambda x: tuple(-1 if v is None else v for v in x)
    key = lambda s: known((s[6], s[7], s[9], s[10], s[15], s[16], s[14]))
    ends = [(a, b) for a in rows + missing for b in rows + missing if a[7] is not None and b[6] is not None and None not in (a[5], b[5])]
    expected = sorted((a[5], *key(a), *key(b)) for a, b in ends if a[5] == b[5] and a[13] == b[13] and key(a) < key(b) and -10 <= b[6] - a[7] <= 20)
    names = [f"{s}_{c}" for s in "ab" for c in D.ORDER]
    assert len(expected) > 50 and sorted(known(r) for r in pairs.select("chain_id", *names).collect()) == expected
    plan = pairs._jdf.queryExecution().sparkPlan().toString()
    prepared = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and prepared.count("Exchange ") == 1


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_segments_of_a_large_table_spread_by_their_number(spark):
    p = Params(length=16569, min_anchor_length=20, max_query_overlap=10)
    rows = spark.createDataFrame([segment(0, 50, 100, 149), segment(50, 100, 3000, 3049), segment(0, 50, 5, 54, read="alone", chain="alone")], SCHEMA)
    pairs = D.pair_segments(rows, p, rows=40 * TASK_ROWS)
    assert pairs.rdd.getNumPartitions() == 40  # the session has 8
    assert [(r.a_query_start, r.b_query_start, r.read_id) for r in pairs.collect()] == [(0, 50, "r")]


def test_zero_slop_needs_no_join(spark):
    rows = spark.createDataFrame([("x", 1, 5, "a"), ("x", 1, 5, "b"), ("x", None, 5, "c"), (None, 1, 5, "d")], "species string, left_breakpoint int, right_breakpoint int, read_id string")
    out = K.assign_clusters(rows, 0, 1000)
    assert "Join" not in plan_of(out)
    assert sorted((r.read_id, r.leader_left, r.leader_right) for r in out.collect()) == [("a", 1, 5), ("b", 1, 5)]


def caller_rows(spark, n=400):
    """Rows of two callers: reads that run both ways, copies, several deletions, missing ends and names."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        l, r = rng.choice([(100, 800), (104, 797), (800, 100), (300, 300), (500, 620)])
        own = Q.CHIMERIC if i % 3 else Q.REMAP
        rows.append(("s", "x", f"r{rng.randrange(90)}", l + rng.randrange(3), r + rng.randrange(3), own, rng.choice(["G1--H", "G2--H", None]), rng.randrange(4), f"p{rng.randrange(3)}"))
    rows += [rows[0]] * 3 + [("s", "x", None, 5, 9, Q.REMAP, None, 1, "p"), ("s", "x", "r1", None, 9, Q.REMAP, None, 1, "p")]
    columns = "sample string, species string, read_id string, left_breakpoint int, right_breakpoint int, evidence_source string, gene_pair_label string, min_mapq int, alignment_pattern_id string"
    return spark.createDataFrame(rows, columns).withColumns(
        {"raw_left_breakpoint": F.col("left_breakpoint"), "raw_right_breakpoint": F.col("right_breakpoint"), "secondary_only_evidence": F.lit(False),
         "primary_chain_evidence": F.lit(True), "estimated_alignment_error_rate": F.lit(0.2), "query_gap_bp": F.lit(0), "query_overlap_bp": F.lit(1), "direction_status": F.lit("directed"),
         "total_alignment_segments": F.lit(2), "query_segments_adjacent": F.lit(True), "nuclear_competition_status": F.lit("n"), "rotation_name": F.lit("normal"), "filter_status": F.lit("pass")}
    )


def test_caller_rows_of_a_read_meet_in_one_shuffle(spark, monkeypatch):
    """Ordinary and crowded reads give the same observations and conflicts; rows of ordinary reads are shuffled once, by read."""
    p = Params(length=1000, slop=5)
    rows = caller_rows(spark)
    found, ambiguous = Q.consolidate(rows, p)
    plan = found._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("== Initial Plan ==")[-1].splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("hashpartitioning(sample" in line and "leader" not in line and "breakpoint" not in line for line in exchanges)
    plain = lambda df: sorted(repr([r[c] for c in sorted(df.columns)]) for r in df.collect())
    want, opposed = plain(found), plain(ambiguous)
    monkeypatch.setattr(Q, "ROW_LIMIT", 0)  # every read is crowded
    found, ambiguous = Q.consolidate(rows, p)
    assert plain(found) == want and plain(ambiguous) == opposed and len(want) > 50
    assert opposed == plain(X.split_conflicts(rows, p.slop, p.length)[1])
