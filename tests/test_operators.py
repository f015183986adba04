"""Annotation, tiers, selection, motif search, statistics, views and readers on small inputs."""

import gzip
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from circlet.functions import pvalues as PV
from circlet.operators import annotate as FA
from circlet.operators import audit as Z
from circlet.operators import conflicts as X
from circlet.operators import coverage as P
from circlet.operators import features as FT
from circlet.operators import matrix as M
from circlet.operators import motif as MO
from circlet.operators import selection as S
from circlet.operators import stats as A
from circlet.operators import tiers as T
from circlet.operators import views as V
from circlet.params import Params
from circlet.sources import alignments as SA
from circlet.sources import exports as SE
from circlet.sources import fastq as SF
from circlet.sources import ranges as SR
from circlet.sources import samples as SS
from circlet.sources import tabular as ST
from circlet.streaming.selection import decisions, stream_depleted

ARCS = [{"name": "minor_arc", "start": 408, "end": 5746}, {"name": "major_arc", "start": 5747, "end": 407}]


def features(spark, rows, length, limit):
    table = spark.createDataFrame([("MT", s, e, "+", t, "", n, "", "") for n, t, s, e in rows], FT.COLUMNS)
    return FT.Features(table, length, limit)


@pytest.mark.parametrize("limit", [2000, 0])
def test_impact_and_nearest(spark, limit):
    f = features(spark, [("MT-CYB", "gene", 10, 60), ("D-loop", "region", 940, 1000), ("far", "gene", 500, 520)], 1000, limit)
    df = spark.createDataFrame([(950, 50), (300, 310)], "left_breakpoint int, right_breakpoint int")
    got = {r.left_breakpoint: r for r in f.nearest(f.impact(df, "left_breakpoint", "right_breakpoint"), "left_breakpoint", "near").collect()}
    assert (got[950].affected_feature_label, got[950].feature_impact_class) == ("MT-CYB+D-loop", "d_loop_involved")
    assert got[300].feature_impact_class == "intergenic" and got[300].near == "far:gene:500-520;distance=200"


def test_one_feature_per_name(spark):
    rows = [("MT", s, e, "+", t, "", "G", "", "") for t, s, e in (("exon", 1, 5), ("gene", 1, 9), ("CDS", 2, 4))]
    assert [r.feature_type for r in FT.one_per_name(spark.createDataFrame(rows, FT.COLUMNS)).collect()] == ["gene"]


def test_arcs_and_targets(spark):
    df = spark.createDataFrame([(8469, 13447, 4977), (13447, 8469, 11590), (1000, 2000, 999)], "left_breakpoint int, right_breakpoint int, deleted_size int")
    got = [(r.minor_arc_deleted_bp, r.major_arc_deleted_bp) for r in FA.with_arc_context(df, ARCS, 16569).orderBy("deleted_size").collect()]
    assert got[0] == (999, 0) and got[1] == (0, 4977) and got[2][0] == 5339 and sum(got[2]) == 11590
    with pytest.raises(ValueError, match="partition"):
        FA.checked_arcs([{**ARCS[0], "end": 5700}, ARCS[1]], 16569)
    known = [{"name": "c", "left_breakpoint": 8470, "right_breakpoint": 13447, "deleted_size": 4977, "breakpoint_tolerance_bp": 10, "size_tolerance_bp": 20}]
    hit = spark.createDataFrame([(8472, 13448, 4975)], df.schema)
    assert FA.with_known_targets(hit, FA.deletion_targets(spark, known, [], 16569), 16569).first().known_deletion_label == "c"
    searches = [{"id": "mtDNA_100_500"}, {"id": "mtDNA_8471_13449"}, {"id": "bad", "left_breakpoint": "x", "right_breakpoint": 7}, {"id": "mtDNA_103_503"}]
    inferred = FA.target_table(FA.deletion_targets(spark, known, searches, 16569, breakpoint_tolerance=2)).collect()
    assert [(t["name"], t["left_breakpoint"], t["breakpoint_tolerance_bp"]) for t in inferred] == [("c", 8470, 10), ("mtDNA_100_500", 100, 2), ("mtDNA_103_503", 103, 2)]
    again = MO.search_targets(spark, known, [*searches, {"id": "mtDNA_100_500", "left_breakpoint": 8, "right_breakpoint": 60}], 16569).orderBy("deletion_id").collect()
    assert [(t["deletion_id"], t["target_left_breakpoint"], t["breakpoint_tolerance_bp"], t["matched_configured_target_label"]) for t in again] == [
        ("mtDNA_100_500", 8, 100, ""), ("mtDNA_103_503", 103, 100, ""), ("mtDNA_8471_13449", 8471, 10, "c")]


def test_conflicts_without_a_circle(spark):
    rows = [("s", "a", 5, 9), ("s", "a", 9, 5), ("s", "b", 5, 9), ("s", "b", 9, 6), ("s", "c", 7, 7), ("s", "d", 4, 4), ("s", "d", 4, 4), ("t", "a", 9, 5)]
    out = X.flag_conflicts(spark.createDataFrame(rows, "sample string, read_id string, left_breakpoint int, right_breakpoint int"), 10, None)
    assert sorted(tuple(r)[:4] for r in out.filter("in_conflict").collect()) == [("s", "a", 5, 9), ("s", "a", 9, 5), ("s", "d", 4, 4), ("s", "d", 4, 4)]


@pytest.mark.parametrize("limit", [100, 0])
def test_equal_feature_rows_stay_apart(spark, limit):
    f = features(spark, [("A", "gene", 10, 20), ("A", "gene", 10, 20)], 100, limit)
    out = f.overlaps(spark.createDataFrame([(1,)], "k int"), F.array(F.struct(F.lit(15).alias("start"), F.lit(18).alias("end"))), "hits").first().hits
    assert [h.overlap for h in out] == [4, 4]


def test_settings(spark):
    config = {"a": {"b": 1, "c": {"d": "x", "e": [2, {"z": 1, "y": None}]}}, "f": None, "g": True, "h": 0.5, "i": {}}
    assert dict(ST.flatten_settings(spark, config).collect()) == {"a.b": "1", "a.c.d": "x", "a.c.e": '[2, {"y": null, "z": 1}]', "f": "null", "g": "true", "h": "0.5"}


@pytest.mark.parametrize(
    "count, most, both, expected, tier",
    [(1, 1, 0, False, "review"), (2, 1, 0, False, "supported"), (2, 2, 0, False, "strong"), (1, 1, 1, False, "review"), (3, 3, 1, True, "rejected")],
)
def test_tiers(spark, count, most, both, expected, tier):
    row = spark.createDataFrame([(count, most, both, 0, T.EXPECTED if expected else "x")],
                                "distinct_observation_count int, maximum_support_within_sample int, both_caller_supporting_observations int, _undirected int, i string")
    assert row.select(T.tier_columns(F.col("i"), Params())["quality_tier"]).first()[0] == tier


SAM = """@HD\tVN:1
a\t0\tMT\t10\t60\t30M\t*\t0\t0\t{0}\t*\tNH:i:1
b\t0\tMT\t10\t60\t30M\t*\t0\t0\t{0}\t*\tNH:i:2
c\t0\tMT\t10\t10\t30M\t*\t0\t0\t{0}\t*
d\t0\t1\t10\t60\t30M\t*\t0\t0\t{0}\t*
d\t256\tMT\t10\t60\t30M\t*\t0\t0\t{0}\t*
e\t4\t*\t0\t0\t*\t*\t0\t0\t{0}\t*
f\t0\tMT\t10\t60\t30M\t*\t0\t0\t{0}\t*
f\t2048\t1\t10\t60\t10H20M\t*\t0\t0\t{1}\t*
e\t4\t*\t0\t0\t*\t*\t0\t0\t{0}\t*
""".format("A" * 30, "A" * 20)  # fmt: skip


@pytest.fixture
def sam(tmp_path):
    folder = tmp_path / "half"
    folder.mkdir()
    (folder / "s1.sam").write_text(SAM)
    return folder


def test_sam_selection(spark, sam):
    p = Params()
    rows = SA.read_sam(spark, str(sam), p)
    first = rows.filter("query_name = 'a'").first()
    assert (first.sample, first.rotation_name, first.rotation_start, first.query_end, first.ref_end) == ("s1", "half", 8285, 30, 39)
    cats = {(r.query_name, r.flag): r.category for r in S.classify(rows, p).collect()}
    assert [cats[k] for k in (("a", 0), ("b", 0), ("c", 0), ("d", 0), ("e", 4))] == ["high_confidence_mt", "ambiguous_mt", "low_quality_mt", "non_mt_primary", "unmapped"]
    groups = {r.query_name: r.category for r in S.competitive_groups(rows, p).collect()}
    assert groups["f"] == "mt_primary_ambiguous" and groups["d"] == "nuclear_primary_with_mt_competitor" and groups["a"] == "mt_primary_best"
    kept = {r.query_name: r.retention_reason for r in S.deplete_nuclear(rows, p).collect()}
    assert kept == {"e": "primary_unmapped", "c": "weak_or_partial_nuclear_alignment"}


def test_stream_equals_batch(spark, sam, tmp_path):
    out = stream_depleted(spark, str(sam), Params())
    query = out.writeStream.format("memory").queryName("kept").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.query_name for r in spark.table("kept").collect()) == ["c", "e"]


def test_fastq_both_ways(spark, tmp_path):
    text = "".join(f"@r{i} x\nac{'gt'[i % 2]}a\n+\nIIII\n" for i in range(50))
    (tmp_path / "s1_R1.fastq").write_text(text)
    with gzip.open(tmp_path / "s2_R2.fastq.gz", "wt") as handle:
        handle.write(text)
    rows = SF.read_fastq(spark, [str(tmp_path / "s1_R1.fastq"), str(tmp_path / "s2_R2.fastq.gz")]).collect()
    for sample, mate in (("s1", "R1"), ("s2", "R2")):
        own = sorted((r.record_no, r.read_id, r.seq) for r in rows if (r.sample, r.mate) == (sample, mate))
        assert own == [(i, f"r{i}", f"AC{'GT'[i % 2]}A") for i in range(50)]


def test_fastq_records_that_end_early(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "s_R1.fastq").write_text(f"@{folder}1 1:N:0\nac\n+\nII\n@{folder}2/1 more\nGG\n+\n")
        with gzip.open(tmp_path / folder / "s_R2.fq.gz", "wt") as handle:
            handle.write(f"@{folder}1\nac\n+\nII\n@{folder}2\n")
    rows = SF.read_fastq(spark, [str(p) for p in sorted(tmp_path.glob("*/*"))]).collect()
    got = sorted((r.mate, r.record_no, r.read_id, r.seq, r.qual) for r in rows)
    assert got == sorted(
        [("R1", 0, f"{f}1", "AC", "II") for f in "ab"] + [("R1", 1, f"{f}2/1", "GG", None) for f in "ab"]
        + [("R2", 0, f"{f}1", "AC", "II") for f in "ab"] + [("R2", 1, f"{f}2", "", None) for f in "ab"])


def test_sam_tags(spark):
    fields = "r1 0 MT 5 60 4M * 0 0 ACGT IIII".replace(" ", "\t")
    tags = "\t".join([f"X{chr(65 + i // 36)}"[:2] + f":i:{i}" for i in range(0, 36, 36)] + ["NH:i:3", "NH:i:9"] + [f"Z{i % 10}:i:{i}" for i in range(1500)] + ["AS:i:7"])
    row = SA.parse_sam(spark.createDataFrame([(f"{fields}\t{tags}",), (fields,)], "value string")).orderBy(F.desc("nh")).collect()
    assert (row[0].nh, row[0].alignment_score, row[1].nh) == (3, 7, 1)


SEARCHES = [
    {"id": "one", "search_sequences": [{"id": "j", "sequence": "AACC", "reverse_complement": "GGTT"}]},
    {"id": "two", "search_strategy": {"type": "multi_sequence_required"}, "search_sequences": [{"id": "p", "sequence": "ACGT"}, {"id": "q", "sequence": "TTTT", "reverse_complement": "AAAA"}]},
]


def test_motifs(spark):
    reads = spark.createDataFrame([("s", n, "R1", i, q) for i, (n, q) in enumerate([("a", "xxggttx"), ("b", "acgt"), ("c", "acgtaaaa"), ("d", "c")])],
                                  "sample string, read_id string, mate string, record_no long, seq string")
    got = {(r.read_id, r.deletion_id, r.matched_sequence_ids, r.matched_orientation) for r in MO.find_motifs(reads, MO.motif_table(spark, SEARCHES)).collect()}
    assert got == {("a", "one", "j", "reverse_complement"), ("c", "two", "p,q", "forward,reverse_complement")}


def test_motifs_against_plain_search(spark):
    """Patterns of all seed lengths, one within another, repeated ones, and reads with null keys and texts."""
    rng = random.Random(6)
    reads = [(rng.choice(["s", "t", None]), f"r{i}", "R1", i, "".join(rng.choice("acGTé") for _ in range(rng.randrange(400)))) for i in range(60)]
    reads += [("s", "none", "R1", 60, None), ("s", "empty", "R1", 61, ""), ("s", "long", "R1", 62, "ACGT" * 30_000)]
    patterns = {"".join(rng.choice("ACGTÉ") for _ in range(n)) for n in (1, 2, 3, 4, 5, 7, 8, 9)} | {"ACGT" * 20, "T" + "ACGT" * 9, "Q", "\u00c9" * 40}
    for read in reads[:40]:
        text = read[4].upper()
        patterns |= {text[a : a + n] for n in (6, 15, 16, 17, 31, 32, 33, 90) for a in [rng.randrange(len(text) + 1)]}
    patterns.discard("")
    schema = "sample string, read_id string, mate string, record_no long, seq string"
    text = spark.createDataFrame(reads, schema).select(F.struct("sample", "read_id", "mate", "record_no").alias("_read"), F.coalesce(F.upper("seq"), F.lit("")).alias("_seq"))
    got = {(r["_read"]["record_no"], r["pattern"]) for r in MO.matching_patterns(text, spark.createDataFrame([(p,) for p in patterns], "pattern string")).collect()}
    assert got == {(i, p) for _, _, _, i, seq in reads for p in patterns if p in (seq or "").upper()}
    assert MO.find_motifs(spark.createDataFrame(reads, schema), MO.motif_table(spark, []).filter("false")).count() == 0


def test_sample_labels(spark):
    rows = spark.createDataFrame([("SRR1", "18G_replicate_5", 1), ("SRR2", "18G_replicate_5", 2)], "Run string, Biological_Replicate string, record_no long")
    got = SS.resolve_samples(rows, "d", "rat", "rat_{age}_{treatment}_{replicate}").orderBy("run_accession").collect()
    assert [r.sample for r in got] == ["rat_18mo_GPA_5", "rat_18mo_GPA_5_2"] and got[0].treatment == "GPA"


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", True, ["x", "y"])], "id string, flag boolean, items array<string>")
    ST.write_tsv(df, str(tmp_path / "t"), ["items", "id", "flag", "missing"])
    assert ST.read_tsv(spark, str(tmp_path / "t")).first().asDict() == {"items": "x;y", "id": "a", "flag": "yes", "missing": None}
    manifest = ST.export_by_key(spark.createDataFrame([("e", "s", "r")] * 3 + [("f", "s", "r")], "id string, sample string, read_id string"), str(tmp_path / "k"), "id", ["sample", "read_id"])
    assert {(r.id, r.read_count) for r in manifest.collect()} == {("e", 1), ("f", 1)}
    (tmp_path / "s1").mkdir()
    (tmp_path / "s1" / "fragment_counts.tsv").write_text("metric\tvalue\ntotal_fragments\t9\nread1_after_filtering\t7\n")
    assert ST.read_fragment_counts(spark, str(tmp_path / "s1" / "fragment_counts.tsv")).first().fragments == 7.0
    (tmp_path / "x.mt_read_summary.json").write_text('{\n"mt_evidence_reads_selected": 4\n}')
    assert ST.read_summaries(spark, str(tmp_path / "x.mt_read_summary.json")).first().asDict() == {"sample": "x", "mt_evidence_reads": 4.0}


def test_p_values():
    assert PV.t_two_sided(2.0, 10) == pytest.approx(0.0733880348, abs=1e-9)
    assert PV.fisher_p(8, 2, 1, 5) == pytest.approx(0.0349650350, abs=1e-9)
    assert PV.mann_whitney_p(9, 3, 3, 0) == pytest.approx(0.1)
    assert PV.mann_whitney_p(4.5, 3, 3, 210.0) == 1.0
    assert PV.ks_p(0.75, 3, 4) == pytest.approx(8 / 35)
    assert PV.ks_p(2e-6, 2_000_000, 2_000_000) == 1.0
    assert PV.ks_p(0.02, 10_001, 10_001) == pytest.approx(PV.ks_p(0.02, 9_999, 9_999), rel=2e-2)
    assert PV.fisher_p(2_000_300, 1_999_700, 2_000_000, 2_000_000) == pytest.approx(math.erfc(299 / 1414.2 / math.sqrt(2)), abs=1e-3)
    assert PV.fisher_p(40, 0, 0, 40) == pytest.approx(2 / math.comb(80, 40), rel=1e-6)
    assert PV.fisher_p(3, 3, 3, 3) == 1.0
    assert PV._exact_u_tail(16, 4, 4) == pytest.approx(1 / 70) and PV._exact_u_tail(8, 4, 4) == pytest.approx(0.5571, abs=1e-3)
    assert 0.0 < PV.mann_whitney_p(100_000, 8, 20_000, 0) < 1.0


def test_adjustment_equals_one_sorted_pass(spark):
    rng = np.random.default_rng(2)
    p = np.round(rng.random(2000) ** 3, 3)
    order = np.argsort(p)
    q = np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1]
    want = dict(zip(p[order].tolist(), np.minimum(q, 1).tolist()))
    got = A.adjust(spark.createDataFrame([(float(x),) for x in p] + [(None,)], "p double"), "p", "q", buckets=16).collect()
    assert all((r.q is None) if r.p is None else r.q == pytest.approx(want[r.p]) for r in got)


def test_unbalanced_model(spark):
    """With an empty cell the model is solved with minimum norm, as numpy does."""
    rows = [("18mo", "Control", 1.0), ("18mo", "Control", 2.0), ("34mo", "Control", 4.0), ("34mo", "Control", 7.0), ("18mo", "GPA", 3.0), ("18mo", "GPA", 3.5)]
    out = A.factorial_model(spark.createDataFrame(rows, "age string, treatment string, unique_exact_deletions double"))
    got = {r.term: r.estimate for r in out.collect()}
    x = np.array([[1, a == "34mo", t == "GPA", a == "34mo" and t == "GPA"] for a, t, _ in rows], dtype=float)
    beta = np.linalg.lstsq(x, np.array([r[2] for r in rows]), rcond=None)[0]
    assert [got[t] for t in ("age", "treatment", "age:treatment")] == pytest.approx(beta[1:].tolist())


def test_hotspots(spark):
    p = Params(length=500, density_bin=100)
    table = spark.createDataFrame([(i, 100.0 * i, float(h)) for i, h in enumerate((1, 2, 9, 3, 8))], "bin_index int, bin_midpoint double, smoothed_summed_support double")
    assert [r.coord for r in V.hotspots(table, p, min_spacing=250).collect()] == [200.0]


def test_density(spark):
    rows = [(10, 150, 5.0, 5), (250, 20, 5.0, 5), (120, 290, 1.0, 1)]
    table = spark.createDataFrame(rows, "left_breakpoint int, right_breakpoint int, plot_support double, supporting_reads int")
    first = V.endpoint_density(table, Params(length=300, density_bin=100, density_smooth_bins=1)).orderBy("bin_index").first()
    assert (first.left_support, first.right_support, first.summed_support) == (5.0, 5.0, 10.0)


def fastq_text(rng, n):
    out = []
    for i in range(n):
        size = rng.choice([0, 1, 5, 60, 300])
        out.append((f"@r{i} @x", "".join(rng.choice("ACGT") for _ in range(size)), "+", "".join(rng.choice("@+I") for _ in range(size))))
    return out


@pytest.mark.parametrize("form", ["plain", "blocks", "members"])
@pytest.mark.parametrize("range_bytes", [37, 900, 1 << 20])
def test_ranges_of_records(spark, tmp_path, form, range_bytes):
    """Every record is read once, wherever ranges begin; the last one ends early."""
    records = fastq_text(random.Random(9), 120)
    text = "".join("\n".join(r) + "\n" for r in records) + "@end 1\nACGT\n+"
    data, path = text.encode(), tmp_path / ("s_R1.fastq" if form == "plain" else "s_R1.fastq.gz")
    cuts = [data[i : i + 700] for i in range(0, len(data), 700)]
    path.write_bytes(data if form == "plain" else b"".join(map(SR.bgzf_block, cuts)) + SR.BGZF_END if form == "blocks" else b"".join(map(gzip.compress, cuts)))
    rows = SR.read_ranges(spark, str(path), "fastq", range_bytes=range_bytes).collect()
    rows.sort(key=lambda r: r.place)
    whole = [(h, s, q) for h, s, _, q in records]
    assert [(r.header, r.seq, r.qual) for r in rows[:120]] == whole
    assert [(r.header, r.seq, r.qual) for r in rows[120:]] == [("@end 1", "ACGT", None)]
    lines = SR.read_ranges(spark, str(path), columns=["value", "place"], range_bytes=range_bytes)
    assert [r.value for r in sorted(lines.collect(), key=lambda r: r.place)] == text.split("\n")
    back = {r.read_id for r in SF.fastq_columns(SR.read_ranges(spark, str(path), "fastq", range_bytes=range_bytes).withColumnRenamed("place", "record_no")).collect()}
    assert back == {f"r{i}" for i in range(120)} | {"end"}


def test_blocks_that_are_whole_lines(spark, tmp_path):
    """Lines that begin where blocks do, and one that fills blocks of its own."""
    lines = ["a" * 10, "b" * 65_000, "c" * 200_000, "d", "", "e"]
    parts = [b"a" * 10 + b"\n", b"b" * 65_000 + b"\n", b"c" * 65_000, b"c" * 65_000, b"c" * 65_000, b"c" * 5000 + b"\n", b"d\n\n", b"e\n"]
    (tmp_path / "x.gz").write_bytes(b"".join(map(SR.bgzf_block, parts)) + SR.BGZF_END)
    for range_bytes in (10, 100, 170, 1000):
        got = SR.read_ranges(spark, str(tmp_path), range_bytes=range_bytes).collect()
        assert [r.value for r in sorted(got, key=lambda r: r.place)] == lines


def test_exports_show_what_was_committed(spark, tmp_path):
    rows = [("k/1", 2, "x"), ("k/1", 1, None), ("k/1", 1, None), ("", 5, "y"), (None, 6, "z")] + [("hot", i, "w") for i in range(500)]
    folder = str(tmp_path / "out")
    table = spark.createDataFrame(rows, "k string, n int, t string")
    listed = SE.export_keyed(table.repartition(5), folder, "k", ["n", "t"]).collect()
    assert {k: sum(r.read_count for r in listed if r.id == k) for k in ("k/1", "", None, "hot")} == {"k/1": 2, "": 1, None: 1, "hot": 500}
    (tmp_path / "out" / "data" / "lost").mkdir()
    (tmp_path / "out" / "data" / "lost" / "0-hot.tsv").write_text("n\tt\n1\tlost\n")
    listed = SE.read_manifest(spark, folder).collect()
    for key, want in (("hot", {(i, "w") for i in range(500)}), ("k/1", {(1, None), (2, "x")})):
        files = [f"{folder}/{r.read_list_file}" for r in listed if r.id == key]
        assert {tuple(r) for r in ST.read_tsv(spark, files, "n int, t string").collect()} == want
    assert SE.export_keyed(table.limit(0), str(tmp_path / "none"), "k", ["n"]).count() == 0


def test_reads_close_after_a_pause(spark, tmp_path):
    """Records of a read in any order of files give the batch decision; a later record after the pause opens a group of its own."""
    rng = random.Random(4)
    rows = [(rng.choice("st"), f"r{rng.randrange(60)}", rng.choice([0, 16, 256, 2048, 4]), rng.randrange(60), rng.choice(["MT", "1"]), rng.random(), i) for i in range(400)]
    schema = "sample string, query_name string, flag int, mapq int, reference_name string, aligned_fraction double, record_no long"
    table = spark.createDataFrame(rows, schema)
    arriving = tmp_path / "in"
    for k, part in enumerate(table.randomSplit([1.0] * 4, 3)):
        part.withColumn("arrived", F.timestamp_seconds(F.lit(k))).coalesce(1).write.mode("append").parquet(str(arriving))
    last = table.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields]).withColumn("arrived", F.timestamp_seconds(F.lit(10_000)))
    last.coalesce(1).write.mode("append").parquet(str(arriving))
    stream = spark.readStream.schema(spark.read.parquet(str(arriving)).schema).option("maxFilesPerTrigger", 1).parquet(str(arriving))
    closed = decisions(stream, Params(), "1 minute", str(tmp_path / "out"), str(tmp_path / "cp")).filter("sample is not null")
    key = lambda r: (r.sample, r.query_name, r.records, r.category)
    assert sorted(map(key, closed.collect())) == sorted(map(key, S.competitive_groups(table, Params()).collect()))
    again = table.limit(1).withColumn("arrived", F.timestamp_seconds(F.lit(20_000))).unionByName(last.withColumn("arrived", F.timestamp_seconds(F.lit(40_000))))
    again.coalesce(1).write.mode("append").parquet(str(arriving))
    more = decisions(stream, Params(), "1 minute", str(tmp_path / "out"), str(tmp_path / "cp")).filter("sample is not null")
    assert more.count() == S.competitive_groups(table, Params()).count() + 1


@pytest.mark.parametrize("seed", range(2))
def test_nearest_feature_against_plain_search(spark, seed):
    """Nested, equal and touching features, and positions at, between and beyond them."""
    rng = random.Random(seed)
    rows = [(f"f{rng.randrange(9)}", rng.choice(["gene", "exon"]), s, s + rng.choice([0, 3, 40])) for s in [rng.randrange(20, 300) for _ in range(25)]]
    rows.append((*rows[0][:2], rows[0][2], rows[0][3] + 7))
    found = features(spark, rows, 400, 0)
    kept = [tuple(r) for r in found._entries.select("start", "end", "name", "type").collect()]
    df = spark.createDataFrame([(x,) for x in range(1, 401)] + [(None,)], "p int")
    got = {r.p: r.near for r in found.nearest(df, "p", "near").collect()}

    def plain(x):
        d, s, e, n, t = min((0 if s <= x <= e else min(abs(x - s), abs(x - e)), s, e, n, t) for s, e, n, t in kept)
        return f"{n}:{t}:{s}-{e};distance={d}"

    assert got == {None: "", **{x: plain(x) for x in range(1, 401)}}


def test_blocks_of_cigars(spark):
    rng = random.Random(3)
    rows = [("s", "r0", 10, "5S10M2I5M3D7M"), ("s", "r1", None, "5M"), ("s", "r2", 7, ""), ("s", "r3", 7, "4S3H"), ("s", "r4", 1, "1M" + "1D1M" * 2000)]
    rows += [("t", f"q{i}", rng.randrange(1, 50), "".join(f"{rng.randrange(1, 9)}{rng.choice('MIDNSHP=X')}" for _ in range(rng.randrange(12)))) for i in range(60)]
    got = {}
    for r in P.aligned_blocks(spark.createDataFrame(rows, "sample string, name string, pos int, cigar string")).collect():
        got.setdefault(r["name"], []).append((r.start, r.end))
    for _, name, pos, cigar in rows:
        want, at = [], pos
        for n, op in re.findall("([0-9]+)(.)", cigar) if pos is not None else []:
            if op in "M=X":
                want.append((at, at + int(n) - 1))
            at += int(n) if op in "MDN=X" else 0
        assert got.get(name, []) == want


def test_audit_counts_what_is_missing(spark):
    rows = [(10, 20, 9), (10, 20, 8), (10, 20, None), (None, 20, 9), (20, 10, 89)]
    table = spark.createDataFrame(rows, "left_breakpoint int, right_breakpoint int, deleted_size int")
    checks = Z.table_checks({"t": table}, 100).first()
    assert (checks["rows"], checks.size_mismatches, checks.origin_spanning_rows) == (5, 3, 1)


def test_stated_numbers_must_parse(spark):
    with pytest.raises(ValueError, match="left_breakpoint"):
        FA.deletion_targets(spark, [{"name": "x", "left_breakpoint": "84a69"}], [], 16569)
    assert FA.deletion_targets(spark, [{"name": "x", "left_breakpoint": " 8469 ", "right_breakpoint": ""}], [], 16569).count() == 1


def test_hotspots_keep_their_distance(spark):
    rows = [(i, i * 10 + 5.5, float(y)) for i, y in enumerate([5, 9, 5, 8, 1, 0, 7, 0, 2, 9])]
    density = spark.createDataFrame(rows, "bin_index int, bin_midpoint double, smoothed_summed_support double")
    got = [(r.coord, r.height) for r in V.hotspots(density, Params(length=100, density_bin=10), top=3, min_spacing=25).collect()]
    assert got == [(15.5, 9.0), (65.5, 7.0)]  # 95.5 is as high as 15.5 and 20 away, 35.5 likewise
    assert V.hotspots(density.limit(2), Params(length=20, density_bin=10)).count() == 0


def test_dictionary_and_settings(spark):
    table = spark.createDataFrame([("s", 1, 2)], "sample string, left_breakpoint int, odd int")
    rows = {(r["table"], r["column"]): (r.category, r.definition) for r in ST.data_dictionary(spark, {"t": table}, {"odd": "An odd one."}).collect()}
    assert rows["t", "sample"][0] == "biological_metadata" and rows["t", "left_breakpoint"][0] == "coordinates"
    assert rows["t", "odd"] == ("workflow_or_analysis_field", "An odd one.")
    settings = {r.setting: r.value for r in ST.flatten_settings(spark, {"a": {"b": 1, "c": [1, 2]}, "d": True, "e": "x"}).collect()}
    assert settings == {"a.b": "1", "a.c": "[1, 2]", "d": "true", "e": "x"}


def test_documents_under_their_names(spark, tmp_path):
    rows = spark.createDataFrame([("a.mt_read_summary.json", '{"mt_evidence_reads_selected": 3}'), ("b.mt_read_summary.json", "{}")], "name string, text string")
    assert SE.write_documents(rows, str(tmp_path)) == 2
    assert {(r.sample, r.mt_evidence_reads) for r in ST.read_summaries(spark, str(tmp_path)).collect()} == {("a", 3.0), ("b", 0.0)}


def test_wide_rows_and_back(spark):
    counts = spark.createDataFrame([("k", "s", "x", 2), ("k", "t", "y", 1), ("m", "s", "x", 5)], "label_kind string, sample string, label string, reads long")
    wide = M.wide_rows(counts, spark.createDataFrame([("s",), ("t",), ("u",)], "sample string"))
    assert {(r.label_kind, r["sample"]): (r.labels, r["values"]) for r in wide.collect()} == {
        ("k", "s"): (["x", "y"], [2, 0]), ("k", "t"): (["x", "y"], [0, 1]), ("k", "u"): (["x", "y"], [0, 0]),
        ("m", "s"): (["x"], [5]), ("m", "t"): (["x"], [0]), ("m", "u"): (["x"], [0])}
    assert V.melt_rows(wide, ["label_kind", "sample"]).filter("reads > 0").count() == 3


def test_small_ranges_share_tasks_and_reads(tmp_path):
    """Ranges of a few bytes do not make a task each, nor read far past their ends; together they cover every file once."""
    for i in range(3):
        (tmp_path / f"{i}.txt").write_bytes(b"0123456789abcde\n" * 20_000 + b"x" * i)
    reader = SR.RecordReader(StructType().add("path", "string").add("place", "long").add("value", "string"), {"kind": "lines", "rangebytes": "64", "paths": str(tmp_path)})
    tasks = reader.partitions()
    assert 100 < len(tasks) <= 3 * SR.TASKS
    for i in range(3):
        cuts = [(r.start, r.end) for t in tasks for p in t.parts for r in p.cut(t.step) if p.path.endswith(f"{i}.txt")]
        assert cuts == [(a, min(a + 64, 320_000 + i)) for a in range(0, 320_000 + i, 64)]
    assert sum(b.num_rows for b in reader.read(tasks[0])) == tasks[0].parts[-1].end // 16 + 1
    big = SR.Range(str(tmp_path / "0.txt"), 64, 128, 320_000, "plain")
    assert [len(d) for _, d in zip(range(2), (d for _, d in SR._pieces(big)))] == [64, SR.BEYOND]


def test_evidence_row_is_chosen_before_wide_columns_come(spark):
    members = spark.createDataFrame(
        [("s", "a", "x", 1, 2, 20, 30, "n"), ("s", "a", "x", 3, 4, 25, 30, "n"), ("s", "b", "x", 1, 2, 20, 20, "n"), ("t", "a", "x", 5, 6, None, 9, "h"), ("t", "a", "x", 9, 9, 1, 1, "h")],
        "sample string, read_id string, species string, leader_left int, leader_right int, left_anchor_length int, right_anchor_length int, rotation_name string",
    )
    clusters = spark.createDataFrame(
        [("x", 1, 2, "e", "first", ["s"]), ("x", 3, 4, "e", "second", ["s"]), ("x", 5, 6, "f", None, ["t"])],
        "species string, leader_left int, leader_right int, exact_deletion_id string, affected_features string, supporting_samples array<string>",
    )
    out = M.evidence_join(members, clusters)
    assert out.columns == ["species", "leader_left", "leader_right", "sample", "read_id", "left_anchor_length", "right_anchor_length", "rotation_name", "exact_deletion_id", "affected_features"]
    got = {(r.sample, r.read_id, r.exact_deletion_id): (r.leader_left, r.affected_features) for r in out.collect()}
    assert got == {("s", "a", "e"): (3, "second"), ("s", "b", "e"): (1, "first"), ("t", "a", "f"): (5, None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Window")
