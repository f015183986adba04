"""SQL twins of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}
L = 16569


def gap(a: str, b: str) -> str:
    return f"(CASE WHEN {b} > {a} THEN {b} - {a} - 1 ELSE {L} - {a} + {b} - 1 END)"


def dist(a: str, b: str) -> str:
    return f"least(abs({a} - {b}), {L} - abs({a} - {b}))"


def norm(x: str, rot: str = "1") -> str:
    return f"((({x}) + ({rot}) - 2 + 3 * {L}) % {L} + 1)"


def rotated(x: str, rot: str) -> str:
    return f"((({x}) - ({rot}) + 3 * {L}) % {L} + 1)"


def interval(a: str, b: str) -> str:
    return (
        f"concat_ws(';', CASE WHEN {b} > {a} AND {b} - {a} > 1 THEN ({a} + 1) || '-' || ({b} - 1) END,"
        f" CASE WHEN {b} <= {a} AND {a} < {L} THEN ({a} + 1) || '-{L}' END,"
        f" CASE WHEN {b} <= {a} AND {b} > 1 THEN '1-' || ({b} - 1) END)"
    )


def overlap(a: str, b: str, s: str, e: str) -> str:
    """Bases of s..e inside the arc deleted between a and b."""
    return (
        f"(greatest(0, least(CASE WHEN {b} > {a} THEN {b} - 1 ELSE {L} END, {e}) - greatest({a} + 1, {s}) + 1)"
        f" + CASE WHEN {b} <= {a} THEN greatest(0, least({b} - 1, {e}) - greatest(1, {s}) + 1) ELSE 0 END)"
    )


def event_id(a: str, b: str, n: str) -> str:
    return f"('mtDel_' || lpad(CAST({a} AS VARCHAR), 5, '0') || '_' || lpad(CAST({b} AS VARCHAR), 5, '0') || '_' || lpad(CAST({n} AS VARCHAR), 5, '0'))"


def pair_id(a: str, b: str) -> str:
    return f"('mtPair_' || lpad(CAST(least({a}, {b}) AS VARCHAR), 5, '0') || '_' || lpad(CAST(greatest({a}, {b}) AS VARCHAR), 5, '0'))"


def size_class(n: str) -> str:
    return (
        f"CASE WHEN {n} < 250 THEN 'small_lt_250bp' WHEN {n} < 1000 THEN 'small_250bp_to_999bp' WHEN {n} < 5000 THEN 'medium_1kb_to_4999bp'"
        f" WHEN {n} < 10000 THEN 'large_5kb_to_9999bp' ELSE 'very_large_ge_10kb' END"
    )


SEG = f"""
base AS (
  SELECT 's' || CAST(l_orderkey % 12 AS VARCHAR) AS sample, 'r' || CAST(l_orderkey AS VARCHAR) AS read_id, l_orderkey AS orderkey,
    (l_linenumber - 1) * 50 AS query_start, (l_linenumber - 1) * 50 + 50 - l_suppkey % 3 AS query_end,
    (1000 * (l_suppkey % 17) + l_partkey % 31 - 15 - 1 + {L}) % {L} + 1 AS std_end,
    CASE WHEN l_returnflag = 'N' THEN 'half' ELSE 'normal' END AS rotation_name,
    CASE WHEN l_returnflag = 'N' THEN 8285 ELSE 1 END AS rotation_start,
    CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, CAST(l_quantity AS BIGINT) AS mapq,
    CASE WHEN l_linenumber = 1 THEN 0 WHEN l_discount >= 0.095 THEN 256 ELSE 2048 END + CASE WHEN l_linestatus = 'F' THEN 0 ELSE 16 END AS flag,
    CASE WHEN l_suppkey % 3 < 2 THEN 'MT' ELSE '1' END AS reference_name, 1 + l_partkey % 2 AS nh, (l_quantity + 50) / 100 AS aligned_fraction,
    l_partkey % 4 AS edit_distance, 40 + l_partkey % 60 AS alignment_score,
    CASE WHEN l_partkey % 5 = 0 THEN 'MT,1,+,50M,60,0;MT,9,+,50M,60,0;' ELSE 'MT,1,+,50M,60,0;' END AS sa_tag,
    l_linenumber AS linenumber, l_partkey AS partkey, l_suppkey AS suppkey FROM lineitem),
seg AS (
  SELECT *, query_end - query_start AS anchor_length, {rotated("std_end - 49", "rotation_start")} AS ref_start_raw,
    {rotated("std_end", "rotation_start")} AS ref_end_raw, {norm("std_end - 49")} AS ref_start, std_end AS ref_end,
    CASE WHEN query_start > 0 THEN query_start || 'S' ELSE '' END || (query_end - query_start) || 'M10S' AS cigar,
    flag < 256 AS is_primary, flag >= 256 AND flag < 2048 AS is_secondary, flag >= 2048 AS is_supplementary FROM base)"""

SEG_ORDER = "query_start, {0}.query_end, {0}.ref_start_raw, {0}.ref_end_raw, {0}.flag, {0}.cigar, {0}.mapq"


def side(name: str, left: bool) -> str:
    a, b = ("a", "b") if left else ("b", "a")
    return f"CASE WHEN a.strand = '+' THEN {a}.{name} ELSE {b}.{name} END"


def _paired(join: str) -> str:
    return f"""
paired AS (
  SELECT a.sample, a.read_id, a.rotation_name, a.rotation_start, a.orderkey, a.strand,
    {side("ref_end", True)} AS dl, {side("ref_start", False)} AS dr,
    {side("anchor_length", True)} AS left_anchor_length, {side("anchor_length", False)} AS right_anchor_length,
    {side("ref_end_raw", True)} AS raw_left_breakpoint, {side("ref_start_raw", False)} AS raw_right_breakpoint,
    {side("mapq", True)} AS left_mapq, {side("mapq", False)} AS right_mapq,
    {side("cigar", True)} AS left_cigar, {side("cigar", False)} AS right_cigar, {side("flag", True)} AS left_flag, {side("flag", False)} AS right_flag,
    {side("is_primary", True)} AS left_is_primary, {side("is_primary", False)} AS right_is_primary,
    {side("is_secondary", True)} AS left_is_secondary, {side("is_secondary", False)} AS right_is_secondary,
    {side("edit_distance", True)} AS left_edit_distance, {side("edit_distance", False)} AS right_edit_distance,
    {side("alignment_score", True)} AS left_alignment_score, {side("alignment_score", False)} AS right_alignment_score,
    {side("sa_tag", True)} AS left_sa_tag, {side("sa_tag", False)} AS right_sa_tag,
    greatest(0, least(a.query_end, b.query_end) - greatest(a.query_start, b.query_start)) AS query_overlap_bp,
    greatest(0, b.query_start - a.query_end) AS query_gap_bp,
    a.query_start AS query_first_start, a.query_end AS query_first_end, b.query_start AS query_second_start, b.query_end AS query_second_end
  FROM {join}
  WHERE a.strand = b.strand AND greatest(0, least(a.query_end, b.query_end) - greatest(a.query_start, b.query_start)) <= 10
    AND greatest(0, b.query_start - a.query_end) <= 20)"""


ALL_PAIRS = f"""seg a JOIN seg b ON a.sample = b.sample AND a.read_id = b.read_id AND a.rotation_name = b.rotation_name
    AND row(a.{SEG_ORDER.format("a")}) < row(b.{SEG_ORDER.format("b")})"""
ADJACENT = f"""(SELECT *, row_number() OVER (PARTITION BY sample, rotation_name, read_id ORDER BY seg.{SEG_ORDER.format("seg")}) AS n FROM seg) a
  JOIN (SELECT *, row_number() OVER (PARTITION BY sample, rotation_name, read_id ORDER BY seg.{SEG_ORDER.format("seg")}) AS n FROM seg) b
    ON a.sample = b.sample AND a.read_id = b.read_id AND a.rotation_name = b.rotation_name AND b.n = a.n + 1"""


def _placed(left: str = "dl", right: str = "dr") -> str:
    return f"""
placed AS (SELECT *, {left} AS left_breakpoint, {right} AS right_breakpoint, least(left_anchor_length, right_anchor_length) AS min_anchor_length,
    least(left_mapq, right_mapq) AS min_mapq FROM paired),
sized AS (SELECT *, {gap("left_breakpoint", "right_breakpoint")} AS deleted_size FROM placed),
events_all AS (
  SELECT *, {event_id("left_breakpoint", "right_breakpoint", "deleted_size")} AS deletion_id, {pair_id("left_breakpoint", "right_breakpoint")} AS breakpoint_pair_id,
    right_breakpoint <= left_breakpoint AS wraps_origin, {interval("left_breakpoint", "right_breakpoint")} AS deleted_interval,
    {gap("right_breakpoint", "left_breakpoint")} AS complement_deleted_size
  FROM sized WHERE deleted_size BETWEEN 100 AND 16000)"""


EVENTS = f"""{SEG},{_paired(ALL_PAIRS)},{_placed()},
events AS (
  SELECT * FROM events_all
  QUALIFY row_number() OVER (PARTITION BY sample, rotation_name, read_id, deletion_id ORDER BY query_first_start, query_first_end,
    query_second_start, query_second_end, raw_left_breakpoint, raw_right_breakpoint, left_mapq, right_mapq, left_cigar, right_cigar, left_flag, right_flag) = 1)"""

EVENT = """sample, read_id, rotation_name, deletion_id, breakpoint_pair_id, left_breakpoint, right_breakpoint, deleted_size, wraps_origin, deleted_interval,
  complement_deleted_size, left_anchor_length, right_anchor_length, min_mapq, strand, raw_left_breakpoint, raw_right_breakpoint, query_overlap_bp, query_gap_bp,
  query_first_start, query_second_start, left_cigar, right_cigar, left_flag, right_is_secondary"""

# ---- coordinates ---------------------------------------------------------------------------

ENDS = f"{SEG}, ends AS (SELECT DISTINCT std_end AS l, (std_end + partkey * 7 - 1) % {L} + 1 AS r, rotation_start, partkey AS k FROM seg), lr AS (SELECT DISTINCT l, r FROM ends)"

ORACLES["c_positions"] = f"""WITH {ENDS}
SELECT l, r, rotation_start, k, {norm("l", "rotation_start")} AS standard, {rotated("l", "rotation_start")} AS rotated,
  (rotation_start - 1 + l - 1000 - 1 + {L}) % {L} + 1 AS padded, {gap("l", "r")} AS gap, {dist("l", "r")} AS distance, {size_class(gap("l", "r"))} AS size_class,
  {dist("l", "r")} <= k % 500 AS inside,
  round(fmod((l + CASE WHEN r < l THEN r + {L} ELSE r END) / 2.0 - 1, {L}) + 1, 6) AS midpoint, round((l - 1) / {L}.0 * 360, 6) AS angle FROM ends"""

ORACLES["c_directed_record"] = f"""WITH {ENDS}, g AS (SELECT *, {gap("l", "r")} AS f, {gap("r", "l")} AS b FROM lr),
s AS (SELECT *, b < f OR (b = f AND r < l) AS swap FROM g)
SELECT l, r, f AS deleted_size, r <= l AS wraps_origin, {interval("l", "r")} AS deleted_interval, b AS complement_deleted_size, l <= r AS complement_wraps_origin,
  CASE WHEN swap THEN r ELSE l END AS arc_left, CASE WHEN swap THEN l ELSE r END AS arc_right, swap AS arc_reversed,
  {event_id("l", "r", "f")} AS deletion_id, {pair_id("l", "r")} AS pair_id FROM s"""


def closed(s: str, e: str) -> str:
    return f"CASE WHEN {s} <= {e} THEN {s} || '-' || {e} ELSE {s} || '-{L};1-' || {e} END"


ORACLES["c_pieces"] = f"""WITH {ENDS}, x AS (SELECT *, {norm("l - 20")} AS ws, {norm("l + 20")} AS we, {norm("l", "8285")} AS bs, {norm("r", "8285")} AS be FROM lr)
SELECT l, r, {interval("l", "r")} AS deleted, {closed("r", "l")} AS region, {gap("l", "r")} AS deleted_bp,
  CASE WHEN r <= l THEN {overlap("l", "r", "r", "l")} ELSE {overlap("l", "r", "r", str(L))} + {overlap("l", "r", "1", "l")} END AS shared_bp,
  {closed("ws", "we")} AS window, {closed("bs", "be")} AS block, {overlap("l", "r", "5000", "9000")} AS with_interval FROM x"""

ORACLES["c_circular_median"] = f"""WITH {SEG}, g AS (SELECT sample, suppkey % 17 AS spot, std_end AS v, min(std_end) OVER (PARTITION BY sample, suppkey % 17) AS a FROM seg),
m AS (SELECT sample, spot, quantile_cont(a + (v - a + {L // 2} + {L}) % {L} - {L // 2}, 0.5) AS m FROM g GROUP BY ALL)
SELECT sample, spot, (CAST(round_even(m, 0) AS BIGINT) - 1 + {L}) % {L} + 1 AS median_position FROM m"""

ORACLES["c_rotate_text"] = """WITH d AS (SELECT doc_id, text, 1 + doc_id % length(text) AS k FROM documents)
SELECT doc_id, k AS "at", length(text) AS n, md5(substr(text, k) || substr(text, 1, k - 1)) AS digest FROM d"""

# ---- ingest --------------------------------------------------------------------------------

ORACLES["s_sam_text"] = f"""WITH {SEG}
SELECT sample, read_id AS query_name, flag, reference_name, ref_start_raw AS pos, mapq, query_start, query_start + anchor_length + 5 AS query_end,
  ref_start_raw + anchor_length + 2 + 5 - 1 AS ref_end, round((anchor_length + 5)::DOUBLE / (query_start + anchor_length + 8), 6) AS aligned_fraction,
  round(query_start::DOUBLE / (query_start + anchor_length + 8), 6) AS soft_clip_fraction,
  round((anchor_length + 5)::DOUBLE / (query_start + anchor_length + 5), 6) AS stored_aligned_fraction, nh, edit_distance, sa_tag, CAST(NULL AS INT) AS alignment_score FROM seg"""

JUNCTIONS = f"""{SEG}, j AS (
  SELECT sample, orderkey, CASE WHEN suppkey % 5 < 4 THEN 'MT' ELSE '1' END AS contig_a, std_end AS breakpoint_a, strand AS strand_a,
    CASE WHEN partkey % 7 < 6 THEN 'MT' ELSE '2' END AS contig_b, {norm("std_end + partkey % 9000 + 40")} AS breakpoint_b,
    CASE WHEN mapq % 10 > 0 THEN strand ELSE '+' END AS strand_b, partkey % 5 AS repeat_left, suppkey % 4 AS repeat_right, read_id,
    {norm("std_end - 40")} AS start_a, {norm("std_end + partkey % 9000 + 40")} AS start_b, mapq % 40 + 8 AS la, mapq % 25 + 10 AS ra,
    mapq % 40 + 8 + partkey % 30 AS clip, alignment_score AS score FROM seg)"""

ORACLES["s_junction_text"] = f"""WITH {JUNCTIONS}, e AS (
  SELECT sample, 'human' AS species, read_id || '/1' AS read_id, (breakpoint_a - 5 - 1 + {L}) % {L} + 1 AS left_breakpoint, (breakpoint_b - 5 - 1 + {L}) % {L} + 1 AS right_breakpoint,
    la AS left_anchor_length, ra AS right_anchor_length, strand_a || ':' || strand_b AS strand, 'STAR_Chimeric.out.junction' AS source, 'normal' AS rotation_name,
    1 AS rotation_start, breakpoint_a AS raw_left_breakpoint, breakpoint_b AS raw_right_breakpoint FROM j),
s AS (SELECT *, {gap("left_breakpoint", "right_breakpoint")} AS deleted_size FROM e),
f AS (SELECT *, concat_ws(';', CASE WHEN left_anchor_length < 20 THEN 'left_anchor_short' END, CASE WHEN right_anchor_length < 20 THEN 'right_anchor_short' END,
  CASE WHEN deleted_size < 100 THEN 'deletion_too_small' END, CASE WHEN deleted_size > 16000 THEN 'deletion_too_large' END) AS filter_reason FROM s)
SELECT *, CASE WHEN filter_reason = '' THEN 'pass' ELSE 'fail' END AS filter_status FROM f"""

ORACLES["s_junction_summary"] = f"""SELECT sample, count(*) AS candidate_reads, count(*) FILTER (filter_status = 'pass') AS passing_reads,
  count(*) FILTER (filter_status = 'fail') AS failed_reads FROM ({ORACLES["s_junction_text"]}) GROUP BY sample"""

ORACLES["s_fastq_text"] = """SELECT 'r' || doc_id || '/1' AS read_id, 'r' || doc_id AS read_key, 'R1' AS mate, md5(upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', 'N', 'g'))) AS digest,
  length(coalesce(text, '')) AS quality_length FROM documents"""
ORACLES["s_fastq_ranges"] = ORACLES["s_fastq_text"]
ORACLES["s_sam_ranges"] = ORACLES["s_sam_text"]
ORACLES["s_export"] = """SELECT o_orderpriority AS id, count(*) AS read_count, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, round(sum(o_totalprice), 2) AS price FROM orders GROUP BY 1"""
ORACLES["s_run_table"] = """SELECT o_orderstatus, o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE 'no' END AS late, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, 0 AS missing FROM orders GROUP BY 1, 2, 3"""
ORACLES["s_summaries"] = f"""WITH {SEG}, p AS (SELECT sample, count(*) AS n, count(DISTINCT read_id) AS reads FROM seg GROUP BY sample)
SELECT sample, CAST(CASE WHEN n % 2 = 0 THEN reads ELSE n END AS DOUBLE) AS mt_evidence_reads, CAST(reads AS DOUBLE) AS fragments FROM p"""
ORACLES["w_preparation"] = f"""WITH {SEG}, p AS (SELECT sample, CAST(substr(sample, 2) AS BIGINT) AS i, count(*) AS n, round(avg(anchor_length), 3) AS len FROM seg GROUP BY sample),
s AS (SELECT *, CASE WHEN i % 2 = 0 THEN '18mo' ELSE '34mo' END AS age, CASE WHEN (i // 2) % 2 = 0 THEN 'Control' ELSE 'GPA' END AS treatment FROM p)
SELECT sample, age || '_' || treatment AS condition, 'demo' AS dataset, 'human' AS species, 'single' AS layout, age, treatment, CASE WHEN i % 2 = 0 THEN 'single end (50 cycles)' END AS sequencing_cycles,
  CASE WHEN i % 2 = 0 THEN 50 END AS read1_cycles_raw, CASE WHEN i % 2 = 0 THEN len END AS read1_mean_length_raw, CASE WHEN i % 2 = 0 THEN len END AS read1_mean_length_after_fastp,
  CASE WHEN i % 2 = 0 THEN 2 * n END AS total_reads_raw, CASE WHEN i % 2 = 0 THEN n END AS total_reads_after_fastp, CASE WHEN i % 2 = 0 THEN 0.9 END AS q30_rate_raw, CASE WHEN i % 2 = 0 THEN 0.9 END AS q30_rate_after_fastp,
  CASE WHEN i % 2 = 0 THEN n % 11 END AS adapter_trimmed_reads, CASE WHEN i % 2 = 0 THEN n % 7 END AS too_short_reads_removed, 'not recorded' AS fastp_trimming_run FROM s"""
ORACLES["s_gtf_text"] = """WITH p AS (SELECT *, ['gene','exon','CDS','start_codon','tRNA'][CAST(p_partkey % 5 + 1 AS INT)] AS kind FROM part)
SELECT 'circular' AS origin, p_partkey + 1 AS start, p_partkey + 1 + p_size AS "end", kind AS feature_type, 'ENS' || p_partkey AS gene_id,
  CASE WHEN p_partkey % 3 > 0 THEN p_brand ELSE 'ENS' || p_partkey END AS gene_name, p_name AS product FROM p WHERE p_partkey % 4 > 0 AND kind <> 'start_codon'
UNION ALL SELECT 'other', p_partkey + 1, NULL, NULL, NULL, NULL, NULL FROM p WHERE p_partkey % 4 = 0"""
ORACLES["s_resolve_samples"] = r"""WITH o AS (
  SELECT o_orderkey AS k, 'SRR' || o_orderkey AS run, CASE WHEN o_orderkey % 7 > 0 THEN (18 + o_orderkey % 2 * 16) || ['G','C',''][CAST(o_orderkey % 3 + 1 AS INT)] || '_replicate_' || (o_orderkey % 5) ELSE '' END AS bio,
    CASE WHEN o_orderkey % 2 = 0 THEN 'liver' ELSE n_name END AS tissue, CASE WHEN o_orderkey % 4 = 0 THEN 'paired' ELSE 'single' END AS layout
  FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 25),
d AS (SELECT *, CASE WHEN bio = '' THEN 'NA' ELSE (18 + k % 2 * 16) || 'mo' END AS age, CASE WHEN bio = '' OR k % 3 = 2 THEN 'NA' WHEN k % 3 = 0 THEN 'GPA' ELSE 'Control' END AS treatment,
  CASE WHEN bio = '' THEN run ELSE CAST(k % 5 AS VARCHAR) END AS rep FROM o),
b AS (SELECT *, 'rat_' || age || '_' || treatment || '_' || rep AS base FROM d),
n AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY k) AS n FROM b)
SELECT CASE WHEN n = 1 THEN base ELSE base || '_' || n END AS sample, run AS run_accession,
  CASE WHEN k % 3 > 0 THEN 'https://ftp.host/' || run || '_1.gz' ELSE '' END AS fastq_1, CASE WHEN k % 3 > 0 THEN 'http://x/' || run || '_2.gz' ELSE '' END AS fastq_2,
  layout, age, treatment, age || '_' || treatment AS condition, tissue FROM n"""

ORACLES["s_sample_violations"] = """WITH o AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE 'x' || (o_orderkey % 5000) END AS sample, CASE WHEN o_orderkey % 4 = 1 THEN 'paired' ELSE 'single' END AS kind FROM orders),
v AS (
  SELECT 'empty_sample' AS rule, sample FROM o WHERE sample = ''
  UNION ALL SELECT 'duplicate_sample', sample FROM o WHERE sample <> '' GROUP BY sample HAVING count(*) > 1
  UNION ALL SELECT 'unsupported_layout', sample FROM o WHERE k % 4 = 3
  UNION ALL SELECT 'paired_without_second_file', sample FROM o WHERE kind = 'paired' AND k % 5 > 0
  UNION ALL SELECT 'single_with_second_file', sample FROM o WHERE kind = 'single' AND k % 5 = 0
  UNION ALL SELECT 'no_input', sample FROM o WHERE k % 3 = 0 AND k % 6 = 0
  UNION ALL SELECT 'other_dataset', sample FROM o WHERE k % 11 = 0
  UNION ALL SELECT 'other_species', sample FROM o WHERE k % 13 = 0
  UNION ALL SELECT 'layout_against_strategy', sample FROM o WHERE kind = 'paired'
  UNION ALL SELECT 'empty_group_value', sample FROM o WHERE k % 17 = 0
  UNION ALL SELECT 'target_size', 't')
SELECT rule, count(*) AS found, count(DISTINCT sample) AS subjects FROM v GROUP BY rule"""

# ---- read selection ------------------------------------------------------------------------

CAT = """CASE WHEN flag >= 2048 THEN CASE WHEN reference_name = 'MT' THEN 'supplementary_mt' ELSE 'supplementary_non_mt' END
  WHEN flag >= 256 THEN CASE WHEN reference_name = 'MT' THEN 'secondary_mt' ELSE 'secondary_non_mt' END
  WHEN reference_name <> 'MT' THEN 'non_mt_primary' WHEN mapq < 20 THEN 'low_quality_mt' WHEN nh > 1 THEN 'ambiguous_mt' ELSE 'high_confidence_mt' END"""
CHIM = """chim AS (SELECT DISTINCT sample, read_id FROM j WHERE (contig_a = 'MT' OR contig_b = 'MT'))"""
CLASSED = f"""{JUNCTIONS}, {CHIM}, cat AS (SELECT seg.*, {CAT} AS category, chim.read_id IS NOT NULL AS chimeric FROM seg LEFT JOIN chim ON seg.sample = chim.sample AND seg.read_id = chim.read_id)"""
OWN = "category IN ('high_confidence_mt', 'low_quality_mt', 'ambiguous_mt', 'supplementary_mt', 'secondary_mt')"
OWN_NOSEC = "category IN ('high_confidence_mt', 'low_quality_mt', 'ambiguous_mt', 'supplementary_mt')"

ORACLES["r_classify"] = f"""WITH {CLASSED},
m AS (SELECT *, max({OWN_NOSEC} OR chimeric) OVER (PARTITION BY sample, read_id) AS mates FROM cat),
x AS (SELECT *, list_sort(list_filter([CASE WHEN {OWN_NOSEC} THEN category END, CASE WHEN chimeric THEN 'full_genome_chimeric_mt_evidence' END,
  CASE WHEN mates THEN 'mate_of_mt_evidence_read' END], lambda r: r IS NOT NULL)) AS reasons FROM m)
SELECT sample, read_id AS query_name, count(*) AS records, count(*) FILTER (len(reasons) > 0) AS selected,
  array_to_string(list_sort(list(DISTINCT category || '=' || array_to_string(reasons, '+'))), ';') AS reasons FROM x GROUP BY sample, read_id"""

ORACLES["r_classification_summary"] = f"""WITH {CLASSED}, x AS (SELECT *, {OWN} AS own, {OWN} OR chimeric AS sel FROM cat),
n AS (SELECT sample, 'alignment_category' AS table_type, category AS name FROM x UNION ALL SELECT sample, 'selected_alignment_category', category FROM x WHERE sel
  UNION ALL SELECT sample, 'selection_reason', category FROM x WHERE own UNION ALL SELECT sample, 'selection_reason', 'full_genome_chimeric_mt_evidence' FROM x WHERE chimeric)
SELECT sample, table_type, name, count(*) AS count FROM n GROUP BY ALL"""

FIRST = "row_number() OVER (PARTITION BY sample, read_id ORDER BY orderkey, linenumber, partkey, suppkey, mapq) = 1"
ORACLES["r_selected_reads"] = f"""WITH {SEG}, x AS (SELECT *, {CAT} AS category FROM seg WHERE flag < 256),
o AS (SELECT 'high_confidence' AS output, * FROM (SELECT * FROM x WHERE category = 'high_confidence_mt' QUALIFY {FIRST})
  UNION ALL SELECT 'ambiguous', * FROM (SELECT * FROM x WHERE category IN ('ambiguous_mt', 'low_quality_mt') QUALIFY {FIRST})
  UNION ALL SELECT 'evidence', * FROM (SELECT * FROM x WHERE {OWN} QUALIFY {FIRST}))
SELECT output, sample, read_id AS query_name, mapq, flag, category FROM o"""

ORACLES["r_selection_totals"] = f"""WITH {SEG}, x AS (SELECT *, {CAT} AS category FROM seg)
SELECT sample, count(*) AS total_alignments_examined, count(DISTINCT read_id) FILTER ({OWN}) AS mt_evidence_reads_selected,
  count(DISTINCT read_id) FILTER ({OWN} AND flag < 256) AS mt_evidence_fastq_records_written FROM x GROUP BY sample"""


def competitive(amb: int, weak: float, nuclear: float) -> str:
    return f"""{SEG}, g AS (SELECT sample, read_id, count(*) AS records,
    min(row(orderkey, linenumber, partkey, suppkey, mapq, reference_name, aligned_fraction)) FILTER (flag < 256) AS p,
    bool_or(flag >= 256 AND reference_name = 'MT') AS mt2, bool_or(flag >= 256 AND reference_name <> 'MT' AND aligned_fraction >= {nuclear}) AS n2 FROM seg GROUP BY ALL),
c AS (SELECT *, CASE WHEN p IS NULL THEN 'no_primary_alignment' WHEN p[6] <> 'MT' THEN CASE WHEN mt2 THEN 'nuclear_primary_with_mt_competitor' ELSE 'nuclear_primary' END
  WHEN p[5] < 0 OR p[7] < {weak} THEN 'weak_mt_primary' WHEN p[5] < {amb} OR n2 THEN 'mt_primary_ambiguous' ELSE 'mt_primary_best' END AS category FROM g)"""


ORACLES["r_competitive"] = f"""WITH {competitive(15, 0.6, 0.9)}
SELECT sample, read_id AS query_name, '' AS mate, records, category, category = 'mt_primary_best' AS retained FROM c"""
ORACLES["r_competitive_summary"] = (
    f"WITH {competitive(10, 0.5, 0.5)} SELECT sample, CAST(sum(records) AS BIGINT) AS total_alignments_examined, "
    + ", ".join(
        f"count(*) FILTER (category = '{n}') AS {n}_reads"
        for n in ("mt_primary_best", "mt_primary_ambiguous", "nuclear_primary", "nuclear_primary_with_mt_competitor", "weak_mt_primary", "primary_unmapped", "no_primary_alignment")
    )
    + ", count(*) FILTER (category IN ('mt_primary_best', 'mt_primary_ambiguous')) AS mt_evidence_reads_selected FROM c GROUP BY sample"
)

ORACLES["r_competitive_stream"] = ORACLES["r_competitive_summary"]

STRONG = "(mapq >= 20 AND aligned_fraction >= 0.8)"
ORACLES["r_depletion"] = f"""WITH {SEG}, x AS (SELECT * FROM seg WHERE flag < 256 AND NOT {STRONG} QUALIFY {FIRST})
SELECT sample, read_id AS query_name, '' AS mate, mapq, 'weak_or_partial_nuclear_alignment' AS retention_reason FROM x"""
ORACLES["r_depletion_summary"] = f"""WITH {SEG}
SELECT sample, count(*) AS alignment_records_examined, count(*) FILTER (flag >= 256 AND flag < 2048) AS secondary_records, count(*) FILTER (flag >= 2048) AS supplementary_records,
  0 AS primary_unmapped_records, count(*) FILTER (flag < 256 AND {STRONG}) AS strong_primary_nuclear_mapped_records,
  count(*) FILTER (flag < 256 AND NOT {STRONG}) AS weak_or_partial_primary_nuclear_mapped_records,
  count(DISTINCT read_id) FILTER (flag < 256 AND NOT {STRONG}) AS retained_for_mitochondrial_remap, 0 AS primary_unmapped_written FROM seg GROUP BY sample"""

ORACLES["r_forward_reads"] = """WITH d AS (SELECT *, doc_id % 4 * 16 + doc_id % 3 * 64 AS flag FROM documents)
SELECT lang AS sample, doc_id || CASE WHEN flag & 128 > 0 THEN '/2' WHEN flag & 64 > 0 THEN '/1' ELSE '' END AS read_name,
  md5(CASE WHEN flag & 16 > 0 THEN reverse(translate(text, 'ACGTNacgtn', 'TGCANtgcan')) ELSE text END) AS digest, length(text) AS quality_length FROM d"""
ORACLES["r_mates"] = """WITH m AS (SELECT source AS sample, 1 AS mate FROM documents UNION ALL SELECT source, 2 FROM documents)
SELECT sample, count(*) AS records, count(*) FILTER (mate = 1) AS mate1_records, count(*) FILTER (mate = 2) AS mate2_records, count(*) FILTER (mate = 1) AS fragments FROM m GROUP BY sample"""

# ---- motif search --------------------------------------------------------------------------

HITS = """docs AS (SELECT source AS sample, 'r' || doc_id AS read_id, 'R1' AS mate, doc_id AS record_no, upper(text) AS seq FROM documents),
mot AS (SELECT 'd' || item_id AS deletion_id, 'item ' || item_id AS deletion_name, item_id % 2 = 0 AS single, item_id % 3 = 0 AS turned, upper(text) AS whole,
  upper(substr(text, 1, length(text) // 2)) AS f, upper(substr(text, length(text) // 2 + 1)) AS s FROM benchmark),
hits AS (SELECT sample, read_id, mate, record_no, deletion_id, deletion_name, CASE WHEN single THEN 'single_sequence' ELSE 'multi_sequence_required' END AS search_strategy,
  CASE WHEN single THEN 'whole' ELSE 'first,second' END AS matched_sequence_ids,
  CASE WHEN single THEN CASE WHEN contains(seq, CASE WHEN turned THEN reverse(whole) ELSE whole END) THEN 'forward' ELSE 'reverse_complement' END ELSE CASE WHEN contains(seq, CASE WHEN turned THEN reverse(f) ELSE f END) THEN 'forward' ELSE 'reverse_complement' END || ',' || CASE WHEN contains(seq, CASE WHEN turned THEN reverse(s) ELSE s END) THEN 'forward' ELSE 'reverse_complement' END END AS matched_orientation
  FROM docs JOIN mot ON CASE WHEN single THEN (contains(seq, whole) OR contains(seq, reverse(whole))) ELSE (contains(seq, f) OR contains(seq, reverse(f))) AND (contains(seq, s) OR contains(seq, reverse(s))) END)"""
ORACLES["m_hits"] = f"WITH {HITS} SELECT * FROM hits"
ORACLES["m_summary"] = f"""WITH {HITS}, e AS (SELECT sample, CASE WHEN length(sample) % 2 = 0 THEN count(*) * 2 ELSE count(*) END AS reads_examined FROM docs GROUP BY sample),
n AS (SELECT sample, deletion_id, count(*) AS c FROM hits GROUP BY ALL)
SELECT e.sample, deletion_id, deletion_name, CASE WHEN single THEN 'single_sequence' ELSE 'multi_sequence_required' END AS search_strategy, reads_examined, coalesce(c, 0) AS matching_reads,
  round(coalesce(c, 0) / reads_examined * 1000000.0, 6) AS matching_reads_per_million_examined FROM e CROSS JOIN mot LEFT JOIN n USING (sample, deletion_id)"""

OVERLAP = f"""{EVENTS},
t(deletion_id, deletion_name, tl, tr, ts, bt, st) AS (VALUES ('search_9000_11951', 'search_9000_11951', 9000, 11951, {11951 - 9000 - 1}, 100, 150), ('again_3001_7950', 'again', 3001, 7950, {7950 - 3001 - 1}, 20, 30)),
h AS (SELECT sample, read_id || '/1' AS rid, read_id AS read_key, CASE WHEN orderkey % 2 = 0 THEN 'search_9000_11951' ELSE 'again_3001_7950' END AS deletion_id FROM events),
r AS (SELECT e.sample, t.deletion_id, e.read_id AS read_key, e.deletion_id AS eid FROM events e JOIN t ON
  ((abs(left_breakpoint - tl) <= bt AND abs(right_breakpoint - tr) <= bt) OR (abs(left_breakpoint - tr) <= bt AND abs(right_breakpoint - tl) <= bt)) AND abs(deleted_size - ts) <= st
  WHERE EXISTS (SELECT 1 FROM h WHERE h.sample = e.sample AND h.deletion_id = t.deletion_id)),
hk AS (SELECT DISTINCT sample, deletion_id, read_key FROM h), rk AS (SELECT DISTINCT sample, deletion_id, read_key FROM r)"""
ORACLES["m_overlap"] = f"""WITH {OVERLAP},
b AS (SELECT coalesce(hk.sample, rk.sample) AS sample, coalesce(hk.deletion_id, rk.deletion_id) AS deletion_id, hk.read_key IS NOT NULL AS s, rk.read_key IS NOT NULL AS r
  FROM hk FULL JOIN rk ON hk.sample = rk.sample AND hk.deletion_id = rk.deletion_id AND hk.read_key = rk.read_key),
c AS (SELECT sample, deletion_id, count(*) FILTER (s) AS a, count(*) FILTER (r) AS b, count(*) FILTER (s AND r) AS c, count(*) FILTER (s AND NOT r) AS d, count(*) FILTER (NOT s AND r) AS e FROM b GROUP BY ALL),
i AS (SELECT sample, deletion_id, array_to_string(list_sort(list(DISTINCT eid))[1:20], ';') AS ids FROM r GROUP BY ALL)
SELECT c.sample, c.deletion_id, deletion_name, tl AS target_left_breakpoint, tr AS target_right_breakpoint, ts AS target_deleted_size, bt AS breakpoint_tolerance_bp, st AS size_tolerance_bp,
  a AS sequence_search_reads, b AS remap_nearby_reads, c AS shared_reads, d AS sequence_only_reads, e AS remap_only_reads,
  round(coalesce(c / nullif(a, 0), 0.0), 6) AS overlap_fraction_of_sequence_search, round(coalesce(c / nullif(b, 0), 0.0), 6) AS overlap_fraction_of_remap_nearby,
  coalesce(ids, '') AS matched_remap_exact_deletions FROM c JOIN t ON t.deletion_id = c.deletion_id LEFT JOIN i ON i.sample = c.sample AND i.deletion_id = c.deletion_id"""
ORACLES["m_read_sets"] = f"""WITH {OVERLAP}, s AS (SELECT DISTINCT sample, deletion_id, read_key, rid, CAST(NULL AS VARCHAR) AS eid FROM h), q AS (SELECT DISTINCT sample, deletion_id, read_key, read_key AS rid, eid FROM r),
u AS (SELECT 'sequence_search_reads' AS set_name, 'sequence_search' AS source, * FROM s UNION ALL SELECT 'remap_nearby_reads', 'remap_near_target', * FROM q
  UNION ALL SELECT 'shared_reads', 'both', * FROM s SEMI JOIN rk USING (sample, deletion_id, read_key) UNION ALL SELECT 'shared_reads', 'both', * FROM q SEMI JOIN hk USING (sample, deletion_id, read_key)
  UNION ALL SELECT 'sequence_only_reads', 'sequence_search', * FROM s ANTI JOIN rk USING (sample, deletion_id, read_key)
  UNION ALL SELECT 'remap_only_reads', 'remap_near_target', * FROM q ANTI JOIN hk USING (sample, deletion_id, read_key))
SELECT set_name, source, sample, deletion_id, count(*) AS rows, count(DISTINCT read_key) AS reads, count(eid) AS with_event FROM u GROUP BY ALL"""

# ---- event calling -------------------------------------------------------------------------

ORACLES["d_segments"] = f"""WITH {SEG}
SELECT sample, rotation_name, read_id, read_id AS chain_id, query_start, query_end, anchor_length, ref_start, ref_end, strand, mapq, is_primary, is_supplementary FROM seg
WHERE (flag >= 2048 OR suppkey % 4 > 0) AND mapq >= 4 AND anchor_length >= 49 AND aligned_fraction >= 0.6 AND edit_distance / 10 <= 0.2 AND NOT (flag >= 256 AND flag < 2048)"""
ORACLES["d_pairs"] = f"WITH {SEG},{_paired(ALL_PAIRS)},{_placed()} SELECT {EVENT} FROM events_all"
ORACLES["d_adjacent_pairs"] = f"WITH {SEG},{_paired(ADJACENT)},{_placed()} SELECT {EVENT} FROM events_all"
SWAP = f"({gap('dr', 'dl')} < {gap('dl', 'dr')} OR ({gap('dr', 'dl')} = {gap('dl', 'dr')} AND dr < dl))"
ORACLES["d_legacy_arc"] = f"""WITH {SEG},{_paired(ALL_PAIRS)},{_placed(f"CASE WHEN {SWAP} THEN dr ELSE dl END", f"CASE WHEN {SWAP} THEN dl ELSE dr END")}
SELECT {EVENT}, CASE WHEN {SWAP} THEN 'reversed_to_shorter_interval' ELSE 'reported' END AS canonical_orientation, {gap("dl", "dr")} AS directed_deleted_size FROM events_all"""
ORACLES["d_events"] = f"WITH {EVENTS} SELECT {EVENT}, 'directed' AS direction_status FROM events"
ORACLES["d_event_counts"] = f"WITH {EVENTS} SELECT sample, deletion_id, count(*) AS reads, count(DISTINCT read_id) AS distinct_reads FROM events GROUP BY ALL"
ORACLES["d_reciprocal"] = f"""WITH {EVENTS}, x AS (SELECT sample, read_id, rotation_name, breakpoint_pair_id, dl, dr FROM events UNION ALL SELECT sample, read_id, rotation_name, breakpoint_pair_id, dr, dl FROM events WHERE orderkey % 7 = 0),
n AS (SELECT sample, read_id, rotation_name, breakpoint_pair_id, count(DISTINCT (dl, dr)) AS n FROM x GROUP BY ALL)
SELECT sample, read_id, rotation_name, breakpoint_pair_id, dl AS directed_left_breakpoint, dr AS directed_right_breakpoint, CASE WHEN n > 1 THEN 'ambiguous_reciprocal_alignments' ELSE 'directed' END AS direction_status
FROM x JOIN n USING (sample, read_id, rotation_name, breakpoint_pair_id)"""
USED = "(split AND anchor_length >= 20 AND aligned_fraction >= 0.15 AND edit_distance / 10 <= 0.9)"
ORACLES["d_call_summary"] = f"""WITH {EVENTS}, x AS (SELECT *, flag >= 2048 OR suppkey % 4 > 0 AS split FROM seg),
a AS (SELECT sample, rotation_name, count(*) AS alignment_records, count(*) FILTER (NOT split) AS records_without_split_evidence, count(*) FILTER {USED} AS segments_used,
  count(*) FILTER (split AND NOT {USED}) AS segments_rejected, count(DISTINCT read_id) FILTER {USED} AS reads_with_usable_segments, count(DISTINCT read_id) FILTER {USED} AS fragments_with_usable_segments FROM x GROUP BY ALL),
b AS (SELECT sample, rotation_name, count(*) AS candidate_deletion_records, 0 AS ambiguous_direction_records, count(*) AS deletion_supporting_records FROM events GROUP BY ALL),
j AS (SELECT a.*, coalesce(candidate_deletion_records, 0) AS candidate_deletion_records, CAST(0 AS BIGINT) AS ambiguous_direction_records, coalesce(deletion_supporting_records, 0) AS deletion_supporting_records FROM a LEFT JOIN b USING (sample, rotation_name))
UNPIVOT j ON COLUMNS(* EXCLUDE (sample, rotation_name)) INTO NAME metric VALUE value"""

# ---- evidence ------------------------------------------------------------------------------


def query_pair(s1, e1, s2, e2, n, prefix=""):
    """Columns of the query-pair metrics; spans already in order."""
    ov, total = f"greatest(0, {e1} - {s2})", f"(({e1} - {s1}) + ({e2} - {s2}))"
    return f"""{s1} AS {prefix}query_first_start, {e1} AS {prefix}query_first_end, {s2} AS {prefix}query_second_start, {e2} AS {prefix}query_second_end,
  {ov} AS {prefix}query_overlap_bp, greatest(0, {s2} - {e1}) AS {prefix}query_gap_bp, round(least(1.0, greatest(0.0, ({total} - {ov}) / greatest({n}, 1))), 6) AS {prefix}query_union_coverage,
  {total} - {ov} AS {prefix}query_union_aligned_length, {total} AS {prefix}total_aligned_query_length, greatest({n}, 1) AS {prefix}read_length, greatest(0, {s2} - {e1}) = 0 AS {prefix}query_segments_adjacent,
  least({e1}, greatest({n}, 1) - {e1}, {s2}, greatest({n}, 1) - {s2}) AS {prefix}query_junction_boundary_distance_from_read_end_min"""


ORACLES["q_cigar"] = f"""WITH {SEG}, x AS (SELECT *, query_start + anchor_length + 10 AS n, (mapq < query_start OR (mapq = query_start AND mapq + 30 < query_end)) AS sw FROM seg),
y AS (SELECT *, CASE WHEN sw THEN mapq ELSE query_start END AS s1, CASE WHEN sw THEN mapq + 30 ELSE query_end END AS e1, CASE WHEN sw THEN query_start ELSE mapq END AS s2, CASE WHEN sw THEN query_end ELSE mapq + 30 END AS e2 FROM x)
SELECT DISTINCT orderkey, cigar, mapq, query_start, query_end, n AS query_length, anchor_length AS aligned_query_length, anchor_length AS aligned_reference_length,
{query_pair("s1", "e1", "s2", "e2", "n", "pair_")} FROM y"""

ORACLES["q_remap_rows"] = f"""WITH {EVENTS}, x AS (SELECT *, greatest(query_first_end + 10, query_second_end + 10) AS n FROM events)
SELECT sample, read_id, rotation_name, deletion_id, n AS read_length, round((left_edit_distance + right_edit_distance) / (left_anchor_length + right_anchor_length), 6) AS estimated_alignment_error_rate,
  round(1.0 - left_anchor_length / n, 6) AS left_clipped_fraction, CASE WHEN contains(left_sa_tag, ',9,') OR contains(right_sa_tag, ',9,') THEN 3 ELSE 2 END AS total_alignment_segments,
  concat_ws(':', 'minimap2', rotation_name, raw_left_breakpoint, raw_right_breakpoint, left_cigar, right_cigar) AS alignment_pattern_id,
  round(least(1.0, greatest(0.0, ((query_first_end - query_first_start) + (query_second_end - query_second_start) - greatest(0, query_first_end - query_second_start)) / n)), 6) AS query_union_coverage,
  query_second_start <= query_first_end AS query_segments_adjacent, (query_first_end - query_first_start) + (query_second_end - query_second_start) AS total_aligned_query_length,
  left_is_primary OR right_is_primary AS primary_chain_evidence, left_is_secondary AND right_is_secondary AS secondary_only_evidence,
  least(query_first_end, n - query_first_end, query_second_start, n - query_second_start) AS query_junction_boundary_distance_from_read_end_min,
  'not_available_from_retained_intermediates' AS mate_mapping_class FROM x"""

ORACLES["q_conflicts"] = f"""WITH {EVENTS}, c AS (SELECT DISTINCT a.sample, a.read_id, a.left_breakpoint, a.right_breakpoint FROM events a JOIN events b ON a.sample = b.sample AND a.read_id = b.read_id
  AND row(a.rotation_name, a.deletion_id) <> row(b.rotation_name, b.deletion_id) AND {dist("a.left_breakpoint", "b.right_breakpoint")} <= 60 AND {dist("a.right_breakpoint", "b.left_breakpoint")} <= 60)
SELECT e.sample, e.read_id, e.rotation_name, e.left_breakpoint, e.right_breakpoint, c.sample IS NOT NULL AS in_conflict FROM events e
LEFT JOIN c ON e.sample = c.sample AND e.read_id = c.read_id AND e.left_breakpoint = c.left_breakpoint AND e.right_breakpoint = c.right_breakpoint"""

ORACLES["q_union"] = f"""WITH {EVENTS}
SELECT 'minimap2_remap' AS evidence_source, 'pass' AS filter_status, 'passed source filters' AS filter_reason, count(*) AS source_records FROM events
UNION ALL SELECT 'star_chimeric', CASE WHEN orderkey % 33 = 0 THEN 'fail' ELSE 'pass' END, CASE WHEN orderkey % 33 = 0 THEN 'left_anchor_short' ELSE 'passed source filters' END, count(*) FROM events GROUP BY ALL"""


# ---- clusters ------------------------------------------------------------------------------


def clustering(src: str, order: str, name: str = "led", slop: int = 10) -> str:
    """Greedy leaders of the coordinates in ``src``: independent components step point by point.

    The circle is opened at a gap (coordinate 16070), where no hotspot lies.
    """
    near = f"{dist('x.l', 'p.l')} <= {slop} AND {dist('x.r', 'p.r')} <= {slop}"
    return f"""
{name}_p AS (SELECT left_breakpoint AS l, right_breakpoint AS r, (left_breakpoint + 500) % {L} AS x, (right_breakpoint + 500) % {L} AS y, min(row({order})) AS o FROM {src} GROUP BY ALL),
{name}_x AS (SELECT x, sum(CASE WHEN x - px > {slop} THEN 1 ELSE 0 END) OVER (ORDER BY x) AS cx FROM (SELECT x, lag(x) OVER (ORDER BY x) AS px FROM (SELECT DISTINCT x FROM {name}_p))),
{name}_q AS (SELECT * FROM {name}_p JOIN {name}_x USING (x)),
{name}_y AS (SELECT cx, y, sum(CASE WHEN y - py > {slop} THEN 1 ELSE 0 END) OVER (PARTITION BY cx ORDER BY y) AS cy FROM (SELECT cx, y, lag(y) OVER (PARTITION BY cx ORDER BY y) AS py FROM (SELECT DISTINCT cx, y FROM {name}_q))),
{name}_k AS (SELECT l, r, cx, cy, row_number() OVER (PARTITION BY cx, cy ORDER BY o) AS k FROM {name}_q JOIN {name}_y USING (cx, y)),
{name} AS (
  SELECT cx, cy, k, l, r, [{{'l': l, 'r': r}}] AS leaders, l AS ll, r AS lr FROM {name}_k WHERE k = 1
  UNION ALL
  SELECT cx, cy, k, l, r, CASE WHEN m IS NULL THEN list_append(leaders, {{'l': l, 'r': r}}) ELSE leaders END, coalesce(m.l, l), coalesce(m.r, r)
  FROM (SELECT p.*, s.leaders, list_filter(s.leaders, lambda x: {near})[1] AS m FROM {name} s JOIN {name}_k p ON p.cx = s.cx AND p.cy = s.cy AND p.k = s.k + 1)),
asg AS (SELECT e.*, ll, lr FROM {src} e JOIN {name} ON e.left_breakpoint = l AND e.right_breakpoint = r)"""


def unwrapped(v: str, a: str) -> str:
    return f"({a} + ({v} - {a} + {L // 2} + {L}) % {L} - {L // 2})"


def wrapped(m: str) -> str:
    return f"((CAST(round_even({m}, 0) AS BIGINT) - 1 + 2 * {L}) % {L} + 1)"


COORD = "left_breakpoint, right_breakpoint, sample, read_id, rotation_name"
READS = "sample, read_id, left_breakpoint, right_breakpoint"


def clusters(order: str, support: int) -> str:
    return f"""
sup AS (SELECT * FROM asg QUALIFY row_number() OVER (PARTITION BY ll, lr, sample, read_id ORDER BY {order}) = 1),
med AS (SELECT ll, lr, {wrapped(f"quantile_cont({unwrapped('left_breakpoint', 'll')}, 0.5)")} AS cl, {wrapped(f"quantile_cont({unwrapped('right_breakpoint', 'lr')}, 0.5)")} AS cr,
  count(*) AS n, count(DISTINCT sample) AS ns, array_to_string(list_sort(list(DISTINCT sample)), ';') AS ss FROM sup GROUP BY ll, lr HAVING count(*) >= {support}),
rot AS (SELECT ll, lr, array_to_string(list_sort(list(DISTINCT rotation_name)), ';') AS rotations, count(DISTINCT rotation_name) AS nr FROM asg GROUP BY ALL),
clu AS (SELECT *, {gap("cl", "cr")} AS cs, {event_id("cl", "cr", gap("cl", "cr"))} AS cid FROM med JOIN rot USING (ll, lr))"""


CLUSTER = f"""cid AS exact_deletion_id, {pair_id("cl", "cr")} AS breakpoint_pair_id, cl AS left_breakpoint, cr AS right_breakpoint, cs AS deleted_size, cr <= cl AS wraps_origin,
  {interval("cl", "cr")} AS deleted_interval, n AS total_supporting_reads, ns AS samples_with_signal, ss AS supporting_samples, rotations, nr AS rotation_count,
  CASE WHEN nr > 1 THEN 'multiple_rotations' ELSE 'single_rotation' END AS rotation_agreement"""

ORACLES["k_clusters"] = f"WITH RECURSIVE {EVENTS},{clustering('events', COORD)},{clusters(COORD, 2)} SELECT {CLUSTER} FROM clu"
ORACLES["k_clusters_by_read"] = f"WITH RECURSIVE {EVENTS},{clustering('events', READS)},{clusters(READS, 1)} SELECT {CLUSTER} FROM clu"
MEMBERS = f"WITH RECURSIVE {EVENTS},{clustering('events', COORD)},{clusters(COORD, 2)}, mem AS (SELECT sup.*, cl, cr, cs, cid FROM sup JOIN clu USING (ll, lr))"
ORACLES["k_members"] = f"""{MEMBERS} SELECT sample, read_id, rotation_name, cid AS exact_deletion_id, cl AS left_breakpoint, cr AS right_breakpoint, left_breakpoint AS read_left_breakpoint,
  right_breakpoint AS read_right_breakpoint, deleted_size AS read_deleted_size FROM mem"""
ORACLES["e_remap"] = f"""WITH RECURSIVE {EVENTS}, cf AS (SELECT DISTINCT a.sample, a.read_id, a.left_breakpoint, a.right_breakpoint FROM events a JOIN events b ON a.sample = b.sample AND a.read_id = b.read_id
  AND row(a.rotation_name, a.deletion_id) <> row(b.rotation_name, b.deletion_id) AND {dist("a.left_breakpoint", "b.right_breakpoint")} <= 10 AND {dist("a.right_breakpoint", "b.left_breakpoint")} <= 10),
acc AS (SELECT * FROM events ANTI JOIN cf USING (sample, read_id, left_breakpoint, right_breakpoint)),{clustering('acc', COORD)},{clusters(COORD, 2)}, mem AS (SELECT sup.*, cl, cr, cs, cid FROM sup JOIN clu USING (ll, lr))
SELECT sample, read_id, rotation_name, cid AS exact_deletion_id, cl AS left_breakpoint, cr AS right_breakpoint, left_breakpoint AS read_left_breakpoint, right_breakpoint AS read_right_breakpoint,
  deleted_size AS read_deleted_size FROM mem"""
ORACLES["k_numbered"] = f"""WITH RECURSIVE {EVENTS},{clustering('events', COORD)},
g AS (SELECT ll, lr, count(DISTINCT (sample, read_id)) AS n, count(DISTINCT sample) AS ns, array_to_string(list_sort(list(DISTINCT sample)), ';') AS ss, count(DISTINCT rotation_name) AS nr FROM asg GROUP BY ALL)
SELECT 'mtDelJunc_' || lpad(CAST(row_number() OVER (ORDER BY ll, lr) AS VARCHAR), 6, '0') AS junction_id, ll AS left_breakpoint, lr AS right_breakpoint, {gap("ll", "lr")} AS deleted_size,
  n AS total_supporting_reads, ns AS samples_with_signal, ss AS supporting_samples, nr AS rotation_count FROM g"""
EXACT_FIRST = "row_number() OVER (PARTITION BY left_breakpoint, right_breakpoint, sample, read_id ORDER BY rotation_name) = 1"
ORACLES["k_exact"] = f"""WITH {EVENTS} SELECT sample, read_id, deletion_id AS exact_deletion_id, left_breakpoint, right_breakpoint, left_breakpoint AS reported_left_breakpoint FROM events QUALIFY {EXACT_FIRST}"""
ORACLES["z_mismatches"] = f"""{MEMBERS}, d AS (SELECT left_breakpoint <> cl OR right_breakpoint <> cr OR deleted_size <> cs AS d FROM mem)
SELECT count(*) AS read_rows_with_cluster, count(*) FILTER (d) AS read_rows_different_from_cluster_representative, round(avg(d::INT), 6) AS fraction_different FROM d"""
ORACLES["z_mismatch_examples"] = f"""{MEMBERS} SELECT sample, read_id, cid AS exact_deletion_id, rotation_name, left_breakpoint AS read_left_breakpoint, right_breakpoint AS read_right_breakpoint,
  deleted_size AS read_deleted_size, cl AS left_breakpoint, cr AS right_breakpoint, cs AS deleted_size FROM mem WHERE left_breakpoint <> cl OR right_breakpoint <> cr OR deleted_size <> cs
  ORDER BY 1, 2, 3, 4, 5, 6, 7 LIMIT 20"""
ORACLES["z_recluster"] = f"""WITH RECURSIVE {EVENTS},{clustering('events', COORD)},{clusters(COORD, 2)}
SELECT 'corrected merge from raw rotated calls' AS "table", count(*) AS rows, 0 AS size_mismatches, 0 AS negative_sizes, 0 AS wrap_rule_mismatches, count(*) FILTER (cr <= cl) AS origin_spanning_rows,
  10 AS breakpoint_slop_bp, 2 AS min_split_read_support FROM clu"""

# ---- observations --------------------------------------------------------------------------

NEAR = f"{dist('x.l', 'p.l')} <= 10 AND {dist('x.r', 'p.r')} <= 10"
CANDS = f"""{EVENTS},
cand AS (
  SELECT sample, read_id, orderkey, left_breakpoint, right_breakpoint, 'minimap2_remap' AS src, rotation_name, min_anchor_length, min_mapq,
    (left_edit_distance + right_edit_distance) / (left_anchor_length + right_anchor_length) AS err,
    least(1.0, greatest(0.0, ((query_first_end - query_first_start) + (query_second_end - query_second_start) - greatest(0, query_first_end - query_second_start)) / (query_second_end + 10))) AS cov,
    query_second_start <= query_first_end AS adj, left_is_primary OR right_is_primary AS prim, left_is_secondary AND right_is_secondary AS sec, query_gap_bp, query_overlap_bp,
    CASE WHEN contains(left_sa_tag, ',9,') OR contains(right_sa_tag, ',9,') THEN 3 ELSE 2 END AS segs, CAST(NULL AS BIGINT) AS chims, CAST(NULL AS BIGINT) AS rep, CAST(NULL AS VARCHAR) AS gene,
    concat_ws(':', 'minimap2', rotation_name, raw_left_breakpoint, raw_right_breakpoint, left_cigar, right_cigar) AS pat FROM events
  UNION ALL
  SELECT sample, CASE WHEN orderkey % 3 = 1 THEN 'x' || orderkey ELSE read_id END, orderkey, nl, right_breakpoint, 'star_chimeric', 'full_genome', min_anchor_length, NULL, NULL, 1.0, TRUE, NULL, NULL, query_gap_bp, query_overlap_bp, 2, 1 + orderkey % 2, orderkey % 7,
    CASE WHEN orderkey % 2 = 0 THEN 'G' || (nl % 3) || '--H' || (right_breakpoint % 2) END, concat_ws(':', 'star', nl, right_breakpoint, left_cigar, right_cigar)
  FROM (SELECT *, {norm("left_breakpoint + orderkey % 5 - 2 + CASE WHEN orderkey % 3 = 2 THEN 40 ELSE 0 END")} AS nl FROM events WHERE orderkey % 33 <> 0)),
pk AS (SELECT *, row_number() OVER (PARTITION BY sample, read_id ORDER BY l, r) AS k FROM (SELECT DISTINCT sample, read_id, left_breakpoint AS l, right_breakpoint AS r FROM cand)),
hyp AS (
  SELECT sample, read_id, k, l, r, [{{'l': l, 'r': r}}] AS leaders, l AS ll, r AS lr FROM pk WHERE k = 1
  UNION ALL
  SELECT sample, read_id, k, l, r, CASE WHEN m IS NULL THEN list_append(leaders, {{'l': l, 'r': r}}) ELSE leaders END, coalesce(m.l, l), coalesce(m.r, r)
  FROM (SELECT p.*, s.leaders, list_filter(s.leaders, lambda x: {NEAR})[1] AS m FROM hyp s JOIN pk p ON p.sample = s.sample AND p.read_id = s.read_id AND p.k = s.k + 1)),
ch AS (SELECT c.*, ll, lr, count(DISTINCT (ll, lr)) OVER (PARTITION BY c.sample, c.read_id) AS nh, first_value(left_breakpoint) OVER w AS al, first_value(right_breakpoint) OVER w AS ar
  FROM cand c JOIN hyp h ON c.sample = h.sample AND c.read_id = h.read_id AND c.left_breakpoint = h.l AND c.right_breakpoint = h.r
  WINDOW w AS (PARTITION BY c.sample, c.read_id, ll, lr, src ORDER BY left_breakpoint, right_breakpoint)),
per AS (SELECT sample, read_id, ll, lr, src, {wrapped(f"quantile_cont({unwrapped('left_breakpoint', 'al')}, 0.5)")} AS ml, {wrapped(f"quantile_cont({unwrapped('right_breakpoint', 'ar')}, 0.5)")} AS mr FROM ch GROUP BY ALL),
fst AS (SELECT *, first_value(ml) OVER w AS fl, first_value(mr) OVER w AS fr FROM per WINDOW w AS (PARTITION BY sample, read_id, ll, lr ORDER BY src)),
pos AS (SELECT sample, read_id, ll, lr, {wrapped(f"quantile_cont({unwrapped('ml', 'fl')}, 0.5)")} AS l, {wrapped(f"quantile_cont({unwrapped('mr', 'fr')}, 0.5)")} AS r FROM fst GROUP BY ALL),
gn AS (SELECT sample, read_id, ll, lr, gene, count(*) AS n, min(row(left_breakpoint, right_breakpoint)) AS f FROM ch WHERE gene IS NOT NULL GROUP BY ALL),
gm AS (SELECT sample, read_id, ll, lr, gene FROM gn QUALIFY row_number() OVER (PARTITION BY sample, read_id, ll, lr ORDER BY n DESC, f, gene) = 1),
fl AS (SELECT *, list_filter([CASE WHEN src = 'minimap2_remap' AND coalesce(min_mapq, 0) = 0 THEN 'min_mapq_zero' END, CASE WHEN sec THEN 'secondary_only' END, CASE WHEN err > 0.15 THEN 'high_alignment_error' END,
  CASE WHEN chims > 1 THEN 'star_multimapping' END, CASE WHEN query_gap_bp > 0 THEN 'query_gap' END, CASE WHEN query_overlap_bp > 0 THEN 'query_overlap' END,
  CASE WHEN segs > 2 THEN 'complex_alignment_chain' END, CASE WHEN nh > 1 THEN 'multiple_deletion_hypotheses' END], lambda v: v IS NOT NULL) AS flags FROM ch),
obs AS (SELECT sample, read_id, ll, lr, array_to_string(list_sort(list(DISTINCT src)), ';') AS evidence_sources, count(DISTINCT src) > 1 AS both_callers_support, count(*) AS source_record_count,
  array_to_string(list_sort(list(DISTINCT rotation_name)), ';') AS rotation_support, max(nh) AS deletion_hypotheses_from_read, array_to_string(list_sort(list_distinct(flatten(list(flags)))), ';') AS observation_quality_flags,
  min(min_anchor_length) AS min_anchor_length, min(min_mapq) AS min_mapq, round(max(err), 6) AS estimated_alignment_error_rate, round(min(cov), 6) AS query_union_coverage, bool_or(prim) AS primary_chain_evidence,
  bool_and(coalesce(sec, FALSE)) AS secondary_only_evidence, count(DISTINCT pat) AS alignment_pattern_count, max(rep) AS junction_repeat_length, bool_and(adj) AS query_segments_adjacent FROM fl GROUP BY ALL)"""
ORACLES["e_evidence"] = f"""WITH RECURSIVE {CANDS},
ob2 AS (SELECT o.sample, o.read_id, o.ll AS hl, o.lr AS hr, o.evidence_sources AS es, o.both_callers_support AS bc, o.source_record_count AS n, p.l AS left_breakpoint, p.r AS right_breakpoint
  FROM obs o JOIN pos p ON o.sample = p.sample AND o.read_id = p.read_id AND o.ll = p.ll AND o.lr = p.lr),{clustering('ob2', 'sample, read_id, hl, hr')},
one AS (SELECT * FROM asg QUALIFY row_number() OVER (PARTITION BY ll, lr, sample, read_id ORDER BY hl, hr) = 1),
ps AS (SELECT ll, lr, max(c) AS mx FROM (SELECT ll, lr, sample, count(*) AS c FROM one GROUP BY ALL) GROUP BY ALL)
SELECT ll AS leader_left, lr AS leader_right, count(*) AS distinct_observation_count, CAST(sum(n) AS BIGINT) AS raw_source_record_count, count(DISTINCT (sample, read_id)) AS distinct_read_identifier_count,
  any_value(mx) AS maximum_support_within_sample, round(count(*) FILTER (bc) / count(*), 6) AS both_caller_supporting_observation_fraction,
  concat_ws(';', CASE WHEN bool_or(contains(es, 'minimap2_remap')) THEN 'minimap2_remap' END, CASE WHEN bool_or(contains(es, 'star_chimeric')) THEN 'star_chimeric' END) AS evidence_sources
FROM one JOIN ps USING (ll, lr) GROUP BY ll, lr"""
ORACLES["q_build_summary"] = f"""WITH RECURSIVE {CANDS},
ob2 AS (SELECT o.sample, o.read_id, o.ll AS hl, o.lr AS hr, o.both_callers_support AS bc, p.l AS left_breakpoint, p.r AS right_breakpoint
  FROM obs o JOIN pos p ON o.sample = p.sample AND o.read_id = p.read_id AND o.ll = p.ll AND o.lr = p.lr),{clustering('ob2', 'sample, read_id, hl, hr')},
one AS (SELECT * FROM asg QUALIFY row_number() OVER (PARTITION BY ll, lr, sample, read_id ORDER BY hl, hr) = 1),
n AS (SELECT (SELECT count(*) FROM events) AS ev, (SELECT count(*) FROM cand) AS ca, (SELECT count(*) FROM one) AS ob, (SELECT count(*) FROM one WHERE bc) AS bo, (SELECT count(DISTINCT (ll, lr)) FROM asg) AS cl)
SELECT unnest(['minimap2_source_candidates', 'star_source_candidates', 'source_candidates_passing', 'ambiguous_direction_records', 'canonical_distinct_observations', 'canonical_deletion_clusters', 'both_caller_observations']) AS metric,
  unnest([ev, ev, ca, 0, ob, cl, bo]) AS value FROM n"""
ORACLES["q_observations"] = f"""WITH RECURSIVE {CANDS}
SELECT o.* EXCLUDE (ll, lr), p.l AS left_breakpoint, p.r AS right_breakpoint, {gap("p.l", "p.r")} AS deleted_size, gm.gene AS gene_pair_label FROM obs o
JOIN pos p ON o.sample = p.sample AND o.read_id = p.read_id AND o.ll = p.ll AND o.lr = p.lr LEFT JOIN gm ON o.sample = gm.sample AND o.read_id = gm.read_id AND o.ll = gm.ll AND o.lr = gm.lr"""

# ---- coverage ------------------------------------------------------------------------------

BLOCKS = f"""st AS (SELECT sample, rotation_name, 'f' || orderkey AS name, (1000 * (suppkey % 17) - 150 + partkey % 300 - 1 + {L}) % {L} + 1 AS s, partkey % 300 AS n FROM seg),
en AS (SELECT *, (s + 99 + n - 1) % {L} + 1 AS e FROM st),
blk AS (SELECT sample, rotation_name, name, s, e FROM en WHERE s <= e UNION ALL SELECT sample, rotation_name, name, s, {L} FROM en WHERE s > e UNION ALL SELECT sample, rotation_name, name, 1, e FROM en WHERE s > e),
want AS (SELECT sample, left_breakpoint AS position FROM events UNION SELECT sample, right_breakpoint FROM events
  UNION SELECT sample, CASE WHEN i <= 30 THEN i ELSE i + {L} - 60 END FROM (SELECT DISTINCT sample FROM events) CROSS JOIN range(1, 61) t(i))"""


def spanning(want: str, blocks: str = BLOCKS) -> str:
    """Distinct names whose blocks cover all pieces of the window of 20 around each wanted position."""
    return f"""{blocks},
win AS (SELECT sample, position, {norm("position - 20")} AS ws, {norm("position + 20")} AS we FROM {want}),
one AS (SELECT w.sample, position, rotation_name, count(DISTINCT name) AS n FROM win w JOIN blk b ON b.sample = w.sample AND b.s <= ws AND b.e >= we WHERE ws <= we GROUP BY ALL),
tl AS (SELECT DISTINCT w.sample, position, rotation_name, name FROM win w JOIN blk b ON b.sample = w.sample AND b.s <= ws AND b.e >= {L} WHERE ws > we),
hd AS (SELECT DISTINCT w.sample, position, rotation_name, name FROM win w JOIN blk b ON b.sample = w.sample AND b.s <= 1 AND b.e >= we WHERE ws > we),
cov AS (SELECT * FROM one UNION ALL SELECT sample, position, rotation_name, count(*) AS n FROM tl JOIN hd USING (sample, position, rotation_name, name) GROUP BY ALL),
best AS (SELECT w.sample, w.position, coalesce(max(n), 0) AS depth FROM win w LEFT JOIN cov c ON c.sample = w.sample AND c.position = w.position GROUP BY ALL)"""


# two blocks for each primary record, two bases apart
CIGAR_BLOCKS = BLOCKS.replace(BLOCKS[: BLOCKS.index("blk AS (")], f"""pr AS (SELECT *, 60 + partkey % 200 AS a, 30 + suppkey % 40 AS b FROM seg WHERE flag < 256 AND mapq >= 5),
en AS (SELECT sample, rotation_name, read_id AS name, {norm("ref_start_raw + rotation_start - 1")} AS s, {norm("ref_start_raw + rotation_start - 1 + a - 1")} AS e FROM pr
  UNION ALL SELECT sample, rotation_name, read_id, {norm("ref_start_raw + rotation_start - 1 + a + 2")}, {norm("ref_start_raw + rotation_start - 1 + a + 2 + b - 1")} FROM pr),
""")
ORACLES["p_from_alignments"] = f"WITH {EVENTS}, {spanning('want', CIGAR_BLOCKS)} SELECT * FROM best"
ORACLES["p_spanning"] = f"WITH {EVENTS}, {spanning('want')} SELECT * FROM best"
ORACLES["p_depth"] = f"""WITH {EVENTS}, {BLOCKS}, rots AS (SELECT DISTINCT sample, rotation_name FROM blk WHERE s + 20 <= e - 20)
SELECT w.sample, r.rotation_name, w.position, count(b.s) AS depth FROM want w JOIN rots r ON r.sample = w.sample
LEFT JOIN blk b ON b.sample = w.sample AND b.rotation_name = r.rotation_name AND b.s + 20 <= w.position AND b.e - 20 >= w.position GROUP BY ALL"""

# observations and exact clusters of the derived inputs
OBS = f"""{EVENTS},
ob AS (SELECT sample, read_id, orderkey AS k, left_breakpoint AS l, right_breakpoint AS r, deleted_size AS z, deletion_id AS eid, min(min_anchor_length) AS anc, list_sort(list(DISTINCT rotation_name)) AS rots,
  bool_or(left_is_secondary) AS lsec, bool_or(right_is_secondary) AS rsec, min(min_mapq) AS mq, min(left_anchor_length) AS la, min(right_anchor_length) AS ra FROM events GROUP BY ALL),
ex AS (SELECT left_breakpoint AS l, right_breakpoint AS r, any_value(deleted_size) AS z, any_value(deletion_id) AS eid, count(DISTINCT (sample, read_id)) AS n, count(DISTINCT sample) AS ns FROM events GROUP BY ALL)"""

ORACLES["p_support"] = f"""WITH {OBS}, el AS (SELECT DISTINCT l, r, eid, sample FROM ob WHERE k % 5 <> 1),
pw AS (SELECT sample, l AS position FROM el UNION SELECT sample, r FROM el), {spanning('pw')},
a AS (SELECT el.l, el.r, sum(b1.depth) AS x, sum(b2.depth) AS y FROM el JOIN best b1 ON b1.sample = el.sample AND b1.position = el.l JOIN best b2 ON b2.sample = el.sample AND b2.position = el.r GROUP BY ALL),
sp AS (SELECT l, r, count(*) AS n FROM ob WHERE k % 5 <> 1 GROUP BY ALL)
SELECT ex.eid AS exact_deletion_id, coalesce(sp.n, 0) AS split_supporting_reads, CAST(x AS BIGINT) AS left_reference_spanning_reads, CAST(y AS BIGINT) AS right_reference_spanning_reads,
  CAST(least(x, y) AS BIGINT) AS reference_spanning_reads_min, round(sp.n / (sp.n + least(x, y)), 6) AS local_split_support_fraction, 20 AS reference_support_window_bp,
  CASE WHEN a.l IS NULL THEN 'not_available_without_minimap2_remap_evidence' ELSE 'indexed_primary_alignment_depth_max_across_rotations' END AS reference_support_method
FROM ex LEFT JOIN a ON a.l = ex.l AND a.r = ex.r LEFT JOIN sp ON sp.l = ex.l AND sp.r = ex.r"""
ORACLES["p_reuse"] = f"""WITH {OBS}, el AS (SELECT DISTINCT l, r FROM ob WHERE k % 5 <> 1), x AS (SELECT ex.*, el.l IS NOT NULL AS remap, ex.l % 2 = 0 AS hit FROM ex LEFT JOIN el ON el.l = ex.l AND el.r = ex.r)
SELECT eid AS exact_deletion_id, CASE WHEN hit THEN n END AS split_supporting_reads, CASE WHEN hit THEN n + 1 END AS left_reference_spanning_reads, CASE WHEN hit THEN n + 2 END AS right_reference_spanning_reads,
  CASE WHEN hit THEN n + 1 END AS reference_spanning_reads_min, CASE WHEN hit THEN 0.5 END AS local_split_support_fraction, 20 AS reference_support_window_bp,
  CASE WHEN hit THEN 'reused_existing_counted' WHEN remap THEN 'not_available_in_existing_remap_support' ELSE 'not_available_without_minimap2_remap_evidence' END AS reference_support_method FROM x"""

# ---- annotation ----------------------------------------------------------------------------

FEATS = """feats(name, kind, s, e) AS (VALUES ('MT-ND1', 'protein_coding', 3307, 4262), ('MT-ND2', 'protein_coding', 4470, 5511), ('MT-CO1', 'protein_coding', 5904, 7445),
  ('MT-CO2', 'protein_coding', 7586, 8269), ('MT-ATP8', 'protein_coding', 8366, 8572), ('MT-ATP6', 'protein_coding', 8527, 9207), ('MT-CO3', 'protein_coding', 9207, 9990),
  ('MT-ND3', 'protein_coding', 10059, 10404), ('MT-ND4L', 'protein_coding', 10470, 10766), ('MT-ND4', 'protein_coding', 10760, 12137), ('MT-ND5', 'protein_coding', 12337, 14148),
  ('MT-ND6x', 'protein_coding', 14149, 14673), ('MT-CYTB', 'protein_coding', 14747, 15887), ('MT-RNR1', 'rRNA', 648, 1601), ('MT-RNR2', 'rRNA', 1671, 3229), ('MT-TL1', 'tRNA', 3230, 3304),
  ('control_region', 'region', 16024, 16569), ('control_region', 'region', 1, 576), ('repeat_window', 'region', 8445, 8495))"""


def at_text(v: str) -> str:
    return f"(SELECT coalesce(string_agg(name || ':' || kind || ':' || s || '-' || e, ';' ORDER BY s, e, name), '') FROM feats WHERE s <= {v} AND e >= {v})"


def near_text(v: str) -> str:
    d = f"CASE WHEN s <= {v} AND {v} <= e THEN 0 ELSE least(abs({v} - s), abs({v} - e)) END"
    return f"(SELECT arg_min(name || ':' || kind || ':' || s || '-' || e || ';distance=' || ({d}), row({d}, s, e, name)) FROM feats)"


ORACLES["f_positions"] = f"""WITH {SEG}, {FEATS}, q AS (SELECT DISTINCT std_end AS "position" FROM seg)
SELECT "position", {at_text('q."position"')} AS features_at, {near_text('q."position"')} AS nearest_feature FROM q"""
ORACLES["f_positions_joined"] = ORACLES["f_positions"]

COORDS = f"{EVENTS}, {FEATS}, co AS (SELECT DISTINCT left_breakpoint AS l, right_breakpoint AS r, deleted_size AS z FROM events)"
IMPACT = f"""ih AS (SELECT l, r, name, kind, s, e, {overlap("l", "r", "s", "e")} AS bp FROM co CROSS JOIN feats WHERE {overlap("l", "r", "s", "e")} > 0),
iu AS (SELECT l, r, name, min(row(s, e)) AS o FROM ih GROUP BY ALL),
un AS (SELECT l, r, string_agg(name, '+' ORDER BY o, name) AS lab, string_agg(name, ';' ORDER BY o, name) AS names, count(*) AS n FROM iu GROUP BY ALL),
hh AS (SELECT l, r, coalesce(string_agg(name, ';' ORDER BY s, e, name) FILTER (bp >= e - s + 1), '') AS fulls, coalesce(string_agg(name, ';' ORDER BY s, e, name) FILTER (bp < e - s + 1), '') AS parts,
  string_agg(name || ':' || CASE WHEN bp >= e - s + 1 THEN 'full' ELSE 'partial' END || ':' || bp, ';' ORDER BY s, e, name) AS detail,
  bool_or(name = 'control_region') AS ctl, bool_or(kind IN ('rRNA', 'tRNA')) AS rna, bool_and(kind = 'protein_coding') AS cod FROM ih GROUP BY ALL),
imp AS (SELECT co.l, co.r, co.z, coalesce(lab, 'intergenic') AS lab, coalesce(names, '') AS names, coalesce(fulls, '') AS fulls, coalesce(parts, '') AS parts, coalesce(detail, '') AS detail,
  CASE WHEN ctl THEN 'd_loop_involved' WHEN rna THEN 'rrna_trna_involved' WHEN n IS NULL THEN 'intergenic' WHEN n = 1 THEN 'single_feature' WHEN n = 2 THEN 'two_features'
    WHEN cod THEN 'multi_feature_protein_coding_only' ELSE 'multi_feature_mixed' END AS cls FROM co LEFT JOIN un ON un.l = co.l AND un.r = co.r LEFT JOIN hh ON hh.l = co.l AND hh.r = co.r)"""
ORACLES["f_impact"] = f"""WITH {COORDS}, {IMPACT} SELECT l AS left_breakpoint, r AS right_breakpoint, z AS deleted_size, lab AS affected_feature_label, names AS affected_features, fulls AS fully_removed_features,
  parts AS partially_overlapped_features, cls AS feature_impact_class, detail AS per_feature_overlap_details FROM imp"""

MINOR, MAJOR = overlap("l", "r", "408", "5746"), f"({overlap('l', 'r', '5747', str(L))} + {overlap('l', 'r', '1', '407')})"
ARC = f"CASE WHEN {MINOR} > 0 AND {MAJOR} > 0 THEN 'major_and_minor_arcs' WHEN {MAJOR} > 0 THEN 'major_arc_only' WHEN {MINOR} > 0 THEN 'minor_arc_only' ELSE 'unassigned' END"
ORACLES["f_arcs"] = f"""WITH {COORDS} SELECT l AS left_breakpoint, r AS right_breakpoint, z AS deleted_size, {MINOR} AS minor_arc_deleted_bp, {MAJOR} AS major_arc_deleted_bp, {ARC} AS replication_arc_context FROM co"""
TARGETS = f"""concat_ws(';', CASE WHEN {dist("l", "8469")} <= 100 AND {dist("r", "13447")} <= 100 AND abs(z - 4977) <= 150 THEN 'common' END,
  CASE WHEN {dist("l", "3000")} <= 20 AND {dist("r", "7951")} <= 20 AND abs(z - 4950) <= 30 THEN 'hot_a' END, CASE WHEN {dist("l", "12000")} <= 60 AND {dist("r", "1951")} <= 60 THEN 'hot_b' END,
  CASE WHEN {dist("l", "5000")} <= 6 THEN 'open_right' END, CASE WHEN {dist("l", "9000")} <= 100 AND {dist("r", "11951")} <= 100 AND abs(z - 2950) <= 150 THEN 'search_9000_11951' END)"""
ORACLES["f_targets"] = f"""WITH {COORDS}, k AS (SELECT *, {TARGETS} AS lab FROM co)
SELECT l AS left_breakpoint, r AS right_breakpoint, z AS deleted_size, lab AS known_deletion_label,
  concat_ws(';', CASE WHEN regexp_matches(lab, 'common|hot|open') THEN 'configured_known_deletion_match' END, CASE WHEN contains(lab, 'search') THEN 'configured_sequence_search_target_match' END) AS known_deletion_match_reason FROM k"""

ANN = f"""{OBS}, {FEATS}, co AS (SELECT l, r, z FROM ex), {IMPACT},
pt AS (SELECT l AS v FROM ex UNION SELECT r FROM ex),
pn AS (SELECT v, {at_text("pt.v")} AS a, {near_text("pt.v")} AS nf FROM pt),
an0 AS (SELECT ex.*, p1.a AS al, p1.nf AS nl, p2.nf AS nr, imp.lab, imp.names, imp.cls, imp.detail, {ARC.replace("l,", "l,")} AS arc, {MINOR} AS minor, {TARGETS} AS kd,
  split_part(p1.nf, ':', 1) AS gl, split_part(p2.nf, ':', 1) AS gr
  FROM ex JOIN pn p1 ON p1.v = ex.l JOIN pn p2 ON p2.v = ex.r JOIN (SELECT l AS il, r AS ir, lab, names, cls, detail FROM imp) imp ON il = ex.l AND ir = ex.r),
ann AS (SELECT *, CASE WHEN gl = 'MT-ND1' AND gr = 'MT-CO1' THEN 'same_transcript' WHEN (gl = 'MT-CO3' AND gr = 'MT-ND5') OR (gl = 'MT-ND5' AND gr = 'MT-CO3') THEN 'neighbours' END AS why FROM an0)"""
ORACLES["f_annotate"] = f"""WITH {ANN} SELECT eid AS exact_deletion_id, al AS left_feature_overlap, nl AS nearest_left_feature, nr AS nearest_right_feature, lab AS affected_feature_label, cls AS feature_impact_class,
  {size_class("z")} AS size_class, arc AS replication_arc_context, kd AS known_deletion_label, CASE WHEN why IS NULL THEN 'candidate_deletion_junction' ELSE 'expected_transcript_junction' END AS junction_interpretation,
  coalesce(why, 'not_configured_expected_transcript_pair') AS junction_interpretation_reason FROM ann"""
ORACLES["f_display"] = f"""WITH {COORDS}, {IMPACT}, d(feature_name, feature_class, start, "end", strand) AS (
  SELECT name, CASE WHEN name LIKE 'MT-R%' THEN 'rRNA' WHEN name LIKE 'MT-T%' THEN 'tRNA' ELSE 'protein_coding' END, s, e, '+' FROM feats WHERE kind <> 'region'
  UNION ALL VALUES ('control_region', 'configured region', 16024, 576, '.'), ('repeat_window', 'configured region', 8445, 8495, '.')),
n AS (SELECT name, count(*) AS events FROM iu GROUP BY name)
SELECT feature_name, feature_class, start, "end", strand, abs("end" - start) + 1 AS length_bp, events FROM d LEFT JOIN n ON name = feature_name"""

ORACLES["q_junction_judge"] = f"""WITH {JUNCTIONS}, {FEATS},
i AS (SELECT *, {gap("breakpoint_a", "breakpoint_b")} AS z, start_a + la - 1 AS ea, start_b + ra - 1 AS eb, row_number() OVER () AS id FROM j WHERE contig_a = 'MT' AND contig_b = 'MT'),
h AS (SELECT id, 'l' AS side, name, s, e, least(ea, e) - greatest(start_a, s) + 1 AS bp FROM i JOIN feats ON least(ea, e) >= greatest(start_a, s) AND kind <> 'region'
  UNION ALL SELECT id, 'r', name, s, e, least(eb, e) - greatest(start_b, s) + 1 FROM i JOIN feats ON least(eb, e) >= greatest(start_b, s) AND kind <> 'region'),
t AS (SELECT id, side, arg_min(row(name, s, e), row(-bp, name, s)) AS t, string_agg(name, ';' ORDER BY -bp, name, s) AS hits, list(name) AS ns FROM h GROUP BY ALL),
x AS (SELECT i.*, a.t AS ta, b.t AS tb, coalesce(a.hits, '') AS ha, coalesce(b.hits, '') AS hb, coalesce(list_has_any(a.ns, b.ns), FALSE) AS same, la AS e1, clip AS s2, clip + ra AS e2 FROM i LEFT JOIN t a ON a.id = i.id AND a.side = 'l' LEFT JOIN t b ON b.id = i.id AND b.side = 'r'),
y AS (SELECT *, greatest(0, e1 - s2) AS ov, greatest(0, s2 - e1) AS gp FROM x),
f AS (SELECT *, concat_ws(';', CASE WHEN strand_a <> strand_b THEN 'incompatible_reference_orientation' END, CASE WHEN la < 12 THEN 'left_anchor_short' END, CASE WHEN ra < 12 THEN 'right_anchor_short' END,
  CASE WHEN z < 100 THEN 'deletion_too_small' END, CASE WHEN z > 16000 THEN 'deletion_too_large' END, CASE WHEN ov > 20 THEN 'query_overlap_too_large' END, CASE WHEN gp > 20 THEN 'query_gap_too_large' END,
  CASE WHEN ta IS NULL OR tb IS NULL THEN 'missing_annotated_gene_anchor' END, CASE WHEN same THEN 'same_gene_chimeric_alignment' END,
  CASE WHEN ta IS NOT NULL AND tb IS NOT NULL AND greatest(0, least(ta[3], tb[3]) - greatest(ta[2], tb[2]) + 1) / least(ta[3] - ta[2] + 1, tb[3] - tb[2] + 1) > 0.5 THEN 'substantially_overlapping_gene_anchors' END,
  CASE WHEN (ta[1] = 'MT-ND1' AND tb[1] = 'MT-CO1') OR (ta[1] = 'MT-CO3' AND tb[1] = 'MT-ND5') OR (ta[1] = 'MT-ND5' AND tb[1] = 'MT-CO3') THEN 'configured_expected_transcript_pair' END) AS why FROM y)
SELECT sample, read_id, breakpoint_a AS left_breakpoint, breakpoint_b AS right_breakpoint, z AS deleted_size, la AS left_anchor_length, ra AS right_anchor_length, ov AS query_overlap_bp, gp AS query_gap_bp,
  ha AS left_gene_hits, hb AS right_gene_hits, ta[1] || '--' || tb[1] AS gene_pair_label, 99 - score AS chimeric_score_delta, least(repeat_left, repeat_right) AS junction_repeat_length,
  round(1.0 - la / (la + mq), 6) AS left_clipped_fraction, CASE WHEN why = '' THEN 'pass' ELSE 'fail' END AS filter_status, why AS filter_reason FROM (SELECT *, ra AS mq FROM f)"""

# ---- tiers ---------------------------------------------------------------------------------

GRADED = f"""{ANN},
ps AS (SELECT l, r, sample, count(*) AS c FROM ob GROUP BY ALL),
pa AS (SELECT l, r, string_agg(sample || ':' || c, ';' ORDER BY sample) AS per, max(c) AS mx, count(*) FILTER (c >= 2) AS rep FROM ps GROUP BY ALL),
gc AS (SELECT l, r, 'G' || (k % 3) || '--H1' AS g, count(*) AS c FROM ob WHERE k % 5 <= 1 GROUP BY ALL),
gm AS (SELECT l, r, g FROM gc QUALIFY row_number() OVER (PARTITION BY l, r ORDER BY c DESC, g) = 1),
ag AS (SELECT l, r, count(*) AS oc, CAST(sum(1 + k % 3) AS BIGINT) AS raw, count(DISTINCT read_id) AS nread, count(DISTINCT k % 9) AS npat, count(*) FILTER (k % 5 = 0) AS nboth, count(*) FILTER (k % 5 <= 1) AS star, count(*) FILTER (k % 5 <> 1) AS remap,
  avg(CASE WHEN k % 4 > 0 THEN (k % 4 = 1)::INT END) AS prim, quantile_cont(anc, 0.5) AS manc, quantile_cont((k % 20) / 100, 0.5) AS merr, max((k % 20) / 100) AS werr, quantile_cont(1.0 - (k % 8) / 16, 0.5) AS mcov,
  avg((k % 3 > 0)::INT) AS adj, count(*) FILTER (k % 2 = 1) AS cplx, max(k % 7) AS rl, count(*) FILTER (len(rots) > 1) AS brot, bool_or(k % 50 = 7) AS undir, bool_or(k % 10 = 3) AS qg FROM ob GROUP BY ALL),
grd AS (SELECT ann.*, ag.* EXCLUDE (l, r), pa.per, pa.mx, pa.rep, coalesce(gm.g, gl || '--' || gr) AS gp,
  CASE WHEN why IS NOT NULL OR undir THEN 'rejected' WHEN oc < 2 THEN 'review' WHEN mx >= 2 OR nboth > 0 THEN 'strong' ELSE 'supported' END AS tier,
  CASE WHEN why IS NOT NULL THEN 'configured_expected_transcript_junction' WHEN undir THEN 'unresolved_direction_ambiguity' WHEN oc < 2 THEN 'fewer_than_minimum_supported_observations'
    WHEN mx >= 2 OR nboth > 0 THEN 'replicated_within_sample_or_cross_caller_corroboration' ELSE 'multi_observation_support_without_strong_corroboration' END AS reason,
  array_to_string(list_sort(list_filter([CASE WHEN qg THEN 'query_gap' END, CASE WHEN oc = 1 THEN 'singleton_cluster' END, CASE WHEN why IS NOT NULL THEN 'expected_transcript_junction' END, CASE WHEN undir THEN 'direction_ambiguity' END], lambda v: v IS NOT NULL)), ';') AS flags,
  CASE WHEN star > 0 AND remap > 0 THEN 'star_and_minimap2' WHEN star > 0 THEN 'star_only' ELSE 'minimap2_only' END AS status
  FROM ann JOIN ag ON ag.l = ann.l AND ag.r = ann.r JOIN pa ON pa.l = ann.l AND pa.r = ann.r LEFT JOIN gm ON gm.l = ann.l AND gm.r = ann.r)"""
ORACLES["t_grade"] = f"""WITH {GRADED} SELECT eid AS exact_deletion_id, oc AS distinct_observation_count, raw AS raw_source_record_count, nread AS distinct_read_identifier_count, npat AS distinct_alignment_pattern_count,
  per AS support_per_sample, mx AS maximum_support_within_sample, rep AS samples_with_replicated_support, concat_ws(';', CASE WHEN remap > 0 THEN 'minimap2_remap' END, CASE WHEN star > 0 THEN 'star_chimeric' END) AS evidence_sources,
  round(nboth / oc, 6) AS both_caller_supporting_observation_fraction, status AS evidence_status, round(prim, 6) AS primary_chain_evidence_fraction, manc AS median_min_anchor_length, round(merr, 6) AS median_alignment_error_rate,
  werr AS worst_alignment_error_rate, round(mcov, 6) AS median_query_union_coverage, round(adj, 6) AS adjacent_query_segment_fraction, cplx AS complex_alignment_chain_observation_count, cplx AS multiple_hypothesis_observation_count,
  l || ':' || r AS modal_observed_breakpoint_pair, 0 AS maximum_left_breakpoint_deviation_bp, brot AS both_rotation_supporting_observation_count, rl AS microhomology_or_repeat_length, gp AS gene_pair_label, tier AS quality_tier,
  reason AS quality_tier_reason, flags AS quality_flags FROM grd"""
PROFILES = "pro(name, tiers) AS (VALUES ('stringent', ['strong']), ('standard', ['strong', 'supported']), ('exploratory', ['strong', 'supported', 'review']))"
ORACLES["t_membership"] = f"""WITH {GRADED}, {PROFILES} SELECT eid AS exact_deletion_id, name AS report_profile, list_contains(tiers, tier) AS included, tier AS quality_tier, oc AS distinct_observation_count,
  CASE WHEN list_contains(tiers, tier) THEN 'included_tier' ELSE reason END AS reason FROM grd CROSS JOIN pro"""
ORACLES["t_profile"] = f"""WITH {GRADED} SELECT sample, read_id, ob.eid AS exact_deletion_id, tier AS quality_tier, CASE WHEN k % 5 <= 1 THEN 'G' || (k % 3) || '--H1' ELSE gl || '--' || gr END AS gene_pair_label
FROM ob JOIN grd ON grd.l = ob.l AND grd.r = ob.r WHERE tier IN ('strong', 'supported')"""
ORACLES["t_summary"] = f"""WITH {GRADED}, tiers(t) AS (VALUES ('strong'), ('supported'), ('review'), ('rejected'), ('unknown'))
SELECT 'cluster' AS level, t AS quality_tier, (SELECT count(*) FROM grd WHERE tier = t) AS count FROM tiers UNION ALL SELECT 'observation', t, (SELECT CAST(coalesce(sum(oc), 0) AS BIGINT) FROM grd WHERE tier = t) FROM tiers"""
ORACLES["t_index"] = f"""WITH {GRADED}, {PROFILES} SELECT name AS profile, array_to_string(tiers, ', ') AS included_tiers, count(*) FILTER (list_contains(tiers, tier)) AS deletion_clusters,
  CAST(coalesce(sum(oc) FILTER (list_contains(tiers, tier)), 0) AS BIGINT) AS distinct_observations, CASE WHEN name = 'standard' THEN 'Primary interpretation' ELSE 'Sensitivity view' END AS role FROM grd CROSS JOIN pro GROUP BY name, tiers"""
ORACLES["w_composition"] = f"""WITH {GRADED} SELECT 'cluster' AS level, status AS name, count(*) AS count FROM grd GROUP BY status
UNION ALL SELECT 'observation', CASE k % 5 WHEN 0 THEN 'minimap2_remap;star_chimeric' WHEN 1 THEN 'star_chimeric' ELSE 'minimap2_remap' END, count(*) FROM ob GROUP BY 2"""

# ---- matrices and statistics ---------------------------------------------------------------

SAMPLES = """smp AS (SELECT sample, CAST(substr(sample, 2) AS BIGINT) AS i, CASE WHEN i % 2 = 0 THEN '18mo' ELSE '34mo' END AS age, CASE WHEN (i // 2) % 2 = 0 THEN 'Control' ELSE 'GPA' END AS tr, age || '_' || tr AS cond,
  CASE WHEN i = 11 THEN 0.0 ELSE 1000.0 * count(*) END AS tot, 10.0 * count(*) AS mt FROM seg GROUP BY sample)"""
EVID = f"{GRADED}, {SAMPLES}, bef AS (SELECT ob.*, grd.lab, grd.cls, grd.gp, grd.tier, grd.detail, grd.why FROM ob JOIN grd ON grd.l = ob.l AND grd.r = ob.r), evd AS (SELECT * FROM bef WHERE why IS NULL)"
PM = "coalesce({0} / nullif(tot, 0), 0) * 1000000.0"
COUNTS = f"""{EVID}, lng AS (SELECT 'exact' AS kind, sample, eid AS label, tier FROM evd UNION ALL SELECT 'affected', sample, lab, tier FROM evd UNION ALL SELECT 'impact', sample, cls, tier FROM evd UNION ALL SELECT 'gene_pair', sample, gp, tier FROM evd),
cnt AS (SELECT kind, c.sample, label, reads, {PM.format("reads")} AS pm, cond, i, tot FROM (SELECT kind, sample, label, count(*) AS reads FROM lng GROUP BY ALL) c JOIN smp ON smp.sample = c.sample),
bur AS (SELECT smp.*, CAST(coalesce(sum(reads) FILTER (kind = 'exact'), 0) AS BIGINT) AS rd, coalesce(sum(pm) FILTER (kind = 'exact'), 0.0) AS spm, count(*) FILTER (kind = 'exact') AS ue, count(*) FILTER (kind = 'affected') AS ua
  FROM smp LEFT JOIN (SELECT kind, sample, label, reads, pm FROM cnt) c ON c.sample = smp.sample GROUP BY ALL)"""
ORACLES["a_evidence"] = f"WITH {EVID} SELECT sample, read_id, eid AS exact_deletion_id, lab AS affected_feature_label, tier AS quality_tier, la AS left_anchor_length, z AS deleted_size FROM evd"
ORACLES["a_counts"] = f"WITH {COUNTS} SELECT kind AS label_kind, sample, label, reads, round(pm, 6) AS per_million FROM cnt"
ORACLES["a_profile_counts"] = f"""WITH {EVID}, {PROFILES}, lng AS (SELECT 'exact' AS kind, sample, eid AS label, tier FROM evd UNION ALL SELECT 'affected', sample, lab, tier FROM evd UNION ALL SELECT 'impact', sample, cls, tier FROM evd UNION ALL SELECT 'gene_pair', sample, gp, tier FROM evd)
SELECT name AS profile, kind AS label_kind, sample, label, count(*) AS reads FROM lng JOIN pro ON list_contains(tiers, tier) GROUP BY ALL"""
ORACLES["a_alternative"] = f"""WITH {ANN}, {SAMPLES}, c AS (SELECT sample, eid, count(*) AS n FROM ob GROUP BY ALL)
SELECT smp.sample, a.eid AS exact_deletion_id, coalesce(n, 0) AS raw, round(coalesce(n, 0) / nullif(tot / 1e6, 0), 6) AS per_million_fragments, round(coalesce(n, 0) / nullif(mt / 1e6, 0), 6) AS per_million_mt_reads, (coalesce(n, 0) > 0)::INT AS presence
FROM smp CROSS JOIN (SELECT DISTINCT eid FROM ann WHERE why IS NULL) a LEFT JOIN c ON c.sample = smp.sample AND c.eid = a.eid"""
ORACLES["a_wide"] = f"""WITH {COUNTS}, lb AS (SELECT DISTINCT kind, label FROM cnt) SELECT lb.kind AS label_kind, smp.sample, lb.label, coalesce(reads, 0) AS reads FROM smp CROSS JOIN lb
  LEFT JOIN cnt ON cnt.sample = smp.sample AND cnt.kind = lb.kind AND cnt.label = lb.label"""
ORACLES["a_burden"] = f"""WITH {COUNTS} SELECT sample, cond AS condition, rd AS deletion_supporting_reads, round(spm, 6) AS deletion_support_per_million_mt_reads, ue AS unique_exact_deletions, ua AS unique_affected_feature_categories FROM bur"""
FB = f"""{EVID}, tok AS (SELECT sample, split_part(unnest(string_split(detail, ';')), ':', 1) AS feature FROM evd WHERE detail <> ''),
fb AS (SELECT t.sample, feature, cond, n, {PM.format("n")} AS pm FROM (SELECT sample, feature, count(*) AS n FROM tok GROUP BY ALL) t JOIN smp ON smp.sample = t.sample)"""
ORACLES["a_feature_burden"] = f"WITH {FB} SELECT sample, feature, cond AS condition, n AS supporting_reads, round(pm, 6) AS support_per_million_mt_reads FROM fb"

COMPARE = f"""{COUNTS}, grp AS (SELECT cond, min(i) AS o FROM smp GROUP BY cond), prs AS (SELECT a.cond AS lg, b.cond AS rg FROM grp a JOIN grp b ON a.o < b.o),
lbs AS (SELECT DISTINCT kind, label FROM cnt), den AS (SELECT lbs.kind, lbs.label, smp.sample, smp.cond, coalesce(c.pm, 0) AS pm, coalesce(c.reads, 0) AS reads FROM lbs CROSS JOIN smp
  LEFT JOIN cnt c ON c.kind = lbs.kind AND c.label = lbs.label AND c.sample = smp.sample),
gs AS (SELECT kind, label, cond, avg(pm) AS m, CAST(sum(reads) AS BIGINT) AS rd, count(*) FILTER (reads > 0) AS sg FROM den GROUP BY ALL),
us AS (SELECT a.kind, a.label, lg, rg, sum(CASE WHEN a.pm > b.pm THEN 1.0 WHEN a.pm = b.pm THEN 0.5 ELSE 0 END) AS u FROM den a JOIN prs ON a.cond = lg JOIN den b ON b.kind = a.kind AND b.label = a.label AND b.cond = rg GROUP BY ALL),
tv AS (SELECT kind, label, lg, rg, pm, count(*) AS t FROM den JOIN prs ON cond = lg OR cond = rg GROUP BY ALL), ts AS (SELECT kind, label, lg, rg, sum(t * t * t - t) AS tie FROM tv GROUP BY ALL),
cmp AS (SELECT lbs.kind, lbs.label, lg, rg, x.m AS lm, y.m AS rm, x.rd AS lr, y.rd AS rr, x.sg + y.sg AS sg FROM lbs CROSS JOIN prs JOIN gs x ON x.kind = lbs.kind AND x.label = lbs.label AND x.cond = lg JOIN gs y ON y.kind = lbs.kind AND y.label = lbs.label AND y.cond = rg)"""
ORACLES["a_compare"] = f"""WITH {COMPARE} SELECT c.kind AS label_kind, c.label, c.lg AS left_group, c.rg AS right_group, round(lm, 6) AS left_mean_per_million_mt_reads, round(rm, 6) AS right_mean_per_million_mt_reads,
  round(rm - lm, 6) AS difference_per_million_mt_reads, CASE WHEN lm <= 0 AND rm <= 0 THEN 'absent_in_both_groups' WHEN lm <= 0 THEN 'present_only_in_right_group' WHEN rm <= 0 THEN 'present_only_in_left_group'
    WHEN rm > lm THEN 'higher_in_right_group' WHEN rm < lm THEN 'higher_in_left_group' ELSE 'same_group_mean' END AS abundance_change, round(log2((rm + 0.5) / (lm + 0.5)), 6) AS log2_fold_change_right_over_left,
  CASE WHEN lm > 0 AND rm > 0 THEN round(rm / lm, 6) END AS fold_change_right_over_left, lr AS left_total_supporting_reads, rr AS right_total_supporting_reads, sg AS samples_with_signal,
  CAST(u AS DOUBLE) AS mann_whitney_u, CAST(tie AS DOUBLE) AS tie_term FROM cmp c JOIN us ON us.kind = c.kind AND us.label = c.label AND us.lg = c.lg AND us.rg = c.rg JOIN ts ON ts.kind = c.kind AND ts.label = c.label AND ts.lg = c.lg AND ts.rg = c.rg"""

def fisher(name: str, table: str, a: str, b: str, c: str, d: str) -> str:
    """CTEs of the exact two-sided p of distinct 2 x 2 tables: likelihood ratios to the observed one by running sums of logarithms."""
    return f"""{name}0 AS (SELECT DISTINCT {a} AS a, {b} AS b, {c} AS c, {d} AS d FROM {table}),
{name}1 AS (SELECT *, unnest(range(greatest(0, a - d), least(a + b, a + c) + 1)) AS x FROM {name}0 WHERE a + b > 0 AND c + d > 0 AND a + c > 0 AND b + d > 0),
{name}2 AS (SELECT *, coalesce(sum(ln((a + b - x) * (a + c - x)::DOUBLE / ((x + 1.0) * (d - a + x + 1.0)))) OVER (PARTITION BY a, b, c, d ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS w
  FROM {name}1 WHERE TRUE),
{name}3 AS (SELECT *, w - max(CASE WHEN x = a THEN w END) OVER (PARTITION BY a, b, c, d) AS r FROM {name}2),
{name}4 AS (SELECT a, b, c, d, sum(exp(r - top)) FILTER (r <= 1e-7) / sum(exp(r - top)) AS p FROM (SELECT *, max(r) OVER (PARTITION BY a, b, c, d) AS top FROM {name}3) GROUP BY a, b, c, d),
{name} AS (SELECT z.*, coalesce(y.p, 1.0) AS p FROM {name}0 z LEFT JOIN {name}4 y USING (a, b, c, d))"""


def adjusted(p: str) -> str:
    """Benjamini-Hochberg inside each kind, after ``rk``: equal p share the largest rank."""
    return f"least(1.0, min({p} * m / r_{p}) OVER (PARTITION BY kind ORDER BY {p} DESC))"


# ranks of n1 of n1 + n2 values, all ways counted; erf by its series
RANK_P = f"""{COMPARE}, gn AS (SELECT cond, count(*) AS n, CAST(floor(sum(tot)) AS BIGINT) AS dp FROM smp GROUP BY cond),
cs AS (SELECT c.*, u, tie, g1.n AS n1, g2.n AS n2, g1.dp AS ld, g2.dp AS rd, x.sg AS ls, y.sg AS rs, greatest(u, g1.n * g2.n - u) AS top
  FROM cmp c JOIN us ON us.kind = c.kind AND us.label = c.label AND us.lg = c.lg AND us.rg = c.rg JOIN ts ON ts.kind = c.kind AND ts.label = c.label AND ts.lg = c.lg AND ts.rg = c.rg
  JOIN gn g1 ON g1.cond = c.lg JOIN gn g2 ON g2.cond = c.rg JOIN gs x ON x.kind = c.kind AND x.label = c.label AND x.cond = c.lg JOIN gs y ON y.kind = c.kind AND y.label = c.label AND y.cond = c.rg),
ways AS (SELECT n1, n2, list_sum(list_transform(range(0, n1 + n2), lambda k: CASE WHEN (m >> k) % 2 = 1 THEN k + 1 ELSE 0 END)) - n1 * (n1 + 1) // 2 AS v FROM (SELECT DISTINCT n1, n2 FROM cs) t, LATERAL (SELECT unnest(range(0, 1 << (n1 + n2)::INT)) AS m) k WHERE bit_count(m) = n1),
exu AS (SELECT n1, n2, top, avg(CASE WHEN v >= top THEN 1.0 ELSE 0.0 END) AS tail FROM (SELECT DISTINCT n1, n2, top FROM cs WHERE tie = 0) t JOIN ways USING (n1, n2) GROUP BY ALL),
nm AS (SELECT *, n1 * n2 / 12.0 * (n1 + n2 + 1 - tie / ((n1 + n2) * (n1 + n2 - 1.0))) AS var FROM cs),
zs AS (SELECT *, CASE WHEN var > 0 THEN (top - n1 * n2 / 2.0 - 0.5) / sqrt(2 * var) END AS z FROM nm),
mw AS (SELECT zs.*, CASE WHEN tie = 0 THEN least(1.0, 2.0 * exu.tail) WHEN coalesce(z, 0) <= 0 THEN 1.0
  ELSE 1.0 - 2.0 / sqrt(pi()) * list_sum(list_transform(range(0, 80), lambda k: (1 - 2 * (k % 2)) * exp((2 * k + 1) * ln(z) - lgamma(k + 1.0)) / (2 * k + 1))) END AS p1
  FROM zs LEFT JOIN exu USING (n1, n2, top)),
{fisher("fp", "mw", "lr", "rr", "n1 - ls", "n2 - rs")},
{fisher("fd", "mw", "lr", "greatest(ld - lr, 0)", "rr", "greatest(rd - rr, 0)")},
pvs AS (SELECT mw.*, fp.p AS p2, fd.p AS p3 FROM mw JOIN fp ON fp.a = lr AND fp.b = rr AND fp.c = n1 - ls AND fp.d = n2 - rs JOIN fd ON fd.a = lr AND fd.b = greatest(ld - lr, 0) AND fd.c = rr AND fd.d = greatest(rd - rr, 0)),
rkq AS (SELECT *, count(*) OVER (PARTITION BY kind) AS m, count(*) OVER (PARTITION BY kind ORDER BY p1) AS r_p1, count(*) OVER (PARTITION BY kind ORDER BY p3) AS r_p3 FROM pvs)"""
ORACLES["a_compare_p"] = f"""WITH {RANK_P} SELECT kind AS label_kind, label, lg AS left_group, rg AS right_group, round(p1, 6) AS p_value, round(p2, 6) AS fisher_presence_p, round(p3, 6) AS read_depth_fisher_p,
  round({adjusted("p1")}, 6) AS q_value_bh, round({adjusted("p3")}, 6) AS read_depth_fisher_q_value_bh FROM rkq"""
ORACLES["a_adjust"] = """WITH r AS (SELECT l_returnflag, CASE WHEN l_suppkey % 10 > 0 THEN (1 + l_partkey * 37 % 1000) / 1000.0::DOUBLE END AS p FROM lineitem),
k AS (SELECT *, row_number() OVER (ORDER BY p) AS a, count(*) OVER () AS na, row_number() OVER (PARTITION BY l_returnflag ORDER BY p) AS b, count(*) OVER (PARTITION BY l_returnflag) AS nb FROM r WHERE p IS NOT NULL),
q AS (SELECT *, least(1.0, min(p * na / a) OVER (ORDER BY a DESC)) AS q1, least(1.0, min(p * nb / b) OVER (PARTITION BY l_returnflag ORDER BY b DESC)) AS q2 FROM k)
SELECT l_returnflag, p, count(*) AS n, round(min(q1), 9) AS q_all, round(max(q2), 9) AS q_flag FROM q GROUP BY ALL UNION ALL SELECT l_returnflag, NULL, count(*), NULL, NULL FROM r WHERE p IS NULL GROUP BY l_returnflag"""
ORACLES["a_associations"] = f"""WITH {COUNTS}, o AS (SELECT sample, age, tr, 'deletion_support_per_million_mt_reads' AS outcome, spm AS y FROM bur UNION ALL SELECT sample, age, tr, 'unique_exact_deletions', ue FROM bur),
k AS (SELECT *, CAST(left(age, 2) AS DOUBLE) AS x, rank() OVER (PARTITION BY outcome ORDER BY y) + (count(*) OVER (PARTITION BY outcome, y) - 1) / 2.0 AS ry,
  rank() OVER (PARTITION BY outcome ORDER BY age) + (count(*) OVER (PARTITION BY outcome, age) - 1) / 2.0 AS rx FROM o),
n AS (SELECT outcome, round(corr(rx, ry), 6) AS rho, round(regr_slope(y, x), 6) AS sl, round(avg(y) FILTER (tr = 'Control'), 6) AS lm, round(avg(y) FILTER (tr = 'GPA'), 6) AS rm, sum(ry) FILTER (tr = 'Control') - 21.0 AS u FROM k GROUP BY outcome)
SELECT c AS metadata_column, 'numeric_or_ordered' AS metadata_type, outcome, 'spearman_and_linear_regression' AS test, rho AS spearman_rho, sl AS linear_slope, CAST(NULL AS VARCHAR) AS left_group, CAST(NULL AS VARCHAR) AS right_group,
  CAST(NULL AS DOUBLE) AS left_mean, CAST(NULL AS DOUBLE) AS right_mean, CAST(NULL AS DOUBLE) AS mann_whitney_u FROM n CROSS JOIN (VALUES ('age'), ('condition')) t(c)
UNION ALL SELECT 'treatment', 'categorical', outcome, 'mann_whitney_u', NULL, NULL, 'Control', 'GPA', lm, rm, CAST(u AS DOUBLE) FROM n"""
ORACLES["a_size_tests"] = f"""WITH {EVID}, v AS (SELECT cond, z, min(i) OVER (PARTITION BY cond) AS o FROM evd JOIN smp ON smp.sample = evd.sample),
m AS (SELECT cond, min(o) AS o, count(*) AS n, quantile_cont(z, 0.5) AS med FROM v GROUP BY cond), prs AS (SELECT a.cond AS lg, b.cond AS rg, a.n AS na, b.n AS nb, a.med AS ma, b.med AS mb FROM m a JOIN m b ON a.o < b.o),
w AS (SELECT lg, rg, na, nb, z, count(*) FILTER (cond = lg) AS a, count(*) FILTER (cond = rg) AS b FROM v JOIN prs ON cond = lg OR cond = rg GROUP BY ALL),
c AS (SELECT *, sum(a) OVER w AS ca, sum(b) OVER w AS cb FROM w WINDOW w AS (PARTITION BY lg, rg ORDER BY z)),
g AS (SELECT lg, rg, max(abs(ca / na - cb / nb)) AS d, sum(a * (cb - b)) + sum(a * b) / 2.0 AS u FROM c GROUP BY ALL)
SELECT 'condition' AS group_column, g.lg AS left_group, g.rg AS right_group, na AS left_n_deletion_supporting_reads, nb AS right_n_deletion_supporting_reads, ma AS left_median_deleted_size, mb AS right_median_deleted_size,
  t AS test, round(CASE WHEN t LIKE 'kol%' THEN d ELSE u END, 6) AS statistic FROM g JOIN prs ON prs.lg = g.lg AND prs.rg = g.rg CROSS JOIN (VALUES ('kolmogorov_smirnov_unweighted_deletion_sizes'), ('mann_whitney_u_unweighted_deletion_sizes')) x(t)"""
W = "CASE WHEN tot > 0 THEN 1000000.0 / tot ELSE 0 END"
SIZES = f"""siz AS (SELECT evd.sample, quantile_cont(z, 0.5) AS med, count(*) FILTER (z >= 5000) * any_value({W}) AS lrg, count(*) FILTER (z < 1000) * any_value({W}) AS sml, count(*) FILTER (z >= 1000 AND z < 5000) * any_value({W}) AS mid
  FROM evd JOIN smp ON smp.sample = evd.sample GROUP BY evd.sample)"""
ORACLES["a_size_metrics"] = f"""WITH {EVID}, {SIZES} SELECT sample, med AS median_deletion_size, round(lrg, 6) AS large_deletion_support_per_million_mt_reads, round(sml, 6) AS small_lt_1kb_support_per_million_mt_reads,
  round(mid, 6) AS medium_1kb_to_4999bp_support_per_million_mt_reads FROM siz"""
ORACLES["a_size_bins"] = f"""WITH {EVID}, v AS (SELECT cond, z, {W} AS w FROM evd JOIN smp ON smp.sample = evd.sample),
g AS (SELECT cond, count(*) AS n, quantile_cont(z, 0.5) AS med, sum(w) AS t, coalesce(sum(w) FILTER (z < 1000), 0) AS a, coalesce(sum(w) FILTER (z >= 1000 AND z < 5000), 0) AS b, coalesce(sum(w) FILTER (z >= 5000), 0) AS c FROM v GROUP BY cond)
SELECT cond AS "group", n AS n_deletion_supporting_reads, med AS median_deletion_size, round(t, 6) AS total_support_per_million_mt_reads, round(a, 6) AS small_lt_1kb_support_per_million_mt_reads,
  round(b, 6) AS medium_1kb_to_4999bp_support_per_million_mt_reads, round(c, 6) AS large_ge_5kb_support_per_million_mt_reads, round(a / t, 6) AS small_lt_1kb_fraction_of_support, round(b / t, 6) AS medium_1kb_to_4999bp_fraction_of_support,
  round(c / t, 6) AS large_ge_5kb_fraction_of_support FROM g"""
ORACLES["a_factorial"] = f"""WITH {COUNTS}, {SIZES}, m AS (SELECT bur.*, med, lrg, sml, mid FROM bur LEFT JOIN siz ON siz.sample = bur.sample),
o AS (SELECT age, tr, unnest(['deletion_support_per_million_mt_reads', 'unique_exact_deletions', 'median_deletion_size', 'large_deletion_support_per_million_mt_reads', 'small_lt_1kb_support_per_million_mt_reads', 'medium_1kb_to_4999bp_support_per_million_mt_reads']) AS outcome,
  unnest([spm, ue, med, lrg, sml, mid]::DOUBLE[]) AS y FROM m),
c AS (SELECT outcome, age, tr, count(*) AS n, avg(y) AS m, coalesce(var_pop(y), 0) * count(*) AS s FROM o WHERE y IS NOT NULL GROUP BY ALL),
w AS (SELECT outcome, sum(n) AS n, sum(s) / (sum(n) - 4) AS s2, sum(1.0 / n) AS iall, sum(1.0 / n) FILTER (tr = 'Control') AS ia, sum(1.0 / n) FILTER (age = '18mo') AS it, max(m) FILTER (age = '18mo' AND tr = 'Control') AS m00, max(m) FILTER (age = '34mo' AND tr = 'Control') AS m10,
  max(m) FILTER (age = '18mo' AND tr = 'GPA') AS m01, max(m) FILTER (age = '34mo' AND tr = 'GPA') AS m11 FROM c GROUP BY outcome),
r AS (SELECT outcome, 'age' AS term, '34mo vs 18mo' AS contrast, m10 - m00 AS est, sqrt(s2 * ia) AS se, n FROM w UNION ALL SELECT outcome, 'treatment', 'GPA vs Control', m01 - m00, sqrt(s2 * it), n FROM w
  UNION ALL SELECT outcome, 'age:treatment', 'extra GPA effect in 34mo', m11 - m10 - m01 + m00, sqrt(s2 * iall), n FROM w)
SELECT outcome, term, contrast, round(est, 4) AS estimate, CASE WHEN est > 0 THEN 'positive' WHEN est < 0 THEN 'negative' ELSE 'zero' END AS direction, round(se, 4) AS standard_error, round(est / se, 4) AS t_statistic, CAST(n - 4 AS BIGINT) AS degrees_of_freedom FROM r"""
ORACLES["a_qc"] = f"""WITH {COUNTS}, a AS (SELECT sample, count(*) AS n, count(*) FILTER (why IS NOT NULL) AS x, count(*) FILTER (why IS NULL) AS c, count(*) FILTER (why IS NULL AND (lsec OR rsec)) AS sec, count(*) FILTER (why IS NULL AND mq <= 0) AS mz FROM bef GROUP BY sample),
u AS (SELECT sample, count(*) AS n, count(DISTINCT read_id) AS d FROM ob WHERE k % 50 = 7 GROUP BY sample)
SELECT bur.sample, tot AS total_usable_reads, mt AS reads_passed_to_minimap2, coalesce(a.n, 0) AS clustered_split_read_alignments_before_transcript_filter, coalesce(x, 0) AS expected_transcript_compatible_split_reads,
  coalesce(c, 0) AS candidate_deletion_split_reads_before_transcript_filter, coalesce(sec, 0) AS primary_calls_using_secondary_alignments, coalesce(mz, 0) AS primary_calls_with_min_mapq_zero, coalesce(u.n, 0) AS ambiguous_direction_records_excluded,
  coalesce(d, 0) AS ambiguous_direction_reads_excluded, rd AS deletion_supporting_reads, ue AS unique_exact_deletions, TRUE AS expected_transcript_filter_applied,
  concat_ws(';', CASE WHEN mt = 0 THEN 'no_mitochondrial_evidence_reads' END, CASE WHEN d > 0 THEN 'ambiguous_direction_evidence_excluded' END, CASE WHEN sec > 0 THEN 'secondary_alignments_in_primary_calls' END,
    CASE WHEN mz > 0 THEN 'mapq_zero_alignments_in_primary_calls' END) AS warning_flags FROM bur LEFT JOIN a ON a.sample = bur.sample LEFT JOIN u ON u.sample = bur.sample"""

# ---- views ---------------------------------------------------------------------------------

LOC = f"""{ANN}, {SAMPLES},
loc0 AS (SELECT cond, l, r, z, eid, count(*) AS n, round(sum({W}), 9) AS sup FROM ob JOIN smp ON smp.sample = ob.sample GROUP BY ALL),
loc AS (SELECT *, row_number() OVER (PARTITION BY cond ORDER BY sup DESC, eid) AS rk FROM loc0)"""
LOCATION = "cond AS plot_group, loc.eid AS exact_deletion_id, loc.l AS left_breakpoint, loc.r AS right_breakpoint, loc.z AS deleted_size, loc.n AS supporting_reads, round(sup, 6) AS plot_support, rk AS support_rank"
ORACLES["v_locations"] = f"WITH {LOC} SELECT {LOCATION}, ann.lab AS affected_feature_label, arc AS replication_arc_context FROM loc JOIN ann ON ann.l = loc.l AND ann.r = loc.r"
ORACLES["v_top_locations"] = f"""WITH {OBS}, {SAMPLES}, loc0 AS (SELECT tr AS cond, l, r, z, eid, count(*) AS n, round(sum({W}), 9) AS sup FROM ob JOIN smp ON smp.sample = ob.sample GROUP BY ALL),
loc AS (SELECT *, row_number() OVER (PARTITION BY cond ORDER BY sup DESC, eid) AS rk FROM loc0 WHERE sup >= 0.2) SELECT {LOCATION} FROM loc WHERE rk <= 40"""
DENSITY = f"""{LOC}, ep AS (SELECT 'l' AS side, l AS v, sup, n FROM loc UNION ALL SELECT 'r', r, sup, n FROM loc),
bn AS (SELECT b, count(*) FILTER (side = 'l') AS lc, count(*) FILTER (side = 'r') AS rc, coalesce(sum(sup) FILTER (side = 'l'), 0.0) AS ls, coalesce(sum(sup) FILTER (side = 'r'), 0.0) AS rs,
  CAST(coalesce(sum(n) FILTER (side = 'l'), 0) AS BIGINT) AS ln, CAST(coalesce(sum(n) FILTER (side = 'r'), 0) AS BIGINT) AS rn FROM (SELECT range AS b FROM range(332)) LEFT JOIN ep ON (v - 1) // 50 = b GROUP BY b),
sm AS (SELECT a.b, sum(c.ls + c.rs) / 7.0 AS ss, sum(c.lc + c.rc) / 7.0 AS sc FROM bn a JOIN bn c ON least(abs(a.b - c.b), 332 - abs(a.b - c.b)) <= 3 GROUP BY a.b)"""
ORACLES["v_hotspots"] = f"""WITH RECURSIVE {DENSITY},
pk AS (SELECT (a.b * 50 + 1 + least((a.b + 1) * 50, {L})) / 2.0 AS coord, round(a.ss, 9) AS h FROM sm a WHERE round(a.ss, 9) > 0
  AND NOT EXISTS (SELECT 1 FROM sm c WHERE c.b IN ((a.b + 1) % 332, (a.b + 331) % 332) AND round(c.ss, 9) > round(a.ss, 9))),
rkp AS (SELECT *, row_number() OVER (ORDER BY h DESC, coord) AS k FROM pk),
pick AS (SELECT 0::BIGINT AS k, []::DOUBLE[] AS cs, []::DOUBLE[] AS hs
  UNION ALL SELECT r.k, CASE WHEN ok THEN list_append(cs, r.coord) ELSE cs END, CASE WHEN ok THEN list_append(hs, r.h) ELSE hs END
  FROM (SELECT r.*, cs, hs, len(cs) < 8 AND len(list_filter(cs, lambda c: least(abs(r.coord - c), {L} - abs(r.coord - c)) < {int(L * 0.075)})) = 0 AS ok FROM pick JOIN rkp r ON r.k = pick.k + 1) r)
SELECT round(coord, 4) AS coord, round(height, 4) AS height FROM (SELECT unnest(cs) AS coord, unnest(hs) AS height FROM pick QUALIFY row_number() OVER (ORDER BY k DESC) = 1)"""
ORACLES["v_density"] = f"""WITH {DENSITY} SELECT bn.b AS bin_index, lc AS left_endpoint_count, rc AS right_endpoint_count, round(ls, 6) AS left_support, round(rs, 6) AS right_support, ln AS left_raw_supporting_reads, rn AS right_raw_supporting_reads,
  lc + rc AS endpoint_count, round(ls + rs, 6) AS summed_support, ln + rn AS raw_supporting_reads, bn.b * 50 + 1 AS bin_start, least((bn.b + 1) * 50, {L}) AS bin_end, (bn.b * 50 + 1 + least((bn.b + 1) * 50, {L})) / 2.0 AS bin_midpoint,
  round(ss, 6) AS smoothed_summed_support, round(CAST(sc AS DOUBLE), 6) AS smoothed_endpoint_count FROM bn JOIN sm ON sm.b = bn.b"""
ORACLES["v_pairs"] = f"""WITH {LOC} SELECT cond AS plot_group, l AS left_breakpoint, r AS right_breakpoint, CASE WHEN r < l THEN r + {L} ELSE r END AS adjusted_right_breakpoint, r < l AS crosses_origin, round(sum(sup), 6) AS plot_support,
  CAST(sum(n) AS BIGINT) AS supporting_reads, min(rk) AS support_rank, min(z) AS deleted_size, count(DISTINCT eid) AS pair_count, string_agg(DISTINCT eid, '+') AS exact_deletion_id FROM loc GROUP BY cond, l, r"""
ORACLES["v_histogram"] = f"""WITH {EVENTS}, {SAMPLES}, lim AS (SELECT min(deleted_size)::DOUBLE AS lo, max(deleted_size)::DOUBLE AS hi FROM events),
b AS (SELECT cond, least(floor((deleted_size - lo) / ((hi - lo) / 60.0)), 59)::INT AS b, lo, (hi - lo) / 60.0 AS st, {W} AS w FROM events JOIN smp ON smp.sample = events.sample CROSS JOIN lim)
SELECT cond AS "group", b AS bin_index, round(min(lo + b * st), 4) AS bin_start, round(min(lo + (b + 1) * st), 4) AS bin_end, count(*) AS supporting_reads, round(sum(w), 4) AS weighted_support FROM b GROUP BY cond, b"""
ORACLES["v_categories"] = f"""WITH {COUNTS}, t AS (SELECT kind, cond, label, sum(reads)::DOUBLE AS v FROM cnt GROUP BY ALL), p AS (SELECT kind, cond, label, v / sum(v) OVER (PARTITION BY kind, cond) * 100 AS v FROM t),
k AS (SELECT kind, label FROM p GROUP BY kind, label QUALIFY row_number() OVER (PARTITION BY kind ORDER BY round(sum(v), 9) DESC, label) <= 14)
SELECT kind AS label_kind, cond AS "group", CASE WHEN (kind, label) IN (SELECT (kind, label) FROM k) THEN label ELSE 'Other categories' END AS category, round(sum(v), 6) AS value FROM p GROUP BY 1, 2, 3"""
ORACLES["v_top_features"] = f"""WITH {FB}, g AS (SELECT cond, feature, sum(pm) AS v FROM fb GROUP BY ALL), k AS (SELECT feature FROM g GROUP BY feature ORDER BY sum(v) DESC, feature LIMIT 8),
raw(n, s) AS (VALUES ('MT-ND1', 3307), ('MT-ND2', 4470), ('MT-CO1', 5904), ('MT-CO2', 7586), ('MT-ATP8', 8366), ('MT-ATP6', 8527), ('MT-CO3', 9207), ('MT-ND3', 10059), ('MT-ND4L', 10470), ('MT-ND4', 10760), ('MT-ND5', 12337),
  ('MT-ND6', 14149), ('MT-CYB', 14747), ('MT-RNR1', 648), ('MT-RNR2', 1671), ('MT-TL1', 3230))
SELECT feature, cond AS "group", round(v, 6) AS support_per_million_mt_reads, s AS genome_order FROM g LEFT JOIN raw ON n = feature WHERE feature IN (SELECT feature FROM k)"""
ORACLES["v_recurrence"] = f"""WITH {COUNTS}, k AS (SELECT *, len(string_split(lab, '+')) AS np FROM ann ORDER BY n DESC, eid LIMIT 22), g AS (SELECT cond, label, sum(pm) AS v FROM cnt WHERE kind = 'exact' GROUP BY ALL)
SELECT eid AS exact_deletion_id, l || '->' || r || ' (' || z || ' bp) | ' || CASE WHEN np > 6 THEN string_split(lab, '+')[1] || ' ... ' || string_split(lab, '+')[-1] || ' (' || np || ' features)' ELSE lab END AS label,
  n AS total_supporting_reads, cond AS "group", round(v, 6) AS support_per_million FROM k LEFT JOIN g ON g.label = eid"""
ORACLES["v_gram"] = f"""WITH {COUNTS}, lb AS (SELECT DISTINCT label FROM cnt WHERE kind = 'affected'), d AS (SELECT smp.sample, lb.label, coalesce(reads, 0)::DOUBLE AS v FROM smp CROSS JOIN lb LEFT JOIN cnt ON cnt.sample = smp.sample AND cnt.label = lb.label AND kind = 'affected'),
c AS (SELECT sample, label, v - avg(v) OVER (PARTITION BY label) AS v FROM d) SELECT a.sample AS sample_a, b.sample AS sample_b, round(sum(a.v * b.v), 3) AS value FROM c a JOIN c b ON a.label = b.label GROUP BY ALL"""
ORACLES["v_bray_curtis"] = f"""WITH {COUNTS}, x AS (SELECT kind, sample, label, pm FROM cnt), t AS (SELECT k.kind, smp.sample, coalesce(sum(pm), 0) AS t FROM smp CROSS JOIN (SELECT DISTINCT kind FROM cnt) k
  LEFT JOIN x ON x.sample = smp.sample AND x.kind = k.kind GROUP BY ALL),
m AS (SELECT a.kind, a.sample AS sa, b.sample AS sb, sum(least(a.pm, b.pm)) AS m FROM x a JOIN x b ON a.label = b.label AND a.kind = b.kind GROUP BY ALL)
SELECT a.kind AS label_kind, a.sample AS sample_a, b.sample AS sample_b, CASE WHEN a.sample = b.sample OR a.t + b.t = 0 THEN 0.0 ELSE round((a.t + b.t - 2 * coalesce(m, 0)) / (a.t + b.t), 6) END AS distance
FROM t a JOIN t b ON a.kind = b.kind LEFT JOIN m ON sa = a.sample AND sb = b.sample AND m.kind = a.kind"""
RANKED = f"""{COMPARE}, rk AS (SELECT cmp.*, round(rm - lm, 6) AS df, lr + rr AS obs, ann.l, ann.r, ann.z, ann.arc, ann.minor FROM cmp JOIN ann ON ann.eid = cmp.label WHERE cmp.kind = 'exact' AND lr + rr >= 1),
rkd AS (SELECT *, row_number() OVER (PARTITION BY lg, rg ORDER BY abs(df) DESC, obs DESC, label) AS pos FROM rk)"""
ORACLES["v_comparison"] = f"""WITH {RANKED} SELECT label AS exact_deletion_id, lg AS left_group, rg AS right_group, df AS difference_per_million_mt_reads, obs AS total_supporting_observations, pos AS comparison_rank, z AS deleted_size,
  arc AS replication_arc_context, minor AS minor_arc_deleted_bp FROM rkd"""
ORACLES["v_preset"] = f"WITH {RANKED} SELECT label AS exact_deletion_id, lg AS left_group, rg AS right_group, df AS difference_per_million_mt_reads FROM rkd WHERE obs >= 2 AND abs(df) >= 0.05 AND df > 0"
ORACLES["v_presets"] = f"""WITH {RANK_P}, rk AS{RANKED.split("rk AS", 1)[1].split("rkd AS")[0].rstrip().rstrip(",")},
qv AS (SELECT kind, label, lg, rg, p1, {adjusted("p1")} AS q1, {adjusted("p3")} AS q3 FROM rkq),
al AS (SELECT rk.label, rk.lg, rk.rg, p1, q1, q3 FROM rk JOIN qv ON qv.kind = 'exact' AND qv.label = rk.label AND qv.lg = rk.lg AND qv.rg = rk.rg)
SELECT preset, label AS exact_deletion_id, lg AS left_group, rg AS right_group FROM (
  SELECT *, unnest([CASE WHEN TRUE THEN 'all' END, CASE WHEN q1 <= 0.05 THEN 'replicate-significant' END, CASE WHEN p1 <= 0.05 THEN 'replicate-suggestive' END, CASE WHEN q3 <= 0.05 THEN 'depth-significant' END]) AS preset FROM al) WHERE preset IS NOT NULL"""
ORACLES["v_chords"] = f"WITH {LOC} SELECT cond AS plot_group, eid AS exact_deletion_id, round((l - 1) / {L}.0 * 360, 6) AS left_angle_degrees_clockwise_from_coordinate_1, round((r - 1) / {L}.0 * 360, 6) AS right_angle_degrees_clockwise_from_coordinate_1 FROM loc"
ORACLES["v_chord_summary"] = f"""WITH {LOC} SELECT cond AS plot_group, count(*) AS loaded_deletions, round(min(sup), 6) AS support_min, round(max(sup), 6) AS support_max, round(coalesce(min(sup) FILTER (n >= 2 AND z >= 1000), max(sup)), 6) AS support_threshold,
  coalesce(min(n) FILTER (sup >= 0.3 AND z >= 1000), 0) AS observation_threshold FROM loc GROUP BY cond"""
ORACLES["v_group_order"] = f"WITH {SEG}, {SAMPLES} SELECT cond AS \"group\", row_number() OVER (ORDER BY age, tr) AS position, count(*) AS sample_count, age, tr AS treatment FROM smp GROUP BY cond, age, tr"
ORACLES["v_group_means"] = f"""WITH {COUNTS} SELECT age, tr AS treatment, round(avg(spm), 6) AS mean_value, count(*) AS sample_count, string_agg(sample, '; ' ORDER BY sample) AS samples FROM bur GROUP BY age, tr
UNION ALL SELECT NULL, tr, round(avg(spm), 6), count(*), string_agg(sample, '; ' ORDER BY sample) FROM bur GROUP BY tr"""
ORACLES["v_scale"] = f"""WITH {LOC}, m AS (SELECT min(sup) FILTER (sup > 0) AS a, max(sup) FILTER (sup > 0) AS b, quantile_cont(sup, 0.96) FILTER (sup > 0) AS c FROM loc), d AS (SELECT *, pow(10, floor(log10(a))) AS da, pow(10, floor(log10(b))) AS db FROM m)
SELECT round(a, 6) AS support_min, round(b, 6) AS support_max, round(c, 6) AS cap, round(CASE WHEN a / da < 2 THEN 1 WHEN a / da < 5 THEN 2 ELSE 5 END * da, 6) AS scale_low,
  round(CASE WHEN b / db <= 1 THEN 1 WHEN b / db <= 2 THEN 2 WHEN b / db <= 5 THEN 5 ELSE 10 END * db, 6) AS scale_high FROM d"""

# ---- report tables -------------------------------------------------------------------------

ORACLES["w_target_ranks"] = f"""WITH {ANN}, a AS (SELECT *, row_number() OVER (ORDER BY n DESC, eid) AS pos, max(n) OVER () AS top FROM ann),
g AS (SELECT kd, count(*) AS c, CAST(sum(n) AS BIGINT) AS s, min(pos) AS pos FROM a WHERE kd <> '' GROUP BY kd)
SELECT g.kd AS configured_deletion_target, c AS matching_exact_deletion_calls, s AS total_supporting_reads_across_matches, eid AS top_matching_exact_deletion, g.pos AS top_matching_rank_among_all_exact_deletions,
  n AS top_matching_supporting_reads, l AS top_left_breakpoint, r AS top_right_breakpoint, z AS top_deleted_size, g.pos = 1 AS is_strongest, top AS top_overall_exact_deletion_supporting_reads FROM g JOIN a ON a.pos = g.pos"""
SHOWN = f"{ANN}, shn AS (SELECT *, row_number() OVER (ORDER BY kd = '', n DESC, ns DESC, z DESC, eid) AS pos FROM ann WHERE (SELECT count(*) FROM ann) <= 60 OR n >= 2 OR kd <> '' QUALIFY pos <= 60)"
ORACLES["w_display"] = f"WITH {SHOWN} SELECT eid AS exact_deletion_id, kd AS known_deletion_label, n AS total_supporting_reads, z AS deleted_size, pos AS position FROM shn"
ORACLES["w_counters"] = f"""WITH {SHOWN} SELECT (SELECT count(*) FROM shn) AS shown_rows, (SELECT CAST(sum(n) AS BIGINT) FROM shn) AS shown_reads, (SELECT count(*) FROM shn WHERE kd <> '') AS shown_target_rows,
  count(*) AS total_rows, CAST(sum(n) AS BIGINT) AS total_reads, count(*) FILTER (kd <> '') AS total_target_rows FROM ann"""
ORACLES["w_checks"] = f"""WITH {COUNTS} SELECT count(*) FILTER (r <= l) AS origin_spanning_exact_deletions, count(*) FILTER (kd <> '') AS configured_target_matches, count(*) AS exact_deletions, CAST(sum(n) AS BIGINT) AS supporting_reads,
  (SELECT round(avg(spm), 6) FROM bur) AS mean_burden FROM ann"""

# ---- audit ---------------------------------------------------------------------------------

CHECK = "count(*) AS rows, count(*) FILTER (z <> {0}) AS size_mismatches, count(*) FILTER (z < 0) AS negative_sizes, 0 AS wrap_rule_mismatches, count(*) FILTER (r <= l) AS origin_spanning_rows".format(gap("l", "r"))
ORACLES["z_checks"] = f"""WITH {OBS}, e AS (SELECT left_breakpoint AS l, right_breakpoint AS r, deleted_size AS z, orderkey AS k FROM events), w AS (SELECT l, r, z - CASE WHEN k % 9 = 0 THEN 300 ELSE 0 END AS z FROM e)
SELECT 'raw rotated deletion calls' AS "table", {CHECK} FROM e UNION ALL SELECT 'altered calls', {CHECK} FROM w UNION ALL SELECT 'merged clusters', {CHECK} FROM ex"""
ORACLES["z_round_trip"] = f"""WITH {SEG} SELECT DISTINCT std_end AS standard_position, rn AS rotation_name, rs AS rotation_start, {rotated("std_end", "rs")} AS rotated_position, std_end AS back_to_standard, TRUE AS roundtrip_pass
FROM seg CROSS JOIN (VALUES ('normal', 1), ('half', 8285)) t(rn, rs)"""
BACK = norm("raw_left_breakpoint", "rotation_start")
EXAMPLE = f"sample, read_id, rotation_name, left_breakpoint, right_breakpoint, {BACK} AS raw_left_converted_to_standard, deleted_size, TRUE AS size_matches"
BY = "ORDER BY sample, read_id, deletion_id, rotation_name LIMIT 1"
EDGE = f"least(abs(raw_left_breakpoint), abs(raw_left_breakpoint - {L}), abs(raw_right_breakpoint), abs(raw_right_breakpoint - {L}))"
ORACLES["z_examples"] = f"""WITH {EVENTS}, mem AS (SELECT * FROM events QUALIFY {EXACT_FIRST}), bo AS (SELECT left_breakpoint AS l, right_breakpoint AS r FROM mem GROUP BY ALL HAVING count(DISTINCT rotation_name) > 1 ORDER BY min(deletion_id) LIMIT 1)
SELECT * FROM (SELECT 'normal deletion from standard alignment' AS example, {EXAMPLE} FROM events WHERE rotation_name = 'normal' AND NOT wraps_origin {BY})
UNION ALL SELECT * FROM (SELECT 'normal deletion from offset alignment', {EXAMPLE} FROM events WHERE rotation_name = 'half' AND NOT wraps_origin {BY})
UNION ALL SELECT * FROM (SELECT 'origin-spanning deletion from offset alignment', {EXAMPLE} FROM events WHERE rotation_name = 'half' AND wraps_origin {BY})
UNION ALL SELECT * FROM (SELECT 'deletion near offset-reference boundary', {EXAMPLE} FROM events WHERE rotation_name = 'half' AND NOT wraps_origin ORDER BY {EDGE}, sample, read_id, deletion_id, rotation_name LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'merged call detected in both alignments', {EXAMPLE} FROM mem JOIN bo ON l = left_breakpoint AND r = right_breakpoint ORDER BY sample, read_id, rotation_name LIMIT 1)"""
ORACLES["z_violations"] = f"""WITH {LOC} SELECT 'altered' AS input, 'locations' AS "table", eid AS exact_deletion_id FROM loc WHERE NOT (l % 2 = 0 AND sup > 0)
UNION ALL SELECT 'as_is', 'locations', eid FROM loc WHERE NOT sup > 0"""
