"""Registered queries: every operator on tables that Spark derives from the given ones."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from circlet.durable import materialize, shared_dir
from circlet.functions import coords as C
from circlet.functions import reads as R
from circlet.operators import annotate as FA
from circlet.operators import audit as Z
from circlet.operators import calling as D
from circlet.operators import clusters as K
from circlet.operators import conflicts as X
from circlet.operators import coverage as P
from circlet.operators import evidence as Q
from circlet.operators import features as FT
from circlet.operators import matrix as M
from circlet.operators import motif as MO
from circlet.operators import report as RP
from circlet.operators import selection as S
from circlet.operators import stats as A
from circlet.operators import tiers as T
from circlet.operators import views as V
from circlet.plans import fixtures as X0
from circlet.plans import paths as PA
from circlet.sources import alignments as SA
from circlet.sources import fastq as SF
from circlet.sources import annotation as SG
from circlet.sources import exports as SE
from circlet.sources import ranges as SR
from circlet.sources import samples as SS
from circlet.sources import tabular as ST
from circlet.streaming import selection as SEL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PRM = X0.PARAMS
L = PRM.length


def query(name: str) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, lists as text: the form results are compared in."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind == "double":
            out.append(F.round(f.name, digits).alias(f.name))
        elif kind == "array<string>":
            out.append(F.array_join(f.name, ";").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def pieces_text(pieces) -> F.Column:
    return F.array_join(F.transform(pieces, lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ";")


# ---- coordinates ---------------------------------------------------------------------------


def _ends(spark, sf) -> DataFrame:
    seg = X0.segments(spark, sf)
    right = F.pmod(F.col("std_end") + F.col("partkey") * 7 - 1, F.lit(L)) + 1
    return seg.select(
        F.col("std_end").alias("l"), right.cast("int").alias("r"), "rotation_start", F.col("partkey").cast("int").alias("k")
    ).distinct()


@query("c_positions")
def _(spark, sf):
    """C01-C05, C12, C13, C15, C17."""
    return rounded(
        _ends(spark, sf).select(
            "l", "r", "rotation_start", "k",
            C.normalize_pos("l", L, F.col("rotation_start")).alias("standard"),
            C.rotated_pos("l", L, F.col("rotation_start")).alias("rotated"),
            C.normalize_padded_pos("l", L, 1000, F.col("rotation_start")).alias("padded"),
            C.directed_gap("l", "r", L).alias("gap"), C.circular_distance("l", "r", L).alias("distance"),
            C.size_class(C.directed_gap("l", "r", L)).alias("size_class"),
            C.within_window("l", "r", F.col("k") % 500, L).alias("inside"),
            C.circular_midpoint("l", "r", L).alias("midpoint"), C.angle_degrees("l", L).alias("angle"),
        )
    )


@query("c_directed_record")
def _(spark, sf):
    """C09-C11."""
    arc = C.shortest_arc("l", "r", L)
    return _ends(spark, sf).select("l", "r").distinct().select(
        "l", "r", *[v.alias(k) for k, v in C.directed_record("l", "r", L).items()],
        arc["left"].alias("arc_left"), arc["right"].alias("arc_right"), arc["reversed"].alias("arc_reversed"),
        C.deletion_id("l", "r", C.directed_gap("l", "r", L)).alias("deletion_id"), C.breakpoint_pair_id("l", "r").alias("pair_id"),
    )


@query("c_pieces")
def _(spark, sf):
    """C06-C08, C16."""
    deleted, region = C.deleted_pieces("l", "r", L), C.region_pieces("r", "l", L)
    return _ends(spark, sf).select("l", "r").distinct().select(
        "l", "r", pieces_text(deleted).alias("deleted"), pieces_text(region).alias("region"),
        C.pieces_length(deleted).alias("deleted_bp"), C.pieces_overlap(deleted, region).alias("shared_bp"),
        pieces_text(C.window_pieces("l", 20, L)).alias("window"),
        pieces_text(C.block_pieces("l", "r", L, 8285)).alias("block"),
        C.deleted_overlap("l", "r", F.lit(5000), F.lit(9000), L).alias("with_interval"),
    )


@query("c_circular_median")
def _(spark, sf):
    """C14: median of the positions of each hotspot and sample, unwrapped round the smallest."""
    seg = X0.segments(spark, sf).select("sample", (F.col("suppkey") % 17).alias("spot"), F.col("std_end").alias("v"))
    first = seg.groupBy("sample", "spot").agg(F.min("v").alias("anchor"))
    per = seg.join(first, ["sample", "spot"]).groupBy("sample", "spot").agg(F.percentile(C.unwrap("v", "anchor", L), F.lit(0.5)).alias("m"))
    return per.select("sample", "spot", C.wrap_median("m", L).alias("median_position"))


@query("c_rotate_text")
def _(spark, sf):
    """C18 on whole document texts."""
    docs = X0.table(spark, sf, "documents").withColumn("at", (1 + F.col("doc_id") % F.length("text")).cast("int"))
    turned = C.rotate_text("text", F.col("at"))
    return docs.select("doc_id", "at", F.length(turned).alias("n"), F.md5(turned.cast("binary")).alias("digest"))


# ---- ingest --------------------------------------------------------------------------------


@query("s_fastq_text")
def _(spark, sf):
    """Documents written as FASTQ text, empty and missing ones too, read back by blocks."""
    docs = X0.table(spark, sf, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    seq = F.regexp_replace("text", "[^A-Za-z]", "N")
    record = F.array(F.concat(F.lit("@r"), F.col("doc_id").cast("string"), F.lit("/1 1:N:0:ACGT")), seq, F.lit("+"), F.repeat(F.lit("I"), F.length("text")))
    path = f"{shared_dir(spark).rstrip('/')}/fastq-{uuid.uuid4().hex}"
    docs.select(F.explode(record)).write.text(path)
    reads = SF.read_fastq(spark, [path])
    return reads.select("read_id", R.name_key("read_id").alias("read_key"), "mate", F.md5("seq").alias("digest"), F.length("qual").alias("quality_length"))


@query("s_fastq_ranges")
def _(spark, sf):
    """The same documents, read by byte ranges that begin in the middle of records."""
    docs = X0.table(spark, sf, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    seq = F.regexp_replace("text", "[^A-Za-z]", "N")
    record = F.array(F.concat(F.lit("@r"), F.col("doc_id").cast("string"), F.lit("/1 1:N:0:ACGT")), seq, F.lit("+"), F.repeat(F.lit("I"), F.length("text")))
    path = f"{shared_dir(spark).rstrip('/')}/circlet-fastq-{uuid.uuid4().hex}"
    docs.select(F.explode(record)).write.text(path)
    reads = SF.fastq_columns(SR.read_ranges(spark, path, "fastq", ["path", "place", "header", "seq", "qual"], range_bytes=1 << 16).withColumnRenamed("place", "record_no"))
    return reads.select("read_id", R.name_key("read_id").alias("read_key"), "mate", F.md5("seq").alias("digest"), F.length("qual").alias("quality_length"))


def _sam_lines(spark, sf) -> DataFrame:
    """sample and SAM text of every segment; the line number makes lines differ."""
    seg = X0.segments(spark, sf)
    cigar = F.concat(F.col("query_start").cast("string"), F.lit("S"), F.col("anchor_length").cast("string"), F.lit("M2D5M3H"))
    line = F.concat_ws(
        "\t", "read_id", F.col("flag").cast("string"), "reference_name", F.col("ref_start_raw").cast("string"), F.col("mapq").cast("string"),
        cigar, F.lit("*"), F.lit("0"), F.lit("0"), F.repeat(F.lit("A"), F.col("query_start") + F.col("anchor_length") + 5), F.lit("*"),
        F.concat(F.lit("NH:i:"), F.col("nh").cast("string")), F.concat(F.lit("NM:i:"), F.col("edit_distance").cast("string")),
        F.concat(F.lit("SA:Z:"), F.col("sa_tag")), F.concat(F.lit("XN:i:"), F.col("linenumber").cast("string")),
    )
    return seg.select("sample", line.alias("value"))


@query("s_sam_ranges")
def _(spark, sf):
    """SAM lines exported in gzip blocks for each sample, read by ranges of blocks, typed."""
    folder = f"{shared_dir(spark).rstrip('/')}/circlet-sam-{uuid.uuid4().hex}"
    listed = SE.export_keyed(_sam_lines(spark, sf), folder, "sample", ["value"], packed=True, header=False)
    lines = SR.read_ranges(spark, f"{folder}/data", columns=["path", "value"], range_bytes=1 << 17)
    file = F.element_at(F.split("path", "/data/"), -1)
    named = lines.join(F.broadcast(listed.select(F.col("id").alias("sample"), F.element_at(F.split("read_list_file", "data/"), -1).alias("_file"))), file == F.col("_file"))
    parsed = SA.parse_sam(named.select("sample", "value"))
    return rounded(
        parsed.select("sample", "query_name", "flag", "reference_name", "pos", "mapq", "query_start", "query_end", "ref_end", "aligned_fraction",
                      "soft_clip_fraction", "stored_aligned_fraction", "nh", "edit_distance", "sa_tag", "alignment_score")
    )


@query("s_export")
def _(spark, sf):
    """Orders exported by their priority, found over the manifest and read back."""
    folder = f"{shared_dir(spark).rstrip('/')}/circlet-orders-{uuid.uuid4().hex}"
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]
    listed = SE.export_keyed(X0.table(spark, sf, "orders"), folder, "o_orderpriority", columns)
    files = [f"{folder}/{r[0]}" for r in listed.select("read_list_file").collect()]  # a few for each of five keys
    read = ST.read_tsv(spark, files, "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string")
    name = F.element_at(F.split("_metadata.file_path", "/data/"), -1)
    back = read.groupBy(name.alias("_file")).agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"), F.sum("o_totalprice").alias("price"))
    both = listed.join(back, F.element_at(F.split("read_list_file", "data/"), -1) == F.url_decode("_file"), "left")
    return rounded(both.groupBy("id").agg(F.sum("read_count").alias("read_count"), F.sum("rows").alias("rows"), F.sum("keys").alias("keys"), F.sum("price").alias("price")), 2)


@query("s_run_table")
def _(spark, sf):
    """Orders as a comma-separated run table, its delimiter found and read back, per status and priority."""
    folder = f"{shared_dir(spark).rstrip('/')}/circlet-runs-{uuid.uuid4().hex}"
    orders = X0.table(spark, sf, "orders").withColumn("late", F.col("o_orderkey") % 2 == 0)
    ST.write_tsv(orders, folder, ["o_orderkey", "o_orderstatus", "o_orderpriority", "late", "missing"], sep=",")
    runs = ST.read_run_table(spark, folder)
    return runs.groupBy("o_orderstatus", "o_orderpriority", "late").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("o_orderkey").cast("long")).alias("keys"), F.count("missing").alias("missing"))


@query("s_summaries")
def _(spark, sf):
    """Selected reads and fragments of every sample, from a JSON document and a metric table of each."""
    per = X0.segments(spark, sf).groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("read_id").alias("reads"))
    even = F.col("n") % 2 == 0
    folder = f"{shared_dir(spark).rstrip('/')}/circlet-summaries-{uuid.uuid4().hex}"
    fallback = F.to_json(F.struct(F.col("n").alias("mt_evidence_reads_selected")))
    both = F.to_json(F.struct(F.col("reads").alias("mt_evidence_fastq_records_written"), F.col("n").alias("mt_evidence_reads_selected")))
    SE.write_documents(per.select(F.concat("sample", F.lit(".mt_read_summary.json")), F.when(even, both).otherwise(fallback)), f"{folder}/json")
    number = F.col("reads").cast("string")
    metrics = F.concat(F.lit("metric\tvalue\ntotal_fragments\t1\nread1_after_filtering\t"), number, F.lit("\n"))
    plain = F.concat(F.lit("fragments\n"), number, F.lit("\n"))
    SE.write_documents(per.select(F.concat("sample", F.lit("/fragment_counts.tsv")), F.when(even, metrics).otherwise(plain)), f"{folder}/tsv")
    return ST.read_summaries(spark, f"{folder}/json").join(ST.read_fragment_counts(spark, f"{folder}/tsv/*/fragment_counts.tsv"), "sample")


@query("w_preparation")
def _(spark, sf):
    """Read preparation of every sample from QC documents, beside the compact sample sheet; odd samples have none."""
    per = X0.segments(spark, sf).groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.avg("anchor_length").alias("length"))
    folder = f"{shared_dir(spark).rstrip('/')}/circlet-qc-{uuid.uuid4().hex}"
    stage = lambda share: F.struct((F.col("n") * share).cast("long").alias("total_reads"), F.round("length", 3).alias("read1_mean_length"), F.lit(0.9).alias("q30_rate"))
    report = F.struct(
        F.struct(F.lit("single end (50 cycles)").alias("sequencing"), stage(2).alias("before_filtering"), stage(1).alias("after_filtering")).alias("summary"),
        F.struct(F.lit(50).alias("total_cycles")).alias("read1_before_filtering"), F.struct((F.col("n") % 7).alias("too_short_reads")).alias("filtering_result"),
        F.struct((F.col("n") % 11).alias("adapter_trimmed_reads")).alias("adapter_cutting"),
    )
    known = per.filter(F.substring("sample", 2, 5).cast("int") % 2 == 0)
    SE.write_documents(known.select(F.concat("sample", F.lit("/qc.json")), F.to_json(report)), folder)
    sheet = X0.samples(spark, sf)
    made = ST.read_preparation(spark, sheet, f"{folder}/*/qc.json").drop("layout", "minimum_length_after_trimming", "read2_cycles_raw", "read2_mean_length_raw", "read2_mean_length_after_fastp")
    return rounded(RP.compact_samples(sheet, ["condition"]).join(made, "sample"))


@query("s_sam_text")
def _(spark, sf):
    """SAM text lines to typed columns."""
    seg = X0.segments(spark, sf)
    cigar = F.concat(F.col("query_start").cast("string"), F.lit("S"), F.col("anchor_length").cast("string"), F.lit("M2D5M3H"))
    line = F.concat_ws(
        "\t", "read_id", F.col("flag").cast("string"), "reference_name", F.col("ref_start_raw").cast("string"), F.col("mapq").cast("string"),
        cigar, F.lit("*"), F.lit("0"), F.lit("0"), F.repeat(F.lit("A"), F.col("query_start") + F.col("anchor_length") + 5), F.lit("*"),
        F.concat(F.lit("NH:i:"), F.col("nh").cast("string")), F.concat(F.lit("NM:i:"), F.col("edit_distance").cast("string")),
        F.concat(F.lit("SA:Z:"), F.col("sa_tag")),
    )
    parsed = SA.parse_sam(seg.select("sample", "orderkey", "linenumber", line.alias("value")))
    return rounded(
        parsed.select("sample", "query_name", "flag", "reference_name", "pos", "mapq", "query_start", "query_end", "ref_end", "aligned_fraction",
                      "soft_clip_fraction", "stored_aligned_fraction", "nh", "edit_distance", "sa_tag", "alignment_score")
    )


@query("s_junction_text")
def _(spark, sf):
    """Junction lines to judged events."""
    rows = X0.junction_rows(spark, sf)
    line = F.concat_ws("\t", *[F.col(name).cast("string") for name, _ in SA.JUNCTION_FIELDS])
    parsed = SA.parse_junctions(rows.select("sample", line.alias("value")))
    judged = SA.call_plain_junctions(parsed, PRM, padding=5)
    return rounded(judged)


@query("s_junction_summary")
def _(spark, sf):
    """D12 counters."""
    return SA.plain_junction_summary(SA.call_plain_junctions(X0.junction_rows(spark, sf), PRM, padding=5))


@query("s_gtf_text")
def _(spark, sf):
    """Annotation lines to features."""
    part = X0.table(spark, sf, "part")
    k = F.col("p_partkey")
    kind = F.element_at(F.array(*map(F.lit, ("gene", "exon", "CDS", "start_codon", "tRNA"))), (k % 5 + 1).cast("int"))
    attributes = F.concat(
        F.lit('gene_id "ENS'), k.cast("string"), F.lit('"; '), F.when(k % 3 > 0, F.concat(F.lit('gene_name "'), F.col("p_brand"), F.lit('"; '))).otherwise(""),
        F.lit('product "'), F.col("p_name"), F.lit('";'),
    )
    line = F.concat_ws("\t", F.when(k % 4 == 0, "1").otherwise("MT"), F.lit("src"), kind, (k + 1).cast("string"), (k + 1 + F.col("p_size")).cast("string"),
                       F.lit("."), F.lit("+"), F.lit("."), attributes)
    lines = part.select(line.alias("value"))
    other = SG.without_contigs(lines, PRM).select(F.lit("other").alias("origin"), F.split_part("value", F.lit("\t"), F.lit(4)).cast("int").alias("start"))
    kept = SG.parse_gtf(lines, PRM)
    named = kept.select(F.lit("circular").alias("origin"), "start", "end", "feature_type", "gene_id", "gene_name", "product")
    return named.unionByName(other, allowMissingColumns=True)


@query("s_resolve_samples")
def _(spark, sf):
    """Run rows with derived labels, filled cells and file lists."""
    rows = _runs(spark, sf)
    attributes = X0.table(spark, sf, "nation").select(F.concat(F.lit("B"), F.col("n_nationkey").cast("string")).alias("BioSample"), F.col("n_name").alias("tissue"))
    fastq = rows.select(
        F.when(F.col("o_orderkey") % 3 > 0, F.col("Run")).otherwise(F.concat(F.lit("other"), "Run")).alias("run_accession"),
        F.concat(F.lit("ftp.host/"), F.col("Run"), F.lit("_1.gz;http://x/"), F.col("Run"), F.lit("_2.gz")).alias("fastq_ftp"),
    )
    filled = SS.fill_from_attributes(rows, attributes)
    out = SS.resolve_samples(filled, "rat", "rat", "{dataset}_{age}_{treatment}_{replicate}", fastq)
    return out.select("sample", "run_accession", "fastq_1", "fastq_2", "layout", "age", "treatment", "condition", "tissue")


def _runs(spark, sf) -> DataFrame:
    o = X0.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    letter = F.element_at(F.array(F.lit("G"), F.lit("C"), F.lit("")), (k % 3 + 1).cast("int"))
    bio = F.when(k % 7 > 0, F.concat((18 + k % 2 * 16).cast("string"), letter, F.lit("_replicate_"), (k % 5).cast("string"))).otherwise("")
    return o.select(
        "o_orderkey", F.concat(F.lit("SRR"), k.cast("string")).alias("Run"), bio.alias("Biological_Replicate"),
        F.concat(F.lit("B"), (F.col("o_custkey") % 25).cast("string")).alias("BioSample"),
        F.when(k % 2 == 0, "liver").otherwise("").alias("tissue"), F.when(k % 4 == 0, "PAIRED").otherwise("SINGLE").alias("LibraryLayout"),
        F.col("o_orderkey").alias("record_no"),
    )


@query("s_sample_violations")
def _(spark, sf):
    """S14 on a sheet made from orders."""
    o = X0.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    sheet = o.select(
        F.when(k % 97 == 0, "").otherwise(F.concat(F.lit("x"), (k % 5000).cast("string"))).alias("sample"),
        F.when(k % 11 == 0, "other").otherwise("demo").alias("dataset"), F.when(k % 13 == 0, "rat").otherwise("human").alias("species"),
        F.element_at(F.array(*map(F.lit, ("single", "paired", "PE", "odd"))), (k % 4 + 1).cast("int")).alias("layout"),
        F.when(k % 3 == 0, "").otherwise("a.gz").alias("fastq_1"), F.when(k % 5 == 0, "b.gz").otherwise("").alias("fastq_2"),
        F.when(k % 6 == 0, "").otherwise("SRR").alias("run_accession"), F.when(k % 17 == 0, "").otherwise("ctl").alias("condition"),
    )
    found = SS.violations(sheet, PRM, "demo", "human", "single_end_short_read", ["condition"], [{"name": "t", "left_breakpoint": 10, "right_breakpoint": 20, "deleted_size": 5}])
    return found.groupBy("rule").agg(F.count(F.lit(1)).alias("found"), F.count_distinct("subject").alias("subjects"))


# ---- read selection ------------------------------------------------------------------------


def _chimeric(spark, sf) -> DataFrame:
    return S.chimeric_names(X0.junction_rows(spark, sf), PRM)


@query("r_classify")
def _(spark, sf):
    """R02-R06 with chimeric names and mates."""
    p = replace(PRM, include_secondary_reads=False, include_mates=True)
    out = S.classify(X0.alignments(spark, sf), p, _chimeric(spark, sf))
    return out.groupBy("sample", "query_name").agg(
        F.count(F.lit(1)).alias("records"), F.count_if("selected").alias("selected"),
        F.array_join(F.array_sort(F.collect_set(F.concat_ws("=", "category", F.array_join("reasons", "+")))), ";").alias("reasons"),
    )


@query("r_classification_summary")
def _(spark, sf):
    """R08."""
    return S.classification_summary(S.classify(X0.alignments(spark, sf), PRM, _chimeric(spark, sf)))


@query("r_selected_reads")
def _(spark, sf):
    """First primary record of every selected (name, mate)."""
    out = S.selected_reads(S.classify(X0.alignments(spark, sf), PRM))
    parts = [df.select(F.lit(n).alias("output"), "sample", "query_name", "mapq", "flag", "category") for n, df in out.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("r_selection_totals")
def _(spark, sf):
    """R08 totals."""
    return S.selection_totals(S.classify(X0.alignments(spark, sf), PRM))


@query("r_competitive")
def _(spark, sf):
    """One decision per read, and whether it is retained."""
    p = replace(PRM, competitive_ambiguous_mapq_below=15, competitive_min_aligned_fraction=0.6, competitive_nuclear_aligned_fraction=0.9, keep_ambiguous=False)
    groups = S.competitive_groups(X0.alignments(spark, sf), p)
    kept = S.retain(groups, p).select(*S.READ, F.lit(True).alias("retained"))
    return groups.join(kept, list(S.READ), "left").select("sample", "query_name", "mate", "records", "category", F.coalesce("retained", F.lit(False)).alias("retained"))


@query("r_competitive_summary")
def _(spark, sf):
    """R11."""
    return S.competitive_summary(S.competitive_groups(X0.alignments(spark, sf), PRM), PRM)


@query("r_competitive_stream")
def _(spark, sf):
    """R09, R11 over all records as micro-batches of files, in which the records of a read are spread over several.

    ``arrived`` is the second of a record's file; a last row of no sample, much later, lets the watermark close every group.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/circlet-arriving-{uuid.uuid4().hex}"
    rows = X0.alignments(spark, sf).withColumn("part", (F.col("record_no.linenumber") % 4).cast("int"))
    rows = rows.select("sample", "query_name", "flag", "mapq", "reference_name", "aligned_fraction", "record_no", F.timestamp_seconds("part").alias("arrived"))
    end = {"sample": F.lit(None).cast("string"), "arrived": F.timestamp_seconds(F.lit(100_000))}
    closing = spark.range(1).select(*[end.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in rows.schema.fields])
    for part in range(4):  # in the order in which they arrive
        rows.filter(F.col("arrived") == F.timestamp_seconds(F.lit(part))).write.mode("append").parquet(folder)
    closing.write.mode("append").parquet(folder)
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(folder)
    closed = SEL.decisions(arriving, PRM, "1 minute", f"{folder}-out", f"{folder}-checkpoint")
    return SEL.decision_summary(closed.filter("sample is not null"), PRM)


@query("r_depletion")
def _(spark, sf):
    """R12."""
    out = S.deplete_nuclear(X0.alignments(spark, sf), PRM)
    return out.select("sample", "query_name", "mate", "mapq", "retention_reason")


@query("r_depletion_summary")
def _(spark, sf):
    """R12 counters."""
    rows = X0.alignments(spark, sf)
    return S.depletion_summary(rows, S.deplete_nuclear(rows, PRM), PRM)


@query("r_forward_reads")
def _(spark, sf):
    """R14 on whole document texts."""
    docs = X0.table(spark, sf, "documents").select(
        F.col("lang").alias("sample"), F.col("doc_id").cast("string").alias("query_name"), F.col("text").alias("seq"),
        F.lit(None).cast("string").alias("qual"), (F.col("doc_id") % 4 * 16 + F.col("doc_id") % 3 * 64).cast("int").alias("flag"),
    )
    out = S.as_fastq(docs)
    return out.select("sample", "read_name", F.md5(F.col("seq").cast("binary")).alias("digest"), F.length("qual").alias("quality_length"))


@query("r_mates")
def _(spark, sf):
    """Two mate tables under each other, with counts."""
    docs = X0.documents(spark, sf).drop("mate")
    return S.mate_counts(S.concat_mates(docs, docs))


# ---- motif search --------------------------------------------------------------------------


def _hits(spark, sf) -> DataFrame:
    return MO.find_motifs(X0.documents(spark, sf), X0.motifs(spark, sf))


@query("m_hits")
def _(spark, sf):
    """M01-M05 over whole documents."""
    return _hits(spark, sf)


@query("m_summary")
def _(spark, sf):
    """Every sample with every motif."""
    docs = X0.documents(spark, sf)
    sheet = docs.groupBy("sample").agg(F.count(F.lit(1)).alias("n")).select(
        "sample", F.when(F.length("sample") % 2 == 0, F.col("n") * 2).alias("mt_evidence_reads"), F.lit(None).cast("long").alias("fragments")
    )
    return rounded(MO.motif_summary(_hits(spark, sf), docs, X0.motifs(spark, sf), sheet))


def _searched(spark, sf):
    ev = X0.event_ends(spark, sf)
    targets = MO.search_targets(spark, X0.KNOWN, X0.SEARCHES, L)
    key = X0.orderkey()
    near = ev.select("sample", F.concat("read_id", F.lit("/1")).alias("read_id"), key.alias("k"))
    hits = near.select("sample", "read_id", F.when(F.col("k") % 2 == 0, "search_9000_11951").otherwise("again_3001_7950").alias("deletion_id"))
    return hits, ev.withColumn("exact_deletion_id", F.col("deletion_id")).drop("deletion_id"), targets


@query("m_overlap")
def _(spark, sf):
    """M07."""
    return rounded(MO.search_overlap(*_searched(spark, sf)))


@query("m_read_sets")
def _(spark, sf):
    """Sizes of the five read sets."""
    sets = MO.read_sets(*_searched(spark, sf))
    return sets.groupBy("set_name", "source", "sample", "deletion_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("read_key").alias("reads"), F.count("exact_deletion_id").alias("with_event")
    )


# ---- event calling -------------------------------------------------------------------------

EVENT = ("sample", "read_id", "rotation_name", "deletion_id", "breakpoint_pair_id", "left_breakpoint", "right_breakpoint", "deleted_size",
         "wraps_origin", "deleted_interval", "complement_deleted_size", "left_anchor_length", "right_anchor_length", "min_mapq", "strand",
         "raw_left_breakpoint", "raw_right_breakpoint", "query_overlap_bp", "query_gap_bp", "query_first_start", "query_second_start",
         "left_cigar", "right_cigar", "left_flag", "right_is_secondary")


def _segments(spark, sf) -> DataFrame:
    return X0.segments(spark, sf).select(*X0.SEGMENT_INPUT)


@query("d_segments")
def _(spark, sf):
    """Usable segments of the alignment records."""
    p = replace(PRM, min_mapq=4, include_secondary=False, min_segment_aligned_fraction=0.6, max_soft_clip_fraction=0.2, min_anchor_length=49)
    out = D.select_segments(D.split_evidence(X0.alignments(spark, sf)), p)
    return out.select("sample", "rotation_name", "read_id", "chain_id", "query_start", "query_end", "anchor_length", "ref_start", "ref_end", "strand", "mapq",
                      "is_primary", "is_supplementary")


@query("d_pairs")
def _(spark, sf):
    """Every compatible pair as a directed event."""
    return D.events_from_pairs(D.pair_segments(_segments(spark, sf), PRM), PRM).select(*EVENT)


@query("d_adjacent_pairs")
def _(spark, sf):
    """D05."""
    p = replace(PRM, pairing_mode="adjacent")
    return D.events_from_pairs(D.pair_segments(_segments(spark, sf), p), p).select(*EVENT)


@query("d_legacy_arc")
def _(spark, sf):
    """D07 with the shorter arc."""
    p = replace(PRM, arc_assignment="legacy_shortest_arc")
    return D.events_from_pairs(D.pair_segments(_segments(spark, sf), p), p).select(*EVENT, "canonical_orientation", "directed_deleted_size")


@query("d_events")
def _(spark, sf):
    """Events counted once per read, event and rotation."""
    return D.call_events(_segments(spark, sf), PRM).select(*EVENT, "direction_status")


@query("d_event_counts")
def _(spark, sf):
    """The minimum slice: reads per sample and event."""
    ev = D.call_events(_segments(spark, sf), PRM)
    return ev.groupBy("sample", "deletion_id").agg(F.count(F.lit(1)).alias("reads"), F.count_distinct("read_id").alias("distinct_reads"))


@query("d_reciprocal")
def _(spark, sf):
    """D09 on events to which some reads add the reverse direction."""
    ev = D.first_per_read(D.events_from_pairs(D.pair_segments(_segments(spark, sf), PRM), PRM))
    turned = ev.filter(X0.orderkey() % 7 == 0).withColumns(
        {"directed_left_breakpoint": F.col("directed_right_breakpoint"), "directed_right_breakpoint": F.col("directed_left_breakpoint")}
    )
    out = D.mark_reciprocal(ev.unionByName(turned))
    return out.select("sample", "read_id", "rotation_name", "breakpoint_pair_id", "directed_left_breakpoint", "directed_right_breakpoint", "direction_status")


@query("d_call_summary")
def _(spark, sf):
    """D11."""
    rows = X0.alignments(spark, sf)
    return D.call_summary(rows, D.call_candidates(_segments(spark, sf), PRM), PRM)


# ---- evidence ------------------------------------------------------------------------------


@query("q_cigar")
def _(spark, sf):
    """Q01, Q02 on all segment CIGARs."""
    seg = X0.segments(spark, sf).withColumns({k: v for k, v in R.cigar_metrics("cigar").items() if k not in ("query_start", "query_end")})
    pair = R.query_pair_metrics("query_start", "query_end", F.col("mapq"), F.col("mapq") + 30, "query_length")
    own = seg.select("orderkey", "cigar", "mapq", "query_start", "query_end", "query_length", "aligned_query_length", "aligned_reference_length", *[v.alias(f"pair_{k}") for k, v in pair.items()])
    return rounded(own.distinct())


@query("q_junction_judge")
def _(spark, sf):
    """Q03-Q05: junction records judged with reasons in order."""
    pairs = [(e["left_feature"], e["right_feature"], e.get("bidirectional", False)) for e in X0.EXPECTED]
    out = Q.judge_junctions(X0.junction_rows(spark, sf), X0.feature_set(spark), PRM, pairs)
    return rounded(
        out.select("sample", "read_id", "left_breakpoint", "right_breakpoint", "deleted_size", "left_anchor_length", "right_anchor_length", "query_overlap_bp",
                   "query_gap_bp", "left_gene_hits", "right_gene_hits", "gene_pair_label", "chimeric_score_delta", "junction_repeat_length",
                   "left_clipped_fraction", "filter_status", "filter_reason")
    )


@query("q_remap_rows")
def _(spark, sf):
    """Q06, Q07."""
    out = Q.with_layout(Q.remap_evidence(X0.events(spark, sf)), "paired")
    return rounded(
        out.select("sample", "read_id", "rotation_name", "deletion_id", "read_length", "estimated_alignment_error_rate", "left_clipped_fraction",
                   "total_alignment_segments", "alignment_pattern_id", "query_union_coverage", "query_segments_adjacent", "total_aligned_query_length",
                   "primary_chain_evidence", "secondary_only_evidence", "query_junction_boundary_distance_from_read_end_min", "mate_mapping_class")
    )


@query("q_conflicts")
def _(spark, sf):
    """Q09 at slop 60."""
    out = X.flag_conflicts(X0.event_ends(spark, sf), 60, L)
    return out.select("sample", "read_id", "rotation_name", "left_breakpoint", "right_breakpoint", "in_conflict")


@query("q_union")
def _(spark, sf):
    """Q08: caller rows by source, status and reason."""
    return RP.disposition(X0.candidates(spark, sf))


OBSERVATION = ("sample", "read_id", "left_breakpoint", "right_breakpoint", "deleted_size", "evidence_sources", "both_callers_support", "source_record_count",
               "rotation_support", "deletion_hypotheses_from_read", "observation_quality_flags", "min_anchor_length", "min_mapq",
               "estimated_alignment_error_rate", "query_union_coverage", "gene_pair_label", "primary_chain_evidence", "secondary_only_evidence",
               "alignment_pattern_count", "junction_repeat_length", "query_segments_adjacent")


@query("q_observations")
def _(spark, sf):
    """Q09-Q13: physical observations of both callers."""
    found, _ = Q.consolidate(X0.candidates(spark, sf), PRM)
    return rounded(found.select(*OBSERVATION))


# ---- end to end ----------------------------------------------------------------------------


@query("e_remap")
def _(spark, sf):
    """Segments to events, conflicts left out, clusters and their member rows."""
    out = PA.remap_path(_segments(spark, sf), PRM).members
    return out.select("sample", "read_id", "rotation_name", "exact_deletion_id", "left_breakpoint", "right_breakpoint", "read_left_breakpoint",
                      "read_right_breakpoint", "read_deleted_size")


@query("e_evidence")
def _(spark, sf):
    """Rows of both callers to observations, clusters of them, annotation and tiers."""
    targets = FA.deletion_targets(spark, X0.KNOWN, X0.SEARCHES, L)

    def annotated(clusters):
        return FA.annotate(clusters, X0.feature_set(spark), X0.ARCS, targets, X0.EXPECTED, L)

    graded = PA.evidence_path(X0.candidates(spark, sf), PRM, annotated, stored=True).graded
    return rounded(graded.select(
        "leader_left", "leader_right", "distinct_observation_count", "raw_source_record_count", "distinct_read_identifier_count",
        "maximum_support_within_sample", "both_caller_supporting_observation_fraction", "evidence_sources",
    ))


@query("q_build_summary")
def _(spark, sf):
    """Q14: what consolidation took in and gave out."""
    rows = X0.candidates(spark, sf)
    path = PA.evidence_path(rows, PRM, stored=True)
    return Q.build_summary(rows, path.ambiguous, path.observations, path.clusters, PRM)


# ---- clusters ------------------------------------------------------------------------------

CLUSTER = ("exact_deletion_id", "breakpoint_pair_id", "left_breakpoint", "right_breakpoint", "deleted_size", "wraps_origin", "deleted_interval",
           "total_supporting_reads", "samples_with_signal", "supporting_samples", "rotations", "rotation_count", "rotation_agreement")
READ_ORDER = ("sample", "read_id", "left_breakpoint", "right_breakpoint")


@query("k_clusters")
def _(spark, sf):
    """K01-K03 in coordinate order, clusters with support of two."""
    assigned = X0.assigned(spark, sf)
    return rounded(K.cluster_table(assigned, PRM.slop, L, PRM.min_support).select(*CLUSTER))


@query("k_clusters_by_read")
def _(spark, sf):
    """K01-K03 in (sample, read) order."""
    assigned = K.assign_clusters(X0.event_ends(spark, sf), PRM.slop, L, READ_ORDER)
    return rounded(K.cluster_table(assigned, PRM.slop, L, 1, READ_ORDER).select(*CLUSTER))


@query("k_members")
def _(spark, sf):
    """Member rows with representative and own coordinates."""
    assigned = X0.assigned(spark, sf)
    out = K.member_rows(assigned, K.cluster_table(assigned, PRM.slop, L, PRM.min_support))
    return out.select("sample", "read_id", "rotation_name", "exact_deletion_id", "left_breakpoint", "right_breakpoint", "read_left_breakpoint",
                      "read_right_breakpoint", "read_deleted_size")


@query("k_numbered")
def _(spark, sf):
    """K06."""
    out = K.numbered_clusters(X0.events(spark, sf), PRM.slop, L, 1)
    return rounded(out.select("junction_id", "left_breakpoint", "right_breakpoint", "deleted_size", "total_supporting_reads", "samples_with_signal", "supporting_samples", "rotation_count"))


@query("k_exact")
def _(spark, sf):
    """K01 at slop 0, with K04's id map."""
    members = X0.members(spark, sf)
    return K.id_map(members).select("sample", "read_id", "exact_deletion_id", "left_breakpoint", "right_breakpoint", "reported_left_breakpoint")


# ---- coverage ------------------------------------------------------------------------------


def _positions(spark, sf) -> DataFrame:
    ev = X0.event_ends(spark, sf)
    near = spark.range(1, 61).select(F.when(F.col("id") <= 30, F.col("id")).otherwise(F.col("id") + L - 60).cast("int").alias("position"))
    own = ev.select("sample", F.explode(F.array("left_breakpoint", "right_breakpoint")).alias("position"))
    return own.unionByName(ev.select("sample").distinct().join(near, F.lit(True))).distinct()


@query("p_spanning")
def _(spark, sf):
    """Reads that span the window around each breakpoint, and around the origin."""
    return P.best_rotation(P.spanning_reads(X0.blocks(spark, sf), _positions(spark, sf), PRM))


@query("p_from_alignments")
def _(spark, sf):
    """P03 from alignment records: primary blocks of their CIGARs, with a deletion in each."""
    match, rest = F.lit(60) + F.col("record_no.partkey") % 200, F.lit(30) + F.col("record_no.suppkey") % 40
    cigar = F.concat(F.lit("7S"), match.cast("string"), F.lit("M2D"), rest.cast("string"), F.lit("=3I10S"))
    placed = P.primary_blocks(X0.alignments(spark, sf).withColumn("cigar", cigar), replace(PRM, min_mapq=5))
    return P.best_rotation(P.spanning_reads(placed, _positions(spark, sf), PRM))


@query("p_depth")
def _(spark, sf):
    """P04."""
    return P.block_depth(X0.blocks(spark, sf), _positions(spark, sf), PRM)


@query("p_support")
def _(spark, sf):
    """Split support against spanning reads."""
    obs = X0.observed(spark, sf)
    clusters = X0.exact_clusters(spark, sf)
    positions = P.candidate_positions(clusters, P.eligible_samples(clusters, obs))
    depths = P.spanning_reads(X0.blocks(spark, sf), positions, PRM)
    return rounded(P.reference_support(clusters, obs, depths, PRM).drop(*P.KEY))


@query("p_reuse")
def _(spark, sf):
    """Cached values, under the event's own id for every second one."""
    obs = X0.observed(spark, sf)
    clusters = X0.exact_clusters(spark, sf)
    n = F.col("total_supporting_reads")
    cached = clusters.select(
        F.when(F.col("left_breakpoint") % 2 == 0, F.col("exact_deletion_id")).otherwise(F.concat(F.lit("other_"), "exact_deletion_id")).alias("exact_deletion_id"), n.alias("split_supporting_reads"), (n + 1).alias("left_reference_spanning_reads"), (n + 2).alias("right_reference_spanning_reads"),
        (n + 1).alias("reference_spanning_reads_min"), F.lit(0.5).alias("local_split_support_fraction"), F.lit(20).alias("reference_support_window_bp"),
        F.lit("counted").alias("reference_support_method"),
    )
    return P.reuse_support(clusters, obs, cached, PRM).drop(*P.KEY)


# ---- annotation ----------------------------------------------------------------------------


def _coordinates(spark, sf) -> DataFrame:
    return X0.event_ends(spark, sf).select("left_breakpoint", "right_breakpoint", "deleted_size").distinct()


@query("f_positions")
def _(spark, sf):
    """Features at and nearest to every left breakpoint."""
    at = X0.segments(spark, sf).select(F.col("std_end").alias("position")).distinct()
    features = X0.feature_set(spark)
    return features.nearest(features.at(at, "position", "features_at"), "position", "nearest_feature")


@query("f_positions_joined")
def _(spark, sf):
    """F05, F06 by the join plan for feature tables too large to be a constant."""
    at = X0.segments(spark, sf).select(F.col("std_end").alias("position")).distinct()
    features = X0.feature_set(spark, limit=0)
    return features.nearest(features.at(at, "position", "features_at"), "position", "nearest_feature")


@query("f_impact")
def _(spark, sf):
    """F07."""
    return X0.feature_set(spark).impact(_coordinates(spark, sf), "left_breakpoint", "right_breakpoint")


@query("f_arcs")
def _(spark, sf):
    """F08, F09."""
    return FA.with_arc_context(_coordinates(spark, sf), X0.ARCS, L)


@query("f_targets")
def _(spark, sf):
    """F10, F11."""
    return FA.with_known_targets(_coordinates(spark, sf), FA.deletion_targets(spark, X0.KNOWN, X0.SEARCHES, L), L)


@query("f_annotate")
def _(spark, sf):
    """all annotations of the exact clusters."""
    out = X0.annotated(spark, sf)
    return out.select("exact_deletion_id", "left_feature_overlap", "nearest_left_feature", "nearest_right_feature", "affected_feature_label", "feature_impact_class",
                      "size_class", "replication_arc_context", "known_deletion_label", "junction_interpretation", "junction_interpretation_reason")


@query("f_display")
def _(spark, sf):
    """displayed features with the number of events that touch each."""
    shown = FT.display_features(X0.feature_rows(spark), X0.REGIONS, X0.ALIASES)
    hits = X0.feature_set(spark).impact(_coordinates(spark, sf), "left_breakpoint", "right_breakpoint")
    names = hits.select(F.explode(F.split("affected_features", ";")).alias("feature_name")).groupBy("feature_name").agg(F.count(F.lit(1)).alias("events"))
    return shown.join(names, "feature_name", "left")


# ---- tiers ---------------------------------------------------------------------------------


def _graded(spark, sf):
    obs = X0.observed(spark, sf)
    return X0.stage(spark, sf, "graded", lambda: T.grade(X0.annotated(spark, sf), obs, PRM)), obs


@query("t_grade")
def _(spark, sf):
    """T01-T04 over the exact clusters."""
    graded, _ = _graded(spark, sf)
    return rounded(
        graded.select("exact_deletion_id", "distinct_observation_count", "raw_source_record_count", "distinct_read_identifier_count",
                      "distinct_alignment_pattern_count", "support_per_sample", "maximum_support_within_sample", "samples_with_replicated_support",
                      "evidence_sources", "both_caller_supporting_observation_fraction", "evidence_status", "primary_chain_evidence_fraction",
                      "median_min_anchor_length", "median_alignment_error_rate", "worst_alignment_error_rate", "median_query_union_coverage",
                      "adjacent_query_segment_fraction", "complex_alignment_chain_observation_count", "multiple_hypothesis_observation_count",
                      "modal_observed_breakpoint_pair", "maximum_left_breakpoint_deviation_bp", "both_rotation_supporting_observation_count",
                      "microhomology_or_repeat_length", "gene_pair_label", "quality_tier", "quality_tier_reason", "quality_flags")
    )


@query("t_membership")
def _(spark, sf):
    """T06."""
    graded, _ = _graded(spark, sf)
    return T.profile_membership(graded, PRM).drop(*T.KEY)


@query("t_profile")
def _(spark, sf):
    """Observations of the standard profile with their labels."""
    graded, obs = _graded(spark, sf)
    enriched = T.enrich_observations(obs, graded)
    _, kept, _ = T.filter_profile(graded, enriched, T.observation_id_map(enriched), "standard", PRM)
    return kept.select("sample", "read_id", "exact_deletion_id", "quality_tier", "gene_pair_label")


@query("t_summary")
def _(spark, sf):
    """T08."""
    graded, obs = _graded(spark, sf)
    return T.tier_summary(graded, T.enrich_observations(obs, graded))


@query("t_index")
def _(spark, sf):
    """T09."""
    graded, _ = _graded(spark, sf)
    return T.profile_index(T.profile_membership(graded, PRM), PRM)


# ---- matrices and statistics ---------------------------------------------------------------


def _evidence(spark, sf) -> DataFrame:
    """A01, A02 over the exact clusters."""
    graded, obs = _graded(spark, sf)
    return X0.stage(spark, sf, "evidence", lambda: M.evidence_join(obs, graded))


LABELLED = ("sample", *M.LABELS.values(), "deleted_size", "junction_interpretation")


def _labelled(spark, sf) -> DataFrame:
    """The evidence rows with the labels and sizes that counts read; the wide rows are not made for them."""
    if X0.is_staged(spark, sf, "evidence"):
        return _evidence(spark, sf).select(*LABELLED)
    graded, obs = _graded(spark, sf)
    return X0.stage(spark, sf, "labelled", lambda: M.evidence_join(obs, graded).select(*LABELLED))


def _counts(spark, sf):
    sheet = X0.samples(spark, sf)
    kept = M.drop_expected(_labelled(spark, sf), PRM)
    return X0.stage(spark, sf, "counts", lambda: M.normalized(M.label_counts(kept, sheet), sheet)), sheet


@query("a_evidence")
def _(spark, sf):
    """The evidence rows statistics use."""
    kept = M.drop_expected(_evidence(spark, sf), PRM)
    return kept.select("sample", "read_id", "exact_deletion_id", "affected_feature_label", "quality_tier", "left_anchor_length", "deleted_size")


@query("a_counts")
def _(spark, sf):
    """A03, A04 in long form."""
    return rounded(_counts(spark, sf)[0])


@query("a_profile_counts")
def _(spark, sf):
    """A03 of all report profiles in one pass."""
    sheet = X0.samples(spark, sf)
    return M.profile_counts(M.drop_expected(_evidence(spark, sf), PRM), sheet, PRM)


@query("a_alternative")
def _(spark, sf):
    """Every sample with every event."""
    return rounded(M.alternative_matrix(K.id_map(X0.members(spark, sf)), X0.annotated(spark, sf), X0.samples(spark, sf), PRM))


@query("a_wide")
def _(spark, sf):
    """A03 export form of all label kinds, and back."""
    counts, sheet = _counts(spark, sf)
    return V.melt_rows(M.wide_rows(counts, sheet), ["label_kind", "sample"])


@query("a_burden")
def _(spark, sf):
    """A06."""
    counts, sheet = _counts(spark, sf)
    return rounded(M.burden(counts.drop("per_million"), sheet).select("sample", "condition", "deletion_supporting_reads", "deletion_support_per_million_mt_reads", "unique_exact_deletions", "unique_affected_feature_categories"))


@query("a_feature_burden")
def _(spark, sf):
    """A07."""
    sheet = X0.samples(spark, sf)
    out = M.feature_burden(M.drop_expected(_evidence(spark, sf), PRM), sheet)
    return rounded(out.select("sample", "feature", "condition", "supporting_reads", "support_per_million_mt_reads"))


COMPARED = ("label_kind", "label", "left_group", "right_group", "left_mean_per_million_mt_reads", "right_mean_per_million_mt_reads", "difference_per_million_mt_reads",
            "abundance_change", "log2_fold_change_right_over_left", "fold_change_right_over_left", "left_total_supporting_reads", "right_total_supporting_reads",
            "samples_with_signal", "mann_whitney_u", "tie_term")


@query("a_compare")
def _(spark, sf):
    """Every label between all group pairs (p-values are tested apart)."""
    return rounded(_compared(spark, sf).select(*COMPARED))


@query("a_compare_p")
def _(spark, sf):
    """A08-A12 with p- and q-values."""
    return rounded(A.with_q_values(_compared(spark, sf), ["label_kind"]).select("label_kind", "label", "left_group", "right_group", "p_value", "fisher_presence_p", "read_depth_fisher_p", "q_value_bh", "read_depth_fisher_q_value_bh"))


@query("a_adjust")
def _(spark, sf):
    """A12 on given p-values, many of them equal and some missing."""
    li = X0.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    p = (1 + F.col("l_partkey") * 37 % 1000) / F.lit(1000.0)
    rows = li.withColumn("p", F.when(F.col("l_suppkey") % 10 > 0, p))
    out = A.adjust(A.adjust(rows, "p", "q_all"), "p", "q_flag", ["l_returnflag"])
    return rounded(out.groupBy("l_returnflag", "p").agg(F.count(F.lit(1)).alias("n"), F.min("q_all").alias("q_all"), F.max("q_flag").alias("q_flag")), 9)


@query("a_associations")
def _(spark, sf):
    """Coefficients of the burden associations."""
    counts, sheet = _counts(spark, sf)
    out = A.burden_associations(M.burden(counts.drop("per_million"), sheet), ["age", "treatment", "condition"])
    return rounded(out.select("metadata_column", "metadata_type", "outcome", "test", "spearman_rho", "linear_slope", "left_group", "right_group", "left_mean", "right_mean", "mann_whitney_u"))


@query("a_size_tests")
def _(spark, sf):
    """Statistics of the size tests."""
    kept, sheet = M.drop_expected(_evidence(spark, sf), PRM), X0.samples(spark, sf)
    return rounded(A.size_tests(kept, sheet, "condition").drop("p_value", "q_value_bh"))


@query("a_size_metrics")
def _(spark, sf):
    """A16."""
    return rounded(A.sample_size_metrics(M.drop_expected(_evidence(spark, sf), PRM), X0.samples(spark, sf)))


@query("a_size_bins")
def _(spark, sf):
    """A17."""
    return rounded(A.size_bins(M.drop_expected(_evidence(spark, sf), PRM), X0.samples(spark, sf), "condition"))


@query("a_factorial")
def _(spark, sf):
    """Estimates and errors of the two-by-two model."""
    counts, sheet = _counts(spark, sf)
    sizes = A.sample_size_metrics(M.drop_expected(_labelled(spark, sf), PRM), sheet)
    metrics = M.burden(counts.drop("per_million"), sheet).join(sizes, "sample", "left")
    return rounded(A.factorial_model(metrics).drop("p_value", "q_value_bh"), 4)


@query("a_qc")
def _(spark, sf):
    """A19, A20."""
    before, sheet = _evidence(spark, sf), X0.samples(spark, sf)
    counts = M.label_counts(M.drop_expected(before, PRM), sheet)
    ambiguous = X0.observed(spark, sf).filter("direction_status <> 'directed'")
    return rounded(M.qc_summary(sheet, before, ambiguous, M.burden(counts, sheet), PRM))


# ---- views ---------------------------------------------------------------------------------


def _locations(spark, sf) -> DataFrame:
    def build():
        members = X0.members(spark, sf, X0.event_ends(spark, sf)).select("sample", "read_id", "exact_deletion_id", "left_breakpoint", "right_breakpoint", "deleted_size")
        placed = V.representative_coordinates(members, X0.annotated(spark, sf), L)
        return V.location_table(placed, X0.samples(spark, sf), "condition", PRM)

    return X0.stage(spark, sf, "locations", build)


LOCATION = ("plot_group", "exact_deletion_id", "left_breakpoint", "right_breakpoint", "deleted_size", "supporting_reads", "plot_support", "support_rank")


@query("v_locations")
def _(spark, sf):
    """V01-V03."""
    return rounded(_locations(spark, sf).select(*LOCATION, "affected_feature_label", "replication_arc_context"))


@query("v_top_locations")
def _(spark, sf):
    """V02 cut to the best of each group, as a report shows it."""
    p = replace(PRM, view_min_support=0.2, view_max_per_group=40)
    return rounded(V.location_table(X0.members(spark, sf, X0.event_ends(spark, sf)), X0.samples(spark, sf), "treatment", p).select(*LOCATION))


@query("v_density")
def _(spark, sf):
    """V04, V05."""
    return rounded(V.endpoint_density(_locations(spark, sf), PRM))


@query("v_hotspots")
def _(spark, sf):
    """V06."""
    return rounded(V.hotspots(V.endpoint_density(_locations(spark, sf), PRM), PRM), 4)


@query("v_pairs")
def _(spark, sf):
    """V07."""
    return rounded(V.breakpoint_pairs(_locations(spark, sf), L))


@query("v_histogram")
def _(spark, sf):
    """V08."""
    return rounded(V.size_histogram(X0.events(spark, sf), X0.samples(spark, sf), "condition"), 4)


def _category_values(spark, sf) -> DataFrame:
    counts, sheet = _counts(spark, sf)
    placed = counts.join(sheet.select("sample", "condition"), "sample")
    return placed.select("label_kind", F.col("condition").alias("group"), F.col("label").alias("category"), F.col("reads").cast("double").alias("value"))


@query("v_categories")
def _(spark, sf):
    """V09 of all label kinds."""
    return rounded(V.category_totals(_category_values(spark, sf), 14, proportional=True, by="label_kind"))


@query("v_top_features")
def _(spark, sf):
    """V10."""
    burden = M.feature_burden(M.drop_expected(_evidence(spark, sf), PRM), X0.samples(spark, sf))
    return rounded(V.top_features(burden, "condition", X0.feature_rows(spark), 8))


@query("v_recurrence")
def _(spark, sf):
    """V11."""
    counts, sheet = _counts(spark, sf)
    return rounded(V.recurrence(X0.annotated(spark, sf), counts, sheet, "condition"))


@query("v_gram")
def _(spark, sf):
    """The centred sample x sample matrix the components come from."""
    counts, sheet = _counts(spark, sf)
    return rounded(V.centred_gram(counts.filter("label_kind = 'affected'"), sheet.select("sample"), "reads"), 3)


@query("v_bray_curtis")
def _(spark, sf):
    """V13 of all label kinds."""
    counts, sheet = _counts(spark, sf)
    return rounded(V.bray_curtis(counts, sheet.select("sample"), by="label_kind"))


def _compared(spark, sf) -> DataFrame:
    def build():
        counts, sheet = _counts(spark, sf)
        return A.compare_groups(counts, sheet, "condition", PRM, ("label_kind", "label"))

    return X0.stage(spark, sf, "compared", build)


def _ranked(spark, sf) -> DataFrame:
    def build():
        compared = _compared(spark, sf).filter("label_kind = 'exact'").withColumnRenamed("label", "exact_deletion_id")
        placed = A.with_event_columns(compared, X0.annotated(spark, sf), "exact_deletion_id")
        # ranks compare equal sums that were added in another order, so they use rounded differences
        return V.comparison_ranking(placed.withColumn("difference_per_million_mt_reads", F.round("difference_per_million_mt_reads", 6)), X0.ARCS, L)

    return X0.stage(spark, sf, "ranked", build)


@query("v_comparison")
def _(spark, sf):
    """V14, A21."""
    return rounded(
        _ranked(spark, sf).select("exact_deletion_id", "left_group", "right_group", "difference_per_million_mt_reads", "total_supporting_observations", "comparison_rank",
                                  "deleted_size", "replication_arc_context", "minor_arc_deleted_bp")
    )


@query("v_preset")
def _(spark, sf):
    """V17 with effect, observation and direction limits."""
    return rounded(V.comparison_preset(_ranked(spark, sf), "all", 2, 0.05, "right").select("exact_deletion_id", "left_group", "right_group", "difference_per_million_mt_reads"))


@query("v_presets")
def _(spark, sf):
    """The rows that each preset lets through, significance presets too."""
    tested = A.with_q_values(_compared(spark, sf), ["label_kind"]).filter("label_kind = 'exact'").withColumnRenamed("label", "exact_deletion_id")
    placed = A.with_event_columns(tested, X0.annotated(spark, sf), "exact_deletion_id").withColumn("difference_per_million_mt_reads", F.round("difference_per_million_mt_reads", 6))
    ranked = materialize(V.comparison_ranking(placed, X0.ARCS, L), "ranked-tests")
    out = None
    for name in V.PRESETS:
        part = V.comparison_preset(ranked, name).select(F.lit(name).alias("preset"), "exact_deletion_id", "left_group", "right_group")
        out = part if out is None else out.unionByName(part)
    return out


@query("v_chords")
def _(spark, sf):
    """V15."""
    return rounded(V.chord_table(_locations(spark, sf), L).select("plot_group", "exact_deletion_id", "left_angle_degrees_clockwise_from_coordinate_1", "right_angle_degrees_clockwise_from_coordinate_1"))


@query("v_chord_summary")
def _(spark, sf):
    """V15, V16."""
    where = _locations(spark, sf)
    return rounded(V.chord_summary(where).join(V.linked_thresholds(where, 2, 1000, 0.3), "plot_group"))


@query("v_group_order")
def _(spark, sf):
    """V18, W04."""
    sheet = X0.samples(spark, sf)
    return V.group_order(sheet, "condition").join(RP.group_counts(sheet, "condition"), "group")


@query("v_group_means")
def _(spark, sf):
    """Group and cell means of the burden."""
    counts, sheet = _counts(spark, sf)
    burden = M.burden(counts.drop("per_million"), sheet)
    value = "deletion_support_per_million_mt_reads"
    cells = V.group_means(burden, ["age", "treatment"], value)
    return rounded(cells.unionByName(V.group_means(burden, ["treatment"], value), allowMissingColumns=True))


@query("v_scale")
def _(spark, sf):
    """V20."""
    return rounded(V.scale_limits(_locations(spark, sf)))


# ---- report tables -------------------------------------------------------------------------


@query("w_target_ranks")
def _(spark, sf):
    """W01."""
    return RP.target_ranks(X0.annotated(spark, sf))


@query("w_display")
def _(spark, sf):
    """The display table and its position in the default order."""
    shown = RP.display_table(X0.annotated(spark, sf), replace(PRM, table_max_rows=60, table_min_reads=2))
    w = W.partitionBy(F.lit(1)).orderBy(*RP.default_order(shown))
    return shown.select("exact_deletion_id", "known_deletion_label", "total_supporting_reads", "deleted_size", F.row_number().over(w).alias("position"))


@query("w_counters")
def _(spark, sf):
    """W03 counters."""
    clusters = X0.annotated(spark, sf)
    return RP.display_counters(clusters, RP.display_table(clusters, replace(PRM, table_max_rows=60, table_min_reads=2)))


@query("w_composition")
def _(spark, sf):
    """W05."""
    graded, obs = _graded(spark, sf)
    return RP.evidence_composition(graded, obs)


@query("w_checks")
def _(spark, sf):
    """W06."""
    clusters = X0.annotated(spark, sf)
    counts, sheet = _counts(spark, sf)
    return rounded(RP.circular_checks(clusters).join(RP.headline(clusters, M.burden(counts.drop("per_million"), sheet)), F.lit(True)))


# ---- audit ---------------------------------------------------------------------------------


@query("z_checks")
def _(spark, sf):
    """Z01."""
    ev = X0.events(spark, sf)
    wrong = ev.withColumn("deleted_size", F.col("deleted_size") - F.when(X0.orderkey() % 9 == 0, 300).otherwise(0))
    return Z.table_checks({"raw rotated deletion calls": ev, "altered calls": wrong, "merged clusters": X0.exact_clusters(spark, sf)}, L)


@query("z_mismatches")
def _(spark, sf):
    """Z02."""
    assigned = X0.assigned(spark, sf)
    return rounded(Z.read_mismatches(K.member_rows(assigned, K.cluster_table(assigned, PRM.slop, L, PRM.min_support))))


@query("z_mismatch_examples")
def _(spark, sf):
    """The first examples."""
    assigned = X0.assigned(spark, sf)
    return Z.mismatch_examples(K.member_rows(assigned, K.cluster_table(assigned, PRM.slop, L, PRM.min_support)))


@query("z_round_trip")
def _(spark, sf):
    """Z03 over every position in the data."""
    positions = X0.segments(spark, sf).select(F.col("std_end").alias("standard_position")).distinct()
    return Z.round_trip(spark, PRM, positions)


@query("z_recluster")
def _(spark, sf):
    """Z04."""
    return Z.recluster_check(X0.events(spark, sf), PRM)


@query("z_examples")
def _(spark, sf):
    """Z05."""
    ev = X0.events(spark, sf)
    out = Z.worked_examples(ev, X0.members(spark, sf), PRM)
    return out.select("example", "sample", "read_id", "rotation_name", "left_breakpoint", "right_breakpoint", "raw_left_converted_to_standard", "deleted_size", "size_matches")


@query("z_violations")
def _(spark, sf):
    """No row breaks the rules of the view tables, and altered rows are found."""
    where, ranked = _locations(spark, sf), _ranked(spark, sf)
    broken = where.withColumn("plot_support", F.when(F.col("left_breakpoint") % 2 == 0, F.col("plot_support")).otherwise(0.0))
    good = Z.view_violations(where, ranked).select(F.lit("as_is").alias("input"), "table", "exact_deletion_id")
    bad = Z.view_violations(broken, ranked).select(F.lit("altered").alias("input"), "table", "exact_deletion_id")
    return good.unionByName(bad)
