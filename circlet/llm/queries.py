"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from circlet.llm import conversation_repair, exact_dedup, fingerprint, language, license_scan, line_dedup, near_dedup, packing, periodic_runs, pieces, quality, toxicity, warc
from circlet.llm.common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode_documents(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), with_ids=False)
    best, second = F.element_at("scores", 1), F.try_element_at("scores", F.lit(2))
    return coded.select("doc_id", "n_ids", "ids_crc32", best.alias("best_score"), second.alias("second_score"), F.size("scores").alias("n_paths"), "decoded_sha256", "paths")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.convert(table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_report(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), edit=periodic_runs.crc_period)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damaged(rows), rows)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_near_dedup": op3_near_dedup,
    "op4_pieces": op4_pieces,
    "op5_warc": op5_warc,
    "op6_line_dedup": op6_line_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_quality": op8_quality,
    "op9_language": op9_language,
    "op10_fingerprints": op10_fingerprints,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_license_scan": op13_license_scan,
}
