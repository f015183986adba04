"""Literal motif search over reads, and its overlap with called events."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circlet.durable import materialize
from circlet.functions import reads as R
from circlet.functions import seeds as SD
from circlet.operators.targets import search_targets  # noqa: F401

MOTIF_SCHEMA = (
    "deletion_id string, deletion_name string, search_strategy string, group_no int, variant_no int,"
    " sequence_id string, orientation string, pattern string"
)
MULTI = "multi_sequence_required"


def motif_rows(searches: Iterable[Mapping]) -> list[tuple]:
    """Pattern variants in configured order: forward, then the reverse complement if it differs.

    With the multi strategy every sequence is a group of its own; any other strategy has one group.
    """
    rows = []
    for search in searches:
        strategy = (search.get("search_strategy") or {}).get("type", "single_sequence")
        group = variant = 0
        for item in search.get("search_sequences") or []:
            forward = str(item.get("sequence", "")).strip().upper()
            reverse = str(item.get("reverse_complement", "")).strip().upper()
            variants = [("forward", forward)] if forward else []
            variants += [("reverse_complement", reverse)] if reverse and reverse != forward else []
            for orientation, pattern in variants:
                rows.append((str(search.get("id", "")), str(search.get("name", "")), strategy, group, variant,
                             str(item.get("id", "sequence")), orientation, pattern))
                variant += 1
            group += bool(variants) and strategy == MULTI
    return rows


def motif_table(spark: SparkSession, searches: Iterable[Mapping]) -> DataFrame:
    return spark.createDataFrame(motif_rows(searches), MOTIF_SCHEMA)


def find_motifs(reads: DataFrame, motifs: DataFrame) -> DataFrame:
    """Reads in which every group of a motif has a matching variant.

    ``reads``: sample, read_id, mate, record_no, seq. One plan for any number of patterns: each pattern is looked for by
    its rarest seed, a stretch of at most 32 characters, and confirmed where the seed stands in a read. A read's hashes
    are rolled over its text in one pass, so the cost is that of the texts plus the places of the seeds. Empty
    patterns match nothing.
    """
    motifs = motifs.filter("pattern <> ''")
    key = ["sample", "read_id", "mate", "record_no"]
    text = reads.select(F.struct(*key).alias("_read"), F.coalesce(F.upper("seq"), F.lit("")).alias("_seq"))
    matched = matching_patterns(text, motifs.select("pattern").distinct())
    found = matched.join(motifs, "pattern").select("_read.*", *[c for c in motifs.columns if c not in key])
    per_group = found.groupBy(*key, "deletion_id", "deletion_name", "search_strategy", "group_no").agg(
        F.min(F.struct("variant_no", "sequence_id", "orientation")).alias("best")
    )
    groups = motifs.groupBy("deletion_id").agg(F.count_distinct("group_no").alias("_groups"))
    hits = per_group.groupBy(*key, "deletion_id", "deletion_name", "search_strategy").agg(
        F.array_sort(F.collect_list(F.struct("group_no", "best"))).alias("_m")
    )
    complete = hits.join(groups, "deletion_id").filter(F.size("_m") == F.col("_groups"))
    return complete.select(
        *key, "deletion_id", "deletion_name", "search_strategy",
        F.array_join(F.transform("_m", lambda m: m["best"]["sequence_id"]), ",").alias("matched_sequence_ids"),
        F.array_join(F.transform("_m", lambda m: m["best"]["orientation"]), ",").alias("matched_orientation"),
    )


def matching_patterns(text: DataFrame, patterns: DataFrame) -> DataFrame:
    """(_read, pattern) for every pattern that occurs in a read; ``text``: _read, _seq; ``patterns`` are distinct.

    First pass: every stretch of a pattern that has the longest seed length fitting into it is counted in the reads, and
    the rarest is its seed. A pattern with a seed that occurs nowhere is out. Second pass: places of the chosen
    seeds. What goes to the tasks is a bitmap of a fixed 8 MB; a false positive there finds no partner in the join.
    """
    offered = materialize(_pattern_seeds(patterns), "motif-seeds")
    classes = sorted(r[0] for r in offered.select("class").distinct().collect())  # at most six
    counts = _count_seeds(text, classes, _filter_bits(offered)).groupBy("hash").agg(F.sum("n").alias("n"))
    rarest = F.min(F.struct("n", "offset", "hash")).alias("best")
    chosen = offered.join(counts, "hash", "left").na.fill(0, ["n"]).groupBy("pattern").agg(rarest).filter("best.n > 0")
    seeds = materialize(chosen.select("pattern", F.col("best.offset").alias("offset"), F.col("best.hash").alias("hash")), "motif-chosen")
    places = _seed_places(text, classes, _filter_bits(seeds))
    tried = places.join(seeds, "hash").withColumn("starts", F.filter(F.transform("places", lambda p: p - F.col("offset")), lambda p: p >= 0)).drop("places", "hash", "offset")
    there = F.exists("starts", lambda p: F.col("_seq").substr(p + 1, F.length("pattern")) == F.col("pattern"))
    return tried.join(text, "_read").filter(there).select("_read", "pattern").distinct()


def _pattern_seeds(patterns: DataFrame) -> DataFrame:
    """pattern, class, offset, hash of every possible seed."""

    def run(batches):
        for batch in batches:
            for pattern in batch.column(0).to_pylist():
                k = SD.seed_class(len(pattern))
                h = next(h for c, h in SD.rolled(pattern) if c == k).view(np.int64)
                n = len(h)
                yield pa.RecordBatch.from_arrays([pa.array([pattern] * n), pa.array([k] * n, pa.int32()), pa.array(np.arange(n, dtype=np.int32)), pa.array(h)], names=["pattern", "class", "offset", "hash"])

    return patterns.mapInArrow(run, "pattern string, class int, offset int, hash long")


def _filter_bits(seeds: DataFrame) -> np.ndarray:
    at = F.shiftrightunsigned("hash", 64 - SD.FILTER_BITS)
    blocks = seeds.select(at.alias("at")).groupBy(F.shiftright("at", 15).alias("block")).agg(F.bitmap_construct_agg(F.col("at") % 32768).alias("bits"))
    return SD.filter_of([(r["block"], bytes(r["bits"])) for r in blocks.collect()])  # at most 2,048 bitmaps


def _count_seeds(text: DataFrame, classes: list[int], bits: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [np.zeros(0, dtype=np.uint64)]
            for seq in batch.column(0).to_pylist():
                found += [h[SD.wanted(h, bits)] for k, h in SD.rolled(seq) if k in classes]
            hashes, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))], names=["hash", "n"])

    return text.select("_seq").mapInArrow(run, "hash long, n long")


def _seed_places(text: DataFrame, classes: list[int], bits: np.ndarray) -> DataFrame:
    """_read, hash, places (from 0) of the wanted seeds of every read."""

    def run(batches):
        for batch in batches:
            rows, hashes, places = [], [], []
            for i, seq in enumerate(batch.column(1).to_pylist()):
                for k, h in SD.rolled(seq):
                    if k in classes:
                        at = SD.wanted(h, bits)
                        order = np.argsort(h[at], kind="stable")
                        some, first = np.unique(h[at][order], return_index=True)
                        cuts = [*first.tolist(), len(at)]
                        for j, value in enumerate(some.view(np.int64).tolist()):
                            rows.append(i)
                            hashes.append(value)
                            places.append(at[order[cuts[j] : cuts[j + 1]]])
            keys = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(hashes, pa.int64()), pa.array(places, pa.list_(pa.int32()))], names=["_read", "hash", "places"])

    schema = T.StructType([text.schema["_read"], T.StructField("hash", T.LongType()), T.StructField("places", T.ArrayType(T.IntegerType()))])
    return text.select("_read", "_seq").mapInArrow(run, schema)


def motif_summary(hits: DataFrame, reads: DataFrame, motifs: DataFrame, samples: DataFrame) -> DataFrame:
    """Every (sample, motif) with matching reads per million examined; zero rows are kept.

    Reads examined: the selected-read count, else the fragment count, else the scanned first mates.
    """
    names = motifs.select("deletion_id", "deletion_name", "search_strategy").distinct()
    scanned = reads.filter(F.col("mate") == "R1").groupBy("sample").agg(F.count(F.lit(1)).alias("_scanned"))
    known = F.coalesce("mt_evidence_reads", "fragments", F.lit(0))
    examined = samples.join(scanned, "sample", "left").withColumn(
        "reads_examined", F.coalesce(F.nullif(known, F.lit(0)), F.col("_scanned"), F.lit(0)).cast("long")
    )
    counts = hits.groupBy("sample", "deletion_id").agg(F.count(F.lit(1)).alias("matching_reads"))
    # sample sheet x motif list: both configured, and every pair is a result row
    every = examined.select("sample", "reads_examined").join(names, F.lit(True))
    out = every.join(counts, ["sample", "deletion_id"], "left").withColumn("matching_reads", F.coalesce("matching_reads", F.lit(0)))
    rate = F.coalesce(F.col("matching_reads") / F.nullif("reads_examined", F.lit(0)) * 1_000_000.0, F.lit(0.0))
    return out.withColumn("matching_reads_per_million_examined", rate)


def near_search_target(events: DataFrame, targets: DataFrame) -> DataFrame:
    """Events within *linear* tolerance of a search target, directly or the other way round.

    ``targets`` is as long as the configuration, so it is one array beside every event.
    """
    listed = targets.agg(F.collect_list(F.struct(*targets.columns)).alias("_targets"))

    def fits(t):
        def ends(a, b):
            near = [F.abs(F.col(f"{side}_breakpoint") - t[f"target_{other}_breakpoint"]) <= t["breakpoint_tolerance_bp"] for side, other in (("left", a), ("right", b))]
            return near[0] & near[1]

        return (ends("left", "right") | ends("right", "left")) & (F.abs(F.col("deleted_size") - t["target_deleted_size"]) <= t["size_tolerance_bp"])

    met = events.join(F.broadcast(listed), F.lit(True))
    return met.withColumn("_t", F.explode(F.filter("_targets", fits))).withColumn("deletion_id", F.col("_t.deletion_id")).drop("_t", "_targets")


def _keyed(hits: DataFrame, events: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    known = F.broadcast(targets.select("deletion_id"))
    searched = hits.join(known, "deletion_id", "left_semi").withColumn("read_key", R.name_key("read_id")).filter("read_key <> ''")
    groups = searched.select("sample", "deletion_id").distinct()
    remap = near_search_target(events, targets).withColumn("read_key", R.name_key("read_id")).filter("read_key <> ''")
    return searched, remap.join(groups, ["sample", "deletion_id"], "left_semi")


def search_overlap(hits: DataFrame, events: DataFrame, targets: DataFrame) -> DataFrame:
    """Per (sample, search) reads found by motif, by event, by both; only searches with hits have a row."""
    searched, remap = _keyed(hits, events, targets)
    key = ["sample", "deletion_id", "read_key"]
    a = searched.select(*key).distinct().withColumn("in_search", F.lit(True))
    b = remap.groupBy(*key).agg(F.lit(True).alias("in_remap"), F.collect_set("exact_deletion_id").alias("_ids"))
    both = a.join(b, key, "full_outer")
    s, r = F.col("in_search").isNotNull(), F.col("in_remap").isNotNull()
    per = both.groupBy("sample", "deletion_id").agg(
        F.count_if(s).alias("sequence_search_reads"), F.count_if(r).alias("remap_nearby_reads"),
        F.count_if(s & r).alias("shared_reads"), F.count_if(s & ~r).alias("sequence_only_reads"),
        F.count_if(~s & r).alias("remap_only_reads"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("_ids")))).alias("_ids"),
    )

    def part(total):
        return F.coalesce(F.col("shared_reads") / F.nullif(total, F.lit(0)), F.lit(0.0))

    return per.join(F.broadcast(targets.drop("matched_configured_target_label")), "deletion_id").withColumns(
        {
            "overlap_fraction_of_sequence_search": part("sequence_search_reads"),
            "overlap_fraction_of_remap_nearby": part("remap_nearby_reads"),
            "matched_remap_exact_deletions": F.array_join(F.slice("_ids", 1, 20), ";"),
        }
    ).drop("_ids")


def read_sets(hits: DataFrame, events: DataFrame, targets: DataFrame) -> DataFrame:
    """The reads of all five sets as rows (set_name, source, sample, deletion_id, read_key, ...)."""
    searched, remap = _keyed(hits, events, targets)
    key = ["sample", "deletion_id", "read_key"]
    none = F.lit(None).cast("string").alias("exact_deletion_id")
    s = searched.select(*key, "read_id", none).distinct()
    r = remap.select(*key, "read_id", "exact_deletion_id").distinct()
    sk, rk = s.select(*key).distinct(), r.select(*key).distinct()

    def named(df, name, source):
        return df.select(F.lit(name).alias("set_name"), F.lit(source).alias("source"), *key, "read_id", "exact_deletion_id")

    shared = s.join(rk, key, "left_semi").unionByName(r.join(sk, key, "left_semi"))
    parts = [
        named(s, "sequence_search_reads", "sequence_search"),
        named(r, "remap_nearby_reads", "remap_near_target"),
        named(shared, "shared_reads", "both"),
        named(s.join(rk, key, "left_anti"), "sequence_only_reads", "sequence_search"),
        named(r.join(sk, key, "left_anti"), "remap_only_reads", "remap_near_target"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
