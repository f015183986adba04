"""Near-duplicate documents: circulant MinHash, banding, exact verification, components.

1. One pass over the texts makes for each document its set of five-word shingles, a 128-bit name of the set, and band
   keys of a circulant MinHash signature (``shingles.py``). ``BANDS`` bands of ``ROWS`` coordinates miss a pair of
   similarity 0.85 with a probability below 1e-7, and one of similarity 0.8 with about 1.5e-5.
2. Documents with equal sets are one class; only its smallest id goes on, so copies never meet each other.
3. In every bucket the class with the most company leads, and the others are checked against it on full sets. What does
   not link to a leader gets a second leader among its like. A bucket of n classes so costs n checks, not n squared.
4. Pairs that could still link, inside a leader's family but in different components, are searched in blocks of
   ``BLOCK`` classes with an exact upper bound of the intersection (sums of least bucket counts of the two sets, and the
   triangle inequality over the leader). Only survivors become rows; they are checked on full sets. No pair is dropped.
5. Components of all links, by star steps; the smallest id of a component stays.

A link takes a Jaccard similarity of ``similar`` percent or more: 85 is the contract of op3_near_dedup, other callers give
their own. Below 80 the bands would miss more than the figures above say.

Defined cases: a null text, an empty one or one of blanks has no shingles, links with nothing and stays. A row with a
null id links with nothing and stays. Rows that repeat an id are one document each with the same result. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from circlet.llm.common import HEAVY_SHARE, lean_worker, materialize, small_batches
from circlet.llm.components import components
from circlet.llm.shingles import band_keys, circulant_signature, set_digest, shingle_set

ROWS, BANDS = 5, 28
LEADER_PAIRS = 2048  # pairs of one leader that stay together
SIMILAR = 85  # percent, of op3_near_dedup
PLACES = 256  # of the counts that bound intersections
BLOCK = 256


def sketches(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, n_shingles, set_key, bands of every row with an id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lean_worker()
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                s = shingle_set(text)
                a, b = set_digest(s)
                bands = band_keys(circulant_signature(s, ROWS * BANDS), ROWS) if len(s) else []
                rows.append((doc_id, len(s), a.to_bytes(8, "little", signed=True) + b.to_bytes(8, "little", signed=True), bands))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "set_key", "bands"])

    texts = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return texts.mapInPandas(run, "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>")


def full_sets(docs: DataFrame, company: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """rep, company, n, shingles (sorted hashes) and counts of the documents that ``company`` (rep, company) names."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lean_worker()
        for pdf in batches:
            rows = []
            for rep, near, text in zip(pdf["rep"], pdf["company"], pdf["text"]):
                s = shingle_set(text)
                counts = np.minimum(np.bincount((s % np.uint64(PLACES)).astype(np.int64), minlength=PLACES), 0xFFFF).astype("<u2")
                rows.append((rep, near, len(s), s.view(np.int64), counts.tobytes()))
                if len(rows) == 500:
                    yield pd.DataFrame(rows, columns=["rep", "company", "n", "shingles", "counts"])
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["rep", "company", "n", "shingles", "counts"])

    texts = docs.select(F.col(id_column).cast("bigint").alias("rep"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    named = texts.join(company.hint("shuffle_hash"), "rep").select("rep", "company", "text")
    return named.mapInPandas(run, "rep bigint, company bigint, n bigint, shingles array<bigint>, counts binary")


def check_pairs(pairs: DataFrame, sets: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """a, b, both (size of the intersection), na, nb, linked for pairs (a, b), on full sets; company and counts of b.

    Leaders of a thousandth of the pairs or more are at most a thousand. Their pairs spread over salts, and
    their one set row is repeated for each.
    """
    pairs = materialize(pairs.select("a", "b"), "near-pairs")
    share = max(LEADER_PAIRS, pairs.count() // HEAVY_SHARE)
    large = F.broadcast(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share).select("a", F.ceil(F.col("n") / share).alias("salts")))
    salt = F.coalesce(F.pmod(F.xxhash64("b"), F.col("salts")), F.lit(0).cast("bigint"))
    right = pairs.join(large, "a", "left").select("a", "b", salt.alias("salt")).join(sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("set_b"), "company", "counts"), "b")
    leaders = sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("set_a")).join(large, "a", "left")
    every = F.sequence(F.lit(0).cast("bigint"), F.coalesce("salts", F.lit(1).cast("bigint")) - 1)
    met = right.join(leaders.select("a", "na", "set_a", F.explode(every).alias("salt")), ["a", "salt"])
    checked = met.select("a", "b", "na", "nb", "company", "counts", F.size(F.array_intersect("set_a", "set_b")).cast("bigint").alias("both"))
    return checked.withColumn("linked", 100 * F.col("both") >= similar * (F.col("na") + F.col("nb") - F.col("both")))


def _could_fit(n1, n2, similar: int):
    return 100 * F.least(n1, n2) >= similar * F.greatest(n1, n2)


def _search_blocks(batches: Iterator[pd.DataFrame], similar: int) -> Iterator[pd.DataFrame]:
    """Pairs of two blocks of a family that may link and are not known to be connected."""
    for pdf in batches:
        for ours, theirs in zip(pdf["ours"], pdf["theirs"]):
            def unpack(block):
                ids, n, comp, near = (np.array([m[k] for m in block]) for k in ("b", "nb", "root", "near"))
                return ids, n, comp, near, np.array([np.frombuffer(m["counts"], "<u2") for m in block]).astype(np.int32)

            ids, n, comp, near, counts = unpack(theirs)
            found = []
            for i, size, root, close, own in zip(*unpack(ours)):
                fits = (comp != root) & (ids != i) & (100 * np.minimum(n, size) >= similar * np.maximum(n, size))
                fits &= np.abs(near - close) <= 1 - similar / 100 + 1e-9
                at = np.flatnonzero(fits)
                if len(at):
                    most = np.minimum(counts[at], own).sum(axis=1)
                    at = at[((100 + similar) * most >= similar * (n[at] + size)) | (own.max() == 0xFFFF)]
                found += [(min(i, j), max(i, j)) for j in ids[at]]
            if found:
                yield pd.DataFrame(sorted(set(found)), columns=["a", "b"])


def remaining_pairs(first: DataFrame, second: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """Pairs inside a leader's family, not both linked to one leader, that may link: blocks against blocks."""
    hers = second.where("linked").groupBy("b").agg(F.min("a").alias("second_lead"))
    known = first.join(hers, "b", "left").withColumn("root", F.when(F.col("linked"), F.col("a")).otherwise(F.coalesce("second_lead", "b")))
    near = 1 - F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))
    families = first.groupBy("a").agg(F.count(F.lit(1)).alias("size"), F.count_if(~F.col("linked")).alias("left_over")).where("left_over > 0 and size > 1")
    full = known.withColumn("near", near).join(families, "a")
    block = F.pmod(F.xxhash64("b"), F.ceil(F.col("size") / BLOCK))
    member = F.struct("b", "nb", "root", "near", "counts")
    blocks = full.groupBy("a", block.alias("block")).agg(F.collect_list(member).alias("theirs"), F.collect_list(F.when(~F.col("linked"), member)).alias("ours"))
    met = blocks.where(F.size("ours") > 0).select("a", "ours").join(blocks.select("a", "theirs"), "a").select("ours", "theirs")
    return met.mapInPandas(partial(_search_blocks, similar=similar), "a bigint, b bigint").distinct()


def near_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similar: int = SIMILAR) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document; links take a similarity of ``similar`` percent."""
    with small_batches(docs.sparkSession):
        return _near_groups(docs, id_column, text_column, similar)


def _near_groups(docs: DataFrame, id_column: str, text_column: str, similar: int) -> DataFrame:
    sketch = materialize(sketches(docs, id_column, text_column), "near-sketches")
    filled = sketch.where("n_shingles > 0")
    classes = materialize(filled.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "near-classes")
    reps = filled.join(classes.withColumnRenamed("set_key", "class_key"), (F.col("set_key") == F.col("class_key")) & (F.col("doc_id") == F.col("rep")))
    members = materialize(reps.select("rep", F.explode("bands").alias("key")), "near-bands")
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = materialize(members.join(buckets, "key").select("rep", "key", "n"), "near-members")
    company = materialize(met.groupBy("rep").agg(F.sum("n").alias("company")), "near-company")
    ranked = met.select("rep", "key").join(company, "rep")
    leads = ranked.groupBy("key").agg(F.max(F.struct("company", (-F.col("rep")).alias("minus")))["minus"].alias("minus")).select("key", (-F.col("minus")).alias("a"))
    stars = materialize(ranked.select(F.col("rep").alias("b"), "key").join(leads, "key").where("a <> b").select("a", "b").distinct(), "near-stars")
    sets = materialize(full_sets(docs, company, id_column, text_column), "near-sets")
    first = materialize(check_pairs(stars, sets, similar), "near-first")
    # a second leader for what did not link to the first
    loose = first.where(~F.col("linked")).select("a", "b", "nb", "company")
    top = F.max(F.struct("company", (-F.col("b")).alias("minus"), F.col("nb").alias("n_lead"))).alias("top")
    seconds = loose.groupBy("a").agg(top, F.count(F.lit(1)).alias("n")).where("n > 1").select("a", (-F.col("top.minus")).alias("lead"), "top.n_lead")
    again = loose.join(seconds, "a").where((F.col("b") != F.col("lead")) & _could_fit(F.col("nb"), F.col("n_lead"), similar)).select(F.col("lead").alias("a"), "b").distinct()
    second = materialize(check_pairs(again, sets, similar), "near-second")
    third = materialize(check_pairs(remaining_pairs(first, second, similar), sets, similar), "near-third")
    roots = components(first.unionByName(second).unionByName(third).where("linked").select("a", "b"))
    roots = classes.join(roots, F.col("rep") == F.col("node"), "left").select("set_key", F.coalesce("root", "rep").alias("component_id"))
    grouped = filled.select("doc_id", "n_shingles", "set_key").join(roots, "set_key").select("doc_id", "n_shingles", "component_id")
    alone = sketch.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    nameless = docs.where(F.col(id_column).isNull()).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("n_shingles"), F.lit(None).cast("bigint").alias("component_id"))
    return grouped.unionByName(alone).unionByName(nameless).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similar: int = SIMILAR) -> DataFrame:
    """Whole rows of the documents that stay: one of each component, and every row without shingles or id."""
    gone = near_groups(docs, id_column, text_column, similar).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    rows = docs.select(F.col(id_column).cast("bigint").alias("row_id"), F.struct("*").alias("row"))
    return rows.join(gone.hint("shuffle_hash"), F.col("row_id") == F.col("gone_id"), "left_anti").select("row.*")
