"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A document is a bag of words; a word weighs its count, short words less. For each of ``samples`` draws every (word,
weight) gets gamma and uniform variables that depend on the word and the draw alone: r, c ~ Gamma(2, 1), b ~ U(0, 1),
t = floor(ln w / r + b), ln y = r (t - b), ln a = ln c - ln y - r. The word with the least a, with its t, is the sample.
Two documents agree on a sample with the probability of their generalised Jaccard similarity (sum of least weights by
sum of greatest). The least a and the sample's name travel packed in one 64-bit number, so a document is summed up by
plain minima in a hash aggregate that map tasks finish alone.

``edit_neighbours`` pairs each document with the next one in descending id: within buckets of consecutive ids by a
window, and across a bucket's end by a join of one row a bucket.

Defined cases: a null or empty text is the one empty word, as is every blank, at the least weight. Equal texts have
equal fingerprints. Rows with equal ids come out once each, in order of their text. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from circlet.llm.common import materialize
from circlet.operators.ranking import numbered

SAMPLES = 32
BUCKET_IDS = 256
FULL_WEIGHT_CHARS = 6
LEAST_WEIGHT = 0.01
_NAME_BITS = 21


def words(text: Column) -> Column:
    return F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " ")


def word_weight(word: Column) -> Column:
    """Grows with the square of the length up to ``FULL_WEIGHT_CHARS``: short words are common ones."""
    share = F.length(word) / F.lit(float(FULL_WEIGHT_CHARS))
    return F.least(F.lit(1.0), F.greatest(F.lit(LEAST_WEIGHT), share * share))


def _uniform(bits: Column, shift: int, width: int) -> Column:
    """A number in (0, 1) from some bits of a hash."""
    return (F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(0.5)) / F.lit(float(1 << width))


def weighted_sample(term: Column, log_weight: Column, draw: int) -> Column:
    """ln a in the upper bits, the name of (term, t) in the lower ones."""
    g, h = F.xxhash64(term, F.lit(2 * draw)), F.xxhash64(term, F.lit(2 * draw + 1))
    r = -F.log(_uniform(g, 0, 21) * _uniform(g, 21, 21))
    b = _uniform(g, 42, 22)
    c = -F.log(_uniform(h, 0, 32) * _uniform(h, 32, 32))
    t = F.floor(log_weight / r + b)
    log_a = F.log(c) - r * (t - b) - r
    rank = F.floor((F.greatest(F.lit(-127.0), F.least(F.lit(127.0), log_a)) + 128.0) * F.lit(float(1 << 34))).cast("bigint")
    name = F.xxhash64(term, F.lit(draw), t).bitwiseAND(F.lit((1 << _NAME_BITS) - 1))
    return F.shiftleft(rank, _NAME_BITS).bitwiseOR(name)


def fingerprints(rows: DataFrame, keys: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``fingerprint`` (an array of sample names). If rows are partitioned by some of the keys, nothing shuffles."""
    exploded = rows.select(*keys, F.explode(words(F.coalesce(F.col(text), F.lit("")))).alias("word"))
    terms = exploded.groupBy(*keys, F.xxhash64("word").alias("term")).agg(F.sum(word_weight(F.col("word"))).alias("weight"))
    logs = terms.select(*keys, "term", F.log("weight").alias("log_weight"))
    least = logs.groupBy(*keys).agg(*[F.min(weighted_sample(F.col("term"), F.col("log_weight"), k)).alias(f"s{k}") for k in range(samples)])
    names = F.array(*[F.col(f"s{k}").bitwiseAND(F.lit((1 << _NAME_BITS) - 1)).cast("int") for k in range(samples)])
    return least.select(*keys, names.alias("fingerprint"))


def as_text(fingerprint: Column) -> Column:
    return F.concat_ws("", F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x.cast("bigint"))), 6, "0")))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(samples))


def _bucket_edges(rows: DataFrame) -> DataFrame:
    """For each bucket the one after it in descending order (after the last the first), with that bucket's greatest id.

    One narrow row a bucket, numbered by ranges, so ids may lie as far apart as they like.
    """
    tops = rows.groupBy("bucket").agg(F.max("doc_id").alias("top_id"))
    ranked = numbered(tops, ["bucket"], "n").select("bucket", "n", F.struct("bucket", "top_id").alias("top"))
    lower = ranked.select((F.col("n") + 1).alias("n"), F.col("top").alias("below"))
    start = ranked.agg(F.max("top").alias("start"))
    chained = ranked.join(lower, "n", "left").crossJoin(F.broadcast(start))  # start is one row
    head = F.coalesce("below", "start")
    return chained.select(F.col("bucket").alias("edge_bucket"), head["bucket"].alias("head_bucket"), head["top_id"].alias("head_id"))


def edit_neighbours(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """bucket, place, doc_id, text, next_id, edited: the last third replaced by the start of the next document.

    The next document is the one with the next smaller id; after the last comes the first. (bucket, place) names a row.
    """
    bucket = F.coalesce(F.floor(F.col(id_column) / BUCKET_IDS), F.lit(-(2**60)))
    rows = docs.select(bucket.alias("bucket"), F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    edges = materialize(_bucket_edges(rows), "bucket-edges")
    heads = rows.join(edges, (F.col("bucket") == F.col("head_bucket")) & F.col("doc_id").eqNullSafe(F.col("head_id")))
    across = heads.groupBy("edge_bucket").agg(F.min(F.struct("text", "doc_id")).alias("head"))
    order = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), "text")
    paired = rows.withColumn("place", F.row_number().over(order)).withColumn("follower", F.lead(F.struct("text", "doc_id")).over(order))
    joined = paired.join(across, F.col("follower").isNull() & (F.col("bucket") == F.col("edge_bucket")), "left")
    after = F.coalesce("follower", "head")
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - third), F.substring(after["text"], F.lit(1), third))
    return joined.select("bucket", "place", "doc_id", "text", after["doc_id"].alias("next_id"), edited.alias("edited"))


def edit_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses."""
    pairs = edit_neighbours(docs, id_column, text_column)
    versions = F.explode(F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("body")), F.struct(F.lit(1).alias("version"), F.col("edited").alias("body"))))
    bodies = pairs.select("bucket", "place", versions.alias("v")).select("bucket", "place", "v.version", "v.body")
    prints = fingerprints(bodies, ["bucket", "place", "version"], "body", samples)
    facts = pairs.select("bucket", "place", "doc_id", "next_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    # one query, so that both halves read the same shuffle of the texts
    both = materialize(prints.unionByName(facts, allowMissingColumns=True), "fingerprints")
    version = F.col("version")
    rows = both.groupBy("bucket", "place").agg(
        F.max("doc_id").alias("doc_id"), F.max("next_id").alias("next_id"), F.max("n_chars").alias("n_chars"), F.max("edited_sha256").alias("edited_sha256"),
        F.max(F.when(version == 0, F.col("fingerprint"))).alias("fingerprint"), F.max(F.when(version == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    rows = materialize(rows, "fingerprint-rows")
    following = rows.groupBy(F.col("doc_id").alias("f_id")).agg(F.min("fingerprint").alias("next_fingerprint"))
    full = rows.join(following, F.col("next_id").eqNullSafe(F.col("f_id")))
    return full.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("fingerprint")).alias("fingerprint"), as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"),
    )
