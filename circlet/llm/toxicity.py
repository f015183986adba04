"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of a seed lexicon and of word stems learned from the training labels, how near their hits
stand to the second person, capitals, punctuation, and rates of obfuscation (digits or signs for letters, spaced-out or
stretched words). The trees learn from three quarters of the training rows, the isotonic curve from the rest. Stems are
learned on one half of the rows at a time and counted in the other, so the trees see honest densities.

Bound: ``TRAIN_ROWS`` labelled rows, chosen by a hash of the id; every text is scored whole.

Defined cases: a null text is empty and gets the score that its features (all zero) get. Without training rows of both
labels every score is the share of label 1 (0 without rows). An id labelled twice takes the smaller label. Rows that
repeat an id are scored each by themselves.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circlet.llm.common import id_bucket, labelled_sample, materialize, replace_text

TRAIN_ROWS = 12_000
TREES, DEPTH = 20, 3
STEMS = 300
STEM_MIN, STEM_MAX = 3, 8
STEM_EVIDENCE = 20.0
NEAR_WORDS = 4

# fixed values: common English insults, and second-person words of a few languages
SEED = frozenset(
    "idiot idiots moron morons stupid dumb loser losers scum pathetic trash garbage worthless disgusting clown fool imbecile "
    "cretin vermin filth filthy scumbag lowlife dumbass jerk creep ugly hate kill die shut shit fuck fucking bitch bastard asshole damn".split()
)
SECOND_PERSON = frozenset("you your yours youre yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros tus".split())
LEET = str.maketrans("0134578@$!|+", "oleastbasilt")

_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"(?<!\S)(?=\S*[^\W\d_])(?=\S*[^\W\d_][\d@$!|+*]+[^\W\d_])\S+")
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_][ .\-*_]){3,}[^\W\d_](?!\S)")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
FEATURES = (
    "seed_density", "seed_hits", "stem_density", "stem_hits", "stem_weight", "near_second_person", "second_person_density", "obfuscated_hits",
    "capitals", "capital_words", "exclamations", "questions", "punctuation", "obfuscation", "stretched", "log_words", "mean_length",
)


def stems_of(words: set[str]) -> set[str]:
    """Whole words and the beginnings of longer ones (marked by ``*``)."""
    out = set(words)
    for w in words:
        out.update(w[:n] + "*" for n in range(STEM_MIN, min(len(w), STEM_MAX + 1)))
    return out


def features(text: str, stems: dict[str, float]) -> list[float]:
    """The dense features; ``stems`` maps words and beginnings to their log odds."""
    words = _WORD.findall(text.lower())
    n = max(1, len(words))
    openings = {s[:STEM_MIN] for s in stems}
    seed_at = [i for i, w in enumerate(words) if w in SEED]
    stem_at, weight = [], 0.0
    for i, w in enumerate(words):
        if w[:STEM_MIN] in openings:
            found = [stems[k] for k in (w, *(w[:j] + "*" for j in range(STEM_MIN, min(len(w), STEM_MAX + 1)))) if k in stems]
            if found:
                stem_at.append(i)
                weight += max(found)
    hits = sorted({*seed_at, *stem_at})
    person = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near, j = 0, 0
    for i in hits:
        while j < len(person) and person[j] < i - NEAR_WORDS:
            j += 1
        near += j < len(person) and person[j] <= i + NEAR_WORDS
    mixed = _MIXED.findall(text) if any(c in text for c in "0134578@$!|+*") else []
    plain = [re.sub(r"[^\w]", "", m.lower().translate(LEET)) for m in mixed]
    plain += [re.sub(r"[\W_]", "", m.lower()) for m in _SPACED.findall(text)]
    hidden = sum(p in SEED or any(p[:k] + "*" in stems for k in range(STEM_MIN, STEM_MAX + 1)) for p in plain)
    size = max(1, len(text))
    letters = max(1, sum(map(len, words)))
    capitals = sum(map(str.isupper, text)) if not text.islower() else 0
    tokens = text.split()
    loud = sum(len(t) > 1 and t.isupper() for t in tokens)
    marks = len(text) - sum(map(len, words)) - sum(map(text.count, " \n\t\r"))
    return [
        len(seed_at) / n, math.log1p(len(seed_at)), len(stem_at) / n, math.log1p(len(stem_at)), weight / n, near / n, len(person) / n, math.log1p(hidden),
        capitals / letters, loud / max(1, len(tokens)), text.count("!") / size, text.count("?") / size, marks / size, len(plain) / n,
        sum(1 for _ in _STRETCHED.finditer(text)) / n, math.log1p(len(words)), sum(map(len, words)) / n,
    ]


def learn_stems(sample: DataFrame, limit: int = STEMS) -> dict[str, float]:
    """The stems that tell label 1 best, by log-likelihood ratio, with their log odds; ``sample`` is bounded."""

    @F.pandas_udf("array<string>")
    def stems(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(stems_of(set(_WORD.findall(t.lower())))) for t in texts], dtype=object)

    size = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return {}
    counted = sample.select("label", F.explode(stems("text")).alias("stem")).groupBy("stem").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).where("a >= 3")
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    odds = F.log((a + 0.5) / (n1 + 1)) - F.log((b + 0.5) / (n0 + 1))
    share = (a + b) / (n1 + n0)
    evidence = 2 * (a * F.log(a / (n1 * share)) + F.when(b > 0, b * F.log(b / (n0 * share))).otherwise(0.0))
    best = counted.select("stem", odds.alias("odds"), evidence.alias("evidence")).where((F.col("odds") > 2.0) & (F.col("evidence") > STEM_EVIDENCE))
    return {r["stem"]: r["odds"] for r in best.orderBy(F.desc("evidence"), "stem").limit(limit).collect()}


def with_features(rows: DataFrame, stems: dict[str, float]) -> DataFrame:
    """Replaces ``text`` (not null) by ``features``."""
    return replace_text(rows, "features", T.ArrayType(T.DoubleType()), lambda texts: [features(t, stems) for t in texts])


class ToxicityModel:
    """Stems, trees and curve; ``prior`` alone if the labels taught nothing."""

    def __init__(self, stems: dict[str, float], prior: float, trees=None, curve=None):
        self.stems, self.prior, self.trees, self.curve = stems, prior, trees, curve

    def _raw(self, rows: DataFrame) -> DataFrame:
        vectors = rows.withColumn("vector", array_to_vector("features"))
        return self.trees.transform(vectors).withColumn("raw", vector_to_array("probability")[1])

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` with text (not null): the other columns and ``score``."""
        names = [c for c in rows.columns if c != "text"]
        if self.trees is None:
            return rows.select(*names, F.lit(self.prior).alias("score"))
        curved = self.curve.transform(self._raw(with_features(rows, self.stems)))
        return curved.select(*names, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated"))).alias("score"))


def fit(sample: DataFrame) -> ToxicityModel:
    """``sample``: doc_id, label and text of a bounded number of rows."""
    sample = materialize(sample, "toxicity-sample")
    size = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if min(n1, n0) < 4:
        return ToxicityModel({}, n1 / max(1, n1 + n0))
    part = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))
    halves = [sample.where(part == k) for k in (0, 1)]
    learned = [learn_stems(h) for h in halves]
    honest = with_features(halves[1], learned[0]).unionByName(with_features(halves[0], learned[1]))
    rows = materialize(honest, "toxicity-features").coalesce(4)
    model = ToxicityModel(learn_stems(sample), n1 / (n1 + n0))
    held = F.pmod(F.xxhash64(F.lit("curve"), "doc_id"), F.lit(4)) == 0
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=64)
    grown = rows.where(~held)
    if grown.select("label").distinct().count() < 2:
        grown = rows
    model.trees = trees.fit(grown.withColumn("vector", array_to_vector("features")))
    curve_rows = model._raw(rows.where(held))
    if curve_rows.select("label").distinct().count() < 2:
        curve_rows = model._raw(rows)
    model.curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(curve_rows.select("raw", F.col("label").cast("double").alias("label")))
    return model


def held_out(id_column: str = "doc_id") -> Column:
    return id_bucket(id_column, 5) == 0


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> ToxicityModel:
    return fit(labelled_sample(docs, labels, "toxic", ~held_out(), rows))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = train(docs, labels, rows).score(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
