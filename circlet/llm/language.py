"""Language identification by nearest centroids of TF-IDF n-gram vectors.

Texts become counts of lower-cased character pairs and triples, hashed to ``DIMS`` places, damped by a logarithm, weighted
by inverse document frequency and normalised. Document frequencies are counted over all training rows. Each language
gets ``CENTROIDS`` centroids: spherical k-means on a bounded sample starts them, then one pass over all training rows
assigns every row to the nearest centroid of its language and averages. A text takes the language of the centroid with
the greatest cosine. It is marked ``rejected`` if that cosine lies below what all but 1 % of the language's own training
rows reach.

Bounds: ``SAMPLE_ROWS`` rows to start the centroids; everything else covers all rows. What goes to the driver has a fixed
number of places for each language.

Defined cases: a null text or one without a letter is ``und`` with score 0. Training rows without a language or a letter
are left out. Without any training row every text is ``und``. Ties go to the language that sorts first. Rows that
repeat an id are predicted each by themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circlet.llm.common import hash_sample, id_bucket

DIMS = 4096
CENTROIDS = 4
SAMPLE_ROWS = 1500
ROUNDS = 8
BINS = 200
CHUNK = 1 << 18
_LETTER = np.array([chr(i).isalpha() for i in range(1 << 16)])  # beyond the first plane everything counts as a letter


def letters_only(text: str) -> np.ndarray:
    """Code points of the lower-cased text; what is not a letter becomes one space."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = np.where(_LETTER[np.minimum(c, 0xFFFF)], c, np.uint32(32))
    gap = c == 32
    return np.concatenate([c[:1], c[1:][~(gap[1:] & gap[:-1])]])


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed pairs and triples of letters, in pieces of bounded memory."""
    out = np.zeros(DIMS, dtype=np.float64)
    codes = letters_only(text)
    for start in range(0, max(len(codes) - 1, 0), CHUNK):
        c = codes[start : start + CHUNK + 2]
        pair = c[:-1] * np.uint32(2654435761) + c[1:] * np.uint32(2246822519)
        out += np.bincount((pair[:CHUNK] >> np.uint32(8)) % DIMS, minlength=DIMS)
        if len(c) > 2:
            triple = pair[:-1] * np.uint32(3266489917) + c[2:] * np.uint32(668265263)
            out += np.bincount((triple[:CHUNK] >> np.uint32(8)) % DIMS, minlength=DIMS)
    return out


def has_letter(text) -> bool:
    return isinstance(text, str) and any(map(str.isalpha, text))


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(ngram_counts(text)) * idf
    n = np.sqrt(v @ v)
    return v / n if n else v


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray = field(repr=False)  # rows are unit vectors
    owner: np.ndarray = field(repr=False)  # index of the language of each row
    least: np.ndarray = field(default_factory=lambda: np.zeros(0))  # least accepted cosine of each language

    def predict(self, text) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return "und", 0.0, True
        cosines = self.centroids @ vector(text, self.idf)
        best = np.full(len(self.languages), -1.0)
        np.maximum.at(best, self.owner, cosines)
        i = int(np.argmax(best))
        return self.languages[i], float(min(1.0, max(0.0, best[i]))), bool(best[i] < self.least[i])


def _start(vectors: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means; the first centre is the mean, the next are the rows farthest from those before."""
    centres = [vectors.mean(axis=0)]
    for _ in range(min(k, len(vectors)) - 1):
        near = np.max(vectors @ np.array([c / max(np.linalg.norm(c), 1e-12) for c in centres]).T, axis=1)
        centres.append(vectors[int(np.argmin(near))])
    centres = np.array(centres)
    for _ in range(rounds):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        member = np.argmax(vectors @ centres.T, axis=1)
        centres = np.array([vectors[member == j].mean(axis=0) if (member == j).any() else centres[j] for j in range(len(centres))])
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)


def fit(training: DataFrame, sample_rows: int = SAMPLE_ROWS, centroids: int = CENTROIDS) -> LanguageModel:
    """``training`` has doc_id, text and lang; rows without text or language teach nothing."""
    rows = training.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(DIMS, dtype=np.int64), {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                if has_letter(text):
                    df += ngram_counts(text) > 0
                    n[lang] = n.get(lang, 0) + 1
        yield pd.DataFrame({"lang": [None] * DIMS + list(n), "place": [*range(DIMS), *[-1] * len(n)], "n": [*df, *n.values()]})

    counted = rows.mapInPandas(frequencies, "lang string, place int, n bigint").groupBy("lang", "place").agg(F.sum("n").alias("n")).collect()
    counts = {r["lang"]: r["n"] for r in counted if r["place"] < 0}
    languages = sorted(counts)
    df = np.zeros(DIMS)
    for r in counted:
        if r["place"] >= 0:
            df[r["place"]] = r["n"]
    idf = np.log((1 + sum(counts.values())) / (1 + df)) + 0.05
    if not languages:
        return LanguageModel([], idf, np.zeros((0, DIMS)), np.zeros(0, dtype=int))

    each = max(1, sample_rows // len(languages))
    share = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(min(1.0, 1.5 * each / counts[name])))])
    chosen = rows.where(F.pmod(F.xxhash64(F.lit("start"), "doc_id"), F.lit(1 << 30)) < F.try_element_at(share, F.col("lang")) * (1 << 30))
    chosen = hash_sample(chosen, "doc_id", 2 * sample_rows)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [(a, vector(t, idf).astype(np.float32).tobytes()) for a, t in zip(pdf["lang"], pdf["text"]) if has_letter(t)]
            yield pd.DataFrame(keep, columns=["lang", "v"])

    sample = chosen.mapInPandas(vectors, "lang string, v binary").toPandas()
    known = {name: np.array([np.frombuffer(v, np.float32) for v in group]) for name, group in sample.groupby("lang")["v"]}
    languages = [name for name in languages if name in known]
    starts = [_start(known[name].astype(np.float64), centroids, ROUNDS) for name in languages]
    first = LanguageModel(languages, idf, np.concatenate(starts), np.repeat(np.arange(len(languages)), [len(s) for s in starts]))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, bins = np.zeros_like(first.centroids), np.zeros((len(languages), BINS), dtype=np.int64)
        own = {name: np.flatnonzero(first.owner == i) for i, name in enumerate(languages)}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                if lang in own and has_letter(text):
                    v = vector(text, idf)
                    near = first.centroids[own[lang]] @ v
                    sums[own[lang][int(np.argmax(near))]] += v
                    bins[languages.index(lang), min(BINS - 1, max(0, int(near.max() * BINS)))] += 1
        yield pd.DataFrame({"row": [*range(len(sums)), *range(-len(languages), 0)], "v": [[float(x) for x in v] for v in [*sums, *bins]]})

    parts = rows.mapInPandas(assign, "row int, v array<double>").select("row", F.posexplode("v").alias("place", "x"))
    totals = parts.groupBy("row", "place").agg(F.sum("x").alias("x")).toPandas()  # a fixed number of places for each language
    centres, bins = first.centroids.copy(), np.zeros((len(languages), BINS))
    for row, group in totals.groupby("row"):
        target = np.zeros(DIMS if row >= 0 else BINS)
        target[group["place"].to_numpy()] = group["x"].to_numpy()
        if row < 0:
            bins[row + len(languages)] = target
        elif np.linalg.norm(target):
            centres[row] = target / np.linalg.norm(target)
    below = np.cumsum(bins, axis=1) / np.maximum(bins.sum(axis=1, keepdims=True), 1)
    least = np.argmax(below > 0.01, axis=1) / BINS
    return LanguageModel(languages, idf, centres, first.owner, least)


def predict(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [model.predict(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "lang_pred": [o[0] for o in out], "score": [o[1] for o in out], "rejected": [o[2] for o in out]})

    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return narrow.mapInPandas(run, T.StructType([narrow.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]))


def held_out(id_column: str = "doc_id") -> Column:
    return id_bucket(id_column, 3) == 1


def identify(docs: DataFrame) -> DataFrame:
    """Learns from the rows that are not held out and predicts all: doc_id, held_out, lang_pred, score, rejected."""
    model = fit(docs.where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
