"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` code points. Each passage is encoded (pairs of character classes and word
statistics, then a learned layer); a gated attention layer, learned from document labels only, weighs the passages, and
the weighted sum is scored. A bad passage can so condemn a document, and the attention tells which one did it.

Bound: ``TRAIN_ROWS`` labelled rows, chosen by a hash of the id, are learned from on the driver (their passages are a few
hundred bytes each); every text is scored whole, in the tasks.

Defined cases: a null or empty text is one empty passage. Without training rows of both labels every score is the share of
label 1 (0 without rows). An id labelled twice takes the smaller label. Rows that repeat an id are scored each by
themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circlet.llm.common import id_bucket, labelled_sample, replace_text

PASSAGE = 512
TRAIN_ROWS = 4000
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 40, 128, 4e-3, 1e-4
CLASSES = 8
WORD_FEATURES = 6
INPUTS = CLASSES * CLASSES + WORD_FEATURES


def _class_of(i: int) -> int:
    c = chr(i)
    if c.isalpha():
        return 1 if c.isupper() else 0
    if c.isdigit():
        return 2
    if c == "\n":
        return 4
    if c.isspace():
        return 3
    if c in ".,;:'-":
        return 5
    return 6 if i < 128 else 7


_CLASS = np.array([_class_of(i) for i in range(1 << 16)], dtype=np.int64)


def passages(text: str) -> np.ndarray:
    """One row of inputs for every passage of a text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = max(1, -(-len(codes) // PASSAGE))
    out = np.zeros((n, INPUTS))
    if not len(codes):
        return out
    kind = _CLASS[np.minimum(codes, 0xFFFF)]
    at = np.arange(len(codes)) // PASSAGE
    pair = at[1:] * CLASSES * CLASSES + kind[:-1] * CLASSES + kind[1:]
    size = np.bincount(at, minlength=n)[:, None]
    out[:, : CLASSES * CLASSES] = np.sqrt(np.bincount(pair, minlength=n * CLASSES * CLASSES).reshape(n, -1) / size)
    for i in range(n):
        words = text[i * PASSAGE : (i + 1) * PASSAGE].split()
        if words:
            k, lengths = len(words), [len(w) for w in words]
            again = sum(a == b for a, b in zip(words, words[1:]))
            out[i, CLASSES * CLASSES :] = (len(set(words)) / k, again / k, sum(lengths) / k / 10, max(lengths) / PASSAGE, np.log1p(k) / 5, sum(x <= 3 for x in lengths) / k)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class QualityModel:
    """Weights of encoder, attention and score; without weights every document scores ``prior``."""

    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Passages of several documents one after another; ``starts`` are the first rows of each."""
        w = self.weights
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ w["encode"] + w["encode_bias"])
        t, s = np.tanh(h @ w["look"]), _sigmoid(h @ w["gate"])
        e = (t * s) @ w["attend"]
        sizes = np.diff(np.append(starts, len(x)))
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "sizes": sizes, "p": _sigmoid(z @ w["score"] + w["score_bias"])}

    def score(self, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        bags = [passages(t) for t in texts]
        starts = np.cumsum([0, *(len(b) for b in bags)])[:-1]
        return self.forward(np.concatenate(bags), starts)["p"] if bags else np.zeros(0)


def learn(bags: list[np.ndarray], labels: np.ndarray, seed: int = 11) -> QualityModel:
    """Adam on the log loss of the documents; gradients run through the attention."""
    prior = float(labels.mean()) if len(labels) else 0.0
    if not 0 < prior < 1:
        return QualityModel(prior)
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    shapes = {"encode": (INPUTS, HIDDEN), "encode_bias": (HIDDEN,), "look": (HIDDEN, GATE), "gate": (HIDDEN, GATE), "attend": (GATE,), "score": (HIDDEN,), "score_bias": (1,)}
    w = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) * ("bias" not in k) for k, s in shapes.items()}
    model = QualityModel(prior, every.mean(axis=0), every.std(axis=0) + 1e-3, w)
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            starts = np.cumsum([0, *(len(bags[i]) for i in chosen)])[:-1]
            f = model.forward(np.concatenate([bags[i] for i in chosen]), starts)
            delta = (f["p"] - labels[chosen]) / len(chosen)
            dz = np.repeat(delta, f["sizes"])[:, None] * w["score"]
            da = (dz * f["h"]).sum(axis=1)
            de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), f["sizes"]))
            dts = de[:, None] * w["attend"]
            dt, ds = dts * f["s"] * (1 - f["t"] ** 2), dts * f["t"] * f["s"] * (1 - f["s"])
            dh = (f["a"][:, None] * dz + dt @ w["look"].T + ds @ w["gate"].T) * (1 - f["h"] ** 2)
            gradient = {
                "encode": f["x"].T @ dh, "encode_bias": dh.sum(axis=0), "look": f["h"].T @ dt, "gate": f["h"].T @ ds,
                "attend": (f["t"] * f["s"]).T @ de, "score": f["z"].T @ delta, "score_bias": delta.sum(keepdims=True),
            }
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k, g in gradient.items():
                g = g + DECAY * w[k] * ("bias" not in k)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit(sample: DataFrame) -> QualityModel:
    """``sample``: doc_id, label and text of a bounded number of rows; their passages are encoded in the tasks."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"], "bag": [passages(t).astype(np.float32).tobytes() for t in pdf["text"]]})

    rows = sample.mapInPandas(encode, T.StructType([sample.schema["doc_id"], T.StructField("label", T.IntegerType()), T.StructField("bag", T.BinaryType())])).toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    bags = [np.frombuffer(b, np.float32).reshape(-1, INPUTS).astype(np.float64) for b in rows["bag"]]
    return learn(bags, rows["label"].to_numpy(dtype=np.float64))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Replaces ``text`` (not null) by ``score``."""
    def scores(texts: list[str]) -> list[float]:
        return [x for i in range(0, len(texts), 256) for x in model.score(texts[i : i + 256]).tolist()]

    return replace_text(docs, "score", T.DoubleType(), scores)


def held_out(id_column: str = "doc_id") -> Column:
    return id_bucket(id_column, 3) == 1


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> QualityModel:
    return fit(labelled_sample(docs, labels, "quality", ~held_out(), rows))


def quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), train(docs, labels, rows))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
