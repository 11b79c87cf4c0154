"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct buckets of its words, word pairs, word triples, and pairs with one
or two words between. Each coordinate has its own learning rate and an L1 penalty, so most weights
are exactly zero and the model is a short list of buckets, small enough to broadcast. It is fitted on
a bounded sample of labelled texts; scoring reads every text whole, in one pass without a shuffle.

Defined results: null and empty texts have no features and score by the intercept; several labels of
one text count as toxic if any of them is 1; null labels do not count; without labelled texts every
score is 0.5. Repeated rows give repeated results. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.textblocks import bound_batches, hash_words, lean, mix, words_of
from rivulet.session import share

BITS = 22
#: Bounds of the fitting sample: texts per class, characters of a text.
PER_CLASS, MAX_CHARS = 2_500, 100_000
#: Distances between the words of a feature; () is a single word.
SHAPES = ((), (1,), (1, 1), (2,), (3,))


@dataclass(frozen=True)
class ToxicityModel:
    """Non-zero weights by bucket (sorted), and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.buckets] = self.weights
        return out


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of every occurrence, one shape after the other."""
    words, token, text = words_of(texts)
    h = hash_words(words)[token]
    for number, gaps in enumerate(SHAPES):
        reach = sum(gaps)
        n = len(h) - reach
        if n <= 0:
            continue
        x, at = mix(h[:n] + np.uint64(number)), 0
        for gap in gaps:
            at += gap
            x = mix(x * np.uint64(31) + h[at:at + n])
        inside = text[:n] == text[reach:reach + n]
        yield (x[inside] >> np.uint64(64 - BITS)).astype(np.int64), text[:n][inside]


def train(texts: list[str], labels: list[int], *, alpha: float = 1.0, beta: float = 1.0, l1: float = 15.0, l2: float = 0.1,
          steps: int = 14_000, seed: int = 7) -> ToxicityModel:
    """FTRL-proximal, one text at a time, in shuffled orders fixed by ``seed``, for about ``steps`` texts.

    The rarer class weighs as much as the other one in total.
    """
    size = 1 << BITS
    z, n = np.zeros(size + 1, np.float32), np.zeros(size + 1, np.float32)  # the last coordinate is the intercept
    rng = np.random.default_rng(seed)
    rows: list[np.ndarray] = []
    for i in range(0, len(texts), 256):
        part = pa.array(texts[i:i + 256], pa.large_string())
        key = np.unique(np.concatenate([t * size + b for b, t in features(part)] or [np.empty(0, np.int64)]))
        cut = np.searchsorted(key, np.arange(len(part) + 1) * size)
        rows += [np.append(key[a:b] % size, size) for a, b in zip(cut, cut[1:])]

    def weights(ids: np.ndarray) -> np.ndarray:
        zi, ni = z[ids], n[ids]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
        w[np.abs(zi) <= l1] = 0
        if len(ids) and ids[-1] == size:  # the intercept has no penalty
            w[-1] = -zi[-1] / ((beta + np.sqrt(ni[-1])) / alpha)
        return w

    ones = sum(labels)
    weight = [len(labels) / (2 * max(1, len(labels) - ones)), len(labels) / (2 * max(1, ones))]
    for _ in range(max(2, round(steps / max(1, len(rows))))):
        for i in rng.permutation(len(rows)):
            ids = rows[i]
            w = weights(ids)
            g = 1 / (1 + np.exp(-min(30.0, max(-30.0, float(w.sum()))))) - labels[i]
            g *= weight[labels[i]]
            sigma = (np.sqrt(n[ids] + g * g) - np.sqrt(n[ids])) / alpha
            z[ids] += g - sigma * w
            n[ids] += g * g
    full = weights(np.arange(size + 1))
    kept = np.flatnonzero(full[:size])
    return ToxicityModel(kept, full[kept], float(full[size]))


def fitting_sample(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_class: int = PER_CLASS) -> DataFrame:
    """(key, text, label): about ``per_class`` labelled texts of each class, chosen by a hash of the key."""
    marks = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("_label"))
    counts = {r["_label"]: r["count"] for r in marks.groupBy("_label").count().collect()}
    share = F.lit(0)
    for value, count in counts.items():
        share = F.when(F.col("_label") == value, min(1_000_000, 1 + per_class * 1_000_000 // count)).otherwise(share)
    chosen = marks.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < share).limit(4 * per_class)
    texts = documents.where(F.col(text).isNotNull() & (F.length(text) <= MAX_CHARS)).select(key, F.col(text).alias("text"))
    return texts.join(F.broadcast(chosen), key).select(key, "text", F.col("_label").alias("label")).limit(8 * per_class)


def fit(documents: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", **options) -> ToxicityModel:
    """Train on a bounded sample of the labelled rows of ``documents``."""
    rows = sorted((r["text"], r["label"]) for r in fitting_sample(documents, labels, key, text, label).collect())
    return train([r[0] for r in rows], [r[1] for r in rows], **options)


def scores(model: ToxicityModel, dense: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Probability of label 1 for every text."""
    hit = [np.empty(0, np.int64)]
    for bucket, text in features(texts):
        live = dense[bucket] != 0
        hit.append(text[live] * (1 << BITS) + bucket[live])
    key = np.unique(np.concatenate(hit))
    total = np.bincount(key >> BITS, weights=dense[key & ((1 << BITS) - 1)], minlength=len(texts)) + model.bias
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def predict(documents: DataFrame, model: ToxicityModel, *, text: str = "text", prefix: str = "toxic_") -> DataFrame:
    """``documents`` with prefix + score and predicted; columns of these names are replaced."""
    spark = documents.sparkSession
    bound_batches(spark)
    shared = share(spark, model)
    names = [f"{prefix}score", f"{prefix}predicted"]
    source = documents.drop(*names)
    kept = source.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        dense = model.dense()
        for batch in batches:
            p = scores(model, dense, batch.column(text)) if batch.num_rows else np.empty(0)
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(p, pa.float64()), pa.array(p >= 0.5).cast(pa.int32())], [*[f.name for f in kept], *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return source.mapInArrow(lean(run), f"{fields}, {names[0]} double, {names[1]} int")
