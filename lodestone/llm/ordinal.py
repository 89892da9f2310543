"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text's words and their shapes are hashed into buckets; one weight a bucket, shared by all grades,
gives a score s. Ordered thresholds cut it: P(grade > k) = sigmoid(s - threshold k). The expected
grade is the sum of these, and the tail probability is that of the highest grade; both columns
select documents. Thresholds are kept in order by learning their gaps' logarithms.

The model is fitted on a bounded sample of rated rows, FIT_ROWS at most, the least by hash of
doc_id; its weights have a fixed size and are broadcast. Every document is scored, in one pass
without a shuffle. A null or blank text has no features, and its score is 0. Repeated rows score
alike; of a doc_id rated twice the lower rating counts. With no rated rows every weight is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Memo

BUCKET_BITS = 18
FIT_ROWS = 8_000
EPOCHS = 12
KEEP_FROM = 0.5


def shape(word: str) -> str:
    """Kinds of characters in a word, each run once: `Aa.` for a sentence's only word."""
    kinds = ["A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word[:40]]
    return "".join(k for i, k in enumerate(kinds) if not i or kinds[i - 1] != k)


def _buckets(word: bytes) -> bytes:
    text = word.decode("utf-8", "replace")
    low = text.strip(".,;:!?\"'()[]").lower()
    names = (f"w {low}", f"s {shape(text)}")
    return np.array([xxhash.xxh64_intdigest(x) >> (64 - BUCKET_BITS) for x in names], "<u4").tobytes()


BUCKETS = Memo(_buckets, 250_000)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values): damped counts, scaled to unit length."""
    words = text.split()
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    ids, counts = np.unique(np.frombuffer(b"".join(map(BUCKETS.__getitem__, words)), "<u4"), return_counts=True)
    values = 1.0 + np.log(counts)
    return ids.astype(np.int64), (values / np.sqrt((values**2).sum())).astype(np.float32)


class Model:
    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def score(self, text: bytes) -> float:
        ids, values = features(text)
        return float(self.weights[ids] @ values) if len(ids) else 0.0

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for every k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], grades: int, epochs: int = EPOCHS, rate: float = 0.5, decay: float = 1e-6, seed: int = 7) -> Model:
    """Adaptive gradient steps on the cumulative-link likelihood, in batches."""
    weights, steps = np.zeros(1 << BUCKET_BITS), np.full(1 << BUCKET_BITS, 1e-6)
    cuts, cut_steps = np.concatenate([[-1.0], np.zeros(grades - 2)]), np.full(grades - 1, 1e-6)
    rng = np.random.default_rng(seed)

    def thresholds() -> np.ndarray:
        return cuts[0] + np.concatenate([[0.0], np.cumsum(np.exp(cuts[1:]))])

    order = np.arange(len(rows))
    for _ in range(epochs):
        rng.shuffle(order)
        for start in range(0, len(order), 64):
            batch = [rows[i] for i in order[start : start + 64]]
            y = np.array([b[0] for b in batch])
            size = np.array([len(b[1]) for b in batch])
            ids, values = np.concatenate([b[1] for b in batch]), np.concatenate([b[2] for b in batch])
            at = np.repeat(np.arange(len(batch)), size)
            s = np.bincount(at, weights[ids] * values, len(batch))
            t = np.concatenate([[-np.inf], thresholds(), [np.inf]])
            sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
            high, low = sigmoid(t[y + 1] - s), sigmoid(t[y] - s)
            p = np.maximum(high - low, 1e-9)
            dh, dl = high * (1 - high) / p, low * (1 - low) / p
            ds = -(dh - dl)  # of the log-likelihood
            np_grad = np.bincount(ids, ds[at] * values, len(weights)) if len(ids) else np.zeros(len(weights))
            touched = np.unique(ids)
            g = np_grad[touched] - decay * weights[touched]
            steps[touched] += g * g
            weights[touched] += rate * g / np.sqrt(steps[touched])
            dt = np.array([(dh[y == k]).sum() - (dl[y == k + 1]).sum() for k in range(grades - 1)])
            gc = np.concatenate([[dt.sum()], np.exp(cuts[1:]) * np.cumsum(dt[::-1])[::-1][1:]])
            cut_steps[:] += gc * gc
            cuts[:] += 0.1 * gc / np.sqrt(cut_steps)
    return Model(weights.astype(np.float32), thresholds())


def rated(labels: DataFrame) -> DataFrame:
    """The ratings of the labels' two marks: 0 bad, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.cast("int").alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, key: str = "doc_id", text: str = "text", grades: int = 3, fit_rows: int = FIT_ROWS) -> Model:
    sample = ratings.where(F.col(key).isNotNull() & F.col("grade").isNotNull()).groupBy(F.col(key).cast("long").alias("_id")).agg(F.min("grade").alias("grade"))
    sample = sample.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(x.as_py() or b"") for x in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([i.astype("<u4").tobytes() for i, _ in found], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())], names=["id", "grade", "ids", "values"])

    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    # The sample is bounded by fit_rows, so it is broadcast and the texts are not shuffled.
    picked = texts.join(F.broadcast(sample), F.col("id") == F.col("_id")).select("id", "text", "grade").mapInArrow(run, "id bigint, grade int, ids binary, values binary")
    rows = sorted(picked.collect(), key=lambda r: (r.id, r.ids, r.values))
    return fit([(r.grade, np.frombuffer(r.ids, "<u4").astype(np.int64), np.frombuffer(r.values, "<f4")) for r in rows], grades)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """key, expected_grade, tail_probability and kept of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            above = m.above(np.array([m.score(x.as_py() or b"") for x in batch.column(1).cast(pa.binary())]).reshape(-1))
            expected, tail = np.round(above.sum(axis=1), 6), np.round(above[:, -1], 6)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(expected, pa.float64()), pa.array(tail, pa.float64()), pa.array(tail >= keep_from)], names=[key, "expected_grade", "tail_probability", "kept"])

    return docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text)).mapInArrow(run, f"{key} bigint, expected_grade double, tail_probability double, kept boolean")
