"""A linear classifier of quality: naive Bayes support vectors over byte n-grams.

A text is the set of its hashed byte n-grams of 2 to 4 and runs of repeated words (indicators, scaled to length one). Each indicator is weighted by
the log ratio of its class counts, and a hinge-loss model is fitted to them by dual coordinate descent, on a bounded
sample of labelled rows; a logistic curve through the margins of rows left out of the fit gives scores in (0, 1).

Cases: null and empty texts have no indicators and get the score of the bias alone; without labelled rows, or with one
class only, every score is the share of label 1 smoothed by one row of each class; repeated rows score alike; an empty
table gives an empty table; other columns take no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Buckets of indicators. Labelled rows of the sample, at most, and indicators that they hold together (four bytes each).
BUCKETS, SAMPLE_ROWS, SAMPLE_KEYS = 1 << 18, 6000, 1 << 26
THRESHOLD = 0.7
#: Indicators from which a text has full weight.
EVIDENCE = 512


def fold(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 4; fold 2 is held out of learning."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4))


def echoes(text: str) -> list[int]:
    """Buckets of the runs of up to six words that each repeat the word before: n-grams of the sequence of repetitions."""
    words = text.split()
    run = most = 0
    for same in map(eq, words, words[1:]):
        run = run + 1 if same else 0
        if run > most:
            most = run
    return list(range(BUCKETS - 6, BUCKETS - 6 + min(most, 6)))


def scaled(n: int) -> float:
    """A text of n indicators is scaled to length one; one of fewer than EVIDENCE stays shorter."""
    return 1.0 / float(np.sqrt(max(n, EVIDENCE)))


class Indicators:
    """The distinct buckets of a text's byte n-grams (2 to 4) and of its repetitions; the last six are the latter's."""

    def __init__(self) -> None:
        self.mark = np.zeros(BUCKETS, np.int32)

    def __call__(self, text: str | None) -> np.ndarray:
        b = np.frombuffer((text or "").encode(), np.uint8).astype(np.uint32)
        if len(b) < 2:
            return np.empty(0, np.uint32)
        two = b[:-1] << np.uint32(8) | b[1:]
        three = two[:-1] << np.uint32(8) | b[2:]
        four = three[:-1] << np.uint32(8) | b[3:]
        hashed = [(g * np.uint32(k)) >> np.uint32(14) for g, k in ((two, 0x85EBCA77), (three, 0x9E3779B1), (four, 0xC2B2AE3D))]
        key = np.minimum(np.concatenate(hashed), np.uint32(BUCKETS - 7))
        key = np.concatenate([key, np.array(echoes(text), np.uint32)])
        at = np.arange(len(key), dtype=np.int32)
        self.mark[key] = at
        return key[self.mark[key] == at]


@dataclass
class Model:
    weight: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, keys: np.ndarray) -> float:
        return float(self.weight[keys].sum() * scaled(len(keys)) + self.bias)

    def score(self, keys: np.ndarray) -> float:
        return 1.0 / (1.0 + float(np.exp(-np.clip(self.slope * self.margin(keys) + self.offset, -500, 500))))


def descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; each row is ratio at its keys, scaled to length one by their number."""
    w, bias = np.zeros(BUCKETS), 0.0
    scale = [scaled(len(k)) for k in rows]
    q = np.array([float((ratio[k] ** 2).sum()) * s * s + 1.0 for k, s in zip(rows, scale)])
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            k = rows[i]
            x = ratio[k] * scale[i]
            g = y[i] * (float(w[k] @ x) + bias) - 1.0
            new = min(max(alpha[i] - g / q[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[k] += step * x
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through margins, with smoothed targets, by Newton's method."""
    pos, neg = float((y > 0).sum()), float((y < 0).sum())
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        r, s = p - t, np.maximum(p * (1 - p), 1e-9)
        grad = np.array([r @ margin + 1e-3 * (a - 1), r.sum()])
        hess = np.array([[s @ margin**2 + 1e-3, s @ margin], [s @ margin, s.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return max(a, 1e-3), b


def fitted(rows: list[np.ndarray], labels: np.ndarray, epochs: int = 20, cost: float = 1.0, seed: int = 5, balanced: bool = True) -> Model:
    y = np.where(np.asarray(labels) == 1, 1.0, -1.0)
    pos, neg = int((y > 0).sum()), int((y < 0).sum())
    if not pos or not neg:
        share = (pos + 1) / (pos + neg + 2)
        return Model(np.zeros(BUCKETS), 0.0, 1.0, float(np.log(share / (1 - share))))
    each = np.where(y > 0, cost * len(y) / (2 * pos), cost * len(y) / (2 * neg)) if balanced else np.full(len(y), cost)
    out = np.arange(len(y)) % 5 == 0
    if len({*y[out]}) < 2 or len({*y[~out]}) < 2:
        out = np.zeros(len(y), bool)
    learn = np.flatnonzero(~out)
    # the rows that the curve is fitted to are in no count of the classes either
    p, n = np.ones(BUCKETS), np.ones(BUCKETS)
    for i in learn:
        (p if y[i] > 0 else n)[rows[i]] += 1
    ratio = np.log(p / ((y[learn] > 0).sum() + 2)) - np.log(n / ((y[learn] < 0).sum() + 2))
    w, bias = descent([rows[i] for i in learn], y[learn], ratio, each[learn], epochs, seed)
    weight = w * ratio
    left = np.flatnonzero(out) if out.any() else learn
    model = Model(weight, bias, 1.0, 0.0)
    model.slope, model.offset = curve(np.array([model.margin(rows[i]) for i in left]), y[left])
    return model


def learned(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """The model of a bounded sample of the labelled rows outside fold 2, chosen by the order of a hash."""
    good = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 2))
    good = good.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.max("quality").alias("quality"))
    good = good.orderBy(F.xxhash64("labelled"), "labelled").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def keys(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        for batch in of:
            found = [indicators(t.as_py()).astype(np.int32) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "quality", "keys"])

    sample = texts.join(F.broadcast(good), F.col("doc_id") == F.col("labelled")).select("doc_id", "quality", "text")
    sample = C.written(sample.mapInArrow(keys, "doc_id long, quality int, keys array<int>").dropDuplicates(["doc_id"]))
    size = sample.select("doc_id", F.size("keys").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    fit = np.cumsum(size.column("n").to_numpy()) <= SAMPLE_KEYS
    if not fit.all():  # some 180 MB in all, whatever the length of the texts
        sample = sample.where(F.col("doc_id").isin(size.column("doc_id").to_numpy()[fit].tolist()))
    got = sample.toArrow().sort_by("doc_id")
    found = [np.asarray(k.values.to_numpy(zero_copy_only=False), np.uint32) if k.is_valid else np.empty(0, np.uint32) for k in got.column("keys")]
    return fitted(found, got.column("quality").to_numpy())


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text of docs(doc_id, text); the model (2 MB) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batches(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators, model = Indicators(), shared.value
        for batch in of:
            score = [model.score(indicators(t.as_py())) for t in batch.column("text")]
            held = pa.array([zlib.crc32(str(i if i is not None else "").encode()) % 4 == 2 for i in batch.column("doc_id").to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), held, pa.array(score, pa.float64()), pa.array([int(s >= threshold) for s in score], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(batches, "doc_id long, held_out boolean, score double, predicted int")
