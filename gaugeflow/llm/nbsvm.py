"""Text quality by naive Bayes support vectors: scaled n-gram indicators, hinge loss, dual coordinate descent."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHAR_BUCKETS = 1 << 16
SHAPE_BUCKETS = 1 << 13
BUCKETS = CHAR_BUCKETS + SHAPE_BUCKETS
#: Labelled documents that the model is fitted on, the first by a hash of their id.
TRAINING_DOCS = 6000
#: Every fifth of them sets the scale from margin to probability instead.
CALIBRATION = 5
SMOOTHING = 1.0
PENALTY = 1.0
EPOCHS = 20
SEED = 3

_MIX = np.uint32(0x9E3779B1)


def _character_classes() -> np.ndarray:
    """0 other letter, 1 upper case, 2 digit, 3 mark or symbol, 4 white space, by code point."""
    table = np.full(0x10000, 3, np.uint8)
    for i in range(0x10000):
        c = chr(i)
        if c.isupper():
            table[i] = 1
        elif c.isalpha():
            table[i] = 0
        elif c.isdigit():
            table[i] = 2
    table[[32, *range(9, 14)]] = 4
    return table


_CLASSES = _character_classes()


def _grams(codes: np.ndarray, buckets: int, start: int) -> list[np.ndarray]:
    found, joined = [], np.zeros(len(codes), np.uint32)
    for n in range(3):
        if len(codes) <= n:
            break
        joined = (joined[: len(codes) - n] * _MIX) + codes[n:] + np.uint32(n + 1)
        mixed = joined * _MIX
        mixed ^= mixed >> np.uint32(15)
        found.append((mixed * np.uint32(0x85EBCA6B) >> np.uint32(7)) % np.uint32(buckets) + np.uint32(start))
    return found


def _shapes(codes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """A small code for each word: case, symbols, length, and whether it repeats the word before."""
    word = classes != 4
    starts = np.flatnonzero(word & ~np.concatenate(([False], word[:-1])))
    if not len(starts):
        return np.zeros(0, np.uint32)
    sizes = np.add.reduceat(word, starts, dtype=np.int64)
    upper = np.add.reduceat(classes == 1, starts, dtype=np.int64)
    letters = upper + np.add.reduceat(classes == 0, starts, dtype=np.int64)
    symbols = np.add.reduceat(classes == 3, starts, dtype=np.int64)
    bounds = np.concatenate(([0], starts))
    place = (np.arange(len(codes)) - np.repeat(bounds, np.diff(np.append(bounds, len(codes))))).astype(np.uint64)
    odd = place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xC2B2AE3D27D4EB4F)
    tagged = np.where(word, (codes.astype(np.uint64) + np.uint64(1)) * odd, np.uint64(0))
    tagged ^= tagged >> np.uint64(32)
    digest = np.add.reduceat(tagged, starts)
    again = np.concatenate(([False], digest[1:] == digest[:-1]))
    case = np.where(letters == 0, 0, np.where(upper == letters, 3, np.where(upper > 0, 2, 1)))
    return (case + 4 * np.minimum(symbols, 3) + 16 * np.minimum(sizes // 4, 3) + 64 * again).astype(np.uint32)


def indicators(text: str | None) -> np.ndarray:
    """Sorted buckets of the n-grams (1 to 3) of characters and of word shapes that occur in the whole text."""
    codes = np.frombuffer((text or "").encode("utf-32-le"), "<u4").astype(np.uint32)
    if not len(codes):
        return np.zeros(0, np.int32)
    classes = np.where(codes < 0x10000, _CLASSES[np.minimum(codes, 0xFFFF)], 3)
    present = np.zeros(BUCKETS, bool)
    for grams in _grams(codes, CHAR_BUCKETS, 0) + _grams(_shapes(codes, classes), SHAPE_BUCKETS, CHAR_BUCKETS):
        present[grams] = True
    return np.flatnonzero(present).astype(np.int32)


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """ln of the smoothed share of each indicator in class 1 over its share in class 0."""
    shares = []
    for label in (1, 0):
        held = [r for r, y in zip(rows, labels) if y == label]
        counts = SMOOTHING + np.bincount(np.concatenate(held) if held else [], minlength=BUCKETS)
        shares.append(counts / counts.sum())
    return np.log(shares[0] / shares[1])


def dual_descent(rows, values, labels, epochs: int = EPOCHS, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-hinge linear model; both classes weigh the same in total."""
    signs = np.where(labels == 1, 1.0, -1.0)
    box = np.where(labels == 1, 1 / max((labels == 1).sum(), 1), 1 / max((labels == 0).sum(), 1)) * penalty * len(labels) / 2
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(BUCKETS), 0.0
    square = np.array([v @ v + 1 for v in values])
    rng = np.random.default_rng(SEED)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), box[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                alpha[i] = new
                weights[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights, bias


def _scaled(row: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    values = ratios[row]
    return values / max(np.sqrt(values @ values), 1e-12)


def _platt(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through smoothed targets, by Newton steps."""
    positive, negative = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    points = np.stack([margins, np.ones(len(margins))], axis=1)
    found = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(points @ found, -30, 30)))
        hessian = points.T @ (points * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, points.T @ (target - p))
        found = found + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(found[0]), 1e-3), float(found[1])


class Model:
    """Scores a text with one product per indicator; the prior of the labels where there is nothing to learn."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray):
        self.weights, self.bias, self.slope, self.offset = np.zeros(BUCKETS), 0.0, 1.0, 0.0
        self.ratios = np.zeros(BUCKETS)
        if len(set(labels.tolist())) < 2:
            if len(labels):
                self.offset = 2.0 if labels[0] == 1 else -2.0
            return
        part = np.arange(len(rows)) % CALIBRATION == 0
        if len(set(labels[part].tolist())) < 2 or len(set(labels[~part].tolist())) < 2:
            part = np.zeros(len(rows), bool)
        fit = np.flatnonzero(~part)
        self.ratios = log_count_ratios([rows[i] for i in fit], labels[fit])
        values = [_scaled(r, self.ratios) for r in rows]
        self.weights, self.bias = dual_descent([rows[i] for i in fit], [values[i] for i in fit], labels[fit])
        tested = np.flatnonzero(part) if part.any() else fit
        margins = np.array([self.weights[rows[i]] @ values[i] + self.bias for i in tested])
        self.slope, self.offset = _platt(margins, labels[tested])

    def score(self, row: np.ndarray) -> float:
        margin = self.weights[row] @ _scaled(row, self.ratios) + self.bias if len(row) else self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _featured(batches):
    for batch in batches:
        rows = pa.array([indicators(t.as_py()) for t in batch.column(1)], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), rows], ["quality", "row"])


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_DOCS) -> Model:
    """Learns from at most ``limit`` labelled documents whose id is not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        "doc_id is not null and quality in (0, 1)"
    )
    chosen = known.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(limit)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    taken = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")  # at most ``limit`` rows
    one = taken.groupBy("doc_id").agg(F.min(F.struct("text", "quality")).alias("one")).select("one.quality", "one.text", "doc_id")
    rows = (
        one.orderBy(F.xxhash64("doc_id"), "doc_id")
        .select("quality", "text")
        .mapInArrow(_featured, "quality int, row array<int>")
        .toArrow()
    )
    found = [np.asarray(r.values, dtype=np.int32) for r in rows.column("row")]
    return Model(found, np.asarray(rows.column("quality").to_pylist(), dtype=np.int64))


def _scored(batches, model):
    for batch in batches:
        scores = [model.score(indicators(t.as_py())) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])


def classify(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Features are the n-grams of characters and word shapes in the whole text, as indicators scaled by the log-count
    ratio of the classes and brought to unit length. Only labelled documents with crc32(doc_id) mod 3 other than 1
    are learnt from, at most ``limit``; a doc_id with several texts counts once. Null and empty texts have no
    indicator and get the model's bias as margin; without labels of both classes every score is the one
    class's prior, or 0.5. A null doc_id is never held out. Repeated rows repeat; no rows give none.
    """
    model = fit(docs, labels, limit)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(lambda batches: _scored(batches, model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
