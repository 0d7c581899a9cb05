"""Quality of a text by a support vector machine on naive Bayes features.

A text becomes a set of n-gram indicators: word unigrams and bigrams, n-grams of word shapes, and a few
indicators of repetition and length.  Each indicator is scaled by its log-count ratio between the classes,
and a linear hinge-loss model is fitted to the scaled rows by dual coordinate descent.  A logistic curve on
the margins turns them into scores.

The model is fitted on a bounded sample (``TRAIN_ROWS`` labelled documents); every document is scored
over its whole text.

Defined cases: a null or empty text has only the indicators of an empty text and is scored like any other;
without labels of both classes all scores are the share of label 1 (0.5 without labels); rows that
repeat get equal scores.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, functions as F

from statcube.llm.common import fold
from statcube.llm.learning import labelled_sample, logistic, scored
from statcube.llm.wordhash import mixed, windows, word_hashes

TRAIN_ROWS = 6000
FOLDS, HELD_FOLD = 3, 1
BUCKETS = 1 << 18
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
SEED = 11

# Classes of bytes for shapes: letters of either case, other letters, digits; the rest stands for itself.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("A"):ord("Z") + 1] = ord("A")
_SHAPE[ord("a"):ord("z") + 1] = ord("a")
_SHAPE[ord("0"):ord("9") + 1] = ord("0")
_SHAPE[128:] = ord("a")


def shape_of(data: bytes) -> bytes:
    """The text with runs of one class written as one character (white space stays)."""
    shape = _SHAPE[np.frombuffer(data, np.uint8)]
    keep = np.ones(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    return shape[keep].tobytes()


def _told(name: int, value: int) -> np.uint64:
    return mixed(np.array([name * 1_000_003 + value], np.uint64))[0]


def indicators(text: str) -> np.ndarray:
    """Distinct hashes of the indicators of a text."""
    data = text.encode()
    words, shapes = word_hashes(data), word_hashes(shape_of(data))
    n = len(words)
    fives = windows(words, 5)
    repeated = 1 - len(np.unique(fives)) / len(fives) if len(fives) else 0.0
    lines = [s for s in data.split(b"\n") if s.strip()]
    dup_lines = 1 - len(set(lines)) / len(lines) if lines else 0.0
    parts = [
        mixed(words + np.uint64(1)), windows(words, 2, first=2), mixed(shapes + np.uint64(2)), windows(shapes, 2, first=8),
        windows(shapes, 3, first=12),
        np.array([_told(1, int(20 * repeated)), _told(2, n.bit_length()), _told(3, int(10 * dup_lines)),
                  _told(4, round(len(data) / n) if n else 0)], np.uint64),
    ]
    return np.unique(np.concatenate(parts))


def buckets(hashes: np.ndarray) -> np.ndarray:
    return np.unique((hashes >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int64)


def log_count_ratios(labels: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """log(p / |p|) - log(q / |q|) of the smoothed counts of each bucket in both classes."""
    counts = [
        SMOOTHING + np.bincount(np.concatenate([r for r, y in zip(rows, labels) if y == side] or [np.zeros(0, np.int64)]), minlength=BUCKETS)
        for side in (1, 0)]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def descend(labels: np.ndarray, rows: list[np.ndarray], ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model by dual coordinate descent; rows are scaled to length 1.

    Both classes get the same total cost.
    """
    rng = np.random.Generator(np.random.PCG64(SEED))
    sides = np.where(labels > 0, 1.0, -1.0)
    share = np.where(labels > 0, (labels > 0).mean(), (labels <= 0).mean())
    limit = COST * 0.5 / share
    values = [ratios[r] / max(1e-9, float(np.linalg.norm(ratios[r]))) for r in rows]
    weights, bias, dual = np.zeros(BUCKETS), 0.0, np.zeros(len(rows))
    norms = np.array([float(v @ v) + 1.0 for v in values])
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            r, v, y = rows[i], values[i], sides[i]
            gradient = y * (weights[r] @ v + bias) - 1.0
            new = min(max(dual[i] - gradient / norms[i], 0.0), limit[i])
            if new != dual[i]:
                step = (new - dual[i]) * y
                weights[r] += step * v
                bias += step
                dual[i] = new
    return weights, bias


def calibrated(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the margins, by Newton steps."""
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = logistic(slope * margins + offset)
        w = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((p - labels) * margins).sum() + 1e-3 * slope, (p - labels).sum()])
        h = np.array([[(w * margins * margins).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-9]])
        slope, offset = np.array([slope, offset]) - np.linalg.solve(h, g)
    return float(slope), float(offset)


def fit(labels: np.ndarray, hashes: list[np.ndarray]) -> Callable[[str], float]:
    """A scoring function of texts."""
    if not len(labels) or labels.min() == labels.max():
        constant = float(labels.mean()) if len(labels) else 0.5
        return lambda text: constant
    rows = [buckets(h) for h in hashes]
    ratios = log_count_ratios(labels, rows)
    weights, bias = descend(labels, rows, ratios)
    margins = np.array([weights[r] @ ratios[r] / max(1e-9, float(np.linalg.norm(ratios[r]))) + bias for r in rows])
    slope, offset = calibrated(margins, labels)
    w, r = weights.astype(np.float32), ratios.astype(np.float32)

    def score(text: str) -> float:
        b = buckets(indicators(text))
        scale = r[b].astype(np.float64)
        margin = float(w[b].astype(np.float64) @ scale) / max(1e-9, float(np.linalg.norm(scale))) + bias
        return float(logistic(np.float64(slope * margin + offset)))

    return score


def score_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.  Fits the model when called."""
    held = fold(F.col("doc_id"), FOLDS) == HELD_FOLD
    return scored(docs, fit(*labelled_sample(docs, labels, "quality", ~held, train_rows, indicators)), held)
