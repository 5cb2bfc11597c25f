"""Bounded samples of labelled rows, and linear models in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import _text

#: Hashed n-gram buckets of the word features.
WORD_BUCKETS = 1 << 18
_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True


def sample_keys(rows: DataFrame, key: str, label: str, each: int) -> DataFrame:
    """About ``each`` rows of every label (all, where it has fewer), chosen by a hash of the key: the same at every run.

    The labels' counts are one small row each; the sample has about ``each`` times the labels.
    """
    counts = {r[0]: r[1] for r in rows.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    if not counts:
        return rows.where(F.lit(False))
    share = F.lit(0.0)
    for value, n in sorted(counts.items(), key=str):
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, each / n))).otherwise(share)
    place = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(F.col(label).isNotNull() & (place < share))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, weights: np.ndarray | None = None) -> np.ndarray:
    """Weights of a logistic model by Newton's steps (the last one is the intercept, not penalised)."""
    x = np.hstack((x, np.ones((len(x), 1))))
    w = np.zeros(x.shape[1])
    v = np.ones(len(y)) if weights is None else weights
    penalty = np.full(len(w), l2 * v.sum())
    penalty[-1] = 1e-9 * v.sum() + 1e-9
    for _ in range(25):
        p = sigmoid(x @ w)
        gradient = x.T @ (v * (p - y)) + penalty * w
        hessian = (x * (v * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    return w


def word_features(data: np.ndarray, at: np.ndarray, prefixes: tuple[int, ...] = (5, 7, 9)) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket), distinct and in order: each word of letters and its first bytes, hashed."""
    starts, ends = _text.word_spans(data, at, _LETTERS)
    owner = np.searchsorted(at, starts, side="right") - 1
    found = [_text.span_hashes(data, starts, ends)]
    owners = [owner]
    for k in prefixes:
        longer = ends - starts > k
        found.append(_text.mix(_text.span_hashes(data, starts[longer], starts[longer] + k) + np.uint64(k)))
        owners.append(owner[longer])
    keys = np.concatenate(owners).astype(np.uint64) << np.uint64(18) | np.concatenate(found) >> np.uint64(46)
    keys = np.unique(keys)
    return (keys >> np.uint64(18)).astype(np.int64), (keys & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)
