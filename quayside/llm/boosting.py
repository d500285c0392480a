"""Boosted trees of two levels over small integer features, as numbers and as SQL."""

from __future__ import annotations

import numpy as np

ROUNDS = 24
RATE = 0.4
#: Added to the second derivatives of a leaf, so that leaves of few rows stay near 0.
RIDGE = 1.0


def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray) -> tuple[float, int, int] | None:
    """(gain, feature, threshold) of the best cut of `rows`; ties go to the first."""
    best = None
    for j in range(x.shape[1]):
        v = x[rows, j]
        for t in np.unique(v)[1:].tolist():
            low = v < t
            gl, hl, gr, hr = g[rows][low].sum(), h[rows][low].sum(), g[rows][~low].sum(), h[rows][~low].sum()
            gain = gl * gl / (hl + RIDGE) + gr * gr / (hr + RIDGE) - (gl + gr) ** 2 / (hl + hr + RIDGE)
            if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                best = gain, j, t
    return best


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int):
    found = _split(x, g, h, rows) if depth and len(rows) else None
    if found is None:
        return float(-RATE * g[rows].sum() / (h[rows].sum() + RIDGE))
    _, j, t = found
    low = x[rows, j] < t
    return j, t, _grow(x, g, h, rows[low], depth - 1), _grow(x, g, h, rows[~low], depth - 1)


def predict(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    j, t, low, high = tree
    return np.where(x[:, j] < t, predict(low, x), predict(high, x))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list:
    """Trees whose sum is the log-odds of y = 1, from rows that stand for `weight` equal ones."""
    trees, score = [], np.zeros(len(x))
    for _ in range(ROUNDS if len(x) else 0):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, weight * (p - y), weight * p * (1 - p), np.arange(len(x)), 2)
        trees.append(tree)
        score += predict(tree, x)
    return trees


def threshold(score: np.ndarray, y: np.ndarray, weight: np.ndarray, precision: float) -> float:
    """The least score from which on rows are right with `precision`; infinite if there is none."""
    order = np.argsort(-score, kind="stable")
    right, total = np.cumsum((y * weight)[order]), np.cumsum(weight[order])
    last = np.r_[score[order][1:] != score[order][:-1], True] if len(order) else np.zeros(0, bool)
    good = np.flatnonzero(last & (right >= precision * total) & (right > 0))
    return float(score[order][good[-1]]) if len(good) else float("inf")


def to_sql(trees: list, names: list[str]) -> str:
    def one(tree) -> str:
        if isinstance(tree, float):
            return f"{tree:.6f}D"
        j, t, low, high = tree
        return f"CASE WHEN {names[j]} < {t} THEN {one(low)} ELSE {one(high)} END"

    return " + ".join(f"({one(t)})" for t in trees) or "0D"
