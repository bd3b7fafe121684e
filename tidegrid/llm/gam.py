"""A generalised additive model with pairwise interactions, learned by cyclic boosting.

Each feature is cut into bins and has a table with one value a bin; each chosen pair of features
has a table over coarser bins of both. Round by round, every table in turn gets a step of a
shallow tree fitted to what the sum of all tables still misses. The score of a row is the
sum of its table entries, through the logistic function.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np


def bin_edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


@dataclass
class Gam:
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    base: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        total = np.full(len(x), self.base)
        for table, at in zip(self.tables, self.bins(x)):
            total += table[at]
        rough = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.coarse)]
        for (f, g), table in self.pairs.items():
            total += table[rough[f], rough[g]]
        return 1 / (1 + np.exp(-total))


def _split(g: np.ndarray, h: np.ndarray, lo: int, hi: int, ridge: float) -> tuple[float, int]:
    """Gain and place of the best cut of the bins ``lo`` to ``hi``."""
    if hi - lo < 2:
        return 0.0, lo
    a, b = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
    left, right = a[:-1] ** 2 / (b[:-1] + ridge), (a[-1] - a[:-1]) ** 2 / (b[-1] - b[:-1] + ridge)
    gain = left + right - a[-1] ** 2 / (b[-1] + ridge)
    best = int(np.argmax(gain))
    return float(gain[best]), lo + best + 1


def _tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """A tree of depth two over the bins of one feature: a value for each bin."""
    cuts = [0, len(g)]
    for _ in range(2):
        for lo, hi in list(zip(cuts, cuts[1:])):
            gain, at = _split(g, h, lo, hi, ridge)
            if gain > 1e-9:
                cuts.append(at)
        cuts = sorted(set(cuts))
    out = np.zeros(len(g))
    for lo, hi in zip(cuts, cuts[1:]):
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best tree that cuts both features of a pair once: its gain and a value for each cell."""
    a, b = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    gains = np.zeros((max(1, g.shape[0] - 1), max(1, g.shape[1] - 1)))
    parts = []
    if min(g.shape) > 1:
        for c in (a, b):
            q = c[:-1, :-1]
            top, left = c[:-1, -1:] - q, c[-1:, :-1] - q
            parts.append((q, top, left, c[-1, -1] - q - top - left))
        gains = sum(x ** 2 / (y + ridge) for x, y in zip(*parts))
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    out = np.zeros(g.shape)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + ridge)
    return float(gains[i, j]), out


def fit_gam(x: np.ndarray, y: np.ndarray, *, bins: int = 32, coarse_bins: int = 8, rounds: int = 150,
            pair_rounds: int = 60, pairs: int = 8, rate: float = 0.15, ridge: float = 4.0) -> Gam:
    """Learn from rows of features and labels of 0 or 1. Without rows, or with one label only, the base rate remains."""
    d = x.shape[1]
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Gam([bin_edges(x[:, f], bins) if len(x) else np.zeros(0) for f in range(d)],
                [bin_edges(x[:, f], coarse_bins) if len(x) else np.zeros(0) for f in range(d)],
                float(np.log(share / (1 - share))))
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if not len(x) or y.min() == y.max():
        return model
    at = model.bins(x)
    rough = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.coarse)]
    total = np.full(len(x), model.base)

    def missing() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, table in enumerate(model.tables):
            g, h = missing()
            n = len(table)
            step = rate * _tree(np.bincount(at[f], g, n), np.bincount(at[f], h, n), ridge)
            table += step
            total += step[at[f]]

    def cells(f: int, g: int, values: np.ndarray) -> np.ndarray:
        shape = len(model.coarse[f]) + 1, len(model.coarse[g]) + 1
        return np.bincount(rough[f] * shape[1] + rough[g], values, shape[0] * shape[1]).reshape(shape)

    g, h = missing()
    gains = {(f, k): _quadrants(cells(f, k, g), cells(f, k, h), ridge)[0] for f, k in combinations(range(d), 2)}
    for pair in sorted(gains, key=gains.get, reverse=True)[:pairs]:
        model.pairs[pair] = np.zeros((len(model.coarse[pair[0]]) + 1, len(model.coarse[pair[1]]) + 1))
    for _ in range(pair_rounds):
        for (f, k), table in model.pairs.items():
            g, h = missing()
            step = rate * _quadrants(cells(f, k, g), cells(f, k, h), ridge)[1]
            table += step
            total += step[rough[f], rough[k]]
    return model
