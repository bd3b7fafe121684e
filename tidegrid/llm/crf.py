"""A linear-chain conditional random field with two labels over lines of discrete features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Crf:
    """``emit[f, v, y]``: weight of value ``v`` of feature ``f`` under label ``y``; ``move[y, z]``; ``start[y]``."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def scores(self, lines: np.ndarray) -> np.ndarray:
        """Emission scores of lines, a row of feature values each."""
        return self.emit[np.arange(self.emit.shape[0]), lines].sum(axis=1)


def by_step(lengths: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sequences from longest to shortest, and for each step the rows of all lines there, in that order."""
    order = np.argsort(-lengths, kind="stable")
    first = (np.cumsum(lengths) - lengths)[order]
    alive = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), "left")
    return order, [first[:n] + t for t, n in enumerate(alive)]


def viterbi(model: Crf, lines: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The most probable label of every line; ``lengths`` says how many lines each sequence has."""
    emit = model.scores(lines)
    _, steps = by_step(lengths)
    label = np.zeros(len(lines), np.int8)
    if not steps:
        return label
    best = np.zeros((len(steps[0]), 2))
    back = []
    for t, rows in enumerate(steps):
        n = len(rows)
        if t == 0:
            best[:n] = model.start + emit[rows]
            continue
        paths = best[:n, :, None] + model.move  # from, to
        back.append(paths.argmax(axis=1))
        best[:n] = paths.max(axis=1) + emit[rows]
    last = best.argmax(axis=1)
    for t in range(len(steps) - 1, -1, -1):
        rows = steps[t]
        label[rows] = last[:len(rows)]
        if t:
            n = len(rows)
            last[:n] = back[t - 1][np.arange(n), last[:n]]
    return label


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def gradient(model: Crf, lines: np.ndarray, lengths: np.ndarray, label: np.ndarray) -> tuple[Crf, float]:
    """Of the log likelihood of the labels: observed counts minus expected ones, by forward and backward sums."""
    emit = model.scores(lines)
    _, steps = by_step(lengths)
    alpha, beta = np.zeros((len(lines), 2)), np.zeros((len(lines), 2))
    alpha[steps[0]] = model.start + emit[steps[0]]
    for before, rows in zip(steps, steps[1:]):
        alpha[rows] = _logsum(alpha[before[:len(rows)]][:, :, None] + model.move, 1) + emit[rows]
    for before, rows in zip(steps[-2::-1], steps[:0:-1]):
        beta[before[:len(rows)]] = _logsum(model.move + (emit[rows] + beta[rows])[:, None, :], 2)
    first = steps[0]
    norm = np.zeros(len(lines))
    total = _logsum(alpha[first] + beta[first], 1)
    for rows in steps:
        norm[rows] = total[:len(rows)]
    expected = np.exp(alpha + beta - norm[:, None])
    rest = np.eye(2)[label] - expected
    emit_g = np.zeros_like(model.emit)
    for f in range(model.emit.shape[0]):
        for y in range(2):
            emit_g[f, :, y] = np.bincount(lines[:, f], rest[:, y], model.emit.shape[1])
    move_g = np.zeros((2, 2))
    value = (model.start[label[first]] + emit[first, label[first]]).sum() - total.sum()
    for before, rows in zip(steps, steps[1:]):
        before = before[:len(rows)]
        pair = np.exp(alpha[before][:, :, None] + model.move + (emit[rows] + beta[rows])[:, None, :] - norm[rows][:, None, None])
        move_g -= pair.sum(axis=0)
        np.add.at(move_g, (label[before], label[rows]), 1)
        value += (model.move[label[before], label[rows]] + emit[rows, label[rows]]).sum()
    return Crf(emit_g, move_g, rest[first].sum(axis=0)), float(value)


def fit_crf(lines: np.ndarray, lengths: np.ndarray, label: np.ndarray, values: int, *, steps: int = 120,
            rate: float = 0.1, decay: float = 1e-3) -> Crf:
    """Maximise the likelihood of the labels, less a penalty on large weights, by Adam steps."""
    shapes = [(lines.shape[1], values, 2), (2, 2), (2,)]
    weights = [np.zeros(s) for s in shapes]
    mean, spread = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    for t in range(1, steps + 1):
        g, _ = gradient(Crf(*weights), lines, lengths, label)
        for w, m, v, part in zip(weights, mean, spread, (g.emit, g.move, g.start)):
            part = part / len(lines) - decay * w
            m += 0.1 * (part - m)
            v += 0.001 * (part ** 2 - v)
            w += rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Crf(*weights)
