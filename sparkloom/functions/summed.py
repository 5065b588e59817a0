"""Sums of distances over weighted rows, without forming all pairs where there are few dimensions."""

from __future__ import annotations

import math

import numpy as np

from sparkloom.functions.distance import block_distances, quick_distances

TILE = 512
FEW_DIMS = 3
# Rows of a cell; the error that the number of nodes allows a distance at most (measured: a thousandth of it and less in the sums); most nodes.
CELL, ERROR, MOST_NODES = 1024, 1e-9, 40


def summed_distances(x: np.ndarray, y: np.ndarray, weights: np.ndarray, back: np.ndarray | None, metric: str) -> tuple[np.ndarray, np.ndarray | None]:
    """(distances @ weights of the rows of y, distances.T @ back of the rows of x).

    Equal rows are folded.  In up to `FEW_DIMS` dimensions distances between cells that lie apart come from polynomials through
    them, with a relative error of the sums below 1e-11; in up to two dimensions Chebyshev distances
    are sums along two axes and come from sorted prefix sums.
    """
    if x.shape[1] > FEW_DIMS or metric not in ("euclidean", "chebyshev") or (metric == "chebyshev" and x.shape[1] > 2) or not len(x) or not len(y):
        return _tiled(x, y, weights, back, metric)
    (x, at, back), (y, to, weights) = _folded(x, back), _folded(y, weights)
    out, turned = (_axes if metric == "chebyshev" else _cells)(x, y, weights, back)
    return out[at], None if turned is None else turned[to]


def _tiled(x, y, weights, back, metric):
    out, turned = np.zeros((len(x), weights.shape[1])), None if back is None else np.zeros((len(y), back.shape[1]))
    for i in range(0, len(x), TILE):
        for j in range(0, len(y), TILE):
            p, q = slice(i, i + TILE), slice(j, j + TILE)
            d = quick_distances(x[p], y[q], metric)
            out[p] += d @ weights[q].astype(np.float64)
            if turned is not None:
                turned[q] += d.T @ back[p].astype(np.float64)
    return out, turned


def _folded(x: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """(different rows, the place of every row among them, their summed weights)."""
    order = np.lexsort(x.T)
    new = np.r_[True, (x[order][1:] != x[order][:-1]).any(axis=1)]
    at = np.empty(len(x), np.int64)
    at[order] = np.cumsum(new) - 1
    total = None if weights is None else np.add.reduceat(weights[order].astype(np.float64), np.flatnonzero(new), axis=0)
    return x[order][new], at, total


# --- Chebyshev -------------------------------------------------------------------

def _axes(x, y, weights, back):
    """The larger of |a| and |b| is half of |a + b| + |a - b|, and a sum along one axis needs a place in the order only."""
    def one_way(x, y, weights):
        middle = y.mean(axis=0)
        u, v = x - middle, y - middle
        if x.shape[1] == 1:
            pairs, share = [(u[:, 0], v[:, 0])], 1.0
        else:
            pairs, share = [(u[:, 0] + u[:, 1], v[:, 0] + v[:, 1]), (u[:, 0] - u[:, 1], v[:, 0] - v[:, 1])], 0.5
        out = np.zeros((len(x), weights.shape[1]))
        for s, t in pairs:
            order = np.argsort(t, kind="stable")
            w, m = weights[order], weights[order] * t[order, None]
            below, moment = (np.concatenate([np.zeros((1, w.shape[1])), np.cumsum(c, axis=0)]) for c in (w, m))
            place = np.searchsorted(t[order], s, side="right")
            out += share * (s[:, None] * (2 * below[place] - below[-1]) - (2 * moment[place] - moment[-1]))
        # sums that rounding may have made, such as those over rows at the same place, are taken pair by pair
        width = max(float(np.abs(u).max()), float(np.abs(v).max()))
        unsure = np.flatnonzero(((out < 1e-9 * width * weights.sum(axis=0)) & (weights.sum(axis=0) > 0)).any(axis=1))
        for a in range(0, len(unsure), TILE):
            p = unsure[a:a + TILE]
            out[p] = sum(block_distances(x[p], y[b:b + TILE], "chebyshev") @ weights[b:b + TILE] for b in range(0, len(y), TILE))
        return out
    return one_way(x, y, weights), None if back is None else one_way(y, x, back)


# --- Euclidean -------------------------------------------------------------------

class _Cell:
    """Rows that lie together, and their weights moved to the nodes of polynomials of a given degree."""

    def __init__(self, rows: np.ndarray, x: np.ndarray, weights: np.ndarray | None):
        self.rows, self.x, self.weights = rows, x[rows], None if weights is None else weights[rows]
        lo, hi = self.x.min(axis=0), self.x.max(axis=0)
        self.middle, self.half = (lo + hi) / 2, (hi - lo) / 2
        self.held: dict[tuple, tuple] = {}

    def at(self, degree: tuple[int, ...]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray | None]:
        """(nodes per dimension, rows x nodes, weights of the nodes)."""
        if degree not in self.held:
            nodes, matrix = [], np.ones((len(self.rows), 1))
            for k, (middle, half, n) in enumerate(zip(self.middle, self.half, degree, strict=True)):
                angles = (2 * np.arange(n) + 1) * np.pi / (2 * n)
                if half > 0:
                    nodes.append(middle + half * np.cos(angles))
                    apart = (self.x[:, k, None] - middle) / half - np.cos(angles)
                    hit = apart == 0
                    part = np.sin(angles) * (-1.0) ** np.arange(n) / np.where(hit, 1.0, apart)
                    part = np.where(hit.any(axis=1)[:, None], hit, part)
                    part /= part.sum(axis=1)[:, None]
                else:
                    nodes.append(np.array([middle]))
                    part = np.ones((len(self.rows), 1))
                matrix = (matrix[:, :, None] * part[:, None, :]).reshape(len(self.rows), -1)
            self.held[degree] = nodes, matrix, None if self.weights is None else matrix.T @ self.weights
        return self.held[degree]


def _split(x: np.ndarray) -> list[np.ndarray]:
    out, left = [], [np.arange(len(x))]
    while left:
        own = left.pop()
        if len(own) <= CELL:
            out.append(own)
            continue
        part = x[own]
        dim = int((part.max(axis=0) - part.min(axis=0)).argmax())
        order = np.argpartition(part[:, dim], len(own) // 2)
        left += [own[order[:len(own) // 2]], own[order[len(own) // 2:]]]
    return out


def _degrees(a: _Cell, middle: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes per dimension of a cell and of each of many others: the distance has no singularity within their gap."""
    apart = np.maximum(np.abs(middle - a.middle) - half - a.half, 0.0)
    gap = np.sqrt((apart * apart).sum(axis=1))[:, None]

    def need(half: np.ndarray) -> np.ndarray:
        q = gap / np.where(half > 0, half, 1.0)
        with np.errstate(divide="ignore"):
            n = 2 * np.ceil(np.minimum(math.log(1 / ERROR) / np.log(q + np.sqrt(q * q + 1)) + 1, 1e3) / 2)
        return np.where(half > 0, n, 1).astype(int)
    return need(np.broadcast_to(a.half, half.shape)), need(half)


def _cells(x, y, weights, back):
    ours, theirs = [_Cell(r, x, back) for r in _split(x)], [_Cell(r, y, weights) for r in _split(y)]
    out, turned = np.zeros((len(x), weights.shape[1])), None if back is None else np.zeros((len(y), back.shape[1]))
    middle, half = (np.array([getattr(c, f) for c in theirs]) for f in ("middle", "half"))
    returned: dict[tuple, np.ndarray] = {}
    for a in ours:
        received: dict[tuple, np.ndarray] = {}
        for at, (b, *degrees) in enumerate(zip(theirs, *_degrees(a, middle, half), strict=True)):
            if max(d.max() for d in degrees) > MOST_NODES or math.prod(int(d.prod()) for d in degrees) >= 2 * len(a.rows) * len(b.rows):
                d = block_distances(a.x, b.x, "euclidean")
                out[a.rows] += d @ b.weights
                if turned is not None:
                    turned[b.rows] += d.T @ a.weights
                continue
            degree, turn = (tuple(d.tolist()) for d in degrees)
            (mine, _, sent), (others, _, got) = a.at(degree), b.at(turn)
            d = np.zeros((1, 1))
            for u, v in zip(mine, others, strict=True):
                square = (u[:, None] - v) ** 2
                d = (d[:, None, :, None] + square[None, :, None, :]).reshape(d.shape[0] * len(u), d.shape[1] * len(v))
            np.sqrt(d, out=d)
            received[degree] = received.get(degree, 0.0) + d @ got
            if turned is not None:
                returned[at, turn] = returned.get((at, turn), 0.0) + d.T @ sent
        for degree, field in received.items():
            out[a.rows] += a.at(degree)[1] @ field
        a.held.clear()
    for (at, degree), field in returned.items():
        turned[theirs[at].rows] += theirs[at].at(degree)[1] @ field
    return out, turned
