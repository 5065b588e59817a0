"""Distances between vectors: column expressions and block kernels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("euclidean", "euclidean_squared", "chebyshev")


def require_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; known: {', '.join(METRICS)}")


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def euclidean_squared_distance(x, y) -> Column:
    squares = F.zip_with(_column(x), _column(y), lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v)


def euclidean_distance(x, y) -> Column:
    return F.sqrt(euclidean_squared_distance(x, y))


def chebyshev_distance(x, y) -> Column:
    return F.array_max(F.zip_with(_column(x), _column(y), lambda a, b: F.abs(a - b)))


def distance(x, y, metric: str) -> Column:
    require_metric(metric)
    return {"euclidean": euclidean_distance, "euclidean_squared": euclidean_squared_distance,
            "chebyshev": chebyshev_distance}[metric](x, y)


def block_distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """All distances between two blocks, summed dimension by dimension."""
    out, diff = np.zeros((len(a), len(b))), np.empty((len(a), len(b)))  # no new matrix per dimension
    for k in range(a.shape[1]):
        np.subtract(a[:, k, None], b[None, :, k], out=diff)
        if metric == "chebyshev":
            np.maximum(out, np.abs(diff, out=diff), out=out)
        else:
            diff *= diff
            out += diff
    return np.sqrt(out, out=out) if metric == "euclidean" else out


def quick_distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """`block_distances` from one matrix product, for sums: a distance is off by some 1e-12 of the widest row at most.

    Pairs nearer than a thousandth of that width are computed one by one, so that copies are at distance 0.
    """
    if metric == "chebyshev" or not len(a) or not len(b):
        return block_distances(a, b, metric)
    middle = a.mean(axis=0)
    x, y = a - middle, b - middle
    norms = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
    width = norms[0].max() + norms[1].max()
    # coordinates far from 0 have lost their digits before the middle is taken off
    if not (1e-200 < width < 1e200) or np.abs(middle).max() ** 2 > 1e6 * width:
        return block_distances(a, b, metric)
    out = x @ y.T
    out *= -2
    out += norms[0][:, None]
    out += norms[1]
    i, j = np.divmod(np.flatnonzero(out < 1e-6 * width), len(b))
    for at in range(0, len(i), 65_536):
        p, q = i[at:at + 65_536], j[at:at + 65_536]
        diff = a[p] - b[q]
        out[p, q] = np.einsum("ij,ij->i", diff, diff)
    return np.sqrt(out, out=out) if metric == "euclidean" else out


def distances_from(point: np.ndarray, others: np.ndarray, metric: str) -> np.ndarray:
    """Distances of one point to many, in the same summation order."""
    return block_distances(point[None, :], others, metric)[0]


def choose_two(n) -> Column:
    """n over 2 for counts as decimal(38, 0): n * (n - 1) / 2, zero below two."""
    n = _column(n).cast("bigint")
    # the even factor is halved first, so nothing is rounded and nothing overflows
    even = F.shiftright(n, 1).cast("decimal(19,0)") * (n - 1).cast("decimal(19,0)")
    odd = n.cast("decimal(19,0)") * F.shiftright(n - 1, 1).cast("decimal(19,0)")
    return F.when(n < 2, F.lit(0).cast("decimal(38,0)")).when(F.pmod(n, F.lit(2)) == 0, even).otherwise(odd).cast("decimal(38,0)")


def binomial(n: int, k: int = 2) -> int:
    """n over k; zero outside 0 <= k <= n."""
    if k < 0 or n < 0 or k > n:
        return 0
    out = 1
    for i in range(1, min(k, n - k) + 1):
        out = out * (n - i + 1) // i
    return out
