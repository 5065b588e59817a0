"""Adaptive random search for informative features."""

from __future__ import annotations

import functools
import hashlib
import math
import warnings
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.checks import QualityError, feature_quality
from sparkloom.operators.linkage import single_linkage
from sparkloom.operators.profile import variance_ranking
from sparkloom.operators.quality import silhouette
from sparkloom.session import cut

HISTORY_SCHEMA = ("iteration int, quality double, best_quality double, lr double, features array<int>, "
                  "probs array<double>, quality_std double")


def subset_quality(df: DataFrame, features: list[str], k: int = 3, metric: str = "euclidean", row_id: str = "row_id") -> float:
    """Silhouette of the single linkage partition on the features, 0 for unsuitable ones.

    Unsuitable: fewer than two features or rows, a feature with fewer than ten
    values or hardly any spread, or a total variance below 0.1.
    """
    if len(features) < 2:
        return 0.0
    n = df.count()
    if n < 2:
        return 0.0
    weak = feature_quality(df, features).where((F.col("distinct_values") < 10) | (F.col("std") < 1e-6))
    if weak.limit(1).count():
        return 0.0
    variance = df.agg(*[F.var_pop(f).alias(f"v{i}") for i, f in enumerate(features)]).first()
    if sum(variance) < 0.1:
        return 0.0
    labels = cut(single_linkage(df, features, min(k, n - 1), metric, row_id))
    score = silhouette(df, features, labels, metric, row_id).first()["silhouette"]
    return max(0.0, score) if score is not None else 0.0


@dataclass(frozen=True)
class Search:
    """State of a search: what the next round needs, and nothing else."""

    probs: tuple[float, ...]
    scores: tuple[float, ...] = ()
    best: float = -math.inf
    chosen: tuple[int, ...] = ()
    stale: int = 0


def _draw(seed: int, *keys) -> float:
    """Uniform in (0, 1) hashed from the seed and the keys."""
    text = ":".join(map(str, (seed, *keys)))
    return (int(hashlib.md5(text.encode()).hexdigest()[:13], 16) + 0.5) / 2.0 ** 52


def propose(state: Search, n: int, seed: int) -> tuple[int, ...]:
    """n features: every one with its probability, then the likeliest of too many or a weighted draw of what is missing."""
    t = len(state.scores) + 1
    inside = [i for i, p in enumerate(state.probs) if _draw(seed, t, i) < p]
    inside = sorted(inside, key=lambda i: (-state.probs[i], i))[:n]
    # the smallest exponential waiting times are a weighted draw without replacement
    waiting = sorted((-math.log(_draw(seed, t, i, "more")) / p, i) for i, p in enumerate(state.probs) if i not in inside)
    return tuple(sorted(inside + [i for _, i in waiting[:n - len(inside)]]))


def update(state: Search, subset: tuple[int, ...], score: float, step: float) -> Search:
    """The state after a round: a feature's probability follows the standardised score, up if chosen and down if not."""
    scores = (*state.scores, score)
    probs = state.probs
    if len(scores) > 1:
        z = (score - np.mean(scores)) / max(float(np.std(scores)), 1e-6)
        move = step * min(max(float(z), -5.0), 5.0)
        raw = [max(p + (move if i in subset else -move / (len(probs) - len(subset))), 1e-8) for i, p in enumerate(probs)]
        probs = tuple(p / sum(raw) for p in raw)
    better = score > state.best
    return Search(probs, scores, score if better else state.best, subset if better else state.chosen, 0 if better else state.stale + 1)


def finished(state: Search, patience: int, tolerance: float) -> bool:
    return state.stale >= patience or (len(state.scores) >= 10 and float(np.std(state.scores[-10:])) < tolerance)


# The defaults below and the constants of `update` and the step are the published settings.
def adaptive_search(d: int, n: int, quality: Callable[[tuple[int, ...]], float], max_iterations: int = 1000,
                    lr: float = 0.05, min_lr: float = 1e-4, patience: int = 20, tolerance: float = 1e-6,
                    seed: int = 42) -> tuple[list[int], float, list[tuple]]:
    """Driver loop over d probabilities; `quality` runs a Spark job per new subset and is remembered."""
    if n < 1:
        raise ValueError("choose at least one feature")
    if n >= d:
        return list(range(d)), 1.0, []
    if not 0 < lr <= 1 or not 0 < min_lr <= lr:
        raise ValueError("learning rates must satisfy 0 < min_lr <= lr <= 1")

    @functools.cache
    def score(subset: tuple[int, ...]) -> float:
        value = float(quality(subset))
        return value if math.isfinite(value) else 0.0

    state, history = Search((1.0 / d,) * d), []
    while len(history) < max_iterations and not finished(state, patience, tolerance):
        step = max(lr * 0.95 ** (len(history) // 10), min_lr)
        subset = propose(state, n, seed)
        state = update(state, subset, score(subset), step)
        spread = max(float(np.std(state.scores)), 1e-6) if len(state.scores) > 1 else 0.0
        history.append((len(history) + 1, state.scores[-1], state.best, step, list(subset), list(state.probs), spread))
    return list(state.chosen), state.best, history


@dataclass
class Selection:
    features: list[str]
    quality: float
    method: str  # "spa" or "variance"
    history: list[tuple]

    def summary(self) -> dict:
        return {"features": self.features, "quality": self.quality, "method": self.method, "iterations": len(self.history)}

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame(self.history, HISTORY_SCHEMA)


def select_features(df: DataFrame, columns: list[str], n: int, k: int = 3, metric: str = "euclidean",
                    row_id: str = "row_id", max_iterations: int = 1000, seed: int = 42,
                    quality: Callable[[DataFrame, list[str]], float] | None = None) -> Selection:
    """The n most informative columns; largest variances where the data check refuses the search (`QualityError`)."""
    table = df.select(row_id, *columns).persist()
    score = quality or (lambda frame, names: subset_quality(frame, names, k, metric, row_id))
    try:
        found, best, history = adaptive_search(
            len(columns), n, lambda s: score(table, [columns[i] for i in s]), max_iterations, seed=seed)
        return Selection([columns[i] for i in found], best, "spa", history)
    except QualityError as failure:  # a lost executor or any other failure is no reason for another answer
        warnings.warn(f"the data are unfit for the search, ranking by variance: {failure}", stacklevel=2)
        rows = variance_ranking(table, columns, n).orderBy("rank").collect()
        return Selection([r["column"] for r in rows], rows[0]["quality"], "variance", [])
    finally:
        table.unpersist()
