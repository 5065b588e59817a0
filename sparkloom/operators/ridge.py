"""Ridge regression from moment sums: repair, alpha search and evaluation.

One pass over the rows yields, per fold, the count, the sums and the products
of features and target.  Every alpha and every fold is then solved exactly from
these p x p sums, so the search costs no further pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions.hashing import normal, uniform
from sparkloom.functions.ranks import order_statistics
from sparkloom.operators.checks import date_parts, is_missing, require_numeric
from sparkloom.operators.encode import few_classes, frequencies, mode_values

ALPHAS = (0.1, 1.0, 10.0, 100.0)
EVALUATION_ALPHAS = (0.01, 0.1, 1.0, 10.0, 100.0)
MAX_FEATURES = 2000  # the driver solves a p x p system


# --- design matrix -------------------------------------------------------------

@dataclass
class Design:
    """Fitted feature expressions over a row."""
    names: list[str] = field(default_factory=list)
    numeric: dict[str, float] = field(default_factory=dict)
    onehot: dict[str, tuple[str, list]] = field(default_factory=dict)
    freq: dict[str, tuple[str, DataFrame]] = field(default_factory=dict)

    def prepared(self, df: DataFrame) -> DataFrame:
        """`df` with one frequency column per frequency-encoded feature."""
        for i, (c, (fill, table)) in enumerate(self.freq.items()):
            t = table.select(F.col("value").alias("_v"), F.col("freq").alias(f"_freq{i}"))
            key = F.coalesce(F.col(c).cast("string"), F.lit(fill))
            df = df.withColumn("_k", key).join(t, F.col("_k") == F.col("_v"), "left").drop("_k", "_v")
        return df

    def vector(self) -> list[Column]:
        """Feature columns in the order of `names`."""
        out = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(m)), F.lit(m)) for c, m in self.numeric.items()]
        for c, (fill, values) in self.onehot.items():
            v = F.coalesce(F.col(c).cast("string"), F.lit(fill))
            out += [F.when(v == F.lit(x), 1.0).otherwise(0.0) for x in values[1:]]
        out += [F.coalesce(F.col(f"_freq{i}"), F.lit(0.0)) for i in range(len(self.freq))]
        return out

    def linear(self, weights: np.ndarray, intercept: float, freq: list[Column] | None = None) -> Column:
        """intercept + w . x; a one-hot block is one map lookup, not one term per class.

        `freq` replaces the frequency columns that `prepared` adds.
        """
        w = list(map(float, weights))
        terms: list[Column] = [F.lit(float(intercept))]
        for (c, m), b in zip(self.numeric.items(), w):
            terms.append(F.lit(b) * F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(m)), F.lit(m)))
        k = len(self.numeric)
        for c, (fill, values) in self.onehot.items():
            pairs = [F.lit(x) for v, b in zip(values[1:], w[k:]) for x in (v, b)]
            if pairs:
                v = F.coalesce(F.col(c).cast("string"), F.lit(fill))
                terms.append(F.coalesce(F.try_element_at(F.create_map(*pairs), v), F.lit(0.0)))
            k += len(values) - 1
        for i, column in enumerate(freq or [F.col(f"_freq{i}") for i in range(len(self.freq))]):
            terms.append(F.lit(w[k + i]) * F.coalesce(column, F.lit(0.0)))
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        return total


def fit_design(train: DataFrame, numeric: list[str], onehot: list[str], freq: list[str]) -> Design:
    """Imputation values, classes and frequencies from the training rows only."""
    d = Design()
    if numeric:
        row = train.agg(*[F.avg(F.when(~is_missing(c, train), F.col(c).cast("double"))).alias(f"m{i}")
                          for i, c in enumerate(numeric)]).first()
        d.numeric = {c: float(row[f"m{i}"] or 0.0) for i, c in enumerate(numeric)}
    categorical = onehot + freq
    if categorical:
        text = train.select(*[F.col(c).cast("string").alias(c) for c in categorical])
        fill = mode_values(text, categorical)
        for c in onehot:
            values = few_classes(text.select(F.coalesce(F.col(c), F.lit(fill[c])).alias(c)), c)
            if values is None:
                raise ValueError(f"column {c!r} has too many classes for one-hot; give it as a frequency column")
            d.onehot[c] = (fill[c], values)
        for c in freq:
            filled = text.select(F.coalesce(F.col(c), F.lit(fill[c])).alias(c))
            d.freq[c] = (fill[c], frequencies(filled, c))
    d.names = (list(d.numeric) + [f"{c}_{v}" for c, (_, vs) in d.onehot.items() for v in vs[1:]] + list(d.freq))
    if not d.names:
        raise ValueError("no features")
    if len(d.names) > MAX_FEATURES:
        raise ValueError(f"{len(d.names)} features; at most {MAX_FEATURES} can be solved")
    return d


# --- moment sums ------------------------------------------------------------------

def moment_sums(df: DataFrame, features: list[Column], target: Column, fold: Column,
                shift: list[float]) -> dict[int, np.ndarray]:
    """Per fold the (p+2) x (p+2) matrix of sums of products of [1, x - shift, y - shift].

    Tasks fold their Arrow batches into one matrix per fold before the shuffle;
    the driver receives folds * (p+2)^2 numbers.
    """
    width = len(features) + 2
    cols = [fold.cast("bigint").alias("fold")] + [
        (c.cast("double") - F.lit(s)).alias(f"x{i}") for i, (c, s) in enumerate(zip([*features, target], shift))]

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            for f, part in pdf.groupby("fold", sort=False):
                z = np.hstack([np.ones((len(part), 1)), part.iloc[:, 1:].to_numpy(dtype=np.float64)])
                sums[f] = sums.get(f, 0.0) + z.T @ z
        for f, m in sums.items():
            yield pd.DataFrame({"fold": np.int64(f), "cell": np.arange(width * width, dtype=np.int32), "s": m.ravel()})

    rows = (df.select(*cols).mapInPandas(partial, "fold bigint, cell int, s double")
            .groupBy("fold", "cell").agg(F.sum("s").alias("s")).collect())
    out: dict[int, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["fold"], np.zeros(width * width))[r["cell"]] = r["s"]
    return {f: m.reshape(width, width) for f, m in sorted(out.items())}


def solve(m: np.ndarray, alpha: float, scale: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Ridge with free intercept on features divided by `scale`; weights on the unscaled features."""
    n = m[0, 0]
    sx, sy = m[0, 1:-1], m[0, -1]
    cov = m[1:-1, 1:-1] - np.outer(sx, sx) / n
    cxy = m[1:-1, -1] - sx * sy / n
    if scale is None:
        std = np.sqrt(np.maximum(np.diag(cov) / n, 0.0))
        scale = np.where(std > 0, std, 1.0)
    a = cov / np.outer(scale, scale) + alpha * np.eye(len(sx))
    w = np.linalg.lstsq(a, cxy / scale, rcond=None)[0] / scale
    return w, float(sy / n - w @ sx / n)


def standard_scales(m: np.ndarray) -> np.ndarray:
    n = m[0, 0]
    var = np.diag(m)[1:-1] / n - (m[0, 1:-1] / n) ** 2
    std = np.sqrt(np.maximum(var, 0.0))
    return np.where(std > 1e-12, std, 1.0)


def squared_error(m: np.ndarray, w: np.ndarray, b: float) -> float:
    """Sum of squared residuals of y - b - w.x over the rows behind `m`."""
    v = np.concatenate([[b], w, [-1.0]])
    return float(v @ m @ v)


@dataclass
class AlphaSearch:
    alpha: float
    weights: np.ndarray
    intercept: float
    rows: list[tuple]  # (alpha, mean score, std score)
    residual_std: float

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(float(a), float(s), float(d)) for a, s, d in self.rows],
            "alpha double, mean_score double, std_score double")


def search_alpha(sums: dict[int, np.ndarray], alphas=ALPHAS, scale_per_fold: bool = False) -> AlphaSearch:
    """Best alpha by mean negative squared error over the folds; the first wins ties.

    Scales come from all rows, or from each training part with `scale_per_fold`.
    """
    total = sum(sums.values())
    scale = standard_scales(total)
    rows = []
    for a in alphas:
        scores = []
        for f in sums.values():
            rest = total - f
            w, b = solve(rest, a, standard_scales(rest) if scale_per_fold else scale)
            scores.append(-squared_error(f, w, b) / f[0, 0])
        rows.append((a, float(np.mean(scores)), float(np.std(scores))))
    best = rows[int(np.argmax([r[1] for r in rows]))][0]
    w, b = solve(total, best, scale)
    return AlphaSearch(best, w, b, rows, float(np.sqrt(max(squared_error(total, w, b) / total[0, 0], 0.0))))


# --- folds --------------------------------------------------------------------------

def contiguous_folds(train: DataFrame, folds: int, row_id: str, n: int) -> Column:
    """Fold number by position of row_id; the first n % folds folds hold one row more."""
    starts = fold_starts(n, folds)
    ids = order_statistics(train, {row_id: starts})[row_id] if starts else {}
    return fold_of(row_id, [ids[s] for s in starts])


def fold_starts(n: int, folds: int) -> list[int]:
    """Positions at which the second and later of the contiguous folds of n rows start."""
    if n < folds:
        raise ValueError(f"{n} training rows cannot form {folds} folds")
    sizes = [n // folds + (1 if i < n % folds else 0) for i in range(folds)]
    return np.cumsum([0, *sizes])[1:-1].tolist()


def fold_of(row_id: str, first_ids: list) -> Column:
    """Fold number of a row from the smallest ids of the second and later folds."""
    out = F.lit(0)
    for i, low in enumerate(first_ids, 1):
        out = F.when(F.col(row_id) >= F.lit(low), i).otherwise(out)
    return out


def hashed_fold(seed, folds: int, row_id: str = "row_id") -> Column:
    """Shuffled fold: floor(u * folds)."""
    return F.floor(uniform(seed, row_id) * F.lit(folds)).cast("int")


# --- repair --------------------------------------------------------------------------

@dataclass
class RegressionFill:
    design: Design
    search: AlphaSearch
    columns: list[str]

    def prediction(self) -> Column:
        return self.design.linear(self.search.weights, self.search.intercept)


def roles_of(df: DataFrame, column: str, row_id: str, numeric, onehot, freq, timestamp):
    taken = {column, row_id, timestamp}
    if numeric is None:
        numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    numeric = [c for c in numeric if c in df.columns and c not in taken and c not in (onehot or []) + (freq or [])]
    parts = ["_year", "_month", "_day"] if timestamp and timestamp in df.columns else []
    return numeric + parts, [c for c in onehot or [] if c in df.columns], [c for c in freq or [] if c in df.columns]


def with_dates(df: DataFrame, timestamp: str | None) -> DataFrame:
    if not timestamp or timestamp not in df.columns:
        return df
    return date_parts(df.withColumn("_ts", F.col(timestamp)), "_ts", ("_year", "_month", "_day"))


def fit_regression(df: DataFrame, column: str, row_id: str = "row_id", numeric: list[str] | None = None,
                   onehot: list[str] | None = None, freq: list[str] | None = None, timestamp: str | None = None,
                   alphas=ALPHAS, folds: int = 5) -> RegressionFill:
    """Fit the repair model of `column` on the rows where it is present."""
    require_numeric(df, column)
    num, hot, frq = roles_of(df, column, row_id, numeric, onehot, freq, timestamp)
    train = with_dates(df, timestamp).where(~is_missing(column, df))
    design = fit_design(train, num, hot, frq)
    head = train.agg(F.count(F.lit(1)), F.avg(column)).first()
    fold = contiguous_folds(train, folds, row_id, head[0])
    shift = [*design.numeric.values()] + [0.0] * (len(design.names) - len(design.numeric)) + [float(head[1])]
    sums = moment_sums(design.prepared(train), design.vector(), F.col(column), fold, shift)
    search = search_alpha(sums, alphas)
    # undo the shift of the sums
    search.intercept += shift[-1] - float(search.weights @ np.array(shift[:-1]))
    return RegressionFill(design, search, design.names)


def fill_regression(df: DataFrame, column: str, row_id: str = "row_id", numeric: list[str] | None = None,
                    onehot: list[str] | None = None, freq: list[str] | None = None, timestamp: str | None = None,
                    alphas=ALPHAS, folds: int = 5, noise_seed: int | None = None) -> DataFrame:
    """Missing values of `column` take the ridge prediction; the schema is kept.

    With `noise_seed` a normal residual is added (stochastic regression).
    """
    require_numeric(df, column)
    if not df.where(is_missing(column, df)).limit(1).count():
        return df
    fitted = fit_regression(df, column, row_id, numeric, onehot, freq, timestamp, alphas, folds)
    guess = fitted.prediction()
    if noise_seed is not None:
        guess = guess + F.lit(fitted.search.residual_std) * normal(noise_seed, row_id)
    wide = fitted.design.prepared(with_dates(df, timestamp))
    value = F.when(is_missing(column, df), guess).otherwise(F.col(column).cast("double"))
    return wide.withColumn(column, value).select(*df.columns)


# --- evaluation ------------------------------------------------------------------------

def evaluate(df: DataFrame, target: str, numeric: list[str], onehot: list[str] | None = None,
             freq: list[str] | None = None, row_id: str = "row_id", alphas=EVALUATION_ALPHAS, folds: int = 10,
             test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Hold-out and k-fold evaluation: (one row alpha, mse, r2, train_rows, test_rows; search table).

    The split and the folds follow hashes of row_id.  Scaling is fitted inside
    every training part.
    """
    require_numeric(df, target)
    rows = df.where(~is_missing(target, df))
    design = fit_design(rows, numeric, onehot or [], freq or [])
    fold = F.when(uniform(seed, row_id) < F.lit(test_share), F.lit(-1)).otherwise(hashed_fold(f"{seed}/fold", folds, row_id))
    mean = float(rows.agg(F.avg(target)).first()[0])
    shift = [*design.numeric.values()] + [0.0] * (len(design.names) - len(design.numeric)) + [mean]
    sums = moment_sums(design.prepared(rows), design.vector(), F.col(target), fold, shift)
    test = sums.pop(-1, None)
    if test is None or not sums:
        raise ValueError("too few rows for a split")
    found = search_alpha(sums, alphas, scale_per_fold=True)
    sse = squared_error(test, found.weights, found.intercept)
    n = test[0, 0]
    spread = test[-1, -1] - test[0, -1] ** 2 / n
    train_rows = sum(m[0, 0] for m in sums.values())
    spark = df.sparkSession
    scores = spark.createDataFrame(
        [(float(found.alpha), float(sse / n), float(1.0 - sse / spread) if spread > 0 else None,
          int(train_rows), int(n))],
        "alpha double, mse double, r2 double, train_rows bigint, test_rows bigint")
    return scores, found.table(spark)


def best_models(table: DataFrame, n: int = 5) -> DataFrame:
    """The n best rows of a search table by mean score."""
    return table.orderBy(F.desc("mean_score"), "alpha").limit(n)
