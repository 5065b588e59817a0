"""The repair experiment: inject, repair, measure, for a grid of settings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.ranks import exact_quantiles
from sparkloom.operators.checks import drop_missing
from sparkloom.operators.missing import fill_mean, fill_mode
from sparkloom.operators.profile import modes
from sparkloom.operators.repair_grid import RepairGrid
from sparkloom.operators.ridge import ALPHAS, fill_regression

SHARES = (0.03, 0.05, 0.10, 0.20, 0.30)
METHODS = ("drop", "mean", "regression")


def repair(df: DataFrame, column: str, method: str, **roles) -> DataFrame:
    """One repair by name; `roles` goes to the regression."""
    if method == "drop":
        return drop_missing(df, column)
    if method == "mean":
        return fill_mean(df, column)
    if method == "mode":
        return fill_mode(df, column)
    if method == "regression":
        return fill_regression(df, column, **roles)
    if method == "stochastic_regression":
        return fill_regression(df, column, noise_seed=roles.pop("noise_seed", 42), **roles)
    raise ValueError(f"unknown method {method!r}")


def statistics(df: DataFrame, column: str) -> DataFrame:
    """One row: mean, median and the smallest of the modes with the number of tied modes."""
    med = exact_quantiles(df, [column], [0.5])[column]
    avg = df.agg(F.avg(column)).first()[0]
    return modes(df, column).agg(
        F.lit(avg).cast("double").alias("mean"), F.lit(med[0] if med else None).cast("double").alias("median"),
        F.min("value").cast("double").alias("first_mode"), F.count(F.lit(1)).alias("mode_count"))


def experiment(df: DataFrame, columns: list[str], shares=SHARES, methods=METHODS, seed: int = 42,
               row_id: str = "row_id", injection: str = "block", alphas=ALPHAS, folds: int = 5, noise_seed: int = 42,
               **roles) -> DataFrame:
    """One row per column, share and method: statistics of the repaired column and its error.

    All shares and methods of a column are answered by the same passes (`RepairGrid`); the rows equal those of
    injecting, repairing and measuring one setting after the other.
    """
    out = []
    for c in columns:
        grid = RepairGrid(df, c, shares, seed, row_id, injection, **roles)
        out.append(grid.measure(methods, alphas, folds, noise_seed).select(F.lit(c).alias("column"), "*"))
    return reduce(DataFrame.unionByName, out)
