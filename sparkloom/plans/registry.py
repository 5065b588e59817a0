"""Registry of queries: a Spark callable and, where SQL can say it, its SQL."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its name."""
    def wrap(fn):
        QUERIES[name or fn.__name__] = Query(fn, sql)
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def r(column: Column | str, digits: int = 6) -> Column:
    """Rounded double without a negative zero, so that engines can be compared."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def rs(expr: str, digits: int = 6) -> str:
    """The SQL twin of `r`."""
    return f"(round(({expr})::DOUBLE, {digits}) + 0.0::DOUBLE)"


def whole(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts as bigint, for tables that are known to be small enough."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in columns})
