"""Missing values: injection, simple repairs and the repair error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.hashing import digest
from sparkloom.functions.ranks import order_statistics, smallest_digest_bound
from sparkloom.operators.checks import is_missing, require_column, require_numeric
from sparkloom.operators.encode import UNKNOWN

import hashlib


def _count_for(n: int, share: float) -> int:
    if not 0 < share < 1:
        raise ValueError("the share must lie between 0 and 1, both excluded")
    return round(n * share)  # half to even


def _blank(df: DataFrame, column: str, where: Column) -> DataFrame:
    kept = F.when(where, F.lit(None)).otherwise(F.col(column))
    return df.withColumn(column, kept.cast(df.schema[column].dataType))


def inject_random(df: DataFrame, column: str, share: float, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """Exactly round(n * share) rows, drawn without replacement, become null.

    The rows with the smallest md5(seed:row_id) are taken.  Only the boundary
    digest is searched (counting by prefix), so nothing is sorted.
    """
    require_column(df, column)
    n = df.count()
    m = _count_for(n, share)
    h = digest(seed, row_id)
    bound = smallest_digest_bound(df, h, m)
    return df if bound is None else _blank(df, column, h <= F.lit(bound))


def hashed_start(seed: int, n: int, m: int) -> int:
    """Start of a block of m among n positions, from md5(seed:n)."""
    u = int(hashlib.md5(f"{seed}:{n}".encode()).hexdigest()[:13], 16) / 2.0 ** 52
    return int(u * (n - m + 1))


def inject_block(df: DataFrame, column: str, share: float, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """One block of round(n * share) consecutive rows (by row_id) becomes null.

    The two row ids that bound the block are found by counting; no row moves.
    """
    require_column(df, column)
    n = df.count()
    m = _count_for(n, share)
    if m == 0:
        return df
    start = hashed_start(seed, n, m)
    ends = order_statistics(df, {row_id: [start, start + m - 1]})[row_id]
    return _blank(df, column, F.col(row_id).between(F.lit(ends[start]), F.lit(ends[start + m - 1])))


def hole_flags(df: DataFrame, shares, seed: int = 42, row_id: str = "row_id", injection: str = "block") -> list[Column]:
    """One flag per share: the rows that `inject_block` or `inject_random` would blank.

    The bounds of the blocks of all shares are found by the same counting passes.
    """
    n = df.count()
    counts = [_count_for(n, s) for s in shares]
    if injection == "random":
        h = digest(seed, row_id)
        bounds = [smallest_digest_bound(df, h, m) for m in counts]
        return [F.lit(False) if b is None else h <= F.lit(b) for b in bounds]
    if injection != "block":
        raise ValueError(f"unknown injection {injection!r}")
    spans = [(a, a + m - 1) if m else None for m in counts for a in (hashed_start(seed, n, m),)]
    ids = order_statistics(df, {row_id: sorted({p for s in spans if s for p in s})})[row_id]
    return [F.col(row_id).between(F.lit(ids[s[0]]), F.lit(ids[s[1]])) if s else F.lit(False) for s in spans]


def fill_mean(df: DataFrame, column: str) -> DataFrame:
    """Missing values take the mean of the present ones."""
    require_numeric(df, column)
    value = df.agg(F.avg(F.when(~is_missing(column, df), F.col(column)))).first()[0]
    if value is None:
        return df
    return df.withColumn(column, F.when(is_missing(column, df), F.lit(value)).otherwise(F.col(column)))


def mode_of(df: DataFrame, column: str):
    """Most frequent value, ties to the smallest; None if all are null.

    Counts are combined before the shuffle; ``mode`` itself would keep every
    distinct value in one buffer.
    """
    return (df.where(~is_missing(column, df)).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.min_by("v", F.struct((-F.col("n")).alias("n"), F.col("v").alias("v"))))).first()[0]


def fill_mode(df: DataFrame, column: str) -> DataFrame:
    """Missing values take the mode; an all-null text column takes 'Unknown'."""
    require_column(df, column)
    value = mode_of(df, column)
    if value is None:
        value = UNKNOWN
        return df.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit(value)))
    return df.withColumn(column, F.when(is_missing(column, df), F.lit(value)).otherwise(F.col(column)))


def relative_error(original: DataFrame, missing: DataFrame, filled: DataFrame, column: str,
                   rows_removed: bool = False, row_id: str = "row_id") -> DataFrame:
    """One row: mean |t - p| / |t| in percent over the injected rows.

    (error_pct, scored_rows, zero_truth_rows).  Rows whose true value is zero
    have no relative error and are counted apart.  No error is given when rows
    were dropped.
    """
    spark = original.sparkSession
    schema = "error_pct double, scored_rows bigint, zero_truth_rows bigint"
    if rows_removed or column not in original.columns:
        return spark.createDataFrame([(None, 0, 0)], schema)
    holes = missing.where(is_missing(column, missing)).select(row_id)
    truth = original.select(row_id, F.col(column).cast("double").alias("t"))
    guess = filled.select(row_id, F.col(column).cast("double").alias("p"))
    both = truth.join(holes, row_id, "left_semi").join(guess, row_id)
    return error_of(both)


def error_of(scored: DataFrame) -> DataFrame:
    """The error row of (t, p) pairs."""
    t, p = F.col("t"), F.col("p")
    usable = t.isNotNull() & (t != 0)
    return scored.agg((F.avg(F.when(usable, F.abs(F.try_divide(t - p, t)))) * 100).alias("error_pct"),
                      F.count_if(usable & p.isNotNull()).alias("scored_rows"),
                      F.count_if(t == 0).alias("zero_truth_rows"))
