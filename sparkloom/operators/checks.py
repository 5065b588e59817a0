"""Projections, filters and input checks."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KNOWN_METRICS = ("euclidean", "euclidean_squared", "chebyshev")


class QualityError(ValueError):
    """Data that must not be processed further."""


def columns_by_kind(df: DataFrame, kinds: dict[str, str], wanted: set[str] | list[str]) -> list[str]:
    """Columns whose configured kind is wanted, in table order."""
    return [c for c in df.columns if kinds.get(c) in wanted]


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ("student_id",), limit: int | None = None) -> list[str]:
    """Numeric columns in table order without the excluded ones; all of them unless a `limit` is given."""
    names = [f.name for f in df.schema.fields
             if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    return names if limit is None else names[:limit]


def select_features(df: DataFrame, features: list[str], row_id: str = "row_id", exactly: int | None = None) -> DataFrame:
    """Projection on the chosen features; at least one, or `exactly` n different ones."""
    if not features:
        raise ValueError("choose at least one feature")
    if exactly is not None and len(set(features)) != exactly:
        raise ValueError(f"choose {exactly} different features")
    unknown = [f for f in features if f not in df.columns]
    if unknown:
        raise ValueError(f"unknown features: {unknown}")
    return df.select(row_id, *features)


def drop_missing(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is present."""
    require_column(df, column)
    return df.where(~is_missing(column, df))


def require_column(df: DataFrame, column: str) -> None:
    if not isinstance(column, str):
        raise ValueError("the column must be given by name")
    if column not in df.columns:
        raise ValueError(f"no column {column!r}")


def require_numeric(df: DataFrame, column: str) -> None:
    require_column(df, column)
    if not isinstance(df.schema[column].dataType, T.NumericType):
        raise ValueError(f"column {column!r} is not numeric")


def require_complete(df: DataFrame, column: str) -> None:
    """Raise if the column holds a null."""
    require_column(df, column)
    if df.where(F.col(column).isNull()).limit(1).count():
        raise QualityError(f"column {column!r} has missing values")


def assert_complete(df: DataFrame, column: str) -> DataFrame:
    """The same guard inside the plan: the job fails at the first null."""
    require_column(df, column)
    present = F.assert_true(F.col(column).isNotNull(), F.lit(f"column {column!r} has missing values"))
    return df.where(present.isNull())


def is_missing(c: str, df: DataFrame) -> Column:
    """Null, or NaN in a floating column."""
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def null_report(df: DataFrame) -> DataFrame:
    """(column, missing) for every column, one scan."""
    one = df.agg(*[F.count_if(is_missing(c, df)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("missing"))
        for i, c in enumerate(df.columns)])))


def date_parts(df: DataFrame, column: str, names: tuple[str, str, str] = ("year", "month", "day")) -> DataFrame:
    """Timestamp (or its text) to year, month and day; the source column is dropped."""
    require_column(df, column)
    ts = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        ts = F.to_timestamp(ts)
    y, m, d = names
    return df.withColumns({y: F.year(ts), m: F.month(ts), d: F.dayofmonth(ts)}).drop(column)


def validate_input(df: DataFrame, configured: list[str]) -> list[str]:
    """Raise on an empty table; configured columns that are absent only warn."""
    if df.isEmpty():
        raise ValueError("the table is empty")
    absent = sorted(set(configured) - set(df.columns))
    if absent:
        warnings.warn(f"configured columns not in the table: {absent}", stacklevel=2)
    return absent


def loss_check(before: DataFrame, after: DataFrame) -> DataFrame:
    """Share of rows lost: over 50 % is an error, over 20 % a warning."""
    zero = F.lit(0).cast("bigint")
    b = before.agg(F.count(F.lit(1)).alias("rows_before"), zero.alias("rows_after"))
    a = after.agg(zero.alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))
    lost = F.try_divide(F.lit(100.0) * (F.col("rows_before") - F.col("rows_after")), F.col("rows_before"))
    return (b.unionByName(a).agg(F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after"))
            .withColumn("loss_pct", lost)
            .withColumn("verdict", F.when(F.col("loss_pct") > 50, "error")
                        .when(F.col("loss_pct") > 20, "warning").otherwise("ok")))


def require_small_loss(before: DataFrame, after: DataFrame) -> float:
    row = loss_check(before, after).first()
    if row["verdict"] == "error":
        raise QualityError(f"{row['loss_pct']:.1f} % of the rows were lost")
    if row["verdict"] == "warning":
        warnings.warn(f"{row['loss_pct']:.1f} % of the rows were lost", stacklevel=2)
    return row["loss_pct"]


def feature_quality(df: DataFrame, features: list[str]) -> DataFrame:
    """Distinct count, sample std and range per feature, with a verdict.

    Fewer than 10 distinct values is a warning; std or range below 1e-6 an error.
    """
    # One distinct count per plan: several in one aggregate would expand every row.
    distinct = (df.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])))
        .where("v is not null").groupBy("feature", "v").agg(F.lit(1).alias("one"))
        .groupBy("feature").agg(F.count(F.lit(1)).alias("distinct_values")))
    one = df.agg(*[e.alias(f"{n}{i}") for i, f in enumerate(features)
                   for n, e in (("s", F.stddev_samp(f)), ("r", (F.max(f) - F.min(f)).cast("double")))])
    spread = one.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"s{i}").alias("std"), F.col(f"r{i}").alias("value_range"))
        for i, f in enumerate(features)])))
    return (spread.join(distinct, "feature", "left")
            .withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0).cast("bigint")))
            .withColumn("verdict", F.when((F.col("std") < 1e-6) | (F.col("value_range") < 1e-6), "error")
                        .when(F.col("distinct_values") < 10, "warning").otherwise("ok")))


def require_feature_quality(df: DataFrame, features: list[str]) -> None:
    """Raise on nearly constant features; `features` bounds the rows collected."""
    for r in feature_quality(df, features).collect():
        if r["verdict"] == "error":
            raise QualityError(f"feature {r['feature']!r} is nearly constant")
        if r["verdict"] == "warning":
            warnings.warn(f"feature {r['feature']!r} has {r['distinct_values']} distinct values", stacklevel=2)


def vector_check(df: DataFrame, vector: str, width: int | None = None) -> DataFrame:
    """One row: number of vectors, smallest and largest width, vectors with null, NaN or infinite entries."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    out = df.agg(F.count(v).alias("vectors"), F.min(F.size(v)).alias("min_width"),
                 F.max(F.size(v)).alias("max_width"), F.count_if(bad).alias("bad_vectors"),
                 F.count_if(v.isNull() | (F.size(v) == 0)).alias("empty_vectors"))
    same = F.col("min_width") == F.col("max_width")
    if width is not None:
        same = same & (F.col("max_width") == width)
    return out.withColumn("valid", same & (F.col("bad_vectors") == 0) & (F.col("empty_vectors") == 0))


def require_vectors(df: DataFrame, vector: str, width: int | None = None) -> int:
    """Raise on invalid vectors; the number of vectors otherwise."""
    row = vector_check(df, vector, width).first()
    if not row["valid"]:
        raise QualityError(f"invalid vectors: {row.asDict()}")
    return row["vectors"]


def check_k_range(min_k: int, max_k: int, metric: str) -> None:
    """Argument check of a run over several numbers of clusters."""
    for name, v in (("min_k", min_k), ("max_k", max_k)):
        if not isinstance(v, int) or isinstance(v, bool):
            raise TypeError(f"{name} must be an integer")
    if min_k < 1:
        raise ValueError("min_k must be at least 1")
    if max_k < 2:
        raise ValueError("max_k must be at least 2")
    if min_k >= max_k:
        raise ValueError("min_k must be below max_k")
    if metric not in KNOWN_METRICS:
        warnings.warn(f"unknown metric {metric!r}", stacklevel=2)
