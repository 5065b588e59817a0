"""Scalers, encoders and the fit / transform pair driven by a specification."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.ranks import with_position
from sparkloom.operators.checks import columns_by_kind, is_missing, validate_input
from sparkloom.operators.profile import is_numeric, is_text, value_counts
from sparkloom.sources.spec import CATEGORICAL, NUMERICAL, TableSpec

# Up to this many classes a code is looked up in a literal map inside the
# projection; beyond it the codes live in a table and are joined.
LITERAL_CLASSES = 1000
UNKNOWN = "Unknown"


def _map(pairs: list[tuple]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs for x in kv])


# --- numeric ---------------------------------------------------------------

def standard_scale(df: DataFrame, columns: list[str], stats: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """(x - mean) / population std; a zero std divides by one; nulls stay null."""
    stats = stats or standard_stats(df, columns)
    return df.withColumns({c: standard_column(c, *stats[c]) for c in columns})


def standard_stats(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[e.alias(f"{n}{i}") for i, c in enumerate(columns) for n, e in (
        ("m", F.avg(_clean(df, c))), ("s", F.stddev_pop(_clean(df, c))))]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def standard_column(c: str, mean: float | None, std: float | None) -> Column:
    if mean is None:
        return F.lit(None).cast("double")
    return (F.col(c).cast("double") - F.lit(float(mean))) / F.lit(float(std) if std else 1.0)


def minmax_scale(df: DataFrame, columns: list[str], stats: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """(x - min) / (max - min); a constant column becomes 0."""
    stats = stats or minmax_stats(df, columns)
    return df.withColumns({c: minmax_column(c, *stats[c]) for c in columns})


def minmax_stats(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[e.cast("double").alias(f"{n}{i}") for i, c in enumerate(columns) for n, e in (
        ("l", F.min(_clean(df, c))), ("h", F.max(_clean(df, c))))]).first()
    return {c: (row[f"l{i}"], row[f"h{i}"]) for i, c in enumerate(columns)}


def minmax_column(c: str, low: float | None, high: float | None) -> Column:
    if low is None:
        return F.lit(None).cast("double")
    return (F.col(c).cast("double") - F.lit(low)) / F.lit(high - low if high > low else 1.0)


def _clean(df: DataFrame, c: str) -> Column:
    return F.when(~is_missing(c, df), F.col(c).cast("double"))


# --- classes of a categorical column ----------------------------------------

def classes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): codes from 0 in sorted order, without a one-task window."""
    return with_position(df.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct(),
                         ["value"], "code").withColumn("code", F.col("code").cast("int"))


def few_classes(df: DataFrame, column: str, limit: int = LITERAL_CLASSES) -> list | None:
    """Sorted distinct values when there are at most `limit`, else None."""
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).collect()
    return sorted(r[0] for r in rows) if len(rows) <= limit else None


def label_encode(df: DataFrame, column: str, fitted: list | DataFrame | None = None, output: str | None = None) -> DataFrame:
    """Code of the value in the sorted classes; an unseen value takes code 0."""
    output = output or column
    if fitted is None:
        fitted = few_classes(df, column)
        if fitted is None:
            fitted = classes(df, column)
    if isinstance(fitted, list):
        return df.withColumn(output, label_column(column, fitted))
    codes = fitted.select(F.col("value").alias("_v"), F.col("code").alias("_code"))
    # a skewed value on the left is split by AQE; the right side is unique
    joined = df.join(codes, df[column] == codes["_v"], "left")
    return joined.withColumn(output, F.coalesce("_code", F.lit(0))).drop("_v", "_code")


def label_column(column: str, fitted: list) -> Column:
    if not fitted:
        return F.lit(0)
    return F.coalesce(F.try_element_at(_map([(v, i) for i, v in enumerate(fitted)]), F.col(column)), F.lit(0))


def onehot_columns(column: str, fitted: list) -> dict[str, Column]:
    """One 0/1 column per sorted class but the first; unseen values give zeros."""
    return {f"{column}_{v}": F.when(F.col(column) == F.lit(v), 1.0).otherwise(0.0) for v in fitted[1:]}


def onehot_encode(df: DataFrame, column: str, fitted: list | None = None, drop: bool = True) -> DataFrame:
    if fitted is None:
        fitted = few_classes(df, column)
        if fitted is None:
            raise ValueError(f"column {column!r} has more than {LITERAL_CLASSES} classes; use label or frequency codes")
    out = df.withColumns(onehot_columns(column, fitted))
    return out.drop(column) if drop else out


def ordinal_column(column: str, order: list[str]) -> Column:
    """Position in the configured order; unknown values take 0."""
    if not order:
        raise ValueError(f"column {column!r}: an ordinal code needs an order")
    return F.coalesce(F.try_element_at(_map([(v, i) for i, v in enumerate(order)]), F.col(column)), F.lit(0))


def ordinal_encode(df: DataFrame, column: str, order: list[str], output: str | None = None) -> DataFrame:
    return df.withColumn(output or column, ordinal_column(column, order))


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """(value, freq): relative frequency among the rows that have a value."""
    present = df.where(F.col(column).isNotNull())
    total = present.count()
    return (present.groupBy(F.col(column).alias("value"))
            .agg((F.count(F.lit(1)) / F.lit(float(total))).alias("freq")))


def frequency_encode(df: DataFrame, column: str, fitted: DataFrame | None = None, output: str | None = None) -> DataFrame:
    """Value to its relative frequency in the fitted rows; unseen or null gives 0.

    The dictionary has no size bound (card numbers), so no broadcast is forced:
    Spark broadcasts it only below its own size threshold.
    """
    fitted = frequencies(df, column) if fitted is None else fitted
    table = fitted.select(F.col("value").alias("_v"), F.col("freq").alias("_f"))
    joined = df.join(table, df[column] == table["_v"], "left")
    return joined.withColumn(output or column, F.coalesce("_f", F.lit(0.0))).drop("_v", "_f")


# --- fit / transform ---------------------------------------------------------

@dataclass
class Fitted:
    """Statistics of one table; a transform is one select over them."""
    spec: TableSpec
    numeric: dict[str, tuple[float, float]] = field(default_factory=dict)
    fill: dict[str, Any] = field(default_factory=dict)
    classes: dict[str, list | DataFrame] = field(default_factory=dict)
    features: list[str] | None = None

    def summary(self) -> dict:
        return {"fitted": True, "seed": self.spec.seed, "transformers": len(self.numeric) + len(self.classes),
                "output_count": len(self.features or []), "output_features": list(self.features or [])}

    def feature_names(self) -> list[str]:
        if self.features is None:
            raise ValueError("transform a table first")
        return self.features


def mode_values(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Most frequent value per column, ties to the smallest; one shuffle for all columns."""
    best = (value_counts(df, columns).groupBy("column")
            .agg(F.min_by("value", F.struct((-F.col("count")).alias("c"), F.col("value").alias("v"))).alias("value")))
    got = {r["column"]: r["value"] for r in best.collect()}  # one row per column
    return {c: got.get(c, UNKNOWN) for c in columns}


def fit(df: DataFrame, spec: TableSpec) -> Fitted:
    validate_input(df, list(spec.columns))
    out = Fitted(spec)
    numeric = columns_by_kind(df, spec.kinds(), NUMERICAL)
    standard = [c for c in numeric if spec.columns[c].scaling == "standard"]
    minmax = [c for c in numeric if spec.columns[c].scaling == "minmax"]
    if standard:
        out.numeric.update(standard_stats(df, standard))
    if minmax:
        out.numeric.update(minmax_stats(df, minmax))
    categorical = columns_by_kind(df, spec.kinds(), CATEGORICAL)
    if categorical:
        text = df.select(*[F.col(c).cast("string").alias(c) for c in categorical])
        out.fill = mode_values(text, categorical)
        for c in categorical:
            s = spec.columns[c]
            if s.encoding == "ordinal":
                if not s.ordinal:
                    raise ValueError(f"column {c!r}: an ordinal code needs an order")
                out.classes[c] = list(s.ordinal)
                continue
            filled = text.select(F.coalesce(F.col(c), F.lit(out.fill[c])).alias(c))
            few = few_classes(filled, c)
            if few is None and s.encoding == "onehot":
                raise ValueError(f"column {c!r} has more than {LITERAL_CLASSES} classes; use label or frequency codes")
            out.classes[c] = few if few is not None else classes(filled, c)
    return out


def transform(df: DataFrame, fitted: Fitted | None, row_id: str = "row_id") -> DataFrame:
    """Numeric block, then categorical block; identifiers dropped, `row_id` kept."""
    if fitted is None:
        raise ValueError("fit first")
    spec = fitted.spec
    validate_input(df, list(spec.columns))
    select: dict[str, Column] = {}
    joins: list[tuple[str, DataFrame]] = []
    for c in columns_by_kind(df, spec.kinds(), NUMERICAL):
        how = spec.columns[c].scaling
        if how == "standard":
            select[c] = standard_column(c, *fitted.numeric[c])
        elif how == "minmax":
            select[c] = minmax_column(c, *fitted.numeric[c])
        else:
            select[c] = F.col(c)
    for c in columns_by_kind(df, spec.kinds(), CATEGORICAL):
        known = fitted.classes.get(c)
        df = df.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(fitted.fill[c])))
        how = spec.columns[c].encoding
        if how == "onehot":
            select.update(onehot_columns(c, known))
        elif how == "ordinal":
            select[c] = ordinal_column(c, known)
        elif isinstance(known, list):
            select[c] = label_column(c, known)
        else:
            joins.append((c, known))
            select[c] = F.col(c)
    out = df.select(row_id, *[e.alias(n) for n, e in select.items()])
    for c, table in joins:
        out = label_encode(out, c, table)
    fitted.features = list(select)
    return out.select(row_id, *fitted.features)


def fit_transform(df: DataFrame, spec: TableSpec, row_id: str = "row_id") -> tuple[DataFrame, Fitted]:
    fitted = fit(df, spec)
    return transform(df, fitted, row_id), fitted


# --- decoding of an anonymised table -----------------------------------------

def midpoint(c: str) -> Column:
    """Middle of a `lo-hi` label of exactly two numeric parts, else null."""
    parts = F.split(F.col(c), "-")
    lo, hi = F.trim(F.get(parts, F.lit(0))).try_cast("double"), F.trim(F.get(parts, F.lit(1))).try_cast("double")
    return F.when(F.size(parts) == 2, (lo + hi) / F.lit(2.0))


def decode_anonymised(df: DataFrame, row_id: str = "row_id", identifiers: tuple[str, ...] = ()) -> DataFrame:
    """Ranges to midpoints, other text to label codes, remaining nulls to 0.

    Identifier columns are left out of the result; pass them in `identifiers`.
    """
    columns = [c for c in df.columns if c != row_id and c not in identifiers]
    text = [c for c in columns if is_text(df, c)]
    facts = {}
    if text:
        row = df.agg(*[e.alias(f"{n}{i}") for i, c in enumerate(text) for n, e in (
            ("d", F.max(F.col(c).contains("-"))), ("m", F.count(midpoint(c))))]).first()
        facts = {c: (bool(row[f"d{i}"]), row[f"m{i}"]) for i, c in enumerate(text)}
    out = df
    for c in columns:
        if c in text:
            dashed, ranges = facts[c]
            if dashed and ranges:
                out = out.withColumn(c, F.coalesce(midpoint(c), F.lit(0.0)))
            else:
                out = label_encode(out.withColumn(c, F.coalesce(F.col(c), F.lit("unknown"))), c)
        elif is_numeric(df, c):
            zero = F.lit(0).cast(df.schema[c].dataType)
            out = out.withColumn(c, F.when(is_missing(c, df), zero).otherwise(F.col(c)))
        else:
            out = label_encode(out.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit("unknown"))), c)
    return out.select(row_id, *columns)
