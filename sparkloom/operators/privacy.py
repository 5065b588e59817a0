"""k-anonymity reports, generalisation and suppression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sparkloom.functions.ranks import exact_quantiles, with_position
from sparkloom.operators.checks import is_missing
from sparkloom.operators.profile import QUASI_IDENTIFIER_NAMES, distinct_counts, entropy, is_numeric
from sparkloom.session import cut

# Bins per level and the usual quasi-identifiers.
BIN_COUNTS = {"low": 8, "moderate": 4, "high": 2}
MASK = "***"
DEFAULT_QIS = QUASI_IDENTIFIER_NAMES

# Fixed values of the text generalisation.
GENDER_SHORT = {"Male": "M", "Female": "F", "Other": "O"}
EDUCATION_GROUPS = {
    "None": "No Formal Education",
    "Primary": "Basic Education",
    "Secondary": "Basic Education",
    "High School": "Secondary Education",
    "Bachelor": "Higher Education",
    "Master": "Higher Education",
    "PhD": "Higher Education",
}
HIGHER_WORDS = ("bachelor", "master", "phd")
QUALITY_HIGH = ("5", "4", "Excellent", "Good")
QUALITY_MEDIUM = ("3", "Average")


# --- classes and reports -------------------------------------------------------

def _require(df: DataFrame, qis: list[str]) -> None:
    absent = sorted(set(qis) - set(df.columns))
    if absent:
        raise ValueError(f"quasi-identifiers not in the table: {absent}")


def class_sizes(df: DataFrame, qis: list[str]) -> DataFrame:
    """(qis..., group_size); rows with a null key belong to no class.

    Partial aggregation runs before the shuffle, so one class holding a third
    of the rows sends one row per task.
    """
    _require(df, qis)
    # plain null tests reach the scan, na.drop would not
    present = reduce(lambda a, b: a & b, [~is_missing(c, df) for c in qis])
    return df.where(present).groupBy(*qis).agg(F.count(F.lit(1)).alias("group_size"))


def equivalence_classes(df: DataFrame, qis: list[str]) -> DataFrame:
    """Classes with a running `group_id` in order of size, then keys."""
    return with_position(class_sizes(df, qis), ["group_size", *qis], "group_id")


def size_histogram(classes: DataFrame) -> DataFrame:
    """(group_size, groups): at most sqrt(2 * rows) rows."""
    return classes.groupBy("group_size").agg(F.count(F.lit(1)).alias("groups"))


def group_stats(classes: DataFrame) -> DataFrame:
    """One row: number of classes, min, max, mean, median, sample std, classes and rows of size 1.

    Everything comes from the size histogram; its size is bounded by the square
    root of the row count, so the exact weighted median fits one buffer.
    """
    h = size_histogram(classes)
    size, times = F.col("group_size").cast("double"), F.col("groups")
    n, s = F.sum(times), F.sum(size * times)
    # squares around the mean keep their digits; the histogram is small, so a second pass costs nothing
    mean = h.agg((s / n).alias("m")).first()["m"] or 0.0
    q = F.sum((size - F.lit(mean)) * (size - F.lit(mean)) * times)
    return (h.agg(
        n.alias("total_groups"), F.min("group_size").alias("min_group_size"), F.max("group_size").alias("max_group_size"),
        (s / n).alias("mean_group_size"), F.percentile("group_size", 0.5, times).alias("median_group_size"),
        F.sqrt(F.try_divide(q, n - F.lit(1))).alias("std_group_size"),
        F.coalesce(F.sum(F.when(size == 1, times)), F.lit(0)).alias("vulnerable_groups"),
        F.coalesce(F.sum(F.when(size == 1, times)), F.lit(0)).alias("vulnerable_rows")))


def vulnerability(classes: DataFrame) -> DataFrame:
    """Unique and small (below 5) classes; percentages are of classes, not rows."""
    h = size_histogram(classes)
    size, times = F.col("group_size"), F.col("groups")
    zero = F.lit(0).cast("bigint")
    some = lambda cond, x: F.coalesce(F.sum(F.when(cond, x)), zero)
    out = h.agg(F.sum(times).alias("_n"), some(size == 1, times).alias("unique_count"),
                some(size < 5, times).alias("small_groups"), some(size < 5, size * times).alias("small_rows"))
    pct = lambda c: F.coalesce(F.try_divide(F.lit(100.0) * F.col(c), F.col("_n")), F.lit(0.0))
    return (out.withColumns({"unique_pct": pct("unique_count"), "small_groups_pct": pct("small_groups")}).drop("_n"))


def qi_impact(df: DataFrame, qis: list[str]) -> DataFrame:
    """(column, distinct_values, uniqueness_ratio, entropy) per quasi-identifier."""
    n = df.count()
    # one row per quasi-identifier on both sides
    return (distinct_counts(df, qis).join(F.broadcast(entropy(df, qis)), "column", "left")
            .withColumn("uniqueness_ratio", F.try_divide(F.col("distinct_values").cast("double"), F.lit(n)))
            .withColumn("entropy", F.coalesce("entropy", F.lit(0.0))))


def risk(classes: DataFrame) -> DataFrame:
    """Rows in classes of size 1, 2 and below 5, their shares and the risk level."""
    h = size_histogram(classes)
    size, rows = F.col("group_size"), F.col("group_size") * F.col("groups")
    zero = F.lit(0).cast("bigint")
    out = h.agg(F.coalesce(F.sum(rows), zero).alias("_n"), *[
        F.coalesce(F.sum(F.when(cond, rows)), zero).alias(name) for name, cond in (
            ("rows_unique", size == 1), ("rows_size_2", size == 2), ("rows_small", size < 5))])
    pct = lambda c: F.coalesce(F.try_divide(F.lit(100.0) * F.col(c), F.col("_n")), F.lit(0.0))
    u, s = F.col("percent_unique"), F.col("percent_small")
    return (out.withColumns({"percent_unique": pct("rows_unique"), "percent_size_2": pct("rows_size_2"),
                             "percent_small": pct("rows_small")})
            .withColumn("risk_level", F.when((u > 10) | (s > 20), "HIGH")
                        .when((u > 5) | (s > 10), "MEDIUM").otherwise("LOW")).drop("_n"))


def recommendations(stats: DataFrame) -> DataFrame:
    """Adds `codes` (array of strings) to `group_stats`."""
    k = F.col("min_group_size")
    level = (F.when(k == 1, "critical_unique_rows").when(k < 3, "raise_k_to_3")
             .when(k < 5, "raise_k_to_5").otherwise("k_sufficient"))
    share = F.try_divide(F.lit(100.0) * F.col("vulnerable_rows"), F.col("mean_group_size") * F.col("total_groups"))
    uneven = F.try_divide(F.col("max_group_size"), F.col("mean_group_size")) > 10
    codes = F.array(level, F.when(share > 10, "generalise_values"), F.when(uneven, "uneven_group_sizes"),
                    F.lit("review_identifying_attributes"), F.lit("consider_l_diversity"),
                    F.lit("review_quasi_identifiers"))
    return stats.withColumn("codes", F.array_compact(codes))


def k_report(df: DataFrame, qis: list[str]) -> DataFrame:
    """One row: k, all rows (nulls included), number of classes, QI list."""
    if df.isEmpty():
        raise ValueError("the table is empty")
    total = df.count()
    return class_sizes(df, qis).agg(
        F.min("group_size").alias("k"), F.lit(total).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("classes"), F.lit(",".join(qis)).alias("qis"))


def analyse(df: DataFrame, qis: list[str] | None = None) -> dict[str, DataFrame]:
    """The whole report as tidy DataFrames over one materialised class table."""
    qis = list(qis or [c for c in DEFAULT_QIS if c in df.columns])
    classes = cut(class_sizes(df, qis))
    stats = group_stats(classes)
    return {"summary": k_report(df, qis), "classes": classes, "groups": stats,
            "sizes": size_histogram(classes), "vulnerability": vulnerability(classes),
            "impact": qi_impact(df, qis), "risk": risk(classes), "recommendations": recommendations(stats)}


def text_key(df: DataFrame, c: str) -> Column:
    """Value as text; null and NaN become the group 'nan'."""
    return F.when(is_missing(c, df), F.lit("nan")).otherwise(F.col(c).cast("string"))


def compact_report(df: DataFrame, qis: list[str]) -> DataFrame:
    """k, rows, classes and size statistics, with null as a group of its own."""
    keyed = df.select(*[text_key(df, c).alias(c) for c in qis])
    h = size_histogram(keyed.groupBy(*qis).agg(F.count(F.lit(1)).alias("group_size")))
    size, times = F.col("group_size"), F.col("groups")
    zero = F.lit(0).cast("bigint")
    return h.agg(F.coalesce(F.min(size), zero).alias("k"), F.coalesce(F.sum(size * times), zero).alias("total_rows"),
                 F.coalesce(F.sum(times), zero).alias("classes"), F.coalesce(F.max(size), zero).alias("max_size"),
                 F.coalesce(F.try_divide(F.sum((size * times).cast("double")), F.sum(times)), F.lit(0.0)).alias("mean_size"),
                 F.coalesce(F.percentile(size, 0.5, times), F.lit(0.0)).alias("median_size"))


# --- generalisation --------------------------------------------------------------

# Limits and steps below.
def round_edge(b: float) -> float | int:
    """Edge rounded to the step of its magnitude (Python's half-even rounding)."""
    if b == 0:
        return 0
    if b < 1:
        return round(float(b), 1)
    for limit, step in ((10, 1), (100, 5), (1000, 50)):
        if b < limit:
            return round(b / step) * step
    return round(b / 500) * 500


def bin_edges(quantiles: list[float], low: float, high: float) -> list:
    """Distinct rising rounded edges, ends widened to the data."""
    edges = sorted({round_edge(q) for q in quantiles})
    if edges[0] > low:
        edges[0] = low
    if edges[-1] < high:
        edges[-1] = high
    return edges


def edge_label(lo, hi) -> str:
    return f"{lo}-{hi}"


def generalise_numeric(df: DataFrame, column: str, level: str) -> DataFrame:
    """Right-closed quantile bins labelled `lo-hi`; null becomes the text 'nan'.

    With too few values for the bins the column stays as it is.  The edges are
    at most nine numbers found by counting passes; binning is a projection.
    """
    bins = BIN_COUNTS.get(level, BIN_COUNTS["high"])
    present = df.where(~is_missing(column, df))
    head = present.agg(F.count(F.lit(1)), F.min(column), F.max(column)).first()
    n, low, high = head
    if n < bins + 1:
        return df
    integral = isinstance(df.schema[column].dataType, T.IntegralType)
    low, high = (int(low), int(high)) if integral else (float(low), float(high))
    q = exact_quantiles(present, [column], [i / bins for i in range(bins + 1)])[column]
    edges = bin_edges(q, low, high)
    return df.withColumn(column, bin_column(df, column, edges))


def bin_column(df: DataFrame, column: str, edges: list) -> Column:
    if len(edges) < 2:
        # a single edge spans no bin
        return F.lit("nan")
    v = F.col(column)
    out = F.when(is_missing(column, df) | (v < F.lit(edges[0])), "nan")
    for lo, hi in zip(edges, edges[1:]):
        out = out.when(v <= F.lit(hi), edge_label(lo, hi))
    return out.otherwise("nan")


def generalise_text(df: DataFrame, column: str, level: str) -> DataFrame:
    """Gender, education and quality maps by column name; other text is masked at `high`."""
    name = column.lower()
    text = text_key(df, column)
    mapped = lambda table: F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), text), text)
    if name in ("gender", "sex"):
        if level == "high":
            return df.withColumn(column, F.lit(MASK))
        return df.withColumn(column, mapped(GENDER_SHORT)) if level == "moderate" and "gender" in name else df
    if "education" in name:
        if level == "high":
            higher = reduce(lambda a, b: a | b, [F.lower(text).contains(w) for w in HIGHER_WORDS])
            return df.withColumn(column, F.when(higher, "Higher Education").otherwise("Other"))
        return df.withColumn(column, mapped(EDUCATION_GROUPS)) if level == "moderate" else df
    if "quality" in name or "rating" in name:
        if level in ("moderate", "high"):
            return df.withColumn(column, F.when(text.isin(*QUALITY_HIGH), "High")
                                 .when(text.isin(*QUALITY_MEDIUM), "Medium").otherwise("Low"))
        return df
    return df.withColumn(column, F.lit(MASK)) if level == "high" else df


def generalise(df: DataFrame, qis: list[str], level: str) -> DataFrame:
    """Every quasi-identifier rewritten by its type; absent columns are skipped."""
    out = df
    for c in qis:
        if c not in df.columns:
            continue
        out = generalise_numeric(out, c, level) if is_numeric(df, c) else generalise_text(out, c, level)
    return out


# --- suppression -------------------------------------------------------------------

def suppress_rare(df: DataFrame, qis: list[str], min_count: int = 3) -> DataFrame:
    """Drops rows of classes below `min_count`.

    Nothing happens when the table has fewer than 3 * min_count rows; when more
    than a quarter of the rows would go, `min_count` is lowered once, and if
    that is still too much nothing is dropped.  The rare keys are found by an
    aggregate and removed by an anti join: a class with a third of all rows is
    never gathered (a window count would gather it).
    """
    h = {}
    keyed = df.select(*[text_key(df, c).alias(c) for c in qis])
    sizes = keyed.groupBy(*qis).agg(F.count(F.lit(1)).alias("group_size"))
    # only sizes that can matter, plus the total: at most min_count rows
    counted = (sizes.groupBy(F.least("group_size", F.lit(min_count)).alias("s"))
               .agg(F.sum("group_size").alias("rows")).collect())
    h = {r["s"]: r["rows"] for r in counted}
    total = sum(h.values())
    text = df.withColumns({c: text_key(df, c) for c in qis})
    if total < 3 * min_count:
        return df
    lost = lambda m: sum(rows for s, rows in h.items() if s < m)
    if lost(min_count) == 0:
        return text
    if lost(min_count) / total * 100 > 25:
        min_count = max(1, min_count - 1)
        if lost(min_count) / total * 100 > 25 or lost(min_count) == 0:
            return text
    rare = sizes.where(F.col("group_size") < min_count).select(*qis)
    return text.join(rare, qis, "left_anti").select(*df.columns)


def anonymise(df: DataFrame, qis: list[str], level: str = "moderate") -> DataFrame:
    """Generalise, then suppress unique combinations when k < 2 at level `high`.

    k below 1 cannot occur in a non-empty table, so `low` and `moderate` never
    suppress.
    """
    present = [c for c in qis if c in df.columns]
    out = generalise(df, qis, level)
    if present and level == "high":
        k = compact_report(out, present).first()["k"]
        if k < 2:
            out = suppress_rare(out, present, 2)
    return out
