"""Statistics, column profile, kind rules and the default specification."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sparkloom.functions.ranks import exact_quantiles
from sparkloom.operators.checks import is_missing, require_complete, require_numeric
from sparkloom.session import cut
from sparkloom.sources.spec import ColumnSpec, TableSpec

# Fixed values of the kind rules.
IDENTIFIER_NAMES = ("id", "student_id", "user_id")
QUASI_IDENTIFIER_NAMES = ("age", "gender", "parental_education_level", "internet_quality", "part_time_job")
ORDINAL_NAME_PARTS = ("quality", "level", "grade", "rating", "education")
ORDINAL_WORDS = ("poor", "fair", "good", "low", "medium", "high", "bad", "average",
                 "none", "high school", "bachelor", "master")
ORDINAL_SCALES = (("Poor", "Fair", "Good"),
                  ("None", "High School", "Bachelor", "Master"),
                  ("Poor", "Average", "Good"))
TOP_VALUES = 10
MAX_LEVELS = 1000  # levels of an ordinal column; more raise


def is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.NumericType)


def is_text(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


# --- single statistics -----------------------------------------------------

def mean(df: DataFrame, column: str) -> DataFrame:
    require_numeric(df, column)
    require_complete(df, column)
    return df.agg(F.avg(column).alias("mean"))


def median(df: DataFrame, column: str) -> DataFrame:
    """Exact interpolated median; one row."""
    require_numeric(df, column)
    require_complete(df, column)
    value = exact_quantiles(df, [column], [0.5])[column]
    return df.sparkSession.range(1).select(F.lit(value[0] if value else None).cast("double").alias("median"))


def modes(df: DataFrame, column: str, allow_missing: bool = False) -> DataFrame:
    """All values tied for the highest count: (value, count), in value order."""
    if not allow_missing:
        require_complete(df, column)
    counts = (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
              .agg(F.count(F.lit(1)).alias("count")))
    top = counts.agg(F.max("count").alias("count"))  # one row
    return counts.join(F.broadcast(top), "count", "left_semi").select("value", "count").orderBy("value")


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, count) of the non-null values of several columns, as text.

    One shuffle serves distinct counts, modes, top values and entropies.
    """
    def text(c: str) -> Column:
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            # -0.0 and 0.0 are one value; NaN counts as missing
            return F.when(~F.isnan(c), (F.col(c) + F.lit(0.0)).cast("string"))
        return F.col(c).cast("string")
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), text(c).alias("value")) for c in columns])))
    return (long.where("value is not null").groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("count")))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, distinct_values), columns without values included."""
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    got = value_counts(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    return (names.join(got, "column", "left")
            .withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0).cast("bigint"))))


def entropy(df: DataFrame, columns: list[str]) -> DataFrame:
    """-sum p*log2(p + 1e-10) per column; nulls stay in the denominator."""
    p = F.col("count") / F.lit(df.count())
    # sum over multiplicities: many values share a count, so the log runs once per count
    return (value_counts(df, columns).groupBy("column", "count").agg(F.count(F.lit(1)).alias("times"))
            .groupBy("column").agg((-F.sum(F.col("times") * p * F.log2(p + F.lit(1e-10)))).alias("entropy")))


# --- histogram and density -------------------------------------------------

def bin_count(n: int, low: float, high: float, iqr: float) -> int:
    """The narrower of the Sturges and Freedman-Diaconis widths."""
    if n == 0 or high == low:
        return 1
    sturges = (high - low) / (math.log2(n) + 1.0)
    fd = 2.0 * iqr / n ** (1.0 / 3.0)
    width = min(sturges, fd) if fd > 0 else sturges
    return max(1, math.ceil((high - low) / width))


def histogram(df: DataFrame, column: str, bins: int | str = "auto") -> DataFrame:
    """(bin, low, high, count); equal widths, the last bin closed on the right."""
    require_numeric(df, column)
    n, lo, hi = df.agg(F.count(column), F.min(column), F.max(column)).first()
    if not n:
        raise ValueError(f"column {column!r} has no values")
    lo, hi = float(lo), float(hi)
    if bins == "auto":
        q1, q3 = exact_quantiles(df, [column], [0.25, 0.75])[column]
        bins = bin_count(n, lo, hi, q3 - q1)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    index = F.least(F.floor((F.col(column).cast("double") - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = (df.where(F.col(column).isNotNull()).groupBy(index.alias("bin"))
              .agg(F.count(F.lit(1)).alias("count")))
    edges = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), (F.lit(lo) + F.col("id") * F.lit(width)).alias("low"),
        (F.lit(lo) + (F.col("id") + 1) * F.lit(width)).alias("high"))
    return (edges.join(counts, "bin", "left")
            .withColumn("count", F.coalesce("count", F.lit(0).cast("bigint"))))


def density(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """(point, x, density): Gaussian kernel density with Scott's bandwidth."""
    require_numeric(df, column)
    n, lo, hi, std = df.agg(F.count(column), F.min(column), F.max(column), F.stddev_samp(column)).first()
    if not n or not std:
        raise ValueError("a density needs at least two different values")
    lo, hi = float(lo), float(hi)
    h = std * n ** (-0.2)
    grid = [lo + (hi - lo) * i / (points - 1) for i in range(points)]
    # equal values are folded first, then each meets the fixed grid
    folded = (df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v"))
              .agg(F.count(F.lit(1)).alias("times")))
    z = (F.col("x") - F.col("v")) / F.lit(h)
    return (folded.select("v", "times", F.posexplode(F.array(*[F.lit(g) for g in grid])).alias("point", "x"))
            .groupBy("point", "x")
            .agg((F.sum(F.col("times") * F.exp(F.lit(-0.5) * z * z))
                  / F.lit(n * h * math.sqrt(2.0 * math.pi))).alias("density")))


# --- profile and kinds -----------------------------------------------------

def column_profile(df: DataFrame, columns: list[str] | None = None, medians: bool = True) -> DataFrame:
    """One row per column: type, distinct, missing, numeric statistics, top values.

    One wide aggregate, one value-count shuffle and the median's counting
    passes, whatever the number of columns.
    """
    columns = columns or df.columns
    numeric = [c for c in columns if is_numeric(df, c)]
    text = [c for c in columns if is_text(df, c)]
    med = exact_quantiles(df, numeric, [0.5]) if medians and numeric else {}
    exprs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        exprs.append(F.count_if(is_missing(c, df)).alias(f"m{i}"))
        if c in numeric:
            v = F.when(~is_missing(c, df), F.col(c).cast("double"))
            exprs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
                      F.avg(v).alias(f"av{i}"), F.stddev_samp(v).alias(f"sd{i}")]
    one = df.agg(*exprs)
    nothing = F.lit(None).cast("double")

    def row(i: int, c: str) -> Column:
        num = c in numeric
        return F.struct(
            F.lit(i).alias("ordinal"), F.lit(c).alias("column"),
            F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
            F.lit("numeric" if num else "text" if c in text else "other").alias("family"),
            F.col("rows"), F.col(f"m{i}").alias("missing"),
            *[(F.col(f"{k}{i}") if num else nothing).alias(n)
              for k, n in (("lo", "min_value"), ("hi", "max_value"), ("av", "mean_value"), ("sd", "std_value"))],
            F.lit(med[c][0] if num and med.get(c) else None).cast("double").alias("median_value"))

    stats = one.select(F.inline(F.array(*[row(i, c) for i, c in enumerate(columns)])))
    counts = value_counts(df, columns)
    distinct = counts.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    # rank <= 10 is pushed below the exchange, so each task sends ten rows per column
    best_first = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    top = (counts.where(F.col("column").isin(text)).withColumn("rank", F.row_number().over(best_first))
           .where(F.col("rank") <= TOP_VALUES).groupBy("column")
           .agg(F.sort_array(F.collect_list(F.struct("rank", "value", "count"))).alias("top"))
           .select("column", F.col("top.value")[0].alias("top_value"), F.col("top.count")[0].alias("top_count"),
                   F.col("top.value").alias("categories")))
    # all values of text columns with at most MAX_LEVELS of them
    few = distinct.where((F.col("distinct_values") <= MAX_LEVELS) & F.col("column").isin(text)).select("column")
    levels = (counts.join(F.broadcast(few), "column").groupBy("column")
              .agg(F.sort_array(F.collect_list("value")).alias("levels")))
    pct = lambda c: F.try_divide(F.lit(100.0) * F.col(c), F.col("rows"))
    # one row per column on every side
    return (stats.join(F.broadcast(distinct), "column", "left").join(F.broadcast(top), "column", "left")
            .join(F.broadcast(levels), "column", "left")
            .withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0).cast("bigint")))
            .withColumns({"distinct_pct": pct("distinct_values"), "missing_pct": pct("missing")}))


SKETCH_LG = 12  # 4 096 registers: counts to about 300 are exact, others within 1.6 % as a standard error
NEAR_HALF = (0.45, 0.55)  # of the rows: columns whose count lies this near to the limit of a kind are counted exactly


def _hashed(df: DataFrame, c: str) -> Column:
    """A 64-bit number for each present value; -0.0 is 0.0."""
    v = F.col(c) + F.lit(0.0) if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else F.col(c)
    return F.when(~is_missing(c, df), F.xxhash64(v))


def kind_facts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """What `column_kinds` needs and no more: one aggregate without an exchange of values.

    Distinct values come from a sketch.  Columns whose sketch is near half of the
    rows, a limit of the kind rules, are counted exactly; so are the values of
    text columns in which a word of a known scale occurs.  `distinct_values` of other columns is
    an estimate; the kinds are those of `column_profile`.
    """
    columns = columns or df.columns
    numeric = [c for c in columns if is_numeric(df, c)]
    text = [c for c in columns if is_text(df, c)]
    exprs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        exprs.append(F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(_hashed(df, c), SKETCH_LG)), F.lit(0).cast("bigint")).alias(f"d{i}"))
        if c in numeric:
            v = F.when(~is_missing(c, df), F.col(c).cast("double"))
            exprs += [F.avg(v).alias(f"av{i}"), F.stddev_samp(v).alias(f"sd{i}")]
        elif c in text:
            exprs.append(F.count_if(F.lower(c).isin(*ORDINAL_WORDS)).alias(f"w{i}"))
    row = df.agg(*exprs).first()
    n = row["rows"]
    found = {c: row[f"d{i}"] for i, c in enumerate(columns)}
    near = [c for c in numeric if NEAR_HALF[0] * n <= found[c] <= NEAR_HALF[1] * n]
    if near:
        found.update({r["column"]: r["distinct_values"] for r in distinct_counts(df, near).collect()})  # one row per column
    worded = [c for i, c in enumerate(columns) if c in text and row[f"w{i}"]]
    tops: dict[str, list[str]] = {}
    if worded:
        best_first = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
        top = value_counts(df, worded).withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= TOP_VALUES)
        for r in top.collect():  # TOP_VALUES rows per column
            tops.setdefault(r["column"], []).append(r["value"])
    rows = [(i, c, "numeric" if c in numeric else "text" if c in text else "other", found[c], 100.0 * found[c] / n if n else None,
             row[f"av{i}"] if c in numeric else None, row[f"sd{i}"] if c in numeric else None, tops.get(c, []))
            for i, c in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column string, family string, distinct_values bigint, distinct_pct double, "
                                                 "mean_value double, std_value double, categories array<string>")


# --- profiles that merge ---------------------------------------------------------

TOP_TRACKED = 1000  # values that the heavy hitters of a text column keep


def sketch_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One mergeable row per column, from one aggregate and without an exchange of values.

    Counts, range, mean and squares are exact.  Sketches stand for the values: distinct counts within 1.6 %, quantiles within
    about 1.3 % of the ranks, and the frequent values of text columns.  Rows of several days or files, stored as a table, become
    the profile of all of them by `merge_profiles`.
    """
    columns = columns or df.columns
    numeric, text = {c for c in columns if is_numeric(df, c)}, {c for c in columns if is_text(df, c)}
    exprs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        exprs += [F.count_if(is_missing(c, df)).alias(f"m{i}"), F.hll_sketch_agg(_hashed(df, c), SKETCH_LG).alias(f"h{i}")]
        if c in numeric:
            v = F.when(~is_missing(c, df), F.col(c).cast("double"))
            exprs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.avg(v).alias(f"av{i}"),
                      (F.var_pop(v) * F.count(v)).alias(f"sq{i}"), F.kll_sketch_agg_double(v).alias(f"k{i}")]
        elif c in text:
            exprs.append(F.expr(f"approx_top_k_accumulate(`{c}`, {TOP_TRACKED})").alias(f"t{i}"))
    one = cut(df.agg(*exprs))
    top_type = next((one.schema[f"t{i}"].dataType for i, c in enumerate(columns) if c in text), T.NullType())
    out = None
    for i, c in enumerate(columns):
        none = F.lit(None).cast("double")
        row = one.select(
            F.lit(i).alias("ordinal"), F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
            F.lit("numeric" if c in numeric else "text" if c in text else "other").alias("family"), "rows", F.col(f"m{i}").alias("missing"),
            *[(F.col(f"{k}{i}") if c in numeric else none).alias(n) for k, n in (("lo", "min_value"), ("hi", "max_value"), ("av", "mean_value"), ("sq", "squares"))],
            F.col(f"h{i}").alias("distinct"), (F.col(f"k{i}") if c in numeric else F.lit(None).cast("binary")).alias("quantiles"),
            (F.col(f"t{i}") if c in text else F.lit(None).cast(top_type)).alias("top"))
        out = row if out is None else out.unionByName(row)
    return out


def merge_profiles(parts: DataFrame) -> DataFrame:
    """One row per column from the rows of `sketch_profile` over parts of a table."""
    n = F.col("rows") - F.col("missing")
    total = F.sum(n)
    mean = F.try_divide(F.sum(n * F.col("mean_value")), total)
    text = parts.schema["top"].dataType != T.NullType()
    merged = parts.groupBy("column").agg(
        F.min("ordinal").alias("ordinal"), F.first("dtype").alias("dtype"), F.first("family").alias("family"), F.sum("rows").alias("rows"),
        F.sum("missing").alias("missing"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"), mean.alias("mean_value"),
        # squares around the parts' means, and of these around the common one
        (F.sum("squares") + F.greatest(F.lit(0.0), F.sum(n * F.col("mean_value") * F.col("mean_value")) - total * mean * mean)).alias("squares"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"))
    if not text:
        return merged.withColumn("top", F.lit(None))
    top = parts.where("top IS NOT NULL").groupBy("column").agg(F.expr(f"approx_top_k_combine(top, {TOP_TRACKED})").alias("top"))
    return merged.join(F.broadcast(top), "column", "left")  # one row per column


def estimated_profile(profile: DataFrame) -> DataFrame:
    """What a row of `sketch_profile` says: counts and moments as they are, distinct values, quartiles and top values as estimates."""
    n = F.col("rows") - F.col("missing")
    quartiles = [F.when((F.col("family") == "numeric") & (n > 0), F.kll_sketch_get_quantile_double("quantiles", F.lit(q))).alias(c)
                 for q, c in ((0.25, "lower_quartile"), (0.5, "median_value"), (0.75, "upper_quartile"))]
    top = F.expr(f"CASE WHEN top IS NOT NULL THEN approx_top_k_estimate(top, {TOP_VALUES}) END") if profile.schema["top"].dataType != T.NullType() else F.lit(None)
    return profile.select(
        "ordinal", "column", "dtype", "family", "rows", "missing", "min_value", "max_value", "mean_value",
        F.when(n > 1, F.sqrt(F.col("squares") / (n - 1))).alias("std_value"),
        F.hll_sketch_estimate("distinct").alias("distinct_values"), *quartiles, top.alias("top"))


def ordinal_test() -> Column:
    """Name hints at a scale, or a top value is a word of a known scale."""
    named = F.lower("column").rlike("|".join(ORDINAL_NAME_PARTS))
    worded = F.arrays_overlap(F.transform("categories", F.lower), F.array(*[F.lit(w) for w in ORDINAL_WORDS]))
    return named | F.coalesce(worded, F.lit(False))


def column_kinds(profile: DataFrame) -> DataFrame:
    """Adds `kind` to a profile."""
    distinct, sd, av = F.col("distinct_values"), F.col("std_value"), F.col("mean_value")
    spread = F.when(F.abs(av) > 1e-6, sd / F.abs(av) > 0.3).otherwise(sd >= 1.0)
    numeric = (F.when((F.col("distinct_pct") > 50) & (distinct > 20), "numerical_continuous")
               .when(distinct <= 20, "numerical_discrete")
               .when((sd > 0) & ~spread, "numerical_discrete")
               .otherwise("numerical_continuous"))
    return profile.withColumn(
        "kind",
        F.when(F.lower("column").isin(*IDENTIFIER_NAMES), "identifier")
        .when(F.col("family") == "numeric", numeric)
        .when((F.col("family") == "text") & ordinal_test(), "categorical_ordinal")
        .otherwise("categorical_nominal"))


def ordinal_order(values: list[str]) -> list[str]:
    """Known scale if all its words occur (exact spelling kept), else alphabetical."""
    lower = {v.lower() for v in values}
    for scale in ORDINAL_SCALES:
        if {w.lower() for w in scale} <= lower:
            return [w for w in scale if w in values]
    return sorted(values)


def default_spec(profile: DataFrame, seed: int = 42) -> TableSpec:
    """Specification derived from the profile rows (one per column)."""
    columns = {}
    kinds = profile if "kind" in profile.columns else column_kinds(profile)
    for r in kinds.orderBy("ordinal").collect():
        scaling = encoding = order = None
        if r["kind"].startswith("numerical"):
            scaling = "standard"
        elif r["kind"] == "categorical_nominal":
            encoding = "onehot" if r["distinct_values"] <= 10 else "label"
        elif r["kind"] == "categorical_ordinal":
            encoding = "ordinal"
            if r["levels"] is None and r["distinct_values"]:
                raise ValueError(f"column {r['column']!r} has {r['distinct_values']} levels, more than {MAX_LEVELS}")
            order = ordinal_order(list(r["levels"] or []))
        columns[r["column"]] = ColumnSpec(
            name=r["column"], kind=r["kind"], scaling=scaling, encoding=encoding, ordinal=order,
            is_quasi_identifier=r["column"].lower() in QUASI_IDENTIFIER_NAMES)
    return TableSpec(columns=columns, seed=seed)


# --- diagnosis -------------------------------------------------------------

def correlations(df: DataFrame, columns: list[str], threshold: float | None = None) -> DataFrame:
    """(left, right, r) for all pairs of columns from one aggregate; |r| above the threshold."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    one = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    out = one.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)])))
    return out if threshold is None else out.where(F.abs("r") > threshold)


def average_ranks(df: DataFrame, column: str) -> DataFrame:
    """(value, rank_value): tied average rank of each distinct value.

    Ranks come from counts of distinct values: groups of equal values never
    meet in one task.
    """
    from sparkloom.functions.ranks import with_position
    folded = (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
              .agg(F.count(F.lit(1)).alias("times")))
    placed = with_position(folded, ["value"], "_pos")
    # running totals: per block of positions first, then inside each block
    block = F.floor(F.col("_pos") / F.lit(100_000))
    blocked = cut_blocks(placed.withColumn("_block", block))
    inside = F.sum("times").over(Window.partitionBy("_block").orderBy("_pos")
                                 .rowsBetween(Window.unboundedPreceding, 0))
    return blocked.select("value", (F.col("_before") + inside - (F.col("times") - 1) / F.lit(2.0)).alias("rank_value"))


def cut_blocks(df: DataFrame) -> DataFrame:
    """Adds the number of rows in earlier blocks; one row per block of 100 000 distinct values."""
    totals = df.groupBy("_block").agg(F.sum("times").alias("_t"))
    # two levels: inside groups of 1000 blocks, and over the groups, of which there is one per 100 million distinct values
    group = F.floor(F.col("_block") / F.lit(1000))
    earlier = F.sum("_t").over(Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    groups, start = [], 0
    for r in sorted(totals.groupBy(group.alias("g")).agg(F.sum("_t").alias("t")).collect()):
        groups.append((r["g"], start))
        start += r["t"]
    starts = df.sparkSession.createDataFrame(groups, "_g bigint, _start bigint")
    placed = totals.withColumn("_inside", F.coalesce(earlier, F.lit(0))).withColumn("_g", group).join(F.broadcast(starts), "_g")
    return df.join(placed.select("_block", (F.col("_start") + F.col("_inside")).alias("_before")), "_block")


def spearman(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rank correlation of all pairs; missing values take the column's median."""
    med = exact_quantiles(df, columns, [0.5])
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(med[c][0])).alias(c) for c in columns])
    for i, c in enumerate(columns):
        ranks = cut(average_ranks(filled, c)).select(F.col("value").alias(c), F.col("rank_value").alias(f"_r{i}"))
        # the fill value may be a large part of the rows: its rank is a literal, and its rows spread over the join
        mine = ranks.where(F.col(c) == F.lit(med[c][0])).first()
        fill = F.col(c) == F.lit(med[c][0])
        rank = F.lit(mine[f"_r{i}"] if mine else None).cast("double")
        key = F.when(fill, -1 - F.pmod(F.xxhash64(*filled.columns), F.lit(1000))).otherwise(0)
        filled = (filled.withColumn("_salt", key).join(ranks.withColumn("_salt", F.lit(0)), [c, "_salt"], "left")
                  .withColumn(f"_r{i}", F.when(fill, rank).otherwise(F.col(f"_r{i}"))).drop("_salt"))
    ranked = filled.select(*[F.col(f"_r{i}").alias(c) for i, c in enumerate(columns)])
    return correlations(ranked, columns)


def iqr_outliers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values outside Q1 - 1.5 IQR .. Q3 + 1.5 IQR: (column, q1, q3, low, high, outliers, outlier_pct)."""
    q = exact_quantiles(df, columns, [0.25, 0.75])
    fences = {c: (v[0], v[1], v[0] - 1.5 * (v[1] - v[0]), v[1] + 1.5 * (v[1] - v[0])) for c, v in q.items() if v}
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[
        F.count_if((F.col(c) < F.lit(f[2])) | (F.col(c) > F.lit(f[3]))).alias(f"o{i}")
        for i, (c, f) in enumerate(fences.items())])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(f[0]).alias("q1"), F.lit(f[1]).alias("q3"),
                 F.lit(f[2]).alias("low"), F.lit(f[3]).alias("high"), F.col(f"o{i}").alias("outliers"),
                 (F.lit(100.0) * F.col(f"o{i}") / F.col("rows")).alias("outlier_pct"))
        for i, (c, f) in enumerate(fences.items())])))


def scale_check(df: DataFrame, columns: list[str]) -> DataFrame:
    """Range above 1000 or sample std above 100 flags a scale problem."""
    one = df.agg(*[e.alias(f"{n}{i}") for i, c in enumerate(columns) for n, e in (
        ("lo", F.min(c).cast("double")), ("hi", F.max(c).cast("double")), ("sd", F.stddev_samp(c)))])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"),
                 F.col(f"sd{i}").alias("std_value"),
                 ((F.col(f"hi{i}") - F.col(f"lo{i}") > 1000) | (F.col(f"sd{i}") > 100)).alias("scale_problem"))
        for i, c in enumerate(columns)])))


def variance_ranking(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """The n columns with the largest sample variance and the quality estimate.

    quality = mean of the chosen variances / (mean of all + 1e-6).
    """
    one = df.agg(*[F.coalesce(F.var_samp(c), F.lit(0.0)).alias(f"v{i}") for i, c in enumerate(columns)])
    rows = one.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column"), F.col(f"v{i}").alias("variance"))
        for i, c in enumerate(columns)])))
    everything = Window.partitionBy(F.lit(1))  # one row per column
    ranked = (rows.withColumn("rank", F.row_number().over(everything.orderBy(F.desc("variance"), "ordinal")))
              .withColumn("_all", F.avg("variance").over(everything)))
    return (ranked.where(F.col("rank") <= n)
            .withColumn("quality", F.avg("variance").over(everything) / (F.col("_all") + F.lit(1e-6)))
            .select("rank", "column", "variance", "quality"))
