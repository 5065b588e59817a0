"""Registered queries: checks, statistics, profile, scalers and encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions.hashing import digest_sql
from sparkloom.operators import checks, encode, missing, profile
from sparkloom.plans.registry import query, r, rounded, rs, table
from sparkloom.session import cut
from sparkloom.sources.spec import ColumnSpec, TableSpec

# Order of the priorities for the ordinal code.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def holes_sql(table_: str, key: str, column: str, share: float, seed: int = 42) -> str:
    """A table with round(n * share) hashed nulls in one column."""
    return (f"(SELECT * REPLACE (CASE WHEN row_number() OVER (ORDER BY {digest_sql(seed, key)}) <= "
            f"round_even((SELECT count(*) FROM {table_}) * {share}::DOUBLE, 0) THEN NULL ELSE {column} END AS {column}) FROM {table_})")


# --- checks ---------------------------------------------------------------------

@query("SELECT p_partkey, p_size, p_retailprice FROM part")
def numeric_projection(spark, sf):
    part = table(spark, sf, "part")
    return checks.select_features(part, checks.numeric_columns(part, exclude=("p_partkey",)), "p_partkey")


@query("SELECT p_partkey, p_name, p_brand FROM part")
def nominal_projection(spark, sf):
    part = table(spark, sf, "part")
    kinds = {x["column"]: x["kind"] for x in profile.column_kinds(profile.kind_facts(part)).collect()}
    return part.select("p_partkey", *checks.columns_by_kind(part, kinds, {"categorical_nominal"}))


@query(f"SELECT c_custkey, c_acctbal FROM {holes_sql('customer', 'c_custkey', 'c_acctbal', 0.1)} WHERE c_acctbal IS NOT NULL")
def drop_missing(spark, sf):
    holes = missing.inject_random(table(spark, sf, "customer"), "c_acctbal", 0.1, row_id="c_custkey")
    return checks.drop_missing(holes, "c_acctbal").select("c_custkey", "c_acctbal")


@query("SELECT count(c_acctbal) AS complete_rows FROM customer")
def complete_guard(spark, sf):
    whole = checks.assert_complete(table(spark, sf, "customer"), "c_acctbal")
    return whole.agg(F.count("c_acctbal").alias("complete_rows"))


@query(f"""WITH h AS {holes_sql('orders', 'o_orderkey', 'o_totalprice', 0.2)}
SELECT unnest(['o_orderkey','o_custkey','o_orderstatus','o_totalprice','o_orderdate','o_orderpriority']) AS "column",
 unnest([count(*) - count(o_orderkey), count(*) - count(o_custkey), count(*) - count(o_orderstatus),
 count(*) - count(o_totalprice), count(*) - count(o_orderdate), count(*) - count(o_orderpriority)]) AS missing FROM h""")
def null_report(spark, sf):
    return checks.null_report(missing.inject_random(table(spark, sf, "orders"), "o_totalprice", 0.2, row_id="o_orderkey"))


@query("""SELECT o_orderkey, year(o_orderdate)::INTEGER AS "year", month(o_orderdate)::INTEGER AS "month",
day(o_orderdate)::INTEGER AS "day" FROM orders""")
def date_parts(spark, sf):
    return checks.date_parts(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


@query(f"""WITH h AS {holes_sql('orders', 'o_orderkey', 'o_totalprice', 0.3)},
c AS (SELECT count(*) AS rows_before, count(o_totalprice) AS rows_after FROM h)
SELECT rows_before, rows_after, {rs('100.0::DOUBLE * (rows_before - rows_after) / rows_before')} AS loss_pct,
CASE WHEN 100.0 * (rows_before - rows_after) / rows_before > 50 THEN 'error'
 WHEN 100.0 * (rows_before - rows_after) / rows_before > 20 THEN 'warning' ELSE 'ok' END AS verdict FROM c""")
def loss_check(spark, sf):
    holes = missing.inject_random(table(spark, sf, "orders"), "o_totalprice", 0.3, row_id="o_orderkey")
    return rounded(checks.loss_check(holes, checks.drop_missing(holes, "o_totalprice")), ["loss_pct"])


QUALITY_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {rs(f'stddev_samp({c})')} AS std, {rs(f'max({c}) - min({c})')} AS value_range,
count(DISTINCT {c}) AS distinct_values, CASE WHEN stddev_samp({c}) < 1e-6 OR max({c}) - min({c}) < 1e-6 THEN 'error'
WHEN count(DISTINCT {c}) < 10 THEN 'warning' ELSE 'ok' END AS verdict FROM lineitem""" for c in QUALITY_COLUMNS))
def feature_quality(spark, sf):
    return rounded(checks.feature_quality(table(spark, sf, "lineitem"), QUALITY_COLUMNS), ["std", "value_range"])


@query("""SELECT count(embedding) AS vectors, min(len(embedding))::INTEGER AS min_width, max(len(embedding))::INTEGER AS max_width,
count(*) FILTER (WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) > 0) AS bad_vectors,
count(*) FILTER (WHERE embedding IS NULL OR len(embedding) = 0) AS empty_vectors,
min(len(embedding)) = max(len(embedding)) AND max(len(embedding)) = 64
 AND count(*) FILTER (WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) > 0) = 0
 AND count(*) FILTER (WHERE embedding IS NULL OR len(embedding) = 0) = 0 AS valid FROM embeddings""")
def vector_check(spark, sf):
    return checks.vector_check(table(spark, sf, "embeddings"), "embedding", 64)


# --- statistics --------------------------------------------------------------------

@query(f"SELECT {rs('avg(l_extendedprice)')} AS mean, {rs('quantile_cont(l_extendedprice, 0.5)')} AS median FROM lineitem")
def mean_median(spark, sf):
    li = table(spark, sf, "lineitem")
    med = profile.median(li, "l_extendedprice").first()["median"]
    return profile.mean(li, "l_extendedprice").select(r("mean").alias("mean"), r(F.lit(med)).alias("median"))


@query("""WITH c AS (SELECT p_size AS value, count(*) AS "count" FROM part GROUP BY 1)
SELECT value, "count" FROM c WHERE "count" = (SELECT max("count") FROM c)""")
def modes(spark, sf):
    return profile.modes(table(spark, sf, "part"), "p_size")


ENTROPY_COLUMNS = ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount"]


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {rs('-sum(p * log2(p + 1e-10))')} AS entropy FROM
(SELECT count(*) / (SELECT count(*) FROM lineitem)::DOUBLE AS p FROM lineitem GROUP BY {c})""" for c in ENTROPY_COLUMNS))
def entropy(spark, sf):
    return rounded(profile.entropy(table(spark, sf, "lineitem"), ENTROPY_COLUMNS), ["entropy"])


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS distinct_values FROM part"""
                          for c in ("p_name", "p_brand", "p_type", "p_size")))
def distinct_counts(spark, sf):
    return profile.distinct_counts(table(spark, sf, "part"), ["p_name", "p_brand", "p_type", "p_size"])


CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
CORR_PAIRS = [(a, b) for i, a in enumerate(CORR) for b in CORR[i + 1:]]


@query(" UNION ALL ".join(f"""SELECT '{a}' AS "left", '{b}' AS "right", {rs(f'corr({a}, {b})')} AS r FROM lineitem"""
                          for a, b in CORR_PAIRS))
def corr_pairs(spark, sf):
    return rounded(profile.correlations(table(spark, sf, "lineitem"), CORR), ["r"])


@query(f"""WITH v AS (SELECT o_totalprice AS a, o_totalprice * 0.9::DOUBLE + (o_orderkey % 97) * 1000.0::DOUBLE AS b, (o_orderkey % 11)::DOUBLE AS c FROM orders),
p AS (SELECT 'a' AS "left", 'b' AS "right", {rs('corr(a, b)')} AS r FROM v UNION ALL
SELECT 'a', 'c', {rs('corr(a, c)')} FROM v UNION ALL SELECT 'b', 'c', {rs('corr(b, c)')} FROM v)
SELECT * FROM p WHERE abs(r) > 0.7""")
def strong_pairs(spark, sf):
    v = table(spark, sf, "orders").select(
        F.col("o_totalprice").alias("a"),
        (F.col("o_totalprice") * 0.9 + (F.col("o_orderkey") % 97) * F.lit(1000.0)).alias("b"),
        (F.col("o_orderkey") % 11).cast("double").alias("c"))
    return rounded(profile.correlations(v, ["a", "b", "c"], 0.7), ["r"])


@query(f"""WITH h AS {holes_sql('part', 'p_partkey', 'p_size', 0.1)},
f AS (SELECT coalesce(p_size::DOUBLE, (SELECT quantile_cont(p_size, 0.5) FROM h)) AS a, p_retailprice AS b FROM h),
k AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra,
 rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM f)
SELECT 'p_size' AS "left", 'p_retailprice' AS "right", {rs('corr(ra::DOUBLE, rb::DOUBLE)')} AS r FROM k""")
def spearman(spark, sf):
    holes = missing.inject_random(table(spark, sf, "part"), "p_size", 0.1, row_id="p_partkey")
    return rounded(profile.spearman(holes, ["p_size", "p_retailprice"]), ["r"])


IQR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {rs('q1')} AS q1, {rs('q3')} AS q3, {rs('q1 - 1.5 * (q3 - q1)')} AS low,
{rs('q3 + 1.5 * (q3 - q1)')} AS high, count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers,
{rs(f'100.0 * count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) / count(*)')} AS outlier_pct
FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem) GROUP BY q1, q3"""
    for c in IQR_COLUMNS))
def iqr_outliers(spark, sf):
    return rounded(profile.iqr_outliers(table(spark, sf, "lineitem"), IQR_COLUMNS), ["q1", "q3", "low", "high", "outlier_pct"])


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {rs(f'min({c})')} AS min_value, {rs(f'max({c})')} AS max_value, {rs(f'stddev_samp({c})')} AS std_value,
max({c}) - min({c}) > 1000 OR stddev_samp({c}) > 100 AS scale_problem FROM lineitem""" for c in QUALITY_COLUMNS))
def scale_check(spark, sf):
    return rounded(profile.scale_check(table(spark, sf, "lineitem"), QUALITY_COLUMNS), ["min_value", "max_value", "std_value"])


@query(f"""WITH v AS ({' UNION ALL '.join(f'''SELECT {i} AS o, '{c}' AS "column", var_samp({c}) AS variance FROM lineitem'''
                                           for i, c in enumerate(QUALITY_COLUMNS))}),
k AS (SELECT *, row_number() OVER (ORDER BY variance DESC, o) AS "rank", avg(variance) OVER () AS every FROM v)
SELECT "rank"::INTEGER AS "rank", "column", {rs('variance', 3)} AS variance, {rs('avg(variance) OVER () / (every + 1e-6)')} AS quality
FROM k WHERE "rank" <= 2""")
def variance_ranking(spark, sf):
    out = profile.variance_ranking(table(spark, sf, "lineitem"), QUALITY_COLUMNS, 2)
    return rounded(rounded(out, ["variance"], 3), ["quality"])


@query(f"""WITH s AS (SELECT count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi,
 quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25) AS iqr FROM orders),
b AS (SELECT *, ceil((hi - lo) / least((hi - lo) / (log2(n) + 1), 2 * iqr / n ** (1.0::DOUBLE / 3)))::INTEGER AS bins FROM s),
w AS (SELECT *, (hi - lo) / bins AS width FROM b),
c AS (SELECT least(floor((o_totalprice - lo) / width), bins - 1)::INTEGER AS bin, count(*) AS n FROM orders, w GROUP BY 1)
SELECT g.bin, {rs('lo + g.bin * width', 3)} AS low, {rs('lo + (g.bin + 1) * width', 3)} AS high, coalesce(c.n, 0) AS "count"
FROM w, (SELECT unnest(range(0, (SELECT bins FROM b)))::INTEGER AS bin) g LEFT JOIN c ON c.bin = g.bin""")
def histogram(spark, sf):
    return rounded(profile.histogram(table(spark, sf, "orders"), "o_totalprice"), ["low", "high"], 3)


@query(f"""WITH s AS (SELECT count(*) AS n, min(p_size) AS lo, max(p_size) AS hi, stddev_samp(p_size) * count(*) ** (-0.2::DOUBLE) AS h FROM part),
g AS (SELECT i AS point, lo + (hi - lo) * i / 199.0::DOUBLE AS x, n, h FROM s, (SELECT unnest(range(0, 200))::INTEGER AS i))
SELECT point, {rs('x')} AS x, {rs('sum(exp(-0.5 * ((x - p_size) / h) ** 2)) / any_value(n * h * sqrt(2 * pi()))', 9)} AS density
FROM g, part GROUP BY point, x""")
def density(spark, sf):
    return rounded(rounded(profile.density(table(spark, sf, "part"), "p_size"), ["x"]), ["density"], 9)


# --- profile --------------------------------------------------------------------------

def profile_sql(table_: str, columns: list[tuple[str, str]]) -> str:
    """The profile of (column, type) pairs as SQL."""
    parts = []
    for i, (c, kind) in enumerate(columns):
        numeric = kind not in ("string", "timestamp_ntz")
        family = "numeric" if numeric else "text" if kind == "string" else "other"
        num = (f"min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi, avg({c}) AS av, stddev_samp({c}) AS sd, quantile_cont({c}, 0.5)::DOUBLE AS md"
               if numeric else "NULL::DOUBLE AS lo, NULL::DOUBLE AS hi, NULL::DOUBLE AS av, NULL::DOUBLE AS sd, NULL::DOUBLE AS md")
        top = (f"(SELECT list(v ORDER BY n DESC, v) FROM (SELECT {c} AS v, count(*) AS n FROM {table_} GROUP BY 1 ORDER BY n DESC, v LIMIT 10))"
               if kind == "string" else "NULL::VARCHAR[]")
        best = f"(SELECT max(n) FROM (SELECT count(*) AS n FROM {table_} GROUP BY {c}))" if kind == "string" else "NULL::BIGINT"
        parts.append(f"""SELECT {i} AS ordinal, '{c}' AS "column", '{kind}' AS dtype, '{family}' AS family, count(*) AS n,
count(*) - count({c}) AS missing, count(DISTINCT {c}) AS dv, {num}, {top} AS cats, {best} AS top_count FROM {table_}""")
    words = ", ".join(f"'{w}'" for w in profile.ORDINAL_WORDS)
    return f"""(SELECT *, 100.0::DOUBLE * dv / n AS dp,
CASE WHEN lower("column") IN ('id', 'student_id', 'user_id') THEN 'identifier'
WHEN family = 'numeric' THEN CASE WHEN 100.0::DOUBLE * dv / n > 50 AND dv > 20 THEN 'numerical_continuous' WHEN dv <= 20 THEN 'numerical_discrete'
 WHEN sd > 0 AND NOT (CASE WHEN abs(av) > 1e-6 THEN sd / abs(av) > 0.3 ELSE sd >= 1 END) THEN 'numerical_discrete' ELSE 'numerical_continuous' END
WHEN family = 'text' AND (regexp_matches(lower("column"), 'quality|level|grade|rating|education')
 OR list_has_any(list_transform(cats, lambda x: lower(x)), [{words}])) THEN 'categorical_ordinal'
ELSE 'categorical_nominal' END AS kind FROM ({' UNION ALL '.join(parts)}))"""


NUMBERS = ("bigint", "int", "double")
PART = [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")]
ORDERS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
          ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
EVENTS = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"),
          ("props", "string")]


@query(f"""SELECT "column", dtype, n AS "rows", missing, dv AS distinct_values, {rs('dp')} AS distinct_pct,
{rs('100.0::DOUBLE * missing / n')} AS missing_pct, {rs('lo')} AS min_value, {rs('hi')} AS max_value, {rs('av')} AS mean_value,
{rs('sd')} AS std_value, {rs('md')} AS median_value, cats[1] AS top_value, top_count, array_to_string(cats, '|') AS categories
FROM {profile_sql('part', PART)}""")
def column_profile(spark, sf):
    p = profile.column_profile(table(spark, sf, "part"))
    numbers = ["distinct_pct", "missing_pct", "min_value", "max_value", "mean_value", "std_value", "median_value"]
    return rounded(p, numbers).select("column", "dtype", "rows", "missing", "distinct_values", *numbers, "top_value", "top_count",
                                      F.array_join("categories", "|").alias("categories"))


def halves(spark, sf):
    """Profiles of the orders with even and with odd keys, stored as one table."""
    orders = table(spark, sf, "orders").select([c for c, _ in ORDERS])
    parts = [profile.sketch_profile(orders.where(F.col("o_orderkey") % 2 == i)) for i in (0, 1)]
    return orders, cut(parts[0].unionByName(parts[1]))


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) AS "rows", count(*) FILTER ({c} IS NULL) AS missing,
{rs(f'min({c})') if k in NUMBERS else 'NULL::DOUBLE'} AS min_value, {rs(f'max({c})') if k in NUMBERS else 'NULL::DOUBLE'} AS max_value,
{rs(f'avg({c})') if k in NUMBERS else 'NULL::DOUBLE'} AS mean_value, {rs(f'stddev_samp({c})') if k in NUMBERS else 'NULL::DOUBLE'} AS std_value FROM orders"""
                          for c, k in ORDERS))
def profile_merged(spark, sf):
    """What is exact in the merged profile of two halves."""
    numbers = ["min_value", "max_value", "mean_value", "std_value"]
    out = profile.estimated_profile(profile.merge_profiles(halves(spark, sf)[1]))
    return rounded(out, numbers).select("column", "rows", "missing", *numbers)


@query()
def profile_errors(spark, sf):
    """How far the merged sketches are from the exact values: distinct counts, rank of the median, count of the top value."""
    orders, parts = halves(spark, sf)
    told = cut(profile.estimated_profile(profile.merge_profiles(parts)))
    exact = profile.column_profile(orders).select("column", F.col("distinct_values").alias("exact"), F.col("top_count"))
    medians = {x["column"]: x["median_value"] for x in told.where("median_value IS NOT NULL").collect()}  # one row per column
    below = orders.agg(*[F.avg(F.when(F.col(c) <= v, 1.0).otherwise(0.0)).alias(c) for c, v in medians.items()])
    ranks = below.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("median_rank")) for c in medians])))
    return (told.join(exact, "column").join(ranks, "column", "left").select(
        "column", r(F.abs(F.col("distinct_values") - F.col("exact")) / F.col("exact")).alias("distinct_error"), r("median_rank").alias("median_rank"),
        r(F.abs(F.col("top")[0]["count"] - F.col("top_count")) / F.col("top_count")).alias("top_error")))


@query(" UNION ALL ".join(f"""SELECT '{t}' AS table_name, "column", kind FROM {profile_sql(t, c)}"""
                          for t, c in (("part", PART), ("orders", ORDERS), ("events", EVENTS))))
def column_kinds(spark, sf):
    out = None
    for name, cols in (("part", PART), ("orders", ORDERS), ("events", EVENTS)):
        one = profile.column_kinds(profile.kind_facts(table(spark, sf, name), [c for c, _ in cols])) \
            .select(F.lit(name).alias("table_name"), "column", "kind")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""SELECT "column" AS name, kind, CASE WHEN kind LIKE 'numerical%' THEN 'standard' END AS scaling,
CASE WHEN kind = 'categorical_nominal' THEN CASE WHEN dv <= 10 THEN 'onehot' ELSE 'label' END
 WHEN kind = 'categorical_ordinal' THEN 'ordinal' END AS encoding,
CASE WHEN kind = 'categorical_ordinal' THEN array_to_string(list_sort(cats), '|') END AS ordinal, false AS is_quasi_identifier
FROM {profile_sql('part', PART)}""")
def default_spec(spark, sf):
    spec = profile.default_spec(profile.column_profile(table(spark, sf, "part")))
    return spec.table(spark).withColumn("ordinal", F.array_join("ordinal", "|"))


# --- scalers and encoders ------------------------------------------------------------------

@query(f"""SELECT o_orderkey, {rs('(o_totalprice - m) / s')} AS o_totalprice FROM orders,
(SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)""")
def scale_standard(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rounded(encode.standard_scale(o, ["o_totalprice"]), ["o_totalprice"])


@query(f"""SELECT o_orderkey, {rs('(o_totalprice - m) / (s - m)')} AS o_totalprice, 0.0::DOUBLE AS constant FROM orders,
(SELECT min(o_totalprice) AS m, max(o_totalprice) AS s FROM orders)""")
def scale_minmax(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.lit(7.0).alias("constant"))
    return rounded(encode.minmax_scale(o, ["o_totalprice", "constant"]), ["o_totalprice", "constant"])


@query("""SELECT p_partkey, (SELECT count(DISTINCT q.p_brand) FROM part q WHERE q.p_brand < part.p_brand)::INTEGER AS p_brand FROM part""")
def encode_label(spark, sf):
    return encode.label_encode(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand")


@query("""WITH fitted AS (SELECT p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS code FROM (SELECT DISTINCT p_type FROM part WHERE p_size <= 2))
SELECT p_partkey, coalesce(code, 0)::INTEGER AS code FROM part LEFT JOIN fitted USING (p_type)""")
def encode_label_unseen(spark, sf):
    part = table(spark, sf, "part")
    known = encode.classes(part.where("p_size <= 2"), "p_type")
    return encode.label_encode(part, "p_type", known, "code").select("p_partkey", "code")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END::DOUBLE AS o_orderstatus_O,
CASE WHEN o_orderstatus = 'P' THEN 1.0 ELSE 0.0 END::DOUBLE AS o_orderstatus_P FROM orders""")
def encode_onehot(spark, sf):
    return encode.onehot_encode(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus")


@query("SELECT o_orderkey, coalesce(list_position([" + ", ".join(f"'{p}'" for p in PRIORITIES) + "], o_orderpriority) - 1, 0)::INTEGER AS o_orderpriority FROM orders")
def encode_ordinal(spark, sf):
    return encode.ordinal_encode(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", PRIORITIES)


@query(f"""SELECT event_id, {rs('count(*) OVER (PARTITION BY user_id) / (count(*) OVER ())::DOUBLE', 9)} AS user_freq FROM events""")
def encode_freq(spark, sf):
    out = encode.frequency_encode(table(spark, sf, "events").select("event_id", "user_id"), "user_id", output="user_freq")
    return rounded(out.select("event_id", "user_freq"), ["user_freq"], 9)


FIT_SPEC = TableSpec({c.name: c for c in (
    ColumnSpec("p_partkey", "identifier"), ColumnSpec("p_brand", "categorical_nominal", encoding="label"),
    ColumnSpec("p_type", "categorical_nominal", encoding="onehot"), ColumnSpec("p_size", "numerical_discrete", scaling="minmax"),
    ColumnSpec("p_retailprice", "numerical_continuous", scaling="standard"))})
TYPES = ["LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(f"""WITH h AS {holes_sql('part', 'p_partkey', 'p_brand', 0.1)},
b AS (SELECT p_brand FROM h WHERE p_brand IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 1),
f AS (SELECT h.* REPLACE (coalesce(h.p_brand, b.p_brand) AS p_brand) FROM h, b),
c AS (SELECT p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT p_brand FROM f)),
s AS (SELECT min(p_size) AS lo, max(p_size) AS hi, avg(p_retailprice) AS m, stddev_pop(p_retailprice) AS sd FROM f)
SELECT p_partkey AS row_id, {rs('(p_size - lo) / (hi - lo)::DOUBLE')} AS p_size, {rs('(p_retailprice - m) / sd')} AS p_retailprice,
code::INTEGER AS p_brand, {', '.join(f"CASE WHEN p_type = '{t}' THEN 1.0 ELSE 0.0 END::DOUBLE AS p_type_{t}" for t in TYPES)}
FROM f JOIN c USING (p_brand), s""")
def fit_transform(spark, sf):
    part = missing.inject_random(table(spark, sf, "part"), "p_brand", 0.1, row_id="p_partkey").withColumn("row_id", F.col("p_partkey"))
    out, _ = encode.fit_transform(part, FIT_SPEC)
    return rounded(out, ["p_size", "p_retailprice"])


PLAIN_SPEC = TableSpec({c.name: c for c in (
    ColumnSpec("o_orderkey", "identifier"), ColumnSpec("o_totalprice", "numerical_continuous", scaling="none"),
    ColumnSpec("o_orderstatus", "categorical_nominal", encoding="label"))})


@query("""SELECT o_orderkey AS row_id, o_totalprice, (dense_rank() OVER (ORDER BY o_orderstatus) - 1)::INTEGER AS o_orderstatus FROM orders""")
def scale_none(spark, sf):
    orders = table(spark, sf, "orders").withColumn("row_id", F.col("o_orderkey"))
    return encode.fit_transform(orders, PLAIN_SPEC)[0]


@query("""WITH names AS (SELECT 0 AS part, 'p_size' AS name UNION ALL SELECT 1, 'p_retailprice' UNION ALL SELECT 2, 'p_brand'
UNION ALL SELECT 2 + dense_rank() OVER (ORDER BY p_type), 'p_type_' || p_type FROM (SELECT DISTINCT p_type FROM part) QUALIFY dense_rank() OVER (ORDER BY p_type) > 1)
SELECT (row_number() OVER (ORDER BY part) - 1)::INTEGER AS place, name, count(*) OVER () AS outputs FROM names""")
def feature_names(spark, sf):
    part = table(spark, sf, "part").withColumn("row_id", F.col("p_partkey"))
    _, fitted = encode.fit_transform(part, FIT_SPEC)
    outputs = fitted.summary()["output_count"]
    return spark.createDataFrame([(i, n, outputs) for i, n in enumerate(fitted.feature_names())], "place int, name string, outputs bigint")


WANTED = ["c_custkey", "c_income", "c_mktsegment", "c_age"]


@query(f"""SELECT name AS absent, (SELECT count(*) FROM customer) AS "rows" FROM (SELECT unnest({WANTED}) AS name)
WHERE name NOT IN (SELECT column_name FROM (DESCRIBE customer))""")
def input_check(spark, sf):
    import warnings
    customer = table(spark, sf, "customer")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        absent = checks.validate_input(customer, WANTED)
    return customer.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(F.array(*[F.lit(c) for c in absent])).alias("absent"), "rows")
