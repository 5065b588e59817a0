"""Registered queries: k-anonymity, generalisation, suppression, decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import encode, privacy
from sparkloom.plans.registry import query, r, rounded, rs, table
from sparkloom.plans.tables import holes_sql
from sparkloom.operators.missing import inject_random


def edge_sql(b: str) -> str:
    """A rounded edge as struct(v, t): value and text."""
    return f"""CASE WHEN {b} = 0 THEN {{'v': 0.0::DOUBLE, 't': '0'}}
WHEN {b} < 1 THEN {{'v': round({b}, 1), 't': round({b}, 1)::VARCHAR}}
WHEN {b} < 10 THEN {{'v': round_even({b}, 0), 't': round_even({b}, 0)::BIGINT::VARCHAR}}
WHEN {b} < 100 THEN {{'v': round_even({b} / 5, 0) * 5, 't': (round_even({b} / 5, 0) * 5)::BIGINT::VARCHAR}}
WHEN {b} < 1000 THEN {{'v': round_even({b} / 50, 0) * 50, 't': (round_even({b} / 50, 0) * 50)::BIGINT::VARCHAR}}
ELSE {{'v': round_even({b} / 500, 0) * 500, 't': (round_even({b} / 500, 0) * 500)::BIGINT::VARCHAR}} END"""


def binned_sql(source: str, column: str, bins: int) -> str:
    """`source` with the column replaced by its `lo-hi` label, for columns with enough values."""
    probs = ", ".join(str(i / bins) for i in range(bins + 1))
    return f"""(WITH src AS (SELECT * FROM {source}),
q AS (SELECT unnest(quantile_cont({column}::DOUBLE, [{probs}])) AS b, min({column}) AS lo, max({column}) AS hi FROM src),
e AS (SELECT DISTINCT {edge_sql('b')} AS e, lo, hi FROM q),
l AS (SELECT list(e ORDER BY e.v) AS es, any_value(lo) AS lo, any_value(hi) AS hi FROM e),
w AS (SELECT list_concat(list_concat(
 [CASE WHEN es[1].v > lo THEN {{'v': lo::DOUBLE, 't': lo::VARCHAR}} ELSE es[1] END], es[2:len(es) - 1]),
 [CASE WHEN es[len(es)].v < hi THEN {{'v': hi::DOUBLE, 't': hi::VARCHAR}} ELSE es[len(es)] END]) AS es FROM l),
x AS (SELECT unnest(range(1, len(es))) AS i, es FROM w),
bins AS (SELECT i, es[i].v AS lo, es[i + 1].v AS hi, es[i].t || '-' || es[i + 1].t AS label FROM x)
SELECT src.* REPLACE (coalesce(label, 'nan') AS {column}) FROM src LEFT JOIN bins
 ON src.{column} <= bins.hi AND (src.{column} > bins.lo OR (i = 1 AND src.{column} >= bins.lo)))"""


BALANCE_QIS = ["c_acctbal", "c_mktsegment"]
BINNED_CUSTOMER = binned_sql("customer", "c_acctbal", 4)
CUSTOMER_QIS = ["c_nationkey", "c_mktsegment"]
CLASSES = "(SELECT c_nationkey, c_mktsegment, count(*) AS g FROM customer GROUP BY 1, 2)"
# many small classes: balances in thousands, by nation and segment
FINE_QIS = ["c_nationkey", "c_mktsegment", "thousands"]
FINE = "(SELECT c_nationkey, c_mktsegment, floor(c_acctbal / 1000)::BIGINT AS thousands, count(*) AS g FROM customer GROUP BY 1, 2, 3)"


def fine_classes(spark, sf):
    c = table(spark, sf, "customer").withColumn("thousands", F.floor(F.col("c_acctbal") / 1000))
    return privacy.class_sizes(c, FINE_QIS)


@query("""SELECT c_nationkey, c_mktsegment, g AS group_size, row_number() OVER (ORDER BY g, c_nationkey, c_mktsegment) - 1 AS group_id
FROM """ + CLASSES)
def k_classes(spark, sf):
    return privacy.equivalence_classes(table(spark, sf, "customer"), CUSTOMER_QIS)


@query(f"""WITH b AS {BINNED_CUSTOMER}, c AS (SELECT count(*) AS g FROM b GROUP BY c_acctbal, c_mktsegment)
SELECT min(g) AS k, (SELECT count(*) FROM b) AS total_rows, count(*) AS classes, 'c_acctbal,c_mktsegment' AS qis FROM c""")
def k_report(spark, sf):
    c = privacy.generalise(table(spark, sf, "customer"), ["c_acctbal"], "moderate")
    return privacy.k_report(c, BALANCE_QIS)


GROUPS = f"""SELECT count(*) AS total_groups, min(g) AS min_group_size, max(g) AS max_group_size, {rs('avg(g)')} AS mean_group_size,
{rs('quantile_cont(g, 0.5)')} AS median_group_size, {rs('stddev_samp(g)')} AS std_group_size,
count(*) FILTER (WHERE g = 1) AS vulnerable_groups, count(*) FILTER (WHERE g = 1) AS vulnerable_rows FROM {FINE}"""


@query(GROUPS)
def k_groups(spark, sf):
    return rounded(privacy.group_stats(fine_classes(spark, sf)), ["mean_group_size", "median_group_size", "std_group_size"])


@query(f'SELECT g AS group_size, count(*) AS "groups" FROM {FINE} GROUP BY g')
def k_sizes(spark, sf):
    return privacy.size_histogram(fine_classes(spark, sf))


@query(f"""SELECT count(*) FILTER (WHERE g = 1) AS unique_count, count(*) FILTER (WHERE g < 5) AS small_groups,
(sum(g) FILTER (WHERE g < 5))::BIGINT AS small_rows, {rs('100.0 * count(*) FILTER (WHERE g = 1) / count(*)')} AS unique_pct,
{rs('100.0 * count(*) FILTER (WHERE g < 5) / count(*)')} AS small_groups_pct FROM {FINE}""")
def k_vulnerability(spark, sf):
    return rounded(privacy.vulnerability(fine_classes(spark, sf)), ["unique_pct", "small_groups_pct"])


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS distinct_values, {rs('-sum(p * log2(p + 1e-10))')} AS entropy,
{rs('count(*) / any_value(n)::DOUBLE', 9)} AS uniqueness_ratio FROM
(SELECT count(*) / (SELECT count(*) FROM customer)::DOUBLE AS p, (SELECT count(*) FROM customer) AS n FROM customer GROUP BY {c})"""
    for c in CUSTOMER_QIS))
def k_impact(spark, sf):
    out = privacy.qi_impact(table(spark, sf, "customer"), CUSTOMER_QIS)
    return rounded(rounded(out, ["entropy"]), ["uniqueness_ratio"], 9)


RISK = f"""WITH c AS (SELECT sum(g) AS n, coalesce(sum(g) FILTER (WHERE g = 1), 0)::BIGINT AS rows_unique,
 coalesce(sum(g) FILTER (WHERE g = 2), 0)::BIGINT AS rows_size_2, coalesce(sum(g) FILTER (WHERE g < 5), 0)::BIGINT AS rows_small FROM {FINE}),
p AS (SELECT *, 100.0::DOUBLE * rows_unique / n AS u, 100.0::DOUBLE * rows_size_2 / n AS t, 100.0::DOUBLE * rows_small / n AS s FROM c)
SELECT rows_unique, rows_size_2, rows_small, {rs('u')} AS percent_unique, {rs('t')} AS percent_size_2, {rs('s')} AS percent_small,
CASE WHEN u > 10 OR s > 20 THEN 'HIGH' WHEN u > 5 OR s > 10 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM p"""


@query(RISK)
def k_risk(spark, sf):
    return rounded(privacy.risk(fine_classes(spark, sf)), ["percent_unique", "percent_size_2", "percent_small"])


@query(f"""WITH s AS (SELECT min(g) AS k, max(g) AS hi, avg(g) AS av, count(*) AS n, count(*) FILTER (WHERE g = 1) AS v FROM {FINE})
SELECT concat_ws('|', CASE WHEN k = 1 THEN 'critical_unique_rows' WHEN k < 3 THEN 'raise_k_to_3' WHEN k < 5 THEN 'raise_k_to_5' ELSE 'k_sufficient' END,
CASE WHEN 100.0 * v / (av * n) > 10 THEN 'generalise_values' END, CASE WHEN hi / av > 10 THEN 'uneven_group_sizes' END,
'review_identifying_attributes', 'consider_l_diversity', 'review_quasi_identifiers') AS codes FROM s""")
def k_recommendations(spark, sf):
    out = privacy.recommendations(privacy.group_stats(fine_classes(spark, sf)))
    return out.select(F.array_join("codes", "|").alias("codes"))


LEVELS = {"low": 8, "moderate": 4, "high": 2}


@query(" UNION ALL ".join(f"SELECT '{n}' AS level, c_custkey, c_acctbal FROM {binned_sql('customer', 'c_acctbal', b)}" for n, b in LEVELS.items()))
def generalise_numeric(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    out = None
    for level in LEVELS:
        one = privacy.generalise_numeric(c, "c_acctbal", level).select(F.lit(level).alias("level"), "c_custkey", "c_acctbal")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"SELECT p_partkey, p_size FROM {binned_sql(holes_sql('part', 'p_partkey', 'p_size', 0.1), 'p_size', 4)}")
def generalise_integer(spark, sf):
    holes = inject_random(table(spark, sf, "part"), "p_size", 0.1, row_id="p_partkey")
    return privacy.generalise_numeric(holes, "p_size", "moderate").select("p_partkey", "p_size")


# Customers with text attributes derived from their keys, so that every rule is met.
PEOPLE_COLUMNS = [
    "c_custkey", "c_mktsegment",
    "CASE c_custkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Other' END AS gender",
    "CASE c_custkey % 8 WHEN 0 THEN 'None' WHEN 1 THEN 'Primary' WHEN 2 THEN 'Secondary' WHEN 3 THEN 'High School' "
    "WHEN 4 THEN 'Bachelor' WHEN 5 THEN 'Master' WHEN 6 THEN 'PhD' END AS education_level",
    "CASE c_custkey % 5 WHEN 0 THEN 'Good' WHEN 1 THEN 'Average' WHEN 2 THEN '5' WHEN 3 THEN 'Poor' END AS net_quality"]
PEOPLE = f"(SELECT {', '.join(PEOPLE_COLUMNS)} FROM customer)"


def people(spark, sf):
    return table(spark, sf, "customer").selectExpr(*PEOPLE_COLUMNS)


TEXT_RULES = {
    "moderate": """CASE coalesce(gender, 'nan') WHEN 'Male' THEN 'M' WHEN 'Female' THEN 'F' WHEN 'Other' THEN 'O' ELSE 'nan' END AS gender,
CASE coalesce(education_level, 'nan') WHEN 'None' THEN 'No Formal Education' WHEN 'Primary' THEN 'Basic Education' WHEN 'Secondary' THEN 'Basic Education'
 WHEN 'High School' THEN 'Secondary Education' WHEN 'Bachelor' THEN 'Higher Education' WHEN 'Master' THEN 'Higher Education'
 WHEN 'PhD' THEN 'Higher Education' ELSE 'nan' END AS education_level,
CASE WHEN net_quality IN ('5', '4', 'Excellent', 'Good') THEN 'High' WHEN net_quality IN ('3', 'Average') THEN 'Medium' ELSE 'Low' END AS net_quality,
c_mktsegment""",
    "high": """'***' AS gender, CASE WHEN education_level IN ('Bachelor', 'Master', 'PhD') THEN 'Higher Education' ELSE 'Other' END AS education_level,
CASE WHEN net_quality IN ('5', '4', 'Excellent', 'Good') THEN 'High' WHEN net_quality IN ('3', 'Average') THEN 'Medium' ELSE 'Low' END AS net_quality,
'***' AS c_mktsegment"""}
TEXT_QIS = ["gender", "education_level", "net_quality", "c_mktsegment"]


@query(" UNION ALL ".join(f"SELECT '{k}' AS level, c_custkey, {v} FROM {PEOPLE}" for k, v in TEXT_RULES.items()))
def generalise_text(spark, sf):
    out = None
    for level in TEXT_RULES:
        one = privacy.generalise(people(spark, sf), TEXT_QIS, level).select(F.lit(level).alias("level"), "c_custkey", *TEXT_QIS)
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""WITH b AS {binned_sql(holes_sql('customer', 'c_custkey', 'c_acctbal', 0.1), 'c_acctbal', 4)},
c AS (SELECT count(*) AS g FROM b GROUP BY c_acctbal, c_mktsegment)
SELECT min(g) AS k, sum(g)::BIGINT AS total_rows, count(*) AS classes, max(g) AS max_size, {rs('avg(g)')} AS mean_size,
{rs('quantile_cont(g, 0.5)')} AS median_size FROM c""")
def k_compact(spark, sf):
    holes = inject_random(table(spark, sf, "customer"), "c_acctbal", 0.1, row_id="c_custkey")
    out = privacy.compact_report(privacy.generalise(holes, ["c_acctbal"], "moderate"), BALANCE_QIS)
    return rounded(out, ["mean_size", "median_size"])


@query("""WITH t AS (SELECT c_custkey, c_nationkey::VARCHAR AS c_nationkey, c_mktsegment FROM customer),
c AS (SELECT *, count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) AS g, count(*) OVER () AS n FROM t),
l AS (SELECT count(*) FILTER (WHERE g < 10) * 100.0 / any_value(n) AS l10, count(*) FILTER (WHERE g < 9) * 100.0 / any_value(n) AS l9, any_value(n) AS n FROM c),
m AS (SELECT CASE WHEN n < 30 THEN 0 WHEN l10 <= 25 THEN 10 WHEN l9 <= 25 THEN 9 ELSE 0 END AS m FROM l)
SELECT c_custkey, c_nationkey, c_mktsegment FROM c, m WHERE g >= m""")
def suppress_rare(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("c_nationkey"), "c_mktsegment")
    return privacy.suppress_rare(c, CUSTOMER_QIS, 10)


ANON = ["c_acctbal", "c_nationkey", "c_mktsegment"]
ANON_HIGH = binned_sql("(SELECT c_custkey, c_acctbal, c_nationkey, '***' AS c_mktsegment FROM customer)", "c_acctbal", 2)


@query(f"""WITH b AS {binned_sql(ANON_HIGH, 'c_nationkey', 2)},
c AS (SELECT *, count(*) OVER (PARTITION BY c_acctbal, c_nationkey, c_mktsegment) AS g FROM b)
SELECT c_custkey, c_acctbal, c_nationkey, c_mktsegment FROM c WHERE g >= 2 OR (SELECT min(g) FROM c) >= 2""")
def anonymise(spark, sf):
    return privacy.anonymise(table(spark, sf, "customer").select("c_custkey", *ANON), ANON, "high")


DECODE = binned_sql("(SELECT c_custkey, c_acctbal, c_nationkey, c_mktsegment FROM customer)", "c_nationkey", 4)


@query(f"""WITH b AS {DECODE}
SELECT c_custkey, coalesce((try_cast(split_part(c_nationkey, '-', 1) AS DOUBLE) + try_cast(split_part(c_nationkey, '-', 2) AS DOUBLE)) / 2, 0.0)::DOUBLE AS c_nationkey,
{rs('c_acctbal')} AS c_acctbal, (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::INTEGER AS c_mktsegment FROM b""")
def decode_anonymised(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    binned = privacy.generalise_numeric(c, "c_nationkey", "moderate")
    return rounded(encode.decode_anonymised(binned, "c_custkey"), ["c_acctbal"])
