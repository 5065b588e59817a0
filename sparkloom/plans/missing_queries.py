"""Registered queries: injection, repair, ridge regression and its evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions.hashing import uniform_sql
from sparkloom.operators import missing, ridge
from sparkloom.plans import repair
from sparkloom.plans.registry import query, r, rounded, rs, table
from sparkloom.plans.tables import holes_sql
from sparkloom.session import cut

ALPHA_ROWS = ", ".join(f"({a}::DOUBLE)" for a in ridge.ALPHAS)


def block_sql(table_: str, key: str, column: str, share: float, seed: int = 42) -> str:
    """A table with one hashed block of consecutive nulls in one column."""
    return f"""(WITH c AS (SELECT count(*) AS n, round_even(count(*) * {share}::DOUBLE, 0)::BIGINT AS m FROM {table_}),
s AS (SELECT m, floor({uniform_sql(seed, 'n')} * (n - m + 1))::BIGINT AS start FROM c),
o AS (SELECT *, row_number() OVER (ORDER BY {key}) - 1 AS _pos FROM {table_})
SELECT o.* EXCLUDE (_pos) REPLACE (CASE WHEN _pos >= start AND _pos < start + m THEN NULL ELSE {column} END AS {column}) FROM o, s)"""


def ridge_sql(source: str, key: str, x: str, y: str) -> str:
    """CTEs of the one-feature model of y on x: `tr` (training), `scores` per alpha, `fit` (w on z, b, alpha, m, sd, resid)."""
    return f"""tr0 AS (SELECT {key} AS k, {x}::DOUBLE AS x, {y}::DOUBLE AS y, row_number() OVER (ORDER BY {key}) - 1 AS pos,
 count(*) OVER () AS n, avg({x}) OVER () AS m, stddev_pop({x}) OVER () AS sd FROM {source} WHERE {y} IS NOT NULL),
tr AS (SELECT *, (x - m) / sd AS z, CASE WHEN pos < (n % 5) * (n // 5 + 1) THEN pos // (n // 5 + 1)
 ELSE n % 5 + (pos - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold FROM tr0),
parts AS (SELECT fold, count(*) AS n, avg(z) AS mz, avg(y) AS my, var_pop(z) * count(*) AS szz, covar_pop(z, y) * count(*) AS szy
 FROM (SELECT f.fold, t.z, t.y FROM (SELECT DISTINCT fold FROM tr) f JOIN tr t ON t.fold <> f.fold) GROUP BY fold),
models AS (SELECT fold, a AS alpha, szy / (szz + a) AS w, my - szy / (szz + a) * mz AS b FROM parts, (VALUES {ALPHA_ROWS}) v(a)),
folds AS (SELECT alpha, fold, -avg((y - b - w * z) ** 2) AS score FROM models JOIN tr USING (fold) GROUP BY 1, 2),
scores AS (SELECT alpha, avg(score) AS mean_score, stddev_pop(score) AS std_score FROM folds GROUP BY 1),
best AS (SELECT alpha FROM scores ORDER BY mean_score DESC, alpha LIMIT 1),
fit0 AS (SELECT any_value(alpha) AS alpha, covar_pop(z, y) * count(*) / (var_pop(z) * count(*) + any_value(alpha)) AS w, avg(z) AS mz, avg(y) AS my,
 any_value(m) AS m, any_value(sd) AS sd FROM tr, best),
fit AS (SELECT f.*, my - w * mz AS b, (SELECT sqrt(avg((y - (f.my - f.w * f.mz) - f.w * z) ** 2)) FROM tr, fit0 f) AS resid FROM fit0 f)"""


# --- injection and simple repairs ------------------------------------------------

@query(f"SELECT o_orderkey, {rs('o_totalprice')} AS o_totalprice FROM {holes_sql('orders', 'o_orderkey', 'o_totalprice', 0.1)}")
def inject_random(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rounded(missing.inject_random(o, "o_totalprice", 0.1, row_id="o_orderkey"), ["o_totalprice"])


@query(f"SELECT o_orderkey, {rs('o_totalprice')} AS o_totalprice FROM {block_sql('orders', 'o_orderkey', 'o_totalprice', 0.1)}")
def inject_block(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rounded(missing.inject_block(o, "o_totalprice", 0.1, row_id="o_orderkey"), ["o_totalprice"])


@query(f"""WITH h AS {block_sql('orders', 'o_orderkey', 'o_totalprice', 0.1)}
SELECT o_orderkey, {rs('coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM h))')} AS o_totalprice FROM h""")
def fill_mean(spark, sf):
    o = missing.inject_block(table(spark, sf, "orders"), "o_totalprice", 0.1, row_id="o_orderkey")
    return rounded(missing.fill_mean(o, "o_totalprice").select("o_orderkey", "o_totalprice"), ["o_totalprice"])


@query(f"""WITH h AS {holes_sql('part', 'p_partkey', 'p_brand', 0.2)},
b AS (SELECT p_brand FROM h WHERE p_brand IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 1)
SELECT p_partkey, coalesce(h.p_brand, b.p_brand) AS p_brand FROM h, b""")
def fill_mode(spark, sf):
    h = missing.inject_random(table(spark, sf, "part"), "p_brand", 0.2, row_id="p_partkey")
    return missing.fill_mode(h, "p_brand").select("p_partkey", "p_brand")


@query(f"""WITH h AS {block_sql('orders', 'o_orderkey', 'o_totalprice', 0.1)}, m AS (SELECT avg(o_totalprice) AS m FROM h)
SELECT {rs('avg(abs((o.o_totalprice - m) / o.o_totalprice)) * 100')} AS error_pct, count(*) AS scored_rows, 0::BIGINT AS zero_truth_rows
FROM orders o JOIN h USING (o_orderkey), m WHERE h.o_totalprice IS NULL""")
def repair_error(spark, sf):
    o = table(spark, sf, "orders")
    h = missing.inject_block(o, "o_totalprice", 0.1, row_id="o_orderkey")
    out = missing.relative_error(o, h, missing.fill_mean(h, "o_totalprice"), "o_totalprice", row_id="o_orderkey")
    return rounded(out, ["error_pct"])


# --- regression -----------------------------------------------------------------------

X, Y, KEY = "o_custkey", "o_totalprice", "o_orderkey"
BLOCK = block_sql("orders", KEY, Y, 0.1)


def order_holes(spark, sf):
    # read by every pass of the fit
    return cut(missing.inject_block(table(spark, sf, "orders").select(KEY, X, Y), Y, 0.1, row_id=KEY))


@query(f"""WITH h AS {BLOCK}, {ridge_sql('h', KEY, X, Y)}
SELECT {KEY}, {rs(f'coalesce({Y}, b + w * ({X} - m) / sd)', 4)} AS {Y} FROM h, fit""")
def fill_regression(spark, sf):
    out = ridge.fill_regression(order_holes(spark, sf), Y, row_id=KEY, numeric=[X])
    return rounded(out.select(KEY, Y), [Y], 4)


@query(f"""WITH h AS {BLOCK}, {ridge_sql('h', KEY, X, Y)}
SELECT {KEY}, {rs(f'''coalesce({Y}, b + w * ({X} - m) / sd + resid * sqrt(-2.0 * ln(1.0::DOUBLE - {uniform_sql('7/a', KEY)}))
 * cos(2.0::DOUBLE * pi() * {uniform_sql('7/b', KEY)}))''', 3)} AS {Y} FROM h, fit""")
def fill_stochastic(spark, sf):
    out = ridge.fill_regression(order_holes(spark, sf), Y, row_id=KEY, numeric=[X], noise_seed=7)
    return rounded(out.select(KEY, Y), [Y], 3)


@query(f"""WITH h AS {BLOCK}, {ridge_sql('h', KEY, X, Y)}
SELECT alpha, {rs('mean_score / 1e6')} AS mean_score, {rs('std_score / 1e6')} AS std_score FROM scores""")
def alpha_search(spark, sf):
    found = ridge.fit_regression(order_holes(spark, sf), Y, row_id=KEY, numeric=[X]).search.table(spark)
    return found.select("alpha", r(F.col("mean_score") / 1e6).alias("mean_score"), r(F.col("std_score") / 1e6).alias("std_score"))


@query()
def fill_regression_wide(spark, sf):
    """All feature kinds: numeric, dates, one-hot and frequencies; no closed form in SQL."""
    o = table(spark, sf, "orders").withColumn("clerk", (F.col("o_custkey") % 50).cast("string"))
    h = cut(missing.inject_block(o, Y, 0.1, row_id=KEY))
    out = ridge.fill_regression(h, Y, row_id=KEY, numeric=[X], onehot=["o_orderstatus", "o_orderpriority"], freq=["clerk"],
                                timestamp="o_orderdate")
    return rounded(out.select(KEY, Y), [Y], 2)


EVAL = f"""e AS (SELECT {X}::DOUBLE AS x, {Y} AS y, CASE WHEN {uniform_sql(42, KEY)} < 0.2::DOUBLE THEN -1
 ELSE floor({uniform_sql('42/fold', KEY)} * 10)::INTEGER END AS fold FROM orders),
parts AS (SELECT f.fold, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) * count(*) AS sxx, covar_pop(x, y) * count(*) AS sxy
 FROM (SELECT DISTINCT fold FROM e WHERE fold >= 0) f JOIN e t ON t.fold <> f.fold AND t.fold >= 0 GROUP BY f.fold),
models AS (SELECT fold, a AS alpha, sxy * n / (sxx * (n + a)) AS w, my - sxy * n / (sxx * (n + a)) * mx AS b
 FROM parts, (VALUES {", ".join(f"({a}::DOUBLE)" for a in ridge.EVALUATION_ALPHAS)}) v(a)),
folds AS (SELECT alpha, fold, -avg((y - b - w * x) ** 2) AS score FROM models JOIN e USING (fold) GROUP BY 1, 2),
scores AS (SELECT alpha, avg(score) AS mean_score, stddev_pop(score) AS std_score FROM folds GROUP BY 1),
best AS (SELECT alpha FROM scores ORDER BY mean_score DESC, alpha LIMIT 1),
fit AS (SELECT any_value(alpha) AS alpha, count(*) AS n, covar_pop(x, y) * count(*) / (var_pop(x) * (count(*) + any_value(alpha))) AS w,
 avg(x) AS mx, avg(y) AS my FROM e, best WHERE fold >= 0)"""


@query(f"""WITH {EVAL}
SELECT any_value(alpha) AS alpha, {rs('avg((y - my - w * (x - mx)) ** 2) / 1e6')} AS mse,
{rs('1 - sum((y - my - w * (x - mx)) ** 2) / (var_pop(y) * count(*))')} AS r2, any_value(n) AS train_rows, count(*) AS test_rows
FROM e, fit WHERE fold = -1""")
def evaluate(spark, sf):
    scores, _ = ridge.evaluate(table(spark, sf, "orders"), Y, [X], row_id=KEY)
    return rounded(scores.withColumn("mse", F.col("mse") / 1e6), ["mse", "r2"])


@query(f"""WITH {EVAL} SELECT alpha, {rs('mean_score / 1e6')} AS mean_score, {rs('std_score / 1e6')} AS std_score
FROM scores ORDER BY scores.mean_score DESC, alpha LIMIT 5""")
def best_models(spark, sf):
    _, search = ridge.evaluate(table(spark, sf, "orders"), Y, [X], row_id=KEY)
    top = ridge.best_models(search, 5)
    return top.select("alpha", r(F.col("mean_score") / 1e6).alias("mean_score"), r(F.col("std_score") / 1e6).alias("std_score"))


# --- the experiment --------------------------------------------------------------------

SHARES = (0.03, 0.05, 0.1, 0.2, 0.3)


def experiment_sql(share: float, method: str) -> str:
    h = f"SELECT {KEY}, {X}, {Y} FROM {block_sql('orders', KEY, Y, share)}"
    filled = {"drop": f"SELECT {KEY}, {Y} FROM h WHERE {Y} IS NOT NULL",
              "mean": f"SELECT {KEY}, coalesce({Y}, (SELECT avg({Y}) FROM h)) AS {Y} FROM h",
              "regression": f"SELECT {KEY}, coalesce({Y}, b + w * ({X} - m) / sd) AS {Y} FROM h, fit"}[method]
    error = "NULL::DOUBLE" if method == "drop" else rs(
        f"(SELECT avg(abs((o.{Y} - f.{Y}) / o.{Y})) * 100 FROM orders o JOIN f USING ({KEY}) JOIN h USING ({KEY}) WHERE h.{Y} IS NULL)")
    return f"""(WITH h AS ({h}), {ridge_sql('h', KEY, X, Y)}, f AS ({filled}),
modes AS (SELECT {Y} AS v, count(*) AS n FROM f GROUP BY 1), top AS (SELECT min(v) AS v, count(*) AS c FROM modes WHERE n = (SELECT max(n) FROM modes))
SELECT '{Y}' AS "column", {share}::DOUBLE AS share, '{method}' AS method, (SELECT {rs(f'avg({Y})')} FROM orders) AS mean_before,
(SELECT {rs(f'quantile_cont({Y}, 0.5)')} FROM orders) AS median_before, {rs(f'avg({Y})')} AS mean, {rs(f'quantile_cont({Y}, 0.5)')} AS median,
(SELECT {rs('v', 4)} FROM top) AS first_mode, (SELECT c FROM top) AS mode_count, {error} AS error_pct FROM f)"""


@query(" UNION ALL ".join(experiment_sql(s, m) for s in SHARES for m in repair.METHODS))
def repair_experiment(spark, sf):
    o = table(spark, sf, "orders").select(KEY, X, Y)
    out = repair.experiment(o, [Y], SHARES, repair.METHODS, row_id=KEY, numeric=[X])
    return rounded(rounded(out, ["mean_before", "median_before", "mean", "median", "error_pct"]), ["first_mode"], 4)
