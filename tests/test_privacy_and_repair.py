"""k-anonymity, generalisation, suppression, injection, repair and ridge."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.operators import missing, privacy, ridge
from sparkloom.plans import repair


def groups(spark, sizes):
    rows = [(i, f"g{k}") for k, s in enumerate(sizes) for i in range(s)]
    return spark.createDataFrame([(n, g) for n, (_, g) in enumerate(rows)], "row_id bigint, q string")


def numbers(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"row_id bigint, v {kind}")


def test_risk_of_small_classes(spark):
    c = privacy.class_sizes(groups(spark, [1, 2, 4, 5]), ["q"])
    r = privacy.risk(c).first()
    assert r["risk_level"] == "HIGH" and r["percent_unique"] == pytest.approx(8.3333, abs=1e-3)
    assert r["percent_small"] == pytest.approx(58.333, abs=1e-2)
    s = privacy.group_stats(c).first()
    assert (s["min_group_size"], s["max_group_size"], s["mean_group_size"], s["median_group_size"]) == (1, 5, 3.0, 3.0)
    assert s["std_group_size"] == pytest.approx(np.std([1, 2, 4, 5], ddof=1))
    assert privacy.recommendations(privacy.group_stats(c)).first()["codes"][0] == "critical_unique_rows"
    assert privacy.vulnerability(c).first()["unique_pct"] == 25.0


def test_null_keys(spark):
    df = spark.createDataFrame([(0, "a"), (1, None), (2, "a")], "row_id bigint, q string")
    assert privacy.k_report(df, ["q"]).first()["k"] == 2 and privacy.k_report(df, ["q"]).first()["total_rows"] == 3
    assert privacy.compact_report(df, ["q"]).first()["k"] == 1
    with pytest.raises(ValueError):
        privacy.k_report(df, ["absent"])
    assert set(privacy.analyse(df, ["q"])) == {"summary", "classes", "groups", "sizes", "vulnerability", "impact", "risk", "recommendations"}


def test_edges_and_labels(spark):
    assert [privacy.round_edge(x) for x in (0, 0.26, 5.5, 7, 12, 19, 33, 120, 1250)] == [0, 0.3, 6, 7, 10, 20, 35, 100, 1000]
    out = privacy.generalise_numeric(numbers(spark, [1, 5, 9, 12, 18, 20, 33, None], "int"), "v", "moderate")
    got = [r["v"] for r in out.orderBy("row_id").collect()]
    assert got == ["1-7", "1-7", "7-10", "10-20", "10-20", "10-20", "20-35", "nan"]
    few = numbers(spark, [1, 2], "int")
    assert privacy.generalise_numeric(few, "v", "moderate").schema == few.schema


def test_text_rules(spark):
    df = spark.createDataFrame([("Male", "PhD", "4", "x"), (None, "None", "Poor", "y")], "gender string, education string, my_rating string, job string")
    m = privacy.generalise(df, df.columns, "moderate").collect()
    assert tuple(m[0]) == ("M", "Higher Education", "High", "x") and tuple(m[1]) == ("nan", "No Formal Education", "Low", "y")
    assert tuple(privacy.generalise(df, df.columns, "high").first()) == ("***", "Higher Education", "High", "***")
    assert privacy.generalise(df, df.columns, "low").collect() == df.collect()


def test_suppression_guards(spark):
    assert privacy.suppress_rare(groups(spark, [1, 2]), ["q"], 2).count() == 3            # fewer than 3 * min_count rows
    assert privacy.suppress_rare(groups(spark, [1, 9]), ["q"], 2).count() == 9
    assert privacy.suppress_rare(groups(spark, [2, 2, 1, 7]), ["q"], 3).count() == 11     # lowered once
    assert privacy.suppress_rare(groups(spark, [1] * 5 + [7]), ["q"], 2).count() == 12    # nothing dropped
    assert privacy.anonymise(groups(spark, [1, 9]).withColumn("n", F.lit("a")), ["n"], "high").count() == 10


def test_injection_counts(spark):
    df = numbers(spark, [float(i) for i in range(10)])
    assert missing.inject_random(df, "v", 0.25).where("v is null").count() == 2
    block = sorted(r["row_id"] for r in missing.inject_block(df, "v", 0.35).where("v is null").collect())
    assert len(block) == 4 and block == list(range(block[0], block[0] + 4))
    a = sorted(map(str, missing.inject_random(df.repartition(5), "v", 0.4).collect()))
    assert a == sorted(map(str, missing.inject_random(df.coalesce(1), "v", 0.4).collect()))
    for bad in (0, 1, 1.5):
        with pytest.raises(ValueError):
            missing.inject_random(df, "v", bad)


def test_simple_repairs(spark):
    m = missing.fill_mean(numbers(spark, [1.0, None, 3.0, float("nan")]), "v")
    assert [r["v"] for r in m.orderBy("row_id").collect()] == [1.0, 2.0, 3.0, 2.0]
    t = missing.fill_mode(numbers(spark, ["b", "a", "b", "a", None], "string"), "v")
    assert [r["v"] for r in t.orderBy("row_id").collect()][-1] == "a"
    assert missing.fill_mode(numbers(spark, [None, None], "string"), "v").first()["v"] == "Unknown"
    with pytest.raises(ValueError):
        missing.fill_mean(numbers(spark, ["a"], "string"), "v")


def test_relative_error(spark):
    truth, holes, filled = numbers(spark, [10.0, 20.0, 0.0, 5.0]), numbers(spark, [None, None, None, 5.0]), numbers(spark, [9.0, 25.0, 1.0, 5.0])
    r = missing.relative_error(truth, holes, filled, "v").first()
    assert (r["error_pct"], r["scored_rows"], r["zero_truth_rows"]) == (pytest.approx(17.5), 2, 1)
    assert missing.relative_error(truth, holes, filled, "v", rows_removed=True).first()["error_pct"] is None


def test_regression_matches_direct_solution(spark):
    rng = np.random.default_rng(5)
    n = 203
    x, g, b = rng.normal(2000, 3, n), rng.integers(0, 3, n), rng.integers(0, 5, n)
    y = 3 * x - 40 * (g == 1) + 10 * (b == 2) + rng.normal(size=n)
    hole = np.zeros(n, bool)
    hole[50:80] = True
    df = spark.createDataFrame([(i, float(x[i]), f"g{g[i]}", f"b{b[i]}", None if hole[i] else float(y[i])) for i in range(n)],
                               "row_id bigint, x double, g string, b string, y double")
    fitted = ridge.fit_regression(df, "y", numeric=["x"], onehot=["g"], freq=["b"])
    share = {v: (b[~hole] == v).mean() for v in range(5)}
    z = np.column_stack([x, g == 1, g == 2, [share[v] for v in b]]).astype(float)
    mu, sd = z[~hole].mean(0), z[~hole].std(0)
    z = (z - mu) / sd
    zt, yt = z[~hole], y[~hole]
    sizes = [len(yt) // 5 + (i < len(yt) % 5) for i in range(5)]
    edge = np.cumsum([0, *sizes])

    def fit(a, zz, yy):
        m = zz.mean(0)
        w = np.linalg.solve((zz - m).T @ (zz - m) + a * np.eye(4), (zz - m).T @ (yy - yy.mean()))
        return w, yy.mean() - m @ w
    scores = []
    for a in ridge.ALPHAS:
        part = []
        for i in range(5):
            t = np.zeros(len(yt), bool)
            t[edge[i]:edge[i + 1]] = True
            w, c = fit(a, zt[~t], yt[~t])
            part.append(-np.mean((yt[t] - zt[t] @ w - c) ** 2))
        scores.append(np.mean(part))
    assert [r[1] for r in fitted.search.rows] == pytest.approx(scores, rel=1e-6)
    best = ridge.ALPHAS[int(np.argmax(scores))]
    assert fitted.search.alpha == best
    w, c = fit(best, zt, yt)
    filled = ridge.fill_regression(df, "y", numeric=["x"], onehot=["g"], freq=["b"])
    assert filled.columns == df.columns
    got = np.array([r["y"] for r in filled.orderBy("row_id").collect()])
    assert got[hole] == pytest.approx(z[hole] @ w + c, rel=1e-6) and got[~hole] == pytest.approx(y[~hole])
    noisy = ridge.fill_regression(df, "y", numeric=["x"], onehot=["g"], freq=["b"], noise_seed=1)
    assert np.std([r["y"] for r in noisy.orderBy("row_id").collect()] - got) > 0
    assert ridge.fill_regression(df.na.drop(), "y", numeric=["x"]).count() == n - 30


def test_repair_by_name(spark):
    df = numbers(spark, [1.0, None, 3.0])
    assert repair.repair(df, "v", "drop").count() == 2
    with pytest.raises(ValueError):
        repair.repair(df, "v", "magic")


@pytest.mark.parametrize("injection", ["block", "random"])
def test_grid_equals_one_setting_after_the_other(spark, injection):
    rng = np.random.default_rng(8)
    n = 240
    x, g, b = rng.normal(50, 9, n), rng.integers(0, 4, n), rng.integers(0, 6, n)
    y = np.round(2 * x + 15 * (g == 2) + rng.normal(size=n))
    rows = [(i, None if i % 17 == 3 else float(x[i]), None if i % 13 == 5 else f"g{g[i]}", None if i % 19 == 1 else f"b{b[i]}",
             0.0 if i == 7 else float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "row_id bigint, x double, g string, b string, y double")
    roles = {"numeric": ["x"], "onehot": ["g"], "freq": ["b"]}
    methods = ("drop", "mean", "mode", "regression", "stochastic_regression")
    got = {(r["share"], r["method"]): r for r in repair.experiment(
        df, ["y"], (0.05, 0.3), methods, injection=injection, noise_seed=3, **roles).collect()}
    assert len(got) == 10
    inject = {"block": missing.inject_block, "random": missing.inject_random}[injection]
    before = repair.statistics(df, "y").first()
    for share in (0.05, 0.3):
        holes = inject(df, "y", share)
        for m in methods:
            extra = {**roles, **({"noise_seed": 3} if m.startswith("stoch") else {})} if "regression" in m else {}
            fixed = repair.repair(holes, "y", m, **extra)
            want = {**repair.statistics(fixed, "y").first().asDict(), "mean_before": before["mean"], "median_before": before["median"],
                    "error_pct": missing.relative_error(df, holes, fixed, "y", rows_removed=m == "drop").first()["error_pct"]}
            for k, v in want.items():
                assert got[share, m][k] == (v if v is None else pytest.approx(v, rel=1e-7)), (share, m, k)


def test_grid_with_missing_from_the_start(spark):
    df = numbers(spark, [1.0, None, 3.0, float("nan"), 5.0, 5.0, 7.0, 9.0, 2.0, 4.0])
    rows = repair.experiment(df, ["v"], (0.2, 0.01), ("drop", "mean"), injection="random").collect()
    small = {r["method"]: r for r in rows if r["share"] == 0.01}  # no hole is made, the missing values are repaired
    assert small["mean"]["mean"] == pytest.approx(4.5) and small["drop"]["first_mode"] == 5.0 and small["mean"]["error_pct"] is None
    with pytest.raises(ValueError):
        repair.experiment(df, ["v"], (0.2,), ("magic",))
    with pytest.raises(ValueError):
        repair.experiment(df, ["v"], (0.2,), ("mean",), injection="odd")
