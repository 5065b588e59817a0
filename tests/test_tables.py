"""Checks, statistics, profile, encoders: golden values worked out by hand."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.functions import ranks
from sparkloom.functions.distance import binomial, chebyshev_distance, euclidean_distance, euclidean_squared_distance
from sparkloom.operators import checks, encode, profile
from sparkloom.sources.spec import ColumnSpec, TableSpec


def col(spark, values, kind="string", name="v"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"row_id bigint, {name} {kind}")


def values(df, c):
    return [r[c] for r in df.orderBy("row_id").collect()]


# --- ranks ---------------------------------------------------------------------

def test_exact_quantiles_match_numpy_on_skewed_values(spark, monkeypatch):
    monkeypatch.setattr(ranks, "FEW_ROWS", 20)
    monkeypatch.setattr(ranks, "BUCKETS", 8)
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=400), np.full(200, 0.25), [1e9, -1e7]])
    df = spark.createDataFrame([(float(v), int(v * 10) if abs(v) < 1e6 else 5) for v in x], "d double, n bigint")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = ranks.exact_quantiles(df, ["d", "n"], probs)
    ints = [int(v * 10) if abs(v) < 1e6 else 5 for v in x]
    assert got["d"] == pytest.approx(list(np.quantile(x, probs)), rel=1e-12)
    assert got["n"] == pytest.approx(list(np.quantile(ints, probs)), rel=1e-12)
    assert ranks.exact_quantiles(df.where("d > 1e12"), ["d"], probs)["d"] is None


def test_digest_bound_takes_exactly_n_rows(spark, monkeypatch):
    monkeypatch.setattr(ranks, "FEW_ROWS", 3)
    df = spark.range(500).withColumn("h", F.md5(F.col("id").cast("string")))
    for n in (1, 37, 500):
        bound = ranks.smallest_digest_bound(df, F.col("h"), n)
        assert df.where(F.col("h") <= bound).count() == n
    with pytest.raises(ValueError):
        ranks.smallest_digest_bound(df, F.col("h"), 501)


def test_positions_and_group_ranks_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i, i % 3, float(i * 7 % 11)) for i in range(40)], "id bigint, g int, w double")
    a = sorted(map(tuple, ranks.rank_within(df.repartition(7), ["g"], ["w", "id"]).collect()))
    b = sorted(map(tuple, ranks.rank_within(df.coalesce(1), ["g"], ["w", "id"]).collect()))
    assert a == b
    assert sorted(r[3] for r in a if r[1] == 0) == list(range(1, 15))
    assert sorted(r["position"] for r in ranks.with_position(df, ["w", "id"]).collect()) == list(range(40))


# --- checks --------------------------------------------------------------------

def test_guards(spark):
    df = col(spark, [1.0, None, 3.0], "double")
    assert checks.drop_missing(df, "v").count() == 2
    with pytest.raises(ValueError):
        checks.require_complete(df, "v")
    with pytest.raises(Exception, match="missing values"):
        checks.assert_complete(df, "v").count()
    with pytest.raises(ValueError):
        checks.require_numeric(col(spark, ["a"]), "v")
    with pytest.raises(ValueError):
        checks.require_column(df, "nope")
    assert values(checks.null_report(df).withColumn("row_id", F.col("column")), "missing") == [0, 1]
    with pytest.raises(ValueError):
        checks.validate_input(df.limit(0), [])
    with pytest.warns(UserWarning):
        assert checks.validate_input(df, ["gone"]) == ["gone"]
    with pytest.raises(ValueError):
        checks.select_features(df, [])
    with pytest.raises(ValueError):
        checks.select_features(df, ["v", "v"], exactly=2)
    assert checks.numeric_columns(df, exclude=("row_id",)) == ["v"]


def test_nan_counts_as_missing(spark):
    df = col(spark, [1.0, float("nan"), None], "double")
    assert {r["column"]: r["missing"] for r in checks.null_report(df).collect()}["v"] == 2


def test_loss_and_quality(spark):
    df = spark.range(10).select(F.col("id").alias("row_id"), F.lit(1.0).alias("c"), F.col("id").cast("double").alias("x"))
    assert checks.loss_check(df, df.where("row_id < 4")).first()["verdict"] == "error"
    with pytest.raises(checks.QualityError):
        checks.require_small_loss(df, df.where("row_id < 4"))
    with pytest.warns(UserWarning):
        checks.require_small_loss(df, df.where("row_id < 7"))
    q = {r["feature"]: r["verdict"] for r in checks.feature_quality(df, ["c", "x"]).collect()}
    assert q == {"c": "error", "x": "ok"}
    with pytest.raises(checks.QualityError):
        checks.require_feature_quality(df, ["c"])


def test_vectors_and_k_range(spark):
    v = spark.createDataFrame([([1.0, 2.0],), ([1.0, float("inf")],)], "f array<double>")
    with pytest.raises(checks.QualityError):
        checks.require_vectors(v, "f")
    assert checks.require_vectors(v.limit(1), "f", 2) == 1
    for bad in ((0, 3), (1, 1), (3, 3)):
        with pytest.raises(ValueError):
            checks.check_k_range(*bad, "euclidean")
    with pytest.raises(TypeError):
        checks.check_k_range(1.5, 3, "euclidean")
    with pytest.warns(UserWarning):
        checks.check_k_range(2, 3, "manhattan")


def test_date_parts_from_text(spark):
    df = spark.createDataFrame([("2021-03-04 05:06:07",)], "ts string")
    out = checks.date_parts(df, "ts")
    assert out.columns == ["year", "month", "day"] and tuple(out.first()) == (2021, 3, 4)


# --- distances and statistics ------------------------------------------------------

def test_distances(spark):
    row = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0, 5.0, 6.0])], "x array<double>, y array<double>").select(
        euclidean_distance("x", "y").alias("e"), euclidean_squared_distance("x", "y").alias("s"), chebyshev_distance("x", "y").alias("c")).first()
    assert row["e"] == 5.196152422706632 and row["s"] == 27 and row["c"] == 3
    assert [binomial(5), binomial(1), binomial(5, 6), binomial(6, 3), binomial(-1)] == [10, 0, 0, 20, 0]


def test_statistics(spark):
    df = col(spark, ["b", "a", "b", "a", "c"])
    assert [r["value"] for r in profile.modes(df, "v").collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        profile.modes(col(spark, ["a", None]), "v")
    assert profile.entropy(col(spark, ["a", "a", "b", None]), ["v"]).first()["entropy"] == pytest.approx(1.0, abs=1e-8)
    assert profile.median(col(spark, [1.0, 2.0, 10.0, 4.0], "double"), "v").first()["median"] == 3.0
    assert profile.distinct_counts(col(spark, ["a", None, "a"]), ["v"]).first()["distinct_values"] == 1
    h = profile.histogram(col(spark, [0.0, 1.0, 1.0, 4.0], "double"), "v", 4).orderBy("bin").collect()
    assert [r["count"] for r in h] == [1, 2, 0, 1]
    d = profile.density(col(spark, [0.0, 1.0, 3.0], "double"), "v", 50)
    assert all(r["density"] > 0 for r in d.collect())


def test_ordinal_rules(spark):
    assert profile.ordinal_order(["Master", "None", "Bachelor", "High School", "PhD"]) == ["None", "High School", "Bachelor", "Master"]
    assert profile.ordinal_order(["b", "a"]) == ["a", "b"]
    assert profile.ordinal_order(["good", "Poor", "Fair"]) == ["Poor", "Fair"]  # spelling decides
    df = spark.createDataFrame(
        [(i, i, "x" if i % 2 else "y", "low" if i else "z", "p", bool(i % 2), i % 7, 1000.0 + i % 30) for i in range(60)],
        "student_id int, big int, nominal string, words string, my_grade string, flag boolean, few int, steady double")
    kinds = {r["column"]: r["kind"] for r in profile.column_kinds(profile.column_profile(df)).collect()}
    assert kinds == {"student_id": "identifier", "big": "numerical_continuous", "nominal": "categorical_nominal",
                     "words": "categorical_ordinal", "my_grade": "categorical_ordinal", "flag": "categorical_nominal",
                     "few": "numerical_discrete", "steady": "numerical_discrete"}


# --- encoders ---------------------------------------------------------------------------

def test_label_onehot_ordinal_frequency(spark):
    df = col(spark, ["a", "c", "z"])
    for fitted in (["a", "b", "c"], spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "value string, code int")):
        assert values(encode.label_encode(df, "v", fitted), "v") == [0, 2, 0]
    one = encode.onehot_encode(df, "v", ["a", "b", "c"])
    assert one.columns == ["row_id", "v_b", "v_c"] and values(one, "v_c") == [0.0, 1.0, 0.0]
    assert values(encode.ordinal_encode(df, "v", ["c", "a"]), "v") == [1, 0, 0]
    with pytest.raises(ValueError):
        encode.ordinal_encode(df, "v", [])
    fitted = encode.frequencies(col(spark, ["a", "a", "b", None]), "v")
    assert [round(x, 6) for x in values(encode.frequency_encode(df, "v", fitted), "v")] == [0.666667, 0.0, 0.0]


def test_scalers_on_constants_and_nulls(spark):
    df = col(spark, [5.0, 5.0, None], "double")
    assert values(encode.standard_scale(df, ["v"]), "v") == [0.0, 0.0, None]
    assert values(encode.minmax_scale(df, ["v"]), "v") == [0.0, 0.0, None]
    assert values(encode.standard_scale(col(spark, [1.0, 3.0], "double"), ["v"]), "v") == [-1.0, 1.0]


def test_fit_transform_reuses_fitted_statistics(spark):
    spec = TableSpec({"student_id": ColumnSpec("student_id", "identifier"), "x": ColumnSpec("x", "numerical_discrete", scaling="none"),
                      "g": ColumnSpec("g", "categorical_nominal", encoding="label")})
    df = spark.createDataFrame([(0, 9, 1.0, "b"), (1, 8, 2.0, "b"), (2, 7, 3.0, None)], "row_id bigint, student_id int, x double, g string")
    out, fitted = encode.fit_transform(df, spec)
    assert out.columns == ["row_id", "x", "g"] and fitted.feature_names() == ["x", "g"]
    assert fitted.summary()["output_count"] == 2
    new = spark.createDataFrame([(0, 1, 4.0, None), (1, 1, 4.0, "q")], df.schema)
    assert values(encode.transform(new, fitted), "g") == [0, 0]
    with pytest.raises(ValueError):
        encode.transform(df, None)
    with pytest.raises(ValueError):
        encode.Fitted(spec).feature_names()


def test_decode_anonymised(spark):
    assert values(encode.decode_anonymised(col(spark, ["18-20", "-1.0-0.5", None])), "v") == [19.0, 0.0, 0.0]
    assert values(encode.decode_anonymised(col(spark, ["b", None, "a"])), "v") == [1, 2, 0]
    assert values(encode.decode_anonymised(col(spark, ["x-y", "a-b-c", None])), "v") == [2, 0, 1]


def test_spec_round_trip_is_tolerant(spark, tmp_path):
    spec = TableSpec.from_dict({"columns": {"a": {"kind": "odd", "scaling": "odd", "encoding": "odd"}, "b": {"kind": "identifier"}}, "seed": 7})
    a = spec.columns["a"]
    assert (a.kind, a.scaling, a.encoding) == ("categorical_nominal", "standard", "label") and spec.columns["b"].scaling is None
    spec.save(spark, str(tmp_path / "spec"))
    assert TableSpec.load(spark, str(tmp_path / "spec")) == spec
    assert spec.table(spark).count() == 2


def test_spearman_averages_ties(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (2.0, 7.0), (9.0, 6.0)], "a double, b double")
    ra, rb = [1, 2.5, 2.5, 4], [1.5, 1.5, 4, 3]
    assert profile.spearman(df, ["a", "b"]).first()["r"] == pytest.approx(float(np.corrcoef(ra, rb)[0, 1]))
    assert not math.isnan(profile.correlations(df, ["a", "b"]).first()["r"])


def test_median_of_values_near_both_limits(spark):
    from sparkloom.functions.ranks import exact_quantiles
    big = 1.5e308
    df = spark.range(6004).select(((F.col("id") - 3001.5) / 3001.5 * big).alias("v"))
    values = sorted(r["v"] for r in df.collect())
    got = exact_quantiles(df, ["v"], [0.0, 0.25, 1.0])["v"]
    assert got[0] == values[0] and got[2] == values[-1] and abs(got[1] - values[1500]) < big / 1000


def test_ordinal_order_has_all_levels(spark):
    df = spark.range(240).select(F.format_string("g%02d", F.col("id") % 12).alias("grade"))
    spec = profile.default_spec(profile.column_profile(df))
    assert spec.columns["grade"].ordinal == [f"g{i:02d}" for i in range(12)]
    many = spark.range(2000).select(F.format_string("level %d", F.col("id")).alias("grade"))
    with pytest.raises(ValueError, match="2000 levels"):
        profile.default_spec(profile.column_profile(many))


def test_profiles_of_parts_merge(spark):
    rows = [(i, f"t{min(i % 50, 7)}" if i % 9 else None, float(i % 400) if i % 5 else None, i % 3 == 0) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k bigint, word string, v double, flag boolean")
    parts = None
    for i in range(4):
        one = profile.sketch_profile(df.where(F.pmod(F.xxhash64("k"), F.lit(4)) == i))
        parts = one if parts is None else parts.unionByName(one)
    got = {x["column"]: x for x in profile.estimated_profile(profile.merge_profiles(parts)).collect()}
    want = {x["column"]: x for x in profile.column_profile(df).collect()}
    assert list(got) == ["k", "word", "v", "flag"] or sorted(got) == sorted(want)
    for c, w in want.items():
        g = got[c]
        assert (g.rows, g.missing, g.min_value, g.max_value) == (w.rows, w.missing, w.min_value, w.max_value)
        assert abs(g.distinct_values - w.distinct_values) <= 0.06 * w.distinct_values
        if w.mean_value is not None:
            assert g.mean_value == pytest.approx(w.mean_value) and g.std_value == pytest.approx(w.std_value)
            rank = df.where(F.col(c) <= g.median_value).count() / df.where(F.col(c).isNotNull()).count()
            assert abs(rank - 0.5) < 0.02
    assert [(x["item"], x["count"]) for x in got["word"].top][:1] == [(want["word"].top_value, want["word"].top_count)]
    assert [x["item"] for x in got["word"].top][:8] and got["word"].distinct_values == 8
    none = profile.estimated_profile(profile.merge_profiles(profile.sketch_profile(df.limit(0).select("k", "word")))).collect()
    assert {(x["rows"], x["distinct_values"], x["mean_value"]) for x in none} == {(0, 0, None)}


def test_order_statistics_count_numbers_of_any_distance(spark, monkeypatch):
    monkeypatch.setattr(ranks, "FEW_ROWS", 3)
    wide = [-2 ** 63, 2 ** 63 - 1, 0, None, 5, 5, 5, 5, -7, 2 ** 62, 2 ** 53 + 1, 2 ** 53]
    real = [0.0, -0.5, None, -1e308, 1e308, 2.5, 2.5, 2.5, 2.5, 1e-9, -3.0, 7.0]
    df = spark.createDataFrame(list(zip(wide, real, strict=True)), "n bigint, d double")
    n, d = sorted(v for v in wide if v is not None), sorted(v for v in real if v is not None)
    got = ranks.order_statistics(df, {"n": list(range(len(n))), "d": list(range(len(d)))})
    assert [got["n"][i] for i in range(len(n))] == n  # their differences do not fit into 64 bits
    assert [got["d"][i] for i in range(len(d))] == d
