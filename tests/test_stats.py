import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from regispark.operators import features as L, linear, stats as T
from regispark.operators.tails import chi2_sf, f_sf, with_p_value


def test_distribution_tails(spark):
    assert abs(chi2_sf(spark, 3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(chi2_sf(spark, 5.991464547107979, 2) - 0.05) < 1e-9
    assert abs(f_sf(spark, 4.35124348, 1, 20) - 0.05) < 1e-6
    assert abs(chi2_sf(spark, 2.0, 2) - math.exp(-1.0)) < 1e-12


@pytest.mark.parametrize("d", [1e6, 1e8, 1e12])
def test_tails_of_many_degrees_of_freedom(spark, d):
    """At the mean and two deviations off it, where the first Edgeworth term is known."""
    def normal(z, skew):
        return 0.5 * math.erfc(z / math.sqrt(2)) + skew / 6 * (z * z - 1) * math.exp(-z * z / 2) / math.sqrt(2 * math.pi)

    for z in (-2.0, 0.0, 2.0):
        assert chi2_sf(spark, d + z * math.sqrt(2 * d), d) == pytest.approx(normal(z, math.sqrt(8 / d)), abs=2e-6 if d < 1e7 else 1e-7)
    assert f_sf(spark, 1.0, d, d) == pytest.approx(0.5, abs=1e-7)
    assert f_sf(spark, 3.841458820694124, 1, d) == pytest.approx(0.05, abs=1e-6)
    assert f_sf(spark, 1 / 3.841458820694124, d, 1) == pytest.approx(0.95, abs=1e-6)
    for f in (0.999, 1.001):
        assert f_sf(spark, f, d, 1e4) + f_sf(spark, 1 / f, 1e4, d) == pytest.approx(1.0, abs=1e-9)


def test_p_values_of_undefined_and_extreme_statistics(spark):
    df = spark.createDataFrame([(None, 1.0, 5.0), (float("inf"), 1.0, 5.0), (0.0, 1.0, 5.0), (1.0, 0.0, 5.0), (float("nan"), 1.0, 5.0)], "f double, a double, b double")
    assert [r.p_value for r in with_p_value(df, "f", "f", "a", "b").collect()] == [None, 0.0, 1.0, None, None]


def test_p_values_agree_with_spark_ml(spark):
    """The F test of one feature is the t test of its slope; two classes make the ANOVA the same."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(float(k % 2), float(k % 2 * 0.3 + x)) for k, x in enumerate(rng.normal(size=300))], "g double, x double")
    data = VectorAssembler(inputCols=["g"], outputCol="features").transform(df)
    want = LinearRegression(labelCol="x", solver="normal").fit(data).summary.pValues[0]
    assert T.f_regression(df, "x", ["g"]).first().p_value == pytest.approx(want, rel=1e-6)
    assert T.anova_f(df, "g", ["x"]).first().p_value == pytest.approx(want, rel=1e-6)


@pytest.mark.parametrize("lags,groups,parts", [(1, False, 7), (2, True, 5), (3, True, 16)])
def test_lagged_matches_pandas(spark, lags, groups, parts):
    rnd = random.Random(lags)
    data = [(i, rnd.choice("ab") if groups else "a", rnd.random()) for i in rnd.sample(range(10_000), 400)]
    df = spark.createDataFrame(data, "t long, g string, x double").repartition(3)
    out = T.lagged(df, "x", "t", lags, ["g"] if groups else [], num_partitions=parts).toPandas()
    pdf = pd.DataFrame(data, columns=["t", "g", "x"]).sort_values("t")
    for k in range(1, lags + 1):
        pdf[f"lag{k}_x"] = pdf.groupby("g")["x"].shift(k) if groups else pdf["x"].shift(k)
    got = out.sort_values("t").reset_index(drop=True)
    exp = pdf.reset_index(drop=True)
    for k in range(1, lags + 1):
        a, b = got[f"lag{k}_x"].to_numpy(dtype=float), exp[f"lag{k}_x"].to_numpy(dtype=float)
        assert np.array_equal(np.isnan(a), np.isnan(b))
        assert np.allclose(a[~np.isnan(a)], b[~np.isnan(b)])


def test_durbin_watson_brute_force(spark):
    rnd = random.Random(3)
    e = [rnd.gauss(0, 1) for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(e)], "t long, e double")
    got = T.durbin_watson(df, "e", "t").first()["dw"]
    exp = sum((e[i] - e[i - 1]) ** 2 for i in range(1, len(e))) / sum(v * v for v in e)
    assert abs(got - exp) < 1e-9


def test_jarque_bera(spark):
    rnd = random.Random(5)
    xs = [rnd.gauss(0, 1) for _ in range(2000)]
    r = T.jarque_bera(spark.createDataFrame([(x,) for x in xs], "x double"), "x").first()
    n = len(xs); mu = sum(xs) / n
    m2 = sum((x - mu) ** 2 for x in xs) / n; m3 = sum((x - mu) ** 3 for x in xs) / n; m4 = sum((x - mu) ** 4 for x in xs) / n
    s, k = m3 / m2 ** 1.5, m4 / m2 ** 2 - 3
    assert abs(r["jb"] - n / 6 * (s * s + k * k / 4)) < 1e-6 and r["normal"]


def test_breusch_pagan_and_vif(spark):
    rnd = random.Random(9)
    data = [(float(x), 2 * x + rnd.gauss(0, 1 + x), rnd.random()) for x in range(200)]
    df = spark.createDataFrame(data, "x double, y double, z double")
    res = T.residuals(df, "y", ["x"], "e")
    bp = T.breusch_pagan(res, "e", ["x"]).first()
    assert bp["lm"] > 10 and bp["p_value"] < 0.01
    v = {r[0]: r[1] for r in T.vif(df, ["x", "z"]).collect()}
    r = np.corrcoef([d[0] for d in data], [d[2] for d in data])[0, 1]
    assert abs(v["x"] - 1 / (1 - r * r)) < 1e-9


def test_anova_and_f_regression(spark):
    data = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 4.0), ("b", 5.0), ("b", 6.0)]
    r = T.anova_f(spark.createDataFrame(data, "g string, x double"), "g", ["x"]).first()
    assert abs(r["f_value"] - 13.5) < 1e-9 and r["df1"] == 1 and r["df2"] == 4
    assert 0 < r["p_value"] < 0.05


def test_lagged_many_buckets(spark, monkeypatch):
    """Small data forced into many buckets: bucket heads are stitched from earlier buckets."""
    from regispark.operators import ordering as O

    monkeypatch.setattr(O, "MIN_ROWS_PER_BUCKET", 1)
    rnd = random.Random(21)
    data = [(i, rnd.choice("ab"), rnd.random()) for i in rnd.sample(range(10_000), 500)]
    df = spark.createDataFrame(data, "t long, g string, x double")
    out = T.lagged(df, "x", "t", 2, ["g"], num_partitions=40).toPandas().sort_values("t").reset_index(drop=True)
    exp = pd.DataFrame(data, columns=["t", "g", "x"]).sort_values("t").reset_index(drop=True)
    for k in (1, 2):
        e = exp.groupby("g")["x"].shift(k).to_numpy(dtype=float)
        a = out[f"lag{k}_x"].to_numpy(dtype=float)
        assert np.array_equal(np.isnan(a), np.isnan(e)) and np.allclose(a[~np.isnan(a)], e[~np.isnan(e)])


def test_linear_diagnostics_agree_with_least_squares(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 2))
    y = 3.0 + 0.5 * x[:, 0] + 0.2 * x[:, 1] + rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    got = {r.term: r for r in T.linear_diagnostics(df, "y", ["a", "b"]).collect()}
    full = np.column_stack([x, np.ones(200)])
    beta = np.linalg.lstsq(full, y, rcond=None)[0]
    sse, sst = float(((y - full @ beta) ** 2).sum()), float(((y - y.mean()) ** 2).sum())
    row = got["a"]
    assert [got[t].coefficient for t in ("a", "b", "intercept")] == pytest.approx(beta.tolist())
    assert row.mse == pytest.approx(sse / 200) and row.f_value == pytest.approx((sst - sse) / 2 / (sse / 197))
    # with one feature the F test is the square of its t test
    one = T.linear_diagnostics(df, "y", ["b"]).filter("term = 'b'").first()
    assert one.f_value == pytest.approx(one.t_value ** 2) and one.f_p_value == pytest.approx(one.p_value, rel=1e-6)


# ---- normal equations with categories and dependent columns


def mixed_rows(n=400, seed=0):
    rng = np.random.default_rng(seed)
    c, d = rng.integers(0, 4, n), rng.integers(0, 3, n)
    a, b = rng.normal(size=n), rng.normal(size=n)
    y = 1e6 + 2 * a - b + (c % 3) + rng.normal(size=n) * (1 + c)
    return [(float(1e4 + x), float(1e4 + z + x), f"c{i}", f"d{j}", float(w)) for x, z, i, j, w in zip(a, b, c, d, y)]


def design(rows, numeric=(), categorical=()):
    cols = [np.array([r[i] for r in rows], dtype=float) for i in numeric]
    for i in categorical:
        values = [r[i] for r in rows]
        cols += [np.array([v == level for v in values], dtype=float) for level in sorted(set(values))[1:]]
    return np.column_stack([np.ones(len(rows)), *[x - x.mean() for x in cols]])


def r_squared(x, y):
    e = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
    return 1 - float(e @ e) / float(((y - y.mean()) ** 2).sum()), float(e @ e)


SCHEMA = "a double, b double, c string, d string, y double"


def test_breusch_pagan_on_categories(spark):
    rows = mixed_rows()
    df = spark.createDataFrame(rows + [(1.0, 1.0, None, "d0", 1.0), (None, 1.0, "c1", "d1", 2.0)], SCHEMA)
    centred = df.withColumn("e", F.col("y") - 1e6)
    got = T.breusch_pagan(centred, "e", ["c", "d", "a"]).first()
    x = design(rows, [0], [2, 3])
    want = r_squared(x, (np.array([r[4] for r in rows]) - 1e6) ** 2)[0]
    assert (got.n, got.dof) == (400, 6) and got.lm == pytest.approx(400 * want, rel=1e-8) and got.p_value < 1e-4
    # a category that repeats another adds no degree of freedom
    same = T.breusch_pagan(centred.withColumn("again", F.concat(F.lit("x"), F.col("c"))), "e", ["c", "d", "a", "again"]).first()
    assert same.dof == 6 and same.lm == pytest.approx(got.lm)
    flat = T.breusch_pagan(centred.withColumn("e", F.lit(2.0)), "e", ["c"]).first()
    assert flat.r2 is None and flat.lm is None and flat.p_value is None and flat.n == 401
    assert T.breusch_pagan(centred.limit(0), "e", ["c", "a"]).first().lm is None
    with pytest.raises(ValueError, match="slots"):
        linear.moments(df, "y", ["c"], max_levels=2)


def test_residuals_and_diagnostics_with_categories_and_dependent_columns(spark):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"k": F.lit(3.0), "twice": 2 * F.col("a") - 1})
    y, x = np.array([r[4] for r in rows]), design(rows, [0, 1], [2])
    r2, sse = r_squared(x, y)
    res = T.residuals(df, "y", ["a", "b", "c"], "e", keep=["d"])
    assert res.columns == ["d", "y", "a", "b", "c", "e"]
    assert res.agg(F.sum(F.col("e") ** 2)).first()[0] == pytest.approx(sse, rel=1e-6)
    got = {r.term: r for r in T.linear_diagnostics(df, "y", ["a", "b", "c", "k", "twice"]).collect()}
    assert list(got) == ["a", "b", "c=c1", "c=c2", "c=c3", "k", "twice", "intercept"]
    assert got["k"].coefficient is None and got["twice"].t_value is None and got["twice"].p_value is None
    row = got["a"]
    assert row.r2 == pytest.approx(r2, rel=1e-6) and row.mse == pytest.approx(sse / 400, rel=1e-6) and row.f_value == pytest.approx(r2 / 5 / ((1 - r2) / 394), rel=1e-6)
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    noise = np.sqrt(sse / 394 * np.diag(np.linalg.inv(x.T @ x)))
    assert [got[t].t_value for t in ("a", "b", "c=c1", "c=c2", "c=c3")] == pytest.approx((beta / noise)[1:].tolist(), rel=1e-5)


def test_diagnostics_without_residuals_or_variation(spark):
    two = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0)], "x double, y double")
    row = T.linear_diagnostics(two, "y", ["x"]).first()
    assert row.coefficient == pytest.approx(2.0) and row.t_value is None and row.f_value is None and row.f_p_value is None and row.r2_adj is None
    flat = T.linear_diagnostics(two.withColumn("y", F.lit(1.0)), "y", ["x"]).first()
    assert flat.r2 is None and flat.coefficient == 0.0
    none = T.linear_diagnostics(two.limit(0), "y", ["x"]).collect()
    assert [(r.term, r.coefficient, r.mse) for r in none] == [("x", None, None), ("intercept", None, None)]
    assert T.f_regression(two.withColumn("k", F.lit(1.0)), "y", ["k"]).first().f_value is None


def test_vif_of_constant_duplicated_and_category_columns(spark):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"k": F.lit(3.0), "twice": 2 * F.col("a") - 1})
    got = {r[0]: r[1] for r in T.vif(df, ["a", "b", "c", "k", "twice"]).collect()}
    assert got["k"] is None and got["a"] == got["twice"] == float("inf")
    x = design(rows, [0, 1], [2])
    assert got["b"] == pytest.approx(1 / (1 - r_squared(np.delete(x, 2, axis=1), x[:, 2])[0]), rel=1e-6)
    assert got["c=c1"] == pytest.approx(1 / (1 - r_squared(np.delete(x, 3, axis=1), x[:, 3])[0]), rel=1e-6)
    assert [r.vif for r in T.vif(df.limit(0), ["a", "k"]).collect()] == [None, None]


@pytest.mark.parametrize("lam", [0.0, 0.3, 2.0])
def test_ridge_from_moments_is_spark_mls(spark, lam):
    from pyspark.ml.regression import LinearRegression

    # without the offsets, which cost Spark ML's uncentred sums their digits
    df = spark.createDataFrame(mixed_rows(), SCHEMA).withColumns({"y": F.col("y") - 1e6, "a": F.col("a") - 1e4, "b": F.col("b") - 1e4})
    m = linear.moments(df, "y", ["a", "b", "c"], reference="rare")
    got = linear.fit(m, lam / math.sqrt(m.cross[-1, -1] / m.n) * np.diag(m.cross)[:-1])
    data = L.rformula(df, "y ~ a + b + c", "error")
    model = LinearRegression(regParam=lam, solver="normal").fit(data)
    theirs = dict(zip(L.vector_names(data), model.coefficients))
    ours = {c if a is None else f"{c}_{a}": b for (c, a), b in zip(m.slots, got.beta)}
    assert ours.keys() == theirs.keys() and all(ours[k] == pytest.approx(theirs[k], rel=1e-6, abs=1e-7) for k in ours)


def test_kfold_moments_match_refitting_every_fold(spark):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    fold = [r[0] for r in df.select(L.hash_fold(df.columns, 4)).collect()]
    y, x, errors = np.array([r[4] for r in rows]), design(rows, [0, 1], [2]), []
    for g in range(4):
        test = np.array(fold) == g
        beta = np.linalg.lstsq(x[~test], y[~test], rcond=None)[0]
        errors.append(math.sqrt(((y[test] - x[test] @ beta) ** 2).mean()))
    plain = L.kfold_rmse(df, "y ~ a + b + c", folds=4).first().rmse
    assert plain == pytest.approx(sum(errors) / 4, rel=1e-6)
    assert L.kfold_rmse(df.repartition(7), "y ~ a + b + c", folds=4).first().rmse == pytest.approx(plain, rel=1e-9)
    assert L.kfold_rmse(df.select("a", "b", "y"), "y ~ .", folds=4, reg_params=(0.0, 1.0)).count() == 2
    assert L.kfold_rmse(df, "y ~ a + b + a:b", folds=3).first().rmse > 0
    assert L.kfold_rmse(df.limit(0), "y ~ a", folds=3).first().rmse is None


# ---- normality


def test_normal_distribution_function(spark):
    z = [-12.0, -7.08, -7.0, -3.0, -0.5, 0.0, 0.5, 2.0, 8.0]
    got = spark.createDataFrame([(x,) for x in z], "z double").select(F.expr(T.normal_cdf_sql("z"))).collect()
    assert [r[0] for r in got] == pytest.approx([0.5 * math.erfc(-x / math.sqrt(2)) for x in z], rel=1e-7)


def test_lilliefors_p_follows_the_published_table():
    """Critical values of the modified statistic at 15, 10, 5, 2.5 and 1 percent."""
    for n in (20, 100, 10_000, 10**9):
        scale = math.sqrt(n) - 0.01 + 0.85 / math.sqrt(n)
        for k, p in ((0.775, 0.15), (0.819, 0.10), (0.895, 0.05), (0.955, 0.025), (1.035, 0.01)):
            assert T.lilliefors_p(n, k / scale) == pytest.approx(p, rel=0.15)
    assert T.lilliefors_p(50, 0.01) == 1.0 and T.lilliefors_p(1000, 0.5) < 1e-9


@pytest.mark.parametrize("per_cut", [100_000, 20])
def test_ks_normal_is_exact_over_ties_and_slices(spark, monkeypatch, per_cut):
    monkeypatch.setattr(T, "VALUES_PER_CUT", per_cut)
    rng = np.random.default_rng(2)
    x = np.concatenate([np.round(rng.normal(size=300), 2), np.full(200, 0.25), rng.exponential(size=300)])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double").repartition(5)
    got = T.ks_normal(df, "x").first()
    mean, sd, d = x.mean(), x.std(ddof=1), 0.0
    for v in np.unique(x):
        f = 0.5 * math.erfc(-(v - mean) / sd / math.sqrt(2))
        d = max(d, f - (x < v).mean(), (x <= v).mean() - f)
    assert got.n == 800 and got.statistic == pytest.approx(d, abs=1e-12) and got.p_value < 0.01 and not got.normal
    assert T.ks_normal(spark.createDataFrame([(float(v),) for v in rng.normal(5, 3, 500)], "x double"), "x").first().normal


def test_ks_normal_of_constant_empty_and_infinite_columns(spark):
    for rows in ([], [(1.0,)] * 9, [(None,)], [(1.0,), (2.0,), (float("inf"),), (3.0,), (4.0,)]):
        got = T.ks_normal(spark.createDataFrame(rows, "x double"), "x").first()
        assert got.statistic is None and got.p_value is None and got.normal is None


# ---- contingency tables


def test_chi_square_of_all_features_matches_spark_ml(spark):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    df = spark.createDataFrame(mixed_rows(), SCHEMA).withColumn("label", F.when(F.col("y") > 1e6, "hi").otherwise("lo"))
    got = {r.feature: r for r in L.chi_square_test(df, "label", ["c", "d"]).collect()}
    data = StringIndexer(inputCols=["c", "d", "label"], outputCols=["ci", "di", "li"]).fit(df).transform(df)
    want = ChiSquareTest.test(VectorAssembler(inputCols=["ci", "di"], outputCol="f").transform(data), "f", "li").first()
    assert [got[c].statistic for c in "cd"] == pytest.approx(list(want.statistics)) and [got[c].p_value for c in "cd"] == pytest.approx(list(want.pValues))
    assert [got[c].dof for c in "cd"] == list(want.degreesOfFreedom)


def test_chi_square_of_missing_constant_and_hot_categories(spark):
    rows = [("x", "p", "k", None)] * 2000 + [("y", "q", "k", None)] * 2000 + [(None, "p", "k", None), ("x", None, "k", "only")]
    df = spark.createDataFrame(rows, "f string, label string, same string, none string")
    got = {r.feature: r for r in L.chi_square_test(df, "label", ["f", "same", "none"]).collect()}
    assert got["f"].statistic == pytest.approx(4000.0) and got["f"].p_value == 0.0 and got["f"].dependent
    assert got["same"].statistic is None and got["same"].dof == 0 and got["same"].p_value is None and "none" not in got
    more = df.withColumn("g", F.when(F.rand(1) < 0.1, "x").otherwise(F.col("f")))
    assert [(r.feature, r["rank"]) for r in L.chisq_select(more, "label", ["same", "g", "f"], 2).collect()] == [("f", 0), ("g", 1)]
    assert L.chisq_select(df.limit(0), "label", ["f"]).count() == 0
