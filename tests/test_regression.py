import math

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrocar.operators import regression as R
from ferrocar.operators import stats, tails


@pytest.mark.parametrize("t, df, p", [(2.228, 10, 0.05), (1.96, 1e7, 0.05), (12.706, 1, 0.05), (2.626, 100, 0.01), (0.0, 5, 1.0)])
def test_student_table(t, df, p):
    assert tails.student_p(t, df) == pytest.approx(p, abs=2e-4)


@pytest.mark.parametrize("f, d1, d2, p", [(4.965, 1, 10, 0.05), (3.326, 5, 10, 0.05), (2.70, 4, 50, 0.0411)])
def test_f_table(f, d1, d2, p):
    assert tails.f_upper(f, d1, d2) == pytest.approx(p, abs=3e-4)


def test_student_quantile():
    assert tails.student_quantile(0.975, 10) == pytest.approx(2.228139, abs=1e-6)


@given(st.floats(0.05, 60), st.floats(0.05, 60), st.floats(0.001, 0.999))
def test_incomplete_beta_reflects(a, b, x):
    assert tails.incomplete_beta(a, b, x) + tails.incomplete_beta(b, a, 1 - x) == pytest.approx(1.0, abs=1e-9)


# Published fits: n, R2, regressors, log-likelihood -> adjusted R2, AIC, BIC.
@pytest.mark.parametrize(
    "n, r2, k, ll, adj, aic, bic",
    [(1789, 0.617, 13, -1161.8, 0.614, 2352, 2428), (1210, 0.633, 7, -820.60, 0.630, 1657, 1698)],
)
def test_published_identities(n, r2, k, ll, adj, aic, bic):
    assert R.adjusted_r2(r2, n, k) == pytest.approx(adj, abs=1e-3)
    assert R.aic(ll, k) == pytest.approx(aic, abs=1)
    assert R.bic(ll, k, n) == pytest.approx(bic, abs=1)


def test_published_diagnostics(spark):
    # n, skew, kurtosis -> Jarque-Bera, Omnibus as published (inputs rounded to three digits).
    rows = [(1789, 1.121, 12.077, 6516.901, 558.903), (1210, 1.265, 11.769, 4198.901, 410.493)]
    df = spark.createDataFrame(rows, "n long, s double, k double, jb double, om double")
    n, s, k = F.col("n"), F.col("s"), F.col("k")
    for r in df.select("jb", "om", R.jarque_bera(n, s, k).alias("a"), R.omnibus(n, s, k).alias("b")).collect():
        assert r["a"] == pytest.approx(r["jb"], rel=2e-3) and r["b"] == pytest.approx(r["om"], rel=2e-3)


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(11)
    quote = {m: float(rng.normal(100, 9)) for m in range(24)}
    rows = []
    for i in range(1500):
        seg, m = ["Petrol", "Diesel", "Electric"][i % 3], int(rng.integers(0, 24))
        km, hp = float(rng.integers(0, 200_000)), float(rng.integers(60, 400))
        y = 9 - 5e-6 * km + 0.003 * hp + 0.1 * (seg == "Diesel") + 0.01 * quote[m] + rng.normal(0, 0.3)
        rows.append((i, seg, m, km if i % 50 else None, hp, y, quote[m]))
    return spark.createDataFrame(rows, "id int, seg string, month int, km double, hp double, y double, q double"), rows


def fitted(spark, df, split=None):
    cells = R.moment_cells(df, ["seg", "month"], ["km", "hp", "y"])
    cells = cells.join(df.select("month", "q").distinct(), "month")
    scored = R.standardise(cells, ["q"], [split] if split else [])
    terms = [R.Term("km", "km"), R.Term("hp", "hp"), R.Term("q", value=F.col("z_q"))]
    if split is None:
        terms.append(R.Term("Diesel", value=(F.col("seg") == "Diesel").cast("double")))
    design = R.Design("y", tuple(terms), split)
    return scored, design, R.solve(scored, design)


def arrays(rows, segment=None):
    mine = [r for r in rows if segment is None or r[1] == segment]
    q = np.array([r[6] for r in mine])
    z = (q - q.mean()) / q.std(ddof=1)
    keep = [i for i, r in enumerate(mine) if r[3] is not None]
    columns = [[1.0, mine[i][3], mine[i][4], z[i]] + ([float(mine[i][1] == "Diesel")] if segment is None else []) for i in keep]
    return np.array(columns), np.array([mine[i][5] for i in keep])


@pytest.mark.parametrize("segment", [None, "Electric"])
def test_fit_equals_dense_least_squares(spark, sample, segment):
    df, rows = sample
    _, _, solutions = fitted(spark, df, "seg" if segment else None)
    s = next(x for x in solutions if x.segment == (segment or "pooled"))
    x, y = arrays(rows, segment)
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    e = y - x @ beta
    cov = e @ e / (len(y) - x.shape[1]) * np.linalg.inv(x.T @ x)
    assert s.n == len(y)
    assert s.coef == pytest.approx(beta, rel=1e-7)
    assert s.std_err == pytest.approx(np.sqrt(np.diag(cov)), rel=1e-6)
    assert s.cond_no == pytest.approx(np.linalg.cond(x), rel=1e-4)


def test_agrees_with_library_solver(spark, sample):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    df, _ = sample
    _, _, solutions = fitted(spark, df)
    m, sd = df.agg(F.avg("q"), F.stddev_samp("q")).first()
    wide = df.dropna().withColumns({"z": (F.col("q") - m) / sd, "d": (F.col("seg") == "Diesel").cast("double")})
    data = VectorAssembler(inputCols=["km", "hp", "z", "d"], outputCol="features").transform(wide)
    model = LinearRegression(labelCol="y", solver="normal", regParam=0.0).fit(data)
    table = {r["term"]: r for r in R.coefficient_table(spark, solutions).collect()}
    for name, b, se, p in zip(["km", "hp", "q", "Diesel"], model.coefficients, model.summary.coefficientStandardErrors, model.summary.pValues):
        assert table[name]["coef"] == pytest.approx(b, rel=1e-6)
        assert table[name]["std_err"] == pytest.approx(se, rel=1e-6)
        assert table[name]["p"] == pytest.approx(p, abs=1e-8)


def test_diagnostics_against_numpy(spark, sample):
    df, rows = sample
    scored, design, solutions = fitted(spark, df)
    predictions = R.cell_predictions(scored, design, solutions, ["seg", "month"])
    resid = R.residuals(df, predictions.withColumnRenamed("segment", "segment"), design, ["seg", "month"])
    x, y = arrays(rows)
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    e = y - x @ beta
    got = R.diagnostics(resid, ["id"]).first()
    assert got["durbin_watson"] == pytest.approx((np.diff(e) ** 2).sum() / (e**2).sum(), rel=1e-9)
    d = e - e.mean()
    assert got["skew"] == pytest.approx((d**3).mean() / (d**2).mean() ** 1.5, rel=1e-8)
    assert got["p_jarque_bera"] == pytest.approx(math.exp(-got["jarque_bera"] / 2))


def test_durbin_watson_with_one_hot_leading_key(spark):
    rng = np.random.default_rng(2)
    e = rng.normal(size=3000)
    rows = [("s", 1 if i < 2500 else i, i, float(v)) for i, v in enumerate(e)]
    df = spark.createDataFrame(rows, "segment string, a int, b int, resid double").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = R.durbin_watson(df, ["a", "b"]).first()["durbin_watson"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == pytest.approx((np.diff(e) ** 2).sum() / (e**2).sum(), rel=1e-9)


def test_small_and_constant_pairs(spark):
    rows = [("two", 1.0, 2.0), ("two", 2.0, 3.0), ("flat", 1.0, 2.0), ("flat", 1.0, 3.0), ("flat", 1.0, 5.0)]
    rows += [("gap", 1.0, None), ("gap", 2.0, 4.0), ("gap", 3.0, 6.0), ("gap", 4.0, 7.0)]
    got = {r["k"]: r for r in stats.correlate(spark.createDataFrame(rows, "k string, x double, y double"), ["k"], "x", "y").collect()}
    assert got["two"]["r"] is None and got["two"]["n"] == 2 and got["two"]["p"] is None
    assert got["flat"]["r"] is None and got["gap"]["n"] == 3
    assert got["gap"]["r"] == pytest.approx(np.corrcoef([2, 3, 4], [4, 6, 7])[0, 1])


def test_cell_correlation_equals_row_correlation(spark):
    rng = np.random.default_rng(4)
    rows = [(int(m), float(rng.normal()), float(m * m)) for m in rng.integers(0, 9, 400)]
    df = spark.createDataFrame(rows, "m int, y double, x double")
    cells = df.groupBy("m", "x").agg(F.count("y").alias("n_rows"), F.avg("y").alias("mu"), F.var_pop("y").alias("v")).withColumn("k", F.lit(1))
    got = stats.weighted_pearson(cells, ["k"], "n_rows", "mu", "v", "x").first()
    assert got["r"] == pytest.approx(np.corrcoef([r[1] for r in rows], [r[2] for r in rows])[0, 1]) and got["n"] == 400


def test_short_constant_and_dependent_segments(spark, sample):
    _, rows = sample
    kept = [r for r in rows if r[1] == "Petrol"] + [r for r in rows if r[1] == "Electric" and r[3] is not None][:3]
    kept += [(*r[:1], "Flat", *r[2:5], 7.0, r[6]) for r in rows if r[1] == "Diesel"]
    kept += [(*r[:1], "Same", *r[2:4], 100.0, *r[5:]) for r in rows if r[1] == "Diesel"]
    df = spark.createDataFrame(kept, "id int, seg string, month int, km double, hp double, y double, q double")
    _, _, solutions = fitted(spark, df, "seg")
    fits = {r.segment: r for r in R.fit_table(spark, solutions).collect()}
    assert fits["Electric"].n == 3 and fits["Electric"].r2 is None and fits["Electric"].df_resid is None
    assert fits["Flat"].n > 400 and fits["Flat"].r2 is None and fits["Flat"].f is None
    # A column that does not vary is no parameter.
    assert fits["Same"].df_model == 2 and fits["Same"].df_resid == fits["Same"].n - 3 and fits["Same"].r2 > 0
    assert fits["Petrol"].df_model == 3
    table = [r for r in R.coefficient_table(spark, solutions).collect() if r.segment == "Electric"]
    assert len(table) == 4 and all(r.coef is None and r.p is None for r in table)
