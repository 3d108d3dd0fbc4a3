"""Regressions: coefficients, fit, diagnostics, tests."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrocar.operators import regression
from ferrocar.plans import power_mode
from ferrocar.session import stage
from workload import proxies as P
from workload.helpers import r6, r6_sql, t_tail_sql
from workload.panels import PREPARED_SQL, monthly, observed
from workload.registry import query

KEY = ", ".join(P.KEY)


def sig7(c: str) -> Column:
    """Seven significant digits as text: coefficients differ by orders of magnitude."""
    return F.when(F.col(c).isNotNull(), F.format_string("%.6e", c)).alias(c)


def sig7_sql(expr: str, name: str) -> str:
    return f"printf('%.6e', {expr}) AS {name}"


# --- SQL: normal equations by Gauss-Jordan elimination on the correlation matrix --------------


def _ols_sql(design: str, k: int) -> str:
    """CTEs from a design relation ``(seg, keys, y, x1..xk)`` to ``fits`` and ``terms``."""
    xs = [f"x{i}" for i in range(1, k + 1)]
    cov = ", ".join("[" + ", ".join(f"covar_pop({a}, {b})" for b in xs) + "]" for a in xs)
    each = f"range(1, {k + 1})"
    return f"""{design},
moments AS (SELECT seg, count(*) AS n, avg(y) AS my, var_pop(y) AS vy, [{', '.join(f'avg({x})' for x in xs)}] AS mx,
  [{', '.join(f'stddev_pop({x})' for x in xs)}] AS sx, [{', '.join(f'covar_pop({x}, y)' for x in xs)}] AS cy, [{cov}] AS cx
  FROM design GROUP BY seg),
start AS (SELECT *, list_transform({each}, lambda r: list_concat(
    list_transform({each}, lambda c: cx[r][c] / (sx[r] * sx[c])), [cy[r] / sx[r]],
    list_transform({each}, lambda c: CASE WHEN r = c THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END))) AS m FROM moments),
elim AS (
  SELECT seg, 0 AS i, m FROM start
  UNION ALL
  SELECT seg, i + 1, list_transform({each}, lambda r: list_transform(range(1, {2 * k + 2}), lambda c:
    CASE WHEN r = i + 1 THEN m[r][c] / m[r][r] ELSE m[r][c] - m[r][i + 1] * m[i + 1][c] / m[i + 1][i + 1] END))
  FROM elim WHERE i < {k}),
fits AS (SELECT s.seg, n, my, vy, mx, sx, cy, list_transform({each}, lambda r: e.m[r][{k + 1}] / sx[r]) AS b,
    list_transform({each}, lambda r: list_transform({each}, lambda c: e.m[r][{k + 1} + c] / (sx[r] * sx[c] * n))) AS inv
  FROM start s JOIN elim e ON e.seg = s.seg AND e.i = {k}),
errors AS (SELECT *, n * (vy - list_sum(list_transform({each}, lambda r: b[r] * cy[r]))) AS sse, n * vy AS sst, n - {k} - 1 AS df FROM fits),
terms AS (
  SELECT seg, 0 AS j, df, my - list_sum(list_transform({each}, lambda r: b[r] * mx[r])) AS coef,
    sqrt(sse / df * (1.0::DOUBLE / n + list_sum(list_transform({each}, lambda r: list_sum(list_transform({each}, lambda c: mx[r] * mx[c] * inv[r][c])))))) AS se
  FROM errors
  UNION ALL
  SELECT seg, j, df, b[j] AS coef, sqrt(sse / df * inv[j][j]) AS se FROM errors, (SELECT unnest({each}) AS j))"""


# The 97.5 % quantile of Student's t around the normal one, for large degrees of freedom.
_Z = "1.959963984540054::DOUBLE"
_T975 = (
    f"({_Z} + (pow({_Z}, 3) + {_Z}) / (4.0 * df) + (5 * pow({_Z}, 5) + 16 * pow({_Z}, 3) + 3 * {_Z}) / (96.0 * df * df)"
    f" + (3 * pow({_Z}, 7) + 19 * pow({_Z}, 5) + 17 * pow({_Z}, 3) - 15 * {_Z}) / (384.0 * df * df * df))"
)


def _terms_sql(names: list[str]) -> str:
    labels = "[" + ", ".join(f"'{n}'" for n in names) + "]"
    return f"""SELECT seg AS segment, ({labels})[j + 1] AS term, {sig7_sql('coef', 'coef')}, {sig7_sql('se', 'std_err')},
  {sig7_sql('coef / se', 't')}, {r6_sql(t_tail_sql('(coef / se)', 'df'), 'p')}, {sig7_sql(f'coef - {_T975} * se', 'low')}, {sig7_sql(f'coef + {_T975} * se', 'high')}
FROM terms"""


_FIT_SQL = f"""SELECT seg AS segment, n, CAST(len(b) AS BIGINT) AS df_model, df AS df_resid, {r6_sql('1 - sse / sst', 'r2')},
  {r6_sql('1 - (sse / sst) * (n - 1) / df', 'adj_r2')}, {sig7_sql('(sst - sse) / len(b) / (sse / df)', 'f')},
  {sig7_sql('-n / 2.0::DOUBLE * (ln(2 * pi() * sse / n) + 1)', 'log_likelihood')},
  {sig7_sql('n * (ln(2 * pi() * sse / n) + 1) + 2 * (len(b) + 1)', 'aic')}, {sig7_sql('n * (ln(2 * pi() * sse / n) + 1) + ln(n) * (len(b) + 1)', 'bic')}
FROM errors"""


def _diagnostics_sql(k: int) -> str:
    fitted = " + ".join(f"x{i} * f.b[{i}]" for i in range(1, k + 1))
    return f""", resid AS (SELECT d.seg, {KEY}, y - t.coef - ({fitted}) AS e FROM design d JOIN fits f ON f.seg = d.seg
  JOIN terms t ON t.seg = d.seg AND t.j = 0),
steps AS (SELECT seg, e, e - lag(e) OVER (PARTITION BY seg ORDER BY {KEY}, e) AS s FROM resid),
shape AS (SELECT seg, CAST(count(*) AS DOUBLE) AS n, avg(e) AS mu FROM steps GROUP BY 1),
powers AS (SELECT s.seg, n, sum(s.s * s.s) / sum(e * e) AS dw, avg(pow(e - mu, 2)) AS m2, avg(pow(e - mu, 3)) AS m3, avg(pow(e - mu, 4)) AS m4
  FROM steps s JOIN shape USING (seg) GROUP BY 1, 2),
sk AS (SELECT seg, n, dw, m3 / pow(m2, 1.5) AS skew, m4 / (m2 * m2) AS kurt FROM powers),
omni1 AS (SELECT *, skew * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
  3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta2,
  (kurt - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
  6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb1 FROM sk),
omni2 AS (SELECT *, sqrt(2 * (beta2 - 1)) - 1 AS w2, 6 + 8 / sb1 * (2 / sb1 + sqrt(1 + 4 / (sb1 * sb1))) AS a FROM omni1),
omni3 AS (SELECT *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(ln(w2) / 2) AS z1,
  (1 - 2 / (9 * a) - cbrt((1 - 2 / a) / (1 + x * sqrt(2 / (a - 4))))) / sqrt(2 / (9 * a)) AS z2,
  n / 6 * (skew * skew + (kurt - 3) * (kurt - 3) / 4) AS jb FROM omni2)
SELECT seg AS segment, CAST(n AS BIGINT) AS n, {r6_sql('skew', 'skew')}, {r6_sql('kurt', 'kurtosis')}, {sig7_sql('jb', 'jarque_bera')},
  {r6_sql('exp(-jb / 2)', 'p_jarque_bera')}, {sig7_sql('z1 * z1 + z2 * z2', 'omnibus')}, {r6_sql('exp(-(z1 * z1 + z2 * z2) / 2)', 'p_omnibus')},
  {r6_sql('dw', 'durbin_watson')} FROM omni3"""


def _z_sql(role: str, over: str) -> str:
    q = f'"{P.ROLES[role]}"'
    return f"({q} - avg({q}) OVER ({over})) / stddev_samp({q}) OVER ({over}) AS z_{role.lower()}"


POOLED_NAMES = [
    "Intercept", "mileage", "engine_power_hp", *power_mode.POOLED_ROLES, "Diesel", "Electric",
    *[f"{mode}:{name}" for mode, name in power_mode.INTERACTIONS],
]
SEGMENT_NAMES = ["Intercept", "mileage", "engine_power_hp", *power_mode.SEGMENT_ROLES]

POOLED_SQL = "WITH RECURSIVE " + _ols_sql(
    f"""{PREPARED_SQL},
scored AS (SELECT *, {', '.join(_z_sql(r, '') for r in power_mode.POOLED_ROLES)},
  CAST(power_mode = 'Diesel' AS DOUBLE) AS dd, CAST(power_mode = 'Electric' AS DOUBLE) AS de FROM observed),
design AS (SELECT 'pooled' AS seg, {KEY}, log_price AS y, mileage AS x1, engine_power_hp AS x2, z_lithium AS x3, z_copper AS x4, z_wti AS x5,
  z_steel AS x6, dd AS x7, de AS x8, de * z_lithium AS x9, de * z_copper AS x10, de * z_wti AS x11, dd * z_wti AS x12, dd * z_steel AS x13
  FROM scored WHERE log_price IS NOT NULL AND mileage IS NOT NULL AND engine_power_hp IS NOT NULL AND power_mode IS NOT NULL
    AND z_lithium IS NOT NULL AND z_copper IS NOT NULL AND z_wti IS NOT NULL AND z_steel IS NOT NULL)""",
    13,
)
SEGMENT_SQL = "WITH RECURSIVE " + _ols_sql(
    f"""{PREPARED_SQL},
scored AS (SELECT *, {', '.join(_z_sql(r, 'PARTITION BY power_mode') for r in power_mode.SEGMENT_ROLES)} FROM observed WHERE power_mode IS NOT NULL),
design AS (SELECT power_mode AS seg, {KEY}, log_price AS y, mileage AS x1, engine_power_hp AS x2, z_lithium AS x3, z_copper AS x4, z_nickel AS x5,
  z_wti AS x6, z_steel AS x7
  FROM scored WHERE log_price IS NOT NULL AND mileage IS NOT NULL AND engine_power_hp IS NOT NULL
    AND z_lithium IS NOT NULL AND z_copper IS NOT NULL AND z_nickel IS NOT NULL AND z_wti IS NOT NULL AND z_steel IS NOT NULL)""",
    7,
)


# --- Spark --------------------------------------------------------------------------------


def _cells(spark, d) -> DataFrame:
    """Staged: one row per power mode and month, read by the z-scores, the fit and the residuals."""
    return stage(power_mode.regression_cells(observed(spark, d), monthly(spark, d)), "regression-cells")


def _coefficients(spark, solutions) -> DataFrame:
    out = regression.coefficient_table(spark, solutions)
    return out.select("segment", "term", sig7("coef"), sig7("std_err"), sig7("t"), r6("p", "p"), sig7("low"), sig7("high"))


def _fit(spark, solutions) -> DataFrame:
    out = regression.fit_table(spark, solutions)
    return out.select(
        "segment", "n", "df_model", "df_resid", r6("r2", "r2"), r6("adj_r2", "adj_r2"), sig7("f"),
        sig7("log_likelihood"), sig7("aic"), sig7("bic"),
    )


def _diagnostics(spark, d, fitted) -> DataFrame:
    scored, design, solutions = fitted
    predictions = regression.cell_predictions(scored, design, solutions, ["power_mode", "month"])
    rows = power_mode.by_observation_month(observed(spark, d))
    resid = regression.residuals(rows, predictions, design, ["power_mode", "month"])
    out = regression.diagnostics(resid, P.KEY)
    return out.select(
        "segment", "n", r6("skew", "skew"), r6("kurtosis", "kurtosis"), sig7("jarque_bera"), r6("p_jarque_bera", "p_jarque_bera"),
        sig7("omnibus"), r6("p_omnibus", "p_omnibus"), r6("durbin_watson", "durbin_watson"),
    )


def pooled(spark, d):
    return power_mode.pooled_fit(_cells(spark, d), P.ROLES)


def segments(spark, d):
    return power_mode.segment_fits(_cells(spark, d), P.ROLES)


@query("s6_s8_pooled_coefficients", f"{POOLED_SQL} {_terms_sql(POOLED_NAMES)}")
def pooled_coefficients(spark, d):
    return _coefficients(spark, pooled(spark, d)[2])


@query("s7_s8_segment_coefficients", f"{SEGMENT_SQL} {_terms_sql(SEGMENT_NAMES)}")
def segment_coefficients(spark, d):
    return _coefficients(spark, segments(spark, d)[2])


@query("s9_pooled_fit", f"{POOLED_SQL} {_FIT_SQL}")
def pooled_fit(spark, d):
    return _fit(spark, pooled(spark, d)[2])


@query("s9_segment_fit", f"{SEGMENT_SQL} {_FIT_SQL}")
def segment_fit(spark, d):
    return _fit(spark, segments(spark, d)[2])


@query("s10_w10_pooled_diagnostics", f"{POOLED_SQL} {_diagnostics_sql(13)}")
def pooled_diagnostics(spark, d):
    return _diagnostics(spark, d, pooled(spark, d))


@query("s10_w10_segment_diagnostics", f"{SEGMENT_SQL} {_diagnostics_sql(7)}")
def segment_diagnostics(spark, d):
    return _diagnostics(spark, d, segments(spark, d))


_TESTED = {name: POOLED_NAMES.index(name) for name in power_mode.TESTS}
_CASES = " ".join(f"WHEN {j} THEN '{power_mode.TESTS[n]}'" for n, j in _TESTED.items())
_TERMS = " ".join(f"WHEN {j} THEN '{n}'" for n, j in _TESTED.items())
_P = t_tail_sql("(coef / se)", "df")


@query(
    "s11_hypothesis_tests",
    f"""{POOLED_SQL}
SELECT CASE j {_CASES} END AS test, CASE j {_TERMS} END AS term, {sig7_sql('coef', 'coef')}, {r6_sql(_P, 'p')},
  CASE WHEN {_P} < 0.05 THEN 'significant' ELSE 'not significant' END AS result
FROM terms WHERE j IN ({', '.join(map(str, _TESTED.values()))})""",
)
def hypothesis_tests(spark, d):
    table = regression.coefficient_table(spark, pooled(spark, d)[2])
    out = regression.hypothesis_tests(table, power_mode.TESTS)
    return out.select("test", "term", sig7("coef"), r6("p", "p"), "result")


@query(
    "m2_standardised_quotes",
    f"""WITH {PREPARED_SQL},
scored AS (SELECT power_mode, observation_month, {', '.join(_z_sql(r, 'PARTITION BY power_mode') for r in power_mode.SEGMENT_ROLES)} FROM observed)
SELECT DISTINCT power_mode, strftime(observation_month, '%Y-%m') AS month, {', '.join(r6_sql(f'z_{r.lower()}', f'z_{r.lower()}') for r in power_mode.SEGMENT_ROLES)} FROM scored""",
)
def standardised_quotes(spark, d):
    used = {r: P.ROLES[r] for r in power_mode.SEGMENT_ROLES}
    cells = power_mode.regression_cells(observed(spark, d), monthly(spark, d))
    scored = regression.standardise(cells, list(used.values()), ["power_mode"])
    return scored.select(
        "power_mode", F.date_format("month", "yyyy-MM").alias("month"),
        *[r6(f"`z_{i}`", f"z_{r.lower()}") for r, i in used.items()],
    )
