"""Least squares for listings, from distributed sufficient statistics.

A design mixes columns that vary by listing (mileage, power) with columns that are fixed by
segment and month (quotes, segment dummies, their products). Listings are therefore reduced in
one pass to cells per (segment, month) holding counts, means and central moments. Everything
else (z-scores, cross-products, fits, correlations) is worked out on the cells, of which there
are segments x months. Central moments keep the sums well conditioned.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrocar.operators import tails
from ferrocar.session import stage

COEFFICIENTS = T.StructType(
    [T.StructField("segment", T.StringType()), T.StructField("term", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in ("coef", "std_err", "t", "p", "low", "high")]
)

FIT = T.StructType(
    [T.StructField("segment", T.StringType()), T.StructField("n", T.LongType())]
    + [T.StructField("df_model", T.LongType()), T.StructField("df_resid", T.LongType())]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("r2", "adj_r2", "f", "p_f", "log_likelihood", "aic", "bic", "cond_no")
    ]
)

DIAGNOSTICS = T.StructType(
    [T.StructField("segment", T.StringType()), T.StructField("n", T.LongType())]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("skew", "kurtosis", "jarque_bera", "p_jarque_bera", "omnibus", "p_omnibus", "durbin_watson")
    ]
)


@dataclass(frozen=True)
class Term:
    """A regressor: a listing column, or a cell-level expression."""

    name: str
    column: str | None = None
    value: Column | None = field(default=None, compare=False)


@dataclass(frozen=True)
class Design:
    """Response, regressors, and the segment split (``None`` for one pooled fit)."""

    response: str
    terms: tuple[Term, ...]
    split: str | None = None

    @property
    def row_columns(self) -> list[str]:
        return [t.column for t in self.terms if t.column is not None]


def moment_cells(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Count, means and population (co)variances of complete rows per cell, and all rows.

    ``rows_all`` counts every row of the cell, which the z-scores of the quotes refer to;
    ``n`` and the moments count rows in which all of ``columns`` are present.
    """
    complete = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    aggs = ["count(1) AS rows_all", f"count_if({complete}) AS n"]
    for i, a in enumerate(columns):
        aggs.append(f"avg({a}) FILTER (WHERE {complete}) AS m_{a}")
        aggs += [f"covar_pop({a}, {b}) FILTER (WHERE {complete}) AS v_{a}_{b}" for b in columns[i:]]
    return rows.groupBy(*keys).agg(*[F.expr(e) for e in aggs])


def standardise(cells: DataFrame, instruments: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """z-scores of the quotes, weighted by the rows of each cell; ``z_<instrument>`` columns.

    The windows run over cells, whose number is bounded by segments and calendar months.
    """
    scope = f"OVER (PARTITION BY {', '.join(within) or '0'})"
    weight = {i: f"CASE WHEN `{i}` IS NOT NULL THEN rows_all END" for i in instruments}
    means = cells.selectExpr(
        "*",
        *[f"sum({w}) {scope} AS `_w_{i}`" for i, w in weight.items()],
        *[f"try_divide(sum({w} * `{i}`) {scope}, sum({w}) {scope}) AS `_m_{i}`" for i, w in weight.items()],
    )
    spreads = means.selectExpr(
        "*",
        *[
            f"sqrt(try_divide(sum({w} * (`{i}` - `_m_{i}`) * (`{i}` - `_m_{i}`)) {scope}, `_w_{i}` - 1)) AS `_s_{i}`"
            for i, w in weight.items()
        ],
    )
    scores = [f"try_divide(`{i}` - `_m_{i}`, `_s_{i}`) AS `z_{i}`" for i in instruments]
    return spreads.selectExpr(*[f"`{c}`" for c in cells.columns], *scores)


def _design_cells(cells: DataFrame, design: Design) -> DataFrame:
    """Cell means of every design column (``x0..xk``, the response last) for usable cells."""
    columns: list[Column] = []
    for t in design.terms:
        columns.append(F.col(f"m_{t.column}") if t.column else t.value.cast("double"))
    columns.append(F.col(f"m_{design.response}"))
    segment = F.col(design.split) if design.split else F.lit("pooled")
    vary = {t.column: i for i, t in enumerate(design.terms) if t.column}
    vary[design.response] = len(design.terms)
    moments = [
        F.col(_moment_name(cells, a, b)).alias(f"w_{i}_{j}")
        for a, i in vary.items()
        for b, j in vary.items()
        if i <= j
    ]
    shaped = cells.where(F.col("n") > 0).select(
        segment.alias("segment"), "n", *[c.alias(f"x{i}") for i, c in enumerate(columns)], *moments
    )
    return shaped.dropna(subset=["segment", *[f"x{i}" for i in range(len(columns))]])


def _moment_name(cells: DataFrame, a: str, b: str) -> str:
    return f"v_{a}_{b}" if f"v_{a}_{b}" in cells.columns else f"v_{b}_{a}"


def cross_products(cells: DataFrame, design: Design) -> DataFrame:
    """Count, means and the centred cross-product matrix (flattened) per segment."""
    size = len(design.terms) + 1
    shaped = _design_cells(cells, design)
    scope = "OVER (PARTITION BY segment)"
    centred = shaped.selectExpr(
        "*", *[f"try_divide(sum(n * x{i}) {scope}, sum(n) {scope}) AS mu{i}" for i in range(size)]
    )
    products = []
    for i in range(size):
        for j in range(i, size):
            inner = f" + w_{i}_{j}" if f"w_{i}_{j}" in shaped.columns else ""
            products.append(f"sum(n * ((x{i} - mu{i}) * (x{j} - mu{j}){inner}))")
    means = ", ".join(f"max(mu{i})" for i in range(size))
    return centred.groupBy("segment").agg(
        F.sum("n").alias("n"),
        F.expr(f"array({means}) AS means"),
        F.expr(f"array({', '.join(products)}) AS products"),
    )


@dataclass
class Solution:
    segment: str
    n: int
    names: list[str]
    coef: np.ndarray
    std_err: np.ndarray
    sse: float
    sst: float
    cond_no: float
    rank: int

    @property
    def df_resid(self) -> int:
        """Rows beyond the terms that can be told apart, the intercept included."""
        return self.n - self.rank - 1

    @property
    def fitted(self) -> bool:
        """Whether the segment has enough rows for the design; if not, it has its count alone."""
        return self.n > len(self.coef)


def _solve(segment: str, n: int, means, products, names: list[str]) -> Solution:
    size = len(means)
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = products
    full = full + np.triu(full, 1).T
    mu = np.asarray(means)
    k = size - 1
    scale = np.sqrt(np.diag(full)[:k])
    if np.any(scale == 0):
        # A column that is constant within the segment is not separable from the intercept.
        scale = np.where(scale == 0, 1.0, scale)
    unit = full[:k, :k] / np.outer(scale, scale)
    inverse = np.linalg.pinv(unit, hermitian=True) / np.outer(scale, scale)
    rank = int(np.linalg.matrix_rank(unit, hermitian=True)) if k else 0
    slopes = inverse @ full[:k, k]
    intercept = mu[k] - mu[:k] @ slopes
    sst = full[k, k]
    sse = sst - slopes @ full[:k, k]
    sigma2 = sse / (n - rank - 1) if n > rank + 1 else float("nan")
    variance = np.concatenate([[1.0 / n + mu[:k] @ inverse @ mu[:k]], np.diag(inverse)]) * sigma2
    raw = np.empty((size, size))
    raw[0, 0] = n
    raw[0, 1:] = raw[1:, 0] = n * mu[:k]
    raw[1:, 1:] = full[:k, :k] + n * np.outer(mu[:k], mu[:k])
    eigen = np.linalg.eigvalsh(raw)
    cond = float(np.sqrt(eigen[-1] / eigen[0])) if eigen[0] > 0 else float("inf")
    coef = np.concatenate([[intercept], slopes])
    return Solution(segment, n, ["Intercept", *names], coef, np.sqrt(variance), float(sse), float(sst), cond, rank)


def solve(cells: DataFrame, design: Design) -> list[Solution]:
    """Fit each segment. Only its cross-product matrix (one row) reaches the driver.

    A segment with too few rows for the design is kept with its count and without a fit.
    """
    names = [t.name for t in design.terms]
    rows = cross_products(cells, design).orderBy("segment").collect()
    return [_solve(r["segment"], r["n"], r["means"], r["products"], names) for r in rows]


def _clean(x: float) -> float | None:
    return None if x is None or np.isnan(x) else float(x)


def coefficient_table(spark: SparkSession, solutions: Sequence[Solution], level: float = 0.95) -> DataFrame:
    """Coefficient, standard error, t, p and confidence interval per term."""
    rows = []
    for s in solutions:
        if not s.fitted:
            rows += [(s.segment, name, *[None] * 6) for name in s.names]
            continue
        wide = tails.student_quantile(0.5 + level / 2.0, s.df_resid)
        for name, b, se in zip(s.names, s.coef, s.std_err):
            t = b / se if se > 0 else float("nan")
            p = tails.student_p(t, s.df_resid) if se > 0 else float("nan")
            rows.append((s.segment, name, *map(_clean, (b, se, t, p, b - wide * se, b + wide * se))))
    return spark.createDataFrame(rows, COEFFICIENTS)


def fit_table(spark: SparkSession, solutions: Sequence[Solution]) -> DataFrame:
    """Fit statistics per segment."""
    rows = []
    for s in solutions:
        if not s.fitted:
            rows.append((s.segment, s.n, None, None, *[None] * 8))
            continue
        k, r2, f, p, ll = s.rank, None, None, None, None
        # A constant response has nothing to explain; a perfect fit leaves nothing to test.
        if s.sst > 0:
            r2 = 1.0 - s.sse / s.sst
        if s.sst > 0 and s.sse > 0:
            ll = -s.n / 2.0 * (np.log(2.0 * np.pi * s.sse / s.n) + 1.0)
        if s.sst > 0 and s.sse > 0 and k:
            f = (s.sst - s.sse) / k / (s.sse / s.df_resid)
            p = tails.f_upper(f, k, s.df_resid)
        adjusted = None if r2 is None else adjusted_r2(r2, s.n, k)
        criteria = (None, None) if ll is None else (aic(ll, k), bic(ll, k, s.n))
        values = (r2, adjusted, f, p, ll, *criteria, s.cond_no)
        rows.append((s.segment, s.n, k, s.df_resid, *(None if v is None else float(v) for v in values)))
    return spark.createDataFrame(rows, FIT)


def adjusted_r2(r2: float, n: int, k: int) -> float:
    return 1.0 - (1.0 - r2) * (n - 1) / (n - k - 1)


def aic(log_likelihood: float, k: int) -> float:
    return -2.0 * log_likelihood + 2.0 * (k + 1)


def bic(log_likelihood: float, k: int, n: int) -> float:
    return -2.0 * log_likelihood + (k + 1) * float(np.log(n))


def cell_predictions(cells: DataFrame, design: Design, solutions: Sequence[Solution], keys: Sequence[str]) -> DataFrame:
    """The part of each prediction that is fixed by the cell, and the listing-level slopes.

    One row per (segment, month): a listing's prediction is ``fixed`` plus its own columns
    times ``slopes``.
    """
    solutions = [s for s in solutions if s.fitted]
    segment = F.col(design.split) if design.split else F.lit("pooled")
    fixed, slopes = F.lit(None).cast("double"), F.lit(None).cast("array<double>")
    for s in solutions:
        part = F.lit(float(s.coef[0]))
        own = []
        for t, b in zip(design.terms, s.coef[1:]):
            if t.column:
                own.append(F.lit(float(b)))
            else:
                part = part + F.lit(float(b)) * t.value.cast("double")
        mine = segment == s.segment
        fixed = F.when(mine, part).otherwise(fixed)
        slopes = F.when(mine, F.array(*own)).otherwise(slopes)
    return cells.select(*keys, segment.alias("segment"), fixed.alias("fixed"), slopes.alias("slopes"))


def residuals(rows: DataFrame, predictions: DataFrame, design: Design, keys: Sequence[str]) -> DataFrame:
    """Complete rows with ``segment`` and ``resid``.

    The predictions have one row per segment and calendar month.
    """
    joined = rows.join(predictions, list(keys))
    fitted = F.col("fixed")
    for i, c in enumerate(design.row_columns):
        fitted = fitted + F.col("slopes")[i] * F.col(c)
    out = joined.withColumn("resid", F.col(design.response) - fitted)
    return out.where(F.col("resid").isNotNull()).drop("fixed", "slopes")


def durbin_watson(resid: DataFrame, order: Sequence[str]) -> DataFrame:
    """Sum of squared successive differences over the sum of squares, per segment.

    The order is global within a segment, so rows are range-partitioned by segment and the
    full ordering key: no partition depends on how often a leading key occurs. Differences
    inside a partition come from a window over it, and the step between neighbouring
    partitions from their first and last rows, of which there is one pair per partition.
    Rows with equal keys are ordered by their residual, so the result does not vary.
    """
    placed = (
        resid.select("segment", "resid", F.struct(*order, F.col("resid").alias("_tie")).alias("_key"))
        .repartitionByRange("segment", "_key")
        .withColumn("_part", F.spark_partition_id())
    )
    inside = W.partitionBy("segment", "_part").orderBy("_key")
    step = F.col("resid") - F.lag("resid").over(inside)
    parts = (
        placed.withColumn("_step", step)
        .groupBy("segment", "_part")
        .agg(
            F.sum(F.col("resid") * F.col("resid")).alias("_ss"),
            F.coalesce(F.sum(F.col("_step") * F.col("_step")), F.lit(0.0)).alias("_ds"),
            F.min("_key").alias("_first_key"),
            F.min_by("resid", "_key").alias("_first"),
            F.max_by("resid", "_key").alias("_last"),
        )
    )
    gap = F.col("_first") - F.lag("_last").over(W.partitionBy("segment").orderBy("_first_key"))
    return (
        parts.withColumn("_gap", F.coalesce(gap * gap, F.lit(0.0)))
        .groupBy("segment")
        .agg(F.try_divide(F.sum(F.col("_ds") + F.col("_gap")), F.sum("_ss")).alias("durbin_watson"))
    )


def residual_moments(resid: DataFrame) -> DataFrame:
    """Count, skewness and kurtosis (normal = 3) of the residuals per segment."""
    return resid.groupBy("segment").agg(
        F.count("resid").alias("n"),
        F.skewness("resid").alias("skew"),
        (F.kurtosis("resid") + 3.0).alias("kurtosis"),
    )


def jarque_bera(n: Column, skew: Column, kurtosis: Column) -> Column:
    excess = kurtosis - 3.0
    return n / 6.0 * (skew * skew + excess * excess / 4.0)


def omnibus(n: Column, skew: Column, kurtosis: Column) -> Column:
    """D'Agostino-Pearson statistic: squared normal scores of skewness and kurtosis."""
    n = n.cast("double")
    y = skew * F.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    b2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2.0 * (b2 - 1)) - 1
    delta = 1.0 / F.sqrt(0.5 * F.log(w2))
    alpha = F.sqrt(2.0 / (w2 - 1))
    z_skew = delta * F.asinh(y / alpha)

    mean = 3.0 * (n - 1) / (n + 1)
    var = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (kurtosis - mean) / F.sqrt(var)
    root = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
    root = root * F.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / root * (2.0 / root + F.sqrt(1 + 4.0 / (root * root)))
    inner = (1 - 2.0 / a) / (1 + x * F.sqrt(2.0 / (a - 4)))
    cube = F.signum(inner) * F.pow(F.abs(inner), F.lit(1.0 / 3.0))
    z_kurt = (1 - 2.0 / (9.0 * a) - cube) / F.sqrt(2.0 / (9.0 * a))
    return z_skew * z_skew + z_kurt * z_kurt


def diagnostics(resid: DataFrame, order: Sequence[str]) -> DataFrame:
    """Normality and serial-correlation diagnostics per segment.

    The residuals are staged with their ordering key only: the moments, the sampling of the
    range partitioning and the ordering each read them, and none repeats the model's joins.
    """
    resid = stage(resid.select("segment", "resid", *order), "residuals")
    n, skew, kurtosis = F.col("n"), F.col("skew"), F.col("kurtosis")
    jb, omni = jarque_bera(n, skew, kurtosis), omnibus(n, skew, kurtosis)
    out = residual_moments(resid).join(durbin_watson(resid, order), "segment")
    return out.select(
        "segment",
        "n",
        "skew",
        "kurtosis",
        jb.alias("jarque_bera"),
        F.exp(-jb / 2).alias("p_jarque_bera"),
        omni.alias("omnibus"),
        F.exp(-omni / 2).alias("p_omnibus"),
        "durbin_watson",
    )


def hypothesis_tests(coefficients: DataFrame, tests: Mapping[str, str], alpha: float = 0.05) -> DataFrame:
    """Named tests of single terms against ``alpha``."""
    label = F.create_map(*[F.lit(x) for pair in tests.items() for x in pair])
    hit = coefficients.where(F.col("term").isin(list(tests)))
    return hit.select(
        label[F.col("term")].alias("test"),
        "term",
        "coef",
        "p",
        F.when(F.col("p") < alpha, "significant").otherwise("not significant").alias("result"),
    )


def report_lines(title: str, coefficients: DataFrame, fit: DataFrame) -> DataFrame:
    """A printable report as rows of ``(segment, line_no, value)``."""
    def num(c: str, width: int = 12) -> Column:
        return F.lpad(F.format_string("%.4g", F.col(c)), width, " ")

    heads = fit.select(
        "segment",
        F.lit(0).alias("line_no"),
        F.concat(
            F.lit(f"{title}: "), F.col("segment"),
            F.format_string("  n=%d  R2=%.3f  adj R2=%.3f  F=%.4g  AIC=%.4g  BIC=%.4g", "n", "r2", "adj_r2", "f", "aic", "bic"),
        ).alias("value"),
    )
    order = F.row_number().over(W.partitionBy("segment").orderBy("term"))
    body = coefficients.select(
        "segment",
        order.alias("line_no"),
        F.concat(F.rpad("term", 40, " "), *[num(c) for c in ("coef", "std_err", "t", "p", "low", "high")]).alias("value"),
    )
    return heads.unionByName(body)
