"""Correlations, simple fits and their significance."""

from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrocar.operators import tails

MIN_PAIRS = 3


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over complete pairs; missing where either side does not vary.

    The built-in ``corr`` raises on constant input under ANSI rules, so the quotient is
    written out with a null guard.
    """
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    spread = F.stddev_pop(xs) * F.stddev_pop(ys)
    return F.covar_pop(xs, ys) / F.nullif(spread, F.lit(0.0))


def pair_count(x: Column, y: Column) -> Column:
    return F.count(F.when(x.isNotNull() & y.isNotNull(), 1))


@F.pandas_udf(T.DoubleType())
def correlation_p(r: pd.Series, n: pd.Series) -> pd.Series:
    """Two-sided p of a correlation. It sees one row per reported coefficient."""
    return pd.Series([tails.correlation_p(a, b) for a, b in zip(r, n)], dtype="float64")


def correlate(df: DataFrame, keys: Sequence[str], x: str, y: str, minimum: int = MIN_PAIRS) -> DataFrame:
    """Pearson r, its p and the number of pairs per group; r is missing below ``minimum`` pairs."""
    cx, cy = F.col(x), F.col(y)
    out = df.groupBy(*keys).agg(pearson(cx, cy).alias("r"), pair_count(cx, cy).alias("n"))
    out = out.withColumn("r", F.when(F.col("n") >= minimum, F.col("r")))
    return out.withColumn("p", correlation_p("r", "n"))


def average_rank(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Rank within the group, ties sharing their mean rank.

    Ranks need the group in order, so this is for aggregated series (months per segment).
    """
    ordered = W.partitionBy(*keys).orderBy(value)
    ties = W.partitionBy(*keys, value)
    rank = F.rank().over(ordered) + (F.count(F.lit(1)).over(ties) - 1) / 2.0
    return df.withColumn(out, rank.cast("double"))


def spearman(df: DataFrame, keys: Sequence[str], x: str, y: str, minimum: int = MIN_PAIRS) -> DataFrame:
    """Spearman rho, its p and the number of pairs per group."""
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = average_rank(average_rank(pairs, keys, x, "_rx"), keys, y, "_ry")
    out = correlate(ranked, keys, "_rx", "_ry", minimum)
    return out.withColumnsRenamed({"r": "rho"})


def correlation_matrix(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairwise correlations of the columns in one pass: ``a, b, r, n``, diagonal missing."""
    names = sorted(columns)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    stats = [
        F.struct(
            F.lit(a).alias("a"),
            F.lit(b).alias("b"),
            pearson(F.col(f"`{a}`"), F.col(f"`{b}`")).alias("r"),
            pair_count(F.col(f"`{a}`"), F.col(f"`{b}`")).alias("n"),
        )
        for a, b in pairs
    ]
    own = [
        F.struct(
            F.lit(a).alias("a"),
            F.lit(a).alias("b"),
            F.lit(None).cast("double").alias("r"),
            F.count(F.col(f"`{a}`")).alias("n"),
        )
        for a in names
    ]
    # Both triangles are written from the same coefficient, next to the masked diagonal.
    upper = wide.agg(F.array(*stats, *own).alias("cells")).select(F.inline("cells"))
    sides = F.when(
        F.col("a") == F.col("b"), F.array(F.struct("a", "b"))
    ).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    return upper.withColumn("side", F.explode(sides)).select("side.a", "side.b", "r", "n")


def weighted_pearson(
    cells: DataFrame,
    keys: Sequence[str],
    count: str,
    mean: str,
    variance: str,
    x: str,
) -> DataFrame:
    """Pearson r of rows and a cell-level value, from cell summaries.

    Each cell holds the number of rows, their mean and population variance, and the one
    value ``x`` all its rows share. The result equals the row-level correlation, but the rows
    are read once and need not be joined to ``x``.
    """
    usable = cells.where(F.col(x).isNotNull() & (F.col(count) > 0))
    centre = usable.groupBy(*keys).agg(
        F.sum(count).alias("_n"),
        F.try_divide(F.sum(F.col(count) * F.col(mean)), F.sum(count)).alias("_my"),
        F.try_divide(F.sum(F.col(count) * F.col(x)), F.sum(count)).alias("_mx"),
        # Exact test for a constant side: centred sums leave rounding noise instead of zero.
        ((F.max(x) > F.min(x)) & ((F.max(mean) > F.min(mean)) | (F.max(variance) > 0))).alias("_varies"),
    )
    dy, dx = F.col(mean) - F.col("_my"), F.col(x) - F.col("_mx")
    joined = usable.join(centre, list(keys))
    sums = joined.groupBy(*keys).agg(
        F.max("_n").alias("n"),
        F.max("_varies").alias("_varies"),
        F.sum(F.col(count) * dx * dy).alias("_xy"),
        F.sum(F.col(count) * dx * dx).alias("_xx"),
        F.sum(F.col(count) * (F.col(variance) + dy * dy)).alias("_yy"),
    )
    r = F.col("_xy") / F.nullif(F.sqrt(F.col("_xx") * F.col("_yy")), F.lit(0.0))
    return sums.select(*keys, F.when(F.col("_varies"), r).alias("r"), "n")


def segment_matrix(correlations: DataFrame, segment: str, names: Sequence[str], column: str = "instrument") -> DataFrame:
    """Long correlations to one row per segment and one column per name."""
    return correlations.groupBy(segment).pivot(column, list(names)).agg(F.first("r"))


def defined_only(correlations: DataFrame) -> DataFrame:
    return correlations.where(F.col("r").isNotNull())


def with_reason(correlations: DataFrame, minimum: int = MIN_PAIRS) -> DataFrame:
    """State why a coefficient is missing."""
    reason = F.when(F.col("r").isNotNull(), F.lit(None)).when(
        F.col("n") < minimum, F.lit("too few pairs")
    )
    return correlations.withColumn("reason", reason.otherwise(F.when(F.col("r").isNull(), "insufficient variation")))


def strongest(correlations: DataFrame, name: str = "instrument") -> DataFrame:
    """The entry with the largest absolute r; the smaller name wins a tie."""
    order = F.struct((-F.abs(F.col("r"))).alias("a"), F.col(name).alias("b"))
    seen = F.col("r").isNotNull()
    return correlations.agg(
        F.min_by(F.when(seen, F.col(name)), F.when(seen, order)).alias(name),
        F.min_by(F.when(seen, F.col("r")), F.when(seen, order)).alias("r"),
    )


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line through complete pairs, with the range of x."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xs, ys = F.when(both, F.col(x)), F.when(both, F.col(y))
    return df.agg(
        F.regr_slope(ys, xs).alias("slope"),
        F.regr_intercept(ys, xs).alias("intercept"),
        F.min(x).alias("x_min"),
        F.max(x).alias("x_max"),
        F.count(xs).alias("n"),
    )


def fitted_line(fit: DataFrame, points: int = 200) -> DataFrame:
    """Evenly spaced points on a fitted line."""
    step = F.try_divide(F.col("x_max") - F.col("x_min"), F.lit(float(points - 1)))
    spread = fit.where("n >= 3").select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    x = F.col("x_min") + F.col("point") * step
    return spread.select("point", x.alias("x"), (F.col("intercept") + F.col("slope") * x).alias("y"))


def weighted_index(values: DataFrame, weights: Mapping[str, float], keys: Sequence[str], value: str, name: str = "instrument") -> DataFrame:
    """Weighted sum over the named series; missing unless every series has a value."""
    weight = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    usable = values.where(F.col(name).isin(list(weights)))
    total = F.sum(F.col(value) * weight[F.col(name)])
    return usable.groupBy(*keys).agg(
        F.when(F.count(value) == len(weights), total).alias("composite_index")
    )


def all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in columns])
