"""Output forms shared by both engines."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferrocar.functions import dates, numeric


def r6(c: Column | str, name: str) -> Column:
    """Six digits, half to even, with the arithmetic of :func:`r6_sql`."""
    return numeric.round_even(F.col(c) if isinstance(c, str) else c, 6).alias(name)


def r6_sql(expr: str, name: str) -> str:
    return f"round_even(({expr}) * 1e6, 0) / 1e6 AS {name}"


def big(c: Column | str, name: str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint").alias(name)


def ym(c: Column | str = "month", name: str = "month") -> Column:
    return dates.month_text(F.col(c) if isinstance(c, str) else c).alias(name)


def ym_sql(expr: str = "month", name: str = "month") -> str:
    return f"strftime({expr}, '%Y-%m') AS {name}"


def pearson_sql(x: str, y: str) -> str:
    """Pearson r over complete pairs, missing where a side does not vary."""
    both = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    return f"covar_pop({x}, {y}) {both} / nullif(stddev_pop({x}) {both} * stddev_pop({y}) {both}, 0)"


def t_tail_sql(t: str, df: str) -> str:
    """Two-sided p of Student's t by Simpson's rule over the angle atan(t / sqrt(df)).

    With the angle u the central probability is C * integral of cos(u)^(df - 1), and
    C = 2 gamma((df + 1) / 2) / (sqrt(pi) gamma(df / 2)).
    """
    steps = 2000
    h = f"(atan(abs({t}) / sqrt({df})) / {steps}.0)"
    weight = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    area = f"(SELECT sum(({weight}) * pow(cos(i * {h}), {df} - 1)) FROM range(0, {steps + 1}) g(i)) * {h} / 3"
    return (
        f"CASE WHEN {t} IS NOT NULL THEN greatest(0.0, 1 - 2 / sqrt(pi()) "
        f"* exp(lgamma(({df} + 1) / 2.0) - lgamma({df} / 2.0)) * {area}) END"
    )


def corr_p_sql(r: str, n: str) -> str:
    return t_tail_sql(f"({r} * sqrt(({n} - 2) / nullif(1 - {r} * {r}, 0)))", f"({n} - 2)")
