"""Exploration of the quote series: indexes, returns, volatility, correlations."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrocar.operators import series, stats


def indexed(quotes: DataFrame) -> DataFrame:
    """Each series with its first valid close as 100."""
    return series.index_to_first(quotes, ["instrument"], "date", "close")


def daily_returns(dense: DataFrame, instruments: Sequence[str], pad: bool = True) -> DataFrame:
    """Returns of the indexed series on days where every instrument has one."""
    rets = series.returns(indexed(dense), "indexed", pad)
    return series.complete_days(rets, "ret", len(instruments)).select("date", "instrument", "ret")


def volatility_table(rets: DataFrame) -> DataFrame:
    return series.volatility(rets)


def fenced_histogram(rets: DataFrame, bins: int = 50) -> DataFrame:
    return series.histogram(series.fence(rets, ["instrument"], "ret"), ["instrument"], "ret", bins)


def fenced_normal(rets: DataFrame) -> DataFrame:
    return series.normal_fit(series.fence(rets, ["instrument"], "ret"))


def close_correlations(dense: DataFrame, instruments: Sequence[str]) -> DataFrame:
    return stats.correlation_matrix(series.to_wide(dense, instruments), instruments)


def clean_quotes(dense: DataFrame, window: int = 7, digits: int = 2, recompute: bool = False) -> DataFrame:
    """Gap-filled, rounded closes. Monthly averages stay those of the unfilled closes unless
    ``recompute`` asks for new ones."""
    averaged = series.with_monthly_average(dense)
    filled = series.trailing_fill(averaged, window)
    rounded = filled.withColumn("close", series.numeric.round_even(F.col("filled"), digits)).drop("filled")
    return series.with_monthly_average(rounded) if recompute else rounded
