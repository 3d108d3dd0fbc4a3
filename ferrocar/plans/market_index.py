"""How median prices move with a composite commodity index."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrocar.functions import numeric
from ferrocar.operators import panel, series, stats
from ferrocar.session import stage


def month_table(listings: DataFrame, quotes: DataFrame, weights: Mapping[str, float], segment: Sequence[str] = ()) -> DataFrame:
    """Monthly price panel with quotes and composite index; rows are months (x segments)."""
    instruments = list(weights)
    monthly = stage(series.monthly_mean(quotes), "monthly-quotes")
    wide = series.monthly_wide(monthly, instruments)
    index = series.composite_index(monthly, weights)
    prices = panel.monthly_panel(listings, segment)
    return panel.add_quotes(panel.add_quotes(prices, index), wide)


def price_correlations(table: DataFrame, instruments: Sequence[str]) -> DataFrame:
    """Pearson and Spearman of the median price with the composite and each commodity."""
    series_names = ["composite_index", *instruments]
    table = stage(table, "months")
    long = table.unpivot(
        ["month", "median_price"], [F.col(f"`{c}`") for c in series_names], "instrument", "value"
    )
    r = stats.correlate(long, ["instrument"], "median_price", "value")
    rho = stats.spearman(long, ["instrument"], "median_price", "value")
    rho = rho.select("instrument", "rho", F.col("p").alias("rho_p"))
    return r.join(rho, "instrument", "left")


def rebased(table: DataFrame, start: str) -> DataFrame:
    """The composite index set to 100 at ``start``, or at the first month after it."""
    window = panel.from_month(table, start)
    return series.rebase_at(window, "composite_index", start, "composite_indexed")


def segment_price_index(table: DataFrame, segment: str, start: str) -> DataFrame:
    """Median price of each segment, its first month as 100."""
    window = panel.from_month(table, start)
    base = window.groupBy(segment).agg(F.min_by("median_price", "month").alias("_base"))
    indexed = numeric.index_100(F.col("median_price"), F.col("_base"))
    return window.join(base, segment).withColumn("median_price_indexed", indexed).drop("_base")


def run_summary(table: DataFrame, correlations: DataFrame) -> DataFrame:
    """Months, listings, composite correlation and strongest commodity in one row."""
    composite = F.col("instrument") == "composite_index"
    size = table.agg(F.count("month").alias("months"), F.sum("car_count").alias("cars"))
    own = correlations.where(composite).select("r", "rho")
    best = stats.strongest(correlations.where(~composite))
    return size.select(
        "months",
        "cars",
        own.select("r").scalar().alias("composite_r"),
        own.select("rho").scalar().alias("composite_rho"),
        best.select("instrument").scalar().alias("strongest"),
        best.select("r").scalar().alias("strongest_r"),
    )
