"""How brand prices move with commodity prices.

Listings -> brand x month panel -> month join -> coverage -> selected brands -> Pearson r per
brand and commodity.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrocar.operators import impute, panel, series, stats
from ferrocar.session import stage


def master(raw: DataFrame, monthly: DataFrame, new_vehicle_month: str) -> DataFrame:
    """Imputed listings with the month's quotes. ``monthly`` has one row per month."""
    typed = impute.type_listings(raw, new_vehicle_month)
    return panel.add_quotes(impute.impute(typed), monthly)


def analysis_panel(brand_month: DataFrame, monthly: DataFrame, start: str) -> DataFrame:
    return panel.add_quotes(panel.from_month(brand_month, start), monthly)


def selected_brands(rows: DataFrame, instruments: Sequence[str], minimum: int = 10, most: int = 12) -> DataFrame:
    coverage = panel.brand_coverage(rows, stats.all_present(instruments))
    return panel.covered_brands(coverage, minimum, most)


def correlations(
    brand_month: DataFrame,
    quotes: DataFrame,
    instruments: Sequence[str],
    start: str,
    minimum: int = 10,
    most: int = 12,
) -> DataFrame:
    """``brand, instrument, r, n`` for the best covered brands.

    ``brand_month`` is already aggregated, so everything here runs on brands x months rows, which are
    staged in the shared folder.
    """
    monthly = series.monthly_wide(series.monthly_mean(quotes), instruments)
    # Read twice, for the selection and for the correlations, but worked out once.
    rows = stage(analysis_panel(brand_month, monthly, start), "brand-months")
    chosen = panel.only_brands(rows, selected_brands(rows, instruments, minimum, most))
    cells = [
        F.struct(
            F.lit(i).alias("instrument"),
            stats.pearson(F.col("price_chf_mean"), F.col(f"`{i}`")).alias("r"),
            stats.pair_count(F.col("price_chf_mean"), F.col(f"`{i}`")).alias("n"),
        )
        for i in instruments
    ]
    # One pass over the panel for all instruments, written out as rows afterwards.
    return chosen.groupBy("brand").agg(F.array(*cells).alias("cells")).select("brand", F.inline("cells"))
