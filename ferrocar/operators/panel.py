"""Monthly panels of listings, and their coverage.

Listings are aggregated before they meet the quotes: a quote table has one row per calendar
month, so the join happens on panel rows (months x segments) and not on listings.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrocar.functions import numeric
from ferrocar.operators.quantile import count_values, radix_quantiles

PRICE = "price_chf"
BRAND_MEASURES = ["mileage", "engine_power_hp", "consumption_l_per_100km"]


def price_panel(listings: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Median, mean and number of prices, number of rows, and the mean of each measure per group.

    One pass over the listings: sums of the measures travel with the counted prices from
    which the exact medians are taken.
    """
    carried: list[Column] = []
    for m in measures:
        carried += [F.sum(m).alias(f"_s_{m}"), F.count(m).alias(f"_c_{m}")]
    counts = count_values(listings, keys, PRICE, carried)
    medians = radix_quantiles(counts, keys, PRICE, [0.5], ["median_price"])
    n_priced = F.sum(F.when(F.col(PRICE).isNotNull(), F.col("n")).otherwise(0))
    base = counts.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col(PRICE) * F.col("n")), n_priced).alias("mean_price"),
        n_priced.alias("priced"),
        F.sum("n").alias("listing_count"),
        *[F.try_divide(F.sum(f"_s_{m}"), F.sum(f"_c_{m}")).alias(f"mean_{m}") for m in measures],
    )
    return base.join(medians, list(keys), "left")


def monthly_panel(listings: DataFrame, segment: Sequence[str] = ()) -> DataFrame:
    """Price and mileage per month, or per month and segment."""
    panel = price_panel(listings, ["month", *segment], ["mileage"])
    return panel.select(
        "month", *segment, "median_price", "mean_price", F.col("priced").alias("car_count"),
        F.col("mean_mileage").alias("avg_mileage"),
    )


def brand_month_panel(listings: DataFrame) -> DataFrame:
    """Price, listings and vehicle means per brand and month, rounded for reporting."""
    panel = price_panel(listings, ["brand", "month"], BRAND_MEASURES)
    return panel.select(
        "brand",
        "month",
        numeric.round_even(F.col("mean_price")).alias("price_chf_mean"),
        numeric.round_even(F.col("median_price")).alias("price_chf_median"),
        "listing_count",
        numeric.round_even(F.col("mean_mileage")).alias("mileage_mean"),
        numeric.round_even(F.col("mean_engine_power_hp")).alias("engine_power_hp_mean"),
        numeric.round_even(F.col("mean_consumption_l_per_100km"), 2).alias("consumption_l_per_100km_mean"),
    )


def mean_panel(listings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rounded mean price and rows per group, where no median is asked for."""
    return (
        listings.where(F.col(keys[0]).isNotNull() & F.col(keys[-1]).isNotNull())
        .groupBy(*keys)
        .agg(
            numeric.round_even(F.avg(PRICE)).alias("price_chf_mean"),
            F.count(F.lit(1)).alias("listing_count"),
        )
    )


def add_quotes(rows: DataFrame, monthly: DataFrame, on: str = "month") -> DataFrame:
    """Left join of one quote row per month.

    The other side, which the optimizer broadcasts while it is small, has at most one row per calendar month (twelve a year, one column per
    instrument), whatever the size of the quote feed or of the listings.
    """
    quotes = monthly if on == "month" else monthly.withColumnsRenamed({"month": on})
    return rows.join(quotes, on, "left")


def from_month(panel: DataFrame, start: str) -> DataFrame:
    return panel.where(F.col("month") >= F.lit(start).cast("date"))


def brand_coverage(panel: DataFrame, complete: Column) -> DataFrame:
    """Listings, months, months with every quote, and first and last month per brand."""
    return panel.groupBy("brand").agg(
        F.sum("listing_count").alias("listing_count_total"),
        # The panel has one row per brand and month, so months need no distinct count.
        F.count("month").alias("months_total"),
        F.count_if(complete).alias("months_with_commodities"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
    )


def covered_brands(coverage: DataFrame, minimum: int = 10, most: int | None = 12) -> DataFrame:
    """Brands with enough covered months, best covered first, at most ``most`` of them."""
    enough = coverage.where(F.col("months_with_commodities") >= minimum)
    ranked = enough.orderBy(F.desc("months_with_commodities"), "brand")
    return ranked.limit(most) if most is not None else ranked


def top_brands(panel: DataFrame, n: int = 10) -> DataFrame:
    totals = panel.groupBy("brand").agg(F.sum("listing_count").alias("listings"))
    return totals.orderBy(F.desc("listings"), "brand").limit(n)


def only_brands(panel: DataFrame, brands: DataFrame) -> DataFrame:
    """Panel rows of the selected brands."""
    return panel.join(brands.select("brand"), "brand", "left_semi")


def mean_price_by_brand(panel: DataFrame) -> DataFrame:
    """Mean of the monthly mean prices, highest first."""
    out = panel.groupBy("brand").agg(F.avg("price_chf_mean").alias("avg_price"))
    return out.orderBy(F.desc("avg_price"), "brand")


def price_trim(listings: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Rows between two price quantiles, both bounds included."""
    bounds = radix_quantiles(count_values(listings, [], PRICE), [], PRICE, [low, high], ["lower", "upper"])
    both = bounds.select(F.struct("lower", "upper")).scalar()
    return listings.where(F.col(PRICE).between(both["lower"], both["upper"]))
