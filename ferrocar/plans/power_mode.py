"""How price sensitivity to commodities differs by power mode."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrocar.functions import dates, numeric, text
from ferrocar.operators import panel, regression, stats

SEGMENTS = ["Petrol", "Diesel", "Electric"]


def prepare(listings: DataFrame, key: Column, first: str, last: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Listings with a power mode and a price inside the trim, and an observation month."""
    known = listings.where(F.col("power_mode").isNotNull() & F.col("price_chf").isNotNull())
    trimmed = panel.price_trim(known, low, high)
    return trimmed.withColumns(
        {
            "power_mode": text.power_mode_en(F.col("power_mode")),
            "observation_month": dates.assigned_month(key, first, last),
            "log_price": numeric.log_price(F.col("price_chf")),
        }
    )


def quoted_months(monthly: DataFrame, required: Sequence[str]) -> DataFrame:
    """Months with all required quotes: one row per calendar month."""
    return monthly.where(stats.all_present(required))


def observed(prepared: DataFrame, monthly: DataFrame, required: Sequence[str]) -> DataFrame:
    """Listings whose observation month has the required quotes."""
    months = quoted_months(monthly, required).select(F.col("month").alias("observation_month"))
    return prepared.join(months, "observation_month", "left_semi")


def descriptives(rows: DataFrame) -> DataFrame:
    """Price, mileage and power statistics per power mode, two digits."""
    def two(c: Column, name: str) -> Column:
        return numeric.round_even(c, 2).alias(name)

    return (
        rows.where(F.col("power_mode").isNotNull())
        .groupBy("power_mode")
        .agg(
            F.count("price_chf").alias("price_count"),
            two(F.avg("price_chf"), "price_mean"),
            two(F.stddev_samp("price_chf"), "price_std"),
            two(F.min("price_chf"), "price_min"),
            two(F.max("price_chf"), "price_max"),
            two(F.avg("mileage"), "mileage_mean"),
            two(F.stddev_samp("mileage"), "mileage_std"),
            two(F.avg("engine_power_hp"), "power_mean"),
            two(F.stddev_samp("engine_power_hp"), "power_std"),
        )
    )


def price_correlations(rows: DataFrame, monthly: DataFrame, instruments: Sequence[str]) -> DataFrame:
    """Listing-level Pearson r of price and quote: ``power_mode, instrument, r, n``.

    All listings of a power mode and month share their quotes, so prices are summarised per
    (power mode, month) before the quotes are joined.
    """
    cells = (
        rows.where(F.col("power_mode").isNotNull())
        .groupBy("power_mode", F.col("observation_month").alias("month"))
        .agg(
            F.count("price_chf").alias("n_rows"),
            F.avg("price_chf").alias("mean_price"),
            F.var_pop("price_chf").alias("var_price"),
        )
    )
    long = panel.add_quotes(cells, monthly).unpivot(
        ["power_mode", "month", "n_rows", "mean_price", "var_price"],
        [F.col(f"`{i}`") for i in instruments],
        "instrument",
        "quote",
    )
    return stats.weighted_pearson(long, ["power_mode", "instrument"], "n_rows", "mean_price", "var_price", "quote")


def by_observation_month(rows: DataFrame) -> DataFrame:
    """Rows keyed by their observation month instead of their production month."""
    return rows.drop("month").withColumnsRenamed({"observation_month": "month"})


def regression_cells(rows: DataFrame, monthly: DataFrame) -> DataFrame:
    """Moments of log price, mileage and power per power mode and month, with the quotes."""
    cells = regression.moment_cells(
        by_observation_month(rows),
        ["power_mode", "month"],
        ["mileage", "engine_power_hp", "log_price"],
    )
    return panel.add_quotes(cells, monthly)


def _is(mode: str) -> Column:
    return (F.col("power_mode") == mode).cast("double")


def _z(name: str) -> Column:
    return F.col(f"`z_{name}`")


def pooled_design(roles: dict[str, str], interactions: Sequence[tuple[str, str]]) -> regression.Design:
    """Mileage, power, z-scored quotes, power-mode dummies (petrol is the reference level) and
    their products. ``roles`` maps commodity names to quote columns."""
    terms = [regression.Term("mileage", "mileage"), regression.Term("engine_power_hp", "engine_power_hp")]
    terms += [regression.Term(name, value=_z(column)) for name, column in roles.items()]
    terms += [regression.Term(mode, value=_is(mode)) for mode in SEGMENTS[1:]]
    terms += [
        regression.Term(f"{mode}:{name}", value=_is(mode) * _z(roles[name])) for mode, name in interactions
    ]
    return regression.Design("log_price", tuple(terms))


def segment_design(roles: dict[str, str]) -> regression.Design:
    """Mileage, power and z-scored quotes, one fit per power mode."""
    terms = [regression.Term("mileage", "mileage"), regression.Term("engine_power_hp", "engine_power_hp")]
    terms += [regression.Term(name, value=_z(column)) for name, column in roles.items()]
    return regression.Design("log_price", tuple(terms), "power_mode")


POOLED_ROLES = ["Lithium", "Copper", "WTI", "Steel"]
SEGMENT_ROLES = ["Lithium", "Copper", "Nickel", "WTI", "Steel"]
INTERACTIONS = [
    ("Electric", "Lithium"),
    ("Electric", "Copper"),
    ("Electric", "WTI"),
    ("Diesel", "WTI"),
    ("Diesel", "Steel"),
]
TESTS = {
    "Electric:Lithium": "electric more sensitive to lithium than petrol",
    "Electric:Copper": "electric more sensitive to copper than petrol",
    "Diesel:WTI": "diesel more sensitive to oil than petrol",
}


def pooled_fit(cells: DataFrame, roles: dict[str, str]):
    """Pooled model over all power modes: the cells with z-scores, the design, its solution."""
    used = {name: roles[name] for name in POOLED_ROLES}
    scored = regression.standardise(cells, list(used.values()))
    design = pooled_design(used, INTERACTIONS)
    return scored, design, regression.solve(scored, design)


def segment_fits(cells: DataFrame, roles: dict[str, str]):
    """One model per power mode, quotes standardised within it."""
    used = {name: roles[name] for name in SEGMENT_ROLES}
    named = cells.where(F.col("power_mode").isNotNull())
    scored = regression.standardise(named, list(used.values()), ["power_mode"])
    design = segment_design(used)
    return scored, design, regression.solve(scored, design)
