"""Hierarchical imputation of listings.

Every fill value depends on a listing's brand and model only, and on the levels before it. So
the listings are read once into cells (rows with equal brand, model, power mode, transmission
and month are one cell of counts and sums), all levels are worked out on the cells, and one
lookup per (brand, model) is joined back. No level scans the listings again, and a popular
model is combined before any shuffle.

Levels, in order:

* price, mileage, power: overall mean, then the whole column rounded to 0 digits
* consumption: 0 for electric; model mean (electric zeros included); brand mean (model fills
  included); overall mean of the original values; rounded to 2 digits
* power mode, transmission: the model's most frequent value, else ``Unknown``
* production date: model median, then brand median (model fills included); month from the
  date; then the model's and the brand's most frequent month

Fill values are learnt on demand. ``OUTPUTS`` names the fill values each imputed column reads and
``NEEDS`` the fill values each one is worked out from; ``plan`` closes a set of columns over both, and
only those values are learnt. Mean fills need the overall means alone, which one aggregate gives
without staging anything; the other values are learnt over staged cells, one table per level group
(cells, models, brands, months, the lookup), and a group that no asked-for value needs is not built.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrocar import schema as S
from ferrocar.functions import dates, numeric, text
from ferrocar.session import stage

MEAN_FILLED = ["price_chf", "mileage", "engine_power_hp"]
CONSUMPTION = "consumption_l_per_100km"
UNKNOWN = "Unknown"

# The fill values that each fill value is worked out from.
NEEDS: dict[str, set[str]] = {
    "overall": set(),
    "cons_model": set(),
    "power_mode_fill": set(),
    "transmission_fill": set(),
    "day_model": set(),
    "cons_brand": {"cons_model"},
    "day_brand": {"day_model"},
    "month_model": {"day_model", "day_brand"},
    "month_brand": {"month_model"},
}
# The fill values that each imputed column reads.
OUTPUTS: dict[str, set[str]] = {
    **{c: {"overall"} for c in MEAN_FILLED},
    CONSUMPTION: {"cons_model", "cons_brand", "overall"},
    "fill_source": {"cons_model", "cons_brand", "overall"},
    "power_mode": {"power_mode_fill"},
    "transmission": {"transmission_fill"},
    "production_date": {"day_model", "day_brand"},
    "month": {"day_model", "day_brand", "month_model", "month_brand"},
}
# Fill values of each table of the lookup.
MODEL_VALUES = ("cons_model", "power_mode_fill", "transmission_fill", "day_model")
BRAND_VALUES = ("cons_brand", "day_brand")
MONTH_VALUES = ("month_model", "month_brand")


def plan(columns: list[str] | tuple[str, ...] | set[str] | None = None) -> set[str]:
    """The fill values that imputing ``columns`` needs (all imputed columns if None), closed over ``NEEDS``."""
    wanted = set().union(*(OUTPUTS[c] for c in (OUTPUTS if columns is None else columns) if c in OUTPUTS))
    while True:
        more = wanted.union(*(NEEDS[v] for v in wanted))
        if more == wanted:
            return wanted
        wanted = more


def type_listings(
    raw: DataFrame, new_vehicle_month: str = S.NEW_VEHICLE_MONTH, new_vehicle: str = S.NEW_VEHICLE
) -> DataFrame:
    """Numbers, dates and month keys from crawled text."""
    date = text.replace_literal(F.col("production_date"), new_vehicle, new_vehicle_month)
    texts = [c for c in S.CONTINUOUS if c in raw.columns and isinstance(raw.schema[c].dataType, T.StringType)]
    typed = {c: numeric.to_number(F.col(c)) for c in texts}
    typed["production_date"] = dates.parse_month_year(date)
    out = raw.withColumns(typed)
    return out.withColumn("month", dates.month_of(F.col("production_date")))


def listing_cells(listings: DataFrame) -> DataFrame:
    """Counts and sums per (brand, model, power mode, transmission, date), staged."""
    sums = [F.sum(c).alias(f"sum_{c}") for c in S.CONTINUOUS]
    seen = [F.count(c).alias(f"n_{c}") for c in S.CONTINUOUS]
    grouped = listings.groupBy("brand", "model", "power_mode", "transmission", "production_date")
    return stage(grouped.agg(F.count(F.lit(1)).alias("n"), *sums, *seen), "listing-cells")


def _mean(total: str, count: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(count))


def _day_month(day: Column) -> Column:
    return dates.month_of(F.date_from_unix_date(F.floor(day).cast("int")))


def _mode(counted: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Most frequent value per key; the smallest wins a tie."""
    seen = counted.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    totals = seen.groupBy(key, value).agg(F.sum("n").alias("_n"))
    return totals.groupBy(key).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(out))


def _with_known(cells: DataFrame) -> DataFrame:
    """Cells with the day number, and how many listings have a consumption once electric ones
    count as zero (``_known``)."""
    seen = F.col(f"n_{CONSUMPTION}")
    zeros = F.when(text.is_electric(F.col("power_mode")), F.col("n") - seen).otherwise(0)
    return cells.select(
        "brand",
        "model",
        "power_mode",
        "transmission",
        F.unix_date("production_date").cast("double").alias("_day"),
        "n",
        F.coalesce(F.col(f"sum_{CONSUMPTION}"), F.lit(0.0)).alias("_sum"),
        (seen + zeros).alias("_known"),
    )


def model_statistics(cells: DataFrame, wanted: set[str] | None = None) -> DataFrame:
    """Mean consumption, modal power mode and transmission, and median day per model (those ``wanted``).

    Each cell gives one row per statistic, so equal values of all of them are combined by the
    same aggregate. The last step then sees a model's distinct values only: its power modes,
    its gearboxes and the calendar's months.
    """
    none = {"text": F.lit(None).cast("string"), "day": F.lit(None).cast("double"), "n": F.lit(0).cast("bigint")}

    def entry(kind: str, **values: Column) -> Column:
        fields = {**none, "sum": F.lit(0.0), "known": F.lit(0).cast("bigint"), **values}
        return F.struct(F.lit(kind).alias("kind"), *[c.alias(k) for k, c in fields.items()])

    wanted = set(MODEL_VALUES) if wanted is None else wanted
    kinds = {
        "cons_model": entry("cons", sum=F.col("_sum"), known=F.col("_known")),
        "power_mode_fill": entry("power", text=F.col("power_mode"), n=F.col("n")),
        "transmission_fill": entry("gear", text=F.col("transmission"), n=F.col("n")),
        "day_model": entry("day", day=F.col("_day"), n=F.col("n")),
    }
    entries = F.array(*(kinds[v] for v in MODEL_VALUES if v in wanted))
    rows = _with_known(cells).where(F.col("model").isNotNull()).select("model", F.inline(entries))
    counted = rows.groupBy("model", "kind", "text", "day").agg(
        F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.sum("known").alias("known")
    )

    def mode(kind: str, out: str) -> Column:
        mine = (F.col("kind") == kind) & F.col("text").isNotNull()
        order = F.when(mine, F.struct(-F.col("n"), F.col("text")))
        return F.min_by(F.when(mine, F.col("text")), order).alias(out)

    # Rows of other kinds have no day and are passed over by the percentile.
    values = {
        "cons_model": _mean("sum", "known").alias("cons_model"),
        "power_mode_fill": mode("power", "power_mode_fill"),
        "transmission_fill": mode("gear", "transmission_fill"),
        "day_model": F.percentile("day", F.lit(0.5), F.col("n")).alias("day_model"),
    }
    return counted.groupBy("model").agg(*(values[v] for v in MODEL_VALUES if v in wanted))


def brand_statistics(cells: DataFrame, models: DataFrame, wanted: set[str] | None = None) -> DataFrame:
    """Mean consumption and median day per brand, after the model fills (those ``wanted``)."""
    wanted = set(BRAND_VALUES) if wanted is None else wanted
    rows = _with_known(cells).where(F.col("brand").isNotNull()).join(models, "model", "left")
    cons, day = "cons_brand" in wanted, "day_brand" in wanted
    gaps = F.when(F.col("cons_model").isNotNull(), F.col("n") - F.col("_known")).otherwise(0) if cons else F.lit(0)
    filled = rows.select(
        "brand",
        (F.coalesce("_day", "day_model") if day else F.lit(None).cast("double")).alias("_day"),
        "n",
        (F.col("_sum") + F.coalesce(gaps * F.col("cons_model"), F.lit(0.0)) if cons else F.lit(0.0)).alias("_sum"),
        (F.col("_known") + gaps).alias("_known"),
    )
    counted = filled.groupBy("brand", "_day").agg(
        F.sum("n").alias("n"), F.sum("_sum").alias("_sum"), F.sum("_known").alias("_known")
    )
    values = {
        "cons_brand": _mean("_sum", "_known").alias("cons_brand"),
        "day_brand": F.percentile("_day", F.lit(0.5), F.col("n")).alias("day_brand"),
    }
    return counted.groupBy("brand").agg(*(values[v] for v in BRAND_VALUES if v in wanted))


@dataclass
class Fills:
    """One staged row of fill values per (brand, model), the overall means, and the values learnt."""

    pairs: DataFrame | None
    overall: DataFrame | None
    wanted: set[str]


def learn_fills(listings: DataFrame, wanted: set[str] | None = None) -> Fills:
    """The fill values ``wanted`` (all if None), from one pass over typed listings.

    Overall means alone are one aggregate of the listings. Otherwise the listings become staged
    cells, and each level group that a wanted value needs is staged once before the next reads it:
    models, brands, months, and the lookup per (brand, model).
    """
    wanted = plan() if wanted is None else wanted
    if not wanted - {"overall"}:
        overall = listings.agg(*[F.avg(c).alias(c) for c in S.CONTINUOUS]) if wanted else None
        return Fills(None, overall, wanted)
    cells = listing_cells(listings)
    model_values = wanted.intersection(MODEL_VALUES)
    brand_values = wanted.intersection(BRAND_VALUES)
    lookups: list[tuple[DataFrame, str]] = []
    models = model_statistics(cells, model_values) if model_values else None
    if models is not None:
        models = stage(models, "models") if brand_values or "month_model" in wanted else models
        lookups.append((models, "model"))
    brands = brand_statistics(cells, models, brand_values) if brand_values else None
    if brands is not None:
        brands = stage(brands, "brands") if "month_model" in wanted else brands
        lookups.append((brands, "brand"))
    keys = cells
    if "month_model" in wanted:
        dated = cells.join(models, "model", "left").join(brands, "brand", "left")
        day = F.coalesce(F.unix_date("production_date").cast("double"), "day_model", "day_brand")
        months = stage(dated.groupBy("brand", "model", _day_month(day).alias("_month")).agg(F.sum("n").alias("n")), "months")
        month_model = _mode(months, "model", "_month", "month_model")
        lookups.append((month_model, "model"))
        if "month_brand" in wanted:
            later = months.join(month_model, "model", "left").withColumn("_month", F.coalesce("_month", "month_model"))
            lookups.append((_mode(later, "brand", "_month", "month_brand"), "brand"))
        keys = months
    pairs = keys.select("brand", "model").distinct()
    for lookup, key in lookups:
        pairs = pairs.join(lookup, key, "left")
    overall = cells.agg(*[_mean(f"sum_{c}", f"n_{c}").alias(c) for c in S.CONTINUOUS]) if "overall" in wanted else None
    return Fills(stage(pairs, "fills"), overall, wanted)


def _join_pair(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join on brand and model; a missing brand or model matches its own entry."""
    right = lookup.withColumnsRenamed({"brand": "_brand", "model": "_model"})
    same = F.col("brand").eqNullSafe(F.col("_brand")) & F.col("model").eqNullSafe(F.col("_model"))
    return rows.join(right, same, "left").drop("_brand", "_model")


def fill_source() -> Column:
    """The level that supplies a listing's consumption."""
    return (
        F.when(F.col(CONSUMPTION).isNotNull(), "observed")
        .when(text.is_electric(F.col("power_mode")), "electric")
        .when(F.col("cons_model").isNotNull(), "model")
        .when(F.col("cons_brand").isNotNull(), "brand")
        .when(F.col(f"_overall.{CONSUMPTION}").isNotNull(), "overall")
        .otherwise("missing")
    )


def impute(listings: DataFrame, fills: Fills | None = None, columns: list[str] | None = None) -> DataFrame:
    """Typed listings with the gaps of ``columns`` (all imputed columns if None) filled, as far as the
    levels can fill them; ``fill_source`` where consumption is asked for. Columns not asked for stay as typed.
    """
    columns = list(OUTPUTS) if columns is None else [c for c in columns if c in OUTPUTS]
    if fills is None:
        fills = learn_fills(listings, plan(columns))
    joined = listings
    if fills.pairs is not None:
        # The lookup is staged: broadcast if its files are small, skew-split merge join if not.
        joined = _join_pair(joined, fills.pairs)
    if fills.overall is not None:
        joined = joined.withColumn("_overall", fills.overall.select(F.struct(*S.CONTINUOUS)).scalar())
    # An electric listing is zero only where its own power mode was known.
    electric = F.when(text.is_electric(F.col("power_mode")), F.lit(0.0))
    value = F.coalesce(F.col(CONSUMPTION), electric, "cons_model", "cons_brand", f"_overall.{CONSUMPTION}")
    day = F.coalesce(F.unix_date("production_date").cast("double"), "day_model", "day_brand")
    filled = {
        **{c: numeric.round_even(F.coalesce(F.col(c), f"_overall.{c}"), 0) for c in MEAN_FILLED},
        "fill_source": fill_source(),
        CONSUMPTION: numeric.round_even(value, 2),
        "power_mode": F.coalesce("power_mode", "power_mode_fill", F.lit(UNKNOWN)),
        "transmission": F.coalesce("transmission", "transmission_fill", F.lit(UNKNOWN)),
        "production_date": F.date_from_unix_date(F.floor(day).cast("int")),
        "month": F.coalesce(_day_month(day), "month_model", "month_brand"),
    }
    out = joined.withColumns({c: filled[c] for c in columns})
    helpers = (set(fills.pairs.columns) - {"brand", "model"} if fills.pairs is not None else set()) | {"_overall"}
    return out.drop(*helpers)


def fill_audit(imputed: DataFrame) -> DataFrame:
    """Listings per supplying level."""
    return imputed.groupBy("fill_source").agg(F.count(F.lit(1)).alias("n"))
