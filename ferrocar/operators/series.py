"""Quote series: gap filling, indexes, returns and their distribution.

Quotes are long: ``date, instrument, close``, one row per instrument and trading day. An
instrument's series is bounded by the calendar (about 260 rows a year), so a window or an exact
percentile per instrument stays small however many listings there are. Statistics that need no
order use ``min_by``/``max_by`` and do without windows.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ferrocar.functions import dates, numeric

MIN_RETURNS = 10
FENCE = 3.0


def pick_close(ohlc: DataFrame) -> DataFrame:
    """The ``Close`` rows, or the ``Adj Close`` rows where the whole feed has no ``Close``."""
    has_close = ohlc.agg(F.max(F.col("field") == "Close")).scalar()
    chosen = F.when(F.coalesce(has_close, F.lit(False)), "Close").otherwise("Adj Close")
    return ohlc.where(F.col("field") == chosen).select("date", "ticker", F.col("value").alias("close"))


def name_tickers(quotes: DataFrame, tickers: Mapping[str, str], start: str) -> DataFrame:
    """Quotes of the configured tickers from ``start`` on, under their commodity names."""
    names = F.create_map(*[F.lit(x) for name, ticker in tickers.items() for x in (ticker, name)])
    kept = quotes.where(F.col("ticker").isin(list(tickers.values()))).where(F.col("date") >= F.lit(start).cast("date"))
    return kept.select("date", names[F.col("ticker")].alias("instrument"), "ticker", "close")


def to_wide(quotes: DataFrame, instruments: Sequence[str], value: str = "close") -> DataFrame:
    """One row per day and one column per instrument; an absent instrument is a null column."""
    return quotes.groupBy("date").pivot("instrument", list(instruments)).agg(F.first(value))


def to_long(wide: DataFrame, instruments: Sequence[str], value: str = "close") -> DataFrame:
    """One row per day and instrument; days without a quote keep a null value."""
    return wide.unpivot("date", [F.col(f"`{i}`") for i in instruments], "instrument", value)


def densify(quotes: DataFrame, instruments: Sequence[str]) -> DataFrame:
    """Add a null row for each instrument on days when only others were quoted."""
    return to_long(to_wide(quotes, instruments), instruments)


def with_monthly_average(quotes: DataFrame, digits: int | None = 2) -> DataFrame:
    """The month's mean close on every day of the month."""
    monthly = F.avg("close").over(W.partitionBy("instrument", "month"))
    if digits is not None:
        monthly = numeric.round_even(monthly, digits)
    return quotes.withColumn("month", dates.month_of(F.col("date"))).withColumn("monthly_avg", monthly)


def monthly_mean(quotes: DataFrame, value: str = "close", out: str = "close") -> DataFrame:
    """Mean per month and instrument: at most one row per calendar month and instrument."""
    return (
        quotes.withColumn("month", dates.month_of(F.col("date")))
        .groupBy("month", "instrument")
        .agg(F.avg(value).alias(out))
    )


def monthly_wide(monthly: DataFrame, instruments: Sequence[str], value: str = "close") -> DataFrame:
    """One row per month and one column per instrument."""
    return monthly.groupBy("month").pivot("instrument", list(instruments)).agg(F.first(value))


def trailing_fill(quotes: DataFrame, window: int = 7, value: str = "close") -> DataFrame:
    """Fill gaps with the mean of the last ``window`` observed values.

    Filled values are not used for later fills, and gaps before the first observation stay.
    """
    seen = F.col(value).isNotNull()
    by_day = W.partitionBy("instrument").orderBy("date")
    # Observed rows of an instrument get consecutive numbers, so a row window over them
    # skips the gaps in between.
    observed = W.partitionBy("instrument", seen).orderBy("date").rowsBetween(-(window - 1), 0)
    recent = F.when(seen, F.avg(value).over(observed))
    carried = F.last("_recent", ignorenulls=True).over(by_day.rowsBetween(W.unboundedPreceding, 0))
    return (
        quotes.withColumn("_recent", recent)
        .withColumn("filled", F.coalesce(F.col(value), carried))
        .drop("_recent")
    )


def mean_fill(quotes: DataFrame, value: str = "close") -> DataFrame:
    """Fill gaps with the instrument's mean."""
    mean = F.avg(value).over(W.partitionBy("instrument"))
    return quotes.withColumn(value, F.coalesce(F.col(value), mean))


def first_valid(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    """First non-null value per group."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min_by(value, order).alias(out))


def index_to_first(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str = "indexed") -> DataFrame:
    """Each group's series with its first valid value as 100.

    A group whose first value is zero keeps its values, as it cannot be indexed.
    """
    base = first_valid(df, keys, order, value, "_base")
    scaled = F.when(F.col("_base") == 0, F.col(value)).otherwise(numeric.index_100(F.col(value), F.col("_base")))
    return df.join(base, list(keys), "left").withColumn(out, scaled).drop("_base")


def rebase_at(df: DataFrame, value: str, month: str, out: str) -> DataFrame:
    """The series with its value at ``month`` as 100, or its first row's where that is absent."""
    at = F.col("month") == F.lit(month).cast("date")
    base = df.agg(
        F.when(F.max(at), F.max(F.when(at, F.col(value)))).otherwise(F.min_by(value, "month"))
    ).scalar()
    return df.withColumn(out, numeric.index_100(F.col(value), base))


def returns(quotes: DataFrame, value: str = "close", pad: bool = True, out: str = "ret") -> DataFrame:
    """Change against the previous row; ``pad`` carries the last value over gaps first."""
    by_day = W.partitionBy("instrument").orderBy("date")
    level = F.col(value)
    if pad:
        level = F.last(value, ignorenulls=True).over(by_day.rowsBetween(W.unboundedPreceding, 0))
    with_level = quotes.withColumn("_level", level)
    change = numeric.ratio(F.col("_level"), F.lag("_level").over(by_day)) - 1.0
    return with_level.withColumn(out, change).drop("_level")


def complete_days(quotes: DataFrame, value: str, instruments: int) -> DataFrame:
    """Rows of days on which every instrument has a value."""
    present = F.count(value).over(W.partitionBy("date"))
    return quotes.withColumn("_present", present).where(F.col("_present") == instruments).drop("_present")


def total_change(quotes: DataFrame) -> DataFrame:
    """First and last valid close with their days and the change in percent."""
    seen = quotes.where(F.col("close").isNotNull())
    out = seen.groupBy("instrument").agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.min_by("close", "date").alias("first_close"),
        F.max_by("close", "date").alias("last_close"),
        F.count("close").alias("n"),
    )
    change = numeric.percent_change(F.col("first_close"), F.col("last_close"))
    return out.withColumn("pct_change", numeric.at_least(F.col("n"), 2, change))


def first_per_month(quotes: DataFrame, keys: Sequence[str] = ("instrument",)) -> DataFrame:
    """The first row of each month, by day."""
    rest = [c for c in quotes.columns if c not in {*keys, "month"}]
    first = F.min_by(F.struct(*rest), "date").alias("_row")
    return quotes.groupBy(*keys, "month").agg(first).select(*keys, "month", "_row.*")


def fence_bounds(df: DataFrame, keys: Sequence[str], value: str, k: float = FENCE) -> DataFrame:
    """Quartiles and the fence ``[Q1 - k IQR, Q3 + k IQR]`` per series."""
    quarters = df.groupBy(*keys).agg(
        F.percentile(value, F.array(F.lit(0.25), F.lit(0.75))).alias("_q"), F.count(value).alias("n")
    )
    q1, q3 = F.col("_q")[0], F.col("_q")[1]
    return quarters.select(
        *keys,
        "n",
        q1.alias("q1"),
        q3.alias("q3"),
        (q1 - k * (q3 - q1)).alias("lower"),
        (q3 + k * (q3 - q1)).alias("upper"),
    )


def fence(df: DataFrame, keys: Sequence[str], value: str, k: float = FENCE) -> DataFrame:
    """Rows inside their series' fence."""
    bounds = fence_bounds(df.where(F.col(value).isNotNull()), keys, value, k)
    inside = F.col(value).between(F.col("lower"), F.col("upper"))
    return df.join(bounds.select(*keys, "lower", "upper"), list(keys)).where(inside).drop("lower", "upper")


def fence_counts(df: DataFrame, keys: Sequence[str], value: str, k: float = FENCE) -> DataFrame:
    """Rows per series, and how many the fence removes."""
    seen = df.where(F.col(value).isNotNull())
    bounds = fence_bounds(seen, keys, value, k).drop("n")
    inside = F.col(value).between(F.col("lower"), F.col("upper"))
    return (
        seen.join(bounds, list(keys))
        .groupBy(*keys)
        .agg(
            F.max("lower").alias("lower"),
            F.max("upper").alias("upper"),
            F.count(value).alias("n"),
            F.count_if(~inside).alias("removed"),
        )
    )


def volatility(rets: DataFrame, minimum: int = MIN_RETURNS, k: float = FENCE, value: str = "ret") -> DataFrame:
    """Distribution of the fenced returns per instrument.

    Instruments with fewer than ``minimum`` returns keep a row with missing statistics.
    """
    seen = rets.where(F.col(value).isNotNull())
    bounds = fence_bounds(seen, ["instrument"], value, k).withColumnsRenamed({"n": "_all"})
    held = seen.join(bounds, "instrument").withColumn(
        "_x", F.when(F.col(value).between(F.col("lower"), F.col("upper")), F.col(value))
    )
    x = F.col("_x")
    enough = F.max("_all") >= minimum

    def guarded(stat: Column) -> Column:
        return F.when(enough, stat)

    # Every instrument that has rows is reported, even if no return could be formed.
    everyone = rets.select("instrument").distinct()
    stats = held.groupBy("instrument").agg(
        guarded(F.avg(x) * 100).alias("mean_pct"),
        guarded(F.stddev_samp(x) * 100).alias("std_pct"),
        guarded(F.min(x) * 100).alias("min_pct"),
        guarded(F.max(x) * 100).alias("max_pct"),
        guarded(numeric.sample_skewness(x)).alias("skewness"),
        guarded(numeric.sample_kurtosis(x)).alias("kurtosis"),
        F.when(enough, F.max("_all") - F.count(x)).otherwise(F.lit(0)).alias("removed"),
        F.when(enough, F.count(x)).otherwise(F.max("_all")).alias("n"),
    )
    filled = {"removed": F.coalesce("removed", F.lit(0)), "n": F.coalesce("n", F.lit(0))}
    return everyone.join(stats, "instrument", "left").withColumns(filled)


def histogram(df: DataFrame, keys: Sequence[str], value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum with counts and density; empty bins are left out."""
    seen = df.where(F.col(value).isNotNull())
    span = seen.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(value).alias("_n"))
    if keys:
        placed = seen.select(*keys, value).join(span, list(keys))
        lo, hi, n = F.col("_lo"), F.col("_hi"), F.col("_n")
    else:
        one = span.select(F.struct("_lo", "_hi", "_n")).scalar()
        placed, lo, hi, n = seen.select(value), one["_lo"], one["_hi"], one["_n"]
    width = (hi - lo) / F.lit(float(bins))
    place = F.least(F.floor(F.try_divide(F.col(value) - lo, width)), F.lit(bins - 1)).cast("int")
    counted = placed.select(*keys, F.coalesce(place, F.lit(0)).alias("bin"), lo.alias("_lo"), width.alias("_w"), n.alias("_n"))
    return (
        counted.groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.max("_lo").alias("_lo"), F.max("_w").alias("_w"), F.max("_n").alias("_n"))
        .select(
            *keys,
            "bin",
            (F.col("_lo") + F.col("bin") * F.col("_w")).alias("left_edge"),
            "n",
            F.try_divide(F.col("n"), F.col("_n") * F.col("_w")).alias("density"),
        )
    )


def normal_fit(rets: DataFrame, value: str = "ret") -> DataFrame:
    """Mean, deviation and one-sigma marks per instrument."""
    mu, sigma = F.avg(value), F.stddev_samp(value)
    return rets.groupBy("instrument").agg(
        mu.alias("mu"),
        sigma.alias("sigma"),
        (mu - sigma).alias("mu_minus_sigma"),
        (mu + sigma).alias("mu_plus_sigma"),
        F.min(value).alias("x_min"),
        F.max(value).alias("x_max"),
    )


def normal_curve(fit: DataFrame, points: int = 100) -> DataFrame:
    """The fitted normal density on evenly spaced points between minimum and maximum."""
    step = (F.col("x_max") - F.col("x_min")) / F.lit(float(points - 1))
    x = F.col("x_min") + F.col("point") * step
    spread = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    return spread.select(
        "instrument", "point", x.alias("x"), numeric.normal_pdf(x, F.col("mu"), F.col("sigma")).alias("density")
    )


def composite_index(monthly: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Weighted index of the monthly means, each set to 100 at its first valid month."""
    from ferrocar.operators.stats import weighted_index

    indexed = index_to_first(monthly, ["instrument"], "month", "close")
    return weighted_index(indexed, weights, ["month"], "indexed")


def prepare_monthly(wide_quotes: DataFrame, instruments: Sequence[str], suffix: str = "_Spot_Monthly_Avg") -> DataFrame:
    """Monthly averages from the quote file: month key, mean fill, first row of each month.

    Input rows hold ``Date``, ``Month`` text and one average column per instrument.
    """
    months = wide_quotes.withColumn("month", dates.quote_month(F.col("Month"), F.col("Date")))
    names = [f"{i}{suffix}" for i in instruments]
    long = months.where(F.col("Date").isNotNull() | F.col("month").isNotNull()).unpivot(
        ["Date", "month"], [F.col(f"`{n}`").alias(i) for n, i in zip(names, instruments)], "instrument", "close"
    )
    filled = mean_fill(long)
    return (
        filled.where(F.col("month").isNotNull())
        .withColumnsRenamed({"Date": "date"})
        .transform(first_per_month)
        .select("month", "instrument", "close")
    )
