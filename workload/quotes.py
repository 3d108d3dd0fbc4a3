"""Quote series: averages, fills, indexes, returns, volatility, correlations."""

from pyspark.sql import functions as F

from ferrocar.functions import numeric
from ferrocar.operators import profile, series, stats
from ferrocar.plans import quote_profile
from ferrocar.sources import readers
from workload import proxies as P
from workload.helpers import big, pearson_sql, r6, r6_sql, ym, ym_sql
from workload.registry import query


def dense(spark, d):
    return series.densify(P.quotes(spark, d), P.INSTRUMENTS)


TICKERS = {name: f"T{i}" for i, name in enumerate(P.INSTRUMENTS)}


@query(
    "a5_quotes_from_ohlc",
    f"""WITH {P.QUOTES_SQL}
SELECT date, strftime(date, '%Y-%m') AS month, instrument, 'T' || (CAST(substr(instrument, 1, 1) AS INTEGER) - 1) AS ticker,
  close, round_even(avg(close) OVER (PARTITION BY instrument, date_trunc('month', date)) * 100, 0) / 100 AS monthly_avg
FROM quotes WHERE date >= DATE '{P.START}'""",
)
def quotes_from_ohlc(spark, d):
    """A multi-ticker feed with both price fields and a ticker that is not configured."""
    ticker = F.create_map(*[F.lit(x) for pair in TICKERS.items() for x in pair])
    closes = P.quotes(spark, d).select("date", ticker[F.col("instrument")].alias("ticker"), "close")
    fields = F.explode(
        F.array(
            F.struct(F.lit("Close").alias("field"), F.col("close").alias("value")),
            F.struct(F.lit("Adj Close").alias("field"), (F.col("close") * 0.9).alias("value")),
        )
    )
    feed = closes.select("date", "ticker", fields.alias("f")).select("date", "ticker", "f.*")
    unknown = feed.where(F.col("ticker") == "T0").withColumn("ticker", F.lit("ZZ"))
    out = readers.quotes_from_ohlc(feed.unionByName(unknown), TICKERS, P.START)
    return out.select("date", ym(), "instrument", "ticker", "close", "monthly_avg")


@query(
    "c13_decimal_comma_quotes",
    f"WITH {P.QUOTES_SQL} SELECT instrument, {r6_sql('sum(round_even(close, 0))', 'total')}, count(*) AS n FROM quotes GROUP BY 1",
)
def decimal_comma_quotes(spark, d):
    shown = F.replace(numeric.round_even(F.col("close"), 0).cast("decimal(18,1)").cast("string"), F.lit("."), F.lit(","))
    rows = P.quotes(spark, d).select("instrument", numeric.decimal_comma(shown).alias("close"))
    return rows.groupBy("instrument").agg(r6(F.sum("close"), "total"), big(F.count("close"), "n"))


@query(
    "w1_monthly_average",
    f"""WITH {P.QUOTES_SQL}
SELECT date, instrument, round_even(avg(close) OVER (PARTITION BY instrument, date_trunc('month', date)) * 100, 0) / 100 AS monthly_avg
FROM quotes""",
)
def monthly_average(spark, d):
    return series.with_monthly_average(P.quotes(spark, d)).select("date", "instrument", "monthly_avg")


@query(
    "w2_trailing_fill",
    f"""WITH {P.DENSE_SQL},
seen AS (SELECT date, instrument, avg(close) OVER (PARTITION BY instrument ORDER BY date ROWS 6 PRECEDING) AS recent
  FROM dense WHERE close IS NOT NULL)
SELECT d.date, d.instrument, {r6_sql('''coalesce(d.close, last_value(s.recent IGNORE NULLS)
  OVER (PARTITION BY d.instrument ORDER BY d.date ROWS UNBOUNDED PRECEDING))''', 'filled')}
FROM dense d LEFT JOIN seen s ON s.date = d.date AND s.instrument = d.instrument""",
)
def trailing_fill(spark, d):
    return series.trailing_fill(dense(spark, d)).select("date", "instrument", r6("filled", "filled"))


INDEXED_SQL = f"""{P.DENSE_SQL},
base AS (SELECT instrument, arg_min(close, date) AS base FROM quotes GROUP BY 1),
indexed AS (SELECT date, instrument, CASE WHEN base = 0 THEN close ELSE close / base * 100 END AS indexed
  FROM dense JOIN base USING (instrument))"""


@query("w3_index_to_first", f"WITH {INDEXED_SQL} SELECT date, instrument, {r6_sql('indexed', 'indexed')} FROM indexed")
def index_to_first(spark, d):
    return quote_profile.indexed(dense(spark, d)).select("date", "instrument", r6("indexed", "indexed"))


RETURNS_SQL = f"""{INDEXED_SQL},
padded AS (SELECT date, instrument,
  last_value(indexed IGNORE NULLS) OVER (PARTITION BY instrument ORDER BY date ROWS UNBOUNDED PRECEDING) AS level FROM indexed),
allrets AS (SELECT date, instrument, level / nullif(lag(level) OVER (PARTITION BY instrument ORDER BY date), 0) - 1 AS ret FROM padded),
rets AS (SELECT * FROM allrets WHERE date IN (SELECT date FROM allrets GROUP BY 1 HAVING count(ret) = 5))"""


def rets(spark, d):
    return quote_profile.daily_returns(dense(spark, d), P.INSTRUMENTS)


@query("w6_daily_returns", f"WITH {RETURNS_SQL} SELECT date, instrument, {r6_sql('ret', 'ret')} FROM rets")
def daily_returns(spark, d):
    return rets(spark, d).select("date", "instrument", r6("ret", "ret"))


@query(
    "w6_returns_without_padding",
    f"""WITH {P.DENSE_SQL}
SELECT date, instrument, {r6_sql('close / nullif(lag(close) OVER (PARTITION BY instrument ORDER BY date), 0) - 1', 'ret')} FROM dense""",
)
def returns_without_padding(spark, d):
    return series.returns(dense(spark, d), pad=False).select("date", "instrument", r6("ret", "ret"))


@query(
    "w7_total_change",
    f"""WITH {P.QUOTES_SQL}
SELECT instrument, min(date) AS first_date, max(date) AS last_date, {r6_sql('arg_min(close, date)', 'first_close')},
  {r6_sql('arg_max(close, date)', 'last_close')}, count(*) AS n,
  {r6_sql('CASE WHEN count(*) >= 2 THEN (arg_max(close, date) - arg_min(close, date)) / arg_min(close, date) * 100 END', 'pct_change')}
FROM quotes GROUP BY 1""",
)
def total_change(spark, d):
    out = series.total_change(P.quotes(spark, d))
    return out.select(
        "instrument", "first_date", "last_date", r6("first_close", "first_close"),
        r6("last_close", "last_close"), "n", r6("pct_change", "pct_change"),
    )


@query(
    "w8_o6_first_per_month",
    f"""WITH {P.QUOTES_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY instrument, date_trunc('month', date) ORDER BY date) AS k FROM quotes)
SELECT instrument, {ym_sql('date')}, date, {r6_sql('close', 'close')} FROM ranked WHERE k = 1""",
)
def first_per_month(spark, d):
    rows = P.quotes(spark, d).withColumn("month", F.trunc("date", "MM"))
    return series.first_per_month(rows).select("instrument", ym(), "date", r6("close", "close"))


@query(
    "g4_p3_monthly_mean",
    f"WITH {P.MONTHLY_SQL} SELECT {ym_sql()}, instrument, {r6_sql('close', 'close')} FROM monthly",
)
def monthly_mean(spark, d):
    return series.monthly_mean(P.quotes(spark, d)).select(ym(), "instrument", r6("close", "close"))


_PIVOT = ", ".join(f"max(close) FILTER (WHERE instrument = '{i}') AS \"{i}\"" for i in P.INSTRUMENTS)
_WIDE = ", ".join(r6_sql(f'"{i}"', f'"{i}"') for i in P.INSTRUMENTS)


_AVERAGES = ", ".join(r6_sql(f'"{i}"', f'"{i}_Monthly_Avg"') for i in P.INSTRUMENTS)


@query(
    "p3_suffix_selection",
    f"WITH {P.MONTHLY_SQL}, averages AS (SELECT month, {_PIVOT} FROM monthly GROUP BY 1) SELECT {ym_sql()}, {_AVERAGES} FROM averages",
)
def suffix_selection(spark, d):
    wide = series.monthly_wide(series.monthly_mean(P.quotes(spark, d)), P.INSTRUMENTS)
    wide = wide.withColumnsRenamed({i: f"{i}_Monthly_Avg" for i in P.INSTRUMENTS}).withColumn("Spot", F.lit(0.0))
    return wide.select(ym(), *[r6(F.col(f"`{c}`"), c) for c in profile.with_suffix(wide, "_Monthly_Avg")])


@query(
    "o9_long_to_wide",
    f"""WITH {P.QUOTES_SQL}, wide AS (SELECT date, {_PIVOT} FROM quotes GROUP BY 1)
SELECT date, {_WIDE} FROM wide""",
)
def long_to_wide(spark, d):
    wide = series.to_wide(P.quotes(spark, d), P.INSTRUMENTS)
    return wide.select("date", *[r6(f"`{i}`", i) for i in P.INSTRUMENTS])


@query("o10_wide_to_long", f"WITH {P.DENSE_SQL} SELECT date, instrument, {r6_sql('close', 'close')} FROM dense")
def wide_to_long(spark, d):
    return dense(spark, d).select("date", "instrument", r6("close", "close"))


@query(
    "p8_complete_days",
    f"""WITH {P.DENSE_SQL}
SELECT date FROM dense GROUP BY 1 HAVING count(close) = 5""",
)
def complete_days(spark, d):
    return series.to_wide(P.quotes(spark, d), P.INSTRUMENTS).dropna("any").select("date")


FENCED_SQL = f"""{RETURNS_SQL},
bounds AS (SELECT instrument, q1 - 3 * (q3 - q1) AS lower, q3 + 3 * (q3 - q1) AS upper FROM (
  SELECT instrument, quantile_cont(ret, 0.25) AS q1, quantile_cont(ret, 0.75) AS q3 FROM rets GROUP BY 1)),
fenced AS (SELECT r.*, lower, upper, ret BETWEEN lower AND upper AS inside FROM rets r JOIN bounds USING (instrument))"""


@query(
    "p12_iqr_fence",
    f"""WITH {FENCED_SQL}
SELECT instrument, {r6_sql('max(lower)', 'lower')}, {r6_sql('max(upper)', 'upper')}, count(*) AS n, count(*) FILTER (WHERE NOT inside) AS removed
FROM fenced GROUP BY 1""",
)
def iqr_fence(spark, d):
    out = series.fence_counts(rets(spark, d), ["instrument"], "ret")
    return out.select("instrument", r6("lower", "lower"), r6("upper", "upper"), "n", "removed")


@query(
    "g21_volatility",
    f"""WITH {FENCED_SQL}
SELECT instrument, {r6_sql('avg(ret) FILTER (WHERE inside) * 100', 'mean_pct')}, {r6_sql('stddev_samp(ret) FILTER (WHERE inside) * 100', 'std_pct')},
  {r6_sql('min(ret) FILTER (WHERE inside) * 100', 'min_pct')}, {r6_sql('max(ret) FILTER (WHERE inside) * 100', 'max_pct')},
  {r6_sql('skewness(ret) FILTER (WHERE inside)', 'skewness')}, {r6_sql('kurtosis(ret) FILTER (WHERE inside)', 'kurtosis')},
  count(*) FILTER (WHERE NOT inside) AS removed, count(*) FILTER (WHERE inside) AS n
FROM fenced GROUP BY 1""",
)
def volatility(spark, d):
    out = quote_profile.volatility_table(rets(spark, d))
    measures = ["mean_pct", "std_pct", "min_pct", "max_pct", "skewness", "kurtosis"]
    return out.select("instrument", *[r6(m, m) for m in measures], "removed", "n")


@query(
    "p15_short_series_guard",
    f"""WITH {P.QUOTES_SQL}
SELECT instrument, CAST(date_trunc('year', date) AS DATE) AS year, count(*) AS n,
  {r6_sql('CASE WHEN count(*) >= 240 THEN avg(close) END', 'mean')} FROM quotes GROUP BY 1, 2""",
)
def short_series_guard(spark, d):
    """A statistic is reported only for series long enough; the others keep their row."""
    n, mean = F.count(F.lit(1)), F.avg("close")
    out = P.quotes(spark, d).groupBy("instrument", F.to_date(F.trunc("date", "year")).alias("year")).agg(
        n.alias("n"), numeric.at_least(n, 240, mean).alias("mean")
    )
    return out.select("instrument", "year", "n", r6("mean", "mean"))


@query(
    "g20_returns_histogram",
    f"""WITH {FENCED_SQL},
kept AS (SELECT instrument, ret FROM fenced WHERE inside),
span AS (SELECT instrument, min(ret) AS lo, (max(ret) - min(ret)) / 50.0::DOUBLE AS w, count(*) AS total FROM kept GROUP BY 1),
placed AS (SELECT k.instrument, lo, w, total, coalesce(least(CAST(floor((ret - lo) / nullif(w, 0)) AS INTEGER), 49), 0) AS bin FROM kept k JOIN span USING (instrument))
SELECT instrument, bin, {r6_sql('max(lo) + bin * max(w)', 'left_edge')}, count(*) AS n, {r6_sql('count(*) / nullif(max(total) * max(w), 0)', 'density')}
FROM placed GROUP BY instrument, bin""",
)
def returns_histogram(spark, d):
    out = quote_profile.fenced_histogram(rets(spark, d))
    return out.select("instrument", "bin", r6("left_edge", "left_edge"), "n", r6("density", "density"))


@query(
    "g20_events_histogram",
    f"""WITH span AS (SELECT min(value) AS lo, (max(value) - min(value)) / 50.0::DOUBLE AS w, count(value) AS total FROM events),
placed AS (SELECT lo, w, total, coalesce(least(CAST(floor((value - lo) / nullif(w, 0)) AS INTEGER), 49), 0) AS bin FROM events, span WHERE value IS NOT NULL)
SELECT bin, {r6_sql('max(lo) + bin * max(w)', 'left_edge')}, count(*) AS n, {r6_sql('count(*) / nullif(max(total) * max(w), 0)', 'density')} FROM placed GROUP BY bin""",
)
def events_histogram(spark, d):
    out = series.histogram(P.table(spark, d, "events"), [], "value")
    return out.select("bin", r6("left_edge", "left_edge"), "n", r6("density", "density"))


FIT_SQL = f"""{FENCED_SQL},
fit AS (SELECT instrument, avg(ret) AS mu, stddev_samp(ret) AS sigma, min(ret) AS x_min, max(ret) AS x_max
  FROM fenced WHERE inside GROUP BY 1)"""


@query(
    "s13_normal_fit",
    f"""WITH {FIT_SQL} SELECT instrument, {r6_sql('mu', 'mu')}, {r6_sql('sigma', 'sigma')},
  {r6_sql('mu - sigma', 'mu_minus_sigma')}, {r6_sql('mu + sigma', 'mu_plus_sigma')} FROM fit""",
)
def normal_fit(spark, d):
    out = quote_profile.fenced_normal(rets(spark, d))
    return out.select("instrument", *[r6(c, c) for c in ("mu", "sigma", "mu_minus_sigma", "mu_plus_sigma")])


@query(
    "m6_normal_curve",
    f"""WITH {FIT_SQL},
points AS (SELECT instrument, mu, sigma, i AS point, x_min + i * ((x_max - x_min) / 99.0::DOUBLE) AS x FROM fit, range(0, 100) g(i))
SELECT instrument, CAST(point AS INTEGER) AS point, {r6_sql('x', 'x')},
  {r6_sql('exp(-((x - mu) / sigma) * ((x - mu) / sigma) / 2) / (sigma * sqrt(2 * pi()))', 'density')} FROM points""",
)
def normal_curve(spark, d):
    out = series.normal_curve(quote_profile.fenced_normal(rets(spark, d)))
    return out.select("instrument", "point", r6("x", "x"), r6("density", "density"))


_NAMES_SQL = ", ".join(f"('{i}')" for i in P.INSTRUMENTS)


@query(
    "s3_o13_correlation_matrix",
    f"""WITH {P.DENSE_SQL}
SELECT x.instrument AS a, y.instrument AS b,
  {r6_sql("CASE WHEN x.instrument <> y.instrument THEN " + pearson_sql('x.close', 'y.close') + " END", 'r')},
  count(*) FILTER (WHERE x.close IS NOT NULL AND y.close IS NOT NULL) AS n
FROM dense x JOIN dense y ON x.date = y.date GROUP BY 1, 2""",
)
def correlation_matrix(spark, d):
    out = quote_profile.close_correlations(dense(spark, d), P.INSTRUMENTS)
    return out.select("a", "b", r6("r", "r"), "n")


COMPOSITE_SQL = f"""{P.MONTHLY_SQL}, {P.WEIGHTS_SQL.strip()},
first_month AS (SELECT instrument, arg_min(close, month) AS base FROM monthly GROUP BY 1),
composite AS (SELECT month, CASE WHEN count(close) = 5 THEN sum(weight * (close / base * 100)) END AS composite_index
  FROM monthly JOIN first_month USING (instrument) JOIN weights USING (instrument) GROUP BY 1)"""


@query(
    "x1_composite_index",
    f"WITH {COMPOSITE_SQL} SELECT {ym_sql()}, {r6_sql('composite_index', 'composite_index')} FROM composite",
)
def composite_index(spark, d):
    out = series.composite_index(series.monthly_mean(P.quotes(spark, d)), P.WEIGHTS)
    return out.select(ym(), r6("composite_index", "composite_index"))


@query(
    "w4_rebased_composite",
    f"""WITH {COMPOSITE_SQL},
later AS (SELECT * FROM composite WHERE month >= DATE '{P.START}'),
base AS (SELECT coalesce(max(composite_index) FILTER (WHERE month = DATE '{P.START}'), arg_min(composite_index, month)) AS b FROM later)
SELECT {ym_sql()}, {r6_sql('composite_index / b * 100', 'composite_indexed')} FROM later, base""",
)
def rebased_composite(spark, d):
    index = series.composite_index(series.monthly_mean(P.quotes(spark, d)), P.WEIGHTS)
    window = index.where(F.col("month") >= F.lit(P.START).cast("date"))
    out = series.rebase_at(window, "composite_index", P.START, "composite_indexed")
    return out.select(ym(), r6("composite_indexed", "composite_indexed"))


@query(
    "x3_mean_fill",
    f"""WITH {P.DENSE_SQL}
SELECT date, instrument, {r6_sql('coalesce(close, avg(close) OVER (PARTITION BY instrument))', 'close')} FROM dense""",
)
def mean_fill(spark, d):
    return series.mean_fill(dense(spark, d)).select("date", "instrument", r6("close", "close"))


@query(
    "x7_prepared_months",
    f"""WITH {P.DENSE_SQL},
averaged AS (SELECT date, instrument,
  round_even(avg(close) OVER (PARTITION BY instrument, date_trunc('month', date)) * 100, 0) / 100 AS monthly_avg FROM dense),
holes AS (SELECT date, instrument, CASE WHEN date < DATE '1995-03-01' THEN NULL ELSE monthly_avg END AS v FROM averaged),
filled AS (SELECT date, instrument, coalesce(v, avg(v) OVER (PARTITION BY instrument)) AS v FROM holes),
ranked AS (SELECT *, row_number() OVER (PARTITION BY instrument, date_trunc('month', date) ORDER BY date) AS k FROM filled)
SELECT {ym_sql('date')}, instrument, {r6_sql('v', 'close')} FROM ranked WHERE k = 1""",
)
def prepared_months(spark, d):
    """Monthly averages from the quote file layout, some months without text, two without values."""
    averaged = series.with_monthly_average(dense(spark, d))
    holes = averaged.withColumn("monthly_avg", F.when(F.col("date") >= "1995-03-01", F.col("monthly_avg")))
    wide = series.to_wide(holes, P.INSTRUMENTS, "monthly_avg").withColumnsRenamed(
        {i: f"{i}_Spot_Monthly_Avg" for i in P.INSTRUMENTS}
    )
    shown = F.when(F.dayofmonth("date") % 3 != 0, F.date_format("date", "MM-yyyy"))
    layout = wide.withColumn("Month", shown).withColumnsRenamed({"date": "Date"})
    return series.prepare_monthly(layout, P.INSTRUMENTS).select(ym(), "instrument", r6("close", "close"))


@query(
    "k3_clean_quotes",
    f"""WITH {P.DENSE_SQL},
seen AS (SELECT date, instrument, avg(close) OVER (PARTITION BY instrument ORDER BY date ROWS 6 PRECEDING) AS recent FROM dense WHERE close IS NOT NULL),
filled AS (SELECT d.date, d.instrument, d.close, coalesce(d.close, last_value(s.recent IGNORE NULLS)
  OVER (PARTITION BY d.instrument ORDER BY d.date ROWS UNBOUNDED PRECEDING)) AS f
  FROM dense d LEFT JOIN seen s ON s.date = d.date AND s.instrument = d.instrument)
SELECT instrument, {ym_sql('date')}, count(f) AS days, {r6_sql('max(round_even(f, 0))', 'top')},
  {r6_sql('round_even(avg(close) * 100, 0) / 100', 'monthly_avg')} FROM filled GROUP BY 1, 2""",
)
def clean_quotes(spark, d):
    out = quote_profile.clean_quotes(dense(spark, d), digits=0)
    return out.groupBy("instrument", ym()).agg(
        F.count("close").alias("days"), r6(F.max("close"), "top"), r6(F.max("monthly_avg"), "monthly_avg")
    )
