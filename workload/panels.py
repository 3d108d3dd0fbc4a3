"""Monthly panels, joins with quotes, coverage, and the analyses built on them."""

from pyspark.sql import functions as F

from ferrocar.functions import text
from ferrocar.operators import panel, series, stats
from ferrocar.operators.quantile import exact_quantiles
from ferrocar.plans import brand_sensitivity, market_index, power_mode
from workload import proxies as P
from workload.helpers import corr_p_sql, pearson_sql, r6, r6_sql, ym, ym_sql
from workload.registry import query


def monthly(spark, d):
    """One row per month, one column per instrument."""
    return series.monthly_wide(series.monthly_mean(P.quotes(spark, d)), P.INSTRUMENTS)


_QUOTES = ", ".join(r6_sql(f'"{i}"', f'"{i}"') for i in P.INSTRUMENTS)


def _quotes6():
    return [r6(f"`{i}`", i) for i in P.INSTRUMENTS]


# --- panels -------------------------------------------------------------------------------


@query(
    "g1_monthly_panel",
    f"""WITH {P.LISTINGS_SQL}, {P.MONTHLY_SQL.strip()}
SELECT {ym_sql('p.month')}, median_price, mean_price, car_count, avg_mileage, {_QUOTES}
FROM (SELECT month, {r6_sql('quantile_cont(price_chf, 0.5)', 'median_price')}, {r6_sql('avg(price_chf)', 'mean_price')},
        count(price_chf) AS car_count, {r6_sql('avg(mileage)', 'avg_mileage')} FROM listings GROUP BY 1) p
LEFT JOIN wide w ON w.month = p.month""",
)
def monthly_panel(spark, d):
    out = panel.add_quotes(panel.monthly_panel(P.listings(spark, d)), monthly(spark, d))
    return out.select(
        ym(), r6("median_price", "median_price"), r6("mean_price", "mean_price"), "car_count",
        r6("avg_mileage", "avg_mileage"), *_quotes6(),
    )


def typed_listings(spark, d):
    return P.listings(spark, d).withColumn("vehicle_type", text.vehicle_type(F.col("power_mode")))


TYPED_SQL = f"""{P.LISTINGS_SQL},
typed AS (SELECT *, CASE WHEN lower(power_mode) IN ('elektro', 'electric', 'ev') THEN 'EV' ELSE 'ICE' END AS vehicle_type FROM listings),
by_type AS (SELECT month, vehicle_type, quantile_cont(price_chf, 0.5) AS median_price, avg(price_chf) AS mean_price,
  count(price_chf) AS car_count, avg(mileage) AS avg_mileage FROM typed GROUP BY 1, 2)"""


@query(
    "g2_panel_by_vehicle_type",
    f"""WITH {TYPED_SQL}
SELECT {ym_sql()}, vehicle_type, {r6_sql('median_price', 'median_price')}, {r6_sql('mean_price', 'mean_price')}, car_count,
  {r6_sql('avg_mileage', 'avg_mileage')} FROM by_type""",
)
def panel_by_vehicle_type(spark, d):
    out = panel.monthly_panel(typed_listings(spark, d), ["vehicle_type"])
    return out.select(
        ym(), "vehicle_type", r6("median_price", "median_price"), r6("mean_price", "mean_price"), "car_count",
        r6("avg_mileage", "avg_mileage"),
    )


@query(
    "w5_price_index_by_type",
    f"""WITH {TYPED_SQL},
later AS (SELECT * FROM by_type WHERE month >= DATE '{P.START}'),
base AS (SELECT vehicle_type, arg_min(median_price, month) AS b FROM later GROUP BY 1)
SELECT {ym_sql()}, vehicle_type, {r6_sql('median_price', 'median_price')}, {r6_sql('median_price / b * 100', 'median_price_indexed')}
FROM later JOIN base USING (vehicle_type)""",
)
def price_index_by_type(spark, d):
    table = panel.monthly_panel(typed_listings(spark, d), ["vehicle_type"])
    out = market_index.segment_price_index(table, "vehicle_type", P.START)
    return out.select(
        ym(), "vehicle_type", r6("median_price", "median_price"), r6("median_price_indexed", "median_price_indexed")
    )


BRAND_MONTH_SQL = f"""{P.LISTINGS_SQL},
brand_month AS (
  SELECT brand, month, round_even(avg(price_chf), 0) AS price_chf_mean, round_even(quantile_cont(price_chf, 0.5), 0) AS price_chf_median,
    count(*) AS listing_count, round_even(avg(mileage), 0) AS mileage_mean, round_even(avg(engine_power_hp), 0) AS engine_power_hp_mean,
    round_even(avg(consumption_l_per_100km) * 100, 0) / 100 AS consumption_l_per_100km_mean
  FROM listings WHERE brand IS NOT NULL AND month IS NOT NULL GROUP BY 1, 2)"""


@query(
    "g3_brand_month_panel",
    f"""WITH {BRAND_MONTH_SQL}
SELECT brand, {ym_sql()}, price_chf_mean, price_chf_median, listing_count, mileage_mean, engine_power_hp_mean,
  consumption_l_per_100km_mean FROM brand_month""",
)
def brand_month_panel(spark, d):
    out = panel.brand_month_panel(P.listings(spark, d))
    return out.withColumn("month", F.date_format("month", "yyyy-MM"))


# --- joins --------------------------------------------------------------------------------


@query(
    "j1_listings_with_quotes",
    f"""WITH {P.LISTINGS_SQL}, {P.MONTHLY_SQL.strip()}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {ym_sql('l.month')}, price_chf, {_QUOTES}
FROM listings l LEFT JOIN wide w ON w.month = l.month""",
)
def listings_with_quotes(spark, d):
    out = panel.add_quotes(P.listings(spark, d), monthly(spark, d))
    return out.select(*P.KEY, ym(), "price_chf", *_quotes6())


OBSERVED_SQL = f"""{P.LISTINGS_SQL}, {P.MONTHLY_SQL.strip()},
assigned AS (SELECT *, CAST(DATE '{P.FIRST_MONTH}' + to_months(CAST(CAST('0x' || substr(md5({P.KEY_SQL}), 1, 8) AS BIGINT) % 67 AS INTEGER)) AS DATE)
  AS observation_month FROM listings)"""


@query(
    "j2_observation_month_join",
    f"""WITH {OBSERVED_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {ym_sql('observation_month', 'observation_month')}, {_QUOTES}
FROM assigned LEFT JOIN wide ON wide.month = observation_month
WHERE "3-MEDIUM" IS NOT NULL AND "1-URGENT" IS NOT NULL""",
)
def observation_month_join(spark, d):
    from ferrocar.functions import dates

    month = dates.assigned_month(P.listing_key(), P.FIRST_MONTH, P.LAST_MONTH)
    rows = P.listings(spark, d).withColumn("observation_month", month)
    out = panel.add_quotes(rows, monthly(spark, d), "observation_month")
    out = out.dropna(subset=["3-MEDIUM", "1-URGENT"])
    return out.select(*P.KEY, ym("observation_month", "observation_month"), *_quotes6())


@query(
    "j3_o5_panel_with_quotes",
    f"""WITH {BRAND_MONTH_SQL}, {P.MONTHLY_SQL.strip()}
SELECT brand, {ym_sql('b.month')}, price_chf_mean, {_QUOTES} FROM brand_month b LEFT JOIN wide w ON w.month = b.month""",
)
def panel_with_quotes(spark, d):
    rows = panel.mean_panel(P.listings(spark, d), ["brand", "month"])
    out = panel.add_quotes(rows, monthly(spark, d).distinct())
    return out.select("brand", ym(), "price_chf_mean", *_quotes6())


# --- coverage and selection ---------------------------------------------------------------

COVERED_SQL = f"""{BRAND_MONTH_SQL}, {P.MONTHLY_SQL.strip()},
joined AS (SELECT b.*, w.* EXCLUDE (month), {' AND '.join(f'"{i}" IS NOT NULL' for i in P.INSTRUMENTS)} AS covered
  FROM brand_month b LEFT JOIN wide w ON w.month = b.month),
later AS (SELECT * FROM joined WHERE month >= DATE '{P.START}')"""


def _coverage_sql(rows: str) -> str:
    return f"""SELECT brand, CAST(sum(listing_count) AS BIGINT) AS listing_count_total, count(DISTINCT month) AS months_total,
  count(*) FILTER (WHERE covered) AS months_with_commodities, {ym_sql('min(month)', 'first_month')}, {ym_sql('max(month)', 'last_month')}
FROM {rows} GROUP BY 1"""


def covered_panel(spark, d, start=None):
    rows = panel.mean_panel(P.listings(spark, d), ["brand", "month"])
    if start:
        rows = panel.from_month(rows, start)
    return panel.add_quotes(rows, monthly(spark, d))


def _coverage(rows):
    out = panel.brand_coverage(rows, stats.all_present(P.INSTRUMENTS))
    return out.select(
        "brand", "listing_count_total", "months_total", "months_with_commodities",
        ym("first_month", "first_month"), ym("last_month", "last_month"),
    )


@query("g6_p16_brand_coverage", f"WITH {COVERED_SQL} {_coverage_sql('joined')}")
def brand_coverage(spark, d):
    return _coverage(covered_panel(spark, d))


@query("g6_p10_coverage_in_window", f"WITH {COVERED_SQL} {_coverage_sql('later')}")
def coverage_in_window(spark, d):
    return _coverage(covered_panel(spark, d, P.START))


SELECTED_SQL = f"""{COVERED_SQL},
selected AS (SELECT brand, count(*) FILTER (WHERE covered) AS months FROM later GROUP BY 1
  HAVING count(*) FILTER (WHERE covered) >= 10 ORDER BY months DESC, brand LIMIT 12)"""


@query("p13_o3_selected_brands", f"WITH {SELECTED_SQL} SELECT brand, months FROM selected")
def selected_brands(spark, d):
    rows = covered_panel(spark, d, P.START)
    out = brand_sensitivity.selected_brands(rows, P.INSTRUMENTS)
    return out.select("brand", F.col("months_with_commodities").alias("months"))


@query(
    "p14_j6_selected_panel",
    f"""WITH {SELECTED_SQL} SELECT brand, {ym_sql()}, price_chf_mean FROM later WHERE brand IN (SELECT brand FROM selected)""",
)
def selected_panel(spark, d):
    rows = covered_panel(spark, d, P.START)
    out = panel.only_brands(rows, brand_sensitivity.selected_brands(rows, P.INSTRUMENTS))
    return out.select("brand", ym(), "price_chf_mean")


@query(
    "g7_top_brands",
    f"WITH {P.LISTINGS_SQL} SELECT brand, count(*) AS listings FROM listings GROUP BY 1 ORDER BY listings DESC, brand LIMIT 10",
)
def top_brands(spark, d):
    return panel.top_brands(panel.mean_panel(P.listings(spark, d), ["brand", "month"]))


@query(
    "g8_o1_mean_price_by_brand",
    f"WITH {BRAND_MONTH_SQL} SELECT brand, {r6_sql('avg(price_chf_mean)', 'avg_price')} FROM brand_month WHERE month >= DATE '{P.START}' GROUP BY 1",
)
def mean_price_by_brand(spark, d):
    rows = panel.from_month(panel.mean_panel(P.listings(spark, d), ["brand", "month"]), P.START)
    return panel.mean_price_by_brand(rows).select("brand", r6("avg_price", "avg_price"))


@query(
    "o2_tail_months",
    f"WITH {P.MONTHLY_SQL} SELECT {ym_sql()}, {_QUOTES} FROM wide ORDER BY wide.month DESC LIMIT 10",
)
def tail_months(spark, d):
    from ferrocar.operators import profile

    return profile.tail_rows(monthly(spark, d), 10, "month").select(ym(), *_quotes6())


# --- correlations -------------------------------------------------------------------------

_LONG_SQL = f"""{SELECTED_SQL},
long AS (UNPIVOT (SELECT brand, month, price_chf_mean, {', '.join(f'"{i}"' for i in P.INSTRUMENTS)} FROM later
    WHERE brand IN (SELECT brand FROM selected))
  ON {', '.join(f'"{i}"' for i in P.INSTRUMENTS)} INTO NAME instrument VALUE quote)"""

BRAND_R_SQL = f"""{_LONG_SQL},
r AS (SELECT brand, instrument, {pearson_sql('price_chf_mean', 'quote')} AS r, count(*) AS n FROM long GROUP BY 1, 2)"""


@query("x9_s4_brand_sensitivity", f"WITH {BRAND_R_SQL} SELECT brand, instrument, {r6_sql('r', 'r')}, n FROM r")
def brand_sensitivity_query(spark, d):
    """Flagship: Pearson r of brand-month prices and each commodity."""
    rows = panel.mean_panel(P.listings(spark, d), ["brand", "month"])
    out = brand_sensitivity.correlations(rows, P.quotes(spark, d), P.INSTRUMENTS, P.START)
    return out.select("brand", "instrument", r6("r", "r"), "n")


@query(
    "o11_brand_matrix",
    f"""WITH {BRAND_R_SQL} SELECT brand, {', '.join(r6_sql(f"max(r) FILTER (WHERE instrument = '{i}')", f'"{i}"') for i in P.INSTRUMENTS)} FROM r GROUP BY 1""",
)
def brand_matrix(spark, d):
    rows = panel.mean_panel(P.listings(spark, d), ["brand", "month"])
    out = brand_sensitivity.correlations(rows, P.quotes(spark, d), P.INSTRUMENTS, P.START)
    return stats.segment_matrix(out, "brand", P.INSTRUMENTS).select("brand", *_quotes6())


@query(
    "s5_undefined_correlations",
    f"""WITH {P.LISTINGS_SQL}, {P.MONTHLY_SQL.strip()},
cells AS (SELECT brand, month, count(*) AS n, CASE WHEN brand IN ('Brand#1', 'Brand#2') THEN 1.0::DOUBLE ELSE avg(price_chf) END AS y FROM listings GROUP BY 1, 2),
r AS (SELECT brand, {pearson_sql('y', '"1-URGENT"')} AS r, count(*) FILTER (WHERE y IS NOT NULL AND "1-URGENT" IS NOT NULL) AS n FROM cells LEFT JOIN wide USING (month) GROUP BY 1)
SELECT brand, {r6_sql('r', 'r')}, n, CASE WHEN r IS NULL THEN CASE WHEN n < 3 THEN 'too few pairs' ELSE 'insufficient variation' END END AS reason FROM r""",
)
def undefined_correlations(spark, d):
    """Two brands get constant prices: their coefficient is missing, with the reason."""
    cells = P.listings(spark, d).groupBy("brand", "month").agg(F.avg("price_chf").alias("y"))
    flat = cells.withColumn("y", F.when(F.col("brand").isin("Brand#1", "Brand#2"), 1.0).otherwise(F.col("y")))
    joined = panel.add_quotes(flat, monthly(spark, d))
    out = joined.groupBy("brand").agg(
        stats.pearson(F.col("y"), F.col("`1-URGENT`")).alias("r"),
        stats.pair_count(F.col("y"), F.col("`1-URGENT`")).alias("n"),
    )
    return stats.with_reason(out).select("brand", r6("r", "r"), "n", "reason")


MARKET_SQL = f"""{P.LISTINGS_SQL}, {P.MONTHLY_SQL.strip()}, {P.WEIGHTS_SQL.strip()},
first_month AS (SELECT instrument, arg_min(close, month) AS base FROM monthly GROUP BY 1),
composite AS (SELECT month, CASE WHEN count(close) = 5 THEN sum(weight * (close / base * 100)) END AS composite_index
  FROM monthly JOIN first_month USING (instrument) JOIN weights USING (instrument) GROUP BY 1),
prices AS (SELECT month, quantile_cont(price_chf, 0.5) AS median_price, count(price_chf) AS car_count FROM listings GROUP BY 1),
market AS (SELECT * FROM prices LEFT JOIN composite USING (month) LEFT JOIN wide USING (month)),
mlong AS (UNPIVOT market ON composite_index, {', '.join(f'"{i}"' for i in P.INSTRUMENTS)} INTO NAME instrument VALUE v),
pear AS (SELECT instrument, {pearson_sql('median_price', 'v')} AS r, count(*) AS n FROM mlong GROUP BY 1),
ranks AS (SELECT instrument, rank() OVER (PARTITION BY instrument ORDER BY median_price)
    + (count(*) OVER (PARTITION BY instrument, median_price) - 1) / 2.0::DOUBLE AS rx,
  rank() OVER (PARTITION BY instrument ORDER BY v) + (count(*) OVER (PARTITION BY instrument, v) - 1) / 2.0::DOUBLE AS ry FROM mlong),
spear AS (SELECT instrument, {pearson_sql('rx', 'ry')} AS rho FROM ranks GROUP BY 1),
paired AS (SELECT instrument, r, rho, n FROM pear JOIN spear USING (instrument))"""


def market_table(spark, d):
    return market_index.month_table(P.listings(spark, d), P.quotes(spark, d), P.WEIGHTS)


@query(
    "s1_s2_market_correlations",
    f"""WITH {MARKET_SQL}
SELECT instrument, {r6_sql('r', 'r')}, {r6_sql(corr_p_sql('r', 'n'), 'p')}, {r6_sql('rho', 'rho')}, {r6_sql(corr_p_sql('rho', 'n'), 'rho_p')}, n FROM paired""",
)
def market_correlations(spark, d):
    out = market_index.price_correlations(market_table(spark, d), P.INSTRUMENTS)
    return out.select("instrument", *[r6(c, c) for c in ("r", "p", "rho", "rho_p")], "n")


@query(
    "w9_average_rank",
    f"""WITH {P.LISTINGS_SQL}, by_brand AS (SELECT brand, {ym_sql()}, round_even(avg(engine_power_hp) / 20, 0) AS bucket FROM listings GROUP BY brand, listings.month)
SELECT brand, month, rank() OVER (PARTITION BY brand ORDER BY bucket) + (count(*) OVER (PARTITION BY brand, bucket) - 1) / 2.0::DOUBLE AS rnk FROM by_brand""",
)
def average_rank(spark, d):
    from ferrocar.functions import numeric

    cells = P.listings(spark, d).groupBy("brand", ym()).agg(numeric.round_even(F.avg("engine_power_hp") / 20).alias("bucket"))
    return stats.average_rank(cells, ["brand"], "bucket", "rnk").select("brand", "month", "rnk")


@query(
    "s14_o4_run_summary",
    f"""WITH {MARKET_SQL}
SELECT (SELECT count(*) FROM prices) AS months, (SELECT CAST(sum(car_count) AS BIGINT) FROM prices) AS cars,
  {r6_sql("(SELECT r FROM paired WHERE instrument = 'composite_index')", 'composite_r')},
  {r6_sql("(SELECT rho FROM paired WHERE instrument = 'composite_index')", 'composite_rho')},
  instrument AS strongest, {r6_sql('r', 'strongest_r')}
FROM paired WHERE instrument <> 'composite_index' ORDER BY abs(r) DESC, instrument LIMIT 1""",
)
def run_summary(spark, d):
    from ferrocar.session import stage

    # The month table is read for its size and for both correlations: one row per month.
    table = stage(market_table(spark, d), "market")
    corr = stage(market_index.price_correlations(table, P.INSTRUMENTS), "market-r")
    out = market_index.run_summary(table, corr)
    return out.select(
        "months", "cars", r6("composite_r", "composite_r"), r6("composite_rho", "composite_rho"),
        "strongest", r6("strongest_r", "strongest_r"),
    )


@query(
    "s12_linear_fit",
    f"""WITH {MARKET_SQL}
SELECT {r6_sql('regr_slope(median_price, composite_index)', 'slope')}, {r6_sql('regr_intercept(median_price, composite_index)', 'intercept')},
  {r6_sql('min(composite_index)', 'x_min')}, {r6_sql('max(composite_index)', 'x_max')}, count(composite_index) AS n FROM market""",
)
def linear_fit(spark, d):
    out = stats.linear_fit(market_table(spark, d), "composite_index", "median_price")
    return out.select(*[r6(c, c) for c in ("slope", "intercept", "x_min", "x_max")], "n")


@query(
    "s12_fitted_line",
    f"""WITH {MARKET_SQL},
fit AS (SELECT regr_slope(median_price, composite_index) AS s, regr_intercept(median_price, composite_index) AS i,
  min(composite_index) AS a, max(composite_index) AS b FROM market)
SELECT CAST(k AS INTEGER) AS point, {r6_sql('a + k * ((b - a) / 199.0::DOUBLE)', 'x')}, {r6_sql('i + s * (a + k * ((b - a) / 199.0::DOUBLE))', 'y')}
FROM fit, range(0, 200) g(k)""",
)
def fitted_line(spark, d):
    fit = stats.linear_fit(market_table(spark, d), "composite_index", "median_price")
    return stats.fitted_line(fit).select("point", r6("x", "x"), r6("y", "y"))


# --- power modes --------------------------------------------------------------------------

REQUIRED = [P.ROLES["WTI"], P.ROLES["Lithium"]]

# Trimmed listings with English power modes and an observation month that has the quotes.
PREPARED_SQL = f"""{P.LISTINGS_SQL}, {P.MONTHLY_SQL.strip()},
bounds AS (SELECT quantile_cont(price_chf, 0.01) AS lo, quantile_cont(price_chf, 0.99) AS hi FROM listings),
prepared AS (SELECT l.* REPLACE (CASE power_mode WHEN 'Benzin' THEN 'Petrol' WHEN 'Diesel' THEN 'Diesel' WHEN 'Elektro' THEN 'Electric' END AS power_mode),
  CAST(DATE '{P.FIRST_MONTH}' + to_months(CAST(CAST('0x' || substr(md5({P.KEY_SQL}), 1, 8) AS BIGINT) % 67 AS INTEGER)) AS DATE) AS observation_month,
  ln(price_chf) AS log_price
  FROM listings l, bounds WHERE price_chf BETWEEN lo AND hi),
observed AS (SELECT p.*, w.* EXCLUDE (month) FROM prepared p JOIN wide w ON w.month = observation_month
  WHERE "3-MEDIUM" IS NOT NULL AND "1-URGENT" IS NOT NULL)"""


def prepared(spark, d):
    return power_mode.prepare(P.listings(spark, d), P.listing_key(), P.FIRST_MONTH, P.LAST_MONTH)


def observed(spark, d):
    return power_mode.observed(prepared(spark, d), monthly(spark, d), REQUIRED)


@query(
    "p11_price_trim",
    f"""WITH {P.LISTINGS_SQL}, bounds AS (SELECT quantile_cont(price_chf, 0.01) AS lo, quantile_cont(price_chf, 0.99) AS hi FROM listings)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price_chf FROM listings, bounds WHERE price_chf BETWEEN lo AND hi""",
)
def price_trim(spark, d):
    return panel.price_trim(P.listings(spark, d)).select(*P.KEY, "price_chf")


@query(
    "p11_price_trim_by_ranges",
    f"""WITH {P.LISTINGS_SQL}
SELECT brand, {r6_sql('quantile_cont(price_chf, 0.01)', 'p01')}, {r6_sql('quantile_cont(price_chf, 0.5)', 'p50')}, {r6_sql('quantile_cont(price_chf, 0.99)', 'p99')}
FROM listings GROUP BY 1""",
)
def price_trim_by_ranges(spark, d):
    """The bounds of each brand, over every listing."""
    out = exact_quantiles(P.listings(spark, d), ["brand"], "price_chf", [0.01, 0.5, 0.99], ["p01", "p50", "p99"])
    return out.select("brand", *[r6(c, c) for c in ("p01", "p50", "p99")])


@query(
    "g5_power_mode_descriptives",
    f"""WITH {PREPARED_SQL}
SELECT power_mode, count(price_chf) AS price_count, round_even(avg(price_chf) * 100, 0) / 100 AS price_mean,
  round_even(stddev_samp(price_chf) * 100, 0) / 100 AS price_std, round_even(min(price_chf) * 100, 0) / 100 AS price_min,
  round_even(max(price_chf) * 100, 0) / 100 AS price_max, round_even(avg(mileage) * 100, 0) / 100 AS mileage_mean,
  round_even(stddev_samp(mileage) * 100, 0) / 100 AS mileage_std, round_even(avg(engine_power_hp) * 100, 0) / 100 AS power_mean,
  round_even(stddev_samp(engine_power_hp) * 100, 0) / 100 AS power_std
FROM observed WHERE power_mode IS NOT NULL GROUP BY 1""",
)
def power_mode_descriptives(spark, d):
    return power_mode.descriptives(observed(spark, d))


@query(
    "s4_power_mode_correlations",
    f"""WITH {PREPARED_SQL},
long AS (UNPIVOT (SELECT power_mode, price_chf, {', '.join(f'"{i}"' for i in P.INSTRUMENTS)} FROM observed)
  ON {', '.join(f'"{i}"' for i in P.INSTRUMENTS)} INTO NAME instrument VALUE quote)
SELECT power_mode, instrument, {r6_sql(pearson_sql('price_chf', 'quote'), 'r')}, count(*) AS n FROM long GROUP BY 1, 2""",
)
def power_mode_correlations(spark, d):
    out = power_mode.price_correlations(observed(spark, d), monthly(spark, d), P.INSTRUMENTS)
    return out.select("power_mode", "instrument", r6("r", "r"), "n")


@query("o8_distinct_segments", f"WITH {PREPARED_SQL} SELECT DISTINCT power_mode FROM observed WHERE power_mode IS NOT NULL")
def distinct_segments(spark, d):
    return observed(spark, d).select("power_mode").where(F.col("power_mode").isNotNull()).distinct()


@query(
    "g23_removed_rows",
    f"""WITH {P.DIRTY_SQL}
SELECT count(*) AS before, count(power_mode) AS after, count(*) - count(power_mode) AS removed FROM dirty""",
)
def removed_rows(spark, d):
    from ferrocar.operators import profile

    return profile.removed_by(P.dirty_listings(spark, d), F.col("power_mode").isNotNull())
