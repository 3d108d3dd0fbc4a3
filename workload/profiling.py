"""Counts, completeness and summaries."""

from pyspark.sql import functions as F

from ferrocar import schema as S
from ferrocar.operators import profile, series
from workload import proxies as P
from workload.helpers import r6, r6_sql
from workload.quotes import dense
from workload.registry import query

COLUMNS = ["price_chf", "mileage", "power_mode", "production_date", "consumption_l_per_100km", "transmission"]


@query("g9_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark, d):
    return profile.value_counts(P.table(spark, d, "events"), "event_type")


@query(
    "g9_value_counts_with_null",
    f"WITH {P.DIRTY_SQL} SELECT power_mode, count(*) AS n FROM dirty GROUP BY 1",
)
def value_counts_with_null(spark, d):
    return profile.value_counts(P.dirty_listings(spark, d), "power_mode")


@query(
    "p7_value_counts_without_null",
    f"WITH {P.DIRTY_SQL} SELECT power_mode, count(*) AS n FROM dirty WHERE power_mode IS NOT NULL GROUP BY 1",
)
def value_counts_without_null(spark, d):
    return profile.value_counts(P.dirty_listings(spark, d), "power_mode", keep_null=False)


def _union(stat) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {stat(c)} FROM dirty" for c in COLUMNS)


@query(
    "g10_null_counts",
    f"WITH {P.DIRTY_SQL} {_union(lambda c: f'count(*) - count({c}) AS nulls')}",
)
def null_counts(spark, d):
    return profile.null_counts(P.dirty_listings(spark, d), COLUMNS)


@query(
    "g11_completeness",
    f"WITH {P.DIRTY_SQL} {_union(lambda c: r6_sql(f'count({c}) / count(*) * 100.0::DOUBLE', 'pct'))}",
)
def completeness(spark, d):
    return profile.completeness(P.dirty_listings(spark, d), COLUMNS).select("column", r6("pct", "pct"))


@query(
    "g12_describe_quotes",
    f"""WITH {P.DENSE_SQL}
SELECT instrument, count(close) AS count, {r6_sql('avg(close)', 'mean')}, {r6_sql('stddev_samp(close)', 'std')}, {r6_sql('min(close)', 'min')},
  {r6_sql('quantile_cont(close, 0.25)', 'p25')}, {r6_sql('quantile_cont(close, 0.5)', 'p50')}, {r6_sql('quantile_cont(close, 0.75)', 'p75')},
  {r6_sql('max(close)', 'max')} FROM dense GROUP BY 1""",
)
def describe_quotes(spark, d):
    out = profile.describe_series(dense(spark, d), ["instrument"], "close")
    return out.select("instrument", "count", *[r6(c, c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@query("g17_date_range", "SELECT CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last FROM orders")
def date_range(spark, d):
    orders = P.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    return profile.date_range(orders, "day")


@query(
    "p2_p4_column_selection",
    f"""WITH {P.LISTINGS_SQL}
SELECT count(price_chf) AS price_chf, count(mileage) AS mileage, count(engine_power_hp) AS engine_power_hp,
  count(consumption_l_per_100km) AS consumption_l_per_100km FROM listings""",
)
def column_selection(spark, d):
    """Of the columns asked for, those that exist and are numbers."""
    df = P.listings(spark, d)
    wanted = [*S.CONTINUOUS, "power_mode", "vat"]
    numbers = profile.numeric_columns(df.select(*profile.existing(df, wanted)))
    return df.agg(*[F.count(c).alias(c) for c in numbers])


@query(
    "g10_quote_gaps_before_after",
    f"""WITH {P.DENSE_SQL},
seen AS (SELECT instrument, min(date) AS first FROM quotes GROUP BY 1)
SELECT instrument, count(*) - count(close) AS before, count(*) FILTER (WHERE date < first) AS after FROM dense JOIN seen USING (instrument) GROUP BY 1""",
)
def quote_gaps(spark, d):
    filled = series.trailing_fill(dense(spark, d))
    return filled.groupBy("instrument").agg(
        F.count_if(F.col("close").isNull()).alias("before"), F.count_if(F.col("filled").isNull()).alias("after")
    )
