import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ferrocar.operators import series, stats
from ferrocar.plans import quote_profile
from ferrocar.sources import readers


def day(i):
    return dt.date(2020, 1, 1) + dt.timedelta(days=i)


def frame(spark, **columns):
    rows = [(day(i), name, v) for name, values in columns.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date date, instrument string, close double")


def values(df, column, name="a"):
    return [r[0] for r in df.where(F.col("instrument") == name).orderBy("date").select(column).collect()]


def test_trailing_fill_small(spark):
    df = series.trailing_fill(frame(spark, a=[None, 10.0, None, 20.0, None, None]))
    assert values(df, "filled") == [None, 10, 10, 20, 15, 15]


def test_trailing_fill_matches_a_plain_loop(spark):
    rng = random.Random(3)
    data = [None if rng.random() < 0.4 else float(rng.randint(1, 99)) for _ in range(300)]
    expected, seen = [], []
    for v in data:
        if v is None:
            expected.append(sum(seen[-7:]) / len(seen[-7:]) if seen else None)
        else:
            seen.append(v)
            expected.append(v)
    assert values(series.trailing_fill(frame(spark, a=data)), "filled") == pytest.approx(expected)


def test_index(spark):
    df = quote_profile.indexed(frame(spark, a=[None, 50.0, 75.0], z=[0.0, 5.0, 6.0], n=[None, None, None]))
    assert values(df, "indexed") == [None, 100, 150]
    assert values(df, "indexed", "z") == [0, 5, 6]
    assert values(df, "indexed", "n") == [None] * 3


def test_returns_padding_and_zero(spark):
    df = frame(spark, a=[10.0, None, 15.0, 0.0, 3.0])
    assert values(series.returns(df), "ret") == pytest.approx([None, 0.0, 0.5, -1.0, None])
    assert values(series.returns(df, pad=False), "ret") == pytest.approx([None, None, None, -1.0, None])


def test_volatility_guard(spark):
    rows = [(day(i), "few", 0.1 * i) for i in range(9)] + [(day(i), "many", 0.01 * (i % 5)) for i in range(20)]
    rows.append((day(30), "many", 9.0))
    rets = spark.createDataFrame(rows, "date date, instrument string, ret double")
    got = {r["instrument"]: r for r in series.volatility(rets).collect()}
    assert got["few"]["mean_pct"] is None and got["few"]["n"] == 9 and got["few"]["removed"] == 0
    assert got["many"]["removed"] == 1 and got["many"]["n"] == 20


def test_sample_moments(spark):
    from ferrocar.functions import numeric

    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    got = df.agg(numeric.sample_skewness(F.col("x")), numeric.sample_kurtosis(F.col("x"))).first()
    assert got[0] == pytest.approx(1.7636, abs=1e-4) and got[1] == pytest.approx(3.228, abs=1e-3)


def test_adjusted_close_only_where_no_close(spark):
    rows = [(day(0), "CL=F", "Adj Close", 5.0), (day(0), "XX", "Adj Close", 1.0), (day(-9), "CL=F", "Adj Close", 2.0)]
    feed = spark.createDataFrame(rows, "date date, ticker string, field string, value double")
    assert [(r["instrument"], r["close"]) for r in readers.quotes_from_ohlc(feed).collect()] == [("WTI", 5.0)]
    both = feed.unionByName(spark.createDataFrame([(day(1), "CL=F", "Close", 7.0)], feed.schema))
    assert [r["close"] for r in readers.quotes_from_ohlc(both).collect()] == [7.0]


def test_composite_needs_every_series(spark):
    rows = [(day(0), "a", 2.0), (day(0), "b", 4.0), (day(40), "a", 3.0)]
    monthly = series.monthly_mean(spark.createDataFrame(rows, "date date, instrument string, close double"))
    got = {str(r["month"]): r["composite_index"] for r in series.composite_index(monthly, {"a": 0.5, "b": 0.5}).collect()}
    assert got == {"2020-01-01": 100.0, "2020-02-01": None}


def test_rebase_falls_back_to_first_month(spark):
    df = spark.createDataFrame([(dt.date(2020, 3, 1), 50.0), (dt.date(2020, 4, 1), 75.0)], "month date, v double")
    got = series.rebase_at(df, "v", "2020-01-01", "x").orderBy("month").collect()
    assert [r["x"] for r in got] == [100, 150]


def test_correlation_matrix_is_symmetric(spark):
    df = frame(spark, a=[1.0, 2.0, 4.0, 3.0], b=[2.0, 1.0, 5.0, None], c=[1.0, 1.0, 1.0, 1.0])
    got = {(r["a"], r["b"]): r["r"] for r in stats.correlation_matrix(series.to_wide(df, ["a", "b", "c"]), ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got[("a", "a")] is None and got[("a", "c")] is None
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(0.8386, abs=1e-4)


def test_clean_quotes_keeps_or_recomputes_the_average(spark):
    df = frame(spark, a=[10.0, None, 40.0])
    assert values(quote_profile.clean_quotes(df), "monthly_avg") == [25.0] * 3
    assert values(quote_profile.clean_quotes(df, recompute=True), "monthly_avg") == [20.0] * 3


def test_bounded_statistics_need_no_python(spark):
    df = frame(spark, a=[1.0, 2.0, 3.0])
    plan = series.volatility(series.returns(df))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
