import datetime as dt

from pyspark.sql import functions as F

from ferrocar import schema as S
from ferrocar.operators import profile, regression, series
from ferrocar.plans import brand_sensitivity
from ferrocar.sources import pages, readers, writers
from tests.conftest import SMALL
from workload import proxies as P

RAW = [("BMW X5, \"M\"\nPaket", "12900", "10", "150", "Benzin", "06.2024", "5.2", "Automat", "u"), ("Skoda", None, None, None, None, None, None, None, None)]


def test_raw_listings_round_trip(spark, tmp_path):
    df = spark.createDataFrame(RAW, S.LISTING_RAW)
    assert writers.write_raw_listings(df, str(tmp_path / "raw"))
    back = readers.read_raw_listings(spark, str(tmp_path / "raw"), multi_line=True)
    assert set(back.collect()) == set(df.na.fill("N/A").collect())
    typed = readers.read_listings(spark, str(tmp_path / "raw"), S.LISTING_COLUMNS, multi_line=True)
    assert {(r["car_model"], r["price_chf"], r["power_mode"]) for r in typed.collect()} == {(RAW[0][0], 12900.0, "Benzin"), ("Skoda", None, None)}


def test_empty_frame_writes_nothing(spark, tmp_path):
    assert not writers.write_raw_listings(spark.createDataFrame([], S.LISTING_RAW), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_missing_tokens_keep_dash_and_unknown(spark):
    df = spark.createDataFrame([(x,) for x in ["N/A", "", "NaN", "null", "-", "Unknown"]], "c string")
    assert [r[0] for r in readers.with_missing_tokens(df).collect()] == [None] * 4 + ["-", "Unknown"]


def test_curated_round_trip(spark, tmp_path):
    curated = pages.curate(spark.createDataFrame(RAW, S.LISTING_RAW))
    writers.write_curated(curated, str(tmp_path / "c"))
    back = readers.read_listings(spark, str(tmp_path / "c" / "csv"), multi_line=True)
    assert back.columns == S.CURATED_COLUMNS
    assert {(r["brand"], r["model"]) for r in back.collect()} == {("BMW", "X5,"), ("Skoda", None)}


def test_quote_dialects(spark, tmp_path):
    quotes = P.quotes(spark, SMALL).transform(series.with_monthly_average)
    writers.write_quotes(quotes, str(tmp_path / "q"), P.INSTRUMENTS)
    columns = writers.wide_quotes(quotes, P.INSTRUMENTS).columns
    back = readers.read_quotes(spark, str(tmp_path / "q"), columns)
    assert back.count() == quotes.select("date").distinct().count()
    first = back.orderBy("Date").first()
    assert isinstance(first["Date"], dt.date) and first["Month"] == first["Date"].strftime("%m-%Y")
    total = quotes.agg(F.sum("close")).first()[0]
    assert sum(back.agg(F.sum(f"`{i}_Spot`")).first()[0] for i in P.INSTRUMENTS) == total
    writers.write_clean_quotes(quotes, str(tmp_path / "k"), P.INSTRUMENTS)
    clean = readers.read_quotes(spark, str(tmp_path / "k"), columns, date_format="dd-MM-yyyy")
    assert set(clean.collect()) == set(back.collect())
    (tmp_path / "semi.csv").write_text("Date;WTI\n2020-01-02;1,5\n2020-01-03;\n")
    semi = readers.read_semicolon_quotes(spark, str(tmp_path / "semi.csv"), ["Date", "WTI"])
    assert [tuple(r) for r in semi.orderBy("Date").collect()] == [(dt.date(2020, 1, 2), 1.5), (dt.date(2020, 1, 3), None)]


def test_panel_is_pruned_by_year(spark, tmp_path):
    monthly = series.monthly_wide(series.monthly_mean(P.quotes(spark, SMALL)), P.INSTRUMENTS)
    master = brand_sensitivity.master(P.dirty_listings(spark, SMALL), monthly, P.NEW_VEHICLE_MONTH)
    writers.write_panel(master, str(tmp_path / "panel"), str(tmp_path / "csv"))
    back = spark.read.parquet(str(tmp_path / "panel"))
    assert back.count() == P.dirty_listings(spark, SMALL).count()
    plan = back.where("year >= 1999").select("price_chf")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<price_chf:double>" in plan
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == back.count()


def test_report(spark, tmp_path):
    coef = spark.createDataFrame([("a", "x", 1.5, 0.1, 15.0, 0.0, 1.3, 1.7), ("b", "x", 2.5, 0.1, 25.0, 0.0, 2.3, 2.7)], regression.COEFFICIENTS)
    fit = spark.createDataFrame([(s, 10, 1, 8, 0.5, 0.4, 3.0, 0.1, -1.0, 4.0, 5.0, 2.0) for s in "ab"], regression.FIT)
    writers.write_report(regression.report_lines("OLS", coef, fit), str(tmp_path / "r"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "r")).collect()]
    assert len(lines) == 4 and lines[0].startswith("OLS: a  n=10") and lines[3].startswith("x ")


def test_require_columns(spark):
    import pytest

    df = spark.range(1)
    assert profile.require_columns(df, ["id"]) is df
    assert profile.existing(df, ["x", "id"]) == ["id"] and profile.with_suffix(df, "d") == ["id"]
    with pytest.raises(ValueError, match="missing columns: x"):
        profile.require_columns(df, ["id", "x"])


def test_month_join_is_broadcast_and_scan_is_pruned(spark):
    from workload import QUERIES

    plan = QUERIES["g6_p10_coverage_in_window"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [month" in plan
    scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "ReadSchema: struct<l_partkey:bigint,l_shipdate:timestamp_ntz>" in scan
