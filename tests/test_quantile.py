import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ferrocar.operators import quantile
from ferrocar.operators.panel import price_panel, price_trim
from ferrocar.operators.quantile import exact_quantiles
from ferrocar.session import stage

PROBS = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
NAMES = [f"q{i}" for i in range(len(PROBS))]


def brute(rows):
    out = {}
    for k in {r[0] for r in rows if r[0] is not None}:
        vals = [r[1] for r in rows if r[0] == k and r[1] is not None]
        if vals:
            out[k] = np.quantile(vals, PROBS)
    return out


def radix(df, keys, value, probs, names):
    return quantile.radix_quantiles(quantile.count_values(df, keys, value), keys, value, probs, names)


def compare(spark, rows, select=exact_quantiles):
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: [r[n] for n in NAMES] for r in select(df, ["k"], "v", PROBS, NAMES).collect()}
    expected = brute(rows)
    assert got.keys() == expected.keys()
    for k in got:
        assert got[k] == pytest.approx(list(expected[k]))


def hot_rows():
    rng = np.random.default_rng(5)
    rows = [("hot", float(v)) for v in rng.random(20_000)] + [("hot", 1e13)]
    rows += [(f"g{i % 9}", float(v)) for i, v in enumerate(rng.normal(50, 20, 500))]
    return rows + [("one", 4.0), ("none", None), (None, 3.0), ("flat", 2.0), ("flat", 2.0)]


def test_against_numpy_with_a_hot_group_and_an_outlier(spark):
    compare(spark, hot_rows())


def test_no_task_holds_more_than_its_share(spark, monkeypatch):
    staged = {}

    def keep(df, label):
        staged[label] = stage(df, label)
        return staged[label]

    monkeypatch.setattr(quantile, "stage", keep)
    # Parts are not put together, as they would be for so few rows.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compare(spark, hot_rows())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in staged["sorted-counts"].groupBy("_part").count().collect()]
    assert len(sizes) >= 3 and max(sizes) < 2 * sum(sizes) / len(sizes)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_selection_property(spark, rows):
    compare(spark, rows)


def test_trim_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 102)] + [(None,)], "price_chf double")
    kept = sorted(r[0] for r in price_trim(df).collect())
    assert kept == [float(i) for i in range(2, 101)]


def test_panel_counts_priced_and_all_rows(spark):
    rows = [("a", 1.0, 5.0), ("a", 3.0, None), ("a", None, 7.0), (None, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "k string, price_chf double, km double")
    got = price_panel(df, ["k"], ["km"]).collect()
    assert [tuple(r) for r in got] == [("a", 2.0, 2, 3, 6.0, 2.0)]


def test_radix_against_numpy_with_a_hot_group_and_an_outlier(spark):
    compare(spark, hot_rows(), radix)


def test_radix_on_raw_rows_extreme_values_and_ties(spark):
    rows = [("a", v) for v in (0.0, -0.0, 5e-324, -5e-324, 1e300, -1e300, 0.1, 0.1, 0.1, 2.0)] + [("b", 7.0)] * 5
    df = spark.createDataFrame(rows, "k string, v double").withColumn("n", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1))
    got = {r["k"]: [r[n] for n in NAMES] for r in quantile.radix_quantiles(df, ["k"], "v", PROBS, NAMES).collect()}
    expected = brute(rows)
    assert got.keys() == expected.keys()
    for k in got:
        assert got[k] == pytest.approx(list(expected[k]), rel=1e-12, abs=1e-300)


def test_radix_stages_no_sorted_copy(spark, monkeypatch):
    staged = []

    def keep(df, label):
        staged.append(label)
        return stage(df, label)

    monkeypatch.setattr(quantile, "stage", keep)
    compare(spark, hot_rows(), radix)
    assert "sorted-counts" not in staged and staged.count("value-counts") == 1


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_radix_selection_property(spark, rows):
    compare(spark, rows, radix)
