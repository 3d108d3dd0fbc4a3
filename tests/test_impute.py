import datetime as dt

import numpy as np
import pandas as pd
import pytest

from ferrocar.operators import impute

SCHEMA = (
    "id int, brand string, model string, price_chf double, mileage double, engine_power_hp double, power_mode string,"
    " transmission string, production_date date, consumption_l_per_100km double"
)


def typed(spark, rows):
    from pyspark.sql import functions as F

    from ferrocar.functions import dates

    return spark.createDataFrame(rows, SCHEMA).withColumn("month", dates.month_of(F.col("production_date")))


def make_rows(seed, n=400):
    rng = np.random.default_rng(seed)

    def maybe(v, p):
        return None if rng.random() < p else v

    rows = []
    for i in range(n):
        brand, model = f"B{rng.integers(0, 6)}", f"M{rng.integers(0, 8)}"
        # Whole models and brands without values, so that every level is reached.
        cons = None if model in ("M1", "M2") or brand == "B4" else maybe(float(rng.integers(3, 12)), 0.4)
        date = None if model in ("M5", "M6") or brand == "B3" else maybe(dt.date(2015 + int(rng.integers(0, 8)), int(rng.integers(1, 13)), 1), 0.3)
        rows.append((
            i, maybe(brand, 0.03), maybe(model, 0.03), maybe(float(rng.integers(1000, 90000)) + 0.5, 0.1),
            maybe(float(rng.integers(0, 300000)), 0.1), maybe(float(rng.integers(60, 400)), 0.1),
            maybe(str(rng.choice(["Benzin", "Diesel", "Elektro"])), 0.2), maybe(str(rng.choice(["Automat", "Manuell"])), 0.2), date, cons,
        ))
    return rows


def level_by_level(rows):
    """The levels one after the other on the whole table."""
    df = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
    for c in ("price_chf", "mileage", "engine_power_hp"):
        df[c] = df[c].fillna(df[c].mean()).round(0)
    cons = "consumption_l_per_100km"
    overall = df[cons].mean()
    df.loc[df[cons].isna() & (df.power_mode == "Elektro"), cons] = 0.0
    for key in ("model", "brand"):
        df[cons] = df[cons].fillna(df[key].map(df.groupby(key)[cons].mean()))
    df[cons] = df[cons].fillna(overall).round(2)
    for c in ("power_mode", "transmission"):
        modes = df.dropna(subset=[c]).groupby("model")[c].agg(lambda x: x.mode().iat[0])
        df[c] = df[c].fillna(df["model"].map(modes)).fillna("Unknown")
    df["production_date"] = pd.to_datetime(df["production_date"])
    for key in ("model", "brand"):
        seen = df.dropna(subset=["production_date"])
        df["production_date"] = df["production_date"].fillna(df[key].map(seen.groupby(key)["production_date"].median()))
    df["month"] = df["production_date"].dt.to_period("M")
    for key in ("model", "brand"):
        seen = df.dropna(subset=["month"])
        modes = seen.groupby(key)["month"].agg(lambda x: x.mode().iat[0])
        df["month"] = df["month"].fillna(df[key].map(modes))
    return df


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_level_by_level(spark, seed):
    rows = make_rows(seed)
    got = {r["id"]: r for r in impute.impute(typed(spark, rows)).collect()}
    for want in level_by_level(rows).itertuples():
        r = got[want.id]
        for c in ("price_chf", "mileage", "engine_power_hp", "consumption_l_per_100km", "power_mode", "transmission"):
            assert r[c] == getattr(want, c), (c, want)
        assert (r["production_date"] is None) == pd.isna(want.production_date)
        if r["production_date"] is not None:
            assert r["production_date"] == want.production_date.date()
        assert (r["month"] is None) == pd.isna(want.month)
        if r["month"] is not None:
            assert r["month"].strftime("%Y-%m") == str(want.month)


def test_unknown_power_mode_is_not_electric(spark):
    rows = [(1, "a", "m", 1.0, 1.0, 1.0, "Elektro", "x", None, None), (2, "a", "m", 1.0, 1.0, 1.0, None, "x", None, None), (3, "a", "n", 1.0, 1.0, 1.0, "Benzin", "x", None, 8.0)]
    got = {r["id"]: r for r in impute.impute(typed(spark, rows)).collect()}
    assert got[1]["fill_source"] == "electric" and got[2]["fill_source"] == "model"
    assert got[2]["consumption_l_per_100km"] == 0.0 and got[2]["power_mode"] == "Elektro"
    assert got[2]["month"] is None


def test_mode_tie_takes_the_smallest(spark):
    rows = [(i, "a", "m", 1.0, 1.0, 1.0, p, None, None, 1.0) for i, p in enumerate(["Diesel", "Benzin", None])]
    got = {r["id"]: r for r in impute.impute(typed(spark, rows)).collect()}
    assert got[2]["power_mode"] == "Benzin" and got[2]["transmission"] == "Unknown"


def test_lookup_join_broadcasts_by_size_only(spark):
    df = typed(spark, make_rows(3, 50))
    fills = impute.learn_fills(df)

    def plan():
        return impute.impute(df, fills)._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan() and "BroadcastHashJoin" not in plan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_plan_closes_over_the_levels():
    assert impute.plan(impute.MEAN_FILLED) == {"overall"}
    assert impute.plan(["power_mode"]) == {"power_mode_fill"}
    assert impute.plan(["month"]) == {"day_model", "day_brand", "month_model", "month_brand"}
    assert impute.plan(["fill_source"]) == {"cons_model", "cons_brand", "overall"}
    assert impute.plan(None) == set(impute.NEEDS)


@pytest.mark.parametrize(
    "columns, groups",
    [
        (impute.MEAN_FILLED, []),
        (["power_mode", "transmission"], ["listing-cells", "fills"]),
        ([impute.CONSUMPTION, "fill_source"], ["listing-cells", "models", "fills"]),
        (["price_chf", "month"], ["listing-cells", "models", "brands", "months", "fills"]),
    ],
)
def test_only_asked_levels_are_learnt_and_equal_the_full_plan(spark, monkeypatch, columns, groups):
    rows = typed(spark, make_rows(11))
    full = {r.id: r for r in impute.impute(rows).collect()}
    staged = []
    real = impute.stage

    def counting(df, label):
        staged.append(label)
        return real(df, label)

    monkeypatch.setattr(impute, "stage", counting)
    part = impute.impute(rows, columns=columns)
    got = {r.id: r for r in part.collect()}
    monkeypatch.setattr(impute, "stage", real)
    # Cells are staged by listing_cells through the module's stage too.
    assert sorted(staged) == sorted(groups)
    original = {r.id: r for r in rows.collect()}
    for i, r in got.items():
        for c in columns:
            assert r[c] == full[i][c], (c, i)
        for c in set(impute.OUTPUTS) - set(columns) - {"fill_source"}:
            assert r[c] == original[i][c], (c, i)
