"""Imputation levels and the merged listings."""

from pyspark.sql import functions as F

from ferrocar.operators import impute, panel
from ferrocar.plans import brand_sensitivity
from workload import proxies as P
from workload.helpers import pearson_sql, r6, r6_sql, ym, ym_sql
from workload.panels import monthly
from workload.registry import query

# The levels one after the other, each over the rows as the level before left them.
TYPED_SQL = f"""{P.SPARSE_SQL},
typed AS (SELECT * REPLACE (CAST(try_strptime(CASE WHEN production_date = 'Neues Fahrzeug' THEN '{P.NEW_VEHICLE_MONTH}'
    ELSE production_date END, '%m.%Y') AS DATE) AS production_date) FROM sparse)"""

STAGED_SQL = f"""{TYPED_SQL},
means AS (SELECT avg(price_chf) AS p, avg(mileage) AS m, avg(engine_power_hp) AS h, avg(consumption_l_per_100km) AS c FROM typed),
c0 AS (SELECT t.* EXCLUDE (price_chf, mileage, engine_power_hp), round_even(coalesce(price_chf, p), 0) AS price_chf,
    round_even(coalesce(mileage, m), 0) AS mileage, round_even(coalesce(engine_power_hp, h), 0) AS engine_power_hp,
    coalesce(consumption_l_per_100km, CASE WHEN power_mode = 'Elektro' THEN 0.0::DOUBLE END) AS v1,
    CASE WHEN consumption_l_per_100km IS NOT NULL THEN 'observed' WHEN power_mode = 'Elektro' THEN 'electric' END AS s1, c
  FROM typed t, means),
model_mean AS (SELECT model, avg(v1) AS mm FROM c0 WHERE model IS NOT NULL GROUP BY 1),
c1 AS (SELECT c0.*, coalesce(v1, mm) AS v2, coalesce(s1, CASE WHEN mm IS NOT NULL THEN 'model' END) AS s2 FROM c0 LEFT JOIN model_mean USING (model)),
brand_mean AS (SELECT brand, avg(v2) AS bm FROM c1 WHERE brand IS NOT NULL GROUP BY 1),
c2 AS (SELECT c1.*, coalesce(v2, bm, c) AS v3, coalesce(s2, CASE WHEN bm IS NOT NULL THEN 'brand' WHEN c IS NOT NULL THEN 'overall' ELSE 'missing' END) AS fill_source
  FROM c1 LEFT JOIN brand_mean USING (brand)),
pm AS (SELECT model, power_mode AS pm_fill FROM (SELECT model, power_mode, row_number() OVER (PARTITION BY model ORDER BY count(*) DESC, power_mode) AS k
  FROM typed WHERE model IS NOT NULL AND power_mode IS NOT NULL GROUP BY 1, 2) WHERE k = 1),
tr AS (SELECT model, transmission AS tr_fill FROM (SELECT model, transmission, row_number() OVER (PARTITION BY model ORDER BY count(*) DESC, transmission) AS k
  FROM typed WHERE model IS NOT NULL AND transmission IS NOT NULL GROUP BY 1, 2) WHERE k = 1),
c3 AS (SELECT c2.* EXCLUDE (power_mode, transmission, consumption_l_per_100km), round_even(v3 * 100, 0) / 100 AS consumption_l_per_100km,
    coalesce(power_mode, pm_fill, 'Unknown') AS power_mode, coalesce(transmission, tr_fill, 'Unknown') AS transmission,
    CAST(production_date - DATE '1970-01-01' AS DOUBLE) AS d0
  FROM c2 LEFT JOIN pm USING (model) LEFT JOIN tr USING (model)),
model_date AS (SELECT model, quantile_cont(d0, 0.5) AS md FROM c3 WHERE model IS NOT NULL GROUP BY 1),
c4 AS (SELECT c3.*, coalesce(d0, md) AS d1 FROM c3 LEFT JOIN model_date USING (model)),
brand_date AS (SELECT brand, quantile_cont(d1, 0.5) AS bd FROM c4 WHERE brand IS NOT NULL GROUP BY 1),
c5 AS (SELECT c4.*, coalesce(d1, bd) AS d2, CAST(date_trunc('month', DATE '1970-01-01' + CAST(floor(coalesce(d1, bd)) AS INTEGER)) AS DATE) AS m1
  FROM c4 LEFT JOIN brand_date USING (brand)),
model_month AS (SELECT model, m1 AS mm1 FROM (SELECT model, m1, row_number() OVER (PARTITION BY model ORDER BY count(*) DESC, m1) AS k
  FROM c5 WHERE model IS NOT NULL AND m1 IS NOT NULL GROUP BY 1, 2) WHERE k = 1),
c6 AS (SELECT c5.*, coalesce(m1, mm1) AS m2 FROM c5 LEFT JOIN model_month USING (model)),
brand_month_fill AS (SELECT brand, m2 AS bm2 FROM (SELECT brand, m2, row_number() OVER (PARTITION BY brand ORDER BY count(*) DESC, m2) AS k
  FROM c6 WHERE brand IS NOT NULL AND m2 IS NOT NULL GROUP BY 1, 2) WHERE k = 1),
imputed AS (SELECT c6.* EXCLUDE (production_date), CAST(DATE '1970-01-01' + CAST(floor(d2) AS INTEGER) AS DATE) AS production_date,
    coalesce(m2, bm2) AS month
  FROM c6 LEFT JOIN brand_month_fill USING (brand))"""

KEY = ", ".join(P.KEY)


def imputed(spark, d, columns=None):
    """Listings with the gaps of ``columns`` filled; only the levels that they need are learnt."""
    return impute.impute(impute.type_listings(P.sparse_listings(spark, d), P.NEW_VEHICLE_MONTH), columns=columns)


@query("x2_mean_imputation", f"WITH {STAGED_SQL} SELECT {KEY}, price_chf, mileage, engine_power_hp FROM imputed")
def mean_imputation(spark, d):
    return imputed(spark, d, impute.MEAN_FILLED).select(*P.KEY, "price_chf", "mileage", "engine_power_hp")


@query(
    "x4_j4_consumption_levels",
    f"WITH {STAGED_SQL} SELECT {KEY}, consumption_l_per_100km, fill_source FROM imputed",
)
def consumption_levels(spark, d):
    return imputed(spark, d, [impute.CONSUMPTION, "fill_source"]).select(*P.KEY, "consumption_l_per_100km", "fill_source")


@query("x5_categorical_levels", f"WITH {STAGED_SQL} SELECT {KEY}, power_mode, transmission FROM imputed")
def categorical_levels(spark, d):
    return imputed(spark, d, ["power_mode", "transmission"]).select(*P.KEY, "power_mode", "transmission")


@query("x6_date_levels", f"WITH {STAGED_SQL} SELECT {KEY}, production_date, {ym_sql()} FROM imputed")
def date_levels(spark, d):
    return imputed(spark, d, ["production_date", "month"]).select(*P.KEY, "production_date", ym())


@query("g22_fill_audit", f"WITH {STAGED_SQL} SELECT fill_source, count(*) AS n FROM imputed GROUP BY 1")
def fill_audit(spark, d):
    return impute.fill_audit(imputed(spark, d, ["fill_source"]))


def typed(spark, d):
    return impute.type_listings(P.sparse_listings(spark, d), P.NEW_VEHICLE_MONTH)


@query(
    "g14_consumption_means",
    f"""WITH {STAGED_SQL},
pairs AS (SELECT DISTINCT brand, model FROM typed)
SELECT brand, model, {r6_sql('mm', 'model_mean')}, {r6_sql('bm', 'brand_mean')} FROM pairs LEFT JOIN model_mean USING (model) LEFT JOIN brand_mean USING (brand)""",
)
def consumption_means(spark, d):
    out = impute.learn_fills(typed(spark, d), impute.plan([impute.CONSUMPTION]) - {"overall"}).pairs
    return out.select("brand", "model", r6("cons_model", "model_mean"), r6("cons_brand", "brand_mean"))


@query(
    "g13_model_modes",
    f"WITH {STAGED_SQL} SELECT model, pm_fill AS power_mode, tr_fill AS transmission FROM pm JOIN tr USING (model)",
)
def model_modes(spark, d):
    pairs = impute.learn_fills(typed(spark, d), impute.plan(["power_mode", "transmission"])).pairs.where(F.col("model").isNotNull())
    return pairs.select("model", F.col("power_mode_fill").alias("power_mode"), F.col("transmission_fill").alias("transmission")).distinct()


@query(
    "g15_g16_date_fills",
    f"""WITH {STAGED_SQL},
pairs AS (SELECT DISTINCT brand, model FROM typed)
SELECT brand, model, md AS model_day, bd AS brand_day, {ym_sql('mm1', 'model_month')}, {ym_sql('bm2', 'brand_month')}
FROM pairs LEFT JOIN model_date USING (model) LEFT JOIN brand_date USING (brand) LEFT JOIN model_month USING (model)
  LEFT JOIN brand_month_fill USING (brand)""",
)
def date_fills(spark, d):
    out = impute.learn_fills(typed(spark, d), impute.plan(["production_date", "month"])).pairs
    return out.select(
        "brand", "model", F.col("day_model").alias("model_day"), F.col("day_brand").alias("brand_day"),
        ym("month_model", "model_month"), ym("month_brand", "brand_month"),
    )


_QUOTES = ", ".join(r6_sql(f'"{i}"', f'"{i}"') for i in P.INSTRUMENTS)


@query(
    "x8_k4_master_listings",
    f"""WITH {STAGED_SQL}, {P.MONTHLY_SQL.strip()}
SELECT {KEY}, brand, model, {ym_sql('i.month')}, price_chf, consumption_l_per_100km, power_mode, {_QUOTES}
FROM imputed i LEFT JOIN wide w ON w.month = i.month""",
)
def master_listings(spark, d):
    out = brand_sensitivity.master(P.sparse_listings(spark, d), monthly(spark, d), P.NEW_VEHICLE_MONTH)
    return out.select(
        *P.KEY, "brand", "model", ym(), "price_chf", "consumption_l_per_100km", "power_mode",
        *[r6(f"`{i}`", i) for i in P.INSTRUMENTS],
    )


IMPUTED_R_SQL = f"""{STAGED_SQL}, {P.MONTHLY_SQL.strip()},
brand_month AS (SELECT brand, month, round_even(avg(price_chf), 0) AS price_chf_mean FROM imputed
  WHERE brand IS NOT NULL AND month IS NOT NULL GROUP BY 1, 2),
later AS (SELECT b.*, w.* EXCLUDE (month), {' AND '.join(f'"{i}" IS NOT NULL' for i in P.INSTRUMENTS)} AS covered
  FROM brand_month b LEFT JOIN wide w ON w.month = b.month WHERE b.month >= DATE '{P.START}'),
selected AS (SELECT brand, count(*) FILTER (WHERE covered) AS months FROM later GROUP BY 1
  HAVING count(*) FILTER (WHERE covered) >= 10 ORDER BY months DESC, brand LIMIT 12),
long AS (UNPIVOT (SELECT brand, month, price_chf_mean, {', '.join(f'"{i}"' for i in P.INSTRUMENTS)} FROM later
    WHERE brand IN (SELECT brand FROM selected))
  ON {', '.join(f'"{i}"' for i in P.INSTRUMENTS)} INTO NAME instrument VALUE quote),
r AS (SELECT brand, instrument, {pearson_sql('price_chf_mean', 'quote')} AS r, count(*) AS n FROM long GROUP BY 1, 2)"""


@query("x9_imputed_brand_sensitivity", f"WITH {IMPUTED_R_SQL} SELECT brand, instrument, {r6_sql('r', 'r')}, n FROM r")
def imputed_brand_sensitivity(spark, d):
    """The whole path: dirty listings, imputation, panel, coverage, correlation."""
    rows = panel.mean_panel(imputed(spark, d, ["price_chf", "month"]), ["brand", "month"])
    out = brand_sensitivity.correlations(rows, P.quotes(spark, d), P.INSTRUMENTS, P.START)
    return out.select("brand", "instrument", r6("r", "r"), "n")
