"""Text, date and number rules."""

from pyspark.sql import functions as F

from ferrocar import schema as S
from ferrocar.functions import dates, html, numeric, text
from ferrocar.operators import profile
from workload import proxies as P
from workload.helpers import big, r6, r6_sql, ym, ym_sql
from workload.registry import query


def _case_any(column: str, classes) -> str:
    tests = []
    for name, words in classes:
        hit = " OR ".join(f"contains({column}, '{w}')" for w in words)
        tests.append(f"WHEN {hit} THEN '{name}'")
    return " ".join(tests)


@query(
    "c1_fuel_class",
    f"""WITH {P.VEHICLES_SQL}
SELECT p_partkey, CASE {_case_any('lower(fuel)', S.FUEL_CLASSES)} END AS fuel_class FROM vehicles""",
)
def fuel_class(spark, d):
    return P.vehicles(spark, d).select("p_partkey", text.fuel_class(F.col("fuel")).alias("fuel_class"))


@query(
    "c2_transmission_class",
    f"""WITH {P.VEHICLES_SQL}
SELECT p_partkey, CASE WHEN gearbox IN ('', '-', '—') THEN NULL
  {_case_any('lower(trim(gearbox))', S.TRANSMISSION_CLASSES)} ELSE substr(trim(gearbox), 1, 20) END AS transmission
FROM vehicles""",
)
def transmission_class(spark, d):
    return P.vehicles(spark, d).select("p_partkey", text.transmission_class(F.col("gearbox")).alias("transmission"))


def _brand_case() -> str:
    tests = []
    for b in S.BRANDS:
        tests.append(f"WHEN regexp_matches(car_model, '^{b}\\s+', 'i') THEN '{b}'")
    return " ".join(tests)


# The brand's length is that of its spelling, so the rest of the name starts after it.
CURATED_SQL = f"""{P.VEHICLES_SQL},
named AS (
  SELECT *, CASE {_brand_case()} END AS known FROM vehicles),
split AS (
  SELECT *,
    CASE WHEN car_model = 'N/A' THEN NULL ELSE coalesce(known, regexp_extract(car_model, '\\S+')) END AS brand,
    CASE WHEN car_model = 'N/A' THEN NULL
         WHEN known IS NOT NULL THEN trim(substr(car_model, length(known) + 1))
         ELSE trim(regexp_replace(car_model, '^\\s*\\S+\\s*', '')) END AS rest
  FROM named),
modelled AS (
  SELECT *,
    CASE WHEN rest IS NULL OR rest = '' THEN NULL
         WHEN regexp_matches(regexp_split_to_array(rest, '[\\s\\-]+')[2], '^\\d')
           THEN regexp_split_to_array(rest, '[\\s\\-]+')[1] || ' ' || regexp_split_to_array(rest, '[\\s\\-]+')[2]
         ELSE regexp_split_to_array(rest, '[\\s\\-]+')[1] END AS base_model
  FROM split),
curated AS (
  SELECT *, CASE {' '.join(f"WHEN contains(car_model, '{part}') THEN '{name}'" for part, name in S.MODEL_NAMES)}
    ELSE base_model END AS model
  FROM modelled)"""


@query("c3_brand", f"WITH {CURATED_SQL} SELECT p_partkey, brand FROM curated")
def brand(spark, d):
    return P.vehicles(spark, d).select("p_partkey", text.brand(F.col("car_model")).alias("brand"))


@query("c4_base_model", f"WITH {CURATED_SQL} SELECT p_partkey, base_model FROM curated")
def base_model(spark, d):
    return P.vehicles(spark, d).select("p_partkey", text.base_model(F.col("car_model")).alias("base_model"))


def curated(spark, d):
    c = F.col("car_model")
    return P.vehicles(spark, d).select(
        "p_partkey",
        "car_model",
        text.brand(c).alias("brand"),
        text.standard_model(c, text.base_model(c)).alias("model"),
    )


@query("c5_standard_model", f"WITH {CURATED_SQL} SELECT p_partkey, car_model, brand, model FROM curated")
def standard_model(spark, d):
    return curated(spark, d)


@query(
    "c6_c7_electric_labels",
    f"""WITH {P.VEHICLES_SQL}
SELECT p_partkey, CASE WHEN lower(fuel) IN ('elektro', 'electric', 'ev') THEN 'EV' ELSE 'ICE' END AS vehicle_type,
  contains(lower(fuel), 'elektro') OR contains(lower(fuel), 'electric') AS is_electric FROM vehicles""",
)
def electric_labels(spark, d):
    fuel = F.col("fuel")
    return P.vehicles(spark, d).select(
        "p_partkey", text.vehicle_type(fuel).alias("vehicle_type"), text.is_electric(fuel).alias("is_electric")
    )


@query(
    "c8_power_mode_names",
    f"""WITH {P.LISTINGS_SQL}
SELECT power_mode, CASE power_mode WHEN 'Benzin' THEN 'Petrol' WHEN 'Diesel' THEN 'Diesel' WHEN 'Elektro' THEN 'Electric' END
  AS power_mode_en, count(*) AS n FROM listings GROUP BY 1, 2""",
)
def power_mode_names(spark, d):
    mode = F.col("power_mode")
    rows = P.listings(spark, d).select(mode, text.power_mode_en(mode).alias("power_mode_en"))
    return rows.groupBy("power_mode", "power_mode_en").agg(F.count(F.lit(1)).alias("n"))


@query(
    "c9_d1_production_month",
    f"""WITH {P.VEHICLES_SQL},
fixed AS (SELECT *, CASE WHEN production_date = 'Neues Fahrzeug' THEN '10.2025' ELSE production_date END AS c FROM vehicles)
SELECT p_partkey, c AS date_text, strftime(try_strptime(c, '%m.%Y'), '%Y-%m') AS month FROM fixed""",
)
def production_month(spark, d):
    c = text.replace_literal(F.col("production_date"), S.NEW_VEHICLE, S.NEW_VEHICLE_MONTH)
    return P.vehicles(spark, d).select("p_partkey", c.alias("date_text"), ym(dates.parse_month_year(c)))


@query(
    "c10_missing_tokens",
    f"""WITH {P.VEHICLES_SQL}
SELECT p_partkey, CASE WHEN gearbox NOT IN ('-', '—', '–', '', 'N/A') THEN gearbox END AS gearbox,
  CASE WHEN car_model NOT IN ('-', '—', '–', '', 'N/A') THEN car_model END AS car_model FROM vehicles""",
)
def missing_tokens(spark, d):
    return P.vehicles(spark, d).select(
        "p_partkey", *[text.missing_tokens(F.col(c)).alias(c) for c in ("gearbox", "car_model")]
    )


@query(
    "c11_canonical_links",
    f"""WITH links AS (
  SELECT page_id, url, regexp_extract(html, '<a[^>]*href="([^"]*)"', 1) AS href FROM pages)
SELECT page_id, CASE WHEN url LIKE 'http%' THEN split_part(url, '?', 1)
                     WHEN url LIKE '/%' THEN '{P.SITE}' || split_part(url, '?', 1) END AS url,
  CASE WHEN href LIKE 'http%' THEN split_part(href, '?', 1)
       WHEN href LIKE '/%' THEN '{P.SITE}' || split_part(href, '?', 1) END AS first_link
FROM links""",
)
def canonical_links(spark, d):
    link = html.first_link(F.col("html"))
    return P.table(spark, d, "pages").select(
        "page_id",
        text.canonical_link(F.col("url"), P.SITE).alias("url"),
        text.canonical_link(link, P.SITE).alias("first_link"),
    )


@query(
    "c12_first_non_empty",
    f"""WITH {P.VEHICLES_SQL}
SELECT p_partkey, coalesce(nullif(fuel, ''), nullif(gearbox, ''), nullif(car_model, '')) AS first_text FROM vehicles""",
)
def first_non_empty(spark, d):
    cols = [F.col(c) for c in ("fuel", "gearbox", "car_model")]
    return P.vehicles(spark, d).select("p_partkey", text.first_non_empty(*cols).alias("first_text"))


@query(
    "c13_c14_numbers",
    f"""WITH {P.VEHICLES_SQL}
SELECT p_partkey, try_cast(replace(price_text, ',', '.') AS DOUBLE) AS price, try_cast(price_text AS DOUBLE) AS strict
FROM vehicles""",
)
def numbers(spark, d):
    c = F.col("price_text")
    return P.vehicles(spark, d).select(
        "p_partkey", numeric.decimal_comma(c).alias("price"), numeric.to_number(c).alias("strict")
    )


@query(
    "c15_label_cleanup",
    """SELECT o_orderkey, replace(replace(o_orderpriority || '_Spot_Monthly_Avg', '_Monthly_Avg', ''), '_Spot', '') AS label
FROM orders""",
)
def label_cleanup(spark, d):
    label = F.concat(F.col("o_orderpriority"), F.lit("_Spot_Monthly_Avg"))
    return P.table(spark, d, "orders").select(
        "o_orderkey", text.remove_suffix_text(label, "_Monthly_Avg", "_Spot").alias("label")
    )


_VISIBLE = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
  regexp_replace(regexp_replace(html, '<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', ' ', 'gis'), '<[^>]*>', ' ', 'gs'),
  '&copy;', '©'), '&middot;', '·'), '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&amp;', '&'),
  '[\s\x{00A0}]+', ' ', 'g'))"""


@query(
    "c17_visible_text",
    f"SELECT page_id, length({_VISIBLE}) AS chars, md5({_VISIBLE}) AS digest FROM pages",
)
def visible_text(spark, d):
    body = html.visible_text(F.col("html"))
    return P.table(spark, d, "pages").select(
        "page_id", F.length(body).cast("bigint").alias("chars"), F.md5(body).alias("digest")
    )


# Running text with the patterns the fallbacks look for, built from the documents.
_NOTES_SQL = """notes AS (
  SELECT doc_id, text || ' EZ ' || CASE doc_id % 3 WHEN 0 THEN (doc_id % 12 + 1) || '/' || (1990 + doc_id % 30)
           WHEN 1 THEN CAST(1990 + doc_id % 30 AS VARCHAR) ELSE 'neu' END
    || ', ' || (doc_id % 9 + 3) || '.' || (doc_id % 10) || CASE WHEN doc_id % 4 = 0 THEN ' l/100km' ELSE '  l/100 km' END
    || CASE doc_id % 5 WHEN 0 THEN ' Schaltgetriebe' WHEN 1 THEN ' Halbautomatik' WHEN 2 THEN ' Automatik' ELSE '' END
    AS body FROM documents)"""


@query(
    "c16_text_fallbacks",
    f"""WITH {_NOTES_SQL}
SELECT doc_id, nullif(regexp_extract(body, '\\b(\\d{{1,2}}/\\d{{4}}|\\d{{4}})\\b', 1), '') AS production_date,
  nullif(regexp_extract(body, '(\\d+\\.\\d+)\\s*l/100\\s*km', 1), '') AS consumption,
  CASE WHEN contains(body, 'Automatik') OR contains(body, 'Automat') THEN 'Automat'
       WHEN contains(body, 'Manuell') OR contains(body, 'Schaltgetriebe') THEN 'Manuell'
       WHEN contains(body, 'Halbautomatik') THEN 'Halbautomatik' END AS transmission
FROM notes""",
)
def text_fallbacks(spark, d):
    key = F.col("doc_id")
    year = (F.lit(1990) + key % 30).cast("string")
    when = F.when(key % 3 == 0, F.concat((key % 12 + 1).cast("string"), F.lit("/"), year)).when(key % 3 == 1, year)
    fuel = F.concat((key % 9 + 3).cast("string"), F.lit("."), (key % 10).cast("string"))
    unit = F.when(key % 4 == 0, " l/100km").otherwise("  l/100 km")
    gear = F.when(key % 5 == 0, " Schaltgetriebe").when(key % 5 == 1, " Halbautomatik").when(key % 5 == 2, " Automatik")
    body = F.concat(
        F.col("text"), F.lit(" EZ "), when.otherwise("neu"), F.lit(", "), fuel, unit, gear.otherwise("")
    )
    notes = P.table(spark, d, "documents").select("doc_id", body.alias("body"))
    c = F.col("body")
    return notes.select(
        "doc_id",
        text.date_in_text(c).alias("production_date"),
        text.consumption_in_text(c).alias("consumption"),
        text.transmission_in_text(c).alias("transmission"),
    )


@query(
    "c18_g9_brand_model_counts",
    f"""WITH {CURATED_SQL}
SELECT brand || ' ' || model AS label, count(*) AS n FROM curated WHERE brand IS NOT NULL AND model IS NOT NULL GROUP BY 1""",
)
def brand_model_counts(spark, d):
    rows = curated(spark, d).select(text.brand_model_label(F.col("brand"), F.col("model")).alias("label"))
    return profile.value_counts(rows, "label", keep_null=False)


@query(
    "g19_catalogue_summary",
    f"""WITH {CURATED_SQL}
SELECT count(*) AS cars, count(DISTINCT brand) AS brands, count(DISTINCT brand || ' ' || model) AS models FROM curated""",
)
def catalogue_summary(spark, d):
    return profile.catalogue_summary(curated(spark, d))


@query(
    "g19_top_brands",
    f"""WITH {CURATED_SQL}
SELECT brand, count(*) AS n FROM curated WHERE brand IS NOT NULL GROUP BY 1 ORDER BY n DESC, brand LIMIT 5""",
)
def top_brands(spark, d):
    return profile.top_values(curated(spark, d), "brand", 5)


@query(
    "d2_day_dates",
    """SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS day_text,
  CAST(strptime(strftime(o_orderdate, '%d-%m-%Y'), '%d-%m-%Y') AS DATE) AS day,
  CAST(try_strptime(strftime(o_orderdate, '%d-%m-%Y'), '%Y-%m-%d') AS DATE) AS wrong_format
FROM orders""",
)
def day_dates(spark, d):
    shown = F.date_format("o_orderdate", "dd-MM-yyyy")
    return P.table(spark, d, "orders").select(
        "o_orderkey",
        shown.alias("day_text"),
        dates.parse_date(shown, "dd-MM-yyyy").alias("day"),
        dates.parse_date(shown, "yyyy-MM-dd").alias("wrong_format"),
    )


@query(
    "d3_any_month_layout",
    f"""WITH {P.VEHICLES_SQL}
SELECT p_partkey, CAST(coalesce(try_strptime(production_date, '%m.%Y'), try_strptime(production_date, '%m-%Y'),
  try_strptime(production_date, '%Y-%m'), try_strptime(production_date, '%Y.%m')) AS DATE) AS month FROM vehicles""",
)
def any_month_layout(spark, d):
    return P.vehicles(spark, d).select("p_partkey", dates.parse_any_month(F.col("production_date")).alias("month"))


@query(
    "d4_d5_month_keys",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
  strftime(l_shipdate, '%m-%Y') AS month_text, strftime(l_shipdate, '%Y-%m-%d') AS day_text FROM lineitem""",
)
def month_keys(spark, d):
    ship = F.to_date("l_shipdate")
    return P.table(spark, d, "lineitem").select(
        *P.KEY,
        dates.month_of(ship).alias("month"),
        dates.month_text(ship, "MM-yyyy").alias("month_text"),
        dates.month_text(ship, "yyyy-MM-dd").alias("day_text"),
    )


@query(
    "d6_month_from_date",
    """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%m-%Y') END AS m FROM orders)
SELECT o_orderkey, CAST(date_trunc('month', coalesce(try_strptime(m, '%m-%Y'), CAST(d AS TIMESTAMP))) AS DATE) AS month FROM o""",
)
def month_from_date(spark, d):
    key = F.col("o_orderkey")
    shown = F.when(key % 5 == 0, F.lit(None)).when(key % 7 == 0, "n/a").otherwise(F.date_format("o_orderdate", "MM-yyyy"))
    return P.table(spark, d, "orders").select(
        "o_orderkey", dates.quote_month(shown, F.to_date("o_orderdate")).alias("month")
    )


@query(
    "d7_month_sequence",
    """WITH span AS (SELECT min(date_trunc('month', o_orderdate)) AS a, max(date_trunc('month', o_orderdate)) AS b FROM orders),
months AS (SELECT unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS m FROM span)
SELECT strftime(m, '%Y-%m') AS month, count(o_orderkey) AS orders
FROM months LEFT JOIN orders ON date_trunc('month', o_orderdate) = m GROUP BY 1""",
)
def month_sequence(spark, d):
    orders = P.table(spark, d, "orders").select(dates.month_of(F.to_date("o_orderdate")).alias("month"))
    counted = orders.groupBy("month").agg(F.count(F.lit(1)).alias("orders"))
    span = counted.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    months = span.select(F.explode(dates.month_sequence(F.col("a"), F.col("b"))).alias("month"))
    joined = months.join(counted, "month", "left")
    return joined.select(ym(), F.coalesce("orders", F.lit(0)).alias("orders"))


@query(
    "d8_assigned_month",
    f"""SELECT strftime(DATE '{P.FIRST_MONTH}' + to_months(CAST(CAST('0x' || substr(md5({P.KEY_SQL}), 1, 8) AS BIGINT) % 67 AS INTEGER)), '%Y-%m')
  AS observation_month, count(*) AS n FROM lineitem GROUP BY 1""",
)
def assigned_month(spark, d):
    month = dates.assigned_month(P.listing_key(), P.FIRST_MONTH, P.LAST_MONTH)
    rows = P.table(spark, d, "lineitem").select(ym(month, "observation_month"))
    return rows.groupBy("observation_month").agg(F.count(F.lit(1)).alias("n"))


@query(
    "m1_m3_m4_m5_price_math",
    f"""WITH {P.LISTINGS_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {r6_sql('ln(price_chf)', 'log_price')},
  round_even(price_chf, 0) AS price_0, round_even(price_chf / 7 * 100, 0) / 100 AS price_2,
  {r6_sql('mileage / nullif(engine_power_hp - 10, 0)', 'km_per_hp')},
  {r6_sql('(price_chf - mileage) / nullif(mileage, 0) * 100', 'pct')}, abs(price_chf - mileage) AS gap
FROM listings""",
)
def price_math(spark, d):
    price, km, hp = F.col("price_chf"), F.col("mileage"), F.col("engine_power_hp")
    return P.listings(spark, d).select(
        *P.KEY,
        r6(numeric.log_price(price), "log_price"),
        numeric.round_even(price, 0).alias("price_0"),
        numeric.round_even(price / 7, 2).alias("price_2"),
        r6(numeric.ratio(km, hp - 10), "km_per_hp"),
        r6(numeric.percent_change(km, price), "pct"),
        F.abs(price - km).alias("gap"),
    )


@query(
    "p1_p6_projection",
    f"""WITH {P.LISTINGS_SQL}
SELECT brand, {ym_sql()}, count(*) AS n FROM listings WHERE month >= DATE '{P.START}' AND price_chf IS NOT NULL GROUP BY 1, 2""",
)
def projection(spark, d):
    rows = P.listings(spark, d).where(F.col("month") >= F.lit(P.START).cast("date")).where(F.col("price_chf").isNotNull())
    return rows.select("brand", ym()).groupBy("brand", "month").agg(big(F.count(F.lit(1)), "n"))
