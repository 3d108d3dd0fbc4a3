"""Listings, quotes and pages derived from the given tables.

Each proxy has a DataFrame form and the SQL text of the same relation, for use as a common
table expression.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START = "1996-01-01"
FIRST_MONTH, LAST_MONTH = "1996-01-01", "2001-07-01"
NEW_VEHICLE_MONTH = "10.2001"
SITE = "https://listings.example"

INSTRUMENTS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
WEIGHTS = {"1-URGENT": 0.30, "2-HIGH": 0.15, "3-MEDIUM": 0.25, "4-NOT SPECIFIED": 0.15, "5-LOW": 0.15}
# Commodity of a regression -> proxy instrument.
ROLES = {
    "Lithium": "1-URGENT",
    "Copper": "2-HIGH",
    "WTI": "3-MEDIUM",
    "Steel": "4-NOT SPECIFIED",
    "Nickel": "5-LOW",
}
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing_key() -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in KEY])


KEY_SQL = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing per line item. Both inputs grow with the data, so the join is left to the
    optimizer: broadcast while ``part`` is small, else a sort-merge join with skew splitting."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name", "p_size")
    joined = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        *KEY,
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("model"),
        F.concat_ws(" ", "p_brand", "p_name").alias("car_model"),
        F.rint("l_extendedprice").alias("price_chf"),
        (F.col("l_quantity") * 4000.0).alias("mileage"),
        (F.col("p_size") * 10.0).alias("engine_power_hp"),
        F.when(F.col("l_returnflag") == "N", "Benzin")
        .when(F.col("l_returnflag") == "R", "Diesel")
        .otherwise("Elektro")
        .alias("power_mode"),
        F.date_format("l_shipdate", "MM.yyyy").alias("production_date"),
        F.rint(F.col("l_discount") * 100.0).alias("consumption_l_per_100km"),
        F.when(F.col("l_linestatus") == "O", "Automat").otherwise("Manuell").alias("transmission"),
        F.to_date(F.trunc("l_shipdate", "MM")).alias("month"),
    )


LISTINGS_SQL = """
listings AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         p_brand AS brand, p_type AS model, p_brand || ' ' || p_name AS car_model,
         round_even(l_extendedprice, 0) AS price_chf, l_quantity * 4000.0::DOUBLE AS mileage, p_size * 10.0::DOUBLE AS engine_power_hp,
         CASE l_returnflag WHEN 'N' THEN 'Benzin' WHEN 'R' THEN 'Diesel' ELSE 'Elektro' END AS power_mode,
         strftime(l_shipdate, '%m.%Y') AS production_date,
         round_even(l_discount * 100.0::DOUBLE, 0) AS consumption_l_per_100km,
         CASE WHEN l_linestatus = 'O' THEN 'Automat' ELSE 'Manuell' END AS transmission,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS month
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def dirty_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with gaps at fixed keys, new vehicles, and no month yet."""
    df = listings(spark, sf_dir).drop("month")

    def gap(column: str, where: Column) -> Column:
        return F.when(~where, F.col(column)).alias(column)

    order, part_key, line, supp = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"))
    date = F.when(order % 31 == 0, F.lit(None)).when(order % 29 == 0, "Neues Fahrzeug")
    return df.select(
        *KEY,
        "brand",
        "model",
        "car_model",
        gap("price_chf", (part_key + line) % 23 == 0),
        gap("mileage", (supp + order) % 19 == 0),
        "engine_power_hp",
        gap("power_mode", order % 13 == 0),
        date.otherwise(F.col("production_date")).alias("production_date"),
        gap("consumption_l_per_100km", part_key % 3 == 0),
        gap("transmission", order % 17 == 0),
    )


DIRTY_SQL = f"""{LISTINGS_SQL},
dirty AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, brand, model, car_model,
         CASE WHEN (l_partkey + l_linenumber) % 23 <> 0 THEN price_chf END AS price_chf,
         CASE WHEN (l_suppkey + l_orderkey) % 19 <> 0 THEN mileage END AS mileage,
         engine_power_hp,
         CASE WHEN l_orderkey % 13 <> 0 THEN power_mode END AS power_mode,
         CASE WHEN l_orderkey % 31 = 0 THEN NULL WHEN l_orderkey % 29 = 0 THEN 'Neues Fahrzeug'
              ELSE production_date END AS production_date,
         CASE WHEN l_partkey % 3 <> 0 THEN consumption_l_per_100km END AS consumption_l_per_100km,
         CASE WHEN l_orderkey % 17 <> 0 THEN transmission END AS transmission
  FROM listings)"""


def sparse_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty listings whose gaps reach every imputation level.

    One model has no consumption anywhere and some brands none at all; dates are missing for
    whole models and whole brands; a few listings have no model or no brand.
    """
    df = dirty_listings(spark, sf_dir)
    part_key = F.col("l_partkey")
    no_consumption = (F.col("model") == "PROMO") | F.col("brand").isin("Brand#7", "Brand#8")
    no_date = ((F.col("model") == "LARGE") & (F.col("brand") != "Brand#3")) | F.col("brand").isin("Brand#5", "Brand#6")
    no_date = no_date | ((F.col("model") == "LARGE") & (part_key % 2 == 0))
    return df.withColumns(
        {
            "consumption_l_per_100km": F.when(~no_consumption, F.col("consumption_l_per_100km")),
            "production_date": F.when(~no_date, F.col("production_date")),
            "model": F.when(F.col("l_suppkey") % 37 != 0, F.col("model")),
            "brand": F.when(F.col("l_suppkey") % 41 != 0, F.col("brand")),
        }
    )


SPARSE_SQL = f"""{DIRTY_SQL},
sparse AS (
  SELECT * REPLACE (
    CASE WHEN NOT (model = 'PROMO' OR brand IN ('Brand#7', 'Brand#8')) THEN consumption_l_per_100km END
      AS consumption_l_per_100km,
    CASE WHEN NOT ((model = 'LARGE' AND brand <> 'Brand#3') OR brand IN ('Brand#5', 'Brand#6')
                   OR (model = 'LARGE' AND l_partkey % 2 = 0)) THEN production_date END AS production_date,
    CASE WHEN l_suppkey % 37 <> 0 THEN model END AS model,
    CASE WHEN l_suppkey % 41 <> 0 THEN brand END AS brand)
  FROM dirty)"""


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily close per order priority, in whole units: at most five rows a day.

    Closes and prices are whole numbers, whose sums do not depend on their order: means that
    lie on a rounding boundary come out alike in every engine and partitioning.
    """
    cents = F.rint(F.col("o_totalprice") * 100.0).cast("bigint")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("instrument"))
        .agg(F.rint(F.sum(cents).cast("double") / (F.count(F.lit(1)) * 100.0)).alias("close"))
    )


QUOTES_SQL = """
quotes AS (
  SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS instrument,
         round_even(CAST(sum(CAST(round_even(o_totalprice * 100.0::DOUBLE, 0) AS BIGINT)) AS DOUBLE)
           / (count(*) * 100.0::DOUBLE), 0) AS close
  FROM orders GROUP BY 1, 2)"""

# Every day with any quote, for every instrument; days without a quote have a null close.
DENSE_SQL = f"""{QUOTES_SQL},
dense AS (
  SELECT d.date, i.instrument, q.close
  FROM (SELECT DISTINCT date FROM quotes) d
  CROSS JOIN (SELECT DISTINCT instrument FROM quotes) i
  LEFT JOIN quotes q ON q.date = d.date AND q.instrument = i.instrument)"""

MONTHLY_SQL = f"""{QUOTES_SQL},
monthly AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS month, instrument, avg(close) AS close
  FROM quotes GROUP BY 1, 2),
wide AS (
  SELECT month,
         max(close) FILTER (WHERE instrument = '1-URGENT') AS "1-URGENT",
         max(close) FILTER (WHERE instrument = '2-HIGH') AS "2-HIGH",
         max(close) FILTER (WHERE instrument = '3-MEDIUM') AS "3-MEDIUM",
         max(close) FILTER (WHERE instrument = '4-NOT SPECIFIED') AS "4-NOT SPECIFIED",
         max(close) FILTER (WHERE instrument = '5-LOW') AS "5-LOW"
  FROM monthly GROUP BY 1)"""

WEIGHTS_SQL = """
weights(instrument, weight) AS (VALUES ('1-URGENT', 0.30::DOUBLE), ('2-HIGH', 0.15::DOUBLE),
  ('3-MEDIUM', 0.25::DOUBLE), ('4-NOT SPECIFIED', 0.15::DOUBLE), ('5-LOW', 0.15::DOUBLE))"""


# Vehicle names as crawled; the parts are spread over them by key.
NAMES = [
    "BMW X6M", "bmw X5 30d", "Mercedes-Benz EQB 350", "Mercedes C 220", "MERCEDES-BENZ A AMG 45 S 4Matic+ 8G-DCT",
    "VW Golf 2.0 TDI", "VW R-Line 3.0", "Toyota C-HR 1.8", "mini Cooper S", "MINI Countryman", "Saab 9-3 2.0i Aero",
    "TESLA Model Y", "TESLA Model S", "Land Rover Discovery", "Range Rover Evoque 2.0", "AUDI e-tron", "Audi A4 40",
    "Peugeot 2008 1.2", "Skoda", "FORD S-Max", "Alfa Romeo Giulia", "Daihatsu 6.0 Double Six", "VW T-Cross", "DS 7",
    "Jeep Grand Cherokee", "Smart #1 66", "Smartfix Roadster", "  Kia Sportage", "N/A", "Citroën C4 Cactus",
]
FUELS = [
    "Benzin", "Mild-Hybrid Benzin/Elektro", "DIESEL", "Elektro", "Electric drive", "Plug-in Hybrid", "Petrol", "Gas", "",
]
GEARBOXES = [
    "Halbautomatisches Getriebe", "Automatik", "automatic 8-speed", "Schaltgetriebe", "Manual", "—", "-", "",
    "CVT stufenlos mit langem Namen", "  Automatisches Getriebe ",
]
DATES = ["06.2024", "6.2024", "10/2023", "2023", "06-2024", "2024-06", "2024.06", "Neues Fahrzeug", "13.2024"]


def pick(values: list[str], key: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(key, F.lit(len(values))).cast("int"))


def pick_sql(values: list[str], key: str) -> str:
    items = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{items}])[CAST({key} % {len(values)} AS INTEGER) + 1]"


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawled-looking text for each part."""
    key = F.col("p_partkey")
    name = pick(NAMES, key)
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(name.isin("N/A", "Skoda"), name).otherwise(F.concat_ws(" ", name, "p_name")).alias("car_model"),
        pick(FUELS, key).alias("fuel"),
        pick(GEARBOXES, key).alias("gearbox"),
        pick(DATES, key).alias("production_date"),
        F.concat(F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(",")), F.when(key % 11 == 0, "x").otherwise("")).alias("price_text"),
    )


VEHICLES_SQL = f"""
vehicles AS (
  SELECT p_partkey, CASE WHEN name IN ('N/A', 'Skoda') THEN name ELSE name || ' ' || p_name END AS car_model,
         {pick_sql(FUELS, 'p_partkey')} AS fuel, {pick_sql(GEARBOXES, 'p_partkey')} AS gearbox,
         {pick_sql(DATES, 'p_partkey')} AS production_date,
         replace(CAST(p_retailprice AS VARCHAR), '.', ',') || CASE WHEN p_partkey % 11 = 0 THEN 'x' ELSE '' END AS price_text
  FROM (SELECT *, {pick_sql(NAMES, 'p_partkey')} AS name FROM part))"""
