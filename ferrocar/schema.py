"""Schemas and fixed values shared by the package."""

from pyspark.sql import types as T

# Raw listings: every field is text as crawled.
LISTING_RAW = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in (
            "car_model",
            "price_chf",
            "mileage",
            "engine_power_hp",
            "power_mode",
            "production_date",
            "consumption_l_per_100km",
            "transmission",
            "listing_url",
        )
    ]
)

LISTING_COLUMNS = LISTING_RAW.fieldNames()
CURATED_COLUMNS = ["brand", "model", *LISTING_COLUMNS]
CONTINUOUS = ["price_chf", "mileage", "engine_power_hp", "consumption_l_per_100km"]

LISTING = T.StructType(
    [
        T.StructField("brand", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("car_model", T.StringType()),
        T.StructField("price_chf", T.DoubleType()),
        T.StructField("mileage", T.DoubleType()),
        T.StructField("engine_power_hp", T.DoubleType()),
        T.StructField("power_mode", T.StringType()),
        T.StructField("production_date", T.DateType()),
        T.StructField("month", T.DateType()),
        T.StructField("consumption_l_per_100km", T.DoubleType()),
        T.StructField("transmission", T.StringType()),
        T.StructField("listing_url", T.StringType()),
    ]
)

# One row per ticker, trading day and OHLC field.
OHLC_LONG = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

QUOTE_LONG = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("month", T.DateType()),
        T.StructField("instrument", T.StringType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("monthly_avg", T.DoubleType()),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

# --- fixed values -----------------------------------------------------------

# Commodity name -> exchange ticker.
TICKERS = {
    "WTI": "CL=F",
    "Copper": "HG=F",
    "Lithium": "LIT",
    "Aluminium": "ALI=F",
    "Steel": "HRC=F",
    "Nickel": "NIC.AX",
    "Cobalt": "603799.SS",
}
INSTRUMENTS = list(TICKERS)

# Composite index weights; they sum to 1.
WEIGHTS = {
    "WTI": 0.30,
    "Steel": 0.15,
    "Aluminium": 0.25,
    "Copper": 0.05,
    "Cobalt": 0.05,
    "Nickel": 0.05,
    "Lithium": 0.15,
}

# Text read as missing by the default CSV dialect.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

DASHES = ["-", "—", "–", ""]

# Brands in match order; the first spelling that fits wins.
BRANDS = [
    "BMW", "Mercedes-Benz", "Mercedes", "Audi", "VW", "Volkswagen", "Porsche", "Tesla", "Volvo",
    "Ford", "Toyota", "Honda", "Mazda", "Nissan", "Hyundai", "Kia", "Seat", "Skoda", "Peugeot",
    "Renault", "Citroën", "Citroen", "Opel", "Fiat", "Alfa Romeo", "Jeep", "Land Rover",
    "Range Rover", "Jaguar", "Mini", "MINI", "Smart", "Subaru", "Suzuki", "Mitsubishi", "Lexus",
    "Infiniti", "Cupra", "DS",
]

# Text found in the full car name -> model name; the first hit wins.
MODEL_NAMES = [
    ("AUDI e-tron", "e-tron"),
    ("AUDI 2.0 TDI", "2.0 TDI"),
    ("6.0 Double Six", "6.0"),
    ("4x4 Country Club", "4x4 Country Club"),
    ("FORD S-Max", "S-Max"),
    ("FORD C-Max", "C-Max"),
    ("JAGUAR I-Pace", "I-Pace"),
    ("Grand Cherokee", "Grand Cherokee"),
    ("Range Rover Evoque 2.0", "Range Rover Evoque 2.0"),
    ("MERCEDES-BENZ A AMG 45 S 4Matic+ 8G-DCT", "A AMG"),
    ("i MiEV", "i MiEV"),
    ("9-3 2.0i", "9-3 2.0i"),
    ("Smart #5 100kWh", "#5"),
    ("Smart #1 66", "#1"),
    ("TESLA Model Y", "Model Y"),
    ("TESLA TESLA Model 3 Performance, 513 PS", "Model 3"),
    ("TESLA Signature Sport", "Roadster"),
    ("TESLA Model S", "Model S"),
    ("Toyota C-HR", "C-HR"),
    ("T-Cross", "T-Cross"),
    ("VW R-Line 3.0", "R-Line 3.0"),
    ("T-Roc", "T-Roc"),
    ("New Beetle Cabrio", "Beetle Cabrio"),
    ("Käfer Cabriolet", "Beetle Cabrio"),
    ("e-Golf", "e-Golf"),
]

FUEL_CLASSES = [
    ("Benzin", ["benzin", "petrol"]),
    ("Diesel", ["diesel"]),
    ("Elektro", ["elektro", "electric"]),
    ("Hybrid", ["hybrid"]),
]

TRANSMISSION_CLASSES = [
    ("Halbautomatik", ["halbautomatisches getriebe", "halbautomatik"]),
    ("Automat", ["automat"]),
    ("Manuell", ["manuell", "manual", "schalt"]),
]

# Transmission words searched in free text, in order.
TRANSMISSION_WORDS = [
    "Automatik", "Automat", "Automatisches Getriebe", "Manuell", "Manuelles Getriebe",
    "Schaltgetriebe", "Halbautomatik", "Halbautomatisches Getriebe",
]

POWER_MODES_EN = {"Benzin": "Petrol", "Diesel": "Diesel", "Elektro": "Electric"}
ELECTRIC_LABELS = ["elektro", "electric", "ev"]

NEW_VEHICLE = "Neues Fahrzeug"
NEW_VEHICLE_MONTH = "10.2025"

LISTING_SCRIPT_ID = "structured-schema-srp"
PAGE_CAP = 4
