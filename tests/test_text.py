import datetime as dt

from pyspark.sql import functions as F

from ferrocar.functions import dates, html, numeric, text


def test_fuel_order(column):
    values = ["Mild-Hybrid Benzin/Elektro", "DIESEL", "electric", "Plug-in Hybrid", "Gas", "", None]
    assert column(text.fuel_class, values) == ["Benzin", "Diesel", "Elektro", "Hybrid", None, None, None]


def test_transmission_order(column):
    values = ["Halbautomatisches Getriebe", "Automatikgetriebe", "Schaltgetriebe", "—", "", " -", None, "CVT stufenlos mit langem Namen"]
    expected = ["Halbautomatik", "Automat", "Manuell", None, None, "-", None, "CVT stufenlos mit la"]
    assert column(text.transmission_class, values) == expected


NAMES = {
    "mini Cooper S": ("Mini", "Cooper", "Cooper"),
    "MINI Countryman": ("Mini", "Countryman", "Countryman"),
    "Mercedes-Benz EQB 350 AMG": ("Mercedes-Benz", "EQB 350", "EQB 350"),
    "Mercedes C 220": ("Mercedes", "C 220", "C 220"),
    "BMW X6M Competition": ("BMW", "X6M", "X6M"),
    "BMW X5 30d": ("BMW", "X5 30d", "X5 30d"),
    "VW Golf 2.0 TDI": ("VW", "Golf 2.0", "Golf 2.0"),
    "Toyota C-HR 1.8": ("Toyota", "C", "C-HR"),
    "Saab 9-3 2.0i Aero": ("Saab", "9 3", "9-3 2.0i"),
    "BMW": ("BMW", None, None),
    "BMW ": ("BMW", None, None),
    "BMWX5 Coupe": ("BMWX5", "Coupe", "Coupe"),
    " Audi A4": ("Audi", "A4", "A4"),
    "CITROËN C4": ("Citroën", "C4", "C4"),
    "land rover  Discovery": ("Land Rover", "Discovery", "Discovery"),
    "Fiat -500": ("Fiat", " 500", " 500"),
    "VW T-Cross": ("VW", "T", "T-Cross"),
    "N/A": (None, None, None),
}


def test_brand_and_model(column):
    names = list(NAMES)
    assert column(text.brand, names) == [v[0] for v in NAMES.values()]
    assert column(text.base_model, names) == [v[1] for v in NAMES.values()]
    assert column(lambda c: text.standard_model(c, text.base_model(c)), names) == [v[2] for v in NAMES.values()]


def test_vehicle_type_is_exact_and_mask_is_substring(column):
    values = ["Elektro", "EV", "Elektro/Benzin", None]
    assert column(text.vehicle_type, values) == ["EV", "EV", "ICE", "ICE"]
    assert column(text.is_electric, values) == [True, False, True, False]


def test_links(column):
    values = ["/de/d/x?y=1", "https://a.b/c?d", "#top", "mailto:x", None]
    expected = ["https://s.example/de/d/x", "https://a.b/c", None, None, None]
    assert column(lambda c: text.canonical_link(c, "https://s.example/"), values) == expected


def test_numbers(column):
    assert column(numeric.decimal_comma, ["1,5", "2.25", "x", "", None, "NaN"]) == [1.5, 2.25, None, None, None, None]


def test_round_half_to_even_on_binary_value(spark):
    values = [(0.5,), (1.5,), (2.5,), (-0.5,), (1.015,)]
    rows = spark.createDataFrame(values, "x double").select(numeric.round_even(F.col("x")), numeric.round_even(F.col("x"), 2))
    got = [tuple(r) for r in rows.collect()]
    assert [g[0] for g in got] == [0, 2, 2, 0, 1]
    assert got[-1][1] == 1.01


def test_dates(column):
    assert column(dates.parse_month_year, ["06.2024", "6.2024", "10/2023", "2023", "13.2024"]) == [
        dt.date(2024, 6, 1), dt.date(2024, 6, 1), None, None, None,
    ]
    assert column(dates.parse_any_month, ["06.2024", "06-2024", "2024-06", "2024.06", "x"]) == [dt.date(2024, 6, 1)] * 4 + [None]


def test_text_fallbacks(column):
    values = ["EZ 10/2023, 5.2 l/100 km, Automatik", "Jahr 2021 12345", "Manuelles Getriebe", "nichts"]
    assert column(text.date_in_text, values) == ["10/2023", "2021", None, None]
    assert column(text.consumption_in_text, values) == ["5.2", None, None, None]
    assert column(text.transmission_in_text, values) == ["Automat", None, "Manuell", None]


def test_visible_text(column):
    values = ["<p>A&amp;B<!-- x --><script>var a='</p>'</script>\n <b>c </b></p>"]
    assert column(html.visible_text, values) == ["A&B c"]


def test_assigned_month_is_stable_and_in_range(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    months = keys.select(dates.assigned_month(F.col("k"), "2020-01-01", "2025-10-01").alias("m"))
    got = months.groupBy("m").count().collect()
    assert len(got) == 70 == dates.months_between("2020-01-01", "2025-10-01")
    assert months.collect() == months.collect()
    other = keys.select(dates.assigned_month(F.col("k"), "2020-01-01", "2025-10-01", "7").alias("m"))
    assert other.collect() != months.collect()


def test_only_whole_numbers_are_numbers(column):
    texts = ["12d", "12f", "1e3", " -2.5 ", ".5", "5.", "0x1A", "1_000", "inf", "NaN", "--1"]
    assert column(numeric.to_number, texts) == [None, None, 1000.0, -2.5, 0.5, 5.0, None, None, float("inf"), None, None]


def test_entities_are_decoded_once(column):
    texts = ["caf&eacute; &#8211; &#x1F642;", "&amp;lt; &nosuch; &#0; a & b;", "&copy;&middot;&apos;", "plain", None]
    assert column(html.unescape, texts) == ["café – 🙂", "&lt; &nosuch; &#0; a & b;", "©·'", "plain", None]


def test_links_need_a_name_of_their_own(column):
    texts = ["<a data-href='/no' href='/yes'>", "<a class=x href=/d/1>", '<a href="/q?a=1&amp;b=2">', "<a data-href='/no'>"]
    assert column(html.first_link, texts) == ["/yes", "/d/1", "/q?a=1&b=2", None]
