"""Text rules for listings. All of them are built-in expressions."""

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferrocar import schema as S

# (?U) gives \s, \d and \b their Unicode meaning: crawled text holds no-break spaces.
_STRIP = r"(?U)^\s+|\s+$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, worked out once: inside a lambda, each use of an expression runs it again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _STRIP, "")


def none_if(c: Column, tokens: list[str]) -> Column:
    """Missing where the text is one of the tokens."""
    if len(tokens) == 1:
        return F.nullif(c, F.lit(tokens[0]))
    return F.when(~c.isin(tokens), c)


def missing_tokens(c: Column) -> Column:
    """Dashes, empty text and N/A become missing."""
    return none_if(c, [*S.DASHES, "N/A"])


def first_non_empty(*cols: Column) -> Column:
    return F.coalesce(*[none_if(c, [""]) for c in cols])


def replace_literal(c: Column, old: str, new: str) -> Column:
    return F.when(c == old, F.lit(new)).otherwise(c)


def remove_suffix_text(c: Column, *parts: str) -> Column:
    return reduce(lambda acc, p: F.replace(acc, F.lit(p), F.lit("")), parts, c)


def _any_contains(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def _first_class(c: Column, classes: list[tuple[str, list[str]]]) -> Column:
    return F.coalesce(*[F.when(_any_contains(c, words), F.lit(name)) for name, words in classes])


def fuel_class(c: Column) -> Column:
    """Fuel family from free text; unknown fuels are missing."""
    return _first_class(F.lower(c), S.FUEL_CLASSES)


def transmission_class(c: Column) -> Column:
    """Gearbox family from free text, or the text itself cut to 20 characters."""

    def named(text: Column) -> Column:
        return F.coalesce(_first_class(F.lower(text), S.TRANSMISSION_CLASSES), F.substring(text, 1, 20))

    return F.when(~c.isin(["", "-", "—"]), let(strip(c), named))


def _brand_names() -> str:
    return "|".join(re.escape(b) for b in S.BRANDS)


def _brand_pattern() -> str:
    return rf"(?iuU)^({_brand_names()})\s+"


def _brand_or_word() -> str:
    """What stands before the model: a known brand, else the first word."""
    return rf"(?iuU)^(?:(?:{_brand_names()})\s+|\s*\S+\s*)"


def _canonical_brand(found: Column) -> Column:
    spelling: dict[str, str] = {}
    for name in S.BRANDS:
        spelling.setdefault(name.lower(), name)
    pairs = [F.lit(x) for pair in spelling.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.lower(found))


def brand(car_model: Column) -> Column:
    """Known brand at the start of the name, else the first word.

    One alternation replaces the ordered list of patterns: each alternative must be followed
    by white space, so the first that fits is the first of the list.
    """
    text = missing_tokens(car_model)
    known = _canonical_brand(F.regexp_extract(text, _brand_pattern(), 1))
    return F.coalesce(known, none_if(F.regexp_extract(text, r"(?U)(\S+)", 1), [""]))


def base_model(car_model: Column) -> Column:
    """First token after the brand, with the second if that starts with a digit."""
    rest = strip(F.regexp_replace(missing_tokens(car_model), _brand_or_word(), ""))
    tokens = F.regexp_extract(rest, r"(?U)^[^\s\-]*(?:[\s\-]+\d[^\s\-]*)?", 0)
    return F.when(rest != "", F.regexp_replace(tokens, r"(?U)[\s\-]+", " "))


def standard_model(car_model: Column, model: Column) -> Column:
    """Model name from the dictionary where the full name contains an entry."""
    hits = [F.when(F.contains(car_model, F.lit(part)), F.lit(name)) for part, name in S.MODEL_NAMES]
    return F.coalesce(*hits, model)


def brand_model_label(brand_col: Column, model: Column) -> Column:
    return F.concat(brand_col, F.lit(" "), model)


def vehicle_type(power_mode: Column) -> Column:
    """EV by exact label, everything else (missing too) ICE."""
    return F.when(F.lower(power_mode).isin(S.ELECTRIC_LABELS), "EV").otherwise("ICE")


def is_electric(power_mode: Column) -> Column:
    """Electric by substring, unlike :func:`vehicle_type`."""
    return F.coalesce(F.lower(power_mode).rlike("elektro|electric"), F.lit(False))


def power_mode_en(c: Column) -> Column:
    pairs = [F.lit(x) for pair in S.POWER_MODES_EN.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def without_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def canonical_link(href: Column, site: str) -> Column:
    """Absolute link without its query; other schemes and fragments are missing."""
    clean = without_query(href)
    return F.when(F.startswith(href, F.lit("http")), clean).when(
        F.startswith(href, F.lit("/")), F.concat(F.lit(site.rstrip("/")), clean)
    )


def date_in_text(c: Column) -> Column:
    """``10/2023`` or ``2023`` found in running text."""
    return let(F.regexp_extract(c, r"(?U)\b(\d{1,2}/\d{4}|\d{4})\b", 1), lambda found: none_if(found, [""]))


def consumption_in_text(c: Column) -> Column:
    """The number before ``l/100 km`` in running text."""
    return let(F.regexp_extract(c, r"(?U)(\d+\.\d+)\s*l/100\s*km", 1), lambda found: none_if(found, [""]))


def _class_of(word: str) -> str:
    return next(name for name, parts in S.TRANSMISSION_CLASSES if any(p in word.lower() for p in parts))


def transmission_in_text(c: Column) -> Column:
    """Class of the first known transmission word in running text."""
    hits = [F.when(F.contains(c, F.lit(w)), F.lit(_class_of(w))) for w in S.TRANSMISSION_WORDS]
    return F.coalesce(*hits)
