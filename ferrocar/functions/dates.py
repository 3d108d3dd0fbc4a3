"""Dates and month keys. A month is held as its first day."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_FORMATS = ("M.yyyy", "M-yyyy", "yyyy-M", "yyyy.M")


def parse_date(c: Column, fmt: str) -> Column:
    """Text in the given format to a date, or missing."""
    return F.try_to_date(c, fmt)


def month_of(d: Column) -> Column:
    return F.trunc(d, "MM")


def parse_month_year(c: Column) -> Column:
    """``06.2024`` to the first of June 2024, or missing."""
    return parse_date(c, "M.yyyy")


def parse_any_month(c: Column) -> Column:
    """The first of four month layouts that fits."""
    return F.coalesce(*[parse_date(c, f) for f in MONTH_FORMATS])


def month_text(d: Column, fmt: str = "yyyy-MM") -> Column:
    return F.date_format(d, fmt)


def quote_month(month: Column, date: Column) -> Column:
    """Month from ``MM-yyyy`` text, taken from the trading day where that is missing."""
    return month_of(F.coalesce(parse_date(month, "M-yyyy"), date))


def month_sequence(first: str | Column, last: str | Column) -> Column:
    """All months between two dates, both included."""
    return F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))


def months_between(first: str, last: str) -> int:
    fy, fm = (int(x) for x in first.split("-")[:2])
    ly, lm = (int(x) for x in last.split("-")[:2])
    return (ly - fy) * 12 + lm - fm + 1


def assigned_month(key: Column, first: str, last: str, seed: str = "") -> Column:
    """A month drawn uniformly for each key, the same on every run.

    The key's digest takes the place of a random generator, so the draw does not depend on
    row order, partitioning or retries.
    """
    text = F.concat(F.lit(seed), key) if seed else key
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    offset = F.pmod(draw, F.lit(months_between(first, last))).cast("int")
    return F.add_months(F.lit(first).cast("date"), offset)
