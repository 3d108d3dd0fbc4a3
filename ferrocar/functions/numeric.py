"""Numbers: coercion, rounding, ratios and guarded statistics."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# A number and nothing else: a cast alone would take Java's suffixes (12d, 12f) for part of it.
NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a number is missing."""
    value = F.trim(c.cast("string"))
    return F.when(value.rlike(NUMBER), value.try_cast("double"))


def decimal_comma(c: Column) -> Column:
    """Text with a decimal comma or point to double."""
    return to_number(F.replace(c.cast("string"), F.lit(","), F.lit(".")))


def round_even(c: Column, digits: int = 0) -> Column:
    """Scale, round half to even, scale back: the rounding of array libraries.

    ``bround`` works on the decimal text of a double instead, so 1.015 differs.
    """
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def percent_change(first: Column, last: Column) -> Column:
    return F.try_divide(last - first, first) * 100.0


def index_100(value: Column, base: Column) -> Column:
    return F.try_divide(value, base) * 100.0


def z_score(c: Column, mean: Column, std: Column) -> Column:
    return F.try_divide(c - mean, std)


def log_price(c: Column) -> Column:
    """Natural logarithm; zero and negative prices are missing."""
    return F.ln(c)


def normal_pdf(x: Column, mu: Column, sigma: Column) -> Column:
    z = F.try_divide(x - mu, sigma)
    return F.try_divide(F.exp(-z * z / 2.0), sigma * F.sqrt(F.lit(2.0) * F.pi()))


def at_least(n: Column, minimum: int, stat: Column) -> Column:
    """The statistic, or missing where the sample is too small."""
    return F.when(n >= minimum, stat)


def sample_skewness(c: Column) -> Column:
    """Bias-corrected skewness, missing below three values."""
    n = F.count(c).cast("double")
    g1 = _moment(c, 3)
    return F.when(n >= 3, F.try_divide(g1 * F.sqrt(n * (n - 1)), n - 2))


def sample_kurtosis(c: Column) -> Column:
    """Bias-corrected excess kurtosis, missing below four values."""
    n = F.count(c).cast("double")
    g2 = _moment(c, 4)
    return F.when(n >= 4, F.try_divide((n - 1) * ((n + 1) * g2 + 6), (n - 2) * (n - 3)))


def _moment(c: Column, order: int) -> Column:
    return F.skewness(c) if order == 3 else F.kurtosis(c)
