"""Distribution tails for small result tables, in plain Python.

Student t and F probabilities come from the regularised incomplete beta function, evaluated
with its continued fraction (Abramowitz & Stegun 26.5.8).
"""

import math


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    numer, denom = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    denom = 1.0 / (denom if abs(denom) > tiny else tiny)
    value = denom
    for m in range(1, 1000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            denom = 1.0 + term * denom
            denom = 1.0 / (denom if abs(denom) > tiny else tiny)
            numer = 1.0 + term / numer
            numer = numer if abs(numer) > tiny else tiny
            factor = denom * numer
            value *= factor
        if abs(factor - 1.0) < 1e-15:
            break
    return value


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def student_p(t: float, df: float) -> float:
    """Two-sided p of a t value."""
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def student_quantile(p: float, df: float) -> float:
    """The t value with upper tail ``1 - p``, for p above one half."""
    low, high = 0.0, 1.0
    target = 2.0 * (1.0 - p)
    while student_p(high, df) > target:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        if student_p(mid, df) > target:
            low = mid
        else:
            high = mid
    return (low + high) / 2.0


def f_upper(f: float, d1: float, d2: float) -> float:
    """Upper tail of the F distribution."""
    if f <= 0.0:
        return 1.0
    return incomplete_beta(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_two_upper(x: float) -> float:
    """Upper tail of chi-square with two degrees of freedom."""
    return math.exp(-x / 2.0)


def correlation_p(r: float | None, n: float) -> float | None:
    """Two-sided p of a correlation of n pairs."""
    if r is None or math.isnan(r) or n < 3:
        return None
    left = 1.0 - r * r
    if left <= 0.0:
        return 0.0
    return student_p(r * math.sqrt((n - 2) / left), n - 2)
