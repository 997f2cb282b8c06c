"""Special functions and tail probabilities as column expressions.

Meant for tables of results, one row per test: the loops run inside the row, without Python.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the Lanczos approximation for g = 7.
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)
#: Steps of a continued fraction or series, and the degrees of freedom from which a t distribution counts as normal and a
#: chi-squared one as a cube of normal numbers.
STEPS, MANY, LARGE = 600, 1e5, 1e4
_TINY = 1e-300


def _d(x: Column | float) -> Column:
    return x.cast("double") if isinstance(x, Column) else F.lit(float(x))


def _log_gamma_above(y: Column) -> Column:
    """log_gamma from one half on."""
    y = y - 1
    total = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        total = total + F.lit(c) / (y + i)
    t = y + 7.5
    return 0.5 * math.log(2 * math.pi) + (y + 0.5) * F.log(t) - t + F.log(total)


def log_gamma(x: Column | float) -> Column:
    """Natural logarithm of the gamma function of a positive number, to about 14 digits."""
    x = _d(x)
    return F.when(x >= 0.5, _log_gamma_above(x)).when(x > 0, F.log(math.pi / F.sin(math.pi * x)) - _log_gamma_above(1 - x))


def log_choose(n: Column, k: Column) -> Column:
    """Natural logarithm of the number of ways to pick k of n, null outside 0 to n."""
    return F.when((k >= 0) & (k <= n), _log_gamma_above(_d(n + 1)) - _log_gamma_above(_d(k + 1)) - _log_gamma_above(_d(n - k + 1)))


def _held(x: Column) -> Column:
    """The number, or a tiny one instead of zero."""
    return F.when(F.abs(x) < _TINY, F.lit(_TINY)).otherwise(x)


def beta_share(a: Column | float, b: Column | float, x: Column) -> Column:
    """Regularised incomplete beta function, by its continued fraction."""
    a, b, x = _d(a), _d(b), _d(x)
    # The fraction converges fast below the mean; above it the complement is taken.
    turn = x > (a + 1) / (a + b + 2)

    def part(a: Column, b: Column, x: Column) -> Column:
        front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1 - x)) / a
        first = 1 / _held(1 - (a + b) * x / (a + 1))

        def step(s: Column, k: Column) -> Column:
            m = F.floor(k / 2)
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            term = F.when(k % 2 == 0, even).otherwise(odd)
            d, c = 1 / _held(1 + term * s["d"]), _held(1 + term / s["c"])
            return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

        start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
        return front * F.aggregate(F.sequence(F.lit(2), F.lit(STEPS)), start, step, lambda s: s["h"])

    value = F.when(turn, 1 - part(b, a, 1 - x)).otherwise(part(a, b, x))
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(value)


def gamma_tail(a: Column | float, x: Column) -> Column:
    """Upper regularised incomplete gamma function, by its series below a + 1 and its continued fraction above."""
    a, x = _d(a), _d(x)
    front = F.exp(a * F.log(x) - x - log_gamma(a))

    def grow(s: Column, k: Column) -> Column:
        term = s["t"] * x / (a + k)
        return F.struct(term.alias("t"), (s["h"] + term).alias("h"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.struct((1 / a).alias("t"), (1 / a).alias("h")), grow, lambda s: s["h"])

    def step(s: Column, k: Column) -> Column:
        term, b = -k * (k - a), x + 2 * k + 1 - a
        d, c = 1 / _held(term * s["d"] + b), _held(b + term / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

    first = 1 / _held(x + 1 - a)
    start = F.struct(F.lit(1 / _TINY).alias("c"), first.alias("d"), first.alias("h"))
    fraction = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step, lambda s: s["h"])
    return F.when(x <= 0, 1.0).when(x < a + 1, F.greatest(F.lit(0.0), 1 - front * series)).when(x == float("inf"), 0.0).otherwise(front * fraction)


def normal_two_sided(z: Column) -> Column:
    """Chance that a standard normal number is at least as far from zero."""
    return gamma_tail(0.5, z * z / 2)


def t_two_sided(t: Column, dof: Column) -> Column:
    """Chance that Student's t is at least as far from zero; normal from MANY degrees of freedom on."""
    return F.when(dof > MANY, normal_two_sided(t)).otherwise(beta_share(dof / 2, 0.5, dof / (dof + t * t)))


def normal_above(z: Column) -> Column:
    """Chance that a standard normal number is at least as high."""
    half = normal_two_sided(z) / 2
    return F.when(z >= 0, half).otherwise(1 - half)


def chi_squared_tail(x: Column, dof: Column) -> Column:
    """Chance that a chi-squared number is at least as high; from LARGE degrees of freedom on by the normal cube root."""
    part = F.lit(2.0) / (9 * dof)
    return F.when(dof > LARGE, normal_above((F.pow(x / dof, F.lit(1 / 3)) - (1 - part)) / F.sqrt(part))).otherwise(gamma_tail(dof / 2, x / 2))


def hypergeometric_tail(hits: Column, drawn: Column, marked: Column, total: Column) -> Column:
    """Chance of at least so many marked ones among those drawn without return, summed from the logarithm of the first term."""
    hits, drawn, marked, total = (c.cast("bigint") for c in (hits, drawn, marked, total))
    low = F.greatest(hits, drawn + marked - total, F.lit(0))
    high = F.least(drawn, marked)
    first = log_choose(marked, low) + log_choose(total - marked, drawn - low) - log_choose(total, drawn)

    def step(s: Column, i: Column) -> Column:
        ratio = ((marked - i + 1).cast("double") * (drawn - i + 1)) / (i.cast("double") * (total - marked - drawn + i))
        term = s["t"] * ratio
        return F.struct(term.alias("t"), (s["h"] + term).alias("h"))

    # Terms relative to the first: their sum is at least 1, so nothing is lost when the first is tiny.
    rest = F.when(high > low, F.sequence(low + 1, high)).otherwise(F.array().cast("array<bigint>"))
    total_of = F.aggregate(rest, F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("h")), step, lambda s: s["h"])
    chance = F.exp(first + F.log(total_of))
    return F.when(low > high, 0.0).when(chance > 1, 1.0).otherwise(chance)


def fisher_two_sided(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Fisher's exact test of a table of two rows (a, b) and (c, d): all tables at most as likely, margins fixed."""
    a, b, c, d = (x.cast("bigint") for x in (a, b, c, d))
    row, col, total = a + b, a + c, a + b + c + d
    low, high = F.greatest(F.lit(0), row + col - total), F.least(row, col)

    def chance(k: Column) -> Column:
        return log_choose(col, k) + log_choose(total - col, row - k) - log_choose(total, row)

    seen = chance(a) + 1e-7

    def step(s: Column, i: Column) -> Column:
        term = s["t"] + F.when(i == low, 0.0).otherwise(
            F.log((col - i + 1).cast("double") * (row - i + 1)) - F.log(i.cast("double") * (total - col - row + i)))
        return F.struct(term.alias("t"), (s["h"] + F.when(term <= seen, F.exp(term)).otherwise(0.0)).alias("h"))

    start = F.struct(chance(low).alias("t"), F.lit(0.0).alias("h"))
    chance_of = F.aggregate(F.sequence(low, high), start, step, lambda s: s["h"])
    return F.when(chance_of > 1, 1.0).otherwise(chance_of)
