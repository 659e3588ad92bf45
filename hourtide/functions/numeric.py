"""Arithmetic helpers: guarded ratios and the two-sample Kolmogorov tail."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or(numerator: Column, denominator: Column, default=None) -> Column:
    """A quotient that is ``default`` where the denominator is zero."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return quotient if default is None else F.coalesce(quotient, F.lit(default).cast("double"))


def share(condition: Column) -> Column:
    """Fraction of rows where ``condition`` holds; a null condition counts as not holding."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def positive_if(condition: Column) -> Column:
    """Rows where ``condition`` holds; null counts as not holding."""
    return F.count(F.when(condition, F.lit(1)))


def kolmogorov_tail(d: Column, n1: Column, n2: Column, terms: int = 4) -> Column:
    """P(statistic >= d) under equal distributions, for the two-sample test.

    The limit law evaluated at a finite-sample corrected argument (J. Vrbik, 2018). Two equivalent
    series are used, each where it converges in a few terms.
    """
    root = F.sqrt((n1.cast("double") * n2.cast("double")) / (n1 + n2).cast("double"))
    plain = d * root
    x = plain + 1.0 / (6.0 * root) + (plain - 1.0) / (4.0 * root * root)
    upper = F.lit(0.0)
    for k in range(1, terms + 1):
        upper = upper + F.lit(2.0 * (-1) ** (k - 1)) * F.exp(-2.0 * k * k * x * x)
    lower = F.lit(0.0)
    for k in range(1, terms + 1):
        lower = lower + F.exp(-((2 * k - 1) ** 2) * math.pi**2 / (8.0 * x * x))
    tail = F.when(x >= 1.0, upper).otherwise(1.0 - math.sqrt(2 * math.pi) / x * lower)
    return F.when(plain <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0)))
