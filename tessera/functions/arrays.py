"""Array math on logit columns (M1, M2) and log-factorials (for A15)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def argmax(a) -> Column:
    """M1: 0-based index of the maximum, first index on ties."""
    a = _c(a)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def log_sum_exp(a) -> Column:
    """ln(sum(exp(x))); the maximum is bound once, so the cost is linear in the classes."""
    return let(_c(a), lambda x: let(F.array_max(x), lambda m: m + F.log(
        F.aggregate(x, F.lit(0.0), lambda acc, v: acc + F.exp(v - m)))))


def log_softmax(a, temperature: float = 1.0) -> Column:
    a = _c(a)
    if temperature != 1.0:
        a = F.transform(a, lambda x: x / F.lit(float(temperature)))
    return let(a, lambda x: let(log_sum_exp(x), lambda lse: F.transform(x, lambda v: v - lse)))


def softmax(a, temperature: float = 1.0) -> Column:
    """M2: numerically stable softmax over a logit array."""
    return F.transform(log_softmax(a, temperature), lambda x: F.exp(x))


def to_double_array(a) -> Column:
    return F.transform(_c(a), lambda x: x.cast("double"))


def ln_factorial(n) -> Column:
    """ln(n!) as an expression (Spark has no lgamma).

    Exact via ``factorial`` up to 20, Stirling's series beyond (error below
    1e-15 relative there).  No lookup table, so nothing grows with N.
    """
    n = _c(n).cast("double")
    small = F.log(F.factorial(F.least(n, F.lit(20.0)).cast("int")).cast("double"))
    stirling = (n * F.log(n) - n + F.lit(0.5) * F.log(F.lit(2 * math.pi) * n)
                + F.lit(1 / 12) / n - F.lit(1 / 360) / F.pow(n, 3)
                + F.lit(1 / 1260) / F.pow(n, 5) - F.lit(1 / 1680) / F.pow(n, 7))
    return F.when(n <= 20, small).otherwise(stirling)
