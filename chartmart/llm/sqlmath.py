"""Numeric helpers as Spark SQL expressions."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def log_factorial(n: Column) -> Column:
    """``ln(n!)`` to double precision: a table below ten, Stirling's series from there."""
    small = F.element_at(F.array(*[F.lit(math.log(math.factorial(k))) for k in range(10)]), F.greatest(F.lit(1), F.least(n, F.lit(9)) + 1).cast("int"))
    x = F.greatest(n, F.lit(10)).cast("double")
    series = 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, 5)) - 1 / (1680 * F.pow(x, 7))
    return F.when(n < 10, small).otherwise(x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + series)


def log_choose(n: Column, k: Column) -> Column:
    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """``P(X <= k)`` for ``X`` binomial with ``n`` trials of chance ``p``, for ``k <= n p`` (else 1).

    The sum runs down from its largest term, as far as terms can matter.
    """
    steps = F.least(k, (50 + 40 * F.sqrt(n * p)).cast("long"))
    top = F.exp(log_choose(n, k) + k * math.log(p) + (n - k) * math.log1p(-p))
    start = F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term"))

    def add(acc: Column, i: Column) -> Column:
        down = acc["term"] * (k - i) * (1 - p) / ((n - k + i + 1) * p)
        return F.struct((acc["sum"] + down).alias("sum"), down.alias("term"))

    total = F.aggregate(F.sequence(F.lit(0).cast("long"), F.greatest(steps - 1, F.lit(0))), start, add, lambda acc: acc["sum"])
    return F.when(k > n * p, F.lit(1.0)).when(k == 0, top).otherwise(top * total)
