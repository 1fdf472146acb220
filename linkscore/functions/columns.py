"""Column expressions shared by the operators. None of them needs a Python worker."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkscore import params as P


def weighted_mean(weights: Mapping[str, float]) -> Column:
    """Mean of the named columns by weight; a null column drops out together with its weight."""
    total = reduce(Column.__add__, (F.coalesce(F.col(c) * F.lit(float(w)), F.lit(0.0)) for c, w in weights.items()))
    weight = reduce(
        Column.__add__,
        (F.when(F.col(c).isNotNull(), F.lit(float(w))).otherwise(F.lit(0.0)) for c, w in weights.items()),
    )
    return F.try_divide(total, weight)


def category(score: Column, ladder: Sequence[tuple[float, str]], lowest: str = P.LOWEST_CATEGORY) -> Column:
    """Name of the highest step of ``ladder`` that ``score`` reaches; null stays null."""
    rungs = F.when(score.isNull(), F.lit(None).cast("string"))
    for bound, name in ladder:
        rungs = rungs.when(score >= F.lit(bound), F.lit(name))
    return rungs.otherwise(F.lit(lowest))


def category_number(name: Column) -> Column:
    """1 for the lowest category up to 4 for the best; anything else is null."""
    return reduce(
        lambda acc, item: acc.when(name == F.lit(item[0]), F.lit(item[1])),
        P.CATEGORY_NUMBERS.items(),
        F.when(name.isNull(), F.lit(None).cast("int")),
    )


def number_category(number: Column) -> Column:
    """Inverse of :func:`category_number` for a mean of category numbers."""
    return category(number, P.OVERALL_LADDER)


def clamp(value: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """``value`` kept inside [low, high]; null stays null."""
    return F.when(value < F.lit(low), F.lit(low)).when(value > F.lit(high), F.lit(high)).otherwise(value)


def db_linear(value: Column) -> Column:
    """A decibel value in the linear domain."""
    return F.pow(F.lit(10.0), value / F.lit(10.0))


def linear_db(value: Column) -> Column:
    """Inverse of :func:`db_linear`."""
    return F.lit(10.0) * F.log10(value)


def capped_percent(value: Column, digits: int = 4) -> Column:
    """100 x value, with the value capped at 1 and rounded; null stays null (``least`` would not)."""
    return F.round(F.when(value > 1, F.lit(1.0)).otherwise(value), digits) * F.lit(100.0)


def round2(value: Column) -> Column:
    """``round(value, 2)`` for values far below 1e9, mostly without decimal arithmetic.

    Spark rounds a double through its decimal text, which dominates the cost of a record. Away from
    a half, nearest-integer arithmetic gives the same two digits; only the rest takes the slow way.
    """
    scaled = value * F.lit(100.0)
    to_half = F.abs(scaled - F.floor(scaled) - F.lit(0.5))
    return F.when(to_half < F.lit(1e-6), F.round(value, 2)).otherwise(F.floor(scaled + F.lit(0.5)) / F.lit(100.0))


def hundredths(value: Column) -> Column:
    """A two-digit value as whole hundredths, so that its sum does not depend on row order; NaN is null."""
    return F.rint(value * F.lit(100.0)).try_cast("bigint")
