"""Rounding rules and order-independent means."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(28,6)"
_EXACT_LIMIT = 1e22


def half_even(c: Column, digits: int) -> Column:
    """Scaled rounding with ties to even: the rule of the KPI layer."""
    scale = float(10**digits)
    return F.rint(c * scale) / scale


def half_up(c: Column, digits: int) -> Column:
    """Scaled rounding with ties away from zero: the rule of the risk views."""
    scale = float(10**digits)
    return F.round(c * scale) / scale


def exact(c: Column, kind: str = _EXACT, limit: float = _EXACT_LIMIT) -> Column:
    """A double as a decimal of six digits after the point; null stays null.

    Values that the decimal cannot hold, infinities and NaN fail the query: nothing is dropped.
    """
    value = c.cast("double")
    beyond = F.raise_error(F.concat(F.lit("No exact sum of "), value.cast("string"))).cast(kind)
    return F.when(value.isNull() | (F.abs(value) < limit), value.try_cast(kind)).otherwise(beyond)


def exact_sum(c: Column) -> Column:
    """Decimal sum that does not depend on the order in which partitions are merged."""
    return F.sum(exact(c))


def exact_mean(c: Column) -> Column:
    """Mean of the non-null values, each taken to six decimals.

    Averages of two-digit measures often land on a rounding tie, where a double sum gives a
    different last digit for each merge order. With an infinity or NaN among the values the mean
    is the one IEEE arithmetic gives, in any order.
    """
    value = c.cast("double")
    finite = F.abs(value) < float("inf")
    mean = exact_sum(F.when(finite, value)).cast("double") / F.nullif(F.count(value), F.lit(0))
    return F.when(F.count_if(~finite) > 0, F.sum(F.when(~finite, value))).otherwise(mean)


def clip(c: Column, low: float, high: float) -> Column:
    """Limit to a range; null stays null although `least` and `greatest` skip nulls."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))
