"""Sums that come out the same whatever order the rows arrive in.

Floating-point sums change with partitioning, task retries and merge order. Measures are added as
decimals instead, and turned into doubles once, right before the last division. Exact sums can also
be subtracted, which is what makes the rolling statistics linear in the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VALUE = "decimal(18,4)"
ERROR = "decimal(18,6)"


def dec(column: Column | str, kind: str = VALUE) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(kind)


def square(column: Column | str, kind: str = VALUE) -> Column:
    value = dec(column, kind)
    return value * value


def exact_sum(column: Column | str, kind: str = VALUE) -> Column:
    return F.sum(dec(column, kind)).cast("double")


def exact_mean(column: Column | str, kind: str = VALUE) -> Column:
    """Mean of the non-null values; NULL when there are none."""
    value = dec(column, kind)
    return F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))


def mean_of(total: Column, count: Column) -> Column:
    return total.cast("double") / F.nullif(count, F.lit(0))


# Moments. Values are counted as whole numbers of a power of ten that the largest of them decides, so that
# neither a series around 1e7 nor one around 1e-5 loses digits. Sums of whole numbers are exact and can be
# subtracted, and n * sum(x^2) - sum(x)^2 has no cancellation: it is a whole number too, and the same whatever is
# taken off all values first.
DIGITS = 13


def finite(value: Column) -> Column:
    """The value, or NULL where it is no finite number."""
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def exponent_of(largest: Column, digits: int = DIGITS) -> Column:
    """The power of ten that gives values of up to `largest` about `digits` whole digits."""
    ten = F.floor(F.log10(F.nullif(largest, F.lit(0.0))))
    return F.least(F.coalesce(F.lit(digits - 1) - ten, F.lit(0)), F.lit(300)).cast("int")


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(10.0), exponent.cast("double"))


def whole(value: Column, exponent: Column) -> Column:
    """The value as a whole number of 10^-exponent; values that are not finite are NULL."""
    return F.rint(finite(value) * _power(exponent)).cast("long")


def wide(number: Column) -> Column:
    """A whole number whose square has room for its sums."""
    return number.cast("decimal(19,0)")


def whole_mean(total: Column, count: Column, exponent: Column) -> Column:
    """Mean from a sum of whole numbers. The sum is scaled back before it is divided: for up to 22 decimals that gives the
    double nearest to the exact sum, whatever the exponent."""
    total = total.cast("double")
    scaled = F.when(exponent >= 0, total / _power(exponent)).otherwise(total * _power(-exponent))
    return scaled / F.nullif(count, F.lit(0))


def whole_std(total: Column, squares: Column, count: Column, exponent: Column) -> Column:
    """Sample deviation from a count, a sum and a sum of squares of whole numbers; NULL for fewer than two."""
    total = total.cast("decimal(19,0)")
    numerator = count.cast("decimal(12,0)") * squares - total * total
    # Read as a decimal number, the numerator becomes the nearest double, whatever the exponent.
    scaled = F.concat(numerator.cast("string"), F.lit("e"), (-2 * exponent).cast("string")).cast("double")
    return F.sqrt(scaled / F.nullif(count * (count - 1), F.lit(0)))
