"""Column expressions whose results must not depend on the engine's defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(c: Column) -> Column:
    """``yyyyMMdd`` text to a date; anything else, including impossible days, is NULL."""
    return F.try_to_date(F.trim(c), "yyyyMMdd")


def day_text(c: Column) -> Column:
    """The trimmed text if it is a real day written as ``yyyyMMdd``, else NULL."""
    return F.when(parse_day(c).isNotNull(), F.trim(c))


def month_of(c: Column) -> Column:
    """``yyyyMM`` of a ``yyyyMMdd`` text; NULL if it is not a real day."""
    return F.substring(day_text(c), 1, 6)


def month_start(month: Column) -> Column:
    return parse_day(F.concat(month, F.lit("01")))


def shift_month(month: Column, by: int) -> Column:
    """``yyyyMM`` moved by a number of months."""
    return F.date_format(F.add_months(month_start(month), by), "yyyyMM")


def months_crossed(start: Column, end: Column) -> Column:
    """Month boundaries between two dates, whatever the day of month."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


#: Decimal text with an exponent, or a word for infinity or not-a-number; Spark's cast would also take "30D" and "0x1p3".
NUMBER = "(?i)^\\s*[+-]?(\\d+\\.?\\d*(e[+-]?\\d+)?|\\.\\d+(e[+-]?\\d+)?|inf|infinity|nan)\\s*$"


NUMERIC_TYPES = "^(tinyint|smallint|int|bigint|float|double|decimal.*)$"


def real(c: Column) -> Column:
    """A number or numeric text as double, NULL where it is not a number.

    The type is known when the plan is optimised, so columns of numbers are only cast and no text is matched.
    """
    readable = F.typeof(c).rlike(NUMERIC_TYPES) | c.cast("string").rlike(NUMBER)
    return F.when(readable, c.try_cast("double"))


def whole(c: Column) -> Column:
    """A number or numeric text rounded half away from zero to int, NULL where that is impossible."""
    return rounded_to(c, "int")


def rounded_to(c: Column, kind: str) -> Column:
    """As :func:`whole`, in an integer type of choice."""
    value = real(c)
    return (value + F.signum(value) * 0.5).try_cast(kind)


def is_finite(c: Column) -> Column:
    """True only for real numbers: NULL, NaN and infinities are not finite.

    NaN sorts above every number in Spark, so this test has to come before any
    comparison with a bound.
    """
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def known(c: Column) -> Column:
    """The number, NULL instead of NaN, which Spark would place above all numbers."""
    return F.when(~F.isnan(c), c)


def ratio(top: Column, bottom: Column) -> Column:
    """Double division; NULL when the divisor is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def share_of(n: Column, share: float) -> Column:
    """``max(1, ceil(share * n))`` in double arithmetic, as a row count."""
    return F.greatest(F.lit(1).cast("bigint"), F.ceil(F.lit(float(share)) * n.cast("double")).cast("bigint"))
