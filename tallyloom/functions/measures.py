"""Exact decimal measures and their display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Result types. Sums are never narrowed: totals over very large facts must fit.
UNITS = "decimal(38,1)"
REVENUE = "decimal(38,3)"
AVERAGE = "decimal(38,2)"

# Operand types, so that a product with its step stays below 38 digits.
_MONEY = "decimal(31,3)"
_COUNT = "decimal(31,1)"


def line_revenue() -> Column:
    return F.col("price_unit") * F.col("quantity")


def month_of(date: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(date, "MM")


def total_units() -> Column:
    return F.sum("units").cast(UNITS)


def total_revenue() -> Column:
    return F.sum("revenue").cast(REVENUE)


def _units_of(amount: Column, step: int, kind: str) -> Column:
    """A decimal as a whole number of its smallest unit, which is 1 / step."""
    return (amount.cast(kind) * F.lit(step)).cast("decimal(34,0)")


def _hundredths(part: Column, whole: Column) -> Column:
    """part / whole, both whole numbers, as that many hundredths; halves go away from zero.

    Integer arithmetic throughout: the quotient of two decimals is cut after some digits, and
    one just below a half would then round up. A zero divisor is an error in ANSI mode.
    """
    doubled = F.lit(2) * F.abs(part) + F.abs(whole)
    quotient = F.call_function("div", doubled, F.lit(2) * F.abs(whole)).cast("decimal(20,0)")
    hundredths = (quotient * F.lit("0.01").cast("decimal(2,2)")).cast(AVERAGE)
    return F.when((part < 0) != (whole < 0), -hundredths).otherwise(hundredths).cast(AVERAGE)


def average_per_count(total: Column, count: Column) -> Column:
    """Average to two decimals, halves away from zero. A zero count is an error in ANSI mode."""
    # Mils over ten counts are cents.
    return _hundredths(_units_of(total, 1000, _MONEY), F.lit(10) * count.cast("decimal(20,0)"))


def average_per_unit(total: Column, units: Column) -> Column:
    # Mils over tenths of units are cents.
    return _hundredths(_units_of(total, 1000, _MONEY), _units_of(units, 10, _COUNT))


def share_percent(part: Column, whole: Column) -> Column:
    """Percent of a whole to two decimals; NULL where the whole is zero."""
    some = F.when(whole != 0, _units_of(whole, 1000, _MONEY))
    return _hundredths(F.lit(10_000) * _units_of(part, 1000, _MONEY).cast("decimal(30,0)"), some)


def money_text(amount: Column, digits: int = 2) -> Column:
    """``1234.5`` -> ``$1,234.50``. For display only, after all arithmetic."""
    return F.concat(F.lit("$"), F.format_number(amount, digits))


def month_label(date: Column) -> Column:
    """``2024-06-01`` -> ``Jun 2024``."""
    return F.date_format(date, "MMM yyyy")
