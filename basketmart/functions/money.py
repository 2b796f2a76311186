"""Exact money arithmetic.

Money columns are doubles. Adding doubles depends on the order rows arrive in, so a retried task may change the last
digits of a sum. Every money sum here adds whole ten-thousandths instead: exact for amounts with up to four decimals
(further ones are rounded; ``source_checks`` counts them) and independent of row order. Up to a basket, household or
product-household they are plain bigint additions inside whole-stage codegen; above that, where a sum may pass 9.2e18
units, they are added as decimals. ``*_u`` columns hold units while a plan still has levels of aggregation to go.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS_PER_ONE = 10_000


def units(amount: Column | str) -> Column:
    """Amount in whole ten-thousandths (bigint)."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return F.floor(column * F.lit(float(UNITS_PER_ONE)) + F.lit(0.5))


def wide_sum(column: Column | str) -> Column:
    """Exact sum of units that may exceed a bigint: decimal(30, 0)."""
    value = F.col(column) if isinstance(column, str) else column
    return F.sum(value.cast("decimal(20,0)"))


def wide_units(amount: Column | str) -> Column:
    """Units of an amount that may itself be a large sum, as decimal."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return (column.cast("decimal(28,4)") * F.lit(UNITS_PER_ONE)).cast("decimal(38,0)")


def money(total_units: Column | str) -> Column:
    """Units back to a double amount."""
    column = F.col(total_units) if isinstance(total_units, str) else total_units
    return column / F.lit(float(UNITS_PER_ONE))


def money_sum(amount: Column | str) -> Column:
    """Exact ``sum`` of a money column, as double."""
    return money(wide_sum(units(amount)))


def mean_money(total_units: Column, count: Column) -> Column:
    """Average amount from a sum of units and a row count; NULL for an empty group."""
    return F.when(count > 0, total_units / (count * F.lit(float(UNITS_PER_ONE))))


def positive_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` where the denominator is positive, otherwise NULL."""
    return F.when(denominator > 0, numerator.cast("double") / denominator)


def nonzero_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` unless the denominator is zero (then NULL)."""
    return F.when(denominator != 0, numerator.cast("double") / denominator)


def discount_units() -> Column:
    """All three recorded discounts of a staged line, in units."""
    return units("retail_discount_amt") + units("coupon_discount_amt") + units("coupon_match_discount_amt")
