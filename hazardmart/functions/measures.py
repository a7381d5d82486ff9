"""Aggregate and ratio expressions shared by the analytics.

Amounts are exact decimals end to end; a result is only cast to double after it was rounded.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardmart.schemas import AMOUNT_SUM


def total(measure: str) -> Column:
    return F.sum(measure).cast("bigint")


def total_where(condition: Column, measure: str) -> Column:
    """Conditional sum: rows outside the condition add zero."""
    return F.sum(F.when(condition, F.col(measure)).otherwise(0))


def count_where(condition: Column, measure: str) -> Column:
    return total_where(condition, measure).cast("bigint")


def whole(amount: Column) -> Column:
    """Amount rounded half away from zero to a whole number."""
    return F.round(amount, 0).cast("bigint")


def millions(amount: Column) -> Column:
    return F.round(amount / 1_000_000, 2).cast("double")


def exact_sum(measure: str) -> Column:
    """Sum of an amount in which a missing value counts as zero."""
    return F.sum(F.coalesce(F.col(measure), F.lit(0))).cast(AMOUNT_SUM)


def percent(part: Column, base: Column) -> Column:
    """Unrounded ``100 * part / base`` as a decimal, NULL for a zero base."""
    return F.lit(Decimal("100.0")) * part / F.nullif(base, F.lit(0))
