"""Numeric column helpers that stay NULL instead of failing under ANSI rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, NULL when whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole on decimals, so that halves round up exactly."""
    scaled = (part * 100).cast("decimal(24,0)")
    return F.round(F.try_divide(scaled, whole.cast("decimal(20,0)")), digits)


def percent_text(part: Column, whole: Column, digits: int) -> Column:
    shown = percent(part, whole, digits).cast(f"decimal(30,{digits})")
    return F.concat(shown.cast("string"), F.lit("%"))


def amount_where(condition: Column, amount: str) -> Column:
    """Sum of an amount over the rows that meet the condition, 0 when none does."""
    return F.coalesce(F.sum(F.when(condition, F.col(amount))), F.lit(0))
