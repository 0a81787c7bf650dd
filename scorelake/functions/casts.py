"""Casts that return NULL on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_int(text: Column) -> Column:
    """Whole number from text, rounding fractions half away from zero; NULL when not numeric."""
    return text.try_cast("decimal(38,0)").try_cast("int")


def safe_date(text: Column) -> Column:
    """Date from ``YYYY-MM-DD`` text; NULL otherwise."""
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"), F.trim(text).try_cast("date"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL when the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(part * F.lit(100.0) / F.nullif(whole, F.lit(0)).cast("double"), digits)
