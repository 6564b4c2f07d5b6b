"""Aggregates, ratios and number formats shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(condition: Column) -> Column:
    """Share of rows that satisfy the condition; NULL on an empty input."""
    return F.try_divide(F.count_if(condition).cast("double"), F.count(F.lit(1)))


def percent(condition: Column, digits: int = 1) -> Column:
    return F.round(share(condition) * F.lit(100.0), digits)


def mean(value: Column, digits: int) -> Column:
    return F.round(F.avg(value.cast("double")), digits)


def short_number(value: Column) -> Column:
    """Two decimals at most, without trailing zeros: 12.5, 12, 0.07."""
    text = value.cast("decimal(18,2)").cast("string")
    return F.regexp_replace(text, r"\.?0+$", "")


def clamp(value: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(value, F.lit(high)))
