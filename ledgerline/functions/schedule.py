"""Calendar and instalment expressions for loans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instalment(principal: Column, rate_percent: Column, months: Column) -> Column:
    """Flat-rate instalment, rounded half-up to cents."""
    exact = principal * (F.lit(1.0) + rate_percent / 100) / months
    return F.round(exact.cast("decimal(28,10)"), 2).cast("double")


def months_after(moment: Column, months: Column) -> Column:
    """The same day and time `months` later, clamped to the end of a shorter month."""
    return moment + F.make_ym_interval(F.lit(0), months.cast("int"))
