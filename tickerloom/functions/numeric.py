"""Null-safe arithmetic: under ANSI mode a plain division by zero stops the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def growth_rate(last: Column, first: Column, periods: float | Column) -> Column:
    """Compound rate that turns `first` into `last` over `periods` steps."""
    return F.pow(ratio(last, first), ratio(F.lit(1.0), F.lit(periods))) - 1


def log_return(price: Column, previous: Column) -> Column:
    """Natural log return; null for a missing, zero or sign-changing price."""
    return F.log(ratio(price, previous))
