"""Growth rate of the index and the risk-free rate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.numeric import growth_rate
from tickerloom.functions.timeline import since, until


def _index_growth(calendar: bool) -> Column:
    """Growth from the first to the last price, over five periods or the real span."""
    years = F.datediff(F.max("date"), F.min("date")) / 365 if calendar else 5
    return growth_rate(F.max_by("adj_close", "date"), F.min_by("adj_close", "date"), years)


def index_rate(tape: DataFrame, market: str, as_of: datetime, days: int = 365 * 5,
               calendar: bool = False) -> DataFrame:
    """Compound yearly growth of the index over the window.

    Always over five periods, unless `calendar` asks for the years really covered.
    """
    inside = tape.filter((F.col("ticker") == market) & since(tape, as_of, days))
    return inside.groupBy("ticker").agg(_index_growth(calendar).alias("rate"))


def risk_free_rate(tape: DataFrame, risk_free: str, as_of: datetime) -> DataFrame:
    """Last quote up to `as_of` of the risk-free instrument, given in percent, as a
    fraction."""
    return (
        tape.filter((F.col("ticker") == risk_free) & until(tape, as_of))
        .groupBy("ticker")
        .agg((F.max_by("adj_close", "date") / 100).alias("rate"))
    )


def benchmark_rates(tape: DataFrame, market: str, risk_free: str, as_of: datetime,
                    days: int = 365 * 5, calendar: bool = False) -> DataFrame:
    """Both rates, one row each; a benchmark without rows has none.

    `index_rate` and `risk_free_rate` in one pass: both end at `as_of`, and only the
    index has a beginning.
    """
    if market == risk_free:
        raise ValueError("the index and the risk-free instrument must differ")
    is_index = F.col("ticker") == market
    used = tape.filter(
        F.col("ticker").isin(market, risk_free) & until(tape, as_of)
        & (~is_index | since(tape, as_of, days))
    )
    percent = F.max_by("adj_close", "date") / 100
    return used.groupBy("ticker").agg(
        F.when(is_index, _index_growth(calendar)).otherwise(percent).alias("rate")
    )
