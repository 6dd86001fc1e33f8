"""Latest prices and recent histories."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.timeline import since, until
from tickerloom.operators.clean import recent_rows


def latest_price(tape: DataFrame, as_of: datetime) -> DataFrame:
    """Last price and last positive dividend by ticker as of `as_of`; no sort, fixed-width
    buffers."""
    paid_on = F.when(F.col("dividends") > 0, F.col("date"))
    return tape.filter(until(tape, as_of)).groupBy("ticker").agg(
        F.max_by("adj_close", "date").alias("last_price"),
        F.max_by("dividends", paid_on).alias("last_dividend"),
    )


def price_history(tape: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Recent prices, one row per ticker and date."""
    return recent_rows(tape, as_of, days).select("ticker", "date", "adj_close")


def dividend_history(tape: DataFrame, as_of: datetime, days: int = 365) -> DataFrame:
    """Recent payments, one row per ticker and date."""
    return recent_rows(tape, as_of, days).filter(F.col("dividends") > 0).select(
        "ticker", "date", "dividends"
    )


def nested_histories(tape: DataFrame, as_of: datetime, price_days: int = 30,
                     dividend_days: int = 365) -> DataFrame:
    """Both histories as date-ordered arrays, one row per ticker seen in the longer window.

    An array holds one element per distinct date of its window, which is closed at both
    ends: it does not grow with the tape. On a fine tape the flat histories are lighter.
    """
    dates = F.col("date").cast("timestamp").alias("date")
    price = F.struct(dates, F.col("adj_close").alias("adj close"))
    payment = F.struct(dates, F.col("dividends"))
    paid = (F.col("dividends") > 0) & since(tape, as_of, dividend_days)
    return (
        recent_rows(tape, as_of, max(price_days, dividend_days))
        .groupBy("ticker")
        .agg(
            F.sort_array(F.collect_list(F.when(since(tape, as_of, price_days), price)))
            .alias("price_history"),
            F.sort_array(F.collect_list(F.when(paid, payment))).alias("dividend_history"),
        )
    )
