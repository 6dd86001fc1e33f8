"""Log returns and market beta."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions.numeric import log_return, ratio
from tickerloom.functions.timeline import with_previous
from tickerloom.operators.clean import recent_rows


def log_returns(tape: DataFrame, as_of: datetime, days: int = 365 * 5) -> DataFrame:
    """Log return of every row inside the window; a ticker's first row has none.

    The window filter comes first, so nothing is carried in from before it.
    """
    rows = recent_rows(tape, as_of, days).select("ticker", "date", "adj_close")
    return with_previous(rows, "ticker", "date", ["adj_close"]).select(
        "ticker", "date", "adj_close",
        log_return(F.col("adj_close"), F.col("previous_adj_close")).alias("log_return"),
    )


def market_returns(index: DataFrame, as_of: datetime, days: int = 365 * 5) -> DataFrame:
    """Log returns of the index rows alone: (date, market_return)."""
    return log_returns(index, as_of, days).select(
        "date", F.col("log_return").alias("market_return")
    )


def _slope(paired: bool) -> Column:
    """Covariance over market variance.

    Covariance skips a day when either return is missing, variance only when the
    market's is. `paired` takes both over the same days: the regression slope.
    """
    if paired:
        return F.regr_slope("log_return", "market_return")
    return ratio(F.covar_pop("log_return", "market_return"), F.var_pop("market_return"))


def beta(companies: DataFrame, index: DataFrame, as_of: datetime, days: int = 365 * 5,
         paired: bool = False) -> DataFrame:
    """Five-year daily beta of every ticker in `companies` against the `index` rows.

    The join carries no hint: its size at run time decides whether the market series is
    broadcast. The final aggregate combines per task first, so a long ticker costs no
    more than others.
    """
    return (
        log_returns(companies, as_of, days)
        .join(market_returns(index, as_of, days), "date")
        .groupBy("ticker")
        .agg(_slope(paired).alias("beta"))
    )


def month_end_prices(tape: DataFrame) -> DataFrame:
    """Last price of each ticker and month; `month_index` counts months from year 0."""
    month_index = (F.year("date") * 12 + F.month("date")).alias("month_index")
    return tape.groupBy("ticker", month_index).agg(
        F.max_by("adj_close", "date").alias("adj_close")
    )


def beta_monthly(companies: DataFrame, index: DataFrame, as_of: datetime,
                 days: int = 365 * 5) -> DataFrame:
    """Beta over month-end prices.

    A ticker has one row a month, so one window per ticker is bounded, and so is
    the broadcast index: one row per month between cut-off and `as_of`.
    """
    by_month = Window.partitionBy("ticker").orderBy("month_index")

    def monthly(tape: DataFrame) -> DataFrame:
        return month_end_prices(recent_rows(tape, as_of, days)).withColumn(
            "log_return", log_return(F.col("adj_close"), F.lag("adj_close").over(by_month))
        )

    market = monthly(index).select("month_index", F.col("log_return").alias("market_return"))
    return (
        monthly(companies)
        .join(F.broadcast(market), "month_index")
        .groupBy("ticker")
        .agg(_slope(paired=False).alias("beta_monthly"))
    )
