"""Annual dividends, growth streaks and growth rates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tickerloom.functions.numeric import growth_rate
from tickerloom.functions.timeline import until


def _by_year() -> WindowSpec:
    return Window.partitionBy("ticker").orderBy("year")


def _year(tape: DataFrame) -> Column:
    return (F.col("year") if "year" in tape.columns else F.year("date")).alias("year")


def _yearly_measures() -> list[Column]:
    paid = F.col("dividends") > 0
    return [
        F.sum("dividends").alias("annual_dividend"),
        F.count_if(paid).alias("dividend_frequency"),
    ]


def annual_dividends(tape: DataFrame) -> DataFrame:
    """Dividend total and number of payments by ticker and year."""
    return tape.groupBy("ticker", _year(tape)).agg(*_yearly_measures())


def annual_summary(tape: DataFrame) -> DataFrame:
    """`annual_dividends` plus each year's last price and last payment.

    One pass over the tape then feeds both the growth figures and the latest
    figures; all aggregation buffers are fixed-width, so it stays a hash aggregate.
    """
    paid = F.col("dividends") > 0
    paid_on = F.when(paid, F.col("date"))
    return tape.groupBy("ticker", _year(tape)).agg(
        *_yearly_measures(),
        F.max("date").alias("last_date"),
        F.max_by("adj_close", "date").alias("last_price"),
        F.max(paid_on).alias("last_paid"),
        F.max_by("dividends", paid_on).alias("last_dividend"),
    )


def dividend_change(annual: DataFrame, calendar: bool = False) -> DataFrame:
    """Change against the ticker's previous row, and whether it is an increase.

    A missing year is bridged unless `calendar` asks for adjacent years.
    """
    before = F.lag("annual_dividend").over(_by_year())
    if calendar:
        before = F.when(F.lag("year").over(_by_year()) == F.col("year") - 1, before)
    return annual.withColumn("dividend_increase", F.col("annual_dividend") - before).withColumn(
        "flag", F.when(F.col("dividend_increase") > 0, 1).otherwise(0)
    )


def growth_streak(changes: DataFrame) -> DataFrame:
    """Length of the run of increases that each year belongs to, so far.

    `grp` is the position of the last year without an increase. A ticker's first
    year never counts as one, so every year has such a position, and a single
    window sort finds both.
    """
    position = F.row_number().over(_by_year())
    last_break = F.last(F.when(F.col("flag") == 0, F.col("_position")), ignorenulls=True)
    return (
        changes.withColumn("_position", position)
        .withColumn("grp", last_break.over(_by_year()))
        .withColumn("consecutive_growth_years", F.col("_position") - F.col("grp"))
        .drop("_position")
    )


def qualify_growth(streaks: DataFrame, as_of: datetime, min_streak: int = 5,
                   calendar: bool = False) -> DataFrame:
    """Tickers whose streak reaches `min_streak` and still lives in the last full year.

    The growth rate looks over the last five *qualifying* years, so the streak
    filter comes before the frame: a streak that just reached the threshold has a
    rate of zero. The exponent is 1/5 whatever the frame holds. `calendar` compares
    with the dividend of exactly four years before instead, over four periods.
    """
    if calendar:
        base = F.first("annual_dividend").over(_by_year().rangeBetween(-4, -4))
        rated = streaks.withColumn(
            "five_year_cagr", growth_rate(F.col("annual_dividend"), base, 4)
        )
        return rated.filter(
            (F.col("consecutive_growth_years") >= min_streak) & (F.col("year") == as_of.year - 1)
        )
    frame = _by_year().rowsBetween(-4, 0)
    rate = growth_rate(
        F.last("annual_dividend").over(frame), F.first("annual_dividend").over(frame), 5
    )
    return (
        streaks.filter(F.col("consecutive_growth_years") >= min_streak)
        .withColumn("five_year_cagr", rate)
        .filter(F.col("year") == as_of.year - 1)
    )


def dividend_growth(tape: DataFrame, as_of: datetime, min_streak: int = 5,
                    calendar: bool = False) -> DataFrame:
    """Dividend growers with payment frequency, streak and growth rate.

    `calendar` wants adjacent years in a streak and four calendar years in the rate.
    """
    streaks = growth_streak(dividend_change(annual_dividends(tape), calendar))
    return qualify_growth(streaks, as_of, min_streak, calendar).select(
        "ticker", "dividend_frequency", "consecutive_growth_years", "five_year_cagr"
    )


def growth_with_latest(tape: DataFrame, as_of: datetime, min_streak: int = 5) -> DataFrame:
    """`dividend_growth` with the latest price and dividend, from the same pass over the
    rows up to `as_of`."""
    whole = Window.partitionBy("ticker")
    summary = annual_summary(tape.filter(until(tape, as_of))).withColumns({
        "last_price": F.max_by("last_price", "last_date").over(whole),
        "last_dividend": F.max_by("last_dividend", "last_paid").over(whole),
    })
    streaks = growth_streak(dividend_change(summary))
    return qualify_growth(streaks, as_of, min_streak).select(
        "ticker", "dividend_frequency", "consecutive_growth_years", "five_year_cagr",
        "last_price", "last_dividend",
    )


def dividend_cagr_calendar(tape: DataFrame, as_of: datetime, years: int = 4) -> DataFrame:
    """Growth rate between two calendar years, `years` intervals apart.

    Only those two years are read. Null without a base year or a base dividend.
    """
    last = as_of.year - 1
    first = last - years
    both = annual_dividends(tape).filter(F.col("year").isin([first, last]))
    return (
        both.groupBy("ticker")
        .agg(
            F.max(F.when(F.col("year") == last, F.col("annual_dividend"))).alias("_last"),
            F.max(F.when(F.col("year") == first, F.col("annual_dividend"))).alias("_first"),
            F.max("year").alias("year"),
        )
        .filter(F.col("year") == last)
        .select("ticker", "year",
                growth_rate(F.col("_last"), F.col("_first"), years).alias("calendar_cagr"))
    )
