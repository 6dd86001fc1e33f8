"""Days on which a ticker has no row, one by one or as ranges to fetch."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.functions.sizing import broadcast_if_fits
from tickerloom.functions.timeline import until, with_previous


def coverage_gaps(tape: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Missing weekdays between a ticker's first and last date, or up to and with the day
    of `as_of`; later rows then change nothing.

    Each row looks back to the ticker's previous day and lists the weekdays in
    between, so the work follows the data: there is no calendar to join with.
    """
    rows = tape if as_of is None else tape.filter(until(tape, as_of))
    days = rows.select("ticker", F.to_date("date").alias("day")).distinct()
    if as_of is not None:
        day_after = F.lit((as_of + timedelta(days=1)).date()).alias("day")
        days = days.union(rows.select("ticker").distinct().select("ticker", day_after))
    gap = F.sequence(F.date_add("previous_day", 1), F.date_sub("day", 1))
    return (
        with_previous(days, "ticker", "day", ["day"])
        .filter(F.datediff("day", "previous_day") > 1)
        .select("ticker", F.explode(gap).alias("missing_day"))
        .filter(F.weekday("missing_day") < 5)
    )


def trading_days(index: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """(day, number) of the days that the index has rows on, counted from 1.

    There is a row per calendar day at most, some 37 000 a century, so one task may order
    them.
    """
    rows = index if as_of is None else index.filter(until(index, as_of))
    days = rows.select(F.to_date("date").alias("day")).filter(F.col("day").isNotNull()).distinct()
    return days.withColumn("number", F.row_number().over(Window.orderBy("day")).cast("long"))


def missing_ranges(tape: DataFrame, index: DataFrame,
                   as_of: datetime | None = None) -> DataFrame:
    """ticker, start_date, end_date, n_days: stretches of trading days without a row.

    A stretch begins after a row of the ticker and ends before its next, or, with `as_of`,
    with the last trading day until then; it may span weekends and holidays, as the market
    did not trade. `end_date` is the day after its last trading day. Days on which the
    market did not trade are not missed, and rows on them are passed over. Missing days
    are never listed one by one: a stretch is the jump between two numbers of days.
    """
    calendar = trading_days(index, as_of)
    small = broadcast_if_fits(calendar)
    rows = tape if as_of is None else tape.filter(until(tape, as_of))
    held = (rows.select("ticker", F.to_date("date").alias("day")).distinct()
            .join(small, "day").select("ticker", "day", "number"))
    if as_of is not None:
        # One more number than there are days stands for the day after the last.
        end = calendar.agg((F.max("number") + 1).alias("number"),
                           F.date_add(F.max("day"), 1).alias("day")).filter("number IS NOT NULL")
        last = held.select("ticker").distinct().join(F.broadcast(end))
        held = held.unionByName(last.select("ticker", "day", "number"))
    jumps = with_previous(held, "ticker", "day", ["number"]).filter(
        F.col("number") - F.col("previous_number") > 1)
    starts = small.select((F.col("number") - 1).alias("previous_number"),
                          F.col("day").alias("start_date"))
    ends = small.select((F.col("number") + 1).alias("number"),
                        F.date_add("day", 1).alias("end_date"))
    return (
        jumps.join(starts, "previous_number").join(ends, "number")
        .select("ticker", "start_date", "end_date",
                (F.col("number") - F.col("previous_number") - 1).alias("n_days"))
    )
