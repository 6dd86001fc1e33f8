"""Beta from stored monthly moments, merged for any window.

A month of a ticker keeps counts, sums and cross products of the returns inside the month,
and its edges: the first row, whose return needs the month before, and the last price. A
window adds up the months that lie in it whole and makes the returns between them from the
edges. Only the months that the window cuts, and that in which the market begins, are read
as rows. So a new month reads one month, and any window reads months, not days.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom.functions.numeric import log_return, ratio
from tickerloom.functions.timeline import at, since, with_previous
from tickerloom.operators.clean import recent_rows
from tickerloom.operators.returns import log_returns
from tickerloom.sources import commits

PAIRS = ["n", "sum_r", "sum_m", "sum_rm", "sum_mm"]
MARKET = ["market_n", "market_sum", "market_squares"]
SUMS = PAIRS + MARKET
EDGES = ["first_price", "first_market", "last_price"]
MOMENTS = (", ".join(["ticker string", *[f"{n} double" for n in SUMS + EDGES]])
           + ", month string")


def month_of(column: str = "date") -> Column:
    return F.date_format(column, "yyyy-MM")


def market_series(index: DataFrame) -> DataFrame:
    """(date, market_return) over all of the index, the first without a return."""
    rows = index.select("ticker", "date", "adj_close")
    return with_previous(rows, "ticker", "date", ["adj_close"]).select(
        "date", log_return(F.col("adj_close"), F.col("previous_adj_close")).alias("market_return"))


def _sums(r: Column, m: Column) -> dict[str, Column]:
    """What one row adds to each sum: covariance counts a day with both returns, variance
    one with the market's."""
    both = r.isNotNull() & m.isNotNull()
    pairs = [F.lit(1.0), r, m, r * m, m * m]
    market = [F.lit(1.0), m, m * m]
    return ({n: F.when(both, x).otherwise(0.0) for n, x in zip(PAIRS, pairs, strict=True)}
            | {n: F.when(m.isNotNull(), x).otherwise(0.0)
               for n, x in zip(MARKET, market, strict=True)})


def monthly_moments(companies: DataFrame, market: DataFrame) -> DataFrame:
    """Moments and edges of each ticker and month of `companies` against (date,
    market_return). Rows without ticker or date have no place in them.

    A ticker's rows are split by month for the look-back and combined before the shuffle.
    """
    rows = companies.select("ticker", "date", "adj_close", month_of().alias("month")).filter(
        F.col("ticker").isNotNull() & F.col("date").isNotNull())
    in_month = Window.partitionBy("ticker", "month").orderBy("date")
    inside = rows.withColumns({
        "r": log_return(F.col("adj_close"), F.lag("adj_close").over(in_month)),
        "is_first": F.row_number().over(in_month) == 1,
    }).join(market, "date", "left")
    m = F.col("market_return")
    added = {n: F.sum(F.when(F.col("is_first"), 0.0).otherwise(x)).alias(n)
             for n, x in _sums(F.col("r"), m).items()}
    first = F.col("is_first")
    edges = [F.max(F.when(first, F.col("adj_close"))).alias("first_price"),
             F.max(F.when(first, m)).alias("first_market"),
             F.max_by("adj_close", "date").alias("last_price")]
    return inside.groupBy("ticker", "month").agg(*added.values(), *edges).select(
        "ticker", *SUMS, *EDGES, "month")


def merged_beta(months: DataFrame, paired: bool = False) -> DataFrame:
    """(ticker, beta) over the given months of each ticker; there is a row per month, so a
    ticker's window is short.

    The first row of a month pairs with the last price of the ticker's month before; the
    first of all has no return but counts for the market's variance, as in `returns.beta`.
    """
    by_month = Window.partitionBy("ticker").orderBy("month")
    edge = log_return(F.col("first_price"), F.lag("last_price").over(by_month))
    with_edge = months.withColumn("edge", edge)
    between = _sums(F.col("edge"), F.col("first_market"))
    total = with_edge.groupBy("ticker").agg(
        *[F.sum(F.col(n) + x).alias(n) for n, x in between.items()])

    def moment(product: str, one: str, other: str, n: str) -> Column:
        """Mean of products less the product of means."""
        return ratio(F.col(product), F.col(n)) - ratio(F.col(one), F.col(n)) * ratio(
            F.col(other), F.col(n))

    covariance = moment("sum_rm", "sum_r", "sum_m", "n")
    variance = (moment("sum_mm", "sum_m", "sum_m", "n") if paired else
                moment("market_squares", "market_sum", "market_sum", "market_n"))
    # Equal market returns leave a variance of nothing but rounding.
    scale = ratio(F.col("sum_mm" if paired else "market_squares"),
                  F.col("n" if paired else "market_n"))
    return total.filter("market_n > 0").select(
        "ticker", F.when(variance > scale * 1e-14, ratio(covariance, variance)).alias("beta"))


def _cut_months(index: DataFrame, as_of: datetime, days: int) -> list[str]:
    """Months that have to be read as rows: those that the window cuts, and that in which
    the market's first return is missing."""
    start = as_of - timedelta(days=days)
    begins = recent_rows(index, as_of, days).agg(F.min("date").alias("date")).first()["date"]
    moments = [start, as_of] + ([begins] if begins else [])
    return sorted({f"{moment:%Y-%m}" for moment in moments})


def beta_from_moments(moments: DataFrame, companies: DataFrame, index: DataFrame,
                      as_of: datetime, days: int = 365 * 5, paired: bool = False) -> DataFrame:
    """`returns.beta` from `moments`, which `monthly_moments` made with `market_series`.

    Of `companies` at most three months are read; `index` is one instrument.
    """
    start = as_of - timedelta(days=days)
    cut = _cut_months(index, as_of, days)
    inside = F.col("month").between(f"{start:%Y-%m}", f"{as_of:%Y-%m}")
    whole = moments.filter(inside & ~F.col("month").isin(cut))
    ranges = [_month_range(companies, month) for month in cut]
    wanted = ranges[0]
    for other in ranges[1:]:
        wanted = wanted | other
    rows = companies.filter(wanted & since(companies, as_of, days))
    market = log_returns(index, as_of, days).select(
        "date", F.col("log_return").alias("market_return"))
    # Only days the market has rows on count, with or without a return.
    return merged_beta(whole.unionByName(monthly_moments(rows, market)), paired)


def _month_range(rows: DataFrame, month: str) -> Column:
    """Rows of one month, as a range that reaches the file scan."""
    begin = datetime.strptime(month, "%Y-%m")
    end = (begin + timedelta(days=32)).replace(day=1)
    dtype = rows.schema["date"].dataType
    found = (F.col("date") >= at(begin, dtype)) & (F.col("date") < at(end, dtype))
    if "year" in rows.columns:
        found = found & (F.col("year") == begin.year)
    return found


def refresh_moments(spark: SparkSession, companies: DataFrame, index: DataFrame,
                    months: list[str], path: str, n: int) -> list[str]:
    """Commit `n` of the stored moments at `path`: make the given months anew from their
    rows, and each month that follows one of them, for its first market return depends on
    the month before. All other months stay. Returns the months read.
    """
    if commits.is_committed(spark, path, n):
        return [month for month, _ in commits.folders_of(spark, path, n)]
    following = {_next_month(month) for month in months}
    touched = sorted(set(months) | following)
    known = commits.entries(spark, path, before=n)
    ranges = [_month_range(companies, month) for month in touched]
    wanted = F.lit(False)
    for one in ranges:
        wanted = wanted | one
    made = monthly_moments(companies.filter(wanted), market_series(index))
    written = commits.write_rows(made, path, n, "month", ["ticker"])
    commits.write_log(spark, path, n, [e for e in known if e[0] not in set(touched)] + written)
    return touched


def _next_month(month: str) -> str:
    return f"{datetime.strptime(month, '%Y-%m') + timedelta(days=32):%Y-%m}"


def read_moments(spark: SparkSession, path: str) -> DataFrame:
    return commits.open_folders(spark, path, commits.entries(spark, path), MOMENTS)
