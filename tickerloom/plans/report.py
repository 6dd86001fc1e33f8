"""The company report: growth, risk, latest figures, attributes and histories per ticker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.sizing import broadcast_if_fits, fits
from tickerloom.functions.timeline import since
from tickerloom.operators.clean import company_rows, instrument_rows, recent_rows
from tickerloom.operators.dividends import dividend_growth, growth_with_latest
from tickerloom.operators.prices import nested_histories
from tickerloom.operators.returns import beta
from tickerloom.settings import AnalysisSettings
from tickerloom.sources.workspace import materialise, shared_folder

FIGURES = [
    "ticker", "name", "sector", "industry", "consecutive_growth_years", "dividend_frequency",
    "beta", "five_year_cagr", "last_dividend", "last_price",
]


def _growers(tape: DataFrame, settings: AnalysisSettings) -> tuple[DataFrame, DataFrame]:
    """Stored growers, and the company rows that the other parts have to read.

    Growers are usually few. Then everything else reads only their rows: the filter
    moves below the dedupe, and the five-year return pass, the largest shuffle,
    shrinks to them. When they are too many to broadcast, all rows stay and the joins
    at the end do the same work unaided.
    """
    rows = company_rows(tape, settings.benchmarks)
    growers = materialise(
        growth_with_latest(rows, settings.as_of, settings.min_streak),
        shared_folder(tape.sparkSession, "growers"),
    )
    if fits(growers):
        rows = rows.join(F.broadcast(growers.select("ticker")), "ticker", "left_semi")
    return growers, rows


def _with_risk(growers: DataFrame, rows: DataFrame, tape: DataFrame, companies: DataFrame,
               settings: AnalysisSettings) -> DataFrame:
    index = instrument_rows(tape, settings.market)
    risk = beta(rows, index, settings.as_of, settings.growth_days)
    return growers.join(risk, "ticker").join(companies, "ticker").select(*FIGURES)


def company_figures(tape: DataFrame, companies: DataFrame,
                    settings: AnalysisSettings) -> DataFrame:
    """The report without its histories, for tapes of any density."""
    growers, rows = _growers(tape, settings)
    priced = recent_rows(rows, settings.as_of, settings.history_days).select("ticker").distinct()
    figures = _with_risk(growers, rows, tape, companies, settings)
    return figures.join(priced, "ticker", "left_semi")


def company_report(tape: DataFrame, companies: DataFrame, settings: AnalysisSettings) -> DataFrame:
    """One row per qualifying company that has all parts; the others drop out.

    Histories are arrays over windows that are closed at both ends. Of a tape with very
    many times a day, `company_figures` with the flat `price_history` and
    `dividend_history` gives the same content without arrays.
    """
    growers, rows = _growers(tape, settings)
    figures = _with_risk(growers, rows, tape, companies, settings)
    histories = nested_histories(
        rows, settings.as_of, settings.price_days, settings.history_days
    )
    return figures.join(histories, "ticker")


def dropped_companies(tape: DataFrame, companies: DataFrame,
                      settings: AnalysisSettings) -> DataFrame:
    """Growers the report leaves out, with the first part they lack.

    Whether a part exists needs no returns and no arrays: one pass over the
    five-year rows finds market days and recent prices together.
    """
    rows = company_rows(tape, settings.benchmarks)
    as_of = settings.as_of
    growers = dividend_growth(rows, as_of, settings.min_streak).select("ticker")
    longest = max(settings.growth_days, settings.history_days)
    market_days = (
        recent_rows(instrument_rows(tape, settings.market), as_of, settings.growth_days)
        .select("date")
        .distinct()
        .withColumn("_traded", F.lit(True))
    )
    seen = (
        recent_rows(rows, as_of, longest)
        .join(broadcast_if_fits(market_days), "date", "left")
        .groupBy("ticker")
        .agg(
            F.max("_traded").alias("_market_day"),
            F.max(since(tape, as_of, settings.history_days)).alias("_recent"),
        )
    )
    named = companies.select("ticker", F.lit(True).alias("_named")).distinct()
    reason = (
        F.when(F.col("_market_day").isNull(), "no market day")
        .when(F.col("_named").isNull(), "no company")
        .when(~F.coalesce(F.col("_recent"), F.lit(False)), "no recent price")
    )
    return (
        growers.join(seen, "ticker", "left")
        .join(named, "ticker", "left")
        .select("ticker", reason.alias("reason"))
        .filter(F.col("reason").isNotNull())
    )
