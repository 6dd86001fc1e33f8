"""The operators as temporary views, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickerloom.operators import (
    benchmarks,
    clean,
    coverage,
    dividends,
    membership,
    prices,
    returns,
)
from tickerloom.settings import AnalysisSettings


def register_views(tape: DataFrame, snapshots: DataFrame,
                   settings: AnalysisSettings) -> list[str]:
    """Register one view per result over a clean tape and membership snapshots.

    Views are lazy: a query reads only what it asks for. Returns their names.
    """
    s = settings
    rows = clean.company_rows(tape, s.benchmarks)
    index = clean.instrument_rows(tape, s.market)
    annual = dividends.annual_dividends(rows)
    views = {
        "tape": tape,
        "annual_dividends": annual,
        "growth_streaks": dividends.growth_streak(dividends.dividend_change(annual)),
        "dividend_growth": dividends.dividend_growth(rows, s.as_of, s.min_streak),
        "log_returns": returns.log_returns(rows, s.as_of, s.growth_days),
        "market_beta": returns.beta(rows, index, s.as_of, s.growth_days),
        "latest_prices": prices.latest_price(rows, s.as_of),
        "price_history": prices.price_history(rows, s.as_of, s.price_days),
        "dividend_history": prices.dividend_history(rows, s.as_of, s.history_days),
        "benchmark_rates": benchmarks.benchmark_rates(
            tape, s.market, s.risk_free, s.as_of, s.growth_days
        ),
        "companies": membership.latest_company(snapshots, as_of=s.as_of),
        "membership_changes": membership.snapshot_diff(snapshots, s.as_of),
        "membership_intervals": membership.membership_intervals(snapshots),
        "missing_ranges": coverage.missing_ranges(rows, index, s.as_of),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)
