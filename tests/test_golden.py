"""Values of the hand-written tape."""

from dataclasses import replace
from datetime import datetime

import pytest
from golden import SETTINGS, by_ticker, companies, raw_tape, snapshots, tape_rows
from pyspark.sql import functions as F

from tickerloom.operators import benchmarks, clean, dividends, prices, returns, valuation
from tickerloom.plans.report import company_figures, company_report, dropped_companies
from tickerloom.plans.views import register_views

S = SETTINGS


@pytest.fixture(scope="module")
def tape(spark):
    return clean.clean_tape(raw_tape(spark)).persist()


@pytest.fixture(scope="module")
def rows(tape):
    return clean.company_rows(tape, S.benchmarks)


@pytest.fixture(scope="module")
def index(tape):
    return clean.instrument_rows(tape, S.market)


def near(expected):
    return {k: v if v is None else pytest.approx(v, abs=1e-8) for k, v in expected.items()}


def test_one_copy_per_day(tape):
    assert tape.count() == 45


def test_annual_dividends(rows):
    found = dividends.annual_dividends(rows).filter("year = 2023")
    assert by_ticker(found, "annual_dividend", "dividend_frequency") == {
        "AAA": (1.65, 1), "BBB": (1.0, 2), "CCC": (1.2, 1), "EEE": (0.0, 0),
    }


def test_streaks(rows):
    changes = dividends.dividend_change(dividends.annual_dividends(rows))
    streaks = dividends.growth_streak(changes)
    assert by_ticker(streaks.filter("year = 2023"), "consecutive_growth_years") == {
        "AAA": 7, "BBB": 5, "CCC": 1, "EEE": 0,
    }
    assert by_ticker(streaks.filter("year = 2021 and ticker = 'CCC'"),
                     "consecutive_growth_years") == {"CCC": 5}


def test_growth_rate_sees_qualifying_years_only(rows):
    found = dividends.dividend_growth(rows, S.as_of, 5)
    assert by_ticker(found, "dividend_frequency", "consecutive_growth_years") == {
        "AAA": (1, 7), "BBB": (2, 5),
    }
    assert by_ticker(found, "five_year_cagr") == near({"AAA": 0.03340648, "BBB": 0.0})


def test_calendar_rate(rows):
    found = dividends.dividend_cagr_calendar(rows, S.as_of)
    assert by_ticker(found, "calendar_cagr") == near(
        {"AAA": 0.08286839, "BBB": 0.13621937, "CCC": -0.01981179, "EEE": None}
    )


def test_calendar_streak_breaks_at_a_missing_year(spark):
    rows = [("A", datetime(y, 6, 1), 1.0, float(y)) for y in (2018, 2019, 2021, 2022, 2023)]
    tape = clean.clean_tape(raw_tape(spark, rows))
    as_of = datetime(2024, 7, 1)
    bridged = dividends.dividend_growth(tape, as_of, 1)
    adjacent = dividends.dividend_growth(tape, as_of, 1, calendar=True)
    assert by_ticker(adjacent, "five_year_cagr") == near({"A": (2023 / 2019) ** 0.25 - 1})
    assert by_ticker(bridged, "consecutive_growth_years") == {"A": 4}
    assert by_ticker(adjacent, "consecutive_growth_years") == {"A": 2}


def test_beta(rows, index):
    assert by_ticker(returns.beta(rows, index, S.as_of), "beta") == near(
        {"AAA": 0.07773310, "BBB": 0.11298427, "CCC": 0.0, "EEE": 0.77108759}
    )
    assert by_ticker(returns.beta(rows, index, S.as_of, paired=True), "beta") == near(
        {"AAA": 0.07773310, "BBB": 0.10029931, "CCC": 0.0, "EEE": 1.68879812}
    )


def test_beta_of_the_index_is_one(index):
    assert by_ticker(returns.beta(index, index, S.as_of), "beta") == near({"^GSPC": 1.0})


def test_beta_without_market_movement_is_null(spark):
    days = [datetime(2024, 1, d) for d in (2, 3, 4)]
    flat = [("^GSPC", d, 100.0, 0.0) for d in days]
    moving = [("AAA", d, 10.0 + d.day, 0.0) for d in days]
    tape = clean.clean_tape(raw_tape(spark, flat + moving))
    found = returns.beta(clean.company_rows(tape, S.benchmarks),
                         clean.instrument_rows(tape, S.market), S.as_of)
    assert by_ticker(found, "beta") == {"AAA": None}


def test_monthly_beta_of_the_index_is_one(index):
    found = returns.beta_monthly(index, index, S.as_of)
    assert by_ticker(found, "beta_monthly") == near({"^GSPC": 1.0})


def test_latest(rows):
    assert by_ticker(prices.latest_price(rows, S.as_of), "last_price", "last_dividend") == {
        "AAA": (91.0, 0.45), "BBB": (26.0, 0.5), "CCC": (30.0, 1.2), "EEE": (14.0, None),
    }


def test_latest_from_the_annual_pass(rows):
    found = dividends.growth_with_latest(rows, S.as_of, 5)
    assert by_ticker(found, "last_price", "last_dividend") == {
        "AAA": (91.0, 0.45), "BBB": (26.0, 0.5),
    }


def test_histories(rows):
    nested = prices.nested_histories(rows, S.as_of)
    sizes = nested.select("ticker", F.size("price_history").alias("p"),
                          F.size("dividend_history").alias("d"))
    assert by_ticker(sizes, "p", "d") == {"AAA": (3, 1), "BBB": (2, 0), "CCC": (1, 0), "EEE": (2, 0)}
    dates = by_ticker(nested, "price_history")["AAA"]
    assert [r["date"].day for r in dates] == [3, 14, 28]
    assert prices.price_history(rows, S.as_of).count() == 8
    assert prices.dividend_history(rows, S.as_of).count() == 1


def test_benchmark_rates(tape):
    found = benchmarks.benchmark_rates(tape, S.market, S.risk_free, S.as_of)
    assert by_ticker(found, "rate") == near({"^GSPC": 0.12723451, "^TNX": 0.043})
    apart = benchmarks.index_rate(tape, S.market, S.as_of).unionByName(
        benchmarks.risk_free_rate(tape, S.risk_free, S.as_of))
    assert by_ticker(apart, "rate") == by_ticker(found, "rate")


def test_report_and_value(spark, tape):
    report = company_report(tape, companies(spark), S)
    assert sorted(r["ticker"] for r in report.collect()) == ["AAA", "BBB"]
    rates = benchmarks.benchmark_rates(tape, S.market, S.risk_free, S.as_of)
    value = valuation.gordon_value(report, rates, S.market, S.risk_free)
    found = by_ticker(value, "required_return", "next_dividend", "fair_price")
    assert found["AAA"] == pytest.approx((0.049548, 0.465033, 28.810), rel=1e-4)
    assert found["BBB"] == pytest.approx((0.052517, 1.0, 19.041), rel=1e-4)


def test_views_answer_sql(spark, tape):
    names = register_views(tape, snapshots(spark), S)
    found = spark.sql("""
        SELECT g.ticker, c.name, l.last_price FROM dividend_growth g
        JOIN companies c USING (ticker) JOIN latest_prices l USING (ticker)
        JOIN market_beta b USING (ticker) ORDER BY 1
    """).collect()
    assert [tuple(r) for r in found] == [
        ("AAA", "AAA at 2024-07-01", 91.0), ("BBB", "BBB at 2024-07-01", 26.0)]
    assert all(spark.table(n).count() > 0 for n in names)


def test_figures_are_the_report_without_histories(spark, tape):
    figures = company_figures(tape, companies(spark), S)
    report = company_report(tape, companies(spark), S)
    assert sorted(figures.collect()) == sorted(report.select(figures.columns).collect())
    late = S.as_of.replace(year=2026)
    assert company_figures(tape, companies(spark), replace(S, as_of=late)).count() == 0


def test_fine_tape_is_answered(spark, tape):
    """One row off a quarter hour changes its ticker's latest price and nothing else."""
    tick = raw_tape(spark, [("AAA", datetime(2024, 6, 28, 9, 31), 91.5, 0.0)])
    fine = tape.unionByName(clean.clean_tape(tick))
    for plan in (company_figures, company_report):
        assert by_ticker(plan(fine, companies(spark), S), "last_price") == {
            "AAA": 91.5, "BBB": 26.0}


def test_report_with_too_many_growers_to_broadcast(spark, tape, monkeypatch):
    import tickerloom.plans.report as report

    few = {r["ticker"]: r for r in company_report(tape, companies(spark), S).collect()}
    monkeypatch.setattr(report, "fits", lambda *a, **k: False)
    assert {r["ticker"]: r for r in company_report(tape, companies(spark), S).collect()} == few


def test_no_value_when_growth_exceeds_the_required_return(spark):
    report = spark.createDataFrame(
        [("A", 0.1, 0.5, 1, 1.0)],
        "ticker string, beta double, five_year_cagr double, dividend_frequency long, last_dividend double",
    )
    rates = spark.createDataFrame([("m", 0.08), ("f", 0.04)], "ticker string, rate double")
    assert by_ticker(valuation.gordon_value(report, rates, "m", "f"), "fair_price") == {"A": None}


def test_dropped_companies_name_their_missing_part(spark, tape):
    known = companies(spark).filter("ticker <> 'BBB'")
    assert by_ticker(dropped_companies(tape, known, S), "reason") == {"BBB": "no company"}

    def audit(day):
        grower = [("OLD", datetime(y, 6, day), 5.0, float(y)) for y in range(2010, 2024)]
        tape = clean.clean_tape(raw_tape(spark, tape_rows() + grower))
        named = companies(spark).unionByName(
            companies(spark).limit(1).withColumn("ticker", F.lit("OLD"))
        )
        return by_ticker(dropped_companies(tape, named, S), "reason")

    assert audit(day=20) == {"OLD": "no market day"}
    assert audit(day=15) == {"OLD": "no recent price"}
