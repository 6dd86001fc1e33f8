"""Behaviour that arrival order, bad values or edge sizes must not change."""

import math
import random
from datetime import datetime, timedelta

import pytest
from golden import SETTINGS, by_ticker, raw_tape, snapshots, tape_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickerloom.functions import sizing
from tickerloom.functions.timeline import since, with_previous
from tickerloom.operators import (
    benchmarks,
    clean,
    coverage,
    dividends,
    membership,
    prices,
    returns,
)
from tickerloom.schemas import SNAPSHOT
from tickerloom.sources import routing

S = SETTINGS


def test_copies_keep_the_newest_file_then_the_smallest_row(spark):
    day = datetime(2024, 1, 2)
    raw = spark.createDataFrame(
        [("A", day, 5.0, 0.0, -1), ("A", day, 9.0, 0.0, -2), ("A", day, 8.0, 0.1, -2),
         ("A", day, None, 0.0, -2), ("B", day, 3.0, 0.2, None), ("B", day, 4.0, 0.1, 7)],
        "ticker string, date timestamp, adj_close double, dividends double, source_rank long",
    )
    found = by_ticker(clean.dedupe_tape(raw), "adj_close", "dividends")
    assert found == {"A": (8.0, 0.1), "B": (4.0, 0.1)}
    again = clean.dedupe_tape(clean.dedupe_tape(raw))
    assert by_ticker(again, "adj_close", "dividends") == found


def test_a_third_of_all_rows_are_copies_of_one_day(spark):
    raw = spark.range(30_000).select(
        F.when(F.col("id") < 10_000, "HOT").otherwise(F.concat(F.lit("T"), F.col("id") % 500))
        .alias("ticker"),
        F.when(F.col("id") < 10_000, F.lit(0)).otherwise(F.col("id") % 30).alias("day"),
        ((F.col("id") * 7919) % 10_007).cast("double").alias("adj_close"),
        F.lit(0.0).alias("dividends"),
        ((F.col("id") * 31) % 1_009).alias("source_rank"),
    ).withColumn("date", F.timestamp_seconds(F.col("day") * 86_400)).drop("day")
    best = {}
    for r in raw.collect():
        key, row = (r.ticker, r.date), (r.source_rank, r.adj_close)
        best[key] = min(best.get(key, row), row)
    found = {(r.ticker, r.date): r.adj_close for r in clean.dedupe_tape(raw).collect()}
    assert found == {k: v for k, (_, v) in best.items()}


def test_two_spellings_of_a_date_are_copies(spark):
    raw = spark.createDataFrame(
        [("A", "2024-01-02", "1.5", "0"), ("A", "2024-01-02 00:00:00", "1.5", "0")],
        "ticker string, date string, adj_close string, dividends string",
    )
    assert clean.clean_tape(raw).count() == 1


def test_row_order_changes_nothing(spark):
    def outcome(rows):
        tape = clean.clean_tape(raw_tape(spark, rows).repartition(3))
        company = clean.company_rows(tape, S.benchmarks)
        index = clean.instrument_rows(tape, S.market)
        return (
            by_ticker(dividends.dividend_growth(company, S.as_of, 1), "five_year_cagr"),
            {k: round(v, 9) for k, v in by_ticker(returns.beta(company, index, S.as_of), "beta").items()},
            by_ticker(prices.latest_price(company, S.as_of), "last_price", "last_dividend"),
        )

    rows = tape_rows()
    expected = outcome(rows)
    for seed in (1, 2):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        assert outcome(shuffled) == expected


def test_null_ticker_is_no_company(spark):
    rows = [(None, datetime(2024, 1, 2), 1.0, 0.0), ("A", datetime(2024, 1, 2), 1.0, 0.0)]
    tape = clean.clean_tape(raw_tape(spark, rows))
    assert [r["ticker"] for r in clean.company_rows(tape, S.benchmarks).collect()] == ["A"]


@pytest.mark.parametrize("prices_, expected", [
    ([10.0, 0.0, 5.0], [None, None, None]),
    ([10.0, -1.0, -2.0], [None, None, pytest.approx(0.6931471805599453)]),
    ([10.0, None, 5.0], [None, None, None]),
])
def test_returns_of_unusable_prices_are_null(spark, prices_, expected):
    rows = [("A", datetime(2024, 1, 30) + timedelta(days=i), p, 0.0) for i, p in enumerate(prices_)]
    found = returns.log_returns(clean.clean_tape(raw_tape(spark, rows)), S.as_of)
    assert [r["log_return"] for r in found.orderBy("date").collect()] == expected


def test_window_edges_are_inclusive(spark):
    cut = S.as_of - timedelta(days=30)
    rows = [("A", cut, 1.0, 0.0), ("A", cut - timedelta(seconds=1), 1.0, 0.0),
            ("A", S.as_of, 1.0, 0.0), ("A", S.as_of + timedelta(seconds=1), 1.0, 0.0)]
    tape = raw_tape(spark, rows)
    assert tape.filter(since(tape, S.as_of, 30)).count() == 2


def test_later_rows_change_nothing(spark):
    """A quote after `as_of` leaves every window, latest value and rate as it was."""
    def outcome(rows):
        tape = clean.clean_tape(raw_tape(spark, rows))
        company = clean.company_rows(tape, S.benchmarks)
        index = clean.instrument_rows(tape, S.market)
        frames = [
            dividends.growth_with_latest(company, S.as_of, 1), prices.latest_price(company, S.as_of),
            prices.nested_histories(company, S.as_of), returns.beta(company, index, S.as_of),
            returns.beta_monthly(company, index, S.as_of),
            benchmarks.benchmark_rates(tape, S.market, S.risk_free, S.as_of),
            benchmarks.risk_free_rate(tape, S.risk_free, S.as_of),
        ]
        return [sorted(map(str, f.collect())) for f in frames]

    rows = tape_rows()
    later = [(t, S.as_of + timedelta(days=d), 999.0, 9.0)
             for t in sorted({r[0] for r in rows}) for d in (1, 40)]
    assert outcome(rows + later) == outcome(rows)


def test_later_snapshots_change_no_report(spark):
    """A snapshot after `as_of` leaves names, members and the worklist as they were."""
    early = [("A", "Old", "x", "y", S.as_of - timedelta(days=d)) for d in (0, 40)]
    later = [("A", "New", "x", "z", S.as_of + timedelta(days=1)),
             ("B", "Late", "x", "y", S.as_of + timedelta(days=1))]

    def outcome(rows):
        snapshots = spark.createDataFrame(rows, SNAPSHOT)
        frames = [f(snapshots, as_of=S.as_of) for f in (
            membership.latest_company, membership.latest_members, membership.previous_members,
            membership.new_members, membership.snapshot_diff, membership.snapshot_times)]
        return [sorted(map(str, f.collect())) for f in frames]

    assert outcome(early + later) == outcome(early)


def test_values_that_are_no_numbers_or_dates(spark):
    raw = spark.createDataFrame(
        [("A", "2024-01-02", "Infinity", "NaN"), ("A", "T12:30", "1", "0"),
         ("A", "2024-01-03", "-Infinity", "0.5")],
        "ticker string, date string, adj_close string, dividends string")
    found = clean.clean_tape(raw).filter("date is not null").orderBy("date").collect()
    assert [(r["adj_close"], r["dividends"]) for r in found] == [(None, None), (None, 0.5)]
    refused = routing.route(raw).filter("route = 'quarantined'").orderBy("date", "reason")
    assert sorted(r["reason"] for r in refused.collect()) == ["bad date", "bad price", "bad price"]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.tuples(st.sampled_from("AB"), st.integers(0, 4000), st.floats(1, 100)),
        min_size=1, max_size=30, unique_by=lambda r: r[:2],
    ),
    grain=st.sampled_from(["hour", "day", "month", "year"]),
)
def test_previous_row_matches_brute_force(spark, rows, grain):
    start = datetime(2023, 1, 1)
    frame = spark.createDataFrame(
        [(k, start + timedelta(hours=3 * h), v) for k, h, v in rows],
        "k string, t timestamp, v double",
    )
    found = {(r.k, r.t): r.previous_v for r in with_previous(
        frame, "k", "t", ["v"], grain=grain).collect()}
    expected = {}
    for key in "AB":
        own = sorted((start + timedelta(hours=3 * h), v) for k, h, v in rows if k == key)
        for i, (t, _) in enumerate(own):
            expected[(key, t)] = own[i - 1][1] if i else None
    assert found == expected


def test_previous_row_of_a_hot_key(spark):
    """One key holds nearly all rows; its pieces are no larger than a grain."""
    n = 20_000
    ticks = spark.range(n).select(
        F.lit("HOT").alias("k"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("t"),
        F.col("id").alias("v"),
    ).unionByName(spark.range(3).select(
        F.lit("COLD").alias("k"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 86_400).alias("t"),
        F.col("id").alias("v"),
    ))
    found = with_previous(ticks, "k", "t", ["v"])
    wrong = found.filter(~F.col("previous_v").eqNullSafe(F.when(F.col("v") > 0, F.col("v") - 1)))
    assert found.count() == n + 3
    assert wrong.count() == 0


def test_intraday_beta_equals_brute_force(spark):
    random.seed(3)
    start = datetime(2024, 6, 1, 9, 30)
    rows = [(t, start + timedelta(minutes=25 * i), random.uniform(50, 60), 0.0)
            for t in ("^GSPC", "AAA") for i in range(300) if random.random() > 0.1]
    tape = clean.clean_tape(raw_tape(spark, rows))
    company = clean.company_rows(tape, S.benchmarks)
    index = clean.instrument_rows(tape, S.market)

    def series(ticker):
        own = sorted((d, p) for t, d, p, _ in rows if t == ticker)
        return {d: math.log(p / q) for (_, q), (d, p) in zip(own, own[1:])} | {own[0][0]: None}

    a, m = series("AAA"), series("^GSPC")
    pairs = [(a[d], m[d]) for d in a if d in m and a[d] is not None and m[d] is not None]
    market = [m[d] for d in a if m.get(d) is not None]
    ma, mm = (sum(x) / len(pairs) for x in zip(*pairs))
    mean = sum(market) / len(market)
    covariance = sum((x - ma) * (y - mm) for x, y in pairs) / len(pairs)
    variance = sum((y - mean) ** 2 for y in market) / len(market)
    expected = {"AAA": pytest.approx(covariance / variance)}
    assert by_ticker(returns.beta(company, index, S.as_of), "beta") == expected


def test_intraday_index_too_long_to_broadcast(spark, monkeypatch):
    rows = [(t, datetime(2024, 6, 3, h), 50.0 + h * k, 0.0)
            for k, t in ((1, "^GSPC"), (2, "AAA")) for h in range(9, 17)]
    tape = clean.clean_tape(raw_tape(spark, rows))
    args = (clean.company_rows(tape, S.benchmarks), clean.instrument_rows(tape, S.market), S.as_of)
    expected = by_ticker(returns.beta(*args), "beta")
    monkeypatch.setattr(sizing, "fits", lambda *a, **k: False)
    shuffled = by_ticker(returns.beta(*args), "beta")
    assert shuffled == {k: pytest.approx(v) for k, v in expected.items()}


def test_streak_is_no_longer_than_the_years_seen(spark):
    random.seed(5)
    rows = [(t, datetime(y, 3, 1), 1.0, float(random.randint(0, 4)))
            for t in "ABCDEF" for y in range(2000, 2024) if random.random() > 0.2]
    annual = dividends.annual_dividends(clean.clean_tape(raw_tape(spark, rows)))
    streaks = dividends.growth_streak(dividends.dividend_change(annual)).collect()
    for ticker in "ABCDEF":
        own = sorted((r.year, r.annual_dividend, r.consecutive_growth_years)
                     for r in streaks if r.ticker == ticker)
        streak = 0
        for i, (_, dividend, found) in enumerate(own):
            streak = streak + 1 if i and dividend > own[i - 1][1] else 0
            assert found == streak


def test_membership(spark):
    def symbols(df):
        return sorted(r["symbol"] for r in df.collect())

    shots = snapshots(spark)
    assert symbols(membership.new_members(shots)) == ["FFF"]
    assert symbols(membership.previous_members(shots)) == ["AAA", "BBB", "CCC", "EEE", "^GSPC", "^TNX"]
    assert symbols(membership.latest_members(shots)) == ["AAA", "BBB", "EEE", "FFF", "^GSPC", "^TNX"]
    status = {r["symbol"]: r["status"] for r in membership.snapshot_diff(shots).collect()}
    assert status == {"AAA": "retained", "BBB": "retained", "EEE": "retained", "^TNX": "retained",
                      "^GSPC": "retained", "FFF": "added", "CCC": "removed"}
    names = {r["ticker"]: r["name"] for r in membership.latest_company(shots).collect()}
    current = membership.latest_company(shots, members_only=True)
    assert sorted(r["ticker"] for r in current.collect()) == symbols(membership.latest_members(shots))
    assert names["AAA"] == "AAA at 2024-07-01" and names["CCC"] == "CCC at 2024-06-28"


def test_membership_of_one_and_no_snapshot(spark):
    one = snapshots(spark, 1)
    assert membership.new_members(one).count() == 5
    assert membership.previous_members(one).count() == 0
    undated = one.limit(1).withColumn("updated_at", F.lit(None).cast("timestamp"))
    assert membership.previous_members(one.unionByName(undated)).count() == 0
    none = snapshots(spark, 0)
    assert membership.snapshot_diff(none).count() == 0
    assert membership.latest_members(none).count() == 0


def test_gaps_list_missing_weekdays(spark):
    # Thursday, then Tuesday: Friday and Monday are missing, the weekend is not.
    rows = [("A", datetime(2024, 6, 6), 1.0, 0.0), ("A", datetime(2024, 6, 11, 9), 1.0, 0.0),
            ("A", datetime(2024, 6, 11, 15), 1.0, 0.0), ("B", datetime(2024, 6, 6), 1.0, 0.0)]
    found = coverage.coverage_gaps(clean.clean_tape(raw_tape(spark, rows))).collect()
    assert sorted((r["ticker"], r["missing_day"].day) for r in found) == [("A", 7), ("A", 10)]


def test_gaps_reach_to_as_of(spark):
    rows = [("AAA", "2024-01-02", 1.0, 0.0), ("AAA", "2024-01-09", 1.0, 0.0)]
    tape = spark.createDataFrame(rows, "ticker string, date string, adj_close double, dividends double")
    found = coverage.coverage_gaps(clean.clean_tape(tape), datetime(2024, 1, 5)).collect()
    assert sorted(str(r["missing_day"]) for r in found) == ["2024-01-03", "2024-01-04", "2024-01-05"]
