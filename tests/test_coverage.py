"""Ranges of missing trading days against plain Python, and the fetch plan over them."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import collector, coverage

TYPES = "ticker string, date timestamp, adj_close double"
BEGIN = date(2023, 11, 20)


def rows_of(spark, days):
    return spark.createDataFrame(
        [(t, datetime(d.year, d.month, d.day, 16), 1.0) for t, d in days], TYPES)


def brute(held, market, as_of=None):
    """Stretches of market days between rows of a ticker, or up to the last until as_of."""
    market = sorted(d for d in market if as_of is None or d <= as_of)
    found = []
    for ticker in sorted({t for t, _ in held}):
        own = {d for t, d in held if t == ticker and d in market}
        if not own:
            continue
        last = max(own) if as_of is None else market[-1]
        missing = [i for i, d in enumerate(market) if min(own) < d <= last and d not in own]
        while missing:
            n = 1
            while n < len(missing) and missing[n] == missing[0] + n:
                n += 1
            found.append((ticker, market[missing[0]], market[missing[n - 1]] + timedelta(days=1), n))
            missing = missing[n:]
    return sorted(found)


@pytest.mark.parametrize("seed", [1, 2])
def test_missing_ranges(spark, seed):
    rng = random.Random(seed)
    days = [BEGIN + timedelta(days=n) for n in range(120)]
    market = [d for d in days if d.weekday() < 5 and rng.random() < 0.95]
    held = [(t, d) for t, share in (("A", 0.9), ("B", 0.4), ("C", 0.05)) for d in days
            if rng.random() < share]
    held += [("D", d) for d in days if d not in market]      # on days without a market
    held += held[:5]
    tape, index = rows_of(spark, held), rows_of(spark, [("I", d) for d in market])
    for as_of in (None, datetime(2024, 2, 10), datetime(2024, 6, 1), datetime(2023, 12, 4, 23)):
        known = [(t, d) for t, d in held if as_of is None or d <= as_of.date()]
        found = coverage.missing_ranges(tape, index, as_of)
        assert sorted(map(tuple, found.collect())) == brute(
            known, market, None if as_of is None else as_of.date())


def test_no_market_and_no_rows(spark):
    some, none = rows_of(spark, [("A", BEGIN)]), rows_of(spark, [])
    for tape, index in ((some, none), (none, some), (none, none)):
        assert coverage.missing_ranges(tape, index).collect() == []
        assert coverage.missing_ranges(tape, index, datetime(2025, 1, 1)).collect() == []


def test_fetch_plan_lists_the_missing_ranges(spark):
    new = spark.createDataFrame([("N",)], "symbol string")
    old = spark.createDataFrame([("A",), ("B",)], "symbol string")
    gaps = spark.createDataFrame(
        [("A", date(2024, 1, 2), date(2024, 1, 5), 3), ("A", date(2024, 2, 1), date(2024, 2, 2), 1),
         ("Z", date(2024, 1, 2), date(2024, 1, 3), 1)],
        "ticker string, start_date date, end_date date, n_days long")
    run = datetime(2024, 3, 1)
    plan = collector.fetch_plan(new, old, run, "run.csv", gaps=gaps)
    assert sorted((r["symbol"], r["mode"], r["start_date"], r["end_date"])
                  for r in plan.collect()) == [
        ("A", "daily", datetime(2024, 1, 2), datetime(2024, 1, 5)),
        ("A", "daily", datetime(2024, 2, 1), datetime(2024, 2, 2)),
        ("B", "daily", datetime(2024, 2, 29), run),
        ("N", "historical", datetime(1900, 1, 1), run)]
    assert plan.filter(F.col("batch").isNotNull()).count() == 1
