"""Beta from stored monthly moments against beta from rows."""

import math
import random
from datetime import datetime, timedelta

import pytest

from tickerloom.operators import moments, returns
from tickerloom.sources import commits

TYPES = "ticker string, date timestamp, adj_close double"
BEGIN = datetime(2020, 1, 10)


def random_tape(seed, days=420, share=0.5):
    """Tickers with gaps of days and of whole months, prices of zero and none."""
    rng = random.Random(seed)
    rows = []
    for ticker in ("AAA", "BBB", "CCC", "DDD"):
        price = 10.0
        for n in range(days):
            date = BEGIN + timedelta(days=n)
            price *= math.exp(rng.gauss(0, 0.05))
            skipped = ticker == "CCC" and date.month in (3, 4, 9)
            late = ticker == "DDD" and n < 200
            if rng.random() < share and not skipped and not late:
                rows.append((ticker, date, rng.choice([price] * 20 + [0.0, None])))
    return rows


def random_index(seed, first=0, days=420):
    rng = random.Random(seed)
    price, rows = 100.0, []
    for n in range(days):
        price *= math.exp(rng.gauss(0, 0.02))
        if n >= first and rng.random() < 0.8:
            rows.append(("^IDX", BEGIN + timedelta(days=n), price))
    return rows


def betas(df):
    return {r["ticker"]: None if r["beta"] is None else round(r["beta"], 9) for r in df.collect()}


@pytest.mark.parametrize("first", [0, 150])
@pytest.mark.parametrize("paired", [False, True])
def test_any_window_equals_beta_from_rows(spark, first, paired):
    companies = spark.createDataFrame(random_tape(1), TYPES).cache()
    index = spark.createDataFrame(random_index(2, first), TYPES).cache()
    stored = moments.monthly_moments(companies, moments.market_series(index)).cache()
    for day, days in ((419, 365), (300, 200), (419, 1000), (300, 33), (210, 12), (160, 365)):
        as_of = BEGIN + timedelta(days=day, hours=12)
        expected = betas(returns.beta(companies, index, as_of, days, paired))
        found = betas(moments.beta_from_moments(stored, companies, index, as_of, days, paired))
        # A ticker that meets the market on no day with a return has no beta either way.
        assert ({t: b for t, b in found.items() if b is not None}
                == {t: b for t, b in expected.items() if b is not None})


def test_a_month_of_one_row_and_a_constant_market(spark):
    rows = [("A", datetime(2024, m, 5), 2.0 ** m) for m in range(1, 7)]
    companies = spark.createDataFrame(rows, TYPES)
    flat = spark.createDataFrame([("I", datetime(2024, m, 5), 7.0) for m in range(1, 7)], TYPES)
    stored = moments.monthly_moments(companies, moments.market_series(flat))
    as_of = datetime(2024, 7, 1)
    assert betas(moments.beta_from_moments(stored, companies, flat, as_of)) == {"A": None}
    none = spark.createDataFrame([], TYPES)
    assert betas(moments.beta_from_moments(stored.limit(0), none, none, as_of)) == {}


def test_a_new_month_reads_one_month(spark, tmp_path):
    rows, index_rows = random_tape(5), random_index(6)
    path, as_of = str(tmp_path), BEGIN + timedelta(days=419)
    known = [datetime(2020, 12, 1), datetime(2021, 2, 1), datetime(2022, 1, 1)]

    def upto(when, found):
        return spark.createDataFrame([r for r in found if r[1] < when], TYPES)

    for n, when in enumerate(known):
        companies, index = upto(when, rows), upto(when, index_rows)
        before = known[n - 1] if n else BEGIN - timedelta(days=40)
        new = sorted({f"{r[1]:%Y-%m}" for r in rows + index_rows if before <= r[1] < when})
        touched = moments.refresh_moments(spark, companies, index, new, path, n)
        assert set(touched) - set(new) == {moments._next_month(new[-1])}
    written = {c: [m for m, _ in commits.folders_of(spark, path, c)] for c in range(3)}
    assert written[1] == ["2020-12", "2021-01"] and written[2][0] == "2021-02"
    expected = betas(returns.beta(companies, index, as_of, 365))
    found = moments.beta_from_moments(moments.read_moments(spark, path), companies, index,
                                      as_of, 365)
    assert betas(found) == expected


def test_a_corrected_index_price_reaches_the_month_after(spark, tmp_path):
    rows, index_rows = random_tape(8), random_index(9)
    path, as_of = str(tmp_path), BEGIN + timedelta(days=400)
    companies = spark.createDataFrame(rows, TYPES)
    months = sorted({f"{r[1]:%Y-%m}" for r in rows + index_rows})
    moments.refresh_moments(spark, companies, spark.createDataFrame(index_rows, TYPES), months,
                            path, 0)
    last = max(i for i, r in enumerate(index_rows) if f"{r[1]:%Y-%m}" == "2020-07")
    index_rows[last] = (*index_rows[last][:2], 3.0)
    index = spark.createDataFrame(index_rows, TYPES)
    assert moments.refresh_moments(spark, companies, index, ["2020-07"], path, 1) == [
        "2020-07", "2020-08"]
    found = moments.beta_from_moments(moments.read_moments(spark, path), companies, index,
                                      as_of, 390)
    assert betas(found) == betas(returns.beta(companies, index, as_of, 390))
