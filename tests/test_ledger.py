"""The ledger of deliveries and the annual view over it."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import clean, dividends
from tickerloom.sources import commits, ledger
from tickerloom.streaming import annual
from tickerloom.streaming.curate import start_newest, take_delivery

TYPES = "ticker string, date timestamp, adj_close double, dividends double, source_rank long"


def day(text):
    return datetime.strptime(text, "%Y-%m-%d")


def tape(spark, rows):
    """Rows (ticker, date, adj_close, dividends, source_rank)."""
    return spark.createDataFrame(rows, TYPES)


def content(df, *columns):
    names = columns or ("ticker", "date", "adj_close", "dividends")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def random_deliveries(seed, count, size):
    """Deliveries that share keys; some correct earlier ones, some come late."""
    rng = random.Random(seed)
    begin = day("2022-11-15")
    return [[(rng.choice(["AAA", "BBB", "^IDX", None]), begin + timedelta(days=rng.randrange(90)),
              rng.choice([None, round(rng.uniform(1, 9), 2)]),
              rng.choice([None, 0.0, 0.1, round(rng.uniform(0, 2), 3)]),
              rng.choice([n, count - n])) for _ in range(size)] for n in range(count)]


def test_current_rows_equal_the_batch_whatever_the_order(spark, tmp_path):
    deliveries = random_deliveries(1, 6, 60)
    expected = content(clean.clean_tape(tape(spark, sum(deliveries, []))),
                       "ticker", "date", "adj_close", "dividends", "year", "month")
    for name, order in (("on", deliveries), ("back", deliveries[::-1])):
        path = str(tmp_path / name)
        for n, rows in enumerate(order):
            take_delivery(tape(spark, rows), n, path, folders=4)
        assert content(ledger.read_current(spark, path), "ticker", "date", "adj_close",
                       "dividends", "year", "month") == expected
    assert content(ledger.read_current(spark, str(tmp_path / "none"))) == []


def test_a_delivery_writes_its_months_alone(spark, tmp_path):
    path = str(tmp_path)
    ledger.append(tape(spark, [("A", day("2024-01-02"), 1.0, 0.0, 0),
                               ("A", day("2024-02-02"), 2.0, 0.0, 0)]), path, 0)
    files = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "data").rglob("part-*")}
    touched = ledger.append(tape(spark, [("A", day("2024-02-02"), 3.0, 0.0, -1)]), path, 2)
    assert touched == ["2024-02"]
    assert all((tmp_path / p).stat().st_mtime_ns == t for p, t in files.items())
    assert content(ledger.read_current(spark, path)) == [
        ("A", day("2024-01-02"), 1.0, 0.0), ("A", day("2024-02-02"), 3.0, 0.0)]
    named = [folder for _, folder in commits.entries(spark, path)]
    opened = ledger.read_ranked(spark, path).inputFiles()
    assert named == ["data/commit=0/month=2024-01", "data/commit=0/month=2024-02",
                     "data/commit=2/month=2024-02"]
    assert all(any(folder in file for folder in named) for file in opened)


def test_folders_stay_few_over_many_deliveries(spark, tmp_path):
    path, begin = str(tmp_path), day("2024-01-01")
    held, written = [], []
    for n in range(50):
        rows = [("A", begin + timedelta(days=n), float(n), 0.0, -n),
                ("A", begin + timedelta(days=max(n - 1, 0)), -1.0, 0.0, 1)]
        take_delivery(tape(spark, rows), n, path, folders=5)
        if n % 10 == 9:
            held.append(len(commits.entries(spark, path)))
            commits.expire(spark, path, keep=2)
            written.append(len(list((tmp_path / "data").rglob("part-*"))))
    assert max(held) <= 2 * 5 and max(written) <= 2 * held[-1] + 2 * 5
    assert content(ledger.read_current(spark, path), "adj_close") == sorted(
        ((float(n),) for n in range(50)), key=repr)


def test_a_failure_between_rows_and_log_changes_nothing(spark, tmp_path):
    path = str(tmp_path)
    ledger.append(tape(spark, [("A", day("2024-01-02"), 1.0, 0.0, 0)]), path, 0)
    before = content(ledger.read_current(spark, path))
    lost = tape(spark, [("A", day("2024-01-02"), 9.0, 0.0, -1)]).withColumn(
        "month", F.lit("2024-01"))
    commits.write_rows(lost, path, 2, "month", ["ticker"])       # ends before its log
    assert content(ledger.read_current(spark, path)) == before
    (tmp_path / "log" / "_2.part").write_text("2024-01")          # ends inside it
    assert content(ledger.read_current(spark, path)) == before
    assert commits.expire(spark, path, keep=1) == []
    again = tape(spark, [("A", day("2024-01-02"), 2.0, 0.0, -1)])
    ledger.append(again, path, 2)
    assert content(ledger.read_current(spark, path)) == [("A", day("2024-01-02"), 2.0, 0.0)]
    ledger.append(again, path, 2)                                # complete: left as it is
    assert len(commits.entries(spark, path)) == 2


def test_expiry_keeps_what_the_newest_logs_name(spark, tmp_path):
    path = str(tmp_path)
    for n in range(4):
        take_delivery(tape(spark, [("A", day("2024-01-02"), float(n), 0.0, -n),
                                   ("B", day(f"2024-0{n + 2}-02"), 1.0, 0.0, 0)]), n, path,
                      folders=3)
    current = content(ledger.read_current(spark, path))
    gone = commits.expire(spark, path, keep=1)
    assert gone and all("month=2024-01" in folder for folder in gone)
    assert content(ledger.read_current(spark, path)) == current
    assert commits.expire(spark, path, keep=1) == []
    assert not list((tmp_path / "data" / "commit=0").glob("month=2024-01"))


def test_changes_of_a_commit(spark, tmp_path):
    path = str(tmp_path)
    ledger.append(tape(spark, [("A", day("2024-01-02"), 1.0, 0.5, 5),
                               ("A", day("2024-01-03"), 2.0, None, 5),
                               ("B", day("2024-01-02"), 7.0, 0.1, 5)]), path, 0)
    ledger.append(tape(spark, [("A", day("2024-01-02"), 1.0, 0.7, 4),    # corrects
                               ("A", day("2024-01-03"), 2.0, None, 4),   # repeats
                               ("B", day("2024-01-02"), 8.0, 0.9, 9),    # older than known
                               ("C", day("2024-02-02"), 3.0, 0.3, 9)]), path, 2)
    assert content(ledger.changes(spark, path, 2), "ticker", "dividends", "old_dividends",
                   "is_new") == [("A", 0.7, 0.5, False), ("C", 0.3, None, True)]


@pytest.mark.parametrize("folders", [2, 8])
def test_annual_view_equals_the_batch_after_every_delivery(spark, tmp_path, folders):
    deliveries = random_deliveries(7, 5, 50)
    tape_path, view = str(tmp_path / "tape"), str(tmp_path / "view")
    columns = ("ticker", "year", F.round("annual_dividend", 9), "dividend_frequency")
    for n, rows in enumerate(deliveries):
        take_delivery(tape(spark, rows), n, tape_path, folders)
        annual.refresh_view(spark, tape_path, 2 * n, view, n, ["^IDX"], folders)
        batch = dividends.annual_dividends(clean.company_rows(
            clean.clean_tape(tape(spark, sum(deliveries[:n + 1], []))), ["^IDX"]))
        assert content(annual.read_annual(spark, view), *columns) == content(batch, *columns)
    before = commits.entries(spark, view)
    annual.take_batch(tape(spark, deliveries[-1]), 4, tape_path, view, ["^IDX"])
    assert commits.entries(spark, view) == before


def test_amounts_taken_back_leave_nothing(spark, tmp_path):
    tape_path, view = str(tmp_path / "tape"), str(tmp_path / "view")
    amounts = [0.1, 0.2, 1e15, 0.3, 1e25]
    for n, factor in enumerate((1.0, 0.0)):
        rows = [("A", day(f"2024-03-{i + 1:02d}"), 1.0, a * factor, -n)
                for i, a in enumerate(amounts)]
        annual.take_batch(tape(spark, rows), n, tape_path, view, [])
    assert content(annual.read_annual(spark, view), "annual_dividend",
                   "dividend_frequency") == [(0.0, 0)]


def test_a_batch_reads_its_rows_and_the_months_it_touches(spark, tmp_path):
    tape_path = str(tmp_path)
    rows = [("A", day(f"20{y}-{m:02d}-03"), 1.0, 0.1, 0) for y in range(10, 20) for m in (1, 2, 6)]
    ledger.append(tape(spark, rows), tape_path, 0)
    ledger.append(tape(spark, [("A", day("2015-06-03"), 1.0, 0.4, -1)]), tape_path, 2)
    opened = ledger.changes(spark, tape_path, 2).inputFiles()
    assert opened and all("month=2015-06" in file for file in opened)


def test_newest_delivery_of_a_stream_of_rows(spark, tmp_path):
    deliveries = random_deliveries(3, 4, 40)
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    for n, rows in enumerate(deliveries):
        tape(spark, rows).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(TYPES).parquet(source)
        start_newest(stream, path, str(tmp_path / "cp")).awaitTermination()
        expected = clean.clean_tape(tape(spark, sum(deliveries[:n + 1], [])))
        assert content(ledger.read_current(spark, path)) == content(expected)
