"""Streams end where the batch operators do."""

import os
from datetime import datetime, timedelta

import __spark_entry__ as registered
from golden import SETTINGS, raw_tape, tape_rows
from pyspark.sql import functions as F

from tickerloom.operators import clean, dividends
from tickerloom.sources import commits, ledger, routing
from tickerloom.streaming.annual import read_annual, start_annual, take_batch
from tickerloom.streaming.curate import merge_files, start_curation
from tickerloom.streaming.dedupe import drop_redelivered
from tickerloom.streaming.ingest import new_files, start_ingest, tape_stream

HEADER = "Date,Ticker,Adj Close,Dividends\n"


def test_each_file_is_read_once(spark, tmp_path):
    source, target, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()
    (source / "a.csv").write_text(HEADER + "2024-01-02,AAA,2.5,0.1\nbad,AAA,2.5,0.1\n")
    (source / "note.txt").write_text("not for us\n")

    def run():
        start_ingest(new_files(spark, str(source)), target, cp).awaitTermination()
        return [routing.read_route(spark, target, r).count()
                for r in (routing.ACCEPTED, routing.QUARANTINED)]

    assert run() == [1, 1]
    assert run() == [1, 1]
    (source / "b.csv").write_text(HEADER + "2024-01-03,AAA,2.5,0.1\n2024-01-04,BBB,1,0\n")
    assert run() == [3, 1]


def test_a_file_with_another_header_does_not_stop_the_stream(spark, tmp_path):
    source, target, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()

    def run():
        start_ingest(new_files(spark, str(source), files_per_batch=2), target, cp
                     ).awaitTermination()
        return [sorted(map(tuple, routing.read_route(spark, target, r).select(c).collect()))
                for r, c in ((routing.ACCEPTED, "adj_close"), (routing.QUARANTINED, "raw_row"))]

    (source / "a.csv").write_text(HEADER + "2024-01-02,AAA,2.5,0.1\n")
    (source / "b.csv").write_text("Time,Symbol\n2024-01-02,AAA\n")
    (source / "c 1.csv").write_text("Ticker,Splits,Adj Close,Dividends,Date\nBBB,2,3.5,0,2024-01-02\n")
    (source / "d.csv").write_text("")
    assert run() == [[(2.5,), (3.5,)], [("2024-01-02,AAA",), ("Time,Symbol",)]]
    (source / "e.csv").write_text(HEADER + "2024-01-03,AAA,4.5,0.1\n")
    assert run()[0] == [(2.5,), (3.5,), (4.5,)]


def test_new_files_touch_only_their_months(spark, tmp_path):
    source, routed, target = tmp_path / "in", str(tmp_path / "routed"), tmp_path / "curated"
    source.mkdir()

    def deliver(name, when, *lines):
        (source / name).write_text(HEADER + "\n".join(lines) + "\n")
        os.utime(source / name, (when, when))
        start_curation(spark, str(source), routed, str(target), str(tmp_path / "cp")).awaitTermination()
        rows = ledger.read_current(spark, str(target)).collect()
        assert all(r["year"] == r["date"].year and r["month"] == r["date"].month for r in rows)
        return sorted((r["ticker"], str(r["date"])[:10], r["adj_close"]) for r in rows)

    assert deliver("bad.csv", 1_000, "never,AAA,1,0") == []
    assert deliver("a.csv", 2_000, "2023-05-02,AAA,1,0", "2024-05-02,AAA,2,0") == [
        ("AAA", "2023-05-02", 1.0), ("AAA", "2024-05-02", 2.0)]
    # A correction, and a file that is older than what is known.
    corrected = [("AAA", "2023-05-02", 1.0), ("AAA", "2024-05-02", 3.0),
                 ("BBB", "2024-05-02", 9.0)]
    assert deliver("b.csv", 3_000, "2024-05-02,AAA,3,0", "2024-05-02,BBB,9,0") == corrected
    assert deliver("c.csv", 1_500, "2024-05-02,AAA,7,0") == corrected
    months = {p.name: sorted(m.name for m in p.glob("month=*"))
              for p in (target / "data").glob("commit=*")}
    assert months == {"commit=0": [], "commit=2": ["month=2023-05", "month=2024-05"],
                      "commit=4": ["month=2024-05"], "commit=6": ["month=2024-05"]}
    again = spark.createDataFrame([(str(source / "b.csv"),)], "path string")
    merge_files(again, 2, routed, str(target))
    found = ledger.read_current(spark, str(target)).collect()
    assert sorted((r["ticker"], str(r["date"])[:10], r["adj_close"]) for r in found) == corrected


def test_redelivered_and_late_rows(spark, tmp_path):
    source, target, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()

    def deliver(name, *lines):
        (source / name).write_text(HEADER + "\n".join(lines) + "\n")
        rows = routing.route(tape_stream(spark, str(source))).filter(
            F.col("route") == routing.ACCEPTED
        ).select("ticker", "date", "adj_close", "dividends")
        (
            drop_redelivered(rows, "7 days").writeStream.format("parquet")
            .option("path", target).option("checkpointLocation", cp)
            .trigger(availableNow=True).start().awaitTermination()
        )
        return sorted((r.ticker, r.date.strftime("%m-%d")) for r in spark.read.parquet(target).collect())

    first = deliver("a.csv", "2024-01-20,AAA,1,0", "2024-01-19,AAA,1,0", "2024-01-20,AAA,1,0")
    assert first == [("AAA", "01-19"), ("AAA", "01-20")]
    # A copy of a remembered row, a row inside the delay, a row beyond it.
    second = deliver("b.csv", "2024-01-20,AAA,1,0", "2024-01-15,BBB,1,0", "2024-01-02,CCC,1,0")
    assert second == [("AAA", "01-19"), ("AAA", "01-20"), ("BBB", "01-15")]


def ranked(spark, rows):
    return raw_tape(spark, rows).withColumn("source_rank", F.lit(0).cast("long"))


def test_annual_stream_equals_batch(spark, tmp_path):
    rows = tape_rows()
    source = str(tmp_path / "in")
    for part in (rows[:20], rows[15:35], rows[30:]):
        ranked(spark, part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(ranked(spark, rows).schema).option(
        "maxFilesPerTrigger", 1).parquet(source)
    annual = str(tmp_path / "annual")
    args = (str(tmp_path / "tape"), annual, str(tmp_path / "cp"), SETTINGS.benchmarks)
    start_annual(stream, *args).awaitTermination()

    def found():
        rows = read_annual(spark, annual).select(
            "ticker", "year", F.round("annual_dividend", 9), "dividend_frequency")
        return sorted(map(tuple, rows.collect()))

    batch = dividends.annual_dividends(
        clean.company_rows(clean.clean_tape(raw_tape(spark)), SETTINGS.benchmarks)).select(
        "ticker", "year", F.round("annual_dividend", 9), "dividend_frequency")
    assert found() == sorted(map(tuple, batch.collect()))
    before = found()
    start_annual(stream, *args).awaitTermination()
    assert found() == before


def test_a_batch_that_runs_twice_changes_nothing(spark, tmp_path):
    paths = str(tmp_path / "tape"), str(tmp_path / "annual"), SETTINGS.benchmarks
    rows = tape_rows()

    def found():
        return sorted(map(tuple, read_annual(spark, paths[1]).collect()))

    take_batch(ranked(spark, rows[:30]), 0, *paths)
    take_batch(ranked(spark, rows[20:]), 1, *paths)
    once = found()
    take_batch(ranked(spark, rows[20:]), 1, *paths)
    assert found() == once


def test_a_batch_adds_to_its_years_alone(spark, tmp_path):
    paths = str(tmp_path / "tape"), str(tmp_path / "annual"), SETTINGS.benchmarks
    rows = tape_rows()
    take_batch(ranked(spark, rows), 0, *paths)
    late = [("ZZZ", r[1], 1.0, 1.0) for r in rows if r[1].year == 2016][:1]
    take_batch(ranked(spark, late), 1, *paths)
    assert [part for part, _ in commits.folders_of(spark, paths[1], 2)] == ["2016"]
    tickers = {r.ticker for r in read_annual(spark, paths[1]).filter("year = 2016").collect()}
    assert tickers == {"AAA", "CCC", "ZZZ"}


def test_a_delivery_of_the_annual_stream_is_many_files(spark, tmp_path, monkeypatch):
    """Rows that several tasks read are not brought together in one file."""
    sf, start = tmp_path / "sf", datetime(1997, 1, 1)
    sf.mkdir()
    for part in range(12):
        rows = [(10 * part + i, i % 7 + 1, i % 5, float(i % 4 + 1), 10.0 * i, 0.09 if i % 2 else 0.0,
                 start + timedelta(days=100 * (i % 12) + part)) for i in range(20)]
        spark.createDataFrame(
            rows, "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, "
            "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz").coalesce(
            1).write.mode("append").parquet(str(sf / "lineitem.parquet"))
    monkeypatch.setattr(registered, "shared_folder", lambda _, label: str(tmp_path / label))
    found = registered.stream_annual(spark, str(sf))
    batch = registered.rounded(
        dividends.annual_dividends(registered.companies_tape(spark, str(sf))), "annual_dividend")
    assert sorted(found.collect()) == sorted(batch.select(*found.columns).collect())
    files = spark.read.parquet(str(tmp_path / "tape-files")).groupBy(F.input_file_name()).count()
    assert max(r["count"] for r in files.collect()) <= 240 / 8
    assert sorted(p.name for p in (tmp_path / "stream-tape" / "data").iterdir()) == [
        f"commit={2 * n}" for n in range(5)]
