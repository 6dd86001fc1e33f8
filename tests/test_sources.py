"""Files in, files out."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from golden import SETTINGS, companies, raw_tape, snapshots
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tickerloom.functions.names import normalise_names, snake
from tickerloom.operators import clean, collector, membership
from tickerloom.plans.publish import publish_report
from tickerloom.plans.refresh import analysis_job, membership_job
from tickerloom.sources import curated, delimited, documents, routing
from tickerloom.sources.workspace import shared_folder

S = SETTINGS
RUN = datetime(2024, 7, 1)


def whole(path):
    """The document: all part files in path order."""
    parts = sorted(Path(path).glob("section=*/part-*"))
    return json.loads("".join(p.read_text() for p in parts))


def stamp():
    return F.lit("2024-07-01 00:00:00").cast("timestamp")


def test_names():
    assert snake("GICS Sub-Industry") == "gics_sub_industry"
    assert snake(" Adj Close ") == "adj_close"


def test_names_that_collide_are_refused(spark):
    with pytest.raises(ValueError, match="a_b"):
        normalise_names(spark.createDataFrame([(1, 2)], "`A b` int, `a-B` int"))


def test_tape_files_with_extra_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "Date,Ticker,Open,Adj Close,Dividends\n2024-01-02,AAA,1,2.5,0.1\n2024-01-03,AAA,1,,0\n"
        "2024-01-04,AAA,1\n"
    )
    rows = delimited.read_tape(spark, str(tmp_path)).orderBy("date").collect()
    assert [(r.ticker, r.date, r.adj_close, r.dividends) for r in rows] == [
        ("AAA", "2024-01-02", "2.5", "0.1"), ("AAA", "2024-01-03", None, "0"),
        ("AAA", "2024-01-04", None, None),
    ]
    assert [r[delimited.CORRUPT] for r in rows] == [None, None, "2024-01-04,AAA,1"]


def test_files_with_different_headers_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Date,Ticker,Adj Close,Dividends\n2024-01-02,AAA,2.5,0.1\n")
    (tmp_path / "b 1.csv").write_text("Ticker,Date,Adj Close,Dividends\nBBB,2024-01-02,3.5,0.2\n")
    (tmp_path / "c.csv").write_text(
        "Date,Ticker,Adj Close,Dividends,Stock Splits\n2024-01-03,AAA,2.6,0,2\n2024-01-04,AAA,1\n")
    (tmp_path / "d.csv").write_text("Time,Symbol\n2024-01-02,AAA\n")
    (tmp_path / "e.csv").write_text("")
    routed = routing.route(delimited.read_tape(spark, str(tmp_path))).collect()
    good = sorted((r["ticker"], str(r["date"])[:10], r["adj_close"], r["dividends"])
                  for r in routed if r["route"] == "accepted")
    assert good == [("AAA", "2024-01-02", 2.5, 0.1), ("AAA", "2024-01-03", 2.6, 0.0),
                    ("BBB", "2024-01-02", 3.5, 0.2)]
    bad = sorted((r["reason"], r["raw_row"]) for r in routed if r["route"] == "quarantined")
    assert bad == [("malformed line", "2024-01-02,AAA"), ("malformed line", "2024-01-04,AAA,1"),
                   ("malformed line", "Time,Symbol")]


def test_another_header_than_the_promised_one_is_refused(spark, tmp_path):
    (tmp_path / "b.csv").write_text("Ticker,Date,Adj Close,Dividends\nAAA,2024-01-02,2.5,0.1\n")
    header = ["Date", "Ticker", "Adj Close", "Dividends"]
    with pytest.raises(Exception, match="CSV header does not conform"):
        delimited.read_tape(spark, str(tmp_path), header).collect()


def test_refused_snapshot_lines_are_listed(spark, tmp_path):
    top = "Symbol|Security|GICS Sector|GICS Sub-Industry|updatedAt\n"
    (tmp_path / "a.csv").write_text(
        f"{top}A|Alpha|Tech|Chips|2024-01-02 00:00:00\nB|Beta\nC|Gamma|Tech|Chips|soon\n")
    found = delimited.refused_snapshots(spark, str(tmp_path)).collect()
    assert sorted(r["reason"] for r in found) == ["bad time", "malformed line"]
    assert "B|Beta" in [r["raw_row"] for r in found]
    whole = delimited.read_snapshots(spark, str(tmp_path)).filter("updated_at IS NOT NULL")
    assert [r["symbol"] for r in whole.collect()] == ["A"]


def test_registered_folder_matches_columns_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,B\n1,x\n007,y\n")
    (tmp_path / "b.csv").write_text("B,A,C\nz,q7,5\n")
    found = delimited.register_folder(spark, str(tmp_path), "mixed_folder")
    assert sorted(map(tuple, found.select("a", "b", "c").collect()), key=str) == [
        ("007", "y", None), ("1", "x", None), ("q7", "z", 5)]


def test_bad_rows_are_quarantined_with_reason(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.csv").write_text(
        "Date,Ticker,Adj Close,Dividends\n"
        "2024-01-02,AAA,2.5,0.1\n"
        "bad,AAA,2.5,0.1\n"
        "2024-01-02,,2.5,0.1\n"
        "2024-01-02,AAA,x,0.1\n"
        "2024-01-02,AAA,2.5,NaN\n"
        "2024-01-03,AAA,,\n"
        "2024-01-02,AAA,2.5,0.1,extra\n"
    )
    routing.write_routed(routing.route(delimited.read_tape(spark, str(source))), target)
    good = routing.read_route(spark, target, routing.ACCEPTED).orderBy("date").collect()
    assert [(r.date.day, r.adj_close, r.dividends) for r in good] == [(2, 2.5, 0.1), (3, None, None)]
    bad = routing.read_route(spark, target, routing.QUARANTINED).collect()
    assert sorted(r.reason for r in bad) == [
        "bad date", "bad dividend", "bad price", "malformed line", "no ticker",
    ]
    by_reason = {r.reason: r.raw_row for r in bad}
    assert json.loads(by_reason["bad price"])["adj_close"] == "x"
    assert by_reason["malformed line"] == "2024-01-02,AAA,2.5,0.1,extra"


def test_snapshots_round_trip(spark, tmp_path):
    path = str(tmp_path / "runs")
    shots = snapshots(spark)
    delimited.write_snapshots(shots, path)
    assert (tmp_path / "runs" / "run=2024-06-27-00-00-00").is_dir()
    back = delimited.read_snapshots(spark, path)
    assert sorted(back.collect()) == sorted(shots.select(back.columns).collect())


def test_a_run_written_again_replaces_itself_only(spark, tmp_path):
    path, shots = str(tmp_path / "runs"), snapshots(spark)
    delimited.write_snapshots(shots, path)
    delimited.write_snapshots(shots.filter("updated_at = '2024-06-28'"), path)
    assert delimited.read_snapshots(spark, path).count() == shots.count()


def test_fetched_rows_land_under_their_output_key(spark, tmp_path):
    path = str(tmp_path / "data")
    plan = collector.fetch_plan(
        spark.createDataFrame([("AAA",)], "symbol string"),
        spark.createDataFrame([("BBB",)], "symbol string"), RUN, "run.csv",
    )
    keyed = raw_tape(spark).join(
        plan.select(F.col("symbol").alias("ticker"), "output_key"), "ticker"
    )
    for _ in range(2):
        delimited.write_tape(keyed, path)
    names = {p.name for p in Path(path).glob("output_key=*")}
    assert names == {"output_key=run-daily.csv", "output_key=run-historical-batch-0.csv"}
    header = ["Date", "Ticker", "Adj Close", "Dividends"]
    folder = f"{path}/output_key=run-daily.csv"
    assert delimited.read_tape(spark, folder, header).count() == 9
    assert delimited.read_tape(spark, path).count() == keyed.count()


def test_folder_is_found_and_registered(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Symbol|GICS Sector|Founded\nA|Tech|1999\nB|Energy|2001\n")
    delimited.register_folder(spark, str(tmp_path), "found", sep="|")
    rows = spark.sql("SELECT symbol, gics_sector, founded + 1 AS f FROM found ORDER BY 1").collect()
    assert [tuple(r) for r in rows] == [("A", "Tech", 2000), ("B", "Energy", 2002)]


def test_curated_tape_round_trip(spark, tmp_path):
    path = str(tmp_path / "curated")
    tape = curated.curate(raw_tape(spark), path)
    expected = clean.clean_tape(raw_tape(spark))
    assert sorted(tape.select(expected.columns).collect()) == sorted(expected.collect())
    assert (Path(path) / "year=2024").is_dir()


def test_document_is_one_json_value(spark, tmp_path):
    path = str(tmp_path / "doc")
    tape = clean.clean_tape(raw_tape(spark))
    report = publish_report(tape, companies(spark), S, path, stamp())
    [document] = whole(path)
    assert [c["ticker"] for c in document["companies"]] == ["AAA", "BBB"]
    first = document["companies"][0]
    assert list(first) == [
        "ticker", "name", "sector", "industry", "consecutiveGrowthYears", "dividendFrequency",
        "beta", "fiveYearCAGR", "lastDividend", "lastPrice", "priceHistory", "dividendHistory",
    ]
    assert first["priceHistory"][0] == {"date": "2024-06-03T00:00:00.000Z", "adj close": 90.0}
    assert {b["ticker"]: round(b["rate"], 8) for b in document["benchmarks"]} == {
        "^GSPC": 0.12723451, "^TNX": 0.043,
    }
    assert document["lastUpdated"] == "2024-07-01T00:00:00.000Z"
    back = documents.read_companies(spark, path).orderBy("ticker").collect()
    stored = report.orderBy("ticker").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in stored]


def test_document_without_companies(spark, tmp_path):
    path = str(tmp_path / "doc")
    tape = clean.clean_tape(raw_tape(spark))
    publish_report(tape, companies(spark).limit(0), S, path, stamp())
    [document] = whole(path)
    assert document["companies"] == [] and len(document["benchmarks"]) == 2
    assert documents.read_companies(spark, path).count() == 0


@pytest.mark.parametrize("keep, fields", [(False, ["ticker"]), (True, ["ticker", "name"])])
def test_null_fields_in_the_document(spark, tmp_path, keep, fields):
    report = spark.createDataFrame(
        [("A",)], "ticker string"
    ).withColumns({n: F.lit(None).cast("string") for n in (
        "name", "sector", "industry", "consecutive_growth_years", "dividend_frequency", "beta",
        "five_year_cagr", "last_dividend", "last_price", "price_history", "dividend_history")})
    rates = spark.createDataFrame([("f", 0.04)], "ticker string, rate double")
    documents.publish_document(report, rates, str(tmp_path / "d"), stamp(), keep)
    [document] = whole(tmp_path / "d")
    assert list(document["companies"][0])[:2] == fields


def test_long_document_keeps_its_order(spark, tmp_path):
    """Many elements spread over several files still read as one ordered array."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    members = spark.range(5000).select(F.format_string('s"%05d', "id").alias("symbol"))
    documents.write_worklist(members, members.limit(0), str(tmp_path / "w"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "w").glob("section=1/part-*"))) > 1
    found = whole(tmp_path / "w")
    assert found["New_Tickers"] == [f's"{i:05d}' for i in range(5000)]
    assert found["Old_Tickers"] == []


def test_a_document_written_again_replaces_the_old_one(spark, tmp_path):
    members = spark.createDataFrame([("A",)], "symbol string")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    documents.write_worklist(members, members, str(tmp_path / "w"))
    documents.write_worklist(members.limit(0), members, str(tmp_path / "w"))
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert whole(tmp_path / "w") == {"New_Tickers": [], "Old_Tickers": ["A"]}


def test_worklist_round_trip_with_a_null_symbol(spark, tmp_path):
    new = spark.createDataFrame([("B",), (None,), ("A",)], "symbol string")
    old = spark.createDataFrame([("C",)], "symbol string")
    documents.write_worklist(new, old, str(tmp_path / "w"))
    assert whole(tmp_path / "w") == {"New_Tickers": [None, "A", "B"], "Old_Tickers": ["C"]}
    rows = documents.read_worklist(spark, str(tmp_path / "w")).collect()
    assert sorted(map(tuple, rows), key=str) == [
        ("A", "historical"), ("B", "historical"), ("C", "daily"), (None, "historical"),
    ]


def test_worklist_from_a_single_file(spark, tmp_path):
    (tmp_path / "w.json").write_text('{"New_Tickers": ["N"], "Old_Tickers": ["A", "B"]}')
    rows = documents.read_worklist_file(spark, str(tmp_path / "w.json")).collect()
    assert sorted(map(tuple, rows)) == [("A", "daily"), ("B", "daily"), ("N", "historical")]


def test_universe(spark):
    members = spark.createDataFrame([("AAA", "AAA Inc", "Tech")], "symbol string, security string, gics_sector string")
    rows = {r.symbol: r for r in collector.universe(members, stamp()).collect()}
    assert set(rows) == {"AAA", "^TNX", "^GSPC"}
    assert rows["^TNX"].security == "10 Year Treasury Note" and rows["^TNX"].gics_sector is None
    assert {r.updated_at for r in rows.values()} == {RUN}


def test_wide_rows(spark):
    wide = spark.createDataFrame(
        [("2024-01-02", 1.0, 0.1, None, None), ("2024-01-03", None, 0.2, 3.0, 7)],
        "date string, `A|Adj Close` double, `A|Dividends` double, `B|Adj Close` double, `B|Volume` int",
    )
    rows = collector.wide_to_long(wide).collect()
    assert sorted(map(tuple, rows)) == [
        ("2024-01-02", "A", 1.0, 0.1, None),
        ("2024-01-03", "A", None, 0.2, None),
        ("2024-01-03", "B", 3.0, None, 7),
    ]


@pytest.mark.parametrize("count, batches", [(0, []), (1, [0]), (101, [0, 100]), (250, [0, 100, 200])])
def test_batches(spark, count, batches):
    new = spark.range(count).select(F.concat(F.lit("S"), "id").alias("symbol"))
    plan = collector.fetch_plan(new, new.limit(0), RUN, "2024-07-01-00-00-00.csv")
    sizes = {r.batch: r["count"] for r in plan.groupBy("batch").count().collect()}
    assert sorted(sizes) == batches
    assert all(sizes[b] == 100 for b in batches[:-1])
    positions = [r.position for r in collector.number_rows(new, "symbol").collect()]
    assert sorted(positions) == list(range(count))


def test_fetch_plan(spark):
    shots = snapshots(spark)
    plan = collector.fetch_plan(
        membership.new_members(shots), membership.previous_members(shots), RUN, "run.x.csv"
    ).collect()
    daily = [r for r in plan if r.mode == "daily"]
    assert len(daily) == 6
    assert {(r.start_date, r.end_date, r.output_key) for r in daily} == {
        (datetime(2024, 6, 30), RUN, "run-daily.csv")}
    [new] = [r for r in plan if r.mode == "historical"]
    assert (new.symbol, new.start_date, new.batch, new.output_key) == (
        "FFF", datetime(1900, 1, 1), 0, "run-historical-batch-0.csv")


def test_fetch_plan_from_the_last_seen_date(spark):
    old = spark.createDataFrame([("A",), ("B",)], "symbol string")
    seen = spark.createDataFrame([("A", datetime(2024, 6, 27))], "symbol string, last_date timestamp")
    plan = collector.fetch_plan(old.limit(0), old, RUN, "r.csv", last_seen=seen).collect()
    assert {r.symbol: r.start_date for r in plan} == {
        "A": datetime(2024, 6, 28), "B": datetime(2024, 6, 30)}


def test_jobs_from_folder_to_document(spark, tmp_path):
    runs, tape = str(tmp_path / "runs"), str(tmp_path / "tape")
    delimited.write_snapshots(snapshots(spark), runs)
    delimited.write_tape(raw_tape(spark), tape)
    plan = membership_job(spark, runs, str(tmp_path / "worklist"), RUN, "2024-07-01-00-00-00.csv")
    assert plan.count() == 7
    assert whole(tmp_path / "worklist")["New_Tickers"] == ["FFF"]
    for _ in range(2):
        report = analysis_job(
            spark, tape, runs, str(tmp_path / "routed"), str(tmp_path / "curated"),
            str(tmp_path / "doc"), S, RUN,
        )
    assert sorted(r.ticker for r in report.collect()) == ["AAA", "BBB"]
    assert [c["name"] for c in whole(tmp_path / "doc")[0]["companies"]] == [
        "AAA at 2024-07-01", "BBB at 2024-07-01"]


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one.startswith(base) and two.startswith(base) and one != two


def test_curated_folder_is_not_overwritten(spark, tmp_path):
    path = str(tmp_path / "curated")
    curated.curate(raw_tape(spark), path)
    with pytest.raises(AnalysisException):
        curated.curate(raw_tape(spark), path)
