"""Shapes of physical plans that must not change unnoticed."""

import re
from datetime import datetime

import pytest
from golden import SETTINGS, raw_tape, snapshots

from tickerloom import sampledata
from tickerloom.operators import clean, collector, dividends, membership, prices, returns
from tickerloom.sources import curated, delimited, inventory

S = SETTINGS


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tape(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "tape")
    return curated.curate(raw_tape(spark), path)


def test_dedupe_combines_before_the_shuffle(spark):
    plan = plan_of(clean.dedupe_tape(raw_tape(spark)))
    assert plan.count("Exchange") == 1
    assert "partial_min" in plan.split("Exchange")[1]


def test_date_filter_passes_the_dedupe_to_the_scan(spark):
    raw = sampledata.raw_tape(spark, "/root/testdata/sf0.001")
    plan = plan_of(prices.price_history(clean.clean_tape(raw), datetime(2001, 8, 1)))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate,2001-07-02", plan)
    scanned = re.search(r"FileScan parquet \[(.*?)\]", plan).group(1)
    assert "l_tax" not in scanned and "l_partkey" not in scanned


def test_recent_rows_prune_year_folders(tape):
    plan = plan_of(prices.price_history(tape, S.as_of))
    assert re.search(r"PartitionFilters: \[.*year#\d+ >= 2024", plan)


def test_annual_figures_hash_aggregate(tape):
    plan = plan_of(dividends.annual_summary(tape))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_streaks_sort_once(tape):
    annual = dividends.annual_dividends(tape)
    plan = plan_of(dividends.growth_streak(dividends.dividend_change(annual)))
    assert len(re.findall(r"[+:] ?- ?\*?(?:\(\d+\) )?Sort \[|Sort \[", plan)) == 1


def test_latest_price_has_no_sort(tape):
    plan = plan_of(prices.latest_price(tape, S.as_of))
    assert "Sort" not in plan and plan.count("Exchange") == 1


def test_market_is_broadcast_and_nothing_runs_in_one_task(tape):
    company = clean.company_rows(tape, S.benchmarks)
    found = returns.beta(company, clean.instrument_rows(tape, S.market), S.as_of)
    plan = plan_of(found)
    assert "BroadcastHashJoin [date" in plan
    assert "SinglePartition" not in plan


def test_returns_share_one_tape_exchange(tape):
    found = returns.log_returns(tape, S.as_of)
    found.collect()
    final = plan_of(found).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("FileScan parquet") == 1


def test_membership_has_no_nested_loop(spark):
    for df in (membership.snapshot_diff(snapshots(spark)),
               membership.latest_members(snapshots(spark)),
               membership.previous_members(snapshots(spark))):
        plan = plan_of(df)
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_latest_company_limits_before_the_shuffle(spark):
    plan = plan_of(membership.latest_company(snapshots(spark)))
    assert "WindowGroupLimit" in plan.split("Exchange")[1]


def test_numbering_orders_bucket_sizes_only(spark):
    rows = spark.range(10).selectExpr("cast(id as string) as symbol")
    plan = plan_of(collector.number_rows(rows, "symbol"))
    single = [part for part in plan.split("\n") if "SinglePartition" in part]
    assert len(single) == 1
    assert re.search(r"SinglePartition.*\n.*HashAggregate\(keys=\[_bucket", plan)


def test_first_lines_are_found_without_a_sort(spark, tmp_path, monkeypatch):
    """Files of several blocks, and several files in a task."""
    source = tmp_path / "in"
    source.mkdir()
    for name, header, n in (("a", "x,y", 3000), ("b", "y,x", 2), ("c 1", "x,y", 1), ("d", "x,y", 0)):
        (source / f"{name}.csv").write_text(header + "\n" + "1,2\n" * n)
    plans, frame = [], type(spark.range(0))
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda df: plans.append(plan_of(df)) or collect(df))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    try:
        found = delimited.files_by_header(spark, str(source))
        stock = inventory.take_stock(spark, str(source), str(tmp_path / "known"), 0)
        listed = {r["file"].rsplit("/", 1)[1]: r["header"] for r in stock.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [[f.rsplit("/", 1)[1] for f in files] for files in found] == [
        ["a.csv", "c 1.csv", "d.csv"], ["b.csv"]]
    assert listed == {"a.csv": "x,y", "b.csv": "y,x", "c%201.csv": "x,y", "d.csv": "x,y"}
    assert "SortAggregate" not in plans[0]
