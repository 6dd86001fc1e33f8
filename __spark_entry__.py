"""Registered queries: every operator over the whole test tables, with its SQL twin.

Accumulated values are rounded to six places on both sides, passed-through values
are not. Timestamps leave without a zone, as the tables hold them.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom import sql_twins
from tickerloom import sampledata as data
from tickerloom.functions.timeline import at, normalise_utc
from tickerloom.operators import (
    benchmarks,
    clean,
    collector,
    coverage,
    dividends,
    membership,
    moments,
    prices,
    returns,
    valuation,
)
from tickerloom.plans.publish import publish_report
from tickerloom.plans.report import company_figures, company_report, dropped_companies
from tickerloom.sources import (
    curated,
    delimited,
    documents,
    inventory,
    ledger,
    registry,
    replay,
    routing,
)
from tickerloom.sources.workspace import materialise, shared_folder
from tickerloom.streaming.annual import read_annual, start_annual
from tickerloom.streaming.curate import start_curation
from tickerloom.streaming.dedupe import drop_redelivered
from tickerloom.streaming.ingest import new_files, start_ingest, tape_stream

try:
    import corpus_pipeline
    from tickerloom.llm import queries as llm_queries
except ModuleNotFoundError as absent:  # the corpus operators may be taken out whole
    if absent.name not in ("corpus_pipeline", "tickerloom.llm"):
        raise
    corpus_pipeline = llm_queries = None

S = data.SETTINGS
RUN_TIME = S.as_of
# A time with many snapshots after it.
PAST = datetime(2000, 3, 15)


# --- shared pieces ---------------------------------------------------------------

def tape(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_tape(data.raw_tape(spark, sf))


def stored_tape(spark: SparkSession, sf: str) -> DataFrame:
    """The tape curated once, for plans that read it several times."""
    return curated.curate(data.raw_tape(spark, sf), shared_folder(spark, "curated"))


def companies_tape(spark: SparkSession, sf: str) -> DataFrame:
    return clean.company_rows(tape(spark, sf), S.benchmarks)


def index_tape(spark: SparkSession, sf: str) -> DataFrame:
    return clean.instrument_rows(tape(spark, sf), S.market)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def unzoned(df: DataFrame) -> DataFrame:
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in zoned})


def history_sizes(report: DataFrame) -> DataFrame:
    """Histories as counts and last dates: arrays are not compared as values."""
    return report.withColumns({
        "n_prices": F.size("price_history").cast("long"),
        "n_dividends": F.size("dividend_history").cast("long"),
        "last_price_date": F.try_element_at("price_history", F.lit(-1))["date"],
    }).drop("price_history", "dividend_history")


# --- scans, sources, sinks -------------------------------------------------------

def scan_tape(spark, sf):
    folder = shared_folder(spark, "tape-csv")
    delimited.write_tape(data.raw_tape(spark, sf), folder)
    return delimited.read_tape(spark, folder).select(
        "ticker",
        F.col("date").try_cast("timestamp").alias("date"),
        F.col("adj_close").try_cast("double").alias("adj_close"),
        F.col("dividends").try_cast("double").alias("dividends"),
    )


def scan_mixed_files(spark, sf):
    """Rows with dividends come in another order beside one more column; files without
    a price column hold the whole tape again and are put aside."""
    folder = shared_folder(spark, "mixed-csv")
    raw, paid = data.raw_tape(spark, sf), F.col("dividends") > 0
    delimited.write_tape(raw.filter(~paid), f"{folder}/plain")
    raw.filter(paid).select(
        F.col("ticker").alias("Ticker"), F.col("source_rank").alias("Stock Splits"),
        F.col("dividends").alias("Dividends"), F.col("adj_close").alias("Adj Close"),
        F.col("date").cast("string").alias("Date"),
    ).write.csv(f"{folder}/paid", header=True)
    raw.select(F.col("ticker").alias("Ticker"), F.col("date").cast("string").alias("Date")
               ).write.csv(f"{folder}/unpriced", header=True)
    routed = routing.route(delimited.read_tape(spark, f"{folder}/*"))
    return routed.filter(F.col("route") == routing.ACCEPTED).select(
        "ticker", "date", "adj_close", "dividends")


def listed_files(spark, sf):
    """The tape in two deliveries of other headers, each listed before the folder is read."""
    folder, known = shared_folder(spark, "listed-csv"), shared_folder(spark, "inventory")
    raw, paid = data.raw_tape(spark, sf), F.col("dividends") > 0
    delimited.write_tape(raw.filter(~paid), f"{folder}/plain")
    inventory.take_stock(spark, folder, known, 0)
    raw.filter(paid).select(
        F.col("ticker").alias("Ticker"), F.col("source_rank").alias("Stock Splits"),
        F.col("dividends").alias("Dividends"), F.col("adj_close").alias("Adj Close"),
        F.col("date").cast("string").alias("Date"),
    ).write.csv(f"{folder}/paid", header=True)
    inventory.take_stock(spark, folder, known, 1)
    routed = routing.route(inventory.read_listed_tape(spark, folder, known))
    return routed.filter(F.col("route") == routing.ACCEPTED).select(
        "ticker", "date", "adj_close", "dividends")


def nested_history(which: str, value: str):
    """The elements of one nested history with their position in the array."""

    def query(spark, sf):
        nested = prices.nested_histories(
            companies_tape(spark, sf), S.as_of, S.price_days, S.history_days)
        element = F.col("element")
        return nested.select("ticker", F.posexplode(which).alias("position", "element")).select(
            "ticker", F.col("position").cast("long").alias("position"),
            element["date"].alias("date"), element[value].alias(value.replace(" ", "_")))

    return query


def scan_snapshots(spark, sf):
    folder = shared_folder(spark, "snapshots-csv")
    delimited.write_snapshots(data.snapshots(spark, sf), folder)
    return delimited.read_snapshots(spark, folder)


def normalise_names(spark, sf):
    folder = shared_folder(spark, "customers-csv")
    data.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Cust Key"),
        F.col("c_name").alias("Security"),
        F.col("c_mktsegment").alias("Market-Segment"),
        F.col("c_acctbal").alias("ACCT Bal"),
    ).write.csv(folder, sep="|", header=True)
    return delimited.register_folder(spark, folder, "found_customers", sep="|")


def registered_rows(spark, sf):
    """Customers in two deliveries, registered one after the other: the first has whole
    balances and no segment, the second other columns in another order."""
    folder, known = shared_folder(spark, "registered-csv"), shared_folder(spark, "registry")
    customers = data.table(spark, sf, "customer")
    early = F.col("c_custkey") % 2 == 0
    customers.filter(early).select(
        F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("Security"),
        F.floor("c_acctbal").alias("ACCT Bal"),
    ).write.csv(f"{folder}/first", header=True)
    registry.discover(spark, folder, known, 0)
    customers.filter(~early).select(
        F.col("c_acctbal").alias("ACCT Bal"), F.col("c_mktsegment").alias("Market-Segment"),
        F.col("c_name").alias("Security"), F.col("c_custkey").alias("Cust Key"),
    ).write.csv(f"{folder}/second", header=True)
    registry.discover(spark, folder, known, 1)
    return registry.read_registered(spark, f"{folder}/*", known)


def _defective_events(spark, sf):
    """Events as text rows, some of them unreadable."""
    kind, value = F.col("event_type"), F.col("value")
    return data.table(spark, sf, "events").select(
        "event_id",
        F.when(kind != "error", F.col("user_id").cast("string")).alias("ticker"),
        F.when(value < 1, "bad").otherwise(F.col("ts").cast("string")).alias("date"),
        F.when(value >= 50, "n/a").otherwise(value.cast("string")).alias("adj_close"),
        F.when(value >= 30, "NaN").when(value < 5, None).otherwise("0.5").alias("dividends"),
    )


def quarantine(spark, sf):
    folder = shared_folder(spark, "routed")
    routing.write_routed(routing.route(_defective_events(spark, sf)), folder)
    accepted = routing.read_route(spark, folder, routing.ACCEPTED).withColumn(
        "reason", F.lit(None).cast("string")
    )
    refused = routing.read_route(spark, folder, routing.QUARANTINED).drop("raw_row")
    return accepted.unionByName(refused)


def replayed_rows(spark, sf):
    """Refused events, corrected and entered twice: those without a ticker or with two
    defects stay out."""
    routed, path, folder = (shared_folder(spark, x) for x in ("routed", "ledger", "replays"))
    events = _defective_events(spark, sf).withColumnRenamed("event_id", "source_rank")
    routing.write_routed(routing.route(events), routed)
    ledger.append(routing.read_route(spark, routed, routing.ACCEPTED), path, 0)
    refused = routing.read_route(spark, routed, routing.QUARANTINED)
    text = F.from_json("raw_row", "ticker string, date string, adj_close string, dividends string")
    reason, fields = F.col("reason"), F.col("text")
    corrections = replay.identified(refused).withColumn("text", text).select(
        "row_id", fields["ticker"].alias("ticker"),
        F.when(reason == "bad date", "2001-01-01").otherwise(fields["date"]).alias("date"),
        F.when(reason == "bad price", "49.5").otherwise(fields["adj_close"]).alias("adj_close"),
        F.when(reason == "bad dividend", "0").otherwise(fields["dividends"]).alias("dividends"),
        F.lit(RUN_TIME).alias("corrected_at"))
    for n in (1, 2):
        replay.enter(refused, corrections, path, folder, n)
    return ledger.read_current(spark, path)


def _published(spark, sf):
    folder = shared_folder(spark, "document")
    publish_report(stored_tape(spark, sf), data.companies(spark, sf), S, folder,
                   at(RUN_TIME, T.TimestampType()))
    return folder


def publish_document(spark, sf):
    """The companies of the written document, read back."""
    return documents.read_companies(spark, _published(spark, sf)).select(
        "ticker", "name", "sector", "industry",
        F.col("consecutiveGrowthYears").alias("streak"),
        F.col("dividendFrequency").alias("payments"),
        F.round("beta", 6).alias("beta"),
        F.round("fiveYearCAGR", 6).alias("cagr"),
        F.col("lastDividend").alias("last_dividend"),
        F.col("lastPrice").alias("last_price"),
        F.size("priceHistory").cast("long").alias("n_prices"),
        F.size("dividendHistory").cast("long").alias("n_dividends"),
    )


def published_rates(spark, sf):
    """The benchmark rates of the written document, read back."""
    return rounded(documents.read_benchmarks(spark, _published(spark, sf)), "rate")


def _stored_members(spark, sf):
    snapshots = data.snapshots(spark, sf)
    return (
        materialise(membership.new_members(snapshots, S.as_of), shared_folder(spark, "new")),
        materialise(membership.previous_members(snapshots, S.as_of),
                    shared_folder(spark, "previous")),
    )


def worklist_json(spark, sf):
    lines = documents.worklist_lines(*_stored_members(spark, sf))
    return lines.withColumnRenamed("key", "symbol")


def read_worklist(spark, sf):
    folder = shared_folder(spark, "worklist")
    documents.write_worklist(*_stored_members(spark, sf), folder)
    return documents.read_worklist(spark, folder)


def universe(spark, sf):
    snapshots = data.snapshots(spark, sf)
    members = membership.latest_members(snapshots, S.as_of).join(
        membership.latest_company(snapshots, as_of=S.as_of).select(
            F.col("ticker").alias("symbol"), F.col("name").alias("security"),
            F.col("sector").alias("gics_sector"), F.col("industry").alias("gics_sub_industry"),
        ),
        "symbol",
    )
    return collector.universe(members, at(RUN_TIME, T.TimestampNTZType()))


def write_snapshot_csv(spark, sf):
    folder = shared_folder(spark, "run-csv")
    delimited.write_snapshots(universe(spark, sf), folder)
    return delimited.read_snapshots(spark, folder)


# --- streams ---------------------------------------------------------------------

def _run_ingest(spark, source):
    target = shared_folder(spark, "ingested")
    start_ingest(new_files(spark, source), target, shared_folder(spark, "cp")).awaitTermination()
    return routing.read_route(spark, target, routing.ACCEPTED).drop("source_rank", "batch")


def stream_ingest(spark, sf):
    source = shared_folder(spark, "events-csv")
    delimited.write_tape(data.event_tape(spark, sf), source)
    return _run_ingest(spark, source)


def stream_first_delivery(spark, sf):
    """The feed is delivered twice; 40 days of memory span all its 30 days."""
    source = shared_folder(spark, "events-twice-csv")
    for _ in range(2):
        delimited.write_tape(data.event_tape(spark, sf), source)
    target = shared_folder(spark, "deduped")
    rows = routing.route(tape_stream(spark, source)).filter(F.col("route") == routing.ACCEPTED)
    (
        drop_redelivered(rows.select("ticker", "date", "adj_close", "dividends"), "40 days")
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", shared_folder(spark, "cp"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(target)


def stream_dedupe(spark, sf):
    """The feed comes with wrong prices first, with right ones and another header later."""
    source, true = shared_folder(spark, "events-corrected"), data.event_tape(spark, sf)
    places = [shared_folder(spark, label) for label in ("routed", "newest", "cp")]
    delimited.write_tape(true.withColumn("adj_close", -F.col("adj_close")), f"{source}/first")
    start_curation(spark, source, *places).awaitTermination()
    true.select(
        F.col("adj_close").alias("Adj Close"), F.col("ticker").alias("Ticker"),
        F.lit(1).alias("Volume"), F.col("dividends").alias("Dividends"),
        F.col("date").cast("string").alias("Date"),
    ).write.csv(f"{source}/second", header=True)
    start_curation(spark, source, *places).awaitTermination()
    return ledger.read_current(spark, places[1]).drop("year", "month")


def incremental_refresh(spark, sf):
    """Rows with dividends first come at twice their price; a later delivery, with its
    columns in another order, corrects them."""
    source, routed = shared_folder(spark, "deliveries"), shared_folder(spark, "routed")
    target, checkpoint = shared_folder(spark, "versions"), shared_folder(spark, "cp")
    true, paid = tape(spark, sf), F.col("dividends") > 0
    wrong = F.when(paid, F.col("adj_close") * 2).otherwise(F.col("adj_close"))
    delimited.write_tape(true.withColumn("adj_close", wrong), f"{source}/first")
    start_curation(spark, source, routed, target, checkpoint).awaitTermination()
    true.filter(paid).select(
        F.col("ticker").alias("Ticker"), F.col("adj_close").alias("Adj Close"),
        F.col("dividends").alias("Dividends"), F.col("date").cast("string").alias("Date"),
    ).write.csv(f"{source}/second", header=True)
    start_curation(spark, source, routed, target, checkpoint).awaitTermination()
    return ledger.read_current(spark, target)


def stream_annual(spark, sf):
    """The tape arrives in four deliveries by date, one per micro-batch, that share years;
    before them comes one with wrong dividends of one year's rows. A delivery is as many
    files as tasks wrote it."""
    source, annual = shared_folder(spark, "tape-files"), shared_folder(spark, "annual")
    places = shared_folder(spark, "stream-tape"), annual, shared_folder(spark, "cp")
    raw = data.raw_tape(spark, sf)
    paid = (F.col("dividends") > 0) & (F.year("date") == 1998)
    wrong = raw.filter(paid).withColumns({
        "dividends": F.col("dividends") * 2, "source_rank": F.col("source_rank") + 2**40})
    quarters = raw.agg(F.percentile_approx("date", [0.25, 0.5, 0.75])).first()[0] or []
    later = [F.col("date") > at(day, raw.schema["date"].dataType) for day in quarters]
    # Rows without a date come first.
    number = sum((F.coalesce(x, F.lit(False)).cast("int") for x in later), F.lit(0))
    for delivery in [wrong, *[raw.filter(number == n) for n in range(len(later) + 1)]]:
        delivery.write.mode("append").parquet(source)
        stream = spark.readStream.schema(raw.schema).parquet(source)
        start_annual(stream, *places, S.benchmarks).awaitTermination()
    return rounded(read_annual(spark, annual), "annual_dividend")


# --- membership through time -----------------------------------------------------

def intervals(spark, sf):
    return membership.membership_intervals(data.snapshots(spark, sf))


def extended_intervals(spark, sf):
    """Intervals until `PAST`, stored, then brought up to the snapshots after it."""
    snapshots = data.snapshots(spark, sf)
    early = membership.known_snapshots(snapshots, PAST)
    last = membership.snapshot_times(early, 1).first()["updated_at"]
    stored = materialise(membership.membership_intervals(early),
                         shared_folder(spark, "intervals"))
    return membership.extend_intervals(stored, snapshots, last)


def member_report(spark, sf):
    """The report on companies that were members two weeks before `as_of`, by their names
    then; symbols are tickers here."""
    settings = replace(S, min_streak=1)
    members = membership.members_as_of(intervals(spark, sf), datetime(2001, 7, 18))
    found = company_figures(stored_tape(spark, sf), members, settings)
    return rounded(found, "beta", "five_year_cagr")


# --- tape operators --------------------------------------------------------------

def beta(paired: bool):
    def query(spark, sf):
        found = returns.beta(
            companies_tape(spark, sf), index_tape(spark, sf), S.as_of, S.growth_days, paired
        )
        return rounded(found, "beta")

    return query


def stored_beta(spark, sf):
    """Moments of the months up to `PAST` and then of the later ones, and beta from them."""
    companies, index = companies_tape(spark, sf), index_tape(spark, sf)
    folder = shared_folder(spark, "moments")
    months = sorted(r["month"] for r in tape(spark, sf).select(
        moments.month_of().alias("month")).distinct().collect() if r["month"])
    cut = f"{PAST:%Y-%m}"
    moments.refresh_moments(spark, companies, index, [m for m in months if m <= cut], folder, 0)
    moments.refresh_moments(spark, companies, index, [m for m in months if m > cut], folder, 1)
    return rounded(moments.beta_from_moments(
        moments.read_moments(spark, folder), companies, index, S.as_of, S.growth_days), "beta")


def growth_streak(spark, sf):
    changes = dividends.dividend_change(dividends.annual_dividends(companies_tape(spark, sf)))
    return rounded(dividends.growth_streak(changes), "annual_dividend", "dividend_increase")


def dividend_change(spark, sf):
    annual = dividends.annual_dividends(companies_tape(spark, sf))
    return rounded(dividends.dividend_change(annual), "annual_dividend", "dividend_increase")


def rates(spark, sf):
    return benchmarks.benchmark_rates(
        tape(spark, sf), S.market, S.risk_free, S.as_of, S.growth_days
    )


def report(spark, sf, settings=S):
    return company_report(stored_tape(spark, sf), data.companies(spark, sf), settings)


def flagship(spark, sf, settings=S):
    found = history_sizes(report(spark, sf, settings))
    return rounded(found, "beta", "five_year_cagr")


def gordon_value(spark, sf):
    stored = stored_tape(spark, sf)
    valued = valuation.gordon_value(
        company_report(stored, data.companies(spark, sf), S),
        benchmarks.benchmark_rates(stored, S.market, S.risk_free, S.as_of, S.growth_days),
        S.market, S.risk_free,
    )
    return rounded(valued, "required_return", "next_dividend", "fair_price")


def audit(spark, sf):
    settings = replace(S, min_streak=1, history_days=30)
    return dropped_companies(tape(spark, sf), data.companies(spark, sf), settings)


# --- collector tables ------------------------------------------------------------

def wide_to_long(spark, sf):
    """Line items by day, with one column per return flag, line status and field."""
    kinds = [f + s for f in ("A", "N", "R") for s in ("F", "O")]  # fixed values
    wide = (
        data.table(spark, sf, "lineitem")
        .select(
            F.col("l_shipdate").alias("date"),
            F.concat("l_returnflag", "l_linestatus").alias("kind"),
            "l_extendedprice", "l_discount",
        )
        .groupBy("date")
        .pivot("kind", kinds)
        .agg(F.max("l_extendedprice").alias("High"),
             F.max(F.when(F.col("l_discount") >= 0.09, F.col("l_discount"))).alias("Dividends"))
    )
    named = wide.toDF(*[c.replace("_", "|") for c in wide.columns])
    return collector.wide_to_long(named).select(
        "date", "ticker", F.col("High").alias("high"), F.col("Dividends").alias("dividends")
    )


def fetch_plan(spark, sf):
    new, old = _stored_members(spark, sf)
    plan = collector.fetch_plan(new, old, RUN_TIME, "2001-08-01-00-00-00.csv")
    return plan.withColumn("batch", F.coalesce("batch", F.lit(-1)).cast("long"))


def missing_ranges(spark, sf):
    return coverage.missing_ranges(companies_tape(spark, sf), index_tape(spark, sf), S.as_of)


def fetch_plan_of_gaps(spark, sf):
    """Tickers as old symbols, each asked for the ranges it lacks."""
    old = companies_tape(spark, sf).select(F.col("ticker").alias("symbol")).distinct()
    plan = collector.fetch_plan(old.limit(0), old, RUN_TIME, "2001-08-01-00-00-00.csv",
                                gaps=missing_ranges(spark, sf))
    return plan.drop("batch")


def utc(spark, sf):
    return data.table(spark, sf, "events").select(
        "event_id",
        normalise_utc(F.col("ts")).cast("timestamp_ntz").alias("from_utc"),
        normalise_utc(F.col("ts"), "+05:30").cast("timestamp_ntz").alias("from_offset"),
    )


# --- contract --------------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """Company report on the smallest tables; a streak of one year qualifies there."""
    return unzoned(flagship(spark, "/root/testdata/sf0.001", replace(S, min_streak=1)))


def tape_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "scan_tape": scan_tape,
        "scan_mixed_files": scan_mixed_files,
        "listed_files": listed_files,
        "scan_snapshots": scan_snapshots,
        "normalise_names": normalise_names,
        "registered_rows": registered_rows,
        "publish_document": publish_document,
        "published_rates": published_rates,
        "worklist_json": worklist_json,
        "read_worklist": read_worklist,
        "write_snapshot_csv": write_snapshot_csv,
        "stream_ingest": stream_ingest,
        "quarantine": quarantine,
        "replayed_rows": replayed_rows,
        "clean_tape": tape,
        "curated_tape": stored_tape,
        "company_rows": companies_tape,
        "recent_rows": lambda s, d: clean.recent_rows(
            companies_tape(s, d), S.as_of, S.history_days),
        "normalise_utc": utc,
        "dedupe_tape": lambda s, d: clean.dedupe_tape(data.raw_tape(s, d)),
        "latest_company": lambda s, d: membership.latest_company(
            data.snapshots(s, d), as_of=S.as_of),
        "current_company": lambda s, d: membership.latest_company(
            data.snapshots(s, d), members_only=True, as_of=S.as_of),
        "snapshot_times": lambda s, d: membership.snapshot_times(
            data.snapshots(s, d), as_of=S.as_of),
        "latest_members": lambda s, d: membership.latest_members(
            data.snapshots(s, d), as_of=S.as_of),
        "previous_members": lambda s, d: membership.previous_members(
            data.snapshots(s, d), as_of=S.as_of),
        "new_members": lambda s, d: membership.new_members(
            data.snapshots(s, d), as_of=S.as_of),
        "snapshot_diff": lambda s, d: membership.snapshot_diff(
            data.snapshots(s, d), as_of=S.as_of),
        "membership_intervals": intervals,
        "extended_intervals": extended_intervals,
        "members_as_of": lambda s, d: membership.members_as_of(intervals(s, d), PAST),
        "companies_as_of": lambda s, d: membership.companies_as_of(intervals(s, d), PAST),
        "snapshot_diff_as_of": lambda s, d: membership.snapshot_diff(
            data.snapshots(s, d), as_of=PAST),
        "member_report": member_report,
        "universe": universe,
        "wide_to_long": wide_to_long,
        "fetch_plan": fetch_plan,
        "fetch_plan_of_gaps": fetch_plan_of_gaps,
        "annual_dividends": lambda s, d: rounded(
            dividends.annual_dividends(companies_tape(s, d)), "annual_dividend"),
        "dividend_change": dividend_change,
        "growth_streak": growth_streak,
        "dividend_growth": lambda s, d: rounded(
            dividends.dividend_growth(companies_tape(s, d), S.as_of, S.min_streak),
            "five_year_cagr"),
        "dividend_growth_calendar": lambda s, d: rounded(
            dividends.dividend_growth(
                companies_tape(s, d), S.as_of, S.min_streak, calendar=True),
            "five_year_cagr"),
        "dividend_cagr_calendar": lambda s, d: rounded(
            dividends.dividend_cagr_calendar(companies_tape(s, d), S.as_of), "calendar_cagr"),
        "log_returns": lambda s, d: rounded(
            returns.log_returns(companies_tape(s, d), S.as_of, S.growth_days), "log_return"),
        "intraday_returns": lambda s, d: rounded(
            returns.log_returns(clean.clean_tape(data.event_tape(s, d)), data.EVENTS_AS_OF, 365),
            "log_return"),
        "market_returns": lambda s, d: rounded(
            returns.market_returns(index_tape(s, d), S.as_of, S.growth_days), "market_return"),
        "beta": beta(paired=False),
        "beta_paired": beta(paired=True),
        "stored_beta": stored_beta,
        "beta_monthly": lambda s, d: rounded(
            returns.beta_monthly(companies_tape(s, d), index_tape(s, d), S.as_of, S.growth_days),
            "beta_monthly"),
        "latest_price": lambda s, d: prices.latest_price(companies_tape(s, d), S.as_of),
        "price_history": lambda s, d: prices.price_history(
            companies_tape(s, d), S.as_of, S.price_days),
        "dividend_history": lambda s, d: prices.dividend_history(
            companies_tape(s, d), S.as_of, S.history_days),
        "nested_prices": nested_history("price_history", "adj close"),
        "nested_dividends": nested_history("dividend_history", "dividends"),
        "benchmark_rates": lambda s, d: rounded(rates(s, d), "rate"),
        "index_rate_calendar": lambda s, d: rounded(
            benchmarks.index_rate(
                tape(s, d), S.market, S.as_of, S.growth_days, calendar=True),
            "rate"),
        "company_report": flagship,
        "company_figures": lambda s, d: rounded(
            company_figures(stored_tape(s, d), data.companies(s, d), S),
            "beta", "five_year_cagr"),
        "dropped_companies": audit,
        "gordon_value": gordon_value,
        "coverage_gaps": lambda s, d: coverage.coverage_gaps(companies_tape(s, d)),
        "coverage_gaps_as_of": lambda s, d: coverage.coverage_gaps(
            companies_tape(s, d), S.as_of),
        "missing_ranges": missing_ranges,
        "stream_dedupe": stream_dedupe,
        "stream_first_delivery": stream_first_delivery,
        "stream_annual": stream_annual,
        "incremental_refresh": incremental_refresh,
    }

    def without_zone(query):
        return lambda spark, sf_dir: unzoned(query(spark, sf_dir))

    return {name: without_zone(query) for name, query in q.items()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    corpus = {}
    if llm_queries:
        corpus = llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return tape_queries() | corpus


def oracle_sql() -> dict[str, str]:
    corpus = {}
    if llm_queries:
        corpus = dict(llm_queries.oracle_sql())
        if corpus_pipeline.ORACLE_SQL:
            corpus["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql_twins.oracle_sql() | corpus
