"""Annual dividends as a maintained view of a tape that comes by deliveries.

The view is a table of partial sums by ticker and year. A delivery adds the partial sums of
what it changed: its new rows, and for a replaced row the new amount less the old. Partials
merge by addition, so a batch reads its rows, the rows they replace, and no year of the tape
again; years with many partials are made one. Amounts are added as decimals, so taking one
back leaves nothing behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickerloom.operators.clean import company_rows
from tickerloom.sources import commits, ledger
from tickerloom.streaming.curate import append_commit, take_delivery

#: Amounts up to this size are added as decimals, others as doubles.
LARGEST = 1e20
EXACT = "decimal(38,12)"
SUMS = ["exact", "rest", "amounts", "payments", "rows"]
PARTIALS = (f"ticker string, exact {EXACT}, rest double, amounts long, payments long, "
            "rows long, year int")


def _contribution(amount: Column) -> list[Column]:
    """What one row adds to each sum but the last."""
    exact = F.abs(amount) < LARGEST
    return [
        F.when(exact, amount).otherwise(0.0).cast(EXACT),
        F.when(exact, 0.0).otherwise(F.coalesce(amount, F.lit(0.0))),
        amount.isNotNull().cast("long"),
        F.coalesce(amount > 0, F.lit(False)).cast("long"),
    ]


def partials(changed: DataFrame, benchmarks: list[str]) -> DataFrame:
    """Partial sums by ticker and year of the rows that `ledger.changes` lists."""
    after, before = _contribution(F.col("dividends")), _contribution(F.col("old_dividends"))
    parts = [F.sum(a - b).alias(n) for a, b, n in zip(after, before, SUMS, strict=False)]
    return (
        company_rows(changed, benchmarks)
        .groupBy("ticker", F.year("date").alias("year"))
        .agg(*parts, F.sum(F.col("is_new").cast("long")).alias("rows"))
        .withColumn("exact", F.col("exact").cast(EXACT))
        .select("ticker", *SUMS, "year")
    )


def _merged(found: DataFrame) -> DataFrame:
    return found.groupBy("ticker", "year").agg(*[F.sum(n).alias(n) for n in SUMS]).withColumn(
        "exact", F.col("exact").cast(EXACT)).select("ticker", *SUMS, "year")


def refresh_view(spark: SparkSession, tape_path: str, commit: int, annual_path: str, n: int,
                 benchmarks: list[str], folders: int = ledger.FOLDERS) -> None:
    """Add to the view what commit `commit` of the tape changed, as the view's batch `n`."""
    own, compaction = append_commit(n), append_commit(n) + 1
    if not commits.is_committed(spark, annual_path, own):
        known = commits.entries(spark, annual_path, before=own)
        changed = partials(ledger.changes(spark, tape_path, commit), benchmarks)
        added = commits.write_rows(changed, annual_path, own, "year", ["ticker"])
        commits.write_log(spark, annual_path, own, known + added)
    rest, many = commits.split_by_folders(
        commits.entries(spark, annual_path, before=compaction), folders)
    if many and not commits.is_committed(spark, annual_path, compaction):
        merged = _merged(commits.open_folders(spark, annual_path, many, PARTIALS))
        made = commits.write_rows(merged, annual_path, compaction, "year", ["ticker"])
        commits.write_log(spark, annual_path, compaction, rest + made)


def read_annual(spark: SparkSession, annual_path: str) -> DataFrame:
    """The view, as `dividends.annual_dividends` gives it for the newest deliveries."""
    named = commits.entries(spark, annual_path)
    found = _merged(commits.open_folders(spark, annual_path, named, PARTIALS))
    total = F.col("exact").cast("double") + F.col("rest")
    return found.filter("rows > 0").select(
        "ticker", "year",
        F.when(F.col("amounts") > 0, total).alias("annual_dividend"),
        F.col("payments").alias("dividend_frequency"))


def take_batch(batch: DataFrame, batch_id: int, tape_path: str, annual_path: str,
               benchmarks: list[str]) -> None:
    """Add a batch to the ledger, then its changes to the view. Each step that was done
    before a failure is left as it is when the batch runs again."""
    take_delivery(batch, batch_id, tape_path)
    refresh_view(batch.sparkSession, tape_path, append_commit(batch_id), annual_path,
                 batch_id, benchmarks)


def start_annual(tape: DataFrame, tape_path: str, annual_path: str, checkpoint: str,
                 benchmarks: list[str]) -> StreamingQuery:
    """Keep the view at `annual_path` over the companies of a stream of typed tape rows
    with `source_rank`; benchmarks stay out. The rows are kept in a ledger at `tape_path`."""
    return (
        tape.writeStream.foreachBatch(
            lambda batch, batch_id: take_batch(
                batch, batch_id, tape_path, annual_path, benchmarks)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
