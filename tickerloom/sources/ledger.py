"""The tape as a table that grows by deliveries, the newest of each (ticker, date) counting.

A delivery adds a folder for each month it touches and rewrites nothing. Each folder holds
one row per (ticker, date); where a month has several, the lowest `source_rank` wins, as in
`dedupe_tape`, whatever the order of the deliveries. `compact` makes one folder of the
months that have many. `sources.commits` keeps the log of the folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.operators.clean import dedupe_tape, with_calendar
from tickerloom.sources import commits

ROWS = ("ticker string, date timestamp, adj_close double, dividends double, "
        "source_rank long, month string")
COLUMNS = ["ticker", "date", "adj_close", "dividends", "source_rank"]
#: A month with so many folders becomes one at the next compaction.
FOLDERS = 8


def _by_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn("month", F.date_format("date", "yyyy-MM"))


def read_ranked(spark: SparkSession, path: str, months: list[str] | None = None,
                before: int | None = None) -> DataFrame:
    """One row per (ticker, date), with source_rank and month; of `months` alone if given,
    as the commits numbered below `before` left it.

    Only months with several folders are shuffled, by the aggregate of `dedupe_tape`.
    """
    named = commits.entries(spark, path, before)
    if months is not None:
        wanted = set(months)
        named = [e for e in named if e[0] in wanted]
    single, several = commits.split_by_folders(named)
    whole = commits.open_folders(spark, path, single, ROWS)
    if not several:
        return whole
    parts = commits.open_folders(spark, path, several, ROWS).select(*COLUMNS)
    return whole.unionByName(_by_month(dedupe_tape(parts, keep_rank=True)))


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The clean tape, as `clean_tape` would give it for all deliveries together."""
    return with_calendar(read_ranked(spark, path).drop("source_rank", "month"))


def append(rows: DataFrame, path: str, n: int) -> list[str]:
    """Commit `n`: add a delivery (the tape's columns and source_rank); the months touched.

    Copies of a key inside the delivery shrink to one per task before they meet.
    """
    spark = rows.sparkSession
    if not commits.is_committed(spark, path, n):
        known = commits.entries(spark, path, before=n)
        one = _by_month(dedupe_tape(rows.select(*COLUMNS), keep_rank=True))
        added = commits.write_rows(one, path, n, "month", ["ticker", "date"])
        commits.write_log(spark, path, n, known + added)
    return [month for month, _ in commits.folders_of(spark, path, n)]


def compact(spark: SparkSession, path: str, n: int, folders: int = FOLDERS) -> list[str]:
    """Commit `n`: one folder for each month that has `folders` or more; those months.
    Without such a month there is no commit."""
    if commits.is_committed(spark, path, n):
        return [month for month, _ in commits.folders_of(spark, path, n)]
    rest, many = commits.split_by_folders(commits.entries(spark, path, before=n), folders)
    months = sorted({month for month, _ in many})
    if months:
        merged = read_ranked(spark, path, months, before=n)
        made = commits.write_rows(merged, path, n, "month", ["ticker", "date"])
        commits.write_log(spark, path, n, rest + made)
    return months


def changes(spark: SparkSession, path: str, n: int) -> DataFrame:
    """What commit `n` changed: ticker, date, the values before and after, `is_new`.

    Reads the rows of the delivery and, of the state before it, the months it touches. A
    row that only repeats what was known, or is older than it, is no change.
    """
    own = commits.folders_of(spark, path, n)
    values = ["adj_close", "dividends"]
    rank = [F.struct(F.col(f"{side}source_rank").isNull(), f"{side}source_rank",
                     F.col(f"{side}adj_close").isNull(), f"{side}adj_close",
                     F.col(f"{side}dividends").isNull(), f"{side}dividends")
            for side in ("", "old_")]
    delivered = commits.open_folders(spark, path, own, ROWS).select(*COLUMNS)
    before = read_ranked(spark, path, [month for month, _ in own], before=n).select(
        *[F.col(c).alias(f"old_{c}") for c in COLUMNS], F.lit(True).alias("_known"))
    same = (F.col("ticker").eqNullSafe(F.col("old_ticker"))
            & F.col("date").eqNullSafe(F.col("old_date")))
    # The delivery is the small side and may be broadcast here, but not in an outer join.
    known = before.join(delivered.select("ticker", "date"), same, "left_semi")
    moved = ~(F.col("adj_close").eqNullSafe(F.col("old_adj_close"))
              & F.col("dividends").eqNullSafe(F.col("old_dividends")))
    return (
        delivered.join(known, same, "left")
        .filter(F.col("_known").isNull() | (moved & (rank[0] < rank[1])))
        .select("ticker", "date", *values, "old_adj_close", "old_dividends",
                F.col("_known").isNull().alias("is_new"))
    )

