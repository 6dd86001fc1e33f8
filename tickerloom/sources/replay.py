"""Corrections of quarantined rows, entered into the ledger exactly once.

A refused row is known by its text and the rank of its file (`row_id`), which stay the same
however often the folder is read or routed; copies of a line in one file are one row. A
correction names the row and gives its four fields anew, as text. It is judged like any
raw row: what is still unreadable stays refused, with its reason. What is good enters with
the rank of the file it came from, so newer files still win over it.

    <folder>/rows/replay=<n>/    what commit `n` judged
    <folder>/done/<n>            commit `n` is complete

An accepted correction closes its row: later corrections of it do nothing, and a later change
of the same (ticker, date) is a delivery of its own. A replay that failed in between is run
again under its number and does the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.sources import commits, ledger
from tickerloom.sources.files import file_names, write_text
from tickerloom.sources.routing import ACCEPTED, route

FIELDS = ["ticker", "date", "adj_close", "dividends"]
ROWS = ("row_id string, ticker string, date timestamp, adj_close double, dividends double, "
        "source_rank long, reason string, raw_row string, route string")


def identified(refused: DataFrame) -> DataFrame:
    """Refused rows with their `row_id`."""
    rank = F.col("source_rank") if "source_rank" in refused.columns else F.lit(None)
    return refused.withColumn("row_id", F.sha2(F.concat(
        F.coalesce(rank.cast("string"), F.lit("-")), F.lit("|"), F.col("raw_row")), 256))


def corrected(refused: DataFrame, corrections: DataFrame) -> DataFrame:
    """The corrected rows, routed: one for each refused row that a correction names.

    `corrections` are (row_id, ticker, date, adj_close, dividends, corrected_at). Of several
    for one row the newest counts, of equally new ones the largest fields. Those that name
    no refused row are left out.
    """
    newest = corrections.groupBy("row_id").agg(
        F.max(F.struct("corrected_at", *FIELDS)).alias("best")).select(
            "row_id", *[F.col(f"best.{c}").cast("string").alias(c) for c in FIELDS])
    rank = (F.min("source_rank") if "source_rank" in refused.columns
            else F.min(F.lit(None).cast("long")))
    # Corrections are few: they choose the refused rows before these are grouped.
    named = identified(refused).join(newest.select("row_id"), "row_id", "left_semi")
    origins = named.groupBy("row_id").agg(rank.alias("source_rank"))
    return route(newest.join(origins, "row_id"))


def entered(spark: SparkSession, folder: str) -> DataFrame:
    """row_id of the rows that complete replays have entered."""
    done = [n for n in file_names(spark, f"{folder}/done") if n.isdigit()]
    if not done:
        return spark.createDataFrame([], "row_id string")
    rows = spark.read.schema(ROWS).parquet(*[f"{folder}/rows/replay={n}" for n in done])
    return rows.filter(F.col("route") == ACCEPTED).select("row_id").distinct()


def waiting(spark: SparkSession, refused: DataFrame, folder: str) -> DataFrame:
    """Refused rows, with `row_id`, that no replay has entered."""
    return identified(refused).join(entered(spark, folder), "row_id", "left_anti")


def enter(refused: DataFrame, corrections: DataFrame, path: str, folder: str, n: int) -> None:
    """Commit `n` of the ledger at `path`: the good ones among the corrected rows that no
    earlier replay entered. `folder` keeps what was judged."""
    spark = refused.sparkSession
    if str(n) in file_names(spark, f"{folder}/done"):
        return
    own = f"{folder}/rows/replay={n}"
    # A commit that is complete is in the ledger already; only its mark is missing.
    if not commits.is_committed(spark, path, n):
        judged = corrected(refused, corrections).join(
            entered(spark, folder), "row_id", "left_anti")
        names = [c.split()[0] for c in ROWS.split(", ")]
        judged.select(*names).write.mode("overwrite").parquet(own)
        rows = spark.read.schema(ROWS).parquet(own)
        ledger.append(rows.filter(F.col("route") == ACCEPTED), path, n)
    write_text(spark, f"{folder}/done/{n}", "entered\n")


def refused_again(spark: SparkSession, folder: str, n: int) -> DataFrame:
    """row_id, reason and text of the corrections that replay `n` could not enter."""
    rows = spark.read.schema(ROWS).parquet(f"{folder}/rows/replay={n}")
    return rows.filter(F.col("route") != ACCEPTED).select("row_id", "reason", "raw_row")
