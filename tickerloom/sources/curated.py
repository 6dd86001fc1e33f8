"""The curated tape: typed, deduplicated parquet, written once and read by every analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.operators.clean import clean_tape


def write_curated(tape: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a clean tape in `year` folders, ordered by ticker inside each file.

    The rebalance hint sizes files: it splits a heavy year over several tasks and
    merges light ones, which a plain repartition by year would not. The order lets
    a reader of one ticker skip most row groups.
    """
    (
        tape.select("ticker", "date", "adj_close", "dividends", "year")
        .hint("rebalance", "year")
        .sortWithinPartitions("year", "ticker", "date")
        .write.partitionBy("year")
        .option("partitionOverwriteMode", "static")
        .mode(mode)
        .parquet(path)
    )


def curate(raw: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Clean `raw` into the curated layout at `path` and read it back."""
    tape = clean_tape(raw).drop("month")
    write_curated(tape, path, mode)
    schema = tape.select("ticker", "date", "adj_close", "dividends", "year").schema
    return raw.sparkSession.read.schema(schema).parquet(path).withColumn("month", F.month("date"))
