"""Send each input row to the curated or the quarantine side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.sources.delimited import CORRUPT

ACCEPTED, QUARANTINED = "accepted", "quarantined"


def _unreadable(name: str) -> Column:
    """The text is there, but it is no finite number. Empty text is a missing value."""
    value = F.col(name).try_cast("double")
    return F.col(name).isNotNull() & (
        value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")))


def _readable_date(tape: DataFrame) -> Column:
    """A whole date begins the text: a time alone would become one of today."""
    moment = F.col("date").try_cast("timestamp")
    if tape.schema["date"].dataType.typeName() != "string":
        return moment.isNotNull()
    return moment.isNotNull() & F.col("date").rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}")


def quarantine_reason(tape: DataFrame) -> Column:
    """Why a raw row is refused; null for a good one. The first reason counts."""
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in tape.columns else F.lit(False)
    return (
        F.when(corrupt, "malformed line")
        .when(F.col("ticker").isNull(), "no ticker")
        .when(~F.coalesce(_readable_date(tape), F.lit(False)), "bad date")
        .when(_unreadable("adj_close"), "bad price")
        .when(_unreadable("dividends"), "bad dividend")
    )


def route(tape: DataFrame) -> DataFrame:
    """Add `reason` and `route`; refused rows keep their text in `raw_row`.

    That is the line itself when it was malformed, else its fields as JSON.
    """
    source = ["ticker", "date", "adj_close", "dividends"]
    judged = tape.withColumn("reason", quarantine_reason(tape))
    refused = F.col("reason").isNotNull()
    text = F.to_json(F.struct(*source))
    if CORRUPT in tape.columns:
        text = F.coalesce(F.col(CORRUPT), text)
    extra = [c for c in judged.columns if c not in (*source, CORRUPT, "reason")]
    return judged.select(
        "ticker",
        F.col("date").try_cast("timestamp").alias("date"),
        F.col("adj_close").try_cast("double").alias("adj_close"),
        F.col("dividends").try_cast("double").alias("dividends"),
        *extra,
        "reason",
        F.when(refused, text).alias("raw_row"),
        F.when(refused, QUARANTINED).otherwise(ACCEPTED).alias("route"),
    )


def write_routed(routed: DataFrame, path: str, mode: str = "append") -> None:
    """Both sides in one pass over the input, as one folder per route."""
    (
        routed.write.partitionBy("route")
        .option("partitionOverwriteMode", "static")
        .mode(mode)
        .parquet(path)
    )


def read_route(spark: SparkSession, path: str, which: str) -> DataFrame:
    rows = spark.read.parquet(path).filter(F.col("route") == which).drop("route")
    return rows.drop("reason", "raw_row") if which == ACCEPTED else rows
