"""Views of the star-schema test tables as the relations the library works on."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.settings import AnalysisSettings

SETTINGS = AnalysisSettings(
    as_of=datetime(2001, 8, 1), market="0", risk_free="1", min_streak=2
)
EVENTS_AS_OF = datetime(2024, 2, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments as quotes of their supplier; copies of a day rank by order line."""
    extended, discount = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("ticker"),
        F.col("l_shipdate").alias("date"),
        (extended / F.col("l_quantity")).alias("adj_close"),
        F.when(discount >= 0.09, extended * discount).otherwise(0.0).alias("dividends"),
        # Line numbers stay below 8.
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("source_rank"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with orders in a month as that month's members."""
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_custkey").cast("string").alias("symbol"),
            F.col("c_name").alias("security"),
            F.col("c_mktsegment").alias("gics_sector"),
            F.col("o_orderpriority").alias("gics_sub_industry"),
            F.date_trunc("month", "o_orderdate").alias("updated_at"),
        )
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the company dimension, named like `latest_company` does."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("ticker"),
            F.col("s_name").alias("name"),
            F.col("r_name").alias("sector"),
            F.col("n_name").alias("industry"),
        )
    )


def event_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an intraday feed of their user, without dividends."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("ticker"),
        F.col("ts").alias("date"),
        F.col("value").alias("adj_close"),
        F.lit(0.0).alias("dividends"),
    )
