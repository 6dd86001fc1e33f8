"""JSON documents too large for one task.

A document is written as lines: an opening, the elements of each array, a
closing. The lines are range-sorted over as many files as the data needs, in one
folder per section, and the files in path order, put one after another, are the
document. Nothing is collected into a single row, and readers parse lines in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.schemas import BENCHMARK, COMPANY, DOCUMENT, WORKLIST


def element_lines(elements: DataFrame, section: int, key: str, value: Column) -> DataFrame:
    """One line per array element, led by a comma except for the smallest key.

    `key` is unique in `elements`, which should be a stored table: it is read twice.
    """
    # One row by construction. The struct lets a null key come first, as it sorts.
    first = elements.agg(F.min(F.struct(F.col(key))).alias("_least")).select(
        F.col(f"_least.{key}").alias("_first"), F.lit(True).alias("_leads")
    )
    return (
        elements.select(F.col(key).alias("key"), value.alias("_value"))
        .join(F.broadcast(first), F.col("key").eqNullSafe(F.col("_first")), "left")
        .select(
            F.lit(section).alias("section"),
            "key",
            F.concat(F.when(F.col("_leads"), "").otherwise(","), "_value").alias("line"),
        )
    )


def frame_line(spark: SparkSession, section: int, line: str) -> DataFrame:
    """A line between sections."""
    return spark.range(1).select(
        F.lit(section).alias("section"), F.lit(None).cast("string").alias("key"),
        F.lit(line).alias("line"),
    )


def write_lines(lines: DataFrame, path: str) -> None:
    """Write a document; one already at `path` is replaced, all sections of it."""
    (
        lines.orderBy("section", "key")
        .select("section", "line")
        .write.partitionBy("section")
        .option("partitionOverwriteMode", "static")
        .mode("overwrite")
        .text(path)
    )


def read_elements(spark: SparkSession, path: str, section: int) -> DataFrame:
    """The JSON text of one section's lines, without the separating commas."""
    return (
        spark.read.text(path)
        .filter(F.col("section") == section)
        .select(F.regexp_replace("value", "^,", "").alias("json"))
    )


def company_struct(report: DataFrame) -> Column:
    """A report row under the published field names."""
    return F.struct(
        "ticker", "name", "sector", "industry",
        F.col("consecutive_growth_years").alias("consecutiveGrowthYears"),
        F.col("dividend_frequency").alias("dividendFrequency"),
        "beta",
        F.col("five_year_cagr").alias("fiveYearCAGR"),
        F.col("last_dividend").alias("lastDividend"),
        F.col("last_price").alias("lastPrice"),
        F.col("price_history").alias("priceHistory"),
        F.col("dividend_history").alias("dividendHistory"),
    )


def document_lines(report: DataFrame, rates: DataFrame, updated_at: Column,
                   keep_nulls: bool = False) -> DataFrame:
    """Lines of the published document: companies, benchmark rates, time of the run.

    Null fields are left out unless `keep_nulls`. With no company at all the
    document still holds an empty array.
    """
    spark = report.sparkSession
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    companies = element_lines(report, 1, "ticker", F.to_json(company_struct(report), options))
    # At most two rows: one per benchmark.
    benchmarks = rates.agg(
        F.to_json(F.sort_array(F.collect_list(F.struct("ticker", "rate"))), options).alias("json")
    )
    stamp = F.get_json_object(F.to_json(F.struct(updated_at.alias("t"))), "$.t")
    closing = benchmarks.select(
        F.lit(2).alias("section"),
        F.lit(None).cast("string").alias("key"),
        F.concat(F.lit('],"benchmarks":'), "json", F.lit(',"lastUpdated":"'), stamp, F.lit('"}]'))
        .alias("line"),
    )
    return frame_line(spark, 0, '[{"companies":[').unionByName(companies).unionByName(closing)


def publish_document(report: DataFrame, rates: DataFrame, path: str, updated_at: Column,
                     keep_nulls: bool = False) -> None:
    write_lines(document_lines(report, rates, updated_at, keep_nulls), path)


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """Company rows of a published document."""
    return (
        read_elements(spark, path, 1)
        .select(F.from_json("json", COMPANY).alias("company"))
        .select("company.*")
    )


def read_benchmarks(spark: SparkSession, path: str) -> DataFrame:
    """Benchmark rows and time of the run of a published document."""
    closing = T.StructType([
        T.StructField("benchmarks", T.ArrayType(BENCHMARK)),
        T.StructField("lastUpdated", T.TimestampType()),
    ])
    # The closing line starts by ending the companies and ends by closing the document.
    text = F.concat(F.lit("{"), F.regexp_extract("json", r"^\],(.*)\]$", 1))
    return (
        read_elements(spark, path, 2)
        .select(F.from_json(text, closing).alias("d"))
        .select(F.inline("d.benchmarks"), F.col("d.lastUpdated").alias("last_updated"))
    )


def worklist_lines(new: DataFrame, old: DataFrame) -> DataFrame:
    """Lines of the collector's worklist: new and old symbols."""
    spark = new.sparkSession
    # A JSON string of the symbol, quoted and escaped.
    quoted = F.regexp_extract(F.to_json(F.array("symbol")), r"^\[(.*)\]$", 1)
    return (
        frame_line(spark, 0, '{"New_Tickers": [')
        .unionByName(element_lines(new, 1, "symbol", quoted))
        .unionByName(frame_line(spark, 2, '], "Old_Tickers": ['))
        .unionByName(element_lines(old, 3, "symbol", quoted))
        .unionByName(frame_line(spark, 4, "]}"))
    )


def write_worklist(new: DataFrame, old: DataFrame, path: str) -> None:
    write_lines(worklist_lines(new, old), path)


def _symbols(elements: DataFrame, mode: str) -> DataFrame:
    symbol = F.from_json(F.concat(F.lit("["), "json", F.lit("]")), "array<string>")[0]
    return elements.select(symbol.alias("symbol"), F.lit(mode).alias("mode"))


def read_worklist(spark: SparkSession, path: str) -> DataFrame:
    """Rows (symbol, mode) of a worklist written by `write_worklist`."""
    new = _symbols(read_elements(spark, path, 1), "historical")
    return new.unionByName(_symbols(read_elements(spark, path, 3), "daily"))


def read_worklist_file(spark: SparkSession, path: str) -> DataFrame:
    """The same rows from a worklist that came as one JSON object in one file."""
    return (
        spark.read.schema(WORKLIST)
        .json(path, multiLine=True)
        .select(F.explode(F.array(
            F.struct(F.col("New_Tickers").alias("symbols"), F.lit("historical").alias("mode")),
            F.struct(F.col("Old_Tickers").alias("symbols"), F.lit("daily").alias("mode")),
        )).alias("part"))
        .select(F.explode("part.symbols").alias("symbol"), "part.mode")
    )


def read_document_file(spark: SparkSession, path: str) -> DataFrame:
    """A published document that came as one file: one row of nested arrays."""
    return spark.read.schema(DOCUMENT).json(path, multiLine=True)
