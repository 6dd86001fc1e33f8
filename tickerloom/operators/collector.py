"""Tables around the collection of prices: the universe, the fetch plan, wide results."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions.timeline import at

# Instruments collected besides the index members. Fixed values.
BENCHMARK_SECURITIES = [("^TNX", "10 Year Treasury Note"), ("^GSPC", "S&P 500")]

HISTORY_START = datetime(1900, 1, 1)
DAILY, HISTORICAL = "daily", "historical"


def universe(members: DataFrame, run_time: Column,
             benchmarks: list[tuple[str, str]] | None = None) -> DataFrame:
    """Members plus benchmark instruments, stamped with the time of the run.

    Columns the benchmarks do not have are null for them.
    """
    rows = members.sparkSession.createDataFrame(
        BENCHMARK_SECURITIES if benchmarks is None else benchmarks,
        "symbol string, security string",
    )
    return members.unionByName(rows, allowMissingColumns=True).withColumn("updated_at", run_time)


def wide_to_long(wide: DataFrame, sep: str = "|", date: str = "date") -> DataFrame:
    """Columns `<ticker><sep><field>` to rows (date, ticker, fields).

    A ticker without any value on a date gives no row. Works row by row: no shuffle.
    """
    fields: dict[str, list[str]] = {}
    for column in wide.columns:
        if column != date:
            ticker, field = column.split(sep, 1)
            fields.setdefault(ticker, []).append(field)
    kinds = {f: wide.schema[f"{t}{sep}{f}"].dataType for t, own in fields.items() for f in own}

    def entry(ticker: str) -> Column:
        cells = [
            (F.col(f"`{ticker}{sep}{f}`") if f in fields[ticker] else F.lit(None).cast(kind))
            .alias(f)
            for f, kind in kinds.items()
        ]
        return F.struct(F.lit(ticker).alias("ticker"), *cells)

    has_value = reduce(or_, [F.col(f"`{f}`").isNotNull() for f in kinds])
    return wide.select(date, F.inline(F.array(*[entry(t) for t in fields]))).filter(has_value)


def number_rows(rows: DataFrame, key: str) -> DataFrame:
    """Add `position`: 0, 1, 2, ... over all rows, in a fixed order of the unique `key`.

    The order is by hash bucket and key. Each bucket counts on its own, and only the
    bucket sizes meet in one window, so no task ever orders the whole table.
    """
    bucket = F.conv(F.substring(F.md5(F.col(key)), 1, 3), 16, 10).cast("int")
    spread = rows.withColumn("_bucket", F.coalesce(bucket, F.lit(0)))
    before = F.sum("_size").over(
        Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    # At most 16**3 rows, whatever the input: safe to order and to broadcast.
    offsets = (
        spread.groupBy("_bucket")
        .agg(F.count("*").alias("_size"))
        .select("_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    )
    in_bucket = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        spread.withColumn("_place", in_bucket)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn("position", F.col("_before") + F.col("_place") - 1)
        .drop("_bucket", "_place", "_before")
    )


def fetch_plan(new: DataFrame, old: DataFrame, run_time: datetime, source_file: str,
               batch_size: int = 100, last_seen: DataFrame | None = None,
               gaps: DataFrame | None = None) -> DataFrame:
    """What to fetch for whom: one row per symbol with its range and output key.

    Old symbols get the day before the run, new ones everything, in batches named
    by their offset. `last_seen` (symbol, last_date) lets an old symbol start where
    its data ends, which closes the gaps a fixed one-day range leaves over weekends. `gaps`,
    as `coverage.missing_ranges` gives them, makes a row for each range an old symbol lacks;
    one that lacks none keeps its usual row.
    """
    stem = source_file.split(".")[0]
    end = at(run_time, T.TimestampType())
    yesterday = at(run_time - timedelta(days=1), T.TimestampType())
    start: Column = yesterday
    if last_seen is not None:
        old = old.join(last_seen.select("symbol", "last_date"), "symbol", "left")
        start = F.coalesce(F.col("last_date").cast("timestamp") + F.expr("INTERVAL 1 DAY"), yesterday)
    until: Column = end
    if gaps is not None:
        old = old.join(gaps.select(F.col("ticker").alias("symbol"), "start_date",
                                   F.col("end_date").alias("gap_end")), "symbol", "left")
        start = F.coalesce(F.col("start_date").cast("timestamp"), start)
        until = F.coalesce(F.col("gap_end").cast("timestamp"), end)
    daily = old.select(
        "symbol", F.lit(DAILY).alias("mode"),
        start.alias("start_date"), until.alias("end_date"),
        F.lit(None).cast("long").alias("batch"),
        F.lit(f"{stem}-daily.csv").alias("output_key"),
    )
    batch = (F.floor(F.col("position") / batch_size) * batch_size).cast("long")
    historical = number_rows(new.select("symbol"), "symbol").select(
        "symbol", F.lit(HISTORICAL).alias("mode"),
        at(HISTORY_START, T.TimestampType()).alias("start_date"), end.alias("end_date"),
        batch.alias("batch"),
        F.concat(F.lit(f"{stem}-historical-batch-"), batch.cast("string"), F.lit(".csv"))
        .alias("output_key"),
    )
    return daily.unionByName(historical)
