"""From raw tape rows to one row per ticker and date."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.timeline import since


def dedupe_tape(tape: DataFrame, keep_rank: bool = False) -> DataFrame:
    """Keep one row per (ticker, date): lowest `source_rank`, then smallest values.
    With `keep_rank` the survivor brings its rank, to be compared with later deliveries.

    The order is total over the kept columns, so the survivor does not depend on
    how rows arrive. It is an aggregate, not a window: copies shrink to one per
    task before the shuffle, however many a single (ticker, date) has.
    """
    values = ["adj_close", "dividends"]
    ranked = (["source_rank"] if "source_rank" in tape.columns else []) + values
    order = []
    for name in ranked:
        order += [F.col(name).isNull().alias(f"no_{name}"), F.col(name)]
    # Struct buffers make this a sort aggregate. The hash leads the sort keys, so most
    # comparisons end at the eight bytes kept beside the row pointer.
    slot = F.xxhash64("ticker", "date").alias("_slot")
    # Spark computes the repeated aggregate once. Without a computation on top of it,
    # joins that filter tickers move below the shuffle.
    survivor = F.min(F.struct(*order))
    return (
        tape.groupBy(slot, "ticker", "date")
        .agg(*[survivor[v].alias(v) for v in (ranked if keep_rank else values)])
        .drop("_slot")
    )


def with_calendar(tape: DataFrame) -> DataFrame:
    return tape.withColumns({"year": F.year("date"), "month": F.month("date")})


def clean_tape(tape: DataFrame) -> DataFrame:
    """Typed, deduplicated tape with its calendar columns.

    Text dates are cast before the duplicates are looked for, so two spellings of
    one date count as copies. A text that begins with no whole date and a value that
    is not finite become null.
    """
    typed = tape.withColumns({n: _finite(n) for n in ("adj_close", "dividends")})
    if not tape.schema["date"].dataType.typeName().startswith(("timestamp", "date")):
        whole = F.col("date").rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}")
        typed = typed.withColumn("date", F.when(whole, F.col("date").try_cast("timestamp")))
    return with_calendar(dedupe_tape(typed))


def _finite(name: str) -> Column:
    value = F.col(name).try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def company_rows(tape: DataFrame, benchmarks: list[str]) -> DataFrame:
    """Rows of companies: benchmarks and null tickers drop out."""
    return tape.filter(~F.col("ticker").isin(benchmarks))


def instrument_rows(tape: DataFrame, ticker: str) -> DataFrame:
    """Rows of one instrument, such as the index."""
    return tape.filter(F.col("ticker") == ticker)


def recent_rows(tape: DataFrame, as_of: datetime, days: int) -> DataFrame:
    return tape.filter(since(tape, as_of, days))
