"""Drop re-delivered rows from a tape stream."""

from __future__ import annotations

from pyspark.sql import DataFrame


def drop_redelivered(tape: DataFrame, delay: str) -> DataFrame:
    """First delivery of each (ticker, date), remembered for `delay` of event time.

    State holds the keys of that span only. Copies inside one micro-batch meet in one
    task, so `files_per_batch` of the source bounds them. Rows older than the watermark are
    dropped, so long histories belong in a batch load, not in this stream. Bad
    dates have to be routed away first: a null date has no event time.
    """
    return tape.withWatermark("date", delay).dropDuplicatesWithinWatermark(["ticker", "date"])
