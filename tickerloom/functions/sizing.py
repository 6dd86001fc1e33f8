"""Broadcast behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a few fixed-width columns: tens of megabytes at most.
BROADCAST_ROWS = 500_000


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether `df` has at most `max_rows` rows; each task sends on a count alone."""
    return df.count() <= max_rows


def broadcast_if_fits(df: DataFrame, probe: DataFrame | None = None,
                      max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the row count allows it.

    `probe` is a cheaper frame with at least as many rows as `df`. Beyond the
    limit the frame comes back unhinted and the join shuffles both sides.
    """
    return F.broadcast(df) if fits(df if probe is None else probe, max_rows) else df
