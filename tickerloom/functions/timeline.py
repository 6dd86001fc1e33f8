"""Time literals, windows that end at `as_of`, and the previous row in time."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def at(moment: datetime, dtype: T.DataType) -> Column:
    """`moment` as a literal of `dtype`.

    The literal takes the column's own type, so that a comparison needs no cast
    on the column and the filter can reach the file scan.
    """
    return F.lit(moment.isoformat(sep=" ")).cast(dtype)


def since(df: DataFrame, as_of: datetime, days: int, column: str = "date") -> Column:
    """Condition: the row is at most `days` days older than `as_of`, and not later."""
    start = as_of - timedelta(days=days)
    recent = (F.col(column) >= at(start, df.schema[column].dataType)) & until(df, as_of, column)
    if column == "date" and "year" in df.columns:
        recent = recent & (F.col("year") >= start.year)  # prunes `year` folders
    return recent


def until(df: DataFrame, as_of: datetime, column: str = "date") -> Column:
    """Condition: the row is not later than `as_of`."""
    known = F.col(column) <= at(as_of, df.schema[column].dataType)
    if column == "date" and "year" in df.columns:
        known = known & (F.col("year") <= as_of.year)
    return known


def normalise_utc(column: Column, source_zone: str = "UTC") -> Column:
    """Wall-clock time of `source_zone` as UTC."""
    return F.to_utc_timestamp(column, source_zone).cast("timestamp")


def with_previous(
    rows: DataFrame,
    key: str,
    order: str,
    values: list[str],
    grain: str = "month",
) -> DataFrame:
    """Add `previous_<value>`: the value of the key's preceding row in time.

    `order` must be unique within `key`. One key may hold much of the table, so its
    rows are split by `grain`: each piece looks back within itself, and the first row
    of a piece takes the last value of the key's piece before. Only one row per piece
    meets in a window per key.
    """
    # Rows without key or time have no place in the order. Stated up front: inferred
    # on one side of the join only, the same filter would keep its two sides from
    # sharing their exchange.
    rows = rows.filter(F.col(key).isNotNull() & F.col(order).isNotNull())
    # One exchange on (key, piece) serves the look-back, the edges and the join.
    pieces = rows.withColumn("_piece", F.date_trunc(grain, order)).repartition(key, "_piece")

    edge_values = {f"_edge_{v}": F.max_by(v, order) for v in values}
    by_piece = Window.partitionBy(key).orderBy("_piece")
    edges = (
        pieces.groupBy(key, "_piece")
        .agg(*[value.alias(name) for name, value in edge_values.items()])
        .select(key, "_piece", *[F.lag(name).over(by_piece).alias(name) for name in edge_values])
    )

    in_piece = Window.partitionBy(key, "_piece").orderBy(order)
    looked_back = pieces.withColumns(
        {"_position": F.row_number().over(in_piece)}
        | {f"previous_{v}": F.lag(v).over(in_piece) for v in values}
    )
    previous = {
        f"previous_{v}": F.when(F.col("_position") == 1, F.col(f"_edge_{v}"))
        .otherwise(F.col(f"previous_{v}"))
        for v in values
    }
    return (
        looked_back.join(edges, [key, "_piece"], "left")
        .withColumns(previous)
        .drop("_piece", "_position", *edge_values)
    )
