"""Positions of rows within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import saved


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`rows` with `position`, counted from 0 within `group` by `order`, and `members`.

    `rows` should be a stored table, for it is read twice. It is dealt out by ranges of
    (group, order), so a group with much of the table lies in many tasks, in order; each
    counts its own rows and starts where the tasks before it end. Equal rows are told
    apart by their place in the table alone. `group` has no nulls.
    """
    told = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = saved(told.repartitionByRange(group, *order, "_tie")
                  .withColumn("_part", F.spark_partition_id()), "ranges")
    # A group has at most one row here for each task of the range exchange.
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy(group, "_part").agg(F.count("*").alias("_n"))
              .withColumns({"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)),
                            "members": F.sum("_n").over(Window.partitionBy(group))})
              .drop("_n"))
    within = Window.partitionBy(group, "_part").orderBy(*order, "_tie")
    return (dealt.withColumn("_within", F.row_number().over(within) - 1)
            .join(starts, [group, "_part"])
            .withColumn("position", F.col("_before") + F.col("_within"))
            .drop("_tie", "_part", "_before", "_within"))
