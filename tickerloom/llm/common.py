"""Small pieces that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.sources.workspace import materialise, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """`df` as a table in the shared folder: computed once, kept if executors go."""
    return materialise(df, shared_folder(df.sparkSession, label))


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo `divisor`."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor


def rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[Any, ...]]:
    """Rows of Arrow batches as tuples, a thousand at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)


def label_sample(labels: DataFrame, target: str, divisor: int, kept_out: int,
                 at_most: int) -> DataFrame:
    """doc_id and 0/1 label of rows a model may learn from.

    Rows whose remainder is `kept_out` are never in it; rows with null id or label
    are not either, and a doc_id labelled twice counts once with its larger label.
    Beyond `at_most` rows it is the share of about that many with the smallest hash.
    """
    known = (labels.select(F.col("doc_id"), F.col(target).cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull()
                    & (remainder("doc_id", divisor) != kept_out))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    found = known.count()
    if found <= at_most:
        return known
    share = int(2**32 * at_most / found)
    return known.where(F.crc32(F.concat(F.lit("sample-"), F.col("doc_id").cast("string"))
                               .cast("binary")) < share)
