"""Documents through quality, line dedup, near-dedup, decontamination and mixing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept;
`run` writes each result as Parquet in the shared folder and reads it again for the
next. All stages but the last return the columns they were given, and of those only
doc_id, text and source are read, so other columns may have any name but that a
column named like one the last stage adds is replaced by it. Rows with a null doc_id
do not pass the first stage; rows with the same doc_id leave the third as one row, that
whose text was compared.
An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import decontaminate, lines, mixing, neardup, quality
from tickerloom.llm.common import saved, table
from tickerloom.llm.queries import ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
ADDED = ("size", "source_size", "target", "taken")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    ship(spark)
    good = quality.classify(docs, table(spark, sf_dir, "labels")).where("predicted = 1")
    return docs.join(good.select("doc_id"), "doc_id", "left_semi").select(docs.columns)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that are boilerplate of their source; none goes whole."""
    return lines.drop_boilerplate(docs).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least doc_id, of each group of near-duplicates."""
    ship(spark)
    kept = neardup.near_duplicates(docs).where("kept").select("doc_id")
    several = saved(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1"),
                    "repeated-ids")
    chosen = docs.join(kept, "doc_id", "left_semi").select(docs.columns)
    if several.limit(1).count():
        # of a repeated id the row whose text was compared; equal texts by source
        again = chosen.join(several, "doc_id", "left_semi")
        texts = saved(neardup.compared_texts(again).select(
            F.col("doc_id").alias("own_id"), F.col("text").alias("own_text")), "compared-texts")
        same = (F.col("doc_id") == F.col("own_id")) & F.col("text").eqNullSafe(F.col("own_text"))
        row = F.min_by(F.struct(*docs.columns), F.struct("source", "text")).alias("row")
        one = again.join(texts, same).groupBy("own_id").agg(row).select("row.*")
        chosen = chosen.join(several, "doc_id", "left_anti").select(docs.columns).union(one)
    return chosen


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    ship(spark)
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(saved(found.select("doc_id").distinct(), "contaminated"),
                     "doc_id", "left_anti").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes words from, with size, source_size, target and taken."""
    taken = mixing.mix(docs).where("taken > 0").select("doc_id", *ADDED)
    return docs.drop(*ADDED).join(taken, "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("line_dedup", without_boilerplate),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmarks),
    ("mixing", mixed),
]

#: Trained weights and whole-text hashing are beyond SQL; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
