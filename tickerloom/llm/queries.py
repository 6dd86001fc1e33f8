"""Registered queries of the corpus operators: each over its whole table."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import (
    centroids,
    decontaminate,
    extraction,
    lines,
    manifest,
    mixing,
    neardup,
    neighbours,
    packing,
    quality,
    suffixes,
    toxicity,
    twins,
    urls,
)
from tickerloom.llm.common import table

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        made = shutil.make_archive(
            str(Path(tempfile.mkdtemp(prefix="tickerloom-package-")) / "tickerloom_package"),
            "zip", root, "tickerloom")
        context.addPyFile(made)
        _shipped.add(context.applicationId)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op4_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_pages(table(spark, sf_dir, "pages"))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.remove_repeats(table(spark, sf_dir, "documents")))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("centroid")


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.proofs(table(spark, sf_dir, "documents"), manifest.lower_case_fifth())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)
        return run

    found = [op1_toxicity, op2_decontamination, op3_mixing, op4_extraction, op5_lines,
             op6_quality, op7_minhash, op8_urls, op9_suffixes,
             op10_neighbours, op11_packing, op12_centroids, op13_manifest]
    return {q.__name__: shipped(q) for q in found}


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": twins.OP3_MIXING, "op5_lines": twins.OP5_LINES,
            "op12_centroids": twins.op12_centroids(), "op13_manifest": twins.op13_manifest()}
