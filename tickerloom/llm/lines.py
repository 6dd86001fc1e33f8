"""Line dedup by site-relative frequency.

A line is boilerplate of its host if the pages of the host that have it are more
than `ratio` of all pages of the host, and at least `least_pages` of them. Pages are
the distinct texts of a host: a page fetched many times is one page, so copies of a
document do not make its own lines boilerplate. Lines are compared trimmed; blank
lines are never boilerplate.

Lines travel as two 64-bit hashes, counted per task before the shuffle; texts are not
shuffled by line. The lines to drop of a host come back to its pages as one list:
they are few, because lines above the ratio fill at most 1 / ratio mean pages. If all
lists together are small, counted first, they go to every task; if there are more, a
join by host takes them, which adaptive execution splits for large hosts.

Defined results: a null host is a host of its own. Null and empty texts have no
lines and stay as they are; a page all of whose lines are dropped stays with an
empty text. Rows with the same doc_id each keep their own text. Order, line breaks
between kept lines and all other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import saved

#: Most dropped lines (two longs each) that are sent to every task.
BROADCAST_LINES = 100_000


def _key(text: Column) -> Column:
    """128 bits of a text in two longs."""
    return F.struct(F.xxhash64(text).alias("h1"),
                    F.xxhash64(F.lit("second"), text).alias("h2"))


def _trimmed(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, r"[\r\t]", " "))


def page_lines(docs: DataFrame, host: str, text: str) -> DataFrame:
    """(host, page, line): every distinct filled line of every distinct page, hashed."""
    pages = docs.where(F.length(text) > 0).select(
        F.col(host).alias("_host"), _key(F.col(text)).alias("_page"), F.array_distinct(
            F.transform(F.filter(F.transform(F.split(text, "\n"), _trimmed),
                                 lambda x: F.length(x) > 0), _key)).alias("_lines"))
    return pages.select("_host", "_page", F.explode("_lines").alias("_line")).distinct()


def boilerplate(docs: DataFrame, ratio: float = 0.1, least_pages: int = 5,
                host: str = "source", text: str = "text") -> DataFrame:
    """(_host, _line, pages, host_pages) of the lines above the ratio."""
    pages = docs.where(F.length(text) > 0).select(
        F.col(host).alias("_host"), _key(F.col(text)).alias("_page")).distinct()
    totals = pages.groupBy(F.col("_host").alias("_of")).agg(F.count("*").alias("host_pages"))
    counts = page_lines(docs, host, text).groupBy("_host", "_line").agg(
        F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    return (counts.join(totals, F.col("_host").eqNullSafe(F.col("_of"))).drop("_of")
            .where(F.col("pages") > ratio * F.col("host_pages")))


def drop_boilerplate(docs: DataFrame, ratio: float = 0.1, least_pages: int = 5,
                     host: str = "source", text: str = "text") -> DataFrame:
    """`docs` with `text` less its boilerplate lines, and n_lines and n_dropped beside it
    (named `_n_lines` and `_n_dropped` to leave the table's own columns alone).

    The sum of the lines' shares is the mean number of lines of a page, so at most
    (lines per page) / ratio lines of a host can exceed the ratio.
    """
    dropped = saved(boilerplate(docs, ratio, least_pages, host, text), "boilerplate")
    lists = dropped.groupBy(F.col("_host").alias("_of")).agg(
        F.collect_list("_line").alias("_drop")).withColumn("_known", F.lit(True))
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    kept = F.filter("_lines", lambda x: ~F.array_contains("_drop", _key(_trimmed(x))))
    joined = (docs.withColumn("_lines", lines)
              .join(F.broadcast(lists) if dropped.count() <= BROADCAST_LINES else lists,
                    F.col(host).eqNullSafe(F.col("_of")), "left").drop("_of"))
    cleaned = joined.withColumn("_kept", F.when(F.col("_known"), kept).otherwise(F.col("_lines")))
    return cleaned.select(
        *[F.col(c) for c in docs.columns if c != text],
        F.when(F.size("_kept") < F.size("_lines"), F.array_join("_kept", "\n"))
        .otherwise(F.col(text)).alias(text),
        F.when(F.length(text) > 0, F.size("_lines")).otherwise(0).cast("long").alias("_n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("_n_dropped"),
    )
