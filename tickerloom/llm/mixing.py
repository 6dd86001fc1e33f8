"""Mixing sources to target weights with Sainte-Laguë quotas of equal-token blocks.

A document's size is its number of words. Sources share the total size by weight;
no target exceeds `most_repeats` times its source's size, and what is cut off is
shared again by weight until none is above. Tokens are dealt in blocks of one size:

1. The blocks go to sources by highest quotients target / (2k + 1).
2. A source's blocks go to its shards by highest quotients of the shard's share. A
   shard is a hash range of documents; there are more shards for more words, so a
   source with a third of all rows is spread like any other.
3. A shard lays its documents in seeded order and takes its quota of blocks from
   there, going round again if the quota is larger than the shard.

Quotients are never listed one by one. Rounding target / d for the divisor d = total
/ blocks gives all but a few blocks right (their number is at most the number of
claimants), and only the quotients next to the rounded ones are ranked to settle the
rest. All steps are DataFrame operations; windows run over sources, shards of one
source, and documents of one shard.

Defined results: null or empty texts have size 0 and take nothing. The null source is
a source of its own and comes last. Rows with the same doc_id and text are rows of
their own; order among equal ids does not matter for what is taken in all, and ties
of the seeded hash are settled by doc_id. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import saved

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
SHARD_WORDS = 500_000
LEAST_SHARDS = 64
BLOCK_WORDS = 8


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded(seed: str, key: Column) -> Column:
    """A hash of the key, the same in every engine that has md5."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(key.cast("string"), F.lit("null")))
                 .cast("binary"))


def source_targets(sizes: DataFrame, most_repeats: int = 3) -> DataFrame:
    """source, source_size, target of a table (source, source_size).

    Sources ordered by how soon their cap binds, the level of the first k being
    capped is (total - caps so far) / (weights to come); the highest level whose
    predecessors are all below it holds for the rest.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weighed = (sizes.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
               .withColumn("cap", F.col("source_size") * most_repeats)
               .withColumn("binds", F.col("cap") / F.col("weight")))
    every = Window.orderBy("binds", F.col("source").isNull(), F.col("source").cast("binary"))
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    levelled = (
        weighed.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                    / (F.sum("weight").over(whole)
                       - F.coalesce(F.sum("weight").over(before), F.lit(0))))
        .withColumn("free", F.col("level") <= F.col("binds")))
    level = F.min(F.when(F.col("free"), F.struct("binds", "level"))).over(whole)["level"]
    return levelled.withColumn("settled", level).select(
        "source", "source_size", F.row_number().over(by_name).alias("source_number"),
        F.coalesce(F.least(F.col("cap").cast("double"), F.col("settled") * F.col("weight")),
                   F.lit(0.0)).alias("target"))


def apportion(claims: DataFrame, group: list[str], votes: str, seats: str,
              order: str) -> DataFrame:
    """`claims` with `quota`: `seats` (equal within a group) dealt by Sainte-Laguë.
    Of equal quotients that with the smaller number `order` comes first."""
    whole = Window.partitionBy(*group)
    rounded = (
        claims.withColumn("_votes", F.sum(votes).over(whole))
        .withColumn("_even", F.when(F.col("_votes") > 0,
                                    F.col(votes) * F.col(seats) / F.col("_votes"))
                    .otherwise(F.lit(0.0)))
        .withColumn("_quota", F.floor(F.col("_even") + 0.5))
        .withColumn("_left", F.col(seats) - F.sum("_quota").over(whole))
        .withColumn("_claimants", F.count(F.lit(1)).over(whole)))
    reach = (F.ceil(F.col("_even") * (F.abs("_left") + F.col("_claimants"))
                    / F.greatest(F.col(seats), F.lit(1))) + 2).cast("int")
    steps = F.when((F.col("_left") != 0) & (F.col(votes) > 0), F.sequence(F.lit(1), reach)
                   ).otherwise(F.array().cast("array<int>"))
    seat = F.when(F.col("_left") > 0, F.col("_quota") + F.col("_step")
                  ).otherwise(F.col("_quota") - F.col("_step") + 1)
    ranked = (
        rounded.withColumn("_step", F.explode_outer(steps))
        .withColumn("_seat", seat)
        .withColumn("_quotient", F.when(F.col("_seat") > 0,
                                        F.col(votes) / (2 * F.col("_seat") - 1))))
    best = Window.partitionBy(*group).orderBy(
        F.col("_quotient").isNull(),
        F.when(F.col("_left") > 0, -F.col("_quotient")).otherwise(F.col("_quotient")),
        F.when(F.col("_left") > 0, F.col(order)).otherwise(-F.col(order)))
    moved = F.when(F.col("_quotient").isNotNull()
                   & (F.row_number().over(best) <= F.abs("_left")), F.signum("_left"))
    return (ranked.withColumn("_moved", F.coalesce(moved, F.lit(0.0)))
            .groupBy(*claims.columns, "_quota")
            .agg((F.first("_quota") + F.sum("_moved")).cast("long").alias("quota"))
            .drop("_quota"))


def mix(docs: DataFrame, seed: str = "mix", most_repeats: int = 3,
        block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source, source_size, target, taken for every row of `docs`."""
    sized = saved(docs.select("doc_id", "source", words_in(F.col("text")).alias("size"))
                  .withColumn("_order", seeded(seed, F.col("doc_id"))), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = saved(source_targets(sizes, most_repeats), "mix-targets")
    facts = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("total")).first()
    total = facts["total"]
    shards = max(LEAST_SHARDS, -(-total // SHARD_WORDS))
    block = max(1, min(block_words, total // 65_536))
    quotas = (apportion(targets.withColumns({"_one": F.lit(1), "_seats": F.lit(total // block)}),
                        ["_one"], "target", "_seats", "source_number")
              .select("source", "source_size", "target", F.col("quota").alias("source_quota")))
    shard = (F.conv(F.substring("_order", 1, 8), 16, 10).cast("long") % shards).alias("shard")
    dealt = sized.select("*", shard)
    cells = (dealt.groupBy("source", "shard").agg(F.sum("size").alias("cell_size"))
             .join(quotas.withColumnRenamed("source", "_source"),
                   F.col("source").eqNullSafe(F.col("_source"))).drop("_source"))
    cells = apportion(cells, ["source"], "cell_size", "source_quota", "shard")
    cells = saved(cells.select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "source_size", "target",
        "cell_size", F.least(F.col("quota") * block, F.col("cell_size") * most_repeats
                             ).alias("words")), "mix-cells")
    seen = (Window.partitionBy("source", "shard")
            .orderBy("_order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1))
    whole = F.when(F.col("cell_size") > 0, F.floor(F.col("words") / F.col("cell_size"))
                   ).otherwise(F.lit(0))
    rest = F.col("words") - F.col("_rounds") * F.col("cell_size")
    return (dealt.join(cells, F.col("source").eqNullSafe(F.col("_source"))
                       & (F.col("shard") == F.col("_shard")))
            .withColumn("_rounds", whole)
            .withColumn("_before", F.coalesce(F.sum("size").over(seen), F.lit(0)))
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("_rounds") * F.col("size")
                     + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before"))))
                    .cast("long").alias("taken")))
