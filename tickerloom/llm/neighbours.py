"""Approximate nearest neighbours: NN-descent graph, greedy graph search.

Building. Vectors start with neighbours found along a few random lines: sorted by the
projection, each window of the order is a group whose members become candidates of
each other. Every edge found is new until a round takes it up. A round takes up to
`sample` new edges of each vector, at random. Around every vector meet the ends of its
edges in both directions, and only pairs with an end taken up this round are compared:
two old ends have met before. Each member keeps the closest `each` it met, does not
hold and has a use for; the lists are merged and cut to the best `degree`. Groups
without a new edge are left out, so rounds shrink as the graph settles; they end when
no more than a share of `delta` of all edges is new. Rounds are Spark joins and
groupings over tables in the shared folder; a group is bounded by
2 * `sample` + 2 * `degree` + 1 members.

Searching. Queries walk the graph together: each holds its best `beam` vectors found
so far, and a round visits the neighbours, in both directions, of those not yet
visited, up to `width` a round; distances are taken to the full vectors. It ends when
no query has anything left to visit. A query that is indexed starts from its own
place, others from any entry points the caller names. A walk may hold 320 vectors, for
evenly spread vectors have no short way to their neighbours; `beam` trades recall
against work.

Equal vectors are one vertex with its smallest ids beside it, so a vector shared by a
third of all rows is one vertex like any other, and ties go to smaller ids.

Defined results: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part, nor do rows with a null id. Rows with the
same id count once with the least of their vectors. An empty table, or a single
vector, gives no rows; fewer candidates than asked for are all returned when the graph
reaches them, which it does up to `degree` vectors by construction. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.llm.common import saved

EDGES = "a long, b long, distance double"
WINDOW_ROWS = 64


def usable(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, vector) of rows that take part, one per id. Vectors of floats stay so; all
    other numbers are taken as doubles."""
    element = vectors.schema[column].dataType.elementType
    kind = "float" if isinstance(element, T.FloatType) else "double"
    vector = F.col(column).cast(f"array<{kind}>")
    whole = (F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf")).cast(kind)))
             & F.exists("vector", lambda x: x != 0))
    found = (vectors.select(F.col(key).cast("long").alias("id"), vector.alias("vector"))
             .where(F.col("id").isNotNull() & F.col("vector").isNotNull())
             .where(F.coalesce(whole, F.lit(False))))
    usual = F.mode(F.size("vector"), True)
    size = found.agg(usual.alias("n")).first()["n"]
    # -0.0 and 0.0 are one component
    even = F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0).cast(kind)).otherwise(x))
    return (found.where(F.size("vector") == (size or 0)).withColumn("vector", even)
            .groupBy("id").agg(F.min("vector").alias("vector")))


def vertices(points: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (id, vector) under their smallest id, and the members
    (id, member): the `most` smallest ids of each. Ranks are first taken within
    random shares of a vector's rows, so no task sees all copies."""
    keyed = points.withColumn("h", F.struct(F.xxhash64("vector").alias("x"), F.xxhash64(
        F.lit(1), F.col("vector")).alias("y")))
    shares = Window.partitionBy("h", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    few = (keyed.select("h", "id").withColumn("rank", F.row_number().over(shares))
           .where(F.col("rank") <= most).drop("rank"))
    ranked = saved(few.withColumn("rank", F.row_number().over(
        Window.partitionBy("h").orderBy("id"))).where(F.col("rank") <= most), "vector-members")
    firsts = ranked.where("rank = 1").select("h", F.col("id").alias("vertex"))
    members = ranked.join(firsts, "h").select(
        F.col("vertex").alias("id"), F.col("id").alias("member"))
    distinct = points.join(firsts.select(F.col("vertex").alias("id")), "id", "left_semi")
    return saved(distinct, "vertices"), saved(members, "members")


def _closest(edges: DataFrame, degree: int) -> DataFrame:
    """The `degree` closest distinct b of each a."""
    best = Window.partitionBy("a").orderBy("distance", "b")
    return (edges.where("a <> b").groupBy("a", "b")
            .agg(F.min("distance").alias("distance"), F.min("fresh").alias("fresh"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= degree))


def _group_edges(each: int):
    """Within every group of a task: each member's `each` closest others that it does
    not hold, if closer than the worst neighbour it has. Of a pair one end is new."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_group, held_ids, held, held_worst, held_known, held_new = None, [], [], [], [], []
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def close() -> None:
            ids, x = np.array(held_ids, dtype=np.int64), np.stack(held).astype(float)
            n = len(ids)
            if n < 2:
                return
            squares = (x * x).sum(axis=1)
            d = np.maximum(squares[:, None] + squares[None, :] - 2 * x @ x.T, 0)
            np.fill_diagonal(d, np.inf)
            old = ~np.array(held_new)
            d[np.ix_(old, old)] = np.inf
            known = np.concatenate(held_known)
            if len(known):
                owner = np.repeat(np.arange(n), [len(x) for x in held_known])
                place = np.argsort(ids)
                at = place[np.minimum(np.searchsorted(ids, known, sorter=place), n - 1)]
                here = ids[at] == known
                d[owner[here], at[here]] = np.inf
            k = min(each, n - 1)
            near = np.argpartition(d, k - 1, axis=1)[:, :k]
            found = np.sqrt(np.take_along_axis(d, near, axis=1))
            use = found < np.array(held_worst)[:, None]
            out.append((np.repeat(ids, k)[use.ravel()], ids[near][use], found[use]))

        def batch_of() -> pa.RecordBatch:
            a, b, d = (np.concatenate(c) for c in zip(*out, strict=True))
            out.clear()
            return pa.record_batch({"a": pa.array(a), "b": pa.array(b), "distance": pa.array(d)})

        for batch in batches:
            if not batch.num_rows:
                continue
            groups, ids, worst = (np.asarray(batch.column(c)) for c in ("group", "id", "worst"))
            new = batch.column("new").to_numpy(zero_copy_only=False)
            column = batch.column("vector")
            flat = np.asarray(column.flatten()).reshape(batch.num_rows, -1)
            lists = batch.column("known")
            ends = np.cumsum(np.asarray(lists.value_lengths()))[:-1]
            knowns = np.split(np.asarray(lists.flatten()), ends)
            for group, key, vector, limit, known, fresh in zip(
                    groups, ids, flat, worst, knowns, new, strict=True):
                if group != held_group and held:
                    close()
                    held_ids, held, held_worst, held_known, held_new = [], [], [], [], []
                held_group = group
                held_ids.append(key)
                held.append(vector)
                held_worst.append(limit)
                held_known.append(known)
                held_new.append(fresh)
            if sum(len(o[0]) for o in out) > 200_000:
                yield batch_of()
        if held:
            close()
        if out:
            yield batch_of()

    return edges


def _grouped(groups: DataFrame, each: int) -> DataFrame:
    """Edges of all groups of (group, id, vector, worst, known, new); a group's rows lie
    together."""
    return (groups.repartition(F.col("group")).sortWithinPartitions("group", "id")
            .select("group", "id", "vector", "worst", "known", "new")
            .mapInArrow(_group_edges(each), EDGES))


def line_groups(points: DataFrame, lines: int, seed: int) -> DataFrame:
    """(group, id): along each random line, windows of neighbours by projection.

    The order is cut at quantiles, so windows hold about WINDOW_ROWS rows and no task
    sorts all of them."""
    total = points.count()
    cuts = max(1, total // WINDOW_ROWS)
    size = points.select(F.size("vector").alias("n")).limit(1).collect()[0]["n"]
    directions = np.random.Generator(np.random.PCG64(seed)).normal(size=(lines, size))

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = np.asarray(batch.column("vector").flatten()).reshape(batch.num_rows, -1)
            values = flat.astype(float) @ directions.T
            ids = np.asarray(batch.column("id"))
            yield pa.record_batch({
                "id": pa.array(np.repeat(ids, lines)),
                "line": pa.array(np.tile(np.arange(lines), len(ids)).astype(np.int32)),
                "value": pa.array(values.ravel())})

    along = saved(points.select("id", "vector").mapInArrow(
        projected, "id long, line int, value double"), "projections")
    # coarse stretches by quantiles, then row numbers within a stretch
    stretches = max(1, min(cuts, 1000))
    shares = [i / stretches for i in range(1, stretches)]
    bounds = along.groupBy("line").agg(
        (F.percentile_approx("value", shares, 10_000) if shares
         else F.array().cast("array<double>")).alias("bounds"))
    placed = along.join(F.broadcast(bounds), "line").withColumn(
        "stretch", F.size(F.filter("bounds", lambda b: b < F.col("value"))))
    order = Window.partitionBy("line", "stretch").orderBy("value", "id")
    window = F.floor((F.row_number().over(order) - 1) / WINDOW_ROWS)
    return placed.select(F.xxhash64("line", "stretch", window).alias("group"), "id")


def _taken_up(graph: DataFrame, sample: int, step: int) -> DataFrame:
    """The graph with `taken`: up to `sample` new edges of each a, at random."""
    some = Window.partitionBy("a").orderBy(~F.col("fresh"), F.xxhash64("a", "b", F.lit(step)))
    return (graph.withColumn("rank", F.row_number().over(some))
            .withColumn("taken", F.col("fresh") & (F.col("rank") <= sample)).drop("rank"))


def _backward(edges: DataFrame, most: int, step: int) -> DataFrame:
    """(group, id): up to `most` of the vectors that name `group`, at random. They are
    first thinned in shares, so no task sees all that name one vector."""
    order = F.xxhash64("a", "b", F.lit(step))
    shares = Window.partitionBy("b", F.pmod(F.xxhash64("a"), F.lit(32))).orderBy(order)
    few = (edges.withColumn("rank", F.row_number().over(shares))
           .where(F.col("rank") <= most))
    return (few.withColumn("rank", F.row_number().over(Window.partitionBy("b").orderBy(order)))
            .where(F.col("rank") <= most)
            .select(F.col("b").alias("group"), F.col("a").alias("id")))


def meetings(taken: DataFrame, degree: int, sample: int, step: int) -> DataFrame:
    """(group, id, new): who meets around every vector that has an edge taken up."""
    old, fresh = taken.where("not fresh"), taken.where("taken")
    forward = taken.where("taken or not fresh").select(
        F.col("a").alias("group"), F.col("b").alias("id"), F.col("taken").alias("new"))
    ends = (forward
            .union(_backward(fresh, sample, step).withColumn("new", F.lit(True)))
            .union(_backward(old, degree, step).withColumn("new", F.lit(False))))
    around = ends.groupBy("group").agg(
        F.collect_set(F.when(F.col("new"), F.col("id"))).alias("taken"),
        F.collect_set(F.when(~F.col("new"), F.col("id"))).alias("held")).where("size(taken) > 0")
    # the vector itself is an old end: those that were just found hear of it
    rest = F.array_except(F.array_union("held", F.array("group")), "taken")
    members = F.concat(
        F.transform("taken", lambda x: F.struct(x.alias("id"), F.lit(True).alias("new"))),
        F.transform(rest, lambda x: F.struct(x.alias("id"), F.lit(False).alias("new"))))
    return around.select("group", F.explode(members).alias("m")).select("group", "m.*")


def build_graph(points: DataFrame, degree: int = 24, rounds: int = 1, lines: int = 6,
                each: int = 12, seed: int = 11, delta: float = 0.001,
                sample: int = 12) -> DataFrame:
    """(a, b, distance): up to `degree` near vectors of every vector, after `rounds`
    rounds at least and until no more than a share of `delta` of the edges is new."""
    fresh = F.lit(True).alias("fresh")
    start = line_groups(points, lines, seed).join(points, "id").withColumns({
        "worst": F.lit(float("inf")), "known": F.array().cast("array<long>"),
        "new": F.lit(True)})
    graph = saved(_closest(_grouped(start, degree).select("*", fresh), degree), "graph")
    for step in count():
        edges = graph.agg(F.count("*").alias("all"), F.count_if("fresh").alias("new")).first()
        if not edges["new"] or (step >= rounds and edges["new"] <= delta * edges["all"]):
            return graph.select("a", "b", "distance")
        taken = saved(_taken_up(graph, sample, step), "taken")
        worst = taken.groupBy(F.col("a").alias("id")).agg(
            F.when(F.count("*") >= degree, F.max("distance")).alias("worst"),
            F.collect_list("b").alias("known"))
        limited = points.join(worst, "id", "left").select(
            "id", "vector", F.coalesce("worst", F.lit(float("inf"))).alias("worst"),
            F.coalesce("known", F.array().cast("array<long>")).alias("known"))
        groups = meetings(taken, degree, sample, step).join(limited, "id")
        found = _grouped(groups, each).select("*", fresh)
        held = taken.select("a", "b", "distance", (F.col("fresh") & ~F.col("taken")).alias("fresh"))
        graph = saved(_closest(held.union(found), degree), "graph")


def _distance(x: str, y: str) -> Column:
    squares = F.zip_with(x, y, lambda p, q: (p.cast("double") - q.cast("double"))
                         * (p.cast("double") - q.cast("double")))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, v: s + v))


def search(points: DataFrame, graph: DataFrame, queries: DataFrame, beam: int = 320,
           width: int = 100, both_ways: int = 40) -> DataFrame:
    """(query, id, distance): the best `beam` vertices found for each query.

    `queries` are (query, start, vector): where the walk of a query begins. Edges are
    followed in both directions, at most the `both_ways` shortest of a vertex.
    """
    around = Window.partitionBy("a").orderBy("distance", "b")
    paths = saved(
        graph.union(graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance"))
        .groupBy("a", "b").agg(F.min("distance").alias("distance"))
        .withColumn("rank", F.row_number().over(around)).where(F.col("rank") <= both_ways)
        .groupBy("a").agg(F.collect_list("b").alias("next")), "paths")
    vectors = points.select("id", F.col("vector").alias("other"))
    asked = saved(queries.select("query", "vector").dropDuplicates(["query"]), "queries")
    begun = (queries.select("query", F.col("start").alias("id")).distinct()
             .join(vectors, "id").join(asked, "query")
             .select("query", "id", _distance("vector", "other").alias("distance"),
                     F.lit(False).alias("visited")))
    state = saved(begun, "walk")
    best = Window.partitionBy("query").orderBy("distance", "id")
    while True:
        open_ones = (state.where("not visited")
                     .withColumn("rank", F.row_number().over(best))
                     .where(F.col("rank") <= width).select("query", "id"))
        if not open_ones.limit(1).count():
            return state.select("query", "id", "distance")
        met = (open_ones.join(paths.withColumnRenamed("a", "id"), "id")
               .select("query", F.explode("next").alias("id")).distinct()
               .join(state.select("query", "id"), ["query", "id"], "left_anti"))
        seen = (met.join(vectors, "id").join(asked, "query")
                .select("query", "id", _distance("vector", "other").alias("distance"),
                        F.lit(False).alias("visited")))
        now = (state.join(open_ones.withColumn("now", F.lit(True)), ["query", "id"], "left")
               .select("query", "id", "distance",
                       (F.col("visited") | F.coalesce("now", F.lit(False))).alias("visited")))
        state = saved(now.union(seen).withColumn("rank", F.row_number().over(best))
                      .where(F.col("rank") <= beam).drop("rank"), "walk")


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, degree: int = 24,
            rounds: int = 1, lines: int = 6, beam: int = 320) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` nearest found of each indexed row whose id
    is divisible by `every`, by Euclidean distance, ties to smaller ids."""
    known = saved(usable(vectors), "vectors")
    points, members = vertices(known, k + 1)
    spark = vectors.sparkSession
    if not points.limit(1).count():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    graph = build_graph(points, degree, rounds, lines)
    asked = known.where(F.col("id") % every == 0).withColumn("h", F.struct(
        F.xxhash64("vector"), F.xxhash64(F.lit(1), F.col("vector"))))
    homes = points.withColumn("h", F.struct(F.xxhash64("vector"), F.xxhash64(
        F.lit(1), F.col("vector")))).select("h", F.col("id").alias("start"))
    # rows with equal vectors walk once, from the vertex they share
    starts = saved(asked.join(homes, "h").select(F.col("id").alias("query_id"), "start"),
                   "starts")
    walks = points.join(starts.select(F.col("start").alias("id")).distinct(), "id").select(
        F.col("id").alias("query"), F.col("id").alias("start"), "vector")
    found = search(points, graph, walks, beam).join(members, "id").select(
        F.col("query").alias("start"), "member", "distance")
    first = Window.partitionBy("start").orderBy("distance", "member")
    few = saved(found.withColumn("rank", F.row_number().over(first))
                .where(F.col("rank") <= k + 1).drop("rank"), "found")
    own = Window.partitionBy("query_id").orderBy("distance", "member")
    return (starts.join(few, "start").where(F.col("member") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("member").alias("vec_id"),
                    F.col("distance").alias("score")))
