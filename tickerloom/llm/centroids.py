"""Centroid clustering of whole-number vectors, exact, through subvector dictionaries.

Components become integers, and vectors are cut into blocks of dimensions. A chunk of
vectors keeps, for every block, the distinct subvectors it holds and a code per vector:
nothing is lost, and each distinct subvector is measured against the centroids once a
round, whatever the number of vectors that share it. A vector's distances are the sums of
the partial distances that its codes name; sums by cluster are counts of codes times
subvectors. All arithmetic is on integers.

Vectors are ordered by their components before they are cut into chunks, so equal ones,
and those that begin alike, share entries. A dictionary belongs to a chunk of a fixed
number of vectors: one for the whole table would need a join of every code with it in
every round, where a chunk needs none. A round reads the chunks and sends on a row per
cluster and task; the driver holds the centroids.

Defined results: vectors of another length, null, or with null or non-finite components
take no part. Repeated rows count each. A null id takes part, but seeds last. Fewer than
`clusters` vectors seed fewer centroids; of none the result is empty. Ties go to the
smaller number. Other columns change nothing. A component beyond 2^27 in size after
scaling stops the job, for squared distances would not fit their type.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import saved

CHUNK = 4096
LARGEST = 2**27
CHUNKS = "ids array<long>, dictionaries array<binary>, codes array<binary>"


def whole_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id and `whole`: floor(scale * x) of each component, of the vectors that count."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return vectors.where((F.size("embedding") == dims) & finite).select(
        "vec_id", scaled.alias("whole"))


def encoded(whole: DataFrame, dims: int, block: int, chunk: int = CHUNK) -> DataFrame:
    """A row for each chunk: ids, and for each block its subvectors and a code per id."""
    blocks = range(0, dims, block)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        parts: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            found = np.concatenate(parts)
            if len(found) and np.abs(found).max() > LARGEST:
                raise ValueError(f"a scaled component is beyond {LARGEST}")
            dictionaries, codes = [], []
            for at in blocks:
                distinct, code = np.unique(found[:, at:at + block], axis=0, return_inverse=True)
                dictionaries.append(distinct.astype(np.int32).tobytes())
                codes.append(code.reshape(-1).astype(np.uint16).tobytes())
            return pa.record_batch({
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "dictionaries": pa.array([dictionaries], pa.list_(pa.binary())),
                "codes": pa.array([codes], pa.list_(pa.binary()))})

        for batch in batches:
            values = np.asarray(batch.column("whole").flatten(), np.int64).reshape(-1, dims)
            own = batch.column("vec_id").to_pylist()
            at = 0
            while at < len(own):
                take = min(chunk - len(ids), len(own) - at)
                ids += own[at:at + take]
                parts.append(values[at:at + take])
                at += take
                if len(ids) == chunk:
                    yield row()
                    ids, parts = [], []
        if ids:
            yield row()

    return (whole.repartitionByRange("whole", "vec_id").sortWithinPartitions("whole")
            .mapInArrow(encode, CHUNKS))


def _chunks(batches: Iterator[pa.RecordBatch], block: int):
    """ids, and (dictionary, codes) of each block, chunk by chunk."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            pairs = zip(row.column("dictionaries")[0], row.column("codes")[0], strict=True)
            yield row.column("ids")[0].values, [
                (np.frombuffer(d.as_buffer(), np.int32).reshape(-1, block).astype(np.int64),
                 np.frombuffer(c.as_buffer(), np.uint16)) for d, c in pairs]


def _distances(blocks: list[tuple[np.ndarray, np.ndarray]], centroids: np.ndarray) -> np.ndarray:
    """Squared distances, vectors by centroids: partial ones once per subvector, summed by code."""
    width = blocks[0][0].shape[1]
    total = 0
    for k, (distinct, codes) in enumerate(blocks):
        own = centroids[:, k * width:(k + 1) * width]
        partial = ((distinct[:, None, :] - own[None]) ** 2).sum(axis=2)
        total = total + partial[codes]
    return total


def _totals(chunks: DataFrame, centroids: np.ndarray, block: int) -> dict[int, tuple]:
    """cluster: (vectors, componentwise sum, sum of distances), of the clusters with any."""
    n, dims = centroids.shape

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, inertia = np.zeros(n, np.int64), np.zeros(n, np.int64)
        sums = np.zeros((n, dims), np.int64)
        for _, blocks in _chunks(batches, block):
            distances = _distances(blocks, centroids)
            nearest = distances.argmin(axis=1)
            size += np.bincount(nearest, minlength=n)
            for c in range(n):
                inertia[c] += distances[nearest == c, c].sum()
            for k, (distinct, codes) in enumerate(blocks):
                used = np.bincount(nearest * len(distinct) + codes, minlength=n * len(distinct))
                sums[:, k * block:(k + 1) * block] += used.reshape(n, -1) @ distinct
        some = np.flatnonzero(size)
        yield pa.record_batch({
            "cluster": pa.array(some, pa.int32()), "size": pa.array(size[some]),
            "inertia": pa.array(inertia[some]),
            "sums": pa.array(list(sums[some]), pa.list_(pa.int64()))})

    parts = chunks.mapInArrow(count, "cluster int, size long, inertia long, sums array<long>")
    found = parts.groupBy("cluster").agg(
        F.sum("size").alias("size"), F.sum("inertia").alias("inertia"),
        F.array(*[F.sum(F.col("sums")[i]) for i in range(dims)]).alias("sums"))
    return {r["cluster"]: (r["size"], r["sums"], r["inertia"]) for r in found.collect()}


def _moved(centroids: np.ndarray, totals: dict[int, tuple]) -> np.ndarray:
    rows = [[s // totals[c][0] for s in totals[c][1]] if c in totals else list(centroids[c])
            for c in range(len(centroids))]
    return np.array(rows, np.int64)


def seeds(whole: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors with the least sha256 of `<seed>:<vec_id>`, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = whole.orderBy(order.asc_nulls_last(), "whole").limit(clusters)
    return np.array([r["whole"] for r in chosen.collect()], np.int64)


def cluster(vectors: DataFrame, clusters: int = 8, rounds: int = 10, dims: int = 64,
            block: int = 8, scale: int = 1024, seed: str = "3") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid.

    `rounds` times each vector goes to its nearest centroid and each centroid with vectors
    to the floor of their mean; then vectors are assigned once more. `centroid` is the
    final one of the vector's cluster, an array of longs.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, dims, scale)
    centroids = seeds(whole, clusters, seed)
    if not len(centroids):
        return spark.createDataFrame([], (
            "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
            "centroid_sha256 string, centroid array<long>"))
    chunks = saved(encoded(whole, dims, block), "encoded-vectors")
    for _ in range(rounds):
        centroids = _moved(centroids, _totals(chunks, centroids, block))
    inertia = {c: t[2] for c, t in _totals(chunks, centroids, block).items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, blocks in _chunks(batches, block):
            distances = _distances(blocks, centroids)
            nearest = distances.argmin(axis=1)
            yield pa.record_batch({
                "vec_id": ids, "cluster": pa.array(nearest, pa.int32()),
                "distance": pa.array(distances[np.arange(len(nearest)), nearest])})

    described = spark.createDataFrame(
        [(c, inertia[c], sum(inertia.values()),
          hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest(),
          [int(x) for x in centroids[c]]) for c in inertia],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, "
        "centroid array<long>")
    assigned = chunks.mapInArrow(assign, "vec_id long, cluster int, distance long")
    return assigned.join(F.broadcast(described), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256",
        "centroid")
