"""Near-duplicates by fast similarity sketching, banding and exact verification.

Every document becomes the set of hashes of its word shingles. The sketch fills its
coordinates in rounds: in round r each element falls into a hashed bin and leaves
the value (r, hash); a bin keeps its least value, and rounds go on until no bin is
empty. After as many rounds as bins, each later round serves one bin, so all are
filled. Two sets agree in a coordinate with the probability of their Jaccard
similarity. Bands of coordinates give buckets; documents that share one are
candidates, and a link counts only if the full sets meet the threshold.

With 42 bands of 6, a pair at 0.8 is missed with a probability of 3 in a million.

Skew. Documents with equal sets are one class before anything is paired. In a
bucket the members are compared with one pivot, not with each other; the links
found make components, and following rounds take another pivot and only members of
other components. What is left after the pivot rounds (members of one bucket in
different components) is compared in full, large buckets in tiles of bounded size,
so no link is lost. Sets travel by joins that adaptive execution can split.

Defined results: null or empty texts and texts without words have no shingles,
n_shingles 0, and are linked with nothing. A text with fewer words than a shingle
is one shingle. Rows with the same doc_id count once, with the least of their
sets. Rows with a null doc_id are left out, for a component is named by an id.
Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import textops
from tickerloom.llm.common import rows, saved
from tickerloom.llm.components import components
from tickerloom.llm.textops import U, mix

EMPTY = U(2**64 - 1)
#: A bucket of up to so many members gives its pairs as rows; tiles hold so many sets.
SMALL, TILE_MEMBERS, TILE_OTHERS = 32, 512, 64
_SEEDS = mix(np.arange(1, 4097, dtype=np.uint64) * U(0xD6E8FEB86659FD93))


def fast_sketch(elements: np.ndarray, bins: int) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit hashes: `bins` values."""
    sketch = np.full(bins, EMPTY)
    done, n = 0, len(elements)
    while done < bins:
        together = min(max(1, 2048 // n), bins - done)
        rounds = np.arange(done, done + together, dtype=np.uint64)
        hashes = mix(elements[None, :] ^ _SEEDS[rounds][:, None])
        where = (((hashes >> U(32)) * U(bins)) >> U(32)).astype(np.int64).ravel()
        values = ((rounds[:, None] << U(32)) | (hashes & U(0xFFFFFFFF))).ravel()
        order = np.argsort(values)[::-1]
        own = np.full(bins, EMPTY)
        own[where[order]] = values[order]
        sketch = np.minimum(sketch, own)
        done += together
        if not (sketch == EMPTY).any():
            return sketch
    for i in np.flatnonzero(sketch == EMPTY):
        hashes = mix(elements ^ _SEEDS[bins + i])
        sketch[i] = (U(bins + i) << U(32)) | (hashes.min() & U(0xFFFFFFFF))
    return sketch


def band_keys(sketch: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band, different for different bands."""
    parts = sketch.reshape(bands, -1)
    salted = mix(parts + _SEEDS[:parts.shape[1]][None, :])
    return mix(salted.sum(axis=1, dtype=np.uint64) ^ _SEEDS[2048:2048 + bands])


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A-Z count as a-z."""
    hashes, firsts = textops.word_hashes(texts)
    return [textops.shingles(hashes[a:b], words)
            for a, b in zip(firsts[:-1], firsts[1:], strict=True)]


def sketches(docs: DataFrame, words: int, bands: int, rows_per_band: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set (d1, d2) and its band keys."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in textops.chunks(rows(batches, "doc_id", "text")):
            sets = shingle_sets(texts, words)
            digests = np.array([[mix(s ^ _SEEDS[k]).sum(dtype=np.uint64) for k in (3000, 3001)]
                                for s in sets], dtype=np.uint64)
            yield pa.record_batch({
                "doc_id": pa.array(keys, pa.int64()),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "d1": pa.array(textops.signed(digests[:, 0].copy())),
                "d2": pa.array(textops.signed(digests[:, 1].copy())),
                "bands": pa.array([
                    textops.signed(band_keys(fast_sketch(s, bands * rows_per_band), bands))
                    if len(s) else None for s in sets], pa.list_(pa.int64())),
            })

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
            .where("doc_id is not null")
            .mapInArrow(sketched,
                        "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"))


def compared_texts(docs: DataFrame, words: int = 5) -> DataFrame:
    """(doc_id, text): of each id the text whose set `near_duplicates` compares, the
    least; of several with that set the least text."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sets = shingle_sets([(t or "").encode() for t in texts], words)
            digests = np.array([[mix(s ^ _SEEDS[k]).sum(dtype=np.uint64) for k in (3000, 3001)]
                                for s in sets], dtype=np.uint64).reshape(-1, 2)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string()),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "d1": pa.array(textops.signed(digests[:, 0].copy())),
                "d2": pa.array(textops.signed(digests[:, 1].copy()))})

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .where("doc_id is not null").distinct()
            .mapInArrow(digested, "doc_id long, text string, n_shingles long, d1 long, d2 long")
            .groupBy("doc_id").agg(F.min(F.struct("n_shingles", "d1", "d2", "text")).alias("s"))
            .select("doc_id", "s.text"))


def stored_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(id, digest, members): full sets of the documents named in `ids`, as bytes.

    Rows of `docs` that share an id may differ; the digest tells which one counts.
    """

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in textops.chunks(rows(batches, "doc_id", "text")):
            sets = shingle_sets(texts, words)
            yield pa.record_batch({
                "id": pa.array(keys, pa.int64()),
                "digest": pa.array([int(textops.signed(np.array(
                    [mix(s ^ _SEEDS[3000]).sum(dtype=np.uint64)], dtype=np.uint64))[0])
                    for s in sets], pa.int64()),
                "members": pa.array([s.tobytes() for s in sets], pa.binary()),
            })

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
            .join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
            .mapInArrow(as_bytes, "id long, digest long, members binary")
            .dropDuplicates(["id", "digest"]))


def verified(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) whose sets meet 100 * intersection >= share * union."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_a, found_b = [], []
            for a, b, x, y in rows(iter([batch]), "a", "b", "x", "y"):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                if 100 * both >= share * (len(x) + len(y) - both):
                    found_a.append(a)
                    found_b.append(b)
            yield pa.record_batch({"a": pa.array(found_a, pa.int64()),
                                   "b": pa.array(found_b, pa.int64())})

    left = sets.select(F.col("id").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(
        check, "a long, b long")


def _alike_in_size(share: int):
    low, high = F.least("n", "pivot_n"), F.greatest("n", "pivot_n")
    return low * 100 >= high * share


def _buckets(members: DataFrame, order: str) -> DataFrame:
    """Buckets with members of several components: size, and the first by `order`."""
    return (members.groupBy("bucket")
            .agg(F.min("component").alias("least"), F.max("component").alias("most"),
                 F.count("*").alias("size"),
                 F.min_by(F.struct("id", "n", "component"), F.expr(order)).alias("pivot"))
            .where("least <> most")
            .select("bucket", "size", F.col("pivot.id").alias("pivot_id"),
                    F.col("pivot.n").alias("pivot_n"),
                    F.col("pivot.component").alias("pivot_component")))


def _candidates(members: DataFrame, others: DataFrame, share: int) -> DataFrame:
    return (members.join(others, "bucket")
            .where((F.col("component") != F.col("pivot_component")) & _alike_in_size(share))
            .select(F.least("id", "pivot_id").alias("a"),
                    F.greatest("id", "pivot_id").alias("b")).distinct())


def _pivot_links(members: DataFrame, sets: DataFrame, share: int, step: int) -> DataFrame:
    """Links between a bucket's pivot and its members of other components. The first
    round prefers the same pivots in all buckets, for fewer pairs; later rounds, with
    few members left outside, take a different one in each."""
    order = f"xxhash64(id, bucket, {step})" if step else "xxhash64(id)"
    pivots = saved(_buckets(members, order).drop("size"), "pivots")
    return verified(_candidates(members, pivots, share), sets, share)


def _remaining_links(members: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Every link between different components of one bucket.

    In a bucket of up to SMALL members the pairs are rows. A larger one is cut into
    tiles of members and of those outside its most likely largest component, the
    pivot's; a tile holds a bounded number of sets and gives only its links.
    """
    spread = saved(_buckets(members, "xxhash64(id, bucket)"), "spread-buckets")
    few = members.join(spread.where(F.col("size") <= SMALL).select("bucket"), "bucket")
    others = few.select("bucket", F.col("id").alias("pivot_id"), F.col("n").alias("pivot_n"),
                        F.col("component").alias("pivot_component"))
    small = verified(_candidates(few, others.alias("o"), share), sets, share)
    many = members.join(spread.where(F.col("size") > SMALL)
                        .select("bucket", "pivot_component"), "bucket")
    outside = F.col("component") != F.col("pivot_component")
    tiles = saved(many.groupBy("bucket").agg(
        F.ceil(F.count("*") / TILE_MEMBERS).cast("int").alias("across"),
        F.ceil(F.count_if(outside) / TILE_OTHERS).cast("int").alias("down")), "tiles")
    placed = many.withColumn("outside", outside).join(tiles, "bucket")
    across = F.pmod(F.xxhash64("id"), F.col("across")).cast("int")
    down = F.pmod(F.xxhash64("id"), F.col("down")).cast("int")
    every = placed.select("bucket", "id", "component", "n", F.lit(False).alias("other"),
                          across.alias("x"), F.explode(F.sequence(
                              F.lit(0), F.col("down") - 1)).alias("y"))
    alone = placed.where("outside").select(
        "bucket", "id", "component", "n", F.lit(True).alias("other"),
        F.explode(F.sequence(F.lit(0), F.col("across") - 1)).alias("x"), down.alias("y"))
    tiled = (every.union(alone).join(sets, "id")
             .groupBy("bucket", "x", "y").applyInArrow(_tile_links(share), "a long, b long"))
    return small.union(tiled).distinct()


def _tile_links(share: int):
    """Links of one tile: its other members, each against all its members at once."""

    def links(tile: pa.Table) -> pa.Table:
        other = np.asarray(tile.column("other"))
        ids, component = (np.asarray(tile.column(c)) for c in ("id", "component"))
        sets = [np.frombuffer(x, np.uint64) for x in tile.column("members").to_pylist()]
        plain = np.flatnonzero(~other)
        found_a, found_b = [], []
        if len(plain):
            sizes = np.array([len(sets[i]) for i in plain])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            elements = np.concatenate([sets[i] for i in plain])
            for k in np.flatnonzero(other):
                own = sets[k]
                at = np.minimum(np.searchsorted(own, elements), len(own) - 1)
                both = np.add.reduceat((own[at] == elements).astype(np.int64), starts)
                linked = ((100 * both >= share * (sizes + len(own) - both))
                          & (component[plain] != component[k]))
                for m in ids[plain[linked]]:
                    found_a.append(min(m, ids[k]))
                    found_b.append(max(m, ids[k]))
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return links


def _named(ids: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """`ids` with `column`, an id, replaced by its component; one without label is its own."""
    known = labels.select(F.col("id").alias(column), F.col("component").alias("_of"))
    return (ids.join(known, column, "left")
            .withColumn(column, F.coalesce("_of", column)).drop("_of"))


def _joined(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(component, joined): the components that `links` between ids make part of another."""
    between = _named(_named(links, labels, "a"), labels, "b").where("a <> b")
    return components(between).where("node <> component").select(
        F.col("node").alias("component"), F.col("component").alias("joined"))


def _relabelled(labels: DataFrame, joined: DataFrame) -> DataFrame:
    """`labels` (id, component) of all ids that are not their own component, after `joined`."""
    moved = labels.join(joined, "component", "left").select(
        "id", F.coalesce("joined", "component").alias("component"))
    return moved.union(joined.select(F.col("component").alias("id"),
                                     F.col("joined").alias("component")))


def _unsettled(members: DataFrame, joined: DataFrame) -> DataFrame:
    """Members, under their new components, of the buckets that still hold several."""
    renamed = saved(members.join(joined, "component", "left").select(
        "id", "n", "bucket", F.coalesce("joined", "component").alias("component")), "renamed")
    several = renamed.groupBy("bucket").agg(
        F.min("component").alias("least"), F.max("component").alias("most")).where(
        "least <> most").select("bucket")
    return renamed.join(several, "bucket", "left_semi")


def near_duplicates(docs: DataFrame, words: int = 5, share: int = 80, bands: int = 42,
                    rows_per_band: int = 6, pivot_rounds: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links), kept."""
    sketched = saved(sketches(docs, words, bands, rows_per_band), "sketches")
    one_set = sketched.groupBy("doc_id").agg(
        F.min(F.struct("n_shingles", "d1", "d2")).alias("s")).select("doc_id", "s.*")
    classes = saved(one_set.where("n_shingles > 0").groupBy("n_shingles", "d1", "d2")
                    .agg(F.min("doc_id").alias("id")), "set-classes")
    entries = (classes.withColumnRenamed("id", "doc_id")
               .join(sketched.select("doc_id", "d1", "d2", "bands")
                     .dropDuplicates(["doc_id", "d1", "d2"]), ["doc_id", "d1", "d2"])
               .select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"),
                       F.explode("bands").alias("bucket")))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = saved(entries.join(shared.select("bucket"), "bucket", "left_semi")
                    .withColumn("component", F.col("id")), "bucket-members")
    sets = stored_sets(docs, members.select("id").distinct(), words).join(
        classes.select("id", F.col("d1").alias("digest")), ["id", "digest"], "left_semi")
    sets = saved(sets.select("id", "members"), "shingle-sets")
    # Components are kept once per id that has another's; the members of a bucket are
    # dropped as soon as they are one component, so rounds shrink.
    labels = sets.sparkSession.createDataFrame([], "id long, component long")
    for step in range(pivot_rounds + 1):
        links = saved(_pivot_links(members, sets, share, step) if step < pivot_rounds
                      else _remaining_links(members, sets, share), "links")
        if not links.limit(1).count():
            continue
        joined = saved(_joined(links, labels), "joined")
        labels = saved(_relabelled(labels, joined), "labels")
        if step < pivot_rounds:
            members = saved(_unsettled(members, joined), "bucket-members")
    named = classes.join(labels, "id", "left").select(
        "n_shingles", "d1", "d2", F.coalesce("component", "id").alias("component"))
    return one_set.join(named, ["n_shingles", "d1", "d2"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"))
