"""Merkle manifest of a table of documents: a root per source, one over all, and proofs.

Every document is a leaf, a digest of its columns. The leaves of a source, in order of
doc_id, are nodes in runs of 16; a run becomes the digest of its nodes, until one node is
left, the subroot. The subroots, in order of source, are the leaves of one more tree.

A level is kept as one hex string per aligned block of 256 nodes, 64 characters each, so
a parent is the digest of a fixed-width substring and the siblings of a node are the
substrings beside it. A block spans two levels and leaves one digest; the digests of a
tree's blocks are the nodes of its next stage, one stage for every factor of 256. All of
it is SQL functions; no task holds more than a block, and a source with any share of the
table has its blocks in many tasks.

Defined results: null columns, texts included, are written `-`; empty texts are `0:`.
A null doc_id stands first in its source and is never tampered with; documents with one
doc_id are separate leaves, ordered by digest. The null source is a tree of its own and
comes first. A lone leaf is its subroot, a lone subroot the root, with no siblings. An
empty table has an empty manifest. Columns beside the five change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import saved
from tickerloom.llm.ranks import ranked

RUN = 16
BLOCK = RUN * RUN
HEX = 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Digest of a document, each column led by its length in bytes."""
    written = [F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)
               for c in (columns[n].cast("string") for n in COLUMNS)]
    return digest(*[F.coalesce(w, F.lit("-")) for w in written])


def leaves(docs: DataFrame, changed_text: Column | None = None) -> DataFrame:
    """doc_id, tree (the source), leaf, and `changed`: the leaf that the document would
    have with `changed_text`, null where that is null. A stored table of digests."""
    own = {n: F.col(n) for n in COLUMNS}
    changed = F.lit(None).cast("string")
    if changed_text is not None:
        changed = F.when(changed_text.isNotNull(), leaf_digest(own | {"text": changed_text}))
    # Led by a character, sources never equal the empty key of the null source.
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    return saved(docs.select("doc_id", tree.alias("tree"), leaf_digest(own).alias("leaf"),
                             changed.alias("changed")), "leaves")


def _parents(level: Column) -> Column:
    """The level above one level of a block, as one hex string."""
    starts = F.sequence(F.lit(1), F.length(level), F.lit(RUN * HEX))
    return F.array_join(F.transform(
        starts, lambda at: digest(F.substring(level, at, F.lit(RUN * HEX)))), "")


def _stage(nodes: DataFrame) -> DataFrame:
    """Stored blocks of `nodes` (tree, position, members, hash, item): both levels, items
    in order and the digest each block leaves."""
    block = F.floor(F.col("position") / BLOCK).alias("block")
    grouped = nodes.groupBy("tree", "members", block).agg(F.sort_array(F.collect_list(
        F.struct("position", "hash", "item"))).alias("nodes"))
    levelled = grouped.withColumn("low", F.array_join(F.col("nodes.hash"), ""))
    blocks = saved(levelled.withColumn("high", _parents(F.col("low"))), "blocks")
    left = (F.when(F.col("members") == 1, F.col("low"))
            .when(F.col("members") <= RUN, F.col("high"))
            .otherwise(digest(F.col("high"))))
    return blocks.withColumn("left_over", left)


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The stages of all trees, from the leaves up, and (tree, top)."""
    stages, tops = [], None
    while True:
        blocks = _stage(nodes)
        stages.append(blocks)
        done = blocks.where(F.col("members") <= BLOCK).select(
            "tree", F.col("left_over").alias("top"))
        tops = done if tops is None else tops.union(done)
        nodes = blocks.where(F.col("members") > BLOCK).select(
            "tree", F.col("block").alias("position"),
            F.ceil(F.col("members") / BLOCK).alias("members"),
            F.col("left_over").alias("hash"), F.lit(None).cast("string").alias("item"))
        if not nodes.limit(1).count():
            return stages, saved(tops, "tops")


def _beside(level: str, start: Column, at: Column) -> Column:
    """The siblings of node `at` in its run, which begins at node `start`."""
    hexes = F.col(level)
    return F.struct(
        F.substring(hexes, start * HEX + 1, (at - start) * HEX).alias("left"),
        F.substring(hexes, (at + 1) * HEX + 1, (start + RUN - 1 - at) * HEX).alias("right"))


def _own_path(node: Column) -> Column:
    """Siblings of a node of a block, one entry for each level that the block spans."""
    at = F.pmod(node["position"], F.lit(BLOCK)).cast("int")
    run = F.floor(at / RUN).cast("int")
    both = F.array(_beside("low", run * RUN, at), _beside("high", F.lit(0), run))
    return F.slice(both, 1, F.when(F.col("members") == 1, 0)
                   .when(F.col("members") <= RUN, 1).otherwise(2))


def _descend(stages: list[DataFrame], above: DataFrame) -> DataFrame:
    """(tree, position, hash, item, path) of the nodes of the lowest stage. `above` has
    (tree, above): the path of each tree's top."""
    paths = None
    for blocks in reversed(stages):
        known = blocks.where(F.col("members") <= BLOCK).join(above, "tree")
        if paths is not None:
            higher = paths.select("tree", F.col("position").alias("block"),
                                  F.col("path").alias("above"))
            known = known.unionByName(
                blocks.where(F.col("members") > BLOCK).join(higher, ["tree", "block"]))
        with_path = F.transform("nodes", lambda x: F.struct(
            x["position"].alias("position"), x["hash"].alias("hash"), x["item"].alias("item"),
            F.concat(_own_path(x), F.col("above")).alias("path")))
        paths = known.select("tree", F.inline(with_path))
    return paths


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, beside: digest(beside["left"], h, beside["right"]))


def manifest(leaf_rows: DataFrame) -> DataFrame:
    """doc_id, source key `tree`, leaf, changed, path, subroot and root of every leaf.

    `path` has an entry for each level up to the root: the siblings to the left and to
    the right of the leaf's ancestor, as hex text. `fold(leaf, path)` gives the root.
    """
    item = F.struct("doc_id", "changed").alias("item")
    placed = ranked(leaf_rows, "tree", ["doc_id", "leaf"]).select(
        "tree", "position", "members", F.col("leaf").alias("hash"), item)
    stages, subroots = _climb(placed)
    sources = ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("item"),
                                     F.col("top").alias("hash")), "tree", ["item"])
    top_stages, top = _climb(sources)
    none = F.array().cast("array<struct<left:string,right:string>>")
    source_paths = saved(_descend(top_stages, top.select("tree", none.alias("above")))
                         .select(F.col("item").alias("tree"), F.col("path").alias("above")),
                         "source-paths")
    found = top.first()  # one row, none of an empty table
    root = F.lit(found["top"] if found else None).cast("string").alias("root")
    roots = subroots.select("tree", F.col("top").alias("subroot"), root)
    return (_descend(stages, source_paths).join(roots, "tree").select(
        F.col("item.doc_id").alias("doc_id"), "tree", F.col("hash").alias("leaf"),
        F.col("item.changed").alias("changed"), "path", "subroot", "root"))


def proofs(docs: DataFrame, changed_text: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document.

    The root is folded from the leaf that `changed_text` gives, where it is not null, and
    the siblings of the untouched table.
    """
    beside = F.transform("path", lambda x: F.concat(x["left"], x["right"]))
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    return manifest(leaves(docs, changed_text)).select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.array_join(beside, ""), 256).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def lower_case_fifth() -> Column:
    """The text with A-Z in lower case where 5 divides the crc32 of the decimal doc_id."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.when(chosen, F.translate("text", upper, upper.lower()))
