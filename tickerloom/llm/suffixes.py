"""Repeated byte strings across documents, found by column-wise suffix sorting.

Bytes covered by a string of `length` bytes that also starts earlier (smaller
doc_id, or same document and earlier start) are removed. Matches never cross
documents; copies are judged on the input.

Whole documents cannot be inserted column by column: that takes as many rounds as
the longest text has bytes, each over the whole collection. So documents are first
cut where equal windows must be cut alike:

* Anchors. Each window of `length` bytes has an anchor, the place of its least
  hashed `gram` bytes, the first if there are more. Equal windows have equal
  anchors at equal offsets. Windows that follow each other with one anchor are one
  segment, under 2 * length bytes. A segment whose anchor occurs once holds no
  repeat. These are counted by a shuffle of hashes that combines per task.
* Equal segments. All but the first occurrence of a segment are covered whole.
* Different segments around equal anchors may share some of their windows. They are
  dealt into bounded blocks, and each block is sorted by column-wise multi-document
  construction: every round inserts one symbol of each segment, from the right, into
  the Burrows-Wheeler transform of the block. Neighbours in the order it gives that
  share their first `length` symbols are one string; its first occurrence wins. The
  anchor's bytes are left out of the sort, so a run of equal symbols may mix anchors
  and is put in order by string before neighbours are compared. Only
  that one common prefix matters, so neighbours are compared by its hash and no table
  of common prefix lengths is kept. An anchor with very many segments is spread over
  blocks, each of which reports its strings' first occurrences, and these are merged
  by hash.

The sequential files of an external-memory construction are Spark's own: the blocks
come sorted from shuffle files, and what a round needs of a bounded block fits in
memory.

Defined results: null texts are empty; an empty or short text has nothing removed.
Rows with the same doc_id and text count once; of several texts under one doc_id
the greatest counts. Rows with null doc_id are left out. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import textops
from tickerloom.llm.common import rows, saved
from tickerloom.llm.textops import U, mix

GRAM = 24
PIECE_BYTES = 1_500_000
BLOCK_SEGMENTS = 20_000
BATCH_SEGMENTS = 1_000
STRETCH = 128
_PLACE = U(2**24 - 1)
NO_REPEATS = pa.schema([("doc_id", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
                        ("key", pa.int64()), ("first", pa.bool_())])
OCCURRENCE = "anchor long, segment long, doc_id long, place long, ahead int, windows int"


def _pieces(batches: Iterator[pa.RecordBatch], length: int
            ) -> Iterator[tuple[tuple[int, int], bytes]]:
    """((doc_id, offset), bytes): long texts in pieces, each window in one of them."""
    for key, text in rows(batches, "doc_id", "text"):
        text = text or b""
        if len(text) >= length:
            for at in range(0, len(text) - length + 1, PIECE_BYTES):
                yield (key, at), text[at:at + PIECE_BYTES + length - 1]


def segments_of(texts: list[bytes], length: int, gram: int
                ) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, anchor place, anchor hash, segment hash);
    places count from the start of the text."""
    data, offsets = textops.joined(texts)
    sums = textops.prefix_hashes(data)
    places = np.arange(len(data) - gram + 1)
    grams = textops.stretch_hashes(sums, places, places + gram)
    least = (grams & ~_PLACE) | places.astype(np.uint64)
    span, width = 1, length - gram + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    anchors = (least & _PLACE).astype(np.int64)
    valid = np.zeros(len(anchors), dtype=bool)
    for i, text in enumerate(texts):
        valid[offsets[i]:offsets[i] + len(text) - length + 1] = True
    windows = np.flatnonzero(valid)
    own = anchors[windows]
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (windows[1:] != windows[:-1] + 1)
    heads = np.flatnonzero(new)
    first, at = windows[heads], own[heads]
    last = windows[np.append(heads[1:], len(windows)) - 1] if len(heads) else first
    whole = mix(textops.stretch_hashes(sums, first, last + length) + (at - first).astype(U))
    text = np.searchsorted(offsets, first, side="right") - 1
    start = offsets[text]
    return text, first - start, last - start, at - start, grams[at], whole


def occurrences(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Every segment: anchor and segment hash, where its anchor lies, how many bytes
    the first window starts ahead of it, and how many windows there are."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in textops.chunks(_pieces(batches, length)):
            text, first, last, at, anchor, segment = segments_of(texts, length, gram)
            ids, offsets = (np.array(x, dtype=np.int64)[text] for x in zip(*keys, strict=True))
            yield pa.record_batch({
                "anchor": pa.array(textops.signed(anchor)),
                "segment": pa.array(textops.signed(segment)),
                "doc_id": pa.array(ids),
                "place": pa.array(offsets + at),
                "ahead": pa.array((at - first).astype(np.int32)),
                "windows": pa.array((last - first + 1).astype(np.int32)),
            })

    return docs.mapInArrow(found, OCCURRENCE)


def suffix_ranks(strings: list[bytes], least: int) -> list[np.ndarray]:
    """For each string the ranks of its suffixes of `least` or more bytes, longest
    first, among all suffixes of all strings.

    Column-wise construction: the transform starts with the last symbol of every
    string, as the symbol before its empty suffix. Round j finds where the suffixes
    of length j go by last-to-first mapping, with counts of symbols per stretch of
    the transform, and inserts there the symbols before them. Equal suffixes stand in
    the order of the strings.
    """
    many, lengths = len(strings), np.array([len(s) for s in strings])
    used, codes = np.unique(np.frombuffer(b"".join(strings), np.uint8), return_inverse=True)
    kinds = len(used) + 1                                    # 0: no symbol before
    columns = np.zeros((many, int(lengths.max()) + 1), dtype=np.uint8 if kinds < 256 else np.uint16)
    ends = np.cumsum(lengths)
    for k in range(int(lengths.max())):
        longer = lengths > k
        columns[longer, k] = codes[ends[longer] - 1 - k] + 1
    before, place = columns[:, 0].copy(), np.arange(many)
    row = (np.arange(int(lengths.sum()) + many) // STRETCH) * kinds
    for k in range(1, columns.shape[1]):
        active = np.flatnonzero(lengths >= k)
        target = _mapped(before, place[active], kinds, many, row)
        grown = np.empty(len(before) + len(active), dtype=before.dtype)
        old = np.ones(len(grown), dtype=bool)
        old[target] = False
        grown[old] = before
        grown[target] = columns[active, k]
        place[active] = target
        before = grown
    order = np.argsort(before, kind="stable")[np.count_nonzero(before == 0):]
    follow = np.zeros(len(before), dtype=np.int64)
    follow[order] = many + np.arange(len(order))
    ranks = np.full((many, max(columns.shape[1] - least, 0)), -1, dtype=np.int64)
    place = np.arange(many)
    for k in range(1, columns.shape[1]):
        active = lengths >= k
        place[active] = follow[place[active]]
        if k >= least:
            ranks[active, k - least] = place[active]
    return [ranks[i, :max(n - least + 1, 0)][::-1] for i, n in enumerate(lengths)]


def _mapped(before: np.ndarray, places: np.ndarray, kinds: int, many: int,
            row: np.ndarray) -> np.ndarray:
    """Where the suffixes begun by the symbols at `places` stand in the next round.
    `row` has, for each place, where the counts of its stretch begin."""
    n = len(before)
    counts = np.bincount(row[:n] + before, minlength=(-(-n // STRETCH)) * kinds
                         ).reshape(-1, kinds)
    total = counts.sum(axis=0)
    smaller = np.cumsum(total) - total - total[0]            # what has no symbol comes first
    above = np.cumsum(counts, axis=0) - counts
    symbols, rows_of = before[places], places // STRETCH
    view = np.zeros((len(counts), STRETCH), before.dtype)
    view.ravel()[:n] = before
    inside = ((view[rows_of] == symbols[:, None])
              & (np.arange(STRETCH)[None, :] < (places % STRETCH)[:, None])).sum(axis=1)
    return many + smaller[symbols] + above[rows_of, symbols] + inside


def _ranks_by_batch(strings: list[bytes], anchor: np.ndarray, least: int) -> list[np.ndarray]:
    """Ranks as of `suffix_ranks`, built for whole anchors of some BATCH_SEGMENTS
    segments at a time, so that a round's arrays stay in the processor's cache."""
    out: list[np.ndarray] = []
    ends = np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor))
    begin, above = 0, 0
    for end, after in zip(ends, np.append(ends[1:], 0), strict=True):
        if after == 0 or after - begin > BATCH_SEGMENTS:
            found = suffix_ranks(strings[begin:end], least)
            out.extend(r + above for r in found)
            above += sum(map(len, strings[begin:end])) + end - begin
            begin = end
    return out


def _block_repeats(length: int, gram: int):
    """One block: stretches to remove, and the first place of each string of anchors
    that other blocks have too."""

    half = (length - gram) // 2

    def sharing(block: pa.Table) -> np.ndarray:
        """Segments that may share a window with another of their anchor: one side of
        the anchor gives at least half of what a window has besides it."""
        strings = block.column("bytes").to_pylist()
        ahead, anchor = (np.asarray(block.column(c)) for c in ("ahead", "anchor"))
        data, offsets = textops.joined(strings)
        sums, at = textops.prefix_hashes(data), offsets[:-1] + ahead
        ends = offsets[1:] - 1
        found = np.asarray(block.column("split")).copy()
        for low, high in ((at - half, at), (at + gram, at + gram + half)):
            there = np.flatnonzero((low >= offsets[:-1]) & (high <= ends))
            side = mix(textops.stretch_hashes(sums, low[there], high[there])
                       ^ anchor[there].view(np.uint64))
            _, which, counts = np.unique(side, return_inverse=True, return_counts=True)
            found[there[counts[which] > 1]] = True
        return found

    def repeats(block: pa.Table) -> pa.Table:
        block = block.filter(pa.array(sharing(block))).sort_by([("anchor", "ascending"), ("doc_id", "ascending"),
                               ("place", "ascending")])
        anchor, doc, place, ahead = (np.asarray(block.column(c)) for c in (
            "anchor", "doc_id", "place", "ahead"))
        split = np.asarray(block.column("split"))
        if not len(anchor):
            return NO_REPEATS.empty_table()
        # the anchor's own bytes are the same in all its segments, at the same offset of
        # equal windows, and lie in every window: they need no rounds
        strings = [s[:a] + s[a + gram:] for s, a in zip(
            block.column("bytes").to_pylist(), ahead.tolist(), strict=True)]
        ranks = _ranks_by_batch(strings, anchor, length - gram)
        string = np.repeat(np.arange(len(strings)), [len(r) for r in ranks])
        start = np.concatenate([np.arange(len(r)) for r in ranks])
        rank = np.concatenate(ranks)
        order = np.argsort(rank)
        string, start = string[order], start[order]
        data, offsets = textops.joined(strings)
        at = offsets[string] + start
        # neighbours in suffix order that share these symbols and belong together
        shared = textops.stretch_hashes(textops.prefix_hashes(data), at, at + length - gram)
        alike = mix(mix(shared ^ anchor[string].view(np.uint64))
                    + (ahead[string] - start).astype(np.uint64))
        # of equal symbols around different anchors, what follows decides the order:
        # strings are brought together within such a run
        run = np.cumsum(_changes(shared)) - 1
        kinds = np.bincount(run, _changes(alike))
        several = np.flatnonzero(kinds[run] > 1)
        order = several[np.lexsort((alike[several], run[several]))]
        string[several], start[several], alike[several] = string[order], start[order], alike[order]
        new = _changes(alike)
        group = np.cumsum(new) - 1
        first = np.minimum.reduceat(string, np.flatnonzero(new)) if len(string) else string
        own = first[group] == string
        begin = place[string] - ahead[string] + start
        lone = own & split[string]
        cover = _runs(doc[string[~own]], begin[~own], length)
        return pa.table({
            "doc_id": pa.array(np.concatenate((cover[0], doc[string[lone]]))),
            "low": pa.array(np.concatenate((cover[1], begin[lone]))),
            "high": pa.array(np.concatenate((cover[2], begin[lone] + length))),
            "key": pa.array(np.concatenate((np.zeros(len(cover[0]), np.int64),
                                            textops.signed(alike[lone])))),
            "first": pa.array(np.concatenate((np.zeros(len(cover[0]), bool),
                                              np.ones(int(lone.sum()), bool)))),
        })

    return repeats


def _changes(values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it; true for the first."""
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    return new


def _runs(doc: np.ndarray, begin: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(doc, low, high) of windows that follow each other byte by byte."""
    order = np.lexsort((begin, doc))
    doc, begin = doc[order].astype(np.int64), begin[order].astype(np.int64)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (begin[1:] > begin[:-1] + 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(doc))[:len(heads)] - 1
    return doc[heads], begin[heads], begin[tails] + length


def covered(docs: DataFrame, length: int = 100, gram: int = GRAM) -> DataFrame:
    """(doc_id, low, high): byte stretches to remove; they may overlap.

    `docs` has a doc_id that is not null and not repeated, and the text as bytes.
    """
    found = saved(occurrences(docs, length, gram), "segments")
    again = saved(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"),
                  "repeated-anchors")
    repeated = saved(found.join(again.select("anchor"), "anchor", "left_semi"),
                     "repeated-segments")
    firsts = saved(repeated.groupBy("anchor", "segment", "ahead", "windows").agg(
        F.min(F.struct("doc_id", "place")).alias("first")), "first-segments")
    first_id, first_place = F.col("first.doc_id"), F.col("first.place")
    low = F.col("place") - F.col("ahead")
    copies = (repeated.join(firsts, ["anchor", "segment", "ahead", "windows"])
              .where((F.col("doc_id") != first_id) | (F.col("place") != first_place))
              .select("doc_id", low.alias("low"),
                      (low + F.col("windows") - 1 + length).alias("high")))
    mixed = (firsts.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    total = mixed.agg(F.coalesce(F.sum("kinds"), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // BLOCK_SEGMENTS))
    parts = F.ceil(F.col("kinds") / BLOCK_SEGMENTS)
    block = F.pmod(F.xxhash64("anchor", F.pmod(F.xxhash64("segment"), parts)), F.lit(blocks))
    cuts = (firsts.join(mixed, "anchor")
            .select(first_id.alias("doc_id"), F.struct(
                "anchor", first_place.alias("place"), "ahead", "windows",
                (F.col("kinds") > BLOCK_SEGMENTS).alias("split"), block.alias("block"))
                .alias("cut"))
            .groupBy("doc_id").agg(F.collect_list("cut").alias("cuts")))
    sorted_blocks = saved(
        _cut(docs.join(cuts, "doc_id"), length).groupBy("block").applyInArrow(
            _block_repeats(length, gram),
            "doc_id long, low long, high long, key long, first boolean"), "block-repeats")
    ones = sorted_blocks.where("first")
    earliest = ones.groupBy("key").agg(
        F.min(F.struct("doc_id", "low")).alias("best"), F.count("*").alias("n")).where("n > 1")
    later = (ones.join(earliest, "key")
             .where((F.col("doc_id") != F.col("best.doc_id")) | (F.col("low") != F.col("best.low")))
             .select("doc_id", "low", "high"))
    inner = sorted_blocks.where("not first").select("doc_id", "low", "high")
    return copies.union(inner).union(later)


def _cut(with_cuts: DataFrame, length: int) -> DataFrame:
    """The bytes of each segment named in `cuts`."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, text, cuts in rows(batches, "doc_id", "text", "cuts"):
            lows = [c["place"] - c["ahead"] for c in cuts]
            yield pa.record_batch({
                "block": pa.array([c["block"] for c in cuts], pa.int64()),
                "split": pa.array([c["split"] for c in cuts], pa.bool_()),
                "anchor": pa.array([c["anchor"] for c in cuts], pa.int64()),
                "doc_id": pa.array([key] * len(cuts), pa.int64()),
                "place": pa.array([c["place"] for c in cuts], pa.int64()),
                "ahead": pa.array([c["ahead"] for c in cuts], pa.int64()),
                "bytes": pa.array([text[a:a + c["windows"] - 1 + length]
                                   for a, c in zip(lows, cuts, strict=True)], pa.binary()),
            })

    return with_cuts.select("doc_id", "text", "cuts").mapInArrow(
        cut, "block long, split boolean, anchor long, doc_id long, place long, ahead long, "
        "bytes binary")


def one_text_each(docs: DataFrame) -> DataFrame:
    """doc_id and bytes, once for each doc_id; the texts are grouped only where an id
    is repeated."""
    plain = docs.select(F.col("doc_id").cast("long"),
                        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
                        ).where("doc_id is not null")
    repeated = saved(plain.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
                     .select("doc_id"), "repeated-ids")
    if not repeated.limit(1).count():
        return plain
    several = plain.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.max("text").alias("text"))
    return plain.join(repeated, "doc_id", "left_anti").union(several)


def remove_repeats(docs: DataFrame, length: int = 100, gram: int = GRAM) -> DataFrame:
    """doc_id, kept (the remaining bytes), n_bytes, n_removed, spans: the maximal
    removed runs as (low, high)."""
    texts = one_text_each(docs)
    stretches = covered(texts, length, gram).groupBy("doc_id").agg(
        F.collect_list(F.struct("low", "high")).alias("stretches"))

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, text, found in rows(batches, "doc_id", "text", "stretches"):
            spans: list[list[int]] = []
            for low, high in sorted((s["low"], s["high"]) for s in found or ()):
                if spans and low <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], high)
                else:
                    spans.append([low, high])
            edges = [0, *(x for span in spans for x in span), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2], strict=True))
            yield pa.record_batch({
                "doc_id": pa.array([key], pa.int64()),
                "kept": pa.array([kept], pa.binary()),
                "n_bytes": pa.array([len(text)], pa.int64()),
                "n_removed": pa.array([len(text) - len(kept)], pa.int64()),
                "spans": pa.array([[{"low": a, "high": b} for a, b in spans]],
                                  pa.list_(pa.struct([("low", pa.int64()),
                                                      ("high", pa.int64())]))),
            })

    return texts.join(stretches, "doc_id", "left").select("doc_id", "text", "stretches").mapInArrow(
        cleaned, "doc_id long, kept binary, n_bytes long, n_removed long, "
        "spans array<struct<low: long, high: long>>")


def digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of `remove_repeats`."""
    return removed.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
