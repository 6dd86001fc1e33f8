"""Benchmark decontamination with a BM25 index of the test items and block-max WAND.

The test items are the indexed documents, the passages of the training documents are
the queries. An item's term weights are its BM25 impacts divided by their sum, so an
item's score for a passage is the weighted share of the item found there, from 0 to
1. Items are cut into blocks; a block stores the largest impact of each of its terms.
For each passage the sum of these maxima bounds every score of the block: only blocks
whose bound reaches the threshold are opened, and within them postings are read from
the strongest term on until the terms still to come cannot lift a new item over it.
Every item at or above the threshold is found (the bound never falls below a score).

Items are grouped by their length in words, rounded up to a power of two of at least
`LEAST_STEP`. The passages for a group begin that many words apart and are twice as
long, so an item that a document holds lies whole in at least one of them, and what is
found of an item hangs on no other item's length. What is retrieved is then verified:
enough of the three-word runs of the item's question and of its answer must lie in
the passage. The last line of an item is its answer; without one, its last sentence;
without one, its last third.

The index is made by Spark tasks in shards of items of one group, about `SHARD_POSTINGS`
postings and `SHARD_ITEMS` items each, and stored as a table in the shared folder.
`PASS_SHARDS` shards at a time go to all tasks and are matched with all documents in one
pass, whose result is written before the next one begins: a larger benchmark takes more
passes, and neither the driver nor a task ever holds more than the shards of one pass.
Words are runs of letters and digits, lower-cased.

Defined results: null or empty texts of documents or items match nothing; items
without a word are left out; items with equal texts are each reported. Different texts
under one item_id are entries of their own, searched and verified each; the best of them
counts for the id. Both sides of an item have words, so a last line of signs alone is no
answer; an item of one word is an answer without a question. Rows with the same doc_id
are reported once per item with the best of their scores. Rows with null doc_id or
item_id are left out. An item longer than a shard is a shard with what else falls there.
Other columns are not read.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import textops
from tickerloom.llm.common import rows, saved
from tickerloom.sources.workspace import materialise, shared_folder

K1, B = 1.2, 0.75
BLOCK_ITEMS = 4
SHARD_POSTINGS, SHARD_ITEMS = 50_000, 2_000
PASS_SHARDS = 8
LEAST_STEP = 32
RUN = 3
RESULT = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def question_and_answer(text: str) -> tuple[str, str]:
    body = text.strip()
    spoken = [m.span() for m in re.finditer(r"\w*[^\W_]\w*", body)]
    for end in (r"\n", r"[.!?](?=\s)"):
        cuts = [m.end() for m in re.finditer(end, body)
                if spoken and spoken[0][1] <= m.end() <= spoken[-1][0]]
        if cuts:
            return body[:cuts[-1]], body[cuts[-1]:]
    words = [body[a:b] for a, b in spoken]
    at = len(words) - max(1, len(words) // 3)
    return " ".join(words[:at]), " ".join(words[at:])


def _words(text: str) -> np.ndarray:
    return textops.word_hashes([text.lower().encode()], textops.MARKS, lower=False)[0]


@dataclass(frozen=True)
class Shard:
    """Some items and their postings; what the search needs is laid out where it runs."""

    item_ids: np.ndarray       # of each entry
    vocabulary: np.ndarray     # sorted term hashes
    term: np.ndarray           # of each posting, its place in the vocabulary
    item: np.ndarray           # of each posting, its entry's place
    impact: np.ndarray         # of each posting; those of an entry sum to 1
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    step: int                  # words from one passage to the next

    @cached_property
    def maxima(self) -> np.ndarray:
        """terms x blocks: the largest impact."""
        found = np.zeros((len(self.vocabulary), -(-len(self.item_ids) // BLOCK_ITEMS)),
                         dtype=np.float32)
        np.maximum.at(found, (self.term, self.item // BLOCK_ITEMS), np.nextafter(
            self.impact.astype(np.float32), np.float32(2)))
        return found

    @cached_property
    def postings(self) -> list[dict[int, tuple[list[int], list[float]]]]:
        """block -> term -> items, impacts"""
        order = np.lexsort((self.item, self.term, self.item // BLOCK_ITEMS))
        item, term, impact = self.item[order], self.term[order], self.impact[order]
        block = item // BLOCK_ITEMS
        change = (np.diff(block) != 0) | (np.diff(term) != 0)
        begin = np.concatenate(([0], np.flatnonzero(change) + 1)) if len(item) else []
        found: list[dict[int, tuple[list[int], list[float]]]] = [
            {} for _ in range(-(-len(self.item_ids) // BLOCK_ITEMS))]
        for lo, hi in zip(begin, [*begin[1:], len(item)], strict=True):
            found[block[lo]][int(term[lo])] = item[lo:hi].tolist(), impact[lo:hi].tolist()
        return found

    def search(self, terms: np.ndarray, starts: np.ndarray, threshold: float
               ) -> Iterator[tuple[int, int, float]]:
        """(passage, item, score) from `threshold` on; passage p has the distinct
        terms[starts[p]:starts[p + 1]]."""
        filled = np.flatnonzero(np.diff(starts))
        if not len(filled):
            return
        opened = []
        for left in range(0, self.maxima.shape[1], 16):   # a few blocks at a time
            bounds = np.add.reduceat(
                self.maxima[:, left:left + 16][terms], starts[filled], axis=0)
            row, block = np.nonzero(bounds >= threshold)
            opened.extend(zip(row, block + left, strict=True))
        for row, block in sorted(opened):
            passage = filled[row]
            own = terms[starts[passage]:starts[passage + 1]]
            upper = self.maxima[own, block]
            order = np.argsort(-upper)
            rest = float(upper.sum())
            scores: dict[int, float] = {}
            for k in order:
                if upper[k] == 0:
                    break
                fresh = rest >= threshold
                for item, impact in zip(*self.postings[block][own[k]], strict=True):
                    if fresh or item in scores:
                        scores[item] = scores.get(item, 0.0) + impact
                rest -= float(upper[k])
            for item, value in scores.items():
                if value >= threshold - 1e-6:
                    yield passage, item, min(float(value), 1.0)


def step_of(words: int) -> int:
    """Distance of the passages in which an item of so many words is looked for."""
    return max(LEAST_STEP, 1 << (words - 1).bit_length())


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for entry, text in rows(batches, "entry", "text"):
        kinds, counts = np.unique(_words(text), return_counts=True)
        if len(kinds):
            words = int(counts.sum())
            yield pa.record_batch({
                "entry": pa.array([entry] * len(kinds), pa.int64()),
                "term": pa.array(textops.signed(kinds)),
                "tf": pa.array(counts, pa.int64()),
                "words": pa.array([words] * len(kinds), pa.int64()),
                "step": pa.array([step_of(words)] * len(kinds), pa.int64()),
            })


def stored_shards(benchmark: DataFrame) -> tuple[DataFrame, list[int]] | None:
    """Rows (number, payload) of all shards in the shared folder, and the numbers; None
    for a benchmark without words. Frequencies of terms count all its items."""
    items = (benchmark.select(F.col("item_id").cast("long"), "text")
             .where("item_id is not null and text is not null").distinct()
             .withColumn("entry", F.xxhash64("item_id", "text")))
    counted = saved(items.mapInArrow(
        _terms_of, "entry long, term long, tf long, words long, step long"), "postings")
    # steps are powers of two, so these are a few rows
    groups = counted.groupBy("step").agg(
        F.count("*").alias("postings"), F.sum("tf").alias("words"),
        F.countDistinct("entry").alias("items")).orderBy("step").collect()
    n = sum(g["items"] for g in groups)
    if not n:
        return None
    mean = sum(g["words"] for g in groups) / n
    number, shards = F.lit(None).cast("long"), 0
    for g in groups:
        parts = max(-(-g["postings"] // SHARD_POSTINGS), -(-g["items"] // SHARD_ITEMS))
        number = F.when(F.col("step") == g["step"],
                        shards + F.pmod("entry", F.lit(parts))).otherwise(number)
        shards += parts
    frequency = counted.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    impact = idf * F.col("tf") * (K1 + 1) / (
        F.col("tf") + K1 * (1 - B + B * F.col("words") / mean))
    # the terms of one item are as long as the item
    entries = counted.join(frequency, "term").groupBy("entry", "step").agg(
        F.collect_list(F.struct("term", impact.alias("impact"))).alias("postings"))
    built = (entries.join(items, "entry")
             .select(number.alias("number"), "entry", "step", "item_id", "text",
                     "postings.term", "postings.impact")
             .groupBy("number").applyInArrow(_packed, "number long, payload binary"))
    return saved(built, "shards"), list(range(shards))


def _packed(entries: pa.Table) -> pa.Table:
    """One row: the shard of the entries."""
    held = sorted(entries.drop_columns(["number"]).to_pylist(), key=lambda r: r["entry"])
    sizes = [len(r["term"]) for r in held]
    terms = np.concatenate([np.array(r["term"], dtype=np.int64) for r in held]).view(np.uint64)
    impacts = np.concatenate([np.array(r["impact"]) for r in held])
    item = np.repeat(np.arange(len(held)), sizes)
    vocabulary, term = np.unique(terms, return_inverse=True)
    sides = [question_and_answer(r["text"]) for r in held]
    shard = Shard(
        np.array([r["item_id"] for r in held], dtype=np.int64), vocabulary, term, item,
        impacts / np.bincount(item, impacts)[item],
        [textops.shingles(_words(q), RUN) for q, _ in sides],
        [textops.shingles(_words(a), RUN) for _, a in sides],
        held[0]["step"])
    return pa.table({"number": entries.column("number").slice(0, 1),
                     "payload": pa.array([pickle.dumps(shard)], pa.binary())})


def passes(benchmark: DataFrame) -> Iterator[list[Shard]]:
    """The shards of one pass after the other; no more than these are ever fetched."""
    stored = stored_shards(benchmark)
    if stored is None:
        return
    table, numbers = stored
    for at in range(0, len(numbers), PASS_SHARDS):
        found = table.where(F.col("number").between(
            numbers[at], numbers[min(at + PASS_SHARDS, len(numbers)) - 1]))
        yield [pickle.loads(r["payload"])    # written by a task of this job
               for r in found.orderBy("number").select("payload").collect()]


def build_shards(benchmark: DataFrame) -> Iterator[Shard]:
    """Shards over the whole benchmark, one after the other."""
    for shards in passes(benchmark):
        yield from shards


def _overlap(part: np.ndarray, passage: np.ndarray) -> float:
    """Share of the part's word runs that the passage has."""
    return float(np.isin(part, passage).mean()) if len(part) else 1.0


def _passages(words: np.ndarray, firsts: np.ndarray, shard: Shard
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping passages of each text, (owner, begin, end) as ranges of words, and
    their distinct terms in the shard's vocabulary with where each passage's begin."""
    texts = np.flatnonzero(np.diff(firsts))
    lengths = np.diff(firsts)[texts]
    each = np.maximum(-(-(lengths - shard.step) // shard.step), 1)
    owner = np.repeat(texts, each)
    nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    begin = firsts[owner] + nth * shard.step
    end = np.minimum(begin + 2 * shard.step, firsts[owner + 1])
    at = np.minimum(np.searchsorted(shard.vocabulary, words), len(shard.vocabulary) - 1)
    place = np.flatnonzero(shard.vocabulary[at] == words)
    lo, hi = np.searchsorted(place, begin), np.searchsorted(place, end)
    count = hi - lo
    passage = np.repeat(np.arange(len(begin)), count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    term = at[place[np.repeat(lo, count) + inside]]
    pairs = np.unique(passage * len(shard.vocabulary) + term)
    held, terms = np.divmod(pairs, len(shard.vocabulary))
    return owner, begin, end, terms, np.searchsorted(held, np.arange(len(begin) + 1))


def matches(docs: DataFrame, shards: list[Shard], threshold: float, least_overlap: float
            ) -> DataFrame:
    """Verified (document, item) rows of some shards; a row per passage and item."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in textops.chunks(rows(batches, "doc_id", "text")):
            words, firsts = textops.word_hashes(texts, textops.MARKS, lower=False)
            if not len(words):
                continue
            out: list[tuple] = []
            for shard in shards:
                owner, begin, end, terms, starts = _passages(words, firsts, shard)
                shown: dict[int, np.ndarray] = {}
                for p, item, value in shard.search(terms, starts, threshold):
                    own = words[begin[p]:end[p]]
                    if p not in shown:
                        shown = {p: textops.shingles(own, RUN)}
                    question, answer = (
                        _overlap(part, _with_short(shown[p], own, part))
                        for part in (shard.questions[item], shard.answers[item]))
                    if question >= least_overlap and answer >= least_overlap:
                        out.append((keys[owner[p]], int(shard.item_ids[item]), value,
                                    question, answer))
            if out:
                yield pa.record_batch(
                    [pa.array([r[i] for r in out], pa.int64() if i < 2 else pa.float64())
                     for i in range(5)],
                    names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    lowered = docs.select(F.col("doc_id").cast("long"),
                          F.lower("text").cast("binary").alias("text"))
    return lowered.where("doc_id is not null").mapInArrow(found, RESULT)


def _with_short(runs: np.ndarray, words: np.ndarray, part: np.ndarray) -> np.ndarray:
    """The passage's runs; for a part of one run also its runs of fewer words, for the
    part may be shorter than a run."""
    if len(part) != 1:
        return runs
    return np.concatenate([runs, *(textops.shingles(words, n) for n in range(1, RUN))])


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6,
                 least_overlap: float = 0.6) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): the items that a
    document holds, each with the figures of its best passage."""
    spark = docs.sparkSession
    folder, done = shared_folder(spark, "decontaminated"), 0
    for shards in passes(benchmark):
        materialise(matches(docs, shards, threshold, least_overlap), f"{folder}/pass={done}")
        done += 1
    found = spark.read.schema(RESULT).parquet(folder) if done else spark.createDataFrame([], RESULT)
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")
