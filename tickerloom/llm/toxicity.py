"""Toxicity by multiple-instance learning: documents are labelled, sentences scored.

A sentence has probability s = logistic(bias + sum of the weights of its features);
a document is toxic if any sentence is: P = 1 - product of (1 - s), the noisy-or.
Weights are learned from document labels alone by gradient ascent on the likelihood
of P, so the trained model also says which sentences give offence.

Features are lower-cased words and word beginnings of four to six letters that are
clearly more frequent in toxic than in other documents of the sample; their number
is bounded by `vocabulary`. Each gradient step is a Spark job over the stored bags of
the sample and returns one number per feature. The sample is bounded by `at_most`
labelled documents (see `label_sample`); scoring covers every whole text.

Null and empty texts have no sentence and score 0. Repeated rows are scored each;
rows with null doc_id are scored and never learned from. Without labels of both
kinds no feature is chosen and every score is 0. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import label_sample, remainder, rows, saved

SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)


def features_of(words: set[str]) -> set[str]:
    """Words and, marked by a star, their beginnings."""
    found = set(words)
    for n in BEGINNINGS:
        found.update(w[:n] + "*" for w in words if len(w) >= n)
    return found


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    bias: float

    def sentence_probability(self, sentence: str) -> float:
        own = features_of(set(WORD.findall(sentence.lower())))
        return logistic(self.bias + sum(self.weights[f] for f in own if f in self.weights))

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, probability) of every sentence that has a word."""
        return [(m.start(), m.end(), self.sentence_probability(m[0]))
                for m in SENTENCE.finditer(text) if WORD.search(m[0])]

    def score(self, text: str) -> float:
        if not self.weights:
            return 0.0
        words = set(WORD.findall(text.lower()))
        if not features_of(words) & self.weights.keys():
            count = sum(1 for m in SENTENCE.finditer(text) if WORD.search(m[0]))
            return -math.expm1(count * math.log1p(-logistic(self.bias)))
        return -math.expm1(sum(math.log1p(-min(p, 1 - 1e-12))
                               for _, _, p in self.sentences(text)))


def logistic(z: float) -> float:
    return 1 / (1 + math.exp(-max(min(z, 40.0), -40.0)))


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task with each feature, by label; sent on in bounded pieces."""
    held: dict[int, Counter] = {0: Counter(), 1: Counter()}

    def out() -> pa.RecordBatch:
        found = [(f, y, n) for y, c in held.items() for f, n in c.items()]
        for c in held.values():
            c.clear()
        return pa.record_batch({
            "feature": pa.array([f for f, _, _ in found], pa.string()),
            "label": pa.array([y for _, y, _ in found], pa.int32()),
            "n": pa.array([n for _, _, n in found], pa.int64()),
        })

    for text, label in rows(batches, "text", "label"):
        held[label].update(features_of(set(WORD.findall((text or "").lower()))))
        if len(held[0]) + len(held[1]) > 200_000:
            yield out()
    yield out()


def choose_features(sample: DataFrame, vocabulary: int = 4096, least: int = 3,
                    ratio: float = 3.0) -> dict[str, float]:
    """Features of toxic documents with their log odds, less one standard error: at
    least `least` toxic documents have it, and these odds reach log(`ratio`). A word
    that a few toxic documents happen to share is thus worth little, or left out.
    """
    totals = {r["label"]: r["n"] for r in
              sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return {}
    counts = (sample.select("text", "label").mapInArrow(
        _feature_counts, "feature string, label int, n long")
        .groupBy("feature").agg(
            F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
            F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("other")))
    toxic, other = F.col("toxic") + 0.5, F.col("other") + 0.5
    odds = F.log(toxic / (totals[1] + 1)) - F.log(other / (totals[0] + 1))
    chosen = (counts.withColumn("odds", odds - F.sqrt(1 / toxic + 1 / other))
              .where((F.col("toxic") >= least) & (F.col("odds") >= math.log(ratio)))
              .orderBy((F.col("odds") * F.col("toxic")).desc(), "feature").limit(vocabulary))
    return {r["feature"]: r["odds"] for r in chosen.collect()}


def _bags(sample: DataFrame, index: dict[str, int]) -> DataFrame:
    """Per document: label, number of sentences without features, and the features
    of each other sentence as one list with the sentence lengths beside it."""

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, list[int], list[int]]] = []
        for text, label in rows(batches, "text", "label"):
            plain, lengths, members = 0, [], []
            for m in SENTENCE.finditer(text or ""):
                words = set(WORD.findall(m[0].lower()))
                own = [index[f] for f in features_of(words) if f in index]
                if own:
                    lengths.append(len(own))
                    members.extend(own)
                elif words:
                    plain += 1
            out.append((label, plain, lengths, members))
        yield pa.record_batch({
            "label": pa.array([r[0] for r in out], pa.int32()),
            "plain": pa.array([r[1] for r in out], pa.int32()),
            "lengths": pa.array([r[2] for r in out], pa.list_(pa.int32())),
            "members": pa.array([r[3] for r in out], pa.list_(pa.int32())),
        })

    return saved(sample.select("text", "label").mapInArrow(
        bag, "label int, plain int, lengths array<int>, members array<int>"), "toxicity-bags")


def _gradient(bags: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Gradient of the log likelihood at `weights` (the bias comes last)."""

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(weights))
        for label, plain, lengths, members in rows(batches, "label", "plain", "lengths",
                                                   "members"):
            members = np.asarray(members, dtype=np.int64)
            of = np.repeat(np.arange(len(lengths)), lengths)
            z = np.bincount(of, weights[members], len(lengths)) + weights[-1]
            s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            rest = logistic(weights[-1])
            none = np.log1p(-np.minimum(s, 1 - 1e-12)).sum() + plain * math.log1p(-rest)
            p = max(-math.expm1(none), 1e-12)
            pull = (1 - p) / p if label else -1.0
            np.add.at(total, members, pull * s[of])
            total[-1] += pull * (s.sum() + plain * rest)
        at = np.flatnonzero(total)
        yield pa.record_batch({"at": pa.array(at, pa.int32()), "value": pa.array(total[at])})

    summed = np.zeros(len(weights))
    for row in (bags.mapInArrow(steps, "at int, value double")
                .groupBy("at").agg(F.sum("value").alias("value")).collect()):
        summed[row["at"]] = row["value"]
    return summed


def fit(sample: DataFrame, vocabulary: int = 4096, steps: int = 12,
        penalty: float = 0.3) -> ToxicityModel:
    """Noisy-or weights from (text, label), by resilient gradient steps."""
    start = choose_features(sample, vocabulary)
    if not start:
        return ToxicityModel({}, 0.0)
    names = sorted(start)
    bags = _bags(sample, {f: i for i, f in enumerate(names)})
    weights = np.array([start[f] for f in names] + [-9.0])
    prior = weights.copy()
    pace, before = np.full(len(weights), 0.5), np.zeros(len(weights))
    for _ in range(steps):
        slope = _gradient(bags, weights) - penalty * (weights - prior)
        turn = np.sign(slope) * np.sign(before)
        pace = np.clip(np.where(turn > 0, pace * 1.2, np.where(turn < 0, pace * 0.5, pace)),
                       1e-3, 2.0)
        weights = weights + pace * np.sign(slope)
        before = slope
    return ToxicityModel(dict(zip(names, weights[:-1].tolist(), strict=True)),
                         float(weights[-1]))


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """doc_id, score and predicted (1 from `threshold` on) of every row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [model.score(t or "") for (t,) in rows(iter([batch]), "text")]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "score": pa.array(values, pa.float64()),
                "predicted": pa.array([int(v >= threshold) for v in values], pa.int32()),
            })

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        scored, "doc_id long, score double, predicted int")


def offending_sentences(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5
                        ) -> DataFrame:
    """doc_id, start, end (code points), probability and text of sentences from
    `threshold` on."""

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(key, a, b, p, text[a:b])
                     for key, text in rows(iter([batch]), "doc_id", "text") if text
                     for a, b, p in model.sentences(text) if p >= threshold and model.weights]
            yield pa.record_batch([
                pa.array([r[i] for r in found], kind) for i, kind in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string()))
            ], names=["doc_id", "start", "end", "probability", "sentence"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        located, "doc_id long, start long, end long, probability double, sentence string")


def learn(docs: DataFrame, labels: DataFrame, divisor: int = 3, kept_out: int = 1,
          at_most: int = 20_000, vocabulary: int = 4096) -> ToxicityModel:
    """A model from `labels.toxic` outside the held-out rows, `at_most` of them."""
    known = F.broadcast(label_sample(labels, "toxic", divisor, kept_out, at_most))
    sample = saved(docs.select("doc_id", "text").join(known, "doc_id").select("text", "label"),
                   "toxicity-sample")
    return fit(sample, vocabulary)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, divisor: int = 3,
             kept_out: int = 1, at_most: int = 20_000) -> DataFrame:
    """Score all of `docs`; doc_id, held_out, score, predicted."""
    model = learn(docs, labels, divisor, kept_out, at_most)
    held_out = F.coalesce(remainder("doc_id", divisor) == kept_out, F.lit(False))
    return score(docs, model, threshold).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")
