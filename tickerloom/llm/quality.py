"""Quality classifier: regularised quadratic discriminant over document statistics.

Every text becomes a short vector of transformed statistics (lengths, character
classes, repetition, the latter damped in short texts). Each class has a mean and a covariance over the labelled
vectors, shrunk towards its own diagonal and the pooled diagonal; the score is the
logistic of the difference of the two log densities plus the log odds of the
classes. Moments are sums, so they need one distributed pass over all labelled
rows; only they (a few hundred numbers) reach the driver, which keeps the inverse
of each Cholesky factor for all rows to come.

Null and empty texts have the vector of an empty text and are scored like others.
Repeated rows are scored each, and the least of their vectors is learned from; a null
doc_id is scored, is not held out and is never learned from. Without labelled rows of both classes every score is the share
of label 1 (0.5 without labels). Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import textops
from tickerloom.llm.common import label_sample, remainder, rows, saved

#: Character classes counted as shares of all bytes.
CLASSES = {
    "upper": range(0x41, 0x5B),
    "digit": range(0x30, 0x3A),
    "stop": b".,;:",
    "shout": b"!?",
    "mark": b"#$%&*+=<>@^~\\/",
    "bar": b"|{}[]_",
    "quote": b"\"'()-",
    "space": b" \t",
}
N_FEATURES = len(CLASSES) + 9
SCHEMA = "doc_id long, features array<double>"


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between offsets; empty stretches give 0."""
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of transformed statistics per text."""
    data, offsets = textops.joined(texts)
    lower = textops.LOWER[data]
    sums = textops.prefix_hashes(lower)
    starts, ends = textops.word_bounds(lower)
    words = textops.stretch_hashes(sums, starts, ends)
    firsts = np.searchsorted(starts, offsets)
    line_breaks = np.flatnonzero((data == 10) | np.isin(
        np.arange(len(data)), offsets[1:] - 1))
    line_starts = np.concatenate(([0], line_breaks[:-1] + 1)).astype(np.int64)
    lines = textops.stretch_hashes(sums, line_starts, line_breaks)
    filled = line_breaks > line_starts
    first_lines = np.searchsorted(line_starts, offsets)
    size = np.maximum(np.diff(offsets) - 1, 1).astype(float)
    out = np.zeros((len(texts), N_FEATURES))
    for j, members in enumerate(CLASSES.values()):
        table = np.zeros(256, dtype=np.int8)
        table[list(members)] = 1
        out[:, j] = np.sqrt(_per_text(table[data], offsets) / size)
    out[:, 7] = np.sqrt(np.maximum(out[:, 7] ** 2 - 1 / (size + 1), 0))  # the joining space
    lengths = ends - starts
    n_words = np.diff(firsts)
    at = len(CLASSES)
    safe = np.maximum(n_words, 1)
    out[:, at] = np.log1p(n_words)
    out[:, at + 1] = np.log1p(_per_text(lengths, firsts) / safe)
    spread = _per_text(lengths * lengths, firsts) / safe - (_per_text(lengths, firsts) / safe) ** 2
    out[:, at + 2] = np.log1p(np.sqrt(np.maximum(spread, 0)))
    for i in range(len(texts)):
        own = words[firsts[i]:firsts[i + 1]]
        if len(own):
            kinds, counts = np.unique(own, return_counts=True)
            out[i, at + 3] = np.log(len(kinds) + 10) / np.log(len(own) + 10)
            out[i, at + 4] = np.sqrt(counts.max() / (len(own) + 20))
            pairs = textops.shingles(own, 2)
            out[i, at + 5] = np.sqrt(max(len(own) - 1 - len(pairs), 0) / (len(own) + 50))
        mine = slice(first_lines[i], first_lines[i + 1])
        own_lines = lines[mine][filled[mine]]
        out[i, at + 6] = np.log1p(len(own_lines))
        if len(own_lines):
            out[i, at + 7] = np.sqrt(
                (len(own_lines) - len(np.unique(own_lines))) / (len(own_lines) + 10))
            out[i, at + 8] = np.log1p(n_words[i] / len(own_lines))
    return out


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, texts in textops.chunks(rows(batches, "doc_id", "text")):
        yield pa.record_batch({
            "doc_id": pa.array(keys, pa.int64()),
            "features": pa.array(list(statistics(texts)), pa.list_(pa.float64())),
        })


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the vector of statistics of each whole text."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")
                       ).mapInArrow(_feature_rows, SCHEMA)


@dataclass(frozen=True)
class Discriminant:
    """Per class: mean, inverse Cholesky factor, log determinant; and the log odds."""

    means: tuple[np.ndarray, np.ndarray] | None
    factors: tuple[np.ndarray, np.ndarray] | None
    log_dets: tuple[float, float]
    log_odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            margin = np.full(len(x), self.log_odds)
        else:
            density = [
                -0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) - 0.5 * d
                for m, f, d in zip(self.means, self.factors, self.log_dets, strict=True)]
            margin = density[1] - density[0] + self.log_odds
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def _moment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of 1, x and x times x of a task's rows, per label."""
    d = N_FEATURES
    sums = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    for batch in batches:
        labels = np.asarray(batch.column("label").to_pylist())
        x = np.asarray(batch.column("features").to_pylist()).reshape(len(labels), d)
        for label, held in sums.items():
            own = x[labels == label]
            held += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
    for label, held in sums.items():
        yield pa.record_batch({
            "label": pa.array([label] * len(held), pa.int32()),
            "at": pa.array(range(len(held)), pa.int32()),
            "value": pa.array(held),
        })


def fit(labelled: DataFrame, shrinkage: float = 0.2, to_diagonal: float = 0.3) -> Discriminant:
    """From (features, label): covariances are (1 - shrinkage) of the class's own,
    its off-diagonal part weakened by `to_diagonal`, plus `shrinkage` of the pooled
    diagonal."""
    d = N_FEATURES
    found = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    moments = labelled.select("features", "label").mapInArrow(
        _moment_rows, "label int, at int, value double")
    for row in moments.groupBy("label", "at").agg(F.sum("value").alias("value")).collect():
        found[row["label"]][row["at"]] = row["value"]
    n = [found[k][0] for k in (0, 1)]
    odds = float(np.log((n[1] + 1) / (n[0] + 1)))
    if min(n) < 2:
        return Discriminant(None, None, (0.0, 0.0), odds)
    means, covariances = [], []
    for k in (0, 1):
        mean = found[k][1:1 + d] / n[k]
        means.append(mean)
        covariances.append(found[k][1 + d:].reshape(d, d) / n[k] - np.outer(mean, mean))
    pooled = np.diag(sum(c * m for c, m in zip(covariances, n, strict=True))) / sum(n) + 1e-4
    factors, log_dets = [], []
    for c in covariances:
        own = np.diag(np.diag(c))
        c = (1 - shrinkage) * ((1 - to_diagonal) * c + to_diagonal * own)
        lower = np.linalg.cholesky(c + shrinkage * np.diag(pooled))
        factors.append(np.linalg.inv(lower))
        log_dets.append(float(2 * np.log(np.diag(lower)).sum()))
    return Discriminant(tuple(means), tuple(factors), tuple(log_dets), odds)


def score(features: DataFrame, model: Discriminant, threshold: float = 0.7) -> DataFrame:
    """doc_id, score and predicted (1 from `threshold` on) of each row of statistics."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.asarray(batch.column("features").to_pylist())
            values = model.score(x)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "score": pa.array(values),
                "predicted": pa.array((values >= threshold).astype(np.int32)),
            })

    return features.mapInArrow(scored, "doc_id long, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, divisor: int = 4,
             kept_out: int = 2, at_most: int = 1_000_000) -> DataFrame:
    """Score all of `docs`, learning from `labels.quality` outside the held-out rows."""
    features = saved(document_statistics(docs), "quality-statistics")
    known = label_sample(labels, "quality", divisor, kept_out, at_most)
    model = fit(features.join(known, "doc_id").groupBy("doc_id", "label").agg(
        F.min("features").alias("features")))
    held_out = F.coalesce(remainder("doc_id", divisor) == kept_out, F.lit(False))
    return score(features, model, threshold).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")
