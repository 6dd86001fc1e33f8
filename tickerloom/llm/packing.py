"""Packing of tokenised documents into as few sequences as possible.

Documents become pieces of at most `capacity` tokens. Only the histogram of piece
lengths, at most one row for each length, decides the packing. Its configuration program
has a column for each multiset of lengths that fits a sequence, and is solved by
multiplicative weights: a length's price is its size times a weight that grows while its
columns are poor and falls as it is covered beyond need. A knapsack table over these
prices gives the best column and, walked back in other ways, columns nearly as good. The
fractions found are rounded to whole sequences; what that leaves is packed by best fit.

The plan is a list of columns with the number of sequences each is used for. A piece finds
its sequence by its rank among the pieces of its length, so the table is ranked once and
joined with nothing; a length that a third of all pieces have is ranked in many tasks.

Defined results: a null text is empty, and an empty text is the closing id alone. Equal
rows and rows with one doc_id, null included, are documents of their own. An empty table
gives no pieces. Very long texts are cut into many pieces. Other columns change nothing.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import rows, saved
from tickerloom.llm.ranks import ranked

WORDS = 800_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of texts as little-endian bytes, remembering the ids of words.

    White space is never part of a token, and neither lower case nor composition reach
    across it, so a text is encoded word by word. Most new words are Latin letters and
    perhaps stops: they go to the model directly, the others through all of the tokenizer,
    as does a whole text with a special token.
    """

    SIMPLE = re.compile("([a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?)\"]*)")

    def __init__(self, path: str, at_most: int = WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.encode().lower() for t in added]
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xdf, 0x100)}
        self.known: dict[bytes, bytes] = {}
        self.at_most = at_most

    def _whole(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()

    def _learn(self, word: bytes) -> None:
        text = word.decode()
        simple = self.SIMPLE.fullmatch(text)
        if not simple:
            self.known[word] = self._whole(text)
            return
        letters, stops = simple.groups()
        if not letters.isascii():
            letters = letters.lower().translate(self.letters)
        model = self.tokenizer.model.tokenize(letters)
        ids = struct.pack(f"<{len(model)}I", *[t.id for t in model])
        if stops:
            end = stops.encode()
            if end not in self.known:
                self.known[end] = self._whole(stops)
            ids += self.known[end]
        self.known[word] = ids

    def __call__(self, text: str) -> bytes:
        lower = text.encode().lower()  # A-Z alone
        if any(s in lower for s in self.special):
            return self._whole(text)
        words = lower.split()  # at ASCII white space
        if len(self.known) > self.at_most:
            self.known.clear()
        known = self.known
        for word in [w for w in words if w not in known]:
            if word not in known:
                self._learn(word)
        return b"".join(map(known.__getitem__, words))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process, which serves many tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, path: str, capacity: int, closing_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        end = np.array([closing_id], "<u4").tobytes()
        for batch in batches:
            found: list[tuple] = []
            for doc_id, text in rows(iter([batch]), "doc_id", "text"):
                ids = encode(text or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    found.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            columns = list(zip(*found, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            yield pa.record_batch({n: pa.array(c, k)
                                   for n, c, k in zip(names, columns, kinds, strict=True)})

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


@dataclass
class Plan:
    """Columns as ((length, copies), ...) with the sequences each fills, and a number of
    sequences that no packing can stay below."""

    columns: list[tuple[tuple[tuple[int, int], ...], int]] = field(default_factory=list)
    bound: int = 0

    @property
    def sequences(self) -> int:
        return sum(times for _, times in self.columns)


def knapsack(price: np.ndarray, capacity: int) -> np.ndarray:
    """The most that lengths of the given prices are worth within each capacity."""
    best = np.zeros(capacity + 1)
    for room in range(1, capacity + 1):
        best[room] = max(best[room - 1], (best[room - 1::-1] + price[1:room + 1]).max())
    return best


Column = tuple[tuple[int, int], ...]


def _column(longest: int, short: np.ndarray, price: np.ndarray, best: np.ndarray,
            slack: float) -> Column:
    """`longest` and what fills its sequence: a walk through the knapsack table that keeps
    within `slack` of the best worth and of such steps takes the length whose demand
    falls `short` by most; a length that is not short is not taken."""
    copies = {longest: 1}
    room = len(best) - 1 - longest
    least = best[room] - slack * best[-1]
    lengths = np.flatnonzero(short > 0)
    while room:
        lengths = lengths[:np.searchsorted(lengths, room, side="right")]
        if not len(lengths):
            break
        worth = best[room - lengths] + price[lengths]
        good = lengths[worth >= least]
        taken = int(good[(short[good] * good).argmax()] if len(good) else lengths[worth.argmax()])
        copies[taken] = copies.get(taken, 0) + 1
        room -= taken
        least -= price[taken]
    return tuple(sorted(copies.items(), reverse=True))


def relaxed(asked: np.ndarray, rounds: int, kept: int, learn: float, rate: float,
            slack: float) -> tuple[dict[Column, float], int]:
    """Columns with the fractions of sequences that cover about `asked`, and a bound.

    In round t every length is brought to be covered t times over, longest first, by
    columns that hold it and are nearly as good as the best under the round's prices. A
    price is the size times a weight. The weight grows by e^(learn * loss) where a length's
    columns stay short of the best column's worth by the share `loss`, and falls by
    e^-rate for each time that the length was covered beyond the round. The `kept` last
    rounds, whose prices have settled, are averaged.
    """
    capacity = len(asked) - 1
    sizes = np.arange(capacity + 1)
    some = asked > 0
    covered, weight = np.zeros(capacity + 1), np.zeros(capacity + 1)
    found: dict[Column, float] = {}
    bound = -(-int(asked @ sizes) // capacity)
    for step in range(1, rounds + 1):
        price = np.where(some, sizes * np.exp(weight - rate * (covered - step + 1)), 0.0)
        best = knapsack(price, capacity)
        # Prices over the worth of the best column are feasible in the dual program.
        bound = max(bound, int(np.ceil(float(asked @ price) / best[-1] - 1e-6)))
        for length in np.flatnonzero(some)[::-1].tolist():
            while covered[length] < step - 1e-9:
                short = np.where(some, step + 1 - covered, 0.0)
                short[short < 1e-9] = 0.0
                column = _column(length, short, price, best, slack)
                own = dict(column)[length]
                times = min([(step + 1 - covered[n]) * asked[n] / c for n, c in column]
                            + [(step - covered[length]) * asked[length] / own])
                loss = 1 - sum(price[n] * c for n, c in column) / best[-1]
                weight[length] += learn * loss * times * own / asked[length]
                for n, c in column:
                    covered[n] += times * c / asked[n]
                if step > rounds - kept:
                    found[column] = found.get(column, 0.0) + times
    return {column: times / kept for column, times in found.items()}, bound


def _best_fit(left: np.ndarray, plan: dict[Column, int]) -> None:
    """Add the pieces `left` to `plan`, longest first, each where least room remains.
    Sequences with the same content are handled together."""
    capacity = len(left) - 1
    open_at: dict[int, dict[Column, int]] = {}
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            room = min((r for r in open_at if r >= length), default=capacity)
            if room in open_at:
                column, times = open_at[room].popitem()
                if not open_at[room]:
                    del open_at[room]
                if times > n:
                    open_at.setdefault(room, {})[column] = times - n
                    times = n
                copies = 1
            else:
                # New sequences take the length alone, as often as it fits.
                column = ()
                copies = min(capacity // length, n)
                times = n // copies
            n -= times * copies
            grown = dict(column)
            grown[length] = grown.get(length, 0) + copies
            made = tuple(sorted(grown.items(), reverse=True))
            same = open_at.setdefault(room - copies * length, {})
            same[made] = same.get(made, 0) + times
    for same in open_at.values():
        for column, times in same.items():
            plan[column] = plan.get(column, 0) + times


def solve(histogram: dict[int, int], capacity: int, rounds: int = 32, kept: int = 12,
          learn: float = 0.3, rate: float = 0.1, slack: float = 0.002) -> Plan:
    """Sequences for `histogram` (length: pieces); work and plan grow with `capacity`
    and `rounds`, not with the number of pieces.

    The fractions of the relaxed program are rounded along their running sum, so that
    every stretch of columns keeps its share, and a column is used no more often than
    its pieces last. What is left is packed by best fit.
    """
    asked = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        asked[length] = n
    if not asked.any():
        return Plan()
    fractions, bound = relaxed(asked, rounds, kept, learn, rate, slack)
    left = asked.copy()
    plan: dict[Column, int] = {}
    sum_so_far = 0.0
    for column, fraction in fractions.items():
        whole = int(sum_so_far + fraction) - int(sum_so_far)
        sum_so_far += fraction
        times = min([whole] + [int(left[n]) // c for n, c in column])
        if times:
            plan[column] = times
            for n, c in column:
                left[n] -= c * times
    _best_fit(left, plan)
    return Plan(list(plan.items()), bound)


def _places(plan: Plan) -> dict[str, np.ndarray]:
    """For each length and first rank: copies a sequence, first sequence, first offset."""
    entries = []
    rank: dict[int, int] = {}
    first = 0
    for column, times in plan.columns:
        offset = 0
        for length, copies in column:
            at = rank.get(length, 0)
            entries.append((length << 48 | at, at, copies, first, offset))
            rank[length] = at + copies * times
            offset += length * copies
        first += times
    table = np.array(sorted(entries), np.int64).reshape(-1, 5)
    return dict(zip(("key", "rank", "copies", "first", "offset"), table.T, strict=True))


def pack(docs: DataFrame, path: str, capacity: int = 2048, closing_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    A document is its ids and `closing_id`; one longer than `capacity` is cut into pieces
    of that length. Sequences have no gaps.
    """
    cut = saved(pieces(docs, path, capacity, closing_id), "pieces")
    histogram = {r["length"]: r["n"] for r in
                 cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = _places(solve(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = np.asarray(batch.column("length"))
            rank = np.asarray(batch.column("position"))
            at = np.searchsorted(places["key"], length << 48 | rank, side="right") - 1
            within = rank - places["rank"][at]
            yield pa.record_batch(
                {n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
                | {"sequence_id": pa.array(places["first"][at] + within // places["copies"][at]),
                   "offset": pa.array(places["offset"][at]
                                      + within % places["copies"][at] * length)})

    placed = ranked(cut, "length", ["doc_id", "piece", "start"])
    return placed.mapInArrow(place, PIECES + ", sequence_id long, offset long")
