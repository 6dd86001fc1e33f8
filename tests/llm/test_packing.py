"""Packing against the plain tokenizer, and its plans against bounds."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickerloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a\x0bb\x0cC", "x\x1cy\x85z", "Á ́b", "İstanbul ΣΑΣ", "<|endoftext|> Hi", "<|EndOfText|> hi",
       "'S'T it's 'tis don't. a,'s", "１２３ ½ ²", " a b　c", "\x00\x01 a",
       "日本語 テスト,abc.", "Été, (the) SS. ß! ÿÞ× a÷b", "K Å", " \n\t ", "", "x..y!?\")"]


def ids(tokenizer, text):
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_words_alone_give_the_ids_of_the_text(spark):
    tokenizer, encode = Tokenizer.from_file(PATH), packing.Encoder(PATH, at_most=50)
    texts = [r["text"] for r in spark.read.parquet(
        "/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for text in [*ODD, *ODD, *(t for t in texts if t)]:
        assert encode(text) == ids(tokenizer, text), text


def packed_like(found, rows, capacity):
    """Check every claim about `found`, pieces of `rows`; the number of sequences."""
    tokenizer = Tokenizer.from_file(PATH)
    expected = Counter()
    for doc_id, text, _ in rows:
        own = ids(tokenizer, text or "") + b"\0\0\0\0"
        for piece, at in enumerate(range(0, len(own), 4 * capacity)):
            part = own[at:at + 4 * capacity]
            expected[doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter(tuple(r)[:5] for r in found) == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_pack(spark, docs, capacity):
    rng = random.Random(1)
    rows = [(i, " ".join(f"word{rng.randrange(90)}" for _ in range(rng.randrange(40))), "s")
            for i in range(150)]
    rows += [(500 + i, text, None) for i, text in enumerate(ODD)]
    rows += [(7, None, "s"), (None, "no id", "s"), (None, None, None), (8, "again", "s"),
             (8, "again", "s"), (900, "long text " * 9000, "s")]
    rows += [(1000 + i, "the same words in every copy", "s") for i in range(200)]
    found = packing.pack(docs(rows, "sequence_id"), PATH, capacity).collect()
    used = packed_like(found, rows, capacity)
    histogram = Counter(r["length"] for r in found)
    assert used == packing.solve(dict(histogram), capacity).sequences
    tokens = sum(r["length"] for r in found)
    assert used <= -(-tokens // capacity) * 1.02 + 1
    assert packing.pack(docs([], "offset"), PATH, capacity).collect() == []


def best_fit(histogram, capacity):
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    plan = {}
    packing._best_fit(left, plan)
    return sum(plan.values())


@pytest.mark.parametrize("low, high, share", [(1, 2048, 1.01), (500, 1100, 1.05),
                                              (300, 1500, 1.02), (1030, 2040, 1.00001)])
def test_plan_covers_all_and_stays_near_its_bound(low, high, share):
    rng = random.Random(3)
    histogram = dict(Counter(min(rng.randint(low, high), 2048) for _ in range(200_000)))
    plan = packing.solve(histogram, 2048)
    used = Counter()
    for column, times in plan.columns:
        assert times > 0 and sum(n * c for n, c in column) <= 2048
        used.update({n: c * times for n, c in column})
    assert used == Counter(histogram)
    assert plan.bound <= plan.sequences <= plan.bound * share
    assert plan.sequences <= best_fit(histogram, 2048) * 1.005


def test_bound_holds_where_the_optimum_is_known():
    for histogram, capacity, optimum in [({6: 10}, 10, 10), ({5: 10, 1: 3}, 10, 6),
                                         ({7: 3, 3: 9, 5: 2}, 10, 6), ({1: 5}, 2048, 1),
                                         ({4: 6, 3: 6, 2: 6}, 9, 6), ({}, 8, 0)]:
        plan = packing.solve(histogram, capacity)
        assert plan.bound <= optimum <= plan.sequences <= optimum + 1
    big = packing.solve({5: 10**9}, 2048)
    assert big.sequences == -(-10**9 // 409) and len(big.columns) < 5
