"""Near-duplicates, repeated byte strings and boilerplate lines against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tickerloom.llm import lines, neardup, suffixes

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def prose(seed, n, words=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join(f"x{rng.randrange(99)}" if rng.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def corpus():
    base = prose(0, 120)
    rows = [(i, prose(i, 40 + i), f"s{i % 3}") for i in range(1, 25)]
    rows += [(100 + i, edited(base, i, 0.05), "s0") for i in range(60)]
    rows += [(200 + i, base, "s1") for i in range(30)]
    rows += [(300, None, "s0"), (301, "", "s0"), (302, " \t\n", None), (303, "One", "s1"),
             (304, "one", "s1"), (305, "two words", "s2"), (306, prose(7, 20_000, 30), "s2"),
             (307, prose(7, 20_000, 30) + " end", "s2")]
    return rows


def brute_components(rows, words):
    sets = {}
    for i, text, _ in rows:
        w = WORD.findall((text or "").lower())
        n = min(words, len(w))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_rounds_shrink(spark, docs, monkeypatch):
    """Groups of near copies whose buckets need several rounds: settled ones are left out."""
    rows = []
    for g in range(12):
        text = prose(50 + g, 150)
        for i in range(12):
            text = edited(text, 100 * g + i, 0.04)      # drifts away from the first
            rows.append((100 * g + i, text, "s"))
    kept = []

    def counted(df, label, save=neardup.saved):
        found = save(df, label)
        if label == "bucket-members":
            kept.append(found.count())
        return found

    monkeypatch.setattr(neardup, "saved", counted)
    found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs(rows), 2).collect()}
    assert found == {i: c for i, (_, c) in brute_components(rows, 2).items()}
    assert len(kept) > 1 and kept == sorted(kept, reverse=True) and kept[-1] < kept[0] / 2, kept


@pytest.mark.parametrize("words, small", [(2, 32), (2, 4), (5, 32)])
def test_components(docs, corpus, monkeypatch, words, small):
    monkeypatch.setattr(neardup, "SMALL", small)          # with 4, large buckets take tiles
    found = neardup.near_duplicates(docs([*corpus, corpus[0], (None, "x y", "s")]), words=words,
                                    pivot_rounds=4 if small == 32 else 1).collect()
    expected = brute_components(corpus, words)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert len(found) == len(expected)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_no_documents(docs):
    assert neardup.near_duplicates(docs([])).collect() == []
    assert suffixes.remove_repeats(docs([])).collect() == []
    assert lines.drop_boilerplate(docs([])).collect() == []


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**62, 900).astype(np.uint64))
    for n in (3, 100, 900):
        left = neardup.fast_sketch(a[:n], 252)
        assert not (left == neardup.EMPTY).any()
        right = neardup.fast_sketch(a[:max(1, n * 8 // 10)], 252)
        assert abs((left == right).mean() - max(1, n * 8 // 10) / n) < 0.12


def brute_repeats(rows, length):
    texts = {}
    for i, t, _ in rows:
        texts[i] = max(texts.get(i, b""), (t or "").encode())
    seen, out = set(), {}
    for i in sorted(texts):
        b = texts[i]
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if b[p:p + length] in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(b[p:p + length])
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("block", [20_000, 7])
def test_repeated_bytes(docs, corpus, monkeypatch, block):
    monkeypatch.setattr(suffixes, "BLOCK_SEGMENTS", block)   # 7: anchors are split over blocks
    monkeypatch.setattr(suffixes, "PIECE_BYTES", 1000)
    passage = "é" + prose(99, 30)
    rows = [*corpus, *((400 + i, prose(500 + i, 9) + passage + prose(600 + i, 9), "s0")
                       for i in range(40)),
            (600, "ab" * 400, "s1"), (601, "a" * 99, "s1"), (602, "a" * 300, "s1"),
            (303, "One", "s1")]
    found = suffixes.digest(suffixes.remove_repeats(docs([*rows, (None, "a" * 300, "s")])))
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
            for r in found.collect()} == brute_repeats(rows, 100)


def test_repeats_of_anchors_with_equal_surroundings(docs):
    """Two fields in one template, in turn: what follows would order them A B A B."""
    rng = random.Random(8)
    before, after = ("".join(rng.choices("abcdefgh", k=n)) for n in (60, 30))
    fields = []
    while len(fields) < 2:
        field = "".join(rng.choices("ijklmnop", k=24))
        _, first, last, at, _, _ = suffixes.segments_of(
            [(before + field + after + 200 * "z").encode()], 100, 24)
        if any(a == 60 and f == 0 and e > 14 for f, e, a in zip(first, last, at, strict=True)):
            fields.append(field)
    rows = [(i, before + fields[i % 2] + after + chr(65 + i) + prose(i, 40), "s")
            for i in range(12)]
    found = suffixes.digest(suffixes.remove_repeats(docs(rows))).collect()
    expected = brute_repeats(rows, 100)
    assert sum(n > 0 for _, n, _, _ in expected.values()) == 10
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
            for r in found} == expected


def test_suffix_ranks_are_the_sorted_order():
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(4, 30))) for _ in range(50)]
    ranks = suffixes.suffix_ranks(strings, 4)
    listed = sorted((r, s[k:]) for s, own in zip(strings, ranks, strict=True)
                    for k, r in enumerate(own.tolist()))
    assert [t for _, t in listed] == sorted(t for _, t in listed)
    assert len({r for r, _ in listed}) == len(listed)


def test_boilerplate(docs):
    rows = [(i, f"Menu | Home\nstory {i}\n \nShared {i % 9}\r\nend {i}", "a") for i in range(40)]
    rows += [(100 + i, "Menu | Home\nonly", "b") for i in range(3)]      # too few pages
    rows += [(200 + i, f" Menu | Home \nstory {i}", None) for i in range(6)]
    rows += [(300 + i, "copy line one\ncopy line two", "a") for i in range(30)]   # one page
    rows += [(400, None, "a"), (401, "", "a"), (402, "Menu | Home", "a"), (403, "\n\n", "a")]
    found = {r["doc_id"]: r for r in lines.drop_boilerplate(docs(rows)).collect()}
    pages, totals = defaultdict(Counter), Counter()
    for host, text in {(s, t) for _, t, s in rows if t}:
        totals[host] += 1
        pages[host].update({x.replace("\r", " ").strip(" ") for x in text.split("\n")} - {""})
    for i, text, host in rows:
        if not text:
            assert found[i]["text"] == text and found[i]["_n_dropped"] == 0
            continue
        kept = [x for x in text.split("\n") if not (
            (k := x.replace("\r", " ").strip(" ")) and pages[host][k] >= 5
            and pages[host][k] > 0.1 * totals[host])]
        assert found[i]["text"] == "\n".join(kept)
        assert found[i]["_n_dropped"] == text.count("\n") + 1 - len(kept)
        assert found[i]["score"] == "own"
    assert found[402]["text"] == "" and found[300]["text"].startswith("copy")
