"""Decontamination, mixing, extraction, URL rules, neighbours, pipeline."""

import math
import random
import re
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from tickerloom.llm import decontaminate, extraction, mixing, neighbours, textops, urls

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def prose(seed, n, words=300):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


# --- decontamination ---------------------------------------------------------------

def test_contaminated(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_POSTINGS", 100)     # several shards
    items = [(i, f"{prose(i, 25)}?\n{prose(1000 + i, 6)}") for i in range(12)]
    table = spark.createDataFrame(
        [*items, (50, None), (51, ""), (None, "a b c"), (3, items[3][1])],
        "item_id long, text string")
    rows = [(i, prose(2000 + i, 150), "s") for i in range(20)]
    rows += [(100 + i, f"{prose(3000 + i, 200)} {t.upper()} {prose(4000 + i, 90)}", "s")
             for i, t in items]
    rows += [(200, items[0][1].split("\n")[0], "s"),              # the question alone
             (201, None, "s"), (202, "", "s"), (203, prose(9, 30_000), "s"),
             (None, items[0][1], "s"), (100, items[0][1], "s")]
    found = decontaminate.contaminated(docs(rows), table).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(100 + i, i) for i, _ in items]
    assert all(r["question_overlap"] == r["answer_overlap"] == 1 for r in found)
    assert decontaminate.contaminated(docs([]), table).collect() == []
    assert decontaminate.contaminated(docs(rows), table.limit(0)).collect() == []


def test_search_is_complete(spark):
    """Block-max search finds what scoring every item finds."""
    texts = [(i, prose(i, 12, 60)) for i in range(90)]
    shard, = decontaminate.build_shards(
        spark.createDataFrame(texts, "item_id long, text string"))
    words = [np.unique(decontaminate._words(prose(5000 + p, 40, 60))) for p in range(40)]
    words += [np.unique(decontaminate._words(t)) for _, t in texts[:10]]
    terms = [np.flatnonzero(np.isin(shard.vocabulary, w)) for w in words]
    starts = np.concatenate(([0], np.cumsum([len(t) for t in terms])))
    weight = defaultdict(dict)
    for block in shard.postings:
        for term, (items, impacts) in block.items():
            for item, impact in zip(items, impacts, strict=True):
                weight[item][term] = impact
    for threshold in (0.4, 0.6, 0.9):
        found = {(p, i): s for p, i, s in shard.search(np.concatenate(terms), starts, threshold)}
        expected = {(p, i): s for p, t in enumerate(terms) for i in weight
                    if (s := sum(weight[i].get(k, 0) for k in t)) >= threshold}
        assert found.keys() == expected.keys()
        assert all(math.isclose(found[k], min(expected[k], 1), rel_tol=1e-6) for k in found)


def test_every_text_of_an_item_is_found(spark, docs):
    texts = [f"{prose(10 * i, 30)}?\n{prose(10 * i + 1, 6)}" for i in range(3)]
    table = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (1, texts[1]), (2, texts[2])],
                                  "item_id long, text string")
    rows = [(10 + i, f"{prose(500 + i, 90)} {t} {prose(600 + i, 90)}", "s")
            for i, t in enumerate(texts)]
    rows.append((20, prose(700, 200), "s"))
    found = decontaminate.contaminated(docs(rows), table).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(10, 1), (11, 1), (12, 2)]


def test_both_sides_of_an_item_have_words(spark, docs):
    assert decontaminate.question_and_answer("Who is it? A man.\n???") == ("Who is it?", " A man.\n???")
    assert decontaminate.question_and_answer("one two three _ \u2013") == ("one two", "three")
    question, answer = prose(1, 30), prose(2, 15)
    table = spark.createDataFrame([(1, f"{question} {answer}\n\u2026 ?")], "item_id long, text string")
    rows = [(10, f"{prose(3, 50)} {question} {prose(4, 50)}", "s"),
            (11, f"{prose(3, 50)} {question} {answer} {prose(4, 50)}", "s")]
    found = decontaminate.contaminated(docs(rows), table).collect()
    assert [r["doc_id"] for r in found] == [11]


def test_items_are_found_alike_in_any_shard(spark, docs, monkeypatch):
    """Neither longer items beside it nor the number of passes changes what is found."""
    items = [(i, f"{prose(i, 12 + 9 * (i % 4))}?\n{prose(800 + i, 5)}") for i in range(16)]
    rows = []
    for i, text in items:
        words = text.split()
        spread = " ".join(f"{w} {prose(5000 + 100 * i + k, i % 3)}" for k, w in enumerate(words))
        rows += [(i, f"{prose(900 + i, 70)} {text} {prose(950 + i, 70)}", "s"),
                 (100 + i, f"{prose(700 + i, 40)} {spread} {prose(750 + i, 40)}", "s")]

    def found(table):
        held = spark.createDataFrame(table, "item_id long, text string")
        return sorted((r["doc_id"], r["item_id"], round(r["score"], 6))
                      for r in decontaminate.contaminated(docs(rows), held).collect())

    whole = found(items)
    assert {(i, i) for i, _ in items} <= {(d, i) for d, i, _ in whole}
    monkeypatch.setattr(decontaminate, "SHARD_POSTINGS", 60)
    monkeypatch.setattr(decontaminate, "PASS_SHARDS", 2)
    assert found(items) == whole
    longer = found([*items, (99, prose(77, 3000, 20_000))])
    assert [(d, i) for d, i, _ in longer] == [(d, i) for d, i, _ in whole]


@pytest.mark.parametrize("words", [1, 2, 31, 32, 33, 64, 65, 300])
def test_some_passage_holds_the_whole_item(words):
    step = decontaminate.step_of(words)
    for length in range(words, words + 4 * step, 7):
        text = " ".join(f"w{k}" for k in range(length)).encode()
        hashes, firsts = textops.word_hashes([b"", text, b"x"], textops.MARKS)
        shard = decontaminate.Shard(np.array([1]), np.unique(hashes), *[np.zeros(0, int)] * 3,
                                    [], [], step)
        owner, begin, end, _, _ = decontaminate._passages(hashes, firsts, shard)
        mine = owner == 1
        assert list(owner) == sorted(owner) and set(owner) == {1, 2}
        for at in range(length - words + 1):
            assert any((begin[mine] <= at) & (at + words <= end[mine]))


# --- extraction: regions inside and beside ----------------------------------------

LONG = "<p>" + "The river ran on past the mill and the town and the children walked home. " * 3 + "</p>"
PLAIN = " ".join(["The river ran on past the mill and the town and the children walked home."] * 3)


@pytest.mark.parametrize("html, kept", [
    (f"<body><div>{LONG}</div><div>Terms apply to all pages.</div></body>", [PLAIN]),
    (f"<body><div>{LONG}</div><div><h2>Two</h2><p>Short.</p></div></body>", [PLAIN, "Two Short."]),
    (f"<body><div>{LONG * 3}</div><div>Terms apply to all pages.</div></body>", [PLAIN] * 3),
    (f"<body><div>{PLAIN}</div><div>Short one.</div></body>", [PLAIN, "Short one."]),
    (f"<body><div><h1>Title</h1></div><div>{PLAIN}</div><div>Short one.</div></body>",
     ["Title", PLAIN, "Short one."]),
    (f"<main>{LONG}<div><h3>More</h3><ul><li><a href=1>One story</a><li><a href=2>Two stories</a>"
     f"</ul></div>{LONG}</main>", [PLAIN, PLAIN]),
    (f"<main><article>{LONG}</article><article><a href=1>Another page</a></article></main>", [PLAIN]),
    (f"<article>{LONG}<div><a href=1>Figure one</a></div></article>", [PLAIN, "Figure one"]),
    (f"<article>{LONG}<ul><li><a href=1>Source a</a><li><a href=2>Source b</a></ul></article>",
     [PLAIN, "Source a Source b"]),
    ("<article><div><p><a href=1>All is</a><p><a href=2>in links</a></div></article>",
     ["All is in links"]),
])
def test_regions_inside_and_beside(html, kept):
    assert extraction.extract(html) == " ".join(kept)


# --- mixing ------------------------------------------------------------------------

def highest_quotients(votes, seats):
    won = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


@pytest.mark.parametrize("seed", range(4))
def test_apportionment(spark, seed):
    rng = random.Random(seed)
    rows = [(g, i, rng.choice([0, 1, 5, 5, rng.randrange(1, 4000)]), 10 + 70 * g)
            for g in range(4) for i in range(3 + 9 * g)]
    table = spark.createDataFrame(rows, "g long, i long, votes long, seats long")
    found = {(r["g"], r["i"]): r["quota"]
             for r in mixing.apportion(table, ["g"], "votes", "seats", "i").collect()}
    for g in range(4):
        own = [r for r in rows if r[0] == g]
        if any(r[2] for r in own):
            assert [found[g, r[1]] for r in own] == highest_quotients(
                [r[2] for r in own], own[0][3])


def test_mix(docs):
    rows = [(i, prose(i, 20 + i % 50), ("big", "mid", "tiny", None)[
        0 if i < 200 else 1 if i < 280 else 2 if i < 284 else 3]) for i in range(300)]
    rows += [(900, None, "big"), (901, "", "mid"), (902, "\t \n", "none"), (903, "x " * 9000, "mid"),
             (5, rows[5][1], "big")]
    table = docs(rows, extra="target")
    found = mixing.mix(table).collect()
    again = mixing.mix(table.repartition(7)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    assert sorted(r["size"] for r in found) == sorted(size)
    of = defaultdict(int)
    for (_, _, s), n in zip(rows, size, strict=True):
        of[s] += n
    names = sorted((s for s in of if s is not None)) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, free, left = {}, set(names), sum(size)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * of[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3.0 * of[s]
            left -= 3 * of[s]
        free -= over
    taken = defaultdict(int)
    for r in found:
        assert math.isclose(r["target"], target[r["source"]], abs_tol=1e-6)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["source_size"] == of[r["source"]]
        taken[r["source"]] += r["taken"]
    for s in names:
        assert abs(taken[s] - target[s]) <= max(4, 0.01 * target[s])
    assert mixing.mix(docs([])).collect() == []
    assert all(r["taken"] == 0 for r in mixing.mix(docs([(1, None, None), (2, "", "a")])).collect())


# --- extraction --------------------------------------------------------------------

LONG = "A sentence of the article that goes on for a good while, as they do here."


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<p></p><br>", ""), ("plain &amp; simple", "plain & simple"),
    (f"<nav><a href=x>Menu</a></nav><article><h1>Head</h1><p>{LONG}\n <b>x</b><p>Short."
     f"</article><footer>&copy; foot</footer>", f"Head {LONG} x Short."),
    (f"<article><header><h1>Head</h1></header><p>{LONG}</p><div class=ad>{LONG}</div>"
     f"<p>End", f"Head {LONG} End"),
    (f"<header>{LONG}</header><div id=content><p>{LONG}</p><ul><li>one<li>two</ul></div>"
     f"<div class='comment-list'><p>{LONG} {LONG}</p></div><aside>{LONG}</aside>"
     f"<form>{LONG}<input></form><script>var x='<p>{LONG}</p>'</script>",
     f"{LONG} one two"),
    (f"<div class=cookieNotice>{LONG}</div><main><section><p>{LONG}</p></section>"
     f"<section><p>Tail &lt;x&gt;</p></section></main>", f"{LONG} Tail <x>"),
])
def test_extract(html, text):
    assert extraction.extract(html) == text


@pytest.mark.parametrize("html, text", [
    (f"<html><head><title>T</title><style>x</style><body><p>{LONG}</p></body>", LONG),
    (f"<head><title>T</title><meta x=y><p>{LONG}", LONG),
    (f"<head><title>T</title>{LONG}", LONG),
    (f"<head><noscript><p>Switch it on</p></noscript></head><p>{LONG}</p>", LONG),
    *((f"<body><{tag}><a href=x>Menu</a><{kind}><p>{LONG}</p></{kind}><footer>F</footer></body>",
       LONG) for tag in ("nav", "header", "form", "aside") for kind in ("main", "article")),
    (f"<article><p>{LONG}</p></article><aside><article>Other</article></aside>", LONG),
    (f"<article><p>{LONG}</p></article><aside><article>Other {LONG}", LONG),     # cut off
])
def test_extract_with_elements_left_open(html, text):
    assert extraction.extract(html) == text


@pytest.mark.parametrize("html, text", [
    (f"<div class=has-sidebar><p>{LONG}</p></div>", LONG),
    (f"<div id=content-with-sidebar><article><p>{LONG}</p></article></div>", LONG),
    (f"<div class='content sidebar-right'><p>{LONG}</p><p>{LONG}</p>"
     f"<div class=sidebar><p>{LONG}</p></div></div>", f"{LONG} {LONG}"),
    (f"<div class='layout sidebar-left'><main><p>{LONG}</p></main></div>", LONG),
    (f"<div class='layout sidebar-left'><article><p>{LONG}</p></article>"
     f"<div class=sidebar>{LONG} {LONG} {LONG}</div></div>", LONG),
    (f"<article><div class=article-header><h1>Head</h1></div><p>{LONG}</p></article>",
     f"Head {LONG}"),
    (f"<article><h1 class=post-header>Head</h1><p>{LONG}</p></article>", f"Head {LONG}"),
    (f"<article><p>{LONG}</p></article><div class=related><article>{LONG} {LONG}</article>"
     f"</div>", LONG),
    (f"<div><p>{LONG}</p></div><div class=comments><p>{LONG}</p><p>{LONG}</p></div>", LONG),
    (f"<div><p>{LONG}</p></div><div class=comments><article>{LONG} {LONG}</article></div>", LONG),
    (f"<div><p>{LONG}</p></div><div class=sidebar><article>Other post</article></div>", LONG),
])
def test_extract_with_marked_wrappers(html, text):
    assert extraction.extract(html) == text


@pytest.mark.parametrize("long", [2, 10, 60])
def test_extract_keeps_short_sections(long):
    """One div a section, without article or main."""
    parts = ["Opening words.", LONG * long, LONG, "Last words."]
    html = "".join(f"<div><h2>Part {i}</h2><p>{t}</p></div>" for i, t in enumerate(parts))
    html = f"<body><div><a href=a>Home</a> <a href=b>More</a></div>{html}</body>"
    assert extraction.extract(html) == " ".join(f"Part {i} {t}" for i, t in enumerate(parts))


def test_extract_pages(spark):
    long = f"<article><p>{LONG * 3000}</p></article>"
    pages = spark.createDataFrame(
        [(1, "u", long, "x"), (2, None, None, "x"), (2, None, None, "x"), (None, "u", "<p>a", "x")],
        "page_id long, url string, html string, text string")
    found = extraction.extract_pages(pages).collect()
    assert sorted((r["n_chars"], r["text"] == "") for r in found) == [
        (0, True), (0, True), (1, False), (len(LONG) * 3000, False)]
    assert extraction.extract_pages(pages.limit(0)).collect() == []


def test_articles_of_the_test_pages(spark):
    import html as entities

    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", r["html"], re.S)[1]
        body = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", body))
        expected = " ".join(entities.unescape(body).split())
        assert extraction.extract(r["html"]) == expected


# --- URLs --------------------------------------------------------------------------

@pytest.mark.parametrize("url, host, path, rule", [
    (None, "", "", None), ("no scheme/x", "", "", None), ("http://", "", "", None),
    ("http://A.Org/X?q#f", "a.org", "/X", "org/"), ("http://a.org", "a.org", "", None),
    ("http://example.org/es/1", "example.org", "/es/", "example.org/es/"),
    ("https://m.example.org/en/12", "m.example.org", "/en/12", "example.org/en/1"),
    ("https://badexample.org/en/12", "badexample.org", "/en/12", "org/"),
    ("http://x.com/de/5#top", "x.com", "/de/5", "com/de/"),
    ("http://x.com?u=http://y.org/", "x.com", "", None),
    ("http://com/fr/", "com", "/fr/", "com/fr/"), ("http://xcom/fr/", "xcom", "/fr/", None),
])
def test_rules(spark, url, host, path, rule):
    if path == "/es/":
        path = "/es/1"
    row = urls.ruled(spark.createDataFrame([(url,)], "url string")).first()
    assert (row["host"], row["path"], row["rule"]) == (host, path, rule)


def test_judge(spark):
    kind = "page_id long, url string, verdict string"
    rows = [(i, f"http://h{i % 9}.com/{'de' if i % 2 else 'fr'}/{i}", "own") for i in range(120)]
    rows += [(500, None, "x"), (501, "http://n.net/en/" + "9" * 5000, "x"), (502, "", "x"),
             (502, "", "x"), (None, "http://x.net/", "x")]
    found = urls.judge(spark.createDataFrame(rows, kind)).collect()
    assert len(found) == len(rows) and {r["verdict"] for r in found} <= {"allow", "block"}
    assert all(r["verdict"] == ("block" if r["page_id"] % 2 else "allow")
               for r in found if r["rule"])
    assert urls.judge(spark.createDataFrame([], kind)).collect() == []
    lone = urls.judge(spark.createDataFrame([(1, "http://a.net/", "")], kind)).collect()
    assert [r["verdict"] for r in lone] == ["allow"]


def test_trees_learn(spark):
    """URLs without a rule follow what the labelled ones look like."""
    rules = (urls.Rule("aaa.com", "/", "block"), urls.Rule("bbb.com", "/", "allow"))
    rng = random.Random(4)

    def path(letters):
        return "".join(rng.choice(letters) for _ in range(rng.randrange(8, 30)))

    rows = [(i, f"http://x.aaa.com/{path('0123456789')}") for i in range(150)]
    rows += [(200 + i, f"http://x.bbb.com/{path('abcdefghij')}") for i in range(150)]
    rows += [(900, "http://x.ccc.com/77192803641277"), (901, "http://x.ccc.com/abhgdjfiecbadf")]
    found = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    assert {r["page_id"]: r["verdict"] for r in found if r["page_id"] >= 900} == {
        900: "block", 901: "allow"}


# --- neighbours --------------------------------------------------------------------

def brute_nearest(rows, k, every):
    good = {}
    for i, v in rows:
        if i is not None and v and len(v) == 16 and all(
                x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, np.float32).astype(float)
    ids = np.array(sorted(good))
    x = np.stack([good[i] for i in ids])
    out = {}
    for q in ids[ids % every == 0]:
        d = np.sqrt(((x - good[q]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(120)]                 # one common vector
    rows += [(2000, None), (2100, [0.0] * 16), (2200, [float("nan")] * 16), (None, rows[1][1]),
             (2300, [1.0] * 5), (2400, [None] + [1.0] * 15), (2500, [float("inf")] * 16),
             (0, rows[0][1])]
    table = spark.createDataFrame([(*r, 1, 0.0) for r in rows],
                                  "vec_id long, embedding array<float>, label int, score double")
    found = defaultdict(list)
    for r in neighbours.nearest(table, every=50).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    expected = brute_nearest(rows, 10, 50)
    assert found.keys() == expected.keys()
    hits = 0
    for q, own in found.items():
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert own == sorted(own, key=lambda r: (r[2], r[1]))
        hits += len({v for _, v, _ in own} & {v for v, _ in expected[q]})
    assert hits >= 0.9 * 10 * len(expected)
    assert [v for _, v, _ in found[0]] == [v for v, _ in expected[0]]     # ties by id


def test_graph_is_built_until_it_holds_the_nearest(spark):
    """Few lines and few new neighbours a group take more rounds than are asked for."""
    x = np.random.default_rng(6).normal(size=(1500, 12)).astype(np.float32)
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                                   "id long, vector array<float>")
    held = defaultdict(set)
    for r in neighbours.build_graph(points, lines=3, each=3, rounds=1).collect():
        held[r["a"]].add(r["b"])
    d = ((x[:, None, :].astype(float) - x[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    nearest = np.argsort(d, axis=1)[:, :10]
    assert sum(len(held[i] & set(own.tolist())) for i, own in enumerate(nearest)) >= 0.95 * 15_000


def test_only_new_edges_bring_vectors_together(spark):
    """A chain 0 -> 1 -> ... -> 9 with one edge taken up: only its ends have a meeting."""
    taken = spark.createDataFrame(
        [(i, i + 1, 1.0, i == 4, i == 4) for i in range(9)],
        "a long, b long, distance double, fresh boolean, taken boolean")
    met = {(r["group"], r["id"], r["new"])
           for r in neighbours.meetings(taken, 24, 12, 0).collect()}
    assert met == {(4, 5, True), (4, 4, False), (4, 3, False),
                   (5, 4, True), (5, 5, False), (5, 6, False)}


def test_vector_that_all_name_stays_a_bounded_group(spark):
    star = spark.range(1, 2001).selectExpr(
        "id as a", "0L as b", "1.0D as distance", "id % 2 = 0 as fresh", "id % 2 = 0 as taken")
    sizes = neighbours.meetings(star, 24, 12, 0).groupBy("group", "new").count().collect()
    assert {(r["new"], r["count"]) for r in sizes if r["group"] == 0} == {(True, 12), (False, 25)}


def test_graph_in_parts_is_searched_within_them(spark):
    """Two clouds far apart, each larger than a list of neighbours."""
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=16) + (1e6 if i % 2 else 0)).astype(np.float32).tolist())
            for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    expected = brute_nearest(rows, 10, 25)
    found = defaultdict(set)
    for r in neighbours.nearest(table, every=25).collect():
        found[r["query_id"]].add(r["vec_id"])
    hits = sum(len(found[q] & {v for v, _ in own}) for q, own in expected.items())
    assert hits >= 0.9 * 10 * len(expected)


def test_few_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    assert neighbours.nearest(spark.createDataFrame([], kind)).collect() == []
    lone = spark.createDataFrame([(100, [1.0, 2.0])], kind)
    assert neighbours.nearest(lone).collect() == []
    three = spark.createDataFrame([(100, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [4.0, 6.0])], kind)
    assert [tuple(r) for r in neighbours.nearest(three).orderBy("rank").collect()] == [
        (100, 1, 7, 0.0), (100, 2, 8, 5.0)]


def test_vectors_of_doubles_keep_their_digits(spark):
    close = [(100, [0.0, 1.0]), (1, [2e-9, 1.0]), (2, [1e-9, 1.0]), (3, [0.0, 1e300])]
    table = spark.createDataFrame(close, "vec_id long, embedding array<double>")
    found = neighbours.nearest(table).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found[:2]] == [(2, 1e-9), (1, 2e-9)]


# --- pipeline ----------------------------------------------------------------------

def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf)
        assert docs.columns == columns, name
        assert docs.join(before, "doc_id", "left_anti").count() == 0
    found = corpus_pipeline.run(spark, sf)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == found.count() > 0
    assert all(0 < r["taken"] <= 3 * r["size"] for r in rows.values())
    items = [" ".join(r["text"].split()) for r in
             spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = [" ".join(r["text"].split()) for r in rows.values()]
    assert not any(i in t for i in items for t in texts)
    assert len(set(texts)) == len(texts)
    whole = {r["doc_id"]: set(r["text"].split("\n"))
             for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert all(set(r["text"].split("\n")) <= whole[i] | {""} for i, r in rows.items())


def test_repeated_id_keeps_the_text_that_was_compared(spark, docs):
    long, short = prose(1, 90), prose(2, 30)
    for rows in ([(1, long, "s"), (1, short, "s"), (2, long, "s")],
                 [(1, short, "s"), (1, long, "s"), (2, long, "s")]):
        found = corpus_pipeline.one_of_each_group(spark, docs(rows).coalesce(1), "")
        assert sorted((r["doc_id"], r["text"]) for r in found.collect()) == [
            (1, short), (2, long)]


def test_pipeline_edges(spark, docs):
    sf = "/root/testdata/sf0.001"
    rows = [(10**6, None, "s"), (10**6 + 1, "", None), (10**6 + 2, prose(1, 90), "s"),
            (10**6 + 2, prose(1, 90), "s"), (10**6 + 3, prose(1, 90), "t"), (None, "x", "s")]
    for table in (docs(rows, extra="size"), docs([], extra="size")):
        for _, stage in corpus_pipeline.STAGES:
            table = stage(spark, table, sf)
        found = table.collect()
        assert len({r["doc_id"] for r in found}) == len(found)
        assert {"size", "source_size", "target", "taken", "text"} <= set(table.columns)


@pytest.mark.parametrize("inner", ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>"])
def test_a_form_around_the_page(inner):
    story = "".join(f"<p>{prose(i, 40)}</p>" for i in range(4))
    text = " ".join(prose(i, 40) for i in range(4))
    page = ("<html><body><form action='/x'><input name='s'><button>Go</button>"
            f"<nav><a href='/'>Home</a></nav>{inner.format(story)}</form></body></html>")
    assert extraction.extract(page) == text
    beside = (f"<html><body>{inner.format(story)}<form><p>Write to us now</p>"
              "<input name='m'></form></body></html>")
    assert extraction.extract(beside) == text


def test_a_page_cut_inside_a_tag():
    story = "".join(f"<p>{prose(i, 40)}</p>" for i in range(3))
    text = " ".join(prose(i, 40) for i in range(3))
    for end in ("<p cla", "</di", "<!-- open", "<a href='x", "<"):
        found = extraction.extract(f"<html><body><article>{story}{end}")
        assert found == (text if end != "<" else f"{text} <")
    assert extraction.extract("<article><p>1 < 2 and 3</p></article>") == "1 < 2 and 3"


def test_a_discussion_is_no_article():
    story = "".join(f"<p>{prose(i, 40)}</p>" for i in range(3))
    page = f"<main>{story}<section id='discussion'><p>{prose(9, 20)}</p></section></main>"
    assert extraction.extract(page) == " ".join(prose(i, 40) for i in range(3))


def test_lexical_features_equal_plain_python(spark):
    given = ["https://a-b.Example.org/x/yy/3?p=1&q=2;r#top", "http://h/", "no scheme 12", None, "",
             "http://www.t.net/aa//b_c", "HTTPS://x.y.z/%41?#", "ftp://q/ää1?z"]
    table = spark.createDataFrame([(u,) for u in given], "url string")
    for row in urls.lexical(urls.ruled(table)).collect():
        url = row["url"] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        query = (re.search(r"\?([^#]*)", url) or [None, ""])[1]
        shares = [url.count(c) / len(url) for c in set(url)]
        expected = {
            "url_length": len(url), "host_length": len(host), "path_length": len(path),
            "depth": sum(1 for part in path.split("/") if part),
            "labels": host.count(".") + 1, "digits": len(re.findall("[0-9]", url)),
            "digit_ratio": len(re.findall("[0-9]", url)) / max(len(url), 1),
            "entropy": -sum(p * math.log2(p) for p in shares),
            "parameters": len(re.split("[&;]", query)) if query else 0, "fragment": "#" in url,
            "secure": url.lower().startswith("https:"), "hyphens": url.count("-") + url.count("_"),
            "longest_part": max(len(part) for part in path.split("/")),
        }
        for name, value in expected.items():
            assert math.isclose(row[name], value, abs_tol=1e-9), (url, name)
