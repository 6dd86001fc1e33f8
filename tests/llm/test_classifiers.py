"""Quality and toxicity: held-out accuracy, and rows at the edge."""

import math
import random
import zlib

import numpy as np
import pytest
from tickerloom.llm import quality, toxicity

GOOD = "the river ran past the old mill and the children walked home along the bank number {}."
SHOUT = "BUY!! NOW!! CHEAP!! {}!! BUY!! NOW!! CHEAP!! OFFER!! BUY!! NOW!!"
SF = "/root/testdata/sf0.01"


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_edges(spark, docs):
    rows = [(i, (GOOD if i % 3 else SHOUT).format(i) * (1 + i % 4), "s") for i in range(60)]
    rows += [(100, None, "s"), (101, "", None), (102, "word " * 60_000, "s"),
             (103, GOOD.format(3), "s"), (103, GOOD.format(3), "s"), (None, GOOD.format(1), "s")]
    known = labelled(spark, [(i, int(i % 3 > 0), 0) for i in range(60)]
                     + [(5, None, 0), (None, 1, 0), (4, 1, 0)])
    found = quality.classify(docs(rows), known).collect()
    assert len(found) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert all(by_id[i]["predicted"] == int(i % 3 > 0) for i in range(60))
    for i, r in by_id.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)


def test_rows_of_one_id_give_one_model(spark, docs):
    """Which of several texts of a labelled id is learned from does not hang on order."""
    rows = [(i % 40, (GOOD if i % 3 else SHOUT).format(i) * (1 + i % 5), "s") for i in range(120)]
    known = labelled(spark, [(i, i % 2, 0) for i in range(40)])

    def scores(order):
        table = docs(order).repartition(5, "text")
        return sorted((r["doc_id"], round(r["score"], 9))
                      for r in quality.classify(table, known).collect())

    assert scores(rows) == scores(rows[::-1])


@pytest.mark.parametrize("module", [quality, toxicity])
def test_nothing_to_learn_from(spark, docs, module):
    none = labelled(spark, [])
    assert module.classify(docs([]), none).collect() == []
    found = module.classify(docs([(1, "a b", "s"), (2, None, "s")]), none).collect()
    assert len(found) == 2 and all(0 <= r["score"] <= 1 for r in found)


def test_held_out_accuracy(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    for module, target in ((quality, "quality"), (toxicity, "toxic")):
        found = module.classify(documents, labels).join(labels, "doc_id").where("held_out")
        right = found.where(f"predicted = {target}").count()
        assert right >= 0.95 * found.count() > 0


def test_labels_out_of_reach(spark, docs):
    """Held-out labels change nothing."""
    rows = [(i, GOOD.format(i) + (" you idiot." if i % 2 else ""), "s") for i in range(80)]
    kept = [(i, 1, i % 2) for i in range(80) if zlib.crc32(str(i).encode()) % 3 != 1]
    out = [(i, 1, 1 - i % 2) for i in range(80) if zlib.crc32(str(i).encode()) % 3 == 1]

    def scores(known):
        return {r["doc_id"]: round(r["score"], 9)
                for r in toxicity.classify(docs(rows), labelled(spark, known)).collect()}

    assert scores(kept) == scores(kept + out)


def test_offending_sentences(spark, docs):
    rows = [(i, f"A calm line {i}. " + ("You are scum number one. " if i % 2 else "")
             + "Another calm line.", "s") for i in range(90)]
    known = labelled(spark, [(i, 1, i % 2) for i in range(90)])
    table = docs([*rows, (500, None, "s"), (501, "", "s")])
    model = toxicity.learn(table, known)
    found = toxicity.offending_sentences(table, model).collect()
    assert {r["doc_id"] for r in found} == {i for i in range(90) if i % 2}
    assert all("scum" in r["sentence"] for r in found)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(table, model).collect()}
    assert scores[500] == scores[501] == 0 and scores[1] > 0.7 > scores[2]


def test_gradient_is_the_slope_of_the_likelihood(spark):
    """Noisy-or over sentences, written out, against what the tasks add up."""
    rng = random.Random(5)
    names = sorted(toxicity.features_of({"scum", "idiots", "calm", "fool"}))
    texts = [("".join(rng.choice(["You scum fool. ", "A calm line! ", "idiots\n", "Nothing here. ",
                                  "Scum scum! ", "123. "]) for _ in range(rng.randrange(7))),
              rng.randrange(2)) for _ in range(40)]
    sample = spark.createDataFrame(texts, "text string, label int").repartition(3)
    bags = toxicity._bags(sample, {f: i for i, f in enumerate(names)})

    def likelihood(weights):
        model = toxicity.ToxicityModel(dict(zip(names, weights[:-1], strict=True)), weights[-1])
        total = 0.0
        for text, label in texts:
            none = math.prod(1 - p for _, _, p in model.sentences(text))
            assert math.isclose(model.score(text), 1 - none, abs_tol=1e-9)
            if label and none < 1:
                total += math.log(1 - none)
            elif not label:
                total += math.log(none)
        return total

    weights = [rng.uniform(-1, 1) for _ in names] + [-1.5]
    found = toxicity._gradient(bags, np.array(weights))
    for i in range(len(weights)):
        up, down = ([*weights[:i], weights[i] + e, *weights[i + 1:]] for e in (1e-5, -1e-5))
        assert math.isclose(found[i], (likelihood(up) - likelihood(down)) / 2e-5,
                            rel_tol=1e-4, abs_tol=1e-4)


def test_discriminant_equals_written_out_densities(spark):
    rng = np.random.default_rng(4)
    d = quality.N_FEATURES
    x = [rng.normal(k, 1 + k, (30 + 20 * k, d)) @ rng.normal(0, 1, (d, d)) for k in (0, 1)]
    rows = [(v.tolist(), k) for k in (0, 1) for v in x[k]]
    model = quality.fit(spark.createDataFrame(rows, "features array<double>, label int")
                        .repartition(3), shrinkage=0.2, to_diagonal=0.3)
    own = [np.cov(v.T, bias=True) for v in x]
    pooled = sum(len(v) * np.diag(c) for v, c in zip(x, own, strict=True)) / 80 + 1e-4
    probes = np.concatenate([x[0][:5], x[1][:5], rng.normal(0, 3, (5, d))])
    logs = []
    for v, c in zip(x, own, strict=True):
        shrunk = 0.8 * (0.7 * c + 0.3 * np.diag(np.diag(c))) + 0.2 * np.diag(pooled)
        away = probes - v.mean(axis=0)
        logs.append(-0.5 * np.einsum("ij,ij->i", away, np.linalg.solve(shrunk, away.T).T)
                    - 0.5 * np.linalg.slogdet(shrunk)[1])
    margin = logs[1] - logs[0] + np.log(51 / 31)
    assert np.allclose(model.score(probes), 1 / (1 + np.exp(-np.clip(margin, -500, 500))), atol=1e-6)
