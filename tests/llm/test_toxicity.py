import math
from collections import Counter

import numpy as np
import pytest

from foliograph.llm import queries, toxicity


def test_regression_against_gradient():
    rnd = np.random.default_rng(1)
    x = (rnd.random((300, 8)) < 0.4).astype(np.float32)
    y = (rnd.random(300) < toxicity.sigmoid(x @ rnd.normal(size=8))).astype(float)
    w = toxicity.fit(x, y, ridge=0.5)
    p = toxicity.sigmoid(x @ w[:-1] + w[-1])
    assert np.abs(x.T @ (y - p) - 0.5 * w[:-1]).max() < 1e-3 and abs((y - p).sum()) < 1e-2


def test_later_categories_see_earlier_ones():
    """The second category is the first one with a second word; its model uses the first one's probability."""
    rnd = np.random.default_rng(2)
    sets = [{w for w, p in (("awful", 0.4), ("fool", 0.5), ("tree", 0.5)) if rnd.random() < p} for _ in range(600)]
    y = np.array([["awful" in s, "awful" in s and "fool" in s] for s in sets], float)
    chain = toxicity.Chain.train(sets, y, ["a", "b"])
    assert [len(w) for w in chain.weights] == [len(chain.vocabulary) + 1, len(chain.vocabulary) + 2]
    assert chain.weights[1][-2] > 0
    p = chain.scorer()([{"awful", "fool"}, {"awful"}, {"fool"}, set()])
    assert (p[:, 0] >= chain.thresholds[0]).tolist() == [True, True, False, False]
    assert (p[:, 1] >= chain.thresholds[1]).tolist() == [True, False, False, False]


def test_reader_gives_the_known_features(texts):
    sets = [toxicity.features(t) for _, t, _ in texts[:200]]
    known = sorted(set().union(*sets))[::7]
    read = toxicity.Chain(["a"], known, [], []).reader()
    for (_, t, _), own in zip(texts[:200], sets):
        assert read(t) == own & set(known)


def test_threshold():
    assert toxicity.threshold(np.array([0.9, 0.6, 0.2]), np.array([1, 1, 0])) == pytest.approx(0.4)
    assert toxicity.threshold(np.array([0.5, 0.5]), np.array([1, 1])) == 0.5


def plain_chain(texts, labels, parts):
    """The chain's training and scoring again, on dicts of features, one text at a time."""
    sets = [toxicity.features(t) for t in texts]
    n = len(texts)

    def choose(rows, k):
        total, within = Counter(), Counter()
        for i in rows:
            total.update(sets[i])
            if labels[i][k]:
                within.update(sets[i])
        m, size = sum(labels[i][k] for i in rows), len(rows)

        def g(f):
            a, b = within[f], total[f]
            cells = [(a, b * m), (b - a, b * (size - m)), (m - a, (size - b) * m), (size - m - b + a, (size - b) * (size - m))]
            return round(sum(2 * o * math.log(o * size / e) for o, e in cells if o > 0), 6)

        scored = sorted(((-g(f), f) for f in total if total[f] >= toxicity.LEAST))
        return [f for v, f in scored[: toxicity.VOCABULARY] if -v >= toxicity.GAIN]

    earlier, models = [[] for _ in range(n)], []
    for k in range(len(labels[0])):
        row = lambda i, own, before: [float(f in sets[i]) for f in own] + before
        out = [0.0] * n
        for part in sorted(set(parts)):
            train, test = [i for i in range(n) if parts[i] != part], [i for i in range(n) if parts[i] == part]
            own = choose(train, k)
            w = toxicity.fit(np.array([row(i, own, earlier[i]) for i in train]), np.array([labels[i][k] for i in train]))
            for i in test:
                out[i] = float(toxicity.sigmoid(np.dot(row(i, own, earlier[i]), w[:-1]) + w[-1]))
        own = choose(range(n), k)
        models.append((own, toxicity.fit(np.array([row(i, own, earlier[i]) for i in range(n)]), np.array([labels[i][k] for i in range(n)])), toxicity.threshold(np.array(out), np.array([labels[i][k] for i in range(n)]))))
        earlier = [[*e, float(np.float32(p))] for e, p in zip(earlier, out)]  # as the chain keeps them

    def score(text):
        found, probabilities = toxicity.features(text), []
        for own, w, _ in models:
            probabilities.append(float(toxicity.sigmoid(np.dot([float(f in found) for f in own] + probabilities, w[:-1]) + w[-1])))
        return probabilities

    return score, [t for _, _, t in models]


def test_against_a_plain_chain(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BUCKETS", 1 << 23)  # no two features that matter share a hash
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.sample(docs, labels, list(queries.TOXICITY_CHAIN.values()), toxicity.SAMPLE, "text", "doc_id")
    score, thresholds = plain_chain([t for t, _ in rows], [y for _, y in rows], [toxicity.fold_of(t) for t, _ in rows])
    asked = [t for t, _ in rows][:60] + [None, ""]
    chain = toxicity.train(docs, labels, queries.TOXICITY_CHAIN)
    read = chain.reader()
    assert np.abs(chain.scorer()([read(t) for t in asked]) - np.array([score(t) for t in asked])).max() < 1e-4
    assert chain.thresholds == pytest.approx(thresholds, abs=1e-4)


def test_random_labels_are_not_foreseen():
    """Out-of-fold probabilities must not know labels dealt by chance, even where features are chosen at a low gain."""
    rnd = np.random.default_rng(4)
    sets = [{f"w{i}" for i in np.flatnonzero(rnd.random(400) < 0.3)} for _ in range(400)]
    y = (rnd.random((400, 1)) < 0.5).astype(float)
    parts = np.arange(400) % 3
    chooser = toxicity.Chooser(sets, y, parts, 3, gain=2.0)
    out = np.zeros(400)
    for part in range(3):
        own, test = chooser.choose(0, part), parts == part
        w = toxicity.fit(chooser.x[~test][:, own], y[~test, 0])
        out[test] = chooser.x[test][:, own] @ w[:-1]
    yes, no = out[y[:, 0] == 1], out[y[:, 0] == 0]
    assert abs((yes[:, None] > no[None]).mean() - 0.5) < 0.08


def test_held_out(spark):
    """Trained on two thirds of the labelled documents and held against all of the rest; some of low quality are labelled toxic
    without anything in the text to tell why."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    chain = toxicity.train(docs, labels.where("doc_id % 3 != 1"), queries.TOXICITY_CHAIN)
    test = labels.where("doc_id % 3 = 1").select("doc_id", "toxic")
    rows = toxicity.classify(docs.join(test.select("doc_id"), "doc_id"), chain).select("doc_id", "toxic").join(test.withColumnRenamed("toxic", "y"), "doc_id").collect()
    hit = sum(r["toxic"] and r["y"] for r in rows)
    assert hit >= 0.9 * sum(r["y"] for r in rows) and hit >= 0.93 * sum(r["toxic"] for r in rows)


def test_labels_that_contradict_each_other(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (3, "d" * 9000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, None), (3, 1), (None, 1)], "doc_id long, toxic int")
    assert sorted(toxicity.sample(docs, labels, ["toxic"], 100, "text", "doc_id")) == [("a", [1.0]), ("c", [0.0])]


def test_rows(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (6, 1, 0), (10, None, 1), (None, 1, 1), (11, 0, 0), (11, 0, 0)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(edge, labels, queries.TOXICITY_CHAIN)
    rows = toxicity.classify(edge, chain).collect()
    assert len(rows) == edge.count() and all(0 <= r["p_toxic"] <= 1 for r in rows)
    kept = toxicity.reject(edge, chain, "toxic")
    assert kept.columns == edge.columns and kept.count() == sum(not r["toxic"] for r in rows)
    assert toxicity.classify(empty, chain).count() == toxicity.reject(empty, chain, "toxic").count() == 0
    untrained = toxicity.train(edge, labels.limit(0), queries.TOXICITY_CHAIN)
    assert not any(r["toxic"] for r in toxicity.classify(edge, untrained).collect())
