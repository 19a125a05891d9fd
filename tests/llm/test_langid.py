import random
import zlib

import numpy as np
import pytest

from foliograph.llm import langid, queries


def grams(text):
    """The n-grams as sets of code points, without bits."""
    s = [c if c.isalpha() else " " for c in text.lower()]
    return {tuple(s[i : i + n]) for n in range(1, langid.NGRAM + 1) for i in range(len(s) - n + 1)}


def test_presence_against_sets():
    bits = np.zeros(langid.BITS, np.uint8)
    text = "The bees, ÉÄ 漢字! \U00020000 x"
    assert langid.presence(text, bits)
    assert bits.sum() == len(grams(text))  # no two of these few share a bit
    bits[:] = 0
    assert not langid.presence(" 12 - 3", bits) and not langid.presence("", bits)


def test_seams(monkeypatch):
    text = "abcdefghgfedcba" * 3
    whole, cut = np.zeros(langid.BITS, np.uint8), np.zeros(langid.BITS, np.uint8)
    langid.presence(text, whole)
    monkeypatch.setattr(langid, "CHUNK", 4)
    langid.presence(text, cut)
    assert (whole == cut).all()


def test_values_against_plain_kernel_ridge(texts):
    """With every training text a landmark, Nystroem features give kernel ridge regression itself, here on plain sets."""
    rows = [(t[:1500], lang) for _, t, lang in texts if t and lang][:60]
    asked = [t[:1500] for _, t, _ in texts[200:240] if t]
    names = sorted({lang for _, lang in rows})
    model = langid.Model.train(sorted(rows, key=lambda r: r[1]), landmarks=10**6)
    known = [grams(t) for t, _ in sorted(rows, key=lambda r: r[1])]
    kernel = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    k = np.array([[kernel(a, b) for b in known] for a in known])
    y = np.array([[1.0 if lang == n else -1.0 for n in names] for _, lang in sorted(rows, key=lambda r: r[1])])
    one = np.ones((len(k), 1))
    # minimise |K a + b - y|^2 + ridge (a' K a + b^2): the intercept is a feature of its own
    joint = k + one @ one.T
    a = np.linalg.solve(joint + langid.RIDGE * np.eye(len(k)), y)
    expected = np.array([[kernel(grams(t), b) for b in known] for t in asked]) @ a + a.sum(0)
    assert np.abs(model.values(asked)[0] - expected).max() < 0.05
    assert [x[0] for x in model.score(asked)] == [names[i] for i in expected.argmax(1)]


def test_held_out_accuracy(spark):
    rows = queries.op7_kernel_language_id(spark, "/root/testdata/sf0.01").collect()
    known = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(known)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == known[r["doc_id"]] for r in held) >= 0.97 * len(held)


@pytest.fixture(scope="module")
def many():
    """70 languages: each has words of its own, letters of all but the first are those of one of several scripts; the texts
    of the last one are all very long."""
    rnd = random.Random(3)
    out = []
    for n in range(70):
        letters = [chr(c) for c in (range(97, 123), range(0x3B1, 0x3C9), range(0x430, 0x44F), range(0x4E00 + 40 * n, 0x4E28 + 40 * n))[n % 4]]
        words = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(3, 9))) for _ in range(60)]
        for _ in range(12):
            out.append((len(out), " ".join(rnd.choice(words) for _ in range(rnd.randrange(30, 80) if n < 69 else 3000)), f"l{n:02d}"))
    return out


def test_every_language_is_learned(spark, many):
    docs = spark.createDataFrame(many, "doc_id long, text string, lang string")
    sample = langid.sample(docs.where("doc_id % 3 != 1"))
    assert {lang for _, lang in sample} == {lang for _, _, lang in many}
    model = langid.Model.train(sample)
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, model).collect()}
    assert sum(found[i] == lang for i, _, lang in many if i % 3 == 1) >= 0.98 * sum(i % 3 == 1 for i, _, _ in many)
    few = langid.sample(docs, size=70)
    assert len(few) == 70 and {lang for _, lang in few} == {lang for _, _, lang in many}


def test_sample_prefers_short_texts_and_is_bounded(spark):
    rows = [(i, "a b c" * (1 if i % 2 else 100), "x") for i in range(40)] + [(100, "z" * 5000, "y"), (100, "z" * 5000, "y"), (101, "z" * 4000, "y"), (None, "q", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.sample(docs, each=20, chars=50)
    assert sorted(len(t) for t, lang in found if lang == "x") == [5] * 20
    assert [len(t) for t, lang in found if lang == "y"] == [4000]


def test_rows(spark, edge, empty):
    model = langid.Model.train(langid.sample(edge))
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(edge, model).collect()}
    assert found[3] == found[4] == found[5] == ("und", 0.0)
    assert all(lang in ("en", "fr", "de") for i, (lang, _) in found.items() if i not in (3, 4, 5))
    assert langid.identify(edge, model).count() == edge.count()
    assert langid.identify(empty, model).count() == 0
    assert langid.Model.train(langid.sample(empty)) is None
    assert {r["lang_pred"] for r in langid.identify(edge, None).collect()} == {"und"}
