import hashlib
import random
import re
from collections import Counter

from foliograph.llm import exact


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(rows):
    size, owner = Counter(), {}
    for i, t in rows:
        size[normal(t)] += 1
        if i is not None:
            owner[normal(t)] = min(i, owner.get(normal(t), i))
    return sorted(((i, owner.get(normal(t)), size[normal(t)], i == owner.get(normal(t)), hashlib.sha256(normal(t).encode()).hexdigest()) for i, t in rows), key=str)


def test_trie_against_a_dict():
    rnd = random.Random(1)
    trie, expected = exact.PatriciaTrie(), {}
    for i in range(4000):
        text = bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(0, 12)))
        trie.insert(text, i)
        owner, n = expected.get(text, (i, 0))
        expected[text] = (min(owner, i), n + 1)
    assert {t: (o, n) for t, o, n in trie.terminals()} == expected


def test_spilled_subtrees_lose_nothing():
    rnd = random.Random(2)
    texts = [bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(0, 9))) for _ in range(3000)]
    out = {}
    for text, owner, n in exact._combine(((t, i, 1) for i, t in enumerate(texts)), 5000):
        a, b = out.get(text, (owner, 0))
        out[text] = (min(a, owner), b + n)
    assert {t: n for t, (_, n) in out.items()} == Counter(texts)
    assert all(texts.index(t) == o for t, (o, _) in out.items())


def test_rows(spark, edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    for budget in (exact.BUDGET, 500):
        found = sorted((tuple(r) for r in exact.exact_duplicates(edge, budget=budget).collect()), key=str)
        assert found == brute(rows)
    assert exact.exact_duplicates(empty).count() == 0


def test_a_hot_group(spark):
    rows = [(i, "one text for all" if i % 2 else f"text {i}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted((tuple(r) for r in exact.exact_duplicates(df).collect()), key=str) == brute(rows)
