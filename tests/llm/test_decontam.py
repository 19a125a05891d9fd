import random

import pytest

from foliograph.llm import decontam

ITEM = "The committee met on a rainy Tuesday to settle how the old harbour should be rebuilt before the winter storms arrive"


def brute(pattern, text):
    """Smallest edit distance of the pattern to any substring, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row)


def test_myers_against_the_table():
    rnd = random.Random(1)
    for _ in range(400):
        pattern = "".join(rnd.choice("ab c") for _ in range(rnd.randrange(1, 90)))
        text = "".join(rnd.choice("ab c") for _ in range(rnd.randrange(0, 60)))
        if rnd.random() < 0.5:
            text += "".join(c for c in pattern if rnd.random() > 0.1) + text
        assert decontam.Myers(pattern).best(text)[0] == brute(pattern, text)


def test_finds_all_within_budget():
    rnd = random.Random(2)
    own = decontam.normal_form(ITEM)
    k = int(decontam.RATE * len(own))
    matcher = decontam.Matcher([(1, ITEM)])
    for _ in range(400):
        text = list(own)
        for _ in range(rnd.randrange(0, k + 4)):
            at = rnd.randrange(len(text))
            match rnd.randrange(3):
                case 0: text[at] = rnd.choice("xyz")
                case 1: del text[at]
                case 2: text.insert(at, rnd.choice("xyz"))
        text = "some words before " + "".join(text) + " and after"
        distance = brute(f" {own} ", f" {decontam.normal_form(text)} ")
        found = matcher.find(text)
        assert bool(found) == (distance <= k)
        assert not found or found[0][:2] == (1, distance)


@pytest.mark.parametrize("size", range(5, 60))
def test_one_rule_at_every_length(size):
    """Edits by the item's length, the ends of words among them, without a step anywhere."""
    item = decontam.normal_form(ITEM)[:size].strip()
    k = int(decontam.RATE * len(item))
    matcher = decontam.Matcher([(1, item)])
    texts = [f"before {item[:3]}{item[4:]} after", f"before {item} after", item, f"be{item} after", f"before {item}er", f"be{item}er", f"be {item[:2]}x{item[2:]}er", item[1:], item[:-1], ""]
    for text in texts:
        distance = brute(f" {item} ", f" {decontam.normal_form(text)} ")
        found = matcher.find(text)
        assert [f[:2] for f in found] == ([(1, distance)] if distance <= k else []), text
    assert matcher.find(f"before {item} after")[0][2] == len("before ") + len(item)


@pytest.mark.parametrize("item,text,met", [("cat dog", "concat dogma", False), ("cat dog mouse", "concat dog mousetrap", False), ("cat dog mouse", "a cat, dog mouse!", True), ("cat dog", "CAT dog", True), ("a text", "sea texts", False)])
def test_items_inside_longer_words(item, text, met):
    assert bool(decontam.Matcher([(1, item)]).find(text)) == met


def test_blocks_are_not_chained(spark, edge):
    """Fifty blocks are as many tasks, each with one block, not fifty workers in one task."""
    items = spark.createDataFrame([(i, f"{ITEM} number {i}") for i in range(50)], "item_id long, text string")
    docs = edge.select("doc_id", "text").union(spark.createDataFrame([(100, f"{ITEM} number 7")], "doc_id long, text string"))
    one = sorted(decontam.reject(docs, items).collect(), key=str)
    many = decontam.reject(docs, items, block_chars=100)
    assert sorted(many.collect(), key=str) == one and "MapInArrow" not in many._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block", [10, 1_000_000])
def test_rows(spark, edge, empty, block):
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, " ... "), (4, "a text"), (None, ITEM), (5, "THE quick, brown fox jumps over the lazy dog near the river bank")], "item_id long, text string")
    extra = spark.createDataFrame([(100, f"Intro. {ITEM.upper()}! Outro.")], "doc_id long, text string")
    docs = edge.select("doc_id", "text").union(extra)
    found = {(r["doc_id"], r["item_id"], r["distance"]) for r in decontam.contaminations(docs, items, block_chars=block).collect()}
    assert found == {(100, 1, 0), (100, None, 0), (1, 5, 0), (2, 5, 0), (7, 5, 0), (None, 4, 0)}
    kept = {r["doc_id"] for r in decontam.reject(edge, items, block_chars=block).collect()}
    assert kept == {3, 4, 5, 6, 9, 10, 11, 12, 13}
    assert decontam.reject(edge, items).columns == edge.columns
    assert decontam.contaminations(empty, items).count() == decontam.contaminations(docs, items.limit(0)).count() == 0


def test_query_against_all_pairs(spark):
    """Every document with every item, by the distance to the whole text; no pieces."""
    from foliograph.llm import queries

    sf = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    forms = [(i["item_id"], decontam.normal_form(i["text"])) for i in items]
    expected = set()
    for d in docs:
        own = decontam.normal_form(d["text"])
        for id, item in forms:
            distance, _ = decontam.Myers(f" {item} ").best(f" {own} ")
            if distance <= int(decontam.RATE * len(item)):
                expected.add((d["doc_id"], id, distance))
    found = queries.op3_pigeonhole_decontamination(spark, sf).collect()
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in found} == expected
