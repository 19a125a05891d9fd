"""Sweeps over pages against all pairs, and line grouping against a fold over a list."""

import random

import pytest
from pyspark.sql import functions as F

from foliograph.operators import layout
from foliograph.sources import readers

ASSETS = "page int, asset_id string, top double, bottom double, note string"
TEXTS = "page int, block_id string, text string, t_top double, t_bottom double, reading_order int"


def page_items(seed):
    pick = random.Random(seed)
    assets, texts = [], []
    for page in range(30):
        for i in range(pick.randrange(0, 12)):
            y = float(pick.randrange(0, 12))
            texts.append((page, f"b{page}_{i}", pick.choice(["", f"t{i}", "u"]), y, y + pick.randrange(0, 4), i))
        for i in range(pick.randrange(0, 12)):
            y = float(pick.randrange(0, 12))
            assets.append((page, f"a{page}_{i}", y, y + pick.randrange(0, 5), "n"))
    return assets, texts


@pytest.mark.parametrize("k", [1, 3])
def test_sweep_finds_what_all_pairs_find(spark, k):
    assets, texts = page_items(k)
    a, t = spark.createDataFrame(assets, ASSETS), spark.createDataFrame(texts, TEXTS)
    near = {r["asset_id"]: (r["context_block_ids"], r["nearby_text"], r["note"]) for r in layout.nearest_context(a, t, ["page"], k).collect()}
    below = {r["asset_id"]: r["caption"] for r in layout.captions(a, t, ["page"], 3).collect()}
    assert len(near) == len(below) == len(assets)
    for page, id, top, bottom, _ in assets:
        mine = [x for x in texts if x[0] == page]
        nearest = sorted(mine, key=lambda x: (min(abs(x[3] - bottom), abs(top - x[4])), x[5]))[:k]
        filled = [x for x in nearest if x[2]]
        assert near[id] == ([x[1] for x in filled], " | ".join(x[2] for x in filled), "n")
        under = sorted((x[3], x[5], x[2]) for x in mine if 0 <= x[3] - bottom <= 3)
        assert below[id] == (under[0][2] if under else "")


def test_sweep_without_pages_boxes_or_texts(spark):
    a = spark.createDataFrame([(1, "a", 0.0, 1.0, ""), (None, "b", 0.0, 1.0, ""), (1, "c", None, None, ""), (1, "a", 0.0, 1.0, "")], ASSETS)
    t = spark.createDataFrame([(1, "x", "X", 2.0, 3.0, 1), (None, "y", "Y", 2.0, 3.0, 1), (1, "z", "Z", None, None, 2), (1, "w", None, 2.0, 3.0, 3)], TEXTS)
    near = sorted((r["asset_id"], r["nearby_text"]) for r in layout.nearest_context(a, t, ["page"]).collect())
    assert near == [("a", "X"), ("a", "X"), ("b", ""), ("c", "")]
    assert sorted((r["asset_id"], r["caption"]) for r in layout.captions(a, t, ["page"]).collect()) == [("a", "X"), ("a", "X"), ("b", ""), ("c", "")]
    assert [r["nearby_text"] for r in layout.nearest_context(a.limit(1), t.limit(0), ["page"]).collect()] == [""]
    assert layout.nearest_context(a.limit(0), t, ["page"]).count() == layout.captions(a.limit(0), t, ["page"]).count() == 0


def test_sweep_makes_no_pairs(spark):
    a, t = spark.createDataFrame([], ASSETS), spark.createDataFrame([], TEXTS)
    for made in (layout.nearest_context(a, t, ["page"]), layout.captions(a, t, ["page"])):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan


def grouped(words):
    out, anchor, line = {}, None, 0
    for w in sorted(words, key=lambda w: (round(w[4], 1), w[3], w[4], w[5], w[6], w[7], w[8], w[2])):
        if anchor is None or abs(w[4] - anchor) > layout.LINE_GAP:
            anchor, line = w[4], line + 1
        out.setdefault(line, []).append(w)
    return {n: " ".join(w[2] for w in sorted(ws, key=lambda w: (w[3], round(w[4], 1), w[2]))) for n, ws in out.items()}


def test_lines_are_those_of_a_fold(spark):
    pick = random.Random(5)
    words = [(d, p, f"w{i}", float(pick.randrange(0, 50)), pick.randrange(0, 400) / 8, 1.0, 2.0, 9.0, "f") for d in "ab" for p in (1, 2, 3) for i in range(60)]
    rows = spark.createDataFrame(words, readers.WORDS)
    found = {(r["document_id"], r["page_number"], r["line"]): r["text"] for r in layout.lines(rows).collect()}
    expected = {(d, p, n): t for d in "ab" for p in (1, 2, 3) for n, t in grouped([w for w in words if w[:2] == (d, p)]).items()}
    assert found == expected
    assert layout.lines(rows.limit(0)).count() == 0


def test_a_page_of_many_words(spark):
    columns = [F.lit("d"), F.lit(1), F.concat(F.lit("w"), "id"), (F.col("id") % 100).cast("double"), F.col("id") / 10, F.lit(1.0), F.lit(2.0), F.lit(9.0), F.lit("f")]
    words = spark.range(60_000).select(*[c.alias(n) for c, n in zip(columns, ["document_id", "page_number", "text", "x0", "top", "x1", "bottom", "size", "fontname"])])
    rows = layout.lines(words).select("line", F.size(F.split("text", " ")).alias("n")).collect()
    assert sum(r["n"] for r in rows) == 60_000 and len(rows) > 1_500 and sorted(r["line"] for r in rows) == list(range(1, len(rows) + 1))
