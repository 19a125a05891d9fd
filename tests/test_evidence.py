"""Evidence with its place, claims about lists, and typed edges."""

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from foliograph.functions import ids, text
from foliograph.operators import graph, parse, provenance
from foliograph.plans import registry, texts  # noqa: F401

TEXT = "# Ann Oak\nEmail: a@x.test\n\n[SUMMARY]\nBuilds things.\n\n[PROJECTS]\nLoom | It's, SQL | Weaves \"cloth\" | \n"
BLOCK = "stem string, block_id string, type string, text string, position int, page_number int, section_id string, bbox array<double>"


def grounded(spark):
    records = parse.ingest(spark.createDataFrame([("ann.md", TEXT)], "source_file string, text string"))
    blocks = spark.createDataFrame([("ann", "b1", "text", "Loom, made with It's SQL", 1, 2, "s1", [0.0, 1.0, 2.0, 3.5]), ("ann", "b2", "text", "loom", 2, 3, "s2", None), ("ann", "b3", "text", None, 3, None, None, None)], BLOCK)
    return records, blocks, provenance.ground(provenance.claims(records), blocks)


def test_evidence_tells_place_and_quote(spark):
    found = {(r["section"], r["field"]): r for r in grounded(spark)[2].collect()}
    one = found["projects", "technologies"]
    assert (one["block_id"], one["page_number"], one["section_id"], one["bbox"], one["quote"], one["match_type"], one["score"]) == ("b1", 2, "s1", [0.0, 1.0, 2.0, 3.5], "Loom, made with It's SQL", "exact_normalized", 1.0)
    assert one["claim_id"] == "claim_" + hashlib.sha256("projects|0|technologies|[\"It's\", 'SQL']".encode()).hexdigest()[:16]
    none = found["candidate", "email"]
    assert not none["grounded"] and none["page_number"] is none["quote"] is none["score"] is None


def test_blocks_without_places(spark):
    records, blocks, _ = grounded(spark)
    rows = provenance.ground(provenance.claims(records), blocks.drop("page_number", "section_id", "bbox")).where("grounded").collect()
    assert rows and all(r["page_number"] is r["section_id"] is r["bbox"] is None and r["quote"] for r in rows)
    assert provenance.ground(provenance.claims(records), blocks.limit(0)).where("grounded").count() == 0


def test_typed_edges_and_their_ids(spark):
    records, blocks, found = grounded(spark)
    nodes = graph.merge_nodes(graph.domain_graph(records)[0]).select("id").union(blocks.select("block_id"))
    people = records.select("stem", ids.candidate_id(F.col("candidate.name"), F.col("candidate.email")).alias("cand"))
    edges = graph.provenance_edges(found, people, nodes, typed=True)
    rel = ids.rel_id(F.col("src"), F.col("type"), F.col("dst"), F.col("properties"), typed=True)
    rows = edges.select("src", "dst", "identity", F.to_json("properties").alias("p"), rel.alias("rel_id")).collect()
    kinds = {json.loads(r["p"])["field"] for r in rows}
    assert kinds >= {"name", "technologies"}
    for r in rows:
        properties = json.loads(r["p"])
        assert isinstance(properties["page_number"], int) and isinstance(properties["score"], float)
        if properties["field"] == "technologies":
            assert json.loads(properties["value"]) == ["It's", "SQL"]
        whole = json.dumps({"from": r["src"], "type": "EXTRACTED_FROM", "to": r["dst"], "properties": properties}, sort_keys=True, ensure_ascii=False)
        assert r["rel_id"] == "rel_" + hashlib.sha256(whole.encode()).hexdigest()[:20]
    plain = {r["identity"]: r["properties"] for r in graph.provenance_edges(found, people, nodes).collect()}
    assert all(p["page_number"] in ("2", "3") for p in plain.values())


def test_lists_as_python_prints_them(spark):
    lists = [["a", "b'c", 'd"e', "f'\"g", "h\\i\n\t"], [], [""]]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, x array<string>")
    assert {r["i"]: r["t"] for r in rows.select("i", text.python_repr(F.col("x")).alias("t")).collect()} == {i: repr(x) for i, x in enumerate(lists)}


def best_of_all(value, blocks):
    """Each block against the value: score, first position, block."""
    normal = lambda t: re.sub("[^a-z0-9]+", " ", (t or "").lower()).strip()
    target, found = normal(value), []
    for id_, kind, words, position in blocks:
        h = normal(words)
        if target and h and kind != "image":
            own = set(target.split())
            score = 1.0 if target in h else len(own & set(h.split())) / len(own)
            found.append((-score, position, id_, "exact_normalized" if target in h else "token_overlap"))
    least = min(found, default=None)
    return (least[2], least[3], -least[0]) if least and -least[0] >= provenance.THRESHOLD else (None, None, None)


def test_evidence_is_the_best_of_all_blocks(spark):
    rnd = random.Random(8)
    words = ["a", "b", "ab", "abc", "b.c", "C", "d-a", "", "é"]
    some = lambda n: " ".join(rnd.choice(words) for _ in range(rnd.randrange(n)))
    blocks = {f"d{d}": [(f"d{d}_{p}", rnd.choice(["text", "table", "image"]), some(6), p) for p in range(rnd.randrange(9))] for d in range(40)}
    claims = [(d, f"c{i}", some(5)) for d in [*blocks, "none"] for i in range(15)]
    rows = [(d, *b) for d, own in blocks.items() for b in rnd.sample(own, len(own))]
    found = provenance.ground(spark.createDataFrame(claims, "stem string, claim_id string, value string"), spark.createDataFrame(rows, "stem string, block_id string, type string, text string, position int"))
    assert {(r["stem"], r["claim_id"]): (r["block_id"], r["match_type"], r["score"]) for r in found.collect()} == {(d, c): best_of_all(v, blocks.get(d, [])) for d, c, v in claims}
    assert {r["match_type"] for r in found.collect()} == {None, "exact_normalized", "token_overlap"}


def test_claims_and_blocks_make_no_pairs(spark):
    """A document's claims meet its blocks as one row, and the records' way gives the same rows as the claims' own."""
    records, blocks, found = grounded(spark)
    whole = provenance.grounded(records, blocks)
    assert whole.columns == found.columns and sorted(map(str, whole.collect())) == sorted(map(str, found.collect()))
    for df in (found, whole):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


@pytest.mark.parametrize("name", ["claim_evidence", "provenance_graph_edges", "provenance_edge_properties"])
def test_queries_look_evidence_up_by_document(spark, name):
    """No claim is shuffled to its evidence."""
    plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Join .*claim_id", plan)
