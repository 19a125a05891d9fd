import random
import re

import pytest
import xxhash

from foliograph.llm import queries, simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=4):
    """rows: (doc_id, fingerprint); smallest reachable doc_id of each fingerprint, by search over all pairs."""
    fps = sorted({f for _, f in rows})
    least = {f: min((i for i, g in rows if g == f and i is not None), default=None) for f in fps}
    left, out = set(fps), {}
    while left:
        start = left.pop()
        group, queue = [start], [start]
        while queue:
            x = queue.pop()
            near = [y for y in left if (x ^ y).bit_count() <= radius]
            left -= set(near)
            group += near
            queue += near
        ids = [least[f] for f in group if least[f] is not None]
        out |= {f: min(ids, default=None) for f in group}
    return out


def test_fingerprints(texts):
    for _, text, _ in texts[:120]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \t") == 0


def test_tree_finds_what_brute_force_finds():
    rnd = random.Random(2)
    base = [rnd.getrandbits(64) for _ in range(40)]
    values = [b ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randrange(7))) for b in base for _ in range(8)]
    tree = simhash.BkTree()
    for v in values:
        tree.insert(v)
    for v in values[:80]:
        assert set(tree.within(v, 4)) == {x for x in values if (x ^ v).bit_count() <= 4}


def test_ranges():
    assert [simhash.ranges_for(n, 4) for n in (0, 10**9, 10**10, 10**12)] == [6, 6, 7, 8]


@pytest.mark.parametrize("blocks", [None, 7])
def test_links_with_small_shards(spark, blocks):
    """A hot group over many shards, chains, and lone values: the components are those of all pairs."""
    rnd = random.Random(3)
    hot = rnd.getrandbits(64)
    values = {hot ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64) for _ in range(150)} | {rnd.getrandbits(64) for _ in range(60)}
    chain = rnd.getrandbits(64)
    for k in range(16):
        chain ^= (1 << 4 * (k % 16)) * 15
        values.add(chain)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), blocks=blocks, shard=20)
    assert edges.count() <= 35 * len(values)
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    expected = brute_components([(v, v & (1 << 64) - 1) for (v,) in signed])
    for (v,) in signed:
        assert roots.get(v, v) == expected[v & (1 << 64) - 1]


def test_rows(spark, edge, empty, texts):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    marked = [(i, plain_fingerprint(t)) for i, t in rows]
    expected = brute_components(marked)
    found = sorted(((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(edge).collect()), key=str)
    assert found == sorted(((i, f, expected[f]) for i, f in marked), key=str)
    assert simhash.near_duplicates(empty).count() == 0


def test_query_against_brute_force(spark):
    found = queries.op2_simhash_near_dedup(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    marked = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs}
    expected = brute_components(list(marked.items()))
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in found} == {(i, f"{f:016x}", expected[f]) for i, f in marked.items()}
