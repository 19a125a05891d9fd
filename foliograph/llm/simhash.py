"""SimHash near-dedup: 64-bit fingerprints, links within a Hamming radius found by sharded BK-trees, components.

Fingerprints. A text's A-Z are lower-cased; its words are runs of other characters than ASCII white space; each
shingle of ``width`` words (repeats included, joined by one space) is hashed by XXH64 with seed 42. A bit is 1 if it is
set in over half the hashes. A shorter text is one shingle; a text without words (null, empty, white space) has the
fingerprint zero and is linked like any other.

Links. Two fingerprints within ``radius`` bits agree wholly on some of ``blocks`` bit ranges (``blocks - radius`` of
them at least), so each distinct fingerprint goes to one shard for every choice of that many ranges. ``blocks`` grows with
the number of fingerprints, so that a shard of evenly spread values stays small; the links don't depend on it. A shard
holds one BK-tree: a node's children are keyed by their Hamming distance to it, and a search follows only the edges within
the radius. Shards of over ``SHARD`` fingerprints are split into parts of about that size, by hash before the shuffle. A
part's tree, as an array of its values, is broadcast to the parts of its shard with higher numbers, whose values ask it:
never a larger tree, and never the documents behind a fingerprint. A search gives a spanning forest of its links, not all
pairs, so the links are fewer than the values that took part.

Components. Labels (smallest ``doc_id``) spread over the links by alternating large-star and small-star rounds, each
round written to the shared folder; nothing is collected. Minima are combined before the shuffle and written before the
join, both sides of which then come from an exchange, so that a hub's links can be split.

Results for special cases: equal fingerprints always share a component; repeated rows give repeated result rows; a null
``doc_id`` takes part but is never a component's id unless all ids there are null; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import removed, written

#: Largest number of fingerprints in one BK-tree.
SHARD = 4096
#: Evenly spread fingerprints that a shard may have on average.
EVEN = 1024


def ranges_for(count: int, radius: int) -> int:
    """The number of bit ranges for ``count`` fingerprints: with radius 4, six for up to two billion, where 15 shards get each
    fingerprint, keyed by two ranges (21 bits)."""
    blocks = radius + 2
    while count > EVEN << 64 * (blocks - radius) // blocks and comb(blocks, radius) < 1000:
        blocks += 1
    return blocks


def fingerprint(text: str | None, width: int = 4) -> int:
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(joined, 42)]
    else:
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(joined)]
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :])]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes; some thousands of hashes are unpacked at a time."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", id: str = "doc_id", width: int = 4) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long, for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(v.as_py(), width) for v in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "fp"])

    return df.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, "doc_id long, fp long")


class BkTree:
    """Children are keyed by their integer Hamming distance to the parent; equal values are kept once."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def insert(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while d := (node[0] ^ value).bit_count():
            child = node[1].get(d)
            if child is None:
                node[1][d] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int) -> Iterator[int]:
        stack = [self.root] if self.root else []
        while stack:
            own, children = stack.pop()
            d = (own ^ value).bit_count()
            if d <= radius:
                yield own
            if len(children) <= 2 * radius + 1:
                stack += [child for k, child in children.items() if -radius <= k - d <= radius]
            else:
                stack += [children[k] for k in range(d - radius, d + radius + 1) if k in children]


class Forest:
    """Union-find over the fingerprints of one shard: tells links that join two groups from those inside one."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent.setdefault(x, x)
        while parent != x:
            self.parent[x] = parent = self.parent.setdefault(parent, parent)
            x, parent = parent, self.parent[parent]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _shard_keys(fp, radius: int, blocks: int):
    """One struct (choice, key) for each choice of ranges that two linked fingerprints may agree on."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(masks[i] for i in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(n).alias("choice"), fp.bitwiseAND(F.lit(signed)).alias("key")))
    return F.array(*keys)


_ALL = (1 << 64) - 1


def search_trees(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Over rows (tree, ask): a part's values, and those of another part that asks its tree (null: the tree's own). The
    links of a spanning forest."""
    for batch in batches:
        found = []
        for values, ask in zip(batch.column(0), batch.column(1)):
            tree, forest, own = BkTree(), Forest(), ask.as_py() is None
            values = values.as_py()
            if not own:
                for value in values:
                    tree.insert(value & _ALL)
            for value in values if own else ask.as_py():
                value &= _ALL
                for other in tree.within(value, radius):
                    if forest.join(value, other):
                        found.append((value, other))
                if own:
                    tree.insert(value)
        if found:
            a, b = (np.array(x, np.uint64).view(np.int64) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def links(distinct: DataFrame, radius: int = 4, blocks: int | None = None, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that connect the same fingerprints as all links would. ``distinct``: a column ``fp`` without repeats."""
    blocks = blocks or ranges_for(distinct.count(), radius)
    keyed = distinct.select("fp", F.explode(_shard_keys(F.col("fp"), radius, blocks)).alias("at")).select("at.choice", "at.key", "fp")
    large = written(keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where(F.col("n") > shard), "large")
    dealt = keyed.join(large, ["choice", "key"], "left").withColumn("parts", F.coalesce(F.ceil(F.col("n") / shard).cast("int"), F.lit(1)))
    parts = dealt.groupBy("choice", "key", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part"), "parts").agg(F.collect_list("fp").alias("tree"))
    parts = written(parts.where("size(tree) > 1 or parts > 1"), "trees")
    none = F.lit(None).cast("array<bigint>")
    sent = parts.where("parts > 1").select("choice", "key", F.explode(F.expr("slice(sequence(part, parts), 2, parts - 1 - part)")).alias("part"), "tree")
    asked = sent.join(parts.select("choice", "key", "part", F.col("tree").alias("ask")), ["choice", "key", "part"])
    return parts.select("tree", none.alias("ask")).union(asked.select("tree", "ask")).mapInArrow(lambda batches: search_trees(batches, radius), "a long, b long")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): the smallest node it is connected with. Large-star: each node
    links its larger neighbours to the smallest of its neighbourhood; small-star: the same for its smaller ones."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a")) if large else e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        out = both.join(least, "u")
        out = out.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")) if large else out.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
        out = written(out.where("a != b").distinct(), "links")
        removed(least, e)
        return out

    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    before = None
    for _ in range(rounds):
        edges = star(star(edges, True), False)
        # every node's sum of roots is settled when a round changes no link
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
        before = now
    raise RuntimeError(f"the components didn't settle in {rounds} rounds")


def near_duplicates(df: DataFrame, text: str = "text", id: str = "doc_id", width: int = 4, radius: int = 4) -> DataFrame:
    """One row for each row of ``df``: ``doc_id``, ``fp`` (signed long), ``component_id``."""
    docs = written(fingerprints(df, text, id, width), "fingerprints")
    owners = written(docs.groupBy("fp").agg(F.min("doc_id").alias("owner")), "owners")
    roots = written(components(links(owners.select("fp"), radius)), "roots")
    linked = owners.join(roots.withColumnRenamed("node", "fp"), "fp")
    classes = linked.groupBy("root").agg(F.min("owner").alias("component_id"))
    # a fingerprint without links, and all its copies, belongs to its own smallest id
    named = written(owners.join(roots.join(classes, "root").select(F.col("node").alias("fp"), "component_id"), "fp", "left").select("fp", F.coalesce("component_id", "owner").alias("component_id")), "components")
    return docs.join(named, "fp").select("doc_id", "fp", "component_id")
