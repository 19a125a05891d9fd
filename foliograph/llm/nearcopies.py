"""SimHash near copies at a Jaccard similarity of 0.8: BK-trees over five-word fingerprints, each link checked exactly.

Shingles. A text's A-Z are lower-cased; its words are runs of other characters than ASCII white space; the set of its
runs of ``WIDTH`` words, hashed by XXH64, stands for it. A shorter text is one shingle. Its SimHash is taken from that set.

Shards. The fingerprints of two texts of similarity 0.8 differ in 10 of 64 bits on average and now and then in 20; bit
ranges, as in ``simhash``, would have to be so short that all texts met. So the SimHash is made wider, to ``WORDS`` words
of 64 bits, and of each word only the most decided bit is taken: the one whose count of set bits in the shingles' hashes is
farthest from half, with its number and value. At 0.8 it is the same in two texts with a probability of about 0.45, though it
tells 128 cases apart; a fixed choice of seven bits would be at 0.32. A text has ``WORDS`` keys, each of the most decided
bits of three words, every word being in three keys: texts of similarity 0.8 share a key with a probability of about
0.9999, others by chance with one of 1 in 14,000. Of texts with a key in common, those are candidates whose first two words
differ in ``WIDE`` bits at most, which a BK-tree finds (one for each group of candidates that is connected already); in a key of
over ``part`` texts all that come later are. A text so has a link for each of its keys; before they are followed, they are
thinned to a few for each text, however large its group. Texts connected by candidates are one shard. A set of three shingles or less is
linked to equal ones alone, so its SimHash is its one key.

Links. A shard is dealt, by hash, to parts of about ``PART`` texts, each asked by the parts after it. A part's BK-tree is
searched for fingerprints within ``RADIUS`` bits (five standard deviations over the average at 0.8), and the texts found
are compared exactly unless they are connected already, so a large shard of near copies costs few comparisons. No text,
shard or fingerprint is left out for its size.

Results for special cases: repeated rows give repeated result rows; a null ``doc_id`` comes after all others in the choice
of the document that stays; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .simhash import _ALL, BkTree, Forest, components, majority

#: Words in a shingle.
WIDTH = 5
#: Words of the wide SimHash, and keys of a text.
WORDS = 144
#: Bits in which the fingerprints of a link may differ, and the first two words of candidates.
RADIUS, WIDE = 24, 44
#: Texts of a shard that one task holds, and of a key that are searched.
PART = 1024

_DEALT = np.random.default_rng(5)
_TIMES = _DEALT.integers(0, 1 << 64, WORDS, np.uint64, endpoint=False) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: The words of each key: three shuffles, cut into threes.
_CHOSEN = np.concatenate([_DEALT.permutation(WORDS) for _ in range(3)]).reshape(WORDS, 3)
#: A byte's bits, each in a byte of its own.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def text_key(text: str = "text") -> Column:
    """A text's MD5; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))))


def shingles(text: str | None) -> np.ndarray:
    """The distinct hashes, sorted."""
    import xxhash

    words = (text or "").encode().lower().split()
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= WIDTH:
        return np.array([digest(joined, 42)], np.uint64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(joined)]
    return np.unique(np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[WIDTH - 1 :])], np.uint64))


def excess(hashes: np.ndarray) -> np.ndarray:
    """For each bit of the wide SimHash, (word, bit): hashes that have it set less those that haven't."""
    counts = np.zeros(WORDS * 64, np.int64)
    for at in range(0, len(hashes), 255):
        words = hashes[at : at + 255, None] * _TIMES
        words = (words ^ (words >> np.uint64(32))) * _MIX
        words ^= words >> np.uint64(29)
        counts += _SPREAD[words.view(np.uint8)].sum(0).view(np.uint8)
    return (2 * counts - len(hashes)).reshape(WORDS, 64)


def signature(hashes: np.ndarray) -> tuple[int, int, bytes | None]:
    """The SimHash and a second word of it, as signed longs, and the most decided bit of each word with its value; none for
    three hashes or less."""
    found = excess(hashes)
    second = np.packbits(found[0] > 0, bitorder="little").view("<i8")[0]
    bits = np.abs(found).argmax(1)
    decided = (2 * bits + (found[np.arange(WORDS), bits] > 0)).astype(np.uint8).tobytes()
    return int(np.uint64(majority(hashes)).view(np.int64)), int(second), decided if len(hashes) > 3 else None


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets is 0.8 at least."""
    if 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * common >= 4 * (len(a) + len(b) - common)


def signatures(df: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``node`` (the text's key) and its ``signature`` (``fp``, ``more``, ``decided``) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [signature(shingles(v.as_py())) for v in batch.column(2)]
            own = [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *own], names=["doc_id", "node", "fp", "more", "decided"])

    rows = df.select(F.col(f"`{id}`").cast("long").alias("doc_id"), text_key(text).alias("node"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, node binary, fp long, more long, decided binary")


def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (fp, more, decided): a row (key, fp, more) for each key, which is its number and its three bits; or, below
    zero, the SimHash."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            fp, more = (batch.column(i).slice(at, 512).to_numpy() for i in range(2))
            decided = batch.column(2).slice(at, 512).to_pylist()
            short = np.array([d is None for d in decided])
            bits = np.frombuffer(b"".join(d for d in decided if d), np.uint8).astype(np.int64).reshape(-1, WORDS)
            first, second, third = (bits[:, _CHOSEN[:, i]] for i in range(3))
            keys = np.arange(WORDS) << 21 | first << 14 | second << 7 | third
            keys = np.concatenate([keys.ravel(), fp[short] | np.iinfo(np.int64).min])
            rows = np.concatenate([np.repeat(np.flatnonzero(~short), WORDS), np.flatnonzero(short)])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, fp[rows], more[rows])], names=["key", "fp", "more"])


def search_keys(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
    """Over rows (key, fp, more) sorted by key: links (a, b) of SimHashes, a > b, that connect all candidates. Values connected
    already are in one BK-tree, of which the first value found is enough; the link goes to the tree's smallest SimHash, so
    that a group's links are much the same in all keys."""
    key, seen, trees = None, set(), []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, fps, more = (batch.column(i).to_numpy() for i in range(3))
        # a key of one row has no candidates; the batch's first and last rows may have some in other batches
        same = np.concatenate([[True], keys[1:] == keys[:-1], [True]])
        at, found = np.flatnonzero(same[1:] | same[:-1]), []
        for own, fp, second in zip(keys[at].tolist(), fps[at].tolist(), more[at].tolist()):
            if own != key:
                key, seen, trees = own, set(), []
            value = (fp & _ALL) << 64 | second & _ALL
            if value in seen:
                continue
            full = len(seen) >= part
            hits = [full or next(tree.within(value, WIDE), None) is not None for tree, *_ in trees]
            near = sorted((t for t, hit in zip(trees, hits) if hit), key=lambda t: len(t[1]))
            least = min(fp, *(first for *_, first in near)) if near else fp
            found += [(v, least) for v in (fp, *(first for *_, first in near)) if v != least]
            tree, values, _ = near.pop() if near else (BkTree(), [], fp)
            for v in [*(v for _, others, _ in near for v in others), *([] if full else [value])]:
                tree.insert(v)
                values.append(v)
            trees = [(tree, values, least), *(t for t, hit in zip(trees, hits) if not hit)]
            if not full:
                seen.add(value)
        if found:
            a, b = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def thinned(found: DataFrame) -> DataFrame:
    """Links (a, b), a > b, that connect what ``found`` does, about one for each node: of a node's links to smaller ones the
    least is left, to which the others' ends are linked in its place. A node is ``a`` in a few links of each key."""
    least = F.min("b").over(Window.partitionBy("a"))
    moved = found.distinct().select("a", "b", least.alias("least"))
    return moved.select(F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("least").alias("b")).distinct()


def groups(marked: DataFrame, part: int = PART) -> DataFrame:
    """(node, root) for each text of ``marked``: texts connected by candidates, or of one SimHash, have one root."""
    texts = written(marked.select("node", "fp", "more", "decided").dropDuplicates(["node"]), "texts")
    keyed = texts.select("fp", "more", "decided").mapInArrow(key_rows, "key long, fp long, more long")
    found = keyed.repartition("key").sortWithinPartitions("key", "fp", "more").mapInArrow(lambda batches: search_keys(batches, part), "a long, b long")
    roots = written(components(thinned(found)), "shards").withColumnRenamed("node", "fp")
    return texts.join(roots, "fp", "left").select("node", F.coalesce("root", "fp").alias("root"))


def check_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (root, part, asks, node, text) sorted by part, members (asks = 0) first: a spanning forest of the links."""
    shard, forest = None, Forest()
    for batch in batches:
        found = []
        for root, part, asks, node, text in zip(*(batch.column(i) for i in range(5))):
            root, part, node = root.as_py(), part.as_py(), node.as_py()
            if (root, part) != shard:
                shard, forest, tree, at, held = (root, part), Forest(), BkTree(), {}, {}
            if node in held:
                continue
            own = shingles(text.as_py())
            fp = majority(own)
            for near in tree.within(fp, RADIUS):
                for other in at[near]:
                    if forest.root(node) != forest.root(other) and similar(own, held[other]):
                        forest.join(node, other)
                        found.append((node, other))
            if not asks.as_py():
                held[node] = own
                tree.insert(fp)
                at.setdefault(fp, []).append(node)
        if found:
            a, b = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def links(df: DataFrame, marked: DataFrame, text: str = "text", part: int = PART) -> DataFrame:
    """Links (a, b) that connect the same texts of ``df`` as all links would. ``marked``: its ``signatures``."""
    shards = written(groups(marked, part), "members")
    sizes = shards.groupBy("root").agg(F.count("*").alias("n")).where("n > 1")
    dealt = written(shards.join(sizes, "root").select("node", "root", F.ceil(F.col("n") / part).cast("int").alias("parts")), "groups")
    rows = (
        df.select(text_key(text).alias("node"), F.col(f"`{text}`").alias("text"))
        .join(dealt, "node")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .select("root", "node", "text", "own", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("part"))
        .select("root", "part", (F.col("part") != F.col("own")).cast("int").alias("asks"), "node", "text")
    )
    return rows.repartition("root", "part").sortWithinPartitions("root", "part", "asks", "node").mapInArrow(check_shards, "a binary, b binary")


def near_copies(df: DataFrame, text: str = "text", id: str = "doc_id", part: int = PART) -> DataFrame:
    """One row for each row of ``df``: ``doc_id``, ``node`` (the text's key), ``component_id`` (the smallest ``doc_id`` of
    its component) and ``kept``, true for the rows of one document of each component: its smallest id and text."""
    marked = written(signatures(df, text, id), "signatures")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("node")))
    owners = written(marked.groupBy("node").agg(least.alias("owner")), "owners")
    roots = written(components(written(links(df, marked, text, part), "links")), "roots")
    classes = owners.join(roots, "node").groupBy("root").agg(F.min("owner").alias("first"))
    # a text without links, and all its rows, belongs to its own smallest id
    named = written(owners.join(roots.join(classes, "root").select("node", "first"), "node", "left").select("node", F.coalesce("first", "owner").alias("first")), "components")
    found = marked.select("doc_id", "node").join(named, "node")
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("node") == F.col("first.node"))
    return found.select("doc_id", "node", F.col("first.doc_id").alias("component_id"), kept.alias("kept"))
