import hashlib
import random

import corpus_pipeline
import numpy as np
import pyarrow as pa

from foliograph.llm import nearcopies, simhash


def plain_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def brute_kept(rows):
    """rows: (doc_id, text), ids unique; the ids that are the smallest of their component, by all pairs."""
    sets, owner = {i: plain_set(t) for i, t in rows}, {i: i for i, _ in rows}

    def root(i):
        while owner[i] != i:
            i = owner[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                owner[high] = low
    return {i for i in ids if owner[i] == i}


def varied(rnd, count):
    """Texts with copies that differ in some words, chains of such copies, and texts that share half a passage only."""
    word = lambda: f"w{rnd.randrange(5000)}"
    out = []
    for _ in range(count):
        text = [word() for _ in range(rnd.randrange(20, 200))]
        out.append(text)
        for _ in range(rnd.randrange(4)):
            text = list(text)
            for _ in range(max(1, len(text) // rnd.choice((40, 50, 60, 90)))):
                text[rnd.randrange(len(text))] = word()
            out.append(text)
        out.append(out[-1][: len(text) // 2] + [word() for _ in range(len(text) // 2)])
    return [(i, " ".join(t)) for i, t in enumerate(rnd.sample(out, len(out)))]


def test_near_copies_beyond_the_radius_of_op2_go(spark):
    rows = varied(random.Random(7), 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert kept == brute_kept(rows) and len(kept) < len(rows) - 40


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()} == brute_kept(rows)


def test_split_group(spark):
    """A group of near copies over many parts is one component."""
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :])) for i in range(100) for k in [rnd.randrange(300)]]
    found = nearcopies.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), part=8).collect()
    assert len(found) == 100 and {r["component_id"] for r in found} == {0}


def kept_rows(spark, rows):
    return sorted(map(tuple, corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()), key=str)


def test_only_the_judged_row_goes(spark):
    """Of a group, one row stays: that of the smallest id, of one id the smallest text, and none without an id."""
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(3, text), (5, text + " end"), (5, "another text altogether, of a few words"), (None, text + " last"), (3, text + " more")]
    expected = min(((3, t) for t in (text, text + " more")), key=lambda r: hashlib.md5(r[1].encode()).digest())
    assert kept_rows(spark, rows) == sorted([expected, rows[2]], key=str)


def test_rows_without_ids(spark):
    text = " ".join(f"w{i}" for i in range(100))
    assert len(kept_rows(spark, [(None, text), (None, text + " end"), (None, "other"), (2, None), (7, "")])) == 3


def test_trees_are_wide_enough():
    """Fingerprints of sets with a similarity of 0.8, of all sizes, are within the radius."""
    rnd = random.Random(5)
    for _ in range(400):
        n = rnd.choice([5, 10, 20, 100, 1000])
        a = np.array([rnd.getrandbits(64) for _ in range(n + n // 4)], np.uint64)
        b = a[: n + n // 8] if rnd.random() < 0.5 else a[n // 4 :]
        if nearcopies.similar(np.unique(a), np.unique(b)):
            assert (nearcopies.majority(a) ^ nearcopies.majority(b)).bit_count() <= nearcopies.RADIUS


def at_threshold(rnd, count):
    """Pairs of hash sets with a similarity of 0.8 exactly, or the least above it."""
    for _ in range(count):
        a, b, common = rnd.choice([(4, 5, 4), (9, 9, 8), (8, 10, 8), (18, 18, 16), (40, 50, 40), (90, 90, 80)])
        both = np.array([rnd.getrandbits(64) for _ in range(a + b - common)], np.uint64)
        yield np.unique(both[:a]), np.unique(both[a - common :])


def keys_of(*made):
    """Rows (key, fp, more) of signatures."""
    fp, more, decided = zip(*made)
    batch = pa.RecordBatch.from_arrays([pa.array(fp, pa.int64()), pa.array(more, pa.int64()), pa.array(decided, pa.binary())], names=["fp", "more", "decided"])
    return [tuple(r.values()) for b in nearcopies.key_rows([batch]) for r in b.to_pylist()]


def test_most_decided_bits_of_the_simhash():
    """A text's shards are told by its SimHash alone: by the bits farthest from half, counted plainly."""
    rnd = random.Random(13)
    hashes = np.array([rnd.getrandbits(64) for _ in range(300)], np.uint64)
    fp, more, decided = nearcopies.signature(hashes)
    for n in (0, 1, nearcopies.WORDS - 1):
        words = []
        for h in hashes.tolist():
            w = h * int(nearcopies._TIMES[n]) % 2**64
            w = (w ^ w >> 32) * int(nearcopies._MIX) % 2**64
            words.append(w ^ w >> 29)
        excess = [2 * sum(w >> b & 1 for w in words) - 300 for b in range(64)]
        bit = max(range(64), key=lambda b: (abs(excess[b]), -b))
        assert decided[n] == 2 * bit + (excess[bit] > 0)
        if n == 0:
            assert more % 2**64 == sum((e > 0) << b for b, e in enumerate(excess))
    assert fp % 2**64 == nearcopies.majority(hashes) and len(keys_of((fp, more, decided))) == nearcopies.WORDS
    assert keys_of(nearcopies.signature(hashes[:3]))[0][0] < 0


def test_texts_at_the_threshold_share_a_shard():
    missed = 0
    for a, b in at_threshold(random.Random(17), 2000):
        x, y = nearcopies.signature(a), nearcopies.signature(b)
        assert sum((i % 2**64 ^ j % 2**64).bit_count() for i, j in zip(x[:2], y[:2])) <= nearcopies.WIDE
        missed += not {r[0] for r in keys_of(x)} & {r[0] for r in keys_of(y)}
    assert missed <= 2


def test_candidates_against_all_pairs_of_a_shard():
    """However rows fall into batches, links connect what all pairs within the bits do; past ``part`` values, all of a key."""
    rnd = random.Random(19)
    base = [rnd.getrandbits(128) for _ in range(4)]
    rows = [(k, rnd.choice(base) ^ sum(1 << rnd.randrange(128) for _ in range(rnd.choice([0, 5, 30, 60]))) % 2**128) for k in sorted(rnd.choices(range(20), k=300))]
    signed = lambda v: v - 2**64 if v >> 63 else v
    for part in (1000, 6):
        expected, found = {}, {}

        def root(of, v):
            while of.setdefault(v, v) != v:
                v = of[v]
            return v

        for n, (k, v) in enumerate(rows):
            for other_key, w in rows[:n]:
                if k == other_key and (part == 6 or (v ^ w).bit_count() <= nearcopies.WIDE):
                    expected[root(expected, v >> 64)] = root(expected, w >> 64)
        for size in (1, 7, 300):
            found.clear()
            columns = [pa.array(c, pa.int64()) for c in zip(*[(k, signed(v >> 64), signed(v % 2**64)) for k, v in rows])]
            batch = pa.RecordBatch.from_arrays(columns, names=["key", "fp", "more"])
            batches = [batch.slice(0, 0), *(batch.slice(at, size) for at in range(0, 300, size))]
            links = [(a.as_py() % 2**64, b.as_py() % 2**64) for out in nearcopies.search_keys(batches, part) for a, b in zip(*out)]
            for a, b in links:
                found[root(found, a)] = root(found, b)
            values = sorted({v >> 64 for _, v in rows})
            assert len(links) < 900
            assert {(a, b) for a in values for b in values if root(found, a) == root(found, b)} == {(a, b) for a in values for b in values if root(expected, a) == root(expected, b)}


def test_links_that_are_followed_grow_with_a_group(spark, monkeypatch):
    """Of a group of near copies, each with many keys, a few links for each text are followed, and the group is one shard."""
    rnd = random.Random(23)
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base[:k] + [f"x{i}", f"y{i}"] + base[k + 2 :]) for i in range(300) for k in [rnd.randrange(98)]]
    docs = spark.createDataFrame([*enumerate(texts), *((300 + i, f"other {i} text of words of its own {i * i}") for i in range(20))], "doc_id long, text string")
    followed = []

    def components(edges):
        followed.append(edges.distinct().count())
        return simhash.components(edges)

    monkeypatch.setattr(nearcopies, "components", components)
    roots = [r["root"] for r in nearcopies.groups(nearcopies.signatures(docs)).collect()]
    assert len(roots) == 320 and max(map(roots.count, roots)) == 300
    assert len(followed) == 1 and followed[0] < 4 * 300


def test_thinned_links_connect_the_same(spark):
    rnd = random.Random(29)
    pairs = {(max(a, b), min(a, b)) for a, b in ((rnd.randrange(-200, 200), rnd.randrange(-200, 200)) for _ in range(260)) if a != b}
    classes = lambda links: sorted(map(tuple, simhash.components(links).collect()))
    found = spark.createDataFrame(sorted(pairs) * 3, "a long, b long")
    thin = nearcopies.thinned(found)
    assert classes(thin) == classes(found) and thin.count() <= len(pairs) and thin.where("a <= b").count() == 0
