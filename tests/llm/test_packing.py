import random
import struct
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from foliograph.llm import packing, queries  # noqa: E402


@pytest.fixture(scope="module")
def definition():
    return queries.definition("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole(definition):
    encode = tokenizers.Tokenizer.from_str(definition).encode
    return lambda text: [*encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, docs):
    """Every id of every document in one piece, sequences without gaps or padding."""
    left, sequences = {}, {}
    for doc_id, ids in docs:
        left.setdefault((doc_id, len(ids)), []).append(ids)
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= 2048 and at & (at - 1) == 0
    got = {}
    for p in pieces:
        got.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], p["length"], p["ids_crc32"]))
    assert sorted(got, key=str) == sorted(left, key=str)
    for key, own in got.items():
        copies = left[key]
        assert sum(length for _, length, _ in own) == key[1] * len(copies)
        for start, length, crc in own:
            assert crc in {zlib.crc32(struct.pack(f"<{length}I", *ids[start : start + length])) for ids in copies}
        if len(copies) == 1:
            at = 0
            for start, length, _ in sorted(own):
                assert start == at
                at += length
    return sequences


def test_same_ids_as_the_library(definition, whole, texts):
    words = packing.Words(definition)
    rnd = random.Random(5)
    parts = ["a", "H", "|", " | ", "~", ",", "!!", ";a.", "b,", "\u0331", "THE", "<|ENDOFTEXT|>", "B'", "'s", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "é", "é", "́", ".", "1", "23", "　", "x y", "\0", "<|endoftext|>", "<|startoftext|>", "İ", "Σ", "漢", "\U0001f600", "​", " "]
    samples = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(16))) for _ in range(3000)] + ["ab" * 20_000] + [t for _, t, _ in texts[:60]]
    for text, ids in zip(samples, words.encode(samples)):
        assert [*np.frombuffer(ids, words.kind), 1] == whole(text), repr(text)


def test_rows(spark, edge, empty, definition, whole):
    found = packing.pack(edge, definition, ids=True).collect()
    docs = [(r["doc_id"], whole(r["text"])) for r in edge.collect()]
    check(found, docs)
    for p in found:
        assert p["token_ids"] in [ids[p["start"] : p["start"] + p["length"]] for d, ids in docs if d == p["doc_id"]]
    assert packing.pack(empty, definition).count() == 0
    with pytest.raises(ValueError):
        packing.pack(empty, definition, length=1000)


def test_query_against_the_library(spark, whole):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    found = queries.op12_hilbert_packing(spark, sf).collect()
    sequences = check(found, [(r["doc_id"], whole(r["text"])) for r in rows])
    short = sum(sum(length for _, length in own) < 2048 for own in sequences.values())
    assert short <= 11 * 4  # at most as many as a length has powers of two, in each range


def test_the_curve_is_hilberts():
    """Every cell once, and each next to the one before."""
    for bits, dimensions in ((1, 2), (3, 2), (2, 3), (2, 4)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
        key = packing.hilbert(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_neighbours_are_alike(spark, definition):
    """Documents next to each other along the curve share their language far more often than documents at random."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null and length(text) > 200")
    langs = {r["doc_id"]: r["lang"] for r in df.collect()}
    order = sorted(packing.pack(df, definition).where("start = 0").collect(), key=lambda p: (p["sequence_id"], p["offset"]))
    same = np.mean([langs[a["doc_id"]] == langs[b["doc_id"]] for a, b in zip(order, order[1:])])
    shares = np.array([list(langs.values()).count(x) for x in set(langs.values())]) / len(langs)
    assert same > (shares**2).sum() + 0.3


def test_a_hot_text_is_dealt_to_several_ranges(spark, definition):
    df = spark.createDataFrame([(i, "one text that all the rows have") for i in range(4000)], "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = packing.pack(df, definition).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges = {}
    for p in found:
        ranges[p["sequence_id"] >> 33] = ranges.get(p["sequence_id"] >> 33, 0) + p["length"]
    assert len(ranges) >= 3 and max(ranges.values()) < 0.5 * sum(ranges.values())
