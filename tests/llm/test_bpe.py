import base64
import hashlib
import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from foliograph.llm import bpe, queries  # noqa: E402


@pytest.fixture(scope="module")
def ranks():
    return queries.ranks()


@pytest.fixture(scope="module")
def encoding(ranks):
    known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks[0].splitlines())}
    return tiktoken.Encoding("own", pat_str=ranks[1], mergeable_ranks=known, special_tokens={})


def test_every_token_is_reached_by_merges(ranks):
    own = bpe.ByteBpe(bpe.read_ranks(ranks[0]), ranks[1])
    for i, token in enumerate(own.tokens):
        assert own.model.encode(bpe.letters(token)) == [i + 1]


def test_same_ids_as_the_library(ranks, encoding, texts):
    own = bpe.ByteBpe(bpe.read_ranks(ranks[0]), ranks[1])
    rnd = random.Random(5)
    parts = ["a", "b'", "'s", " ", "  ", "\n", "\t", "\r\n", "é", ".", "1", "　", "\x1c", "x y", "\0", "<|endoftext|>", "漢", "\U0001f600"]
    samples = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(16))) for _ in range(3000)] + ["ab" * 20_000] + [t for _, t, _ in texts[:60]]
    for text, ids in zip(samples, own.encode_batch(samples)):
        assert ids == encoding.encode_ordinary(text), repr(text)
        assert own.decode(ids) == text.encode()


def test_rows(spark, edge, empty, ranks, encoding):
    rows = bpe.encode(edge, *ranks, digests=True)
    assert rows.columns[: len(edge.columns)] == edge.columns
    for r in rows.collect():
        ids = encoding.encode_ordinary(r["text"] or "")
        assert (r["n_tokens"], list(r["token_ids"])) == (len(ids), ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    back = bpe.decode(rows.select("text", "token_ids"), ranks[0]).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)
    assert bpe.encode(empty, *ranks).count() == 0


def test_a_vocabulary_with_gaps_is_refused(ranks):
    known = bpe.read_ranks(ranks[0])
    with pytest.raises(ValueError):
        bpe.ByteBpe({k: v for k, v in known.items() if v != 5}, ranks[1])


def test_query_against_the_library(spark, encoding):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op1_byte_bpe(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        ids = encoding.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_decoding_of_rows(spark, ranks, encoding):
    """Null ids, no ids, bytes that aren't UTF-8, and a column with the name of the result."""
    broken = encoding.encode_ordinary("é")[:1] if len(encoding.encode_ordinary("é")) > 1 else [next(i for b, i in encoding._mergeable_ranks.items() if b == b"\xc3")]
    rows = [(1, encoding.encode_ordinary("a b\n漢"), "old"), (2, None, "old"), (3, [], "old"), (4, broken, None)]
    found = bpe.decode(spark.createDataFrame(rows, "doc_id long, token_ids array<int>, decoded string"), ranks[0])
    assert found.columns == ["doc_id", "token_ids", "decoded"]
    assert {r["doc_id"]: r["decoded"] for r in found.collect()} == {1: "a b\n漢", 2: None, 3: "", 4: "�"}
