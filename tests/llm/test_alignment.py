import collections
import hashlib
import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from pyspark.sql import functions as F  # noqa: E402

from foliograph.llm import alignment as A  # noqa: E402
from foliograph.llm import queries  # noqa: E402

PARTS = ["a", "B'", "'s", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "é", "é", "ﬁ", ".", "1", "23", "　", "x y", "\0", "▁", "<|endoftext|>", "<s>", "<0x41>", "漢字", "\U0001f600", "the other thing", "==="]


@pytest.fixture(scope="module")
def files():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return queries.definition("byte_bpe_50k.json"), file.read()


@pytest.fixture(scope="module")
def whole(files):
    """The tokens (id, bytes) of a whole text by both libraries."""
    a = tokenizers.Tokenizer.from_str(files[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=files[1])
    letters = A.byte_letters()
    of_a = {i: bytes(letters[c] for c in p if c in letters) for p, i in a.get_vocab().items()}

    def of_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(text):
        both = [(i, of_a[i]) for i in a.encode(" " + text, add_special_tokens=False).ids], [(i, of_b(i)) for i in b.encode(text)]
        return both if text and all(b"".join(p for _, p in x) == (" " + text).encode() for x in both) else ([], [])

    return encode


def detail(text, whole):
    spans = []
    for tokens in whole(text):
        at, own = 0, []
        for i, piece in tokens:
            own.append((i, at, at + len(piece)))
            at += len(piece)
        spans.append(own)
    links = [(i, j) for i, s, e in spans[0] for j, t, u in spans[1] if s < u and t < e]
    cuts, groups = [0, *sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})], []
    for since, until in zip(cuts, cuts[1:]):
        groups.append("|".join(",".join(str(i) for i, s, e in own if since <= s and e <= until) for own in spans))
    return len(spans[0]), len(spans[1]), len(groups), links, ";".join(groups)


def plain(texts, whole, parts=lambda text: [text] if text else []):
    """The query's columns for each text, by comparing all tokens with all, of a text or of its parts."""
    known, counts, best = {}, collections.Counter(), collections.defaultdict(int)
    for text in texts:
        for part in parts(text):
            if part not in known:
                known[part] = detail(part, whole)
            counts.update(known[part][3])
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for text in texts:
        found = [known[p] for p in parts(text)]
        links, groups = [x for f in found for x in f[3]], ";".join(f[4] for f in found)
        out.append((*(sum(f[k] for f in found) for k in range(3)), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), groups and hashlib.sha256(groups.encode()).hexdigest()))
    return out


def samples(n):
    rnd = random.Random(7)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(20))) for _ in range(n)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_against_all_pairs(spark, files, whole):
    texts = [*samples(600), "ab" * 1500, "漢" * 400, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(i, *x) for i, x in enumerate(plain(texts, whole))]
    assert sum(x[1] > 0 for x in want) > 300 and sum(x[1] == 0 for x in want) > 20
    assert rows(A.alignment(df, *files)) == want
    for few, most in ((1, 40), (64, 0)):  # no part looked up, only the most frequent pairs broadcast; no pair broadcast
        rows_ = A.written(A.align(A.tokenised(df.repartition(3), *files, chunk=500), digests=True, few=few), "aligned")
        found = A.scored(rows_, most).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
        assert rows(found) == want


def test_groups_and_links_themselves(spark, files, whole):
    text = "Überraschung: unbelievably 漢字 \U0001f600!"
    found = A.align(A.tokenised(spark.createDataFrame([(1, text)], "doc_id long, text string"), *files))
    groups = found.first()["groups"]
    a, b = whole(text)
    assert [i for g in groups.split(";") for i in map(int, g.split("|")[0].split(","))] == [i for i, _ in a]
    assert [i for g in groups.split(";") for i in map(int, g.split("|")[1].split(","))] == [i for i, _ in b]
    pairs = found.select(F.explode("links").alias("l")).select((F.col("l") / A.PAIR).cast("long").alias("a"), A.b_of(F.col("l")).alias("b")).collect()
    assert {r["a"] for r in pairs} == {i for i, _ in a} and {r["b"] for r in pairs} == {i for i, _ in b}


def test_edges(spark, edge, empty, files, whole):
    docs = edge.collect()
    want = sorted(((r["doc_id"], *x) for r, x in zip(docs, plain([r["text"] if r["doc_id"] != 6 else "word " * 40 for r in docs], whole))), key=str)
    short = edge.withColumn("text", F.when(F.col("doc_id") == 6, "word " * 40).otherwise(F.col("text")))
    assert sorted((tuple(r) for r in A.alignment(short, *files).collect()), key=str) == want
    assert A.alignment(edge, *files).where("doc_id = 6").first()["n_a"] > 40_000
    assert A.alignment(empty, *files).count() == 0


def test_a_vocabulary_without_ranks(files):
    """The file's own library, where merges aren't in the order of ids, and whole texts, where parts can't be told."""
    import json

    rules = json.loads(files[0])
    rules["model"]["merges"][:2] = rules["model"]["merges"][1::-1]
    ranks, slow = A.ByteTokens(files[0]), A.ByteTokens(json.dumps(rules))
    texts = [f" {t}" for t in samples(300)]
    assert ranks.encode(texts) == slow.encode(texts)
    rules["normalizer"] = {"type": "NFC"}
    assert ranks.apart and not A.ByteTokens(json.dumps(rules)).apart


def test_query_against_all_pairs(spark, whole):
    """All pairs of the words of each text, which are told by lone spaces here: those of a long text would take too long."""
    sf = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert not any(t and ("  " in t or t != t.strip()) for _, t in docs)
    want = plain([t for _, t in docs], whole, lambda text: text.split(" ") if text else [])
    assert rows(queries.op13_token_alignment(spark, sf)) == [(d, *x) for (d, _), x in zip(docs, want)]


def test_parts_are_encoded_many_at_a_time(files, whole, monkeypatch):
    """Words go to either library some dozens at least in a call, and a word that doesn't fit costs its neighbours nothing."""
    import pyarrow as pa

    pair, calls = A.Pair(*files), []
    for tokens in pair.both:
        monkeypatch.setattr(tokens, "encode", lambda parts, f=tokens.encode: calls.append(parts) or f(parts))
    words = [f" {a}{b}{c}" for a in "aehr" for b in ("ing", "é", "漢", "'s") for c in ("", "ble", "12", ".")]
    runs = pair.tokens(pa.array(words, pa.large_string()))
    assert len(runs) == 1 and sum(map(len, calls)) <= 1 + len(words) // 30
    for k in (0, 1):
        ids, until = runs[0][2 * k], [0, *runs[0][2 * k + 1]]
        assert [ids[i:j].tolist() for i, j in zip(until, until[1:])] == [[i for i, _ in whole(w[1:])[k]] for w in words]
    mixed = pair.tokens(pa.array([*words[:9], " ▁", *words[9:]], pa.large_string()))
    sizes = [n for run in mixed for n in [run[1][0], *(run[1][1:] - run[1][:-1])]]
    assert sizes == [len(whole(w[1:])[0]) for w in words[:9]] + [0] + [len(whole(w[1:])[0]) for w in words[9:]]
