import base64
import re

import corpus_pipeline
import pyarrow.parquet as pq
import tiktoken

import __spark_entry__
from foliograph.llm import decontam, queries, toxicity
from foliograph.llm.common import written

from .test_nearcopies import brute_kept
from .test_toxicity import plain_chain

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    """Each stage's rows, from its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = docs.collect()
        out = written(stage(spark, docs, SF), name)
        kept = {r["doc_id"] for r in out.collect()}
        assert out.columns == columns and out.count() == len(kept)
        if name == "toxicity":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            sample = toxicity.sample(docs, labels, list(queries.TOXICITY_CHAIN.values()), toxicity.SAMPLE, "text", "doc_id")
            score, thresholds = plain_chain([t for t, _ in sample], [y for _, y in sample], [toxicity.fold_of(t) for t, _ in sample])
            assert kept == {r["doc_id"] for r in rows if score(r["text"])[-1] < thresholds[-1]} and len(kept) < len(rows)
        elif name == "exact_dedup":
            least = {}
            for r in rows:
                key = re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")
                least[key] = min(r["doc_id"], least.get(key, r["doc_id"]))
            assert kept == set(least.values())
        elif name == "simhash_near_dedup":
            assert kept == brute_kept([(r["doc_id"], r["text"]) for r in rows])
        elif name == "benchmark_decontamination":
            items = [decontam.normal_form(x) for x in pq.read_table(f"{SF}/benchmark.parquet")["text"].to_pylist()]
            found = lambda text: any(decontam.Myers(i).best(text)[0] <= int(decontam.RATE * len(i)) for i in items)
            assert kept == {r["doc_id"] for r in rows if not found(decontam.normal_form(r["text"]))}
        docs = out
    ranks, pattern = queries.ranks()
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}, special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    final = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"]: list(r["token_ids"]) for r in final} == {i: encoding.encode_ordinary(t or "") for i, t in texts.items()}


def test_registered():
    names = list(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_edge_rows_pass_every_stage(spark, edge, empty):
    wide = edge
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, SF).count() == 0
        out = written(stage(spark, wide, SF), name)
        assert out.columns == wide.columns
        wide = out
    kept = [r["doc_id"] for r in wide.collect()]
    assert sorted(kept, key=str) == sorted(set(kept), key=str) and 1 in kept and 2 not in kept
    last = corpus_pipeline.STAGES[-1][1]
    encoded = last(spark, wide, SF).collect()
    assert len(encoded) == len(kept) and all(r["n_tokens"] == len(r["token_ids"]) for r in encoded)
    assert sorted(r["n_tokens"] for r in last(spark, edge, SF).where("doc_id in (3, 4)").collect()) == [0, 0]
    assert last(spark, empty, SF).count() == 0 and "text" not in last(spark, edge, SF).columns
