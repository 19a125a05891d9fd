import zlib
from collections import Counter

import pytest

from foliograph.llm import queries, sharding


@pytest.mark.parametrize("fan_out", [4096, 2])
def test_law_and_slots(spark, edge, empty, fan_out):
    rows = sharding.shard(edge, 5, bucket_bytes=64_000, fan_out=fan_out).collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in edge.collect())
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    assert sharding.shard(empty, 5).count() == 0


def test_order_is_shuffled_and_seeded(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "string(id) AS text").repartition(3)
    order = [r["doc_id"] for r in sharding.shard(docs, 1, bucket_bytes=2000).orderBy("slot").collect()]
    assert sorted(order) == list(range(2000)) and order != sorted(order)
    inversions = sum(a > b for a, b in zip(order, order[1:]))
    assert 900 < inversions < 1100
    other = [r["doc_id"] for r in sharding.shard(docs, 1, bucket_bytes=2000, seed=1).orderBy("slot").collect()]
    assert sum(a == b for a, b in zip(order, other)) < 20


def places(df, **options):
    return sorted((r["shard"], r["slot"], r["doc_id"], r["text"]) for r in sharding.shard(df, 7, bucket_bytes=1500, **options).collect())


@pytest.mark.parametrize("fan_out", [4096, 2])
def test_places_depend_on_records_and_seed_alone(spark, tmp_path, fan_out):
    """Whatever the files and partitions, with repeated rows."""
    docs = spark.range(400).selectExpr("id % 300 AS doc_id", "concat('text ', id % 300) AS text").union(spark.range(200).selectExpr("5L", "'same'"))
    docs.repartition(9).write.parquet(str(tmp_path / "nine"))
    docs.coalesce(1).orderBy("text").write.parquet(str(tmp_path / "one"))
    nine, one = (spark.read.parquet(str(tmp_path / n)) for n in ("nine", "one"))
    expected = places(nine, fan_out=fan_out)
    assert expected == places(one, fan_out=fan_out) == places(one.repartition(13), fan_out=fan_out)
    assert sharding.shuffled_buckets(nine, bucket_bytes=1500)[1] > 4


def test_hot_rows_are_scattered(spark):
    docs = spark.range(3000).selectExpr("1L AS doc_id", "'same' AS text")
    buckets, n = sharding.shuffled_buckets(docs, bucket_bytes=1200)
    assert n > 20 and max(r["count"] for r in buckets.groupBy("bucket").count().collect()) < 4 * 3000 / n


def test_query(spark):
    rows = queries.op4_external_shuffle_shards(spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    assert {(r["shard"], r["slot"]) for r in rows} == {(s, k) for s, n in counts.items() for k in range(n)}
    for r in rows:
        data = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "rows", None)


def test_written_shards(spark, edge, tmp_path):
    sharding.write_shards(edge, str(tmp_path / "out"), 3)
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 3
    with pytest.raises(Exception, match="(?i)exist"):
        sharding.write_shards(edge, str(tmp_path / "out"), 3)
