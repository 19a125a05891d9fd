"""Sharding by a two-pass external shuffle, in DataFrame operations only.

Pass one scatters the records uniformly into memory-sized buckets by a seeded hash of a record's MD5 (of all its columns)
and, for records alike in all columns, a number among those. So neither copies nor a hot source nor repeated rows fill a
bucket, and places depend on the seed and the records alone, not on files, partitions or the order in which blocks come.
Each bucket, sorted by those hashes, is shuffled as a whole (``shuffle`` is a Fisher-Yates over the array; its random
numbers go on from bucket to bucket of a partition, so these are sorted, too) and written with its records' places in the
global order: the records in the buckets before it are counted first. Pass two reads the written buckets and deals that order out like
cards: the record at place p goes to shard p mod n, slot p div n. So the law is ``rows``: shard sizes differ by one record
at most, slots have no gaps.

Scale. A shuffle has at most ``FAN_OUT`` buckets. For more, the records are first scattered into folders of ``FAN_OUT``
neighbouring buckets each, and the folders are worked off one after the other; a bucket has the same records either way.
What is broadcast is a row for each bucket of one folder. Counts, repeats and offsets come from a table of
digests and sizes, so texts are shuffled once, and once more where there are folders.

Results for special cases: a null text has size 8 and CRC 0, like the empty one; a null ``doc_id`` or repeated rows are
records like others; an empty table gives an empty one; other columns pass through, and those with the names of new ones
give way to them. ``write_shards`` fails if its path exists.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import new_folder, removed, written

#: Bytes of text and row overhead in a bucket.
BUCKET_BYTES = 8_000_000
#: Buckets of one shuffle.
FAN_OUT = 4096
LAW = "rows"


def size_of(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 8).cast("long")


def _place(seed: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "digest", "number"), F.lit(buckets)).cast("int")


def _starts(sizes: DataFrame) -> DataFrame:
    """(bucket, start): records in the buckets before. Sums run within groups of ``FAN_OUT`` buckets and over these groups."""
    group = F.floor(F.col("bucket") / FAN_OUT)
    grouped = sizes.withColumn("folder", group)
    inside = Window.partitionBy("folder").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("folder").rowsBetween(Window.unboundedPreceding, -1)
    base = grouped.groupBy("folder").agg(F.sum("n").alias("n")).select("folder", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
    return grouped.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(base, "folder").select("folder", "bucket", (F.col("base") + F.col("before")).alias("start"))


def shuffled_buckets(df: DataFrame, text: str = "text", seed: int = 0, bucket_bytes: int = BUCKET_BYTES, fan_out: int = FAN_OUT) -> tuple[DataFrame, int]:
    """Pass one: (bucket, place, record) written in the shared folder, and the number of buckets."""
    spark = df.sparkSession
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    digest = F.unhex(F.md5(F.to_json(record, {"ignoreNullFields": "false"})))
    marks = written(df.select(digest.alias("digest"), size_of(text).alias("size")), "marks")
    buckets = int((marks.agg(F.sum("size")).first()[0] or 0) // bucket_bytes + 1)
    repeats = written(marks.groupBy("digest").agg(F.count("*").alias("copies")).where("copies > 1"), "repeats")

    def numbered(rows: DataFrame, *columns: str) -> DataFrame:
        """``rows`` with ``number``: 0, 1, ... among rows alike. Which of these gets which number makes no difference, so one
        of them stands for all."""
        single = rows.join(repeats, "digest", "left_anti").select("digest", *columns, F.lit(0).cast("long").alias("number"))
        several = rows.join(repeats, "digest").groupBy("digest").agg(F.first("copies").alias("copies"), *[F.first(c).alias(c) for c in columns])
        return single.union(several.select("digest", *columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("number")))

    place = _place(seed, buckets)
    starts = written(_starts(numbered(marks.select("digest")).groupBy(place.alias("bucket")).agg(F.count("*").alias("n"))), "starts")
    rows = numbered(df.select(digest.alias("digest"), record.alias("record")), "record").withColumn("bucket", place)
    folders, scattered = [None], rows
    if buckets > fan_out:
        folder = F.floor(F.col("bucket") / fan_out).cast("int")
        at = new_folder(spark, "folders")
        # each folder's records come from as many tasks as it has shares
        rows.withColumn("folder", folder).repartition(fan_out, "folder", F.pmod(F.xxhash64("digest", "number"), F.lit(64))).write.partitionBy("folder").parquet(at)
        scattered = spark.read.parquet(at)
        scattered._written = at
        folders = range(-(-buckets // fan_out))
    out = []
    for n in folders:
        first = (n or 0) * fan_out
        mine = scattered if n is None else scattered.where(F.col("folder") == n)
        own = starts.where(F.col("bucket").between(first, first + fan_out - 1)).select("bucket", "start")
        arrays = (
            mine.repartition(min(fan_out, buckets - first), "bucket")
            .groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("digest", "number", "record")), _by_digest).alias("records"))
            .sortWithinPartitions("bucket")
            .select("bucket", F.shuffle("records", F.lit(seed)).alias("records"))
        )
        placed = arrays.join(F.broadcast(own), "bucket").select("bucket", "start", F.posexplode("records").alias("pos", "r"))
        out.append(written(placed.select("bucket", (F.col("start") + F.col("pos")).alias("place"), "r.record"), "buckets"))
    removed(marks, repeats, starts, scattered)
    return reduce(DataFrame.union, out), buckets


def _by_digest(a: Column, b: Column) -> Column:
    key = lambda r: F.struct(r["digest"], r["number"])
    return F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)


def shard(df: DataFrame, shards: int, text: str = "text", seed: int = 0, bucket_bytes: int = BUCKET_BYTES, fan_out: int = FAN_OUT) -> DataFrame:
    """The records of ``df`` with ``law``, ``shard`` and ``slot``."""
    rows, _ = shuffled_buckets(df, text, seed, bucket_bytes, fan_out)
    own = [F.col(f"record.`{c}`") for c in df.columns if c not in ("law", "shard", "slot")]
    return rows.select(*own, F.lit(LAW).alias("law"), (F.col("place") % shards).cast("int").alias("shard"), F.floor(F.col("place") / F.lit(shards)).cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str, shards: int, **options) -> None:
    """Parquet files in a folder for each shard, each file sorted by slot."""
    shard(df, shards, **options).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
