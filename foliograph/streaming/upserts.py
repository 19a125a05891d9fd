"""Continuous loads: files or tables as streams, each micro-batch upserted. The merge is the batch one, so a batch that
runs again after a failure changes nothing.

Store. Rows are in ``BUCKETS`` buckets by the hash of their id. A micro-batch rewrites only the buckets that it touches, as
a new version, and then writes that version's list: for each bucket the version that holds it. Readers go by the last
list, so a failed write never touches what they see, and a stream with a new checkpoint goes on where the store is.
Versions that neither of the last two lists names are deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import graph, parse, vector
from ..sources.sinks import last_version

BUCKETS = 64


def text_stream(spark: SparkSession, path: str) -> DataFrame:
    """New .md and .txt files of a folder as (source_file, text)."""
    rows = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.{md,txt}").load(path)
    return rows.select(F.col("_metadata.file_name").alias("source_file"), F.col("value").alias("text"))


def _listed(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    """The version of each bucket: ``BUCKETS`` rows at most."""
    return {r["bucket"]: r["at"] for r in spark.read.parquet(f"{path}/version={version}/list").collect()} if version >= 0 else {}


def _read(spark: SparkSession, path: str, buckets: dict[int, int]) -> DataFrame | None:
    folders = [f"{path}/version={v}/rows/bucket={b}" for b, v in sorted(buckets.items())]
    return spark.read.parquet(*folders) if folders else None


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a store."""
    return _read(spark, path, _listed(spark, path, last_version(spark, path, "list")))


def upsert_store(rows: DataFrame, path: str, merge: Callable[[DataFrame, DataFrame], DataFrame], id: str = "id") -> None:
    """Merge ``rows`` into the store: ``merge(old, new)`` of the buckets that they touch."""
    spark = rows.sparkSession
    before = last_version(spark, path, "list")
    listed = _listed(spark, path, before)
    bucket = F.pmod(F.xxhash64(id), F.lit(BUCKETS)).cast("int").alias("bucket")
    touched = [r[0] for r in rows.select(bucket).distinct().collect()]
    old = _read(spark, path, {b: v for b, v in listed.items() if b in set(touched)})
    merged, new = (rows if old is None else merge(old, rows)), before + 1
    merged.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={new}/rows")
    now = listed | {b: new for b in touched}
    spark.createDataFrame(sorted(now.items()), "bucket int, at int").coalesce(1).write.mode("overwrite").parquet(f"{path}/version={new}/list")
    used = set(listed.values()) | set(now.values()) | {before, new}
    for version in range(new):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={version}")
        if version not in used:
            at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def load_collection(documents: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Upsert the section documents of streamed texts into the collection under ``path``."""

    def each(batch: DataFrame, epoch: int) -> None:
        parsed = parse.parse(batch)
        # of two files with one person, the later in the order of names wins, as for nodes
        rows = vector.section_documents(parsed).select("id", "document", F.col("metadata.source_file").alias("file"))
        upsert_store(rows.groupBy("id").agg(F.max_by("document", F.struct("file", "document")).alias("document")), path, vector.upsert)

    return documents.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def load_nodes(documents: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Merge the domain graph's nodes of streamed texts into the store under ``path``; later batches win."""

    def each(batch: DataFrame, epoch: int) -> None:
        nodes = graph.merge_nodes(graph.domain_graph(parse.parse(batch))[0]).select("id", "label", "properties")
        upsert_store(nodes, path, lambda old, new: graph.upsert_nodes(old, new.withColumn("ordinal", F.lit(0))))

    return documents.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
