"""The corpus pipeline: documents in, token ids out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's ``docs``. All but the last return the columns of ``docs``. Rows are judged one by
one, by id and text: rows of one id with different texts are different rows, and a row without an id gives way to a copy
that has one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm import bpe, decontam, exact, nearcopies, queries, toxicity
from foliograph.llm.common import removed, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain's last category rejects go."""
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), queries.TOXICITY_CHAIN)
    return toxicity.reject(docs, chain, "toxic")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays, and one row of it: the one whose columns, as JSON, have the
    smallest MD5."""
    marks = written(exact.exact_duplicates(docs).select("doc_id", F.col("text_sha256").alias("key"), "kept"), "marks")
    several = marks.where("kept").groupBy("doc_id", "key").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "key")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    chosen = matching(docs, exact.text_digest(), several, "left_semi").groupBy(key_of(docs)).agg(F.min_by(row, F.md5(F.to_json(row))).alias("row"))
    rest = matching(docs, exact.text_digest(), marks.where("not kept").select("doc_id", "key").distinct().union(several), "left_anti")
    return rest.select(*[f"`{c}`" for c in docs.columns]).union(chosen.select("row.*"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 on runs of five words, the one with the smallest id stays."""
    gone = nearcopies.near_copies(docs).where("not kept").select("doc_id", F.col("node").alias("key")).distinct()
    return matching(docs, nearcopies.text_key(), gone, "left_anti").select(*[f"`{c}`" for c in docs.columns])


def key_of(docs: DataFrame) -> str:
    """A name that no column of ``docs`` has, in any case."""
    name, taken = "__key", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def matching(docs: DataFrame, key: Column, judged: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` whose id and ``key`` are, or aren't, among ``judged`` (doc_id, key); with the key as ``key_of`` the
    docs. What goes grows with the documents, so it's merged at every size; what is looked up is rare and left to the
    planner."""
    name = key_of(docs)
    own, those = docs.withColumn(name, key).alias("own"), written(judged, "judged").alias("those")
    return own.join(those.hint("merge") if how == "left_anti" else those, F.col("own.doc_id").eqNullSafe(F.col("those.doc_id")) & (F.col(f"own.{name}") == F.col("those.key")), how)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go."""
    return decontam.reject(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids in place of its text."""
    return bpe.encode(docs, *queries.ranks(), keep=[c for c in docs.columns if c != "text"])


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), name)
        removed(before)
    return STAGES[-1][1](spark, docs, sf_dir)
