"""Helpers shared by the operators: the cluster's shared folder, written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where that is unset, a temporary one in a session whose
    executors run on this machine, as in tests; an error on a cluster, whose executors would each write to their own disk."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="foliograph-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/foliograph/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet, with the writer's ``options``, in the shared folder and read it back: the lineage ends there,
    so a lost executor costs no recomputation of what came before, and all readers see the same rows."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def removed(*tables: DataFrame) -> None:
    """Delete the folders of ``written`` tables that nothing will read again."""
    for df in tables:
        if path := getattr(df, "_written", None):
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def least_hashes(h: Column, wanted: int, of: Column) -> Column:
    """Whether the hash ``h`` (long) can be among the ``wanted`` smallest of ``of`` rows: true for about 20 times as many rows
    as are wanted, spread evenly over the tasks, so that a top-k over the hash gathers no more from many tasks than from few."""
    share = F.lit(20.0 * wanted) / F.greatest(of, F.lit(1))
    return h.cast("double") <= F.lit(-(2.0**63)) + F.least(share, F.lit(1.0)) * F.lit(2.0**64)
