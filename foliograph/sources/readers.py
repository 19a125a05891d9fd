"""Sources: text, JSON, CSV and binary files, and tables that an adapter decodes from pages."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = (
    "candidate struct<name:string,email:string,phone:string,location:string,linkedin:string,portfolio:string,headline:string,summary:string>, "
    "sections struct<skills:array<struct<name:string,category:string>>,"
    "experience:array<struct<experience_id:string,job_title:string,company:string,location:string,start_date:string,end_date:string,description:string>>,"
    "education:array<struct<education_id:string,degree:string,institution:string,location:string,graduation_year:string>>,"
    "projects:array<struct<project_id:string,name:string,technologies:array<string>,description:string,url:string>>,"
    "certifications:array<struct<name:string,issuer:string,year:string>>,languages:array<struct<name:string,proficiency:string>>>, "
    "source_document struct<source_file:string,source_sha256:string,ingested_at:string,parser_version:string>, "
    "images array<struct<image_id:string,kind:string,source_page:int,file_name:string,relative_path:string,sha256:string,mime_type:string,width:int,height:int>>"
)
MIN_IMAGE = 120
WORDS = "document_id string, page_number int, text string, x0 double, top double, x1 double, bottom double, size double, fontname string"


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, text) of the .md and .txt files in a folder; fails if there are none."""
    rows = spark.read.text(path, wholetext=True, pathGlobFilter="*.{md,txt}").select(F.col("_metadata.file_name").alias("source_file"), F.col("value").alias("text"))
    if rows.isEmpty():
        raise RuntimeError(f"no .md or .txt files in {path}")
    return rows


def json_files(spark: SparkSession, path: str, schema: str = RECORD, pattern: str = "*.json") -> DataFrame:
    """One row for each file, with ``stem`` and, for text that isn't JSON, ``_corrupt_record``."""
    suffix = pattern.lstrip("*").replace(".", r"\.")
    rows = spark.read.schema(schema + ", _corrupt_record string").json(path, multiLine=True, mode="PERMISSIVE", pathGlobFilter=pattern)
    return rows.select("*", F.regexp_replace(F.col("_metadata.file_name"), f"{suffix}$", "").alias("stem"))


def raw_files(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """(file, value): whole files as text, for validation."""
    return spark.read.text(path, wholetext=True, pathGlobFilter=pattern).select(F.col("_metadata.file_name").alias("file"), "value")


def csv_files(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; all values are strings and empty fields null."""
    return spark.read.csv(path, header=True, inferSchema=False)


def binary_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(source_file, content, document_id, source_sha256)."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    digest = F.sha2("content", 256)
    return rows.select(F.col("_metadata.file_name").alias("source_file"), "content", F.concat(F.lit("doc_"), F.substring(digest, 1, 16)).alias("document_id"), digest.alias("source_sha256"))


def decoded(files: DataFrame, decode: Callable[[str, bytes], pd.DataFrame], schema: str = WORDS) -> DataFrame:
    """Rows that an adapter makes of each file (document_id, content): words of pages, tables, links or images. No decoder
    comes with this library."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for id, content in zip(batch["document_id"], batch["content"]):
                yield decode(id, content)

    return files.select("document_id", "content").mapInPandas(run, schema)


ANSWER = "source_file string, text_sha256 string, raw string, error string, calls int"


def answers(files: DataFrame, model: Callable[[str], str], retries: int = 0, in_flight: int = 1) -> DataFrame:
    """(source_file, text_sha256, raw, error, calls): what an external model writes for each text. A call that raises, or an
    answer that isn't a JSON object, is tried again ``retries`` times; then the row has ``error`` and no ``raw``. A task keeps
    ``in_flight`` calls open at once. A null text counts as empty."""

    def ask(text: str | None) -> tuple[str | None, str | None, int]:
        error = None
        for call in range(1, retries + 2):
            try:
                raw = model(text or "")
                if not isinstance(json.loads(raw), dict):
                    raise ValueError("not a JSON object")
                return raw, None, call
            except Exception as e:
                error = f"{type(e).__name__}: {e}"
        return None, error, retries + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                # some calls at a time, so that rows leave as they are answered
                for at in range(0, len(batch), in_flight):
                    part = batch.iloc[at : at + in_flight]
                    found = pd.DataFrame(list(pool.map(ask, part["text"])), columns=["raw", "error", "calls"], index=part.index)
                    yield pd.concat([part[["source_file", "text_sha256"]], found], axis=1)

    return files.select("source_file", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")).mapInPandas(run, ANSWER)


def extracted(files: DataFrame, model: Callable[[str], str], strict: bool = True, retries: int = 0, in_flight: int = 1) -> DataFrame:
    """(source_file, raw): the JSON that an external model writes for each text. ``strict``: a text without an answer stops the
    query; else it's a row without ``raw``. No model comes with this library."""
    rows = answers(files, model, retries, in_flight)
    if strict:
        rows = rows.where(F.when(F.col("raw").isNotNull(), F.lit(True)).otherwise(F.raise_error(F.concat_ws(": ", F.concat(F.lit("extraction failed for "), F.col("source_file")), "error"))))
    return rows.select("source_file", "raw")


def extracted_into(files: DataFrame, model: Callable[[str], str], path: str, waves: int = 1, retries: int = 0, in_flight: int = 1) -> tuple[DataFrame, DataFrame]:
    """(answers, failures) of ``files``, kept in a Parquet table under ``path``: only texts without an answer there are asked, in
    ``waves`` parts (by a hash of the file's name), each of which is kept when it ends. So a job that was stopped goes on where
    it was, and a later call asks again what failed and what has another text. Failures: the last error of each text that has
    no answer."""
    spark = files.sparkSession
    keys = ["source_file", "text_sha256"]
    own = files.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    spark.createDataFrame([], ANSWER).write.mode("append").parquet(path)
    for wave in range(waves):
        held = spark.read.schema(ANSWER).parquet(path).where("raw is not null").select(*keys)
        mine = own.where(F.pmod(F.xxhash64("source_file"), F.lit(waves)) == wave)
        answers(mine.join(held, keys, "left_anti").select("source_file", "text").distinct(), model, retries, in_flight).write.mode("append").parquet(path)
    met = spark.read.schema(ANSWER).parquet(path).join(own.select(*keys).distinct(), keys, "left_semi")
    last = met.groupBy(*keys).agg(F.max("raw").alias("raw"), F.max("error").alias("error"), F.sum("calls").alias("calls"))
    return last.where("raw is not null").select("source_file", "raw"), last.where("raw is null").select("source_file", "error", "calls")


def available(probe: Callable[[], object]) -> bool:
    """Whether an external service answers."""
    try:
        probe()
    except Exception:
        return False
    return True


def large_images(images: DataFrame, least: int = MIN_IMAGE) -> DataFrame:
    return images.where((F.col("width") >= least) & (F.col("height") >= least))


def paired_images(pages: DataFrame, places: str = "places", files: str = "files") -> DataFrame:
    """Image places and image files of a page, paired by position as far as both go."""
    return pages.select("*", F.posexplode(F.arrays_zip(places, files)).alias("index", "pair")).where(F.col(f"pair.{places}").isNotNull() & F.col(f"pair.{files}").isNotNull())


def links(pages: DataFrame, id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, index, uri): the targets of a page's links, numbered from 1."""
    uris = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit('<a [^>]*?href="([^"]*)"'), F.lit(1))
    return pages.select(id, F.posexplode(uris).alias("pos", "uri")).select(id, (F.col("pos") + 1).cast("int").alias("index"), "uri")


def text_with_links(pages: DataFrame, document: str = "document_id", page: str = "page_number", text: str = "text", uris: str = "uris") -> DataFrame:
    """(document, text): page texts in order, a blank line between them, then the links without repeats."""
    ordered = pages.groupBy(document).agg(F.array_sort(F.collect_list(F.struct(page, text, uris))).alias("p"))
    all_uris = F.array_distinct(F.filter(F.flatten(F.transform("p", lambda x: F.coalesce(x[uris], F.array().cast("array<string>")))), lambda u: u != ""))
    body = F.array_join(F.transform("p", lambda x: F.coalesce(x[text], F.lit(""))), "\n\n")
    return ordered.select(document, F.when(F.size(all_uris) > 0, F.concat(body, F.lit("\n\n[EMBEDDED LINKS]\n"), F.array_join(all_uris, "\n"))).otherwise(body).alias("text"))
