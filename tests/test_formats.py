"""Pages read through a decoder, records as named files, and a model's answers with failures."""

import json
import os

import pytest
from pyspark.sql import functions as F

from foliograph.operators import layout, parse
from foliograph.sources import formats, readers, sinks

DECODER = "tests.stub_decoder:File"


@pytest.fixture
def folder(tmp_path):
    for name, data in (("a.pdf", b"one two\fthree http://x.test\fbroken\flast"), ("b.pdf", b"BAD"), ("c.pdf", b""), ("d.txt", b"no")):
        (tmp_path / name).write_bytes(data)
    return str(tmp_path)


def read(spark, path, **options):
    formats.register(spark)
    reader = spark.read.format("pages").option("decoder", DECODER)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


@pytest.mark.parametrize("step", [0, 1, 3])
def test_pages_and_their_errors(spark, folder, step):
    rows = read(spark, folder, pagesPerPartition=step)
    assert rows.rdd.getNumPartitions() == {0: 3, 1: 6, 3: 4}[step]
    found = sorted((r["source_file"], r["page_number"], r["text"], r["error"]) for r in rows.collect() if r["error"] is None)
    assert found == [("a.pdf", 1, "one", None), ("a.pdf", 1, "two", None), ("a.pdf", 2, "http://x.test", None), ("a.pdf", 2, "three", None), ("a.pdf", 4, "last", None)]
    errors = sorted((r["source_file"], r["page_number"], r["error"]) for r in rows.where("error is not null").collect())
    assert errors == [("a.pdf", 3, "ValueError: broken page"), ("b.pdf", 0, "ValueError: no such format")]


def test_kinds_of_rows(spark, folder):
    links = read(spark, folder, kind="links").where("error is null").collect()
    assert [(r["source_file"], r["page_number"], r["index"], r["uri"], r["x0"]) for r in links] == [("a.pdf", 2, 1, "http://x.test", None)]
    tables = read(spark, f"file://{folder}/a.pdf", kind="tables").where("error is null")
    assert tables.count() == 3 and tables.first()["rows"] == [["a", None]]
    words = read(spark, folder).where("error is null").withColumnRenamed("source_file", "document_id")
    assert sorted(r["text"] for r in layout.lines(words).collect()) == ["last", "one two", "three http://x.test"]
    assert read(spark, folder, pattern=".none").count() == 0


def test_named_files(spark, tmp_path):
    records = parse.parse(spark.createDataFrame([("ann.md", "# Änn\nEmail: a@x.test\n\n[SKILLS]\nSQL | Data\n"), ("bob.md", "# Bob\n")], "source_file string, text string"))
    path = str(tmp_path / "out")
    sinks.record_files(records, path)
    assert sorted(os.listdir(path)) == ["ann.json", "bob.json"]
    text = (tmp_path / "out" / "ann.json").read_text(encoding="utf-8")
    record = json.loads(text)
    assert text == json.dumps(record, indent=2, ensure_ascii=False) and "Änn" in text and "stem" not in record
    assert list(record["candidate"])[:2] == ["name", "email"] and record["sections"]["skills"] == [{"name": "SQL", "category": "Data"}]
    assert {r["stem"] for r in readers.json_files(spark, path).where("_corrupt_record is null").collect()} == {"ann", "bob"}
    (tmp_path / "out" / "other.json").write_text("{}")
    sinks.record_files(records.where("stem = 'bob'").withColumn("candidate", F.col("candidate").withField("name", F.lit("Rob"))), path)
    assert sorted(os.listdir(path)) == ["ann.json", "bob.json", "other.json"]
    assert json.loads((tmp_path / "out" / "bob.json").read_text())["candidate"]["name"] == "Rob"
    with pytest.raises(Exception, match="repeated stem"):
        sinks.record_files(records.union(records), path)
    with pytest.raises(Exception, match="not a file's name"):
        sinks.record_files(records.withColumn("stem", F.concat(F.lit("../"), "stem")), path)
    assert sorted(os.listdir(path)) == ["ann.json", "bob.json", "other.json"]


FILES = [("a.md", "good a"), ("b.md", "bad b"), ("c.md", "good c"), ("d.md", None), ("e.md", "list")]


def answering(log):
    def model(text):
        with open(log, "a") as out:
            out.write(f"{text}\n")
        if text.startswith("bad"):
            raise TimeoutError("too slow")
        return "[1]" if text == "list" else json.dumps({"of": text})

    return model


def test_a_bad_answer_costs_one_row(spark, tmp_path):
    files = spark.createDataFrame(FILES, "source_file string, text string")
    rows = {r["source_file"]: r for r in readers.answers(files, answering(tmp_path / "log"), retries=1, in_flight=3).collect()}
    assert {k: (json.loads(r["raw"])["of"] if r["raw"] else r["error"], r["calls"]) for k, r in rows.items()} == {
        "a.md": ("good a", 1), "b.md": ("TimeoutError: too slow", 2), "c.md": ("good c", 1), "d.md": ("", 1), "e.md": ("ValueError: not a JSON object", 2)
    }
    assert readers.extracted(files, answering(tmp_path / "log"), strict=False).where("raw is null").count() == 2
    with pytest.raises(Exception, match="extraction failed for b.md"):
        readers.extracted(files.where("source_file = 'b.md'"), answering(tmp_path / "log")).collect()


def test_only_what_is_missing_is_asked_again(spark, tmp_path):
    files = spark.createDataFrame(FILES, "source_file string, text string")
    log, path = tmp_path / "log", str(tmp_path / "answers")
    good, failed = readers.extracted_into(files, answering(log), path, waves=2)
    assert {r["source_file"] for r in good.collect()} == {"a.md", "c.md", "d.md"} and {r["source_file"] for r in failed.collect()} == {"b.md", "e.md"}
    assert sorted(log.read_text().splitlines()) == ["", "bad b", "good a", "good c", "list"]
    log.write_text("")
    changed = files.withColumn("text", F.when(F.col("source_file") == "a.md", "good again").when(F.col("source_file") == "b.md", "good b").otherwise(F.col("text")))
    good, failed = readers.extracted_into(changed, answering(log), path, waves=3)
    assert sorted(log.read_text().splitlines()) == ["good again", "good b", "list"]
    assert {(r["source_file"], json.loads(r["raw"])["of"]) for r in good.collect()} == {("a.md", "good again"), ("b.md", "good b"), ("c.md", "good c"), ("d.md", "")}
    assert [(r["source_file"], r["calls"]) for r in failed.collect()] == [("e.md", 2)]
