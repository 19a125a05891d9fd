"""Each registered query against its SQL, run by DuckDB over the same files."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from foliograph.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(SF):
        path = f"{SF}/{name}"
        connection.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return connection


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, db, name):
    found = catalog.QUERIES[name](spark, SF)
    result = db.sql(catalog.SQL[name])
    columns = sorted(found.columns)
    assert columns == sorted(result.columns)
    at = [result.columns.index(c) for c in columns]
    expected = sorted([plain(r[i]) for i in at] for r in result.fetchall())
    assert sorted([plain(r[c]) for c in columns] for r in found.collect()) == expected


def test_recall_of_the_index(spark):
    exact, found = ({(r["query_id"], r["vec_id"]) for r in catalog.QUERIES[n](spark, "/root/testdata/sf0.1").collect()} for n in ("vector_topk_batch", "vector_index_topk"))
    assert len(exact & found) >= 0.9 * len(exact) == 0.9 * 500


def test_every_row_is_indexed(spark):
    from foliograph.operators import vector

    rows = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(50)] + [(50, [0.0, 0.0])], "id long, embedding array<double>")
    found = vector.centres(rows, cells=4)
    index = vector.with_cells(rows, found).collect()
    assert sorted(r["id"] for r in index) == list(range(51)) and {r["cell"] for r in index} <= set(range(4))
    queries = spark.createDataFrame([(1, [1.0, 1.0])], "query_id int, vector array<double>")
    whole, all_cells = (sorted(map(tuple, x.select("id", "rank").collect())) for x in (vector.search(rows, queries, 5), vector.probe(vector.with_cells(rows, found), queries, found, 5, probes=4)))
    assert whole == all_cells
    empty = vector.centres(rows.limit(0))
    assert vector.with_cells(rows.limit(0), empty).count() == 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["item_id", "doc_id", "position", "score"] or __spark_entry__.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_library_does_not_need_the_subpackage():
    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    for folder, dirs, files in os.walk(os.path.join(root, "foliograph")):
        if os.path.basename(folder) == "llm":
            dirs.clear()
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as file:
                    assert "llm" not in file.read(), name
