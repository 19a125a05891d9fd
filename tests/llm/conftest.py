import pytest

#: Rows that every operator on documents must take: nulls in each column, empty, blank and very long texts, ties, repeated
#: rows, and columns with names that operators use themselves.
EDGE = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", None),
    (3, None, None, "a"),
    (4, "", "en", "b"),
    (5, " \t\n ", "de", "b"),
    (6, "word " * 40_000, "en", "c"),
    (7, "the  quick\tbrown fox jumps over the lazy dog near the river bank today", "en", "c"),
    (7, "the  quick\tbrown fox jumps over the lazy dog near the river bank today", "en", "c"),
    (None, "a text without an identifier", None, None),
    (9, "é ü ß 漢字 \U0001f600 x y z", "fr", "d"),
    (10, "one", "en", "d"),
    (11, "a\nline that is long enough to count\nb", "en", "d"),
    (12, "  A LINE that is long enough to count \nc", "en", "d"),
    (13, "A line that is long enough to count", "en", "d"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, digest string, shard int, kept boolean, bucket string, label string, __text string"


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame([(i, t, l, s, None, 1, "x", 9, True, "b", "y", "z") for i, t, l, s in EDGE], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts():
    import pyarrow.parquet as pq

    rows = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    return [(r["doc_id"], r["text"], r["lang"]) for r in rows]
