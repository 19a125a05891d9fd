import hashlib

import corpus_pipeline

from foliograph.llm import exact

SCHEMA = "doc_id long, text string"


def kept(spark, rows):
    return sorted(map(tuple, corpus_pipeline.drop_exact_copies(spark, spark.createDataFrame(rows, SCHEMA), "").collect()), key=str)


def test_only_the_judged_row_goes(spark):
    assert kept(spark, [(5, "A"), (5, "B"), (3, "B")]) == [(3, "B"), (5, "A")]


def test_copies_without_an_id_go(spark):
    assert kept(spark, [(None, "a  b"), (4, "a\tb"), (None, "c")]) == [(4, "a\tb"), (None, "c")]


def test_white_space_variants_of_one_id_are_one_document(spark):
    assert len(kept(spark, [(8, "x  y z"), (8, "x y z"), (None, "q"), (None, "q"), (9, "x y z"), (9, "u"), (None, "u")])) == 3
    assert kept(spark, [(9, "u"), (None, "u"), (9, "u")]) == [(9, "u")]


def test_what_stays_does_not_depend_on_the_order(spark):
    rows = [(8, "x  y z", "a"), (8, "x y z", "b"), (8, "x\ty z", None)]
    stays = {corpus_pipeline.drop_exact_copies(spark, spark.createDataFrame(order, SCHEMA + ", source string"), "").first() for order in (rows, rows[::-1])}
    assert len(stays) == 1


def test_digest_as_an_expression(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([None, "", " ", "a\x0b\x0c\r\n b", "é  x \x1c\x1f y\x85", " Ä 漢 \U0001f600\t"])], SCHEMA)
    for r in docs.withColumn("h", exact.text_digest()).collect():
        assert r["h"] == hashlib.sha256(exact.normal_form(r["text"])).hexdigest()


def test_columns_named_like_the_stages_own(spark, texts):
    """Columns of any name pass through the stages that keep documents, and their values are those of the rows that stay."""
    rows = [(1, "a b c d e f g h", "k1", "n1", "t"), (2, "a  b c d e f g h", "k2", "n2", "t"), (3, "something else", "k3", None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA + ", __key string, node string, kept string")
    for stage in (corpus_pipeline.drop_exact_copies, corpus_pipeline.drop_near_copies):
        found = stage(spark, docs, "")
        assert found.columns == docs.columns
        kept = {tuple(r) for r in found.collect()}
        assert kept <= set(rows) and {rows[0], rows[2]} <= kept
    assert corpus_pipeline.key_of(spark.createDataFrame([(1, 2)], "__KEY int, __key_ int")) == "__key__"
