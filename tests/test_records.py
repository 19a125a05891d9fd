"""Marked text to records, claims, graphs, vectors and exports."""

import hashlib

import pytest
from pyspark.sql import functions as F

from foliograph.functions import ids, text
from foliograph.operators import graph, layout, parse, patterns, provenance, validate, vector
from foliograph.sources import readers, sinks
from foliograph.streaming import upserts

from .records import TEXTS


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("texts")
    for name, body in TEXTS:
        (folder / name).write_text(body)
    (folder / "other.csv").write_text("a,b\n1,\n")
    return str(folder)


@pytest.fixture(scope="module")
def records(spark, files):
    return parse.parse(parse.check_suffix(readers.text_files(spark, files))).cache()


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def test_parsed_fields(records):
    rows = {r["stem"]: r for r in records.collect()}
    assert sorted(rows) == ["00_ada", "01_ben", "02_cleo"]
    ada = rows["00_ada"]
    assert ada["candidate"]["name"] == "Ada Brook" and ada["candidate"]["summary"] == "Data Engineer with years of practice."
    assert ada["candidate"]["phone"] == "Location: Hill Town"  # an empty value takes the next line
    assert [tuple(s) for s in rows["01_ben"]["sections"]["skills"]] == [("Excel", "Office"), ("sql", "Data"), ("Power BI", "Data")]
    jobs = ada["sections"]["experience"]
    assert jobs[0]["description"] == "Did things | and more." and jobs[1]["description"] == "" and jobs[2]["job_title"] == ""
    key = "cand_" + hashlib.sha256(b"ada brook|ada@example.test").hexdigest()[:12]
    assert jobs[1]["experience_id"] == f"{key}_exp_2"
    assert rows["02_cleo"]["candidate"]["linkedin"] == "" and rows["02_cleo"]["sections"]["projects"][0]["technologies"] == []
    assert [tuple(x) for x in ada["sections"]["languages"]] == [("English", "Native"), ("Welsh", "")]


def test_sources(spark, files, tmp_path):
    assert readers.csv_files(spark, f"{files}/other.csv").collect() == [("1", None)]
    with pytest.raises(RuntimeError):
        readers.text_files(spark, str(tmp_path))
    (tmp_path / "a.json").write_text('{"candidate": {"name": "A"}}')
    (tmp_path / "b.json").write_text("{")
    rows = {r["stem"]: r for r in readers.json_files(spark, str(tmp_path)).collect()}
    assert rows["a"]["candidate"]["name"] == "A" and rows["b"]["_corrupt_record"] is not None
    (tmp_path / "x.pdf").write_bytes(b"pdf")
    found = readers.binary_files(spark, str(tmp_path)).first()
    assert found["document_id"] == "doc_" + hashlib.sha256(b"pdf").hexdigest()[:16]
    pages = spark.createDataFrame([("d", 2, "two", ["u", "v"]), ("d", 1, "one", ["v", "w"])], "document_id string, page_number int, text string, uris array<string>")
    assert readers.text_with_links(pages).first()["text"] == "one\n\ntwo\n\n[EMBEDDED LINKS]\nv\nw\nu"
    images = spark.createDataFrame([(120, 120), (119, 500), (500, 119)], "width int, height int")
    assert readers.large_images(images).count() == 1
    pairs = spark.createDataFrame([(1, ["a", "b"], ["x"])], "page int, places array<string>, files array<string>")
    assert readers.paired_images(pairs).count() == 1
    assert readers.available(lambda: 1) and not readers.available(lambda: 1 / 0)
    with pytest.raises(Exception, match="unsupported input format"):
        parse.check_suffix(spark.createDataFrame([("a.doc",)], "source_file string")).count()


def test_expressions(spark):
    cases = [
        (text.slug(F.lit("  Work & Life! ")), "work_life"),
        (text.slug(F.lit("!!")), "section"),
        (text.safe_name(F.lit("-A b--c-")), "a_b__c"),
        (text.normalized(F.lit("Étion, B.2")), "tion b 2"),
        (text.clean_cids(F.lit("a (cid:12) b(cid:3)")), "a b"),
        (text.without_mailto(F.lit("MAILTO:x@y")), "x@y"),
        (text.section(F.lit("h\n[A]\n1\n[B]\n2\n[A]\n 3 \n"), "A"), "3"),
        (text.python_list(F.array(F.lit("a"), F.lit('b"'))), '["a", "b\\""]'),
        (ids.claim_id(F.lit("s"), F.lit(None), F.lit("f"), F.lit("v")), "claim_" + hashlib.sha256(b"s|None|f|v").hexdigest()[:16]),
        (ids.entity_id("Skill", F.lit(" SQL ")), "skill_" + hashlib.sha256(b"sql").hexdigest()[:16]),
        (ids.rel_id(F.lit("a"), F.lit("T"), F.lit("b"), F.create_map(F.lit("z"), F.lit("1"), F.lit("k"), F.lit("é"))), "rel_" + hashlib.sha256('{"from": "a", "properties": {"k": "é", "z": "1"}, "to": "b", "type": "T"}'.encode()).hexdigest()[:20]),
        (F.array_join(parse.fan_out_skills(F.lit("a; b|c,, d")), ","), "a,b,c,d"),
        (parse.with_defaults(F.lit('{"a": "1"}'), "a string, b string", {"a": "", "b": "-"})["b"], "-"),
        (layout.table_text(F.array(F.array(F.lit("a"), F.lit(None)), F.array(F.lit(""), F.lit("b")))), "a | \n | b"),
        (layout.table_text(F.array(F.array(F.lit(" "), F.lit(None)))), None),
    ]
    for expression, expected in cases:
        assert one(spark, expression) == expected


@pytest.mark.parametrize(
    "line,bold,size,expected",
    [("Skills:", False, 5.0, "skills"), ("Fellowships  & Prizes", False, 5.0, "fellowships_prizes"), ("ABOUT ME", False, 10.0, "about_me"), ("ABOUT ME", False, 9.0, None), ("About me now", True, 11.5, "about_me_now"), ("About me now", True, 11.0, None), ("123", True, 20.0, "123"), ("A B C D E F G H", True, 20.0, None)],
)
def test_headings(spark, line, bold, size, expected):
    assert one(spark, layout.heading_type(F.lit(line), F.lit(bold), F.lit(size), F.lit(10.0))) == expected


def test_domain_graph(spark, records):
    raw = graph.domain_graph(records)
    nodes, edges = graph.merge_nodes(raw[0]).cache(), graph.merge_edges(raw[1]).cache()
    labels = {r["label"]: r["count"] for r in nodes.groupBy("label").count().collect()}
    # skills: SQL (twice, by case), Python, C++, Excel (twice), Power BI, Triage, and the technologies Kafka and R
    assert labels == {"Candidate": 3, "Resume": 3, "Skill": 8, "Role": 6, "Company": 5, "Institution": 1, "Degree": 1, "Project": 3, "Certification": 1, "Language": 2}
    assert nodes.where("label = 'Skill' and properties['name'] = 'sql'").count() == 1  # the last writer's case
    assert graph.schema_errors(nodes, edges).count() == 0
    twice = graph.merge_nodes(raw[0].union(raw[0]))
    assert twice.count() == nodes.count()
    one_side = edges.union(edges.limit(1).withColumn("dst", F.lit("gone")))
    assert graph.resolved(one_side, nodes).count() == edges.count()
    wrong = edges.withColumn("type", F.when(F.col("type") == "SPEAKS", "SINGS").otherwise(F.col("type")))
    assert {r["kind"] for r in graph.schema_errors(nodes, wrong).collect()} == {"unknown type"}


def test_counts_of_ten_texts(spark):
    """Ten texts whose nodes and edges are counted by hand, as sets of what each of them names."""
    rows = []
    for n in range(10):
        own = ["SQL", f"Tool {n}", "python" if n % 2 else "Python"]
        jobs = [(f"Role {n % 4}", f"Firm {n % 3}"), (f"Role {n}", "Firm X")]
        body = f"# Person {n}\nEmail: p{n}@example.test\n\n[SUMMARY]\nText.\n\n[SKILLS]\n" + "; ".join(f"{x} | Kind" for x in own) + "\n\n[EXPERIENCE]\n" + "\n".join(f"{r} | {f} | Town | 2020 | 2021 | Work" for r, f in jobs)
        body += f"\n\n[EDUCATION]\nB.Sc. | University {n % 5} | Town | 2019\n\n[PROJECTS]\nWork {n} | SQL, Kit {n % 2} | Text |\n\n[CERTIFICATIONS]\nPaper {n % 2} | Board | 2022\n\n[LANGUAGES]\nEnglish | Native\n"
        rows.append((f"{n}.md", body))
    own = parse.ingest(spark.createDataFrame(rows, "source_file string, text string"))
    nodes, edges = graph.domain_graph(own)
    labels = {r["label"]: r["count"] for r in graph.merge_nodes(nodes).groupBy("label").count().collect()}
    # skills: SQL, Python, ten tools, two kits; roles 0 to 9; firms 0 to 2 and X
    assert labels == {"Candidate": 10, "Resume": 10, "Skill": 14, "Role": 10, "Company": 4, "Institution": 5, "Degree": 1, "Project": 10, "Certification": 2, "Language": 1}
    kinds = {r["type"]: r["count"] for r in graph.merge_edges(edges).groupBy("type").count().collect()}
    # persons 0 to 3 have one role twice
    assert kinds == {"HAS_RESUME": 10, "HAS_SKILL": 30, "HELD_ROLE": 16, "WORKED_AT": 20, "STUDIED_AT": 10, "EARNED_DEGREE": 10, "BUILT": 10, "USES": 20, "EARNED_CERTIFICATION": 10, "SPEAKS": 10}
    nodes, edges = graph.natural_graph(own, compact=True)
    # skills by their case: 13; technologies: SQL and two kits; jobs: twenty
    assert nodes.select("id").distinct().count() == 10 + 13 + 3 + 20 + 4 + 5 + 10 + 2
    assert graph.merge_edges(edges).count() == 30 + 20 + 20 + 20 + 10 + 10 + 10
    assert vector.section_documents(own).count() == 70


def test_choice_of_the_parser(spark):
    files = spark.createDataFrame([TEXTS[0]], "source_file string, text string")
    pdf = spark.createDataFrame([("a.pdf", "Name\n")], "source_file string, text string")
    answer = '{"candidate": {"name": " Given Name ", "phone": 5, "email": "mailto:g@x.test"}, "sections": {"skills": [{"name": "x; y"}], "experience": [{"company": "C"}, {}], "projects": "none"}}'
    plain = parse.ingest(files).first()
    assert plain["source_document"]["parser_version"] == parse.PARSER_VERSION
    assert parse.ingest(files, "auto", lambda t: answer, lambda: 1 / 0).first()["candidate"] == plain["candidate"]
    for found in (parse.ingest(files, "model", lambda t: answer).first(), parse.ingest(files, "auto", lambda t: answer, lambda: 1, "m:1").first()):
        assert found["candidate"]["name"] == "Given Name" and found["candidate"]["email"] == "g@x.test" and found["candidate"]["phone"] == plain["candidate"]["phone"]
        key = "cand_" + hashlib.sha256(b"given name|g@x.test").hexdigest()[:12]
        assert [x["name"] for x in found["sections"]["skills"]] == ["x", "y"]
        assert [(x["experience_id"], x["company"], x["job_title"]) for x in found["sections"]["experience"]] == [(f"{key}_exp_1", "C", "")]
        assert len(found["sections"]["projects"]) == len(plain["sections"]["projects"]) and found["sections"]["projects"][0]["project_id"] == f"{key}_proj_1"
    assert found["source_document"]["parser_version"] == "m:1"
    assert parse.ingest(pdf, "model", lambda t: answer).first()["candidate"]["name"] == "Given Name"
    with pytest.raises(Exception, match="unsupported input format"):
        parse.ingest(pdf, "auto").count()
    with pytest.raises(Exception, match="extraction failed for a.pdf"):
        parse.ingest(pdf, "model", lambda t: "sorry").collect()
    with pytest.raises(ValueError):
        parse.ingest(files, "none")
    with pytest.raises(ValueError):
        parse.ingest(files, "model")


def test_natural_graphs(records):
    nodes, edges = graph.natural_graph(records)
    direct, _ = graph.natural_graph(records, guards=False)
    assert direct.select("id").distinct().count() > nodes.select("id").distinct().count()
    compact, _ = graph.natural_graph(records, compact=True)
    assert {r["label"] for r in compact.select("label").distinct().collect()} >= {"Experience", "Technology"}


WORDS = [("d", 1, t, float(x), top, x + 5.0, top + 4, 10.0, "Bold" if t == "SKILLS" else "Plain") for t, x, top in [("Intro", 0, 0.0), ("words", 10, 2.0), ("second", 0, 4.0), ("part", 9, 6.0), ("SKILLS", 0, 20.0), ("SQL", 0, 30.0), ("and", 8, 30.2), ("(cid:7)", 0, 50.0)]]


def blocks_of(spark):
    lines = layout.lines(spark.createDataFrame(WORDS, readers.WORDS))
    items = lines.select("document_id", "page_number", F.lit("text").alias("type"), "text", "x0", "top", "x1", "bottom", "font_size", "bold", "body_size", F.col("line").alias("position"))
    image = spark.createDataFrame([("d", 1, "image", "", 0.0, 10.0, 50.0, 18.0, None, None, None, 99)], items.schema)
    return lines, layout.structure(items.union(image))


def test_layout(spark):
    lines, blocks = blocks_of(spark)
    assert [r["text"] for r in lines.orderBy("line").collect()] == ["Intro words", "second part", "SKILLS", "SQL and"]
    rows = blocks.orderBy("reading_order").collect()
    assert [(r["type"], r["section_id"]) for r in rows] == [("text", "d_section_1"), ("text", "d_section_1"), ("image", "d_section_1"), ("heading", "d_section_2"), ("text", "d_section_2")]
    sections = {r["section_id"]: r for r in layout.sections(blocks).collect()}
    assert sections["d_section_1"]["title"] == "Document header" and sections["d_section_2"]["normalized_type"] == "skills"
    assets = blocks.where("type = 'image'").select("page_id", F.col("block_id").alias("asset_id"), "top", "bottom")
    texts = blocks.where("type != 'image'").select("page_id", "block_id", "text", F.col("top").alias("t_top"), F.col("bottom").alias("t_bottom"), "reading_order")
    near = layout.nearest_context(assets, texts, ["page_id"]).first()
    assert near["nearby_text"] == "second part | SKILLS | Intro words"
    assert layout.captions(assets, texts, ["page_id"]).first()["caption"] == "SKILLS"
    assert layout.nearest_context(assets, texts.limit(0), ["page_id"]).first()["context_block_ids"] == []
    counts = layout.statistics(blocks).first()
    assert (counts["blocks"], counts["text_blocks"], counts["images"], counts["sections"]) == (5, 4, 1, 2)


def test_document_graph_and_validation(spark):
    _, blocks = blocks_of(spark)
    sections = layout.sections(blocks)
    documents = spark.createDataFrame([("d", "d.pdf", "ab" * 32, 1)], "document_id string, source_file string, source_sha256 string, page_count int")
    pages = spark.createDataFrame([("d", "d_page_1", 1, 100.0, 100.0, "raw")], "document_id string, page_id string, page_number int, width double, height double, raw_text string")
    nodes, edges = graph.document_graph(documents, pages, sections, blocks)
    merged = graph.merge_nodes(nodes)
    kinds = {r["type"]: r["count"] for r in graph.merge_edges(edges).groupBy("type").count().collect()}
    assert kinds == {"HAS_PAGE": 1, "HAS_SECTION": 2, "HAS_BLOCK": 10, "NEXT_BLOCK": 4}
    assert graph.schema_errors(merged, graph.merge_edges(edges)).count() == 0
    assert validate.structural_errors(documents, pages, sections, blocks).count() == 0
    broken = blocks.union(blocks.limit(1)).withColumn("x1", F.lit(-1.0)).withColumn("context_block_ids", F.array(F.lit("none")))
    found = {r["kind"] for r in validate.structural_errors(documents.withColumn("page_count", F.lit(3)), pages.withColumn("page_id", F.lit("p")), sections.limit(0), broken).collect()}
    assert found == {"page_count", "missing page", "missing section", "invalid box", "repeated block", "missing context"}
    assert vector.block_documents(blocks, sections, documents).count() == 4


def test_claims_and_evidence(spark, records):
    claims = provenance.claims(records)
    blocks = spark.createDataFrame([("00_ada", "b1", "text", "Worked at HARBOR labs", 1), ("00_ada", "b2", "text", "harbor labs again", 2), ("00_ada", "b3", "image", "Ada Brook", 3), ("00_ada", "b4", "text", "years in practice of data", 4)], "stem string, block_id string, type string, text string, position int")
    found = {(r["section"], r["field"], r["item_index"]): r for r in provenance.ground(claims, blocks).where("stem = '00_ada'").collect()}
    assert found["experience", "company", 0]["block_id"] == "b1" and found["experience", "company", 0]["match_type"] == "exact_normalized"
    summary = found["candidate", "summary", None]
    assert summary["match_type"] == "token_overlap" and summary["score"] == pytest.approx(4 / 6)
    assert not found["candidate", "name", None]["grounded"]
    coverage = provenance.coverage(provenance.ground(claims, blocks), ["stem"]).collect()
    assert all(0 <= r["coverage"] <= 1 and r["total_claims"] == r["grounded_claims"] + r["ungrounded_claims"] for r in coverage)
    nodes = graph.merge_nodes(graph.domain_graph(records)[0]).select("id").union(blocks.select("block_id"))
    candidates = records.select("stem", ids.candidate_id(F.col("candidate.name"), F.col("candidate.email")).alias("cand"))
    edges = provenance.ground(claims, blocks)
    made = graph.provenance_edges(edges, candidates, nodes)
    assert made.count() > 0 and made.where("dst not like 'b%'").count() == 0


def test_short_items_are_found_inside_words(spark):
    items = spark.createDataFrame([(1, "sql"), (2, "a b"), (3, "")], "item_id long, text string")
    blocks = spark.createDataFrame([(7, 1, "postgresql"), (8, 1, "b a")], "doc_id long, position int, text string")
    assert {(r["item_id"], r["doc_id"], r["score"]) for r in provenance.best_matches(items, blocks).collect()} == {(1, 7, 1.0), (2, 8, 1.0)}


def test_best_matches_against_all_pairs(spark):
    import random
    import re

    rnd = random.Random(8)
    vocabulary = ["sql", "a", "postgresql", "data", "an", "base", "database", "mysql", "x1", "io", "zed", "of", "the", "to", "land"]
    some = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, some(rnd.choice([0, 1, 1, 2, 2, 3, 4, 6, 12, 20]))) for i in range(60)]
    blocks = [(i, 1 + i % 3, some(rnd.randrange(0, 25)).upper() + rnd.choice(["", ".", " Zq"])) for i in range(80)]
    normal = lambda t: re.sub("[^a-z0-9]+", " ", t.lower()).strip()
    expected = set()
    for i, t in items:
        own, found = set(normal(t).split()), []
        for d, p, b in blocks:
            if own and normal(b):
                value = 1.0 if normal(t) in normal(b) else len(own & set(normal(b).split())) / len(own)
                if value >= 0.45:
                    found.append((-value, d, p))
        if found:
            value, d, p = min(found)
            expected.add((i, d, p, round(-value, 9)))
    made = provenance.best_matches(spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(blocks, "doc_id long, position int, text string"))
    assert {(r["item_id"], r["doc_id"], r["position"], round(r["score"], 9)) for r in made.collect()} == expected


SCHEMA = {
    "type": "object", "required": ["a", "items"], "additionalProperties": False,
    "$defs": {"item": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "minimum": 1}}}},
    "properties": {"a": {"type": "string", "minLength": 1}, "k": {"const": "x"}, "items": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"$ref": "#/$defs/item"}}},
}


@pytest.mark.parametrize(
    "value,paths",
    [('{"a": "z", "items": [{"n": 1}]}', []), ("{", ["$"]), ("[]", ["$"]), ('{"items": [{"n": 0}], "b": 1}', ["$", "$", "$.items[0].n"]), ('{"a": "", "items": [], "k": "y"}', ["$.a", "$.items", "$.k"]), ('{"a": "q", "items": [{}, {}, {}]}', ["$.items", "$.items[0]", "$.items[1]", "$.items[2]"])],
)
def test_json_schema(spark, value, paths):
    rows = spark.createDataFrame([("f", value)], "file string, value string")
    assert [r["path"] for r in validate.in_order(validate.schema_errors(rows, SCHEMA)).collect()] == paths


@pytest.mark.parametrize(
    "kind,good,bad",
    [("string", ['"5"', '""'], ["5", "null", "true", "[1]", "{}"]), ("integer", ["5", "-1", "5.0"], ['"12"', "1.5", "true", "null"]), ("number", ["1.5", "1e300", "3"], ['"1"', "null"]), ("boolean", ["true"], ['"true"', "1"]), ("null", ["null"], ["0", '""']), (["string", "null"], ["null", '"x"'], ["1"]), ("array", ["[]"], ["{}", "null"]), ("object", ["{}"], ["[]", '"{}"'])],
)
def test_json_types(spark, kind, good, bad):
    rows = spark.createDataFrame([(v, f'{{"n": {v}}}') for v in good + bad], "file string, value string")
    found = validate.schema_errors(rows, {"type": "object", "properties": {"n": {"type": kind}}}).collect()
    assert sorted(r["file"] for r in found) == sorted(bad) and {r["path"] for r in found} == {"$.n"}


def test_errors_of_items(spark):
    """One row for each bad item, items in the order of their numbers, arrays in arrays, the order of keywords at one place."""
    schema = {"properties": {"a": {"items": {"type": "object", "required": ["x", "y"], "properties": {"x": {"items": {"minimum": 2, "type": "integer"}}}}}}}
    bad = ", ".join(['{"x": [1, 2, 1.5], "y": 1}', "{}", '{"x": [], "y": 0}'] + ['{"x": []}'] * 9)
    rows = spark.createDataFrame([("f", f'{{"a": [{bad}]}}'), ("g", '{"a": []}'), ("h", None)], "file string, value string")
    found = [tuple(r) for r in validate.in_order(validate.schema_errors(rows, schema)).collect()]
    y = "'y' is a required property"
    assert [(f, p, m) for f, p, m, _, _ in found] == [
        ("f", "$.a[0].x[0]", "is less than the minimum of 2"), ("f", "$.a[0].x[2]", "is less than the minimum of 2"), ("f", "$.a[0].x[2]", "is not of type integer"),
        ("f", "$.a[1]", "'x' is a required property"), ("f", "$.a[1]", y), *[("f", f"$.a[{i}]", y) for i in range(3, 12)], ("h", "$", "is not JSON"),
    ]
    assert [r[3] for r in found[:4]] == ["a.0.x.0", "a.0.x.2", "a.0.x.2", "a.1"] and found[-1][3] == "root" and [r[4] for r in found[:-1]] == list(range(1, 15))


@pytest.mark.parametrize(
    "wanted,good,bad",
    [({"a": 1, "b": [True, None]}, ['{"b": [true, null], "a": 1.0}'], ['{"a": 1}', '{"a": 1, "b": [true]}', '{"a": 1, "b": [1, null]}', '{"a": 1, "b": [true, null], "c": 0}']), (5, ["5", "5.0"], ['"5"', "true", "5.1"]), (True, ["true"], ["1", '"true"']), ("5", ['"5"'], ["5"]), (None, ["null"], ["0", "false"])],
)
def test_const_and_enum_compare_values(spark, wanted, good, bad):
    rows = spark.createDataFrame([(v, f'{{"n": {v}}}') for v in good + bad], "file string, value string")
    for rule in ({"const": wanted}, {"enum": ["other", wanted]}):
        assert sorted(r["file"] for r in validate.schema_errors(rows, {"properties": {"n": rule}}).collect()) == sorted(bad)


def test_json_formats(spark):
    good = ["2024-02-03T04:05:06Z", "2024-02-03T04:05:06.789+00:00"]
    rows = spark.createDataFrame([(v, f'{{"at": "{v}"}}') for v in good + ["2024-02-03", "soon"]], "file string, value string")
    found = validate.schema_errors(rows, {"properties": {"at": {"type": "string", "format": "date-time"}}}).collect()
    assert sorted(r["file"] for r in found) == ["2024-02-03", "soon"]


def test_other_checks(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, None), (5, "y")], "i int, digest string")
    assert sorted(r["i"] for r in validate.repeated_sources(rows, "digest", "i").collect()) == [2, 4]
    assert validate.count_error(rows, 5).count() == 0 and validate.count_error(rows, 4).count() == 1
    validate.gate(rows.limit(0))
    with pytest.raises(ValueError):
        validate.gate(rows)


def test_patterns(spark):
    nodes = spark.createDataFrame([("a", "P", "Ann"), ("b", "S", "Python"), ("c", "S", "SQL"), ("d", "P", "Dan")], "id string, label string, name string")
    edges = spark.createDataFrame([("1", "a", "KNOWS", "b"), ("2", "a", "KNOWS", "c"), ("3", "c", "IN", "b")], "eid string, src string, type string, dst string")
    assert [r["src_name"] for r in patterns.named(nodes, edges, "KNOWS", "P", "S", "pYTHON").collect()] == ["Ann"]
    assert [(r["src_name"], r["names"]) for r in patterns.collected(nodes, edges, "KNOWS", "P", "S", True).collect()] == [("Ann", ["Python", "SQL"]), ("Dan", [])]
    assert [tuple(r) for r in patterns.two_hops(nodes, edges, "KNOWS", "IN").collect()] == [("Ann", "SQL", "Python")]
    trails = {tuple(r["trail"]) for r in patterns.trails(edges, nodes.where("id = 'a'"), 3).collect()}
    assert trails == {("1",), ("2",), ("1", "3"), ("2", "3"), ("1", "3", "2"), ("2", "3", "1")}


def test_exports(spark, records, tmp_path):
    tables = sinks.domain_tables(records)
    counts = sinks.csv_bundle(tables, str(tmp_path / "csv"))
    assert counts == {"resume_candidates": 3, "resume_skills": 8, "resume_experience": 6, "resume_education": 3, "resume_projects": 3, "resume_project_skills": 4, "resume_certifications": 3, "resume_languages": 6}
    assert readers.csv_files(spark, str(tmp_path / "csv/resume_skills")).columns == ["candidate_id", "name", "category"]
    assert sinks.export_bundle(records, str(tmp_path / "one")) == counts and not (tmp_path / "one" / "_rows").exists()
    for name, columns in sinks.DOMAIN_COLUMNS.items():
        one, many = (readers.csv_files(spark, str(tmp_path / folder / name)) for folder in ("one", "csv"))
        assert one.columns == many.columns == columns and sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    compact = {k: v.count() for k, v in sinks.compact_tables(records).items()}
    assert sinks.export_bundle(records.limit(0), str(tmp_path / "none"), compact=True) == dict.fromkeys(sinks.COMPACT_COLUMNS, 0)
    assert compact["demo_education"] == 6 and compact["demo_certifications"] == 6
    raw = graph.domain_graph(records)
    nodes, edges = graph.merge_nodes(raw[0]), graph.merge_edges(raw[1])
    node_tables, edge_tables = sinks.node_tables(nodes), sinks.edge_tables(edges)
    assert node_tables["Skill"].columns == ["graph_id", "name"] and edge_tables["HAS_SKILL"].columns == ["from_id", "to_id", "rel_id", "category"]
    script = sinks.graph_csv(nodes, edges, str(tmp_path / "graph_csv"))
    assert "FOR (n:`Skill`) REQUIRE n.graph_id IS UNIQUE" in script and "MERGE (a)-[r:`HAS_SKILL` {graph_id: row.rel_id}]" in script
    assert "graph_nodes_skill.csv" in script and script.rstrip().splitlines()[-1].startswith("RETURN n_candidate, ") and "r_worked_at" in script
    assert (tmp_path / "graph_csv" / "graph_rels_has_skill").is_dir()
    assert "`A ``b` " in sinks.load_script({"A `b": node_tables["Skill"]}, {}) and "graph_nodes_a__b.csv" in sinks.load_script({"A `b": node_tables["Skill"]}, {})
    with pytest.raises(ValueError):
        sinks.node_tables(nodes.union(nodes))
    for _ in range(2):
        sinks.records_json(records.where("stem = '00_ada'"), str(tmp_path / "json"))
        sinks.records_json(records.where("stem != '00_ada'"), str(tmp_path / "json"))
    assert sorted(r["stem"] for r in spark.read.json(str(tmp_path / "json")).collect()) == ["00_ada", "01_ben", "02_cleo"]
    images = spark.createDataFrame([("00_ada", [])], f"stem string, images {dict(records.dtypes)['images']}")
    assert sinks.with_images(records, images).count() == 3
    with pytest.raises(Exception, match="no record"):
        sinks.with_images(records, images.withColumn("stem", F.lit("none"))).count()


NODES = "id string, label string, properties map<string,string>"
EDGES = "src string, type string, dst string, identity string, properties map<string,string>"


def test_loads_in_a_row(spark, tmp_path):
    """Three loads into one store: earlier nodes and edges stay, new properties win, edges wait for both ends."""
    path = str(tmp_path / "store")
    load = lambda nodes, edges, reset=False: sinks.graph_parquet(spark.createDataFrame(nodes, NODES), spark.createDataFrame(edges, EDGES), path, reset)
    load([("a", "P", {"x": "1", "y": "1"})], [("a", "K", "b", None, {})])
    load([("b", "P", {})], [("a", "K", "b", None, {}), ("a", "K", "b", None, {"w": "2"})])
    assert load([("c", "P", {}), ("a", "Q", {"y": "2", "z": "3"})], [("c", "K", "a", None, {}), ("a", "K", "b", None, {})]) == 2
    nodes, edges = sinks.read_graph(spark, path)
    found = {r["id"]: (r["label"], r["properties"]) for r in nodes.collect()}
    assert found == {"a": ("P", {"x": "1", "y": "2", "z": "3"}), "b": ("P", {}), "c": ("P", {})}
    assert sorted((r["src"], r["dst"], len(r["properties"])) for r in edges.collect()) == [("a", "b", 0), ("a", "b", 1), ("c", "a", 0)]
    load([("d", "P", {})], [], reset=True)
    assert [r["id"] for r in sinks.read_graph(spark, path)[0].collect()] == ["d"]
    with pytest.raises(ValueError):
        load([("d", "P", {}), ("d", "P", {})], [])


def test_upserts_keep_the_order_of_ordinals(spark):
    old = spark.createDataFrame([("a", "P", {"k": "old", "o": "1"})], NODES)
    new = spark.createDataFrame([("a", "P", {"k": str(n)}, n) for n in (9, 10)], NODES + ", ordinal int")
    assert graph.upsert_nodes(old, new).first()["properties"] == {"k": "10", "o": "1"}
    edges = spark.createDataFrame([("a", "K", "b", None, {"k": str(n)}, n) for n in (9, 10)], EDGES + ", ordinal int")
    assert graph.upsert_edges(edges.drop("ordinal").limit(0), edges).first()["properties"] == {"k": "10"}


def test_csv_rows_match_nodes_that_exist(spark):
    nodes = spark.createDataFrame([("a",), ("a",)], "id string")
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "candidate_id string, n int")
    assert [r["n"] for r in graph.matched(rows, nodes, "candidate_id").collect()] == [1]


def test_search(spark, records, tmp_path):
    docs = vector.embed(vector.section_documents(records)).cache()
    assert docs.count() == 21
    query = vector.embed(spark.createDataFrame([(1, "Ada Brook Data Engineer with years of practice")], "query_id int, document string")).select("query_id", F.col("embedding").alias("vector"))
    hits = vector.search(docs, query, 3).orderBy("rank").collect()
    assert [r["rank"] for r in hits] == [1, 2, 3] and hits[0]["id"].endswith(":summary") and hits[0]["distance"] < 0.2
    texts = vector.search_text(docs.drop("embedding"), "Ada Brook Data Engineer with years of practice", 3).orderBy("rank").collect()
    assert [(r["rank"], r["id"], r["distance"]) for r in texts] == [(r["rank"], r["id"], round(r["distance"], 4)) for r in hits] and texts[0]["metadata"]["section"] == "summary"
    sinks.collection_parquet(docs.select("id", "document"), str(tmp_path / "c"), docs.select("id", "document").limit(4))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 21


def test_streams(spark, tmp_path, monkeypatch):
    """Files that arrive later are merged; a stream that starts anew goes on with the store."""
    monkeypatch.setattr(upserts, "BUCKETS", 3)
    folder = tmp_path / "in"
    folder.mkdir()
    for load, n in ((upserts.load_collection, 21), (upserts.load_nodes, 33)):
        out = str(tmp_path / load.__name__)
        for k, (name, body) in enumerate(TEXTS):
            (folder / name).write_text(body)
            load(upserts.text_stream(spark, str(folder)), out, f"{out}-state").awaitTermination()
        assert upserts.read_store(spark, out).count() == n
        whole = sorted(map(str, upserts.read_store(spark, out).collect()))
        load(upserts.text_stream(spark, str(folder)), out, f"{out}-other").awaitTermination()
        again = upserts.read_store(spark, out)
        assert again.count() == n and (load is upserts.load_nodes or sorted(map(str, again.collect())) == whole)
        for name, _ in TEXTS:
            (folder / name).unlink()


def test_a_small_batch_rewrites_few_buckets(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = lambda *ids: spark.createDataFrame([(str(i), "x") for i in ids], "id string, document string")
    upserts.upsert_store(rows(*range(300)), path, vector.upsert)
    upserts.upsert_store(rows(7), path, vector.upsert)
    assert len(list((tmp_path / "s" / "version=1" / "rows").glob("bucket=*"))) == 1 and upserts.read_store(spark, path).count() == 300


def test_search_in_blocks_with_ties(spark, monkeypatch):
    """Several blocks of queries, equal distances, a vector without length, an empty query set."""
    rows = [(i, [float(i % 3), float(i % 2), 1.0]) for i in range(40)] + [(99, [0.0, 0.0, 0.0])]
    collection = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(3)
    queries = spark.createDataFrame([(f"q{i}", v) for i, v in rows[:7]], "query_id string, vector array<double>")
    monkeypatch.setattr(vector, "BLOCK", 2)
    cosine = lambda a, b: 1 - sum(x * y for x, y in zip(a, b)) / ((sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5 or 1)
    expected = {(f"q{q}", i, n + 1) for q, v in rows[:7] for n, (_, i) in enumerate(sorted((round(cosine(v, w), 9), i) for i, w in rows)[:4])}
    assert {(r["query_id"], r["id"], r["rank"]) for r in vector.search(collection, queries, 4).collect()} == expected
    assert vector.search(collection, queries.limit(0), 4).count() == 0


def test_trails_by_stages_and_by_degrees(spark):
    """The first trails and their numbers are those of all trails, with loops, parallel edges and starts without any."""
    import random

    rnd = random.Random(4)
    pairs = [(f"n{rnd.randrange(12)}", f"n{rnd.randrange(12)}") for _ in range(24)] + [("n0", "n0"), ("n1", "n2"), ("n1", "n2"), ("m0", "m1")]
    edges = spark.createDataFrame([(f"e{i}", a, b) for i, (a, b) in enumerate(pairs)], "eid string, src string, dst string")
    nodes = spark.createDataFrame([(n, "AB"[i % 2]) for i, n in enumerate([f"n{k}" for k in range(12)] + ["m0", "m1", "alone"])], "id string, label string")
    starts = nodes.where("label = 'A' or id in ('m1', 'n1')").select("id")
    every = [(r["start"], r["end"], r["hops"], ",".join(r["trail"])) for r in patterns.trails(edges, starts, 3).collect()]
    ordered = sorted(every, key=lambda r: (r[2], r[0], r[3], r[1]))
    ones = sum(r[2] == 1 for r in every)
    for limit, hops in ((5, 2), (ones, 2), (ones + 1, 2), (ones + 9, 2), (10_000, 2), (ones + 40, 3), (10_000, 3)):
        assert [tuple(r) for r in patterns.first_trails(edges, starts, limit, hops).collect()] == [r for r in ordered if r[2] <= hops][:limit]
    label = {r["id"]: r["label"] for r in nodes.collect()}
    counts = {}
    for start, end, n, _ in every:
        if n < 3:
            counts[start, n, label[end]] = counts.get((start, n, label[end]), 0) + 1
    assert {tuple(r)[:3]: r["trails"] for r in patterns.trail_counts(nodes, edges, starts).collect()} == counts


def test_one_scan_for_each_graph(spark, tmp_path):
    """A graph's nodes, or its edges, read the records' texts once."""
    spark.createDataFrame([("1.md", "# A\n[SKILLS]\nx | y")], "source_file string, text string").write.parquet(str(tmp_path / "t"))
    texts = spark.read.parquet(str(tmp_path / "t"))
    for raw in (graph.domain_graph(parse.parse(texts)), graph.natural_graph(parse.parse(texts)), graph.natural_graph(parse.parse(texts), compact=True)):
        for df in (graph.merge_nodes(raw[0]), graph.merge_edges(raw[1])):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.split("== Initial Plan ==")[0].count("FileScan") == 1


def test_canonical_json(spark):
    """As Python writes it, with sorted keys and letters kept; nested values as a graph store takes them."""
    import json

    texts = ["", 'a"b\\c', "x\ny\tz\r\b\f", "\x00\x01\x1f\x7f", "é漢\U0001f600</", "$1 \\1"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0]: r[1] for r in rows.select("t", text.json_string(F.col("t"))).collect()} == {t: json.dumps(t, ensure_ascii=False) for t in texts}
    values = [1, -2.5, True, None, "q\n", [1, [2, "a"], {"z": 1, "a": None}], {"b": [], "a": {"k": {"y": 1, "x": 2}}}, [], {}, ["x", 1, None]]
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, v string").select("i", F.parse_json("v").alias("v"))
    found = {r["i"]: r for r in rows.select("i", text.canonical(F.col("v")).alias("c"), F.to_json(text.store_value(F.col("v"))).alias("s")).collect()}
    for i, v in enumerate(values):
        whole = json.dumps(v, sort_keys=True, ensure_ascii=False)
        assert found[i]["c"] == whole
        nested = isinstance(v, dict) or isinstance(v, list) and any(isinstance(x, (list, dict)) for x in v)
        assert json.loads(found[i]["s"]) == (whole if nested else v)


def test_rows_without_vectors_take_no_part(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0]), (4, [None, 1.0]), (5, [0.0, 0.0])], "id int, embedding array<double>")
    queries = spark.createDataFrame([(7, [1.0, 0.1]), (8, None)], "query_id int, vector array<double>")
    found = [(r["query_id"], r["id"], r["rank"]) for r in vector.search(rows, queries, 5).orderBy("rank").collect()]
    assert found == [(7, 1, 1), (7, 3, 2), (7, 5, 3)]
    index = vector.centres(rows, 2)
    assert sorted(r["id"] for r in vector.probe(vector.with_cells(rows, index), queries, index, 5, 2).collect()) == [1, 3, 5]
