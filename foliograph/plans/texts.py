"""Registered queries over marked texts: one for each customer, made from the given tables, parsed, and turned into records,
claims, graphs, bundles and documents. Their SQL works on the same tables, or on the same texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, text
from ..operators import graph, layout, parse, provenance, validate, vector
from ..sources import readers, sinks
from .registry import query, table

#: One row for each order, numbered for its customer: supplier and part are the smallest of its lines.
_ORDERS = """it AS MATERIALIZED (SELECT o_custkey AS ck, o_orderkey AS ok, o_orderpriority AS pr, o_orderstatus AS st, min(l_suppkey) AS sk, min(l_partkey) AS pk
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
    j AS MATERIALIZED (SELECT it.*, s_name, p_name, p_brand, row_number() OVER (PARTITION BY ck ORDER BY ok) AS i, CASE WHEN ok % 2 = 0 THEN row_number() OVER (PARTITION BY ck, ok % 2 ORDER BY ok) END AS k
        FROM it JOIN supplier ON sk = s_suppkey JOIN part ON pk = p_partkey),
    c AS MATERIALIZED (SELECT c_custkey AS ck, c_custkey || '.md' AS file, c_name AS name, 'C' || c_custkey || '@Example.test' AS email, n_name AS place, r_name AS region, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS headline,
        c_mktsegment AS segment, 'cand_' || substr(sha256(lower(c_name) || '|c' || c_custkey || '@example.test'), 1, 12) AS cand
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_NL = "chr(10)"
_TEXTS = f"""{_ORDERS},
    t AS MATERIALIZED (SELECT c.ck, '# ' || any_value(name) || {_NL} || 'Email: ' || any_value(email) || {_NL} || 'Location: ' || any_value(place) || {_NL} || CASE WHEN any_value(headline) = '' THEN '' ELSE 'Headline: ' || any_value(headline) || {_NL} END
        || {_NL} || '[SUMMARY]' || {_NL} || 'Buys ' || any_value(segment) || ' goods' || {_NL} || 'in ' || any_value(place) || '.' || {_NL} || {_NL} || '[SKILLS]' || {_NL} || coalesce(string_agg(p_name || ' | ' || p_brand, '; ' ORDER BY i), '')
        || {_NL} || {_NL} || '[EXPERIENCE]' || {_NL} || coalesce(string_agg(pr || ' | ' || s_name || ' | ' || place || ' | ' || i || ' | Present | Order ' || ok || ' | status ' || st, {_NL} ORDER BY i), '')
        || {_NL} || {_NL} || '[EDUCATION]' || {_NL} || 'B.Sc. | ' || any_value(place) || ' College | ' || any_value(region) || ' | 1999'
        || {_NL} || {_NL} || '[PROJECTS]' || {_NL} || coalesce(string_agg('Work ' || ok || ' | ' || p_name || ', ' || p_brand || ', | In ' || st, {_NL} ORDER BY i) FILTER (k IS NOT NULL), '')
        || {_NL} || {_NL} || '[CERTIFICATIONS]' || {_NL} || any_value(segment) || ' | Board of ' || any_value(region) || ' | 2001' || {_NL} || 'No issuer'
        || {_NL} || {_NL} || '[LANGUAGES]' || {_NL} || any_value(place) || ' | Native; English' || {_NL} AS text
        FROM c LEFT JOIN j ON c.ck = j.ck GROUP BY c.ck)"""


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_file, text)."""
    t = lambda name: table(spark, sf_dir, name)
    lines = t("lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("s_suppkey"), F.min("l_partkey").alias("p_partkey"))
    orders = t("orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).join(t("supplier").select("s_suppkey", "s_name"), "s_suppkey").join(t("part").select("p_partkey", "p_name", "p_brand"), "p_partkey")
    fields = ["o_orderkey", "o_orderpriority", "o_orderstatus", "s_name", "p_name", "p_brand"]
    mine = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("o"))
    people = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).join(mine, "c_custkey", "left").withColumn("o", F.coalesce("o", F.array().cast(dict(mine.dtypes)["o"])))
    s = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    seg, place, region = F.col("c_mktsegment"), F.col("n_name"), F.col("r_name")
    head = F.when(F.col("c_custkey") % 5 == 0, "").otherwise(s("Headline: ", seg, "\n"))
    skills = F.array_join(F.transform("o", lambda x: s(x.p_name, " | ", x.p_brand)), "; ")
    jobs = F.array_join(F.transform("o", lambda x, i: s(x.o_orderpriority, " | ", x.s_name, " | ", place, " | ", i + 1, " | Present | Order ", x.o_orderkey, " | status ", x.o_orderstatus)), "\n")
    work = F.array_join(F.transform(F.filter("o", lambda x: x.o_orderkey % 2 == 0), lambda x: s("Work ", x.o_orderkey, " | ", x.p_name, ", ", x.p_brand, ", | In ", x.o_orderstatus)), "\n")
    body = s("# ", F.col("c_name"), "\nEmail: C", F.col("c_custkey"), "@Example.test\nLocation: ", place, "\n", head, "\n[SUMMARY]\nBuys ", seg, " goods\nin ", place, ".\n\n[SKILLS]\n", skills, "\n\n[EXPERIENCE]\n", jobs,
             "\n\n[EDUCATION]\nB.Sc. | ", place, " College | ", region, " | 1999\n\n[PROJECTS]\n", work, "\n\n[CERTIFICATIONS]\n", seg, " | Board of ", region, " | 2001\nNo issuer\n\n[LANGUAGES]\n", place, " | Native; English\n")
    return people.select(s(F.col("c_custkey"), ".md").alias("source_file"), body.alias("text"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse(parse.check_suffix(_texts(spark, sf_dir)))


# --- records


@query(f"WITH {_TEXTS} SELECT c.ck::VARCHAR AS stem, name, email, '' AS phone, place AS location, headline, 'Buys ' || segment || ' goods in ' || place || '.' AS summary, file AS source_file, sha256(text) AS source_sha256 FROM c JOIN t ON c.ck = t.ck")
def parse_candidates(spark, sf_dir):
    return _records(spark, sf_dir).select("stem", *[f"candidate.{f}" for f in ("name", "email", "phone", "location", "headline", "summary")], "source_document.source_file", "source_document.source_sha256")


@query(f"WITH {_ORDERS} SELECT c.ck::VARCHAR AS stem, (i - 1)::INT AS pos, cand || '_exp_' || i AS experience_id, pr AS job_title, s_name AS company, place AS location, i::VARCHAR AS start_date, 'Present' AS end_date, 'Order ' || ok || ' | status ' || st AS description FROM c JOIN j ON c.ck = j.ck")
def parse_experience(spark, sf_dir):
    return _records(spark, sf_dir).select("stem", F.posexplode("sections.experience").alias("pos", "x")).select("stem", "pos", "x.*")


@query(f"WITH {_ORDERS} SELECT c.ck::VARCHAR AS stem, (k - 1)::INT AS pos, cand || '_proj_' || k AS project_id, 'Work ' || ok AS name, p_name || '+' || p_brand AS technologies, 'In ' || st AS description, '' AS url FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL")
def parse_projects(spark, sf_dir):
    return _records(spark, sf_dir).select("stem", F.posexplode("sections.projects").alias("pos", "x")).select("stem", "pos", "x.project_id", "x.name", F.array_join("x.technologies", "+").alias("technologies"), "x.description", "x.url")


@query(f"""WITH {_ORDERS} SELECT ck::VARCHAR AS stem, 'skills' AS section, p_name AS name, p_brand AS detail, (i - 1)::INT AS pos FROM j UNION ALL SELECT ck::VARCHAR, 'languages', place, 'Native', 0 FROM c UNION ALL SELECT ck::VARCHAR, 'languages', 'English', '', 1 FROM c
    UNION ALL SELECT ck::VARCHAR, 'certifications', segment, 'Board of ' || region, 0 FROM c UNION ALL SELECT ck::VARCHAR, 'certifications', 'No issuer', '', 1 FROM c UNION ALL SELECT ck::VARCHAR, 'education', 'B.Sc.', place || ' College', 0 FROM c""")
def parse_lists(spark, sf_dir):
    records = _records(spark, sf_dir)
    parts = [records.select("stem", F.lit(s).alias("section"), F.posexplode(f"sections.{s}").alias("pos", "x")).select("stem", "section", F.col(f"x.{a}").alias("name"), F.col(f"x.{b}").alias("detail"), "pos") for s, a, b in (("skills", "name", "category"), ("languages", "name", "proficiency"), ("certifications", "name", "issuer"), ("education", "degree", "institution"))]
    return graph._union(parts)


@query(f"""WITH {_TEXTS}, raw AS (SELECT ck, string_split(text, chr(10) || '[')[1] AS head FROM t) SELECT ck::VARCHAR AS stem, regexp_extract(head, '(?im)^Location:\\s*(.+)$', 1) AS location, trim(ltrim(split_part(head, chr(10), 1), '#')) AS name FROM raw""")
def parse_headers(spark, sf_dir):
    return _records(spark, sf_dir).select("stem", "candidate.location", "candidate.name")


@query(f"""WITH {_ORDERS}, m AS (SELECT c.ck, name, headline, place, CASE WHEN c.ck % 3 = 0 THEN ' Model ' || name || ' ' END AS new_name, CASE WHEN c.ck % 4 = 0 THEN 'MAILTO:m' || c.ck || '@x.test' ELSE email END AS mail FROM c),
    r AS (SELECT m.*, coalesce(trim(new_name), name) AS full_name, regexp_replace(mail, '(?i)^mailto:', '') AS address FROM m),
    f AS (SELECT *, 'cand_' || substr(sha256(lower(full_name) || '|' || lower(address)), 1, 12) AS id FROM r)
    SELECT ck::VARCHAR AS stem, full_name AS name, address AS email, headline, 'a,b c,d' AS skills, id || '_exp_1:Boss:,' || id || '_exp_2::Firm' AS jobs, id || '_proj_1:x+y,' || id || '_proj_2:p+q' AS projects, '1:-' AS languages FROM f""")
def model_records(spark, sf_dir):
    """What a model extracted, cleaned up, over what the parser found: overlay, defaults, fan-out, technologies, numbering."""
    base = _records(spark, sf_dir)
    key = F.col("stem").cast("long")
    candidate = F.to_json(F.struct(F.when(key % 3 == 0, F.concat(F.lit(" Model "), "candidate.name", F.lit(" "))).alias("name"), F.when(key % 4 == 0, F.concat(F.lit("MAILTO:m"), "stem", F.lit("@x.test"))).alias("email")))
    sections = """{"skills": [{"name": "a; b c | d"}, 5], "experience": [{"job_title": "Boss"}, {"location": "no one"}, {"company": "Firm", "start_date": null}], "education": [],
        "projects": [{"name": "P", "technologies": "x, y ,"}, {"name": "Q", "technologies": ["p", " q "]}, {"name": " "}], "certifications": [], "languages": [{"name": "-", "proficiency": "1"}]}"""
    found = parse.refined(base, F.concat(F.lit('{"candidate": '), candidate, F.lit(f', "sections": {sections}}}')), "model:test")
    items = lambda s, *fields: F.array_join(F.transform(f"sections.{s}", lambda x: F.concat_ws(":", *[F.array_join(x[f], "+") if f == "technologies" else x[f] for f in fields])), ",")
    return found.select("stem", "candidate.name", "candidate.email", "candidate.headline", items("skills", "name").alias("skills"), items("experience", "experience_id", "job_title", "company").alias("jobs"), items("projects", "project_id", "technologies").alias("projects"), items("languages", "proficiency", "name").alias("languages"))


# --- graphs


def _id(label: str, *parts: str) -> str:
    return f"'{label.lower()}_' || substr(sha256({' || chr(124) || '.join(f'lower({p})' for p in parts)}), 1, 16)"


_SKILL, _TECH, _BRAND = _id("Skill", "p_name"), _id("Skill", "p_name"), _id("Skill", "p_brand")
_DOMAIN_EDGES = f"""SELECT cand AS src, 'HAS_RESUME' AS type, 'resume_' || substr(sha256(text), 1, 16) AS dst, NULL AS identity FROM c JOIN t ON c.ck = t.ck
    UNION SELECT cand, 'HAS_SKILL', {_SKILL}, NULL FROM c JOIN j ON c.ck = j.ck
    UNION SELECT cand, 'HELD_ROLE', {_id('Role', 'pr')}, NULL FROM c JOIN j ON c.ck = j.ck
    UNION SELECT cand, 'WORKED_AT', {_id('Company', 's_name')}, cand || '_exp_' || i FROM c JOIN j ON c.ck = j.ck
    UNION SELECT cand, 'STUDIED_AT', {_id('Institution', "place || ' College'")}, cand || '_edu_1' FROM c UNION SELECT cand, 'EARNED_DEGREE', {_id('Degree', "'B.Sc.'")}, NULL FROM c
    UNION SELECT cand, 'BUILT', cand || '_proj_' || k, NULL FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL
    UNION SELECT cand || '_proj_' || k, 'USES', {_TECH}, NULL FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL UNION SELECT cand || '_proj_' || k, 'USES', {_BRAND}, NULL FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL
    UNION SELECT cand, 'EARNED_CERTIFICATION', {_id('Certification', 'segment', "'Board of ' || region")}, NULL FROM c
    UNION SELECT cand, 'SPEAKS', {_id('Language', 'place')}, NULL FROM c UNION SELECT cand, 'SPEAKS', {_id('Language', "'English'")}, NULL FROM c"""


@query(f"WITH {_TEXTS}, e AS ({_DOMAIN_EDGES}), n AS (SELECT DISTINCT dst AS id FROM e UNION SELECT cand FROM c) SELECT id, CASE split_part(id, '_', 1) WHEN 'cand' THEN CASE WHEN contains(id, '_proj_') THEN 'Project' ELSE 'Candidate' END ELSE upper(id[1]) || substr(split_part(id, '_', 1), 2) END AS label FROM n")
def domain_graph_nodes(spark, sf_dir):
    return graph.merge_nodes(graph.domain_graph(_records(spark, sf_dir))[0]).select("id", "label")


@query(f"WITH {_TEXTS} {_DOMAIN_EDGES}")
def domain_graph_edges(spark, sf_dir):
    return graph.merge_edges(graph.domain_graph(_records(spark, sf_dir))[1]).select("src", "type", "dst", "identity")


@query(f"""WITH {_TEXTS}, e AS ({_DOMAIN_EDGES}) SELECT type, count(*) AS n FROM e GROUP BY type""")
def domain_graph_counts(spark, sf_dir):
    nodes, edges = (merge(x) for merge, x in zip((graph.merge_nodes, graph.merge_edges), graph.domain_graph(_records(spark, sf_dir))))
    return graph.resolved(edges, nodes).groupBy("type").agg(F.count("*").alias("n"))


_NATURAL = f"""SELECT cand AS src, 'HAS_SKILL' AS type, 'Skill|' || p_name AS dst, NULL AS identity FROM c JOIN j ON c.ck = j.ck UNION SELECT cand, 'HELD_ROLE', 'Role|' || pr, NULL FROM c JOIN j ON c.ck = j.ck
    UNION SELECT cand, 'WORKED_AT', 'Company|' || s_name, cand || '_exp_' || i FROM c JOIN j ON c.ck = j.ck UNION SELECT cand, 'STUDIED_AT', 'Institution|' || place || ' College', cand || '_edu_1' FROM c UNION SELECT cand, 'EARNED_DEGREE', 'Degree|B.Sc.', NULL FROM c
    UNION SELECT cand, 'BUILT', cand || '_proj_' || k, NULL FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL UNION SELECT cand || '_proj_' || k, 'USES', 'Skill|' || p_name, NULL FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL UNION SELECT cand || '_proj_' || k, 'USES', 'Skill|' || p_brand, NULL FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL
    UNION SELECT cand, 'EARNED_CERTIFICATION', 'Certification|' || segment || '|Board of ' || region, NULL FROM c UNION SELECT cand, 'SPEAKS', 'Language|' || place, NULL FROM c UNION SELECT cand, 'SPEAKS', 'Language|English', NULL FROM c"""


@query(f"WITH {_ORDERS} {_NATURAL}")
def csv_graph_edges(spark, sf_dir):
    return graph.merge_edges(graph.natural_graph(_records(spark, sf_dir))[1]).select("src", "type", "dst", "identity")


@query(f"WITH {_ORDERS} {_NATURAL} UNION SELECT cand, 'EARNED_CERTIFICATION', 'Certification|No issuer|', NULL FROM c")
def direct_graph_edges(spark, sf_dir):
    return graph.merge_edges(graph.natural_graph(_records(spark, sf_dir), guards=False)[1]).select("src", "type", "dst", "identity")


_COMPACT = f"""SELECT 'Candidate|' || name AS src, 'HAS_SKILL' AS type, 'Skill|' || p_name AS dst FROM c JOIN j ON c.ck = j.ck UNION SELECT 'Candidate|' || name, 'HAS_EXPERIENCE', 'Experience|' || pr || '|' || s_name || '|' || i || '|Present' FROM c JOIN j ON c.ck = j.ck
    UNION SELECT 'Experience|' || pr || '|' || s_name || '|' || i || '|Present', 'AT_COMPANY', 'Company|' || s_name FROM c JOIN j ON c.ck = j.ck UNION SELECT 'Candidate|' || name, 'STUDIED_AT', 'Institution|' || place || ' College' FROM c
    UNION SELECT 'Candidate|' || name, 'WORKED_ON', 'Project|Work ' || ok FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL UNION SELECT 'Project|Work ' || ok, 'USES', 'Technology|' || p_name FROM j WHERE k IS NOT NULL UNION SELECT 'Project|Work ' || ok, 'USES', 'Technology|' || p_brand FROM j WHERE k IS NOT NULL
    UNION SELECT 'Candidate|' || name, 'HAS_CERTIFICATION', 'Certification|' || segment || '|Board of ' || region FROM c UNION SELECT 'Candidate|' || name, 'HAS_CERTIFICATION', 'Certification|No issuer|' FROM c"""


@query(f"WITH {_ORDERS} {_COMPACT}")
def compact_graph_edges(spark, sf_dir):
    return graph.merge_edges(graph.natural_graph(_records(spark, sf_dir), compact=True)[1]).select("src", "type", "dst")


@query(f"WITH {_ORDERS}, e AS ({_COMPACT}), n AS (SELECT src AS id FROM e UNION SELECT dst FROM e) SELECT id, split_part(id, '|', 1) AS label FROM n")
def compact_graph_nodes(spark, sf_dir):
    return graph.merge_nodes(graph.natural_graph(_records(spark, sf_dir), compact=True)[0]).select("id", "label")


@query(f"""WITH {_ORDERS} SELECT 's' || s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN 'Firm' ELSE 'Company' END AS label, s_name || CASE WHEN s_suppkey % 2 = 0 THEN ' (2)' ELSE '' END AS name, s_nationkey::VARCHAR AS nation,
    CASE WHEN s_suppkey % 2 = 0 THEN 'yes' END AS seen FROM supplier UNION ALL SELECT 'n' || n_nationkey, 'Company', n_name || ' (10)', NULL, 'yes' FROM nation""")
def node_upsert(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    id = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    old = suppliers.select(id.alias("id"), F.when(F.col("s_suppkey") % 3 == 0, "Firm").otherwise("Company").alias("label"), F.create_map(F.lit("name"), F.col("s_name"), F.lit("nation"), F.col("s_nationkey").cast("string")).alias("properties"))
    again = suppliers.where("s_suppkey % 2 = 0").select(id.alias("id"), F.lit("Company").alias("label"), F.create_map(F.lit("name"), F.concat("s_name", F.lit(" (2)")), F.lit("seen"), F.lit("yes")).alias("properties"), F.lit(1).alias("ordinal"))
    nations = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"), F.lit("Company").alias("label"), F.explode(F.sequence(F.lit(1), F.lit(10))).alias("ordinal"), "n_name")
    several = nations.select("id", "label", F.create_map(F.lit("name"), F.concat("n_name", F.lit(" ("), F.col("ordinal").cast("string"), F.lit(")")), F.lit("seen"), F.lit("yes")).alias("properties"), "ordinal")
    p = F.col("properties")
    return graph.upsert_nodes(old, again.unionByName(several)).select("id", "label", p["name"].alias("name"), p["nation"].alias("nation"), p["seen"].alias("seen"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25)")
def match_existing(spark, sf_dir):
    return graph.matched(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), table(spark, sf_dir, "part").where("p_size > 25"), "l_partkey", "p_partkey")


@query("SELECT doc_id AS src, 'labels' AS type, doc_id AS dst FROM labels WHERE doc_id IN (SELECT vec_id FROM embeddings)")
def resolved_edges(spark, sf_dir):
    edges = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("src"), F.lit("labels").alias("type"), F.col("doc_id").alias("dst"))
    return graph.resolved(edges, table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id")))


# --- bundles


def _flat(rows: DataFrame) -> DataFrame:
    """All tables of a bundle as (table, row): the columns joined by a bar."""
    return rows.where("table != 'resume_candidates'").select("table", F.array_join("fields", "|").alias("row"))


@query(f"""WITH {_ORDERS} SELECT 'resume_skills' AS "table", cand || '|' || p_name || '|' || p_brand AS "row" FROM c JOIN j ON c.ck = j.ck
    UNION ALL SELECT 'resume_experience', cand || '|' || cand || '_exp_' || i || '|' || pr || '|' || s_name || '|' || place || '|' || i || '|Present|Order ' || ok || ' | status ' || st FROM c JOIN j ON c.ck = j.ck
    UNION ALL SELECT 'resume_education', cand || '|' || cand || '_edu_1|B.Sc.|' || place || ' College|' || region || '|1999' FROM c
    UNION ALL SELECT 'resume_projects', cand || '|' || cand || '_proj_' || k || '|Work ' || ok || '|' || p_name || ', ' || p_brand || '|In ' || st || '|' FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL
    UNION ALL SELECT 'resume_project_skills', cand || '_proj_' || k || '|' || p_name FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL UNION ALL SELECT 'resume_project_skills', cand || '_proj_' || k || '|' || p_brand FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL
    UNION ALL SELECT 'resume_certifications', cand || '|' || segment || '|Board of ' || region || '|2001' FROM c UNION ALL SELECT 'resume_languages', cand || '|' || place || '|Native' FROM c UNION ALL SELECT 'resume_languages', cand || '|English|' FROM c""")
def domain_bundle(spark, sf_dir):
    return _flat(sinks.domain_rows(_records(spark, sf_dir)))


@query(f"""WITH {_ORDERS} SELECT 'demo_candidates' AS "table", name || '|' || email || '||' || place || '||' || file AS "row" FROM c UNION ALL SELECT 'demo_skills', name || '|' || p_name || '|' || p_brand FROM c JOIN j ON c.ck = j.ck
    UNION ALL SELECT 'demo_experience', name || '|' || pr || '|' || s_name || '|' || place || '|' || i || '|Present|Order ' || ok || ' | status ' || st FROM c JOIN j ON c.ck = j.ck UNION ALL SELECT 'demo_education', name || '|' || place || ' College|B.Sc.|' || region || '|1999' FROM c
    UNION ALL SELECT 'demo_projects', name || '|Work ' || ok || '|In ' || st || '|' FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL UNION ALL SELECT 'demo_technologies', 'Work ' || ok || '|' || p_name FROM j WHERE k IS NOT NULL UNION ALL SELECT 'demo_technologies', 'Work ' || ok || '|' || p_brand FROM j WHERE k IS NOT NULL
    UNION ALL SELECT 'demo_certifications', name || '|' || segment || '|Board of ' || region || '|2001' FROM c UNION ALL SELECT 'demo_certifications', name || '|No issuer||' FROM c""")
def compact_bundle(spark, sf_dir):
    return _flat(sinks.compact_rows(_records(spark, sf_dir)))


@query(f"""WITH {_ORDERS} SELECT 'resume_skills' AS "table", count(*) AS n FROM j UNION ALL SELECT 'resume_experience', count(*) FROM j UNION ALL SELECT 'resume_education', count(*) FROM c UNION ALL SELECT 'resume_projects', count(k) FROM j UNION ALL SELECT 'resume_project_skills', 2 * count(k) FROM j
    UNION ALL SELECT 'resume_certifications', count(*) FROM c UNION ALL SELECT 'resume_languages', 2 * count(*) FROM c""")
def bundle_counts(spark, sf_dir):
    return _flat(sinks.domain_rows(_records(spark, sf_dir))).groupBy("table").agg(F.count("*").alias("n"))


# --- claims, evidence, documents


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each text as blocks: stem, block_id, type, text, position."""
    rows = _texts(spark, sf_dir).select(F.regexp_replace("source_file", r"\.md$", "").alias("stem"), F.posexplode(F.split("text", "\n")).alias("position", "text"))
    return rows.select("stem", F.concat_ws("_", "stem", "position").alias("block_id"), F.when(F.col("position") % 7 == 6, "image").otherwise("text").alias("type"), "text", "position")


_N = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"
_CLAIMS = f"""k AS (SELECT ck, 'candidate' AS section, 'None' AS i, 'name' AS field, name AS value, 'Candidate' AS label, cand AS src FROM c UNION ALL SELECT ck, 'candidate', 'None', 'email', email, 'Candidate', cand FROM c UNION ALL SELECT ck, 'candidate', 'None', 'location', place, 'Candidate', cand FROM c
        UNION ALL SELECT ck, 'candidate', 'None', 'headline', headline, 'Candidate', cand FROM c WHERE headline <> '' UNION ALL SELECT ck, 'candidate', 'None', 'summary', 'Buys ' || segment || ' goods in ' || place || '.', 'Candidate', cand FROM c
        UNION ALL SELECT ck, 'skills', (i - 1)::VARCHAR, unnest(['name', 'category']), unnest([p_name, p_brand]), 'Skill', {_SKILL} FROM j
        UNION ALL SELECT c.ck, 'experience', (i - 1)::VARCHAR, unnest(['job_title', 'company', 'location', 'start_date', 'end_date', 'description']), unnest([pr, s_name, place, i::VARCHAR, 'Present', 'Order ' || ok || ' | status ' || st]), unnest(['Role', 'Company', 'Company', 'Company', 'Company', 'Company']),
            unnest([{_id('Role', 'pr')}, {_id('Company', 's_name')}, {_id('Company', 's_name')}, {_id('Company', 's_name')}, {_id('Company', 's_name')}, {_id('Company', 's_name')}]) FROM c JOIN j ON c.ck = j.ck
        UNION ALL SELECT ck, 'education', '0', unnest(['degree', 'institution', 'location', 'graduation_year']), unnest(['B.Sc.', place || ' College', region, '1999']), unnest(['Degree', 'Institution', 'Institution', 'Institution']),
            unnest([{_id('Degree', "'B.Sc.'")}, {_id('Institution', "place || ' College'")}, {_id('Institution', "place || ' College'")}, {_id('Institution', "place || ' College'")}]) FROM c
        UNION ALL SELECT c.ck, 'projects', (k - 1)::VARCHAR, unnest(['name', 'technologies', 'description']), unnest(['Work ' || ok, p_name || chr(31) || p_brand, 'In ' || st]), 'Project', cand || '_proj_' || k FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL
        UNION ALL SELECT ck, 'certifications', '0', unnest(['name', 'issuer', 'year']), unnest([segment, 'Board of ' || region, '2001']), 'Certification', {_id('Certification', 'segment', "'Board of ' || region")} FROM c UNION ALL SELECT ck, 'certifications', '1', 'name', 'No issuer', 'Certification', {_id('Certification', "'No issuer'", "''")} FROM c
        UNION ALL SELECT ck, 'languages', '0', unnest(['name', 'proficiency']), unnest([place, 'Native']), 'Language', {_id('Language', 'place')} FROM c UNION ALL SELECT ck, 'languages', '1', 'name', 'English', 'Language', {_id('Language', "'English'")} FROM c),
    r AS (SELECT *, CASE WHEN field = 'technologies' THEN '[''' || split_part(value, chr(31), 1) || ''', ''' || split_part(value, chr(31), 2) || ''']' ELSE value END AS written FROM k),
    q AS MATERIALIZED (SELECT * EXCLUDE (value, written), replace(value, chr(31), ' ') AS value, CASE WHEN field = 'technologies' THEN replace(written, '''', '"') ELSE value END AS prop, 'claim_' || substr(sha256(section || '|' || i || '|' || field || '|' || written), 1, 16) AS claim_id FROM r)"""
_GROUND = f"""b AS (SELECT ck, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS position FROM t),
    h AS MATERIALIZED (SELECT ck, position, {_N.format('line')} AS h FROM b WHERE position % 7 <> 6 AND {_N.format('line')} <> ''),
    a AS (SELECT DISTINCT ck, claim_id, {_N.format('value')} AS v FROM q),
    p AS (SELECT a.ck, claim_id, position, contains(h, v) AS exact, CASE WHEN contains(h, v) THEN 1.0::DOUBLE ELSE len(list_intersect(string_split(v, ' '), string_split(h, ' ')))::DOUBLE / len(list_distinct(string_split(v, ' '))) END AS score FROM a JOIN h ON a.ck = h.ck WHERE v <> ''),
    g AS MATERIALIZED (SELECT * FROM p WHERE score >= 0.45 QUALIFY row_number() OVER (PARTITION BY ck, claim_id ORDER BY score DESC, position) = 1)"""


@query(f"WITH {_ORDERS}, {_CLAIMS} SELECT ck::VARCHAR AS stem, section, field, value, claim_id FROM q")
def claims_whole(spark, sf_dir):
    return provenance.claims(_records(spark, sf_dir)).select("stem", "section", "field", "value", "claim_id")


def _grounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance.grounded(_records(spark, sf_dir), _lines(spark, sf_dir))


@query(f"WITH {_TEXTS}, {_CLAIMS}, {_GROUND} SELECT q.ck::VARCHAR AS stem, q.claim_id, q.field, g.claim_id IS NOT NULL AS grounded, q.ck || '_' || position AS block_id, CASE WHEN exact THEN 'exact_normalized' WHEN NOT exact THEN 'token_overlap' END AS match_type, round(score, 3) AS score FROM q LEFT JOIN g ON q.ck = g.ck AND q.claim_id = g.claim_id")
def ground_claims(spark, sf_dir):
    return _grounded(spark, sf_dir).select("stem", "claim_id", "field", "grounded", "block_id", "match_type", F.round("score", 3).alias("score"))


@query(f"WITH {_TEXTS}, {_CLAIMS}, {_GROUND} SELECT DISTINCT q.src, 'EXTRACTED_FROM' AS type, q.ck || '_' || position AS dst, q.claim_id AS identity FROM q JOIN g ON q.ck = g.ck AND q.claim_id = g.claim_id WHERE NOT (section = 'certifications' AND i = '1')")
def provenance_graph_edges(spark, sf_dir):
    records = _records(spark, sf_dir)
    lines = _lines(spark, sf_dir)
    nodes = graph.domain_graph(records)[0].select("id").union(lines.select("block_id"))
    people = records.select("stem", ids.candidate_id(F.col("candidate.name"), F.col("candidate.email")).alias("cand"))
    return graph.provenance_edges(provenance.grounded(records, lines), people, nodes).select("src", "type", "dst", "identity").distinct()


def _placed(lines: DataFrame) -> DataFrame:
    """Lines with the page (twenty lines each), the section (opened by a line with a mark) and the box that they stand in."""
    at, width = F.col("position"), F.length("text")
    placed = layout.with_sections(lines, ["stem"], ["position"], F.startswith("text", F.lit("[")))
    box = F.array(*[x.cast("double") for x in (F.lit(0), at * 12, width * 6, at * 12 + 10)])
    return placed.withColumns({"page_number": F.floor(at / 20).cast("int") + 1, "section_id": F.concat_ws("_section_", "stem", "section_number"), "bbox": box})


_PLACED = """w AS MATERIALIZED (SELECT ck, position, line, (position // 20 + 1)::INT AS page_number, ck || '_section_' || (1 + sum((line[1] = '[')::INT) OVER (PARTITION BY ck ORDER BY position)) AS section_id FROM b)"""


@query(f"""WITH {_TEXTS}, {_CLAIMS}, {_GROUND}, {_PLACED} SELECT DISTINCT q.ck::VARCHAR AS stem, q.claim_id, section, field, q.ck || '_' || g.position AS block_id, page_number, section_id, 0::DOUBLE AS x0, (12 * g.position)::DOUBLE AS top,
    (6 * length(line))::DOUBLE AS x1, (12 * g.position + 10)::DOUBLE AS bottom, line AS quote, CASE WHEN exact THEN 'exact_normalized' ELSE 'token_overlap' END AS match_type, round(score, 3) AS score
    FROM q JOIN g ON q.ck = g.ck AND q.claim_id = g.claim_id JOIN w ON w.ck = g.ck AND w.position = g.position""")
def claim_evidence(spark, sf_dir):
    """The whole evidence of each grounded claim: block, page, section, box and quote."""
    found = provenance.grounded(_records(spark, sf_dir), _placed(_lines(spark, sf_dir))).where("grounded")
    box = [F.col("bbox")[i].alias(c) for i, c in enumerate(("x0", "top", "x1", "bottom"))]
    return found.select("stem", "claim_id", "section", "field", "block_id", "page_number", "section_id", *box, "quote", "match_type", F.round("score", 3).alias("score")).distinct()


_JSON = "replace(replace({0}, '\\', '\\\\'), '\"', '\\\"')"


@query(f"""WITH {_TEXTS}, {_CLAIMS}, {_GROUND}, {_PLACED}, e AS (SELECT DISTINCT q.src, q.ck || '_' || g.position AS dst, q.claim_id, q.field, q.prop AS value, page_number, CASE WHEN exact THEN 'exact_normalized' ELSE 'token_overlap' END AS match_type, round(score, 3)::VARCHAR AS score
        FROM q JOIN g ON q.ck = g.ck AND q.claim_id = g.claim_id JOIN w ON w.ck = g.ck AND w.position = g.position WHERE NOT (section = 'certifications' AND i = '1'))
    SELECT src, dst, claim_id, field, value, page_number, match_type, score, 'rel_' || substr(sha256('{{"from": "' || src || '", "properties": {{"claim_id": "' || claim_id || '", "field": "' || field || '", "match_type": "' || match_type || '", "page_number": ' || page_number || ', "score": ' || score || ', "value": "' || {_JSON.format('value')}
        || '"}}, "to": "' || dst || '", "type": "EXTRACTED_FROM"}}'), 1, 20) AS rel_id FROM e""")
def provenance_edge_properties(spark, sf_dir):
    """All properties of the edges from claims to their evidence, and the edges' ids, which page and score enter as numbers."""
    records = _records(spark, sf_dir)
    lines = _placed(_lines(spark, sf_dir))
    nodes = graph.domain_graph(records)[0].select("id").union(lines.select("block_id"))
    people = records.select("stem", ids.candidate_id(F.col("candidate.name"), F.col("candidate.email")).alias("cand"))
    edges = graph.provenance_edges(provenance.grounded(records, lines), people, nodes, typed=True)
    shown = [F.try_variant_get(F.col("properties")[c], "$", kind).alias(c) for c, kind in (("claim_id", "string"), ("field", "string"), ("value", "string"), ("page_number", "int"), ("match_type", "string"), ("score", "string"))]
    return edges.select("src", "dst", *shown, ids.rel_id(F.col("src"), F.col("type"), F.col("dst"), F.col("properties"), typed=True).alias("rel_id")).distinct()


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector.section_documents(_records(spark, sf_dir))


_SECTIONS = f"""d AS MATERIALIZED (SELECT cand || ':summary' AS id, name || ' - ' || headline || '. Buys ' || segment || ' goods in ' || place || '.' AS document FROM c
        UNION ALL SELECT any_value(cand) || ':skills', any_value(name) || ' skills: ' || string_agg('name: ' || p_name || '; category: ' || p_brand, ' | ' ORDER BY i) FROM c JOIN j ON c.ck = j.ck GROUP BY c.ck
        UNION ALL SELECT any_value(cand) || ':experience', any_value(name) || ' experience: ' || string_agg('job title: ' || pr || '; company: ' || s_name || '; location: ' || place || '; start date: ' || i || '; end date: Present; description: Order ' || ok || ' | status ' || st, ' | ' ORDER BY i) FROM c JOIN j ON c.ck = j.ck GROUP BY c.ck
        UNION ALL SELECT cand || ':education', name || ' education: degree: B.Sc.; institution: ' || place || ' College; location: ' || region || '; graduation year: 1999' FROM c
        UNION ALL SELECT any_value(cand) || ':projects', any_value(name) || ' projects: ' || string_agg('name: Work ' || ok || '; technologies: ' || p_name || ', ' || p_brand || '; description: In ' || st, ' | ' ORDER BY i) FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL GROUP BY c.ck
        UNION ALL SELECT cand || ':certifications', name || ' certifications: name: ' || segment || '; issuer: Board of ' || region || '; year: 2001 | name: No issuer' FROM c UNION ALL SELECT cand || ':languages', name || ' languages: name: ' || place || '; proficiency: Native | name: English' FROM c)"""


@query(f"WITH {_ORDERS}, {_SECTIONS} SELECT * FROM d")
def record_sections(spark, sf_dir):
    return _sections(spark, sf_dir).select("id", "document")


def _search_sql(documents: str, question: str) -> str:
    """Five nearest documents by the cosine of counts of hashed words; the question is one row (document)."""
    cells = lambda of: f"(SELECT id, cell, count(*)::DOUBLE AS n FROM (SELECT id, ('0x' || substr(md5(w), 1, 8))::BIGINT % {vector.DIMENSIONS} AS cell FROM (SELECT id, unnest(string_split({_N.format('document')}, ' ')) AS w FROM {of}) WHERE w <> '') GROUP BY ALL)"
    return f"""x AS {cells(documents)}, y AS {cells(f"(SELECT 'q' AS id, {question} AS document)")}, z AS (SELECT id, sqrt(sum(n * n)) AS norm FROM x GROUP BY id),
    s AS (SELECT z.id, 1 - coalesce(dot, 0) / (norm * (SELECT sqrt(sum(n * n)) FROM y)) AS distance FROM z LEFT JOIN (SELECT x.id, sum(x.n * y.n) AS dot FROM x JOIN y ON x.cell = y.cell GROUP BY x.id) v ON z.id = v.id),
    r AS (SELECT id, distance, row_number() OVER (ORDER BY round(distance, 9), id) AS rank FROM s)
    SELECT r.id, rank::INT AS rank, round(distance, 4) + 0.0 AS distance, document FROM r JOIN {documents} m ON r.id = m.id WHERE rank <= 5"""


@query(f"WITH {_ORDERS}, {_SECTIONS}, {_search_sql('d', repr('Work in MACHINERY for the Board of ASIA'))}")
def text_search_sections(spark, sf_dir):
    return vector.search_text(_sections(spark, sf_dir).select("id", "document"), "Work in MACHINERY for the Board of ASIA").select("id", "rank", "distance", "document")


@query(f"WITH m AS MATERIALIZED (SELECT conv_id || '_' || turn AS id, text AS document FROM conversations WHERE trim(text) <> ''), f AS (SELECT document AS question FROM m ORDER BY id LIMIT 1), {_search_sql('m', '(SELECT question FROM f)')}")
def text_search_blocks(spark, sf_dir):
    blocks = table(spark, sf_dir, "conversations").where("trim(text) != ''").select(F.concat_ws("_", "conv_id", "turn").alias("id"), F.col("text").alias("document"))
    return vector.search_text(blocks, blocks.orderBy("id").first()["document"]).select("id", "rank", "distance", "document")


@query(f"WITH {_ORDERS} SELECT cand || '_proj_' || k AS id, '[\"' || p_name || '\", \"' || p_brand || '\"]' AS technologies, 'In ' || st AS description FROM c JOIN j ON c.ck = j.ck WHERE k IS NOT NULL")
def project_properties(spark, sf_dir):
    nodes = graph.merge_nodes(graph.domain_graph(_records(spark, sf_dir))[0]).where("label = 'Project'")
    return nodes.select("id", F.col("properties")["technologies"].alias("technologies"), F.col("properties")["description"].alias("description"))


#: Rules that many records break, some of them in several items of one array.
_RECORD_SCHEMA = {
    "type": "object", "required": ["candidate", "owner"],
    "properties": {
        "candidate": {"type": "object", "properties": {"headline": {"type": "string", "minLength": 1}}},
        "sections": {"properties": {
            "experience": {"type": "array", "items": {"$ref": "#/$defs/job"}},
            "certifications": {"minItems": 3, "items": {"properties": {"issuer": {"minLength": 1}, "year": {"const": "2001"}}}},
            "languages": {"items": {"properties": {"proficiency": {"minLength": 1}}}},
        }},
    },
    "$defs": {"job": {"type": "object", "required": ["job_title", "salary"], "properties": {"job_title": {"enum": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}, "start_date": {"pattern": "^[0-9][0-9]"}}}},
}


@query(f"""WITH {_ORDERS}, e AS (SELECT ck, 0 AS g, 0 AS i, '' AS f, '' AS p, chr(39) || 'owner' || chr(39) || ' is a required property' AS message FROM c
    UNION ALL SELECT ck, 1, 0, '', '.candidate.headline', 'is shorter than 1' FROM c WHERE headline = ''
    UNION ALL SELECT ck, 2, 0, '', '.sections.certifications', 'violates minItems 3' FROM c UNION ALL SELECT ck, 3, 1, 'issuer', '.sections.certifications[1].issuer', 'is shorter than 1' FROM c UNION ALL SELECT ck, 3, 1, 'year', '.sections.certifications[1].year', 'is not 2001' FROM c
    UNION ALL SELECT ck, 4, i, '', '.sections.experience[' || (i - 1) || ']', chr(39) || 'salary' || chr(39) || ' is a required property' FROM j
    UNION ALL SELECT ck, 4, i, 'job_title', '.sections.experience[' || (i - 1) || '].job_title', 'is not one of the allowed values' FROM j WHERE left(pr, 1) NOT IN ('1', '2', '3')
    UNION ALL SELECT ck, 4, i, 'start_date', '.sections.experience[' || (i - 1) || '].start_date', 'does not match ^[0-9][0-9]' FROM j WHERE i < 10
    UNION ALL SELECT ck, 5, 1, '', '.sections.languages[1].proficiency', 'is shorter than 1' FROM c)
    SELECT ck::VARCHAR AS stem, '$' || p AS path, CASE p WHEN '' THEN 'root' ELSE replace(replace(substr(p, 2), '[', '.'), ']', '') END AS at, message, row_number() OVER (PARTITION BY ck ORDER BY g, i, f)::INT AS rank FROM e""")
def record_schema_errors(spark, sf_dir):
    """Every error of every item, where it is and in which order it is printed."""
    rows = _records(spark, sf_dir).select("stem", F.to_json(F.struct("candidate", "sections")).alias("value"))
    return validate.schema_errors(rows, _RECORD_SCHEMA, "value", "stem").select("stem", "path", "at", "message", "rank")


@query("SELECT c_custkey::VARCHAR AS stem, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE NULL END AS images FROM customer")
def records_with_images(spark, sf_dir):
    records = _records(spark, sf_dir)
    image = F.from_json(F.lit('[{"image_id": "i", "kind": "photo"}]'), dict(records.dtypes)["images"])
    return sinks.with_images(records, records.where(F.col("stem").cast("long") % 2 == 0).select("stem", image.alias("images"))).select("stem", F.when(F.col("images").isNotNull(), F.size("images")).alias("images"))


@query("SELECT event_id, CASE WHEN value > 50 THEN 'true' WHEN value <= 50 THEN 'false' ELSE '' END AS high, coalesce(event_type, '') AS kind, user_id::VARCHAR AS who FROM events")
def csv_values(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("value") > 50).alias("high"), F.col("event_type").alias("kind"), F.col("user_id").alias("who"))
    return rows.select("event_id", *[text.csv_value(F.col(c), kind).alias(c) for c, kind in rows.dtypes if c != "event_id"])


# --- pages of words


@query("""SELECT conv_id AS document_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) || chr(10) || chr(10) || '[EMBEDDED LINKS]' || chr(10) || (SELECT string_agg(role, chr(10) ORDER BY first) FROM (SELECT role, min(turn) AS first FROM conversations b WHERE b.conv_id = a.conv_id GROUP BY role)) AS text FROM conversations a GROUP BY conv_id""")
def pages_with_links(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("document_id"), F.col("turn").alias("page_number"), "text", F.array("role").alias("uris"))
    return readers.text_with_links(pages)


@query("SELECT p_partkey, p_size * 10 AS width, 200 - p_size AS height FROM part WHERE p_size * 10 >= 120 AND 200 - p_size >= 120")
def large_images(spark, sf_dir):
    return readers.large_images(table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 10).alias("width"), (200 - F.col("p_size")).alias("height")))


@query("SELECT l_orderkey, string_agg(l_returnflag || ' | ' || CASE WHEN l_partkey % 5 = 0 THEN '' ELSE l_partkey::VARCHAR END, chr(10) ORDER BY l_linenumber, l_partkey, l_returnflag) AS text FROM lineitem GROUP BY 1")
def table_texts(spark, sf_dir):
    cells = F.array("l_returnflag", F.when(F.col("l_partkey") % 5 != 0, F.col("l_partkey").cast("string")))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag", cells.alias("cells")))), lambda x: x.cells).alias("rows"))
    return rows.select("l_orderkey", layout.table_text(F.col("rows")).alias("text"))


#: Words of a document for each order: a line's words are up to one unit apart, its neighbours twenty. Lines in capitals are
#: headings where they are bold or not smaller than their page's median.
_WORDS = """w AS (SELECT l_orderkey::VARCHAR AS d, CASE WHEN l_linenumber > 4 THEN 2 ELSE 1 END AS page, l_linenumber AS line, CASE WHEN l_partkey % 2 = 0 THEN 'W' ELSE 'w' END || l_partkey AS word, l_suppkey::DOUBLE AS x0, l_linenumber * 20 + (l_partkey % 3) * 0.5 AS top, (8 + l_suppkey % 3)::DOUBLE AS size, CASE l_returnflag WHEN 'R' THEN 'X-Bold' ELSE 'X' END AS font FROM lineitem),
    m AS (SELECT d, page, median(size) AS body FROM w GROUP BY 1, 2),
    l AS MATERIALIZED (SELECT d, page, line, string_agg(word, ' ' ORDER BY x0, top, word) AS text, min(x0) AS x0, min(top) AS top, max(x0) + 5 AS x1, max(top) + 8 AS bottom, max(size) AS font_size, bool_or(font = 'X-Bold') AS bold, array_to_string(list_sort(list(DISTINCT font)), ',') AS fonts, any_value(body) AS body_size FROM w JOIN m USING (d, page) GROUP BY d, page, line)"""
_BLOCKS = f"""{_WORDS}, o AS (SELECT *, row_number() OVER (PARTITION BY d, page ORDER BY top, x0, line) AS ro, CASE WHEN length(regexp_replace(text, '[^W]', '', 'g'))::DOUBLE / length(regexp_replace(text, '[^Ww]', '', 'g')) >= 0.85 AND len(string_split(text, ' ')) <= 7 AND (bold OR font_size >= body_size) OR bold AND font_size >= body_size + 1.5 AND len(string_split(text, ' ')) <= 6 THEN lower(replace(text, ' ', '_')) END AS heading FROM l),
    s AS MATERIALIZED (SELECT *, sum((heading IS NOT NULL)::INT) OVER (PARTITION BY d ORDER BY page, ro) + (first_value(heading IS NULL) OVER (PARTITION BY d ORDER BY page, ro))::INT AS number FROM o),
    b AS MATERIALIZED (SELECT *, d || '_page_' || page AS page_id, d || '_page_' || page || '_block_' || ro AS block_id, d || '_section_' || number AS section_id FROM s),
    z AS MATERIALIZED (SELECT d, section_id, coalesce(arg_min(coalesce(heading, ''), page * 1000 + ro), '') AS heading, arg_min(text, page * 1000 + ro) AS first, min(page) AS start_page, string_agg(block_id, ',' ORDER BY page, ro) AS block_ids FROM b GROUP BY 1, 2)"""


def _word_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = F.col("l_linenumber") * 20 + (F.col("l_partkey") % 3) * 0.5
    word = F.concat(F.when(F.col("l_partkey") % 2 == 0, "W").otherwise("w"), F.col("l_partkey").cast("string"))
    x0 = F.col("l_suppkey").cast("double")
    words = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("document_id"), F.when(F.col("l_linenumber") > 4, 2).otherwise(1).alias("page_number"), word.alias("text"), x0.alias("x0"), top.alias("top"), (x0 + 5).alias("x1"), (top + 8).alias("bottom"),
        (8 + F.col("l_suppkey") % 3).cast("double").alias("size"), F.when(F.col("l_returnflag") == "R", "X-Bold").otherwise("X").alias("fontname"),
    )
    return layout.lines(words)


def _structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.structure(_word_lines(spark, sf_dir).select("document_id", "page_number", F.lit("text").alias("type"), "text", "x0", "top", "x1", "bottom", "font_size", "bold", "body_size", F.col("line").alias("position")))


@query(f"WITH {_WORDS} SELECT d AS document_id, page AS page_number, text, x0, top::DOUBLE AS top, x1, bottom::DOUBLE AS bottom, font_size, bold, fonts, body_size FROM l")
def word_lines(spark, sf_dir):
    return _word_lines(spark, sf_dir).select("document_id", "page_number", "text", "x0", "top", "x1", "bottom", "font_size", "bold", F.array_join("font_names", ",").alias("fonts"), "body_size")


@query(f"WITH {_BLOCKS} SELECT block_id, page_id, section_id, ro::INT AS reading_order, CASE WHEN heading IS NULL THEN 'text' ELSE 'heading' END AS type, heading AS heading_type FROM b")
def page_structure(spark, sf_dir):
    return _structure(spark, sf_dir).select("block_id", "page_id", "section_id", "reading_order", "type", "heading_type")


@query(f"WITH {_BLOCKS} SELECT section_id, CASE WHEN heading = '' THEN 'Document header' ELSE first END AS title, CASE WHEN heading = '' THEN 'header' ELSE heading END AS normalized_type, start_page, block_ids FROM z")
def page_sections(spark, sf_dir):
    return layout.sections(_structure(spark, sf_dir)).select("section_id", "title", "normalized_type", "start_page", F.array_join("block_ids", ",").alias("block_ids"))


def _documents(blocks: DataFrame) -> DataFrame:
    return blocks.select("document_id").distinct().select("document_id", F.concat("document_id", F.lit(".pdf")).alias("source_file"), F.sha2("document_id", 256).alias("source_sha256"))


#: The second block of each page stands for a picture, with the block before and the one after as its context.
_PICTURES = "v AS (SELECT *, ro = 2 AS picture, CASE WHEN ro = 2 THEN 'img_' || block_id ELSE block_id END AS node FROM b)"


@query(f"""WITH {_BLOCKS}, {_PICTURES} SELECT DISTINCT 'resume_' || substr(sha256(d), 1, 16) AS src, 'HAS_PAGE' AS type, page_id AS dst FROM b UNION ALL SELECT 'resume_' || substr(sha256(d), 1, 16), 'HAS_SECTION', section_id FROM z
    UNION ALL SELECT page_id, 'HAS_BLOCK', node FROM v UNION ALL SELECT section_id, 'HAS_BLOCK', node FROM v
    UNION ALL SELECT * FROM (SELECT node, 'NEXT_BLOCK', lead(node) OVER (PARTITION BY d ORDER BY page, ro) AS next FROM v) WHERE next IS NOT NULL
    UNION ALL SELECT p.node, 'HAS_CONTEXT', x.node FROM v p JOIN v x ON p.page_id = x.page_id AND x.ro IN (1, 3) WHERE p.picture""")
def document_graph_edges(spark, sf_dir):
    blocks = _structure(spark, sf_dir)
    context = F.transform(F.array(F.lit(1), F.lit(3)), lambda n: F.concat("page_id", F.lit("_block_"), n.cast("string")))
    pictured = F.col("reading_order") == 2
    blocks = blocks.withColumns({"type": F.when(pictured, "image").otherwise(F.col("type")), "image_id": F.when(pictured, F.concat(F.lit("img_"), "block_id")), "context_block_ids": F.when(pictured, context)})
    pages = blocks.select("document_id", "page_id", "page_number").distinct().select("*", F.lit(100.0).alias("width"), F.lit(100.0).alias("height"), F.lit("").alias("raw_text"))
    _, edges = graph.document_graph(_documents(blocks), pages, layout.sections(blocks), blocks)
    return graph.merge_edges(edges).select("src", "type", "dst")


@query(f"WITH {_BLOCKS} SELECT block_id AS id, text AS document, b.d || '.pdf' AS source_file, CASE WHEN z.heading = '' THEN 'Document header' ELSE first END AS section_title FROM b JOIN z USING (section_id)")
def block_documents(spark, sf_dir):
    blocks = _structure(spark, sf_dir)
    return vector.block_documents(blocks, layout.sections(blocks), _documents(blocks)).select("id", "document", "metadata.source_file", "metadata.section_title")
