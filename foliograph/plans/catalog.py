"""Registered queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, text
from ..operators import graph, layout, parse, patterns, provenance, validate, vector
from ..sources import readers
from . import texts  # noqa: F401  its queries are registered
from .registry import QUERIES, SQL, query
from .registry import table as _t

__all__ = ["QUERIES", "SQL"]

# --- blocks and text expressions

_BLOCKS = """blocks AS (
    SELECT doc_id, pos AS reading_order, trim(line, ' ' || chr(9)) AS block FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents
    ) WHERE trim(line, ' ' || chr(9)) <> ''
)"""


def _norm(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g'))"


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return rows.select("doc_id", (F.col("pos") + 1).alias("reading_order"), F.btrim("line", F.lit(" \t")).alias("block")).where("block != ''")


@query(f"WITH {_BLOCKS} SELECT doc_id, reading_order, block FROM blocks")
def text_blocks(spark, sf_dir):
    return _blocks(spark, sf_dir)


@query("""SELECT p_partkey, coalesce(c[1], '') AS c0, coalesce(c[2], '') AS c1, coalesce(c[3], '') AS c2, coalesce(c[4], '') AS c3
    FROM (SELECT p_partkey, string_split(replace(p_name, ' ', '|'), '|') AS c FROM part)""")
def pipe_rows_padded(spark, sf_dir):
    rows = _t(spark, sf_dir, "part").withColumn("c", F.get(text.pipe_rows(F.translate("p_name", " ", "|")), F.lit(0)))
    return rows.select("p_partkey", *[text.item(F.col("c"), i).alias(f"c{i}") for i in range(4)])


@query("""SELECT page_id, name, value FROM (
        SELECT page_id, trim(string_split(x, '|')[1]) AS name, trim(CASE WHEN strpos(x, '|') > 0 THEN substr(x, strpos(x, '|') + 1) ELSE '' END) AS value
        FROM (SELECT page_id, unnest(string_split(replace(replace(CASE WHEN strpos(url, '?') > 0 THEN substr(url, strpos(url, '?') + 1) ELSE '' END, '&', ';'), '=', '|'), ';')) AS x FROM pages)
        WHERE trim(x) <> '')""")
def pairs_first_split(spark, sf_dir):
    tail = F.when(F.instr("url", "?") > 0, F.substr(F.col("url"), F.instr("url", "?") + 1)).otherwise("")
    rows = _t(spark, sf_dir, "pages").select("page_id", F.explode(text.pairs(F.translate(tail, "&=", ";|"), "value")).alias("p"))
    return rows.select("page_id", "p.name", "p.value")


@query("""SELECT o_orderkey, regexp_extract(h, '(?im)^Status:\\s*(.+)$', 1) AS status, regexp_extract(h, '(?im)^Priority:\\s*(.+)$', 1) AS priority, regexp_extract(h, '(?im)^Clerk:\\s*(.+)$', 1) AS clerk
    FROM (SELECT o_orderkey, 'Order' || chr(10) || 'Status: ' || o_orderstatus || chr(10) || 'priority: ' || o_orderpriority AS h FROM orders)""")
def header_value(spark, sf_dir):
    h = F.concat(F.lit("Order\nStatus: "), "o_orderstatus", F.lit("\npriority: "), "o_orderpriority")
    rows = _t(spark, sf_dir, "orders").withColumn("h", h)
    return rows.select("o_orderkey", text.header_value(F.col("h"), "Status").alias("status"), text.header_value(F.col("h"), "Priority").alias("priority"), text.header_value(F.col("h"), "Clerk").alias("clerk"))


@query("""WITH l AS (SELECT doc_id, trim(ltrim(trim(unnest(string_split(text, chr(10))), ' '), '#'), ' ') AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
    f AS (SELECT doc_id, arg_min(line, pos) AS name FROM l WHERE line <> '' AND NOT contains(line, ':') GROUP BY doc_id)
    SELECT d.doc_id, coalesce(name, 'Unknown Candidate') AS name FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id""")
def name_from_header(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.name_from_header(F.col("text")).alias("name"))


@query(r"""WITH m AS (SELECT p_partkey, 'head' || chr(10) || '[PART]' || chr(10) || p_name || chr(10) || '[BRAND]' || chr(10) || p_brand || chr(10) || chr(10) || '[BRAND]' || chr(10) || p_type || chr(10) AS m FROM part)
    SELECT p_partkey, trim(regexp_extract(m, '(?s).*\[PART\]\n(.*?)(\n\[|$)', 1), ' ' || chr(10)) AS part, trim(regexp_extract(m, '(?s).*\[BRAND\]\n(.*?)(\n\[|$)', 1), ' ' || chr(10)) AS brand, trim(regexp_extract(m, '(?s).*\[SIZE\]\n(.*?)(\n\[|$)', 1), ' ' || chr(10)) AS missing FROM m""")
def section_split(spark, sf_dir):
    marked = F.concat(F.lit("head\n[PART]\n"), "p_name", F.lit("\n[BRAND]\n"), "p_brand", F.lit("\n\n[BRAND]\n"), "p_type", F.lit("\n"))
    rows = _t(spark, sf_dir, "part").withColumn("m", marked)
    return rows.select("p_partkey", text.section(F.col("m"), "PART").alias("part"), text.section(F.col("m"), "BRAND").alias("brand"), text.section(F.col("m"), "SIZE").alias("missing"))


@query("""SELECT p_partkey, CASE WHEN s = '' THEN 'section' ELSE s END AS slug, trim(regexp_replace(lower(p_type), '[^a-z0-9]', '_', 'g'), '_') AS safe
    FROM (SELECT *, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS s FROM part)""")
def slug_values(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"), text.safe_name(F.col("p_type")).alias("safe"))


@query(f"SELECT doc_id, {_norm('text')} AS normalized FROM documents")
def normalized_text(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.normalized(F.col("text")).alias("normalized"))


@query("SELECT c_custkey, 'cand_' || substr(sha256(lower(trim(c_name)) || '|' || lower(trim(c_mktsegment))), 1, 12) AS candidate_id FROM customer")
def stable_candidate_id(spark, sf_dir):
    return _t(spark, sf_dir, "customer").select("c_custkey", ids.candidate_id(F.col("c_name"), F.col("c_mktsegment")).alias("candidate_id"))


@query("SELECT p_partkey, 'skill_' || substr(sha256(lower(trim(p_name))), 1, 16) AS skill, 'certification_' || substr(sha256(lower(trim(p_name)) || '|' || lower(trim(p_brand))), 1, 16) AS certification FROM part")
def entity_ids(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", ids.entity_id("Skill", F.col("p_name")).alias("skill"), ids.entity_id("Certification", F.col("p_name"), F.col("p_brand")).alias("certification"))


@query("""SELECT page_id, pos::INT AS "index", uri FROM (
        SELECT page_id, unnest(u) AS uri, generate_subscripts(u, 1) AS pos FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*?href="([^"]*)"', 1) AS u FROM pages))""")
def link_scan(spark, sf_dir):
    return readers.links(_t(spark, sf_dir, "pages"))


@query("""SELECT c_custkey, regexp_replace('MailTo:c' || c_custkey || '@example.test', '(?i)^mailto:', '') AS address FROM customer""")
def mailto_strip(spark, sf_dir):
    return _t(spark, sf_dir, "customer").select("c_custkey", text.without_mailto(F.concat(F.lit("MailTo:c"), "c_custkey", F.lit("@example.test"))).alias("address"))


@query(r"SELECT p_partkey, trim(regexp_replace(' ' || p_name || ' (cid:' || p_size || ') (x)  (cid:7)', '\s*\(cid:\d+\)', '', 'g')) AS cleaned FROM part")
def cid_cleanup(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", text.clean_cids(F.concat(F.lit(" "), "p_name", F.lit(" (cid:"), F.col("p_size").cast("string"), F.lit(") (x)  (cid:7)"))).alias("cleaned"))


@query("SELECT p_partkey, trim(s) AS skill, pos::INT AS pos FROM (SELECT p_partkey, unnest(string_split(replace(p_name, ' ', ','), ',')) AS s, generate_subscripts(string_split(replace(p_name, ' ', ','), ','), 1) AS pos FROM part) WHERE trim(s) <> ''")
def skill_fanout(spark, sf_dir):
    rows = _t(spark, sf_dir, "part").select("p_partkey", F.posexplode(parse.fan_out_skills(F.regexp_replace("p_name", " ", ";"))).alias("p", "skill"))
    return rows.select("p_partkey", "skill", (F.col("p") + 1).alias("pos"))


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality, CASE WHEN l.toxic IS NULL THEN d.lang ELSE d.lang || '-' || l.toxic END AS lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def overlay_defaults(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    told = F.when(F.col("toxic").isNotNull(), F.concat(F.lit(" "), "lang", F.lit("-"), F.col("toxic").cast("string"), F.lit(" ")))
    over = parse.overlay(F.struct("lang"), F.struct(told.alias("lang")), ["lang"])
    filled = parse.with_defaults(F.to_json(F.struct(F.col("quality").cast("string").alias("quality"))), "quality string", {"quality": "-1"})
    return rows.select("doc_id", filled["quality"].cast("int").alias("quality"), over["lang"].alias("lang"))


# --- layout


@query(f"""WITH {_BLOCKS} SELECT doc_id, reading_order, length(regexp_replace(block, '[^\\p{{Lu}}]', '', 'g')) AS upper, length(regexp_replace(block, '[^\\p{{L}}]', '', 'g')) AS letters,
    length(regexp_replace(block, '[^\\p{{Lu}}]', '', 'g'))::DOUBLE / nullif(length(regexp_replace(block, '[^\\p{{L}}]', '', 'g')), 0) AS ratio FROM blocks""")
def uppercase_ratio(spark, sf_dir):
    b = _blocks(spark, sf_dir)
    count = lambda p: F.length(F.regexp_replace("block", p, "")).cast("long")
    return b.select("doc_id", "reading_order", count(r"[^\p{Lu}]").alias("upper"), count(r"[^\p{L}]").alias("letters"), text.uppercase_ratio(F.col("block")).alias("ratio"))


@query(f"""WITH {_BLOCKS}, w AS (SELECT *, regexp_replace(block, ':+$', '') AS core FROM blocks),
    f AS (SELECT *, len(list_filter(regexp_split_to_array(core, '\\s+'), lambda x: x <> '')) AS words,
        coalesce(length(regexp_replace(core, '[^\\p{{Lu}}]', '', 'g'))::DOUBLE / nullif(length(regexp_replace(core, '[^\\p{{L}}]', '', 'g')), 0), 0) AS ratio,
        trim(regexp_replace(lower(core), '[^a-z0-9]+', '_', 'g'), '_') AS s, reading_order % 3 = 0 AS bold FROM w)
    SELECT doc_id, reading_order, CASE WHEN words BETWEEN 1 AND 7 AND ratio >= 0.85 AND (bold OR 10 >= 10) OR words BETWEEN 1 AND 6 AND bold THEN CASE WHEN s = '' THEN 'section' ELSE s END END AS heading FROM f""")
def heading_classify(spark, sf_dir):
    bold = F.col("reading_order") % 3 == 0
    size = F.when(bold, 12.0).otherwise(10.0)
    return _blocks(spark, sf_dir).select("doc_id", "reading_order", layout.heading_type(F.col("block"), bold, size, F.lit(10.0)).alias("heading"))


@query("""SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_quantity, l_returnflag <> 'R', l_linenumber, l_partkey)::INT AS reading_order FROM lineitem""")
def reading_order(spark, sf_dir):
    items = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("top"), F.col("l_quantity").alias("x0"), F.when(F.col("l_returnflag") == "R", "image").otherwise("text").alias("type"), F.struct("l_linenumber", "l_partkey").alias("position"))
    return layout.in_reading_order(items, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "reading_order")


@query("""SELECT conv_id, turn, (sum((role = 'user')::INT) OVER w + (first_value(role <> 'user') OVER w)::INT)::INT AS section_number FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)""")
def section_forward_fill(spark, sf_dir):
    return layout.with_sections(_t(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], F.col("role") == "user").select("conv_id", "turn", "section_number")


@query("SELECT conv_id, turn AS src, dst FROM (SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS dst FROM conversations) WHERE dst IS NOT NULL")
def next_block(spark, sf_dir):
    return layout.next_blocks(_t(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], "turn")


_ASSETS = """i AS (SELECT l_orderkey, l_linenumber, min(l_quantity) AS q, min(l_returnflag) AS f, min(l_linestatus) AS s FROM lineitem GROUP BY 1, 2),
    a AS (SELECT l_orderkey, l_linenumber, q AS top, q + 2 AS bottom FROM i WHERE f = 'R'),
    t AS (SELECT l_orderkey, l_linenumber AS reading_order, q AS t_top, q + 1 AS t_bottom, s || l_linenumber AS text FROM i WHERE f <> 'R')"""


def _assets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    items = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*[F.min(c).alias(c) for c in ("l_quantity", "l_returnflag", "l_linestatus")])
    q = F.col("l_quantity")
    assets = items.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", F.concat_ws("_", "l_orderkey", "l_linenumber").alias("asset_id"), q.alias("top"), (q + 2).alias("bottom"))
    texts = items.where("l_returnflag != 'R'").select("l_orderkey", F.col("l_linenumber").alias("reading_order"), q.alias("t_top"), (q + 1).alias("t_bottom"), F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("text"), F.col("l_linenumber").cast("string").alias("block_id"))
    return assets, texts


@query(f"""WITH {_ASSETS}, r AS (SELECT a.l_orderkey, a.l_linenumber, text, row_number() OVER (PARTITION BY a.l_orderkey, a.l_linenumber ORDER BY least(abs(t_top - bottom), abs(top - t_bottom)), reading_order) AS k FROM a JOIN t USING (l_orderkey))
    SELECT a.l_orderkey, a.l_linenumber, coalesce(string_agg(text, ' | ' ORDER BY k) FILTER (k <= 3), '') AS nearby_text FROM a LEFT JOIN r ON a.l_orderkey = r.l_orderkey AND a.l_linenumber = r.l_linenumber GROUP BY 1, 2""")
def nearest_context(spark, sf_dir):
    return layout.nearest_context(*_assets(spark, sf_dir), ["l_orderkey"]).select("l_orderkey", "l_linenumber", "nearby_text")


@query(f"""WITH {_ASSETS} SELECT a.l_orderkey, a.l_linenumber, coalesce(arg_min(text, t_top * 1000 + reading_order), '') AS caption
    FROM a LEFT JOIN t ON a.l_orderkey = t.l_orderkey AND t_top - bottom BETWEEN 0 AND 70 GROUP BY 1, 2""")
def caption_below(spark, sf_dir):
    return layout.captions(*_assets(spark, sf_dir), ["l_orderkey"]).select("l_orderkey", "l_linenumber", "caption")


@query("SELECT l_orderkey AS document_id, coalesce(median(nullif(l_quantity, 0)), 10.0) AS body_size FROM lineitem GROUP BY 1")
def page_median_size(spark, sf_dir):
    words = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document_id"), F.lit(1).alias("page_number"), F.col("l_quantity").alias("size"))
    return layout.page_size(words).select("document_id", "body_size")


@query("SELECT conv_id AS document_id, count(DISTINCT turn // 4) AS pages, count(DISTINCT role) AS sections, count(*) AS blocks, count(*) FILTER (role <> 'system') AS text_blocks, count(*) FILTER (role = 'system') AS images, 0::BIGINT AS tables FROM conversations GROUP BY 1")
def document_statistics(spark, sf_dir):
    blocks = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("document_id"), F.floor(F.col("turn") / 4).alias("page_id"), F.col("role").alias("section_id"), F.when(F.col("role") == "system", "image").otherwise("text").alias("type"))
    return layout.statistics(blocks)


# --- claims and evidence

_TOKENS = "list_distinct(list_filter(string_split({0}, ' '), lambda x: x <> ''))"
_BEST = f"""WITH {_BLOCKS}, t AS (SELECT item_id, {_norm("text")} AS t, {_TOKENS.format(_norm("text"))} AS tt FROM benchmark),
    h AS (SELECT doc_id, reading_order, {_norm("block")} AS h, {_TOKENS.format(_norm("block"))} AS ht FROM blocks WHERE {_norm("block")} <> ''),
    p AS (SELECT item_id, doc_id, reading_order, CASE WHEN contains(h, t) THEN 1.0::DOUBLE ELSE len(list_intersect(tt, ht))::DOUBLE / greatest(len(tt), 1) END AS score FROM t JOIN h ON true WHERE t <> ''),
    best AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, reading_order) AS k FROM p WHERE score >= 0.45)"""


def _best(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = _blocks(spark, sf_dir).select("doc_id", F.col("reading_order").alias("position"), F.col("block").alias("text"))
    return provenance.best_matches(_t(spark, sf_dir, "benchmark"), blocks).withColumnRenamed("position", "reading_order")


@query(_BEST + " SELECT item_id, doc_id, reading_order, score FROM best WHERE k = 1")
def provenance_best_match(spark, sf_dir):
    return _best(spark, sf_dir)


@query(_BEST + """, g AS (SELECT b.item_id, d.lang, best.item_id IS NOT NULL AS grounded FROM benchmark b LEFT JOIN best ON b.item_id = best.item_id AND k = 1 LEFT JOIN documents d ON best.doc_id = d.doc_id)
    SELECT coalesce(lang, 'none') AS lang, count(*) AS total_claims, count(*) FILTER (grounded) AS grounded_claims, count(*) FILTER (NOT grounded) AS ungrounded_claims, round(count(*) FILTER (grounded) / count(*)::DOUBLE, 3) AS coverage FROM g GROUP BY 1""")
def provenance_coverage(spark, sf_dir):
    found = _best(spark, sf_dir).join(_t(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", "left")
    rows = _t(spark, sf_dir, "benchmark").select("item_id").join(found, "item_id", "left").select(F.coalesce("lang", F.lit("none")).alias("lang"), F.col("doc_id").isNotNull().alias("grounded"))
    return provenance.coverage(rows, ["lang"])


@query("""SELECT c_custkey AS stem, field, value, 'claim_' || substr(sha256('candidate|None|' || field || '|' || value), 1, 16) AS claim_id FROM (
    SELECT c_custkey, 'name' AS field, c_name AS value FROM customer UNION ALL SELECT c_custkey, 'headline', c_mktsegment FROM customer) WHERE value <> ''""")
def claims_fanout(spark, sf_dir):
    fields = {f: F.lit("") for f in ("name", "email", "phone", "location", "linkedin", "portfolio", "headline", "summary")} | {"name": F.col("c_name"), "headline": F.col("c_mktsegment")}
    empty = "struct<skills:array<struct<name:string,category:string>>,experience:array<struct<experience_id:string,job_title:string,company:string,location:string,start_date:string,end_date:string,description:string>>,education:array<struct<education_id:string,degree:string,institution:string,location:string,graduation_year:string>>,projects:array<struct<project_id:string,name:string,technologies:array<string>,description:string,url:string>>,certifications:array<struct<name:string,issuer:string,year:string>>,languages:array<struct<name:string,proficiency:string>>>"
    records = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("stem"), F.struct(*[v.alias(f) for f, v in fields.items()]).alias("candidate"), F.from_json(F.lit('{"skills":[],"experience":[],"education":[],"projects":[],"certifications":[],"languages":[]}'), empty).alias("sections"))
    return provenance.claims(records).select("stem", "field", "value", "claim_id")


# --- graphs

_GRAPH = """n AS (
        SELECT 'c' || c_custkey AS id, 'Candidate' AS label, c_name AS name FROM customer UNION ALL SELECT 'p' || p_partkey, 'Skill', p_name FROM part
        UNION ALL SELECT 's' || s_suppkey, 'Company', s_name FROM supplier UNION ALL SELECT 'n' || n_nationkey, 'Institution', n_name FROM nation),
    e AS (
        SELECT DISTINCT 'c' || o_custkey AS src, 'HAS_SKILL' AS type, 'p' || l_partkey AS dst FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        UNION ALL SELECT DISTINCT 'c' || o_custkey, 'WORKED_AT', 's' || l_suppkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        UNION ALL SELECT 'c' || c_custkey, 'STUDIED_AT', 'n' || c_nationkey FROM customer
        UNION ALL SELECT 's' || s_suppkey, 'BASED_IN', 'n' || s_nationkey FROM supplier)"""


def _graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = lambda name: _t(spark, sf_dir, name)
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))

    def nodes(df: DataFrame, p: str, c: str, label: str, name: str) -> DataFrame:
        return df.select(key(p, c).alias("id"), F.lit(label).alias("label"), F.col(name).alias("name"))

    found = nodes(t("customer"), "c", "c_custkey", "Candidate", "c_name").union(nodes(t("part"), "p", "p_partkey", "Skill", "p_name"))
    found = found.union(nodes(t("supplier"), "s", "s_suppkey", "Company", "s_name")).union(nodes(t("nation"), "n", "n_nationkey", "Institution", "n_name"))
    lines = t("orders").select("o_orderkey", "o_custkey").join(t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey"), "o_orderkey")

    def edges(df: DataFrame, a: str, x: str, kind: str, b: str, y: str) -> DataFrame:
        return df.select(key(a, x).alias("src"), F.lit(kind).alias("type"), key(b, y).alias("dst"))

    links = edges(lines.select("o_custkey", "l_partkey").distinct(), "c", "o_custkey", "HAS_SKILL", "p", "l_partkey")
    links = links.union(edges(lines.select("o_custkey", "l_suppkey").distinct(), "c", "o_custkey", "WORKED_AT", "s", "l_suppkey"))
    links = links.union(edges(t("customer"), "c", "c_custkey", "STUDIED_AT", "n", "c_nationkey")).union(edges(t("supplier"), "s", "s_suppkey", "BASED_IN", "n", "s_nationkey"))
    return found, links


@query(f"WITH {_GRAPH} SELECT id, min(label) AS label, max(name) AS name FROM n GROUP BY id")
def graph_nodes(spark, sf_dir):
    nodes, _ = _graph(spark, sf_dir)
    raw = nodes.select("id", "label", F.create_map(F.lit("name"), F.col("name")).alias("properties"), F.lit(0).alias("ordinal"))
    return graph.merge_nodes(raw).select("id", "label", F.col("properties")["name"].alias("name"))


@query(f"WITH {_GRAPH} SELECT src, type, dst FROM e")
def graph_edges(spark, sf_dir):
    _, edges = _graph(spark, sf_dir)
    raw = edges.select("*", F.lit(None).cast("string").alias("identity"), F.create_map().cast(graph.NO_PROPERTIES).alias("properties"), F.lit(0).alias("ordinal"))
    return graph.merge_edges(raw).select("src", "type", "dst")


@query("SELECT user_id::VARCHAR AS id, event_type, arg_max(value, (ts, event_id)) AS value FROM events WHERE value IS NOT NULL GROUP BY 1, 2")
def node_merge_last_wins(spark, sf_dir):
    raw = _t(spark, sf_dir, "events").where("value is not null").select(F.col("user_id").cast("string").alias("id"), F.lit("User").alias("label"), F.create_map("event_type", F.col("value").cast("string")).alias("properties"), F.struct("ts", "event_id").alias("ordinal"))
    return graph.merge_nodes(raw).select("id", F.explode("properties").alias("event_type", "value")).withColumn("value", F.col("value").cast("double"))


@query("""SELECT o_custkey::VARCHAR AS src, l_partkey::VARCHAR AS dst, arg_max(l_linenumber, (o_orderkey, l_linenumber, l_suppkey))::VARCHAR AS line FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def edge_dedupe_identity(spark, sf_dir):
    lines = _t(spark, sf_dir, "orders").join(_t(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    raw = lines.select(F.col("o_custkey").cast("string").alias("src"), F.lit("ORDERED").alias("type"), F.col("l_partkey").cast("string").alias("dst"), F.lit(None).cast("string").alias("identity"), F.create_map(F.lit("line"), F.col("l_linenumber").cast("string")).alias("properties"), F.struct("o_orderkey", "l_linenumber", "l_suppkey").alias("ordinal"))
    return graph.merge_edges(raw).select("src", "dst", F.col("properties")["line"].alias("line"))


@query(f"""WITH {_GRAPH}, x AS (SELECT * FROM e UNION ALL SELECT 'c' || c_custkey, 'HAS_SKILL', 'none' FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT dst, type, src FROM e WHERE type = 'STUDIED_AT')
    SELECT 'unknown type' AS kind, src || '>' || dst AS subject, type AS detail FROM x WHERE type = 'BASED_IN'
    UNION ALL SELECT 'missing node', src || '>' || dst, type FROM x WHERE dst = 'none'
    UNION ALL SELECT 'invalid labels', src || '>' || dst, type FROM x WHERE type = 'STUDIED_AT' AND src[1] = 'n'""")
def graph_schema_errors(spark, sf_dir):
    nodes, edges = _graph(spark, sf_dir)
    wrong = _t(spark, sf_dir, "customer").where("c_custkey % 10 = 0").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("src"), F.lit("HAS_SKILL").alias("type"), F.lit("none").alias("dst"))
    turned = edges.where("type = 'STUDIED_AT'").select(F.col("dst").alias("src"), "type", F.col("src").alias("dst"))
    return graph.schema_errors(nodes, edges.union(wrong).union(turned).withColumn("ordinal", F.concat("src", F.lit(">"), "dst")))


@query(f"WITH {_GRAPH} SELECT src AS from_id, type, dst AS to_id, 'rel_' || substr(sha256('{{\"from\": \"' || src || '\", \"properties\": {{\"kind\": \"' || lower(type) || '\"}}, \"to\": \"' || dst || '\", \"type\": \"' || type || '\"}}'), 1, 20) AS rel_id FROM e")
def rel_ids(spark, sf_dir):
    _, edges = _graph(spark, sf_dir)
    return edges.select(F.col("src").alias("from_id"), "type", F.col("dst").alias("to_id"), ids.rel_id(F.col("src"), F.col("type"), F.col("dst"), F.create_map(F.lit("kind"), F.lower("type"))).alias("rel_id"))


@query("""WITH d AS (SELECT event_id, user_id, value, event_type, '{"from": "u' || user_id || '", "properties": {"flags": [' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END || ', null], "n": ' || event_id || ', "note": "' || event_type || '\\n\\t\\"é\\\\", "of": {"a": 1, "b": ["x"]}}, "to": "e' || event_id || '", "type": "MADE"}' AS text FROM events)
    SELECT event_id, 'rel_' || substr(sha256(text), 1, 20) AS rel_id, '{"a": 1, "b": ["x"]}' AS "of", '[' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END || ',null]' AS flags FROM d""")
def typed_edge_ids(spark, sf_dir):
    """Ids of edges whose properties are numbers, lists, objects, and texts with line feeds, tabs, quotes and other letters."""
    note = F.concat(F.coalesce("event_type", F.lit("")), F.lit('\n\t"é\\'))
    of = F.parse_json(F.lit('{"b": ["x"], "a": 1}'))
    flags = F.parse_json(F.concat(F.lit("["), (F.col("event_id") % 2 == 0).cast("string"), F.lit(",null]")))
    rows = _t(spark, sf_dir, "events").select("event_id", "user_id", F.create_map(F.lit("of"), of, F.lit("note"), F.parse_json(text.json_string(note)), F.lit("n"), F.parse_json(F.col("event_id").cast("string")), F.lit("flags"), flags).alias("p"))
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    kept = lambda name: F.to_json(text.store_value(F.col("p")[name]))
    return rows.select("event_id", ids.rel_id(key("u", "user_id"), F.lit("MADE"), key("e", "event_id"), F.col("p"), typed=True).alias("rel_id"), F.try_variant_get(text.store_value(F.col("p")["of"]), "$", "string").alias("of"), kept("flags").alias("flags"))


@query("SELECT 's' || s_suppkey AS graph_id, s_acctbal::VARCHAR AS balance, s_name AS name FROM supplier WHERE s_acctbal = floor(s_acctbal) UNION ALL SELECT 's' || s_suppkey, '', s_name FROM supplier WHERE s_acctbal <> floor(s_acctbal)")
def csv_export_nodes(spark, sf_dir):
    from ..sources import sinks

    rows = _t(spark, sf_dir, "supplier")
    whole = F.col("s_acctbal") == F.floor("s_acctbal")
    properties = F.when(whole, F.create_map(F.lit("name"), F.col("s_name"), F.lit("balance"), F.col("s_acctbal").cast("string"))).otherwise(F.create_map(F.lit("name"), F.col("s_name")))
    nodes = rows.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.lit("Company").alias("label"), properties.alias("properties"))
    out = sinks.node_tables(nodes)["Company"]
    return out if "balance" in out.columns else out.withColumn("balance", F.lit(""))


# --- validation


@query("SELECT d.doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS k FROM documents) d WHERE k > 1")
def dup_hash_detect(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return validate.repeated_sources(rows, "digest", "doc_id").select("doc_id")


@query("""SELECT l_orderkey AS document_id, 'invalid box' AS kind, l_orderkey || '_' || l_linenumber AS subject FROM lineitem WHERE l_discount < l_tax
    UNION ALL SELECT l_orderkey, 'missing page', l_orderkey || '_' || l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
    UNION ALL SELECT l_orderkey, 'repeated block', l_orderkey || '_' || l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    UNION ALL SELECT o_orderkey, 'page_count', '1' FROM orders WHERE o_orderstatus = 'P'""")
def structural_checks(spark, sf_dir):
    orders, items = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem")
    documents = orders.select(F.col("o_orderkey").alias("document_id"), F.lit(1).alias("page_count"))
    pages = orders.where("o_orderstatus != 'P'").select(F.col("o_orderkey").alias("document_id"), F.col("o_orderkey").alias("page_id"))
    sections = items.select(F.col("l_orderkey").alias("document_id"), F.col("l_suppkey").alias("section_id"))
    blocks = items.select(F.col("l_orderkey").alias("document_id"), F.col("l_orderkey").alias("page_id"), F.col("l_suppkey").alias("section_id"), F.concat_ws("_", "l_orderkey", "l_linenumber").alias("block_id"), F.col("l_tax").alias("x0"), F.col("l_discount").alias("x1"), F.lit(0.0).alias("top"), F.lit(1.0).alias("bottom"))
    return validate.structural_errors(documents, pages, sections, blocks)


SCHEMA = {
    "type": "object",
    "required": ["lang", "source", "quality"],
    "additionalProperties": False,
    "properties": {"lang": {"enum": ["de", "en", "es"]}, "source": {"type": "string", "pattern": "^src1", "minLength": 5}, "n": {"type": "integer", "minimum": 1000}},
}


@query("""SELECT doc_id, '$' AS path, '''quality'' is a required property' AS message FROM documents
    UNION ALL SELECT doc_id, '$', 'additional properties are not allowed' FROM documents WHERE doc_id % 7 = 0
    UNION ALL SELECT doc_id, '$.lang', 'is not one of the allowed values' FROM documents WHERE lang NOT IN ('de', 'en', 'es')
    UNION ALL SELECT doc_id, '$.source', 'is shorter than 5' FROM documents WHERE length(source) < 5
    UNION ALL SELECT doc_id, '$.source', 'does not match ^src1' FROM documents WHERE NOT regexp_matches(source, '^src1')
    UNION ALL SELECT doc_id, '$.n', 'is less than the minimum of 1000' FROM documents WHERE n_chars < 1000""")
def json_schema_validate(spark, sf_dir):
    value = F.to_json(F.struct("lang", "source", F.col("n_chars").alias("n"), F.when(F.col("doc_id") % 7 == 0, 1).alias("extra")))
    return validate.schema_errors(_t(spark, sf_dir, "documents").select("doc_id", value.alias("value")), SCHEMA, "value", "doc_id").select("doc_id", "path", "message")


_VALUES = ['"x"', "5", "null", "true", "1.5", "[1]", "{}", '""', "5.0"]
_JSON = "CASE doc_id % 9 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(_VALUES)) + " END"
TYPES = {"type": "object", "properties": {"s": {"type": "string", "minLength": 1}, "n": {"type": "integer"}, "at": {"type": "string", "format": "date-time"}, "o": {"type": ["object", "null"]}}}


@query(f"""WITH j AS (SELECT doc_id, ('{{"s": ' || {_JSON} || ', "n": ' || {_JSON} || ', "o": ' || {_JSON} || ', "at": "' || CASE WHEN doc_id % 2 = 0 THEN '2024-01-02T03:04:05Z' ELSE '2024-01-02' END || '"}}')::JSON AS j FROM documents)
    SELECT doc_id, '$.s' AS path, 'is not of type string' AS message FROM j WHERE json_type(j, '$.s') <> 'VARCHAR' UNION ALL SELECT doc_id, '$.s', 'is shorter than 1' FROM j WHERE json_type(j, '$.s') = 'VARCHAR' AND length(j ->> '$.s') < 1
    UNION ALL SELECT doc_id, '$.n', 'is not of type integer' FROM j WHERE NOT (json_type(j, '$.n') IN ('UBIGINT', 'BIGINT') OR json_type(j, '$.n') = 'DOUBLE' AND TRY_CAST(j ->> '$.n' AS DOUBLE) = floor(TRY_CAST(j ->> '$.n' AS DOUBLE)))
    UNION ALL SELECT doc_id, '$.o', 'is not of type object, null' FROM j WHERE json_type(j, '$.o') NOT IN ('OBJECT', 'NULL')
    UNION ALL SELECT doc_id, '$.at', 'is not a date-time' FROM j WHERE NOT regexp_matches(j ->> '$.at', '^\\d{{4}}-\\d{{2}}-\\d{{2}}[Tt ]\\d{{2}}:\\d{{2}}:\\d{{2}}(\\.\\d+)?([Zz]|[+-]\\d{{2}}:\\d{{2}})$')""")
def json_schema_types(spark, sf_dir):
    v = F.expr(_JSON)
    at = F.when(F.col("doc_id") % 2 == 0, "2024-01-02T03:04:05Z").otherwise("2024-01-02")
    value = F.concat(F.lit('{"s": '), v, F.lit(', "n": '), v, F.lit(', "o": '), v, F.lit(', "at": "'), at, F.lit('"}'))
    return validate.schema_errors(_t(spark, sf_dir, "documents").select("doc_id", value.alias("value")), TYPES, "value", "doc_id").select("doc_id", "path", "message")


@query("SELECT doc_id, '$' AS path, 'is not JSON' AS message FROM documents WHERE doc_id % 4 = 0")
def malformed_json(spark, sf_dir):
    value = F.when(F.col("doc_id") % 4 == 0, '{"a": 1').otherwise('{"a": 1}')
    return validate.schema_errors(_t(spark, sf_dir, "documents").select("doc_id", value.alias("value")), {"type": "object"}, "value", "doc_id").select("doc_id", "path", "message")


@query("SELECT 'expected 7 files, found ' || count(*) AS message FROM documents HAVING count(*) <> 7")
def expected_number(spark, sf_dir):
    return validate.count_error(_t(spark, sf_dir, "documents"), 7)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_keys(spark, sf_dir):
    return validate.repeated_keys(_t(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


# --- patterns


@query(f"WITH {_GRAPH} SELECT DISTINCT a.name AS src_name FROM e JOIN n a ON e.src = a.id JOIN n b ON e.dst = b.id WHERE type = 'STUDIED_AT' AND lower(b.name) = lower((SELECT n_name FROM nation WHERE n_nationkey = 7))")
def one_hop_filter(spark, sf_dir):
    name = _t(spark, sf_dir, "nation").where("n_nationkey = 7").first()["n_name"]
    return patterns.named(*_graph(spark, sf_dir), "STUDIED_AT", "Candidate", "Institution", name.swapcase())


_HELD = _GRAPH.replace(" AS (", " AS MATERIALIZED (")


@query(f"""WITH {_HELD}, w AS MATERIALIZED (SELECT src, dst FROM e WHERE type = 'WORKED_AT'), b AS MATERIALIZED (SELECT src, dst FROM e WHERE type = 'BASED_IN')
    SELECT x.name AS a_name, y.name AS b_name, z.name AS c_name FROM w JOIN b ON w.dst = b.src JOIN n x ON w.src = x.id JOIN n y ON w.dst = y.id JOIN n z ON b.dst = z.id""")
def two_hop_chain(spark, sf_dir):
    return patterns.two_hops(*_graph(spark, sf_dir), "WORKED_AT", "BASED_IN")


def _paths(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All nodes, all edges with their ids, and the candidates."""
    nodes, edges = _graph(spark, sf_dir)
    return nodes, edges.select(F.concat("src", "type", "dst").alias("eid"), "src", "dst"), nodes.where("label = 'Candidate'").select("id")


@query(f"""WITH {_HELD}, b AS MATERIALIZED (SELECT src AS u, dst AS v FROM e UNION ALL SELECT dst, src FROM e), one AS MATERIALIZED (SELECT n.id AS start, v AS mid FROM n JOIN b ON n.id = u WHERE n.label = 'Candidate'),
    near AS MATERIALIZED (SELECT u, label, count(*) AS k FROM b JOIN n ON v = n.id GROUP BY 1, 2)
    SELECT start, 1 AS hops, label, count(*) AS trails FROM one JOIN n ON mid = n.id GROUP BY 1, 3
    UNION ALL SELECT start, 2, label, (sum(k) - count(*) FILTER (label = 'Candidate'))::BIGINT FROM one JOIN near ON mid = u GROUP BY 1, 3 HAVING sum(k) > count(*) FILTER (label = 'Candidate')""")
def var_hop_1_2(spark, sf_dir):
    """How many trails of one or two edges, of any type and in either direction, lead from each candidate to nodes of each
    label."""
    return patterns.trail_counts(*_paths(spark, sf_dir))


@query(f"""WITH {_HELD}, g AS (SELECT src || type || dst AS eid, src, dst FROM e), b AS MATERIALIZED (SELECT eid, src AS u, dst AS v FROM g UNION ALL SELECT eid, dst, src FROM g),
    one AS MATERIALIZED (SELECT n.id AS start, v AS "end", 1 AS hops, eid FROM n JOIN b ON n.id = u WHERE label = 'Candidate'),
    t AS (SELECT start, "end", hops, eid AS trail FROM one UNION ALL SELECT start, v, 2, one.eid || ',' || b.eid FROM one JOIN b ON one."end" = b.u AND one.eid <> b.eid)
    SELECT start, "end", hops, trail FROM t ORDER BY hops, start, trail LIMIT 300""")
def var_hop_first_300(spark, sf_dir):
    _, edges, candidates = _paths(spark, sf_dir)
    return patterns.first_trails(edges, candidates, 300)


@query(f"""WITH {_GRAPH} SELECT a.id AS src, a.name AS src_name, coalesce(array_to_string(list_sort(list(b.name) FILTER (b.name IS NOT NULL)), '|'), '') AS names
    FROM n a LEFT JOIN e ON e.src = a.id AND e.type = 'WORKED_AT' LEFT JOIN n b ON e.dst = b.id WHERE a.label = 'Candidate' GROUP BY 1, 2""")
def optional_collect(spark, sf_dir):
    return patterns.collected(*_graph(spark, sf_dir), "WORKED_AT", "Candidate", "Company", optional=True).withColumn("names", F.array_join("names", "|"))


@query(f"""WITH {_GRAPH} SELECT a.id AS src, a.name AS src_name, array_to_string(list_sort(list(b.name)), '|') AS names FROM e JOIN n a ON e.src = a.id JOIN n b ON e.dst = b.id WHERE type = 'HAS_SKILL' GROUP BY 1, 2 ORDER BY src_name, src""")
def collect_ordered(spark, sf_dir):
    return patterns.collected(*_graph(spark, sf_dir), "HAS_SKILL", "Candidate", "Skill").withColumn("names", F.array_join("names", "|"))


@query(f"WITH {_GRAPH} SELECT (SELECT count(DISTINCT id) FROM n) AS nodes, (SELECT count(*) FROM e) AS edges")
def graph_totals(spark, sf_dir):
    return graph.totals(*_graph(spark, sf_dir))


# --- vectors


def _topk(where: str, k: int) -> str:
    return f"""WITH q AS (SELECT vec_id AS query_id, embedding AS v FROM embeddings WHERE {where}),
    d AS (SELECT query_id, vec_id, 1 - list_dot_product(embedding::DOUBLE[], v::DOUBLE[]) / (sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_dot_product(v::DOUBLE[], v::DOUBLE[]))) AS distance FROM embeddings JOIN q ON true),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
    SELECT query_id, vec_id, rank::INT AS rank, round(distance, 6) + 0.0 AS distance FROM r WHERE rank <= {k}"""


def _search(spark: SparkSession, sf_dir: str, where: str, k: int) -> DataFrame:
    rows = _t(spark, sf_dir, "embeddings")
    queries = rows.where(where).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return vector.search(rows, queries, k, "vec_id").select("query_id", "vec_id", "rank", (F.round("distance", 6) + 0.0).alias("distance"))


@query(_topk("vec_id = 0", 5))
def vector_topk(spark, sf_dir):
    return _search(spark, sf_dir, "vec_id = 0", 5)


@query(_topk("vec_id % 20 = 0", 5))
def vector_topk_batch(spark, sf_dir):
    return _search(spark, sf_dir, "vec_id % 20 = 0", 5)


@query(None)
def vector_index_topk(spark, sf_dir):
    """The same by an index over all rows; approximate, so a test holds its recall against the exact search."""
    rows = _t(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    queries = rows.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    found = vector.centres(rows, id="vec_id")
    return vector.probe(vector.with_cells(rows, found), queries, found, 5, id="vec_id").select("query_id", "vec_id", "rank", (F.round("distance", 6) + 0.0).alias("distance"))


@query("SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN -1 ELSE label END AS label FROM embeddings UNION ALL SELECT vec_id + 1000000, -1 FROM embeddings WHERE vec_id % 5 = 0")
def vector_upsert(spark, sf_dir):
    old = _t(spark, sf_dir, "embeddings").select("vec_id", "label")
    new = old.where("vec_id % 3 = 0").union(old.where("vec_id % 5 = 0").select(F.col("vec_id") + 1_000_000, "label")).withColumn("label", F.lit(-1))
    return vector.upsert(old, new, "vec_id")


