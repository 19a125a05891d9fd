"""Property graphs: raw nodes and edges with ordinals, merged by key; variants, checks and totals.

Raw rows. Nodes: id, label, properties (map of strings), ordinal. Edges: src, type, dst, identity, properties, ordinal.
The ordinal is any type that sorts; it stands for the order in which the rows were written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, text

#: Relationship types with the labels they may lead from and to.
RELATIONSHIPS = {
    "HAS_RESUME": (["Candidate"], ["Resume"]),
    "HAS_SKILL": (["Candidate"], ["Skill"]),
    "WORKED_AT": (["Candidate"], ["Company"]),
    "HELD_ROLE": (["Candidate"], ["Role"]),
    "STUDIED_AT": (["Candidate"], ["Institution"]),
    "EARNED_DEGREE": (["Candidate"], ["Degree"]),
    "BUILT": (["Candidate"], ["Project"]),
    "USES": (["Project"], ["Skill"]),
    "EARNED_CERTIFICATION": (["Candidate"], ["Certification"]),
    "SPEAKS": (["Candidate"], ["Language"]),
    "HAS_IMAGE": (["Candidate"], ["Image"]),
    "HAS_PAGE": (["Resume"], ["Page"]),
    "HAS_SECTION": (["Resume"], ["Section"]),
    "HAS_BLOCK": (["Page", "Section"], ["TextBlock", "Image", "Table"]),
    "NEXT_BLOCK": (["TextBlock", "Image", "Table"], ["TextBlock", "Image", "Table"]),
    "HAS_CONTEXT": (["Image", "Table"], ["TextBlock"]),
    "EXTRACTED_FROM": (["Candidate", "Skill", "Company", "Role", "Institution", "Degree", "Project", "Certification", "Language"], ["TextBlock", "Table"]),
}
LABELS = sorted({label for ends in RELATIONSHIPS.values() for side in ends for label in side})

NO_PROPERTIES = "map<string,string>"


def merge_nodes(raw: DataFrame) -> DataFrame:
    """One row for each id: the first label; for each property the last value written. The rows are read once: a null key
    stands beside each one's properties for the node itself, and both aggregates combine before their shuffle."""
    entries = F.concat(F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value"))), F.map_entries(F.coalesce("properties", F.create_map().cast(NO_PROPERTIES))))
    each = raw.select("id", "label", "ordinal", F.inline(entries))
    last = each.groupBy("id", "key").agg(F.max_by("value", "ordinal").alias("value"), F.min_by("label", "ordinal").alias("label"), F.min("ordinal").alias("ordinal"))
    entry = F.when(F.col("key").isNotNull(), F.struct("key", "value"))
    merged = last.groupBy("id").agg(F.min_by("label", "ordinal").alias("label"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("properties"), F.min("ordinal").alias("ordinal"))
    return merged.select("id", "label", "properties", "ordinal")


def merge_edges(raw: DataFrame) -> DataFrame:
    """One row for each (src, type, dst, identity): the last one as a whole."""
    return raw.groupBy("src", "type", "dst", "identity").agg(F.max_by("properties", "ordinal").alias("properties"), F.min("ordinal").alias("ordinal"))


def upsert_nodes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merged nodes (id, label, properties) with more rows written after them: their properties win, labels stay."""
    columns = ["id", "label", "properties"]
    after = merge_nodes(new).select(*columns, F.lit(1).alias("ordinal"))
    return merge_nodes(old.select(*columns, F.lit(0).alias("ordinal")).unionByName(after)).select(*columns)


def upsert_edges(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merged edges (src, type, dst, identity, properties) with more rows written after them."""
    columns = ["src", "type", "dst", "identity", "properties"]
    after = merge_edges(new).select(*columns, F.lit(1).alias("ordinal"))
    return merge_edges(old.select(*columns, F.lit(0).alias("ordinal")).unionByName(after)).select(*columns)


def matched(rows: DataFrame, nodes: DataFrame, key: str, id: str = "id") -> DataFrame:
    """Rows whose ``key`` is the ``id`` of a node that exists already; the others are passed over, none makes a node."""
    return rows.join(nodes.select(F.col(id).alias(key)).distinct(), key, "left_semi")


def _props(**values: Column) -> Column:
    if not values:
        return F.create_map().cast(NO_PROPERTIES)
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), text.text_or_empty(v))])


def _of(item: Column, *fields: str) -> Column:
    return _props(**{f: item[f] for f in fields})


#: What a record gives: a node or an edge.
NODE = "struct<id:string,label:string,properties:map<string,string>,ordinal:struct<stem:string,step:int,pos:int,sub:int>>"
EDGE = "struct<src:string,type:string,dst:string,identity:string,properties:map<string,string>,ordinal:struct<stem:string,step:int,pos:int,sub:int>>"


class _Made:
    """Arrays of nodes and edges that a record gives, put together as one expression over it."""

    def __init__(self):
        self.nodes: list[Column] = []
        self.edges: list[Column] = []

    @staticmethod
    def ordinal(step: int, pos: Column | None = None, sub: Column | None = None) -> Column:
        return F.struct(F.col("stem").cast("string").alias("stem"), F.lit(step).alias("step"), (F.lit(0) if pos is None else pos).alias("pos"), (F.lit(0) if sub is None else sub).alias("sub"))

    @staticmethod
    def node(id: Column, label: str, properties: Column, at: Column) -> Column:
        return F.struct(id.alias("id"), F.lit(label).alias("label"), properties.alias("properties"), at.alias("ordinal")).cast(NODE)

    @staticmethod
    def edge(src: Column, kind: str, dst: Column, at: Column, properties: Column | None = None, identity: Column | None = None) -> Column:
        identity = F.lit(None).cast("string") if identity is None else identity
        properties = _props() if properties is None else properties
        return F.struct(src.alias("src"), F.lit(kind).alias("type"), dst.alias("dst"), identity.alias("identity"), properties.alias("properties"), at.alias("ordinal")).cast(EDGE)

    def each(self, items: Column, keep: Callable[[Column], Column], nodes: Callable | None = None, edges: Callable | None = None) -> None:
        """Of each item that is kept, with its place among all, the nodes and edges (lists of them)."""
        placed = F.filter(F.transform(items, lambda x, pos: F.struct(x.alias("x"), pos.alias("pos"))), lambda p: keep(p["x"]))
        for to, made in ((self.nodes, nodes), (self.edges, edges)):
            if made:
                to.append(F.flatten(F.transform(placed, lambda p: F.array(*made(p["x"], p["pos"])))))  # noqa: B023

    def rows(self, base: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Raw nodes and edges: each reads ``base`` once. A record without one of its arrays has none of that kind."""
        out = []
        for parts, kind in ((self.nodes, NODE), (self.edges, EDGE)):
            none = F.array().cast(f"array<{kind}>")
            out.append(base.select(F.inline(F.concat(*[F.coalesce(part, none) for part in parts]))))
        return out[0], out[1]


def _filled(*fields: str) -> Callable[[Column], Column]:
    def keep(x: Column) -> Column:
        out = F.lit(True)
        for f in fields:
            out = out & ~text.is_blank(x[f])
        return out

    return keep


def domain_graph(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw nodes and edges of parsed records. Names are keyed without regard to case and outer white space; a skill and
    a project's technology of one name are one node. Each of the two is one pass over the records."""
    base = records.withColumn("cand", ids.candidate_id(F.col("candidate.name"), F.col("candidate.email")))
    made, sections = _Made(), F.col("sections")
    node, edge, at = made.node, made.edge, made.ordinal
    named = lambda label, name, at: node(ids.entity_id(label, name), label, _props(name=text.strip(name)), at)
    cand, resume = F.col("cand"), ids.resume_id(F.col("source_document.source_sha256"))
    candidate_fields = ["name", "email", "phone", "location", "linkedin", "portfolio", "headline", "summary"]
    made.nodes.append(F.array(
        node(cand, "Candidate", F.map_concat(_of(F.col("candidate"), *candidate_fields), _props(candidate_id=cand)), at(0)),
        node(resume, "Resume", _of(F.col("source_document"), "source_file", "source_sha256", "ingested_at", "parser_version"), at(1)),
    ))
    made.edges.append(F.array(edge(cand, "HAS_RESUME", resume, at(1))))
    made.each(
        sections["skills"], _filled("name"),
        lambda x, pos: [named("Skill", x["name"], at(2, pos))],
        lambda x, pos: [edge(cand, "HAS_SKILL", ids.entity_id("Skill", x["name"]), at(2, pos), _props(category=x["category"]))],
    )
    made.each(
        sections["experience"], _filled("job_title"),
        lambda x, pos: [named("Role", x["job_title"], at(3, pos))],
        lambda x, pos: [edge(cand, "HELD_ROLE", ids.entity_id("Role", x["job_title"]), at(3, pos))],
    )
    job_fields = ("experience_id", "job_title", "company", "location", "start_date", "end_date", "description")
    made.each(
        sections["experience"], _filled("job_title", "company"),
        lambda x, pos: [named("Company", x["company"], at(3, pos))],
        lambda x, pos: [edge(cand, "WORKED_AT", ids.entity_id("Company", x["company"]), at(3, pos), _of(x, *job_fields), x["experience_id"])],
    )
    made.each(
        sections["education"], _filled("institution", "degree"),
        lambda x, pos: [named("Institution", x["institution"], at(4, pos)), named("Degree", x["degree"], at(4, pos))],
        lambda x, pos: [
            edge(cand, "STUDIED_AT", ids.entity_id("Institution", x["institution"]), at(4, pos), _of(x, "education_id", "graduation_year", "location"), x["education_id"]),
            edge(cand, "EARNED_DEGREE", ids.entity_id("Degree", x["degree"]), at(4, pos)),
        ],
    )
    project = lambda x: F.map_concat(_of(x, "project_id", "name", "description", "url"), _props(technologies=text.python_list(x["technologies"])))
    made.each(
        sections["projects"], _filled("name"),
        lambda x, pos: [node(x["project_id"], "Project", project(x), at(5, pos))],
        lambda x, pos: [edge(cand, "BUILT", x["project_id"], at(5, pos))],
    )
    used = F.flatten(F.transform(
        F.filter(F.transform(sections["projects"], lambda x, pos: F.struct(x.alias("x"), pos.alias("pos"))), lambda p: _filled("name")(p["x"])),
        lambda p: F.transform(F.coalesce(p["x"]["technologies"], F.array().cast("array<string>")), lambda t, sub: F.struct(p["x"]["project_id"].alias("project"), p["pos"].alias("pos"), t.alias("tech"), sub.alias("sub"))),
    ))
    made.each(
        used, _filled("tech"),
        lambda x, _: [named("Skill", x["tech"], at(5, x["pos"], x["sub"]))],
        lambda x, _: [edge(x["project"], "USES", ids.entity_id("Skill", x["tech"]), at(5, x["pos"], x["sub"]))],
    )
    certificate = lambda x: ids.entity_id("Certification", x["name"], x["issuer"])
    made.each(
        sections["certifications"], _filled("name", "issuer"),
        lambda x, pos: [node(certificate(x), "Certification", _of(x, "name", "issuer", "year"), at(6, pos))],
        lambda x, pos: [edge(cand, "EARNED_CERTIFICATION", certificate(x), at(6, pos))],
    )
    made.each(
        sections["languages"], _filled("name"),
        lambda x, pos: [named("Language", x["name"], at(7, pos))],
        lambda x, pos: [edge(cand, "SPEAKS", ids.entity_id("Language", x["name"]), at(7, pos), _props(proficiency=x["proficiency"]))],
    )
    image_fields = ("image_id", "kind", "source_page", "file_name", "relative_path", "sha256", "mime_type", "width", "height")
    made.each(
        F.col("images"), _filled(),
        lambda x, pos: [node(x["image_id"], "Image", _of(x, *image_fields), at(8, pos))],
        lambda x, pos: [edge(cand, "HAS_IMAGE", x["image_id"], at(8, pos))],
    )
    return made.rows(base)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def document_graph(documents: DataFrame, pages: DataFrame, sections: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw nodes and edges of structured documents: documents (document_id, source_file, source_sha256), pages
    (document_id, page_id, page_number, width, height, raw_text), ``layout.sections`` and ``layout.structure``; blocks may
    have image_id and context_block_ids. The ordinal continues the domain graph's."""
    ordinal = lambda step, pos: F.struct(F.col("document_id").alias("stem"), F.lit(100 + step).alias("step"), pos.cast("int").alias("pos"), F.lit(0).alias("sub")).alias("ordinal")
    none = F.lit(None).cast("string").alias("identity")
    for name, kind in (("image_id", "string"), ("context_block_ids", "array<string>"), ("file_path", "string")):
        if name not in blocks.columns:
            blocks = blocks.withColumn(name, F.lit(None).cast(kind))
    key = F.when(F.col("type") == "image", F.coalesce("image_id", "block_id")).otherwise(F.col("block_id"))
    label = F.when(F.col("type") == "image", "Image").when(F.col("type") == "table", "Table").otherwise("TextBlock")
    keyed = blocks.withColumn("node", key)
    titled = keyed.join(sections.select("section_id", F.col("title").alias("section_title")), "section_id")
    resume = ids.resume_id(F.col("source_sha256")).alias("src")
    linked = lambda df: df.join(documents.select("document_id", "source_sha256"), "document_id")
    place = F.col("page_number") * 1_000_000 + F.col("reading_order")
    bbox = F.concat(F.lit("["), F.array_join(F.transform(F.array("x0", "top", "x1", "bottom"), lambda v: v.cast("string")), ", "), F.lit("]"))
    nodes = [
        documents.select(resume.alias("id"), F.lit("Resume").alias("label"), _props(document_id=F.col("document_id"), source_file=F.col("source_file"), source_sha256=F.col("source_sha256")).alias("properties"), ordinal(0, F.lit(0))),
        pages.select(F.col("page_id").alias("id"), F.lit("Page").alias("label"), _props(**{c: F.col(c) for c in ("page_id", "page_number", "width", "height", "raw_text")}).alias("properties"), ordinal(1, F.col("page_number"))),
        sections.select(F.col("section_id").alias("id"), F.lit("Section").alias("label"), _props(**{c: F.col(c) for c in ("section_id", "title", "normalized_type", "start_page", "document_id")}).alias("properties"), ordinal(2, F.col("start_page"))),
        titled.select(F.col("node").alias("id"), label.alias("label"), F.map_concat(_props(**{c: F.col(c) for c in ("block_id", "page_id", "page_number", "section_id", "section_title", "type", "text", "reading_order", "document_id")}), _props(bbox=bbox, context_block_ids=text.python_list(F.coalesce("context_block_ids", F.array().cast("array<string>"))))).alias("properties"), ordinal(3, place)),
    ]
    follow = keyed.withColumn("page_block", place)
    from .layout import next_blocks

    edges = [
        linked(pages).select(resume, F.lit("HAS_PAGE").alias("type"), F.col("page_id").alias("dst"), none, _props().alias("properties"), ordinal(1, F.col("page_number"))),
        linked(sections).select(resume, F.lit("HAS_SECTION").alias("type"), F.col("section_id").alias("dst"), none, _props().alias("properties"), ordinal(2, F.col("start_page"))),
        keyed.select(F.col("page_id").alias("src"), F.lit("HAS_BLOCK").alias("type"), F.col("node").alias("dst"), none, _props().alias("properties"), ordinal(3, place)),
        keyed.select(F.col("section_id").alias("src"), F.lit("HAS_BLOCK").alias("type"), F.col("node").alias("dst"), none, _props().alias("properties"), ordinal(3, place)),
        next_blocks(follow, ["document_id"], ["page_block"], "node").select("src", F.lit("NEXT_BLOCK").alias("type"), "dst", none, _props().alias("properties"), ordinal(4, F.lit(0))),
        keyed.where(F.col("type").isin("image", "table")).select("document_id", F.col("node").alias("src"), F.explode("context_block_ids").alias("block_id"))
        .join(keyed.select("block_id", F.col("node").alias("dst")), "block_id").select("src", F.lit("HAS_CONTEXT").alias("type"), "dst", none, _props().alias("properties"), ordinal(5, F.lit(0))),
    ]
    return _union(nodes), _union(edges)


def provenance_edges(grounded: DataFrame, candidates: DataFrame, nodes: DataFrame, typed: bool = False) -> DataFrame:
    """EXTRACTED_FROM edges of grounded claims, both ends of which are among ``nodes``. Candidates: stem, cand. The
    claim's node is its document's candidate, a given node, or the entity with the claim's label and key. The properties are
    strings or, ``typed``, Variants, with page and score as numbers; a list's value is its JSON text."""
    key = F.concat_ws("|", F.transform("ref_key", lambda k: F.lower(text.strip(text.text_or_empty(k)))))
    entity = F.concat(F.lower("ref_label"), F.lit("_"), F.substring(F.sha2(key, 256), 1, 16))
    sourced = grounded.where("grounded").join(candidates, "stem", "left").withColumn("src", F.when(F.col("ref_label") == "Candidate", F.col("cand")).when(F.col("ref_node") != "", F.col("ref_node")).otherwise(entity))
    known = nodes.select("id").distinct()
    # sources last: what is made distinct by source later needs no further shuffle
    kept = sourced.join(known.withColumnRenamed("id", "block_id"), "block_id", "left_semi").join(known.withColumnRenamed("id", "src"), "src", "left_semi")
    values = {c: F.col(c) for c in ("claim_id", "field", "page_number", "match_type")} | {"value": F.coalesce(text.python_list(F.col("items")), F.col("value")), "score": F.round("score", 3)}
    properties = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v.cast("variant"))]) if typed else _props(**values)
    return kept.select("src", F.lit("EXTRACTED_FROM").alias("type"), F.col("block_id").alias("dst"), F.col("claim_id").alias("identity"), properties.alias("properties"))


def natural_graph(records: DataFrame, compact: bool = False, guards: bool = True) -> tuple[DataFrame, DataFrame]:
    """Graphs keyed by the names as they are written. ``compact``: the presentation graph, with candidates keyed by name,
    jobs as nodes of their own, technologies apart from skills. ``guards``: items with blank keys are left out (a direct
    load keeps them). Each of the two is one pass over the records."""

    def keyed(label: str, *parts: Column) -> Column:
        return F.concat_ws("|", F.lit(label), *[text.text_or_empty(p) for p in parts])

    who = keyed("Candidate", F.col("candidate.name")) if compact else ids.candidate_id(F.col("candidate.name"), F.col("candidate.email"))
    base = records.withColumn("cand", who)
    if compact:
        base = base.where(~text.is_blank(F.col("candidate.name")))
    made, sections, cand = _Made(), F.col("sections"), F.col("cand")
    filled = _filled if guards else lambda *_: _filled()

    def node(label: str, key: Column, pos: Column | None = None) -> Column:
        return made.node(key, label, _props(key=key), made.ordinal(0, pos))

    def edge(src: Column, kind: str, dst: Column, pos: Column, identity: Column | None = None) -> Column:
        return made.edge(src, kind, dst, made.ordinal(0, pos), None, identity)

    def add(section: str, keep: Callable[[Column], Column], *what: tuple) -> None:
        """Of each item: label, key, type of the edge to it, and where wanted the edge's source and identity."""

        def nodes(x: Column, pos: Column) -> list[Column]:
            return [node(label, key(x), pos) for label, key, *_ in what]

        def edges(x: Column, pos: Column) -> list[Column]:
            return [edge(src(x) if src else cand, kind, key(x), pos, identity(x) if identity else None) for _, key, kind, src, identity in ((*w, None, None)[:5] for w in what)]

        made.each(sections[section], keep, nodes, edges)

    made.nodes.append(F.array(node("Candidate", cand)))
    add("skills", filled("name"), ("Skill", lambda x: keyed("Skill", x["name"]), "HAS_SKILL"))
    company = lambda x: keyed("Company", x["company"])
    if compact:
        job = lambda x: keyed("Experience", x["job_title"], x["company"], x["start_date"], x["end_date"])
        add("experience", filled("job_title", "company"), ("Experience", job, "HAS_EXPERIENCE"), ("Company", company, "AT_COMPANY", job))
    else:
        add("experience", filled("job_title", "company"), ("Role", lambda x: keyed("Role", x["job_title"]), "HELD_ROLE"), ("Company", company, "WORKED_AT", None, lambda x: x["experience_id"]))
    institution = lambda x: keyed("Institution", x["institution"])
    if compact:
        add("education", filled("institution"), ("Institution", institution, "STUDIED_AT"))
    else:
        add("education", filled("institution", "degree"), ("Institution", institution, "STUDIED_AT", None, lambda x: x["education_id"]), ("Degree", lambda x: keyed("Degree", x["degree"]), "EARNED_DEGREE"))
    project = lambda x: keyed("Project", x["name"]) if compact else x["project_id"]
    add("projects", filled("name"), ("Project", project, "WORKED_ON" if compact else "BUILT"))
    kind = "Technology" if compact else "Skill"
    used = F.flatten(F.transform(
        F.filter(F.transform(sections["projects"], lambda x, pos: F.struct(x.alias("x"), pos.alias("pos"))), lambda p: filled("name")(p["x"])),
        lambda p: F.transform(F.coalesce(p["x"]["technologies"], F.array().cast("array<string>")), lambda t: F.struct(project(p["x"]).alias("project"), p["pos"].alias("pos"), t.alias("tech"))),
    ))
    made.each(used, _filled("tech"), lambda x, _: [node(kind, keyed(kind, x["tech"]), x["pos"])], lambda x, _: [edge(x["project"], "USES", keyed(kind, x["tech"]), x["pos"])])
    certificate = ("Certification", lambda x: keyed("Certification", x["name"], x["issuer"]), "HAS_CERTIFICATION" if compact else "EARNED_CERTIFICATION")
    add("certifications", filled("name") if compact else filled("name", "issuer"), certificate)
    if not compact:
        add("languages", filled("name"), ("Language", lambda x: keyed("Language", x["name"]), "SPEAKS"))
    return made.rows(base)


def definitions(spark, relationships: dict[str, tuple[list[str], list[str]]] | None = None) -> DataFrame:
    """(type, from_label, to_label): a few hundred rows, so joins with it are broadcast."""
    found = relationships or RELATIONSHIPS
    return spark.createDataFrame([(t, a, b) for t, (left, right) in found.items() for a in left for b in right], "type string, from_label string, to_label string")


def schema_errors(nodes: DataFrame, edges: DataFrame, relationships: dict[str, tuple[list[str], list[str]]] | None = None) -> DataFrame:
    """(kind, subject, detail): nodes with unknown labels; edges (src, type, dst, ordinal) of unknown type, without one of
    their nodes, or between labels that the type doesn't allow."""
    found = relationships or RELATIONSHIPS
    labels = sorted({label for ends in found.values() for side in ends for label in side})
    allowed = definitions(nodes.sparkSession, found).withColumn("allowed", F.lit(True))
    unknown = nodes.where(~F.col("label").isin(labels)).select(F.lit("unknown label").alias("kind"), F.col("id").alias("subject"), F.col("label").alias("detail"))
    ends = nodes.select(F.col("id"), F.col("label"))
    met = (
        edges.join(ends.select(F.col("id").alias("src"), F.col("label").alias("from_label")), "src", "left")
        .join(ends.select(F.col("id").alias("dst"), F.col("label").alias("to_label")), "dst", "left")
        .join(F.broadcast(allowed), ["type", "from_label", "to_label"], "left")
    )
    reason = (
        F.when(~F.col("type").isin(list(found)), "unknown type")
        .when(F.col("from_label").isNull() | F.col("to_label").isNull(), "missing node")
        .when(F.col("allowed").isNull(), "invalid labels")
    )
    wrong = met.withColumn("kind", reason).where("kind is not null")
    return unknown.unionByName(wrong.select("kind", F.col("ordinal").cast("string").alias("subject"), F.col("type").alias("detail")))


def resolved(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges both ends of which exist."""
    known = nodes.select("id")
    return edges.join(known.withColumnRenamed("id", "src"), "src", "left_semi").join(known.withColumnRenamed("id", "dst"), "dst", "left_semi")


def totals(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct nodes and edges."""
    return nodes.agg(F.count_distinct("id").alias("nodes")).crossJoin(edges.agg(F.count("*").alias("edges")))
