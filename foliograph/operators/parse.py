"""Marked text to domain records: one row per document, nested structs, no Python in the plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, text
from ..sources import readers

PARSER_VERSION = "foliograph-text-1"
CANDIDATE_FIELDS = {"email": "Email", "phone": "Phone", "location": "Location", "linkedin": "LinkedIn", "portfolio": "Portfolio", "headline": "Headline"}
#: Item fields by section, in the order of a row's cells.
CELLS = {
    "experience": ["job_title", "company", "location", "start_date", "end_date", "description"],
    "education": ["degree", "institution", "location", "graduation_year"],
    "projects": ["name", "technologies", "description", "url"],
    "certifications": ["name", "issuer", "year"],
}
NUMBERED = {"experience": ("experience_id", "exp"), "education": ("education_id", "edu"), "projects": ("project_id", "proj")}


def _items(body: Column, section: str, candidate: Column) -> Column:
    fields = CELLS[section]

    def build(cells: Column, i: Column) -> Column:
        values = {f: text.item(cells, k) for k, f in enumerate(fields)}
        if section == "experience":  # further cells belong to the description
            values["description"] = F.array_join(F.slice(cells, 6, F.greatest(F.size(cells) - 5, F.lit(0))), " | ")
        if section == "projects":
            values["technologies"] = text.compact(F.split(values["technologies"], ","))
        own = []
        if section in NUMBERED:
            name, short = NUMBERED[section]
            own = [F.concat(candidate, F.lit(f"_{short}_"), (i + 1).cast("string")).alias(name)]
        return F.struct(*own, *[v.alias(f) for f, v in values.items()])

    return F.transform(text.pipe_rows(body), build)


def parse(docs: DataFrame, column: str = "text", source_file: str = "source_file") -> DataFrame:
    """Domain records: ``candidate``, ``sections``, ``source_document``, ``images``; and ``stem``, the name of the file
    without its suffix, by which records, documents and claims of one source are joined."""
    body = F.col(column)
    base = docs.withColumn("__header", text.header_of(body))
    header = F.col("__header")
    candidate = {"name": text.name_from_header(header)} | {f: text.header_value(header, label) for f, label in CANDIDATE_FIELDS.items()}
    candidate["summary"] = text.strip(F.regexp_replace(text.section(body, "SUMMARY"), "\n", " "))
    base = base.withColumn("candidate", F.struct(*[v.alias(f) for f, v in candidate.items()]))
    key = ids.candidate_id(F.col("candidate.name"), F.col("candidate.email"))
    sections = [text.pairs(text.section(body, "SKILLS"), "category").alias("skills")]
    sections += [_items(text.section(body, s.upper()), s, key).alias(s) for s in ("experience", "education", "projects", "certifications")]
    sections += [text.pairs(text.section(body, "LANGUAGES"), "proficiency").alias("languages")]
    source = F.struct(
        F.col(source_file).alias("source_file"), F.sha2(body, 256).alias("source_sha256"), F.current_timestamp().cast("string").alias("ingested_at"), F.lit(PARSER_VERSION).alias("parser_version")
    )
    images = F.lit(None).cast(
        "array<struct<image_id:string,kind:string,source_page:int,file_name:string,relative_path:string,sha256:string,mime_type:string,width:int,height:int>>"
    )
    return base.select(
        F.regexp_replace(F.col(source_file), r"\.[^.]*$", "").alias("stem"), "candidate", F.struct(*sections).alias("sections"), source.alias("source_document"), F.coalesce(images, F.array()).alias("images")
    )


def check_suffix(files: DataFrame, path: str = "source_file") -> DataFrame:
    """Only .txt and .md are text records; any other row stops the query."""
    good = F.lower(F.regexp_extract(path, r"(\.[^.]*)$", 1)).isin(".txt", ".md")
    return files.where(F.when(good, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("unsupported input format: "), F.col(path)))))


#: Fields of which one at least must have a value.
IDENTIFYING = {"experience": ["job_title", "company"], "education": ["degree", "institution"]}


def overlay(base: Column, other: Column, fields: list[str]) -> Column:
    """``base`` with the trimmed values of ``other`` where these aren't null."""
    return F.struct(*[F.coalesce(text.strip(other[f]), base[f]).alias(f) for f in fields])


def with_defaults(raw: Column, schema: str, defaults: dict[str, str]) -> Column:
    """JSON text of an object as a struct: missing fields get their defaults; null if it isn't an object."""
    parsed = F.from_json(raw, schema)
    return F.when(parsed.isNotNull(), F.struct(*[F.coalesce(parsed[f], F.lit(d)).alias(f) for f, d in defaults.items()]))


def fan_out_skills(names: Column) -> Column:
    """One name for each part between commas, semicolons and bars."""
    return text.compact(F.split(F.translate(names, ";|", ",,"), ","))


def identified(items: Column, section: str) -> Column:
    """Items with a value in one of their identifying fields."""
    fields = IDENTIFYING.get(section, ["name"])

    def known(x: Column) -> Column:
        tests = [~text.is_blank(x[f]) for f in fields]
        return tests[0] if len(tests) == 1 else tests[0] | tests[1]

    return F.filter(items, known)


def technologies(raw: Column) -> Column:
    """A list of names from JSON text of one, or from names between commas."""
    return text.compact(F.coalesce(F.from_json(raw, "array<string>"), F.split(raw, ",")))


#: Item fields by section, without the numbered ids.
FIELDS = CELLS | {"skills": ["name", "category"], "languages": ["name", "proficiency"]}


def refined(records: DataFrame, raw: Column, version: str) -> DataFrame:
    """Parsed records with what a model extracted (JSON text with ``candidate`` and ``sections``) laid over them. Only strings
    replace a candidate's fields, only lists a section; missing and null fields get their defaults, items that aren't objects
    or lack an identifying field go, and what is left is numbered anew for the candidate as it is now."""
    base = records.withColumn("__m", F.try_parse_json(raw))
    names = [f.name for f in records.schema["candidate"].dataType.fields]
    values = {f: F.try_variant_get(F.col("__m"), f"$.candidate.{f}", "variant") for f in names}
    told = F.struct(*[F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).alias(f) for f, v in values.items()])
    base = base.withColumn("__told", told).withColumn("candidate", overlay(F.col("candidate"), F.col("__told"), names))
    base = base.withColumn("candidate", F.col("candidate").withField("email", text.without_mailto(F.col("candidate.email"))))
    key = ids.candidate_id(F.col("candidate.name"), F.col("candidate.email"))

    def found(section: str) -> Column:
        fields = FIELDS[section]
        listed = F.try_variant_get(F.col("__m"), f"$.sections.{section}", "array<variant>")
        items = F.transform(listed, lambda x: with_defaults(F.to_json(x), ", ".join(f"{f} string" for f in fields), dict.fromkeys(fields, "")))
        if section == "skills":
            return F.flatten(F.transform(items, lambda x: F.transform(fan_out_skills(x["name"]), lambda n: F.struct(n.alias("name"), x["category"].alias("category")))))
        if section == "projects":
            items = F.transform(items, lambda x: x.withField("technologies", technologies(x["technologies"])))
        return identified(items, section)

    def numbered(items: Column, section: str) -> Column:
        if section not in NUMBERED:
            return items
        id, short = NUMBERED[section]
        return F.transform(items, lambda x, i: F.struct(F.concat(key, F.lit(f"_{short}_"), (i + 1).cast("string")).alias(id), *[x[f].alias(f) for f in FIELDS[section]]))

    def kept(section: str) -> Column:
        own = F.transform(F.col("sections")[section], lambda x: F.struct(*[x[f].alias(f) for f in FIELDS[section]]))
        return numbered(F.coalesce(found(section), own), section).alias(section)

    sections = [kept(f.name) for f in records.schema["sections"].dataType.fields]
    source = F.col("source_document").withField("parser_version", F.lit(version))
    return base.withColumn("sections", F.struct(*sections)).withColumn("source_document", source).select(*records.columns)


def ingest(files: DataFrame, parser: str = "deterministic", model: Callable[[str], str] | None = None, probe: Callable[[], object] | None = None, version: str = "model") -> DataFrame:
    """Records of files (source_file, text). ``parser``: ``deterministic``, ``model``, or ``auto``, which takes the model if
    ``probe`` answers. Without the model, other files than .md and .txt stop the query."""
    if parser not in ("deterministic", "model", "auto"):
        raise ValueError(f"unknown parser: {parser}")
    if parser == "deterministic" or parser == "auto" and not (model and probe and readers.available(probe)):
        return parse(check_suffix(files))
    if model is None:
        raise ValueError("no model is given")
    met = parse(files).join(readers.extracted(files, model).withColumnRenamed("source_file", "__file"), F.col("source_document.source_file") == F.col("__file"))
    return refined(met.drop("__file"), F.col("raw"), version).drop("raw")
