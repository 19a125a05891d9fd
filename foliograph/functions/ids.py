"""Keys derived from values, so that the same input always gets the same key, on any executor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import canonical, json_string, strip, text_or_empty


def digest_id(prefix: str, *parts: Column, length: int) -> Column:
    """``prefix_`` and the first hex digits of the SHA-256 of the parts joined by a bar; a null part counts as empty."""
    joined = F.concat_ws("|", *[text_or_empty(p) for p in parts])
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(joined, 256), 1, length))


def candidate_id(name: Column, email: Column) -> Column:
    return digest_id("cand", F.lower(strip(text_or_empty(name))), F.lower(strip(text_or_empty(email))), length=12)


def entity_id(label: str, *parts: Column) -> Column:
    return digest_id(label.lower(), *[F.lower(strip(text_or_empty(p))) for p in parts], length=16)


def resume_id(sha256: Column) -> Column:
    return F.concat(F.lit("resume_"), F.substring(sha256, 1, 16))


def document_id(content: Column) -> Column:
    return F.concat(F.lit("doc_"), F.substring(F.sha2(content, 256), 1, 16))


def claim_id(section: Column, index: Column, field: Column, value: Column) -> Column:
    """A missing index is written as None."""
    return digest_id("claim", section, F.coalesce(index.cast("string"), F.lit("None")), field, value, length=16)


def rel_id(source: Column, kind: Column, target: Column, properties: Column, typed: bool = False) -> Column:
    """Of an edge's canonical text: sorted keys, a space after each colon and comma. The properties are a map of strings, or
    ``typed``, of Variants, whose numbers, booleans, lists and objects are written as such."""
    value = canonical if typed else lambda v: json_string(F.coalesce(v, F.lit("")))
    texts = F.transform(F.map_entries(properties), lambda e: F.struct(e["key"].alias("key"), value(e["value"]).alias("text")))
    entries = F.transform(F.array_sort(texts), lambda e: F.concat(json_string(e["key"]), F.lit(": "), e["text"]))
    text = F.concat(F.lit('{"from": '), json_string(source), F.lit(', "properties": {'), F.array_join(entries, ", "), F.lit('}, "to": '), json_string(target), F.lit(', "type": '), json_string(kind), F.lit("}"))
    return F.concat(F.lit("rel_"), F.substring(F.sha2(text, 256), 1, 20))
