"""Validation: a small JSON Schema compiler whose rules are one expression over a parsed text, structural checks, gates."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Formats that strings are checked for.
FORMATS = {"date-time": r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"}


def _is(value: Column, kind: str) -> Column:
    """Whether a Variant, not null itself, is of a JSON type."""
    of = F.schema_of_variant(value)
    number = F.rlike(of, F.lit("^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE)"))
    double = F.try_variant_get(value, "$", "double")
    return {
        "object": F.startswith(of, F.lit("OBJECT")),
        "array": F.startswith(of, F.lit("ARRAY")),
        "string": of == "STRING",
        "boolean": of == "BOOLEAN",
        "null": of == "VOID",
        "number": number,
        "integer": number & (double == F.floor(double)),  # 5.0 is one, too
    }[kind]


def _same(value: Column, wanted) -> Column:
    """Whether a Variant equals a JSON value: objects whatever the order of their keys, numbers by what they are worth."""
    if isinstance(wanted, dict):
        keys = F.json_object_keys(F.to_json(value))
        own = F.size(keys) == len(wanted)
        parts = [_same(F.try_variant_get(value, f"$['{k}']", "variant"), v) for k, v in wanted.items()]
        test, kind = [own, *parts], "object"
    elif isinstance(wanted, list):
        items = F.try_variant_get(value, "$", "array<variant>")
        test, kind = [F.size(items) == len(wanted), *(_same(F.get(items, F.lit(i)), v) for i, v in enumerate(wanted))], "array"
    elif wanted is None:
        test, kind = [], "null"
    elif isinstance(wanted, bool):
        test, kind = [F.try_variant_get(value, "$", "boolean") == wanted], "boolean"
    elif isinstance(wanted, str):
        test, kind = [F.try_variant_get(value, "$", "string") == wanted], "string"
    else:
        test, kind = [F.try_variant_get(value, "$", "double") == float(wanted)], "number"
    fits = _is(value, kind)
    for part in test:
        fits = F.when(fits, part).otherwise(False)
    return F.coalesce(fits, F.lit(False))


#: An error: where (the names and indexes that lead there; a number has its digits filled up, so that they sort) and what.
ERROR = "struct<at:array<string>,message:string>"


def errors_of(schema: dict, value: Column, at: Column, definitions: dict) -> Column:
    """All errors of ``value`` (a Variant; null: not there) as an array of ``ERROR``, those of one place in the order of the
    schema's keywords. Each rule of the schema stands in it once; an array's items are told apart by their index."""
    if "$ref" in schema:
        schema = definitions[schema["$ref"].rsplit("/", 1)[-1]]
    here: list[Column] = []
    deeper: list[Column] = []
    keys = F.when(_is(value, "object"), F.json_object_keys(F.to_json(value)))
    items = F.when(_is(value, "array"), F.try_variant_get(value, "$", "array<variant>"))
    text = F.when(_is(value, "string"), F.try_variant_get(value, "$", "string"))
    number = F.when(_is(value, "number"), F.try_variant_get(value, "$", "double"))

    def error(bad: Column, message: str) -> None:
        here.append(F.when(bad, F.struct(at.alias("at"), F.lit(message).alias("message"))))

    for keyword, rule in schema.items():
        if keyword == "type":
            kinds = rule if isinstance(rule, list) else [rule]
            fits = F.lit(False)
            for kind in kinds:
                fits = fits | _is(value, kind)
            error(~fits, f"is not of type {', '.join(kinds)}")
        elif keyword == "required":
            for name in rule:
                error(~F.array_contains(F.coalesce(keys, F.when(keys.isNotNull(), F.array().cast("array<string>"))), name), f"'{name}' is a required property")
        elif keyword == "additionalProperties" and rule is False:
            allowed = F.array(*[F.lit(k) for k in schema.get("properties", {})]).cast("array<string>")
            error(F.size(F.array_except(keys, allowed)) > 0, "additional properties are not allowed")
        elif keyword == "properties":
            for name, inner in rule.items():
                deeper.append(errors_of(inner, F.try_variant_get(value, f"$['{name}']", "variant"), F.concat(at, F.array(F.lit(name))), definitions))
        elif keyword == "items":
            index = lambda i: F.array(F.concat(F.lit("#"), F.lpad(i.cast("string"), 10, "0")))
            found = F.transform(items, lambda x, i: errors_of(rule, x, F.concat(at, index(i)), definitions))  # noqa: B023
            deeper.append(F.coalesce(F.flatten(found), F.array().cast(f"array<{ERROR}>")))
        elif keyword == "minItems":
            error(F.size(items) < rule, f"violates minItems {rule}")
        elif keyword == "maxItems":
            error(F.size(items) > rule, f"violates maxItems {rule}")
        elif keyword == "minLength":
            error(F.length(text) < rule, f"is shorter than {rule}")
        elif keyword == "pattern":
            error(~F.rlike(text, F.lit(rule)), f"does not match {rule}")
        elif keyword == "format" and rule in FORMATS:
            error(~F.rlike(text, F.lit(FORMATS[rule])), f"is not a {rule}")
        elif keyword == "minimum":
            error(number < rule, f"is less than the minimum of {rule}")
        elif keyword == "enum":
            fits = F.lit(False)
            for wanted in rule:
                fits = fits | _same(value, wanted)
            error(~fits, "is not one of the allowed values")
        elif keyword == "const":
            error(~_same(value, rule), f"is not {rule}")
    own = F.filter(F.array(*here), lambda e: e.isNotNull()) if here else F.array()
    return F.when(value.isNotNull(), F.concat(*[part.cast(f"array<{ERROR}>") for part in (own, *deeper)])).otherwise(F.array().cast(f"array<{ERROR}>"))


def _path(at: Column, root: str, name: str, item: tuple[str, str]) -> Column:
    """A place as text: names after ``name``, indexes between the two of ``item``."""
    index = lambda p: F.regexp_replace(p, "^#0*(?=\\d)", "")
    part = lambda p: F.when(p.startswith("#"), F.concat(F.lit(item[0]), index(p), F.lit(item[1]))).otherwise(F.concat(F.lit(name), p))
    return F.concat(F.lit(root), F.array_join(F.transform(at, part), ""))


def schema_errors(rows: DataFrame, schema: dict, column: str = "value", key: str = "file") -> DataFrame:
    """(key, path, message, at, rank) for each violated rule, one row for text that isn't JSON; the text is parsed once. ``path``
    is like ``$.a[1].x``, ``at`` like ``a.1.x`` (``root`` for the whole), and ``rank`` numbers a text's errors from 1 as they are
    printed: by place, items by their index, and of one place in the order of the schema's keywords.

    Supported: type (one or a list), required, additionalProperties false, properties, items, minLength, pattern, format, enum,
    const, minimum, minItems, maxItems, $ref to ``$defs``. A null text isn't JSON; nor is one that repeats a key, unless the
    session sets ``spark.sql.variant.allowDuplicateKeys``. A property's name must not begin with ``#``."""
    parsed = rows.select(F.col(key).alias("key"), F.try_parse_json(F.col(column)).alias("value"))
    nowhere = F.array().cast("array<string>")
    broken = F.array(F.struct(nowhere.alias("at"), F.lit("is not JSON").alias("message"))).cast(f"array<{ERROR}>")
    found = F.when(F.col("value").isNull(), broken).otherwise(errors_of(schema, F.col("value"), nowhere, schema.get("$defs", {})))
    # places are compared first, then the errors' own order
    ranked = F.array_sort(F.transform(found, lambda e, i: F.struct(e["at"].alias("at"), i.alias("i"), e["message"].alias("message"))))
    each = parsed.select("key", F.posexplode(ranked).alias("rank", "e"))
    dotted = F.regexp_replace(_path(F.col("e.at"), "", ".", (".", "")), r"^\.", "")
    return each.select(F.col("key").alias(key), _path(F.col("e.at"), "$", ".", ("[", "]")).alias("path"), F.col("e.message").alias("message"), F.when(dotted == "", "root").otherwise(dotted).alias("at"), (F.col("rank") + 1).alias("rank"))


def in_order(errors: DataFrame, key: str = "file") -> DataFrame:
    """Errors as they are printed."""
    return errors.orderBy(key, "rank")


def repeated_sources(rows: DataFrame, digest: str, order: str) -> DataFrame:
    """Rows whose source digest was seen before, in ``order``; a null digest counts as a value. The first row of each
    digest is found by an aggregate that combines before the shuffle, so a source with many rows doesn't fill one task."""
    first = rows.groupBy(digest).agg(F.min(order).alias("__first"))
    return rows.alias("r").join(first.alias("f"), F.col(f"r.{digest}").eqNullSafe(F.col(f"f.{digest}"))).where(F.col(order) > F.col("__first")).select("r.*")


def repeated_keys(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def count_error(rows: DataFrame, expected: int) -> DataFrame:
    """One row with a message unless there are exactly ``expected`` rows."""
    return rows.agg(F.count("*").alias("n")).where(F.col("n") != expected).select(F.concat(F.lit(f"expected {expected} files, found "), F.col("n").cast("string")).alias("message"))


def structural_errors(documents: DataFrame, pages: DataFrame, sections: DataFrame, blocks: DataFrame) -> DataFrame:
    """(document_id, kind, subject): page counts that differ, repeated block ids, blocks without their page or section,
    boxes turned inside out, context ids that no block has."""

    def found(df: DataFrame, kind: str, subject: Column) -> DataFrame:
        return df.select("document_id", F.lit(kind).alias("kind"), subject.cast("string").alias("subject"))

    counted = documents.join(pages.groupBy("document_id").agg(F.count("*").alias("n")), "document_id", "left").where(F.coalesce("n", F.lit(0)) != F.col("page_count"))
    out = [
        found(counted, "page_count", F.col("page_count")),
        found(repeated_keys(blocks, "document_id", "block_id"), "repeated block", F.col("block_id")),
        found(blocks.join(pages.select("document_id", "page_id").distinct(), ["document_id", "page_id"], "left_anti"), "missing page", F.col("block_id")),
        found(blocks.join(sections.select("document_id", "section_id").distinct(), ["document_id", "section_id"], "left_anti"), "missing section", F.col("block_id")),
        found(blocks.where((F.col("x1") < F.col("x0")) | (F.col("bottom") < F.col("top"))), "invalid box", F.col("block_id")),
    ]
    if "context_block_ids" in blocks.columns:
        used = blocks.select("document_id", F.explode("context_block_ids").alias("context"))
        known = blocks.select("document_id", F.col("block_id").alias("context")).distinct()
        out.append(found(used.join(known, ["document_id", "context"], "left_anti"), "missing context", F.col("context")))
    errors = out[0]
    for part in out[1:]:
        errors = errors.union(part)
    return errors


def gate(errors: DataFrame) -> None:
    """Raise, with the first errors, unless ``errors`` is empty."""
    if rows := errors.take(20):
        raise ValueError("validation failed: " + "; ".join(str(tuple(r)) for r in rows))

