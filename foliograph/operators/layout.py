"""Page layout: words to lines, lines and assets to blocks in reading order, sections, context and captions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text

#: Headings that are known by their text.
KNOWN_HEADINGS = [
    "achievements", "awards", "career objective", "certificates", "certifications", "degrees", "education", "employment", "experience",
    "fellowships & prizes", "grants & awards", "internships", "languages", "leadership", "objective", "open source", "personal details",
    "professional experience", "profile", "projects", "publications", "research experience", "research interests", "science communication",
    "secondary education", "selected publications", "service", "skills", "societies", "summary", "teaching experience", "technical skills",
    "tertiary education", "trainings given", "work experience",
]
LINE_GAP, CONTEXT_BLOCKS, CAPTION_GAP, DEFAULT_SIZE = 3, 3, 70, 10.0


def heading_type(line: Column, bold: Column, size: Column, body_size: Column) -> Column:
    """The section type that a line opens, or null: known headings, then short lines in capitals, then short bold lines
    in a larger size."""
    core = F.rtrim(text.strip(line), F.lit(":"))
    known = F.regexp_replace(F.lower(core), r"\s+", " ")
    # a line of hundreds of words is told by its first few, before anything is counted in it
    words = F.size(F.filter(F.split(core, r"\s+", 10), lambda w: w != ""))
    capitals = F.coalesce(text.uppercase_ratio(core), F.lit(0.0)) >= 0.85
    short = F.when(words.between(1, 7) & (bold | (size >= body_size)) & capitals | words.between(1, 6) & bold & (size >= body_size + 1.5), text.slug(core))
    return F.when((words <= max(len(k.split()) for k in KNOWN_HEADINGS)) & known.isin(KNOWN_HEADINGS), text.slug(known)).otherwise(short)


def page_size(words: DataFrame) -> DataFrame:
    """Median font size of each page."""
    return words.groupBy("document_id", "page_number").agg(F.coalesce(F.median(F.nullif("size", F.lit(0.0))), F.lit(DEFAULT_SIZE)).alias("body_size"))


def numbered_lines(words: DataFrame, place: list[str], gap: float = LINE_GAP) -> DataFrame:
    """``words`` with the number of their line, from 1 on each page: a word opens a line when its top is over ``gap`` from the
    top of the line's first word. That is a fold over a page in the order of ``place``, so the sorted rows of a partition are
    scanned once, with the page, the line and its top as all that is kept."""
    schema = T.StructType([*words.schema.fields, T.StructField("line", T.IntegerType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, anchor, line = None, None, 0
        for batch in batches:
            numbers = []
            for *key, top in zip(*[batch.column(c).to_pylist() for c in ("document_id", "page_number", "top")]):
                if key != page:
                    page, anchor, line = key, None, 0
                if anchor is None or (top is not None and abs(top - anchor) > gap):
                    anchor, line = top, line + 1
                numbers.append(line)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int32())], names=[*batch.schema.names, "line"])

    page = ["document_id", "page_number"]
    return words.repartition(*page).sortWithinPartitions(*page, *place).mapInArrow(scan, schema)


def lines(words: DataFrame) -> DataFrame:
    """Lines of a page's words (document_id, page_number, text, x0, top, x1, bottom, size, fontname), the words of a line from
    left to right."""
    own = words.select("document_id", "page_number", F.round("top", 1).alias("row"), "x0", "top", "x1", "bottom", "size", "fontname", "text")
    sized = own.withColumn("body_size", F.coalesce(F.median(F.nullif("size", F.lit(0.0))).over(Window.partitionBy("document_id", "page_number")), F.lit(DEFAULT_SIZE)))
    each = numbered_lines(sized, ["row", "x0", "top", "x1", "bottom", "size", "fontname", "text"])
    out = each.groupBy("document_id", "page_number", "line").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "row", "text"))), lambda x: x.text), " ").alias("text"),
        F.round(F.min("x0"), 2).alias("x0"),
        F.round(F.min("top"), 2).alias("top"),
        F.round(F.max("x1"), 2).alias("x1"),
        F.round(F.max("bottom"), 2).alias("bottom"),
        F.round(F.max(F.coalesce(F.nullif("size", F.lit(0.0)), "body_size")), 2).alias("font_size"),
        F.array_sort(F.collect_set(F.coalesce("fontname", F.lit("")))).alias("font_names"),
        F.bool_or(F.contains(F.lower(F.coalesce("fontname", F.lit(""))), F.lit("bold"))).alias("bold"),
        F.first("body_size").alias("body_size"),
    )
    return out.withColumn("text", text.clean_cids(text.strip(F.col("text")))).where("text != ''")


def table_text(rows: Column) -> Column:
    """A table's rows as lines, its cells between bars; null if all cells are blank."""
    cleaned = F.transform(rows, lambda r: F.transform(r, lambda c: F.coalesce(c, F.lit(""))))
    filled = F.exists(cleaned, lambda r: F.exists(r, lambda c: text.strip(c) != ""))
    return F.when(filled, F.array_join(F.transform(cleaned, lambda r: F.array_join(r, " | ")), "\n"))


def in_reading_order(items: DataFrame, page: list[str], top: str = "top", x0: str = "x0", kind: str = "type", position: str = "position") -> DataFrame:
    """``items`` numbered from 1 on each page: from top to bottom, left to right, images first."""
    order = Window.partitionBy(*page).orderBy(top, x0, F.col(kind) != "image", position)
    return items.withColumn("reading_order", F.row_number().over(order))


def with_sections(blocks: DataFrame, document: list[str], order: list[str], opens: Column) -> DataFrame:
    """``section_number``, carried forward over the whole document; blocks before the first heading are a section."""
    whole = Window.partitionBy(*document).orderBy(*order)
    running = F.sum(opens.cast("int")).over(whole.rowsBetween(Window.unboundedPreceding, 0))
    headless = F.first(~opens).over(whole.rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    return blocks.withColumn("section_number", (running + headless).cast("int"))


def sections(blocks: DataFrame) -> DataFrame:
    """One row for each section of ``structure``'s blocks."""
    first = F.struct("page_number", "reading_order")
    return blocks.groupBy("document_id", "section_id").agg(
        F.min_by(F.when(F.col("type") == "heading", F.col("text")).otherwise("Document header"), first).alias("title"),
        F.min_by(F.coalesce("heading_type", F.lit("header")), first).alias("normalized_type"),
        F.min("page_number").alias("start_page"),
        F.transform(F.array_sort(F.collect_list(F.struct("page_number", "reading_order", "block_id"))), lambda x: x.block_id).alias("block_ids"),
    )


def structure(items: DataFrame) -> DataFrame:
    """Blocks of ``items`` (document_id, page_number, type, text, x0, top, x1, bottom, font_size, bold, body_size,
    position; type text, image or table) with ids, reading order and section."""
    kind = F.when(F.col("type") == "text", heading_type(F.col("text"), F.coalesce("bold", F.lit(False)), F.col("font_size"), F.col("body_size")))
    ordered = in_reading_order(items, ["document_id", "page_number"]).withColumn("heading_type", kind)
    ordered = ordered.withColumn("type", F.when(F.col("heading_type").isNotNull(), "heading").otherwise(F.col("type")))
    placed = with_sections(ordered, ["document_id"], ["page_number", "reading_order"], F.col("heading_type").isNotNull())
    page_id = F.concat_ws("_", "document_id", F.lit("page"), "page_number")
    return placed.withColumns({"page_id": page_id, "block_id": F.concat_ws("_", page_id, F.lit("block"), "reading_order"), "section_id": F.concat_ws("_", "document_id", F.lit("section"), "section_number")})


def _texts_before(page: list[str], at: str, ahead: bool) -> Column:
    """How many texts come up to a row by the point ``at``, from above or, with ``ahead``, from below. A text at an asset's own
    point lies ahead; of texts at one point the first one read comes last, which is next to the asset."""
    point, own = (F.col(at).desc(), F.col("text").isNull()) if ahead else (F.col(at).asc(), F.col("text").isNotNull())
    order = Window.partitionBy(*page).orderBy(point, own, F.col("text.reading_order").desc())
    return F.count("text").over(order.rowsBetween(Window.unboundedPreceding, 0))


def _near(assets: DataFrame, texts: DataFrame, page: list[str], sides: list[tuple[str, str, bool]], k: int) -> DataFrame:
    """``assets``, as the struct ``own``, with an array of texts for each of ``sides`` (the asset's edge, the text's edge, ahead
    or not): the ``k`` nearest texts of the page on that side. Assets and texts are sorted together; each row's number is the
    count of texts so far, and so the last k texts are a range of numbers. One exchange, no pairs."""
    held = texts.dropna(subset=[*page, "t_top", "t_bottom"]).select(*page, F.lit(None).cast(assets.schema).alias("own"), F.struct("t_top", "t_bottom", "reading_order", "block_id", "text").alias("text"))
    asked = assets.select(*page, F.struct(*assets.columns).alias("own"), F.lit(None).cast(held.schema["text"].dataType).alias("text"))
    rows = asked.unionByName(held)
    for i, (edge, other, ahead) in enumerate(sides):
        rows = rows.withColumn("__at", F.coalesce(F.col(f"text.{other}"), F.col(f"own.{edge}")))
        rows = rows.withColumn("__n", _texts_before(page, "__at", ahead))
        last = Window.partitionBy(*page).orderBy("__n").rangeBetween(1 - k, 0)
        rows = rows.withColumn(f"side_{i}", F.collect_list("text").over(last))
    return rows.where("own is not null")


def nearest_context(assets: DataFrame, texts: DataFrame, page: list[str], k: int = CONTEXT_BLOCKS) -> DataFrame:
    """For each asset the ids and texts of its ``k`` nearest text blocks of the page, blank ones then left out. Assets:
    asset_id, top, bottom; texts: block_id, text, t_top, t_bottom, reading_order (which no two texts of a page share).
    The distance is that of the facing edges, so a text among the k nearest is among the k nearest above or below by one of
    the two pairs of edges. Texts and assets without a box, or without a page, have no distance."""
    sides = [("bottom", "t_top", False), ("bottom", "t_top", True), ("top", "t_bottom", False), ("top", "t_bottom", True)]
    met = _near(assets, texts, page, sides, k)
    top, bottom = F.col("own.top"), F.col("own.bottom")

    def ranked(x: Column) -> Column:
        distance = F.least(F.abs(x["t_top"] - bottom), F.abs(top - x["t_bottom"]))
        return F.struct(distance.alias("distance"), x["reading_order"].alias("reading_order"), x["block_id"].alias("block_id"), x["text"].alias("text"))

    nearest = F.slice(F.array_sort(F.array_distinct(F.transform(F.concat(*[f"side_{i}" for i in range(len(sides))]), ranked))), 1, k)
    boxed = F.when(top.isNotNull() & bottom.isNotNull(), F.filter(nearest, lambda x: x["text"] != ""))
    found = met.withColumn("c", F.coalesce(boxed, F.filter(nearest, lambda x: F.lit(False))))
    return found.select("own.*", F.transform("c", lambda x: x["block_id"]).alias("context_block_ids"), F.array_join(F.transform("c", lambda x: x["text"]), " | ").alias("nearby_text"))


def captions(assets: DataFrame, texts: DataFrame, page: list[str], gap: float = CAPTION_GAP) -> DataFrame:
    """``caption``: the topmost text that starts at most ``gap`` below the asset; empty if there is none."""
    met = _near(assets, texts, page, [("bottom", "t_top", True)], 1)
    first = F.get("side_0", F.lit(0))
    caption = F.when(first["t_top"] - F.col("own.bottom") <= gap, first["text"])
    return met.select("own.*", F.coalesce(caption, F.lit("")).alias("caption"))


def next_blocks(blocks: DataFrame, document: list[str], order: list[str], key: str) -> DataFrame:
    """Pairs (src, dst) of blocks that follow each other."""
    after = F.lead(key).over(Window.partitionBy(*document).orderBy(*order))
    return blocks.withColumn("dst", after).where("dst is not null").select(*document, F.col(key).alias("src"), "dst")


def statistics(blocks: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Counts for each document."""
    out = blocks.groupBy("document_id").agg(
        F.count_distinct("page_id").alias("pages"),
        F.count_distinct("section_id").alias("sections"),
        F.count("*").alias("blocks"),
        F.count_if(F.col("type").isin("text", "heading")).alias("text_blocks"),
        F.count_if(F.col("type") == "image").alias("images"),
        F.count_if(F.col("type") == "table").alias("tables"),
    )
    if links is None:
        return out
    return out.join(links.groupBy("document_id").agg(F.count("*").alias("links")), "document_id", "left").fillna(0, ["links"])
