"""Benchmark decontamination by pigeonhole edit matching.

Both sides are normalised: lower case, each run of characters other than letters, digits and marks becomes one space, and one
space stands at either end. An item of n characters may be found with up to k = floor(``rate`` * n) edits (insertions,
deletions, substitutions), at whatever length; the spaces at its ends count, so an item inside longer words costs an edit at
each end that isn't a word's, and without a budget isn't found there. It is split into k + 1 pieces of equal length, one of which at least occurs exactly in any text with at most k edits. All
pieces of a block of items are searched in one pass over a document (an Aho-Corasick automaton); around each hit, Myers'
bit-parallel algorithm tells the smallest edit distance of the item to any substring there.

Blocks of items. An automaton holds at most ``BLOCK_CHARS`` characters of items; a larger benchmark is worked off in
blocks, each of them against all documents in tasks of its own, so what is sent to a task, and kept there, is one block.

Results for special cases: items without any letter or digit match nothing; a null text matches nothing; repeated items and
repeated documents each give their own rows; a null ``item_id`` or ``doc_id`` is carried along; empty tables give an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Edits allowed for each character of an item.
RATE = 0.08
#: Characters of items in one automaton.
BLOCK_CHARS = 4_000_000

OTHER = re.compile(r"[\W_]+")


def normal_form(text: str | None) -> str:
    return OTHER.sub(" ", (text or "").lower()).strip()


class Myers:
    """Edit distances of a pattern to all substrings of a text that end at each place, by bit-parallel columns."""

    def __init__(self, pattern: str):
        self.n, self.full = len(pattern), (1 << len(pattern)) - 1
        self.at: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.at[c] = self.at.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end) of the closest substring, the first one if there are several."""
        up, down, score, high, full, get = self.full, 0, self.n, 1 << self.n - 1, self.full, self.at.get
        best = (score, 0)
        for end, c in enumerate(text, 1):
            eq = get(c, 0)
            diagonal = (((eq & up) + up) ^ up) | eq | down
            right, left = down | (full & ~(diagonal | up)), up & diagonal
            if right & high:
                score += 1
            elif left & high:
                score -= 1
            # the text may start anywhere, so nothing is shifted in
            right, left = right << 1 & full, left << 1 & full
            up, down = left | (full & ~(diagonal | right)), right & diagonal
            if score < best[0]:
                best = (score, end)
        return best


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors`` + 1 pieces of about equal length with their places."""
    edges = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


class Matcher:
    def __init__(self, items: list[tuple[int | None, str | None]], rate: float = RATE):
        import ahocorasick

        self.ids, self.items, self.errors, self.myers = [], [], [], []
        at: dict[str, list[tuple[int, int]]] = {}
        for id, text in items:
            if not (own := normal_form(text)):
                continue
            number, k, item = len(self.ids), int(rate * len(own)), f" {own} "
            self.ids.append(id)
            self.items.append(item)
            self.errors.append(k)
            self.myers.append(Myers(item))
            for start, piece in pieces(item, k):
                at.setdefault(piece, []).append((number, start))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        if at:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int | None, int, int]]:
        """(item_id, distance, end of the match in the normal form) of the items within their error budgets."""
        own = f" {normal_form(text)} "
        if not self.ids or own.isspace():
            return []
        hits: dict[int, list[int]] = {}
        for end, (size, places) in self.automaton.iter(own):
            for number, start in places:
                hits.setdefault(number, []).append(end + 1 - size - start)
        return [found for number, starts in hits.items() if (found := self.verify(own, number, sorted(set(starts))))]

    def verify(self, text: str, number: int, starts: list[int]) -> tuple[int | None, int, int] | None:
        item, k = self.items[number], self.errors[number]
        for start in starts:
            if 0 <= start and text.startswith(item, start):
                return (self.ids[number], 0, start + len(item) - 2)
        best, at = None, 0
        while at < len(starts):
            # starts that lie close together share one window
            last = at
            while last + 1 < len(starts) and starts[last + 1] - starts[last] <= 2 * k:
                last += 1
            low = max(0, starts[at] - k)
            distance, end = self.myers[number].best(text[low : starts[last] + len(item) + k])
            if distance <= k and (best is None or distance < best[1]):
                best = (self.ids[number], distance, max(0, low + end - 2))
            at = last + 1
        return best


def blocks(benchmark: DataFrame, id: str, text: str, block_chars: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items, as many at a time as have ``block_chars`` characters; an iterator over partitions, not one collect."""
    own, size = [], 0
    for row in benchmark.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).toLocalIterator():
        own.append((row["id"], row["text"]))
        size += len(row["text"] or "")
        if size >= block_chars:
            yield own
            own, size = [], 0
    if own:
        yield own


def contaminations(docs: DataFrame, benchmark: DataFrame, text: str = "text", id: str = "doc_id", item_text: str = "text", item_id: str = "item_id", rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, match_end) for each document and item found in it."""
    schema = "doc_id long, item_id long, distance int, match_end long"
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = None
    for block in blocks(benchmark, item_id, item_text, block_chars):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value, rate)
            for batch in batches:
                found = [(doc.as_py(), *x) for doc, value in zip(batch.column(0), batch.column(1)) for x in matcher.find(value.as_py())]
                columns = list(zip(*found)) or [[]] * 4
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "item_id", "distance", "match_end"])

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def reject(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id", rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item is found. One block of items is a filter in one pass; several judge
    the texts block by block, and the rows of the texts that are found go by digest."""
    spark = docs.sparkSession
    own = blocks(benchmark, item_id, item_text, block_chars)
    first, second = next(own, None), next(own, None)
    if first is None:
        return docs
    if second is None:
        return _where(docs, docs.columns.index(text), spark.sparkContext.broadcast(first), rate, found=False)
    texts = docs.select(F.col(f"`{text}`").alias("text")).where("text is not null")
    judged = [_where(texts, 0, spark.sparkContext.broadcast(block), rate, found=True).select(F.sha2("text", 256).alias("digest")) for block in chain([first, second], own)]
    gone = written(reduce(DataFrame.union, judged).distinct(), "contaminated").alias("gone")
    return docs.alias("own").join(gone, F.sha2(F.col(f"own.`{text}`"), 256) == F.col("gone.digest"), "left_anti")


def _where(rows: DataFrame, at: int, sent, rate: float, found: bool) -> DataFrame:
    """The rows whose text, column number ``at``, has an item of the block, or has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value, rate)
        for batch in batches:
            yield batch.filter(pa.array([bool(matcher.find(v.as_py())) == found for v in batch.column(at)], pa.bool_()))

    return rows.mapInArrow(run, rows.schema)
