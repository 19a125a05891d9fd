"""Exact dedup with Patricia-trie owners.

Texts are equal when identical after each run of ASCII white space becomes one space; null counts as empty. Rows go to
partitions by length and content hash of that normal form; each partition inserts the full byte strings into a
compressed radix trie whose terminal nodes hold the smallest ``doc_id`` and the number of rows. The same trie combines
the copies inside each input partition before the shuffle, so a group of copies that holds a third of all rows sends
each text once per input partition. When a trie holds more than ``BUDGET`` bytes, its largest subtree is spilled: its
terminals leave as partial results, which meet again by the text's SHA-256.

Results for special cases: a null ``doc_id`` counts in its group's size, but owns it only if all its ids are null, and
then none of its rows is dropped; rows that repeat one ``doc_id`` with one text are one document and are marked alike;
an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Bytes of text that a trie may hold.
BUDGET = 48_000_000
#: Rows that leave a trie in one Arrow batch, in bytes of text.
OUT_BYTES = 8_000_000

WHITE = re.compile(rb"[\x20\x09-\x0D]+")


def normal_form(text: str | None) -> bytes:
    return WHITE.sub(b" ", (text or "").encode())


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the longest common prefix of ``a`` and ``b[at:]``, by halving."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if b.startswith(a[low:mid], at + low):
            low = mid
        else:
            high = mid - 1
    return low


class Node:
    """An edge's label and what hangs below it; ``count`` is 0 unless a text ends here."""

    __slots__ = ("label", "below", "owner", "count")

    def __init__(self, label: bytes):
        self.label, self.below, self.owner, self.count = label, {}, None, 0


class PatriciaTrie:
    def __init__(self) -> None:
        self.root, self.held = Node(b""), 0

    def insert(self, text: bytes, owner: int | None, count: int = 1) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node.below.get(text[at])
            if child is None:
                child = node.below[text[at]] = Node(text[at:])
                self.held += len(child.label) + 200  # and about 200 bytes of objects
                at = len(text)
            elif text.startswith(child.label, at):
                at += len(child.label)
            else:
                cut = _common(child.label, text, at)
                upper = node.below[text[at]] = Node(child.label[:cut])
                child.label = child.label[cut:]
                upper.below[child.label[0]] = child
                self.held += 200
                child, at = upper, at + cut
            node = child
        node.count += count
        if owner is not None and (node.owner is None or owner < node.owner):
            node.owner = owner

    def spill(self) -> Iterator[tuple[bytes, int | None, int]]:
        """Take the subtree with most text below the root out and give its terminals: text, owner, rows."""
        sizes = {}
        for first, node in self.root.below.items():
            sizes[first], stack = 0, [node]
            while stack:
                x = stack.pop()
                sizes[first] += len(x.label) + 200
                stack += x.below.values()
        largest = max(sizes, key=sizes.__getitem__)
        self.held -= sizes[largest]
        yield from self.terminals(self.root.below.pop(largest), b"")

    def terminals(self, node: Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, int | None, int]]:
        stack = [(node or self.root, prefix)]
        while stack:
            node, prefix = stack.pop()
            text = prefix + node.label
            if node.count:
                yield text, node.owner, node.count
            stack += [(child, text) for child in node.below.values()]


def _combine(rows: Iterator[tuple[bytes, int | None, int]], budget: int) -> Iterator[tuple[bytes, int | None, int]]:
    trie = PatriciaTrie()
    for row in rows:
        trie.insert(*row)
        while trie.held > budget and trie.root.below:
            yield from trie.spill()
    yield from trie.terminals()


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], weight) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def owners(df: DataFrame, text: str = "text", id: str = "doc_id", budget: int = BUDGET) -> DataFrame:
    """(text_sha256, keep_id, group_size) for each distinct normal form."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((normal_form(t.as_py()), i.as_py(), 1) for b in batches for i, t in zip(b.column(0), b.column(1)))
        keyed = ((len(t), int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True), t, i, n) for t, i, n in _combine(rows, budget))
        types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        yield from _batches(keyed, ["length", "hash", "text", "owner", "n"], types, lambda r: r[0] + 50)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (tuple(v.as_py() for v in row) for b in batches for row in zip(b.column(2), b.column(3), b.column(4)))
        found = ((hashlib.sha256(t).hexdigest(), i, n) for t, i, n in _combine(rows, budget))
        yield from _batches(found, ["text_sha256", "owner", "n"], [pa.string(), pa.int64(), pa.int64()], lambda r: 150)

    local = df.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(first, "length long, hash long, text binary, owner long, n long")
    partial = local.repartition("length", "hash").mapInArrow(second, "text_sha256 string, owner long, n long")
    # only spilled subtrees have more than one row here
    return partial.groupBy("text_sha256").agg(F.min("owner").alias("keep_id"), F.sum("n").alias("group_size"))


def text_digest(text: str = "text") -> Column:
    """``text_sha256``: hexadecimal digits of the normal form's SHA-256."""
    return F.sha2(F.regexp_replace(F.coalesce(F.col(f"`{text}`"), F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)


def exact_duplicates(df: DataFrame, text: str = "text", id: str = "doc_id", budget: int = BUDGET) -> DataFrame:
    """One row for each row of ``df``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    # written, so that both sides of the join come straight from a shuffle and a hot group's rows can be split
    digests = df.select(F.col(f"`{id}`").cast("long").alias("doc_id"), text_digest(text).alias("text_sha256"))
    joined = digests.join(written(owners(df, text, id, budget), "owners"), "text_sha256")
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
