"""Line dedup that can be taken back: sharded cuckoo filters backed by exact reference-count tables.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased; keys shorter than ``min_chars`` code
points are left alone. The reference table holds (digest, doc_id, refs): how many lines of a document have the key (by
its 128-bit BLAKE2b digest). Inserting documents adds to its counts, deleting them takes from them; what decides (how many
documents hold a key, the largest of their ids) always comes from that table, so any order of insertions and deletions
leaves what a fresh build over the remaining documents would.

Keys held by at least ``min_docs`` documents are in the cuckoo filter of their shard (by digest). Cuckoo filters store
short fingerprints in one of two buckets and, unlike Bloom filters, can forget a key again: ``update`` looks again only at
the keys of the documents that come or go and inserts into, or deletes from, the stored filters those whose status
changes. A filter that gets too full is built anew from its shard's exact keys.

Questions, (digest, doc_id), go to their shard, where its filter and its exact keys are. A digest that isn't in the
filter stays without a look at the exact keys; what is in it is decided by them, so a false positive never costs a line.
A shard with many questions, for a hot line or because there are few shards, is asked in parts of about ``PART``, each with
a copy of the filter and keys; so a part holds ``SHARD_KEYS`` keys or so, and copies are fewer than questions.

Results for special cases: a null or empty text has one empty line; a null ``doc_id`` counts as one document whose lines
always stay; rows that repeat a ``doc_id`` are one document, and their lines are dropped alike; an empty table gives an
empty one.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

WHITE = " \t\n\x0b\x0c\r"
#: Keys of a shard, and questions that are put to it in one part.
SHARD_KEYS, PART = 20_000, 50_000
#: The 26 letters.
_LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def line_key(line: str) -> str:
    return line.strip(WHITE).translate(_LOWER) if not line.isascii() else line.strip(WHITE).lower()


def digest(key: str) -> bytes:
    return hashlib.blake2b(key.encode(), digest_size=16).digest()


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key may be in its own bucket or in the one its fingerprint leads to."""

    SLOTS, KICKS = 4, 500

    def __init__(self, capacity: int, table: np.ndarray | None = None):
        if table is None:
            buckets = 1 << max(4, (int(capacity / (self.SLOTS * 0.85))).bit_length())
            table = np.zeros((buckets, self.SLOTS), np.uint16)
        self.table, self.mask, self.kicked = table, len(table) - 1, 0

    @staticmethod
    def _of(key: bytes) -> tuple[int, int]:
        return int.from_bytes(key[:2], "little") or 1, int.from_bytes(key[2:8], "little")

    def _other(self, at: int, mark: int) -> int:
        return at ^ (mark * 0x5BD1E995 & self.mask)

    def insert(self, key: bytes) -> None:
        mark, place = self._of(key)
        at = place & self.mask
        for here in (at, self._other(at, mark)):
            free = np.flatnonzero(self.table[here] == 0)
            if len(free):
                self.table[here, free[0]] = mark
                return
        for _ in range(self.KICKS):
            slot = self.kicked % self.SLOTS
            self.kicked += 1
            mark, self.table[at, slot] = int(self.table[at, slot]), mark
            at = self._other(at, mark)
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = mark
                return
        raise OverflowError("the filter is full")

    def delete(self, key: bytes) -> bool:
        mark, place = self._of(key)
        at = place & self.mask
        for here in (at, self._other(at, mark)):
            found = np.flatnonzero(self.table[here] == mark)
            if len(found):
                self.table[here, found[0]] = 0
                return True
        return False

    def __contains__(self, key: bytes) -> bool:
        mark, place = self._of(key)
        at = place & self.mask
        return bool((self.table[at] == mark).any() or (self.table[self._other(at, mark)] == mark).any())

    def contains_all(self, keys: list[bytes]) -> np.ndarray:
        """Which of the keys (16 bytes each) may be in the filter."""
        raw = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 16)
        marks = raw[:, :2].copy().view("<u2")[:, 0].astype(np.int64)
        marks[marks == 0] = 1
        at = raw[:, 2:8].astype(np.int64) @ (1 << 8 * np.arange(6, dtype=np.int64)) & self.mask
        other = at ^ (marks * 0x5BD1E995 & self.mask)
        return ((self.table[at] == marks[:, None]) | (self.table[other] == marks[:, None])).any(1)

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(0, np.frombuffer(data, np.uint16).reshape(-1, cls.SLOTS).copy())


def build(keys: list[bytes]) -> CuckooFilter:
    """A filter that holds ``keys``, twice as large while it overflows."""
    capacity = max(len(keys), 16)
    while True:
        found = CuckooFilter(capacity)
        try:
            for key in keys:
                found.insert(key)
            return found
        except OverflowError:
            capacity *= 2


def references(df: DataFrame, text: str = "text", id: str = "doc_id", min_chars: int = 20) -> DataFrame:
    """(digest, doc_id, refs) for each document and key of at least ``min_chars`` code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, docs, refs = [], [], []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = Counter(key for line in (value.as_py() or "").split("\n") if len(key := line_key(line)) >= min_chars)
                keys += map(digest, own)
                refs += own.values()
                docs += [doc] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(docs, pa.int64()), pa.array(refs, pa.int64())], names=["digest", "doc_id", "refs"])

    return df.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, "digest binary, doc_id long, refs long")


def insert(references: DataFrame, added: DataFrame) -> DataFrame:
    """The reference table with the references of more documents."""
    return references.unionByName(added).groupBy("digest", "doc_id").agg(F.sum("refs").alias("refs"))


def delete(references: DataFrame, gone: DataFrame) -> DataFrame:
    """The reference table without the references of documents that leave (their ``references``)."""
    return insert(references, gone.withColumn("refs", -F.col("refs"))).where("refs > 0")


def repeated(references: DataFrame, min_docs: int = 3) -> DataFrame:
    """(digest, docs, last): keys held by at least ``min_docs`` documents, and the largest id of those."""
    pairs = references.groupBy("digest", "doc_id").agg(F.sum("refs").alias("refs")).where("refs > 0")
    return pairs.groupBy("digest").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last")).where(F.col("docs") >= min_docs)


class State(NamedTuple):
    """Tables in the shared folder: references, exact keys (``repeated``), filters (shard, filter); the number of shards."""

    references: DataFrame
    keys: DataFrame
    filters: DataFrame
    shards: int


def _shard_of(shards: int):
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard")


def filters(keys: DataFrame, shards: int) -> DataFrame:
    """(shard, filter): the cuckoo filter of each shard's digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, list[bytes]] = {}
        for batch in batches:
            for shard, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own.setdefault(shard, []).append(key)
        for shard, found in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([build(found).to_bytes()], pa.binary())], names=["shard", "filter"])

    return keys.select(_shard_of(shards), "digest").repartition(shards, "shard").mapInArrow(run, "shard int, filter binary")


def build_state(own: DataFrame, min_docs: int = 3) -> State:
    """The state of documents whose ``references`` are ``own``."""
    references = written(own, "references")
    keys = written(repeated(references, min_docs), "keys")
    shards = int(keys.count() // SHARD_KEYS + 1)
    return State(references, keys, written(filters(keys, shards), "filters"), shards)


def _changed(old: DataFrame, changes: DataFrame) -> DataFrame:
    """Filters (shard, filter) after ``changes`` (shard, digest, kind: 1 leaves, 2 enters); null for one that overflowed."""
    rows = old.select("shard", F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("kind"), "filter").unionByName(changes.withColumn("filter", F.lit(None).cast("binary")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([own and own.to_bytes()], pa.binary())], names=["shard", "filter"])

        at, own = None, None
        for batch in batches:
            for shard, digest, kind, data in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != at:
                    if at is not None:
                        yield out()
                    at, own = shard, CuckooFilter(SHARD_KEYS)
                if kind == 0:
                    own = CuckooFilter.from_bytes(data)
                elif own is not None and kind == 1:
                    own.delete(digest)
                elif own is not None:
                    try:
                        own.insert(digest)
                    except OverflowError:
                        own = None
        if at is not None:
            yield out()

    return rows.repartition("shard").sortWithinPartitions("shard", "kind").select("shard", "digest", "kind", "filter").mapInArrow(run, "shard int, filter binary")


def update(state: State, added: DataFrame | None = None, gone: DataFrame | None = None, min_docs: int = 3) -> State:
    """The state after documents came or went (their ``references``)."""
    parts = [written(x, "delta") for x in (added, gone) if x is not None]
    references = state.references
    if added is not None:
        references = insert(references, parts[0])
    if gone is not None:
        references = delete(references, parts[-1])
    references = written(references, "references")
    touched = parts[0].select("digest") if len(parts) == 1 else parts[0].select("digest").union(parts[1].select("digest"))
    touched = written(touched.distinct(), "touched")
    now = written(repeated(references.join(touched, "digest", "left_semi"), min_docs), "now")
    keys = written(state.keys.join(touched, "digest", "left_anti").unionByName(now), "keys")
    if keys.count() > 2 * SHARD_KEYS * state.shards:
        return build_state(references, min_docs)
    before = state.keys.join(touched, "digest", "left_semi")
    leave, enter = before.join(now, "digest", "left_anti"), now.join(before, "digest", "left_anti")
    changes = leave.select(_shard_of(state.shards), "digest", F.lit(1).alias("kind")).union(enter.select(_shard_of(state.shards), "digest", F.lit(2).alias("kind")))
    found = written(_changed(state.filters, changes), "filters")
    full = found.where("filter is null").select("shard")
    again = filters(keys.withColumn("shard", _shard_of(state.shards)).join(full, "shard", "left_semi"), state.shards)
    return State(references, keys, written(found.where("filter is not null").unionByName(again), "filters"), state.shards)


def drops(questions: DataFrame, state: State) -> DataFrame:
    """(doc_id, digests): for each document of ``questions`` (digest, doc_id) that loses lines, the keys of these lines."""
    asked = questions.select(_shard_of(state.shards), "digest", "doc_id").where("doc_id is not null")
    parts = written(asked.groupBy("shard").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")), "parts")
    none = {"digest": "binary", "doc_id": "long", "filter": "binary"}

    def rows(df: DataFrame, kind: int, part) -> DataFrame:
        # a row for each shard, that is, for SHARD_KEYS keys: some megabytes for ten billion keys
        return df.join(F.broadcast(parts), "shard").select("shard", part.alias("part"), F.lit(kind).alias("kind"), *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in none.items()])

    each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    met = rows(state.filters, 0, each).union(rows(state.keys.select(_shard_of(state.shards), "digest", F.col("last").alias("doc_id")), 1, each))
    met = met.union(rows(asked, 2, F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last = None, {}
        for batch in batches:
            group = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
            edges = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(1)) + 1).tolist(), len(group)]
            digests, docs = [], []
            for a, b in zip(edges, edges[1:]):
                kind = group[a, 2] if b > a else None
                if kind == 0:
                    own, last = (tuple(group[a, :2]), CuckooFilter.from_bytes(batch.column(5)[a].as_py())), {}
                elif kind == 1:
                    last.update(zip(batch.column(3).slice(a, b - a).to_pylist(), batch.column(4).slice(a, b - a).to_pylist()))
                elif kind == 2 and own and own[0] == tuple(group[a, :2]):
                    keys, ids = batch.column(3).slice(a, b - a).to_pylist(), batch.column(4).slice(a, b - a).to_pylist()
                    for i in np.flatnonzero(own[1].contains_all(keys)).tolist():
                        if last.get(keys[i], ids[i]) != ids[i]:
                            digests.append(keys[i])
                            docs.append(ids[i])
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(docs, pa.int64())], names=["digest", "doc_id"])

    sure = met.repartition("shard", "part").sortWithinPartitions("shard", "part", "kind").mapInArrow(run, "digest binary, doc_id long")
    return sure.groupBy("doc_id").agg(F.collect_set("digest").alias("digests"))


def line_dedup(df: DataFrame, text: str = "text", id: str = "doc_id", min_chars: int = 20, min_docs: int = 3, out: str = "kept_text", digests: bool = False, state: State | None = None) -> DataFrame:
    """For each row of ``df``: ``doc_id``, ``n_lines``, ``n_dropped`` and the kept lines in ``out`` (with ``digests``
    their SHA-256 instead). ``state``: of a corpus that ``df`` is a part of; by default ``df`` is all of it."""
    if state is None:
        state = build_state(references(df, text, id, min_chars), min_docs)
        questions = state.references
    else:
        questions = references(df, text, id, min_chars)
    # written, so that both sides of the join come straight from a shuffle and a hot id's rows can be split
    lost = written(drops(questions, state), "drops")
    rows = df.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    known = rows.where("doc_id is not null").join(lost, "doc_id", "left").select("doc_id", "text", "digests")
    asked = known.union(rows.where("doc_id is null").select("doc_id", "text", F.lit(None).cast("array<binary>").alias("digests")))
    name = "kept_sha256" if digests else out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, dropped, kept = [], [], []
            for value, gone in zip(batch.column(1), batch.column(2)):
                own = (value.as_py() or "").split("\n")
                gone = set(gone.as_py() or ())
                stay = [x for x in own if len(key := line_key(x)) < min_chars or digest(key) not in gone] if gone else own
                lines.append(len(own))
                dropped.append(len(own) - len(stay))
                joined = "\n".join(stay)
                kept.append(hashlib.sha256(joined.encode()).hexdigest() if digests else joined)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_lines", "n_dropped", name])

    return asked.mapInArrow(run, f"doc_id long, n_lines long, n_dropped long, {name} string")
