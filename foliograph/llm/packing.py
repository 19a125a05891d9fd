"""Packing along a space-filling curve: documents cut into sequences of one length, neighbours by content side by side.

Each document's token ids are hashed into a vector of term weights, which a fixed random projection takes to four
dimensions. Coordinates, scaled by their mean and deviation over all documents, give a Hilbert key; documents are sorted by
ranges of the key, and each range is laid end to end along the curve and cut at every ``LENGTH`` ids. What remains at a
range's end becomes sequences whose lengths are powers of two, so nothing is padded.

A task tokenises some characters of text at a time and packs a stream: it holds one document's ids and one open sequence.
Equal documents have equal keys; their row numbers order them, so that a range can begin or end among them and a hot text
fills as many ranges as it needs. The ids are written once, in the shared folder, and shuffled once.

Results for special cases: a null text is an empty one and has the closing id alone; an id of a document, null or repeated,
is carried along; other columns are ignored; no rows give no pieces. Strings of special tokens inside texts are read as the
tokenizer's file says.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

#: Ids in a sequence.
LENGTH = 2048
#: The id that closes a document in the query's tokenizer.
CLOSING = 1
#: Characters of text that a task tokenises at a time; words whose ids it remembers before it starts anew.
CHUNK, CACHE = 2_000_000, 1_000_000
#: Words that are encoded as one text, marks that may stand between them, marks that may end a word, and letters before these.
GROUP = 1000
SEPARATORS, MARKS, LETTERS = "|~@", b".,;:!?", b"abcdefghijklmnopqrstuvwxyz"
#: Hashed features, and dimensions and bits of each in the Hilbert key.
FEATURES, DIMENSIONS, BITS = 4096, 4, 15
#: Pieces that are returned at a time.
PIECES = 8192


class Words:
    """The ids of texts under a tokenizer that drops white space: each word between ASCII white space by itself, and each
    distinct one once. A word that ends in an ASCII letter and marks is its two parts, where the tokenizer parts them anyway."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has dealt out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[bytes, bytes] = {}
        self.lowers = [n.get("type") for n in (json.loads(definition).get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        plain = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        alone = [(mark, plain(mark)) for mark in SEPARATORS]
        self.between = next(((mark, ids[0]) for mark, ids in alone if len(ids) == 1 and plain(f"a {mark} b") == [*plain("a"), *ids, *plain("b")]), None)
        cutter = self.tokenizer.pre_tokenizer
        self.parts = cutter is not None and all(cutter.pre_tokenize_str(f"a{mark}{mark}")[0][1] == (0, 1) for mark in MARKS.decode())

    def lowered(self, text: bytes) -> bytes:
        """The text with A-Z lower-cased, if the tokenizer does that anyway: not beside marks that combine with letters, which it
        does first, nor in what may be a special token."""
        return text.lower() if self.lowers and not any(mark in text for mark in (b"\xcc", b"\xcd", b"<|")) else text

    def learn(self, words: list[bytes]) -> None:
        """Remember the ids of ``words``. Many are encoded as one text with a separator between them; where its id comes more
        often than that, it is in a word, and these words are encoded one by one."""
        mark, id = self.between or ("", -1)
        size = self.kind.itemsize
        groups = [words[i : i + GROUP] for i in range(0, len(words), GROUP)] if self.between else []
        single = [] if self.between else words
        for group, found in zip(groups, self.tokenizer.encode_batch_fast([f" {mark} ".join([w.decode() for w in g]) for g in groups], add_special_tokens=False)):
            ids = np.array(found.ids, self.kind)
            at = np.flatnonzero(ids == id)
            if len(at) != len(group) - 1:
                single = single + group
                continue
            raw, first, last = ids.tobytes(), [0, *((at + 1) * size).tolist()], [*(at * size).tolist(), len(ids) * size]
            self.known.update(zip(group, [raw[i:j] for i, j in zip(first, last)]))
        for word, found in zip(single, self.tokenizer.encode_batch_fast([w.decode() for w in single], add_special_tokens=False)):
            self.known[word] = np.array(found.ids, self.kind).tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, as ``kind``."""
        if len(self.known) > CACHE:
            self.known.clear()
        cut = [self.lowered(text.encode()).split() for text in texts]
        new = set().union(*cut).difference(self.known)
        marked = []
        if self.parts:
            for word in new:
                if word[-1] in MARKS and (stem := word.rstrip(MARKS)) and stem[-1] in LETTERS:
                    marked.append((word, stem, word[len(stem) :]))
            new.difference_update([m[0] for m in marked])
            new.update({x for m in marked for x in m[1:]}.difference(self.known))
        self.learn(list(new))
        for word, stem, end in marked:
            self.known[word] = self.known[stem] + self.known[end]
        for words in cut:
            yield b"".join(map(self.known.__getitem__, words))


@lru_cache(1)
def words_of(definition: str) -> Words:
    """What a worker remembers of a tokenizer's words, from one task to the next."""
    return Words(definition)


def projection() -> np.ndarray:
    return np.random.default_rng(12).standard_normal((FEATURES, DIMENSIONS)).astype(np.float32)


def coordinates(ids: list[np.ndarray], onto: np.ndarray) -> np.ndarray:
    """Of each document's ids the hashed vector of dampened counts, of length one, projected."""
    out = np.zeros((len(ids), DIMENSIONS))
    for i, own in enumerate(ids):
        counts = np.bincount(own.astype(np.uint32) * np.uint32(2654435761) >> np.uint32(20))
        met = np.flatnonzero(counts)
        weights = np.log1p(counts[met], dtype=np.float32)
        out[i] = weights @ onto[met] / max(float(np.sqrt(weights @ weights)), 1e-9)
    return out


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The position along the Hilbert curve of each row of ``cells`` (rows of unsigned coordinates under 2^bits): the axes are
    turned and exchanged from the coarsest bit down, then their bits are interleaved as a Gray code."""
    x = cells.T.astype(np.uint64).copy()
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        below = bit - one
        for axis in range(len(x)):
            set_ = (x[axis] & bit) != 0
            swap = np.where(set_, np.uint64(0), (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(set_, below, swap)
            x[axis] ^= swap
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        turn ^= np.where((x[-1] & bit) != 0, bit - one, np.uint64(0))
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            key = key << one | (x[axis] >> np.uint64(level)) & one
    return key.astype(np.int64)


def tokens(df: DataFrame, definition: str, closing: int, text: str = "text") -> DataFrame:
    """doc_id, ``row``, ``ids`` (two or four bytes each, little-endian, with ``closing``) and coordinates c0, c1, ..."""
    rows = df.select("doc_id", F.monotonically_increasing_id().alias("row"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("ids", T.BinaryType()), *(T.StructField(f"c{i}", T.DoubleType()) for i in range(DIMENSIONS))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, onto = words_of(definition), projection()
        end = np.array([closing], words.kind).tobytes()

        def done(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            ids = [x + end for x in words.encode(texts)]
            at = coordinates([np.frombuffer(x, words.kind)[:-1] for x in ids], onto)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary()), *map(pa.array, at.T)], names=schema.names)

        for batch in batches:
            texts, first, size = [], 0, 0
            for value in batch.column(2):
                texts.append(value.as_py() or "")
                size += len(texts[-1])
                if size >= CHUNK:
                    yield done(batch.slice(first, len(texts)), texts)
                    texts, first, size = [], first + len(texts), 0
            if texts:
                yield done(batch.slice(first, len(texts)), texts)

    return rows.mapInArrow(run, schema)


def curve_key(tokenised: DataFrame) -> Column:
    """The Hilbert key of each row; each coordinate's cell is its place in a bell curve fitted to all rows."""
    names = [f"c{i}" for i in range(DIMENSIONS)]
    fitted = tokenised.agg(*[f(c).alias(f"{c}_{f.__name__}") for c in names for f in (F.avg, F.stddev_pop)]).first()
    mean, deviation = (np.array([fitted[f"{c}_{f}"] or 0.0 for c in names]) for f in ("avg", "stddev_pop"))

    @F.pandas_udf("long")
    def key(*columns):
        import pandas as pd

        z = (np.stack([c.to_numpy() for c in columns], 1) - mean) / np.maximum(deviation, 1e-12)
        share = 1 / (1 + np.exp(-1.702 * np.clip(z, -8, 8)))
        return pd.Series(hilbert(np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)))

    return key(*names)


class Packer:
    """Sequences of one range: pieces (doc_id, start, length, crc32, doc_tokens, sequence_id, offset, ids)."""

    def __init__(self, first: int, length: int):
        self.sequence, self.length, self.open, self.room = first, length, [], length

    def add(self, doc_id, ids: np.ndarray, start: int, total: int) -> Iterator[tuple]:
        """Lay ``ids``, which are a document's from ``start`` on."""
        at = 0
        while at < len(ids):
            own = ids[at : at + self.room]
            self.open.append((doc_id, start + at, own, total))
            at, self.room = at + len(own), self.room - len(own)
            if not self.room:
                yield from self.close()

    def close(self) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, own, total in self.open:
            yield (doc_id, start, len(own), zlib.crc32(own.astype("<u4").tobytes()), total, self.sequence, offset, own)
            offset += len(own)
        self.sequence, self.open, self.room = self.sequence + 1, [], self.length

    def finish(self) -> Iterator[tuple]:
        """The open sequence's ids in sequences whose lengths are its length's powers of two."""
        rest, left = self.open, self.length - self.room
        self.open = []
        sizes = [1 << b for b in reversed(range(left.bit_length())) if left >> b & 1]
        self.room = sizes[0] if sizes else 0
        for doc_id, start, own, total in rest:
            at = 0
            while at < len(own):
                part = own[at : at + self.room]
                self.open.append((doc_id, start + at, part, total))
                at, self.room = at + len(part), self.room - len(part)
                if not self.room:
                    yield from self.close()
                    sizes.pop(0)
                    self.room = sizes[0] if sizes else 0


def pack(df: DataFrame, definition: str, closing: int = CLOSING, length: int = LENGTH, ids: bool = False) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of sequences of ``length`` ids, a power of
    two; with ``ids`` also their ``token_ids``. ``definition`` is the content of a tokenizer's file (some MB at most)."""
    if length & (length - 1):
        raise ValueError("the length must be a power of two")
    tokenised = written(tokens(df, definition, closing), "tokens", compression="zstd")
    along = tokenised.select("doc_id", "row", "ids", curve_key(tokenised).alias("key")).repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    counts = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = T.StructType([along.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in counts), *([T.StructField("token_ids", T.ArrayType(T.IntegerType()))] if ids else [])])
    from tokenizers import Tokenizer

    kind = "<u2" if Tokenizer.from_str(definition).get_vocab_size() <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, done, of_id = Packer(TaskContext.get().partitionId() << 33, length), [], pa.null()

        def pieces() -> Iterator[tuple]:
            nonlocal of_id
            for batch in batches:
                of_id = batch.schema.field(0).type
                for doc_id, own in zip(batch.column(0), batch.column(1)):
                    whole = np.frombuffer(own.as_buffer(), kind)
                    yield from packer.add(doc_id.as_py(), whole, 0, len(whole))
            yield from packer.finish()

        def batch() -> pa.RecordBatch:
            columns = list(zip(*done))
            arrays = [pa.array(columns[0], of_id), *(pa.array(c, pa.int64()) for c in columns[1:7])]
            return pa.RecordBatch.from_arrays(arrays + ([pa.array(columns[7], pa.list_(pa.int32()))] if ids else []), names=schema.names)

        for piece in pieces():
            done.append(piece)
            if len(done) >= PIECES:
                yield batch()
                done = []
        if done:
            yield batch()

    return along.select("doc_id", "ids").mapInArrow(run, schema)
