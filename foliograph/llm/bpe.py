"""Byte-level BPE: a rank vocabulary run by a sentencepiece BPE model that is serialised here, without training.

Each of the 256 bytes is shown to sentencepiece as one letter (code point 256 + byte) and each token as the letters of
its bytes with the score -rank, so the highest-scored merge is the lowest-ranked one, leftmost first. The model's
normalisation is the identity. A text is split by the vocabulary's pattern and each pre-token encoded by itself;
decoding joins the tokens' bytes.

Results for special cases: a null text is encoded as the empty text, with no tokens and the digests of the empty string;
other columns, null or not, pass through. A batch of texts is in memory at a time; a pre-token may be of any length.
"""

from __future__ import annotations

import base64
import codecs
import gc
import hashlib
import struct
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Offset of the code points that stand for bytes; none of them is white space or has a special meaning.
BYTE_AT = 256
#: Distinct strings whose ids a task remembers before it starts anew.
CACHE = 1_000_000
#: Characters of text that a task encodes at a time.
CHUNK = 2_000_000
#: Fixed value: the pattern whose matches a single space or line feed between other characters always separates.
SPACED_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

def spaced(text: str) -> bool:
    """Whether all white space is lone spaces and line feeds between other characters."""
    return " ".join(text.split()) == text.replace("\n", " ")


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Of a rank file: a token in base64 and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def letters(data: bytes) -> str:
    """One letter for each byte."""
    return codecs.charmap_decode(data, "strict", _LETTERS)[0]


_LETTERS = "".join(chr(BYTE_AT + b) for b in range(256))


def serialise(tokens: list[bytes]) -> bytes:
    """The protocol buffer of a sentencepiece model; token i becomes piece i + 1, piece 0 is the unknown piece."""

    def piece(text: str, score: float, kind: int) -> bytes:
        return _field(1, _field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + _number(3, kind))

    unknown = "⁇"
    normal, unk, bpe = 1, 2, 2
    model = [piece(unknown, 0.0, unk)]
    model += [piece(letters(token), -float(rank), normal) for rank, token in enumerate(tokens)]
    trainer = _number(3, bpe) + _number(4, len(tokens) + 1) + _number(40, 0) + _field(45, unknown.encode())
    # identity, no added prefix, white space neither removed nor escaped
    normaliser = _field(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(model) + _field(2, trainer) + _field(3, normaliser)


class ByteBpe:
    """Encoder and decoder of one vocabulary. ``ranks`` must be 0, 1, 2, ... and hold every single byte."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self.tokens = sorted(ranks, key=ranks.__getitem__)
        if [ranks[t] for t in self.tokens] != list(range(len(ranks))):
            raise ValueError("the ranks have gaps")
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the vocabulary lacks single bytes: {missing}")
        self.split = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.tokens))
        self.by_spaces = pattern == SPACED_PATTERN
        self.pre_tokens: dict[str, tuple[int, ...]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}  # of texts cut at spaces and line feeds

    def pieces_of(self, text: str) -> list[str]:
        """Of a ``spaced`` text: a lone space or line feed always separates pre-tokens, and a space
        belongs to the one that follows."""
        lines = text.replace(" ", "\0 ").replace("\n", "\0\n\0") if "\0" not in text else ""
        return lines.split("\0") if lines else self.split(text)

    def learn(self, pieces: set[str]) -> None:
        """Encode what isn't known yet; all new pre-tokens go through the model in one call."""
        parts = {piece: [piece] if piece.isalpha() and piece.isascii() else self.split(piece) for piece in pieces}
        new = [p for p in set(chain.from_iterable(parts.values())) if p not in self.pre_tokens]
        for part, ids in zip(new, self.model.encode([letters(p.encode()) for p in new], num_threads=1) if new else [], strict=True):
            self.pre_tokens[part] = tuple([i - 1 for i in ids])
        known = self.pre_tokens
        for piece, own in parts.items():
            self.pieces[piece] = known[own[0]] if len(own) == 1 else tuple(chain.from_iterable(map(known.__getitem__, own)))

    def encode_batch(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text."""
        if len(self.pre_tokens) + len(self.pieces) > CACHE:
            self.pre_tokens.clear()
            self.pieces.clear()
        cut = [self.pieces_of(t) if self.by_spaces and spaced(t) else self.split(t) for t in texts]
        self.learn({p for p in set(chain.from_iterable(cut)) if p not in self.pieces})
        known = self.pieces.__getitem__
        for own in cut:
            yield list(chain.from_iterable(map(known, own)))

    def encode_all(self, values: pa.Array) -> Iterator[list[int]]:
        """The ids of each text of an Arrow column, some of them at a time."""
        texts, size = [], 0
        for value in values:
            texts.append(value.as_py() or "")
            size += len(texts[-1])
            if size >= CHUNK:
                yield from self.encode_batch(texts)
                texts, size = [], 0
        yield from self.encode_batch(texts)

    def encode(self, text: str) -> list[int]:
        return next(self.encode_batch([text]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encode(df: DataFrame, ranks: bytes, pattern: str, text: str = "text", keep: list[str] | None = None, ids: bool = True, digests: bool = False) -> DataFrame:
    """Columns ``keep`` (default: all) of each row, ``n_tokens``, with ``ids`` the ``token_ids``, and with ``digests`` the
    SHA-256 of the decimal ids and of the bytes that the ids decode to. ``ranks`` is the content of a rank file, of a
    fixed size (under 1 MB for 50,000 tokens). An input column with the name of a new one gives way to it."""
    new = {"n_tokens": T.LongType()} | ({"token_ids": T.ArrayType(T.IntegerType())} if ids else {}) | ({"ids_sha256": T.StringType(), "decoded_sha256": T.StringType()} if digests else {})
    keep = [c for c in (keep if keep is not None else df.columns) if c not in new]
    kept = df.select(*[f"`{c}`" for c in keep])
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`")).toDF(*[f"c{i}" for i in range(len(keep) + 1)])
    schema = T.StructType([*kept.schema.fields, *(T.StructField(name, kind) for name, kind in new.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(read_ranks(ranks), pattern)
        decimal = [str(i) for i in range(len(bpe.tokens))]
        gc.disable()  # millions of small tuples without cycles; looking through them again and again doubles the time
        for batch in batches:
            counts, lists, of_ids, of_bytes = [], [], [], []
            for tokens in bpe.encode_all(batch.column(len(keep))):
                counts.append(len(tokens))
                if ids:
                    lists.append(tokens)
                if digests:
                    of_ids.append(hashlib.sha256(" ".join(map(decimal.__getitem__, tokens)).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(bpe.decode(tokens)).hexdigest())
            columns = [batch.column(i) for i in range(len(keep))] + [pa.array(counts, pa.int64())]
            columns += [pa.array(lists, pa.list_(pa.int32()))] if ids else []
            columns += [pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())] if digests else []
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *new])
        gc.enable()

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, ranks: bytes, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids stand for; bytes that aren't UTF-8 become U+FFFD, null ids a null text. An input
    column with the name ``out`` gives way to it."""
    keep = [c for c in df.columns if c != out]
    rows = df.select(*[f"`{c}`" for c in keep])
    at = keep.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = read_ranks(ranks)
        tokens = sorted(known, key=known.__getitem__)
        for batch in batches:
            texts = [None if v.as_py() is None else b"".join(tokens[i] for i in v.as_py()).decode("utf-8", "replace") for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*keep, out])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out, T.StringType())]))
