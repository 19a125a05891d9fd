"""Language identification with a string kernel.

Kernel. k(x, y) is the number of character n-grams (n = 1 to ``NGRAM``) that both texts contain, divided by the geometric
mean of how many each contains: a blended spectrum of presence bits. Texts are lower-cased; letters of any script are
themselves, everything else is one space. An n-gram's bit is its hash, one of ``BITS``, so no letter is left out.

Model. ``LANDMARKS`` texts of the sample (one of each language at least) give Nystroem features K(x, Z) K(Z, Z)^(-1/2); on
them, a kernel ridge regression for each language against the rest. Scoring multiplies a batch of presence bits with the
landmarks' bits and these with the weights. The score is the softmax of the regression values at ``SHARP``.

Training reads a bounded sample of whole texts of every language: ``PER_LANGUAGE`` texts of each, or fewer (one at least)
so that there are about ``SAMPLE``. Those with the smallest hashes are taken, texts of at most ``SAMPLE_CHARS`` characters
before longer ones and these by their length, while a language's texts have ``SAMPLE_CHARS`` characters each on average;
the first one is taken at any length. So what is gathered grows with the number of languages, not with the corpus.

Results for special cases: a text that is null or has no letter is ``und`` with score 0; without any training row, all
are; rows with a null language, text or ``doc_id`` aren't learned from; rows alike in id, text and language are learned
from once; equal scores go to the language first in alphabetical order; repeated rows give repeated results; an empty
table gives an empty one; other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import least_hashes, written

NGRAM = 3
#: Presence bits; a power of two.
BITS = 1 << 18
PER_LANGUAGE, SAMPLE, SAMPLE_CHARS = 300, 4800, 10_000
LANDMARKS = 160
RIDGE = 0.1
SHARP = 8.0
#: Characters of a text that are looked at together; n-grams across the seams count too.
CHUNK = 1_000_000
#: Texts in one matrix product.
BATCH = 32
UNDETERMINED = "und"

_LOW = np.array([chr(c).isalpha() for c in range(0x3000)])
#: An odd factor for each length of n-gram; three code points of 21 bits fit into 64.
_MIX = np.random.default_rng(7).integers(0, 1 << 63, NGRAM, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = np.uint64(64 - BITS.bit_length() + 1)


def symbols(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, that of a space for everything else."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    known = _LOW[np.minimum(codes, 0x2FFF)]
    if (high := codes >= 0x3000).any():
        distinct, at = np.unique(codes[high], return_inverse=True)
        known[high] = np.array([chr(c).isalpha() for c in distinct])[at]
    return np.where(known, codes, 32).astype(np.uint64)


def presence(text: str, bits: np.ndarray) -> bool:
    """Set ``bits`` (zeros before) for each n-gram of the text; whether it has a letter."""
    letters = False
    for at in range(0, max(len(text), 1), CHUNK):
        grams = s = symbols(text[max(0, at - NGRAM + 1) : at + CHUNK])
        letters = letters or bool((s != 32).any())
        for n in range(NGRAM):
            bits[((grams * _MIX[n]) >> _SHIFT).view(np.int64)] = 1
            grams = (grams[:-1] << np.uint64(21)) + s[n + 1 :]
    return letters


class Model:
    def __init__(self, languages: list[str], columns: np.ndarray, landmarks: np.ndarray, weights: np.ndarray):
        self.languages, self.columns, self.landmarks, self.weights = languages, columns, landmarks, weights

    @classmethod
    def train(cls, rows: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
        """``rows``: text and language, in a fixed order."""
        found, languages = [], []
        bits = np.zeros(BITS, np.uint8)
        for text, language in rows:
            if presence(text, bits):
                found.append(np.flatnonzero(bits).astype(np.int32))
                languages.append(language)
            bits[:] = 0
        if not found:
            return None
        names = sorted(set(languages))
        own: dict[str, list[int]] = {}
        for i, language in enumerate(languages):
            own.setdefault(language, []).append(i)
        each = max(1, landmarks // len(names))
        chosen = [found[i] for name in names for i in own[name][:each]]
        columns = np.unique(np.concatenate(chosen))

        def normed(sets: list[np.ndarray]) -> np.ndarray:
            out = np.zeros((len(sets), len(columns)), np.float32)
            for row, s in zip(out, sets):
                row[np.searchsorted(columns, np.intersect1d(s, columns, assume_unique=True))] = 1 / np.sqrt(len(s))
            return out

        z = normed(chosen)
        values, vectors = np.linalg.eigh(z @ z.T)
        good = values > 1e-5
        root = vectors[:, good] / np.sqrt(values[good])
        kernel = np.vstack([normed(found[i : i + 256]) @ z.T for i in range(0, len(found), 256)])
        phi = np.hstack([kernel @ root, np.ones((len(found), 1))])
        y = np.where(np.array(languages)[:, None] == np.array(names), 1.0, -1.0)
        penalty = np.eye(phi.shape[1]) * ridge
        w = np.linalg.solve(phi.T @ phi + penalty, phi.T @ y)
        weights = np.vstack([root @ w[:-1], w[-1:]]).astype(np.float32)
        return cls(names, columns, z.T.copy(), weights)

    def values(self, texts: list[str | None]) -> tuple[np.ndarray, list[bool]]:
        """The regression value of each text for each language, and which texts have a letter."""
        batch, sizes, has = np.zeros((len(texts), len(self.columns)), np.float32), np.ones(len(texts)), []
        bits = np.zeros(BITS, np.uint8)
        for i, text in enumerate(texts):
            has.append(presence(text or "", bits))
            batch[i] = bits[self.columns]
            sizes[i] = max(1, np.count_nonzero(bits))
            bits[:] = 0
        kernel = batch @ self.landmarks / np.sqrt(sizes)[:, None]
        return kernel @ self.weights[:-1] + self.weights[-1], has

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text."""
        values, has = self.values(texts)
        share = np.exp(SHARP * (values - values.max(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        best = share.argmax(1)
        return [(self.languages[b], float(p[b])) if ok else (UNDETERMINED, 0.0) for b, p, ok in zip(best, share, has)]


def sample(docs: DataFrame, text: str = "text", id: str = "doc_id", lang: str = "lang", each: int = PER_LANGUAGE, size: int = SAMPLE, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """The training sample of ``docs``, all of which may be learned from."""
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where("id is not null and text is not null and lang is not null")
    counts = written(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    each = max(1, min(each, size // max(1, counts.count())))
    # rows are chosen by hashes, among few in each task, before any text is gathered
    hashed = rows.select("id", "lang", F.length("text").alias("size"), F.xxhash64(F.lit("langid"), "id", "text").alias("h")).join(counts, "lang")
    likely = hashed.where(least_hashes(F.col("h"), each, F.col("n"))).groupBy("lang", "id", "h").agg(F.max("size").alias("size"))
    order = Window.partitionBy("lang").orderBy(F.greatest("size", F.lit(chars)), "h", "id")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    ranked = likely.withColumn("k", F.row_number().over(order)).withColumn("chars", before)
    chosen = written(ranked.where((F.col("k") == 1) | (F.col("k") <= each) & (F.col("chars") <= F.lit(each) * chars)).select("id", "lang", "h"), "sample")
    texts = rows.withColumn("h", F.xxhash64(F.lit("langid"), "id", "text")).join(chosen, ["id", "lang", "h"])
    found = texts.groupBy("lang", "h", "id").agg(F.min("text").alias("text")).collect()
    return [(r["text"], r["lang"]) for r in sorted(found, key=lambda r: (r["h"], str(r["id"]), r["lang"]))]


def identify(docs: DataFrame, model: Model | None, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.score if model else lambda texts: [(UNDETERMINED, 0.0)] * len(texts)
        for batch in batches:
            found = []
            for at in range(0, len(batch), BATCH):
                found += score(batch.column(1).slice(at, BATCH).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
