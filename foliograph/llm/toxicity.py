"""Toxicity by a classifier chain: categories are predicted one after the other, and each later linear model sees the
probabilities of the earlier categories. In training these probabilities are out of fold, so that a model learns to
use them as good as they are on texts not seen before. A fold's vocabulary, too, is chosen without the fold's labels, and
texts that are alike but for case and other characters than letters are in one fold.

Features: presence of words and, for forms not seen in training, of stems (a word's first letters) that one or that
several words of the text have, from lower-cased runs of letters. Each category's vocabulary is chosen in training by how
much more or less often than elsewhere a feature occurs in its texts. The models are logistic regressions fitted by Newton
steps on the driver.

Training reads a bounded sample: at most ``SAMPLE`` labelled documents (half of them with some positive label where there
are as many) of at most ``SAMPLE_CHARS`` characters each, those with the smallest hashes of their ids; so it learns nothing from
longer texts, which are scored like others. A row of labels with a null is left out; of a document's labels that
contradict each other the largest value counts, and of several texts of one ``doc_id`` the smallest one is learned from.

Results for special cases: a null or empty text has no features and gets each model's base rate; rows whose text has no
label are scored like others; with a category that has only one value in the sample, its probability is that value;
repeated rows give repeated results; an empty table gives an empty one; other columns are dropped.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import least_hashes

SAMPLE = 5000
SAMPLE_CHARS = 8_000
#: Size of a category's vocabulary, and in how many documents of the sample a feature must occur.
VOCABULARY, LEAST = 500, 4
#: Least G statistic of a feature.
GAIN = 15.0
#: Lengths of the stems.
STEMS = (4, 5, 6, 7)
#: Hashed features that are counted together at first.
BUCKETS = 1 << 20
FOLDS = 3
#: Weight of the squared coefficients in the fit.
RIDGE = 0.1
WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[str]:
    words = set(WORD.findall((text or "").lower()))
    stems = Counter(w[:n] for n in STEMS for w in words if len(w) >= n)
    return words.union([s + "-" for s in stems], [s + "--" for s, n in stems.items() if n > 1])


def fold_of(text: str, folds: int = FOLDS) -> int:
    """The fold of a text, by its words."""
    return zlib.crc32(" ".join(WORD.findall(text.lower())).encode()) % folds


class FeatureSets:
    """The feature sets of texts, made anew each time they are gone through: only one is in memory."""

    def __init__(self, texts: list[str]):
        self.texts = texts

    def __len__(self) -> int:
        return len(self.texts)

    def __iter__(self) -> Iterator[set[str]]:
        return map(features, self.texts)


def g_statistic(total: np.ndarray, within: np.ndarray, n: float, m: float) -> np.ndarray:
    """Of features in ``total`` of n texts, ``within`` of them among the m texts of a category."""
    g = np.zeros(len(total))
    for seen, with_it, of in ((within, total, m), (total - within, total, n - m), (m - within, n - total, m), (n - m - total + within, n - total, n - m)):
        g += 2 * seen * np.log(np.maximum(seen, 1e-9) / np.maximum(with_it * of / max(n, 1), 1e-9))
    return g


class Chooser:
    """Features by how much their frequencies differ between a category's texts and the rest. Counts of hashed features
    leave out most of them (and now and then one that shares its hash with a common one); only the rest are counted by
    themselves. ``parts`` numbers the texts' folds: every choice is made
    from counts of the texts outside one fold, or of all texts."""

    def __init__(self, sets: Iterable[set[str]], labels: np.ndarray, parts: np.ndarray, folds: int, size: int = VOCABULARY, least: int = LEAST, gain: float = GAIN):
        self.labels, self.parts, self.size, self.least, self.gain = labels, parts, size, least, gain
        categories = labels.shape[1]
        place = lambda f: zlib.crc32(f.encode()) & (BUCKETS - 1)
        counts = np.zeros((folds, 1 + categories, BUCKETS), np.float32)
        for s, y, part in zip(sets, labels, parts):
            at = np.unique(np.fromiter(map(place, s), np.int64, len(s)))
            counts[np.ix_([part], [0, *(np.flatnonzero(y) + 1)], at)] += 1
        open_ = np.zeros(BUCKETS, bool)
        for left_out in (None, *range(folds)):
            n, m = self.sizes(left_out)
            total, *within = counts.sum(0) - (0 if left_out is None else counts[left_out])
            for own, of in zip(within, m):
                open_ |= (total >= least) & (g_statistic(total, own, n, of) >= gain)
        del counts
        self.kept = [[f for f in s if open_[place(f)]] for s in sets]
        self.names = sorted(f for f, c in Counter(itertools.chain.from_iterable(self.kept)).items() if c >= least)
        self.x = matrix(self.kept, self.names)

    def sizes(self, left_out: int | None) -> tuple[int, np.ndarray]:
        rows = self.parts != (-1 if left_out is None else left_out)
        return int(rows.sum()), self.labels[rows].sum(0)

    def choose(self, category: int, left_out: int | None = None) -> list[int]:
        """The places in ``names`` of a category's features, best first, told by the texts outside the fold ``left_out``."""
        rows = self.parts != (-1 if left_out is None else left_out)
        n, m = self.sizes(left_out)
        total = self.x[rows].sum(0, dtype=np.float64)
        within = self.x[rows & (self.labels[:, category] > 0)].sum(0, dtype=np.float64)
        # rounded, so that features alike are told apart by their names
        g = np.where(total >= self.least, g_statistic(total, within, n, m[category]), 0.0).round(6)
        order = np.lexsort((np.arange(len(g)), -g))[: self.size]
        return [int(i) for i in order if g[i] >= self.gain]


def matrix(sets: Iterable[Iterable[str]], vocabulary: list[str]) -> np.ndarray:
    at = {f: i for i, f in enumerate(vocabulary)}
    rows = [[at[f] for f in s if f in at] for s in sets]
    x = np.zeros((len(rows), len(vocabulary)), np.float32)
    for row, own in enumerate(rows):
        x[row, own] = 1
    return x


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 20) -> np.ndarray:
    """Logistic regression: coefficients, the last one the intercept (which isn't penalised)."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    if len(y) == 0 or y.min() == y.max():
        w = np.zeros(x.shape[1])
        w[-1] = 30 if len(y) and y.max() else -30
        return w
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + (penalty * w * w).sum() / 2)

    now = loss(w)
    for _ in range(steps):
        p = sigmoid(x @ w)
        s = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * s[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        while (after := loss(w + step)) > now and np.abs(step).max() > 1e-4:
            step /= 2
        w, gained, now = w + step, now - after, after
        if gained < 1e-6 * abs(now):
            break
    return w


class Chain:
    """Category k's model: features, probabilities of the categories before it, intercept."""

    def __init__(self, categories: list[str], vocabulary: list[str], weights: list[np.ndarray], thresholds: list[float]):
        self.categories, self.vocabulary, self.weights, self.thresholds = categories, vocabulary, weights, thresholds

    @classmethod
    def train(cls, sets: Iterable[set[str]], labels: np.ndarray, categories: list[str], parts: np.ndarray | None = None, folds: int = FOLDS) -> Chain:
        """``parts``: the fold (0 to ``folds`` - 1) of each text; by position if not given."""
        parts = np.arange(len(labels)) % folds if parts is None else parts
        chooser = Chooser(sets, labels, parts, folds)
        weights, thresholds, chosen, earlier = [], [], [], np.zeros((len(labels), 0), np.float32)
        for k, y in enumerate(labels.T):
            # a category's model sees its own features and the earlier categories' probabilities
            out = np.zeros(len(y))
            for part in range(folds):
                own, test = chooser.choose(k, part), parts == part
                if test.any():
                    x = np.hstack([chooser.x[:, own], earlier])
                    w = fit(x[~test], y[~test])
                    out[test] = sigmoid(x[test] @ w[:-1] + w[-1])
            own = chooser.choose(k)
            chosen.append(own)
            weights.append(fit(np.hstack([chooser.x[:, own], earlier]), y))
            thresholds.append(threshold(out, y))
            earlier = np.hstack([earlier, out[:, None].astype(np.float32)])
        known = sorted({i for own in chosen for i in own})
        at, full = {i: n for n, i in enumerate(known)}, []
        for k, (own, w) in enumerate(zip(chosen, weights)):
            wide = np.zeros(len(known) + k + 1)
            wide[[*(at[i] for i in own), *range(len(known), len(known) + k + 1)]] = w
            full.append(wide)
        return cls(categories, [chooser.names[i] for i in known], full, thresholds)

    def reader(self):
        """A function of texts that gives those of their features that the chain knows. Only words that begin like a known
        stem are looked at for stems."""
        known = set(self.vocabulary)
        heads = {f[: STEMS[0]] for f in known if f.endswith("-")}

        def read(text: str | None) -> set[str]:
            words = set(WORD.findall((text or "").lower()))
            near = [w for w in words if w[: STEMS[0]] in heads]
            return (words | features(" ".join(near))) & known if near else words & known

        return read

    def scorer(self):
        """A function of feature sets that gives a probability for each category."""
        at, n = {f: i for i, f in enumerate(self.vocabulary)}, len(self.vocabulary)
        known, sums = set(at), np.array([w[:n] for w in self.weights]).reshape(len(self.weights), n)

        def score(sets: list[set[str]]) -> np.ndarray:
            out = np.zeros((len(sets), len(self.weights)))
            for row, s in enumerate(sets):
                out[row] = sums[:, [at[f] for f in s & known]].sum(1)
            for k, w in enumerate(self.weights):
                out[:, k] = sigmoid(out[:, k] + out[:, :k] @ w[n : n + k] + w[-1])
            return out

        return score


def threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Half way between the scores around the cut with the best F1; 0.5 where all cuts are alike."""
    if len(y) == 0 or y.min() == y.max():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    ends = np.append(np.diff(p[order]) != 0, True)  # equal scores are on one side
    at = int(np.argmax(np.where(ends, f1, -1)))
    below = p[order][at + 1] if at + 1 < len(p) else 0.0
    return float(np.clip((p[order][at] + below) / 2, 0.05, 0.8))


def sample(docs: DataFrame, labels: DataFrame, categories: list[str], size: int, text: str, id: str) -> list[tuple[str, list[float]]]:
    """At most ``size`` labelled texts. Ids are chosen from the labels alone, so only the chosen texts are gathered."""
    values = labels.select(F.col("doc_id").alias("__id"), *[F.expr(c).cast("double").alias(f"c{i}") for i, c in enumerate(categories)]).dropna()
    known = values.groupBy("__id").agg(*[F.max(f"c{i}").alias(f"c{i}") for i in range(len(categories))])
    known = known.withColumn("h", F.xxhash64(F.lit("toxicity"), "__id")).withColumn("any", F.greatest(F.lit(0.0), *[F.col(f"c{i}") for i in range(len(categories))]) > 0)
    sizes = known.agg(F.count_if("any").alias("yes"), F.count_if(~F.col("any")).alias("no")).first()

    def some(rows: DataFrame, of: int) -> DataFrame:
        return rows.where(least_hashes(F.col("h"), size // 2, F.lit(of))).orderBy("h", "__id").limit(size // 2)

    half = some(known.where("any"), sizes["yes"]).union(some(known.where("not any"), sizes["no"]))
    chosen = docs.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{text}`").alias("text")).where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(half), "__id")
    rows = chosen.groupBy("h", "__id", *[f"c{i}" for i in range(len(categories))]).agg(F.min("text").alias("text")).collect()
    return [(r["text"], [r[f"c{i}"] for i in range(len(categories))]) for r in sorted(rows, key=lambda r: (r["h"], str(r["__id"])))]


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], size: int = SAMPLE, text: str = "text", id: str = "doc_id") -> Chain:
    """``categories``: names and, as SQL over ``labels``, their 0/1 values, in the order of the chain."""
    rows = sample(docs, labels, list(categories.values()), size, text, id)
    y = np.array([r[1] for r in rows], float).reshape(len(rows), len(categories))
    texts = [r[0] for r in rows]
    parts = np.array([fold_of(t) for t in texts], np.int64)
    return Chain.train(FeatureSets(texts), y, list(categories), parts)


def classify(docs: DataFrame, chain: Chain, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``doc_id`` and for each category its probability and whether it reaches the category's threshold."""
    schema = "doc_id long, " + ", ".join(f"p_{c} double, {c} boolean" for c in chain.categories)
    names = [n for c in chain.categories for n in (f"p_{c}", c)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, score = chain.reader(), chain.scorer()
        for batch in batches:
            p = score([read(v.as_py()) for v in batch.column(1)])
            columns = [x for k, t in enumerate(chain.thresholds) for x in (pa.array(p[:, k]), pa.array(p[:, k] >= t))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    return docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)


def reject(docs: DataFrame, chain: Chain, category: str, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that don't reach the threshold of ``category``."""
    at, k = docs.columns.index(text), chain.categories.index(category)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, score = chain.reader(), chain.scorer()
        for batch in batches:
            p = score([read(v.as_py()) for v in batch.column(at)])
            yield batch.filter(pa.array(p[:, k] < chain.thresholds[k]))

    return docs.mapInArrow(run, docs.schema)
