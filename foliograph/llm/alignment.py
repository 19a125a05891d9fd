"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Python only tokenises. A chunk of texts is cut at lone spaces and line feeds, which end a token of either tokenizer, and each
distinct part of a chunk is tokenised once, many in one call: two arrays of ids and two of byte offsets at which the tokens end.
All else is Spark's array functions. Where both tokenizers end their tokens alike, each token is a group with its twin. Offsets where tokens of both end, ``array_intersect``, cut a part into groups, whose tokens are looked up by their
ends; ``sequence`` and ``transform`` list the links, and ``transform`` and ``aggregate`` put together each text's groups, links
and sums. In a part of more than ``FEW`` tokens, how many ends of one array lie below each of another's is read off their
sorted union, so that every token finds its group and the first and last token that overlaps it without a search: n tokens
cost n log n. Either way gives the same rows.

The links' counts over all texts are summed before they are shuffled. To look a pair's count up, the pairs met most often,
``MOST`` at most, are broadcast, and only links of rarer pairs are shuffled to theirs: no pair is met by more than its rare
share of links there. A chunk is bounded by its characters (or one text's, if that is longer).

Results for special cases: a text that is null or empty, or whose tokens' bytes aren't a space and the text's own, has no
tokens, zeros and the groups ''. Ids of documents, null or repeated, are carried along: each row has its own result. Other
columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import SPACED_PATTERN
from .common import written

#: Characters of text in a chunk.
CHUNK = 2_000_000
#: Tokens of a part that are looked up one by one.
FEW = 64
#: Pairs whose counts are broadcast (some 50 bytes each).
MOST = 2_000_000
#: A pair of ids as one number: the first times this, plus the second.
PAIR = 1 << 32
#: What keeps a text whole: white space other than lone spaces and line feeds between words, and marks used for cutting.
WHOLE = "^[ \n]|[ \n]$|[ \n][ \n]|[\t\x0b\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u2581\0]"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen, else the next free one."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokens:
    """A byte-level tokenizer's file. Where its merges are in the order of their tokens' ids, these are ranks, and the faster
    library for ranks gives the same ids."""

    #: Parts that are encoded as one text.
    BLOCK = 4096

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has dealt out the cores
        import json

        import tiktoken

        rules = json.loads(definition)
        letters, vocabulary, own = byte_letters(), rules["model"]["vocab"], rules.get("pre_tokenizer") or {}
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.pieces[i] = bytes(letters[c] for c in piece if c in letters)
        #: Whether the tokenizer treats each match of the pattern by itself.
        self.apart = not rules.get("normalizer") and own.get("type") == "ByteLevel" and own.get("use_regex") and not own.get("add_prefix_space")
        merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in rules["model"]["merges"]]
        if self.apart and merged == sorted(set(merged)) and len(merged) + 256 == len(vocabulary):
            encode = tiktoken.Encoding("own", pat_str=SPACED_PATTERN, mergeable_ranks={p: i for i, p in enumerate(self.pieces)}, special_tokens={}).encode_ordinary
            self.encode = lambda parts: list(map(encode, parts))
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_str(definition)
            tokenizer.encode_special_tokens = True
            self.encode = lambda parts: [e.ids for e in tokenizer.encode_batch_fast(parts, add_special_tokens=False)]


class PieceTokens:
    """A sentencepiece model that puts a space before a text."""

    #: Parts that are encoded as one text; it sorts a text's pairs of pieces, so longer ones cost more.
    BLOCK = 32

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pieces = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in names]
        #: Whether no token goes on past the end of a word or across a line feed, and texts are taken as they are.
        self.apart = not any(re.search("[^▁]▁|\n", p) for p in names) and self.model.normalize("ﬁ  ² a") == "▁ﬁ▁▁²▁a"

    def encode(self, parts: list[str]) -> list[list[int]]:
        """A part begins with a space, which the model adds itself, or with a line feed, before which it adds one too many."""
        found = self.model.encode([p.removeprefix(" ") for p in parts], num_threads=1)
        return [ids if p[0] == " " else ids[1:] for p, ids in zip(parts, found)]


class Pair:
    """The tokens of both tokenizers for distinct parts of texts."""

    def __init__(self, definition: str, model: bytes):
        self.both = ByteTokens(definition), PieceTokens(model)
        self.pieces = [pa.array(t.pieces, pa.large_binary()) for t in self.both]
        self.lengths = [np.array([len(p) for p in t.pieces], np.int64) for t in self.both]
        self.apart = all(t.apart for t in self.both)

    def tokens(self, parts: pa.Array) -> list[list[np.ndarray]]:
        """Runs of the parts with, for either tokenizer, the run's ids and how many of them each part and those before it have.
        Parts are encoded many at a time. Where the tokens' bytes aren't the run's, its halves are runs; a single such part
        has no tokens."""
        data = b"".join(parts.cast(pa.large_binary()).to_pylist())
        ends, found = np.cumsum(pc.binary_length(parts).to_numpy()), []
        for tokens, pieces, lengths in zip(self.both, self.pieces, self.lengths):
            cuts = [0, *ends[tokens.BLOCK - 1 : -1 : tokens.BLOCK].tolist(), len(data)]
            ids = np.fromiter(chain.from_iterable(tokens.encode([data[i:j].decode() for i, j in zip(cuts, cuts[1:])])), np.int32)
            own = np.cumsum(lengths[ids])
            until = np.searchsorted(own, ends)
            if not len(own) or own[-1] != len(data) or (own[until] != ends).any() or pieces.take(pa.array(ids)).buffers()[2].to_pybytes() != data:
                half = len(parts) // 2
                return self.tokens(parts[:half]) + self.tokens(parts[half:]) if half else [[np.zeros(n, np.int32) for n in (0, 1, 0, 1)]]
            found += [ids, until + 1]
        return [found]

    def chunk(self, doc_ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        """One row: the distinct ``parts`` with their tokens, and the ``docs`` as places among them."""
        column = pa.array(texts, pa.large_string())
        space, none = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
        empty = pc.equal(column, none).to_numpy(zero_copy_only=False)
        whole = ~empty & (pc.match_substring_regex(column, WHOLE).to_numpy(zero_copy_only=False) if self.apart else True)
        marked = pc.replace_substring(pc.replace_substring(pc.if_else(pa.array(whole), none, column), " ", "\0 "), "\n", "\0\n")
        cut = pc.split_pattern(pc.binary_join_element_wise(space, marked, none), "\0")
        counts, flat = pc.list_value_length(cut).to_numpy(), cut.flatten()
        firsts, uncut, kept = np.cumsum(counts) - counts, np.zeros(len(flat), bool), np.ones(len(flat), bool)
        uncut[firsts[whole]], kept[firsts[empty]] = True, False
        flat = pc.replace_with_mask(flat, pa.array(uncut), pc.binary_join_element_wise(space, column.filter(pa.array(whole)), none))
        coded = flat.filter(pa.array(kept)).dictionary_encode()
        places = coded.indices.to_numpy()
        of_doc = np.repeat(np.arange(len(texts)), counts)[kept]
        # parts cut from texts come first and are encoded together, those that are texts are encoded one by one
        alone = np.zeros(len(coded.dictionary), bool)
        alone[places[uncut[kept]]] = True
        order = np.argsort(alone, kind="stable")
        places, together = np.argsort(order)[places], len(alone) - alone.sum()
        parts = coded.dictionary.take(pa.array(order))
        runs = self.tokens(parts[:together]) if together else []
        for at in range(together, len(parts)):
            runs += self.tokens(parts[at : at + 1])
        arrays, sizes, numbers = [], [], []
        for k, lengths in enumerate(self.lengths):
            ids = np.concatenate([np.zeros(0, np.int32), *(run[2 * k] for run in runs)])
            sizes.append(np.concatenate([np.zeros(0, np.int64), *(np.diff(run[2 * k + 1], prepend=0) for run in runs)]))
            bounds, ends = np.cumsum([0, *sizes[-1]]), np.cumsum([0, *lengths[ids]])
            ends = ends[1:] - np.repeat(ends[bounds[:-1]], sizes[-1])
            arrays += [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(v.astype(np.int32))) for v in (ids, ends)]
        fit = ~np.isin(of_doc, of_doc[sizes[0][places] == 0])
        places, of_doc = places[fit], of_doc[fit]
        for own in sizes:
            numbers.append(pa.array(np.bincount(of_doc, own[places], len(texts)).astype(np.int64)))
        bounds = np.cumsum([0, *np.bincount(of_doc, minlength=len(texts))]).astype(np.int32)
        docs = pa.StructArray.from_arrays([doc_ids, pa.ListArray.from_arrays(pa.array(bounds), pa.array(places.astype(np.int32))), *numbers], ["doc_id", "places", "n_a", "n_b"])
        rows = pa.StructArray.from_arrays(arrays, ["a_ids", "a_ends", "b_ids", "b_ends"])
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (rows, docs)], names=["parts", "docs"])


def tokenised(df: DataFrame, definition: str, model: bytes, text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Rows of ``chunk`` characters of text: distinct ``parts`` (a_ids, a_ends, b_ids, b_ends) and ``docs`` (doc_id,
    places among the parts, n_a, n_b)."""
    rows = df.select("doc_id", F.col(f"`{text}`").alias("text"))
    numbers = T.ArrayType(T.IntegerType(), False)
    parts = T.StructType([T.StructField(c, numbers) for c in ("a_ids", "a_ends", "b_ids", "b_ends")])
    docs = T.StructType([rows.schema["doc_id"], T.StructField("places", numbers), T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType())])
    schema = T.StructType([T.StructField("parts", T.ArrayType(parts)), T.StructField("docs", T.ArrayType(docs))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, ids, texts, size = Pair(definition, model), [], [], 0
        for batch in batches:
            first = 0
            for at, value in enumerate(batch.column(1)):
                texts.append(value.as_py() or "")
                size += len(texts[-1])
                if size >= chunk:
                    yield pair.chunk(pa.concat_arrays([*ids, batch.column(0).slice(first, at + 1 - first)]), texts)
                    ids, texts, size, first = [], [], 0, at + 1
                    pa.default_memory_pool().release_unused()
            ids.append(batch.column(0).slice(first))
        if texts:
            yield pair.chunk(pa.concat_arrays(ids), texts)
        del pair  # the worker stays for other tasks
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, schema)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of ``value``, which is worked out once, however often and in whatever function ``then`` asks for it (``aggregate``
    doesn't copy its result, as ``transform`` does)."""
    return F.aggregate(F.array(), value, lambda kept, _: kept, then)


def union(these: Column, those: Column) -> Column:
    """Two ascending arrays as one, a number from ``these`` doubled, one from ``those`` doubled and one more."""
    return F.sort_array(F.concat(F.transform(these, lambda x: x * F.lit(2).cast("bigint")), F.transform(those, lambda x: x * F.lit(2).cast("bigint") + 1)))


def below(these: Column, those: Column) -> Column:
    """For each of these how many of those are less: its place in the union among all, less its place among its own."""
    places = F.filter(F.transform(union(these, those), lambda x, place: F.when(x % 2 == 0, place)), lambda place: place.isNotNull())
    return F.transform(places, lambda place, own: place - own)


def pair_of(a: Column, b: Column) -> Column:
    return a.cast("bigint") * F.lit(PAIR) + b


def b_of(pair: Column) -> Column:
    return pair.bitwiseAND(F.lit(PAIR - 1))


def text_of(ids: Column, since: Column, until: Column) -> Column:
    """The ids at these places, joined by commas."""
    return F.when(since == until, ids[until].cast("string")).otherwise(F.array_join(F.transform(F.sequence(since, until), lambda i: ids[i].cast("string")), ","))


def looked_up(part: Column) -> Column:
    """``aligned`` of a part of few tokens."""
    a, b, a_ends, b_ends = part["a_ids"], part["b_ids"], part["a_ends"], part["b_ends"]

    def bounds(ends: Column) -> Column:
        def group(end: Column, g: Column) -> Column:
            since = lambda c: F.when(g == 0, 0).otherwise(ends[g - 1][c])
            return F.struct(since("i").alias("i"), (end["i"] - 1).alias("i_"), since("j").alias("j"), (end["j"] - 1).alias("j_"))

        return F.transform(ends, group)

    def until(cut: Column) -> Column:
        """How many tokens end at the cut or before."""
        return F.struct(*[F.array_position(ends, cut).cast("int").alias(c) for c, ends in (("i", a_ends), ("j", b_ends))])

    def links(g: Column) -> Column:
        begin = lambda ends, k: F.when(k == 0, 0).otherwise(ends[k - 1])
        meet = lambda i: F.filter(F.sequence(g["j"], g["j_"]), lambda j: (begin(b_ends, j) < a_ends[i]) & (begin(a_ends, i) < b_ends[j]))
        one_a, one_b = g["i"] == g["i_"], g["j"] == g["j_"]
        return (
            F.when(one_a & one_b, F.array(pair_of(a[g["i"]], b[g["j"]])))
            .when(one_a, F.transform(F.sequence(g["j"], g["j_"]), lambda j: pair_of(a[g["i"]], b[j])))
            .when(one_b, F.transform(F.sequence(g["i"], g["i_"]), lambda i: pair_of(a[i], b[g["j"]])))
            .otherwise(F.flatten(F.transform(F.sequence(g["i"], g["i_"]), lambda i: F.transform(meet(i), lambda j: pair_of(a[i], b[j])))))
        )

    def found(groups: Column) -> Column:
        texts = F.transform(groups, lambda g: F.concat(text_of(a, g["i"], g["i_"]), F.lit("|"), text_of(b, g["j"], g["j_"])))
        return F.struct(F.size(groups).alias("n_groups"), F.array_join(texts, ";").alias("groups"), F.flatten(F.transform(groups, links)).alias("links"))

    return let(F.transform(F.array_intersect(a_ends, b_ends), until), lambda ends: let(bounds(ends), found))


def aligned(part: Column, few: int = FEW) -> Column:
    """Of a part (a_ids, a_ends, b_ids, b_ends): ``n_groups``, ``groups`` ('a1,a2|b1;a3|b2,b3') and ``links``, pairs of ids of
    tokens that overlap."""
    a, b, a_ends, b_ends = part["a_ids"], part["b_ids"], part["a_ends"], part["b_ends"]

    def placed(cuts: Column, last: Column, ending: Column) -> Column:
        """``last``: of each token of a the last overlapping one of b. ``ending``: of each cut the token of a that ends there."""

        def first(i: Column) -> Column:
            before = last[i - 1]
            return F.when(i == 0, 0).otherwise(before + F.when(b_ends[before] == a_ends[i - 1], 1).otherwise(0))

        def linked(id_: Column, i: Column) -> Column:
            return F.transform(F.sequence(first(i), last[i]), lambda j: pair_of(id_, b[j]))

        def group(i: Column, g: Column) -> Column:
            since = lambda x: F.when(g == 0, 0).otherwise(x + 1)
            return F.concat(text_of(a, since(ending[g - 1]), i), F.lit("|"), text_of(b, since(last[ending[g - 1]]), last[i]))

        return F.struct(F.size(cuts).alias("n_groups"), F.array_join(F.transform(ending, group), ";").alias("groups"), F.flatten(F.transform(a, linked)).alias("links"))

    def joined(ids: Column) -> Column:
        return F.array_join(F.transform(ids, lambda i: i.cast("string")), ",")

    # tokens that all end alike are a group each
    alike = F.struct(
        F.size(a).alias("n_groups"), F.array_join(F.zip_with(a, b, lambda i, j: F.concat(i.cast("string"), F.lit("|"), j.cast("string"))), ";").alias("groups"),
        F.zip_with(a, b, pair_of).alias("links"),
    )
    # one token of either tokenizer overlaps all of the other's
    alone = F.struct(
        F.lit(1).alias("n_groups"), F.concat(joined(a), F.lit("|"), joined(b)).alias("groups"),
        F.when(F.size(a) == 1, F.transform(b, lambda j: pair_of(a[0], j))).otherwise(F.transform(a, lambda i: pair_of(i, b[0]))).alias("links"),
    )
    cuts = F.array_intersect(a_ends, b_ends)
    several = let(cuts, lambda cuts: let(below(a_ends, b_ends), lambda last: let(below(cuts, a_ends), lambda ending: placed(cuts, last, ending))))
    return F.when(a_ends == b_ends, alike).when((F.size(a) == 1) | (F.size(b) == 1), alone).when(F.size(a) + F.size(b) <= few, looked_up(part)).when(F.size(a) > 1, several)


def align(chunks: DataFrame, digests: bool = False, few: int = FEW) -> DataFrame:
    """For each document doc_id, ``row``, n_a, n_b, ``n_groups``, ``groups`` (or their SHA-256, if there are any) and all
    ``links``."""
    kept = [f.name for f in chunks.schema["docs"].dataType.elementType if f.name != "places"]

    def rows(found: Column) -> Column:
        def doc(d: Column) -> Column:
            groups = F.array_join(F.transform(d["places"], lambda p: found[p]["groups"]), ";")
            groups = F.when(F.size(d["places"]) == 0, "").otherwise(F.sha2(groups, 256) if digests else groups)
            links = F.flatten(F.transform(d["places"], lambda p: found[p]["links"]))
            return F.struct(*[d[c].alias(c) for c in kept], groups.alias("groups"), links.alias("links"))

        return F.transform("docs", doc)

    docs = chunks.select(F.inline(let(F.transform("parts", lambda p: aligned(p, few)), rows)))
    # a group's tokens overlap in one place less than they are
    n_groups = F.col("n_a") + F.col("n_b") - F.size("links")
    return docs.select(*kept, n_groups.alias("n_groups"), "groups", "links").withColumn("row", F.monotonically_increasing_id())


def pair_counts(rows: DataFrame) -> DataFrame:
    """Of ``align`` rows: ``pair``, ``n`` links that hold it in all texts, ``best``: whether no pair of its b id has more."""
    counted = rows.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    return counted.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(b_of(F.col("pair")))))


def scores(rows: DataFrame, pairs: DataFrame, most: int = MOST) -> DataFrame:
    """``row``, ``n_links``, ``n_best`` and ``count_sum`` of written ``align`` rows that have links. ``pairs`` is a written table
    of ``pair_counts``; those met 2^k times or more are broadcast, for the least k with which they are ``most`` or fewer."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r["k"]: r["pairs"] for r in pairs.groupBy(power.alias("k")).agg(F.count("*").alias("pairs")).collect()}
    least = next(k for k in range(65) if sum(n for power_, n in sizes.items() if power_ >= k) <= most)
    each = rows.select("row", F.explode("links").alias("pair"))
    met = each.join(F.broadcast(pairs.where(power >= least)), "pair").select("row", "n", "best")
    if any(k < least for k in sizes):
        rare = each.join(F.broadcast(pairs.where(power >= least).select("pair")), "pair", "left_anti")
        met = met.union(rare.join(pairs.where(power < least).hint("merge"), "pair").select("row", "n", "best"))
    return met.groupBy("row").agg(F.count("*").alias("n_links"), F.count_if("best").alias("n_best"), F.sum("n").alias("count_sum"))


def scored(rows: DataFrame, most: int = MOST) -> DataFrame:
    """Written ``align`` rows with their ``scores``, zeros where there are no links."""
    found = scores(rows, written(pair_counts(rows), "pairs"), most)
    zeros = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_links", "n_best", "count_sum")]
    kept = [c for c in rows.columns if c not in ("links", "row")]
    return rows.drop("links").join(found, "row", "left").select(*kept, *zeros)


def alignment(df: DataFrame, definition: str, model: bytes) -> DataFrame:
    """Of each row of ``df`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is the one most
    met of its b id), count_sum (of the links' pairs' counts) and groups_sha256. ``definition`` and ``model`` are contents of
    tokenizers' files (some MB at most)."""
    found = scored(written(align(tokenised(df, definition, model), digests=True), "aligned", compression="zstd"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
