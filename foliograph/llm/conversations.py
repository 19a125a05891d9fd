"""Conversation structure repair: the cheapest edits that give a conversation the turns ``(system? (user assistant)+)?``.

Each conversation's rows are read in order of their turn by a forward Viterbi search over four grammar states (nothing yet,
after the system's turn, after a user's, after an assistant's). A state carries the cheapest edits that lead to it, as
(cost, audit string); a row is kept, given another role or deleted, and after each row the layer is closed by inserted
turns: at most one leads to "user" and one more to "assistant", since longer runs of them only cost more.

Of two audits of one cost none is the other's beginning (what it has more would be insertions, which cost), so the smaller
one stays smaller whatever follows, and a state needs no other.

One shuffle by conversation brings the rows together; equal rows are marked and all rows ordered by local sorts that
spill. A task then reads the rows as a stream and holds, of a conversation of any length, no row but the current one: the
states' audits (common beginnings once) and their running hashes. A conversation is one task's work at the end, because the
hash of its joined text is defined row after row; its memory doesn't grow but by one letter for each row.

Results for special cases: nulls in role and text are one space, a null turn comes first, rows without a conversation form
one. Equal turns are taken by role, then text. A role's first character is its initial. A conversation whose rows are all
lost has zeros, no audit and the hash of the empty string. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What counts as white space.
WHITE = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a turn with this initial leads to.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: The state that an inserted turn, or one with a new role, leads to.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Costs.
DELETED, INSERTED, REROLED, CUT_OFF = 4, 3, 3, 3
#: Letters of an audit after which common beginnings are put together.
TAIL = 1024
#: Rows or characters of audits that are returned at a time.
ROWS, CHARACTERS = 4096, 4_000_000

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Search:
    """The forward search over one conversation. A path is (cost, head, tail, hash): its audit is heads[head] followed by
    ``tail``; the heads ascend and none is another's beginning, so (cost, head, tail) are in the order of (cost, audit)."""

    def __init__(self):
        self.heads: list = [None]  # each a chain (earlier, letters)
        self.paths: list = [(0, 0, "", hashlib.sha256()), None, None, None]
        self.close()

    def step(self, role: str, text: str, gone: bool, cut_off: bool) -> None:
        """Take the next row; ``gone`` if it must be deleted, ``cut_off`` if its text isn't finished."""
        extra, best = CUT_OFF * cut_off, [None] * 4

        def offer(to: int, path: tuple, cost: int, edit: str, role: str | None) -> None:
            key = (path[0] + cost, path[1], path[2] + edit)
            if best[to] is None or key < best[to][0]:
                best[to] = (key, state, path, role)

        for state, path in enumerate(self.paths):
            if path:
                offer(state, path, DELETED, "D", None)
                if not gone:
                    if (to := KEPT.get((state, role[:1]))) is not None:
                        offer(to, path, extra, "K", role)
                    offer(NEXT[state], path, REROLED + extra, "R", ROLE[NEXT[state]])
        self.paths = [b and (*b[0], b[2][3] if b[3] is None else said(b[2][3], b[1], b[3], text)) for b in best]
        self.close()

    def close(self) -> None:
        """Insertions; then what can't win any more goes: whatever follows "nothing yet" can follow an assistant's turn if a
        system's turn is deleted, and whatever follows the system's turn can follow an assistant's."""
        for sources, to in (((START, SYSTEM, ASSISTANT), USER), ((USER,), ASSISTANT)):
            for state in sources:
                if path := self.paths[state]:
                    key = (path[0] + INSERTED, path[1], path[2] + "I")
                    if self.paths[to] is None or key < self.paths[to][:3]:
                        self.paths[to] = (*key, said(path[3], state, ROLE[to], ""))
        for state, more in ((START, DELETED), (SYSTEM, 0)):
            if self.paths[state] and self.paths[state][0] > self.paths[ASSISTANT][0] + more:
                self.paths[state] = None
        if len(self.paths[ASSISTANT][2]) > TAIL:
            self.put_together()

    def put_together(self) -> None:
        """Move the tails into the heads."""
        heads, first = [], None
        for state in sorted((s for s in range(4) if self.paths[s]), key=lambda s: self.paths[s][1:3]):
            cost, head, tail, digest = self.paths[state]
            if not (first and first[0] == head and tail.startswith(first[1])):
                first = (head, tail)
                heads.append((self.heads[head], tail))
            self.paths[state] = (cost, len(heads) - 1, tail[len(first[1]) :], digest)
        self.heads = heads

    def result(self) -> tuple[int, str, str]:
        """Cost, audit and hash of the cheapest edits."""
        cost, head, tail, digest = min((self.paths[s] for s in (START, ASSISTANT) if self.paths[s]), key=lambda p: p[:3])
        parts, chain = [tail], self.heads[head]
        while chain:
            parts.append(chain[1])
            chain = chain[0]
        return cost, "".join(reversed(parts)), digest.hexdigest()


def said(digest, state: int, role: str, text: str):
    """The hash after one more turn."""
    digest = digest.copy()
    digest.update(f"{'' if state == START else chr(10)}{role}:{text}".encode())
    return digest


class Conversation:
    """What is found in one conversation's rows, as they come."""

    def __init__(self, conv_id):
        self.conv_id, self.search, self.initial = conv_id, Search(), None
        self.found = dict.fromkeys(COUNTS, 0)
        self.turn = None

    def step(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if turn is not None:
            if self.turn is not None and turn > self.turn + 1:
                self.found["gaps"] += turn - self.turn - 1
            self.turn = turn
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.found["illegal"] += 1
        self.initial = role[:1]
        if fault:
            self.found[fault] += 1
        self.search.step(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def result(self) -> tuple:
        self.found["cost"], audit, digest = self.search.result()
        return (self.conv_id, *self.found.values(), audit, digest)


def damage(df: DataFrame, share: int = 20) -> DataFrame:
    """``df`` with rows damaged by the CRC32 of ``conv_id:turn`` modulo ``share``: 0 is lost, 1 loses its text, 2 its marks of
    a sentence's end, 3 comes twice, 4 is said by the user. A lost row remains, with ``lost``, for its conversation."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), (F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % share).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("lost"), copies.alias("copy")).drop("copy")


def ordered(df: DataFrame, lost: Column | None) -> DataFrame:
    """All rows with their first fault, each conversation's in order in one partition."""
    lost = F.lit(False) if lost is None else F.coalesce(lost, F.lit(False))
    rows = df.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.when(~lost, F.coalesce(F.col(c).cast("string"), F.lit(" "))).alias(c) for c in ("role", "text")], lost.alias("lost"))
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("turn")) > 1
    end = F.rtrim("text", F.lit(WHITE))
    fault = F.when(end == "", "blank").when(F.col("again"), "duplicate").when(~F.substring(end, -1, 1).isin(*".!?"), "truncated")
    # the window's keys begin with the key that the rows are dealt by: it needs no second shuffle
    marked = rows.repartition("conv_id").withColumn("again", again).withColumn("fault", F.when(~F.col("lost"), fault))
    return marked.sortWithinPartitions("conv_id", "turn", "role", "text", "again").drop("again")


def streamed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of the batches."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from zip(*(column.to_pylist() for column in batch.slice(at, 256).columns))


def repair(df: DataFrame, lost: Column | None = None) -> DataFrame:
    """Of each conv_id of ``df`` (conv_id, turn, role, text): ``gaps`` in its turns; rows whose first fault is ``blank``,
    ``duplicate`` or ``truncated``; adjacent ``illegal`` rows; ``cost`` and ``audit`` of the cheapest edits (K kept, R
    another role, D deleted, I inserted; of equal costs the audit least in ASCII); ``repaired_sha256`` of the repaired
    ``role:text``, joined by newlines. Rows that are ``lost`` only name their conversation."""
    rows = ordered(df, lost)
    schema = T.StructType([rows.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    of_id = rows.select("conv_id").limit(0).toArrow().schema.field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, done, now, size = [of_id, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()], [], None, 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=schema.names)

        for conv_id, turn, role, text, gone, fault in streamed(batches):
            if now is None or now.conv_id != conv_id:
                if now:
                    done.append(now.result())
                    size += len(done[-1][-2])
                    if len(done) >= ROWS or size >= CHARACTERS:
                        yield batch()
                        done, size = [], 0
                now = Conversation(conv_id)
            if not gone:
                now.step(turn, role, text, fault)
        if now:
            done.append(now.result())
            yield batch()

    return rows.mapInArrow(run, schema)


def repaired(df: DataFrame, audits: DataFrame, lost: Column | None = None) -> DataFrame:
    """The repaired conversations as rows (conv_id, position, edit, role, text): ``audits`` (conv_id, audit), as ``repair``
    gives them, carried out on the rows of ``df``. An audit comes before its conversation's rows in one stream."""
    rows = ordered(df, lost).where("not lost").select("conv_id", "turn", "role", "text", F.lit(1).alias("kind"))
    both = rows.union(audits.select("conv_id", F.lit(None).cast("long"), F.lit(""), F.col("audit"), F.lit(0)))
    stream = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text")
    schema = T.StructType([rows.schema["conv_id"], T.StructField("position", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("edit", "role", "text"))])
    of_id = rows.select("conv_id").limit(0).toArrow().schema.field(0).type

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        conv_id, audit, at, position, state = None, "", 0, 0, START

        def inserted() -> Iterator[tuple]:
            nonlocal at, position, state
            while audit[at : at + 1] == "I":
                state = NEXT[state]
                yield (conv_id, position, "I", ROLE[state], "")
                at, position = at + 1, position + 1

        for conv_id, _, role, text, kind in streamed(batches):
            if not kind:
                audit, at, position, state = text, 0, 0, START
            else:
                edit, at = audit[at], at + 1
                if edit != "D":
                    state = KEPT[state, role[:1]] if edit == "K" else NEXT[state]
                    yield (conv_id, position, edit, role if edit == "K" else ROLE[state], text)
                    position += 1
            yield from inserted()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, done, size = [of_id, pa.int64(), pa.string(), pa.string(), pa.string()], [], 0
        for row in turns(batches):
            done.append(row)
            size += len(row[-1])
            if len(done) >= ROWS or size >= CHARACTERS:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=schema.names)
                done, size = [], 0
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=schema.names)

    return stream.mapInArrow(run, schema)
