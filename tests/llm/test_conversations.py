import functools
import hashlib
import random
import zlib

from foliograph.llm import conversations as C
from foliograph.llm import queries

EMPTY = hashlib.sha256(b"").hexdigest()


def cheapest(rows):
    """The least (cost, audit, lines) of all edits, from the end: what follows a beginning is chosen by itself."""

    @functools.cache
    def rest(i, state, inserted):
        options = [(0, "", ())] if i == len(rows) and state in (C.START, C.ASSISTANT) else []

        def add(cost, edit, line, *then):
            options.extend([(cost + x[0], edit + x[1], line + x[2]) for x in [rest(*then)] if x])

        if inserted < 2:
            add(3, "I", (f"{C.ROLE[C.NEXT[state]]}:",), i, C.NEXT[state], inserted + 1)
        if i < len(rows):
            role, text, fault = rows[i]
            add(4, "D", (), i + 1, state, 0)
            if fault not in ("blank", "duplicate"):
                more, to = 3 * (fault == "truncated"), C.NEXT[state]
                add(3 + more, "R", (f"{C.ROLE[to]}:{text}",), i + 1, to, 0)
                if (state, role[:1]) in C.KEPT:
                    add(more, "K", (f"{role}:{text}",), i + 1, C.KEPT[state, role[:1]], 0)
        return min(options, key=lambda x: x[:2], default=None)

    return rest(0, C.START, 0)


def plain(rows):
    """What ``repair`` gives for one conversation's (turn, role, text), by trying all edits."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faulty, initials = set(), [], [r[1][:1] for r in rows]
    for _, role, text in rows:
        end = text.rstrip(C.WHITE)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
        seen.add((role, text))
        faulty.append((role, text, fault))
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, lines = cheapest(faulty)
    count = lambda kind: sum(f == kind for _, _, f in faulty)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, count("blank"), count("duplicate"), count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, audit int, fault string")


def result(df):
    rows = df.collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


def test_against_all_edits(spark):
    rnd = random.Random(3)
    rows = []
    for conv in range(300):
        for _ in range(rnd.randrange(1, 9)):
            rows.append((conv, rnd.choice([None, 0, 1, 1, 2, 3, 9]), rnd.choice(["system", "user", "user", "assistant", "tool", "", "s"]), rnd.choice(["a.", "b", "c! \n", " \t", "", "d?", "e"])))
    found = result(C.repair(table(spark, rows)))
    for conv in range(300):
        own = [r[1:] for r in rows if r[0] == conv]
        assert found[conv] == plain(own), own


def test_nulls_and_lost_rows(spark):
    rows = [(1, None, None, None), (None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (2, 5, "user", "gone."), (3, 0, "system", "Be."), (3, 4, "user", "x.\x0b")]
    found = result(C.repair(table(spark, rows), C.F.col("conv_id") == 2))
    assert found[1] == (0, 1, 0, 0, 0, 4, "D", EMPTY)
    assert found[None] == (0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:Hi.\nassistant:Ho.").hexdigest())
    assert found[2] == (0, 0, 0, 0, 0, 0, "", EMPTY)
    assert found[3] == (3, 0, 0, 0, 0, 3, "KKI", hashlib.sha256(b"system:Be.\nuser:x.\x0b\nassistant:").hexdigest())
    assert C.repair(table(spark, [])).count() == 0


def test_long_conversations_put_their_audits_together(spark, monkeypatch):
    """Paths that never meet: users only, so that one audit rewrites the odd rows and the other the even ones."""
    whole = C.Search()
    for i in range(5000):
        whole.step("user", f"{i}.", False, False)
    monkeypatch.setattr(C, "TAIL", 7)
    cut = C.Search()
    for i in range(5000):
        cut.step("user", f"{i}.", False, False)
        assert all(len(p[2]) <= 9 for p in cut.paths if p)
    assert cut.result() == whole.result() and whole.result()[:2] == (7500, "KR" * 2500)
    rows = [(1, i, ("user", "assistant")[i % 2], f"{i} " * 50 + ".") for i in range(4000)]
    assert result(C.repair(table(spark, rows)))[1][5:7] == (0, "K" * 4000)


def test_damage(spark):
    rows = [(c, t, r, "One. Two! Three? ") for c in range(60) for t, r in enumerate(["system", "user", "assistant", None])]
    damaged = C.damage(table(spark, rows)).collect()
    for c, t, r, text in rows:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        own = [x for x in damaged if (x["conv_id"], x["turn"]) == (c, t)]
        assert len(own) == 1 + (kind == 3) and {x["lost"] for x in own} == {kind == 0}
        assert {x["role"] for x in own} == {"user" if kind == 4 else r or " "}
        assert {x["text"] for x in own} == {"" if kind == 1 else "One Two Three " if kind == 2 else text}


def test_the_repaired_rows_have_the_hash(spark):
    damaged = C.damage(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))
    found = C.repair(damaged, C.F.col("lost"))
    lines = {}
    for r in C.repaired(damaged, found, C.F.col("lost")).collect():
        lines.setdefault(r["conv_id"], {})[r["position"]] = f"{r['role']}:{r['text']}"
    for r in found.collect():
        own = lines.get(r["conv_id"], {})
        assert sorted(own) == list(range(len(own)))
        assert hashlib.sha256("\n".join(own[i] for i in range(len(own))).encode()).hexdigest() == r["repaired_sha256"]


def test_query_against_all_edits(spark):
    rows = {}
    for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect():
        kind = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text = "" if kind == 1 else r["text"].translate({ord(c): None for c in ".!?"}) if kind == 2 else r["text"]
        rows.setdefault(r["conv_id"], []).extend([(r["turn"], "user" if kind == 4 else r["role"], text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    found = result(queries.op11_viterbi_conversation_repair(spark, "/root/testdata/sf0.001"))
    assert found == {c: plain(own) for c, own in rows.items()}


def test_one_shuffle(spark):
    plan = queries.op11_viterbi_conversation_repair(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
