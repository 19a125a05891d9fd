import random

from foliograph.llm import linededup


def brute(rows, min_chars=20, min_docs=3):
    key = lambda x: linededup.line_key(x)
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    last = {k: max((i for i in s if i is not None), default=None) for k, s in holders.items() if len(k) >= min_chars and len(s) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in last or i is None or i == last[key(x)]]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_keys():
    assert linededup.line_key(" \tÄ B\r") == "Ä b" and linededup.line_key(" A ") == "a" and linededup.line_key("\u00a0x ") == "\u00a0x"


def test_filter():
    rnd = random.Random(1)
    keys = [rnd.randbytes(16) for _ in range(3000)]
    own = linededup.build(keys)
    assert all(k in own for k in keys) and own.contains_all(keys).all()
    other = [rnd.randbytes(16) for _ in range(3000)]
    assert own.contains_all(other).mean() < 0.01
    assert (own.contains_all(other) == [k in own for k in other]).all()
    again = linededup.CuckooFilter.from_bytes(own.to_bytes())
    for k in keys[:1500]:
        assert again.delete(k)
    assert all(k in again for k in keys[1500:]) and sum(k in again for k in keys[:1500]) < 30


def test_many_equal_keys_end():
    assert b"\1" * 16 in linededup.build([b"\1" * 16] * 7)


def test_rows(spark, edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert rows_of(linededup.line_dedup(edge)) == brute(rows)
    assert linededup.line_dedup(empty).count() == 0


def some_rows(rnd, count):
    lines = [f"this is line number {k} of the corpus" for k in range(60)]
    return [(i, "\n".join(["A hot line that nearly all of them hold"] * (i % 3 > 0) + rnd.choices(lines, k=4))) for i in range(count)]


SCHEMA = "doc_id long, text string"


def test_many_shards_and_parts(spark, monkeypatch):
    rows = some_rows(random.Random(2), 200)
    monkeypatch.setattr(linededup, "SHARD_KEYS", 15)
    monkeypatch.setattr(linededup, "PART", 40)
    assert rows_of(linededup.line_dedup(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def contents(state):
    """Keys of a state, told apart by its filters: all exact keys are in them, next to nothing else is."""
    found = {r["shard"]: linededup.CuckooFilter.from_bytes(bytes(r["filter"])) for r in state.filters.collect()}
    keys = state.keys.withColumn("shard", linededup._shard_of(state.shards)).collect()
    assert all(bytes(r["digest"]) in found[r["shard"]] for r in keys)
    assert sum(int((f.table > 0).sum()) for f in found.values()) == len(keys)
    return sorted((bytes(r["digest"]), r["docs"], r["last"]) for r in keys)


def test_insertions_and_deletions_are_reversible(spark, monkeypatch):
    """Stored filters follow the documents that come and go, and the results are those of a fresh build."""
    monkeypatch.setattr(linededup, "SHARD_KEYS", 15)
    rnd = random.Random(5)
    rows = some_rows(rnd, 120)
    part = lambda low, high: spark.createDataFrame(rows[low:high], SCHEMA)
    refs = lambda low, high: linededup.references(part(low, high))
    first = linededup.build_state(refs(0, 40))
    second = linededup.update(first, added=refs(40, 120))
    third = linededup.update(second, gone=refs(20, 100))
    fourth = linededup.update(third, added=refs(20, 100), gone=refs(100, 120))
    back = linededup.update(second, gone=refs(40, 120))
    for state, now in ((first, rows[:40]), (second, rows), (third, rows[:20] + rows[100:]), (fourth, rows[:100]), (back, rows[:40])):
        assert contents(state) == contents(linededup.build_state(linededup.references(spark.createDataFrame(now, SCHEMA))))
        assert rows_of(linededup.line_dedup(spark.createDataFrame(now, SCHEMA), state=state)) == brute(now)
    none = linededup.update(back, gone=refs(0, 40))
    assert contents(none) == [] and none.references.count() == 0


def test_full_filters_are_built_anew(spark, monkeypatch):
    monkeypatch.setattr(linededup, "SHARD_KEYS", 150)
    rows = [(i, "\n".join(f"a line that three of them hold, number {k}" for k in range(i // 3 * 80, i // 3 * 80 + 80))) for i in range(9)]
    refs = lambda some: linededup.references(spark.createDataFrame(some, SCHEMA))
    state = linededup.update(linededup.build_state(refs(rows[:3])), added=refs(rows[3:]))
    assert len(contents(state)) == 240 and state.shards == 1
    assert rows_of(linededup.line_dedup(spark.createDataFrame(rows, SCHEMA), state=state)) == brute(rows)
