"""Conversation repair against trying all edits."""

import hashlib
import random
import re
from functools import lru_cache
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from weblode.llm import op11_conversations as op

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(SPACE)
        again = (role, text) in seen
        seen.add((role, text))
        out.append("blank" if not body else "duplicate" if again else "truncated" if body[-1] not in ".!?" else None)
    return out


def cheapest(rows):
    """(cost, audit, repaired) by trying every edit at every place, with up to
    three inserts in a row; the state is what the last line begins with."""
    found = faults(rows)

    @lru_cache(None)
    def best(k, last, inserted):
        ways = []
        if k == len(rows) and last in ("", "a"):
            ways.append((0, "", ()))
        need = "assistant" if last == "u" else "user"
        if inserted < 3:
            c, a, out = best(k, need[0], inserted + 1)
            ways.append((c + 2, "I" + a, ((need, ""), *out)))
        if k < len(rows):
            role, text = rows[k]
            c, a, out = best(k + 1, last, 0)
            ways.append((c + 3, "D" + a, out))
            if found[k] not in ("blank", "duplicate"):
                late = found[k] == "truncated"
                c, a, out = best(k + 1, need[0], 0)
                ways.append((c + 2 + late, "R" + a, ((need, text), *out)))
                if role[:1] == need[0] or (role[:1] == "s" and last == ""):
                    c, a, out = best(k + 1, role[:1], 0)
                    ways.append((c + late, "K" + a, ((role, text), *out)))
        return min(ways, default=(10**9, "", ()))

    return best(0, "", 0)


def expected(table):
    out = []
    for conv in {r[0] for r in table}:
        own = sorted((r[1] is not None, r[1] or 0, " " if r[2] is None else r[2], " " if r[3] is None else r[3])
                     for r in table if r[0] == conv and r[4])
        rows = [(role, text) for _, _, role, text in own]
        turns = [t for known, t, _, _ in own if known]
        cost, audit, lines = cheapest(tuple(rows))
        names = [r[:1] for r, _ in rows]
        kinds = faults(rows)
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(kinds.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(names, names[1:], strict=False)), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()))
    return sorted(map(repr, out))


def got(df, **how):
    return sorted(repr(tuple(r)) for r in op.repair(df, **how).collect())


def prepared(spark, table):
    df = spark.createDataFrame([r[:4] for r in table], SCHEMA)
    for name in ("conv", "place", "sign", "kind", "copy", "fault", "piece", "audit", "signature"):
        df = df.withColumn(name, F.lit("clash"))
    return op.turns(df, "conv_id", "turn", "role", "text")


def chats(seed, conversations, most):
    rng, out = random.Random(seed), []
    for conv in range(conversations):
        for k in range(rng.randrange(1, most)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "u"])
            out.append((conv, k + rng.randrange(2), role, rng.choice(["Yes.", "No", "Well?", " ", "", f"n{k}.", f"m{k}\t", "é!\n"]), True))
    return out


@pytest.mark.parametrize("piece", [1, 2, 3, 512])
def test_all_edits_tried(spark, piece):
    table = chats(piece, 150, 9)
    assert got(prepared(spark, table), piece=piece) == expected(table)


def test_nulls_ties_repeated_rows_and_long_texts(spark):
    table = [
        (None, None, None, None, True), (None, 1, "user", "a.", True), (None, 1, "user", "a.", True), (1, None, "user", "b.", True),
        (1, 5, "assistant", "c.", True), (1, 5, "assistant", "b.", True), (2, 3, None, "x.", True), (3, -4, "user", None, True),
        (4, 2**62, "assistant", "x." * 1_000_000, True), (4, -5, "user", "y" * 1_000_000, True), (5, 1, "é", "\n", True),
    ]
    assert got(prepared(spark, table)) == expected(table)
    assert got(prepared(spark, table), piece=1) == expected(table)


def test_empty_table(spark):
    assert got(prepared(spark, [])) == []
    assert op.repaired(prepared(spark, [])).collect() == []


def test_repaired_rows_follow_the_grammar(spark):
    table = chats(9, 60, 12)
    by_conv = {}
    for r in op.repaired(prepared(spark, table), piece=2).orderBy("conv", "place").collect():
        by_conv.setdefault(r["conv"], []).append(r)
    assert all(re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in rows)) for rows in by_conv.values())
    for r in op.repair(prepared(spark, table)).collect():
        lines = "\n".join(f"{x['role']}:{x['text']}" for x in by_conv.get(r["conv"], []))
        assert hashlib.sha256(lines.encode()).hexdigest() == r["repaired_sha256"]


def test_one_long_conversation_among_many(spark):
    """Pieces, heavy signatures and the chain of pieces, against one piece."""
    rng = random.Random(4)
    table = [(7, k, rng.choice(["user", "assistant", "tool"]), rng.choice([f"t{k}.", f"t{k}", " "]), True) for k in range(900)]
    table += [(100 + k, j, role, f"{role}{k}.", True) for k in range(200) for j, role in enumerate(("system", "user", "assistant"))]
    whole = got(prepared(spark, table), piece=2000)
    old, op.PIECES_PER_SLOT = op.PIECES_PER_SLOT, 20
    try:
        assert got(prepared(spark, table), piece=16) == whole
    finally:
        op.PIECES_PER_SLOT = old


def test_nodes_are_shared_by_suffix(monkeypatch):
    import pyarrow as pa

    made, make = [], op.before
    monkeypatch.setattr(op, "before", lambda sign, node: made.append(sign) or make(sign, node))
    words = sorted(["uaua", "sua", "ua", "Suaua", "xuaua", "uauA"])
    words = sorted(w[::-1] for w in words)
    batch = pa.RecordBatch.from_pydict({"signature": words, "backwards": words, "last": [True] * len(words)})
    out = next(iter(op._solve(iter([batch]))))
    assert len(made) == len({w[:k] for w in words for k in range(1, len(w) + 1)})
    assert dict(zip(words, out["costs"].to_pylist(), strict=True))["auaux"][op.START] == 3


def test_damage(spark):
    table = [(c if c % 9 else None, k if k % 7 else None, ["user", "assistant"][k % 2], f"Well {k}. Or? no", True)
             for c in range(40) for k in range(12)]
    left = []
    for conv, turn, role, text, _ in table:
        fate = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        row = (conv, turn, "user" if fate == 4 else role, text, fate != 0)
        left += [row, row] if fate == 3 else [row]
    df = spark.createDataFrame([r[:4] for r in table], SCHEMA)
    assert got(op.damaged(df)) == expected(left)


def test_conversations_without_rows_are_returned(spark, tmp_path):
    gone = next(k for k in range(10**6) if crc32(f"{k}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "a.")], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert tuple(op.query(spark, str(tmp_path)).first()) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
