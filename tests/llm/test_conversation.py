"""Conversation repair against shortest paths over whole edit strings."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from compare import DATA
from tessella.llm import conversation
from tessella.llm.queries import op12_conversation

FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(rows):
    part = lambda x: " " if x is None else str(x)
    out = []
    for conv, turn, role, text in rows:
        hit = zlib.crc32(f"{part(conv)}:{part(turn)}".encode()) % 20
        role, text = part(role), part(text)
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def best(rows):
    """Cheapest, then ASCII-least repair of the turns of one conversation: shortest path over (turns used, state)."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    first = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
    after = {"": ("u", "user"), "s": ("u", "user"), "u": ("a", "assistant"), "a": ("u", "user")}
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, kept = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            break
        to, role = after[state]
        push = lambda c, e, j, s, *turn: heapq.heappush(heap, (cost + c, audit + e, j, s, kept + turn))  # noqa: B023,E731
        push(3, "I", i, to, f"{role}:")
        if i < len(rows):
            push(4, "D", i + 1, state)
            if faults[i] not in ("b", "d"):
                more = 3 if faults[i] == "t" else 0
                if first[i] and (first[i] == to or first[i] == "s" and state == ""):
                    push(more, "K", i + 1, first[i], f"{rows[i][2]}:{rows[i][3]}")
                push(3 + more, "R", i + 1, to, f"{role}:{rows[i][3]}")
    digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest), list(kept)


def expected(rows):
    by = {r[0]: [] for r in rows}
    for r in damaged(rows):
        by[r[0]].append(r)
    return {conv: best(own)[0] for conv, own in by.items()}


def random_rows(seed, convs=50):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    texts = ["a.", "b", "", " \t", "Hi!", "x? \n", None, "é.", "y", "x" * 20_000]
    return [
        (c, rnd.choice([None, i, i, i, i + 3]), rnd.choice(roles), rnd.choice(texts))
        for c in [*range(convs), None]
        for i in range(rnd.choice([1, 2, 3, 5, 30]))
    ]


def write(spark, tmp_path, rows):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def result(df):
    return {r.conv_id: tuple(r[c] for c in FIELDS) for r in df.collect()}


def test_given_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(str(DATA / "sf0.01/conversations.parquet")).select("conv_id", "turn", "role", "text").collect()]
    assert result(op12_conversation(spark, str(DATA / "sf0.01"))) == expected(rows)


@pytest.mark.parametrize("block", [3, 4096])
def test_random_turns(spark, tmp_path, monkeypatch, block):
    """With blocks of 3 turns most conversations span several."""
    monkeypatch.setattr(conversation, "BLOCK", block)
    rows = random_rows(block)
    assert result(op12_conversation(spark, write(spark, tmp_path, rows))) == expected(rows)


def test_long_conversation(spark, monkeypatch):
    """One conversation over many blocks; the repaired turns have the digest of the report."""
    monkeypatch.setattr(conversation, "BLOCK", 64)
    rnd = random.Random(9)
    rows = [(1, i, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", "b", f"c{i}.", f"d{i}", ""])) for i in range(1500)]
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    tables = conversation.repair(df)
    (got,) = tables["conversations"].collect()
    want, kept = best(rows)
    assert tuple(got[c] for c in FIELDS) == want
    turns = conversation.apply(tables).orderBy("turn").collect()
    assert [f"{t.role}:{t.text}" for t in turns] == kept and [t.turn for t in turns] == list(range(len(kept)))


def test_empty_and_clashing_names(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, "user", "a.", 5, 6, "x")], "conv_id long, turn long, role string, text string, pos int, blk int, key string")
    tables = conversation.repair(df, conv="conv_id")
    assert [tuple(r[c] for c in FIELDS[:7]) for r in tables["conversations"].collect()] == [(0, 0, 0, 0, 0, 3, "KI")]
    assert conversation.repair(df.limit(0), conv="conv_id")["conversations"].count() == 0
    gone = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = result(op12_conversation(spark, write(spark, tmp_path, [(gone, 0, "user", "a.")])))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_checkpoints_are_square_root():
    step, kept = conversation.checkpoints(bytes(10_000), conversation.END)
    assert step == 100 and len(kept) == 101
