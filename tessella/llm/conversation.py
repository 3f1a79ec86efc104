"""Repair of the structure of conversations by the cheapest edits, as a dynamic program with checkpoints.

A conversation's turns are numbered by range partitions and packed, a byte a turn, into blocks of ``BLOCK`` turns, however long it is. The cost of the
best repair of the rest, one number for each state of the grammar ``(s?(ua)+)?``, is the state-cost vector. It is kept at checkpoints only:

1. each block becomes a min-plus matrix (state before, state after), all blocks at once;
2. the matrices of a conversation, last block first, give the vector at the end of each block: the distributed checkpoints;
3. each block walks forward from every state it could be entered in. Inside, vectors are kept at every square root of its turns and the stretch
   between two of them is recomputed when the walk gets there; of the tight edits the ASCII-least is taken;
4. the walks are chained, first block first.

So a conversation that holds a third of all turns is worked on by all tasks; steps 2 and 4 read one small row for ``BLOCK`` turns.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessella.llm.common import small_batches
from tessella.operators.graph import ranked
from tessella.session import discard, save

BLOCK = 4096
INF = 1 << 60
# Fixed values of the repair: costs, edits in ASCII order, grammar states.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the role a reroled or inserted turn takes after each state
DONE = (0, INF, INF, 0)  # an empty conversation and a finished pair may end
NAMES = {USER: "user", ASSISTANT: "assistant"}
SPACE = r"\x20\x09-\x0D"
# A turn's byte: its role (0 other, 1 system, 2 user, 3 assistant) + 4 * its first fault
CLEAN, SHORT, BLANK, DUPLICATE = range(4)


def _kept(state: int, code: int) -> int | None:
    """The state after keeping the turn, or None if its role can't stand there."""
    role = code & 3
    if role == SYSTEM:
        return SYSTEM if state == START else None
    return role if role and role == NEXT[state] else None


def _edits(state: int, code: int) -> Iterator[tuple[str, int, int]]:
    """Edits that use up the turn, in ASCII order: (initial, cost, state after)."""
    yield "D", DELETE, state
    if code >> 2 < BLANK:
        more = TRUNCATED if code >> 2 == SHORT else 0
        kept = _kept(state, code)
        if kept is not None:
            yield "K", more, kept
        yield "R", REROLE + more, NEXT[state]


# Per byte value: for each state the edits that use up the turn.
STEPS = [[list(_edits(s, c)) for s in range(4)] for c in range(16)]


def _with_inserts(base: list[int]) -> tuple[int, ...]:
    """Costs before a turn (or the end) from those without inserted turns before it; two in a row come back to the same state."""
    u, a = min(base[USER], INSERT + base[ASSISTANT]), min(base[ASSISTANT], INSERT + base[USER])
    return min(base[START], INSERT + u), min(base[SYSTEM], INSERT + u), u, a


def back(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """State-cost vector before the turn from the one after it."""
    return _with_inserts([min(cost + after[to] for _, cost, to in STEPS[code][s]) for s in range(4)])


def matrix(codes: bytes) -> list[int]:
    """Costs from each state before the block (rows) to each state after its last turn, row by row."""
    columns = []
    for end in range(4):
        v = tuple(0 if s == end else INF for s in range(4))
        for code in reversed(codes):
            v = back(code, v)
        columns.append(v)
    return [min(columns[e][s], INF) for s in range(4) for e in range(4)]


def checkpoints(codes: bytes, after: tuple[int, ...]) -> tuple[int, list[tuple[int, ...]]]:
    """Step width and the vectors before turns 0, step, 2 step, … and after the last turn."""
    n, step = len(codes), max(1, math.isqrt(len(codes)))
    kept, v = [after], after
    for i in range(n - 1, -1, -1):
        v = back(codes[i], v)
        if i % step == 0:
            kept.append(v)
    return step, kept[::-1]


def walk(codes: bytes, state: int, points: tuple[int, list], last: bool) -> tuple[str, int]:
    """ASCII-least cheapest edits of a block entered in ``state``, and the state it is left in. The ``last`` block may end with inserted turns."""
    step, kept = points
    out, n = [], len(codes)
    for at in range(0, n, step):
        part = codes[at : at + step]
        vectors = [kept[at // step + 1]]  # recomputed for one stretch at a time
        for code in reversed(part):
            vectors.append(back(code, vectors[-1]))
        vectors.reverse()
        for i, code in enumerate(part):
            while True:
                here, there = vectors[i][state], vectors[i + 1]
                tight = [("I", NEXT[state])] if INSERT + vectors[i][NEXT[state]] == here else []
                tight += [(e, to) for e, cost, to in STEPS[code][state] if cost + there[to] == here]
                e, state = min(tight)
                out.append(e)
                if e != "I":
                    break
    while last and DONE[state]:
        state = NEXT[state]
        out.append("I")
    return "".join(out), state


END = _with_inserts(list(DONE))


def repaired(turns: Iterator[tuple[str, str]], audit: Iterator[str], state: int = START) -> Iterator[tuple[str, str]]:
    """The turns that ``audit`` leaves, in order, (role, text); ends with the audit."""
    for e in audit:
        role, text = ("", "") if e == "I" else next(turns)
        if e == "D":
            continue
        if e == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
            yield role, text
        else:
            state = NEXT[state]
            yield NAMES[state], text


def _stream(df: DataFrame, by: str, order: list, schema: str, fn: Callable[[Iterator[dict]], Iterator[tuple]]) -> DataFrame:
    """``fn`` over the rows of each partition, sorted by conversation; rows come one at a time, so a long conversation fills no memory."""
    from pyspark.sql import types as T

    small_batches(df.sparkSession)
    out = T.StructType.fromDDL(schema)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        found = fn(r for b in batches for r in b.to_pylist())
        while rows := list(itertools.islice(found, 1000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), target)], names=out.names)

    return df.repartition(by).sortWithinPartitions(by, *order).mapInArrow(run, out)


MEMO = 1000  # short conversations repeat the same few byte strings: so many results are kept at a time


def _remembered(memo: dict, key, fn: Callable):
    if key not in memo:
        if len(memo) >= MEMO:
            memo.clear()
        memo[key] = fn(*key)
    return memo[key]


def _pack(blocks: Iterator[dict]) -> Iterator[tuple]:
    memo = {}
    for b in blocks:
        turns = sorted(b["turns"], key=lambda t: t["pos"])
        codes = bytes(t["code"] for t in turns)
        roles = [c & 3 for c in codes]
        legal = ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))
        bad = sum(pair not in legal for pair in itertools.pairwise(roles))
        faults = [c >> 2 for c in codes]
        yield (b["conv"], b["blk"], codes, _remembered(memo, (codes,), matrix), *[faults.count(f) for f in (BLANK, DUPLICATE, SHORT)], bad, roles[0], roles[-1])


def _vectors(blocks: Iterator[dict]) -> Iterator[tuple]:
    """Blocks of a conversation, last first: the vector after each block, the cost before it and the illegal pair at its end."""
    for _, own in itertools.groupby(blocks, key=lambda b: b["conv"]):
        v, right = END, None
        for b in own:
            m = b["costs"]
            before = tuple(min(m[4 * s + e] + v[e] for e in range(4)) for s in range(4))
            bad = b["illegal"] + (right is not None and (b["last_role"], right) not in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)))
            yield b["conv"], b["blk"], b["codes"], list(v), right is None, before[START], b["blank"], b["duplicate"], b["truncated"], bad
            v, right = before, b["first_role"]


def walks(codes: bytes, after: tuple[int, ...], first: bool, last: bool) -> tuple[list[str], list[int]]:
    """Edits and the state left, for each state the block could be entered in; a conversation's ``first`` block is entered at the start."""
    points = checkpoints(codes, after)
    found = [walk(codes, s, points, last) if s == START or not first else ("", s) for s in range(4)]
    return [a for a, _ in found], [s for _, s in found]


def _walks(batches):
    memo = {}
    for b in batches:
        exits, audits = [], []
        for codes, v, blk, last in zip(*[b.column(c).to_pylist() for c in ("codes", "after", "blk", "last")]):
            found = _remembered(memo, (codes, tuple(v), blk == 0, last), walks)
            audits.append(found[0])
            exits.append(found[1])
        own = [b.column(c) for c in ("conv", "blk", "cost", "blank", "duplicate", "truncated", "illegal")]
        yield pa.RecordBatch.from_arrays(
            [*own, pa.array(audits, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int32()))],
            names=["conv", "blk", "cost", "blank", "duplicate", "truncated", "illegal", "audits", "exits"],
        )


def _chain(blocks: Iterator[dict]) -> Iterator[tuple]:
    for _, own in itertools.groupby(blocks, key=lambda b: b["conv"]):
        state = START
        for b in own:
            yield b["conv"], b["blk"], state, b["audits"][state], b["cost"], b["blank"], b["duplicate"], b["truncated"], b["illegal"]
            state = b["exits"][state]


def _digests(rows: Iterator[dict]) -> Iterator[tuple]:
    """Per conversation the digest of what its block audits leave of its turns; a block's audit comes before its turns."""
    for conv, own in itertools.groupby(rows, key=lambda r: r["conv"]):
        digest, first = hashlib.sha256(), True
        for r in own:
            if r["kind"] == 0:
                turns = ((t["role"], t["text"]) for t in own)
                for role, text in repaired(turns, iter(r["text"]), r["state"]):
                    digest.update((("" if first else "\n") + role + ":" + text).encode())
                    first = False
        yield conv, digest.hexdigest()


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The damage of the contract, by crc32 of ``conv:turn`` modulo 20: (conv, turn, role, text, copy). Null parts count as one space."""
    q = lambda c: F.coalesce(df[f"`{c}`"].cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(q(conv), F.lit(":"), q(turn)).cast("binary")) % 20
    new = F.when(hit == 1, F.lit("")).when(hit == 2, F.translate(q(text), ".!?", "")).otherwise(q(text))
    copies = F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1)
    rows = df.select(
        df[f"`{conv}`"].alias("conv"), df[f"`{turn}`"].cast("long").alias("turn"), F.when(hit == 4, F.lit("user")).otherwise(q(role)).alias("role"),
        new.alias("text"), F.array_repeat(F.lit(0), copies).alias("again"),
    )
    return rows.select("conv", "turn", "role", "text", F.posexplode("again").alias("copy", "zero")).drop("zero")


def repair(df: DataFrame, conv: str = "conv", turn: str = "turn", role: str = "role", text: str = "text") -> dict[str, DataFrame]:
    """Cheapest repair of each conversation.

    Gives three tables: ``conversations`` (conv, key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), ``blocks`` with the
    edits of each ``BLOCK`` turns (key, blk, state, audit) and ``turns`` (conv, key, turn, role, text, pos); ``apply`` makes the repaired turns of the last two.

    Turns stand by ``turn`` (nulls first), equal ones by role, then text. Null roles and texts count as one space, a null ``conv`` is a conversation of its own;
    roles are told by their first letter, an empty role by none. Repeated rows are turns of their own (later ones duplicates). Texts are read whole,
    whatever their length; conversations may have any number of turns. An empty table gives empty tables; other columns are not looked at.
    """
    q = lambda c: F.coalesce(df[f"`{c}`"].cast("string"), F.lit(" "))
    name = df[f"`{conv}`"]
    rows = df.select(
        name.alias("conv"), F.coalesce(F.concat(F.lit("="), name.cast("string")), F.lit("")).alias("key"), df[f"`{turn}`"].cast("long").alias("turn"),
        q(role).alias("role"), q(text).alias("text"),
    )
    ranks = ranked(rows, ["key"], ["turn", "role", "text"], "pos")
    numbered = save(ranks, "turns")
    discard(ranks)
    sign = F.sha2(F.concat_ws("\x00", F.length("key").cast("string"), "key", F.length("role").cast("string"), "role", "text"), 256)
    code = F.call_function("instr", F.lit("sua"), F.substring("role", 1, 1))
    code = F.when(F.col("role") == "", 0).otherwise(code)
    full = F.col("text").rlike(f"[^{SPACE}]")
    ended = F.col("text").rlike(rf"[.!?][{SPACE}]*\z")
    signed = save(numbered.select("key", "pos", "turn", sign.alias("sign"), code.alias("role"), full.alias("full"), ended.alias("ended")), "turn-codes")
    seen = signed.where("full").groupBy("sign").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1").select("sign", "first")
    # exact copies only: few signs, and the join is dealt anew by AQE if one of them holds many turns
    coded = signed.join(seen, "sign", "left")
    fault = F.when(~F.col("full"), BLANK).when(F.col("pos") > F.col("first"), DUPLICATE).when(~F.col("ended"), SHORT).otherwise(CLEAN)
    coded = coded.select(F.col("key").alias("conv"), F.floor(F.col("pos") / BLOCK).cast("long").alias("blk"), F.struct("pos", (F.col("role") + 4 * fault).alias("code")).alias("t"))
    packed = coded.groupBy("conv", "blk").agg(F.collect_list("t").alias("turns"))  # BLOCK turns at most
    blocks = _stream(packed, "conv", ["blk"], "conv string, blk long, codes binary, costs array<long>, blank long, duplicate long, truncated long, illegal long, first_role int, last_role int", _pack)
    vectors = _stream(blocks, "conv", [F.desc("blk")], "conv string, blk long, codes binary, after array<long>, last boolean, cost long, blank long, duplicate long, truncated long, illegal long", _vectors)
    entered = vectors.mapInArrow(_walks, "conv string, blk long, cost long, blank long, duplicate long, truncated long, illegal long, audits array<string>, exits array<int>")
    chained = save(_stream(entered, "conv", ["blk"], "conv string, blk long, state int, audit string, cost long, blank long, duplicate long, truncated long, illegal long", _chain), "audits")
    counts = chained.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        F.min_by("cost", "blk").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("blk", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    gaps = signed.groupBy("key", "turn").agg(F.lit(1).alias("one")).groupBy("key")
    gaps = gaps.agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")).withColumnRenamed("key", "conv")
    edits = chained.select("conv", (F.col("blk") * BLOCK).alias("pos"), F.lit(0).alias("kind"), "state", F.lit("").alias("role"), F.col("audit").alias("text"))
    turns = numbered.select(F.col("key").alias("conv"), "pos", F.lit(1).alias("kind"), F.lit(0).alias("state"), "role", "text")
    digests = _stream(edits.unionByName(turns), "conv", ["pos", "kind"], "conv string, repaired_sha256 string", _digests)
    names = numbered.groupBy("key").agg(F.first("conv").alias("id")).withColumnRenamed("key", "conv")
    found = counts.join(gaps, "conv").join(digests, "conv").join(names, "conv").withColumnRenamed("conv", "key").withColumnRenamed("id", "conv")
    own = ["conv", "key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {"conversations": found.select(*own), "blocks": chained.select(F.col("conv").alias("key"), "blk", "state", "audit"), "turns": numbered}


def _apply(rows: Iterator[dict]) -> Iterator[tuple]:
    for conv, own in itertools.groupby(rows, key=lambda r: r["conv"]):
        at = 0
        for r in own:
            if r["kind"] == 0:
                turns = ((t["role"], t["text"]) for t in own)
                for role, text in repaired(turns, iter(r["text"]), r["state"]):
                    yield conv, at, role, text
                    at += 1


def apply(tables: dict[str, DataFrame]) -> DataFrame:
    """The repaired turns (key, turn from 0, role, text) of what ``repair`` gave."""
    edits = tables["blocks"].select(F.col("key").alias("conv"), (F.col("blk") * BLOCK).alias("pos"), F.lit(0).alias("kind"), "state", F.lit("").alias("role"), F.col("audit").alias("text"))
    turns = tables["turns"].select(F.col("key").alias("conv"), "pos", F.lit(1).alias("kind"), F.lit(0).alias("state"), "role", "text")
    return _stream(edits.unionByName(turns), "conv", ["pos", "kind"], "key string, turn long, role string, text string", _apply)
