"""Merkle manifest of a dataset: one tree per source over its rows by id, one tree over the sources, and a proof for every row.

Rows are hashed by Spark and numbered within their source by range partitions. 16^3 consecutive rows form a block; it hashes its own three
levels alone. Above, blocks meet in a butterfly: in round r, 16 neighbouring subtrees of 16^r blocks form a group, and block p of each of them swaps
the root of its subtree with block p of the others. Each of them then hashes the 16 roots itself, so that after the last round every block holds
the root and, from the rounds it took part in, its whole upper proof; nothing is sent down again. The last subtree of a source
may have fewer blocks than its neighbours: its blocks then stand in for the missing ones in turn (block p also sends as p + m, p + 2m, …), and so do
sources with fewer blocks than their neighbours when the sources meet in the last rounds.

A group holds 16 messages and at most 16 receivers at any size of source. A block's proof has 15 digests a level, so it grows with the logarithm of the
rows. Round tables are written to the shared folder, so a lost executor costs a round at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.operators.graph import lookup, ranked
from tessella.session import discard, save

FANOUT = 16
DEPTH = 3  # levels inside a block
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
LEVEL = "array<struct<at:int,run:array<string>>>"  # per level: the place in the run and the digests of the whole run


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def _levels(leaves: list[str], nodes: int) -> list[list[str]]:
    """The levels of a block from its leaves up to what it sends out; ``nodes``: leaves of the whole source."""
    out = [leaves]
    while nodes > 1 and len(out) <= DEPTH:
        low = out[-1]
        out.append([digest(*low[i : i + FANOUT]) for i in range(0, len(low), FANOUT)])
        nodes = -(-nodes // FANOUT)
    return out


def _block_root(group: pd.DataFrame) -> pd.DataFrame:
    g = group.sort_values("pos")
    top = _levels(list(g["leaf"]), int(g["n"].iloc[0]))[-1]
    return pd.DataFrame({"src": g["src"].iloc[:1], "blk": g["blk"].iloc[:1], "root": top})


def _meet(state: DataFrame) -> DataFrame:
    """One round. ``state``: src, blk, root, proof and for the round the group (meet, two longs), the subtree's place in it (at), the block's number in
    the subtree (p), the subtree's blocks (m) and those of the largest subtree of the group (width)."""
    sends = state.withColumn("i", F.explode(F.sequence("p", F.greatest(F.col("width") - 1, F.col("p")), F.col("m"))))
    receiver = F.when(F.col("i") == F.col("p"), F.struct("src", "blk", "at", "proof"))
    told = sends.groupBy("meet", "i").agg(
        F.array_sort(F.collect_list(F.struct("at", "root"))).alias("runs"), F.collect_list(receiver).alias("who")
    )  # FANOUT messages at most
    run = F.transform("runs", lambda x: x["root"])
    return told.select(F.explode("who").alias("w"), F.sha2(F.array_join(run, ""), 256).alias("root"), run.alias("run")).select(
        "w.src", "w.blk", "root", F.concat("w.proof", F.array(F.struct(F.col("w.at").cast("int").alias("at"), "run"))).alias("proof")
    )


def _swap_in_sources(state: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """Rounds between the blocks of one source, until each source has one root."""
    reach = 1
    while reach < most:  # a source of n blocks takes part while n > reach
        s = state.join(sizes.select("src", "blocks"), "src")
        wide = reach * FANOUT
        busy = s.where(F.col("blocks") > reach)
        start = F.col("blk") - F.col("blk") % reach
        busy = busy.select(
            "src", "blk", "root", "proof",
            F.struct("src", F.floor(F.col("blk") / wide).cast("long").alias("g")).alias("meet"),
            (F.floor(F.col("blk") / reach) % FANOUT).alias("at"),
            (F.col("blk") % reach).alias("p"),
            F.least(F.lit(reach), F.col("blocks") - start).alias("m"),
            F.least(F.lit(reach), F.col("blocks") - (F.col("blk") - F.col("blk") % wide)).alias("width"),
        )
        new = save(_meet(busy).unionByName(s.where(F.col("blocks") <= reach).select("src", "blk", "root", "proof")), "manifest-round")
        discard(state)
        state, reach = new, wide
    return state


def _swap_sources(state: DataFrame, sizes: DataFrame, sources: int) -> DataFrame:
    """Rounds between sources: subtrees are runs of 16^r sources with all their blocks, numbered through."""
    reach = 1
    while reach < sources:
        c = F.floor(F.col("src") / reach).cast("long")
        child = sizes.groupBy(c.alias("child")).agg(F.min("first").alias("start"), F.sum("blocks").alias("m"))
        group = child.groupBy(F.floor(F.col("child") / FANOUT).cast("long").alias("g")).agg(F.max("m").alias("width"))
        known = child.withColumn("g", F.floor(F.col("child") / FANOUT).cast("long")).join(group, "g")
        plan = save(sizes.withColumn("child", c).join(known, "child").select("src", "first", "start", "m", "width", "child", "g"), "manifest-plan")
        s = lookup(state, "src", plan, state.count()).select(
            "src", "blk", "root", "proof",
            F.struct(F.lit(-1).cast("long").alias("src"), "g").alias("meet"),
            (F.col("child") % FANOUT).alias("at"),
            (F.col("first") - F.col("start") + F.col("blk")).alias("p"),
            "m",
            "width",
        )
        new = save(_meet(s), "manifest-round")
        discard(state)
        discard(plan)
        state, reach = new, reach * FANOUT
    return state


def _prove(key, leaves: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
    g = leaves.sort_values("pos").reset_index(drop=True)
    levels = _levels(list(g["leaf"]), int(g["n"].iloc[0]))
    upper = [(int(x["at"]), list(x["run"])) for x in block["proof"].iloc[0]]
    proofs, folded = [], []
    for i, start in enumerate(g["other"].where(g["other"].notna(), g["leaf"])):
        path, at = [], i
        for level in levels[:-1]:
            low = at - at % FANOUT
            path.append((at - low, level[low : low + FANOUT]))
            at //= FANOUT
        h, beside = start, []
        for own, run in path + upper:
            beside += run[:own] + run[own + 1 :]
            h = digest(*run[:own], h, *run[own + 1 :])
        proofs.append(digest(*beside))
        folded.append(h)
    out = g[["id", "leaf"]].copy()
    for c in ("subroot", "root"):
        out[c] = block[c].iloc[0]
    return out.assign(proof_sha256=proofs, folded_root=folded, verified=[h == block["root"].iloc[0] for h in folded])


def build(
    df: DataFrame,
    columns: Sequence[str] = COLUMNS,
    id: str = "doc_id",
    source: str = "source",
    changed: dict[str, Column] | None = None,
    when: Column | None = None,
) -> DataFrame:
    """A row per row of ``df``: ``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (digest of all siblings, leaf to root), ``folded_root`` (from the
    leaf as found later: with the columns ``changed`` in rows for which ``when`` holds) and ``verified``, whether that gives the root.

    A null source is the first source, null ids are the
    first rows of a source; equal ids stand in order of their leaves, so repeated rows are leaves of their own. Nulls and empty texts have
    different leaves. Texts are hashed whole. An empty table gives no row. Columns not in ``columns`` are not looked at, whatever they are called.
    """
    block = FANOUT**DEPTH
    rows = with_leaves(df, columns, id, source, changed, when)
    rows = save(ranked(rows, ["key"], ["id", "leaf"], "pos"), "manifest-leaves")
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / block).cast("long"))
    sizes = save(ranked(sizes, [], ["key"], "src", total="blocks"), "manifest-sources")
    sizes = sizes.select("key", F.col("src").cast("long").alias("src"), "n", "blocks", (F.col("upto") - F.col("blocks")).cast("long").alias("first"))
    total, most, sources = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.max("blocks"), F.count("*")).first()
    placed = lookup(rows, "key", sizes, total).select("id", "leaf", "other", "pos", "n", "src", F.floor(F.col("pos") / block).cast("long").alias("blk"))
    state = placed.select("src", "blk", "pos", "n", "leaf").groupBy("src", "blk").applyInPandas(_block_root, "src long, blk long, root string")
    state = save(state.withColumn("proof", F.expr(f"cast(array() as {LEVEL})")), "manifest-blocks")
    state = _swap_in_sources(state, sizes, most or 0)
    # the root of the source is kept beside the state while the sources meet
    inner = state.select("src", "blk", F.col("root").alias("subroot"))
    kept = save(inner, "manifest-subroots")
    state = _swap_sources(state, sizes, sources)
    state = state.join(kept, ["src", "blk"])
    out = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    proved = placed.withColumn("id", F.col("id").cast("string")).groupBy("src", "blk").cogroup(state.groupBy("src", "blk")).applyInPandas(_prove, out)
    return proved.withColumn("id", F.col("id").cast(placed.schema["id"].dataType))


def with_leaves(df: DataFrame, columns: Sequence[str], id: str, source: str, changed: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """``(key, id, leaf, other)``: the leaf of each row and, ``when`` that holds, its leaf with the columns ``changed``."""
    q = lambda c: df[f"`{c}`"]
    own = [q(c) for c in columns]
    other = F.when(when, leaf([(changed or {}).get(c, q(c)) for c in columns])) if when is not None else F.lit(None).cast("string")
    return df.select(
        F.coalesce(F.concat(F.lit("="), q(source).cast("string")), F.lit("")).alias("key"), q(id).alias("id"), leaf(own).alias("leaf"), other.alias("other")
    )
