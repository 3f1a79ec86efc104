"""Merkle manifest against SQL and against plain trees, with few rows a block so that many blocks meet."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from compare import DATA, connect, differences
from tessella.llm import manifest
from tessella.llm.queries import QUERIES, SQL


def h(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves, fanout):
    """Root and, for every leaf, its run and place at each level."""
    paths, at = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        for i, p in enumerate(paths):
            low = at[i] - at[i] % fanout
            p.append((at[i] - low, leaves[low : low + fanout]))
            at[i] //= fanout
        leaves = [h(*leaves[i : i + fanout]) for i in range(0, len(leaves), fanout)]
    return leaves[0], paths


def expected(rows, fanout):
    """rows: (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, h(*map(field, r)), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    inner = {s: tree([x[2] for x in sorted(by[s])], fanout) for s in names}
    root, above = tree([inner[s][0] for s in names], fanout)
    out = []
    for k, s in enumerate(names):
        for (_, _, leaf, r), path in zip(sorted(by[s]), inner[s][1]):
            now = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
                now = h(*map(field, (*r[:4], low)))
            beside = []
            for at, run in path + above[k]:
                beside += run[:at] + run[at + 1 :]
                now = h(*run[:at], now, *run[at + 1 :])
            out.append((r[0], leaf, inner[s][0], root, h(*beside), now, now == root))
    return sorted(out, key=str)


def build(df):
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return manifest.build(df, changed={"text": low}, when=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def test_query_equals_sql(spark):
    assert differences(QUERIES["op13_manifest"](spark, str(DATA / "sf0.01")), connect(DATA / "sf0.01"), SQL["op13_manifest"]) is None


@pytest.mark.parametrize("fanout, depth, seed", [(2, 1, 1), (3, 2, 2), (16, 3, 4)])
def test_many_blocks(spark, monkeypatch, fanout, depth, seed):
    """Sources of very different sizes: blocks and sources stand in for those that are missing in a round."""
    monkeypatch.setattr(manifest, "FANOUT", fanout)
    monkeypatch.setattr(manifest, "DEPTH", depth)
    rnd = random.Random(seed)
    rows = []
    for s, n in [(None, 1), ("", 2), ("a", 37), ("b", 1), ("B", 9), ("é", 16), ("\U0001f600", 17), ("￮", 3), ("z", 1)]:
        for _ in range(n):
            rows.append((rnd.choice([None, rnd.randrange(99), 2**60 + rnd.randrange(9)]), s, rnd.choice([None, "en"]), rnd.choice([None, 3]), rnd.choice([None, "", "Ab", "aé", "Z" * 9000])))
    got = build(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows, fanout)


def test_edges(spark):
    one = spark.createDataFrame([(5, "s", None, None, "X", 1, 2, "k")], SCHEMA + ", src int, blk int, key string")
    (r,) = build(one).collect()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == h() and r.id == 5
    assert build(one.limit(0)).count() == 0
    twice = build(one.union(one)).collect()
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0].subroot == h(r.leaf, r.leaf)
