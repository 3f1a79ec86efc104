"""Removal of every byte that lies in a long string occurring elsewhere, over a distributed suffix sort.

Only suffixes at anchors are sorted: the anchor of a window of ``LENGTH`` bytes is the place among its first ``REACH`` with the smallest
hash of the next bytes, so equal windows have their anchor at the same offset and every window has one. Fingerprints of the
bytes right of each anchor are counted first; suffixes whose beginning occurs once leave before any text is exchanged. Tasks then
sort the suffixes left (each followed by the bytes before its anchor, reversed), front-code the sorted runs, and send ranges of them to
their merger. A loser tree merges the runs by their common prefix lengths: heads with different lengths are ordered without
touching a byte, equal ones are compared from the known prefix on. Neighbours with a long common prefix form an interval; the windows
around its anchors are compared within it.

Equal suffixes count once per text and once per run. Anchors whose fingerprint still starts more than ``HOT`` suffixes could make an
interval too large for a task; their windows are counted by a plain aggregation instead, which spreads and pre-aggregates.
"""

from __future__ import annotations

import bisect
import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import add_columns, text_of
from tessella.session import save

LENGTH = 200  # bytes of a window
REACH = 150  # places of a window its anchor is chosen from
RIGHT = LENGTH - REACH + 1  # bytes right of an anchor that all its windows share
GRAM = 16  # bytes hashed at a place
HOT = 200_000
SAMPLE = 64  # one fingerprint in so many may become a splitter
SPLITTERS = 8_192  # sampled suffixes collected, at most
PART = 20_000  # anchors of a merge, about
RUN_BYTES = 32 << 20  # suffix bytes a task holds before it sends a run
BASE = 0x9E3779B97F4A7C15


def _table():
    import numpy as np

    return np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)


def _power(n: int):
    import numpy as np

    return np.uint64(pow(BASE, n, 1 << 64))


def _mixed(x):
    import numpy as np

    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def anchors(data: bytes, table):
    """Arrays ``(place, first, last, fingerprint)``: each anchor with the first and last window start it serves."""
    import numpy as np

    n = len(data)
    if n < LENGTH:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    h1 = table[np.frombuffer(data, np.uint8)]
    h2 = h1[:-1] * _power(1) + h1[1:]
    x = h2
    for k in (2, 4, 8):
        x = x[:-k] * _power(k) + x[k:]
    v = (_mixed(x) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(x), dtype=np.uint64)
    width = 1
    while 2 * width <= REACH:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    rest = REACH - width
    v = np.minimum(v[: len(v) - rest], v[rest:]) if rest else v
    at = (v[: n - LENGTH + 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(at) - 1]])
    a = at[first]
    f = x[a] * _power(16) + x[a + 16]
    f = f * _power(16) + x[a + 32]
    f = f * _power(2) + h2[a + 48]
    f = f * _power(1) + h1[a + 50]
    return a, first, last, _mixed(f).view(np.int64)


def suffix(data: bytes, a: int, first: int, last: int) -> bytes:
    """What is sorted: the bytes from the anchor on, those before it reversed, and what windows of it there are."""
    right = data[a : a + LENGTH]
    left = data[max(0, a - REACH + 1) : a]
    return right.ljust(LENGTH, b"\0") + left[::-1] + bytes((len(right), a - last, a - first))


def common(x: bytes, y: bytes, at: int) -> int:
    """Length of the common prefix, known to be at least ``at``."""
    n = min(len(x), len(y))
    while at < n and x[at : at + 32] == y[at : at + 32]:
        at += 32
    if at >= n:
        return n
    step = 16
    while step:
        if x[at : at + step] == y[at : at + step]:
            at += step
        step >>= 1
    return min(at, n)


def front_coded(run: list[tuple[bytes, bool]]) -> bytes:
    """A sorted run of distinct suffixes, each as the length it shares with the one before and the rest."""
    import array
    import pickle

    import zstandard

    shared, sizes, parts, before = array.array("H"), array.array("H"), [], b""
    for s, _ in run:
        k = common(before, s, 0)
        shared.append(k)
        sizes.append(len(s) - k)
        parts.append(s[k:])
        before = s
    data = pickle.dumps((shared.tobytes(), sizes.tobytes(), b"".join(parts), bytes(many for _, many in run)), 5)
    return zstandard.compress(data, 3)


def decoded(run: bytes):
    """``(shared, suffix, several)`` of each entry of a front-coded run."""
    import array
    import pickle

    import zstandard

    a, b, text, many = pickle.loads(zstandard.decompress(run))
    shared, sizes = array.array("H", a), array.array("H", b)
    at, before = 0, b""
    for k, n, m in zip(shared, sizes, many):
        before = before[:k] + text[at : at + n]
        at += n
        yield k, before, bool(m)


def merge(runs: list):
    """``(shared, suffix, several)`` in order, ``shared`` with the one before; a loser tree over iterators of ``decoded``."""
    size = 1
    while size < max(len(runs), 1):
        size *= 2
    heads: list = [None] * size
    known = [0] * size  # prefix shared with the suffix given out last
    several = [False] * size

    def advance(r: int) -> None:
        got = next(runs[r], None) if r < len(runs) else None
        if got is None:
            heads[r], known[r] = None, -1
        else:
            known[r], heads[r], several[r] = got

    def wins(x: int, y: int) -> bool:
        """Whether x goes before y; the loser's known prefix is set against the winner."""
        kx, ky = known[x], known[y]
        if kx != ky:
            return kx > ky
        if kx < 0:
            return True
        a, b = heads[x], heads[y]
        k = common(a, b, kx)
        first = k == len(a) or k < len(b) and a[k] < b[k]
        known[y if first else x] = k
        return first

    losers = [0] * size
    for r in range(size):
        advance(r)
        if heads[r] is not None:
            known[r] = 0
    winners = list(range(size))
    level = size
    while level > 1:
        nxt = []
        for i in range(0, level, 2):
            x, y = winners[i], winners[i + 1]
            node = level // 2 + i // 2
            if wins(x, y):
                losers[node] = y
                nxt.append(x)
            else:
                losers[node] = x
                nxt.append(y)
        winners, level = nxt, level // 2
    best = winners[0]
    while heads[best] is not None:
        yield known[best], heads[best], several[best]
        advance(best)
        node = (size + best) // 2
        while node:
            if not wins(best, losers[node]):
                best, losers[node] = losers[node], best
            node //= 2


def _intervals(stream):
    """Lists of ``[suffix, several]`` that share their first ``RIGHT`` bytes, equal suffixes as one."""
    group: list = []
    for shared, s, many in stream:
        if group and shared >= RIGHT:
            if shared == len(s) == len(group[-1][0]):
                group[-1][1] = True
            else:
                group.append([s, many])
        else:
            if group:
                yield group
            group = [[s, many]]
    if group:
        yield group


def _repeated(groups: list, table):
    """``(suffix, [(from, to), ...])``: offsets (anchor minus start) of the windows of each suffix that occur twice."""
    import numpy as np

    members = [x for g in groups for x in g]
    m = len(members)
    who = np.repeat(np.arange(len(groups), dtype=np.uint64), [len(g) for g in groups])
    flat = b"".join(s[LENGTH:-3].ljust(REACH - 1, b"\0")[::-1] + s[:LENGTH] for s, _ in members)
    x = np.frombuffer(flat, np.uint8).reshape(m, REACH - 1 + LENGTH)
    low = np.array([s[-2] for s, _ in members])
    high = np.array([s[-1] for s, _ in members])
    good = np.zeros((m, REACH), bool)
    h = np.zeros(m, np.uint64)
    for i in range(LENGTH):
        h = h * np.uint64(BASE) + table[x[:, i]]
    salt, first = who * np.uint64(0xA24BAED4963EE407), _power(LENGTH - 1)
    for c in range(REACH):  # the window that starts at column c, by a rolling hash over all members at once
        j = REACH - 1 - c
        i = np.flatnonzero((low <= j) & (j <= high))
        if len(i):
            keys = _mixed(_mixed(h[i]) + salt[i])
            order = np.argsort(keys)
            same = keys[order[1:]] == keys[order[:-1]]
            good[i[order[1:][same]], j] = True
            good[i[order[:-1][same]], j] = True
        if j:
            h = (h - table[x[:, c]] * first) * np.uint64(BASE) + table[x[:, c + LENGTH]]
    for i, (_, many) in enumerate(members):
        if many:
            good[i, low[i] : high[i] + 1] = True
    padded = np.zeros((m, REACH + 2), np.int8)
    padded[:, 1:-1] = good
    edge = np.diff(padded, axis=1)
    begin, end = np.nonzero(edge == 1), np.nonzero(edge == -1)
    out: list = [[] for _ in range(m)]
    for i, a, b in zip(begin[0].tolist(), begin[1].tolist(), end[1].tolist()):
        out[i].append((a, b - 1))
    return [(s, r) for (s, _), r in zip(members, out) if r]


def _digest(s: bytes) -> tuple[int, int]:
    import xxhash

    x = xxhash.xxh3_128_intdigest(s)
    return (x >> 64) - (1 << 63), (x & (1 << 64) - 1) - (1 << 63)


def repeated_windows(docs: DataFrame, text: str = "text", hot: int = HOT) -> DataFrame:
    """``(k, n, a, low, high)``: windows that occur elsewhere, per text given by its hash and size: those that start from ``high`` to
    ``low`` bytes before each place of ``a``, for each pair of the two lists."""
    keyed = docs.select(text_of(docs, text).alias("t"))
    keyed = keyed.select(F.xxhash64("t").alias("k"), F.octet_length("t").alias("n"), "t").where(F.col("n") >= LENGTH)

    def prints(texts):
        import numpy as np

        table = _table()
        fps, counts, different, samples = [], [], [], []
        for t in texts:
            data = t.encode("utf-8", "surrogatepass")
            a, first, last, f = anchors(data, table)
            u, at, c = np.unique(f, return_index=True, return_counts=True)
            own = np.ones(len(u), np.int32)
            if (c > 1).any():
                seen: dict[int, set] = {}
                for i in np.flatnonzero(np.isin(f, u[c > 1])).tolist():
                    seen.setdefault(int(f[i]), set()).add(suffix(data, int(a[i]), int(first[i]), int(last[i])))
                for x, s in seen.items():
                    own[np.searchsorted(u, x)] = len(s)
            fps.append(u)
            counts.append(c.astype(np.int32))
            different.append(own)
            samples.append([{"f": int(u[i]), "s": data[a[at[i]] : a[at[i]] + RIGHT]} for i in np.flatnonzero(u % SAMPLE == 0)])
        return [fps, counts, different, samples]

    firsts = add_columns(keyed, [keyed["t"]], "f array<bigint>, c array<int>, u array<int>, s array<struct<f:bigint,s:binary>>", prints, batch_rows=1000)
    firsts = save(firsts.select("k", "n", "f", "c", "u", "s"), "fingerprints")
    rows = firsts.select("k", "n", F.explode(F.arrays_zip("f", "c", "u")).alias("x")).select("k", "n", "x.f", "x.c", "x.u")
    often = rows.groupBy("f").agg(F.sum("c").alias("c"), F.sum("u").alias("u")).where("c > 1")
    twice = save(often.select("f", "u", (F.col("u") > hot).alias("hot")), "twice")
    total = twice.where("not hot").agg(F.sum("u")).first()[0] or 0
    parts = max(1, math.ceil(total / PART))
    sample = firsts.select(F.explode("s").alias("s")).select("s.f", "s.s").join(twice.where("not hot").select("f"), "f", "left_semi")
    sample = [bytes(r.s) for r in sample.groupBy("f").agg(F.first("s").alias("s")).sort(F.xxhash64("f")).limit(SPLITTERS).select("s").sort("s").collect()]
    cuts = sorted({sample[i * len(sample) // parts] for i in range(1, parts)}) if sample else []
    need = rows.join(twice.select("f", "hot"), "f").groupBy("k", "n")
    need = need.agg(F.collect_set(F.when(~F.col("hot"), F.col("f"))).alias("fs"), F.collect_set(F.when(F.col("hot"), F.col("f"))).alias("hots"))

    def runs_of(batches):
        import numpy as np
        import pyarrow as pa

        table = _table()
        seen: set = set()
        held: dict[bytes, bool] = {}
        size = 0

        def sent():
            order = sorted(held)
            at = 0
            for p in range(len(cuts) + 1):
                end = bisect.bisect_left(order, cuts[p]) if p < len(cuts) else len(order)
                if end > at:
                    yield p, front_coded([(s, held[s]) for s in order[at:end]])
                at = end
            held.clear()

        def out(part=None, run=None, k=None, n=None, refs=None, wins=None):
            return pa.RecordBatch.from_pylist([{"part": part, "run": run, "k": k, "n": n, "refs": refs, "wins": wins}], schema=target)

        for b in batches:
            for k, n, t, fs, hots in zip(*[b.column(i).to_pylist() for i in range(5)]):
                data = t.encode("utf-8", "surrogatepass")
                a, first, last, f = anchors(data, table)
                new = (k, n) not in seen
                seen.add((k, n))
                refs: dict[bytes, list[int]] = {}
                for i in np.flatnonzero(np.isin(f, np.array(fs, np.int64))).tolist():
                    s = suffix(data, int(a[i]), int(first[i]), int(last[i]))
                    if s in held:
                        held[s] = True
                    else:
                        held[s] = False
                        size += len(s)
                    refs.setdefault(s, []).append(int(a[i]))
                refs = [dict(zip(("h1", "h2", "a"), (*_digest(s), at))) for s, at in refs.items()] if new else []
                wins = []
                for i in np.flatnonzero(np.isin(f, np.array(hots, np.int64))).tolist() if hots else ():
                    for s in range(int(first[i]), int(last[i]) + 1):
                        g1, g2 = _digest(data[s : s + LENGTH])
                        wins.append({"s": s, "g1": g1, "g2": g2})
                if refs or wins:
                    yield out(k=k, n=n, refs=refs, wins=wins)
                if size > RUN_BYTES:
                    for p, run in sent():
                        yield out(part=p, run=run)
                    size = 0
        for p, run in sent():
            yield out(part=p, run=run)

    import pyarrow as pa

    target = pa.schema(
        [
            ("part", pa.int32()),
            ("run", pa.binary()),
            ("k", pa.int64()),
            ("n", pa.int32()),
            ("refs", pa.list_(pa.struct([("h1", pa.int64()), ("h2", pa.int64()), ("a", pa.list_(pa.int32()))]))),
            ("wins", pa.list_(pa.struct([("s", pa.int32()), ("g1", pa.int64()), ("g2", pa.int64())]))),
        ]
    )
    ddl = "part int, run binary, k long, n int, refs array<struct<h1:bigint,h2:bigint,a:array<int>>>, wins array<struct<s:int,g1:bigint,g2:bigint>>"
    sorted_runs = save(keyed.join(need, ["k", "n"]).select("k", "n", "t", "fs", "hots").mapInArrow(runs_of, ddl), "runs")

    def merged(pdf):
        import pandas as pd

        table, out, batch, held = _table(), [], [], 0
        def close():
            for s, ranges in _repeated(batch, table):
                h1, h2 = _digest(s)
                out.append((h1, h2, [a for a, _ in ranges], [b for _, b in ranges]))
            batch.clear()

        for g in _intervals(merge([decoded(r) for r in pdf["run"]])):
            if len(g) > 1 or g[0][1]:
                batch.append(g)
                held += len(g)
                if held >= 10_000:
                    close()
                    held = 0
        if batch:
            close()
        return pd.DataFrame(out, columns=["h1", "h2", "low", "high"])

    found = sorted_runs.where("part is not null").groupBy("part").applyInPandas(merged, "h1 long, h2 long, low array<int>, high array<int>")
    refs = sorted_runs.where("part is null").select("k", "n", F.explode("refs").alias("r")).select("k", "n", "r.*").distinct()
    ranges = refs.join(found, ["h1", "h2"]).select("k", "n", "a", "low", "high")
    wins = sorted_runs.where("part is null").select("k", "n", F.explode("wins").alias("w")).select("k", "n", "w.*")
    copies = docs.select(F.xxhash64(text_of(docs, text)).alias("k"), F.octet_length(text_of(docs, text)).alias("n")).groupBy("k", "n").count()
    weighed = wins.join(copies, ["k", "n"])
    many = weighed.groupBy("g1", "g2").agg(F.sum("count").alias("c")).where("c > 1").select("g1", "g2")
    more = wins.join(many, ["g1", "g2"], "left_semi").groupBy("k", "n").agg(F.collect_list("s").alias("a"))
    more = more.select("k", "n", "a", F.expr("array(0)").alias("low"), F.expr("array(0)").alias("high"))
    return ranges.unionByName(more)


def remove(docs: DataFrame, text: str = "text", hot: int = HOT) -> DataFrame:
    """``docs`` with ``n_bytes``, ``removed_spans`` (array of (start, end) in bytes, merged, end exclusive) and ``kept`` (binary).

    A byte of the text's UTF-8 form goes if it lies in a string of ``LENGTH`` bytes that also starts anywhere else, in any row or in
    the same text; overlapping occurrences count, matches stay within one row's text. Null counts as empty. Every row is a text of its
    own, so a repeated row of that length or more is removed whole. All other columns pass through.
    """
    spans = repeated_windows(docs, text, hot).groupBy("k", "n").agg(F.collect_list(F.struct("a", "low", "high")).alias("spans"))  # of one text
    t = text_of(docs, text)
    names = [f"c{i}" for i in range(len(docs.columns))]
    wide = docs.select(*[docs[f"`{c}`"] for c in docs.columns], F.xxhash64(t), F.octet_length(t)).toDF(*names, "k", "n")
    wide = wide.join(spans, ["k", "n"], "left").drop("k", "n")

    def run(texts, found):
        sizes, removed, kept = [], [], []
        for x, spans in zip(texts, found):
            data = x.encode("utf-8", "surrogatepass")
            merged: list[list[int]] = []
            for s, e in sorted((a - y, a - x + LENGTH) for r in spans or () for a in r["a"] for x, y in zip(r["low"], r["high"])):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(e, merged[-1][1])
                else:
                    merged.append([s, e])
            parts, at = [], 0
            for s, e in merged:
                parts.append(data[at:s])
                at = e
            sizes.append(len(data))
            removed.append([{"start": s, "end": e} for s, e in merged])
            kept.append(b"".join(parts) + data[at:])
        return [sizes, removed, kept]

    at = names[docs.columns.index(text)]
    out = add_columns(wide, [text_of(wide, at), wide["spans"]], "n_bytes bigint, removed_spans array<struct<start:int,end:int>>, kept binary", run, batch_rows=1000)
    added = ("n_bytes", "removed_spans", "kept")
    return out.select(*[out[n].alias(c) for n, c in zip(names, docs.columns) if c not in added], *added)
