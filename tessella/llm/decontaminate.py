"""Benchmark decontamination: find the words of training texts that lie in a window of benchmark words.

A broadcast hash set of the benchmark's normalised n-grams meets a rolling hash over each whole text; every hit is verified
word by word, so hash collisions cannot mark anything. Benchmarks are taken in blocks of a bounded size, one after the
other, so what is broadcast never grows with the data.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import add_columns, text_of, worker_cached
from tessella.session import save

WINDOW = 13
BLOCK_BYTES = 16 << 20  # benchmark text broadcast at a time
# Fixed value: bytes that separate words; A-Z become lower case, all bytes from 0x80 on belong to words.
_BREAKS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
TABLE = bytes(32 if b in set(_BREAKS) else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split()


class Index:
    """The windows of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        import numpy as np

        self.window = window
        self.code: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple, list[int]]] = {}
        for item, text in items:
            w = tuple(self.code.setdefault(x, len(self.code) + 1) for x in words(text))
            n = min(len(w), window)
            for i in range(len(w) - n + 1) if n else ():
                who = by_length.setdefault(n, {}).setdefault(w[i : i + n], [])
                if not who or who[-1] != item:
                    who.append(item)
        mult = np.random.default_rng(7).integers(1, 1 << 62, window, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.mult = mult
        self.grams = {}
        for n, grams in by_length.items():
            keys = np.array(list(grams), np.uint64) * mult[:n]
            self.grams[n] = (np.unique(keys.sum(axis=1, dtype=np.uint64)), grams)

    def hits(self, text: str) -> Iterator[tuple[int, int, list[int]]]:
        """First the number of words, then ``(start, length, items)`` of each window in the text."""
        import numpy as np

        w = words(text)
        yield len(w), 0, []
        ids = np.fromiter(map(self.code.get, w, (0 for _ in w)), np.uint64, len(w))
        if not ids.any():
            return
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        for n, (hashes, grams) in self.grams.items():
            if len(w) < n:
                continue
            at = np.flatnonzero(known[n:] - known[:-n] == n)  # places whose n words all occur in the benchmark
            if not len(at):
                continue
            h = np.zeros(len(at), np.uint64)
            for k in range(n):
                h += ids[at + k] * self.mult[k]
            i = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for s in at[hashes[i] == h].tolist():
                who = grams.get(tuple(ids[s : s + n].tolist()))
                if who:
                    yield s, n, who


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (array of (start, end) in words, merged, end exclusive) and ``hit_items``
    (array of item ids, distinct, ascending).

    A window is ``window`` consecutive words of an item, or all words of a shorter item that has any. Every row stands
    alone (no shuffle); null text has no words; items without words or id match nothing; an empty benchmark hits nothing.
    Repeated items count once per id. Columns of ``docs`` pass through under any name.
    """
    spark = docs.sparkSession
    b = benchmark.select(benchmark[f"`{item}`"].cast("long").alias("i"), text_of(benchmark, item_text).alias("t")).where("i is not null")
    size = b.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    out = docs.withColumns({"n_words": F.lit(0).cast("long"), "hit_spans": F.expr("cast(array() as array<struct<start:int,end:int>>)"), "hit_items": F.expr("cast(array() as array<bigint>)")})
    for k in range(blocks):
        rows = [(r.i, r.t) for r in b.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).sort("i").collect()]  # about BLOCK_BYTES
        shared = spark.sparkContext.broadcast(rows)

        def run(texts, spans, found, shared=shared, key=uuid.uuid4().hex):
            index = worker_cached("decontaminate", key, lambda: Index(shared.value, window))
            n_words, n_spans, n_found = [], [], []
            for t, had, had_items in zip(texts, spans, found):
                it = index.hits(t)
                n_words.append(next(it)[0])
                ranges, who = [(x["start"], x["end"]) for x in had], set(had_items)
                for s, n, items in it:
                    ranges.append((s, s + n))
                    who.update(items)
                merged: list[list[int]] = []
                for s, e in sorted(ranges):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(e, merged[-1][1])
                    else:
                        merged.append([s, e])
                n_spans.append([{"start": s, "end": e} for s, e in merged])
                n_found.append(sorted(who))
            return [n_words, n_spans, n_found]

        out = add_columns(
            out,
            [text_of(out, text), out["hit_spans"], out["hit_items"]],
            "n_words bigint, hit_spans array<struct<start:int,end:int>>, hit_items array<bigint>",
            run,
            batch_rows=1000,
        )
        if blocks > 1:
            out = save(out, "decontaminate")
            shared.destroy()
    return out


def n_hit() -> F.Column:
    """Words inside windows, from ``hit_spans``."""
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contaminated(share: int = 20) -> F.Column:
    """At least one word in ``share`` lies in a window."""
    return (n_hit() > 0) & (F.lit(share) * n_hit() >= F.col("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **names) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns only."""
    return find(docs, benchmark, text, **names).where(~contaminated()).select(*[f"`{c}`" for c in docs.columns])
