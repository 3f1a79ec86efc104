"""Removal of repeated runs of lines.

The lines of all documents get ids; ranks of ever longer runs (1, 2, 4, ... lines) come from distributed prefix doubling, as for
a suffix array over the line ids: the rank of a run of 2n lines is the rank of the pair of its halves. Suffixes whose next
lines occur nowhere else leave the array at once. Suffixes that share a rank form the interval of the suffix array whose
common prefix has that many lines; an interval of any other length is the overlap of two ranks. Each interval is one repeated
run: its first copy stays, later copies go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import add_columns
from tessella.operators.graph import ranked
from tessella.session import save

MIN_WORDS = 25
LAST = (1 << 63) - 1


def _lines(texts, min_words: int):
    """Per text: hashes of its lines and, for each line, how many lines the shortest run of ``min_words`` words has that starts
    (ends) there, 0 if the document ends before."""
    import numpy as np
    import xxhash

    out = []
    for t in texts:
        lines = t.encode("utf-8", "surrogatepass").split(b"\n")
        words = np.array([len(x.split()) for x in lines])
        upto = np.concatenate([[0], np.cumsum(words)])
        n = len(lines)
        end = np.searchsorted(upto, upto[:-1] + max(min_words, 1), "left")
        ahead = np.where(end <= n, end - np.arange(n), 0)
        start = np.searchsorted(upto, upto[1:] - max(min_words, 1), "right") - 1
        back = np.where(start >= 0, np.arange(1, n + 1) - start, 0)
        ids = [xxhash.xxh3_128_intdigest(x) for x in lines]
        out.append([{"i": i, "hi": (h >> 64) - (1 << 63), "lo": (h & (1 << 64) - 1) - (1 << 63), "ahead": a, "back": b} for i, (h, a, b) in enumerate(zip(ids, ahead.tolist(), back.tolist()))])
    return out


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(d, k, t): order of documents, and a hash that tells documents with one id apart."""
    t = docs[f"`{text}`"]
    return docs.select(F.coalesce(docs[f"`{key}`"].cast("long"), F.lit(LAST)).alias("d"), F.xxhash64(t).alias("k"), t.alias("t"))


def repeated_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``(d, k, start, n)``: runs of ``n`` lines from line ``start`` of document ``(d, k)`` that hold at least ``min_words``
    words and occur earlier. They are the shortest such runs that start or end at a line; together they cover exactly
    the lines of all such runs."""
    spark = docs.sparkSession
    plain = _keyed(docs, text, key).where("t is not null")
    rows = add_columns(plain, [plain["t"]], "x array<struct<i:int,hi:bigint,lo:bigint,ahead:int,back:int>>", lambda ts: [_lines(ts, min_words)], batch_rows=500)
    rows = save(rows.select("d", "k", F.explode("x").alias("x")).select("d", "k", "x.*"), "lines")
    ids = ranked(rows.groupBy("hi", "lo").count().where("count > 1").select("hi", "lo"), [], ["hi", "lo"], "r")
    first = save(rows.join(ids, ["hi", "lo"]).select("d", "k", "i", "r", "ahead", "back").distinct(), "repeated")
    runs = first.where("ahead > 0").select("d", "k", F.col("i").alias("start"), F.col("ahead").alias("n"))
    runs = runs.union(first.where("back > 0").select("d", "k", (F.col("i") - F.col("back") + 1).alias("start"), F.col("back").alias("n"))).distinct()
    runs = save(runs, "runs")
    longest = runs.agg(F.max("n")).first()[0] or 0
    level, width, found = first.select("d", "k", "i", "r"), 1, None
    while width <= longest:
        here = runs.where((F.col("n") >= width) & (F.col("n") < 2 * width))
        a = level.select("d", "k", F.col("i").alias("start"), F.col("r").alias("a"))
        b = level.select("d", "k", F.col("i").alias("e"), F.col("r").alias("b"))
        here = here.join(a, ["d", "k", "start"]).withColumn("e", F.col("start") + F.col("n") - width).join(b, ["d", "k", "e"])
        place = F.struct("d", "k", "start")
        heads = here.groupBy("n", "a", "b").agg(F.count("*").alias("copies"), F.min(place).alias("head")).where("copies > 1")
        later = here.join(heads, ["n", "a", "b"]).where(place > F.col("head")).select("d", "k", "start", "n")
        found = later if found is None else found.unionByName(later)
        if 2 * width <= longest:
            nxt = level.select("d", "k", (F.col("i") - width).alias("i"), F.col("r").alias("r2")).where("i >= 0")
            pairs = save(level.join(nxt, ["d", "k", "i"]), "pairs")
            names = ranked(pairs.groupBy("r", "r2").count().where("count > 1").select("r", "r2"), [], ["r", "r2"], "q")
            level = save(pairs.join(names, ["r", "r2"]).select("d", "k", "i", F.col("q").alias("r")), "ranks")
            if level.isEmpty():
                break
        width *= 2
    if found is None:
        return spark.createDataFrame([], "d long, k long, start int, n int")
    return found


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the text left after removing repeated line runs, ``n_lines`` and ``removed_lines`` (array of (start, end)
    in lines, merged, end exclusive).

    A line goes if it lies in a run of consecutive lines (cut at \\n) of its document that has at least ``min_words`` words
    (pieces between ASCII white space) and whose lines also occur as a run at an earlier place: in a document with a smaller id, or
    further up in the same document. Null ids come last; documents with one id are ordered by a hash of the text; rows that
    repeat id and text are one document and all get its result. Null text stays null with 0 lines; empty text is one line.
    All columns of ``docs`` pass through; those named like an added one are replaced.
    """
    drop = repeated_runs(docs, text, key, min_words)
    spans = drop.groupBy("d", "k").agg(F.collect_set(F.struct("start", "n")).alias("spans"))  # of one document
    names = [f"c{i}" for i in range(len(docs.columns))]
    t = docs[f"`{text}`"]
    wide = docs.select(*[docs[f"`{c}`"] for c in docs.columns], F.coalesce(docs[f"`{key}`"].cast("long"), F.lit(LAST)), F.xxhash64(t)).toDF(*names, "d", "k")
    wide = wide.join(spans, ["d", "k"], "left")

    def run(texts, found):
        kept, counts, removed = [], [], []
        for x, spans in zip(texts, found):
            if x is None:
                kept.append(None), counts.append(0), removed.append([])
                continue
            lines = x.split("\n")
            merged: list[list[int]] = []
            for s, e in sorted((r["start"], r["start"] + r["n"]) for r in spans or ()):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(e, merged[-1][1])
                else:
                    merged.append([s, e])
            counts.append(len(lines))
            removed.append([{"start": s, "end": e} for s, e in merged])
            if merged:
                at, rest = 0, []
                for s, e in merged:
                    rest += lines[at:s]
                    at = e
                x = "\n".join(rest + lines[at:])
            kept.append(x)
        return [kept, counts, removed]

    at = names[docs.columns.index(text)]
    out = add_columns(wide, [wide[at], wide["spans"]], f"{at} string, n_lines bigint, removed_lines array<struct<start:int,end:int>>", run, batch_rows=1000)
    back = [out[n].alias(c) for n, c in zip(names, docs.columns) if c not in ("n_lines", "removed_lines")]
    return out.select(*back, "n_lines", "removed_lines")
