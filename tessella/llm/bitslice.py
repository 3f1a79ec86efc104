"""Exact top-k by inner product over a bit-sliced index.

Vectors are quantised to whole numbers. A block of rows holds, for every dimension, one bitmap over its rows per binary digit. A
query adds the slices its digits select, with carry-save adders on whole bitmaps, which gives the slices of all scores of the
block at once. From the most significant slice downward a bitmap of sure rows grows and one of candidates shrinks until k are found;
rows still level after the last slice have equal scores, and the smallest ids among them fill up.
"""

from __future__ import annotations

import math
import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessella.session import save

SCALE = 64
BLOCK = 16_384  # rows of a block; its slices take about 1 MB at 64 dimensions and 7 digits
CHUNK = 256  # queries that meet a block in one step
WIDE = 1 << 26  # quantised components from here on put a row into a block of its own kind, of fewer rows with more digits
LONG = (1 << 63) - 1
LIMIT = 1 << 50  # absolute value of a component from which products leave the range of the two longs of a score


def quantised(vectors: DataFrame, vec: str, key: str, scale: int = SCALE) -> DataFrame:
    """``(id, v)`` of the rows that take part, with components floor(scale * x)."""
    x = vectors.select(vectors[f"`{key}`"].cast("long").alias("id"), vectors[f"`{vec}`"].cast("array<double>").alias("e"))
    bad = F.exists("e", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= F.lit(float(LIMIT))))
    x = x.where("id is not null and e is not null and size(e) > 0").where(~bad)
    return x.select("id", F.transform("e", lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("v"))


class Block:
    """Slices of some rows, all of one dimension; rows are in order of their ids."""

    def __init__(self, ids, rows):
        import numpy as np

        order = np.argsort(ids, kind="stable")
        self.ids, rows = ids[order], rows[order].astype(np.int64)
        n, dims = rows.shape
        self.low = rows.min(axis=0)
        over = rows - self.low
        self.digits = np.array([int(x).bit_length() for x in over.max(axis=0)])
        self.words = -(-n // 64)
        width = max(1, int(self.digits.max()))
        planes = np.zeros((2, dims, width, self.words), np.uint64)
        digit = np.zeros((dims, self.words * 64), np.uint8)
        for b in range(width):
            digit[:, :n] = (over.T >> b) & 1
            planes[0, :, b] = np.packbits(digit, axis=-1, bitorder="little").view(np.uint64)
        planes[1] = ~planes[0]  # digits of the complement
        self.planes = planes.reshape(2 * dims * width, self.words)
        self.width, self.dims = width, dims
        self.valid = np.packbits(np.arange(self.words * 64) < n, bitorder="little").view(np.uint64)

    def slices(self, q):
        """``(constant, slices)``: score = constant + sum of 2^t * slice t. A negative factor takes the complement."""
        import numpy as np

        neg = q < 0
        size = np.abs(q)
        full = (1 << self.digits) - 1
        constant = sum(map(operator.mul, q.tolist(), self.low.tolist())) - sum(map(operator.mul, size[neg].tolist(), full[neg].tolist()))
        at: dict[int, list] = {}  # planes of each weight; their bitmaps are read when the weight is reached
        base = (neg * self.dims + np.arange(self.dims)) * self.width
        for digit in range(int(size.max()).bit_length()):
            chosen = np.flatnonzero((size >> digit) & 1)
            for b in range(self.width):
                rows = base[chosen[self.digits[chosen] > b]] + b
                if len(rows):
                    at.setdefault(digit + b, []).append(rows)
        out, t, carry = [], 0, []
        while t <= max(at, default=-1) or carry:
            parts = [self.planes[rows] for rows in at.get(t, [])] + carry
            cur = np.concatenate(parts) if parts else np.zeros((1, self.words), np.uint64)
            carry = []
            while len(cur) > 2:
                m = len(cur) // 3
                a, b, c = cur[:m], cur[m : 2 * m], cur[2 * m : 3 * m]
                x = a ^ b
                carry.append((a & b) | (c & x))
                cur = np.concatenate([x ^ c, cur[3 * m :]])
            if len(cur) == 2:
                carry.append(cur[:1] & cur[1:])
                cur = cur[:1] ^ cur[1:]
            out.append(cur[0])
            t += 1
        return constant, out

    def top(self, query_id: int, q, k: int) -> list[tuple[int, int]]:
        """``(id, score)`` of the block's k best rows; rows with the query's id take no part."""
        import numpy as np

        constant, slices = self.slices(q)
        maybe = self.valid.copy()
        lo, hi = np.searchsorted(self.ids, [query_id, query_id + 1])
        for r in range(lo, hi):
            maybe[r >> 6] &= ~np.uint64(1 << (r & 63))
        sure = np.zeros_like(maybe)
        for s in reversed(slices):
            x = sure | (maybe & s)
            n = int(np.bitwise_count(x).sum())
            if n > k:
                maybe = maybe & s
            else:
                sure, maybe = x, maybe & ~s
                if n == k:
                    maybe[:] = 0
                    break
        rows = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
        if len(rows) < k:
            ties = np.flatnonzero(np.unpackbits(maybe.view(np.uint8), bitorder="little"))
            rows = np.concatenate([rows, ties[: k - len(rows)]])
        word, bit = rows >> 6, (rows & 63).astype(np.uint64)
        scores = [constant] * len(rows)
        for t, s in enumerate(slices):
            for i, on in enumerate(((s[word] >> bit) & np.uint64(1)).tolist()):
                scores[i] += on << t
        return list(zip(self.ids[rows].tolist(), scores))

    def pack(self) -> bytes:
        import pickle

        return pickle.dumps(self.__dict__, 5)

    @classmethod
    def unpack(cls, data: bytes) -> Block:
        import pickle

        b = cls.__new__(cls)
        b.__dict__ = pickle.loads(data)
        return b


def _grouped(batches, size: int):
    """``(ids, rows)`` arrays of one dimension each: at most ``size`` rows, an eighth of that if they hold wide components."""
    import numpy as np

    held: dict[tuple, list] = {}
    for batch in batches:
        v = batch.column(1)
        ids = batch.column(0).to_numpy()
        dims = np.diff(v.offsets.to_numpy())
        flat, start = v.values.to_numpy(), v.offsets.to_numpy()[:-1]
        for d in np.unique(dims).tolist():
            at = np.flatnonzero(dims == d)
            rows = flat[start[at][:, None] + np.arange(d)]
            wide = (np.abs(rows) >= WIDE).any(axis=1)
            for w in (False, True):
                mine, most = wide == w, max(1, size // 8) if w else size
                if not mine.any():
                    continue
                few, own = ids[at[mine]], rows[mine]
                parts = held.setdefault((d, w), [])
                parts += [(few[i : i + most], own[i : i + most]) for i in range(0, len(few), most)]
                while sum(len(x) for x, _ in parts) >= most:
                    a, b = (np.concatenate(x) for x in zip(*parts))
                    yield a[:most], b[:most]
                    parts[:] = [(a[most:], b[most:])]
    for parts in held.values():
        a, b = (np.concatenate(x) for x in zip(*parts))
        if len(a):
            yield a, b


def build(vectors: DataFrame, vec: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """The index: one row ``(block)`` per block of up to ``BLOCK`` rows, of every row that takes part.

    Vectors that are null, empty, or hold null or non-finite components, and rows without an id, take no part. Neither do those with a
    component of 2^50 or more, whose scores are far beyond a long. Rows are dealt evenly, whatever their ids and values.
    """
    q = save(quantised(vectors, vec, key, scale), "quantised")
    n = q.count()

    def run(batches):
        import pyarrow as pa

        for ids, rows in _grouped(batches, BLOCK):
            yield pa.RecordBatch.from_pydict({"block": pa.array([Block(ids, rows).pack()], pa.binary())})

    return save(q.repartition(max(1, math.ceil(n / BLOCK))).mapInArrow(run, "block binary"), "index")


def search(index: DataFrame, queries: DataFrame, k: int, vec: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k rows of highest inner product, ties to the smaller id.

    A query meets rows with as many components as it has, except rows of its own id. Queries that would take no part in an index
    get no answer; of rows that share a query id the smallest vector asks. Repeated rows of the index are answers of their own. Queries are
    packed in chunks, and each chunk meets each block once. Ranks go by the exact scores; a score beyond the range of a long is given as the
    nearest long. Columns other than ``vec`` and ``key`` are not looked at.
    """
    import numpy as np

    q = save(quantised(queries, vec, key, scale).groupBy("id").agg(F.min("v").alias("v")), "queries")
    chunks = max(1, math.ceil(q.count() / CHUNK))
    q = q.repartition(chunks).withColumn("chunk", F.spark_partition_id())

    def pack(batches):
        import pyarrow as pa

        for b in batches:
            for c in np.unique(b.column(2).to_numpy()).tolist():
                part = b.filter(pa.array(b.column(2).to_numpy() == c))
                yield pa.RecordBatch.from_pydict({"chunk": [c], "ids": [part.column(0).to_pylist()], "vs": [part.column(1).to_pylist()]}, schema=target)

    import pyarrow as pa

    target = pa.schema([("chunk", pa.int32()), ("ids", pa.list_(pa.int64())), ("vs", pa.list_(pa.list_(pa.int64())))])
    packed = save(q.mapInArrow(pack, "chunk int, ids array<bigint>, vs array<array<bigint>>"), "chunks")
    blocks = index.select("block", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    met = blocks.join(packed, "chunk").select("block", "ids", "vs")

    def run(batches):
        last, block = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(0)[i].as_py()
                if data != last:
                    last, block = data, Block.unpack(data)
                out = []
                for qid, v in zip(batch.column(1)[i].as_py(), batch.column(2)[i].as_py()):
                    if len(v) == block.dims:
                        out += [(qid, vid, s >> 63, s & LONG) for vid, s in block.top(qid, np.array(v, np.int64), k)]
                cols = list(zip(*out)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "high", "low"])

    best = met.mapInArrow(run, "query_id long, vec_id long, high long, low long")
    order = W.partitionBy("query_id").orderBy(F.desc("high"), F.desc("low"), "vec_id")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    least = F.lit(-LONG - 1)
    score = F.when(F.col("high") == 0, F.col("low")).when(F.col("high") == -1, least + F.col("low")).when(F.col("high") > 0, F.lit(LONG)).otherwise(least)
    return best.select("query_id", "rank", "vec_id", score.alias("score"))
