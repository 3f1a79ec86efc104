"""Masks as horizontal runs ``(y, bx, x0, x1)`` and their interval algebra.

Runs are cut at multiples of ``BLOCK`` columns (``bx = x0 div BLOCK``), so every window below works on one
row of one block column and holds at most ``BLOCK`` pixels, whatever the size of the canvas.
``by`` names extra key columns when a table holds many canvases; ``w`` and ``h`` are the canvas size, as
numbers or as columns of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessella.session import dealt, small_parts

BLOCK = 1024
SPAN = 128  # small blocks go to Python together, as squares of about this edge


def span(block: int) -> int:
    """Edge of the square of whole blocks that one Python call gets."""
    return max(SPAN // block, 1) * block


def _c(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _div(c: Column, n: int) -> Column:
    return F.floor(c / F.lit(n)).cast("long")


def cut(spans: DataFrame, block: int = BLOCK) -> DataFrame:
    """Cut spans ``(…, x0, x1)`` at block columns."""
    keep = [f"`{c}`" for c in spans.columns if c not in ("bx", "x0", "x1")]
    s = spans.where("x0 <= x1").selectExpr(
        *keep, "x0", "x1", f"explode(sequence(cast(floor(x0 / {block}) as bigint), cast(floor(x1 / {block}) as bigint))) bx"
    )
    return s.selectExpr(
        *keep, "bx", f"greatest(cast(x0 as bigint), bx * {block}) x0", f"least(cast(x1 as bigint), bx * {block} + {block - 1}) x1"
    )


def _events(runs: DataFrame, key: list[str], a: int, b: int) -> DataFrame:
    """Spans as +1/-1 steps at their ends; ``da`` counts spans of the first table, ``db`` those of the second."""
    ends = f"inline(array(struct(x0 pos, {a} da, {b} db), struct(x1 + 1 pos, {-a} da, {-b} db)))"
    return runs.selectExpr(*key, ends)


def sweep(a: DataFrame, b: DataFrame | None, keep: str, by: Sequence[str] = ()) -> DataFrame:
    """Runs of the positions where ``keep`` holds; it may use ``ca`` and ``cb``, the number of spans of
    ``a`` and ``b`` that cover a position. One shuffle on (by, y, bx) serves all steps."""
    key = [*by, "y", "bx"]
    ev = _events(a, key, 1, 0)
    if b is not None:
        ev = ev.unionByName(_events(b, key, 0, 1))
    ev = ev.repartition(*key).groupBy(*key, "pos").agg(F.sum("da").alias("da"), F.sum("db").alias("db"))
    over = f"OVER (PARTITION BY {', '.join(key)} ORDER BY pos)"
    seg = ev.selectExpr(*key, "pos", f"sum(da) {over} ca", f"sum(db) {over} cb", f"lead(pos) {over} nxt")
    seg = seg.selectExpr(*key, "pos", "nxt", f"nxt IS NOT NULL AND {keep} inside")
    seg = seg.selectExpr("*", f"inside AND NOT lag(inside, 1, false) {over} starts")
    seg = seg.selectExpr(*key, "pos", "nxt", "inside", f"sum(cast(starts as int)) {over} island").where("inside")
    return seg.groupBy(*key, "island").agg(F.min("pos").alias("x0"), F.expr("max(nxt) - 1 x1")).drop("island")


def merge(spans: DataFrame, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """Overlapping or touching spans become disjoint runs."""
    return sweep(cut(spans, block), None, "ca > 0", by)


def union(a: DataFrame, b: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return sweep(a, b, "(ca > 0 OR cb > 0)", by)


def intersect(a: DataFrame, b: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return sweep(a, b, "ca > 0 AND cb > 0", by)


def subtract(a: DataFrame, b: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return sweep(a, b, "ca > 0 AND cb = 0", by)


def from_pixels(pixels: DataFrame, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """Runs of the (distinct) pixels ``(y, x)``."""
    key = [*by, "y", "bx"]
    p = pixels.select(*by, F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"))
    p = p.withColumn("bx", _div(F.col("x"), block))
    small_parts(p.sparkSession)
    w = W.partitionBy(*key).orderBy("x")
    return (
        p.withColumn("island", F.col("x") - F.row_number().over(w))
        .groupBy(*key, "island")
        .agg(F.min("x").alias("x0"), F.max("x").alias("x1"))
        .drop("island")
    )


def to_pixels(runs: DataFrame) -> DataFrame:
    keep = [c for c in runs.columns if c not in ("bx", "x0", "x1")]
    return runs.select(*keep, F.explode(F.sequence("x0", "x1")).alias("x"))


def maximal(runs: DataFrame, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """Join runs across block columns, in one pass. Runs that touch a cut meet per row, at most two per block; all
    others stay in the group of their own block."""
    touches = (F.col("x0") % block == 0) | (F.col("x1") % block == block - 1)
    r = runs.select(*by, "y", "x0", "x1", F.when(touches, F.lit(-1)).otherwise(F.col("bx")).alias("lane"))
    key = [*by, "y", "lane"]
    w = W.partitionBy(*key).orderBy("x0")
    r = r.withColumn("gap", (F.col("x0") != F.lag("x1", 1, -2).over(w) + 1).cast("int"))
    r = r.withColumn("island", F.sum("gap").over(w))
    return r.groupBy(*key, "island").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1")).drop("island", "lane")


def universe(spark: SparkSession, w: int, h: int, block: int = BLOCK) -> DataFrame:
    """All rows of one canvas as runs."""
    return cut(spark.range(h).select(F.col("id").alias("y"), F.lit(0).alias("x0"), F.lit(w - 1).alias("x1")), block)


def universe_of(canvases: DataFrame, by: Sequence[str], block: int = BLOCK) -> DataFrame:
    """All rows of many canvases ``(by…)``, which include the columns ``w`` and ``h``."""
    rows = canvases.select(*by, F.explode(F.sequence(F.lit(0).cast("long"), F.col("h").cast("long") - 1)).alias("y"))
    return cut(rows.select("*", F.lit(0).alias("x0"), (F.col("w") - 1).alias("x1")), block)


def _near(mask: np.ndarray, n: int) -> np.ndarray:
    """Positions within Manhattan distance ``n`` of the mask: a distance transform along the columns, then along the rows, by running minima."""
    d = np.where(mask, 0, 1 << 29).astype(np.int32)
    for axis in (0, 1):
        i = np.arange(d.shape[axis], dtype=np.int32)
        i = i[:, None] if axis == 0 else i[None, :]
        before = np.minimum.accumulate(d - i, axis) + i
        after = np.flip(np.minimum.accumulate(np.flip(d + i, axis), axis), axis) - i
        d = np.minimum(before, after)
    return d <= n


def _local(runs: DataFrame, step: Callable[[np.ndarray, np.ndarray], np.ndarray], halo: int, w, h, by: Sequence[str], block: int) -> DataFrame:
    """``step`` on square blocks: each gets the mask and the canvas as arrays with ``halo`` more pixels on all sides, and the middle of
    what it returns becomes runs. Small blocks are taken together (``span``), their runs still cut at ``block``. One shuffle; a run goes to the blocks it reaches, four at most for a halo below the block size."""
    by, cuts = list(by), block
    block = span(cuts)
    to = lambda lo, hi: F.explode(F.sequence(_div(lo - halo, block), _div(hi + halo, block)))
    s = runs.select(*by, F.col("y").cast("long"), F.col("x0").cast("long"), F.col("x1").cast("long"), _c(w).cast("long").alias("w_"), _c(h).cast("long").alias("h_"))
    s = s.withColumn("yb", to(F.col("y"), F.col("y"))).withColumn("bx", to(F.col("x0"), F.col("x1")))
    s = s.where((F.col("yb") >= 0) & (F.col("bx") >= 0) & (F.col("yb") * block < F.col("h_")) & (F.col("bx") * block < F.col("w_")))
    def run(group: pd.DataFrame) -> pd.DataFrame:
        y, x0, x1 = (group[c].to_numpy() for c in ("y", "x0", "x1"))
        yb, bx = int(group["yb"].iloc[0]) * block, int(group["bx"].iloc[0]) * block
        # the part of the block and its halo that the runs can reach
        top, end = max(yb - halo, int(y.min()) - halo), min(yb + block + halo, int(y.max()) + 1 + halo)
        left, right = max(bx - halo, int(x0.min()) - halo), min(bx + block + halo, int(x1.max()) + 1 + halo)
        if top >= min(end, yb + block) or left >= min(right, bx + block):
            return pd.DataFrame({c: group[c].iloc[:0] for c in [*by, "y", "bx", "x0", "x1"]})
        steps = np.zeros((end - top, right - left + 1), np.int32)
        np.add.at(steps, (y - top, np.clip(x0 - left, 0, right - left)), 1)
        np.add.at(steps, (y - top, np.clip(x1 + 1 - left, 0, right - left)), -1)
        ys, xs = np.arange(top, end), np.arange(left, right)
        canvas = ((ys >= 0) & (ys < int(group["h_"].iloc[0])))[:, None] & ((xs >= 0) & (xs < int(group["w_"].iloc[0])))[None, :]
        mask = (np.cumsum(steps, 1)[:, :-1] > 0) & canvas
        own = ((ys >= yb) & (ys < yb + block))[:, None] & ((xs >= bx) & (xs < bx + block))[None, :]
        out = step(mask, canvas) & canvas & own
        first = xs % cuts == 0  # runs end where a block column does
        row, start = np.nonzero(out & ~(np.pad(out, ((0, 0), (1, 0)))[:, :-1] & ~first))
        _, stop = np.nonzero(out & ~(np.pad(out, ((0, 0), (0, 1)))[:, 1:] & ~np.append(first[1:], False)))
        found = pd.DataFrame({"y": row + top, "bx": (start + left) // cuts, "x0": start + left, "x1": stop + left})
        for c in by:
            found[c] = group[c].iloc[0]
        return found[[*by, "y", "bx", "x0", "x1"]]

    keys = "".join(f"`{c}` {t}, " for c, t in s.select(*by).dtypes)
    return dealt(s, *by, "yb", "bx").groupBy(*by, "yb", "bx").applyInPandas(run, keys + "y long, bx long, x0 long, x1 long")


def dilate(runs: DataFrame, n: int, w, h, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """All pixels within Manhattan distance ``n``: what ``n`` steps of the 4-neighbour cross reach. The cost does not depend on ``n``
    but for the halo of the blocks."""
    return _local(runs, lambda mask, canvas: _near(mask, n), n, w, h, by, block)


def complement(runs: DataFrame, space: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return subtract(space, runs, by)


def erode(runs: DataFrame, n: int, space: DataFrame, w, h, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """Pixels whose whole Manhattan ball of radius ``n`` lies in the mask; outside the canvas counts as false,
    so a margin of ``n`` is lost at every border. ``space`` is not needed any more."""
    return _local(runs, lambda mask, canvas: ~_near(~mask, n), n, w, h, by, block)


def opening(runs: DataFrame, n: int, space: DataFrame, w, h, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """Erosion and dilation in one pass."""
    return _local(runs, lambda mask, canvas: _near(~_near(~mask, n), n), 2 * n, w, h, by, block)


def closing(runs: DataFrame, n: int, space: DataFrame, w, h, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """Dilation and erosion in one pass; what grows beyond the canvas is lost before it shrinks again."""
    return _local(runs, lambda mask, canvas: ~_near(~(_near(mask, n) & canvas), n), 2 * n, w, h, by, block)


def thin_structures(
    runs: DataFrame, n: int, space: DataFrame, w, h, grow: int = 0, by: Sequence[str] = (), block: int = BLOCK
) -> DataFrame:
    """The mask minus its opening, optionally grown again, in one pass."""

    def step(mask: np.ndarray, canvas: np.ndarray) -> np.ndarray:
        thin = mask & ~(_near(~_near(~mask, n), n) & canvas)
        return _near(thin, grow) if grow else thin

    return _local(runs, step, 2 * n + grow, w, h, by, block)


def area(runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return runs.groupBy(*by).agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("px"))
