"""Box filters, kernels and resampling on dense pixel rows.

A dense canvas is cut into blocks and every pixel is sent, in one shuffle, to each block whose filter window
reaches it (copies only near block borders, mirrored copies only near the canvas border). Both filter passes
then run inside the block as running sums, so the cost per pixel does not grow with the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessella.session import small_parts

BLOCK = 256


def _c(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _targets(x: str, size, before: int, after: int, block: int) -> tuple[str, Column]:
    """SQL text for the (block, position) pairs of one axis, every block whose windows need pixel ``x``, mirrored ones
    included; and the struct (position, axis size) that stands for ``{v}`` in it."""
    v = F.struct(F.col(x).cast("long").alias("p"), _c(size).cast("long").alias("n"))

    def at(p: str) -> str:
        first, last = f"greatest(floor(({p} - {after}) / {block}), 0L)", f"least(floor(({p} + {before}) / {block}), (v.n - 1) div {block})"
        return (
            f"CASE WHEN {first} <= {last} THEN transform(sequence({first}, {last}), k -> struct(k blk, {p} pos))"
            " ELSE cast(array() as array<struct<blk:bigint,pos:bigint>>) END"
        )

    none = "cast(array() as array<struct<blk:bigint,pos:bigint>>)"
    reach = max(before, after)

    def mirrored(q: str) -> str:
        return f"CASE WHEN {q} >= -{before} AND {q} < v.n + {after} AND {q} <> v.p THEN {at(q)} ELSE {none} END"

    # images of the pixel beyond the border: a canvas narrower than the window is mirrored again and again
    turns = f"transform(sequence(-cast(ceil({reach} / (2.0 * v.n)) as bigint), cast(ceil({reach} / (2.0 * v.n)) as bigint)), m -> 2 * v.n * m)"
    images = f"flatten(transform({turns}, s -> concat({mirrored('(v.p + s)')}, {mirrored('(s - 1 - v.p)')})))"
    both = f"flatten(transform(array({{v}}), v -> concat({at('v.p')}, CASE WHEN v.p < {before} OR v.p >= v.n - {after} THEN {images} ELSE {none} END)))"
    return both, v


def with_halo(
    px: DataFrame, values: Sequence[str], w, h, before: int, after: int, block: int = BLOCK, by: Sequence[str] = ()
) -> DataFrame:
    """Rows ``(by…, by_, bx, y, x, values…)`` partitioned by block, borders mirrored."""
    by = list(by)
    for axis, size in (("x", w), ("y", h)):
        text, v = _targets(axis, size, before, after, block)
        px = px.withColumn(f"v{axis}", v).withColumn(f"t{axis}", F.expr("explode(" + text.replace("{v}", f"v{axis}") + ")"))
    p = px.select(
        *by, F.col("ty.blk").alias("by_"), F.col("tx.blk").alias("bx"), F.col("ty.pos").alias("y"), F.col("tx.pos").alias("x"), *values
    )
    small_parts(p.sparkSession)
    return p.repartition(*by, "by_", "bx")


def _pass(df, values, own, other: str, axis: str, blk: str, size, before: int, after: int, block: int, by) -> DataFrame:
    w = W.partitionBy(*by, "by_", "bx", other).orderBy(axis)
    keep = [*by, "by_", "bx", "y", "x", *own]
    run = df.select(*keep, *[F.sum(v).over(w).alias(v) for v in values])
    out = run.select(
        *keep, *[(F.lead(v, after).over(w) - F.coalesce(F.lag(v, before + 1).over(w), F.lit(0))).alias(v) for v in values]
    )
    lo = F.col(blk) * block
    return out.where((F.col(axis) >= lo) & (F.col(axis) < lo + block) & (F.col(axis) < _c(size)))


def box_sum(
    px: DataFrame, values: Sequence[str], k: int, w, h, own: Sequence[str] = (), block: int = BLOCK, by: Sequence[str] = ()
) -> DataFrame:
    """Sum of each value over the ``k`` x ``k`` box around every pixel of a dense canvas; mirrored border.
    ``own`` columns of the pixel itself are carried along, so no join back is needed. With ``by`` the table
    holds many canvases, and ``w`` and ``h`` may be columns that belong to ``by``."""
    before, after = k // 2, k - 1 - k // 2
    p = with_halo(px, [*values, *own], w, h, before, after, block, by)
    p = _pass(p, values, own, "y", "x", "bx", w, before, after, block, by)
    return _pass(p, values, own, "x", "y", "by_", h, before, after, block, by).select(*by, "y", "x", *own, *values)


def variance_key(
    px: DataFrame, k: int, w, h, own: Sequence[str] = ("r", "g", "b"), block: int = BLOCK, by: Sequence[str] = ()
) -> DataFrame:
    """``vkey`` = ``9 * k^4 *`` variance of the mean grey in the box, a whole number, and the pixel's ``own`` columns."""
    s = (F.col("r") + F.col("g") + F.col("b")).cast("long")
    q = box_sum(px.withColumn("s1", s).withColumn("s2", s * s), ["s1", "s2"], k, w, h, own, block, by)
    return q.select(*by, "y", "x", *own, (F.col("s2") * k * k - F.col("s1") * F.col("s1")).alias("vkey"))


def std_below(limit: int, k: int, key: str = "vkey") -> Column:
    """Local standard deviation < ``limit``, without a square root."""
    return F.col(key) < k**4 * 9 * limit * limit


def gaussian_weights(sigma: float) -> list[int]:
    """Whole-number kernel of radius 3 sigma, 256 at the centre."""
    import math

    r = math.ceil(3 * sigma)
    return [round(256 * math.exp(-(d * d) / (2 * sigma * sigma))) for d in range(-r, r + 1)]


def gaussian_sum(px: DataFrame, value: str, sigma: float, w: int, h: int, own: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """Kernel-weighted sum of ``value``; divide by the square of the kernel's total to get the blur.
    ``own`` columns of the pixel are carried along."""
    wt = gaussian_weights(sigma)
    r = len(wt) // 2
    own = list(own)
    p = with_halo(px, [value, *own], w, h, r, r, block)
    for other, axis, blk, size in (("y", "x", "bx", w), ("x", "y", "by_", h)):
        win = W.partitionBy("by_", "bx", other).orderBy(axis)
        total = F.lit(0).cast("long")
        for d, c in enumerate(wt):
            v = F.col(value) if d == r else (F.lag(value, r - d).over(win) if d < r else F.lead(value, d - r).over(win))
            total = total + v * c
        lo = F.col(blk) * block
        p = p.select("by_", "bx", "y", "x", *own, total.alias(value)).where(
            (F.col(axis) >= lo) & (F.col(axis) < lo + block) & (F.col(axis) < size)
        )
    return p.select("y", "x", *own, value)


def stride(px: DataFrame, ds: int) -> DataFrame:
    """Every ``ds``-th pixel of every ``ds``-th row."""
    rest = [c for c in px.columns if c not in ("y", "x")]
    return px.where((F.col("y") % ds == 0) & (F.col("x") % ds == 0)).select(
        F.floor(F.col("y") / ds).alias("y"), F.floor(F.col("x") / ds).alias("x"), *rest
    )


def upscale_runs(runs: DataFrame, f: int) -> DataFrame:
    """Nearest-neighbour enlargement of a mask by a whole factor; cut the result again before use."""
    return runs.select(
        (F.explode(F.sequence(F.col("y") * f, F.col("y") * f + f - 1))).alias("y"),
        (F.col("x0") * f).alias("x0"),
        (F.col("x1") * f + f - 1).alias("x1"),
    )


def resize_runs(runs: DataFrame, w0: int, h0: int, w: int, h: int) -> DataFrame:
    """A mask of a ``w0`` x ``h0`` canvas on one of ``w`` x ``h``: each pixel takes the one under its centre. Cut the result again
    before use."""
    first = lambda c, old, new: f"((2L * ({c}) * {new} - {old} + {2 * old - 1}) div {2 * old})"
    s = runs.selectExpr(f"{first('y', h0, h)} y0", f"{first('y + 1', h0, h)} - 1 y1", f"{first('x0', w0, w)} x0", f"{first('x1 + 1', w0, w)} - 1 x1")
    return s.where("y0 <= y1 and x0 <= x1").selectExpr("explode(sequence(y0, y1)) y", "x0", "x1")


def block_mean(px: DataFrame, f: int, cols: Sequence[str] = ("r", "g", "b")) -> DataFrame:
    """Shrink by a whole factor: truncated mean of each cell."""
    return px.groupBy(F.floor(F.col("y") / f).alias("y"), F.floor(F.col("x") / f).alias("x")).agg(
        *[F.floor(F.sum(c) / F.count("*")).alias(c) for c in cols]
    )


def resize_tiles(tiles: DataFrame, cell: int, by: Sequence[str], cols: Sequence[str] = ("r", "g", "b")) -> DataFrame:
    """Bring tiles of any size (``w``, ``h`` among ``by``) to ``cell`` x ``cell``: nearest pixel when enlarging, truncated
    mean of the covered pixels when shrinking, each axis on its own."""

    def reach(v, size):
        first = f"CASE WHEN {size} >= {cell} THEN {v} * {cell} div {size} ELSE ({v} * {cell} + {size} - 1) div {size} END"
        last = f"CASE WHEN {size} >= {cell} THEN {v} * {cell} div {size} ELSE (({v} + 1) * {cell} + {size} - 1) div {size} - 1 END"
        return f"explode(sequence({first}, {last}))"

    p = tiles.selectExpr(*by, "y", *cols, f"{reach('x', 'w')} tx")
    p = p.selectExpr(*by, *cols, "tx", f"{reach('y', 'h')} ty")
    return p.groupBy(*by, F.col("ty").alias("y"), F.col("tx").alias("x")).agg(*[F.expr(f"sum({c}) div count(*)").alias(c) for c in cols])
