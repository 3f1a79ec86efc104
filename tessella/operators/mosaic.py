"""Mosaics, blending and crops on pixel rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import color as C
from tessella.operators import grid as G
from tessella.operators import neighborhood as N

HOLE = (16, 16, 20)  # fixed value: background of missing tiles
UNCOVERED = (120, 135, 110)  # fixed value: ground tone outside all layers


def fill_cells(cells: DataFrame, cell: int, color: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """Canvas pixels of whole cells in one colour."""
    side = F.sequence(F.lit(0), F.lit(cell - 1))
    rows = cells.select(*by, "col", "row", F.explode(side).alias("j"))
    rows = rows.select(*by, "col", (F.col("row") * cell + F.col("j")).alias("y"), F.explode(side).alias("i"))
    px = rows.select(*by, "y", (F.col("col") * cell + F.col("i")).alias("x"))
    return px.select("*", *[F.lit(v).alias(c) for c, v in zip("rgb", color)])


def stitch(
    pixels: DataFrame, extent: DataFrame, cell: int, by: Sequence[str] = (), background: Sequence[int] = HOLE
) -> DataFrame:
    """Tile pixels ``(by…, col, row, y, x, r, g, b)`` on one canvas per ``by``. Holes are found among tiles, not
    among pixels, and are painted with the background."""
    placed = pixels.select(
        *by, (F.col("row") * cell + F.col("y")).alias("y"), (F.col("col") * cell + F.col("x")).alias("x"), "r", "g", "b"
    )
    holes = G.missing_cells(pixels.select(*by, "col", "row").distinct(), extent, by)
    return placed.unionByName(fill_cells(holes, cell, background, by))


def stitch_sized(tiles: DataFrame, extent: DataFrame, cell: int, background: Sequence[int] = HOLE) -> DataFrame:
    """Tiles of any size ``(col, row, w, h, y, x, r, g, b)`` brought to the cell size, then stitched."""
    return stitch(N.resize_tiles(tiles, cell, ["col", "row", "w", "h"]), extent, cell, background=background)


def preview_factor(w: int, h: int, inside: int = 1024) -> int:
    """Whole factor that makes the canvas fit inside a square."""
    return max(1, -(-max(w, h) // inside))


def preview(pixels: DataFrame, w: int, h: int, inside: int = 1024) -> DataFrame:
    return N.block_mean(pixels, preview_factor(w, h, inside))


def small_preview(pixels: DataFrame, w: int, h: int, most: int = 2048, share: int = 6) -> DataFrame:
    """Side over ``share``, at most ``most`` pixels."""
    return N.block_mean(pixels, max(share, -(-max(w, h) // most)))


def shift(pixels: DataFrame, ox: int, oy: int) -> DataFrame:
    return pixels.withColumn("x", F.col("x") + ox).withColumn("y", F.col("y") + oy)


def crop(pixels: DataFrame, x0: int, y0: int, x1: int, y1: int) -> DataFrame:
    """Rectangle (upper ends exclusive), renumbered from 0."""
    inside = (F.col("x") >= x0) & (F.col("x") < x1) & (F.col("y") >= y0) & (F.col("y") < y1)
    return shift(pixels.where(inside), -x0, -y0)


def crop_share(pixels: DataFrame, w: int, h: int, fx0: float, fy0: float, fx1: float, fy1: float) -> DataFrame:
    """Crop by shares of the canvas."""
    return crop(pixels, int(w * fx0), int(h * fy0), int(w * fx1), int(h * fy1))


def patch(base: DataFrame, over: DataFrame, box: tuple[int, int, int, int], key: Sequence[str] = ()) -> DataFrame:
    """``base`` with ``over`` columns ``(o_r, o_g, o_b, alpha)`` joined inside ``box``; the pixels outside the box
    take no part in the join."""
    x0, y0, x1, y1 = box
    inside = (F.col("x") >= x0) & (F.col("x") < x1) & (F.col("y") >= y0) & (F.col("y") < y1)
    joined = base.where(inside).join(over, [*key, "y", "x"], "left")
    a = F.coalesce(F.col("alpha"), F.lit(0.0))
    mixed = joined.select(
        *key, "y", "x", *[(F.coalesce(F.col("o_" + c), F.lit(0)) * a + F.col(c) * (F.lit(1.0) - a)).alias(c) for c in "rgb"]
    )
    rest = base.where(~inside).select(*key, "y", "x", *[F.col(c).cast("double").alias(c) for c in "rgb"])
    return mixed.unionByName(rest)


def overlay(base: DataFrame, over: DataFrame, ox: int, oy: int, w: int, h: int, alpha: Column) -> DataFrame:
    """Blend a ``w`` x ``h`` layer over ``base`` at (ox, oy); ``alpha`` is evaluated in layer coordinates."""
    o = over.select("y", "x", *[F.col(c).alias("o_" + c) for c in "rgb"], alpha.cast("double").alias("alpha"))
    return patch(base, shift(o, ox, oy), (ox, oy, ox + w, oy + h))


def restore(pixels: DataFrame, original: DataFrame, keep: DataFrame) -> DataFrame:
    """Copy the original colour at the pixels ``(y, x)`` of ``keep``."""
    src = original.join(keep.select("y", "x"), ["y", "x"], "left_semi").select(
        "y", "x", *[F.col(c).alias("o_" + c) for c in "rgb"]
    )
    return pixels.join(src, ["y", "x"], "left").select("y", "x", *[F.coalesce("o_" + c, c).alias(c) for c in "rgb"])


def layers(base: DataFrame, over: DataFrame, alpha: Column, limit: float = 0.05, ground: Sequence[int] | None = UNCOVERED) -> DataFrame:
    """Two placed layers on one canvas: ``over`` blended onto ``base`` (black where there is none), and
    ``ground`` where neither covers. ``over`` carries its weight as ``alpha``."""
    o = over.select("y", "x", *[F.col(c).alias("o_" + c) for c in "rgb"], "alpha")
    j = base.select("y", "x", *"rgb").join(o, ["y", "x"], "full_outer")
    a = F.coalesce(alpha, F.lit(0.0))
    zero = F.lit(0.0)
    covered = F.col("r").isNotNull() | (a > limit)

    def mix(c, g):
        v = F.coalesce(F.col("o_" + c), zero) * a + F.coalesce(F.col(c), zero) * (F.lit(1.0) - a)
        return (v if g is None else F.when(covered, v).otherwise(F.lit(float(g)))).alias(c)

    g3 = ground if ground is not None else (None, None, None)
    return j.select("y", "x", *[mix(c, g) for c, g in zip("rgb", g3)])


def before_after(before: DataFrame, after: DataFrame, key: Sequence[str], n: int, cell: int) -> DataFrame:
    """The first ``n`` tiles, before next to after, stacked; tiles are ``cell`` pixels wide, the common height
    is that of the lowest of them."""
    first = before.groupBy(*key).agg((F.max("y") + 1).alias("th")).orderBy(*key).limit(n)
    slot = F.row_number().over(_order(key)) - 1
    first = first.select(*key, slot.alias("slot"), F.min("th").over(_all()).alias("rows"))

    def side(px, ox):
        return px.join(F.broadcast(first), list(key)).where("y < rows").select(  # at most n rows
            (F.col("slot") * F.col("rows") + F.col("y")).alias("y"), (F.col("x") + ox).alias("x"), "r", "g", "b"
        )

    return side(before, 0).unionByName(side(after, cell))


def _order(key):
    from pyspark.sql import Window as W

    return W.orderBy(*key)  # over at most n rows


def _all():
    from pyspark.sql import Window as W

    return W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)


def grey_u8() -> Column:
    """Whole-number luma in 16-bit fixed point, rounded."""
    r, g, b = C.rgb()
    return F.floor((r * 19595 + g * 38470 + b * 7471 + 32768) / F.lit(65536))


def grade(pixels: DataFrame, color: float, brightness: float, contrast: float) -> DataFrame:
    """Saturation, then brightness, then contrast around the mean grey of the whole canvas."""
    sat = pixels.select(
        "y", "x", *[C.clip_u8(grey_u8() * F.lit(1 - color) + F.col(c) * F.lit(color)).alias(c) for c in "rgb"]
    )
    lit = sat.select("y", "x", *[C.clip_u8(F.col(c) * F.lit(brightness)).alias(c) for c in "rgb"])
    n, total = lit.agg(F.count("*"), F.sum(grey_u8())).first()  # one number for the canvas
    mean = int(total / n + 0.5) if n else 0
    return lit.select("y", "x", *[C.clip_u8(F.lit(mean * (1 - contrast)) + F.col(c) * F.lit(contrast)).alias(c) for c in "rgb"])
