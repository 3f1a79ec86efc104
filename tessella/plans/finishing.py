"""Whole jobs composed of the operators: water masks, floods, mosaics and finishing."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import color as C
from tessella.operators import mosaic as M
from tessella.operators import neighborhood as N
from tessella.operators import regions as G
from tessella.operators import runs as R
from tessella.operators.regions import median_by, medians
from tessella.session import save

# Water colours and waves (fy, fx, amplitude, span).
RIVER_BLUE = (88, 139, 179)
MUDDY = (104, 111, 120)
CALM = (1.7, 1.3, 1.2, 6.28)
WAVY = (1.7, 1.3, 2.0, 6.28)
STRONG = (1.3, 1.1, 5.0, 9.0)


def water_target(pixels: DataFrame, key: Sequence[str], min_share: float = 0.02) -> DataFrame:
    """Per tile the median colour of its bluish pixels, or nulls below ``min_share`` of the area."""
    key = list(key)
    size = pixels.groupBy(*key).agg(F.count("*").alias("px"))
    med = median_by(pixels.where(C.is_bluish()), key, ["r", "g", "b"])
    enough = F.col("n") >= F.col("px") * F.lit(min_share)
    return size.join(med, key, "left").select(*key, *[F.when(enough, F.floor(c)).alias("t" + c) for c in "rgb"])


def normalise_water(
    pixels: DataFrame, key: Sequence[str], new: tuple[int, int, int], softness: float, target: tuple[int, int, int] | None = None
) -> DataFrame:
    """Move each tile's water colour to ``new``; tiles without water stay as they are. A fixed ``target`` is moved in all tiles."""
    if target:
        moved = C.soft_color_replace([F.lit(v) for v in target], new, softness)
        return pixels.select("y", "x", *[m.alias(c) for c, m in zip("rgb", moved)])
    j = pixels.join(water_target(pixels, key), list(key), "left")
    moved = C.soft_color_replace([F.col("tr"), F.col("tg"), F.col("tb")], new, softness)
    return j.select("y", "x", *[F.when(F.col("tr").isNull(), F.col(c)).otherwise(m).alias(c) for c, m in zip("rgb", moved)])


def fill_uncovered(covered: DataFrame, w: int, h: int, block: int = R.BLOCK, ground: Sequence[int] = M.UNCOVERED) -> DataFrame:
    """``covered`` pixels plus ground-coloured pixels on the rest of the canvas."""
    gaps = R.complement(R.from_pixels(covered, block=block), R.universe(covered.sparkSession, w, h, block))
    rest = R.to_pixels(gaps).select("y", "x", *[F.lit(v).alias(c) for c, v in zip("rgb", ground)])
    return covered.select("y", "x", "r", "g", "b").unionByName(rest)


def flagged(pixels: DataFrame, runs: DataFrame, name: str, value=1, key: Sequence[str] = ()) -> DataFrame:
    """Pixels with ``name`` = ``value`` on the mask and 0 elsewhere. Both sides are shuffled: Catalyst takes the unpacked pixels for as small as
    the runs, and would send a whole mask through the driver."""
    on = R.to_pixels(runs).select(*key, "y", "x", F.lit(value).cast("long").alias(name))
    return pixels.join(on.hint("merge"), [*key, "y", "x"], "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))


def feathered(pixels: DataFrame, runs: DataFrame, sigma: float, w: int, h: int, block: int, own: Sequence[str] = ("r", "g", "b")) -> DataFrame:
    """Pixels with ``fm``, the 0..1 weight of the blurred mask in steps of 1/255."""
    k = sum(N.gaussian_weights(sigma))
    p = N.gaussian_sum(flagged(pixels, runs, "m", 255), "m", sigma, w, h, own, block)
    return p.select("y", "x", *own, (F.floor(F.col("m") / (k * k)) / F.lit(255.0)).alias("fm"))


def tile_water_mask(
    tiles: DataFrame, by: Sequence[str] = ("col", "row", "w", "h"), k: int = 9, std: int = 6, white: int = 200,
    min_share: float = 0.03, close: int = 3, block: int = R.BLOCK,
) -> DataFrame:
    """Per tile: large smooth areas that are not white, small gaps closed. ``tiles`` holds tile pixels with the
    tile's size ``w`` and ``h`` among ``by``; nothing crosses tile borders."""
    by = list(by)
    v = N.variance_key(tiles, k, F.col("w"), F.col("h"), block=block, by=by)
    flat = v.where(N.std_below(std, k) & (C.grey3() < 3 * white))
    reg = G.label(R.from_pixels(flat, by, block), by, block)
    big = G.keep_large(reg, F.col("w") * F.col("h") * F.lit(min_share)).select(*by, "y", "bx", "x0", "x1")
    space = R.universe_of(tiles.select(*by).distinct(), by, block)
    return R.closing(big, close, space, F.col("w"), F.col("h"), by, block)


def augment_controls(tiles: DataFrame, masks: DataFrame, by: Sequence[str] = ("col", "row", "w", "h"), delta: int = 10) -> DataFrame:
    """The faint checker pattern on the masked pixels of every tile."""
    p = flagged(tiles, masks, "m", 1, by)
    return p.select(*by, "y", "x", *C.checkerboard(F.col("m") == 1, delta))


def smooth_regions(
    pixels: DataFrame, k: int, std: int, w: int, h: int, also: Column, min_share: float, close: int, grow: int, block: int = R.BLOCK
) -> DataFrame:
    """Whole-canvas water: smooth pixels that meet ``also``, in regions above ``min_share`` of the canvas, closed
    and grown."""
    v = N.variance_key(pixels, k, w, h, block=block)
    reg = G.label(R.from_pixels(v.where(N.std_below(std, k) & also), block=block), block=block)
    big = G.keep_large(reg, F.lit(w * h * min_share)).select("y", "bx", "x0", "x1")
    out = R.closing(big, close, R.universe(pixels.sparkSession, w, h, block), w, h, block=block)
    return R.dilate(out, grow, w, h, block=block) if grow else out


def raw_water_mask(raw: DataFrame, w: int, h: int, min_share: float = 0.003, block: int = R.BLOCK) -> DataFrame:
    s = C.grey3()
    return smooth_regions(raw, 25, 13, w, h, C.not_green() & (s < 3 * 165) & (s > 3 * 30), min_share, 4, 1, block)


def preview_water_mask(pixels: DataFrame, w: int, h: int, min_share: float = 0.004, block: int = R.BLOCK) -> DataFrame:
    return smooth_regions(pixels, 9, 9, w, h, C.not_green() & (C.grey3() < 3 * 150), min_share, 2, 0, block)


def blend_to_median(pixels: DataFrame, mask: DataFrame, w: int, h: int, block: int = R.BLOCK, strength: float = 0.75, sigma: float = 3, least: int = 100) -> DataFrame:
    """Pull masked pixels toward their median colour, weighted by the feathered mask; nothing happens when the
    mask has at most ``least`` pixels. Channels may be whole (0..255) or real-valued."""
    inside = flagged(pixels, mask, "m").where("m = 1").withColumn("all", F.lit(0))
    real = any(t in ("double", "float") for c, t in pixels.dtypes if c in ("r", "g", "b"))
    med = (medians if real else median_by)(inside, ["all"], ["r", "g", "b"]).first()  # one row of four numbers
    if med is None or med["n"] <= least:
        return pixels.select("y", "x", *[F.col(c).cast("double").alias(c) for c in "rgb"])
    f = feathered(pixels, mask, sigma, w, h, block)
    s = F.col("fm") * F.lit(strength)
    return f.select("y", "x", *[(F.col(c) * (F.lit(1.0) - s) + F.lit(med[c]) * s).alias(c) for c in "rgb"])


def flood_from_raw(
    styled: DataFrame, mask: DataFrame, w: int, h: int, sigma: float = 4, texture: int = 11, k: int = 7,
    color: tuple[int, int, int] = MUDDY, block: int = R.BLOCK,
) -> DataFrame:
    """Flood the mask, feathered, but keep textured structures (bridges, barges) dry."""
    v = N.variance_key(styled, k, w, h, block=block)
    structure = R.from_pixels(v.where(F.col("vkey") > k**4 * 9 * texture * texture), block=block)
    structure = R.dilate(structure, 2, w, h, block=block)
    f = flagged(feathered(styled, mask, sigma, w, h, block), structure, "dry")
    a = F.when(F.col("dry") == 1, F.lit(0.0)).otherwise(F.col("fm"))
    return f.select("y", "x", *C.flood(a, color, C.ripple(w, h, *CALM)))


def flood_from_capture(styled: DataFrame, w: int, h: int, raw: DataFrame, raw_w: int, raw_h: int, block: int = R.BLOCK, **flood) -> DataFrame:
    """Flood the water seen in the raw capture, which may have another resolution than the styled picture."""
    seen = save(raw_water_mask(raw, raw_w, raw_h, block=block), "seen")
    return flood_from_raw(styled, R.merge(N.resize_runs(seen, raw_w, raw_h, w, h), block=block), w, h, block=block, **flood)


def river_flood_mask(
    river: DataFrame, styled: DataFrame, w: int, h: int, close: int = 22, bright: int = 165, thin: int = 6, block: int = R.BLOCK
) -> DataFrame:
    """The river with its islands and bars, minus thin bright structures."""
    space = save(R.universe(styled.sparkSession, w, h, block), "space")
    filled = save(G.fill_holes(river, space, w, h, block), "filled")
    closed = R.closing(filled, close, space, w, h, block=block)
    light = save(R.from_pixels(styled.where(C.is_bright(bright)), block=block), "bright")
    return R.subtract(closed, R.thin_structures(light, thin, space, w, h, block=block))


def polygon_flood(
    water: DataFrame, raw: DataFrame, styled: DataFrame, w: int, h: int, texture: int = 16, thin: int = 22, k: int = 9, block: int = R.BLOCK
) -> DataFrame:
    """Flood real water polygons, without thin textured structures in the raw capture (bridges)."""
    space = R.universe(styled.sparkSession, w, h, block)
    v = N.variance_key(raw, k, w, h, block=block)
    rough = R.from_pixels(v.where(F.col("vkey") > k**4 * 9 * texture * texture), block=block)
    rough = save(R.intersect(rough, water), "rough")
    bridges = R.thin_structures(rough, thin, space, w, h, grow=1, block=block)
    f = feathered(styled, R.subtract(water, bridges), 2, w, h, block)
    return f.select("y", "x", *C.flood(F.col("fm"), MUDDY, C.ripple(w, h, *CALM)))


def remove_stray_pools(pixels: DataFrame, w: int, h: int, river_min: int = 200000, min_px: int = 40, block: int = R.BLOCK, **shore) -> DataFrame:
    """Recolour every water body that is neither the river nor a speck to its local shore colour, with a little noise."""
    blue = save(R.from_pixels(pixels.where(C.is_blue()), block=block), "blue")
    reg = G.label(blue, block=block)
    pools = save(G.touching_pools(reg, river_min, min_px), "pools")
    fill = G.shore_median(reg, pools, blue, pixels, w, h, block=block, **shore)
    wet = R.to_pixels(reg.attach(fill.select("label", *[F.col(c).alias("f" + c) for c in "rgb"])))
    j = pixels.join(wet.select("y", "x", "fr", "fg", "fb"), ["y", "x"], "left")
    return j.select(
        "y", "x",
        *[F.when(F.col("f" + c).isNull(), F.col(c)).otherwise(C.clip_u8(F.col("f" + c) + C.fill_noise(i))).alias(c) for i, c in enumerate("rgb")],
    )


def flat_spot(
    pixels: DataFrame, w: int, h: int, tw: int, th: int, std: int = 6, low: int = 95, high: int = 170, spread: int = 18,
    block: int = R.BLOCK,
) -> DataFrame:
    """Top-left corner for a ``tw`` x ``th`` tag: the centre of the most peripheral flat, mid-grey region that is
    large enough and not at the edge, or a default near the bottom right."""
    ds = max(1, w // 1400)
    k = max(3, 11 // ds)
    sw, sh = -(-w // ds), -(-h // ds)
    p = N.stride(pixels, ds) if ds > 1 else pixels.select("y", "x", "r", "g", "b")
    s = (F.col("r") + F.col("g") + F.col("b")).cast("long")
    b = N.box_sum(p.withColumn("s1", s).withColumn("s2", s * s), ["s1", "s2", "r", "g", "b"], k, sw, sh, block=block)
    n = k * k
    s1 = F.col("s1")
    flat = (
        ((F.col("s2") * n - s1 * s1) < n * n * 9 * std * std) & (s1 > 3 * n * low) & (s1 < 3 * n * high)
        & (F.greatest("r", "g", "b") - F.least("r", "g", "b") < spread * n)
    )
    c = G.centroids(G.label(R.from_pixels(b.where(flat), block=block), block=block))
    fx, fy = F.col("cx") * ds, F.col("cy") * ds
    c = c.where(F.col("px") >= tw * th * 1.5 / (ds * ds)).withColumn("fx", fx).withColumn("fy", fy)
    c = c.where(
        (F.col("fx") >= tw // 2 + 12) & (F.col("fx") <= w - tw // 2 - 12) & (F.col("fy") >= th // 2 + 12) & (F.col("fy") <= h - th // 2 - 12)
    )
    dx, dy = (F.col("fx") - w / 2) / F.lit(float(w)), (F.col("fy") - h / 2) / F.lit(float(h))
    spot = F.struct(F.floor(F.col("fx") - tw // 2).alias("x"), F.floor(F.col("fy") - th // 2).alias("y"))
    best = c.select((dx * dx + dy * dy).alias("p"), "label", spot.alias("spot")).agg(
        F.max_by("spot", F.struct("p", -F.col("label"))).alias("s")
    )
    return best.select(F.coalesce("s.x", F.lit(w - tw - 60)).alias("x"), F.coalesce("s.y", F.lit(h - th - 60)).alias("y"))


def deploy_mosaic(
    base: DataFrame, base_box: tuple[int, int, int, int], over: DataFrame, over_box: tuple[int, int, int, int],
    w: int, h: int, fade: int, top: float = 200, k: float = 0.40, ground: Sequence[int] | None = M.UNCOVERED, block: int = R.BLOCK,
) -> DataFrame:
    """Two finished captures on one canvas. Boxes are (x, y, width, height); ``over`` fades in at its top, bottom
    and right edge, pixels that neither layer covers get the ground colour (black with ``ground`` None)."""

    def finish(px):
        return px.select("y", "x", *[C.clip(c).alias(n) for c, n in zip(C.rolloff(top, k), "rgb")])

    bx, by, bw, bh = base_box
    ox, oy, ow, oh = over_box
    under = M.shift(finish(base), bx, by)
    upper = M.shift(finish(over).withColumn("alpha", C.edge_ramp(ow, oh, fade)), ox, oy)
    mixed = M.layers(under, upper, F.col("alpha"), ground=ground)
    out = mixed.select("y", "x", *[C.clip_u8(F.col(c)).alias(c) for c in "rgb"])
    spark = base.sparkSession
    rect = [
        spark.range(hh).select((F.col("id") + y0).alias("y"), F.lit(x0).alias("x0"), F.lit(x0 + ww - 1).alias("x1"))
        for x0, y0, ww, hh in (base_box, over_box)
    ]
    gaps = R.complement(R.merge(rect[0].unionByName(rect[1]), block=block), R.universe(spark, w, h, block))
    rest = R.to_pixels(gaps).select("y", "x", *[F.lit(v).cast("long").alias(c) for c, v in zip("rgb", ground or (0, 0, 0))])
    return out.unionByName(rest)


def preview_layer(pixels: DataFrame, w: int, h: int, top: float = 190, k: float = 0.30, block: int = R.BLOCK) -> DataFrame:
    """A capture of a preview: whites rolled off, then its water drawn toward its median colour. Channels stay real-valued; only the water
    mask is taken from whole values."""
    soft = save(pixels.select("y", "x", *[c.cast("double").alias(n) for c, n in zip(C.rolloff(top, k), "rgb")]), "soft")
    whole = soft.select("y", "x", *[C.clip_u8(F.col(c)).alias(c) for c in "rgb"])
    water = save(preview_water_mask(whole, w, h, block=block), "water")
    return save(blend_to_median(soft, water, w, h, block), "layer")


def preview_mosaic(
    base: DataFrame, base_box: tuple[int, int, int, int], over: DataFrame, over_box: tuple[int, int, int, int], w: int, h: int, fade: int, block: int = R.BLOCK
) -> DataFrame:
    """The small mosaic: each layer finished by itself, ``over`` faded in at its top, bottom and right edge, black where neither is."""
    layers = [preview_layer(px, box[2], box[3], block=block) for px, box in ((base, base_box), (over, over_box))]
    return deploy_mosaic(layers[0], base_box, layers[1], over_box, w, h, fade, top=math.inf, ground=None, block=block)


def final_finish(
    pixels: DataFrame, original: DataFrame, w: int, h: int, close: int = 16, std: int = 12, block: int = R.BLOCK,
    grade: tuple[float, float, float] = (1.14, 1.03, 1.03),
) -> DataFrame:
    """Recolour the whole river (bars and islands included), put back bright structures, grade."""
    v = N.variance_key(pixels, 9, w, h, block=block)
    vivid = R.from_pixels(v.where(C.is_vivid_blue() & N.std_below(std, 9)), block=block)
    space = save(R.universe(pixels.sparkSession, w, h, block), "space")
    river = save(R.closing(vivid, close, space, w, h, block=block), "river")
    river = save(G.fill_holes(river, space, w, h, block), "river")
    wet = feathered(pixels, river, 3, w, h, block).select("y", "x", *C.flood(F.col("fm"), RIVER_BLUE, C.ripple(w, h, *STRONG)))
    bright = R.from_pixels(original.where(C.is_neutral_bright(128, 22)), block=block)
    kept = R.to_pixels(R.dilate(bright, 1, w, h, block=block))
    return M.grade(save(M.restore(wet, original, kept), "restored"), *grade)


def finishing(pixels: DataFrame, w: int, h: int, knee: float = 185, green: bool = False, block: int = R.BLOCK, **pools) -> DataFrame:
    """Whites, stray pools and optionally greens; every step stores whole channel values."""
    soft = pixels.select("y", "x", *[C.clip_u8(c).alias(n) for c, n in zip(C.soften_whites(knee), "rgb")])
    soft = save(soft, "soft")
    out = remove_stray_pools(soft, w, h, block=block, **pools)
    return out.select("y", "x", *[C.clip_u8(c).alias(n) for c, n in zip(C.mute_green(), "rgb")]) if green else out
