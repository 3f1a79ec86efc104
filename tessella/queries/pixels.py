"""Checked queries: colour expressions (D), mosaics and pyramids (H1-H10, H14, H15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella import fixtures as X
from tessella.functions import color as C
from tessella.operators import mosaic as M
from tessella.operators import pyramid as P
from tessella.operators import runs as R
from tessella.operators.regions import median_by
from tessella.queries import sqlgen as S
from tessella.queries.neighbors import BLUE, BLOCK, blue_runs, smooth_sql
from tessella.queries.registry import query
from tessella.session import new_path
from tessella.sources import sinks

RGB_D = "y:l x:l r:d g:d b:d"
RGB = "y:l x:l r:l g:l b:l"


def d(v) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def each(expr: str, rnd: int | None = 4) -> str:
    """One expression per channel; ``@`` stands for the channel."""
    return ", ".join((f"round({expr}, {rnd})" if rnd else expr).replace("@", c) + f" AS {c}" for c in "rgb")


def rounded(df):
    return df.select("y", "x", *[F.round(F.col(c), 4).alias(c) for c in "rgb"])


U8 = "CAST(floor(greatest(least({}, CAST(255 AS DOUBLE)), CAST(0 AS DOUBLE))) AS BIGINT)"
LUMA = f"({d(0.299)} * r + {d(0.587)} * g + {d(0.114)} * b)"
TILE_OF = "x // 25 AS col, y // 25 AS row"


def tiled(df):
    return df.withColumn("col", F.floor(F.col("x") / X.TILE)).withColumn("row", F.floor(F.col("y") / X.TILE))


@query("d1_luma", "y:l x:l s:l luma:d", X.with_("raster", body=f"SELECT y, x, r + g + b AS s, round({LUMA}, 4) AS luma FROM raster"))
def d1(t):
    return X.raster(t).select("y", "x", C.grey3().alias("s"), F.round(C.luma(), 4).alias("luma"))


@query(
    "d2_soften_whites", RGB_D,
    X.with_("raw_raster", body=f"SELECT y, x, {each(f'CASE WHEN {LUMA} > 185 THEN @ * (({d(185.0)} + ({LUMA} - 185) * {d((222 - 185) / 70.0)}) / {LUMA}) ELSE @ END')} FROM raw_raster"),
)
def d2(t):
    return rounded(X.raw_raster(t).select("y", "x", *C.soften_whites()))


def _rolloff(top, k):
    m = f"((r + g + b) / {d(3.0)})"
    sql = X.with_("raw_raster", body=f"SELECT y, x, {each(f'CASE WHEN {m} > {top} THEN @ * (({d(float(top))} + ({m} - {d(float(top))}) * {d(k)}) / {m}) ELSE @ END')} FROM raw_raster")
    return (lambda t: rounded(X.raw_raster(t).select("y", "x", *C.rolloff(top, k)))), sql


for _top, _k in ((200, 0.40), (190, 0.30)):
    _fn, _sql = _rolloff(_top, _k)
    query(f"d3_rolloff_{_top}", RGB_D, _sql)(_fn)


@query(
    "d4_mute_green", RGB_D,
    X.with_("raw_raster", body=f"SELECT y, x, {each(f'CASE WHEN g - r > 18 AND g - b > 18 THEN ({LUMA} * {d(1 - 0.62)} + @ * {d(0.62)}) * {d(0.92)} ELSE @ END')} FROM raw_raster"),
)
def d4(t):
    return rounded(X.raw_raster(t).select("y", "x", *C.mute_green()))


@query(
    "d5_is_blue", "y:l x:l strict:b fix:b vivid:b walk:b",
    X.with_("raster", body="SELECT y, x, b - r > 14 AND b - g > 8 AND b > 90 AS strict, b - r > 12 AND b - g > 4 AND b > 70 AND b < 250 AS fix, b > r + 18 AND b > g AND b > 115 AS vivid, b > r + 6 AND b > g AND b > 110 AS walk FROM raster"),
)
def d5(t):
    return X.raster(t).select(
        "y", "x", C.is_blue().alias("strict"), C.is_bluish().alias("fix"), C.is_vivid_blue().alias("vivid"), C.is_walk_blue().alias("walk")
    )


@query(
    "d6_is_smooth_water", "y:l x:l flat:b raw:b preview:b",
    X.with_(
        "raster", "size", ctes=smooth_sql(9, 6),
        body=f"SELECT y, x, vkey < {9**4 * 9 * 36} AND r + g + b < 600 AS flat,"
        f" vkey < {9**4 * 9 * 169} AND NOT (g - r > 10 AND g - b > 10) AND r + g + b < 495 AND r + g + b > 90 AS raw,"
        f" vkey < {9**4 * 9 * 81} AND r + g + b < 450 AND NOT (g - r > 10 AND g - b > 10) AS preview FROM flag",
    ),
)
def d6(t):
    from tessella.operators import neighborhood as N

    v = N.variance_key(X.raster(t), 9, X.WIDTH, X.height(t), block=BLOCK)
    s = C.grey3()
    return v.select(
        "y", "x", (N.std_below(6, 9) & (s < 600)).alias("flat"),
        (N.std_below(13, 9) & C.not_green() & (s < 495) & (s > 90)).alias("raw"),
        (N.std_below(9, 9) & (s < 450) & C.not_green()).alias("preview"),
    )


@query(
    "d7_is_neutral_bright", "y:l x:l a:b b:b",
    X.with_("raster", body="SELECT y, x, r + g + b > 420 AND abs(r - b) < 24 AS a, r + g + b > 384 AND abs(r - b) < 22 AS b FROM raster"),
)
def d7(t):
    return X.raster(t).select("y", "x", C.is_neutral_bright(140, 24).alias("a"), C.is_neutral_bright(128, 22).alias("b"))


@query("d8_is_bright", "y:l x:l bright:b", X.with_("raster", body="SELECT y, x, r + g + b > 495 AS bright FROM raster"))
def d8(t):
    return X.raster(t).select("y", "x", C.is_bright().alias("bright"))


def replace_sql(target: tuple[str, str, str], new, softness) -> tuple[str, str]:
    import math

    dist = " + ".join(f"(({c} / {d(255.0)}) - ({v} / {d(255.0)})) * (({c} / {d(255.0)}) - ({v} / {d(255.0)}))" for c, v in zip("rgb", target))
    alpha = f"greatest(least(1 - sqrt({dist}) / {d(softness / 255.0 * math.sqrt(3))}, CAST(1 AS DOUBLE)), CAST(0 AS DOUBLE))"
    out = ", ".join(U8.format(f"({d(n / 255.0)} * a + ({c} / {d(255.0)}) * (1 - a)) * {d(255.0)}") + f" AS {c}" for c, n in zip("rgb", new))
    return alpha, out


_A, _O = replace_sql(("75", "105", "125"), (60, 150, 220), 60.0)


@query("d9_soft_color_replace", RGB, X.with_("raster", ctes=f"w AS (SELECT *, {_A} AS a FROM raster)", body=f"SELECT y, x, {_O} FROM w"))
def d9(t):
    return X.raster(t).select("y", "x", *C.soft_color_replace([F.lit(75), F.lit(105), F.lit(125)], (60, 150, 220), 60.0))


TARGET = f"""target AS (SELECT {TILE_OF}, count(*) AS px, count(*) FILTER (f) AS n,
  median(r) FILTER (f) AS tr, median(g) FILTER (f) AS tg, median(b) FILTER (f) AS tb
  FROM (SELECT *, b - r > 12 AND b - g > 4 AND b > 70 AND b < 250 AS f FROM raster) GROUP BY ALL),
tgt AS (SELECT col, row, CASE WHEN n >= px * 0.02 THEN CAST(floor(tr) AS BIGINT) END AS tr, CASE WHEN n >= px * 0.02 THEN CAST(floor(tg) AS BIGINT) END AS tg,
  CASE WHEN n >= px * 0.02 THEN CAST(floor(tb) AS BIGINT) END AS tb FROM target)"""


def water_targets(t):
    from tessella.plans.finishing import water_target

    return water_target(tiled(X.raster(t)), ["col", "row"])


@query("d10_water_target", "col:l row:l tr:l tg:l tb:l", X.with_("raster", ctes=TARGET, body="SELECT * FROM tgt"))
def d10(t):
    return water_targets(t)


_A2, _O2 = replace_sql(("tr", "tg", "tb"), (60, 150, 220), 60.0)


@query(
    "d11_normalise_water", RGB,
    X.with_(
        "raster", ctes=TARGET + f",\nw AS (SELECT y, x, r, g, b, tr, {_A2} AS a FROM raster p JOIN tgt ON tgt.col = p.x // 25 AND tgt.row = p.y // 25)",
        body=f"SELECT y, x, r, g, b FROM w WHERE tr IS NULL UNION ALL SELECT y, x, {_O2} FROM w WHERE tr IS NOT NULL",
    ),
)
def d11(t):
    from tessella.plans.finishing import normalise_water

    return normalise_water(tiled(X.raster(t)), ["col", "row"], (60, 150, 220), 60.0)


_A3, _O3 = replace_sql(("60", "120", "170"), (60, 150, 220), 60.0)


@query("d11_fixed_target", RGB, X.with_("raster", ctes=f"w AS (SELECT y, x, r, g, b, {_A3} AS a FROM raster)", body=f"SELECT y, x, {_O3} FROM w"))
def d11_fixed(t):
    from tessella.plans.finishing import normalise_water

    return normalise_water(tiled(X.raster(t)), ["col", "row"], (60, 150, 220), 60.0, target=(60, 120, 170))


CHECKER = "CASE WHEN {m} THEN greatest(0, least(255, @ + CASE WHEN (x // 2 + y // 2) % 2 = 1 THEN 10 ELSE -10 END)) ELSE @ END"


@query("d12_checkerboard", RGB, X.with_("raster", body=f"SELECT y, x, {each(CHECKER.format(m='b - r > 14 AND b - g > 8 AND b > 90'), None)} FROM raster"))
def d12(t):
    return X.raster(t).select("y", "x", *C.checkerboard(C.is_blue()))


def ripple_sql(fy, fx, amp, span):
    return f"((sin((y * ({d(span)} / greatest(h - 1, 1))) * {d(fy)}) + cos((x * ({d(span)} / greatest(w - 1, 1))) * {d(fx)})) * {d(amp)})"


WAVES = {"a": (1.7, 1.3, 1.2, 6.28), "b": (1.7, 1.3, 2.0, 6.28), "c": (1.3, 1.1, 5.0, 9.0)}


@query(
    "d13_ripple", "y:l x:l a:d b:d c:d",
    X.with_("raster", "size", body="SELECT y, x, " + ", ".join(f"round({ripple_sql(*v)}, 4) AS {k}" for k, v in WAVES.items()) + " FROM raster, size"),
)
def d13(t):
    h = X.height(t)
    return X.raster(t).select("y", "x", *[F.round(C.ripple(X.WIDTH, h, *v), 4).alias(k) for k, v in WAVES.items()])


def flood_sql(alpha, color, wave):
    return ", ".join(U8.format(f"{c} * (1 - {alpha}) + ({d(float(v))} + {wave}) * {alpha}") + f" AS {c}" for c, v in zip("rgb", color))


@query(
    "d14_flood", RGB,
    X.with_("raster", "size", ctes=f"w AS (SELECT *, (x % 64) / {d(64.0)} AS a FROM raster, size)", body=f"SELECT y, x, {flood_sql('a', (88, 139, 179), ripple_sql(*WAVES['b']))} FROM w"),
)
def d14(t):
    px = X.raster(t).withColumn("a", (F.col("x") % 64) / F.lit(64.0))
    return px.select("y", "x", *C.flood(F.col("a"), (88, 139, 179), C.ripple(X.WIDTH, X.height(t), *WAVES["b"])))


@query(
    "d15_tint_overlay", RGB,
    X.with_("raster", ctes=BLUE, body="SELECT p.y, p.x, " + ", ".join(f"CASE WHEN m.y IS NULL THEN {c} ELSE ({c} * 45 + {v} * 55) // 100 END AS {c}" for c, v in zip("rgb", (0, 200, 255))) + " FROM raster p LEFT JOIN blue m ON m.y = p.y AND m.x = p.x"),
)
def d15(t):
    m = R.to_pixels(blue_runs(t)).select("y", "x", F.lit(True).alias("m"))
    px = X.raster(t).join(m, ["y", "x"], "left")
    return px.select("y", "x", *C.tint_overlay(F.col("m").isNotNull()))


GREY = "((r * 19595 + g * 38470 + b * 7471 + 32768) // 65536)"


def grade_sql(src, color, brightness, contrast):
    return (
        f"g1 AS (SELECT y, x, {each(U8.format(f'{GREY} * {d(1 - color)} + @ * {d(color)}'), None)} FROM {src}),\n"
        f"g2 AS (SELECT y, x, {each(U8.format(f'@ * {d(brightness)}'), None)} FROM g1),\n"
        f"gm AS (SELECT floor(CAST(sum({GREY}) AS DOUBLE) / count(*) + 0.5) AS m FROM g2),\n"
        f"g3 AS (SELECT y, x, {each(U8.format(f'm * {d(1 - contrast)} + @ * {d(contrast)}'), None)} FROM g2, gm),\n"
    )


for _name, _p in (("strong", (1.30, 1.06, 1.05)), ("mild", (1.14, 1.03, 1.03))):
    query(f"d16_grade_{_name}", RGB, X.with_("raw_raster", ctes=grade_sql("raw_raster", *_p), body="SELECT * FROM g3"))(
        lambda t, p=_p: M.grade(X.raw_raster(t), *p)
    )


@query(
    "d17_mark_box", RGB,
    X.with_(
        "raster",
        body="SELECT y, x, " + ", ".join(f"CASE WHEN on_edge THEN {v} ELSE {c} END AS {c}" for c, v in zip("rgb", (237, 28, 36)))
        + " FROM (SELECT *, x % 25 >= 12 AND y % 25 >= 12 AND NOT (x % 25 BETWEEN 14 AND 22 AND y % 25 BETWEEN 14 AND 22) AS on_edge FROM raster)",
    ),
)
def d17(t):
    px = X.raster(t).select("*", F.col("y").alias("cy"), F.col("x").alias("cx"))
    px = px.withColumn("y", F.col("y") % X.TILE).withColumn("x", F.col("x") % X.TILE)
    edge = C.on_outline(F.lit(12), F.lit(12), F.lit(25), F.lit(25))
    return px.select(F.col("cy").alias("y"), F.col("cx").alias("x"), *[F.when(edge, v).otherwise(F.col(c)).alias(c) for c, v in zip("rgb", C.RED)])


@query(
    "d18_clip_u8", RGB,
    X.with_("raw_raster", body=f"SELECT y, x, {each(U8.format(f'(@ - 40) * {d(1.7)}'), None)} FROM raw_raster"),
)
def d18(t):
    return X.raw_raster(t).select("y", "x", *[C.clip_u8((F.col(c) - 40) * F.lit(1.7)).alias(c) for c in "rgb"])


def noise_sql(ch):
    h = f"(x * 73856093 + y * 19349663 + {ch} * 83492791)"
    return f"((({h} % 1000003) * (({h} % 1000003) % 1009 + 7919) % 1000003) % 11 - 5)"


@query("d19_fill_noise", "y:l x:l n0:l n1:l n2:l", X.with_("raster", body="SELECT y, x, " + ", ".join(f"{noise_sql(i)} AS n{i}" for i in range(3)) + " FROM raster"))
def d19(t):
    return X.raster(t).select("y", "x", *[C.fill_noise(i).alias(f"n{i}") for i in range(3)])


def styled_tiles(t):
    """Pixels of the tiles that hold some water; the others are missing."""
    px = tiled(X.raster(t))
    wet = px.where(C.is_blue()).groupBy("col", "row").count().where("count >= 10")
    px = px.join(wet, ["col", "row"], "left_semi")
    return px.select("col", "row", (F.col("y") % X.TILE).alias("y"), (F.col("x") % X.TILE).alias("x"), "r", "g", "b")


STITCH = BLUE + """wet AS (SELECT x // 25 AS c, y // 25 AS q FROM blue GROUP BY ALL HAVING count(*) >= 10),
hole AS (SELECT c, q FROM (SELECT max(c) + 1 AS cols, max(q) + 1 AS rows FROM wet), range(cols) AS a(c), range(rows) AS b(q) WHERE NOT EXISTS (SELECT 1 FROM wet z WHERE z.c = a.c AND z.q = b.q)),
whole AS (SELECT y, x, r, g, b FROM raster JOIN wet ON c = x // 25 AND q = y // 25
  UNION ALL SELECT q * 25 + j, c * 25 + i, {bg} FROM hole, range(25) AS u(j), range(25) AS v(i))"""


@query("h1_stitch", RGB, X.with_("raster", "size", ctes=STITCH.format(bg="16, 16, 20"), body="SELECT * FROM whole"))
def h1(t):
    from tessella.operators import grid as G

    px = styled_tiles(t)
    return M.stitch(px, G.grid_extent(px), X.TILE)


@query("h1_stitch_raw", RGB, X.with_("raster", "size", ctes=STITCH.format(bg="0, 0, 0"), body="SELECT * FROM whole"))
def h1r(t):
    from tessella.operators import grid as G

    px = styled_tiles(t)
    return M.stitch(px, G.grid_extent(px), X.TILE, background=(0, 0, 0))


MEAN = "SELECT y // {f} AS y, x // {f} AS x, sum(r) // count(*) AS r, sum(g) // count(*) AS g, sum(b) // count(*) AS b FROM raster, size GROUP BY ALL"


@query("h2_preview", RGB, X.with_("raster", "size", body=MEAN.format(f="greatest(1, (greatest(h, w) + 31) // 32)").replace("GROUP BY ALL", "GROUP BY 1, 2")))
def h2(t):
    return M.preview(X.raster(t), X.WIDTH, X.height(t), 32)


@query("h2_small_preview", RGB, X.with_("raster", "size", body=MEAN.format(f="greatest(6, (greatest(h, w) + 2047) // 2048)").replace("GROUP BY ALL", "GROUP BY 1, 2")))
def h2b(t):
    return M.small_preview(X.raster(t), X.WIDTH, X.height(t))


RAMP = "(CASE WHEN y < 15 THEN y / {s} ELSE 1 END * CASE WHEN h - 1 - y < 15 THEN (h - 1 - y) / {s} ELSE 1 END * CASE WHEN w - 1 - x < 15 THEN (w - 1 - x) / {s} ELSE 1 END)".format(s=d(15.0))


@query("h3_edge_ramp", "y:l x:l alpha:d", X.with_("raster", "size", body=f"SELECT y, x, round({RAMP}, 4) AS alpha FROM raster, size"))
def h3(t):
    return X.raster(t).select("y", "x", F.round(C.edge_ramp(X.WIDTH, X.height(t), 15), 4).alias("alpha"))


RINGS = (12, 20, 24, 64)


@query(
    "h4_ring_feather", "y:l x:l a12:l a20:l a24:l a64:l",
    X.with_(
        "raster", "size",
        body="SELECT y, x, " + ", ".join(f"CASE WHEN dd < {n} THEN (dd + 1) * 255 // {n + 1} ELSE 255 END AS a{n}" for n in RINGS) + " FROM (SELECT *, least(x, y, w - 1 - x, h - 1 - y) AS dd FROM raster, size)",
    ),
)
def h4(t):
    e = C.edge_distance(F.lit(X.WIDTH), F.lit(X.height(t)))
    return X.raster(t).select("y", "x", *[C.ring_feather(e, n).alias(f"a{n}") for n in RINGS])


@query(
    "h5_blend", RGB_D,
    X.with_(
        "raster", "raw_raster", "size", ctes=f"o AS (SELECT y, x + 40 AS x, r, g, b, {RAMP} AS a FROM raw_raster, size)",
        body="SELECT p.y, p.x, " + ", ".join(f"round(coalesce(o.{c}, 0) * coalesce(a, 0) + p.{c} * (1 - coalesce(a, 0)), 4) AS {c}" for c in "rgb") + " FROM raster p LEFT JOIN o ON o.y = p.y AND o.x = p.x",
    ),
)
def h5(t):
    h = X.height(t)
    return rounded(M.overlay(X.raster(t), X.raw_raster(t), 40, 0, X.WIDTH, h, C.edge_ramp(X.WIDTH, h, 15)))


@query(
    "h6_fill_uncovered", RGB,
    X.with_(
        "raster", ctes=BLUE, body="SELECT p.y, p.x, " + ", ".join(f"CASE WHEN m.y IS NULL THEN {v} ELSE {c} END AS {c}" for c, v in zip("rgb", (120, 135, 110))) + " FROM raster p LEFT JOIN blue m ON m.y = p.y AND m.x = p.x",
    ),
)
def h6(t):
    from tessella.plans.finishing import fill_uncovered

    return fill_uncovered(X.raster(t).where(C.is_blue()), X.WIDTH, X.height(t), BLOCK)


LEVELS = """top AS (SELECT CAST(ceil(log2(greatest(w, h))) AS BIGINT) AS t FROM size),
lv AS (SELECT unnest(range(t + 1)) AS level, t FROM top),
levels AS (SELECT level, y // (CAST(1 AS BIGINT) << (t - level)::INT) AS y, x // (CAST(1 AS BIGINT) << (t - level)::INT) AS x, sum(r) // count(*) AS r, sum(g) // count(*) AS g, sum(b) // count(*) AS b
  FROM raster, lv GROUP BY 1, 2, 3)"""


def levels_of(t):
    return P.pyramid_levels(X.raster(t), X.WIDTH, X.height(t))


@query("h7_pyramid_levels", "level:l y:l x:l r:l g:l b:l", X.with_("raster", "size", ctes=LEVELS, body="SELECT * FROM levels"))
def h7(t):
    return levels_of(t)


PACKED = LEVELS + """,
packed AS (SELECT level, x // 32 AS c, y // 32 AS r, max(x % 32) + 1 AS w, max(y % 32) + 1 AS h,
  md5(string_agg(printf('%02X%02X%02X', r, g, b), '' ORDER BY y, x)) AS hash FROM (SELECT level, y, x, r::INT AS r, g::INT AS g, b::INT AS b FROM levels) GROUP BY level, x // 32, y // 32)"""


@query("h8_pyramid_tiles", "level:l c:l r:l w:l h:l hash:s", X.with_("raster", "size", ctes=PACKED, body="SELECT * FROM packed"))
def h8(t):
    return P.pyramid_tiles(levels_of(t), 32).withColumn("hash", F.md5("hex"))


@query(
    "h9_pyramid_summary", "level:l tiles:l px:l",
    X.with_("raster", "size", ctes=PACKED, body="SELECT level, count(*) AS tiles, sum(w * h) AS px FROM packed GROUP BY ROLLUP (level)"),
)
def h9(t):
    return P.pyramid_summary(P.pyramid_tiles(levels_of(t), 32))


@query("a10_write_pyramid", "level:l c:l r:l hash:s width:l height:l", X.with_("raster", "size", ctes=PACKED, body="SELECT level, c, r, hash, size.w AS width, size.h AS height FROM packed, size"))
def a10(t):
    w, h = X.WIDTH, X.height(t)
    path = new_path(t.spark, "pyramid")
    sinks.write_pyramid(P.pyramid_tiles(levels_of(t), 32), P.descriptor(t.spark, w, h, 32), path)
    size = t.spark.read.schema("width int, height int, tile_size int, overlap int, format string").json(f"{path}/descriptor").first()
    tiles = t.spark.read.parquet(f"{path}/tiles")
    return tiles.select("level", "c", "r", F.md5("hex").alias("hash"), F.lit(size["width"]).alias("width"), F.lit(size["height"]).alias("height"))


@query(
    "h10_restore_structures", RGB,
    X.with_(
        "raster", "raw_raster", "size",
        ctes="bright AS (SELECT y, x FROM raster WHERE r + g + b > 384 AND abs(r - b) < 22),\n" + S.dilate("m", "bright", 1),
        body="SELECT p.y, p.x, " + ", ".join(f"CASE WHEN m.y IS NULL THEN p.{c} ELSE o.{c} END AS {c}" for c in "rgb") + " FROM raw_raster p JOIN raster o ON o.y = p.y AND o.x = p.x LEFT JOIN m ON m.y = p.y AND m.x = p.x",
    ),
)
def h10(t):
    orig = X.raster(t)
    bright = R.from_pixels(orig.where(C.is_neutral_bright(128, 22)), block=BLOCK)
    keep = R.to_pixels(R.dilate(bright, 1, X.WIDTH, X.height(t), block=BLOCK))
    return M.restore(X.raw_raster(t), orig, keep)


@query("h14_crop", RGB, X.with_("raster", "size", body="SELECT y - CAST(floor(h * 0.25) AS BIGINT) AS y, x - 12 AS x, r, g, b FROM raster, size WHERE x >= 12 AND x < 100 AND y >= floor(h * 0.25) AND y < floor(h * 0.75)"))
def h14(t):
    h = X.height(t)
    return M.crop_share(X.raster(t), X.WIDTH, h, 0.1, 0.25, 0.8, 0.75)


@query(
    "h15_before_after", RGB,
    X.with_(
        "raster", "raw_raster",
        ctes=f"tl AS (SELECT col, row, row_number() OVER (ORDER BY col, row) - 1 AS slot, th FROM (SELECT {TILE_OF}, max(y % 25) + 1 AS th FROM raster GROUP BY ALL) ORDER BY col, row LIMIT 6),\n"
        "f AS (SELECT *, min(th) OVER () AS n FROM tl)",
        body="SELECT slot * n + y % 25 AS y, x % 25 AS x, r, g, b FROM raster p JOIN f ON f.col = p.x // 25 AND f.row = p.y // 25 WHERE y % 25 < n UNION ALL"
        " SELECT slot * n + y % 25, x % 25 + 25, r, g, b FROM raw_raster p JOIN f ON f.col = p.x // 25 AND f.row = p.y // 25 WHERE y % 25 < n",
    ),
)
def h15(t):
    def cut(df):
        return tiled(df).withColumn("y", F.col("y") % X.TILE).withColumn("x", F.col("x") % X.TILE)

    return M.before_after(cut(X.raster(t)), cut(X.raw_raster(t)), ["col", "row"], 6, X.TILE)
