"""Checked queries: composed jobs (F5, F6, F8, F10-F12, G7, G8, H11-H13, J6) and edits of boxes (C12-C16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella import fixtures as X
from tessella.functions import color as C
from tessella.operators import grid as GR
from tessella.operators import mosaic as M
from tessella.operators import regions as G
from tessella.operators import runs as R
from tessella.plans import editor as E
from tessella.plans import finishing as P
from tessella.plans import river as V
from tessella.queries import sqlgen as S
from tessella.queries import vectors as VQ
from tessella.queries.neighbors import BLOCK, BLUE, as_runs, blue_runs, frame, runs_sql, smooth_sql
from tessella.queries.pixels import RGB, U8, WAVES, d, each, flood_sql, grade_sql, noise_sql, ripple_sql, tiled
from tessella.queries.registry import QUERIES, query
from tessella.session import save

BIG, SMALL, RING, PAD = 200, 5, 6, 8

POOLS = BLUE + S.label("lab", "blue") + f"""sizes AS (SELECT label, sum(x1 - x0 + 1) AS px FROM lab GROUP BY label),
pools AS (SELECT * FROM sizes WHERE px < {BIG} AND px >= {SMALL}),
pp AS (SELECT label, y, unnest(range(x0, x1 + 1)) AS x FROM lab WHERE label IN (SELECT label FROM pools)),
bb AS (SELECT label, greatest(min(y) - {PAD}, 0) AS y0, least(max(y) + 1 + {PAD}, any_value(h)) AS y1, greatest(min(x) - {PAD}, 0) AS x0, least(max(x) + 1 + {PAD}, any_value(w)) AS x1 FROM pp, size GROUP BY label),
shore AS (SELECT DISTINCT p.label, p.y + dy AS y, p.x + dx AS x FROM pp p, {S.offsets(RING)} o),
med AS (SELECT s.label, count(*) AS n, median(r) AS r, median(g) AS g, median(b) AS b FROM shore s JOIN bb USING (label) JOIN raster p ON p.y = s.y AND p.x = s.x
  WHERE s.y >= bb.y0 AND s.y < bb.y1 AND s.x >= bb.x0 AND s.x < bb.x1 AND NOT EXISTS (SELECT 1 FROM blue z WHERE z.y = s.y AND z.x = s.x) GROUP BY s.label),
fills AS (SELECT p.label, px, coalesce(n, 0) AS n, CASE WHEN coalesce(n, 0) >= 30 THEN m.r ELSE 150 END AS r, CASE WHEN coalesce(n, 0) >= 30 THEN m.g ELSE 148 END AS g,
  CASE WHEN coalesce(n, 0) >= 30 THEN m.b ELSE 143 END AS b FROM pools p LEFT JOIN med m USING (label)),
"""


def stray_sql(src="raster"):
    cols = ", ".join(
        f"CASE WHEN f.{c} IS NULL THEN p.{c} ELSE " + U8.format(f"CAST(f.{c} AS DOUBLE) + " + noise_sql(i).replace("x *", "p.x *").replace("y *", "p.y *")) + f" END AS {c}"
        for i, c in enumerate("rgb")
    )
    return f"stray AS (SELECT p.y, p.x, {cols} FROM {src} p LEFT JOIN (SELECT pp.y, pp.x, fills.* FROM pp JOIN fills USING (label)) f ON f.y = p.y AND f.x = p.x),\n"


@query("f5_remove_stray_pools", RGB, X.with_("raster", "size", ctes=POOLS + stray_sql(), body="SELECT * FROM stray"))
def f5(t):
    _, w, h = frame(t)
    return P.remove_stray_pools(X.raster(t), w, h, BIG, SMALL, BLOCK, ring=RING, pad=PAD)


@query("f6_shore_median", "label:l px:l n:l r:d g:d b:d", X.with_("raster", "size", ctes=POOLS, body="SELECT * FROM fills"))
def f6(t):
    _, w, h = frame(t)
    blue = save(blue_runs(t), "blue")
    reg = G.label(blue, block=BLOCK)
    pools = G.touching_pools(reg, BIG, SMALL)
    return G.shore_median(reg, pools, blue, X.raster(t), w, h, RING, PAD, block=BLOCK)


SPOT = S.box("bx", "raster", 11, {"s1": "p.r + p.g + p.b", "s2": "(p.r + p.g + p.b) * (p.r + p.g + p.b)", "r": "p.r", "g": "p.g", "b": "p.b"}) + (
    f"flat AS (SELECT y, x FROM bx WHERE s2 * 121 - s1 * s1 < {121 * 121 * 9 * 36} AND s1 > {3 * 121 * 95} AND s1 < {3 * 121 * 170} AND greatest(r, g, b) - least(r, g, b) < {30 * 121}),\n"
) + S.label("lab", "flat") + """reg AS (SELECT label, sum(x1 - x0 + 1) AS px, CAST(sum((x0 + x1) * (x1 - x0 + 1)) AS DOUBLE) / 2 / sum(x1 - x0 + 1) AS fx, CAST(sum(y * (x1 - x0 + 1)) AS DOUBLE) / sum(x1 - x0 + 1) AS fy FROM lab GROUP BY label),
ok AS (SELECT * FROM reg, size WHERE px >= 10 * 4 * 1.5 AND fx >= 17 AND fx <= w - 17 AND fy >= 14 AND fy <= h - 14),
best AS (SELECT *, pow((fx - w / 2) / w, 2) + pow((fy - h / 2) / h, 2) AS p FROM ok ORDER BY p DESC, label LIMIT 1)"""


@query("f8_flat_spot", "x:l y:l", X.with_("raster", "size", ctes=SPOT, body="SELECT coalesce(CAST(floor(fx - 5) AS BIGINT), w - 70) AS x, coalesce(CAST(floor(fy - 2) AS BIGINT), h - 64) AS y FROM (SELECT w, h FROM size) s LEFT JOIN (SELECT fx, fy FROM best) b ON true"))
def f8(t):
    _, w, h = frame(t)
    return P.flat_spot(X.raster(t), w, h, 10, 4, spread=30, block=BLOCK)


def weights(sigma):
    from tessella.operators.neighborhood import gaussian_weights

    return gaussian_weights(sigma)


def feather_sql(name, mask, sigma):
    """``name`` (y, x, fm) from the mask of pixels."""
    k = sum(weights(sigma)) ** 2
    return (
        f"{name}_s AS (SELECT c.y, c.x, CASE WHEN m.y IS NULL THEN 0 ELSE 255 END AS v FROM (SELECT y, x FROM raster) c LEFT JOIN {mask} m ON m.y = c.y AND m.x = c.x),\n"
        + S.blur(name + "_b", name + "_s", weights(sigma), "p.v")
        + f"{name} AS (SELECT y, x, (v // {k}) / {d(255.0)} AS fm FROM {name}_b),\n"
    )


MED10 = BLUE + feather_sql("fe", "blue", 3) + "md AS (SELECT median(r) AS mr, median(g) AS mg, median(b) AS mb FROM raster JOIN blue USING (y, x)),\n"


@query(
    "f10_masked_median_colour", "y:l x:l r:d g:d b:d",
    X.with_("raster", "size", ctes=MED10, body="SELECT y, x, " + ", ".join(f"round({c} * (1 - fm * {d(0.75)}) + m{c} * (fm * {d(0.75)}), 4) AS {c}" for c in "rgb") + " FROM raster JOIN fe USING (y, x), md"),
)
def f10(t):
    _, w, h = frame(t)
    out = P.blend_to_median(X.raster(t), blue_runs(t), w, h, BLOCK)
    return out.select("y", "x", *[F.round(c, 4).alias(c) for c in "rgb"])


# per-tile water mask: every tile is a canvas of its own
TILE_MASK = (
    """tp AS (SELECT x // 25 AS col, y // 25 AS row, y % 25 AS y, x % 25 AS x, r, g, b FROM raster),
ts AS (SELECT col, row, max(x) + 1 AS w, max(y) + 1 AS h FROM tp GROUP BY ALL),
tx AS (SELECT *, unnest(range(-4, w + 4)) AS v FROM ts), ty AS (SELECT *, unnest(range(-4, h + 4)) AS v FROM ts),
mir AS (SELECT tx.col, tx.row, ty.v AS y, tx.v AS x, r + g + b AS s FROM tx JOIN ty USING (col, row) JOIN tp ON tp.col = tx.col AND tp.row = tx.row
  AND tp.x = CASE WHEN tx.v < 0 THEN -1 - tx.v WHEN tx.v >= tx.w THEN 2 * tx.w - 1 - tx.v ELSE tx.v END AND tp.y = CASE WHEN ty.v < 0 THEN -1 - ty.v WHEN ty.v >= ty.h THEN 2 * ty.h - 1 - ty.v ELSE ty.v END),
bh AS (SELECT col, row, y, x + e AS x, sum(s) AS s1, sum(s * s) AS s2 FROM mir, range(-4, 5) AS q(e) GROUP BY ALL),
bv AS (SELECT col, row, y + e AS y, x, sum(s1) AS s1, sum(s2) AS s2 FROM bh, range(-4, 5) AS q(e) GROUP BY ALL),
cand AS (SELECT tp.col, tp.row, tp.y, tp.x FROM tp JOIN bv USING (col, row, y, x) WHERE s2 * 81 - s1 * s1 < """
    + str(81 * 81 * 9 * 36)
    + " AND r + g + b < 600),\n"
    + S.label("lab", "cand", "col, row")
    + """big AS (SELECT col, row, label FROM lab JOIN ts USING (col, row) GROUP BY col, row, label, w, h HAVING sum(x1 - x0 + 1) > w * h * 0.03),
bp AS (SELECT col, row, y, unnest(range(x0, x1 + 1)) AS x FROM lab SEMI JOIN big USING (col, row, label)),
dil AS (SELECT DISTINCT col, row, m.y + dy AS y, m.x + dx AS x FROM bp m JOIN ts USING (col, row), """
    + S.offsets(3)
    + """ o WHERE m.y + dy BETWEEN 0 AND h - 1 AND m.x + dx BETWEEN 0 AND w - 1),
wm AS (SELECT col, row, m.y + dy AS y, m.x + dx AS x FROM dil m, """
    + S.offsets(3)
    + " o GROUP BY ALL HAVING count(*) = 25),\n"
)


def tile_pixels(t):
    px = tiled(X.raster(t)).withColumn("y", F.col("y") % X.TILE).withColumn("x", F.col("x") % X.TILE)
    h = X.height(t)
    return px.select(
        "col", "row", F.least(F.lit(X.TILE), F.lit(X.WIDTH) - F.col("col") * X.TILE).alias("w"),
        F.least(F.lit(X.TILE), F.lit(h) - F.col("row") * X.TILE).alias("h"), "y", "x", "r", "g", "b",
    )


@query("f11_tile_water_mask", "col:l row:l y:l x0:l x1:l", X.with_("raster", ctes=TILE_MASK + S.runs("q", "wm", "col, row"), body="SELECT * FROM q"))
def f11a(t):
    return P.tile_water_mask(tile_pixels(t), block=BLOCK)


@query("f11_tile_water_mask_blocks", "col:l row:l y:l x0:l x1:l", X.with_("raster", ctes=TILE_MASK + S.runs("q", "wm", "col, row"), body="SELECT * FROM q"))
def f11a_blocks(t):
    """As above with blocks of 8 pixels, so that every tile spans several."""
    by = ["col", "row", "w", "h"]
    return R.maximal(P.tile_water_mask(tile_pixels(t), block=8), by, 8)


@query(
    "j6_augment_controls", "col:l row:l y:l x:l r:l g:l b:l",
    X.with_(
        "raster", ctes=TILE_MASK,
        body="SELECT col, row, y, x, " + ", ".join(f"CASE WHEN m.z IS NULL THEN {c} ELSE greatest(0, least(255, {c} + CASE WHEN (x // 2 + y // 2) % 2 = 1 THEN 10 ELSE -10 END)) END AS {c}" for c in "rgb")
        + " FROM tp LEFT JOIN (SELECT *, 1 AS z FROM wm) m USING (col, row, y, x)",
    ),
)
def j6(t):
    px = tile_pixels(t)
    return P.augment_controls(px, P.tile_water_mask(px, block=BLOCK))


GREEN = "NOT (g - r > 10 AND g - b > 10)"
MASK_B = smooth_sql(25, 13) + f"cand AS (SELECT y, x FROM flag WHERE smooth AND {GREEN} AND r + g + b < 495 AND r + g + b > 90),\n" + S.label("lab", "cand") + (
    "bigl AS (SELECT label FROM lab, size GROUP BY label, w, h HAVING sum(x1 - x0 + 1) > w * h * 0.003),\nbigp AS (SELECT y, unnest(range(x0, x1 + 1)) AS x FROM lab WHERE label IN (SELECT label FROM bigl)),\n"
) + S.closing("clo", "bigp", 4) + S.dilate("wmask", "clo", 1)


@query("f11_raw_water_mask", "y:l x0:l x1:l", runs_sql(MASK_B, "wmask"))
def f11b(t):
    _, w, h = frame(t)
    return as_runs(P.raw_water_mask(X.raster(t), w, h, block=BLOCK))


MASK_C = smooth_sql(9, 9) + f"cand AS (SELECT y, x FROM flag WHERE smooth AND {GREEN} AND r + g + b < 450),\n" + S.label("lab", "cand") + (
    "bigl AS (SELECT label FROM lab, size GROUP BY label, w, h HAVING sum(x1 - x0 + 1) > w * h * 0.004),\nbigp AS (SELECT y, unnest(range(x0, x1 + 1)) AS x FROM lab WHERE label IN (SELECT label FROM bigl)),\n"
) + S.closing("wmask", "bigp", 2)


@query("f11_preview_water_mask", "y:l x0:l x1:l", runs_sql(MASK_C, "wmask"))
def f11c(t):
    _, w, h = frame(t)
    return as_runs(P.preview_water_mask(X.raster(t), w, h, block=BLOCK))


# The raw capture, half as wide and high as the styled picture; its mask is made at its own size and then brought to the picture's.
SEEN = (
    "capture_size AS (SELECT (w + 1) // 2 AS w, (h + 1) // 2 AS h FROM size),\ncapture AS (SELECT y // 2 AS y, x // 2 AS x, r, g, b FROM raster WHERE y % 2 = 0 AND x % 2 = 0),\n"
    + "seen AS (WITH RECURSIVE size AS (SELECT * FROM capture_size), raster AS (SELECT * FROM capture),\n" + MASK_B.rstrip().rstrip(",") + "\nSELECT y, x FROM wmask),\n"
    + "water AS (SELECT p.y, p.x FROM raster p, size s, capture_size k, seen m WHERE m.y = (2 * p.y + 1) * k.h // (2 * s.h) AND m.x = (2 * p.x + 1) * k.w // (2 * s.w)),\n"
)
F12 = SEEN + feather_sql("fe", "water", 4) + smooth_sql(7, 11) + f"rough AS (SELECT y, x FROM flag WHERE vkey > {7**4 * 9 * 121}),\n" + S.dilate("dry", "rough", 2) + (
    "al AS (SELECT p.y, p.x, p.r, p.g, p.b, w, h, CASE WHEN q.y IS NULL THEN fm ELSE 0 END AS a FROM raster p JOIN fe ON fe.y = p.y AND fe.x = p.x LEFT JOIN dry q ON q.y = p.y AND q.x = p.x, size),\n"
)


@query("f12_flood_from_raw", RGB, X.with_("raster", "size", ctes=F12, body=f"SELECT y, x, {flood_sql('a', (104, 111, 120), ripple_sql(*WAVES['a']))} FROM al"))
def f12(t):
    _, w, h = frame(t)
    capture = X.raster(t).where("y % 2 = 0 and x % 2 = 0").selectExpr("cast(y div 2 as int) y", "cast(x div 2 as int) x", "r", "g", "b")
    return P.flood_from_capture(X.raster(t), w, h, capture, (w + 1) // 2, (h + 1) // 2, block=BLOCK)


# A closer view of the map, so that its squares are some fifty pixels wide.
NEAR = {"a00": 50.0, "a01": 7.0, "a10": -6.0, "a11": 45.0, "a20": 12.0, "a21": -3.0, "clat": 0.25, "clng": 2.5, "mlat": 1.0, "mlng": 1.0, "col0": 1.0, "row0": -1.0}
RIVERS = VQ.polygons_sql(NEAR, "(SELECT w FROM size)", "(SELECT h FROM size)")


def river_runs(t, w, h):
    return save(VQ.polygon_runs(t, NEAR, w, h, BLOCK), "rivers")


G7 = RIVERS + S.canvas() + S.minus("land", "canvas", "poly") + S.label("bg", "land") + (
    "rim AS (SELECT DISTINCT label FROM bg, size WHERE y = 0 OR y = h - 1 OR x0 = 0 OR x1 = w - 1),\ninner_runs AS (SELECT * FROM bg WHERE label NOT IN (SELECT label FROM rim)),\n"
) + S.pixels("holes", "inner_runs") + S.either("filled", "poly", "holes") + S.closing("clo", "filled", 22) + (
    "bright AS (SELECT y, x FROM raster WHERE r + g + b > 495),\n"
) + S.opening("bo", "bright", 6) + S.minus("thin", "bright", "bo") + S.minus("m", "clo", "thin")


@query("g7_river_flood_mask", "y:l x0:l x1:l", runs_sql(G7, "m", ("arcs", "raster", "size")))
def g7(t):
    _, w, h = frame(t)
    return as_runs(P.river_flood_mask(river_runs(t, w, h), X.raster(t), w, h, block=BLOCK))


G8 = RIVERS + smooth_sql(9, 57, "raw_raster") + f"rough AS (SELECT y, x FROM flag WHERE vkey > {9**4 * 9 * 38 * 38}),\n" + S.both("tex", "rough", "poly") + S.opening("blob", "tex", 2) + S.minus("thin", "tex", "blob") + S.dilate("bridge", "thin", 1) + S.minus("fl", "poly", "bridge") + feather_sql("fe", "fl", 2) + (
    "al AS (SELECT p.y, p.x, p.r, p.g, p.b, w, h, fm AS a FROM raster p JOIN fe ON fe.y = p.y AND fe.x = p.x, size),\n"
)


@query("g8_osm_flood_v1", RGB, X.with_("arcs", "raster", "raw_raster", "size", ctes=G8, body=f"SELECT y, x, {flood_sql('a', (104, 111, 120), ripple_sql(*WAVES['a']))} FROM al"))
def g8(t):
    _, w, h = frame(t)
    return P.polygon_flood(river_runs(t, w, h), X.raw_raster(t), X.raster(t), w, h, texture=38, thin=2, block=BLOCK)


def roll(src):
    m = f"((r + g + b) / {d(3.0)})"
    return f"(SELECT y, x, {each(f'greatest(least(CASE WHEN {m} > 200 THEN @ * ((CAST(200 AS DOUBLE) + ({m} - CAST(200 AS DOUBLE)) * {d(0.40)}) / {m}) ELSE @ END, CAST(255 AS DOUBLE)), CAST(0 AS DOUBLE))', None)} FROM {src})"


_RAMP = "(CASE WHEN y < 15 THEN y / {s} ELSE 1 END * CASE WHEN h - 1 - y < 15 THEN (h - 1 - y) / {s} ELSE 1 END * CASE WHEN w - 1 - x < 15 THEN (w - 1 - x) / {s} ELSE 1 END)".format(s=d(15.0))


@query(
    "h11_deploy_mosaic", RGB,
    X.with_(
        "raster", "raw_raster", "size",
        ctes=f"a AS (SELECT y, x + 50 AS x, r, g, b FROM {roll('raster')}), o AS (SELECT y + 30 AS y, x, r, g, b, {_RAMP} AS al FROM {roll('raw_raster')}, size),\n"
        "cv AS (SELECT a.i AS y, b.i AS x FROM size, range(h + 40) AS a(i), range(w + 50) AS b(i))",
        body="SELECT c.y, c.x, " + ", ".join(
            f"CASE WHEN a.r IS NOT NULL OR coalesce(al, 0) > 0.05 THEN {U8.format(f'coalesce(o.{c}, 0) * coalesce(al, 0) + coalesce(a.{c}, 0) * (1 - coalesce(al, 0))')} ELSE {v} END AS {c}" for c, v in zip("rgb", (120, 135, 110))
        ) + " FROM cv c LEFT JOIN a ON a.y = c.y AND a.x = c.x LEFT JOIN o ON o.y = c.y AND o.x = c.x",
    ),
)
def h11(t):
    _, w, h = frame(t)
    return P.deploy_mosaic(X.raster(t), (50, 0, w, h), X.raw_raster(t), (0, 30, w, h), w + 50, h + 40, 15, block=BLOCK)


_mid = lambda c: f"(list_sort(list({c}))[(count(*) + 1) // 2] + list_sort(list({c}))[(count(*) + 2) // 2]) / {d(2.0)}"
PREVIEW = (
    "soft AS " + roll("raster").replace("200", "190").replace(d(0.40), d(0.30)) + ",\n"
    + "whole AS (SELECT y, x, " + ", ".join(f"{U8.format(c)} AS {c}" for c in "rgb") + " FROM soft),\n"
    + MASK_C.replace(smooth_sql(9, 9), smooth_sql(9, 9, "whole")) + feather_sql("fe", "wmask", 3)
    + "md AS (SELECT count(*) AS n, " + ", ".join(f"{_mid(c)} AS m{c}" for c in "rgb") + " FROM soft JOIN wmask USING (y, x)),\n"
    + "lay AS (SELECT y, x, " + ", ".join(f"greatest(least(CASE WHEN n > 100 THEN {c} * (1 - fm * {d(0.75)}) + m{c} * (fm * {d(0.75)}) ELSE {c} END, {d(255.0)}), {d(0.0)}) AS {c}" for c in "rgb")
    + " FROM soft JOIN fe USING (y, x), md),\n"
    + f"a AS (SELECT y, x + 50 AS x, r, g, b FROM lay), o AS (SELECT y + 30 AS y, x, r, g, b, {_RAMP} AS al FROM lay, size),\n"
    + "cv AS (SELECT a.i AS y, b.i AS x FROM size, range(h + 40) AS a(i), range(w + 50) AS b(i))"
)


@query(
    "h11_preview_mosaic", RGB,
    X.with_(
        "raster", "size", ctes=PREVIEW,
        body="SELECT c.y, c.x, " + ", ".join(f"{U8.format(f'coalesce(o.{c}, 0) * coalesce(al, 0) + coalesce(a.{c}, 0) * (1 - coalesce(al, 0))')} AS {c}" for c in "rgb")
        + " FROM cv c LEFT JOIN a ON a.y = c.y AND a.x = c.x LEFT JOIN o ON o.y = c.y AND o.x = c.x",
    ),
)
def h11_preview(t):
    """One capture in two places: each layer is drawn toward the median of its own real-valued water first."""
    _, w, h = frame(t)
    return P.preview_mosaic(X.raster(t), (50, 0, w, h), X.raster(t), (0, 30, w, h), w + 50, h + 40, 15, block=BLOCK)


H12 = smooth_sql(9, 40) + "vivid AS (SELECT y, x FROM flag WHERE smooth AND b > r + 18 AND b > g AND b > 115),\n" + S.closing("clo", "vivid", 5) + S.canvas() + S.minus("land", "canvas", "clo") + S.label("bg", "land") + (
    "edge AS (SELECT DISTINCT label FROM bg, size WHERE y = 0 OR y = h - 1 OR x0 = 0 OR x1 = w - 1),\ninner_runs AS (SELECT * FROM bg WHERE label NOT IN (SELECT label FROM edge)),\n"
) + S.pixels("holes", "inner_runs") + S.either("riv", "clo", "holes") + feather_sql("fe", "riv", 3) + (
    "al AS (SELECT p.y, p.x, p.r, p.g, p.b, w, h, fm AS a FROM raster p JOIN fe ON fe.y = p.y AND fe.x = p.x, size),\n"
    f"wet AS (SELECT y, x, {flood_sql('a', (88, 139, 179), ripple_sql(*WAVES['c']))} FROM al),\n"
    "bright AS (SELECT y, x FROM raw_raster WHERE r + g + b > 384 AND abs(r - b) < 22),\n"
) + S.dilate("keep", "bright", 1) + (
    "rest AS (SELECT p.y, p.x, " + ", ".join(f"CASE WHEN k.y IS NULL THEN p.{c} ELSE o.{c} END AS {c}" for c in "rgb")
    + " FROM wet p JOIN raw_raster o ON o.y = p.y AND o.x = p.x LEFT JOIN keep k ON k.y = p.y AND k.x = p.x),\n"
) + grade_sql("rest", 1.14, 1.03, 1.03)


@query("h12_final_finish", RGB, X.with_("raster", "raw_raster", "size", ctes=H12, body="SELECT * FROM g3"))
def h12(t):
    _, w, h = frame(t)
    return P.final_finish(X.raster(t), X.raw_raster(t), w, h, close=5, std=40, block=BLOCK)


_L = f"({d(0.299)} * r + {d(0.587)} * g + {d(0.114)} * b)"
_GREEN = U8.format(f"CASE WHEN g - r > 5 AND g - b > 5 THEN 0 ELSE @ END")


@query(
    "h13_finishing", RGB,
    X.with_(
        "raster", "size",
        ctes=f"orig AS (SELECT * FROM raster),\nsoft AS (SELECT y, x, {each(U8.format(f'CASE WHEN {_L} > 130 THEN @ * ((CAST(130 AS DOUBLE) + ({_L} - 130) * {d((222 - 130) / 125.0)}) / {_L}) ELSE @ END'), None)} FROM orig),\n"
        + POOLS.replace("FROM raster", "FROM soft").replace("JOIN raster", "JOIN soft") + stray_sql("soft"),
        body=f"SELECT y, x, {each(U8.format(f'CASE WHEN g - r > 18 AND g - b > 18 THEN ({_L} * {d(1 - 0.62)} + @ * {d(0.62)}) * {d(0.92)} ELSE @ END'), None)} FROM stray",
    ),
)
def h13(t):
    _, w, h = frame(t)
    return P.finishing(X.raster(t), w, h, knee=130, green=True, block=BLOCK, river_min=BIG, min_px=SMALL, ring=RING, pad=PAD)


# boxes for edits: one per 25 x 25 cell of the picture, at its dearest order (of equals the first), 5 to 13 pixels wide and 4 to 9 high
BOXES = """priced AS (SELECT o_orderkey AS k, o_orderkey % 125 AS x, o_orderkey // 125 AS y, o_totalprice AS p FROM orders),
dear AS (SELECT k, x, y FROM (SELECT *, row_number() OVER (PARTITION BY x // 25, y // 25 ORDER BY p DESC, k) AS nth FROM priced, size WHERE y < h) WHERE nth = 1),
boxes AS (SELECT k AS box_id, least(x, w - (5 + k % 9)) AS x0, least(y, h - (4 + k % 6)) AS y0, least(x, w - (5 + k % 9)) + 5 + k % 9 AS x1, least(y, h - (4 + k % 6)) + 4 + k % 6 AS y1 FROM dear, size WHERE h >= 9)"""


def boxes(t):
    h = X.height(t)
    o = t.orders.selectExpr("o_orderkey k", "o_orderkey % 125 x", "o_orderkey div 125 y", "o_totalprice p").where(F.col("y") < h)
    o = o.withColumn("best", F.struct((-F.col("p")).alias("p"), "k", "x", "y")).groupBy(F.expr("x div 25"), F.expr("y div 25")).agg(F.min("best").alias("b")).select("b.*")
    o = o.withColumn("bw", F.expr("5 + k % 9")).withColumn("bh", F.expr("4 + k % 6"))
    o = o.withColumn("x0", F.least("x", X.WIDTH - F.col("bw"))).withColumn("y0", F.least("y", F.lit(h) - F.col("bh")))
    b = o.selectExpr("k box_id", "x0", "y0", "x0 + bw x1", "y0 + bh y1")
    return b.where(F.lit(h) >= 9)


@query(
    "c15_regenerate_windows", "box_id:l y:l x:l r:l g:l b:l",
    X.with_(
        "raster", "raw_raster", "size", ctes=BOXES + ",\nwin AS (SELECT *, x0 - wx AS p0, y0 - wy AS q0 FROM (SELECT *, greatest(0, least(w - 30, (x0 + x1) // 2 - 15)) AS wx, greatest(0, least(h - 30, (y0 + y1) // 2 - 15)) AS wy FROM boxes, size)),\n"
        "px AS (SELECT box_id, i, j, wx + i AS x, wy + j AS y, i BETWEEN p0 AND p0 + x1 - x0 - 1 AND j BETWEEN q0 AND q0 + y1 - y0 - 1 AS box, i BETWEEN p0 + 2 AND p0 + x1 - x0 - 3 AND j BETWEEN q0 + 2 AND q0 + y1 - y0 - 3 AS core FROM win, range(30) AS a(i), range(30) AS b(j))",
        body="SELECT box_id, j AS y, i AS x, " + ", ".join(f"CASE WHEN box AND NOT core THEN {v} WHEN box THEN q.{c} ELSE p.{c} END AS {c}" for c, v in zip("rgb", (237, 28, 36)))
        + " FROM px JOIN raster p ON p.y = px.y AND p.x = px.x JOIN raw_raster q ON q.y = px.y AND q.x = px.x",
    ),
)
def c15(t):
    return V.regen_windows(X.raster(t), X.raw_raster(t), boxes(t), 30, X.WIDTH, X.height(t))


@query(
    "c16_prefill_box", "box_id:l n:l fr:l fg:l fb:l",
    X.with_(
        "raster", "size", ctes=BOXES + ",\nring AS (SELECT box_id, r, g, b FROM boxes JOIN raster ON x >= x0 - 6 AND x < x1 + 6 AND y >= y0 - 6 AND y < y1 + 6 AND NOT (x >= x0 AND x < x1 AND y >= y0 AND y < y1) AND NOT (b - r > 14 AND b - g > 8 AND b > 90)),\n"
        "m AS (SELECT box_id, count(*) AS n, median(r) AS r, median(g) AS g, median(b) AS b FROM ring GROUP BY box_id)",
        body="SELECT x.box_id, coalesce(n, 0) AS n, CASE WHEN n > 50 THEN CAST(floor(m.r) AS BIGINT) ELSE 150 END AS fr, CASE WHEN n > 50 THEN CAST(floor(m.g) AS BIGINT) ELSE 148 END AS fg, CASE WHEN n > 50 THEN CAST(floor(m.b) AS BIGINT) ELSE 143 END AS fb FROM boxes x LEFT JOIN m USING (box_id)",
    ),
)
def c16(t):
    return V.prefill_color(X.raster(t), boxes(t), ring=6, block=32)


def flip():
    return {c: F.lit(255) - F.col(c) for c in "rgb"}


RULES = "rules AS (SELECT col, row FROM (SELECT x // 25 AS col, y // 25 AS row, count(*) FILTER (b - r > 14 AND b - g > 8 AND b > 90) AS n FROM raster GROUP BY ALL) WHERE n > 200)"


@query(
    "c13_replace_cells", RGB,
    X.with_(
        "raster", "size",
        ctes=RULES + ",\nj AS (SELECT p.*, z.col IS NOT NULL AS hit, least(x % 25, y % 25, least(25, w - x // 25 * 25) - 1 - x % 25, least(25, h - y // 25 * 25) - 1 - y % 25) AS dd, r + g + b > 420 AND abs(r - b) < 24 AS keep FROM raster p LEFT JOIN rules z ON z.col = x // 25 AND z.row = y // 25, size),\n"
        "k AS (SELECT *, CASE WHEN dd < 5 THEN (dd + 1) * 255 // 6 ELSE 255 END AS a FROM j)",
        body="SELECT y, x, " + ", ".join(f"CASE WHEN hit THEN (CASE WHEN keep THEN {c} ELSE 255 - {c} END * a + {c} * (255 - a)) // 255 ELSE {c} END AS {c}" for c in "rgb") + " FROM k",
    ),
)
def c13(t):
    base = save(X.raster(t), "base")
    wet = tiled(base).groupBy("col", "row").agg(F.count_if(C.is_blue()).alias("n")).where("n > 200").select("col", "row")
    return V.replace_cells(base, wet, E.ColumnEditor(flip), X.TILE, 8, 5, X.WIDTH, X.height(t))


@query("c13_replace_cells_images", RGB, QUERIES["c13_replace_cells"].sql)
def c13_images(t):
    """As c13, with an image editor in Python on packed windows."""
    base = save(X.raster(t), "base")
    wet = tiled(base).groupBy("col", "row").agg(F.count_if(C.is_blue()).alias("n")).where("n > 200").select("col", "row")
    negative = E.PythonEditor(lambda row, model: bytes(255 - v for v in row["payload"]))
    return V.replace_cells(base, wet, E.WindowEditor(negative, ("col", "row")), X.TILE, 8, 5, X.WIDTH, X.height(t))


def soften_image(row, model):
    """The rule of ``soften_in_context`` for an image editor."""
    import numpy as np

    px = np.frombuffer(row["payload"], np.uint8).reshape(-1, 3).astype(int)
    return ((px + px.sum(axis=0) // len(px)) // 2).astype(np.uint8).tobytes()


def soften_in_context():
    """Mean of the pixel and the whole window's first channel sum: the result depends on what the window shows."""
    from pyspark.sql import Window as W

    w = W.partitionBy("box_id")
    return {c: F.floor((F.col(c) + F.floor(F.avg(c).over(w))) / 2) for c in "rgb"}


#: Breadth-first order of the wet tiles, then one tile after another on the canvas as it then is.
RIVER = """tt AS (SELECT 0 AS region, col, row, col * 100000 + row AS v FROM (SELECT x // 25 AS col, y // 25 AS row, count(*) FILTER (b - r > 14 AND b - g > 8 AND b > 90) AS n FROM raster GROUP BY ALL) WHERE n > 50),
ee AS (SELECT a.v AS a, b.v AS b, d.k FROM tt a, (VALUES (1, 0, '0'), (-1, 0, '1'), (0, 1, '2'), (0, -1, '3')) AS d(dx, dy, k), tt b WHERE b.col = a.col + dx AND b.row = a.row + dy),
rr(root, v) AS (SELECT v, v FROM tt UNION SELECT r.root, e.b FROM rr r JOIN ee e ON e.a = r.v WHERE e.b > r.root),
cc AS (SELECT v, min(root) AS comp FROM rr GROUP BY v),
dd(v, d) AS (SELECT v, 0 FROM cc WHERE v = comp UNION SELECT e.b, w.d + 1 FROM dd w JOIN ee e ON e.a = w.v WHERE w.d < 70),
lv AS (SELECT v, min(d) AS level FROM dd GROUP BY v),
pp(v, level, path) AS (SELECT v, level, '' FROM lv WHERE level = 0
  UNION ALL SELECT e.b, p.level + 1, min(p.path || e.k) FROM pp p JOIN ee e ON e.a = p.v JOIN lv ON lv.v = e.b AND lv.level = p.level + 1 GROUP BY e.b, p.level + 1),
tile AS (SELECT v // 100000 * 25 AS x0, v % 100000 * 25 AS y0, row_number() OVER (ORDER BY comp, level, path) AS idx FROM pp JOIN cc USING (v)),
job AS (SELECT x0, y0, x0 + 25 AS x1, y0 + 25 AS y1, row_number() OVER (ORDER BY idx) AS nth, greatest(0, least(w - 50, (2 * x0 + 25) // 2 - 25)) AS wx, greatest(0, least(h - 50, (2 * y0 + 25) // 2 - 25)) AS wy
  FROM tile, size WHERE x0 + 25 <= w AND y0 + 25 <= h),
walk(n, y, x, r, g, b) AS (SELECT CAST(0 AS BIGINT), CAST(y AS BIGINT), CAST(x AS BIGINT), CAST(r AS BIGINT), CAST(g AS BIGINT), CAST(b AS BIGINT) FROM raster UNION ALL
  SELECT n + 1, y, x, """ + ", ".join(f"CASE WHEN box THEN ((s{c} + m{c}) // 2 * a + {c} * (255 - a)) // 255 ELSE {c} END" for c in "rgb") + """ FROM (
    SELECT *, """ + ", ".join(f"CAST(floor(avg(CASE WHEN seen THEN s{c} END) OVER ()) AS BIGINT) AS m{c}" for c in "rgb") + """ FROM (
      SELECT *, """ + ", ".join(f"CASE WHEN box AND d < 2 THEN {v} WHEN box THEN o_{c} ELSE {c} END AS s{c}" for c, v in zip("rgb", (237, 28, 36))) + """, CASE WHEN d < 5 THEN 255 * (d + 1) // 6 ELSE 255 END AS a FROM (
        SELECT walk.n, walk.y, walk.x, walk.r, walk.g, walk.b, o.r AS o_r, o.g AS o_g, o.b AS o_b, x >= x0 AND x < x1 AND y >= y0 AND y < y1 AS box, x >= wx AND x < wx + 50 AND y >= wy AND y < wy + 50 AS seen,
          least(x - x0, y - y0, x1 - 1 - x, y1 - 1 - y) AS d FROM walk JOIN job ON job.nth = walk.n + 1 JOIN (SELECT y AS oy, x AS ox, r, g, b FROM raw_raster) o ON oy = y AND ox = x))))"""


@query("c12_river_walk", RGB, X.with_("raster", "raw_raster", "size", ctes=RIVER, body="SELECT y, x, r, g, b FROM walk WHERE n = (SELECT count(*) FROM job)"))
def c12(t):
    """Wet tiles are re-made in breadth-first order, each from what its window then shows."""
    canvas = save(X.raster(t), "canvas")
    wet = tiled(canvas).groupBy("col", "row").agg(F.count_if(C.is_blue()).alias("n")).where("n > 50")
    order = V.bfs_order(wet.select(F.lit(0).alias("region"), "col", "row"), "region")
    return V.river_walk(canvas, X.raw_raster(t), order, E.ColumnEditor(soften_in_context), X.TILE, 5, X.WIDTH, X.height(t))


#: One box after another on the canvas as it then is; each step carries the whole canvas.
RING_FILL = """ring AS (SELECT box_id, r, g, b FROM boxes JOIN raster ON x >= x0 - 6 AND x < x1 + 6 AND y >= y0 - 6 AND y < y1 + 6 AND NOT (x >= x0 AND x < x1 AND y >= y0 AND y < y1) AND NOT (b - r > 14 AND b - g > 8 AND b > 90)),
m AS (SELECT box_id, count(*) AS n, floor(median(r)) AS r, floor(median(g)) AS g, floor(median(b)) AS b FROM ring GROUP BY box_id)"""
STEP = """job AS (SELECT b.*, row_number() OVER (ORDER BY b.box_id) AS nth, CAST(CASE WHEN n > 50 THEN m.r ELSE 150 END AS BIGINT) AS fr, CAST(CASE WHEN n > 50 THEN m.g ELSE 148 END AS BIGINT) AS fg, CAST(CASE WHEN n > 50 THEN m.b ELSE 143 END AS BIGINT) AS fb,
  greatest(0, least(w - 30, (x0 + x1) // 2 - 15)) AS wx, greatest(0, least(h - 30, (y0 + y1) // 2 - 15)) AS wy FROM size, boxes b LEFT JOIN m USING (box_id)),
walk(n, y, x, r, g, b) AS (SELECT CAST(0 AS BIGINT), CAST(y AS BIGINT), CAST(x AS BIGINT), CAST(r AS BIGINT), CAST(g AS BIGINT), CAST(b AS BIGINT) FROM raster UNION ALL
  SELECT n + 1, y, x, """ + ", ".join(f"CASE WHEN box THEN ((s{c} + m{c}) // 2 * a + {c} * (255 - a)) // 255 ELSE {c} END" for c in "rgb") + """ FROM (
    SELECT *, """ + ", ".join(f"CAST(floor(avg(CASE WHEN seen THEN s{c} END) OVER ()) AS BIGINT) AS m{c}" for c in "rgb") + """ FROM (
      SELECT *, """ + ", ".join(f"CASE WHEN box AND d < 2 THEN {v} WHEN box THEN f{c} ELSE {c} END AS s{c}" for c, v in zip("rgb", (237, 28, 36))) + """, CASE WHEN d < 3 THEN 255 * (d + 1) // 4 ELSE 255 END AS a FROM (
        SELECT walk.*, fr, fg, fb, x >= x0 AND x < x1 AND y >= y0 AND y < y1 AS box, x >= wx AND x < wx + 30 AND y >= wy AND y < wy + 30 AS seen,
          least(x - x0, y - y0, x1 - 1 - x, y1 - 1 - y) AS d FROM walk JOIN job ON job.nth = walk.n + 1))))"""


@query(
    "c14_infill_regions", RGB,
    X.with_("raster", "size", ctes=BOXES + ",\n" + RING_FILL + ",\n" + STEP, body="SELECT y, x, r, g, b FROM walk WHERE n = (SELECT count(*) FROM boxes)"),
)
def c14(t):
    """Boxes are re-made in the order of their ids, each from what its window then shows."""
    return V.infill_regions(X.raster(t), boxes(t), E.ColumnEditor(soften_in_context), 30, 3, X.WIDTH, X.height(t), prefill=True, ring=6)


@query("c14_infill_regions_images", RGB, QUERIES["c14_infill_regions"].sql)
def c14_images(t):
    """As c14, with an image editor in Python on packed windows."""
    return V.infill_regions(X.raster(t), boxes(t), E.WindowEditor(E.PythonEditor(soften_image)), 30, 3, X.WIDTH, X.height(t), prefill=True, ring=6)


def _resize(cell):
    src = """tp AS (SELECT x // 25 AS col, y // 25 AS row, y % 25 AS y, x % 25 AS x, r, g, b FROM raster),
ts AS (SELECT col, row, max(x) + 1 AS w, max(y) + 1 AS h FROM tp GROUP BY ALL),
"""
    grow = f"g AS (SELECT col, row, w, h, q, unnest(range({cell})) AS p FROM (SELECT *, unnest(range({cell})) AS q FROM ts)),\n"
    if cell > X.TILE:
        body = f"SELECT z.col, z.row, z.q AS y, z.p AS x, tp.r, tp.g, tp.b FROM g z JOIN tp ON tp.col = z.col AND tp.row = z.row AND tp.x = z.p * w // {cell} AND tp.y = z.q * h // {cell}"
    else:
        body = f"SELECT col, row, y * {cell} // h AS y, x * {cell} // w AS x, sum(r) // count(*) AS r, sum(g) // count(*) AS g, sum(b) // count(*) AS b FROM tp JOIN ts USING (col, row) GROUP BY 1, 2, 3, 4"
        grow = ""
    from tessella.operators.neighborhood import resize_tiles

    query(f"e10_resize_tiles_{cell}", "col:l row:l y:l x:l r:l g:l b:l", X.with_("raster", ctes=src + grow, body=body))(
        lambda t: resize_tiles(tile_pixels(t), cell, ["col", "row", "w", "h"])
    )


for _cell in (40, 10):
    _resize(_cell)


def _sized(cell):
    inner = QUERIES[f"e10_resize_tiles_{cell}"].sql

    @query(f"h1_stitch_sized_{cell}", RGB, f"SELECT row * {cell} + y AS y, col * {cell} + x AS x, r, g, b FROM (\n{inner}\n) AS tile")
    def h1_sized(t):
        """The picture's tiles, narrower at the border, each brought to the cell."""
        tiles = tile_pixels(t)
        return M.stitch_sized(tiles, GR.grid_extent(tiles), cell)


for _cell in (40, 10):
    _sized(_cell)
