"""Checked queries: neighbourhood operators (E) and regions (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella import fixtures as X
from tessella.functions import color as C
from tessella.operators import neighborhood as N
from tessella.operators import regions as G
from tessella.operators import runs as R
from tessella.queries import sqlgen as S
from tessella.queries.registry import query

BLOCK = 128  # small, so that larger test canvases span several blocks
BLUE = "blue AS (SELECT y, x FROM raster WHERE b - r > 14 AND b - g > 8 AND b > 90),\n"
GREY = "r + g + b"


def blue_runs(t):
    return R.from_pixels(X.raster(t).where(C.is_blue()), block=BLOCK)


def noise_runs(t):
    return R.from_pixels(X.noise_mask(t), block=BLOCK)


def frame(t):
    h = X.height(t)
    return R.universe(t.spark, X.WIDTH, h, BLOCK), X.WIDTH, h


def as_runs(df):
    return R.maximal(df.select("y", "bx", "x0", "x1"), block=BLOCK)


RUN_COLS = "y:l x0:l x1:l"


def runs_sql(ctes: str, mask: str, base=("raster", "size")):
    return X.with_(*base, ctes=ctes + S.runs("out_runs", mask), body="SELECT y, x0, x1 FROM out_runs")


BOX = "y:l x:l s:l s2:l"


def _box(k):
    def fn(t):
        s = F.col("r") + F.col("g") + F.col("b")
        px = X.raster(t).withColumn("s", s.cast("long")).withColumn("s2", (s * s).cast("long"))
        return N.box_sum(px, ["s", "s2"], k, X.WIDTH, X.height(t), block=BLOCK)

    sql = X.with_(
        "raster", "size",
        ctes=S.box("bx", "raster", k, {"s": f"p.r + p.g + p.b", "s2": "(p.r + p.g + p.b) * (p.r + p.g + p.b)"}),
        body="SELECT * FROM bx",
    )
    return fn, sql


for _k in (7, 9, 25, 10):
    _fn, _sql = _box(_k)
    query(f"e1_box_mean_{_k}", BOX, _sql)(_fn)


def smooth_sql(k, limit, src="raster"):
    s = "p.r + p.g + p.b"
    return S.box("bx", src, k, {"s1": s, "s2": f"({s}) * ({s})"}) + (
        f"flag AS (SELECT p.y, p.x, p.r, p.g, p.b, b.s2 * {k * k} - b.s1 * b.s1 AS vkey,"
        f" b.s2 * {k * k} - b.s1 * b.s1 < {k**4 * 9 * limit * limit} AS smooth"
        f" FROM {src} p JOIN bx b ON b.y = p.y AND b.x = p.x),\n"
    )


@query(
    "e2_local_std", "y:l x:l vkey:l smooth:b",
    X.with_("raw_raster", "size", ctes=smooth_sql(9, 60, "raw_raster"), body="SELECT y, x, vkey, smooth FROM flag"),
)
def e2(t):
    v = N.variance_key(X.raw_raster(t), 9, X.WIDTH, X.height(t), block=BLOCK)
    return v.withColumn("smooth", N.std_below(60, 9))


@query("f0_mask_to_runs", RUN_COLS, runs_sql(BLUE, "blue"))
def f0(t):
    return as_runs(blue_runs(t))


@query("f0_runs_to_mask", "y:l x:l", X.with_("raster", ctes=BLUE, body="SELECT * FROM blue"))
def f0b(t):
    return R.to_pixels(blue_runs(t))


def _dilate(n):
    def fn(t):
        _, w, h = frame(t)
        return as_runs(R.dilate(blue_runs(t), n, w, h, block=BLOCK))

    return fn


for _n in (1, 2, 18):
    query(f"e3_dilate_{_n}", RUN_COLS, runs_sql(BLUE + S.dilate("m", "blue", _n), "m"))(_dilate(_n))


@query("e4_complement", RUN_COLS, runs_sql(BLUE + S.canvas() + S.minus("m", "canvas", "blue"), "m"))
def e4c(t):
    space, _, _ = frame(t)
    return as_runs(R.complement(blue_runs(t), space))


@query("e4_erode", RUN_COLS, runs_sql(BLUE + S.erode("m", "blue", 2), "m"))
def e4(t):
    space, w, h = frame(t)
    return as_runs(R.erode(blue_runs(t), 2, space, w, h, block=BLOCK))


@query("e5_open", RUN_COLS, runs_sql(BLUE + S.opening("m", "blue", 6), "m"))
def e5(t):
    space, w, h = frame(t)
    return as_runs(R.opening(blue_runs(t), 6, space, w, h, block=BLOCK))


@query(
    "e5_open_22", RUN_COLS,
    runs_sql(BLUE + S.canvas() + S.minus("land", "canvas", "blue") + S.opening("m", "land", 22), "m"),
)
def e5b(t):
    space, w, h = frame(t)
    land = R.complement(blue_runs(t), space)
    return as_runs(R.opening(land, 22, space, w, h, block=BLOCK))


def _close(n):
    def fn(t):
        space, w, h = frame(t)
        return as_runs(R.closing(blue_runs(t), n, space, w, h, block=BLOCK))

    return fn


for _n in (2, 3, 4, 16, 22):
    query(f"e6_close_{_n}", RUN_COLS, runs_sql(BLUE + S.closing("m", "blue", _n), "m"))(_close(_n))


HOLES = S.label("bg", "land") + (
    "edge AS (SELECT DISTINCT label FROM bg, size WHERE y = 0 OR y = h - 1 OR x0 = 0 OR x1 = w - 1),\n"
    "inner_runs AS (SELECT * FROM bg WHERE label NOT IN (SELECT label FROM edge)),\n"
) + S.pixels("holes", "inner_runs")


@query(
    "e7_fill_holes", RUN_COLS,
    runs_sql(S.canvas() + S.minus("land", "canvas", "noise_mask") + HOLES + S.either("m", "noise_mask", "holes"), "m", ("noise_mask", "size")),
)
def e7(t):
    space, w, h = frame(t)
    return as_runs(G.fill_holes(noise_runs(t), space, w, h, BLOCK))


@query(
    "e8_thin_structures", RUN_COLS,
    runs_sql(BLUE + S.opening("o", "blue", 6) + S.minus("thin", "blue", "o") + S.dilate("m", "thin", 1), "m"),
)
def e8(t):
    space, w, h = frame(t)
    return as_runs(R.thin_structures(blue_runs(t), 6, space, w, h, grow=1, block=BLOCK))


def _feather(sigma):
    def fn(t):
        px = X.raster(t).withColumn("m", F.when(C.is_blue(), 255).otherwise(0).cast("long"))
        k = sum(N.gaussian_weights(sigma))
        return N.gaussian_sum(px, "m", sigma, X.WIDTH, X.height(t), block=BLOCK).select(
            "y", "x", F.floor(F.col("m") / (k * k)).alias("alpha")
        )

    wt = N.gaussian_weights(sigma)
    sql = X.with_(
        "raster", "size",
        ctes=S.blur("bl", "raster", wt, "CASE WHEN p.b - p.r > 14 AND p.b - p.g > 8 AND p.b > 90 THEN 255 ELSE 0 END"),
        body=f"SELECT y, x, v // {sum(wt) ** 2} AS alpha FROM bl",
    )
    return fn, sql


for _s in (2, 3, 4):
    _fn, _sql = _feather(_s)
    query(f"e9_gaussian_feather_{_s}", "y:l x:l alpha:l", _sql)(_fn)


@query("e10_stride", "y:l x:l r:l g:l b:l", X.with_("raster", body="SELECT y // 3 AS y, x // 3 AS x, r, g, b FROM raster WHERE y % 3 = 0 AND x % 3 = 0"))
def e10(t):
    return N.stride(X.raster(t), 3)


@query(
    "e10_upscale_mask", RUN_COLS,
    X.with_("raster", ctes=BLUE + S.runs("q", "blue"), body="SELECT unnest(range(y * 3, y * 3 + 3)) AS y, x0 * 3 AS x0, x1 * 3 + 2 AS x1 FROM q"),
)
def e10u(t):
    return as_runs(R.merge(N.upscale_runs(blue_runs(t), 3), block=BLOCK))


@query(
    "e10_thumbnail", "y:l x:l r:l g:l b:l",
    X.with_("raster", body="SELECT y // 4 AS y, x // 4 AS x, sum(r) // count(*) AS r, sum(g) // count(*) AS g, sum(b) // count(*) AS b FROM raster GROUP BY 1, 2"),
)
def e10t(t):
    return N.block_mean(X.raster(t), 4)


def _algebra(name, op, sqlop):
    def fn(t):
        return as_runs(op(blue_runs(t), noise_runs(t)))

    query(f"e11_mask_{name}", RUN_COLS, runs_sql(BLUE + sqlop("m", "blue", "noise_mask"), "m", ("raster", "noise_mask")))(fn)


_algebra("and", R.intersect, S.both)
_algebra("or", R.union, S.either)
_algebra("and_not", R.subtract, S.minus)

LABELS = S.label("lab", "noise_mask")
SIZES = "sizes AS (SELECT label, CAST(sum(x1 - x0 + 1) AS BIGINT) AS px FROM lab GROUP BY label),\n"


@query(
    "f1_label", "y:l x:l label:l",
    X.with_("noise_mask", ctes=LABELS, body="SELECT y, unnest(range(x0, x1 + 1)) AS x, label FROM lab"),
)
def f1(t):
    runs = R.from_pixels(X.noise_mask(t), block=64)  # many blocks, so that regions join across borders
    return R.to_pixels(G.label(runs, block=64).labelled())


@query("f2_region_sizes", "label:l px:l", X.with_("noise_mask", ctes=LABELS + SIZES, body="SELECT * FROM sizes"))
def f2(t):
    return G.label(noise_runs(t), block=BLOCK).sizes()


@query(
    "f3_keep_large", RUN_COLS,
    runs_sql(LABELS + SIZES + "big AS (SELECT * FROM lab WHERE label IN (SELECT s.label FROM sizes s, size WHERE px > w * h * 0.003)),\n" + S.pixels("m", "big"), "m", ("noise_mask", "size")),
)
def f3(t):
    _, w, h = frame(t)
    return as_runs(G.keep_large(G.label(noise_runs(t), block=BLOCK), F.lit(w * h * 0.003)))


@query(
    "f4_region_boxes", "label:l px:l y0:l y1:l x0:l x1:l",
    X.with_(
        "noise_mask", "size", ctes=LABELS,
        body="SELECT label, sum(lab.x1 - lab.x0 + 1) AS px, greatest(min(y) - 22, 0) AS y0, least(max(y) + 23, any_value(h)) AS y1,"
        " greatest(min(x0) - 22, 0) AS x0, least(max(x1) + 23, any_value(w)) AS x1 FROM lab, size GROUP BY label",
    ),
)
def f4(t):
    _, w, h = frame(t)
    return G.boxes(G.label(noise_runs(t), block=BLOCK), 22, w, h)


@query(
    "f7_centroids", "label:l px:l cx:d cy:d",
    X.with_(
        "noise_mask", ctes=LABELS,
        body="SELECT label, sum(x1 - x0 + 1) AS px, CAST(sum((x0 + x1) * (x1 - x0 + 1)) AS DOUBLE) / 2 / sum(x1 - x0 + 1) AS cx,"
        " CAST(sum(y * (x1 - x0 + 1)) AS DOUBLE) / sum(x1 - x0 + 1) AS cy FROM lab GROUP BY label",
    ),
)
def f7(t):
    return G.centroids(G.label(noise_runs(t), block=BLOCK))


@query(
    "f9_mask_share", "col:l row:l px:l water:l pct:d",
    X.with_(
        "raster",
        ctes=BLUE + S.label("lab", "blue") + SIZES
        + "big AS (SELECT * FROM lab WHERE label IN (SELECT label FROM sizes WHERE px > 50)),\n" + S.pixels("m", "big")
        + "wet AS (SELECT x // 25 AS col, y // 25 AS row, count(*) AS water FROM m GROUP BY 1, 2),\n"
        + "area AS (SELECT x // 25 AS col, y // 25 AS row, count(*) AS px FROM raster GROUP BY 1, 2),\n",
        body="SELECT a.col, a.row, px, coalesce(water, 0) AS water, round(CAST(coalesce(water, 0) AS DOUBLE) * 100 / px, 4) AS pct"
        " FROM area a LEFT JOIN wet w ON a.col = w.col AND a.row = w.row",
    ),
)
def f9(t):
    """Blue pixels -> runs -> regions -> real water bodies -> their share of every tile."""
    tile = lambda c: F.floor(F.col(c) / X.TILE)
    big = G.keep_large(G.label(blue_runs(t), block=BLOCK), 50)
    wet = R.to_pixels(big).groupBy(tile("x").alias("col"), tile("y").alias("row")).agg(F.count("*").alias("water"))
    area = X.raster(t).groupBy(tile("x").alias("col"), tile("y").alias("row")).agg(F.count("*").alias("px"))
    wet0 = F.coalesce(F.col("water"), F.lit(0))
    return area.join(wet, ["col", "row"], "left").select(
        "col", "row", "px", wet0.alias("water"), F.round(wet0.cast("double") * 100 / F.col("px"), 4).alias("pct")
    )
