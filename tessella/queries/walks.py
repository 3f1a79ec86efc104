"""Checked queries: walk (C), samples (J), run statistics (K1-K3, K5), editor and table functions (L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella import fixtures as X
from tessella.functions import color as C
from tessella.functions import text as T
from tessella.operators import monitor as O
from tessella.operators import samples as J
from tessella.plans import editor as E
from tessella.plans import river as V
from tessella.plans import udtf
from tessella.plans import walk as K
from tessella.queries.pixels import tiled
from tessella.queries.registry import QUERIES, query
from tessella.queries.tiles import tiles
from tessella.session import save
from tessella.sources import sinks
from tessella.sources import tiles as ST

# The plan of a 5 x 5 walk, written as the serial order of calls.
PLAN = """walks AS (SELECT walk, (max(qx) + 1) // 2 AS nc, (max(qy) + 1) // 2 AS nr FROM quads GROUP BY walk),
raw_calls AS (
  SELECT walk, 0 AS s, 0 AS o, 0 AS i, 'seed' AS kind, 0 AS qx, 0 AS qy FROM walks
  UNION ALL SELECT walk, 1, c, i, 'half_h', 2 * c + i, 0 FROM (SELECT walk, unnest(range(1, nc)) AS c FROM walks), range(2) AS t(i)
  UNION ALL SELECT walk, 2, r, i, 'half_v', 0, 2 * r + i FROM (SELECT walk, unnest(range(1, nr)) AS r FROM walks), range(2) AS t(i)
  UNION ALL SELECT walk, 3, r * 1000 + c, i, 'br', 2 * c + i % 2, 2 * r + i // 2 FROM (SELECT walk, r, unnest(range(1, nc)) AS c FROM
    (SELECT walk, nc, unnest(range(1, nr)) AS r FROM walks)), range(4) AS t(i)),
calls AS (SELECT *, row_number() OVER (PARTITION BY walk ORDER BY s, o, i) - 1 AS call_id FROM raw_calls),
prod AS (
  SELECT walk, call_id, qx + dx AS qx, qy + dy AS qy FROM calls, range(2) AS a(dx), range(2) AS b(dy) WHERE kind = 'seed'
  UNION ALL SELECT walk, call_id, qx, dy FROM calls, range(2) AS b(dy) WHERE kind = 'half_h'
  UNION ALL SELECT walk, call_id, dx, qy FROM calls, range(2) AS b(dx) WHERE kind = 'half_v'
  UNION ALL SELECT walk, call_id, qx, qy FROM calls WHERE kind = 'br'),
deps AS (
  SELECT walk, call_id, qx - 1 AS qx, dy AS qy FROM calls, range(2) AS b(dy) WHERE kind = 'half_h'
  UNION ALL SELECT walk, call_id, dx, qy - 1 FROM calls, range(2) AS b(dx) WHERE kind = 'half_v'
  UNION ALL SELECT walk, call_id, qx - dx, qy - dy FROM calls, (VALUES (1, 1), (0, 1), (1, 0)) AS v(dx, dy) WHERE kind = 'br'),
edges AS (SELECT DISTINCT d.walk, p.call_id AS src, d.call_id AS dst FROM deps d JOIN prod p USING (walk, qx, qy)),
waves(walk, call_id, wave) AS (
  SELECT walk, call_id, 0 FROM calls WHERE kind = 'seed'
  UNION SELECT e.walk, e.dst, w.wave + 1 FROM waves w JOIN edges e ON e.walk = w.walk AND e.src = w.call_id),
level AS (SELECT walk, call_id, max(wave) AS wave FROM waves GROUP BY walk, call_id)"""


def calls(t):
    return K.plan_calls(X.walks(t))


def sized_quads(t):
    """Quadrants with the size of their walk."""
    q = X.quads(t).select("walk", "qx", "qy", F.col("raw").cast("long").alias("payload"))
    return q.join(X.walks(t), "walk")


@query("c1_split_quads", "seq:l qx:l qy:l", X.with_("tiles", body="SELECT seq, col * 2 + dx AS qx, row * 2 + dy AS qy FROM tiles, range(2) AS a(dx), range(2) AS b(dy)"))
def c1(t):
    return K.split_quads(tiles(t))


@query("c1_split_pixels", "qx:l qy:l n:l sr:l", X.with_("raster", body="SELECT x // 12 AS qx, y // 12 AS qy, count(*) AS n, sum(r * (x % 12 + 1)) AS sr FROM raster GROUP BY 1, 2"))
def c1p(t):
    px = X.raster(t).select(F.floor(F.col("x") / 12).alias("qx"), F.floor(F.col("y") / 12).alias("qy"), (F.col("x") % 12).alias("x"), "r")
    return px.groupBy("qx", "qy").agg(F.count("*").alias("n"), F.sum(F.col("r") * (F.col("x") + 1)).alias("sr"))


@query(
    "c2_plan_calls", "walk:l call_id:l kind:s ndeps:l nprod:l deps:s prod:s",
    X.with_(
        "quads", ctes=PLAN,
        body="SELECT c.walk, c.call_id, kind, coalesce(nd, 0) AS ndeps, np AS nprod, coalesce(d, '') AS deps, p AS prod FROM calls c"
        " LEFT JOIN (SELECT walk, call_id, count(*) AS nd, string_agg(qx || ':' || qy, ' ' ORDER BY qx, qy) AS d FROM deps GROUP BY ALL) USING (walk, call_id)"
        " JOIN (SELECT walk, call_id, count(*) AS np, string_agg(qx || ':' || qy, ' ' ORDER BY qx, qy) AS p FROM prod GROUP BY ALL) USING (walk, call_id)",
    ),
)
def c2(t):
    show = lambda c: F.array_join(F.transform(F.array_sort(c), lambda q: F.concat_ws(":", q.qx, q.qy)), " ")
    return calls(t).select(
        "walk", "call_id", "kind", F.size("deps").alias("ndeps"), F.size("prod").alias("nprod"), show("deps").alias("deps"), show("prod").alias("prod")
    )


@query("c3_dependency_edges", "walk:l src:l dst:l", X.with_("quads", ctes=PLAN, body="SELECT * FROM edges"))
def c3(t):
    return K.dependency_edges(calls(t))


@query(
    "c4_in_degree", "walk:l call_id:l indeg:l ready:b",
    X.with_("quads", ctes=PLAN, body="SELECT c.walk, c.call_id, count(e.src) AS indeg, count(e.src) = 0 AS ready FROM calls c LEFT JOIN edges e ON e.walk = c.walk AND e.dst = c.call_id GROUP BY 1, 2"),
)
def c4(t):
    return K.in_degree(calls(t)).withColumn("ready", F.col("indeg") == 0)


@query("c5_wave_level", "walk:l call_id:l wave:l", X.with_("quads", ctes=PLAN, body="SELECT * FROM level"))
def c5(t):
    return calls(t)


@query(
    "c6_context_for_call", "walk:l call_id:l kind:s tl:l tr:l bl:l br:l",
    X.with_(
        "quads", ctes=PLAN + ",\norig AS (SELECT walk, call_id, kind, CASE WHEN kind IN ('half_h', 'br') THEN qx - 1 ELSE qx END AS ox, CASE WHEN kind IN ('half_v', 'br') THEN qy - 1 ELSE qy END AS oy FROM calls),\n"
        "w AS (SELECT o.*, q.qx - ox AS dx, q.qy - oy AS dy, CASE WHEN p.qx IS NULL THEN 1000 ELSE 0 END + raw AS v FROM orig o JOIN quads q ON q.walk = o.walk AND q.qx BETWEEN ox AND ox + 1 AND q.qy BETWEEN oy AND oy + 1"
        " LEFT JOIN prod p ON p.walk = o.walk AND p.call_id = o.call_id AND p.qx = q.qx AND p.qy = q.qy)",
        body="SELECT walk, call_id, kind, max(v) FILTER (dx = 0 AND dy = 0) AS tl, max(v) FILTER (dx = 1 AND dy = 0) AS tr, max(v) FILTER (dx = 0 AND dy = 1) AS bl, max(v) FILTER (dx = 1 AND dy = 1) AS br FROM w GROUP BY walk, call_id, kind",
    ),
)
def c6(t):
    raw = sized_quads(t)
    return K.windows(raw, raw.withColumn("payload", F.col("payload") + 1000))


@query("c7_call_seed", "walk:l call_id:l seed:l tile_seed:l", X.with_("quads", ctes=PLAN, body="SELECT walk, call_id, 100003 + call_id * 7919 AS seed, 100 + call_id * 7919 AS tile_seed FROM calls"))
def c7(t):
    return calls(t).select("walk", "call_id", K.call_seed(F.col("call_id")).alias("seed"), K.tile_seed(F.col("call_id")).alias("tile_seed"))


def linear_editor():
    """Every new quadrant adds what its finished neighbours hold; the whole walk then has a closed form."""
    kind = F.col("kind")
    tl, tr, bl, br = (F.col(c) for c in ("tl", "tr", "bl", "br"))
    return {
        "tr": F.when(kind == "half_h", tr + tl).otherwise(tr),
        "bl": F.when(kind == "half_v", bl + tl).otherwise(bl),
        "br": F.when(kind == "half_h", br + bl).when(kind == "half_v", br + tr).when(kind == "br", br + bl + tr - tl).otherwise(br),
    }


@query(
    "c8_run_walk", "walk:l qx:l qy:l payload:l",
    X.with_(
        "quads",
        ctes="top AS (SELECT q.walk, q.qx, q.qy, CASE WHEN q.qx < 2 THEN q.raw ELSE (SELECT sum(p.raw) FROM quads p WHERE p.walk = q.walk AND p.qy = q.qy AND p.qx BETWEEN 1 AND q.qx) END AS g FROM quads q WHERE q.qy < 2),\n"
        "lft AS (SELECT q.walk, q.qx, q.qy, CASE WHEN q.qy < 2 THEN q.raw ELSE (SELECT sum(p.raw) FROM quads p WHERE p.walk = q.walk AND p.qx = q.qx AND p.qy BETWEEN 1 AND q.qy) END AS g FROM quads q WHERE q.qx < 2)",
        body="SELECT walk, qx, qy, g AS payload FROM top UNION ALL SELECT walk, qx, qy, g FROM lft WHERE qy >= 2 UNION ALL"
        " SELECT q.walk, q.qx, q.qy, a.g + b.g - c.raw + (SELECT sum(p.raw) FROM quads p WHERE p.walk = q.walk AND p.qx BETWEEN 2 AND q.qx AND p.qy BETWEEN 2 AND q.qy)"
        " FROM quads q JOIN top a ON a.walk = q.walk AND a.qx = q.qx AND a.qy = 1 JOIN lft b ON b.walk = q.walk AND b.qx = 1 AND b.qy = q.qy JOIN quads c ON c.walk = q.walk AND c.qx = 1 AND c.qy = 1 WHERE q.qx >= 2 AND q.qy >= 2",
    ),
)
def c8(t):
    return K.run_walk(sized_quads(t), E.ColumnEditor(linear_editor))


def linear_image(row, model):
    """The rule of ``linear_editor`` for an image editor: pixels are whole numbers of three bytes, and sums stay within them."""
    a, b, c, d = (int.from_bytes(row["payload"][i : i + 3], "little") for i in (0, 3, 6, 9))
    if row["kind"] == "half_h":
        b, d = b + a, d + c
    elif row["kind"] == "half_v":
        c, d = c + a, d + b
    elif row["kind"] == "br":
        d = d + c + b - a
    return b"".join((v % (1 << 24)).to_bytes(3, "little") for v in (a, b, c, d))


_WALK = QUERIES["c8_run_walk"]


@query("c8_run_walk_images", "walk:l qx:l qy:l payload:l", f"SELECT walk, qx, qy, payload % 16777216 AS payload FROM (\n{_WALK.sql}\n) AS w")
def c8_images(t):
    raw = sized_quads(t).withColumn("payload", F.unhex(F.lpad(F.hex("payload"), 6, "0")))
    raw = raw.withColumn("payload", F.unhex(F.concat(*[F.hex(F.expr(f"substring(payload, {i}, 1)")) for i in (3, 2, 1)])))
    made = K.run_walk(raw, E.QuadEditor(E.PythonEditor(linear_image), 1, 1))
    return made.withColumn("payload", sum(F.conv(F.hex(F.expr(f"substring(payload, {i + 1}, 1)")), 16, 10).cast("long") * 256**i for i in range(3)))


@query("c9_assemble_quads", "y:l x:l r:l", X.with_("raster", body="SELECT y, x, r FROM raster"))
def c9(t):
    q = X.raster(t).select(F.floor(F.col("x") / 12).alias("qx"), F.floor(F.col("y") / 12).alias("qy"), (F.col("y") % 12).alias("y"), (F.col("x") % 12).alias("x"), "r")
    return K.assemble_quads(q, 12)


def packed(t):
    p = ST.pixels_to_tiles(X.raster(t), [], X.TILE)
    return p.select("col", "row", F.col("image.data").alias("payload"))


def invert(row, model):
    import numpy as np

    return (255 - np.frombuffer(row["payload"], np.uint8)).tobytes()


def invert_dark(row, model):
    """Fails on bright tiles and gives nothing for some dark ones."""
    import numpy as np

    a = np.frombuffer(row["payload"], np.uint8)
    s = int(a.astype(np.int64).sum())
    if s > 123 * a.size:
        raise ValueError("too bright")
    return None if s < 122 * a.size else (255 - a).tobytes()


HEX = "string_agg(printf('%02X%02X%02X', {e}), '' ORDER BY y, x)"
INV = HEX.format(e="(255 - b)::INT, (255 - g)::INT, (255 - r)::INT")
OWN = HEX.format(e="b::INT, g::INT, r::INT")


@query("c10_convert_tiles", "col:l row:l hash:s status:s", X.with_("raster", body=f"SELECT x // 25 AS col, y // 25 AS row, md5({INV}) AS hash, 'ok' AS status FROM raster GROUP BY ALL"))
def c10(t):
    out = E.convert_tiles(packed(t), E.PythonEditor(invert))
    return out.select("col", "row", F.md5(F.hex("payload").cast("binary")).alias("hash"), "status")


@query(
    "l2_edit_status", "col:l row:l edited:b status:s hash:s",
    X.with_(
        "raster",
        ctes=f"s AS (SELECT x // 25 AS col, y // 25 AS row, sum(r + g + b) AS s, count(*) * 3 AS n, {INV} AS inv, {OWN} AS own FROM raster GROUP BY ALL)",
        body="SELECT col, row, s BETWEEN 122 * n AND 123 * n AS edited, CASE WHEN s > 123 * n THEN 'fail: too bright' WHEN s < 122 * n THEN 'no image' ELSE 'ok' END AS status,"
        " md5(CASE WHEN s BETWEEN 122 * n AND 123 * n THEN inv ELSE own END) AS hash FROM s",
    ),
)
def l2(t):
    base = packed(t)
    out = save(E.convert_tiles(base, E.PythonEditor(invert_dark)), "edited")
    kept = E.or_keep(base, out, ["col", "row"]).join(out.select("col", "row", "status"), ["col", "row"])
    return kept.select("col", "row", "edited", "status", F.md5(F.hex("payload").cast("binary")).alias("hash"))


@query(
    "l1_editor_contract", "walk:l call_id:l seed:l prompt:s sum:l",
    X.with_(
        "quads", ctes=PLAN,
        body="SELECT c.walk, call_id, 100003 + call_id * 7919 AS seed, CASE WHEN kind = 'seed' THEN 'full S' ELSE 'fill S' END AS prompt, sum(raw) * 2 AS sum FROM calls c JOIN prod p USING (walk, call_id) JOIN quads q ON q.walk = c.walk AND q.qx = p.qx AND q.qy = p.qy GROUP BY ALL",
    ),
)
def l1(t):
    """A request per call, with prompt and seed; the editor doubles the bytes that it gets."""
    made = calls(t).select("walk", "call_id", "kind", F.explode("prod").alias("q")).select("walk", "call_id", "kind", "q.*")
    req = made.join(X.quads(t), ["walk", "qx", "qy"]).groupBy("walk", "call_id", "kind").agg(F.sum("raw").cast("string").cast("binary").alias("payload"))
    req = req.select(
        "walk", "call_id", K.call_seed(F.col("call_id")).alias("seed"),
        T.prompt_for(F.col("kind"), "full {trigger}", "fill {trigger}", "S").alias("prompt"), "payload",
    )
    out = E.PythonEditor(lambda row, m: str(2 * int(row["payload"])).encode()).apply(req)
    return out.where("status = 'ok'").withColumn("sum", F.col("payload").cast("string"))


@query(
    "c11_bfs_order", "region:l col:l row:l level:l idx:l",
    X.with_(
        "region_tiles",
        ctes="""tt AS (SELECT *, col * 100 + row AS v FROM region_tiles),
ee AS (SELECT a.region, a.v AS a, b.v AS b, d.k FROM tt a, (VALUES (1, 0, '0'), (-1, 0, '1'), (0, 1, '2'), (0, -1, '3')) AS d(dx, dy, k), tt b WHERE b.region = a.region AND b.col = a.col + dx AND b.row = a.row + dy),
rr(region, root, v) AS (SELECT region, v, v FROM tt UNION SELECT r.region, r.root, e.b FROM rr r JOIN ee e ON e.region = r.region AND e.a = r.v WHERE e.b > r.root),
cc AS (SELECT region, v, min(root) AS comp FROM rr GROUP BY region, v),
dd(region, v, d) AS (SELECT region, v, 0 FROM cc WHERE v = comp UNION SELECT w.region, e.b, w.d + 1 FROM dd w JOIN ee e ON e.region = w.region AND e.a = w.v WHERE w.d < 70),
lv AS (SELECT region, v, min(d) AS level FROM dd GROUP BY region, v),
pp(region, v, level, path) AS (SELECT region, v, level, '' FROM lv WHERE level = 0
  UNION ALL SELECT p.region, e.b, p.level + 1, min(p.path || e.k) FROM pp p JOIN ee e ON e.region = p.region AND e.a = p.v JOIN lv ON lv.region = e.region AND lv.v = e.b AND lv.level = p.level + 1 GROUP BY p.region, e.b, p.level + 1)""",
        body="SELECT region, v // 100 AS col, v % 100 AS row, level, row_number() OVER (PARTITION BY region ORDER BY comp, level, path) - 1 AS idx FROM pp JOIN cc USING (region, v)",
    ),
)
def c11(t):
    return V.bfs_order(X.region_tiles(t), "region")


@query("c17_prompt_for", "walk:l call_id:l prompt:s", X.with_("quads", ctes=PLAN, body="SELECT walk, call_id, CASE WHEN kind = 'seed' THEN 'Convert to S' ELSE 'Fill in S' END || CASE WHEN call_id = 0 THEN '' ELSE ' call ' || call_id END AS prompt FROM calls"))
def c17(t):
    hint = F.when(F.col("call_id") == 0, F.lit("")).otherwise(F.concat(F.lit("call "), F.col("call_id")))
    return calls(t).withColumn("prompt", T.prompt_for(F.col("kind"), "Convert to {trigger}", "Fill in {trigger}", "S", hint))


@query("l3_plan_walk", "walk:l kind:s qx:l qy:l quads:l", X.with_("quads", ctes=PLAN, body="SELECT c.walk, kind, c.qx, c.qy, count(*) AS quads FROM calls c JOIN prod p USING (walk, call_id) GROUP BY ALL"))
def l3(t):
    udtf.register(t.spark)
    rows = X.walks(t).select("walk", "nc", "nr", F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("r")).repartition("walk", "r")
    return t.spark.sql("SELECT w.walk, p.* FROM {rows} w, LATERAL plan_walk_row(w.nc, w.nr, w.r) p", rows=rows)


@query("l4_parse_rgb", "id:l r:l g:l b:l", "SELECT o_orderkey AS id, o_custkey % 256 AS r, o_orderkey % 256 AS g, 7 AS b FROM orders")
def l4(t):
    o = t.orders.selectExpr("o_orderkey id", "concat(o_custkey % 256, ',', o_orderkey % 256, ', 7') s")
    v = o.select("id", T.parse_rgb(F.col("s")).alias("v"))
    return v.select("id", F.col("v")[0].alias("r"), F.col("v")[1].alias("g"), F.col("v")[2].alias("b"))


CAPTIONED = "lang <> 'de'"


@query("j1_pair_samples", "stem:s doc_id:l chars:l", X.with_("samples", body=f"SELECT stem, doc_id, length(text) AS chars FROM samples WHERE labelled AND {CAPTIONED}"))
def j1(t):
    c, g, cap = X.samples(t)
    return J.pair_samples(c, g, cap).select("stem", "control.doc_id", F.length("caption.caption").alias("chars"))


@query("j1_pairing_report", "has_control:l has_target:l has_caption:l n:l", X.with_("samples", body=f"SELECT 1 AS has_control, labelled::INT AS has_target, ({CAPTIONED})::INT AS has_caption, count(*) AS n FROM samples GROUP BY ALL"))
def j1r(t):
    return J.pairing_report(*X.samples(t)).groupBy("has_control", "has_target", "has_caption").agg(F.count("*").alias("n"))


@query(
    "j2_sample_variant", "col:l row:l stem:s is_full:b n:l",
    X.with_(
        "samples", body="SELECT doc_id % 17 AS col, doc_id % 26 AS row, arg_min(stem, (CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END, doc_id % 3, stem)) AS stem, count(*) FILTER (doc_id % 3 = 0) > 0 AS is_full, count(*) AS n FROM samples GROUP BY 1, 2",
    ),
)
def j2(t):
    return J.preferred_sample(J.sample_variant(X.samples(t)[0]), ["col", "row"])


@query(
    "j3_infill_template", "col:l row:l y:l x:l c_r:l c_g:l c_b:l t_r:l t_g:l t_b:l",
    X.with_(
        "raster", "raw_raster",
        ctes="j AS (SELECT p.x // 25 AS col, p.y // 25 AS row, p.y % 25 AS y, p.x % 25 AS x, p.r AS t_r, p.g AS t_g, p.b AS t_b, q.r AS w_r, q.g AS w_g, q.b AS w_b FROM raster p JOIN raw_raster q ON q.y = p.y AND q.x = p.x),\n"
        "k AS (SELECT *, x BETWEEN 5 AND 19 AND y BETWEEN 3 AND 16 AS box, x BETWEEN 7 AND 17 AND y BETWEEN 5 AND 14 AS core FROM j)",
        body="SELECT col, row, y, x, " + ", ".join(f"CASE WHEN box AND NOT core THEN {v} WHEN box THEN w_{c} ELSE t_{c} END AS c_{c}" for c, v in zip("rgb", (237, 28, 36))) + ", t_r, t_g, t_b FROM k",
    ),
)
def j3(t):
    def cut(df):
        return tiled(df).select("col", "row", (F.col("y") % X.TILE).alias("y"), (F.col("x") % X.TILE).alias("x"), "r", "g", "b")

    return J.infill_template(cut(X.raw_raster(t)), cut(X.raster(t)), (5, 3, 20, 17))


@query("j4_caption_dropout", "doc_id:l caption:s", "SELECT doc_id, CASE WHEN (doc_id * 2654435761 + 40503) % 4294967296 % 10000 < 500 THEN '' ELSE text END AS caption FROM documents")
def j4(t):
    return J.caption_dropout(t.documents.withColumnRenamed("text", "caption"), 0.05, "doc_id").select("doc_id", "caption")


@query("j5_resolution_buckets", "stem:s resolution:l", X.with_("samples", body="SELECT stem, unnest([512, 768, 1024]) AS resolution FROM samples"))
def j5(t):
    return J.resolution_buckets(X.samples(t)[0], (512, 768, 1024))


@query(
    "j7_compare_runs", "col:l row:l n_a:l n_b:l mad:d",
    X.with_(
        "raster", "raw_raster",
        ctes="a AS (SELECT x // 25 AS col, y // 25 AS row, y, x, r, g, b FROM raster WHERE x < 100), b AS (SELECT x // 25 AS col, y // 25 AS row, y, x, r, g, b FROM raw_raster WHERE x >= 25),\n"
        "j AS (SELECT coalesce(a.col, b.col) AS col, coalesce(a.row, b.row) AS row, a.r IS NOT NULL AS ia, b.r IS NOT NULL AS ib, abs(a.r - b.r) + abs(a.g - b.g) + abs(a.b - b.b) AS df FROM a FULL JOIN b ON a.y = b.y AND a.x = b.x)",
        body="SELECT col, row, count(*) FILTER (ia) AS n_a, count(*) FILTER (ib) AS n_b, round(CAST(sum(df) AS DOUBLE) / (count(*) FILTER (ia AND ib) * CAST(3 AS DOUBLE)), 4) AS mad FROM j GROUP BY col, row",
    ),
)
def j7(t):
    """Each run lacks one column of tiles that the other has."""
    return J.compare_runs(tiled(X.raster(t)).where("col < 4"), tiled(X.raw_raster(t)).where("col >= 1"), ["col", "row"])


THROUGHPUT = """done AS (SELECT event_id, row_number() OVER w AS done, CAST(sum(CAST(round(secs * 100) AS BIGINT)) OVER w AS BIGINT) AS cs
  FROM edit_log WHERE NOT failed WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
rate AS (SELECT event_id, done, cs, CAST(cs AS DOUBLE) / (done * CAST(100 AS DOUBLE)) AS secs_per_tile,
  CASE WHEN cs > 0 THEN done * CAST(360000 AS DOUBLE) / cs END AS tiles_per_hour FROM done)"""
RATE = "event_id:l done:l cs:l secs_per_tile:d tiles_per_hour:d"


@query("k1_running_throughput", RATE, X.with_("edit_log", ctes=THROUGHPUT, body="SELECT * FROM rate"))
def k1(t):
    return O.running_throughput(X.edit_log(t))


@query("k2_progress_every", RATE, X.with_("edit_log", ctes=THROUGHPUT, body="SELECT * FROM rate WHERE done % 20 = 0 OR done = (SELECT count(*) FROM rate)"))
def k2(t):
    log = X.edit_log(t)
    return O.progress_every(O.running_throughput(log), log.where("NOT failed").count())


@query(
    "k3_retry_report", "call_id:l attempts:l failures:l last_failed:b gave_up:b",
    X.with_(
        "edit_log",
        ctes="a AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY ts DESC, event_id DESC) AS rn FROM edit_log)",
        body="SELECT call_id, count(*) AS attempts, count(*) FILTER (failed) AS failures, bool_or(failed AND rn = 1) AS last_failed, bool_or(failed AND rn = 1) AND count(*) FILTER (failed) >= 8 AS gave_up FROM a GROUP BY call_id",
    ),
)
def k3(t):
    return O.retry_report(X.edit_log(t), 8)


@query("k5_latest_wins", "call_id:l stamp:s event_id:l secs:d", X.with_("edit_log", body="SELECT call_id, CAST(ts AS VARCHAR) AS stamp, event_id, secs FROM (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY ts DESC, event_id DESC) AS rn FROM edit_log WHERE NOT failed) WHERE rn = 1"))
def k5(t):
    done = X.edit_log(t).where("NOT failed").select("call_id", "ts", "event_id", "secs")
    return sinks.latest(done, ["call_id"], "ts").withColumn("stamp", F.col("ts").cast("string"))


@query(
    "k7_throughput_windows", "start:s stop:s tiles:l cs:l",
    X.with_("edit_log", body="SELECT CAST(time_bucket(INTERVAL 1 HOUR, ts) AS VARCHAR) AS start, CAST(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS VARCHAR) AS stop, count(*) AS tiles, sum(CAST(round(secs * 100) AS BIGINT)) AS cs FROM edit_log WHERE NOT failed GROUP BY 1, 2"),
)
def k7(t):
    return O.throughput_windows(X.edit_log(t)).select(F.col("start").cast("string"), F.col("end").cast("string").alias("stop"), "tiles", "cs")
