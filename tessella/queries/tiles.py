"""Checked queries: sources and sinks (A) and tile-grid operators (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella import fixtures as X
from tessella.functions import color as C
from tessella.functions import text as T
from tessella.operators import grid as G
from tessella.operators import runs as R
from tessella.queries import sqlgen as S
from tessella.queries.neighbors import BLUE, BLOCK, as_runs, blue_runs, runs_sql
from tessella.queries.registry import query
from tessella.session import new_path
from tessella.sources import sinks
from tessella.sources import tiles as ST


def tiles(t):
    return G.parse_tiles(X.tile_files(t)).withColumn("region", F.expr("cast(substring(region, 2) as bigint)"))


KEY = ["region", "col", "row"]


@query(
    "a1_scan_tiles", "path:s region:l col:l row:l seq:l",
    X.with_("tiles", body="SELECT 'submissions/r' || region || '/tile_' || col || '_' || row || '.png' AS path, region, col, row, seq FROM tiles"),
)
def a1(t):
    return tiles(t)


@query("a2_tiles_to_pixels", "col:l row:l y:l x:l r:l g:l b:l", X.with_("raster", body="SELECT x // 25 AS col, y // 25 AS row, y % 25 AS y, x % 25 AS x, r, g, b FROM raster"))
def a2(t):
    return ST.tiles_to_pixels(ST.pixels_to_tiles(X.raster(t), [], X.TILE))


@query(
    "a3_read_manifest", "region:l cols:l rows:l",
    X.with_(
        "tiles", ctes="m AS (SELECT s_suppkey AS region, s_nationkey - 5 AS grid FROM supplier WHERE s_acctbal > 1000),\n"
        "e AS (SELECT region, max(col) + 1 AS cols, max(row) + 1 AS rows FROM tiles GROUP BY region)",
        body="SELECT e.region, CASE WHEN grid > 0 THEN grid ELSE cols END AS cols, CASE WHEN grid > 0 THEN grid ELSE rows END AS rows FROM e LEFT JOIN m ON m.region = e.region",
    ),
)
def a3(t):
    docs = t.supplier.where("s_acctbal > 1000").selectExpr("s_suppkey region", "to_json(named_struct('grid', s_nationkey - 5, 'by', s_name)) doc")
    return G.override_extent(G.grid_extent(tiles(t), ["region"]), ST.parse_manifest(docs, ["region"]), ["region"])


def list_docs(t):
    """One JSON list per region; whole-number halves of the column make repeated cells."""
    return X.region_tiles(t).groupBy("region").agg(
        F.to_json(F.collect_list(F.array(F.floor(F.col("col") / 2).cast("int"), F.col("row")))).alias("doc")
    )


@query("a4_read_tile_list", "region:l col:l row:l", X.with_("region_tiles", body="SELECT DISTINCT region, col // 2 AS col, row FROM region_tiles"))
def a4(t):
    return ST.parse_tile_list(list_docs(t), ["region"])


def calibrations(t):
    return ST.parse_calibration(
        t.supplier.selectExpr(
            "s_suppkey id",
            "to_json(named_struct('A', array(array(cast(s_nationkey as double), 20D), array(20D, 0.5D), array(0D, cast(s_suppkey as double))),"
            " 'center', array(38.5D, -90.25D), 'mLat', 2D, 'mLng', s_acctbal, 'col0', 1D, 'row0', 0D)) doc",
        ),
        ["id"],
    )


@query(
    "a5_read_calibration", "id:l a00:d a01:d a10:d a11:d a20:d a21:d clat:d clng:d mlat:d mlng:d col0:d row0:d",
    "SELECT s_suppkey AS id, s_nationkey AS a00, 20 AS a01, 20 AS a10, 0.5 AS a11, 0 AS a20, s_suppkey AS a21, 38.5 AS clat, -90.25 AS clng, 2 AS mlat, s_acctbal AS mlng, 1 AS col0, 0 AS row0 FROM supplier",
)
def a5(t):
    return calibrations(t)


@query(
    "a6_read_features", "osm_id:l type:s wood:b member:l role:s seq:l lat:d lon:d",
    X.with_(
        "arcs",
        ctes="a AS (SELECT *, row_number() OVER (PARTITION BY osm_id ORDER BY arc) - 1 AS pos FROM arcs),\n"
        "k AS (SELECT *, row_number() OVER (PARTITION BY osm_id ORDER BY arc) - 1 AS wpos FROM a WHERE NOT bare),\n"
        "p AS (SELECT *, unnest([0, 1]) AS i FROM k)",
        body="SELECT osm_id, type, wood, CASE WHEN type = 'way' THEN 0 ELSE pos END AS member,"
        " CASE WHEN type = 'way' THEN NULL ELSE role END AS role, CASE WHEN type = 'way' THEN wpos * 2 + i ELSE i END AS seq,"
        " CASE WHEN i = 0 THEN lat0 ELSE lat1 END AS lat, CASE WHEN i = 0 THEN lon0 ELSE lon1 END AS lon FROM p",
    ),
)
def a6(t):
    return ST.points(ST.parse_features(X.map_extract(t))).withColumn("wood", F.col("tags")["natural"] == "wood")


FALLBACK = """wanted AS (SELECT DISTINCT region, col + 7 AS col, row + 3 AS row FROM tiles),
one AS (SELECT l_suppkey AS region, l_partkey % 17 + 11 AS col, l_orderkey % 26 + 2 AS row, max(l_orderkey) AS item FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2, 3),
two AS (SELECT l_suppkey AS region, l_partkey % 17 + 5 AS col, l_orderkey % 26 + 9 AS row, max(l_orderkey) AS item FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2, 3),
j AS (SELECT w.*, CASE WHEN one.item IS NOT NULL THEN 1 WHEN two.item IS NOT NULL THEN 2 END AS source, coalesce(one.item, two.item) AS item
  FROM wanted w LEFT JOIN one USING (region, col, row) LEFT JOIN two USING (region, col, row))"""


def _fallback(t):
    def src(flag):
        return t.lineitem.where(F.col("l_returnflag") == flag).groupBy(
            F.col("l_suppkey").alias("region"), (F.col("l_partkey") % 17).alias("col"), (F.col("l_orderkey") % 26).alias("row")
        ).agg(F.max("l_orderkey").alias("item"))

    wanted = tiles(t).select("region", (F.col("col") + 7).alias("col"), (F.col("row") + 3).alias("row")).distinct()
    return ST.read_with_fallback(wanted, src("A"), src("N"), ["region"], (11, 2), (5, 9))


@query("a7_read_with_fallback", "region:l col:l row:l source:l item:l", X.with_("tiles", ctes=FALLBACK, body="SELECT * FROM j WHERE source IS NOT NULL"))
def a7(t):
    return _fallback(t).where("source IS NOT NULL")


@query("a7_no_raw", "region:l missing:l", X.with_("tiles", ctes=FALLBACK, body="SELECT region, count(*) AS missing FROM j WHERE source IS NULL GROUP BY region"))
def a7m(t):
    return _fallback(t).where("source IS NULL").groupBy("region").agg(F.count("*").alias("missing"))


@query(
    "a8_write_tiles", "region:l col:l row:l seq:l width:l price:l",
    X.with_("tiles", body="SELECT region, col, row, t.seq, t.width, t.price FROM (SELECT region, col, row, max({'seq': seq, 'price': price, 'width': width}) AS t FROM tiles GROUP BY ALL)"),
)
def a8(t):
    path = new_path(t.spark, "tiles")
    sinks.write_tiles(sinks.latest(tiles(t).select(*KEY, "seq", "price", "width"), KEY, "seq"), path)
    return t.spark.read.parquet(path)


@query("a9_write_masks", "y:l x0:l x1:l", runs_sql(BLUE, "blue"))
def a9(t):
    path = new_path(t.spark, "masks")
    sinks.write_masks(blue_runs(t), path)
    return as_runs(t.spark.read.parquet(path))


@query("b1_grid_extent", "region:l cols:l rows:l", X.with_("tiles", body="SELECT region, max(col) + 1 AS cols, max(row) + 1 AS rows FROM tiles GROUP BY region"))
def b1(t):
    return G.grid_extent(tiles(t), ["region"])


CELLS = """ext AS (SELECT region, max(col) + 1 AS cols, max(row) + 1 AS rows FROM tiles GROUP BY region),
cells AS (SELECT region, col, unnest(range(rows)) AS row FROM (SELECT region, rows, unnest(range(cols)) AS col FROM ext))"""


@query("b2_grid_cells", "region:l col:l row:l", X.with_("tiles", ctes=CELLS, body="SELECT * FROM cells"))
def b2(t):
    return G.grid_cells(G.grid_extent(tiles(t), ["region"]), ["region"])


@query(
    "b3_missing_cells", "region:l col:l row:l",
    X.with_("tiles", ctes=CELLS, body="SELECT * FROM cells c WHERE NOT EXISTS (SELECT 1 FROM tiles t WHERE t.region = c.region AND t.col = c.col AND t.row = c.row)"),
)
def b3(t):
    tl = tiles(t)
    return G.missing_cells(tl, G.grid_extent(tl, ["region"]), ["region"])


@query("b4_place", "seq:l col:l row:l x0:l y0:l", X.with_("tiles", body="SELECT seq, col, row, col * 512 + 3072 AS x0, row * 512 + 7 AS y0 FROM tiles"))
def b4(t):
    return G.place(tiles(t), 512, 3072, 7)


@query(
    "b5_drop_out_of_canvas", "seq:l x0:l y0:l",
    X.with_("tiles", body="SELECT * FROM (SELECT seq, col * 512 - 1024 AS x0, row * 512 AS y0 FROM tiles) WHERE x0 >= 0 AND y0 >= 0 AND x0 + 512 <= 6000 AND y0 + 512 <= 9000"),
)
def b5(t):
    return G.drop_out_of_canvas(G.place(tiles(t), 512, -1024, 0), 512, 6000, 9000)


@query(
    "b6_ragged_cells", "id:l label:s x0:l y0:l x1:l y1:l",
    "WITH s AS (SELECT s_suppkey AS id, 300 + s_nationkey * 17 AS w, 200 + s_suppkey % 50 * 11 AS h FROM supplier),\n"
    "a AS (SELECT *, unnest(range((w + 99) // 100)) AS c FROM s), b AS (SELECT *, unnest(range((h + 99) // 100)) AS r FROM a)\n"
    "SELECT id, c || '_' || r AS label, c * 100 AS x0, r * 100 AS y0, least(c * 100 + 100, w) AS x1, least(r * 100 + 100, h) AS y1 FROM b",
)
def b6(t):
    s = t.supplier.selectExpr("s_suppkey id", "300 + s_nationkey * 17 w", "200 + cast(s_suppkey % 50 as int) * 11 h")
    return G.ragged_cells(s, 100, ["id"])


@query("b7_rebase", "seq:l col:l row:l", X.with_("tiles", body="SELECT seq, col - 3 AS col, row - 5 AS row FROM tiles WHERE col BETWEEN 3 AND 9 AND row BETWEEN 5 AND 20"))
def b7(t):
    return G.rebase(tiles(t), 3, 5, 9, 20)


@query(
    "b8_resume", "region:l col:l row:l",
    X.with_("tiles", body="SELECT DISTINCT region, col, row FROM tiles EXCEPT SELECT region, col, row FROM tiles WHERE width = 1024 AND price > 40000"),
)
def b8(t):
    tl = tiles(t)
    return G.resume(tl.select(*KEY).distinct(), tl.where("width = 1024 AND price > 40000"), KEY)


@query("b9_process_first", "path:s seq:l", X.with_("tile_files", body="SELECT path, seq FROM tile_files ORDER BY path, seq, price LIMIT 6"))
def b9(t):
    return G.process_first(X.tile_files(t), 6, ["path", "seq", "price"])


@query(
    "b10_skip_if_already_blue", "col:l row:l share:d",
    X.with_("raster", body="SELECT x // 25 AS col, y // 25 AS row, CAST(count(*) FILTER (b > r + 6 AND b > g AND b > 110) AS DOUBLE) / count(*) AS share FROM raster GROUP BY 1, 2 HAVING share <= 0.35"),
)
def b10(t):
    px = X.raster(t).withColumn("col", F.floor(F.col("x") / X.TILE)).withColumn("row", F.floor(F.col("y") / X.TILE))
    return G.drop_already_blue(px, C.is_walk_blue(), ["col", "row"])


BOXES = "SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey % 4000 AS x0, l_orderkey % 3000 AS y0, l_partkey % 4000 + 20 + CAST(l_quantity AS BIGINT) * 9 AS x1, l_orderkey % 3000 + 30 + l_suppkey % 200 AS y1 FROM lineitem"


def boxes(t):
    return t.lineitem.selectExpr(
        "l_orderkey * 10 + l_linenumber id", "l_partkey % 4000 x0", "l_orderkey % 3000 y0",
        "l_partkey % 4000 + 20 + cast(l_quantity as bigint) * 9 x1", "l_orderkey % 3000 + 30 + l_suppkey % 200 y1",
    )


@query(
    "b11_context_window", "id:l x0:l y0:l wx0:l wy0:l bx0:l by0:l bx1:l by1:l pct:l",
    f"SELECT id, x0, y0, wx0, wy0, x0 - wx0 AS bx0, y0 - wy0 AS by0, x1 - wx0 AS bx1, y1 - wy0 AS by1, (x1 - x0) * (y1 - y0) * 100 // 1048576 AS pct FROM"
    f" (SELECT *, greatest(0, least(5000 - 1024, (x0 + x1) // 2 - 512)) AS wx0, greatest(0, least(4000 - 1024, (y0 + y1) // 2 - 512)) AS wy0 FROM ({BOXES}))",
)
def b11(t):
    return G.context_window(boxes(t), 1024, 5000, 4000)


@query(
    "b12_padded_window", "seq:l wx0:l wy0:l wx1:l wy1:l ox:l oy:l cw:l ch:l",
    X.with_(
        "tiles", body="SELECT seq, wx0, wy0, least(17000, cx + 1244) AS wx1, least(26000, cy + 1244) AS wy1, cx - wx0 AS ox, cy - wy0 AS oy, least(1024, 17000 - cx) AS cw, least(1024, 26000 - cy) AS ch"
        " FROM (SELECT seq, col * 1024 AS cx, row * 1024 AS cy, greatest(0, col * 1024 - 220) AS wx0, greatest(0, row * 1024 - 220) AS wy0 FROM tiles)",
    ),
)
def b12(t):
    return G.padded_window(tiles(t), 1024, 220, 17000, 26000)




@query(
    "b13_extract_window", "wx0:l wy0:l n:l sr:l sxy:l",
    X.with_(
        "raster", "size", ctes="win AS (SELECT DISTINCT o_custkey % 105 AS wx0, o_orderkey // 125 AS wy0 FROM orders WHERE o_totalprice > 250000)",
        body="SELECT wx0, wy0, count(*) AS n, sum(r) AS sr, sum((x - wx0) * (y - wy0)) AS sxy FROM win JOIN raster ON x >= wx0 AND x < wx0 + 20 AND y >= wy0 AND y < wy0 + 20 GROUP BY wx0, wy0",
    ),
)
def b13(t):
    win = t.orders.where("o_totalprice > 250000").selectExpr("o_custkey % 105 wx0", f"o_orderkey div {X.WIDTH} wy0").distinct()
    win = win.selectExpr("wx0", "wy0", "wx0 + 20 wx1", "wy0 + 20 wy1", "wx0 kx", "wy0 ky")
    px = G.extract_window(X.raster(t), win, ["kx", "ky"], block=32)
    return px.groupBy(F.col("kx").alias("wx0"), F.col("ky").alias("wy0")).agg(
        F.count("*").alias("n"), F.sum("r").alias("sr"), F.sum(F.col("x") * F.col("y")).alias("sxy")
    )


SETTINGS = (
    {"label": "base s1.0", "scale": 1.0, "guidance": 4.0},
    {"label": "base s1.4", "scale": 1.4, "guidance": 4.5},
    {"label": "strong s1.8", "scale": 1.8, "guidance": 6.0},
)
COMBOS = "combos(label, scale, guidance) AS (VALUES ('base s1.0', 1.0, 4.0), ('base s1.4', 1.4, 4.5), ('strong s1.8', 1.8, 6.0)),\n"
NAMED = "named AS (SELECT DISTINCT region, 'tile_' || col || '_' || row || '.png' AS name FROM tiles),\n"


def named(t):
    return tiles(t).select("region", T.file_name(F.col("path")).alias("name")).distinct()


@query(
    "b14_sweep", "region:l out:s scale:d guidance:d",
    X.with_("tiles", ctes=COMBOS + NAMED, body="SELECT region, replace(label, ' ', '_') || '__' || name AS out, scale, guidance FROM named, combos"),
)
def b14(t):
    return G.sweep(named(t), SETTINGS)


@query(
    "b15_contact_sheet", "name:s base_10:s base_14:s strong_18:s",
    X.with_(
        "tiles", ctes=NAMED, body="SELECT name, max('base_s1.0__' || name) AS base_10, max('base_s1.4__' || name) AS base_14, max('strong_s1.8__' || name) AS strong_18 FROM named GROUP BY name",
    ),
)
def b15(t):
    s = G.contact_sheet(G.sweep(named(t), SETTINGS), [c["label"] for c in SETTINGS], "out")
    return s.toDF("name", "base_10", "base_14", "strong_18")


@query(
    "b16_cell_rules", "seq:l col:l row:l rule:s",
    X.with_("tiles", body="SELECT seq, col, row, p_name AS rule FROM tiles JOIN (SELECT p_partkey // 26 AS col, p_partkey % 26 AS row, p_name FROM part WHERE p_size > 45) p USING (col, row)"),
)
def b16(t):
    rules = t.part.where("p_size > 45").selectExpr("p_partkey div 26 col", "p_partkey % 26 row", "p_name rule")
    return G.cell_rules(tiles(t), rules)


@query(
    "b17_validate_submission", "region:s file:s reason:s",
    X.with_(
        "tile_files",
        ctes="f AS (SELECT split_part(path, '/', 2) AS region, split_part(path, '/', 3) AS file, width FROM tile_files)\n,"
        "g AS (SELECT region, count(DISTINCT file) AS n FROM f WHERE file LIKE '%.png' GROUP BY region)",
        body="SELECT DISTINCT region, file, 'name' AS reason FROM f WHERE file LIKE '%.jpg' UNION ALL"
        " SELECT DISTINCT region, file, 'size' FROM f WHERE file LIKE '%.png' AND width <> 1024 UNION ALL"
        " SELECT region, '', 'too many tiles' FROM g WHERE n > 450 UNION ALL SELECT DISTINCT region, '', 'no notes' FROM f WHERE CAST(region[2:] AS INT) NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 3000)",
    ),
)
def b17(t):
    notes = t.supplier.where("s_acctbal > 3000").selectExpr("concat('submissions/r', s_suppkey, '/NOTES.md') path", "0 width", "0 height")
    return G.validate_submission(X.tile_files(t).select("path", "width", "height").unionByName(notes), max_tiles=450)


@query(
    "b17_one_region", "region:s file:s reason:s",
    X.with_("tile_files", ctes="f AS (SELECT split_part(path, '/', 2) AS region, seq // 10 % 400 AS sub FROM tile_files)",
            body="SELECT '' AS region, CAST(sub AS VARCHAR) AS file, 'more than one region' AS reason FROM f GROUP BY sub HAVING count(DISTINCT region) > 1"),
)
def b17_region(t):
    """Submissions that touch more than one region."""
    files = X.tile_files(t).selectExpr("path", "width", "height", "cast(seq div 10 % 400 as string) submission")
    return G.validate_submission(files, submission="submission").where("reason = 'more than one region'")


DOC_PATH = {
    "spark": "concat(CASE WHEN doc_id % 5 = 0 THEN 'submissions/' ELSE concat(source, '/') END, doc_id,"
    " CASE doc_id % 7 WHEN 0 THEN '.png' WHEN 1 THEN '.safetensors' WHEN 2 THEN '.pem' WHEN 3 THEN '/.env' WHEN 4 THEN '/.cloud_env' ELSE '.md' END)",
    "sql": "CASE WHEN doc_id % 5 = 0 THEN 'submissions/' ELSE source || '/' END || doc_id ||"
    " CASE doc_id % 7 WHEN 0 THEN '.png' WHEN 1 THEN '.safetensors' WHEN 2 THEN '.pem' WHEN 3 THEN '/.env' WHEN 4 THEN '/.cloud_env' ELSE '.md' END",
}


def _forbidden_sql():
    parts = []
    for why, field, rx in T.FORBIDDEN:
        if "(?!" in rx:
            cond = r"regexp_matches(path, '(?i)\.(png|jpe?g|webp)$') AND NOT starts_with(path, 'submissions/')"
        else:
            cond = f"regexp_matches({field}, '{rx}')"
        parts.append(f"SELECT doc_id, path, '{why}' AS reason FROM d WHERE {cond}")
    return f"WITH d AS (SELECT doc_id, text, {DOC_PATH['sql']} AS path FROM documents)\n" + "\nUNION ALL ".join(parts)


@query("b18_forbidden_content", "doc_id:l path:s reason:s", _forbidden_sql())
def b18(t):
    d = t.documents.selectExpr("doc_id", "text", DOC_PATH["spark"] + " path")
    return d.select("doc_id", "path", F.explode(T.forbidden_reasons(F.col("path"), F.col("text"))).alias("reason"))


@query(
    "b19_notes_fields", "id:l range:s rows:s weights:s steps:s command:s complete:b",
    "SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN (o_custkey % 9) || '-' || (o_custkey % 9 + 4) END AS range, CASE WHEN o_orderstatus <> 'P' THEN '0-' || o_custkey % 7 END AS rows,"
    " CASE WHEN o_orderpriority <> '5-LOW' THEN 'w' || (o_custkey % 3) || '.safetensors' END AS weights,"
    " CASE WHEN o_totalprice > 100000 THEN CAST(10 + o_custkey % 20 AS VARCHAR) END AS steps,"
    " CASE WHEN o_custkey % 4 <> 0 THEN 'python run_' || o_orderkey || '.py' END AS command,"
    " o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' AND o_totalprice > 100000 AND o_custkey % 4 <> 0 AS complete FROM orders",
)
def b19(t):
    notes = t.orders.selectExpr(
        "o_orderkey id",
        "concat_ws('\\n', CASE WHEN o_orderstatus <> 'P' THEN concat('columns ', o_custkey % 9, '-', o_custkey % 9 + 4, ' rows 0-', o_custkey % 7) END,"
        " CASE WHEN o_orderpriority <> '5-LOW' THEN concat('file w', o_custkey % 3, '.safetensors') END,"
        " CASE WHEN o_totalprice > 100000 THEN concat('Steps: ', 10 + o_custkey % 20) END,"
        " CASE WHEN o_custkey % 4 <> 0 THEN concat('ran `python run_', o_orderkey, '.py` twice') END) notes",
    )
    # the command ends at white space or at the closing quote
    f = notes.select("id", *T.note_fields(F.regexp_replace("notes", "`", " ")))
    full = F.col("range").isNotNull() & F.col("weights").isNotNull() & F.col("steps").isNotNull() & F.col("command").isNotNull()
    return f.withColumn("complete", full)


@query(
    "b20_source_precedence", "col:l row:l prio:l seq:l price:l",
    X.with_(
        "tiles", body="SELECT col, row, t.prio AS prio, t.seq AS seq, t.price AS price FROM (SELECT col, row, max({'prio': CASE WHEN width = 512 THEN 2 ELSE 1 END, 'seq': seq, 'price': price}) AS t FROM tiles GROUP BY col, row)",
    ),
)
def b20(t):
    tl = tiles(t)
    a = tl.where("width = 1024").select("col", "row", F.lit(1).alias("prio"), "seq", "price")
    b = tl.where("width = 512").select("col", "row", F.lit(2).alias("prio"), "seq", "price")
    return G.source_precedence(a.unionByName(b), ["col", "row"], "prio")
