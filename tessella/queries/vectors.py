"""Checked queries: vector outlines to raster (G1-G6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella import fixtures as X
from tessella.operators import runs as R
from tessella.operators import vector as V
from tessella.queries import sqlgen as S
from tessella.queries.registry import query
from tessella.session import save
from tessella.sources import tiles as ST

LINES = """a AS (SELECT *, row_number() OVER (PARTITION BY osm_id ORDER BY arc) - 1 AS pos FROM arcs),
lines AS (SELECT osm_id, type, wood, pos AS member, role, arc, lat0, lon0, lat1, lon1 FROM a WHERE type = 'relation' AND NOT bare),
ways AS (SELECT osm_id, type, wood, count(*) * 2 AS n FROM a WHERE type = 'way' AND NOT bare GROUP BY ALL),
outer_lines AS (SELECT * FROM lines WHERE role IN ('outer', ''))"""

# A sheared calibration, so that squares on the ground become tilted parallelograms on the canvas.
CAL = {"a00": 9.0, "a01": 2.5, "a10": -3.0, "a11": 8.0, "a20": 170.0, "a21": 0.0, "clat": 0.5, "clng": 0.25, "mlat": 1.0, "mlng": 1.5, "col0": 1.0, "row0": -1.0}


def lines(t):
    return ST.parse_features(X.map_extract(t))


@query("g1_bbox_filter", "osm_id:l lat:d lon:d", X.with_("arcs", ctes=LINES, body="SELECT osm_id, lat, lon FROM (SELECT osm_id, wood, bare, unnest([lat0, lat1]) AS lat, unnest([lon0, lon1]) AS lon FROM arcs) WHERE NOT bare AND NOT wood AND lat BETWEEN 2 AND 40 AND lon BETWEEN 3.5 AND 21"))
def g1(t):
    return V.bbox_filter(ST.points(lines(t)), 2, 3.5, 40, 21)


@query("g2_flatten_features", "osm_id:l type:s member:l role:s n:l", X.with_("arcs", ctes=LINES, body="SELECT osm_id, type, member, role, 2 AS n FROM outer_lines UNION ALL SELECT osm_id, type, 0, NULL, n FROM ways"))
def g2(t):
    return V.outer_lines(lines(t)).withColumn("n", F.size("geometry"))


@query("g3_rivers_only", "osm_id:l member:l role:s", X.with_("arcs", ctes=LINES, body="SELECT osm_id, member, role FROM outer_lines"))
def g3(t):
    return V.rivers_only(V.outer_lines(lines(t)))


@query("g3_line_counts", "type:s lines:l", X.with_("arcs", ctes=LINES, body="SELECT type, count(*) AS lines FROM outer_lines GROUP BY type UNION ALL SELECT 'way', count(*) FROM ways"))
def g3c(t):
    return V.line_counts(V.outer_lines(lines(t)))


def outer_arcs(t):
    arcs = V.rivers_only(V.outer_lines(lines(t)))
    return arcs.select((F.col("osm_id") * 8 + F.col("member")).alias("arc_id"), "osm_id", "member", "geometry")


RINGS = LINES + """,
nodes AS (SELECT osm_id, lat, lon, count(*) AS ends FROM (SELECT osm_id, lat0 AS lat, lon0 AS lon FROM outer_lines UNION ALL SELECT osm_id, lat1, lon1 FROM outer_lines) GROUP BY ALL),
loose AS (SELECT DISTINCT osm_id FROM nodes WHERE ends <> 2),
chain AS (SELECT osm_id, arc, member, count(*) OVER (PARTITION BY osm_id) + 1 AS points, osm_id NOT IN (SELECT osm_id FROM loose) AS closed FROM outer_lines)"""


@query(
    "g4_chain_rings", "osm_id:l member:l points:l closed:b first:l",
    X.with_(
        "arcs", ctes=RINGS + """,
piece(osm_id, root, member) AS (SELECT osm_id, member, member FROM outer_lines UNION
  SELECT p.osm_id, p.root, b.member FROM piece p JOIN outer_lines a ON a.osm_id = p.osm_id AND a.member = p.member JOIN outer_lines b ON b.osm_id = a.osm_id
    AND ((a.lat0 = b.lat1 AND a.lon0 = b.lon1) OR (a.lat1 = b.lat0 AND a.lon1 = b.lon0))),
ring AS (SELECT osm_id, member, min(root) AS first FROM piece GROUP BY osm_id, member)""",
        body="SELECT osm_id, member, count(*) OVER (PARTITION BY osm_id, first) + 1 AS points, closed, osm_id * 8 + first AS first FROM ring JOIN chain USING (osm_id, member)",
    ),
)
def g4(t):
    arcs = outer_arcs(t)
    r = V.chain_rings(arcs)
    first = r.groupBy("ring").agg(F.min("arc_id").alias("first"))
    return r.join(first, "ring").join(arcs.select("arc_id", "osm_id", "member"), "arc_id")


@query("g4_ring_points", "osm_id:l seq:l lat:d lon:d north:d", X.with_("touching", body="SELECT osm_id, seq, lat, lon, max(lat) OVER (PARTITION BY osm_id, shape) AS north FROM touching"))
def g4_points(t):
    """Rings that nest and touch, as ordered points; the hanging arcs of broken rings are left out."""
    arcs = save(X.touching_arcs(t), "arcs")
    rings, mates = V.assemble(arcs)
    p = V.ring_points(arcs, rings, mates).where("closed")
    names = rings.join(arcs.select("arc_id", "osm_id"), "arc_id").select("ring", "osm_id").distinct()
    north = p.groupBy("ring").agg(F.max("lat").alias("north"))
    return p.join(names, "ring").join(north, "ring")


def cal_sql(lat, lon, cal=CAL):
    e = f"(({lon} - CAST({cal['clng']} AS DOUBLE)) * CAST({cal['mlng']} AS DOUBLE))"
    n = f"(({lat} - CAST({cal['clat']} AS DOUBLE)) * CAST({cal['mlat']} AS DOUBLE))"
    d = lambda k: f"CAST({cal[k]} AS DOUBLE)"
    return (
        f"({e} * {d('a00')} + {n} * {d('a10')} + {d('a20')} - {d('col0')}) * CAST(2 AS DOUBLE)",
        f"({e} * {d('a01')} + {n} * {d('a11')} + {d('a21')} - {d('row0')}) * CAST(2 AS DOUBLE)",
    )


@query("g5_project", "osm_id:l member:l seq:l px:d py:d", X.with_("arcs", ctes=LINES, body=f"SELECT osm_id, member, 0 AS seq, {cal_sql('lat0', 'lon0')[0]} AS px, {cal_sql('lat0', 'lon0')[1]} AS py FROM outer_lines UNION ALL SELECT osm_id, member, 1, {cal_sql('lat1', 'lon1')[0]}, {cal_sql('lat1', 'lon1')[1]} FROM outer_lines"))
def g5(t):
    return V.project(ST.points(outer_arcs(t)), CAL, 4, 0.5)


CW, CH = 800, 1000


def polygon_runs(t, cal=CAL, w=CW, h=CH, block=R.BLOCK):
    arcs = save(outer_arcs(t), "arcs")
    closed = V.chain_rings(arcs).where("closed").select("arc_id", "ring")
    edges = V.segments(V.project(ST.points(arcs), cal, 4, 0.5), ["arc_id"])
    return V.rasterise(edges.join(closed, "arc_id"), "ring", w, h, block=block)


def polygons_sql(cal=CAL, w=str(CW), h=str(CH)):
    """Pixels ``poly`` of the closed rings on a canvas whose sides are SQL expressions."""
    x0, y0 = cal_sql("lat0", "lon0", cal)
    x1, y1 = cal_sql("lat1", "lon1", cal)
    return RINGS + f""",
edge AS (SELECT osm_id, {x0} AS x0, {y0} AS y0, {x1} AS x1, {y1} AS y1 FROM outer_lines WHERE osm_id NOT IN (SELECT osm_id FROM loose)),
box AS (SELECT osm_id, floor(min(least(x0, x1))) AS bx0, ceil(max(greatest(x0, x1))) AS bx1, floor(min(least(y0, y1))) AS by0, ceil(max(greatest(y0, y1))) AS by1 FROM edge GROUP BY osm_id),
probe AS (SELECT osm_id, x, unnest(range(greatest(by0, 0)::BIGINT, least(by1, {h} - 1)::BIGINT + 1)) AS y FROM
  (SELECT *, unnest(range(greatest(bx0, 0)::BIGINT, least(bx1, {w} - 1)::BIGINT + 1)) AS x FROM box)),
hit AS (SELECT p.osm_id, p.x, p.y, count(*) AS n FROM probe p JOIN
  (SELECT osm_id, CASE WHEN y0 <= y1 THEN x0 ELSE x1 END AS xa, least(y0, y1) AS ya, CASE WHEN y0 <= y1 THEN x1 ELSE x0 END AS xb, greatest(y0, y1) AS yb FROM edge) e ON e.osm_id = p.osm_id
  WHERE p.y + CAST(0.5 AS DOUBLE) >= ya AND p.y + CAST(0.5 AS DOUBLE) < yb AND xa + (p.y + CAST(0.5 AS DOUBLE) - ya) * (xb - xa) / (yb - ya) <= p.x + CAST(0.5 AS DOUBLE) GROUP BY ALL),
poly AS (SELECT DISTINCT y, x FROM hit WHERE n % 2 = 1),
"""


@query("g6_rasterise", "y:l x0:l x1:l", X.with_("arcs", ctes=polygons_sql() + S.runs("q", "poly"), body="SELECT y, x0, x1 FROM q"))
def g6(t):
    return R.maximal(polygon_runs(t))


NX, NY = cal_sql("lat", "lon")
NESTED = f"""
corner AS (SELECT osm_id, shape, seq, {NX} AS px, {NY} AS py FROM touching),
edge AS (SELECT osm_id, shape, px AS x0, py AS y0, lead(px) OVER v AS x1, lead(py) OVER v AS y1 FROM corner WINDOW v AS (PARTITION BY osm_id, shape ORDER BY seq)),
box AS (SELECT osm_id, shape, floor(min(px)) AS bx0, ceil(max(px)) AS bx1, floor(min(py)) AS by0, ceil(max(py)) AS by1 FROM corner GROUP BY ALL),
probe AS (SELECT osm_id, shape, x, unnest(range(greatest(by0, 0)::BIGINT, least(by1, {CH - 1})::BIGINT + 1)) AS y FROM
  (SELECT *, unnest(range(greatest(bx0, 0)::BIGINT, least(bx1, {CW - 1})::BIGINT + 1)) AS x FROM box)),
hit AS (SELECT p.osm_id, p.shape, p.x, p.y, count(*) AS n FROM probe p JOIN
  (SELECT osm_id, shape, CASE WHEN y0 <= y1 THEN x0 ELSE x1 END AS xa, least(y0, y1) AS ya, CASE WHEN y0 <= y1 THEN x1 ELSE x0 END AS xb, greatest(y0, y1) AS yb FROM edge WHERE x1 IS NOT NULL) e
  ON e.osm_id = p.osm_id AND e.shape = p.shape
  WHERE p.y + CAST(0.5 AS DOUBLE) >= ya AND p.y + CAST(0.5 AS DOUBLE) < yb AND xa + (p.y + CAST(0.5 AS DOUBLE) - ya) * (xb - xa) / (yb - ya) <= p.x + CAST(0.5 AS DOUBLE) GROUP BY ALL),
poly AS (SELECT DISTINCT y, x FROM hit WHERE n % 2 = 1),
"""


@query("g6_nested_rings", "y:l x0:l x1:l", X.with_("touching", ctes=NESTED + S.runs("q", "poly"), body="SELECT y, x0, x1 FROM q"))
def g6_nested(t):
    """Rings that share a corner are filled each by itself: the inner one cuts no hole."""
    arcs = save(X.touching_arcs(t), "arcs")
    closed = V.chain_rings(arcs).where("closed").select("arc_id", "ring")
    edges = V.segments(V.project(ST.points(arcs), CAL, 4, 0.5), ["arc_id"])
    return R.maximal(V.rasterise(edges.join(closed, "arc_id"), "ring", CW, CH))
