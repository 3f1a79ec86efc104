"""Inputs derived by Spark from the given tables; each uses every row of its table.

``SQL`` holds the same derivations for the checking engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 125  # canvas width in pixels
TILE = 25  # tile edge in pixels


def raster(t) -> DataFrame:
    """A dense image, one pixel per order: river band, bridge rows, ponds, ground."""
    q = t.orders.selectExpr(
        f"cast(o_orderkey div {WIDTH} as int) y",
        f"cast(o_orderkey % {WIDTH} as int) x",
        "cast(floor(o_totalprice) as bigint) % 5 as n",
    ).withColumn(
        "k",
        F.expr(
            "CASE WHEN y % 40 IN (20,21) AND abs(x - 40 - abs(y % 100 - 50)) <= 9 THEN 2"
            " WHEN abs(x - 40 - abs(y % 100 - 50)) <= 9 THEN 1"
            " WHEN (x % 30 - 15)*(x % 30 - 15) + (y % 30 - 15)*(y % 30 - 15) < 10 THEN 3 ELSE 0 END"
        ),
    )
    return q.selectExpr(
        "y",
        "x",
        "cast(CASE k WHEN 1 THEN  88 WHEN 2 THEN 200 WHEN 3 THEN  95 ELSE 120 END + n as int) r",
        "cast(CASE k WHEN 1 THEN 139 WHEN 2 THEN 200 WHEN 3 THEN 140 ELSE 135 END + n as int) g",
        "cast(CASE k WHEN 1 THEN 179 WHEN 2 THEN 200 WHEN 3 THEN 185 ELSE 110 END + n as int) b",
    )


def raw_raster(t) -> DataFrame:
    """A second capture of the same canvas with strong texture, used as raw geometry."""
    return t.orders.selectExpr(
        f"cast(o_orderkey div {WIDTH} as int) y",
        f"cast(o_orderkey % {WIDTH} as int) x",
        "cast(cast(floor(o_totalprice) as bigint) % 200 + 20 as int) r",
        "cast(cast(floor(o_totalprice) as bigint) div 7 % 200 + 20 as int) g",
        "cast(cast(floor(o_totalprice) as bigint) div 11 % 200 + 20 as int) b",
    )


def noise_mask(t) -> DataFrame:
    """Pixels of a random half-full mask: the hard case for labelling."""
    return t.orders.where("o_totalprice < 250000").selectExpr(
        f"cast(o_orderkey div {WIDTH} as int) y", f"cast(o_orderkey % {WIDTH} as int) x"
    )


def height(t) -> int:
    return t.orders.agg((F.max("o_orderkey") / F.lit(WIDTH)).cast("int") + 1).first()[0]


def tile_files(t) -> DataFrame:
    """Submitted files with duplicates, wrong suffixes, wrong sizes and holes."""
    return t.lineitem.selectExpr(
        "concat('submissions/r', l_suppkey, '/tile_', l_partkey % 17, '_', l_orderkey % 26,"
        " CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN '.jpg' ELSE '.png' END) path",
        "CASE WHEN l_quantity = 50 THEN 512 ELSE 1024 END width",
        "1024 height",
        "l_orderkey * 10 + l_linenumber seq",
        "cast(l_extendedprice as bigint) price",
    )


def edit_log(t) -> DataFrame:
    return t.events.selectExpr(
        "event_id", "user_id call_id", "event_type = 'error' failed", "value secs", "ts"
    )


def quads(t) -> DataFrame:
    """Raw quadrants of many walks of 5 x 5 tiles (10 x 10 quadrants)."""
    return t.part.selectExpr(
        "p_partkey div 100 walk",
        "cast(p_partkey % 10 as int) qx",
        "cast(p_partkey div 10 % 10 as int) qy",
        "p_size raw",
    )


def walks(t) -> DataFrame:
    return (
        quads(t)
        .groupBy("walk")
        .agg(((F.max("qx") + 1) / 2).cast("int").alias("nc"), ((F.max("qy") + 1) / 2).cast("int").alias("nr"))
    )


def region_tiles(t) -> DataFrame:
    """Irregular tile sets, one per hundred customers."""
    return t.customer.where("c_acctbal > 1500").selectExpr(
        "c_custkey div 100 region", "cast(c_custkey % 10 as int) col", "cast(c_custkey div 10 % 10 as int) row"
    )


def arcs(t) -> DataFrame:
    """Boundary arcs of one square per customer, laid out 30 to a row; squares of customers in debt lack one."""
    q = t.customer.selectExpr(
        "c_custkey osm_id", "c_nationkey", "c_acctbal", "c_mktsegment", "explode(array(0, 1, 2, 3)) arc"
    ).where("NOT (c_acctbal < 0 AND arc = 2)")
    return q.selectExpr(
        "osm_id",
        "arc",
        "c_acctbal > 8500 wood",
        "c_mktsegment = 'MACHINERY' AND arc = 1 bare",
        "CASE WHEN c_nationkey % 5 = 4 THEN 'inner' WHEN c_nationkey % 5 = 3 THEN '' ELSE 'outer' END role",
        "CASE WHEN c_nationkey % 5 = 2 THEN 'way' ELSE 'relation' END type",
        "cast(osm_id div 30 + (CASE WHEN arc IN (1,2) THEN 1 ELSE 0 END)*0.5 as double) lat0",
        "cast(osm_id % 30 + (CASE WHEN arc IN (2,3) THEN 1 ELSE 0 END)*0.5 as double) lon0",
        "cast(osm_id div 30 + (CASE WHEN arc IN (0,1) THEN 1 ELSE 0 END)*0.5 as double) lat1",
        "cast(osm_id % 30 + (CASE WHEN arc IN (1,2) THEN 1 ELSE 0 END)*0.5 as double) lon1",
    )


# Two more rings for each square: one inside it and one beside it, both meeting it in its first corner. Corners as (lat, lon) steps
# from there, two arcs each; the pieces of the three rings are numbered in turn.
INSIDE = ((0.0, 0.0), (0.1, 0.2), (0.2, 0.2), (0.2, 0.1), (0.0, 0.0))
BESIDE = ((0.0, 0.0), (-0.25, 0.0), (-0.25, -0.25), (0.0, -0.25), (0.0, 0.0))


def touching_arcs(t) -> DataFrame:
    """Arcs ``(arc_id, osm_id, geometry)`` of a square per customer with a ring inside and one beside it; rings of customers in debt lack an arc."""
    pieces = [(2 * i, [q, r]) for i, (q, r) in enumerate((((0.0, 0.0), (0.5, 0.0)), ((0.5, 0.0), (0.5, 0.5)), ((0.5, 0.5), (0.0, 0.5)), ((0.0, 0.5), (0.0, 0.0))))]
    pieces += [(1, INSIDE[:3]), (3, INSIDE[2:]), (5, BESIDE[:3]), (7, BESIDE[2:][::-1])]
    at = lambda p: F.struct((F.col("lat") + F.lit(p[0])).alias("lat"), (F.col("lon") + F.lit(p[1])).alias("lon"))
    arc = F.explode(F.array(*[F.struct(F.lit(i).alias("piece"), F.array(*map(at, ps)).alias("geometry")) for i, ps in pieces]))
    q = t.customer.selectExpr("c_custkey osm_id", "c_acctbal", "cast(c_custkey div 30 as double) lat", "cast(c_custkey % 30 as double) lon").withColumn("a", arc)
    return q.where("NOT (c_acctbal < 0 AND a.piece = 7)").selectExpr("osm_id * 8 + a.piece arc_id", "osm_id", "a.geometry geometry")


def map_extract(t) -> DataFrame:
    """``arcs`` as JSON text in the shape of a map extract, one document per square."""
    a = arcs(t).withColumn(
        "geometry",
        F.expr(
            "CASE WHEN bare THEN null ELSE"
            " array(named_struct('lat', lat0, 'lon', lon0), named_struct('lat', lat1, 'lon', lon1)) END"
        ),
    )
    e = a.groupBy("osm_id", "type", "wood").agg(
        F.sort_array(F.collect_list(F.struct("arc", "role", "geometry"))).alias("m")
    )
    return e.select(
        F.expr(
            "to_json(named_struct('elements', array(named_struct('type', type, 'id', osm_id,"
            " 'tags', map('natural', CASE WHEN wood THEN 'wood' ELSE 'water' END),"
            " 'geometry', CASE WHEN type = 'way' THEN flatten(filter(transform(m, z -> z.geometry), z -> z IS NOT NULL)) END,"
            " 'members', CASE WHEN type = 'relation' THEN transform(m, z -> named_struct('role',"
            " z.role, 'geometry', z.geometry)) END))))"
        ).alias("doc")
    )


def samples(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Controls, targets and captions of training samples, keyed by file stem."""
    stem = (
        "concat('tile_', doc_id % 17, '_', doc_id % 26, '_', lpad(doc_id % 3, 2, '0'),"
        " CASE doc_id % 3 WHEN 0 THEN '_full_' ELSE '_half_' END, doc_id) stem"
    )
    return (
        t.documents.selectExpr(stem, "doc_id"),
        t.labels.selectExpr(stem, "doc_id"),
        t.documents.where("lang <> 'de'").selectExpr(stem, "text caption"),
    )


SQL = {
    "raster": f"""
raster AS (
  SELECT y, x,
    CASE k WHEN 1 THEN  88 WHEN 2 THEN 200 WHEN 3 THEN  95 ELSE 120 END + n AS r,
    CASE k WHEN 1 THEN 139 WHEN 2 THEN 200 WHEN 3 THEN 140 ELSE 135 END + n AS g,
    CASE k WHEN 1 THEN 179 WHEN 2 THEN 200 WHEN 3 THEN 185 ELSE 110 END + n AS b
  FROM (SELECT *, CASE
      WHEN y % 40 IN (20,21) AND abs(x - 40 - abs(y % 100 - 50)) <= 9 THEN 2
      WHEN abs(x - 40 - abs(y % 100 - 50)) <= 9 THEN 1
      WHEN (x % 30 - 15)*(x % 30 - 15) + (y % 30 - 15)*(y % 30 - 15) < 10 THEN 3 ELSE 0 END AS k
    FROM (SELECT CAST(o_orderkey // {WIDTH} AS BIGINT) AS y, CAST(o_orderkey % {WIDTH} AS BIGINT) AS x,
                 CAST(floor(o_totalprice) AS BIGINT) % 5 AS n FROM orders)))""",
    "raw_raster": f"""
raw_raster AS (
  SELECT o_orderkey // {WIDTH} AS y, o_orderkey % {WIDTH} AS x,
    CAST(floor(o_totalprice) AS BIGINT) % 200 + 20 AS r,
    CAST(floor(o_totalprice) AS BIGINT) // 7 % 200 + 20 AS g,
    CAST(floor(o_totalprice) AS BIGINT) // 11 % 200 + 20 AS b FROM orders)""",
    "noise_mask": f"""
noise_mask AS (
  SELECT o_orderkey // {WIDTH} AS y, o_orderkey % {WIDTH} AS x FROM orders
  WHERE o_totalprice < 250000)""",
    "size": f"""
size AS (SELECT {WIDTH} AS w, max(o_orderkey) // {WIDTH} + 1 AS h FROM orders)""",
    "tile_files": """
tile_files AS (
  SELECT 'submissions/r' || l_suppkey || '/tile_' || (l_partkey % 17) || '_' || (l_orderkey % 26) ||
         CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN '.jpg' ELSE '.png' END AS path,
    CASE WHEN l_quantity = 50 THEN 512 ELSE 1024 END AS width, 1024 AS height,
    l_orderkey * 10 + l_linenumber AS seq, CAST(trunc(l_extendedprice) AS BIGINT) AS price FROM lineitem)""",
    "tiles": """
tiles AS (
  SELECT l_suppkey AS region, l_partkey % 17 AS col, l_orderkey % 26 AS row,
    CASE WHEN l_quantity = 50 THEN 512 ELSE 1024 END AS width, 1024 AS height,
    l_orderkey * 10 + l_linenumber AS seq, CAST(trunc(l_extendedprice) AS BIGINT) AS price FROM lineitem
  WHERE NOT (l_linenumber = 7 AND l_returnflag = 'R'))""",
    "edit_log": """
edit_log AS (
  SELECT event_id, user_id AS call_id, event_type = 'error' AS failed, value AS secs, ts FROM events)""",
    "quads": """
quads AS (
  SELECT p_partkey // 100 AS walk, p_partkey % 10 AS qx, p_partkey // 10 % 10 AS qy, p_size AS raw FROM part)""",
    "region_tiles": """
region_tiles AS (
  SELECT c_custkey // 100 AS region, c_custkey % 10 AS col, c_custkey // 10 % 10 AS row FROM customer
  WHERE c_acctbal > 1500)""",
    "arcs": """
arcs AS (
  SELECT c_custkey AS osm_id, arc, c_acctbal > 8500 AS wood, c_mktsegment = 'MACHINERY' AND arc = 1 AS bare,
    CASE WHEN c_nationkey % 5 = 4 THEN 'inner' WHEN c_nationkey % 5 = 3 THEN '' ELSE 'outer' END AS role,
    CASE WHEN c_nationkey % 5 = 2 THEN 'way' ELSE 'relation' END AS type,
    CAST(c_custkey // 30 + (CASE WHEN arc IN (1,2) THEN 1 ELSE 0 END)*0.5 AS DOUBLE) AS lat0,
    CAST(c_custkey % 30  + (CASE WHEN arc IN (2,3) THEN 1 ELSE 0 END)*0.5 AS DOUBLE) AS lon0,
    CAST(c_custkey // 30 + (CASE WHEN arc IN (0,1) THEN 1 ELSE 0 END)*0.5 AS DOUBLE) AS lat1,
    CAST(c_custkey % 30  + (CASE WHEN arc IN (1,2) THEN 1 ELSE 0 END)*0.5 AS DOUBLE) AS lon1
  FROM customer CROSS JOIN (SELECT unnest([0,1,2,3]) AS arc)
  WHERE NOT (c_acctbal < 0 AND arc = 2))""",
    "touching": """
touching AS (
  SELECT c_custkey AS osm_id, shape, seq, CAST(c_custkey // 30 AS DOUBLE) + CAST(dlat AS DOUBLE) AS lat, CAST(c_custkey % 30 AS DOUBLE) + CAST(dlon AS DOUBLE) AS lon, size - 1 AS last
  FROM customer CROSS JOIN (VALUES
    (0, 0, 0, 0, 5), (0, 1, 0, 0.5, 5), (0, 2, 0.5, 0.5, 5), (0, 3, 0.5, 0, 5), (0, 4, 0, 0, 5),
    (1, 0, 0, 0, 5), (1, 1, 0.1, 0.2, 5), (1, 2, 0.2, 0.2, 5), (1, 3, 0.2, 0.1, 5), (1, 4, 0, 0, 5),
    (2, 0, -0.25, -0.25, 5), (2, 1, -0.25, 0, 5), (2, 2, 0, 0, 5), (2, 3, 0, -0.25, 5), (2, 4, -0.25, -0.25, 5)) AS v(shape, seq, dlat, dlon, size)
  WHERE NOT (c_acctbal < 0 AND shape = 2))""",
    "samples": """
samples AS (
  SELECT d.doc_id, d.lang, d.text,
    'tile_' || (d.doc_id % 17) || '_' || (d.doc_id % 26) || '_0' || (d.doc_id % 3) ||
    CASE d.doc_id % 3 WHEN 0 THEN '_full_' ELSE '_half_' END || d.doc_id AS stem,
    l.doc_id IS NOT NULL AS labelled
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)""",
}


def with_(*names: str, ctes: str = "", body: str) -> str:
    """One SQL text from named derivations, extra CTE text and a final SELECT."""
    parts = [SQL[n].strip() for n in names]
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body
