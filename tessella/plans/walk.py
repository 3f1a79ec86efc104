"""Dependency-ordered generation of a grid of quadrants.

Tiles of a ``nc`` x ``nr`` grid split into 2 x 2 quadrants. The first tile is made at once, the rest of the top
row and left column in halves, every other quadrant on its own; each call reads finished neighbours. Call ids,
producers and waves have closed forms, so planning needs no shuffle, no sort and no loop. Tables may hold many
walks, told apart by ``walk``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tessella.session import new_path

SEED_BASE, SEED_STEP = 100003, 7919  # fixed values of the seed formula


def split_quads(tiles: DataFrame) -> DataFrame:
    """Each tile as four quadrants ``(qx, qy)`` with their place in the tile."""
    four = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dy in (0, 1) for dx in (0, 1)]))
    t = tiles.select("*", four.alias("d"))
    return t.select(
        *tiles.columns, (F.col("col") * 2 + F.col("d.dx")).alias("qx"), (F.col("row") * 2 + F.col("d.dy")).alias("qy"), "d.dx", "d.dy"
    )


# The closed forms below are SQL expressions, so that one parse builds each of them; x and y may be any expressions.


def producer_sql(x: str = "qx", y: str = "qy") -> str:
    """Id of the call that makes quadrant (x, y)."""
    inner = f"1 + 2*(nc-1) + 2*(nr-1) + (({y} div 2 - 1)*(nc-1) + {x} div 2 - 1)*4 + ({y} % 2)*2 + {x} % 2"
    return (
        f"cast(CASE WHEN {x} < 2 AND {y} < 2 THEN 0 WHEN {y} < 2 THEN 1 + 2*({x} div 2 - 1) + {x} % 2"
        f" WHEN {x} < 2 THEN 1 + 2*(nc-1) + 2*({y} div 2 - 1) + {y} % 2 ELSE {inner} END as bigint)"
    )


def wave_sql(x: str = "qx", y: str = "qy") -> str:
    """Round in which a quadrant can be made: all its sources belong to the two rounds before."""
    return f"cast(greatest({x}, 1) + greatest({y}, 1) - 2 as int)"


def kind_sql(x: str = "qx", y: str = "qy") -> str:
    """Kind of the call that makes a quadrant."""
    return f"CASE WHEN {x} < 2 AND {y} < 2 THEN 'seed' WHEN {y} < 2 THEN 'half_h' WHEN {x} < 2 THEN 'half_v' ELSE 'br' END"


OWN_SLOT = "CASE WHEN qx >= 1 AND qy >= 1 THEN 'br' WHEN qx >= 1 THEN 'tr' WHEN qy >= 1 THEN 'bl' ELSE 'tl' END"


def dependents_sql() -> str:
    """Calls whose window shows the finished quadrant (qx, qy): array of (call_id, kind, wave, slot). At most three."""

    def use(cond, x, y, slot):
        return (
            f"CASE WHEN {cond} AND {x} < 2*nc AND {y} < 2*nr THEN named_struct('call_id', {producer_sql(x, y)},"
            f" 'kind', {kind_sql(x, y)}, 'wave', {wave_sql(x, y)}, 'slot', {slot}) END"
        )

    right, below = "(qx+1)", "(qy+1)"
    uses = [
        use("qy <= 1 AND qx >= 1", right, "qy", "CASE WHEN qy = 0 THEN 'tl' ELSE 'bl' END"),
        use("qx <= 1 AND qy >= 1", "qx", below, "CASE WHEN qx = 0 THEN 'tl' ELSE 'tr' END"),
        use("qx >= 1 AND qy >= 1", right, below, "'tl'"),
        use("qx >= 2 AND qy >= 1", "qx", below, "'tr'"),
        use("qx >= 1 AND qy >= 2", right, "qy", "'bl'"),
    ]
    return f"array_compact(array({', '.join(uses)}))"


def plan_calls(walks: DataFrame) -> DataFrame:
    """Calls ``(walk, call_id, kind, wave, deps, prod, nc, nr)`` of every walk ``(walk, nc, nr)``."""
    rows = walks.selectExpr("walk", "nc", "nr", "explode(sequence(0, nr - 1)) r").repartition("walk", "r")
    cells = rows.selectExpr("walk", "nc", "nr", "r", "explode(sequence(0, nc - 1)) c")
    parts = "CASE WHEN c = 0 AND r = 0 THEN array(0) WHEN c = 0 OR r = 0 THEN array(0, 1) ELSE array(0, 1, 2, 3) END"
    p = cells.selectExpr("walk", "nc", "nr", "r", "c", f"explode({parts}) i")
    # the top-left quadrant that the call makes
    p = p.selectExpr(
        "walk", "nc", "nr",
        "cast(2*c + CASE WHEN r = 0 AND c > 0 THEN i WHEN r > 0 AND c > 0 THEN i % 2 ELSE 0 END as int) qx",
        "cast(2*r + CASE WHEN c = 0 AND r > 0 THEN i WHEN r > 0 AND c > 0 THEN i div 2 ELSE 0 END as int) qy",
    )
    p = p.selectExpr("*", f"{kind_sql()} kind")
    q = lambda x, y: f"struct(cast({x} as int) qx, cast({y} as int) qy)"
    deps = (
        f"CASE kind WHEN 'half_h' THEN array({q('qx-1', 0)}, {q('qx-1', 1)}) WHEN 'half_v' THEN array({q(0, 'qy-1')}, {q(1, 'qy-1')})"
        f" WHEN 'br' THEN array({q('qx-1', 'qy-1')}, {q('qx', 'qy-1')}, {q('qx-1', 'qy')}) ELSE cast(array() as array<struct<qx:int,qy:int>>) END"
    )
    prod = (
        f"CASE kind WHEN 'seed' THEN array({q(0, 0)}, {q(1, 0)}, {q(0, 1)}, {q(1, 1)}) WHEN 'half_h' THEN array({q('qx', 0)}, {q('qx', 1)})"
        f" WHEN 'half_v' THEN array({q(0, 'qy')}, {q(1, 'qy')}) ELSE array({q('qx', 'qy')}) END"
    )
    return p.selectExpr("walk", f"{producer_sql()} call_id", "kind", f"{wave_sql()} wave", f"{deps} deps", f"{prod} prod", "nc", "nr")


def dependency_calls(calls: DataFrame) -> DataFrame:
    """Calls with ``needs``, the distinct calls that they wait for."""
    return calls.selectExpr("*", f"array_distinct(transform(deps, q -> {producer_sql('q.qx', 'q.qy')})) needs")


def dependency_edges(calls: DataFrame) -> DataFrame:
    return dependency_calls(calls).select("walk", F.explode("needs").alias("src"), F.col("call_id").alias("dst"))


def in_degree(calls: DataFrame) -> DataFrame:
    return dependency_calls(calls).select("walk", "call_id", F.size("needs").alias("indeg"))


def call_seed(i: Column) -> Column:
    return F.lit(SEED_BASE) + i * SEED_STEP


def tile_seed(i: Column) -> Column:
    """Seed of independent tile conversions."""
    return F.lit(100) + i * SEED_STEP


def windows(raw: DataFrame, made: DataFrame | None, wave: int | None = None) -> DataFrame:
    """One row per call with the payloads of its 2 x 2 window as columns ``tl, tr, bl, br``: finished neighbours
    from ``made``, raw content where the call will draw (``targets``). Both inputs hold
    ``(walk, nc, nr, qx, qy, payload)``; every quadrant knows its calls, so one grouping does it all."""
    parts = raw.selectExpr(
        "walk", "nc", "nr", f"{producer_sql()} call_id", f"{kind_sql()} kind", f"{wave_sql()} wave", f"{OWN_SLOT} slot",
        f"struct({OWN_SLOT} slot, qx, qy) target", "payload",
    )
    if made is not None:
        used = made.selectExpr("walk", "nc", "nr", "payload", f"explode({dependents_sql()}) u")
        used = used.selectExpr(
            "walk", "nc", "nr", "u.call_id", "u.kind", "u.wave", "u.slot",
            "cast(null as struct<slot:string,qx:int,qy:int>) target", "payload",
        )
        parts = parts.unionByName(used)
    if wave is not None:
        parts = parts.where(f"wave = {wave}")
    slot = [F.expr(f"max(CASE WHEN slot = '{n}' THEN payload END) {n}") for n in ("tl", "tr", "bl", "br")]
    return parts.groupBy("walk", "call_id", "kind", "wave", "nc", "nr").agg(*slot, F.collect_list("target").alias("targets"))


def _done(spark, path: str) -> bool:
    """Whether a step left its mark."""
    try:
        return not spark.read.schema("n int").parquet(path).isEmpty()
    except AnalysisException:
        return False


def _mark(spark, path: str) -> None:
    spark.range(1).selectExpr("cast(id as int) n").write.mode("overwrite").parquet(path)


def run_walk(raw: DataFrame, editor, path: str | None = None) -> DataFrame:
    """Make all quadrants ``(walk, nc, nr, qx, qy, payload)``, wave by wave.

    ``editor`` changes the window columns ``tl, tr, bl, br`` of each call (``QuadEditor`` for an image editor). The raw quadrants
    are written once, partitioned by wave, so that each wave reads only its own share. Every wave of all walks is one job that
    reads the two waves before it and writes its own partition to the shared folder: a lost executor costs a retry of its
    tasks, and a stopped run with the same ``path`` goes on after the waves that are done. A failed call stops the run with an
    error that names it; what is done stays, so the run can be tried again."""
    spark = raw.sparkSession
    path = path or new_path(spark, "walk")
    quads = raw.select("walk", F.col("nc").cast("int"), F.col("nr").cast("int"), F.col("qx").cast("int"), F.col("qy").cast("int"), "payload")
    types = dict(quads.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in quads.columns)
    if not _done(spark, f"{path}/done/raw"):
        staged = quads.withColumn("wave", F.expr(wave_sql()))
        staged.hint("rebalance", "wave").write.mode("overwrite").partitionBy("wave").parquet(f"{path}/raw")
        _mark(spark, f"{path}/done/raw")
    last = spark.read.schema(schema + ", wave int").parquet(f"{path}/raw").agg(F.max("wave")).first()[0]
    if last is None:
        return quads.limit(0)
    for wave in range(last + 1):
        if _done(spark, f"{path}/done/wave={wave}"):
            continue
        near = [f"{path}/wave={w}" for w in (wave - 2, wave - 1) if w >= 0]
        made = spark.read.schema(schema).parquet(*near) if near else None
        win = windows(spark.read.schema(schema).parquet(f"{path}/raw/wave={wave}"), made, wave)
        out = editor.apply(win)
        status = F.col("status") if "status" in out.columns else F.lit("ok")
        out = out.select("walk", "call_id", "nc", "nr", F.explode("targets").alias("t"), "tl", "tr", "bl", "br", status.alias("status"))
        cell = F.expr("CASE t.slot WHEN 'tl' THEN tl WHEN 'tr' THEN tr WHEN 'bl' THEN bl ELSE br END")
        made = out.select("walk", "nc", "nr", "t.qx", "t.qy", cell.alias("payload"), "call_id", F.when(F.col("status") != "ok", F.col("status")).when(cell.isNull(), "no image").otherwise("ok").alias("status"))
        made.write.mode("overwrite").parquet(f"{path}/wave={wave}")
        bad = spark.read.schema(made.schema).parquet(f"{path}/wave={wave}").where("status <> 'ok'").select("walk", "call_id", "status").limit(5).collect()
        if bad:
            raise RuntimeError(f"wave {wave} stopped: " + "; ".join(f"walk {b.walk} call {b.call_id}: {b.status}" for b in bad))
        _mark(spark, f"{path}/done/wave={wave}")
    return spark.read.schema(schema).parquet(*[f"{path}/wave={w}" for w in range(last + 1)])


def assemble_quads(pixels: DataFrame, quad: int) -> DataFrame:
    """Pixels of quadrants ``(qx, qy, y, x, …)`` on the canvas."""
    rest = [c for c in pixels.columns if c not in ("qx", "qy", "y", "x")]
    return pixels.select(
        (F.col("qy") * quad + F.col("y")).alias("y"), (F.col("qx") * quad + F.col("x")).alias("x"), *rest
    )
