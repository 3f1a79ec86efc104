"""Orders over irregular tile sets, and edits of boxes inside a finished canvas."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import color as C
from tessella.operators import grid as G
from tessella.operators import mosaic as M
from tessella.operators.graph import components, ranked
from tessella.operators.regions import median_by
from tessella.plans import arrays
from tessella.session import discard, new_path, save


def tile_components(tiles: DataFrame, by: str) -> DataFrame:
    """Connected tile sets (4 neighbours) of each ``by``; ``comp`` is the smallest cell of the set."""
    # vertices are numbered densely in the order of (by, col, row), so any columns, rows and regions do
    t = save(ranked(tiles.select(by, "col", "row").distinct(), [], [by, "col", "row"], "v"), "cells")
    step = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((1, 0), (0, 1))]))
    nb = t.select(by, "col", "row", F.col("v").alias("u"), step.alias("s")).select(
        by, (F.col("col") + F.col("s.dx")).alias("col"), (F.col("row") + F.col("s.dy")).alias("row"), "u"
    )
    edges = nb.join(t.select(by, "col", "row", "v"), [by, "col", "row"]).select("u", "v")
    roots = components(edges).select(F.col("id").alias("v"), "root")
    return t.join(roots, "v", "left").select(by, "col", "row", "v", F.coalesce("root", "v").alias("comp"))


#: East, west, south, north: the order in which the neighbours of a tile are taken.
STEPS = ((1, 0, "0"), (-1, 0, "1"), (0, 1, "2"), (0, -1, "3"))


def _near_blocks(cells: DataFrame, reach: int, block: int) -> DataFrame:
    """Each cell once for every block that has cells within ``reach`` of it, as ``(bc, br)``."""
    to = lambda c: F.explode(F.sequence(F.floor((F.col(c) - reach) / block), F.floor((F.col(c) + reach) / block)))
    return cells.withColumn("bc", to("col")).withColumn("br", to("row"))


def _spread(by: str, level: int, reach: int, block: int):
    """The search inside one block and its surroundings, ``reach`` levels on from the tiles of ``level``."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cells = list(zip(pdf["col"].tolist(), pdf["row"].tolist()))
        state, paths = pdf["state"].tolist(), pdf["path"].tolist()
        barred = {c for c, s in zip(cells, state) if s}
        free = set(cells) - barred
        front = {c: p for c, p, s in zip(cells, paths, state) if s == 2}
        bc, br = int(pdf["bc"].iloc[0]), int(pdf["br"].iloc[0])
        found = []
        for at in range(level + 1, level + reach + 1):
            nxt: dict = {}
            for (x, y), p in front.items():
                for dx, dy, k in STEPS:
                    c = (x + dx, y + dy)
                    if c in free and (c not in nxt or p + k < nxt[c]):
                        nxt[c] = p + k
            if not nxt:
                break
            free.difference_update(nxt)
            found += [(*c, p, at) for c, p in nxt.items() if c[0] // block == bc and c[1] // block == br]
            front = nxt
        out = pd.DataFrame(found, columns=["col", "row", "path", "level"])
        out.insert(0, by, pdf[by].iloc[0])
        return out

    return run


NEAR_TILES = 32_000  # tiles of one block of the search, which sees nine blocks at most
REACH = (32, 64, 128, 256, 512, 1024)


def reach_of(tiles: DataFrame, by: str) -> int:
    """The largest edge of ``REACH`` at which no block holds more than ``NEAR_TILES`` tiles, at most a quarter of the extent of the sets; the first always does.
    Thin sets are long and have few tiles a block."""
    span = F.greatest(*[F.max(c) - F.min(c) for c in ("col", "row")])
    extent = tiles.groupBy(by).agg(span.alias("n")).agg(F.max("n")).first()[0] or 0
    some = [k for k in REACH if k == REACH[0] or 4 * k <= extent]
    if len(some) == 1:
        return some[0]
    at = lambda k: F.struct(F.lit(k).alias("k"), *[F.floor(F.col(c) * REACH[0] / k).alias(c) for c in ("col", "row")])
    few = tiles.groupBy(by, *[F.floor(F.col(c) / REACH[0]).alias(c) for c in ("col", "row")]).agg(F.count("*").alias("n"))
    blocks = few.select(by, "n", F.explode(F.array(*map(at, some))).alias("b")).groupBy(by, "b").agg(F.sum("n").alias("n"))
    full = [r.k for r in blocks.groupBy("b.k").agg(F.max("n").alias("n")).where(F.col("n") > NEAR_TILES).collect()]
    return max(k for k in some if k == REACH[0] or k < min(full, default=k + 1))


def bfs_order(tiles: DataFrame, by: str, renumber: int | None = None) -> DataFrame:
    """Breadth-first order per ``by``: components by their smallest (col, row), then level by level; inside a level
    by the place of the earliest parent, then east, west, south, north. Columns: level, idx (from 0).

    A round goes ``renumber`` levels on (by default as far as its blocks stay small): what a tile becomes depends on tiles at most that many steps away, so each block of that edge
    searches alone among its own tiles and those around it (three by three blocks at most). The place inside a level is kept as text: the
    path of directions, which sorts the same way and is replaced by a rank after every round to stay short."""
    spark = tiles.sparkSession
    t = save(tile_components(tiles, by), "tiles")
    renumber = renumber or reach_of(t, by)
    block = max(renumber, 8)
    types = dict(t.dtypes)
    schema = f"{by} {types[by]}, col {types['col']}, row {types['row']}, path string, level int"
    root = new_path(spark, "levels")
    key = [by, "col", "row"]
    own = t.select(by, F.floor(F.col("col") / block).alias("bc"), F.floor(F.col("row") / block).alias("br")).distinct()
    nxt = t.where("v = comp").select(*key, F.lit("").alias("path"), F.lit(0).alias("level"))
    nxt.write.parquet(f"{root}/part=0")
    front, back, level, part = spark.read.schema(schema).parquet(f"{root}/part=0"), None, 0, 0
    while not front.isEmpty():
        # the tiles of the last level go on; those of the level before are the only ones behind that touch them
        known = front.select(*key, "path", F.lit(2).alias("state"))
        if back is not None:
            known = known.unionByName(back.select(*key, "path", F.lit(1).alias("state")))
        active = _near_blocks(front, renumber, block).select(by, "bc", "br").distinct().join(own, [by, "bc", "br"], "left_semi")
        rows = known.unionByName(t.select(*key, F.lit("").alias("path"), F.lit(0).alias("state")))
        rows = _near_blocks(rows, renumber, block).join(active, [by, "bc", "br"], "left_semi")
        part += 1
        rows.groupBy(by, "bc", "br").applyInPandas(_spread(by, level, renumber, block), schema).write.parquet(f"{root}/part={part}")
        level += renumber
        new = spark.read.schema(schema).parquet(f"{root}/part={part}")
        back = new.where(F.col("level") == level - 1)
        front = ranked(new.where(F.col("level") == level), [by], ["path", "col", "row"], "rank")
        front = save(front.select(*key, F.lpad(F.col("rank").cast("string"), 19, "0").alias("path")), "front")
    out = spark.read.schema(schema).parquet(*[f"{root}/part={i}" for i in range(part + 1)]).join(t.select(*key, "comp"), key)
    return ranked(out, [by], ["comp", "level", "path"]).select(*key, "level", "idx")


def _settle(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rounds of the jobs of one block, by their ids: a job waits only for earlier ones, so one pass settles what the block knows."""
    wave = dict(zip(pdf["box_id"].tolist(), pdf["wave"].tolist()))
    was = dict(wave)
    w = pdf[pdf["gap"] >= 0].sort_values("box_id")
    for box, on, gap, seen in zip(w["box_id"].tolist(), w["on"].tolist(), w["gap"].tolist(), w["on_wave"].tolist()):
        wave[box] = max(wave[box], wave.get(on, seen) + gap)
    return pd.DataFrame({"box_id": list(wave), "block": pdf["block"].iloc[0], "wave": list(wave.values()), "moved": [wave[b] > was[b] for b in wave]})


def rounds(jobs: DataFrame, waits: DataFrame) -> DataFrame:
    """Round of each job ``(box_id, block)`` that must run at least ``gap`` rounds after each earlier job in ``waits (box_id, on, gap)``: the
    longest chain before it. Every block of jobs settles its own chains at once from what it knows of the others, until nothing moves: a chain
    costs as many turns as it changes blocks."""
    state = held = save(jobs.where("box_id IS NOT NULL").select("box_id", F.col("block").cast("string").alias("block"), F.lit(0).alias("wave"), F.lit(True).alias("moved")), "rounds")
    none = [F.col("box_id").alias("on"), F.lit(-1).alias("gap"), F.lit(0).alias("on_wave")]
    types = dict(state.dtypes)
    while True:
        on = state.select(F.col("box_id").alias("on"), F.col("wave").alias("on_wave"))
        own = waits.join(on, "on").join(state.drop("moved"), "box_id").select("box_id", "block", "wave", "on", "gap", "on_wave")
        rows = own.unionByName(state.select("box_id", "block", "wave", *none))
        nxt = save(rows.groupBy("block").applyInPandas(_settle, f"box_id {types['box_id']}, block string, wave int, moved boolean"), "rounds")
        discard(held)
        state = held = nxt
        if nxt.where("moved").isEmpty():
            return state.select("box_id", "wave")


def box_waits(windows: DataFrame, block: int) -> DataFrame:
    """``(box_id, on, gap)``: if the window of a box shows an earlier box, that must be finished one round before; if the window
    of the earlier box ``on`` shows the later one, the later one must not run in a round before it. Both sides meet on the
    blocks that they touch."""

    def on_blocks(df, x0, y0, x1, y1):
        seq = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / block), F.floor((F.col(hi) - 1) / block)))
        return df.withColumn("kx", seq(x0, x1)).withColumn("ky", seq(y0, y1))

    sees = on_blocks(windows.select(F.col("box_id").alias("a"), "wx0", "wy0", "wx1", "wy1"), "wx0", "wy0", "wx1", "wy1")
    shown = on_blocks(windows.select(F.col("box_id").alias("b"), "x0", "y0", "x1", "y1"), "x0", "y0", "x1", "y1")
    meet = (F.col("a") != F.col("b")) & (F.col("x0") < F.col("wx1")) & (F.col("x1") > F.col("wx0")) & (F.col("y0") < F.col("wy1")) & (F.col("y1") > F.col("wy0"))
    pairs = sees.join(shown, ["kx", "ky"]).where(meet)
    gap = (F.col("a") > F.col("b")).cast("int")  # the later box looks back: one round; the earlier one looks ahead: none
    return pairs.select(F.greatest("a", "b").alias("box_id"), F.least("a", "b").alias("on"), gap.alias("gap")).groupBy("box_id", "on").agg(F.max("gap").alias("gap"))


AREA = 32  # windows along the edge of the areas in which jobs are ordered
TASK_PIXELS = 500_000  # pixels of windows in one task of a round
AREA_PIXELS = 2_000_000  # pixels of the areas whose boxes one task edits one after another
FEW_CELLS = 50_000  # cells of windows that may be broadcast


def area_sides(w: int, h: int, win: int, pixels: int) -> tuple[int, int]:
    """Edges (across, down) of areas of about so many pixels, in whole windows: square, or longer along a canvas narrower than that."""
    n = max(pixels // (win * win), 1)
    across, down = max(-(-w // win), 1), max(-(-h // win), 1)
    cols = min(across, max(math.isqrt(n), n // down, 1))
    return cols * win, max(n // cols, 1) * win


def _ordered(flat: np.ndarray, size: int, v: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Order in which pixels are written so that of several at one place the largest (r, g, b), nulls first, comes last."""
    seen = np.zeros(size, bool)
    seen[flat] = True
    if seen.sum() == len(flat):
        return np.arange(len(flat))
    return np.lexsort([k for c in (2, 1, 0) for k in (v[c], known[c])])


def _edit_area(steps: dict, win: int, feather: int, ah: int, aw: int):
    """Edits of one area: its boxes one after another, by their ids, on the canvas as it then is."""

    def run(px: pa.Table, boxes: pa.Table) -> pa.Table:
        out = pa.schema([(c, pa.int64()) for c in ("y", "x", *"rgb")] + [("prio", pa.int32())])
        if not boxes.num_rows or not px.num_rows:
            return out.empty_table()
        jobs = sorted(boxes.to_pylist(), key=lambda j: j["box_id"])
        top, left = min(j["wy0"] for j in jobs), min(j["wx0"] for j in jobs)
        hh, ww = max(j["wy0"] for j in jobs) + win - top, max(j["wx0"] for j in jobs) + win - left
        y = px["y"].to_numpy() + (jobs[0]["ay"] * ah - top)
        x = px["x"].to_numpy() + (jobs[0]["ax"] * aw - left)
        ok = (y >= 0) & (y < hh) & (x >= 0) & (x < ww)
        flat, prio = (y * ww + x)[ok], px["prio"].to_numpy()[ok]
        v = np.stack([px[c].fill_null(0).to_numpy() for c in "rgb"])[:, ok].astype(np.int64)
        known = np.stack([px[c].is_valid().to_numpy() for c in "rgb"])[:, ok]
        layer = {}
        for raw in (False, True):  # the canvas with what was made on it so far, and the second capture
            val, good, has = np.zeros((3, hh * ww), np.int64), np.ones((3, hh * ww), bool), np.zeros(hh * ww, bool)
            for p in np.unique(prio[(prio == -2) == raw]):
                at = np.flatnonzero(prio == p)
                at = at[_ordered(flat[at], hh * ww, v[:, at], known[:, at])]
                val[:, flat[at]], good[:, flat[at]], has[flat[at]] = v[:, at], known[:, at], True
            layer[raw] = val.reshape(3, hh, ww), good.reshape(3, hh, ww), has.reshape(hh, ww)
        (val, good, has), (rval, rgood, rhas) = layer[False], layer[True]
        made = np.zeros((hh, ww), bool)
        gy, gx = np.mgrid[0:win, 0:win]
        for j in jobs:
            y0, x0 = j["wy0"] - top, j["wx0"] - left
            by0, by1, bx0, bx1 = (j[c] for c in ("by0", "by1", "bx0", "bx1"))
            inner = slice(max(by0, 0), max(min(by1, win), 0)), slice(max(bx0, 0), max(min(bx1, win), 0))
            sl = slice(y0, y0 + win), slice(x0, x0 + win)
            under, uknown = val[:, *sl], good[:, *sl]
            shown, sknown, here = under.copy(), uknown & has[sl], has[sl].copy()
            shown[~sknown] = 0
            ri = rhas[sl][inner]
            here[inner] |= ri
            if not here[inner].any():
                continue
            take = ri & rgood[:, *sl][:, *inner]
            np.copyto(shown[:, *inner], rval[:, *sl][:, *inner], where=take)
            sknown[:, *inner] |= take
            d = np.minimum(np.minimum(gx - bx0, gy - by0), np.minimum(bx1 - 1 - gx, by1 - 1 - gy))
            edge = d[inner] < 2
            for c, name in enumerate("rgb"):
                if j.get("f" + name) is not None:
                    shown[c][inner], sknown[c][inner] = j["f" + name], True
                shown[c][inner][edge], sknown[c][inner][edge] = C.RED[c], True
            n = int(here.sum())
            whole = n == here.size
            pick = (lambda a: a.ravel()) if whole else (lambda a: a[here])  # noqa: B023
            cols = {c: (np.asarray(j[c], np.int64), None) for c in ("box_id", "bx0", "by0", "bx1", "by1")}
            cols |= {"ox": (np.asarray(j["wx0"], np.int64), None), "oy": (np.asarray(j["wy0"], np.int64), None), "y": (pick(gy), None), "x": (pick(gx), None)}
            for c, name in enumerate("rgb"):
                k = pick(sknown[c])
                cols[name] = pick(shown[c]), None if k.all() else k
            put = here[inner]
            a = np.where(d[inner] < feather, np.floor((d[inner] + 1) * 255 / (feather + 1)).astype(np.int64), 255)
            for c, name in enumerate("rgb"):
                new, k = arrays.value(steps[name], cols)
                full = np.zeros(here.shape, new.dtype)
                full[here] = new
                sure = np.zeros(here.shape, bool)
                sure[here] = True if k is None else k
                u = under[c][inner]
                mixed = np.floor((full[inner] * a + u * (255 - a)) / 255.0).astype(np.int64)
                sure = sure[inner] & uknown[c][inner] & has[sl][inner]
                np.copyto(u, mixed, where=put)
                np.copyto(uknown[c][inner], sure, where=put)
            has[sl][inner] |= put
            made[sl][inner] |= put
        py, px_ = np.nonzero(made)
        rgb = [pa.array(val[c][made], mask=~good[c][made]) for c in range(3)]
        return pa.Table.from_arrays([pa.array(py + top), pa.array(px_ + left), *rgb, pa.array(np.full(len(py), jobs[0]["turn"], np.int32))], schema=out)

    return run


def _edit_areas(layers: DataFrame, b: DataFrame, waits: DataFrame, steps: dict, win: int, feather: int, w: int, h: int, path: str) -> DataFrame | None:
    """What boxes with windows ``b`` make of the canvas, as patches ``(y, x, r, g, b, prio)``, or None if there are no boxes.

    Boxes belong to areas, and one task edits those of an area by their ids until it needs what another area has not made yet: a chain of boxes
    costs as many turns as it changes areas. A turn reads the pixels of its areas and the patches of those turns that its windows show."""
    spark = b.sparkSession
    aw, ah = area_sides(w, h, win, AREA_PIXELS)
    sw, sh = area_sides(w, h, win, max(16 * AREA_PIXELS, (AREA * win) ** 2))
    long = lambda c: F.col(c).cast("long").alias(c)
    b = b.withColumn("ax", F.floor(F.col("x0") / aw)).withColumn("ay", F.floor(F.col("y0") / ah))
    own = lambda c, n: b.select(F.col("box_id").alias(c), F.struct("ax", "ay").alias(n))
    # inside an area the ids settle the order; another area must be a turn ahead
    chain = waits.join(own("box_id", "mine"), "box_id").join(own("on", "other"), "on")
    chain = save(chain.select("box_id", "on", F.when(F.col("mine") == F.col("other"), 0).otherwise(F.col("gap")).alias("gap")), "chain")
    place = F.struct(F.floor(F.col("x0") / sw), F.floor(F.col("y0") / sh))
    turns = rounds(b.select("box_id", place.alias("block")), chain).withColumnRenamed("wave", "turn")
    b = save(b.join(turns, "box_id"), "turns")
    first = b.groupBy("ax", "ay").agg(F.min("turn").alias("first"))
    blocks = lambda lo, hi, name: f"explode(sequence(floor({lo} / {win}), floor(({hi} - 1) / {win}))) {name}"
    cells = b.selectExpr("*", blocks("wx0", "wx1", "kx")).selectExpr("*", blocks("wy0", "wy1", "ky"))
    boxed = F.expr(f"x0 < (kx + 1) * {win} AND x1 > kx * {win} AND y0 < (ky + 1) * {win} AND y1 > ky * {win}")
    cells = save(cells.groupBy("turn", "ax", "ay", "kx", "ky").agg(F.max(boxed).alias("boxed")), "cells")
    # numbers of turns, of which the loop below is made anyway
    size = {r.turn: (r.n, r.areas) for r in cells.groupBy("turn").agg(F.count("*").alias("n"), F.countDistinct("ax", "ay").alias("areas")).collect()}
    if not size:
        return None
    turn_of = lambda c, t: b.select(F.col("box_id").alias(c), F.col("turn").alias(t))
    shows = waits.where("gap = 1").join(turn_of("box_id", "turn"), "box_id").join(turn_of("on", "before"), "on").where("before < turn")
    shows = {r.turn: sorted(r.before) for r in shows.groupBy("turn").agg(F.collect_set("before").alias("before")).collect()}
    parts = b.join(first, ["ax", "ay"]).groupBy("turn").agg(F.collect_set("first").alias("first")).collect()
    parts = {r.turn: sorted(r.first) for r in parts}
    small = lambda df, n: F.broadcast(df) if n <= FEW_CELLS else df.hint("merge")
    at = [F.floor(F.col("y") / win).alias("ky"), F.floor(F.col("x") / win).alias("kx")]
    here = ["ax", "ay", (F.col("y") - F.col("ay") * ah).cast("int").alias("y"), (F.col("x") - F.col("ax") * aw).cast("int").alias("x"), *[long(c) for c in "rgb"], F.col("prio").cast("int").alias("prio")]
    seen = cells.groupBy("ax", "ay", "kx", "ky").agg(F.max("boxed").alias("boxed")).join(first, ["ax", "ay"])
    px = layers.select("*", *at).join(small(seen, sum(n for n, _ in size.values())), ["ky", "kx"]).where("prio <> -2 OR boxed")
    px = px.select(*here, F.col("first").alias("part"))
    px.hint("rebalance", "part").write.partitionBy("part").parquet(f"{path}/pixels")
    px_schema = px.drop("part").schema
    kept = ["ax", "ay", "turn", "box_id", "wx0", "wy0", "bx0", "by0", "bx1", "by1", *[c for c in ("fr", "fg", "fb") if c in b.columns]]
    jobs = b.select(*[long(c) for c in kept], F.col("turn").alias("part"))
    jobs.write.partitionBy("part").parquet(f"{path}/jobs")
    cells.withColumn("part", F.col("turn")).write.partitionBy("part").parquet(f"{path}/cells")
    schema = "y long, x long, r long, g long, b long, prio int"
    run, done = _edit_area(steps, win, feather, ah, aw), []
    for turn in range(max(size) + 1):
        if turn not in size:
            done.append(None)
            continue
        n, areas = size[turn]
        todo = spark.read.schema(jobs.drop("part").schema).parquet(f"{path}/jobs/part={turn}")
        near = spark.read.schema(cells.schema).parquet(f"{path}/cells/part={turn}")
        px = spark.read.schema(px_schema).parquet(*[f"{path}/pixels/part={f}" for f in parts[turn]])
        px = px.join(small(near.select("ax", "ay").distinct(), n), ["ax", "ay"], "left_semi")
        if turn in shows:
            patches = spark.read.schema(schema).parquet(*[done[t] for t in shows[turn]])
            px = px.unionByName(patches.select("*", *at).join(small(near, n), ["ky", "kx"]).select(*here))
        px, todo = (df.repartition(areas, "ax", "ay").groupBy("ax", "ay") for df in (px, todo))
        done.append(f"{path}/turn={turn}")
        px.cogroup(todo).applyInArrow(run, schema).write.parquet(done[-1])
    return spark.read.schema(schema).parquet(*[d for d in done if d])



def edit_boxes(
    canvas: DataFrame, boxes: DataFrame, editor, win: int, feather: int, w: int, h: int, raw: DataFrame | None = None, fill: DataFrame | None = None
) -> DataFrame:
    """Re-make boxes ``(box_id, x0, y0, x1, y1)`` of a canvas in the order of their ids.

    A ``win`` x ``win`` window around each box shows the current canvas, in the box the ``raw`` capture, a ``fill``
    colour ``(box_id, fr, fg, fb)`` or the canvas itself, and a red outline. ``editor`` gets the window pixels
    ``(box_id, y, x, r, g, b, …)``; its result is feathered into the canvas inside the box. Later windows see
    earlier results and never later ones: boxes run in rounds; those of a round do not see what the others make, and no box
    runs before an earlier one whose window shows it. A box larger than the window is an error. The canvas is read
    once, cut into windows by round; a round reads its own windows and the patches of those rounds that they show."""
    spark = canvas.sparkSession
    if not boxes.where((F.col("x1") - F.col("x0") > win) | (F.col("y1") - F.col("y0") > win)).isEmpty():
        raise ValueError(f"a box is larger than the window of {win} pixels")
    b = G.context_window(boxes.select("box_id", "x0", "y0", "x1", "y1"), win, w, h)
    b = save(b.withColumn("wx1", F.col("wx0") + win).withColumn("wy1", F.col("wy0") + win), "boxes")
    waits = save(box_waits(b, win), "waits")
    rgb = ["r", "g", "b"]
    layers = canvas.select("y", "x", *rgb, F.lit(-1).alias("prio"))
    if raw is not None:
        layers = layers.unionByName(raw.select("y", "x", *rgb, F.lit(-2).alias("prio")))
    path = new_path(spark, "edit")
    steps = editor.on_arrays(spark) if hasattr(editor, "on_arrays") and _whole_numbers(layers, b, fill) else None
    if steps is not None and b.groupBy("box_id").count().where("box_id IS NOT NULL AND count > 1").isEmpty():
        own = b.where("box_id IS NOT NULL AND " + " AND ".join(f"{c} IS NOT NULL" for c in ("x0", "y0", "x1", "y1")))
        if fill is not None:
            own = own.join(fill.select("box_id", "fr", "fg", "fb"), "box_id", "left")
        patches = _edit_areas(layers, own, waits, steps, win, feather, w, h, path)
        return canvas.select("y", "x", *rgb) if patches is None else _patched(canvas, patches)
    place = F.struct(*[F.floor(F.col(c) / (AREA * win)) for c in ("x0", "y0")])  # jobs near each other settle their order together
    b = b.join(rounds(b.select("box_id", place.alias("block")), waits), "box_id")
    key = ["box_id", "wave", "bx0", "by0", "bx1", "by1"]
    if fill is not None:
        b, key = b.join(fill.select("box_id", "fr", "fg", "fb"), "box_id", "left"), [*key, "fr", "fg", "fb"]
    b.write.parquet(f"{path}/rounds")
    b = spark.read.schema(b.schema).parquet(f"{path}/rounds")
    size = {r.wave: r.n for r in b.groupBy("wave").agg(F.count("*").alias("n")).collect()}
    if not size:
        return canvas.select("y", "x", *rgb)
    wave_of = lambda c, w: b.select(F.col("box_id").alias(c), F.col("wave").alias(w))
    # rounds whose results a round shows: pairs of rounds, of which the loop below is made anyway
    shows = waits.where("gap = 1").join(wave_of("box_id", "wave"), "box_id").join(wave_of("on", "before"), "on")
    shows = {r.wave: sorted(r.before) for r in shows.groupBy("wave").agg(F.collect_set("before").alias("before")).collect()}
    b = b.selectExpr("*", "wx0 ox", "wy0 oy")
    key += ["ox", "oy"]
    inside = (F.col("x") >= F.col("bx0")) & (F.col("x") < F.col("bx1")) & (F.col("y") >= F.col("by0")) & (F.col("y") < F.col("by1"))
    # The number of the round is a column of the files too: as a literal it would make each round a plan to be compiled anew. For the same reason
    # expressions are built here, once for all rounds.
    staged = G.extract_window(layers, b, key, win).where((F.col("prio") != -2) | inside)
    staged.withColumn("part", F.col("wave")).hint("rebalance", "part").write.partitionBy("part").parquet(f"{path}/windows")
    blocks = lambda lo, hi, name: f"explode(sequence(floor({lo} / {win}), floor(({hi} - 1) / {win}))) {name}"
    seen = b.select(*key, "wx1", "wy1").selectExpr("*", blocks("ox", "wx1", "pbx")).selectExpr("*", blocks("oy", "wy1", "pby"))
    seen.withColumn("part", F.col("wave")).write.partitionBy("part").parquet(f"{path}/boxes")
    at = [*key, "y - oy y", "x - ox x", *rgb, "prio"]
    top = F.struct("prio", *rgb)
    newest = [F.max(F.when(F.col("prio") != -2, top)).alias("under"), F.max(F.when(F.col("prio") == -2, top)).alias("raw")]
    shown = [F.coalesce(f"raw.{c}", f"under.{c}") for c in rgb]
    if fill is not None:
        shown = [F.when(inside, F.coalesce("f" + c, s)).otherwise(s) for c, s in zip(rgb, shown)]
    edge = C.on_outline(F.col("bx0"), F.col("by0"), F.col("bx1"), F.col("by1"))
    shown = [F.when(edge, v).otherwise(s.cast("long")).cast("long").alias(c) for c, s, v in zip(rgb, shown, C.RED)]
    kept = inside & (F.col("status") == "ok")
    d = F.least(F.col("x") - F.col("bx0"), F.col("y") - F.col("by0"), F.col("bx1") - 1 - F.col("x"), F.col("by1") - 1 - F.col("y"))
    a = C.ring_feather(d, feather)
    y, x = (F.col("y") + F.col("oy")).cast("long"), (F.col("x") + F.col("ox")).cast("long")
    patch = [
        y.alias("y"), x.alias("x"),
        *[F.floor((F.col(c) * a + F.col(f"under.{c}") * (255 - a)) / F.lit(255)).cast("long").alias(c) for c in rgb],
        # boxes of one round may overlap without seeing each other only if neither window shows the other box
        F.col("wave").cast("int").alias("prio"), F.floor(x / win).alias("pbx"), F.floor(y / win).alias("pby"),
    ]
    patch_schema = "y long, x long, r long, g long, b long, prio int, pbx long, pby long"
    done = []
    for wave in range(max(size) + 1):
        px = spark.read.schema(staged.schema).parquet(f"{path}/windows/part={wave}")
        if wave in shows:
            boxed = spark.read.schema(seen.schema).parquet(f"{path}/boxes/part={wave}")
            patches = spark.read.schema(patch_schema).parquet(*[done[w] for w in shows[wave]])
            px = px.union(patches.join(boxed, ["pby", "pbx"]).where("x >= ox AND x < wx1 AND y >= oy AND y < wy1").selectExpr(*at))
        tasks = -(-size[wave] * win * win // TASK_PIXELS)  # one shuffle serves the window's other steps too
        px = px.repartition(tasks, "box_id").groupBy(*key, "y", "x").agg(*newest).select(*key, "y", "x", "under", *shown)
        done.append(f"{path}/wave={wave}")
        editor.apply(px).where(kept).select(*patch).write.parquet(done[-1])
    return _patched(canvas, spark.read.schema(patch_schema).parquet(*done))


def _patched(canvas: DataFrame, patches: DataFrame) -> DataFrame:
    """The canvas with the newest patch of each pixel."""
    newest = patches.groupBy("y", "x").agg(F.max(F.struct("prio", "r", "g", "b")).alias("p"))
    return canvas.join(newest.hint("merge"), ["y", "x"], "left").select("y", "x", *[F.coalesce(f"p.{c}", c).alias(c) for c in "rgb"])


def _whole_numbers(layers: DataFrame, boxes: DataFrame, fill: DataFrame | None) -> bool:
    """Whether places, colours and boxes are whole numbers."""
    types = [t for _, t in layers.dtypes] + [t for c, t in boxes.dtypes if c in ("box_id", "x0", "y0", "x1", "y1")]
    types += [t for c, t in fill.dtypes if c in ("fr", "fg", "fb")] if fill is not None else []
    return all(t in ("tinyint", "smallint", "int", "bigint") for t in types)


def tile_boxes(order: DataFrame, tile: int, ox: int = 0, oy: int = 0) -> DataFrame:
    """Boxes of tiles ``(col, row, idx)``, to be edited in the order of ``idx``."""
    x0, y0 = F.col("col") * tile + ox, F.col("row") * tile + oy
    return order.select(F.col("idx").alias("box_id"), x0.alias("x0"), y0.alias("y0"), (x0 + tile).alias("x1"), (y0 + tile).alias("y1"))


def river_walk(
    canvas: DataFrame, raw: DataFrame, order: DataFrame, editor, tile: int, feather: int, w: int, h: int, blue_limit: float | None = None
) -> DataFrame:
    """Re-make listed tiles ``(col, row, idx)`` one after another in breadth-first order, each inside a window of
    the canvas as it then is. Tiles that leave the canvas are dropped; with ``blue_limit`` also those whose share of blue
    pixels on the given canvas is above it."""
    boxes = tile_boxes(order, tile).where((F.col("x0") >= 0) & (F.col("y0") >= 0) & (F.col("x1") <= w) & (F.col("y1") <= h))
    if blue_limit is not None:
        cell = canvas.select(F.floor(F.col("x") / tile).alias("c"), F.floor(F.col("y") / tile).alias("q"), "r", "g", "b")
        dry = G.drop_already_blue(cell, C.is_walk_blue(), ["c", "q"], blue_limit)
        boxes = boxes.join(dry.select((F.col("c") * tile).alias("x0"), (F.col("q") * tile).alias("y0")), ["x0", "y0"], "left_semi")
    return edit_boxes(canvas, boxes, editor, 2 * tile, feather, w, h, raw=raw)


def infill_regions(
    canvas: DataFrame, boxes: DataFrame, editor, win: int, feather: int, w: int, h: int, prefill: bool = False, ring: int = 40
) -> DataFrame:
    """Re-make boxes from their surroundings; with ``prefill`` the box first gets the ground colour around it."""
    fill = save(prefill_color(canvas, boxes, ring, block=win, frame=(win, w, h)), "fill") if prefill else None
    return edit_boxes(canvas, boxes, editor, win, feather, w, h, fill=None if fill is None else fill.select("box_id", "fr", "fg", "fb"))


def prefill_color(
    pixels: DataFrame, boxes: DataFrame, ring: int = 40, least: int = 50, fallback=C.GROUND, block: int = 256, frame: tuple[int, int, int] | None = None
) -> DataFrame:
    """Ground colour around each box ``(box_id, x0, y0, x1, y1)``: median of the non-blue pixels in a ring of
    ``ring`` pixels, or ``fallback`` when there are at most ``least`` of them. With ``frame`` (window, w, h) the ring ends
    where the box's context window does."""
    boxes = boxes.select("box_id", "x0", "y0", "x1", "y1")
    free = [F.lit(None).cast("long").alias(c) for c in ("fx0", "fy0", "fx1", "fy1")]
    if frame:
        win, w, h = frame
        c = G.context_window(boxes, win, w, h).select("box_id", "wx0", "wy0")
        free = [F.col("wx0").alias("fx0"), F.col("wy0").alias("fy0"), (F.col("wx0") + win).alias("fx1"), (F.col("wy0") + win).alias("fy1")]
        boxes = boxes.join(c, "box_id")
    boxes = boxes.select("box_id", "x0", "y0", "x1", "y1", *free)
    edge = {c: F.greatest(F.col(c) - ring, F.col("f" + c)) for c in ("x0", "y0")} | {c: F.least(F.col(c) + ring, F.col("f" + c)) for c in ("x1", "y1")}
    near = boxes.select(
        "box_id", *[F.col(c).alias("q" + c) for c in ("x0", "y0", "x1", "y1")],
        *[e.alias("w" + c) for c, e in edge.items()],
    )
    around = ["box_id", "qx0", "qy0", "qx1", "qy1"]
    px = G.extract_window(pixels.where(~C.is_blue()), near.select(*around, *[F.greatest(c, F.lit(0)).alias(c) for c in ("wx0", "wy0")], "wx1", "wy1")
                          .select(*around, "wx0", "wy0", "wx1", "wy1", F.col("wx0").alias("kx"), F.col("wy0").alias("ky")), [*around, "kx", "ky"], block)
    x, y = F.col("x") + F.col("kx"), F.col("y") + F.col("ky")
    inside = (x >= F.col("qx0")) & (x < F.col("qx1")) & (y >= F.col("qy0")) & (y < F.col("qy1"))
    med = median_by(px.where(~inside), ["box_id"], ["r", "g", "b"])
    out = boxes.select("box_id").join(med, "box_id", "left")
    n = F.coalesce("n", F.lit(0))
    return out.select("box_id", n.alias("n"), *[F.when(n > least, F.floor(c)).otherwise(F.lit(v)).alias("f" + c) for c, v in zip("rgb", fallback)])


def regen_windows(render: DataFrame, raw: DataFrame, boxes: DataFrame, win: int, w: int, h: int) -> DataFrame:
    """Window pixels for each box: current render around, raw geometry inside the box, red outline on its edge."""
    key = ["box_id", "bx0", "by0", "bx1", "by1"]
    b = G.context_window(boxes, win, w, h).withColumn("wx1", F.col("wx0") + win).withColumn("wy1", F.col("wy0") + win)
    both = render.select("y", "x", "r", "g", "b", F.lit(0).alias("src")).unionByName(
        raw.select("y", "x", "r", "g", "b", F.lit(1).alias("src"))
    )
    px = G.extract_window(both, b, key, win)
    inside = (F.col("x") >= F.col("bx0")) & (F.col("x") < F.col("bx1")) & (F.col("y") >= F.col("by0")) & (F.col("y") < F.col("by1"))
    px = px.where(inside == (F.col("src") == 1))
    edge = C.on_outline(F.col("bx0"), F.col("by0"), F.col("bx1"), F.col("by1"))
    return px.select("box_id", "y", "x", *[F.when(edge, v).otherwise(F.col(c)).alias(c) for c, v in zip("rgb", C.RED)])


def paste_boxes(render: DataFrame, patches: DataFrame, feather: int) -> DataFrame:
    """Feather patches ``(y, x, r, g, b, d)`` into the render; ``d`` is the distance to the edge of the patch.
    Patches must not overlap."""
    a = C.ring_feather(F.col("d"), feather)
    p = patches.select("y", "x", *[F.col(c).alias("o_" + c) for c in "rgb"], a.alias("a"))
    j = render.join(p, ["y", "x"], "left")
    return j.select(
        "y", "x",
        *[F.when(F.col("a").isNull(), F.col(c)).otherwise(F.floor((F.col("o_" + c) * F.col("a") + F.col(c) * (255 - F.col("a"))) / F.lit(255))).alias(c) for c in "rgb"],
    )


def replace_cells(
    base: DataFrame, rules: DataFrame, editor, cell: int, pad: int, feather: int, w: int, h: int, key: Sequence[str] = ("col", "row")
) -> DataFrame:
    """Re-make the listed cells ``(col, row, …)``. Every window is cut from the unchanged base, so cells are
    independent. ``editor`` gets window pixels ``(col, row, y, x, r, g, b)`` with the rule's columns and returns
    them changed, with a ``status``; failed cells keep the base. Bright neutral structures are put back."""
    key = list(key)
    win = G.padded_window(rules, cell, pad, w, h)
    rest = [c for c in win.columns if c not in ("wx0", "wy0", "wx1", "wy1")]
    px = G.extract_window(base, win.select("*", F.col("wx0").alias("kx"), F.col("wy0").alias("ky")), [*rest, "kx", "ky"])
    out = editor.apply(px).where("status = 'ok'")
    out = out.where("x >= ox AND x < ox + cw AND y >= oy AND y < oy + ch")
    d = F.least(F.col("x") - F.col("ox"), F.col("y") - F.col("oy"), F.col("ox") + F.col("cw") - 1 - F.col("x"), F.col("oy") + F.col("ch") - 1 - F.col("y"))
    patch = out.select((F.col("y") + F.col("ky")).alias("y"), (F.col("x") + F.col("kx")).alias("x"), "r", "g", "b", d.alias("d"))
    keep = base.where(C.is_neutral_bright(140, 24)).select("y", "x", *[F.col(c).alias("k_" + c) for c in "rgb"])
    patch = patch.join(keep, ["y", "x"], "left").select("y", "x", "d", *[F.coalesce("k_" + c, c).alias(c) for c in "rgb"])
    return paste_boxes(base, patch, feather)
