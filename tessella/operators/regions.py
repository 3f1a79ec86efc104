"""Connected regions of a mask and their statistics.

Labelling has two stages: each block of ``block`` x ``block`` pixels labels its own runs (a group of bounded
size), then the block-local components that meet at block borders are joined as a graph. Statistics go
run -> local component -> region, so a region that covers a third of the canvas is summed block by block
before its rows meet.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.operators import runs as R
from tessella.operators.graph import components, ranked
from tessella.session import dealt, save

SHIFT = 31  # pixel id = y * 2**31 + x


@dataclass
class Regions:
    """``runs (by…, y, bx, x0, x1, local)`` and ``parts (by…, local, label, px)``."""

    runs: DataFrame
    parts: DataFrame
    by: tuple[str, ...] = ()

    def sizes(self) -> DataFrame:
        return self.parts.groupBy(*self.by, "label").agg(F.sum("px").alias("px"))

    def labelled(self) -> DataFrame:
        return self.runs.join(self.parts.select(*self.by, "local", "label"), [*self.by, "local"])

    def keep(self, labels: DataFrame) -> DataFrame:
        """Runs of the regions listed in ``labels`` (by…, label)."""
        parts = self.parts.join(labels.select(*self.by, "label"), [*self.by, "label"], "left_semi")
        return self.runs.join(parts.select(*self.by, "local"), [*self.by, "local"], "left_semi").drop("local")

    def attach(self, stats: DataFrame) -> DataFrame:
        """Runs with the columns that ``stats`` holds per (by…, label)."""
        parts = self.parts.drop("px").join(stats, [*self.by, "label"])
        return self.runs.join(parts, [*self.by, "local"])


def _label_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Union-find over the runs of some blocks, each by itself; the id of a component is its first pixel."""
    pdf = pdf.sort_values(["yb", "bx", "y", "x0"], ignore_index=True)
    ys, lo, hi = pdf["y"].tolist(), pdf["x0"].tolist(), pdf["x1"].tolist()
    blocks = list(zip(pdf["yb"].tolist(), pdf["bx"].tolist()))
    up = list(range(len(ys)))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    above = 0
    for i, y in enumerate(ys):
        while blocks[above] != blocks[i] or ys[above] < y - 1 or (ys[above] == y - 1 and hi[above] < lo[i]):
            above += 1
        j = above
        while ys[j] == y - 1 and lo[j] <= hi[i]:
            a, b = find(i), find(j)
            up[max(a, b)] = min(a, b)
            j += 1
    pdf["local"] = [(ys[r] << SHIFT) + lo[r] for r in map(find, range(len(ys)))]
    return pdf


def label(runs: DataFrame, by: Sequence[str] = (), block: int = R.BLOCK) -> Regions:
    """4-connected components; the label is the id of the first pixel. ``runs`` must be cut at ``block``.
    With ``by`` the table holds many canvases, of any size each."""
    by = tuple(by)
    r = runs.select(*by, "y", "bx", "x0", "x1").withColumn("yb", R._div(F.col("y"), block))
    types = dict(r.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in r.columns) + ", local long"
    many = R.span(block) // block  # blocks along the edge of what one Python call gets
    square = [*by, R._div(F.col("yb"), many).alias("ys"), R._div(F.col("bx"), many).alias("xs")]
    some = dealt(r, *square).groupBy(*square)
    local = save(some.applyInPandas(_label_block, schema).drop("yb"), "local")
    parts = local.groupBy(*by, "local").agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("px"))
    # a whole number for each local component, in the order of (by, local); one canvas needs none
    ids = ranked(parts.select(*by, "local"), [], [*by, "local"], "vid") if by else parts.select("local", F.col("local").alias("vid"))
    ids = save(ids, "ids") if by else ids
    # border pixels of neighbouring blocks meet in equi-joins
    bottom = R.to_pixels(local.where(F.col("y") % block == block - 1)).select(
        *by, (F.col("y") + 1).alias("y"), "x", F.col("local").alias("u")
    )
    top = R.to_pixels(local.where((F.col("y") % block == 0) & (F.col("y") > 0))).select(
        *by, "y", "x", F.col("local").alias("v")
    )
    right = local.where(F.col("x1") % block == block - 1).select(
        *by, "y", (F.col("x1") + 1).alias("x0"), F.col("local").alias("u")
    )
    left = local.where((F.col("x0") % block == 0) & (F.col("x0") > 0)).select(*by, "y", "x0", F.col("local").alias("v"))
    pairs = bottom.join(top, [*by, "y", "x"]).select(*by, "u", "v").union(right.join(left, [*by, "y", "x0"]).select(*by, "u", "v")).distinct()
    if not by:
        roots = components(pairs).select(F.col("id").alias("local"), F.col("root").alias("label"))
    else:
        own = lambda c: ids.select(*by, F.col("local").alias(c), F.col("vid").alias("n" + c))
        edges = pairs.join(own("u"), [*by, "u"]).join(own("v"), [*by, "v"]).select(F.col("nu").alias("u"), F.col("nv").alias("v"))
        roots = components(edges).join(ids.select(F.col("vid").alias("root"), F.col("local").alias("label")), "root")
        roots = ids.join(roots.select(F.col("id").alias("vid"), "label"), "vid").select(*by, "local", "label")
    parts = parts.join(roots, [*by, "local"], "left")
    parts = save(parts.select(*by, "local", "px", F.coalesce("label", "local").alias("label")), "parts")
    return Regions(local, parts, by)


def keep_large(reg: Regions, min_px) -> DataFrame:
    """Runs of the regions with more than ``min_px`` pixels."""
    return reg.keep(reg.sizes().where(F.col("px") > min_px))


def boxes(reg: Regions, pad: int, w: int, h: int) -> DataFrame:
    """Bounding box of each region, padded and clipped; upper ends are exclusive."""
    local = reg.runs.groupBy("local").agg(
        F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x0").alias("x0"), F.max("x1").alias("x1")
    )
    b = local.join(reg.parts, "local").groupBy("label").agg(
        F.sum("px").alias("px"), F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.min("x0").alias("x0"), F.max("x1").alias("x1")
    )
    return b.select(
        "label",
        "px",
        F.greatest(F.col("y0") - pad, F.lit(0)).alias("y0"),
        F.least(F.col("y1") + 1 + pad, F.lit(h)).alias("y1"),
        F.greatest(F.col("x0") - pad, F.lit(0)).alias("x0"),
        F.least(F.col("x1") + 1 + pad, F.lit(w)).alias("x1"),
    )


def centroids(reg: Regions) -> DataFrame:
    """Mean x and y of each region, from whole-number sums."""
    n = F.col("x1") - F.col("x0") + 1
    local = reg.runs.groupBy("local").agg(
        F.sum(F.col("y") * n).alias("sy"), F.sum((F.col("x0") + F.col("x1")) * n).alias("sx2")
    )
    s = local.join(reg.parts, "local").groupBy("label").agg(
        F.sum("px").alias("px"), F.sum("sy").alias("sy"), F.sum("sx2").alias("sx2")
    )
    return s.select(
        "label", "px", (F.col("sx2") / 2 / F.col("px")).alias("cx"), (F.col("sy") / F.col("px")).alias("cy")
    )


def fill_holes(runs: DataFrame, space: DataFrame, w: int, h: int, block: int = R.BLOCK) -> DataFrame:
    """Add the background regions that do not reach the border."""
    bg = label(R.complement(runs, space), block=block)
    edge = (F.col("y") == 0) | (F.col("y") == h - 1) | (F.col("x0") == 0) | (F.col("x1") == w - 1)
    local = bg.runs.groupBy("local").agg(F.max(edge.cast("int")).alias("edge"))
    inner = (
        bg.parts.join(local, "local").groupBy("label").agg(F.max("edge").alias("edge")).where("edge = 0")
    )
    return R.union(runs.select("y", "bx", "x0", "x1"), bg.keep(inner).select("y", "bx", "x0", "x1"))


def touching_pools(reg: Regions, river_min: int, min_px: int) -> DataFrame:
    """Regions that are neither the river (``river_min`` pixels or more) nor specks below ``min_px``."""
    return reg.sizes().where((F.col("px") < river_min) & (F.col("px") >= min_px))


def shore_median(
    reg: Regions,
    pools: DataFrame,
    blue: DataFrame,
    pixels: DataFrame,
    w: int,
    h: int,
    ring: int = 18,
    pad: int = 22,
    min_ring: int = 30,
    fallback: tuple[int, int, int] = (150, 148, 143),
    block: int = R.BLOCK,
) -> DataFrame:
    """Median colour of the ring around each region of ``pools``, without blue pixels and inside the padded box.
    Medians come from exact per-value counts, so no region's pixels meet in one task."""
    own = reg.attach(pools.select("label"))
    grown = R.dilate(own.select("label", "y", "bx", "x0", "x1"), ring, w, h, ["label"], block)
    box = boxes(reg, pad, w, h).select(
        "label", F.col("y0").alias("b_y0"), F.col("y1").alias("b_y1"), F.col("x0").alias("b_x0"), F.col("x1").alias("b_x1")
    )
    shore = R.to_pixels(grown.join(box, "label")).where("y >= b_y0 AND y < b_y1 AND x >= b_x0 AND x < b_x1")
    shore = shore.select("label", "y", "x").join(R.to_pixels(blue), ["y", "x"], "left_anti")
    med = median_by(shore.join(pixels, ["y", "x"]), ["label"], ["r", "g", "b"])
    enough = F.coalesce(F.col("n"), F.lit(0)) >= min_ring
    out = pools.select("label", "px").join(med, "label", "left")
    return out.select(
        "label",
        "px",
        F.coalesce("n", F.lit(0)).alias("n"),
        *[F.when(enough, F.col(c)).otherwise(F.lit(float(v))).alias(c) for c, v in zip("rgb", fallback)],
    )


def median_by(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Exact medians of 0..255 channels per group, and the group size ``n``.

    Each group shrinks to at most 256 (value, count) rows per channel before any of its rows meet, so neither
    a hot group nor the sort of a plain median ends up in one task."""
    from pyspark.sql import Window as W

    by = list(by)
    long = df.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("ch"), F.col(c).alias("v")) for c in cols])).alias("z"))
    hist = long.groupBy(*by, "z.ch", "z.v").agg(F.count("*").alias("c"))
    w = W.partitionBy(*by, "ch").orderBy("v")
    all_ = W.partitionBy(*by, "ch")
    h = hist.withColumn("upto", F.sum("c").over(w)).withColumn("n", F.sum("c").over(all_))
    lo, hi = F.floor((F.col("n") + 1) / 2), F.floor((F.col("n") + 2) / 2)
    first = F.col("upto") - F.col("c")
    m = h.groupBy(*by, "ch").agg(
        F.first("n").alias("n"),
        (
            (
                F.max(F.when((first < lo) & (F.col("upto") >= lo), F.col("v")))
                + F.max(F.when((first < hi) & (F.col("upto") >= hi), F.col("v")))
            )
            / F.lit(2.0)
        ).alias("med"),
    )
    return m.groupBy(*by).agg(
        F.max("n").alias("n"), *[F.max(F.when(F.col("ch") == c, F.col("med"))).alias(c) for c in cols]
    )


def medians(df: DataFrame, by: Sequence[str], cols: Sequence[str], bins: int = 256) -> DataFrame:
    """Exact medians of real-valued columns per group, and the number ``n`` of values of the first column; null and NaN take no part.

    The two middle ranks are closed in by rounds of histograms: values between the bounds of a group fall into ``bins`` equal parts, of which only counts and
    extremes travel, and the part that holds both ranks gives the next bounds. Ranks in different parts are the largest value of one and the
    smallest of the other. Groups of any size stay spread out; a round narrows each by its distinct values, 256 times as a rule."""
    from pyspark.sql import Window as W

    by = list(by)
    key = [*by, "ch"]
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("ch"), F.col(c).cast("double").alias("v")) for c in cols])).alias("z")
    values = save(df.select(*by, each).select(*by, "z.ch", "z.v").where("v IS NOT NULL AND NOT isnan(v)"), "values")
    start = values.groupBy(*key).agg(F.min("v").alias("a"), F.max("v").alias("b"), F.count("*").alias("n"))
    state = save(start.withColumn("before", F.lit(0).cast("long")), "bounds")
    found = None
    while True:
        done = state.where("a = b").select(*key, "n", F.col("a").alias("med"))
        found = done if found is None else found.unionByName(done)
        if state.where("a < b").isEmpty():
            break
        inside = values.join(state.where("a < b"), key).where("v BETWEEN a AND b")
        part = F.least(F.floor((F.col("v") - F.col("a")) / (F.col("b") - F.col("a")) * bins), F.lit(bins - 1)).alias("part")
        hist = inside.groupBy(*key, "n", "before", part).agg(F.count("*").alias("c"), F.min("v").alias("low"), F.max("v").alias("high"))
        w = W.partitionBy(*key).orderBy("part")  # ``bins`` rows at most
        hist = hist.withColumn("upto", F.col("before") + F.sum("c").over(w)).withColumn("first", F.col("upto") - F.col("c"))
        at = lambda rank: (F.col("first") < rank) & (F.col("upto") >= rank)
        lo, hi = F.floor((F.col("n") + 1) / 2), F.floor((F.col("n") + 2) / 2)
        pick = lambda cond, c, name: F.max(F.when(cond, F.col(c))).alias(name)
        near = hist.groupBy(*key, "n").agg(
            pick(at(lo), "part", "p"), pick(at(hi), "part", "q"), pick(at(lo), "low", "a"), pick(at(lo), "high", "b"), pick(at(hi), "low", "c"), pick(at(lo), "first", "before")
        )
        near = save(near, "bounds")
        found = found.unionByName(near.where("p <> q").select(*key, "n", ((F.col("b") + F.col("c")) / F.lit(2.0)).alias("med")))
        state = near.where("p = q").select(*key, "a", "b", "n", "before")
    first = F.max(F.when(F.col("ch") == cols[0], F.col("n"))).alias("n")
    return found.groupBy(*by).agg(first, *[F.max(F.when(F.col("ch") == c, F.col("med"))).alias(c) for c in cols])
