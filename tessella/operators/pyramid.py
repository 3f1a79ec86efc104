"""Deep-zoom pyramid: levels, tiles and summary."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.session import save

STEP = 3  # levels cut from one materialised base


def max_level(w: int, h: int) -> int:
    return math.ceil(math.log2(max(w, h)))


def pyramid_levels(pixels: DataFrame, w: int, h: int) -> DataFrame:
    """Pixels ``(level, y, x, r, g, b)`` of all levels; level ``max_level`` is full size. Every level is the
    truncated block mean of the full-size image: sums and counts are carried, ``STEP`` levels per pass, so the
    passes after the first read 1/64 of the one before."""
    top = max_level(w, h)
    base = pixels.select("y", "x", *[F.col(c).cast("long").alias(c) for c in "rgb"], F.lit(1).cast("long").alias("n"))
    out = [pixels.select(F.lit(top).alias("level"), F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), *"rgb")]
    level = top
    while level > 0:
        steps = min(STEP, level)
        b = base.select("*", F.explode(F.array(*[F.lit(s) for s in range(1, steps + 1)])).alias("s"))
        size = F.pow(F.lit(2.0), F.col("s"))
        sums = b.groupBy(
            "s", F.floor(F.col("y") / size).alias("y"), F.floor(F.col("x") / size).alias("x")
        ).agg(*[F.sum(c).alias(c) for c in ("r", "g", "b", "n")])
        sums = save(sums, "levels")
        out.append(
            sums.select(
                (F.lit(level) - F.col("s")).alias("level"), "y", "x", *[F.floor(F.col(c) / F.col("n")).alias(c) for c in "rgb"]
            )
        )
        base = sums.where(F.col("s") == steps).drop("s")
        level -= steps
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def pyramid_tiles(levels: DataFrame, tile: int = 256) -> DataFrame:
    """Packed tiles ``(level, c, r, w, h, hex)``; rows of RGB bytes as hex. Lines are packed first, then tiles of lines, so
    no group holds more than one line of pixels or one tile of lines."""
    v = F.lpad(F.hex(F.col("r") * 65536 + F.col("g") * 256 + F.col("b")), 6, "0")
    px = levels.select("level", F.floor(F.col("x") / tile).alias("c"), "y", F.struct((F.col("x") % tile).alias("x"), v.alias("v")).alias("p"))
    line = px.groupBy("level", "c", "y").agg(F.sort_array(F.collect_list("p")).alias("p"), (F.max("p.x") + 1).alias("w"))
    text = F.array_join(F.transform("p", lambda z: z.v), "")
    line = line.select("level", "c", F.floor(F.col("y") / tile).alias("r_"), "w", F.struct((F.col("y") % tile).alias("y"), text.alias("v")).alias("p"))
    t = line.groupBy("level", "c", "r_").agg(F.sort_array(F.collect_list("p")).alias("p"), F.max("w").alias("w"), (F.max("p.y") + 1).alias("h"))
    return t.select("level", "c", F.col("r_").alias("r"), "w", "h", text.alias("hex"))


def pyramid_boxes(spark: SparkSession, w: int, h: int, tile: int = 256) -> DataFrame:
    """Tile boxes of all levels from the canvas size alone."""
    top = max_level(w, h)
    lv = spark.range(top + 1).select(F.col("id").cast("int").alias("level"), F.pow(F.lit(2.0), F.lit(top) - F.col("id")).alias("s"))
    lv = lv.select("level", F.ceil(F.lit(w) / F.col("s")).alias("lw"), F.ceil(F.lit(h) / F.col("s")).alias("lh"))
    rows = lv.select("*", F.explode(F.sequence(F.lit(0), F.ceil(F.col("lh") / tile) - 1)).alias("r")).repartition("level", "r")
    cells = rows.select("*", F.explode(F.sequence(F.lit(0), F.ceil(F.col("lw") / tile) - 1)).alias("c"))
    return cells.select(
        "level", "c", "r", F.least(F.lit(tile), F.col("lw") - F.col("c") * tile).alias("w"),
        F.least(F.lit(tile), F.col("lh") - F.col("r") * tile).alias("h"),
    )


def pyramid_summary(boxes: DataFrame) -> DataFrame:
    """Tiles per level, and the total with a null level."""
    return boxes.rollup("level").agg(F.count("*").alias("tiles"), F.sum(F.col("w") * F.col("h")).alias("px"))


def descriptor(spark: SparkSession, w: int, h: int, tile: int = 256, fmt: str = "jpg") -> DataFrame:
    return spark.range(1).select(
        F.lit(w).alias("width"), F.lit(h).alias("height"), F.lit(tile).alias("tile_size"), F.lit(0).alias("overlap"), F.lit(fmt).alias("format")
    )
