"""Relational operators on the tile grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import text as T


def parse_tiles(files: DataFrame) -> DataFrame:
    """Files whose name is ``tile_<col>_<row>.png``, with region folder, col and row."""
    name = T.file_name(F.col("path"))
    return files.where(name.rlike(T.TILE_NAME)).select(
        "*",
        T.folder_name(F.col("path")).alias("region"),
        T.tile_part(name, 1).alias("col"),
        T.tile_part(name, 2).alias("row"),
    )


def grid_extent(tiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return tiles.groupBy(*by).agg((F.max("col") + 1).alias("cols"), (F.max("row") + 1).alias("rows"))


def override_extent(extent: DataFrame, manifests: DataFrame, by: Sequence[str]) -> DataFrame:
    """A manifest with a positive ``grid`` sets both extents."""
    g = F.when(F.col("grid") > 0, F.col("grid"))
    return extent.join(manifests, list(by), "left").select(
        *by, F.coalesce(g, F.col("cols")).alias("cols"), F.coalesce(g, F.col("rows")).alias("rows")
    )


def grid_cells(extent: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All cells of each grid. Rows are spread over the cluster before columns unfold, so one huge grid
    is not unfolded in one task."""
    rows = extent.select(*by, "cols", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"))
    rows = rows.repartition(*by, "row")
    return rows.select(*by, F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("col"), "row")


def missing_cells(tiles: DataFrame, extent: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    key = [*by, "col", "row"]
    return grid_cells(extent, by).join(tiles.select(*key).distinct(), key, "left_anti")


def place(tiles: DataFrame, cell: int, ox: Column | int = 0, oy: Column | int = 0) -> DataFrame:
    """Pixel origin of each tile on the canvas."""
    ox, oy = (v if isinstance(v, Column) else F.lit(v) for v in (ox, oy))
    return tiles.select("*", (F.col("col") * cell + ox).alias("x0"), (F.col("row") * cell + oy).alias("y0"))


def drop_out_of_canvas(placed: DataFrame, cell: int, w: int, h: int) -> DataFrame:
    return placed.where((F.col("x0") >= 0) & (F.col("y0") >= 0) & (F.col("x0") + cell <= w) & (F.col("y0") + cell <= h))


def ragged_cells(sizes: DataFrame, cell: int, by: Sequence[str] = ()) -> DataFrame:
    """Cells over a canvas ``(w, h)`` with boxes clipped at the right and bottom, labelled ``col_row``."""
    ext = sizes.select(
        *by, "w", "h", F.ceil(F.col("w") / cell).cast("int").alias("cols"), F.ceil(F.col("h") / cell).cast("int").alias("rows")
    )
    cells = grid_cells(ext, [*by, "w", "h"])
    return cells.select(
        *by,
        F.concat_ws("_", "col", "row").alias("label"),
        (F.col("col") * cell).alias("x0"),
        (F.col("row") * cell).alias("y0"),
        F.least((F.col("col") + 1) * cell, F.col("w")).alias("x1"),
        F.least((F.col("row") + 1) * cell, F.col("h")).alias("y1"),
    )


def rebase(tiles: DataFrame, c0: int, r0: int, c1: int, r1: int) -> DataFrame:
    """Sub-block ``c0..c1`` x ``r0..r1`` (inclusive), renumbered from 0."""
    return (
        tiles.where(F.col("col").between(c0, c1) & F.col("row").between(r0, r1))
        .withColumn("col", F.col("col") - c0)
        .withColumn("row", F.col("row") - r0)
    )


def resume(todo: DataFrame, done: DataFrame, key: Sequence[str]) -> DataFrame:
    """Tiles whose output does not exist yet."""
    return todo.join(done.select(*key).distinct(), list(key), "left_anti")


def process_first(tiles: DataFrame, n: int, order: Sequence[str] = ("path",)) -> DataFrame:
    return tiles.orderBy(*order).limit(n)


def blue_share(pixels: DataFrame, blue: Column, key: Sequence[str]) -> DataFrame:
    return pixels.groupBy(*key).agg(F.avg(blue.cast("int")).alias("share"))


def drop_already_blue(pixels: DataFrame, blue: Column, key: Sequence[str], limit: float = 0.35) -> DataFrame:
    """Tiles that still need work: at most ``limit`` of their pixels are blue."""
    return blue_share(pixels, blue, key).where(F.col("share") <= limit)


def context_window(boxes: DataFrame, win: int, w: int, h: int) -> DataFrame:
    """A ``win`` x ``win`` window centred on each box and kept inside the canvas, and the box inside it."""

    def start(lo, hi, size):
        centre = F.floor((F.col(lo) + F.col(hi)) / 2)
        return F.greatest(F.lit(0), F.least(F.lit(size - win), centre - win // 2))

    b = boxes.withColumn("wx0", start("x0", "x1", w)).withColumn("wy0", start("y0", "y1", h))
    return b.select(
        "*",
        *[(F.col(c) - F.col("w" + c[0] + "0")).alias("b" + c) for c in ("x0", "y0", "x1", "y1")],
        F.floor((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) * 100 / F.lit(win * win)).alias("pct"),
    )


def padded_window(cells: DataFrame, cell: int, pad: int, w: int, h: int) -> DataFrame:
    """Each cell with ``pad`` pixels around it, clipped; offset and clipped size of the cell in that window."""
    cx, cy = F.col("col") * cell, F.col("row") * cell
    wx0, wy0 = F.greatest(F.lit(0), cx - pad), F.greatest(F.lit(0), cy - pad)
    return cells.select(
        "*",
        wx0.alias("wx0"),
        wy0.alias("wy0"),
        F.least(F.lit(w), cx + cell + pad).alias("wx1"),
        F.least(F.lit(h), cy + cell + pad).alias("wy1"),
        (cx - wx0).alias("ox"),
        (cy - wy0).alias("oy"),
        F.least(F.lit(cell), F.lit(w) - cx).alias("cw"),
        F.least(F.lit(cell), F.lit(h) - cy).alias("ch"),
    )


def extract_window(pixels: DataFrame, windows: DataFrame, key: Sequence[str], block: int = 256) -> DataFrame:
    """Pixels of every window ``(wx0, wy0, wx1, wy1)`` (upper ends exclusive; windows may overlap), addressed
    inside the window. The range condition becomes an equi-join on the blocks that each window touches."""

    def blocks(lo, hi):
        return F.explode(F.sequence(F.floor(F.col(lo) / block), F.floor((F.col(hi) - 1) / block)))

    win = windows.select(*key, "wx0", "wy0", "wx1", "wy1").withColumn("pbx", blocks("wx0", "wx1"))
    win = win.withColumn("pby", blocks("wy0", "wy1"))
    px = pixels.withColumn("pbx", F.floor(F.col("x") / block)).withColumn("pby", F.floor(F.col("y") / block))
    rest = [c for c in pixels.columns if c not in ("y", "x")]
    hit = (F.col("x") >= F.col("wx0")) & (F.col("x") < F.col("wx1")) & (F.col("y") >= F.col("wy0")) & (F.col("y") < F.col("wy1"))
    return px.join(win, ["pby", "pbx"]).where(hit).select(
        *key, (F.col("y") - F.col("wy0")).alias("y"), (F.col("x") - F.col("wx0")).alias("x"), *rest
    )


def sweep(tiles: DataFrame, settings: Sequence[dict]) -> DataFrame:
    """Every tile under every setting; the output key is ``label__name``. The settings are literals of the plan."""
    opts = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in s.items()]) for s in settings])
    s = tiles.select("*", F.explode(opts).alias("s")).select(*tiles.columns, "s.*")
    return s.withColumn("out", F.concat(F.regexp_replace("label", " ", "_"), F.lit("__"), F.col("name")))


def contact_sheet(results: DataFrame, labels: Sequence[str], value: str) -> DataFrame:
    """Rows are tiles, columns are settings."""
    return results.groupBy("name").pivot("label", list(labels)).agg(F.max(value))


def cell_rules(tiles: DataFrame, rules: DataFrame) -> DataFrame:
    """Tiles that have a rule, with it; Catalyst broadcasts the rules only while they are small."""
    return tiles.join(rules, ["col", "row"])


def validate_submission(files: DataFrame, max_tiles: int = 50, size: int = 1024, submission: str | None = None) -> DataFrame:
    """Violations ``(region, file, reason)``: wrong names, wrong sizes, too many tiles, no notes. With a column that tells
    submissions apart also those of more than one region, named by ``file``."""
    name = T.file_name(F.col("path"))
    f = files.select(
        T.folder_name(F.col("path")).alias("region"), name.alias("file"), "width", "height"
    )
    is_tile, is_notes = F.col("file").rlike(T.TILE_NAME), F.col("file") == "NOTES.md"
    why = F.filter(
        F.array(
            F.when(~is_tile & ~is_notes, F.lit("name")),
            F.when(is_tile & ((F.col("width") != size) | (F.col("height") != size)), F.lit("size")),
        ),
        lambda z: z.isNotNull(),
    )
    per_file = f.select("region", "file", F.explode(why).alias("reason")).distinct()
    per_region = f.groupBy("region").agg(
        F.count_distinct(F.when(is_tile, F.col("file"))).alias("tiles"), F.max(is_notes.cast("int")).alias("notes")
    )
    why = F.filter(
        F.array(F.when(F.col("tiles") > max_tiles, F.lit("too many tiles")), F.when(F.col("notes") == 0, F.lit("no notes"))),
        lambda z: z.isNotNull(),
    )
    out = per_file.unionByName(per_region.select("region", F.lit("").alias("file"), F.explode(why).alias("reason")))
    if submission:
        many = files.groupBy(F.col(submission).cast("string").alias("file")).agg(F.count_distinct(T.folder_name(F.col("path"))).alias("n")).where("n > 1")
        out = out.unionByName(many.select(F.lit("").alias("region"), "file", F.lit("more than one region").alias("reason")))
    return out


def source_precedence(captures: DataFrame, key: Sequence[str], prio: str) -> DataFrame:
    """Per cell, the capture with the highest priority, whole row."""
    rest = [c for c in captures.columns if c not in key and c != prio]
    return (
        captures.groupBy(*key)
        .agg(F.max(F.struct(prio, *rest)).alias("top"))
        .select(*key, *[F.col(f"top.{c}").alias(c) for c in (prio, *rest)])
    )
