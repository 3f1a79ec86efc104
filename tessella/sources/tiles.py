"""Reading tiles, lists, manifests, calibrations and map extracts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella import schemas
from tessella.operators import grid


def scan_tiles(spark: SparkSession, folder: str, pattern: str = "tile_*.png") -> DataFrame:
    """Tile files of a folder (recursive) with col and row; an error when there is none."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    )
    tiles = grid.parse_tiles(files)
    if tiles.isEmpty():
        raise ValueError(f"{folder} holds no file named like a tile")
    return tiles


def read_images(spark: SparkSession, folder: str, pattern: str = "tile_*.png") -> DataFrame:
    """Decoded tiles of a folder (recursive): path, region, col, row, the image struct (rows of BGR bytes) and ``status``: ``ok`` or
    ``undecodable``, then with an empty image. Without a pixel such a tile is a hole that is known, not one that vanished."""
    df = spark.read.format("image").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    tiles = grid.parse_tiles(df.select(F.col("image.origin").alias("path"), "image"))
    return tiles.withColumn("status", F.when(F.coalesce(F.col("image.height"), F.lit(-1)) > 0, "ok").otherwise("undecodable"))


def tiles_to_pixels(tiles: DataFrame, key: Sequence[str] = ("col", "row")) -> DataFrame:
    """Unpack decoded images ``(key…, image)`` into pixel rows ``(key…, y, x, r, g, b)``.

    Spark cuts each image into its rows first, so that Python gets small pieces whatever the size of a tile."""
    key = list(key)
    flat = tiles.where("image.height > 0").select(*key, "image.height", "image.width", "image.nChannels", "image.data")
    lines = flat.select("*", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y")).selectExpr(
        *key, "y", "nChannels n", "substring(data, y * width * nChannels + 1, width * nChannels) line"
    )
    types = dict(tiles.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in key) + ", y int, x int, r int, g int, b int"

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n, pdf in batch.groupby("n"):
                for at in range(0, len(pdf), 500):
                    part = pdf.iloc[at : at + 500]
                    widths = part["line"].map(len).to_numpy() // n
                    px = np.frombuffer(b"".join(part["line"]), np.uint8).reshape(-1, n).astype(np.int32)
                    x = np.arange(len(px)) - np.repeat(np.cumsum(widths) - widths, widths)
                    out = {k: np.repeat(part[k].to_numpy(), widths) for k in [*key, "y"]}
                    blue, green, red = (0, 1, 2) if n >= 3 else (0, 0, 0)
                    yield pd.DataFrame({**out, "x": x, "r": px[:, red], "g": px[:, green], "b": px[:, blue]})

    return lines.mapInPandas(unpack, schema)


def pixels_to_tiles(pixels: DataFrame, key: Sequence[str], tile: int) -> DataFrame:
    """Pack canvas pixels into decoded images of ``tile`` x ``tile`` (ragged at the border): lines first,
    then tiles of lines, so no group holds more than one line of pixels or one tile of lines."""
    hex3 = F.hex(F.shiftleft(F.col("b").cast("int"), 16) + F.shiftleft(F.col("g").cast("int"), 8) + F.col("r").cast("int"))
    p = pixels.select(
        *key,
        F.floor(F.col("x") / tile).cast("int").alias("col"),
        F.col("y").cast("int").alias("line"),
        F.struct((F.col("x") % tile).cast("int").alias("tx"), F.lpad(hex3, 6, "0").alias("v")).alias("p"),
    )
    p = p.groupBy(*key, "col", "line").agg(F.sort_array(F.collect_list("p")).alias("px"), (F.max("p.tx") + 1).alias("width"))
    p = p.select(
        *key, "col", F.floor(F.col("line") / tile).cast("int").alias("row"), "width",
        F.struct((F.col("line") % tile).alias("ty"), F.unhex(F.array_join(F.transform("px", lambda z: z.v), "")).alias("v")).alias("p"),
    )
    t = p.groupBy(*key, "col", "row").agg(
        F.sort_array(F.collect_list("p")).alias("px"), (F.max("p.ty") + 1).alias("height"), F.max("width").alias("width")
    )
    data = F.unhex(F.array_join(F.transform("px", lambda z: F.hex(z.v)), ""))
    return t.select(
        *key,
        "col",
        "row",
        F.struct(
            F.concat_ws("_", F.lit("tile"), "col", "row").alias("origin"),
            "height",
            "width",
            F.lit(3).alias("nChannels"),
            F.lit(16).alias("mode"),
            data.alias("data"),
        ).alias("image"),
    )


def parse_manifest(docs: DataFrame, key: Sequence[str], text: str = "doc") -> DataFrame:
    return docs.select(*key, F.from_json(text, schemas.MANIFEST).alias("m")).select(*key, "m.grid")


def parse_tile_list(docs: DataFrame, key: Sequence[str] = (), text: str = "doc") -> DataFrame:
    """``[[c, r], …]`` -> distinct cells."""
    cells = docs.select(*key, F.explode(F.from_json(text, "array<array<int>>")).alias("c"))
    return cells.select(*key, F.col("c")[0].alias("col"), F.col("c")[1].alias("row")).distinct()


def parse_calibration(docs: DataFrame, key: Sequence[str] = (), text: str = "doc") -> DataFrame:
    m = docs.select(*key, F.from_json(text, schemas.CALIBRATION).alias("m"))
    a = [F.col("m.A")[i][j].alias(f"a{i}{j}") for i in range(3) for j in range(2)]
    return m.select(
        *key, *a, F.col("m.center")[0].alias("clat"), F.col("m.center")[1].alias("clng"),
        F.col("m.mLat").alias("mlat"), F.col("m.mLng").alias("mlng"), F.col("m.col0").alias("col0"), F.col("m.row0").alias("row0"),
    )


def read_text_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as one ``doc`` each, for the ``parse_…`` readers."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "doc")


def parse_features(docs: DataFrame, text: str = "doc") -> DataFrame:
    """Map extracts -> one row per line: ``(osm_id, type, tags, member, role, geometry)``. A way is one line;
    a relation has one per member. Elements without geometry or members give none."""
    e = docs.select(F.explode(F.from_json(text, schemas.MAP_EXTRACT).getField("elements")).alias("e")).select("e.*")
    way = F.when(
        (F.col("type") == "way") & F.col("geometry").isNotNull(),
        F.array(F.struct(F.lit(None).cast("string").alias("role"), F.col("geometry").alias("geometry"))),
    )
    rel = F.when(F.col("type") == "relation", F.col("members"))
    lines = e.select(F.col("id").alias("osm_id"), "type", "tags", F.posexplode(F.coalesce(way, rel)).alias("member", "line"))
    return lines.select("osm_id", "type", "tags", "member", "line.role", "line.geometry").where("geometry IS NOT NULL")


def points(lines: DataFrame) -> DataFrame:
    """One row per point of each line."""
    rest = [c for c in lines.columns if c != "geometry"]
    return lines.select(*rest, F.posexplode("geometry").alias("seq", "p")).select(*rest, "seq", "p.lat", "p.lon")


def read_with_fallback(
    wanted: DataFrame, primary: DataFrame, secondary: DataFrame, by: Sequence[str], shift1: tuple[int, int], shift2: tuple[int, int]
) -> DataFrame:
    """Each wanted cell from ``primary`` at (c, r) - shift1, else from ``secondary`` at (c, r) - shift2, else
    ``source`` is null. Both sources have one row ``(by…, col, row, item)`` per cell."""

    def at(src: DataFrame, shift, name) -> DataFrame:
        return src.select(*by, (F.col("col") + shift[0]).alias("col"), (F.col("row") + shift[1]).alias("row"), F.col("item").alias(name))

    key = [*by, "col", "row"]
    j = wanted.join(at(primary, shift1, "one"), key, "left").join(at(secondary, shift2, "two"), key, "left")
    source: Column = F.when(F.col("one").isNotNull(), F.lit(1)).when(F.col("two").isNotNull(), F.lit(2))
    return j.select(*key, source.alias("source"), F.coalesce("one", "two").alias("item"))
