"""The pluggable image editor: a column expression or a Python function that changes windows.

An editor gets rows of requests and returns the same rows with a new payload and a status. A failed edit stays
as a row with ``status`` other than ``ok``; the caller keeps the old content for it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.plans import arrays


@dataclass(frozen=True)
class Options:
    """Request options that travel with every call."""

    prompt: str = ""
    negative: str = ""
    cfg: float = 1.0
    steps: int = 14
    guidance: float = 3.0
    seed: int = 0


@dataclass(frozen=True)
class ColumnEditor:
    """Deterministic editor written as expressions; stays inside the JVM."""

    columns: Callable[[], dict[str, Column]]

    def apply(self, requests: DataFrame) -> DataFrame:
        return requests.withColumns({**self.columns(), "status": F.lit("ok")})

    def on_arrays(self, spark: SparkSession) -> dict[str, tuple] | None:
        """The same expressions for windows held as arrays (``arrays.value``), where they can be computed there."""
        return arrays.compiled(spark, self.columns)


@dataclass(frozen=True)
class PythonEditor:
    """``edit(row: dict, model) -> bytes | None`` per window. ``load`` runs once per task, before its first
    window; None or an exception marks the row as failed. Column ``payload`` (binary) goes in and comes out.

    An image row also has ``width`` and ``height``; its payload holds lines of BGR bytes. The edit may return ``(bytes, width,
    height)``: an image of another size is brought to the row's size by its nearest pixels. Bytes of any other length fail."""

    edit: Callable
    load: Callable[[], object] = field(default=lambda: None)
    options: Options = Options()

    def apply(self, requests: DataFrame) -> DataFrame:
        edit, load, opts = self.edit, self.load, self.options

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = None
            loaded = False
            for pdf in batches:
                out, status = [], []
                for row in pdf.to_dict("records"):
                    if not loaded:
                        model, loaded = load(), True
                    try:
                        res = fitted(edit({**vars(opts), **row}, model), row.get("width"), row.get("height"))
                        out.append(res)
                        status.append("no image" if res is None else "ok")
                    except Exception as exc:  # noqa: BLE001 - the row records the failure
                        out.append(None)
                        status.append(f"fail: {str(exc)[:40]}")
                yield pdf.assign(payload=out, status=status)

        types = [(n, t) for n, t in requests.dtypes if n != "status"]
        cols = [f"`{n}` {t}" for n, t in types]
        return requests.select(*[n for n, _ in types]).mapInPandas(run, ", ".join([*cols, "status string"]))


def fitted(image, width, height) -> bytes | None:
    """Result of an edit as bytes of the wanted size."""
    if isinstance(image, tuple):
        data, w, h = image
        px = np.frombuffer(data, np.uint8).reshape(h, w, 3)
        image = np.ascontiguousarray(px[np.arange(height) * h // height][:, np.arange(width) * w // width]).tobytes()
    if image is not None and width is not None and height is not None and len(image) != width * height * 3:
        raise ValueError("wrong size")
    return image


@dataclass(frozen=True)
class WindowEditor:
    """An image editor at work on windows of pixel rows ``(key…, y, x, r, g, b, …)``: each window is packed into one image
    (lines first, then the window of lines), edited, and unpacked. Pixels of failed windows stay, with their status. The editor also
    gets the key, ``width``, ``height`` and a ``seed`` drawn from the key. A window must be dense."""

    editor: PythonEditor
    key: tuple[str, ...] = ("box_id",)

    def apply(self, px: DataFrame) -> DataFrame:
        key = list(self.key)
        hex3 = F.lpad(F.hex(F.shiftleft(F.col("b").cast("int"), 16) + F.shiftleft(F.col("g").cast("int"), 8) + F.col("r").cast("int")), 6, "0")
        line = px.select(*key, "y", F.struct(F.col("x").cast("int").alias("x"), hex3.alias("v")).alias("p")).groupBy(*key, "y").agg(
            F.sort_array(F.collect_list("p")).alias("p"), F.count("*").cast("int").alias("width"), F.min("p.x").alias("x0")
        )
        line = line.select(*key, "width", "x0", F.struct(F.col("y").cast("int").alias("y"), F.unhex(F.array_join(F.transform("p", lambda p: p.v), "")).alias("v")).alias("p"))
        win = line.groupBy(*key).agg(F.max("width").alias("width"), F.count("*").cast("int").alias("height"), F.min("x0").alias("x0"), F.sort_array(F.collect_list("p")).alias("p"))
        win = win.select(*key, "width", "height", "x0", F.col("p")[0].y.alias("y0"), F.unhex(F.array_join(F.transform("p", lambda p: F.hex(p.v)), "")).alias("payload"))
        out = self.editor.apply(win.withColumn("seed", F.pmod(F.xxhash64(*key), F.lit(1 << 31))))
        lines = out.select(*key, "width", "x0", "y0", "status", "payload", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("i"))
        lines = lines.select(*key, "x0", "status", (F.col("i") + F.col("y0")).alias("y"), F.expr("substring(payload, i * width * 3 + 1, width * 3)").alias("line"), "width")
        pixel = F.posexplode(F.expr("transform(sequence(0, width - 1), i -> hex(substring(line, i * 3 + 1, 3)))"))
        new = lines.select(*key, "y", "x0", "status", pixel.alias("i", "v"))
        part = lambda at: F.conv(F.substring("v", at, 2), 16, 10).cast("long")
        new = new.select(*key, "y", (F.col("i") + F.col("x0")).alias("x"), "status", part(5).alias("new_r"), part(3).alias("new_g"), part(1).alias("new_b"))
        j = px.drop("status").join(new, [*key, "y", "x"], "left")
        ok = F.col("status") == "ok"
        rest = [c for c in px.columns if c not in ("r", "g", "b", "status")]
        return j.select(*rest, *[F.when(ok, F.col("new_" + c)).otherwise(F.col(c)).cast("long").alias(c) for c in "rgb"], F.coalesce("status", F.lit("no image")).alias("status"))


SLOTS = ("tl", "tr", "bl", "br")


@dataclass(frozen=True)
class QuadEditor:
    """An image editor at work on the 2 x 2 windows of a walk, whose columns ``tl, tr, bl, br`` each hold ``width`` x ``height``
    pixels as lines of BGR bytes. It sees one image of twice the size; a call with a missing quadrant fails."""

    editor: PythonEditor
    width: int
    height: int

    def apply(self, windows: DataFrame) -> DataFrame:
        inner, w, h = self.editor, self.width, self.height

        def edit(row, model):
            quads = [row.pop(c) for c in SLOTS]
            if any(q is None or len(q) != w * h * 3 for q in quads):
                raise ValueError("missing quadrant")
            a, b, c, d = (np.frombuffer(q, np.uint8).reshape(h, w, 3) for q in quads)
            image = np.concatenate([np.concatenate([a, b], 1), np.concatenate([c, d], 1)]).tobytes()
            return fitted(inner.edit({**row, "payload": image, "width": 2 * w, "height": 2 * h}, model), 2 * w, 2 * h)

        cols = windows.columns
        ask = windows.withColumn("payload", F.lit(None).cast("binary"))
        out = PythonEditor(edit, inner.load, inner.options).apply(ask)

        def quad(i: int) -> Column:
            start = f"(i + {i // 2 * h}) * {6 * w} + {i % 2 * 3 * w + 1}"
            return F.unhex(F.expr(f"array_join(transform(sequence(0, {h - 1}), i -> hex(substring(payload, {start}, {3 * w}))), '')"))

        new = {c: F.when(F.col("status") == "ok", quad(i)).otherwise(F.col(c)) for i, c in enumerate(SLOTS)}
        return out.withColumns(new).select(*cols, "status")


def convert_tiles(tiles: DataFrame, editor, tasks: int | None = None) -> DataFrame:
    """Independent conversion of whole tiles ``(…, payload)``. ``tasks`` sets how many editors run side by side."""
    return editor.apply(tiles.repartition(tasks) if tasks else tiles)


def or_keep(base: DataFrame, edited: DataFrame, key: list[str]) -> DataFrame:
    """Edited payload where the edit worked, else the old one."""
    good = edited.where("status = 'ok'").select(*key, F.col("payload").alias("fresh"))
    j = base.join(good, key, "left")
    return j.withColumn("edited", F.col("fresh").isNotNull()).withColumn("payload", F.coalesce("fresh", "payload")).drop("fresh")
