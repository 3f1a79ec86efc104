"""Boxes edited area by area: many links of a chain in one task, with the results of one box after another."""

import collections

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from test_masks import image
from test_walk import serial_edits, to_array
from tessella.plans import arrays as A
from tessella.plans import editor as E
from tessella.plans import river as V
from tessella.queries.jobs import soften_in_context

BOX = "box_id long, x0 long, y0 long, x1 long, y1 long"


class Rounds:
    """The same editor, of which only ``apply`` is known: goes by rounds."""

    def __init__(self, editor):
        self.apply = editor.apply


def test_a_long_chain_takes_few_jobs(spark):
    rng = np.random.default_rng(31)
    canvas, raw = rng.integers(0, 256, (16, 240, 3)), rng.integers(0, 256, (16, 240, 3))
    order = spark.createDataFrame([(c, 0, c) for c in range(30)], "col int, row int, idx int")
    px, second = (V.save(image(spark, a)) for a in (canvas, raw))
    spark.sparkContext.setJobGroup("chain", "")
    try:
        got = V.river_walk(px, second, order, E.ColumnEditor(soften_in_context), 8, 2, 240, 16)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (to_array(got, canvas.shape) == serial_edits(canvas, [(c, c * 8, 0, c * 8 + 8, 8) for c in range(30)], 16, 2, raw=raw)).all()
    assert jobs < 60


@pytest.mark.parametrize("pixels", [1, 700, 2_000_000])
def test_areas_of_any_size_follow_the_ids(spark, monkeypatch, pixels):
    monkeypatch.setattr(V, "AREA_PIXELS", pixels)
    rng = np.random.default_rng(32)
    canvas, raw = rng.integers(0, 256, (60, 48, 3)), rng.integers(0, 256, (60, 48, 3))
    boxes = [(i, int(x), int(y), int(x) + 3 + i % 9, int(y) + 2 + i % 7) for i, (x, y) in enumerate(rng.integers(0, 36, (24, 2)))]
    got = V.edit_boxes(image(spark, canvas), spark.createDataFrame(boxes, BOX), E.ColumnEditor(soften_in_context), 16, 2, 48, 60, raw=image(spark, raw))
    assert (to_array(got, canvas.shape) == serial_edits(canvas, boxes, 16, 2, raw=raw)).all()


def test_holes_nulls_and_repeats_as_by_rounds(spark, monkeypatch):
    monkeypatch.setattr(V, "AREA_PIXELS", 600)
    rng = np.random.default_rng(33)

    def some(n):
        rows = [(int(y), int(x), *[None if rng.random() < 0.1 else int(v) for v in rng.integers(0, 256, 3)]) for y, x in zip(rng.integers(0, 40, n), rng.integers(0, 30, n))]
        return V.save(spark.createDataFrame([*rows, (None, 3, 1, 2, 3), (3, None, 1, 2, 3)], "y int, x int, r int, g int, b int"))

    canvas, raw = some(1100), some(700)
    boxes = [(i, int(x), int(y), int(x) + 9, int(y) + 8) for i, (x, y) in enumerate(zip(rng.integers(-3, 25, 7), rng.integers(-3, 36, 7)))]
    boxes = V.save(spark.createDataFrame([*boxes, (None, 2, 2, 5, 5), (20, None, 2, 5, 5)], BOX))
    fill = spark.createDataFrame([(1, 9, None, 7), (3, 1, 2, 3)], "box_id long, fr long, fg long, fb long")
    ed = E.ColumnEditor(soften_in_context)
    for more in ({"raw": raw}, {"fill": fill}):
        a, b = (collections.Counter(map(tuple, V.edit_boxes(canvas, boxes, e, 12, 2, 30, 40, **more).collect())) for e in (ed, Rounds(ed)))
        assert a == b and a != collections.Counter(map(tuple, canvas.select("y", "x", "r", "g", "b").collect()))


def test_expressions_on_arrays(spark):
    w = W.partitionBy("box_id")
    good = [
        lambda: {"r": F.floor((F.col("r") + F.floor(F.avg("g").over(w))) / 2)},
        lambda: {"g": F.lit(255) - F.col("r") * 2, "b": F.max("b").over(w) - F.min("r").over(w) + F.sum("g").over(w)},
        lambda: {"b": F.col("x") + F.col("y") * F.col("bx1"), "r": F.col("g") / 3 * 0.5},
    ]
    rows = [(1, y, x, *[None if (x * y + c) % 7 == 0 else (x * 31 + y * 17 + c * 5) % 256 for c in range(3)], 0, 0, 5, 4, 2, 1) for y in range(3) for x in range(4)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in A.KNOWN))
    v = {c: np.array([r[i] or 0 for r in rows], np.int64) for i, c in enumerate(A.KNOWN)}
    cols = {c: (v[c], np.array([r[i] is not None for r in rows])) for i, c in enumerate(A.KNOWN)}
    for make in good:
        steps = A.compiled(spark, make)
        want = {(r.y, r.x): (r.r, r.g, r.b) for r in df.withColumns(make()).collect()}
        got = [A.value(steps[c], cols) for c in "rgb"]
        for i, r in enumerate(rows):
            have = tuple(np.broadcast_to(a, 12)[i].item() if k is None or np.broadcast_to(k, 12)[i] else None for a, k in got)
            assert have == want[r[1], r[2]]
    with pytest.raises(ZeroDivisionError):
        A.value(A.compiled(spark, lambda: {"r": F.col("r") / F.col("ox")})["r"], cols | {"ox": (np.asarray(0), None)})
    with pytest.raises(ArithmeticError):
        A.value(A.compiled(spark, lambda: {"r": F.col("r") * F.lit(2**62)})["r"], cols)
    bad = [
        lambda: {"r": F.col("under.r")}, lambda: {"y": F.col("x")}, lambda: {"r": F.rand()}, lambda: {"r": F.when(F.col("r") > 2, 1)},
        lambda: {"r": F.row_number().over(w.orderBy("x"))}, lambda: {"r": F.avg("r").over(W.partitionBy("y"))}, lambda: {"r": F.sum("r").over(w.orderBy("x"))},
    ]
    assert [A.compiled(spark, make) for make in bad] == [None] * len(bad)


def test_thin_sets_of_tiles_are_searched_far(spark, monkeypatch):
    thin = spark.range(4200).selectExpr("1 region", "0 col", "cast(id as int) row")
    full = spark.range(512 * 512).selectExpr("1 region", "cast(id % 512 as int) col", "cast(id div 512 as int) row")
    assert V.reach_of(thin, "region") == 1024 and V.reach_of(full, "region") == 64
    monkeypatch.setattr(V, "NEAR_TILES", 4000)
    assert V.reach_of(thin, "region") == 1024 and V.reach_of(full, "region") == 32
    assert V.reach_of(full.where("row < 0"), "region") == 32
